"""Staging to star schema. Each function returns a new version of one table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.functions.dates import parse_date, parse_month
from ebbline.functions.text import blank_to_null, bool_flag, pipe_items, strict_number, to_int, warehouse_norm
from ebbline.operators.checks import key_violations, orphans
from ebbline.operators.dedup import latest
from ebbline.operators.keys import assign_keys
from ebbline.operators.membership import is_small
from ebbline.operators.spread import spread
from ebbline.operators.upsert import absent, delete_insert


def typed_metadata(landing: DataFrame) -> DataFrame:
    """All-text landing rows to typed staging; rows without a usable id are rejected."""
    return landing.select(
        to_int(F.col("app_id")).alias("app_id"),
        bool_flag(F.col("is_free")).alias("is_free"),
        strict_number(F.col("price_usd")).alias("price_usd"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("release_date_str", "genres_csv", "categories_csv", "scraped_utc")],
    ).filter("app_id is not null")


def latest_metadata(typed: DataFrame) -> DataFrame:
    """One row per app: the one fetched last, equal ones decided by all columns."""
    return latest(typed, ["app_id"], ["scraped_utc"], typed.columns)


def latest_months(monthly: DataFrame) -> DataFrame:
    """One row per app and month of a load: the one fetched last. Summed up before the shuffle."""
    keys = ["app_id", "month_index", "month_label"]
    rest = ["scraped_utc", *[c for c in monthly.columns if c not in (*keys, "scraped_utc")]]
    newest = monthly.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in monthly.columns])


def price_tier(is_free: Column, price: Column) -> Column:
    """A free, unpriced or zero-priced entity is Free."""
    # Names and bounds of the tiers.
    return (
        F.when(is_free | price.isNull() | (price == 0), "Free")
        .when(price < 10, "Under_10")
        .when(price < 30, "10_29")
        .when(price < 60, "30_59")
        .otherwise("60_plus")
    )


def upsert_apps(dim: DataFrame | None, typed: DataFrame, keep_stale_release: bool = False, numbered: DataFrame | None = None) -> DataFrame:
    """Type-1 upsert of the app dimension; surrogate keys of known apps are kept.

    ``dim`` may be the part of the dimension that can hold the ids of ``typed``; new keys then follow those of ``numbered``, the whole.

    ``keep_stale_release`` keeps a release date that is already set although its
    text has changed; by default the date follows the text.
    """
    source = typed.select(
        "app_id", F.col("is_free").cast("boolean").alias("is_free"), "price_usd", "release_date_str"
    )
    if dim is None:
        merged = assign_keys(source, ["app_id"], "app_sk").withColumn("_old_release", F.lit(None).cast("date"))
    else:
        fresh = assign_keys(source.join(dim.select("app_id"), "app_id", "left_anti"), ["app_id"], "app_sk", dim if numbered is None else numbered)
        known = dim.alias("d").join(source.withColumn("_seen", F.lit(True)).alias("s"), "app_id", "left")

        def newer(name: str) -> Column:
            return F.when(F.col("_seen"), F.col(f"s.{name}")).otherwise(F.col(f"d.{name}")).alias(name)

        updated = known.select(
            "app_id", "app_sk", newer("is_free"), newer("price_usd"), newer("release_date_str"),
            F.col("d.release_date").alias("_old_release"),
        )
        merged = updated.unionByName(fresh, allowMissingColumns=True)
    release = parse_date(F.col("release_date_str"))
    if keep_stale_release:
        release = F.coalesce("_old_release", release)
    return merged.select(
        F.col("app_sk").cast("long").alias("app_sk"),
        "app_id",
        "is_free",
        "price_usd",
        price_tier(F.coalesce("is_free", F.lit(False)), F.col("price_usd")).alias("price_tier"),
        release.alias("release_date"),
        "release_date_str",
    )


def new_dates(dim: DataFrame | None, monthly: DataFrame) -> DataFrame:
    """The (label, index) pairs that the calendar lacks, with keys; NULL labels match themselves."""
    pairs = monthly.select(blank_to_null(F.col("month_label")).alias("month_label"), "month_index").distinct()
    keys = ["month_label", "month_index"]
    new = pairs if dim is None else absent(pairs, dim, keys)
    start = parse_month(F.col("month_label"))
    return assign_keys(new, keys, "date_sk", dim).select(
        "date_sk",
        start.alias("month_start_date"),
        F.year(start).alias("year_num"),
        F.month(start).alias("month_num"),
        *keys,
    )


def upsert_dates(dim: DataFrame | None, monthly: DataFrame) -> DataFrame:
    """The calendar with the pairs that are new."""
    rows = new_dates(dim, monthly)
    return rows if dim is None else dim.unionByName(rows)


def tag_items(typed: DataFrame, kinds: tuple[str, ...] = ("genre", "category")) -> DataFrame:
    """``(app_id, kind, tag_name, tag_norm)``, one row per list item of each kind."""
    field = {"genre": "genres_csv", "category": "categories_csv"}

    def tagged(kind: str) -> Column:
        items = pipe_items(F.col(field[kind]))
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("tag_name")))

    return (
        typed.select("app_id", F.explode(F.concat(*[tagged(k) for k in kinds])).alias("item"))
        .select("app_id", "item.kind", "item.tag_name")
        .withColumn("tag_norm", warehouse_norm(F.col("tag_name")))
    )


def new_tags(dim: DataFrame | None, items: DataFrame, kind: str) -> DataFrame:
    """The tag keys that the dimension lacks; of several spellings the least one names the key. Only different spellings are sorted."""
    sk, name, norm = f"{kind}_sk", f"{kind}_name", f"{kind}_norm"
    found = (
        items.filter(F.col("kind") == kind)
        .groupBy("tag_norm", "tag_name")
        .agg(F.count("*").alias("_rows"))
        .filter("_rows > 0")  # always; below a minimum Catalyst drops a plain distinct
        .groupBy(F.col("tag_norm").alias(norm))
        .agg(F.min("tag_name").alias(name))
    )
    new = found if dim is None else found.join(dim.select(norm), norm, "left_anti")
    return assign_keys(new, [norm], sk, dim).select(sk, name, norm)


def upsert_tags(dim: DataFrame | None, items: DataFrame, kind: str) -> DataFrame:
    """The dimension with the tag keys that are new."""
    rows = new_tags(dim, items, kind)
    return rows if dim is None else dim.unionByName(rows)


def new_pairs(bridge: DataFrame | None, items: DataFrame, apps: DataFrame, tags: DataFrame, kind: str) -> DataFrame:
    """The (app, tag) pairs that the bridge lacks. A bridge bucketed by both keys is read without an exchange.

    Items are dealt out by app before their repeats go, so no task holds the pairs of a whole split of a file.
    """
    sk, norm = f"{kind}_sk", f"{kind}_norm"
    own = items.filter(F.col("kind") == kind).select("app_id", F.col("tag_norm").alias(norm))
    wanted = spread(own, "app_id", own.count()).distinct()
    pairs = (
        wanted.join(_small(tags.select(norm, sk)), norm)
        .join(apps.select("app_id", "app_sk"), "app_id")
        .select("app_sk", sk)
    )
    return pairs if bridge is None else pairs.join(bridge.hint("merge"), ["app_sk", sk], "left_anti")


def insert_bridge(bridge: DataFrame | None, items: DataFrame, apps: DataFrame, tags: DataFrame, kind: str) -> DataFrame:
    """The bridge with the pairs that are new."""
    rows = new_pairs(bridge, items, apps, tags, kind)
    return rows if bridge is None else bridge.unionByName(rows)


def _small(dimension: DataFrame) -> DataFrame:
    """A dimension marked for broadcast after a count, which stops at the bound: its keys are hot in the rows it joins."""
    return F.broadcast(dimension) if is_small(dimension) else dimension


def fact_rows(monthly: DataFrame, apps: DataFrame, dates: DataFrame) -> DataFrame:
    """Staging rows with their surrogate keys; a NULL month label matches nothing and drops."""
    calendar = dates.select("month_index", "month_label", "date_sk")
    return (
        monthly.join(_small(calendar), ["month_index", "month_label"])
        .join(apps.select("app_id", "app_sk"), "app_id")
        .select("app_sk", "date_sk", "avg_players", "peak_players", "scraped_utc")
    )


def upsert_fact(fact: DataFrame | None, new: DataFrame) -> DataFrame:
    """Reload: rows of the loaded keys are replaced, other rows are kept."""
    return new if fact is None else delete_insert(fact, new, ["app_sk", "date_sk"])


def activity(fact: DataFrame, apps: DataFrame, dates: DataFrame) -> DataFrame:
    """The fact with its natural keys back, as the marts read it."""
    return (
        fact.join(_small(dates.select("date_sk", "month_index", "month_label", "month_start_date")), "date_sk")
        .join(apps.select("app_sk", "app_id"), "app_sk")
        .select("app_id", "month_index", "month_label", "month_start_date", "avg_players", "peak_players")
    )


def check_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Violated primary and unique keys over the whole star; empty when sound."""
    unique = [
        ("dim_app", ["app_sk"]), ("dim_app", ["app_id"]),
        ("dim_date", ["date_sk"]), ("dim_date", ["month_label", "month_index"]),
        ("dim_genre", ["genre_sk"]), ("dim_genre", ["genre_norm"]),
        ("dim_category", ["category_sk"]), ("dim_category", ["category_norm"]),
        ("bridge_app_genre", ["app_sk", "genre_sk"]), ("bridge_app_category", ["app_sk", "category_sk"]),
        ("fact_monthly", ["app_sk", "date_sk"]),
    ]
    by_table: dict[str, list[tuple[list[str], bool]]] = {}
    for table, keys in unique:
        by_table.setdefault(table, []).append((keys, keys == ["month_label", "month_index"]))
    found = [key_violations(tables[t], t, keys) for t, keys in by_table.items() if t in tables]
    return reduce(DataFrame.unionByName, found)


def check_references(tables: dict[str, DataFrame]) -> DataFrame:
    """Surrogate keys without their dimension row over the whole star; empty when sound."""
    references = [
        ("bridge_app_genre", "dim_app", "app_sk"), ("bridge_app_genre", "dim_genre", "genre_sk"),
        ("bridge_app_category", "dim_app", "app_sk"), ("bridge_app_category", "dim_category", "category_sk"),
        ("fact_monthly", "dim_app", "app_sk"), ("fact_monthly", "dim_date", "date_sk"),
    ]
    found = [
        orphans(tables[child], tables[parent], key, f"{child}.{key} -> {parent}")
        for child, parent, key in references
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, found)


def build_star(
    typed: DataFrame, monthly: DataFrame, old: dict[str, DataFrame] | None = None,
    store: Callable[[str, DataFrame], DataFrame] = lambda name, table: table,
) -> dict[str, DataFrame]:
    """All star tables from typed metadata and monthly staging, on top of ``old`` versions.

    ``store`` may write each table and give it back read, in dependency order, so none is computed twice.
    """
    old = old or {}
    typed, monthly = store("typed", latest_metadata(typed)), store("monthly", latest_months(monthly))
    apps = store("dim_app", upsert_apps(old.get("dim_app"), typed))
    dates = store("dim_date", upsert_dates(old.get("dim_date"), monthly))
    items = tag_items(typed)
    star = {"dim_app": apps, "dim_date": dates}
    for kind in ("genre", "category"):
        tags = store(f"dim_{kind}", upsert_tags(old.get(f"dim_{kind}"), items, kind))
        star[f"dim_{kind}"] = tags
        bridge = insert_bridge(old.get(f"bridge_app_{kind}"), items, apps, tags, kind)
        star[f"bridge_app_{kind}"] = store(f"bridge_app_{kind}", bridge)
    star["fact_monthly"] = store("fact_monthly", upsert_fact(old.get("fact_monthly"), fact_rows(monthly, apps, dates)))
    return star


STAR_SCHEMAS = {
    "dim_app": schemas.DIM_APP,
    "dim_date": schemas.DIM_DATE,
    "dim_genre": schemas.dim_tag("genre"),
    "dim_category": schemas.dim_tag("category"),
    "bridge_app_genre": schemas.bridge("genre"),
    "bridge_app_category": schemas.bridge("category"),
    "fact_monthly": schemas.FACT_MONTHLY,
}
