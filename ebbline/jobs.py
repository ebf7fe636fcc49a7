"""The steps as path-in, path-out jobs.

Each reads stored tables, runs one plan and stores the result, so a step can be
repeated or resumed alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline import params, schemas
from ebbline.operators.checks import require_columns
from ebbline.operators.membership import is_small, parse_wanted
from ebbline.operators.split import sample_ids
from ebbline.plans import boosting, charts, evaluate, marts, metadata, pages, panel, scoring, warehouse
from ebbline.plans.training import model_rows
from ebbline.session import new_path, scratch
from ebbline.sources import readers, tables, writers
from ebbline.streaming import incremental

FACT = "fact_monthly"
# The marts and the names of their views.
MART_VIEWS = {
    "app_persistence": "v_app_persistence_6m",
    "decay_curve": "v_player_decay_curve",
    "genre_retention": "v_genre_retention_6m",
    "category_retention": "v_category_retention_6m",
    "price_tier_retention": "v_price_tier_retention",
    "growth_decay": "v_top_growth_decay_6m",
}


def collect_ids(list_pages: DataFrame, sweep_pages: DataFrame | None, out: str) -> None:
    """Distinct ids of list pages and of the sweep, as a sorted CSV."""
    sources = [pages.list_page_ids(list_pages)]
    if sweep_pages is not None:
        sources.append(pages.sweep_ids(sweep_pages))
    writers.write_ids(pages.candidate_ids(*sources), out)


def pull_metrics(
    spark: SparkSession, raw_pages: DataFrame, ids_path: str, out: str, max_ids: int = params.MAX_IDS, resume: bool = True
) -> DataFrame:
    """Parse the pages of the wanted ids that are not done yet, append parts, return the counters.

    ``max_ids`` above zero takes only so many of the least ids; those left out count as pending.
    """
    every = readers.read_ids(spark, ids_path)
    wanted = sample_ids(every, max_ids).select("app_id")
    if resume and _has_parts(spark, out):
        wanted = pages.pending_ids(wanted, readers.read_parts(spark, out, schemas.METRICS_WIDE))
    wide = parse_wanted(raw_pages, wanted, lambda raw: pages.wide_metrics(pages.parse_pages(raw)))
    writers.write_parts(wide, out)
    return pages.run_counters(readers.read_parts(spark, out, schemas.METRICS_WIDE), every)


def stream_metrics(
    spark: SparkSession, raw_pages: str, out: str, checkpoint: str, progress: str, files_per_batch: int = 1000
) -> DataFrame:
    """Parse the page files that arrived since the last run, one part per micro-batch; return all counters.

    ``out`` holds one row per fetch; the panel takes the latest usable one.
    """
    stream = incremental.stream_files(spark, raw_pages, schemas.RAW_PAGES, files_per_batch)
    # A batch is a few files of any size; dealt out, all cores parse it.
    dealt = stream.repartition(spark.sparkContext.defaultParallelism)
    parsed = pages.wide_metrics(pages.parse_pages(dealt))
    incremental.ingest(parsed, out, checkpoint, pages.counters(), progress)
    return spark.read.parquet(progress).agg(*[F.sum(c).alias(c) for c in ("processed", *pages.OUTCOMES)])


def pull_metadata(
    spark: SparkSession, documents: DataFrame, metrics: str, parts: str, merged: str, failures: str, resume: bool = True
) -> None:
    """Project the documents of usable ids not done yet; append parts, log failures, merge."""
    wanted = pages.ok_ids(readers.read_parts(spark, metrics, schemas.METRICS_WIDE))
    if resume and _has_parts(spark, parts):
        wanted = pages.pending_ids(wanted, readers.read_parts(spark, parts, schemas.METADATA))
    writers.write_parts(parse_wanted(documents, wanted, metadata.parse_documents), parts)
    pages.failure_log(readers.read_parts(spark, parts, schemas.METADATA), "fetch_or_parse").write.mode(
        "overwrite"
    ).parquet(failures)
    writers.compact_parts(spark, parts, merged, schemas.METADATA)


def prepare_load(spark: SparkSession, merged: str, out: str) -> None:
    writers.write_csv(metadata.load_format(readers.read_parts(spark, merged, schemas.METADATA)), out)


def _tag_tables() -> list[tuple[str, str, str]]:
    return [(kind, f"dim_{kind}", f"bridge_app_{kind}") for kind in ("genre", "category")]


def _bridge(spark: SparkSession, root: str, kind: str) -> str:
    """The name of a stored bridge, bucketed by both keys."""
    name = f"bridge_app_{kind}"
    return tables.bucketed_table(spark, f"{root}/{name}", warehouse.STAR_SCHEMAS[name], ["app_sk", f"{kind}_sk"])


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star tables as stored; those never written have no rows."""
    star = {}
    for name, schema in warehouse.STAR_SCHEMAS.items():
        if name.startswith("bridge_"):
            spark.catalog.refreshByPath(f"{root}/{name}")
            star[name] = spark.table(_bridge(spark, root, name.removeprefix("bridge_app_")))
        else:
            fields = f"{schema}, bucket int" if name == "dim_app" else schema
            star[name] = tables.read_table(spark, f"{root}/{name}", fields).select(*StructType.fromDDL(fields).names)
    return star


def load_warehouse(spark: SparkSession, monthly_csv: str, metadata_csv: str, root: str) -> dict[str, DataFrame]:
    """Load both CSVs into the star at ``root``; the first load makes it.

    The files are staged, replacing the staging of the load before; of repeated keys the row fetched last is staged. What
    changes is worked out beside the star: the hash partitions of the app dimension and the months of the fact that the load
    touches, and the new rows of the calendar, the tags and the bridges. A load that breaks a key or a reference is
    refused before anything is published. Then new rows are appended, parents first, and touched partitions are
    overwritten. A load that was cut off can be repeated: what it published is found as known.
    """
    old = read_star(spark, root)
    staging = f"{root}/staging"

    def staged(name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{staging}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{staging}/{name}")

    typed = staged("typed", warehouse.latest_metadata(warehouse.typed_metadata(readers.read_metadata_landing(spark, metadata_csv))))
    monthly = staged("monthly", warehouse.latest_months(readers.read_monthly_long(spark, monthly_csv)))
    new = {"dim_date": staged("dim_date", warehouse.new_dates(old["dim_date"], monthly))}

    bucket = tables.key_bucket("app_id")
    buckets = [r[0] for r in typed.select(bucket).distinct().collect()]
    touched = old["dim_app"].filter(F.col("bucket").isin(*buckets)).drop("bucket")
    apps = warehouse.upsert_apps(touched, typed, numbered=old["dim_app"]).withColumn("bucket", bucket)
    new["dim_app"] = staged("dim_app", apps)
    after = {
        "dim_date": old["dim_date"].unionByName(new["dim_date"]),
        "dim_app": old["dim_app"].filter(~F.col("bucket").isin(*buckets)).unionByName(new["dim_app"]).drop("bucket"),
    }
    items = warehouse.tag_items(typed)
    for kind, dimension, bridge in _tag_tables():
        new[dimension] = staged(dimension, warehouse.new_tags(old[dimension], items, kind))
        after[dimension] = old[dimension].unionByName(new[dimension])
        new[bridge] = staged(bridge, warehouse.new_pairs(old[bridge], items, after["dim_app"], after[dimension], kind))
        after[bridge] = old[bridge].unionByName(new[bridge])
    rows = staged("fact_rows", warehouse.fact_rows(monthly, after["dim_app"], after["dim_date"]).select(*old[FACT].columns))
    months = rows.select("date_sk").distinct()
    # The months of a load: a few calendar entries, which prune the stored partitions.
    new[FACT] = staged(FACT, warehouse.upsert_fact(old[FACT].join(F.broadcast(months) if is_small(months) else months, "date_sk", "left_semi"), rows))
    after[FACT] = old[FACT].join(months, "date_sk", "left_anti").unionByName(new[FACT])
    _refuse_violations(after)

    new["dim_date"].write.mode("append").parquet(f"{root}/dim_date")
    for _, dimension, _ in _tag_tables():
        new[dimension].write.mode("append").parquet(f"{root}/{dimension}")
    tables.overwrite_partitions(new["dim_app"], f"{root}/dim_app", "bucket")
    for kind, _, bridge in _tag_tables():
        tables.append_bucketed(new[bridge], _bridge(spark, root, kind), ["app_sk", f"{kind}_sk"])
    tables.overwrite_partitions(new[FACT], f"{root}/{FACT}", "date_sk")
    spark.catalog.refreshByPath(root)
    star = read_star(spark, root)
    return star | {"dim_app": star["dim_app"].drop("bucket")}


def _refuse_violations(star: dict[str, DataFrame]) -> None:
    """Stop a load whose keys or references are broken; the message names the first few."""
    found = warehouse.check_keys(star).unionByName(warehouse.check_references(star)).limit(10).collect()
    if found:
        raise ValueError("The star violates its keys: " + "; ".join(f"{r['check_name']}: {r['key_value']}" for r in found))


def build_marts(star: dict[str, DataFrame], store: Callable[[DataFrame], DataFrame] = lambda mart: mart) -> dict[str, DataFrame]:
    """The six marts over a stored star. ``store`` may write the app mart, which four others read, and give it back read."""
    activity = warehouse.activity(star["fact_monthly"], star["dim_app"], star["dim_date"])
    persistence = store(marts.app_persistence(activity, star["dim_app"]))
    return {
        "app_persistence": persistence,
        "decay_curve": marts.decay_curve(activity),
        "genre_retention": marts.tag_retention(persistence, star["bridge_app_genre"], star["dim_genre"], "genre"),
        "category_retention": marts.tag_retention(
            persistence, star["bridge_app_category"], star["dim_category"], "category"
        ),
        "price_tier_retention": marts.price_tier_retention(persistence),
        "growth_decay": marts.growth_decay(persistence),
    }


def register_views(star: dict[str, DataFrame]) -> None:
    """The star tables and the marts as temporary views, for SQL."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)
    for name, mart in build_marts(star).items():
        mart.createOrReplaceTempView(MART_VIEWS[name])


def export_marts(star: dict[str, DataFrame], out: str) -> None:
    """The marts as headed CSV folders."""
    spark = star["dim_app"].sparkSession

    def store(mart: DataFrame) -> DataFrame:
        path = new_path(spark, "app-mart")
        mart.write.parquet(path)
        return spark.read.schema(mart.schema).parquet(path)

    with scratch(spark):
        for name, mart in build_marts(star, store).items():
            writers.write_csv(mart, f"{out}/{name}")


def build_charts(mart: dict[str, DataFrame], excluded: DataFrame | None = None) -> dict[str, DataFrame]:
    trend = mart["growth_decay"]
    points = charts.excluding(trend, excluded) if excluded is not None else trend
    return {
        "life_cycle": charts.life_cycle(mart["decay_curve"]),
        "price_range": charts.price_range(mart["price_tier_retention"]),
        "top_genres": charts.top_groups(mart["genre_retention"], "genre_name"),
        "top_categories": charts.top_groups(mart["category_retention"], "category_name"),
        "scatter": points,
        "trend_lines": charts.trend_lines(points),
    }


def make_panel(spark: SparkSession, metrics: str, merged: str, vocabulary_out: str, out: str) -> None:
    """Vocabulary and panel tables from stored metrics and metadata."""
    joined = panel.metrics_with_metadata(
        readers.read_parts(spark, metrics, schemas.METRICS_WIDE), readers.read_parts(spark, merged, schemas.METADATA)
    )
    with scratch(spark):
        path = new_path(spark, "joined")
        joined.write.parquet(path)
        joined = spark.read.schema(joined.schema).parquet(path)
        panel.tag_vocabulary(joined).coalesce(1).write.mode("overwrite").parquet(vocabulary_out)
        panel.build_panel(joined).write.mode("overwrite").parquet(out)


def train(
    spark: SparkSession, panel_path: str, vocabulary: str, split: str, out: str,
    config: boosting.BoostingConfig = boosting.BoostingConfig(),
) -> DataFrame:
    """Fit and store the quantile models; reuse the stored split if there is one; return the summary."""
    rows = require_columns(spark.read.parquet(panel_path), ["app_id", "y_log_avg", "avg_k"], "Panel")
    if not _has_parts(spark, split):
        boosting.group_split(model_rows(rows), share=config.test_share, seed=config.seed).write.parquet(split)
    words = panel.collect_vocabulary(spark.read.parquet(vocabulary))
    with scratch(spark):
        model, fitted, held_out = boosting.fit(rows, words, config, spark.read.parquet(split))
        boosting.save_model(spark, model, f"{out}/model")
        summary = summarize(model, fitted, held_out)
        summary.coalesce(1).write.mode("overwrite").json(f"{out}/summary")
        falling = evaluate.downtrend_slice(boosting.predict(held_out, model))
        falling.coalesce(1).write.mode("overwrite").json(f"{out}/downtrend")
    return spark.read.json(f"{out}/summary")


def summarize(model: boosting.QuantileModel, fitted: DataFrame, held_out: DataFrame) -> DataFrame:
    """Metrics of the held-out rows with the sizes and the configuration."""
    n_train = fitted.groupBy().count().scalar()
    return evaluate.metrics(boosting.predict(held_out, model)).withColumns(
        {
            "n_train": n_train,
            "n_features": F.lit(len(model.feature_names)),
            "quantiles": F.array(*[F.lit(q) for q in sorted(model.trees)]),
            "model_family": F.lit("boosted regression trees, pinball loss, downtrend weight"),
            "target": F.lit("delta = y_log_avg - ln(avg_k)"),
            "weight_feature": F.lit(params.DOWNTREND_FEATURE),
            "weight_threshold": F.lit(params.DOWNTREND_THRESHOLD),
            "weight_multiplier": F.lit(params.DOWNTREND_WEIGHT),
        }
    )


def predict(spark: SparkSession, input_csv: str, model: str, out: str) -> None:
    """Score a CSV; every input row comes back, with forecasts or an error."""
    writers.write_csv(scoring.score(readers.read_predict_input(spark, input_csv), boosting.load_model(spark, model)), out)


def _has_parts(spark: SparkSession, path: str) -> bool:
    try:
        readers.read_parts(spark, path, "app_id long")
    except FileNotFoundError:
        return False
    return True
