"""Plans end to end on small fixtures: invariants, idempotence, round trips."""

import json
import math

import pytest
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.functions import html
from ebbline.functions.series import SHAPE_FEATURES
from ebbline.plans import charts, evaluate, marts, metadata, pages, panel, scoring, training, warehouse


def wide_rows(spark, entities):
    """``{app_id: [(label, avg, peak) newest first]}`` as wide metrics."""
    rows = []
    for app_id, months in entities.items():
        flat = [x for m in (months + [(None, None, None)] * 12)[:12] for x in m]
        rows.append((app_id, "ok", "2024-01-01", "u", None, None, None, None, *flat))
    return spark.createDataFrame(rows, schemas.METRICS_WIDE)


def series(n, start=10.0, step=1.1):
    """n months, newest first, growing into the present."""
    names = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
    chrono = [(f"{names[i % 12]} {2023 + i // 12}", start * step**i, 2 * start * step**i) for i in range(n)]
    return chrono[::-1]


def meta_rows(spark, ids):
    rows = [(i, "ok", "2024-01-01", i % 2 == 0, 9.99, "23 Feb, 2022", ["Action", "Indie"], ["Single-player"], None) for i in ids]
    return spark.createDataFrame(rows, schemas.METADATA)


def panel_of(spark, entities, **options):
    joined = panel.metrics_with_metadata(wide_rows(spark, entities), meta_rows(spark, entities))
    return panel.build_panel(joined, **options)


def test_twelve_months_give_four_rows_and_eleven_none(spark):
    rows = panel_of(spark, {1: series(12), 2: series(11), 3: []}).orderBy("k_index").collect()
    assert [(r["app_id"], r["k_index"]) for r in rows] == [(1, 2), (1, 3), (1, 4), (1, 5)]
    first = rows[0]
    assert first["month_k_label"] == "March 2023" and first["age_since_release_months"] == 13
    assert first["y_avg"] == pytest.approx(10 * 1.1**8) and first["avg_km2"] == 10.0
    assert first["avg_growth_k"] == pytest.approx(0.1) and first["curv_log_avg"] == pytest.approx(0, abs=1e-12)
    assert first["shock_log_peak_avg"] == pytest.approx(math.log(2))


def test_zero_rows_are_skipped_and_missing_months_shift_positions(spark):
    zero = series(12)
    zero[3] = (zero[3][0], 0.0, 5.0)  # chronological position 8: the target of k = 2
    assert [r["k_index"] for r in panel_of(spark, {1: zero}).orderBy("k_index").collect()] == [3, 4, 5]
    gap = series(12)
    gap[3] = (gap[3][0], float("nan"), 5.0)
    assert panel_of(spark, {1: gap}).count() == 0
    assert [r["k_index"] for r in panel_of(spark, {1: gap}, min_months=11).orderBy("k_index").collect()] == [2, 3, 4]


def test_duplicate_metrics_use_the_latest(spark):
    old = wide_rows(spark, {1: series(12, start=99.0)}).withColumn("scraped_utc", F.lit("2020-01-01"))
    bad = wide_rows(spark, {1: series(12, start=55.0)}).withColumns({"scraped_utc": F.lit("2030-01-01"), "status": F.lit("error")})
    joined = panel.metrics_with_metadata(old.unionByName(bad).unionByName(wide_rows(spark, {1: series(12)})), meta_rows(spark, [1, 1, 2]))
    assert panel.build_panel(joined).agg(F.min("avg_km2")).first()[0] == 10.0
    assert "scraped_utc_meta" in joined.columns and joined.count() == 1


def test_unpivot_and_wide_round_trip(spark):
    wide = wide_rows(spark, {1: series(12), 2: series(5)})
    assert panel.unpivot_months(wide).groupBy("app_id").count().orderBy("app_id").collect() == [(1, 12), (2, 5)]
    positions = panel.chrono_series(wide).filter("app_id = 2").orderBy("k_index").collect()
    assert [r["month_label"] for r in positions][0] == "January 2023" and len(positions) == 5


def test_vocabulary_counts_occurrences_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(["b", "b", " a "], ["x"]), (["a", "c", ""], None)], "genres array<string>, categories array<string>")
    got = [(r["kind"], r["tag"], r["tag_count"], r["rank"]) for r in panel.tag_vocabulary(df, 2, 5).orderBy("kind", "rank").collect()]
    assert got == [("category", "x", 1, 1), ("genre", "a", 2, 1), ("genre", "b", 2, 2)]


def test_multihot_columns(spark):
    rows = panel_of(spark, {1: series(12)})
    hot = panel.multihot_columns(rows, {"genre": ["Action", "RPG"], "category": ["Single-player"]})
    assert tuple(hot.select("genre_Action", "genre_RPG", "`cat_Single-player`").first()) == (1, 0, 1)
    assert "genres" not in hot.columns


def test_features_of_scorer_equal_the_panel(spark):
    rows = panel_of(spark, {1: series(12, step=1.3), 2: series(12, start=500.0, step=0.8)})
    measures = [("avg_m1", "avg_km2"), ("avg_m2", "avg_km1"), ("avg_m3", "avg_k"), ("peak_m1", "peak_km2"), ("peak_m2", "peak_km1"), ("peak_m3", "peak_k")]
    given = rows.select("app_id", "k_index", *[F.col(b).alias(a) for a, b in measures], "is_free", "price_usd")
    scored = scoring.feature_rows(scoring.validate(given), {}).alias("s")
    pairs = rows.alias("p").join(scored, ["app_id", "k_index"])
    for name in SHAPE_FEATURES:
        assert pairs.filter(~F.col(f"p.{name}").eqNullSafe(F.col(f"f_{name}"))).count() == 0, name


def test_scoring_errors_keep_the_row(spark):
    columns = "avg_m1 string, avg_m2 string, avg_m3 string, peak_m1 string, peak_m2 string, peak_m3 string, is_free string, price_usd string"
    good = ["1", "2", "3", "4", "5", "6", "0", "1.5"]

    def row(**changes):
        names = [c.split()[0] for c in columns.split(", ")]
        return tuple(changes.get(n, v) for n, v in zip(names, good))

    given = [row(), row(avg_m2="0"), row(peak_m1="x"), row(avg_m1=None), row(is_free="maybe"), row(price_usd=""), row(price_usd="$3"), row(is_free="True")]
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "i int, " + columns)
    got = [r["row_error"] for r in scoring.validate(df).orderBy("i").collect()]
    assert got == ["", "All avg/peak values must be > 0.", "could not convert string to float: 'x'", "Missing value: avg_m1",
                   "invalid literal for int() with base 10: 'maybe'", "", "could not convert string to float: '$3'", ""]
    assert {r[0] for r in scoring.validate(df.drop("avg_m3")).select("row_error").collect()} == {"Missing column: avg_m3"}


def test_first_tag_of_a_key_wins(spark):
    words = ["Single-player", "single player", "RPG"]
    df = spark.createDataFrame([("SINGLE_PLAYER, rpg!, other",), (None,)], "t string")
    from ebbline.functions.text import comma_items

    got = [r[0] for r in df.select(scoring.match_tags(comma_items(F.col("t")), words)).collect()]
    assert got == [["Single-player", "RPG"], []]


def payload(app_id, **data):
    return json.dumps({str(app_id): {"success": True, "data": data}})


def test_documents(spark):
    given = [
        (1, payload(1, is_free=False, price_overview={"final": 999, "currency": "USD"}, release_date={"date": "Dec 2020"},
                    genres=[{"description": " Action "}, {"name": "Indie"}, {"description": ""}], categories=[])),
        (2, payload(2, price_overview={"final": 999, "currency": "EUR"}, release_date={"date": ""})),
        (3, json.dumps({"3": {"success": False}})),
        (4, json.dumps({"5": {"success": True, "data": {}}})),
        (6, '{"6": {"succ'),
        (7, payload(7, price_overview={"final": "999", "currency": "USD"})),
        (8, json.dumps({"8": {"success": True}})),
        (9, "null"), (10, None), (11, "[]"),
    ]
    df = spark.createDataFrame([(*g, "t") for g in given], "app_id long, payload string, scraped_utc string")
    got = {r["app_id"]: r for r in metadata.parse_documents(df).collect()}
    assert [got[i]["status"] for i in (9, 10, 11)] == ["no_data"] * 3
    assert [got[i]["status"] for i in (1, 2, 3, 4, 6, 7, 8)] == ["ok", "ok", "no_data", "no_data", "error", "ok", "ok"]
    assert (got[1]["price_usd"], got[1]["genres"], got[1]["release_date_str"]) == (9.99, ["Action", "Indie"], "Dec 2020")
    assert (got[2]["price_usd"], got[2]["is_free"], got[2]["release_date_str"], got[2]["genres"]) == (None, False, None, [])
    assert got[7]["price_usd"] is None and got[8]["is_free"] is False
    assert [r["app_id"] for r in pages.failure_log(metadata.parse_documents(df), "s").collect()] == [6]


def test_load_format_tolerates_absent_columns_and_text_lists(spark):
    df = spark.createDataFrame([(1, "['A' 'B']"), (2, None)], "app_id long, genres string")
    got = metadata.load_format(df).orderBy("app_id").collect()
    assert [(r["genres_csv"], r["categories_csv"], r["is_free"]) for r in got] == [("A|B", "", ""), ("", "", "")]
    with pytest.raises(ValueError):
        metadata.load_format(df.drop("app_id"))


def test_pages_outcomes_and_wide_record(spark):
    heads = "<tr><th>Month</th><th>Avg. Players</th><th>x</th><th>y</th><th>Peak Players</th></tr>"
    line = "<tr><td>{}</td><td>{}</td><td></td><td></td><td>{}</td></tr>"
    months = "".join(line.format(f"M{i}", i, 10 * i) for i in range(1, 15))
    good = f"<table>{heads}{line.format('LAST 30 days', '7', '8')}{months}</table>"
    given = [(1, "u", good, 200, None, "t"), (2, "u", None, 404, None, "t"), (3, "u", None, None, "boom", "t"), (4, "u", "<p/>", 200, None, "t")]
    df = spark.createDataFrame(given, "app_id long, url string, html string, status_code int, error string, scraped_utc string")
    parsed = pages.parse_pages(df)
    got = {r["app_id"]: r for r in pages.wide_metrics(parsed).collect()}
    assert [got[i]["status"] for i in (1, 2, 3, 4)] == ["ok", "not_found", "error", "no_table"]
    assert (got[1]["last30_avg_players"], got[1]["month1_label"], got[1]["month12_peak_players"]) == (7.0, "M1", 120.0)
    assert got[3]["error"] == "boom" and got[2]["month1_label"] is None
    assert tuple(pages.run_counters(parsed).first()) == (4, 1, 1, 1, 1)
    wanted = spark.createDataFrame([(1,), (3,), (3,), (7,), (None,)], "app_id long")
    assert tuple(pages.run_counters(parsed, wanted).first()) == (4, 1, 1, 1, 1, 2)  # the failed one, and one without a page
    assert sorted(r[0] for r in pages.pending_ids(wanted, parsed).collect()) == [3, 7]
    assert [r[0] for r in pages.ok_ids(parsed).collect()] == [1]


def test_sweep_skips_errors_and_stops_at_the_first_empty_page(spark):
    link = '<a href="/app/{}/">x</a>'
    given = [(1, link.format(1), None), (2, None, "503"), (3, link.format(3), None), (4, "nothing", None), (5, link.format(5), None)]
    df = spark.createDataFrame(given, "page_no int, html string, fetch_error string")
    assert sorted(r[0] for r in pages.sweep_ids(df).collect()) == [1, 3]
    assert sorted(r[0] for r in pages.sweep_ids(df.filter("page_no <> 4")).collect()) == [1, 3, 5]
    assert html.page_ids is not None


def landing(spark, rows):
    return spark.createDataFrame(rows, schemas.METADATA_LANDING)


def monthly(spark, rows):
    return spark.createDataFrame(rows, schemas.MONTHLY_LONG)


def star(spark, old=None, price="9.99", text="Feb 23, 2017"):
    typed = warehouse.typed_metadata(
        landing(spark, [("1", "TRUE", "20", "TBA", "Action|RPG", "a-b|a b", ""), ("2", "0", price, text, "action", "", ""), ("x", "1", "1", "", "", "", "")])
    )
    rows = [(1, 1, "February 2024", 5.0, 9.0, "t", "u"), (1, 7, "August 2023", 10.0, 9.0, "t", "u"), (2, 1, None, 1.0, 1.0, "t", "u"),
            (2, 2, "January 2024", 3.0, 4.0, "t", "u"), (9, 1, "February 2024", 1.0, 1.0, "t", "u")]
    return warehouse.build_star(typed, monthly(spark, rows), old)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_star_twice_is_once(spark):
    once = star(spark)
    twice = star(spark, {n: spark.createDataFrame(t.collect(), warehouse.STAR_SCHEMAS[n]) for n, t in once.items()})
    for name in once:
        assert rows_of(once[name]) == rows_of(twice[name]), name
    assert warehouse.check_keys(twice).count() == 0 and warehouse.check_references(twice).count() == 0
    assert once["fact_monthly"].count() == 3  # the NULL label and the unknown app drop
    assert {r["genre_norm"] for r in once["dim_genre"].collect()} == {"action", "rpg"}
    assert [(r["category_name"], r["category_norm"]) for r in once["dim_category"].collect()] == [("a b", "a b")]


def test_repeated_staging_rows_do_not_multiply(spark):
    rows = [("1", "TRUE", "20", "", "A", "", "2024"), ("1", "TRUE", "30", "", "A", "", "2023"), ("2", "0", "5", "", "", "", ""), ("2", "0", "5", "", "", "", "")]
    months = [(1, 1, "February 2024", 5.0, 9.0, "2024", "u"), (1, 1, "February 2024", 6.0, 9.0, "2023", "u"), (2, 1, "February 2024", 1.0, 1.0, "t", "u")] * 2
    built = warehouse.build_star(warehouse.typed_metadata(landing(spark, rows)), monthly(spark, months))
    assert {(r["app_id"], r["price_usd"]) for r in built["dim_app"].collect()} == {(1, 20.0), (2, 5.0)} and built["dim_app"].count() == 2
    assert sorted(r["avg_players"] for r in built["fact_monthly"].collect()) == [1.0, 5.0]
    assert warehouse.check_keys(built).count() == 0


def test_key_checks_name_every_kind_of_violation(spark):
    apps = spark.createDataFrame([(1, 7), (1, 8), (None, 8)], "app_sk long, app_id long")
    dates = spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "x", None)], "date_sk long, month_label string, month_index int")
    found = {tuple(r) for r in warehouse.check_keys({"dim_app": apps, "dim_date": dates}).collect()}
    assert found == {
        ("unique dim_app(app_sk)", "1", 2), ("unique dim_app(app_id)", "8", 2), ("not null dim_app(app_sk)", None, 1),
        ("unique dim_date(month_label,month_index)", "|1", 2),
    }


def test_persistence_after_two_loads_takes_the_newest_months(spark):
    rows = [(1, 1, "January 2024", 100.0, 1.0), (1, 7, "July 2023", 90.0, 1.0), (1, 1, "February 2024", 10.0, 1.0), (1, 7, "August 2023", 95.0, 1.0)]
    activity = spark.createDataFrame(rows, "app_id int, month_index int, month_label string, avg_players double, peak_players double")
    apps = spark.createDataFrame([(1, 1, "Free", True)], "app_id int, app_sk long, price_tier string, is_free boolean")
    assert marts.app_persistence(activity, apps).first()["persistence_6m_ratio"] == pytest.approx(10 / 95)


def test_persistence_by_the_calendar(spark):
    """App 1: the second load has its newest month only, and no load the month six before it. App 2: the first load has that month at
    index 6. App 3: both loads have it, and the second counts. App 4 has no readable label."""
    rows = [
        (1, 1, "January 2024", 200.0), (1, 7, "July 2023", 200.0), (1, 1, "February 2024", 50.0),
        (2, 1, "January 2024", 7.0), (2, 6, "August 2023", 20.0), (2, 7, "July 2023", 9.0), (2, 1, "February 2024", 5.0),
        (3, 6, "August 2023", 1.0), (3, 7, "August 2023", 4.0), (3, 1, "February 2024", 2.0),
        (4, 1, "Last 30 Days", 3.0), (4, 7, "?", 1.0),
    ]
    activity = spark.createDataFrame(rows, "app_id int, month_index int, month_label string, avg_players double")
    apps = spark.createDataFrame([(i, i, "Free", True) for i in (1, 2, 3, 4)], "app_id int, app_sk long, price_tier string, is_free boolean")
    got = {r["app_id"]: (r["avg_players_recent"], r["avg_players_6mo_ago"], r["persistence_6m_ratio"]) for r in marts.app_persistence(activity, apps).collect()}
    assert got[1] == (50.0, None, None) and got[2] == (5.0, 20.0, 0.25) and got[3] == (2.0, 4.0, 0.5) and got[4][1:] == (None, None)


def test_app_upsert_updates_and_keeps_keys(spark):
    first = spark.createDataFrame(star(spark)["dim_app"].collect(), schemas.DIM_APP)
    typed = warehouse.typed_metadata(
        landing(spark, [("2", "0", "70", "Mar 1, 2018", "", "", ""), ("3", "", "", "", "", "", "")])
    )
    got = {r["app_id"]: r for r in warehouse.upsert_apps(first, typed).collect()}
    before = {r["app_id"]: r["app_sk"] for r in first.collect()}
    assert {i: got[i]["app_sk"] for i in (1, 2)} == before and got[3]["app_sk"] == max(before.values()) + 1
    assert (got[2]["price_tier"], str(got[2]["release_date"])) == ("60_plus", "2018-03-01")
    assert (got[1]["price_usd"], got[1]["price_tier"], got[3]["price_tier"]) == (20.0, "Free", "Free")
    stale = {r["app_id"]: r for r in warehouse.upsert_apps(first, typed, keep_stale_release=True).collect()}
    assert str(stale[2]["release_date"]) == "2017-02-23"


def test_marts_and_charts(spark):
    built = star(spark)
    activity = warehouse.activity(built["fact_monthly"], built["dim_app"], built["dim_date"])
    ratios = marts.app_persistence(activity, built["dim_app"])
    got = {r["app_id"]: r for r in ratios.collect()}
    assert got[1]["persistence_6m_ratio"] == 0.5 and set(got) == {1}
    trend = marts.growth_decay(ratios)
    assert [(r["trend_bucket"], r["abs_log_change"]) for r in trend.collect()] == [("Decay", pytest.approx(math.log(2)))]
    genres = marts.tag_retention(ratios, built["bridge_app_genre"], built["dim_genre"], "genre")
    assert [r["game_count"] for r in charts.top_groups(genres, "genre_name", 1).collect()] == [1]
    assert marts.app_persistence(activity, built["dim_app"], min_months=3).count() == 0
    tiers = marts.price_tier_retention(ratios)
    assert [r["price_range"] for r in charts.price_range(tiers).collect()] == ["Free"]


def test_curve_keeps_the_unweighted_mean_and_orders_months(spark):
    rows = [(1, 1, "A", 1.0, 1.0), (2, 1, "A", 3.0, 1.0), (3, 1, "B", 10.0, 1.0), (1, 2, "A", 5.0, 1.0)]
    curve = marts.decay_curve(spark.createDataFrame(rows, "app_id int, month_index int, month_label string, avg_players double, peak_players double"))
    got = charts.life_cycle(curve).collect()
    assert [(r["month_index"], r["avg_avg_players"], r["row_count"]) for r in got] == [(2, 5.0, 1), (1, 6.0, 3)]


def test_evaluation_bounds_are_closed_for_coverage_and_open_for_calibration(spark):
    rows = [(0.0, 1.0, 1.0, 1.0, 1.0, 1.0), (0.0, 2.0, 2.0, 1.0, 1.5, 2.0), (0.0, -1.0, -1.0, 0.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "base_log double, delta double, y_log_avg double, delta_q10 double, delta_q50 double, delta_q90 double")
    got = evaluate.metrics(df).first()
    assert got["coverage_10_90"] == pytest.approx(2 / 3) and got["p_below_10"] == pytest.approx(1 / 3)
    assert got["directional_acc_q50_delta"] == pytest.approx(2 / 3) and got["n_test"] == 3
    assert got["rmse_persistence_log"] == pytest.approx(math.sqrt(2))


def test_all_missing_columns_are_dropped_and_medians_fill(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "price_usd double, age_months double")
    assert training.usable_features(df, ["price_usd", "age_months"]) == ["price_usd"]
    filled = training.impute(df, training.fit_medians(df, ["price_usd"]))
    assert sorted(r["price_usd"] for r in filled.collect()) == [1.0, 2.0, 3.0]
