"""What a task holds or does again must not grow with the input."""

import datetime
import glob

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.serializers import CPickleSerializer

from ebbline import jobs, schemas
from ebbline.catalog import bind
from ebbline.operators import spread
from ebbline.plans import boosting, marts, pages, warehouse

PAGE = "<table><th>Month</th><th>Avg. Players</th><th>Peak Players</th><tr><td>May 2020</td><td>1</td><td></td><td></td><td>2</td></tr></table>"


def raw_pages(spark, n=1):
    rows = [(i, "u", PAGE, 200, None, "2024-01-01T00:00:00+00:00") for i in range(n)]
    return spark.createDataFrame(rows, schemas.RAW_PAGES)


def test_activity_is_dealt_out_by_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bind, "ROWS_PER_TASK", 10)
    rows = [(i % 40, datetime.datetime(2020, 1 + i % 3, 1), 0.1, 2.0, 0.1, 5.0) for i in range(400)]
    columns = "l_partkey long, l_shipdate timestamp_ntz, l_discount double, l_quantity double, l_tax double, l_extendedprice double"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    months = bind.numbered_months(spark, str(tmp_path))
    assert months.rdd.getNumPartitions() == 40
    assert months._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
    assert months.count() == 120


def test_a_filter_on_the_outcome_does_not_parse_pages_again(spark):
    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("<tr")

    wide = pages.wide_metrics(pages.parse_pages(raw_pages(spark)))
    usable = wide.filter("status = 'ok'").drop("status", "status_code", "error")
    assert parses(usable) == parses(wide) and usable.count() == 1


def test_a_batch_of_one_file_is_parsed_by_several_tasks(spark, tmp_path):
    raw_pages(spark, 100).coalesce(1).write.parquet(f"{tmp_path}/pages")
    found = jobs.stream_metrics(spark, f"{tmp_path}/pages", f"{tmp_path}/out", f"{tmp_path}/checkpoint", f"{tmp_path}/progress", 2)
    assert found.first()["ok"] == 100
    assert len(glob.glob(f"{tmp_path}/out/batch_id=0/part-*")) == spark.sparkContext.defaultParallelism


def test_an_export_works_out_the_app_mart_once(spark, tmp_path, monkeypatch):
    files = {}
    monkeypatch.setattr(jobs.writers, "write_csv", lambda mart, path: files.update({path.rpartition("/")[2]: mart.inputFiles()}))
    jobs.export_marts({name: spark.createDataFrame([], schema) for name, schema in warehouse.STAR_SCHEMAS.items()}, str(tmp_path))
    for name in ("app_persistence", "price_tier_retention", "growth_decay"):
        assert len(files[name]) == 1 and "/app-mart-" in files[name][0]


def test_the_sums_of_a_few_tasks_take_one_stage(spark):
    context = spark.sparkContext
    booster = boosting.Booster.__new__(boosting.Booster)
    booster.kept = context.parallelize(range(9), 9)
    context.setJobGroup("one-stage", "sums")
    try:
        assert booster._sum(lambda block: np.array([1.0, block])).tolist() == [9.0, 36.0]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("one-stage")] == [1]


def test_leaf_values_take_one_job_of_a_round_and_the_trees_stay_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(list(map(float, x)), float(d), float(1 + (x[0] > 4)), i) for i, (x, d) in enumerate(zip(
        np.c_[rng.integers(0, 9, (3000, 3)), rng.integers(0, 2, (3000, 2))], rng.normal(size=3000)))]
    rows = [(x, d + x[0] / 9 - x[3], w, i * 7_919) for x, d, w, i in rows]
    vectors = spark.createDataFrame(rows, "x array<double>, delta double, weight double, row_hash long").repartition(3)
    vectors = vectors.withColumn("features", array_to_vector("x")).drop("x").cache()
    cuts = [[i + 0.5 for i in range(8)]] * 3 + [[0.5]] * 2
    config = boosting.BoostingConfig(rounds=12, learning_rate=0.5, subsample=0.8)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 250)
    context, jobs_of, run, one_pass = spark.sparkContext, [], boosting.Booster.run, boosting.Booster._one_pass

    def counted(booster):
        name = f"rounds-{len(jobs_of)}"
        context.setJobGroup(name, "rounds")
        try:
            run(booster)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        jobs_of.append(len(context.statusTracker().getJobIdsForGroup(name)))

    monkeypatch.setattr(boosting.Booster, "run", counted)
    shared = boosting.boost(vectors, cuts, config)
    monkeypatch.setattr(boosting.Booster, "_one_pass", lambda *_: None)
    assert boosting.boost(vectors, cuts, config) == shared
    assert jobs_of[0] <= 4 * config.rounds + 6 and jobs_of[1] == jobs_of[0]
    monkeypatch.setattr(boosting, "_FETCHED", 8_000)  # too few for the rows of all quantiles, enough around them
    assert boosting.boost(vectors, cuts, config) == shared and jobs_of[2] >= 5 * config.rounds
    monkeypatch.setattr(boosting.Booster, "_one_pass", one_pass)
    assert boosting.boost(vectors, cuts, config) == shared and jobs_of[3] <= jobs_of[2] - config.rounds // 2
    assert all(len(t["feature"]) > 1 for trees in shared[1].values() for t in trees)


def test_the_pass_over_the_roots_takes_along_the_next_level(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(list(map(float, x)), float(d + x[0] / 3 + x[3]), float(1 + 0.8 * (x[0] > 4)), i * 104_729) for i, (x, d) in enumerate(zip(
        np.c_[rng.integers(0, 9, (2000, 3)), rng.integers(0, 2, (2000, 2))], rng.normal(size=2000)))]
    vectors = spark.createDataFrame(rows, "x array<double>, delta double, weight double, row_hash long").coalesce(1)
    vectors = vectors.withColumn("features", array_to_vector("x")).drop("x").cache()
    cuts = [[i + 0.5 for i in range(8)]] * 3 + [[0.5]] * 2
    config = boosting.BoostingConfig(rounds=10, learning_rate=0.5, subsample=0.8)
    passes, summed = [], boosting.Booster._sum
    monkeypatch.setattr(boosting.Booster, "_sum", lambda booster, work: (passes.append(1), summed(booster, work))[1])
    taken = boosting.boost(vectors, cuts, config)
    with_guesses = len(passes)
    assert with_guesses <= 3 * config.rounds - 5
    passes.clear()
    monkeypatch.setattr(boosting.Booster, "_likely", lambda *_: [])
    assert boosting.boost(vectors, cuts, config) == taken and len(passes) == 3 * config.rounds
    passes.clear()
    monkeypatch.setattr(boosting.Booster, "_likely", lambda *_: [(4, 0)])  # wrong guesses cost passes, never splits
    assert boosting.boost(vectors, cuts, config) == taken and len(passes) > with_guesses


def test_passes_do_not_carry_the_rounds_of_the_kept_blocks(spark):
    booster = boosting.Booster.__new__(boosting.Booster)
    booster.kernels, booster.kept, booster.past, booster.start = boosting._kernels(), None, None, [0.0]
    block = {"bins": np.zeros((1, 2), np.uint8), "delta": np.zeros(2)}
    booster.source = spark.sparkContext.parallelize([block], 1)
    booster.rounds = [[{"feature": np.full(15, -1), "cut": np.zeros(15, np.int64), "levels": 3, "value": np.full(15, i + 0.5)}] for i in range(200)]
    booster._keep()
    assert booster.kept.first()["fit"].tolist() == [[20_000.0, 20_000.0]]
    assert len(CPickleSerializer().dumps(booster.kept.func)) < 50_000
    booster.close()


def tagged_parts(spark, n=400):
    rows = [(i % 200, "category", f" Tag {i % 7}" if i % 2 else f"tag {i % 7}", f"tag {i % 7}") for i in range(n)]
    return spark.createDataFrame(rows, "app_id int, kind string, tag_name string, tag_norm string").coalesce(1)


def test_pairs_of_tags_are_dealt_out_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 10)
    items = tagged_parts(spark)
    apps = spark.createDataFrame([(i, i + 1000) for i in range(200)], "app_id int, app_sk long")
    tags = warehouse.new_tags(None, items, "category").localCheckpoint()
    pairs = warehouse.new_pairs(None, items, apps, tags, "category")
    wanted = {(r.app_id + 1000, r.tag_norm) for r in items.collect()}
    key = {r.category_sk: r.category_norm for r in tags.collect()}
    assert {(r.app_sk, key[r.category_sk]) for r in pairs.collect()} == wanted and pairs.count() == len(wanted)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(app_id" in plan and ", 40)" in plan
    bridge = pairs.localCheckpoint()
    persistence = spark.createDataFrame([(i + 1000, 1.0, 2.0, 2.0) for i in range(200)], "app_sk long, persistence_6m_ratio double, avg_players_recent double, avg_players_6mo_ago double")
    mart = marts.tag_retention(persistence, bridge, tags, "category")
    assert {r.category_name: r.game_count for r in mart.collect()} == {r.category_name: sum(n == r.category_norm for _, n in wanted) for r in tags.collect()}
    assert f", {-(-len(wanted) // 10)})" in mart._jdf.queryExecution().executedPlan().toString()


def test_only_different_spellings_of_tags_are_sorted(spark):
    tags = warehouse.new_tags(None, tagged_parts(spark), "category").select("category_name", "category_norm")
    assert {tuple(r) for r in tags.collect()} == {(f" Tag {i}", f"tag {i}") for i in range(7)}
    plan = tags._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [tag_norm" in plan and "count(1)" in plan
