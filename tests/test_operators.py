"""Operators against brute force on small data, including one key that holds most rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.operators import checks, dedup, keys, membership, quantile, split, upsert
from ebbline.session import new_path, scratch
from ebbline.sources import readers, tables


def skewed(spark, n=20_000):
    """A third of the rows in group 0, heavy-tailed values, some missing."""
    group = F.when(F.rand(1) < 0.34, 0).otherwise((F.rand(2) * 9 + 1).cast("int"))
    return spark.range(n, numPartitions=6).select(
        group.alias("g"), F.exp(F.randn(3) * 5).alias("v"), F.when(F.rand(4) < 0.9, F.floor(F.rand(5) * 7)).cast("double").alias("w")
    )


def test_exact_medians_equal_pandas(spark):
    rows = skewed(spark).toPandas()
    df = spark.createDataFrame(rows)
    got = {(r["g"], r["column_name"]): r["median"] for r in quantile.exact_medians(df, ["g"], ["v", "w"]).collect()}
    want = rows.groupby("g")[["v", "w"]].median()
    assert len(got) == want.size
    for (g, c), value in got.items():
        assert value == want.loc[g, c]


def test_exact_medians_small_and_missing(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None), (2.0, None), (10.0, None)], "a double, b double")
    assert [tuple(r) for r in quantile.exact_medians(df, [], ["a", "b"]).collect()] == [("a", 3.0)]


def plain_quantile(values, weights, q):
    order = np.argsort(values)
    upto = np.cumsum(np.asarray(weights)[order])
    return np.asarray(values)[order][np.searchsorted(upto, q * upto[-1] * (1 - 1e-12))]


def test_medians_of_a_missing_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 7.0), ("a", None)], "g string, v double")
    assert sorted(map(tuple, quantile.exact_medians(df, ["g"], ["v"]).collect()), key=str) == [("a", "v", 7.0), (None, "v", 2.0)]


def test_rows_of_medians_are_not_shuffled_for_each_pass(spark):
    """Kept cells are few and broadcast, whatever the planner guesses of them, and a code is worked out once for each pass."""
    df = spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quantile.exact_medians(df, ["g"], ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and plan.count("ArrowEvalPython") == 1


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, -1.0,
           np.nextafter(1, 2), np.nextafter(1, 0), np.nextafter(-1, 0), 1e-300, 1e-270, 3.0, 4.0, np.nextafter(4, 0), 8.5e-250, 0.1, 1e22, 2.0**-900, 2.0**-901]


def test_codes_are_the_bits_in_order(spark):
    rng = np.random.default_rng(8)
    with np.errstate(over="ignore"):
        some = rng.integers(-(2**63), 2**63 - 1, 3000).view(np.float64)
    values = np.concatenate([some[np.isfinite(some)], AWKWARD, 2.0 ** np.arange(-1074, 1024), -(2.0 ** np.arange(-1074, 1024, 7)), rng.normal(size=1000)])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", quantile.order_code(F.col("v")).alias("c")).collect()
    for r in rows:
        size = int(np.float64(abs(r["v"])).view(np.int64))
        assert r["c"] == (-size if r["v"] < 0 else size), r["v"]


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_weighted_quantiles_are_exact(spark, q):
    rng = np.random.default_rng(5)
    groups, values, weights = rng.choice([None, "a", "b"], 6000, p=[0.1, 0.6, 0.3]), np.round(rng.normal(size=6000), 3), rng.choice([1.0, 1.8], size=6000)
    df = spark.createDataFrame([(g, float(v), float(w)) for g, v, w in zip(groups, values, weights)], "g string, v double, w double")
    got = {r["g"]: r["quantile"] for r in quantile.weighted_quantiles(df, ["g"], F.col("v"), F.col("w"), q).collect()}
    assert got == {g: plain_quantile(values[groups == g], weights[groups == g], q) for g in (None, "a", "b")}
    assert quantile.weighted_quantiles(df, [], F.col("v"), F.col("w"), q).first()["quantile"] == plain_quantile(values, weights, q)


def test_weighted_quantiles_of_awkward_numbers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*AWKWARD, math.nan, math.inf]] + [(None,)], "v double")
    for i, v in list(enumerate(sorted(AWKWARD)))[::4]:
        assert quantile.weighted_quantiles(df, [], F.col("v"), F.lit(1.0), (i + 1) / len(AWKWARD)).first()["quantile"] == v
    assert quantile.weighted_quantiles(df, [], F.col("v"), F.lit(0.0), 0.5).count() == 0


@pytest.mark.parametrize("scale", [1e-9, 1e-4, 1.0, 1e6])
def test_weighted_quantiles_on_any_scale(spark, scale):
    values = [i * scale / 500 for i in range(-500, 501)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0.1, 0.5, 0.9):
        assert quantile.weighted_quantiles(df, [], F.col("v"), F.lit(1.0), q).first()["quantile"] == plain_quantile(values, np.ones(1001), q)


def test_latest_is_by_order_then_tie(spark):
    rows = [(1, "a", 1, "x"), (1, "b", 1, "y"), (1, "b", 2, "z"), (2, None, 1, "n"), (2, "a", 0, "m")]
    df = spark.createDataFrame(rows, "k int, t string, tie int, v string")
    got = dedup.latest(df, ["k"], ["t"], ["tie"]).orderBy("k").collect()
    assert [r["v"] for r in got] == ["z", "m"]


def test_latest_on_a_hot_key(spark):
    df = spark.range(50_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("t")
    )
    got = dedup.latest(df, ["k"], ["t"])
    assert got.count() == df.select("k").distinct().count()
    assert got.filter("k = -1").first()["t"] == 49_999


def test_positions_are_dense_and_repeatable(spark):
    ids = spark.range(5000).withColumnRenamed("id", "app_id")
    once = keys.hash_positions(ids, ["app_id"], 7).select("app_id", "_position")
    again = keys.hash_positions(ids.repartition(13), ["app_id"], 7).select("app_id", "_position")
    assert sorted(r["_position"] for r in once.collect()) == list(range(1, 5001))
    assert once.exceptAll(again).count() == 0


def test_new_keys_follow_the_old_ones(spark):
    old = spark.createDataFrame([(41, 1)], "sk long, app_id long")
    new = keys.assign_keys(spark.range(2, 5).withColumnRenamed("id", "app_id"), ["app_id"], "sk", old)
    assert sorted(r["sk"] for r in new.collect()) == [42, 43, 44]


@pytest.mark.parametrize("n", [1, 5, 35, 1309])
def test_split_size_and_disjointness(spark, n):
    rows = spark.range(n).select(F.col("id").alias("app_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))
    sides = split.apply_split(rows, split.group_split(rows))
    test = {r["app_id"] for r in sides.filter("is_test").collect()}
    train = {r["app_id"] for r in sides.filter("not is_test").collect()}
    assert len(test) == math.ceil(0.2 * n) and not test & train and len(test | train) == n


def test_unlisted_entities_train(spark):
    saved = spark.createDataFrame([(1, True)], "app_id long, is_test boolean")
    sides = split.apply_split(spark.range(3).withColumnRenamed("id", "app_id"), saved)
    assert {(r["app_id"], r["is_test"]) for r in sides.collect()} == {(0, False), (1, True), (2, False)}


def test_sample_ids_are_the_first_ones_shuffled(spark):
    ids = spark.range(100).select((F.col("id") * 3).alias("app_id"))
    got = [r["app_id"] for r in split.sample_ids(ids, 10).collect()]
    assert sorted(got) == list(range(0, 30, 3)) and got != sorted(got)
    assert split.sample_ids(ids, 0).count() == 100


def test_absent_matches_null_keys(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "label string, i int")
    source = spark.createDataFrame([(None, 1), ("a", 1), ("a", 2), (None, 2)], "label string, i int")
    assert {tuple(r) for r in upsert.absent(source, target, ["label", "i"]).collect()} == {("a", 2), (None, 2)}


def test_delete_insert_keeps_other_keys_and_repeats(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    new = spark.createDataFrame([(2, 9.0), (3, 3.0)], "k int, v double")
    once = upsert.delete_insert(old, new, ["k"])
    twice = upsert.delete_insert(once, new, ["k"])
    assert {tuple(r) for r in once.collect()} == {(1, 1.0), (2, 9.0), (3, 3.0)} == {tuple(r) for r in twice.collect()}


def test_touched_partitions_alone_are_rewritten(spark):
    import os

    root = new_path(spark, "partitions")

    def files():
        top = root.removeprefix("file:")
        return {d: {f for f in os.listdir(f"{top}/{d}") if f.endswith(".parquet")} for d in os.listdir(top) if d.startswith("part=")}

    rows = spark.createDataFrame([(1, "a"), (2, "b b/c"), (3, None)], "k int, part string")
    assert tables.read_table(spark, root, "k int, part string").count() == 0
    tables.overwrite_partitions(rows, root, "part")
    before = files()
    tables.overwrite_partitions(spark.createDataFrame([(7, "a"), (8, "new")], "k int, part string"), root, "part")
    after = files()
    assert {d for d in before if after[d] != before[d]} == {"part=a"} and len(after) == 4
    got = tables.read_table(spark, root, "k int, part string").collect()
    assert {tuple(r) for r in got} == {(7, "a"), (2, "b b/c"), (3, None), (8, "new")}


def test_a_bucketed_table_is_joined_without_an_exchange(spark):
    name = tables.bucketed_table(spark, new_path(spark, "bucketed"), "a long, b long", ["a", "b"])
    pairs = spark.range(500).selectExpr("id % 50 as a", "id as b")
    pairs.filter("b < 300").write.insertInto(name)
    new = pairs.join(spark.table(name).hint("merge"), ["a", "b"], "left_anti")
    assert new.count() == 200
    new.write.insertInto(name)  # files of both writes are in the same buckets
    plan = pairs.join(spark.table(name).hint("merge"), ["a", "b"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    # The only exchange is that of the other side, which comes first.
    assert plan.count("Exchange") == 1 and "Exchange" not in plan[plan.index(":- ") :].split("+- Sort")[-1] and "Bucketed: true" in plan
    assert spark.table(name).count() == 500 and pairs.join(spark.table(name).hint("merge"), ["a", "b"], "left_anti").count() == 0


def test_last_in_file_order(spark):
    root = new_path(spark, "file-order")
    for folder, rows in (("part_000000", [(1, "new", 9), (2, "x", 1), (2, "y", 0)]), ("part_000001", [(1, "late file", 2)])):
        spark.createDataFrame(rows, "k int, v string, t int").coalesce(1).write.parquet(f"{root}/{folder}")
    rows = readers.read_parts_in_order(spark, f"{root}/*", "k int, v string, t int")
    got = dedup.last_in_order(rows, ["k"], readers.FILE_ORDER)
    assert got.columns == ["k", "v", "t"] and {tuple(r) for r in got.collect()} == {(1, "late file", 2), (2, "y", 0)}


@pytest.mark.parametrize("small", [True, False])
def test_wanted_rows_are_parsed_without_shuffling_raw_text(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(membership, "is_small", lambda ids: False)
    raw = spark.range(10).select(F.col("id").alias("app_id"), F.lit("<p>").alias("html")).unionAll(spark.sql("select 4, '<br>'"))
    ids = spark.createDataFrame([(3,), (3,), (4,), (99,)], "app_id long")
    parsed = membership.parse_wanted(raw, ids, lambda df: df.select("app_id", F.length("html").alias("n")))
    assert sorted(tuple(r) for r in parsed.collect()) == [(3, 3), (4, 3), (4, 4)]


def test_checks_find_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, t string")
    assert [r["n_rows"] for r in checks.duplicate_keys(df, ["k", "t"], "c").collect()] == [2]
    assert [r["n_rows"] for r in checks.null_keys(df, ["k", "t"], "c").collect()] == [1]
    parents = spark.createDataFrame([(1,)], "k int")
    assert [(r["key_value"], r["n_rows"]) for r in checks.orphans(df, parents, "k", "c").collect()] == [("2", 1)]


def test_scratch_paths_are_removed(spark):
    import os

    with scratch(spark, keep=("result",)):
        gone, kept = new_path(spark, "step"), new_path(spark, "result")
        spark.range(3).write.parquet(gone)
        spark.read.parquet(gone).write.parquet(kept)
    assert not os.path.exists(gone.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


def test_required_columns_fail_before_any_action(spark):
    with pytest.raises(ValueError, match="app_id"):
        checks.require_columns(spark.range(1), ["app_id"], "Metrics")
