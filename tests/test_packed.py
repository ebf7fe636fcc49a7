"""Passes over packed rows give what passes over blocks give, and rows don't go through them again."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.serializers import CPickleSerializer

from ebbline.catalog import queries
from ebbline.operators import quantile
from ebbline.plans import boosting, packed

CUTS = [[i + 0.5 for i in range(8)]] * 3 + [[0.5]] * 3


def vectors_of(spark, n=3000, seed=5):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 9, (n, 3)), rng.integers(0, 2, (n, 3))]
    # Some targets come often, so that quantiles fall on equal residuals.
    delta = np.where(rng.random(n) < 0.4, rng.integers(0, 3, n), rng.normal(size=n)) + x[:, 0] / 9 - x[:, 3]
    rows = [(list(map(float, x[i])), float(delta[i]), float(1 + (x[i, 0] > 4)), i * 7_919) for i in range(n)]
    df = spark.createDataFrame(rows, "x array<double>, delta double, weight double, row_hash long").repartition(3)
    return df.withColumn("features", array_to_vector("x")).drop("x").cache()


CONFIG = boosting.BoostingConfig(rounds=12, learning_rate=0.5, subsample=0.8)


@pytest.fixture
def plain(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 250)
    vectors = vectors_of(spark)
    return vectors, boosting.boost(vectors, CUTS, CONFIG)


def test_packed_rows_give_the_trees_of_blocks_in_three_jobs_a_round(spark, monkeypatch, plain):
    vectors, want = plain
    monkeypatch.setattr(packed, "CHUNK_ROWS", 400)
    jobs, handles, run = [], [], boosting.Booster.run

    def counted(booster):
        spark.sparkContext.setJobGroup("packed", "rounds")
        try:
            run(booster)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("packed")))
        handles.extend(booster.kept.collect())
        assert all(os.path.exists(path) for _, path, _ in handles)
        assert len(CPickleSerializer().dumps(handles)) < 200 * len(handles)  # all that is kept and read through a socket

    monkeypatch.setattr(boosting.Booster, "run", counted)
    assert boosting.boost(vectors, CUTS, CONFIG) == want
    assert jobs[0] <= 3 * CONFIG.rounds + 8, jobs
    assert sum(sum(sizes) for _, _, sizes in handles) == 3000 and len(handles) == 8
    assert not any(os.path.exists(path) for _, path, _ in handles)


def test_parts_whose_files_are_lost_are_worked_on_from_the_stored_rows(spark, monkeypatch, plain):
    vectors, want = plain
    monkeypatch.setattr(packed, "CHUNK_ROWS", 400)
    grow, lost = boosting.Booster._grow, []

    def losing(booster, number):
        if number in (3, 11):
            for i, path, _ in booster.kept.collect():
                for f in os.listdir(os.path.dirname(path)):
                    if f.startswith(os.path.basename(path)) and (i < 2 and number == 3 or ".fit" in f):
                        os.remove(os.path.join(os.path.dirname(path), f))
                        lost.append(f)
        return grow(booster, number)

    monkeypatch.setattr(boosting.Booster, "_grow", losing)
    assert boosting.boost(vectors, CUTS, CONFIG) == want and len(lost) > 8


def test_many_weights_are_not_packed(spark):
    weights = spark.createDataFrame([(float(i % 5),) for i in range(20)], "weight double")
    assert boosting._kinds(weights) is None and boosting._kinds(weights.filter("weight < 4")) == [0.0, 1.0, 2.0, 3.0]
    assert boosting._kinds(weights.selectExpr("if(weight = 1, null, 1D) weight")) is None


def test_windows_tell_the_exact_quantile_of_residuals_that_come_often():
    rng = np.random.default_rng(3)
    base, kinds = boosting._kernels(), np.array([1.0, 1.8])
    own = packed.kernels(base, 1, 4, 1, kinds.tolist(), 2)
    blocks = [
        {"bins": np.stack([rng.integers(0, 4, n), rng.integers(0, 2, n)]).astype(np.uint8), "row_hash": rng.integers(0, 99, n),
         "delta": np.where(rng.random(n) < 0.5, rng.integers(-2, 3, n), rng.normal(size=n)), "weight": kinds[rng.integers(0, 2, n)]}
        for n in (700, 65, 1)
    ]
    tree = {"feature": np.array([0, 1] + [-1] * 5), "cut": np.array([1, 0] + [0] * 5), "levels": 2}
    seat, shares = np.cumsum(tree["feature"] < 0) - 1, [0.1, 0.5]
    chunks = [(own.chunk(n, arrays), np.zeros((2, n))) for b in blocks for n, arrays in own.arrays_of(iter([b]))]
    got = own.windows(iter(chunks), lambda b: np.ones(len(b["delta"]), bool), [tree] * 2, [seat] * 2, shares, 1.0, 1.0)
    at = np.concatenate([seat[base.grow(b["bins"], tree)] for b in blocks])
    delta, weight = (np.concatenate([b[k] for b in blocks]) for k in ("delta", "weight"))
    sent = 0
    for q, (under, whole, edges, of, value, alike) in enumerate(got):
        for leaf in np.unique(at):
            rows = at == leaf
            order = np.argsort(delta[rows])
            exact = delta[rows][order][np.searchsorted(np.cumsum(weight[rows][order]), weight[rows].sum() * shares[q])]
            assert np.isclose(whole[leaf] @ kinds, weight[rows].sum())
            assert np.isclose(under[leaf] @ kinds, weight[rows & (delta < edges[leaf, 0])].sum())
            upto = (under[leaf] + np.cumsum(alike[of == leaf], axis=0)) @ kinds
            assert value[of == leaf][np.searchsorted(upto, whole[leaf] @ kinds * shares[q])] == exact
            assert edges[leaf, 0] <= exact <= edges[leaf, 1]
        sent += len(value)
    assert sent < len(delta) / 4


def test_medians_of_whole_columns_are_counted_without_unpivoting(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), b) for a, b in zip(rng.normal(size=501), np.where(rng.random(501) < 0.5, rng.integers(-2, 2, 501), rng.normal(size=501)).tolist())]
    rows += [(None, -0.0), (float("nan"), float("inf")), (float("-inf"), None)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    found = quantile.exact_medians(df, [], ["a", "b"])
    got = {r["column_name"]: r["median"] for r in found.collect()}
    for k, name in enumerate("ab"):
        assert got[name] == np.median([r[k] for r in rows if r[k] is not None and np.isfinite(r[k])])
    cells = quantile._summed_columns(df, ["a", "b"])(48, None, None)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in cells and "Expand" not in cells


def test_rows_are_forecast_once_for_all_checks_of_a_fit(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "_fitted", lambda spark, sf: (queries.literal_model(), queries._rows(spark, sf), None))
    found = queries.boost_invariants(spark, sf_dir)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["quantile"] for r in found.collect()] == [0.1, 0.5, 0.9]


def test_a_release_text_is_parsed_once_for_all_rows_of_an_entity(spark, sf_dir):
    plan = queries._panel(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("MMM d, yyyy")


def test_trees_give_the_value_of_the_leaf_a_row_falls_in():
    model = boosting.QuantileModel([], {}, {}, 0.5)
    tree = {"feature": [1, 0, -1, -1, -1], "threshold": [0.0, 1.0, 0.0, 0.0, 0.0], "left": [1, 2, 2, 3, 4], "right": [4, 3, 2, 3, 4], "value": [0.0, 0.0, 1.0, 2.0, 4.0]}
    model.start, model.trees = {0.5: 10.0}, {0.5: [tree, tree]}
    rows = pd.Series([[1.0, 0.0], [1.5, -1.0], [0.0, 0.5], [float("nan"), 0.0], [0.0, float("nan")]])
    got = list(boosting.tree_evaluator(model)(iter([rows, rows[:0]])))
    assert got[0]["delta_q50"].tolist() == [11.0, 12.0, 14.0, 12.0, 14.0] and len(got[1]) == 0
