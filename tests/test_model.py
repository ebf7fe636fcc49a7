"""Boosting, model tables, jobs end to end, and incremental runs."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ebbline import jobs, params, schemas
from ebbline.__main__ import main as command_line
from ebbline.catalog import bind, queries
from ebbline.plans import boosting, evaluate, panel, scoring
from ebbline.session import new_path
from ebbline.sources import readers, writers
from ebbline.streaming import incremental

CONFIG = boosting.BoostingConfig(rounds=6, learning_rate=0.3)


@pytest.fixture(scope="module")
def panel_path(spark, sf_dir):
    path = new_path(spark, "test-panel")
    queries._panel(spark, sf_dir).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def vocabulary(spark, sf_dir):
    return panel.collect_vocabulary(panel.tag_vocabulary(queries._joined(spark, sf_dir), 10, 20))


@pytest.fixture(scope="module")
def fitted(spark, panel_path, vocabulary):
    return boosting.fit(spark.read.parquet(panel_path), vocabulary, CONFIG)


def pinball(delta, predicted, weight, q):
    gap = delta - predicted
    return float(np.average(np.maximum(q * gap, (q - 1) * gap), weights=weight))


def test_weighted_pinball_loss_falls(fitted):
    model, train, _ = fitted
    weight = F.when(F.col("trend3_log_avg") < -0.05, 1.8).otherwise(1.0)
    losses = []
    for rounds in range(CONFIG.rounds + 1):
        cut = boosting.QuantileModel(model.features, model.medians, model.vocabulary, model.learning_rate, dict(model.start),
                                     {q: t[:rounds] for q, t in model.trees.items()})
        rows = boosting.predict(train, cut).select("delta", weight.alias("w"), "delta_q10", "delta_q50", "delta_q90").toPandas()
        losses.append([pinball(rows.delta, rows[boosting.column_name(q)], rows.w, q) for q in CONFIG.quantiles])
    losses = np.array(losses)
    assert (losses[-1] < losses[0]).all()
    assert (np.diff(losses, axis=0) < 1e-3).all()


def plain_trees(x, delta, weight, q, config, bags):
    """Start and trees by trying every split and sorting every leaf."""

    def quantile(values, weights):
        order = np.argsort(values, kind="stable")
        upto = np.cumsum(weights[order])
        return values[order][np.searchsorted(upto, upto[-1] * q * (1 - 1e-12))]

    def grow(rows, below, residual, depth):
        w, b = weight[rows], (weight * below)[rows]
        best, found = (q * w.sum() - b.sum()) ** 2 / w.sum(), None
        for f in range(x.shape[1]) if depth < config.max_depth else ():
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[rows, f] <= cut
                if min(left.sum(), (~left).sum()) >= config.min_leaf_rows:
                    gain = sum((q * w[s].sum() - b[s].sum()) ** 2 / w[s].sum() for s in (left, ~left))
                    if gain > best:
                        best, found = gain, (f, cut)
        if found is None:
            return quantile(residual[rows], w)
        left = x[rows, found[0]] <= found[1]
        return (*found, grow(rows[left], below, residual, depth + 1), grow(rows[~left], below, residual, depth + 1))

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    start = quantile(delta, weight)
    fit, trees = np.full(len(delta), start), []
    for bag in bags:
        trees.append(grow(np.flatnonzero(bag), delta <= fit, delta - fit, 0))
        fit = fit + np.array([config.learning_rate * value(trees[-1], row) for row in x])
    return start, trees


def nested(tree, at=0):
    if tree["left"][at] == at:
        return tree["value"][at]
    return tree["feature"][at], tree["threshold"][at], nested(tree, tree["left"][at]), nested(tree, tree["right"][at])


@pytest.mark.parametrize("fetched", [200_000, 40, 0])
@pytest.mark.parametrize("subsample", [1.0, 0.7])
def test_trees_are_those_of_all_splits(spark, monkeypatch, fetched, subsample):
    """Over several blocks, with leaf values fetched at once, after some counting passes, or read off the last code."""
    from pyspark.ml.functions import array_to_vector

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "_FETCHED", fetched)
    rng = np.random.default_rng(6)
    n = 400
    x = np.stack([rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(0, 2, n), rng.integers(0, 2, n)], axis=1).astype(float)
    delta = np.round(np.sin(x[:, 0]) + x[:, 2] * rng.normal(size=n) - 0.3 * x[:, 1], 2)
    weight = rng.choice([1.0, 2.0], n)
    hashes = rng.integers(-(2**63), 2**63 - 1, n)
    config = boosting.BoostingConfig(rounds=12 if subsample < 1 else 3, learning_rate=0.4, max_depth=3, min_leaf_rows=15, subsample=subsample, seed=4)
    rows = [(x[i].tolist(), float(delta[i]), float(weight[i]), int(hashes[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "features array<double>, delta double, weight double, row_hash long").withColumn("features", array_to_vector("features"))
    cuts = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in (np.unique(x[:, f]).tolist() for f in range(4))]
    starts, trees = boosting.boost(df, cuts, config)
    bags = [boosting._kernels().bagged({"row_hash": hashes, "delta": delta}, i, config.seed, subsample) for i in range(config.rounds)]
    assert subsample == 1 or all(0.6 < b.mean() < 0.8 for b in bags) and (bags[0] != bags[1]).any()
    for q in config.quantiles:
        start, want = plain_trees(x, delta, weight, q, config, bags)
        assert starts[q] == start
        for tree, plain in zip(trees[q], want, strict=True):
            assert nested(tree) == plain


def test_a_round_takes_two_passes_and_seldom_a_third(spark, monkeypatch):
    """Blocks in several tasks: the pass for the leaf values also has the exact root sums of the next round."""
    from pyspark.ml.functions import array_to_vector

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 500)
    rng = np.random.default_rng(8)
    n, rounds = 2000, 12
    x = np.stack([rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(0, 2, n)], axis=1).astype(float)
    delta = x[:, 0] + 0.2 * x[:, 1] + 0.1 * x[:, 2] + rng.normal(size=n)
    rows = [(x[i].tolist(), float(delta[i]), 1.8 if delta[i] < 3 else 1.0, int(h)) for i, h in enumerate(rng.integers(-(2**63), 2**63 - 1, n))]
    df = spark.createDataFrame(rows, "features array<double>, delta double, weight double, row_hash long").withColumn("features", array_to_vector("features"))
    cuts = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in (np.unique(x[:, f]).tolist() for f in range(3))]
    passes, exact = [0], []
    grow, plain_sum, one_pass = boosting.Booster._grow, boosting.Booster._sum, boosting.Booster._one_pass

    def checked(self, number):
        if number:
            plain = self._sum(lambda b, k=self.kernels, f=self._with_fit(number), r=self._next_levels()[0], w=self.wide, m=self.n_bins: k.histograms(b, *f(b), r, w, m))
            passes[0] -= 1
            exact.append(np.allclose(self.ahead[0].ravel(), plain, rtol=1e-12, atol=1e-9))
        return grow(self, number)

    monkeypatch.setattr(boosting.Booster, "_grow", checked)
    monkeypatch.setattr(boosting.Booster, "_sum", lambda self, work: (passes.__setitem__(0, passes[0] + 1), plain_sum(self, work))[1])
    monkeypatch.setattr(boosting.Booster, "_one_pass", lambda self, *a: (passes.__setitem__(0, passes[0] + 1), one_pass(self, *a))[1])
    boosting.boost(df, cuts, boosting.BoostingConfig(rounds=rounds, learning_rate=0.1, max_depth=3, min_leaf_rows=15, seed=4))
    assert len(exact) == rounds - 1 and all(exact)
    assert passes[0] < 3 * rounds


def test_sums_are_the_same_for_few_and_for_many_weights():
    rng = np.random.default_rng(9)
    n, wide, n_bins = 300, 2, 5
    bins = np.concatenate([rng.integers(0, n_bins, (wide, n)), rng.integers(0, 2, (3, n))]).astype(np.uint8)
    tree = {"feature": np.array([0, 3, 1] + [-1] * 4), "cut": np.array([2, 0, 1] + [0] * 4), "levels": 2}
    fit, bag, k = rng.normal(size=(1, n)), rng.random(n) < 0.8, boosting._kernels()
    for weight in (rng.choice([1.0, 1.8], n), rng.random(n)):
        block = k.prepared({"bins": bins, "delta": rng.normal(size=n), "weight": weight}, wide)
        assert ("kinds" in block) == (len(np.unique(weight)) <= 4)
        got, at, want = k.histograms(block, fit, bag, [tree], wide, n_bins), k.grow(bins, tree), []
        stats = np.stack([np.ones(n), weight, weight * (block["delta"] <= fit[0])])
        for f in range(5):
            for node in (3, 5):
                for value in range(n_bins if f < wide else 2):
                    want.append(stats[:, bag & (at == node) & (bins[f] == value)].sum(axis=1))
        want += [stats[:, bag & (at == node)].sum(axis=1) for node in (3, 5)]
        assert np.allclose(got, np.concatenate(want))


def test_thresholds_stand_between_values_or_at_quantiles(spark):
    rows = spark.createDataFrame([(float(i % 3), float(i), 7.0, None if i % 2 else 1.0) for i in range(1000)], "few double, many double, one double, some double")
    cuts = boosting.learned_thresholds(rows, ["few", "many", "one", "some"], 16)
    assert cuts["few"] == [0.5, 1.5] and cuts["one"] == [] and cuts["some"] == []
    assert len(cuts["many"]) == 15 and cuts["many"] == pytest.approx([i * 1000 / 16 for i in range(1, 16)], abs=2)


def test_a_fit_without_rows_says_so(spark, panel_path, vocabulary):
    with pytest.raises(ValueError, match="no training rows"):
        boosting.fit(spark.read.parquet(panel_path).limit(0), vocabulary, CONFIG)


def test_most_rows_do_not_cross_and_metrics_are_complete(fitted):
    model, train, test = fitted
    got = evaluate.metrics(boosting.predict(test, model)).first()
    assert got["crossing_rate"] < 0.5 and 0 <= got["coverage_10_90"] <= 1
    assert got["rmse_q50_log"] <= got["rmse_persistence_log"]
    assert not {r[0] for r in train.select("app_id").collect()} & {r[0] for r in test.select("app_id").collect()}


def test_model_tables_round_trip(spark, fitted):
    model, _, test = fitted
    path = new_path(spark, "test-model")
    boosting.save_model(spark, model, path)
    again = boosting.load_model(spark, path)
    assert again.feature_names == model.feature_names
    a = boosting.predict(test, model).select("app_id", "k_index", "delta_q10", "delta_q90")
    assert a.exceptAll(boosting.predict(test, again).select(*a.columns)).count() == 0


def test_evaluator_loads_where_the_package_is_absent(fitted, tmp_path):
    """Workers of a cluster unpickle it without this repository on their path."""
    path = tmp_path / "evaluator"
    path.write_bytes(cloudpickle.dumps(boosting.tree_evaluator(fitted[0])))
    code = f"import pickle; f = pickle.load(open({str(path)!r}, 'rb')); print(callable(f))"
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "True", done.stderr


def test_scoring_keeps_all_rows_and_inputs(spark, sf_dir, fitted):
    model, _, _ = fitted
    given = bind.score_input(spark, sf_dir)
    got = scoring.score(given, model)
    assert got.columns == [*given.columns, "pred_p10_players", "pred_p50_players", "pred_p90_players", "row_error"]
    assert got.count() == given.count()
    assert got.filter("(row_error = '') <> (pred_p50_players is not null)").count() == 0
    assert got.select(*given.columns).exceptAll(given).count() == 0


def test_steps_from_pages_to_forecast(spark, sf_dir):
    """The whole chain over stored tables, with a resumed second run."""
    root = new_path(spark, "chain")
    raw = bind.activity_pages(spark, sf_dir)
    writers.write_ids(raw.select("app_id"), f"{root}/ids")
    half = raw.filter("status_code = 200")
    jobs.pull_metrics(spark, half, f"{root}/ids", f"{root}/metrics", max_ids=0)
    counters = jobs.pull_metrics(spark, raw, f"{root}/ids", f"{root}/metrics", max_ids=0).first()
    n = raw.count()
    assert counters["processed"] == n and counters["ok"] + counters["not_found"] + counters["no_table"] + counters["error"] == n
    documents = bind.documents(spark, sf_dir)
    jobs.pull_metadata(spark, documents, f"{root}/metrics", f"{root}/parts", f"{root}/meta", f"{root}/failures")
    jobs.pull_metadata(spark, documents, f"{root}/metrics", f"{root}/parts", f"{root}/meta", f"{root}/failures")
    # The second run asks again for failed documents only, which fail again.
    merged = spark.read.parquet(f"{root}/meta")
    assert merged.select("app_id").distinct().count() == counters["ok"]
    assert merged.groupBy("app_id").agg(F.count("*").alias("n"), F.max("status").alias("s")).filter("n > 1 and s <> 'error'").count() == 0
    jobs.make_panel(spark, f"{root}/metrics", f"{root}/meta", f"{root}/vocab", f"{root}/panel")
    config = boosting.BoostingConfig(rounds=2)
    summary = jobs.train(spark, f"{root}/panel", f"{root}/vocab", f"{root}/split", f"{root}/out", config).first()
    assert summary["n_train"] + summary["n_test"] == spark.read.parquet(f"{root}/panel").count()
    writers.write_csv(bind.score_input(spark, sf_dir), f"{root}/input")
    command_line(["predict", "--input", f"{root}/input", "--model", f"{root}/out/model", "--out", f"{root}/forecast"])
    assert spark.read.options(**readers.CSV_OPTIONS).csv(f"{root}/forecast").count() == n


def test_a_load_changes_what_it_touches_and_a_refused_one_nothing(spark, sf_dir):
    root = new_path(spark, "touched")
    writers.write_csv(bind.monthly_long(spark, sf_dir), f"{root}/monthly")
    writers.write_csv(bind.landing(spark, sf_dir), f"{root}/meta")
    star = jobs.load_warehouse(spark, f"{root}/monthly", f"{root}/meta", f"{root}/star")
    top = f"{root}/star".removeprefix("file:")

    def files(name):
        return {os.path.join(d, f) for d, _, names in os.walk(f"{top}/{name}") for f in names if f.endswith(".parquet")}

    before = {name: files(name) for name in star}
    counts = {name: table.count() for name, table in star.items()}
    keys = {r["app_id"]: r["app_sk"] for r in star["dim_app"].collect()}
    some = sorted(keys)[:2]
    months = bind.monthly_long(spark, sf_dir).filter(F.col("app_id").isin(*some)).filter("month_index = 1").withColumn("avg_players", F.lit(7.5))
    writers.write_csv(months, f"{root}/monthly-2")
    writers.write_csv(bind.landing(spark, sf_dir).filter(F.col("app_id").isin(*map(str, some))).withColumn("price_usd", F.lit("1.25")), f"{root}/meta-2")
    star = jobs.load_warehouse(spark, f"{root}/monthly-2", f"{root}/meta-2", f"{root}/star")
    after = {name: files(name) for name in star}
    folders = {os.path.dirname(f) for f in before["dim_app"] ^ after["dim_app"]}
    assert 1 <= len(folders) <= 2 < len({os.path.dirname(f) for f in before["dim_app"]})
    assert {os.path.dirname(f) for f in before["fact_monthly"] ^ after["fact_monthly"]} < {os.path.dirname(f) for f in before["fact_monthly"]}
    assert counts == {name: table.count() for name, table in star.items()}
    assert keys == {r["app_id"]: r["app_sk"] for r in star["dim_app"].collect()}
    assert {r["price_usd"] for r in star["dim_app"].filter(F.col("app_id").isin(*some)).collect()} == {1.25}
    assert star["fact_monthly"].filter("avg_players = 7.5").count() >= months.count()
    # Every row a new app without a price; a broken key is planted in the stored star, so the load is refused.
    spark.createDataFrame([(1, None, None, None, "twice", 99)], star["dim_date"].schema).write.mode("append").parquet(f"{root}/star/dim_date")
    spark.catalog.refreshByPath(f"{root}/star")
    before = {name: files(name) for name in star}
    writers.write_csv(bind.landing(spark, sf_dir).withColumn("price_usd", F.lit("9.75")), f"{root}/meta-3")
    with pytest.raises(ValueError, match="violates"):
        jobs.load_warehouse(spark, f"{root}/monthly", f"{root}/meta-3", f"{root}/star")
    assert before == {name: files(name) for name in star}


def stored(star):
    """A copy that a later load does not change."""
    out = {}
    for name, table in star.items():
        path = new_path(table.sparkSession, f"copy-{name}")
        table.write.parquet(path)
        out[name] = table.sparkSession.read.parquet(path)
    return out


def test_warehouse_job_twice_and_mart_export(spark, sf_dir):
    root = new_path(spark, "warehouse")
    writers.write_csv(bind.monthly_long(spark, sf_dir), f"{root}/monthly")
    writers.write_csv(bind.landing(spark, sf_dir), f"{root}/meta")
    first = stored(jobs.load_warehouse(spark, f"{root}/monthly", f"{root}/meta", f"{root}/star"))
    second = jobs.load_warehouse(spark, f"{root}/monthly", f"{root}/meta", f"{root}/star")
    for name, table in first.items():
        assert table.count() == second[name].count() and table.exceptAll(second[name]).count() == 0, name
    jobs.export_marts(second, f"{root}/marts")
    built = jobs.build_marts(second)
    for name in jobs.MART_VIEWS:
        assert spark.read.options(**readers.CSV_OPTIONS).csv(f"{root}/marts/{name}").count() == built[name].count() > 0
    jobs.register_views(second)
    assert spark.sql("select count(*) from v_price_tier_retention where game_count > 0").first()[0] == built["price_tier_retention"].count()
    shown = jobs.build_charts(built)
    assert shown["life_cycle"].count() == 12 and shown["trend_lines"].count() == 2


def test_readers_fail_on_missing_input(spark):
    with pytest.raises(FileNotFoundError):
        readers.read_parts(spark, new_path(spark, "nothing"), schemas.METADATA)
    path = new_path(spark, "bad-ids")
    writers.write_csv(spark.range(1), path)
    with pytest.raises(ValueError, match="app_id"):
        readers.read_ids(spark, path)


def test_ids_accept_the_other_column_name(spark):
    path = new_path(spark, "appid")
    writers.write_csv(spark.createDataFrame([("3",), ("1",), ("",), ("3",), ("x",), ("99999999999",), ("7.0",)], "appid string"), path)
    assert sorted(r[0] for r in readers.read_ids(spark, path).collect()) == [1, 3, 7, 99999999999]


def test_csv_fields_with_quotes_commas_and_blanks_survive(spark):
    rows = [(1, 1, 'a "b", c', 1.0, None, "", "x|y"), (2, 2, None, None, 2.5, "t", "é")]
    df = spark.createDataFrame(rows, schemas.MONTHLY_LONG)
    path = new_path(spark, "quotes")
    writers.write_csv(df, path)
    back = readers.read_monthly_long(spark, path).orderBy("app_id").collect()
    assert back[0]["month_label"] == 'a "b", c' and back[1]["month_label"] is None and back[1]["url"] == "é"


STREAM = "k long, part string, t long, v double"


def add_file(spark, path, rows):
    spark.createDataFrame(rows, STREAM).coalesce(1).write.mode("append").parquet(path)


def test_upserts_resume_and_late_rows_lose(spark):
    source, target, progress = (new_path(spark, n) for n in ("up-in", "up-out", "up-progress"))

    def run():
        stream = incremental.stream_files(spark, source, STREAM, 1)
        incremental.upsert_batches(stream, target, progress, ["k", "part"], ["t"], ["v"])
        rows = incremental.read_upserted(spark, target, stream.schema, ["k", "part"]).collect()
        return sorted((r["k"], r["part"], r["t"], r["v"]) for r in rows)

    add_file(spark, source, [(1, "a", 5, 1.0), (1, "a", 6, 2.0), (2, "b", 5, 3.0)])
    assert run() == [(1, "a", 6, 2.0), (2, "b", 5, 3.0)]
    add_file(spark, source, [(1, "a", 4, 9.0), (3, "a", 1, 4.0)])
    add_file(spark, source, [(2, "b", 7, 8.0)])
    want = [(1, "a", 6, 2.0), (2, "b", 7, 8.0), (3, "a", 1, 4.0)]
    assert run() == want
    assert run() == want
    assert incremental.read_upserted(spark, f"{target}-none", spark.read.parquet(source).schema, ["k"]).count() == 0


def test_ingest_repeats_nothing_and_latest_wins(spark):
    source, target, progress = (new_path(spark, n) for n in ("in", "out", "progress"))

    def run():
        incremental.ingest(incremental.stream_files(spark, source, STREAM, 1), target, progress)
        raw = spark.read.parquet(target).count()
        rows = incremental.read_ingested(spark, target, ["k"], ["t"], ["v"]).collect()
        return raw, sorted((r["k"], r["v"]) for r in rows)

    add_file(spark, source, [(1, "a", 5, 1.0), (2, "b", 5, 3.0)])
    assert run() == (2, [(1, 1.0), (2, 3.0)])
    add_file(spark, source, [(1, "a", 5, 0.5)])
    assert run() == (3, [(1, 0.5), (2, 3.0)])
    assert run() == (3, [(1, 0.5), (2, 3.0)])


def test_page_stream_resumes_and_feeds_the_panel_input(spark, sf_dir):
    root = new_path(spark, "page-stream")
    raw = bind.activity_pages(spark, sf_dir).select("app_id", "url", "html", "status_code", "error", "scraped_utc")
    paths = [f"{root}/{n}" for n in ("pages", "metrics", "checkpoint", "progress")]
    raw.filter("status_code = 200").coalesce(2).write.parquet(paths[0])
    first = jobs.stream_metrics(spark, *paths, 1).first()
    assert first == jobs.stream_metrics(spark, *paths, 1).first()
    raw.filter("status_code is null or status_code <> 200").coalesce(1).write.mode("append").parquet(paths[0])
    last = jobs.stream_metrics(spark, *paths, 1).first()
    assert last["processed"] == raw.count() and last["ok"] == first["ok"] and first["error"] == 0 < last["error"]
    metrics = readers.read_parts(spark, paths[1], schemas.METRICS_WIDE)
    assert panel.with_history(metrics.filter("status = 'ok'")).count() > 0


def test_back_transform(spark):
    got = spark.range(1).select(scoring.back_transform(F.lit(100.0), F.lit(0.5)), scoring.back_transform(F.lit(0.0), F.lit(0.0))).first()
    assert got[0] == pytest.approx(100 * math.exp(0.5)) and got[1] == pytest.approx(1e-9)


@pytest.mark.parametrize("name", ["quantile_forecast", "score_forecast", "boost_invariants"])
def test_registered_queries_fit_all_rounds(spark, sf_dir, monkeypatch, name):
    class Asked(Exception):
        pass

    def asked(train, vocabulary, config=boosting.BoostingConfig()):
        raise Asked(config.rounds)

    monkeypatch.setattr(boosting, "learn", asked)
    monkeypatch.setattr(queries, "_MODELS", {})
    with pytest.raises(Asked) as found:
        queries.QUERIES[name](spark, sf_dir)
    assert found.value.args == (params.N_TREES,) == (300,)
