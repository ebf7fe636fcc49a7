"""Language identification and the quality classifier: held-out accuracy, parts, and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import langid, pu_quality
from ebbline.llm.queries import QUERIES
from tests.llm import edge


def test_languages_of_held_out_rows(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_bundle_is_the_sum_of_bound_vectors():
    texts = ["Ab  cd!", "é", None, "12 34", "x" * 40]
    found = langid.bundles(texts, 64)
    for text, row in zip(texts, found):
        codes = langid.letters(text)
        want = np.zeros(64)
        for i in range(len(codes) - 2):
            v = [langid.letter_vector(int(c), 64) for c in codes[i : i + 3]]
            want += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
        assert np.array_equal(row, want)
    assert "".join(map(chr, langid.letters("!Ab  cd!"))) == " ab cd "


def test_bundles_are_the_same_in_blocks(monkeypatch):
    texts = ["".join(chr(0x4E00 + (i * 7 + k) % 900) for k in range(200)) for i in range(20)] + ["plain text"]
    whole = langid.bundles(texts, 32)
    monkeypatch.setattr(langid, "_GRAMS", 100)
    monkeypatch.setattr(langid, "_CELLS", 350)
    assert np.array_equal(whole, langid.bundles(texts, 32))
    monkeypatch.setattr(langid, "_STRETCH", 37)
    assert np.array_equal(whole, langid.bundles(texts, 32))


def test_language_edge_rows(spark):
    model = langid.learn(edge.clashing(spark))
    rows = {r.doc_id: r for r in langid.identify(edge.clashing(spark), model).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {2, 3, 4, 8}
    assert all(rows[i].score == 0 for i in (2, 3, 4, 8))
    assert rows[7].lang_pred == "fr" and rows[5].lang_pred == "en"
    assert langid.identify(edge.empty(spark), model).count() == 0
    nothing = langid.learn(edge.empty(spark))
    assert {r.lang_pred for r in langid.identify(edge.docs(spark), nothing).collect()} == {"und"}


def test_rare_languages_are_learned_beyond_the_bound(spark):
    rare = "if(id = 7, 'xx', if(id < 60, 'yy', 'en'))"
    docs = spark.range(3_000).selectExpr("id as doc_id", f"{rare} as lang", f"if({rare} = 'en', 'the plain words', 'żółć gęślą jaźń') as text")
    assert langid.learn(docs, bound=30, least=20).names == ["en", "xx", "yy"]
    n = {r.lang: r["count"] for r in langid.sample(docs, 30, 20, "doc_id", "lang").groupBy("lang").count().collect()}
    assert n["xx"] == 1 and 8 <= n["yy"] <= 35 and 15 <= n["en"] <= 50
    assert langid.sample(docs, 3_000, 20, "doc_id", "lang").count() == 3_000


def test_too_many_languages(spark):
    docs = spark.range(20).select(F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(Exception, match="more than 10"):
        langid.prototypes(docs, most=10)


def test_quality_of_held_out_rows(spark, sf_dir):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op7_quality_classifier"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 10 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9


def test_positive_unlabelled_learning_without_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 5)), rng.normal(-1.5, 1, (4000, 5))
    unlabelled = np.concatenate([good[2000:], bad[: int(2000 * 0.4 / 0.6)]])
    model = pu_quality.fit(good[:2000], unlabelled, 0.6)
    assert (model.scores(rng.normal(1.5, 1, (1000, 5))) > 0.5).mean() > 0.95
    assert (model.scores(rng.normal(-1.5, 1, (1000, 5))) > 0.5).mean() < 0.05
    assert pu_quality.fit(good[:0], unlabelled, 0.5).scores(good[:2]).tolist() == [0, 0]
    assert pu_quality.fit(good, unlabelled[:0], 0.3).scores(good[:1]).tolist() == [0.3]


def test_risk_parts():
    positive, unlabelled = np.array([0.5, 2.0]), np.array([-1.0, 0.3, 0.8])
    loss = lambda g: np.log(1 + np.exp(-g))
    first, second = pu_quality.risk(positive, unlabelled, 0.4)
    assert np.isclose(first, 0.4 * loss(positive).mean())
    assert np.isclose(second, loss(-unlabelled).mean() - 0.4 * loss(-positive).mean())


def test_quality_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 1), (8, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = pu_quality.learn(edge.clashing(spark), labels)
    rows = pu_quality.score(edge.clashing(spark), model).collect()
    assert len(rows) == len(edge.DOCS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    none = pu_quality.learn(edge.docs(spark), labels.filter("quality = 0"))
    assert {r.score for r in pu_quality.score(edge.docs(spark), none).collect()} == {0.0}
    nobody = pu_quality.learn(edge.empty(spark), labels.limit(0))
    assert pu_quality.score(edge.empty(spark), nobody).count() == 0


@pytest.mark.parametrize("share", [0.15, 0.4, 0.75])
def test_the_prior_is_that_of_the_unlabelled_rows(share):
    rng = np.random.default_rng(11)
    n = 8000
    good = rng.normal(0, 1, (n, pu_quality.N_FEATURES)) + 1.2 * (np.arange(pu_quality.N_FEATURES) < 4)
    bad = rng.normal(0, 1, (n, pu_quality.N_FEATURES)) - 1.2 * (np.arange(pu_quality.N_FEATURES) < 4)
    is_good = rng.random(n) < share
    unlabelled = np.where(is_good[:, None], rng.permutation(good), bad)
    assert abs(pu_quality.estimated_prior(good[:4000], unlabelled) - share) < 0.06
    assert pu_quality.estimated_prior(good[:1], unlabelled) == 0.5


def test_the_labelled_share_does_not_decide(spark):
    """Nine of ten labelled documents are good, a third of all are: scores follow the documents."""
    rng = np.random.default_rng(2)
    words = np.array("the sea was calm and old men spoke of wind rain bread light stone".split())
    rows, good = [], {}
    for i in range(1200):
        good[i] = i % 3 == 0
        text = " ".join(rng.choice(words, 90)) + "." if good[i] else " ".join(f"{w}$$$ 99!!" for w in rng.choice(words[:3], 40))
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, 1) for i in range(0, 540, 3)] + [(i, 0) for i in range(1, 60, 3)] + [(3, 0)]  # document 3 is contested
    model = pu_quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    found = {r.doc_id: r.predicted for r in pu_quality.score(docs, model).collect()}
    assert np.mean([found[i] == good[i] for i in range(600, 1200)]) > 0.97
