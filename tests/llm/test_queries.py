"""Queries against their SQL, and the pipeline against brute force."""

import hashlib
import math
from collections import Counter

import pytest

import corpus_pipeline
from ebbline.llm import decontaminate, line_rules, mixing, simhash
from ebbline.llm.common import stored
from ebbline.llm.queries import QUERIES
from ebbline.llm.sql import ORACLE_SQL
from tests.compare import compare, connect
from tests.llm import edge
from tests.llm.test_decontaminate import plain_best
from tests.llm.test_simhash import plain_groups


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, QUERIES[name], ORACLE_SQL[name], sf_dir) == []


def test_registered():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_no_python_in_native_plans(spark, sf_dir):
    for name in ("op2_secret_scan", "op6_sharding", "op10_mixing"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop")), name


def poisson(rate, draw):
    total, k = 0.0, 0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if draw < total:
            return k
        k += 1


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {}
    for r in docs:
        found = line_rules.judge(r.text.encode())
        if found[6]:
            rows[r.doc_id] = (found[9].decode(), r.source)
    keep = {c for _, _, c in plain_groups([(i, t) for i, (t, _) in rows.items()])}
    clean = {}
    for i in keep:
        low = " ".join(rows[i][0].lower().split())
        # The cheap half of the check first: a match within the budget has an exact piece of q characters.
        if not any(
            any(item[a : a + decontaminate.Q] in low for a in range(0, len(item), decontaminate.Q)) and plain_best(item, low) <= min(int(0.1 * len(item)), len(item) // 8 - 1)
            for item in items
            if sum(item[a : a + 8] in low for a in range(len(item) - 7)) >= len(item) + 1 - 8 * (int(0.1 * len(item)) + 1)
        ):
            clean[i] = rows[i]
    sizes = Counter()
    for text, source in clean.values():
        sizes[source] += len(text.encode()) + 1
    weights = {s: b**mixing.ALPHA for s, b in sizes.items()}
    want = Counter()
    for i, (text, source) in clean.items():
        rate = sum(sizes.values()) * weights[source] / sum(weights.values()) / sizes[source]
        draw = int(hashlib.md5(f"{mixing.SEED}|{i}".encode()).hexdigest()[:13], 16) / 16**13
        n = poisson(rate, draw)
        if n:
            want[i, text] = n
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.text) for r in found) == want
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.n_chars == len(r.text) and r["size"] == len(r.text.encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stages_take_edge_rows(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "source_mixing", "sharding"]
    for table in (edge.docs(spark), edge.empty(spark)):
        columns = table.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, table, sf_dir), "edge-stage")
            assert out.columns[: len(columns)] == columns or name == "sharding"
        chained = table
        for name, stage in corpus_pipeline.STAGES:
            chained = stored(stage(spark, chained, sf_dir), "edge-stage")


def test_clashing_columns_keep_their_values(spark, sf_dir):
    """The first four stages return the columns of documents with the values that they came with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [c for c in edge.CLASHING if c not in docs.columns]
    table = docs.selectExpr("*", *[f"'{c} ' || doc_id as {c}" for c in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, table, sf_dir)
        assert out.columns == table.columns, name
        rows = out.selectExpr("doc_id", "source", "lang", *names).collect()
        want = {r.doc_id: r for r in docs.select("doc_id", "source", "lang").collect()}
        assert len(rows) > 50
        for r in rows:
            assert (r.source, r.lang) == (want[r.doc_id].source, want[r.doc_id].lang)
            assert all(r[c] == f"{c} {r.doc_id}" for c in names), name


def test_near_duplicate_stage_keeps_one_of_each(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in simhash.deduplicate(docs).collect()}
    assert kept == {c for _, _, c in plain_groups([(r.doc_id, r.text) for r in docs.collect()])}
