import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ebbline.llm import divergence
from tests.llm import edge

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_audit(docs, min_docs, top):
    """``docs`` is (lang, source, text); all sources, all terms, no skyband."""
    in_docs, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = plain_terms(text)
        in_docs[lang].update(set(terms))
        n[lang, source].update(terms)
    rows = set()
    for lang in in_docs.keys() | {g[0] for g in n}:
        kept = [t for t, d in in_docs[lang].items() if d >= min_docs]
        sources = [s for g, s in n if g == lang]
        v = len(kept)
        totals = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(n[lang, s][t] for s in sources) for t in kept}
        share = lambda c, total: 1 + 1_000_000_000 * (c + 5) // (total + 5 * v)
        for s in sources:
            pairs = [(-sum(abs(share(n[lang, s][t], totals[s]) - share(n[lang, o][t], totals[o])) for t in kept), o) for o in sources if o != s]
            terms = [(share(whole[t], sum(totals.values())) - share(n[lang, s][t], totals[s]), t) for t in kept if n[lang, s][t]]
            leading = sorted((x for x in terms if x[0] < 0), key=lambda x: (x[0], x[1].encode()))[:top]
            for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", leading)):
                rows |= {(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(found, 1)}
    return rows


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("options", [{}, {"bucket_terms": 20}, {"bucket_terms": 50, "block_sources": 3}])
def test_against_all_sources_and_terms(spark, sf_dir, options):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = plain_audit([(r.lang, r.source, r.text) for r in docs.collect()], 10, 7)
    assert found(divergence.audit(docs, min_docs=10, top=7, **options)) == plain
    assert sum(r[2] == "term" for r in plain) > 200


@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 6)), max_size=60), st.integers(1, 5))
def test_skyband_is_who_fewer_than_k_dominate(counts, k):
    n, lang_n, terms = [a for a, _ in counts], [a + b for a, b in counts], [f"t{i:02}" for i in range(len(counts))]
    random.Random(len(counts)).shuffle(terms)
    rows = range(len(n))
    over = [sum(n[j] >= n[i] and lang_n[j] <= lang_n[i] and terms[j] < terms[i] for j in rows) for i in rows]
    assert sorted(divergence.skyband(n, lang_n, terms, k)) == [i for i in rows if over[i] < k]


def test_stretches_are_the_whole_text(monkeypatch):
    monkeypatch.setattr(divergence, "_STRETCH", 7)
    for text in ("one Two,three four-five sixsevenEight nine", "x" * 50, "", "çà ÉTÉ ☃☃☃ 漢字𝒳 z", " a ", "abcdefg hijklmn opqrstu"):
        lists = list(divergence.stretches(text.encode()))
        assert [t.decode() for some in lists for t in some] == plain_terms(text)


def test_edge_rows(spark):
    for table in (edge.docs(spark), edge.clashing(spark)):
        rows = [(r.lang, r.source, r.text) for r in edge.docs(spark).collect()]
        for least in (1, 2, 30):
            assert found(divergence.audit(table, min_docs=least, top=3)) == plain_audit(rows, least, 3)
    assert divergence.audit(edge.empty(spark)).count() == 0


def test_a_flush_changes_nothing(spark, monkeypatch):
    rows = [("en", f"s{i % 4}", " ".join(f"w{'abcdefghij'[(i * j) % 10]}{'klmnop'[j % 6]}" for j in range(20)), i) for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string, doc_id long")
    monkeypatch.setattr(divergence, "_FLUSH", 5)
    assert found(divergence.audit(docs, min_docs=3, top=4)) == plain_audit([r[:3] for r in rows], 3, 4)


def test_exact_shares_of_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, v = 3 * 10**15, 10**16 + 7, 12_345
    row = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    (found_share,) = row.select(divergence.share(F.col("n"), F.col("total"), F.col("v"))).first()
    assert found_share == 1 + 1_000_000_000 * (n + 5) // (total + 5 * v)
