import random

import numpy as np

from ebbline.llm import decontaminate as d
from tests.llm import edge


def plain_best(item, text):
    """Fewest edits between the item and any stretch of the text, by the whole matrix."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, t in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcxyz")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcxyz"))
    return "".join(out)


def phrase(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_align_is_the_banded_optimum():
    rng = random.Random(1)
    codes = lambda s: np.array([ord(c) for c in s], np.uint32)
    for _ in range(60):
        item = phrase(rng, 6)
        text = phrase(rng, 4) + " " + edited(item, rng.randint(0, 5), rng) + " " + phrase(rng, 4)
        cost, start, end = d.align(codes(item), codes(text), -len(item), len(text), 10**6)
        assert cost == plain_best(item, text) == plain_distance(item, text[start:end])


def test_long_texts_in_stretches(monkeypatch):
    rng = random.Random(8)
    item = phrase(rng, 30)
    texts = [phrase(rng, 300) + " " + item + " " + phrase(rng, 50), None, "short", item, phrase(rng, 100)]
    index = d.Index([(1, item)], d.Q, 0.1)
    whole = [(n, regions) for n, regions, _ in index.scan(texts)]
    assert [n for n, _ in whole] == [0, 3]
    monkeypatch.setattr(d, "_STRETCH", 50)
    assert [(n, regions) for n, regions, _ in index.scan(texts)] == whole


def test_find_loses_nothing_within_the_budget(spark):
    rng = random.Random(2)
    items = [(k, phrase(rng, rng.randint(8, 40))) for k in range(12)]
    docs = []
    for n in range(150):
        text = phrase(rng, rng.randint(0, 60))
        if n % 3 == 0:
            own = items[rng.randrange(12)][1]
            text += " " + edited(own, rng.randint(0, int(0.13 * len(own))), rng) + " " + phrase(rng, rng.randint(0, 60))
        docs.append((n, text))
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for n, text in docs:
        low = " ".join(text.lower().split())
        for k, item in items:
            budget = max(0, min(int(0.1 * len(item)), len(item) // d.Q - 1))
            if plain_best(item, low) <= budget:
                want.add((n, k, plain_best(item, low)))
    assert len(want) > 20
    for block in (10**6, 200):  # one block of items, and many
        found = d.find(table, bench, block_chars=block).collect()
        best = {}
        for r in found:
            best[r.doc_id, r.item_id] = min(r.edits, best.get((r.doc_id, r.item_id), r.edits))
        assert {(*k, v) for k, v in best.items()} == want
        clean = {r.doc_id for r in d.remove(table, bench, block_chars=block).collect()}
        assert clean == {n for n, _ in docs} - {n for n, _, _ in want}


def test_places_are_those_of_the_text_as_it_is(spark):
    item = "A passage of the benchmark, which is long enough to be found."
    text = "İ ß Intro\n\n  A  PASSAGE of the\tbenchmark, which is long\nenough to be found.  Tail"
    bench = spark.createDataFrame([(9, item), (10, None), (11, "tiny"), (12, "")], "item_id long, text string")
    (row,) = d.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).collect()
    assert text[row.start : row.start + row.n_chars] == "A  PASSAGE of the\tbenchmark, which is long\nenough to be found."
    assert (row.item_id, row.edits) == (9, 0)


def test_an_item_twice_in_a_text(spark):
    item = "some sentence that stands in here twice over."
    docs = spark.createDataFrame([(1, f"{item} And again: {item}")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.start for r in d.find(docs, bench).collect()) == [0, len(item) + 12]


def test_planted_passages_of_the_given_tables(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: " ".join(r.text.lower().split()) for r in bench.collect()}
    exact = set()
    for r in docs.collect():
        low = " ".join(r.text.lower().split())
        exact |= {(r.doc_id, k) for k, item in items.items() if item in low}
    found = {(r.doc_id, r.item_id) for r in d.find(docs, bench).collect()}
    assert exact and exact <= found


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta. alpha beta gamma delta."), (2, "quick brown fox jumps over")], "item_id long, text string")
    found = d.find(edge.clashing(spark), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 2), (5, 1), (6, 1)}
    assert sum(r.doc_id == 1 for r in found) == 2
    kept = d.remove(edge.clashing(spark), bench)
    assert kept.columns == edge.clashing(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 4, 7, 8, None]
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find(edge.docs(spark), none).count() == 0 and d.remove(edge.docs(spark), none).count() == len(edge.DOCS)
    assert d.find(edge.empty(spark), bench).count() == 0 == d.remove(edge.empty(spark), bench).count()
