"""How the sources of a language differ: distances between sources, and the terms that mark each of them.

Documents become counts of (language, source, term). A language keeps the terms in enough of its documents. With smoothed
shares in billionths, every pair of sources of a language gets the sum of absolute differences, and every source its leading
terms against the whole language.

The leading terms come from a dominance skyband. A term is dominated by one with at least its count in the source, at most its
count in the language and an earlier spelling: such a term can't rank behind it. Each part of the terms keeps, for each
source, those that fewer than ``top`` others dominate; the skybands of the parts are merged into one, and only its members
are ranked by their exact value. Leading terms are never lost, since whoever has ``top`` dominators has ``top`` in the skyband too.

The parts: terms of a language are dealt by hash into buckets of some ``BUCKET_TERMS`` terms, and its sources into blocks of
``BLOCK_SOURCES``. A task takes one bucket and two blocks, so what it holds is bounded whatever the number of
documents, terms or sources, and common terms or large sources are mere numbers by then. The pair part has a row for each ordered
pair of sources, which is its result's own size. Arithmetic is of whole numbers throughout.

Defined results: text, language and source NULL count as empty strings, which are values like others; a very long text is
read in stretches; repeated rows count as often as they stand; ties of value go by the item's UTF-8; a source without terms
has its pairs and no term rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import as_bytes, slices, stored

MIN_DOCS = 30
TOP = 50
BUCKET_TERMS = 8192
BLOCK_SOURCES = 256
MERGED_BUCKETS = 64
_FLUSH = 400_000  # entries that a worker holds before it hands them on
_STRETCH = 1 << 20

_UPPER = bytes(range(0x41, 0x5B))
#: Capitals to small letters, other ASCII but letters to blanks; bytes of other characters stay.
_FOLD = bytes(c + 32 if c in _UPPER else c if chr(c).isalpha() or c > 0x7F else 0x20 for c in range(256))


# --- counts ------------------------------------------------------------------


def stretches(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    start = 0
    while start < len(text):
        end = start + _STRETCH
        folded = text[start:end].translate(_FOLD)
        if end < len(text):
            cut = folded.rfind(b" ")
            # A term longer than a stretch is taken whole.
            while cut < 0 and end < len(text):
                end += _STRETCH
                folded = text[start:end].translate(_FOLD)
                cut = folded.rfind(b" ")
            if cut >= 0 and end < len(text):
                folded, end = folded[:cut], start + cut + 1  # behind the blank
        yield folded.split()
        start = end


def _counts(found: dict) -> Iterator[pa.RecordBatch]:
    """Rows of each group, and one of the empty term that says that the group occurs."""
    for (lang, source), (n, docs) in found.items():
        terms = [b"", *n]
        columns = [
            pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
            pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
            pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
        ]
        yield pa.record_batch(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``, summed within tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        held = 0
        for batch in slices(batches):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, in_docs = found.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                own: set[bytes] = set()
                for terms in stretches(text or b""):
                    n.update(terms)
                    own.update(terms)
                in_docs.update(own)
                held += len(n) - before
                if held > _FLUSH:
                    yield from _counts(found)
                    found, held = {}, 0
        yield from _counts(found)

    empty = F.lit("")
    narrow = docs.select(
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"), F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        as_bytes("text").alias("text"),
    )
    counted = narrow.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """One more than the smoothed share in billionths, rounded down; exact for any count."""
    above = (n + 5).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = (total + 5 * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


# --- skyband -----------------------------------------------------------------


def skyband(n: list[int], lang_n: list[int], terms: list[str], k: int) -> list[int]:
    """Places of the terms that fewer than ``k`` others dominate.

    Taken by falling count in the source, dominators come first. A Fenwick tree over the counts in the language keeps the
    ``k`` earliest spellings of each of its ranges, which is enough to tell whether ``k`` members dominate a term.
    """
    order = sorted(range(len(n)), key=lambda i: (-n[i], lang_n[i], terms[i]))
    levels = {v: i + 1 for i, v in enumerate(sorted(set(lang_n)))}
    tree: list[list[str]] = [[] for _ in range(len(levels) + 1)]
    kept = []
    for i in order:
        term, at, over = terms[i], levels[lang_n[i]], 0
        while at and over < k:
            over += bisect_left(tree[at], term)
            at &= at - 1
        if over >= k:
            continue
        kept.append(i)
        at = levels[lang_n[i]]
        while at < len(tree):
            node = tree[at]
            if len(node) < k or term < node[-1]:
                insort(node, term)
                del node[k:]
            at += at & -at
    return kept


# --- parts -------------------------------------------------------------------

_PART_SCHEMA = "lang string, source string, part string, item string, value long, n long, lang_n long, bucket long"
_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64()),
                    ("n", pa.int64()), ("lang_n", pa.int64()), ("bucket", pa.int64())])


def _differences(rows: dict, groups: dict, first: int, second: int, whole: bool) -> Iterator[tuple[str, str, int]]:
    """Sums of absolute differences over the terms of one bucket, between the sources of two blocks.

    Terms that neither block has differ by the sources' bases. They are in no row, so a sum holds what its terms have beyond
    the bases' difference; that of all terms comes on top once, where ``whole`` is set.
    """
    sides = [[i for i, b in enumerate(groups["block"]) if b == block] for block in (first, second)]
    names = [[groups["source"][i] for i in side] for side in sides]
    bases = [np.array([groups["base"][i] for i in side], np.int64) for side in sides]
    seats = [{s: i for i, s in enumerate(own)} for own in names]
    known, at = {}, []
    for term in rows["term"]:
        at.append(known.setdefault(term, len(known)))
    at, p = np.array(at, np.int64), np.array(rows["p"], np.int64)
    own = [np.array([seat.get(s, -1) for s in rows["source"]], np.int64) for seat in seats]
    sums = np.zeros((len(names[0]), len(names[1])), np.int64)
    step = max(1, (1 << 20) // max(1, *map(len, names)))
    for low in range(0, len(known), step):
        n = min(step, len(known) - low)
        dense = []
        for seat, base in zip(own, bases):
            block = np.tile(base, (n, 1))
            here = (at >= low) & (at < low + n) & (seat >= 0)
            block[at[here] - low, seat[here]] = p[here]
            dense.append(block)
        for i in range(len(names[0])):
            sums[i] += np.abs(dense[1] - dense[0][:, i : i + 1]).sum(axis=0)
    absent = (groups["terms"][0] if whole else 0) - len(known)
    sums += absent * np.abs(bases[1] - bases[0][:, None])
    for i, source in enumerate(names[0]):
        for j, other in enumerate(names[1]):
            if source != other:
                yield source, other, int(sums[i, j])
                if first != second:
                    yield other, source, int(sums[i, j])


def _part(top: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, bucket, first, second = (k.as_py() for k in key)
        rows, groups = left.to_pydict(), right.to_pydict()
        out: list[tuple] = []
        if rows["term"] or bucket == 0:  # one bucket at least speaks for sources without terms
            out += [(lang, s, "pair", o, v, None, None, bucket) for s, o, v in _differences(rows, groups, first, second, bucket == 0)]
        if first == second:
            by_source: dict[str, list[int]] = {}
            for i, (source, p, q) in enumerate(zip(rows["source"], rows["p"], rows["q"])):
                if p > q:
                    by_source.setdefault(source, []).append(i)
            for source, at in by_source.items():
                n, lang_n, terms = ([rows[c][i] for i in at] for c in ("n", "lang_n", "term"))
                out += [
                    (lang, source, "term", terms[j], rows["p"][at[j]] - rows["q"][at[j]], n[j], lang_n[j], bucket)
                    for j in skyband(n, lang_n, terms, top)
                ]
        columns = zip(*out) if out else [[]] * len(_ARROW)
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return run


def _merge(top: int):
    def run(found: pa.Table) -> pa.Table:
        rows = found.select(["n", "lang_n", "item"]).to_pydict()
        kept = skyband(rows["n"], rows["lang_n"], rows["item"], top)
        return found.select(["lang", "source", "part", "item", "value"]).take(pa.array(kept, pa.int64()))

    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bucket_terms: int = BUCKET_TERMS,
          block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: ``pair`` rows for all other sources, ``term`` rows for the ``top`` leading terms."""
    same_term = Window.partitionBy("lang", "term")  # a row for each source
    counts = term_counts(docs).select(
        "lang", "source", "term", "n", F.sum("n").over(same_term).alias("lang_n"), F.sum("docs").over(same_term).alias("lang_docs"),
        (F.col("source") == F.min("source").over(same_term)).alias("first"),
    )
    counts = stored(counts.filter((F.col("lang_docs") >= min_docs) | (F.col("term") == "")), "divergence-counts")
    langs = counts.groupBy("lang").agg(
        F.count_if(F.col("first") & (F.col("term") != "")).alias("terms"), F.sum("n").alias("lang_total"), F.count_if(F.col("term") == "").alias("sources")
    )
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    seat = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(
        groups.select(
            "lang", "source", "total", "lang_total", "terms", F.floor(seat / block_sources).alias("block"),
            F.floor((F.col("sources") - 1) / block_sources).alias("last_block"), F.ceil(F.greatest("terms", F.lit(1)) / bucket_terms).alias("buckets"),
            F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0).alias("base"),
        ),
        "divergence-groups",
    )
    # Every block meets every other once, in ascending order.
    meetings = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), "last_block"), lambda b: F.struct(F.least("block", b).alias("first"), F.greatest("block", b).alias("second")))).alias("meet")
    rows = counts.filter("term != ''").join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), meetings, "source", "term", "n", "lang_n",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    sides = groups.select("lang", "buckets", meetings, "source", "block", "base", "terms").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"), "meet.first", "meet.second", "source", "block", "base", "terms"
    )
    keys = ("lang", "bucket", "first", "second")
    rows = rows.select("lang", "bucket", "meet.first", "meet.second", "source", "term", "n", "lang_n", "p", "q")
    parts = stored(rows.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(_part(top), _PART_SCHEMA), "divergence-parts")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    merged = parts.filter("part = 'term'").withColumn("merge", F.floor(F.col("bucket") / MERGED_BUCKETS))
    terms = merged.groupBy("lang", "source", "merge").applyInArrow(_merge(top), "lang string, source string, part string, item string, value long")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    leading = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return leading.unionByName(pairs.withColumn("rank", F.row_number().over(by_value)))
