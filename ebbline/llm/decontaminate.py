"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared in lower case with runs of white space as one blank. An item of m characters
found in a text with at most e edits shares at least ``m + 1 - q * (e + 1)`` of its q-grams with
that text. A diagonal is a place in the text less the place in the item; each edit moves by one diagonal at
most, so all of these lie on ``e + 1`` neighbouring ones. So for each text the item's shared q-grams, each place of the
item once, are counted in bands of diagonals that overlap: each band is taken together with the next. Only regions
that reach the bound are aligned, on the diagonals of their bands, and reported if the alignment keeps the edit
budget.

The scan of the texts is row-wise and needs no shuffle. Items are dealt into blocks of about ``block_chars`` characters, a table in the
shared folder; a worker reads a block there and holds the index of its q-grams, one at a time. Each block is one pass over the
texts; with several, what a pass finds or leaves is written before the next begins. Nothing of the items goes through the driver.

Defined results: texts NULL, empty or shorter than q match nothing; items NULL or shorter than q
normalised characters can't be found by q-grams and match nothing; for items so short that the
bound would be zero the budget is lowered until it is one. Repeated rows are reported each. An empty
table of texts or items gives no rows. Extra columns are ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import slices, stored
from ebbline.llm.warc import file_system
from ebbline.session import new_path

Q = 8
EDIT_SHARE = 0.1
BLOCK_CHARS = 4_000_000
_TABLE_BITS = 22
_STRETCH = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_NO_CODE = np.uint32(0xFFFFFFFF)
_KEPT: dict[tuple, Index] = {}
_SPACE = np.zeros(0x3001, bool)
_SPACE[[c for c in range(0x3001) if chr(c).isspace()]] = True


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the text in lower case with single blanks, and the place in the text of each."""
    low = text.lower()
    if len(low) != len(text):  # a few letters have a lower form of two characters; those stay as they are
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (codes < len(_SPACE)) & _SPACE[np.minimum(codes, len(_SPACE) - 1)]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    places = np.flatnonzero(keep)
    codes = np.where(space[places], np.uint32(32), codes[places])
    if len(codes) and codes[-1] == 32:
        codes, places = codes[:-1], places[:-1]
    return codes, places


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash for each q-gram: a polynomial of the code points, by doubling."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    power, width, base = codes.astype(np.uint64) + np.uint64(1), 1, np.uint64(_BASE)
    done, have = None, 0
    while True:
        if q & width:
            if done is None:
                done, have = power, width
            else:  # the part found so far, then this power's part behind it
                n = len(codes) - have - width + 1
                done = done[:n] * base + power[have : have + n]
                have += width
        if have == q:
            return done[: len(codes) - q + 1]
        n = len(power) - width
        power = power[:n] * base + power[width : width + n]
        base = np.uint64(int(base) * int(base) & 0xFFFFFFFFFFFFFFFF)
        width *= 2


class Index:
    """The q-grams of a block of items, sorted, with the items and places that have them."""

    def __init__(self, items: list[tuple[int, str]], q: int, edit_share: float):
        self.q = q
        self.ids, self.codes, self.budgets, self.bounds = [], [], [], []
        hashes, owners, places = [], [], []
        for item_id, text in items:
            codes, _ = normalise(text)
            if len(codes) < q:
                continue
            edits = max(0, min(int(edit_share * len(codes)), len(codes) // q - 1))
            found = grams(codes, q)
            hashes.append(found)
            owners.append(np.full(len(found), len(self.ids), np.int64))
            places.append(np.arange(len(found)))
            self.ids.append(item_id)
            self.codes.append(codes)
            self.budgets.append(edits)
            self.bounds.append(len(codes) + 1 - q * (edits + 1))
        if not self.ids:
            return
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = np.concatenate(owners)[order], np.concatenate(places)[order]
        self.hashes, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(hashes))
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[self._slot(self.hashes)] = True
        self.bound = np.array(self.bounds)

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _SPREAD) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def hits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place in found, item, place in item)`` of every shared q-gram."""
        at = np.flatnonzero(self.seen[self._slot(found)])
        rank = np.searchsorted(self.hashes, found[at])
        rank = np.minimum(rank, len(self.hashes) - 1)
        same = self.hashes[rank] == found[at]
        at, rank = at[same], rank[same]
        counts = self.first[rank + 1] - self.first[rank]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        inside = np.arange(total) - np.repeat(ends - counts, counts)
        entry = np.repeat(self.first[rank], counts) + inside
        return np.repeat(at, counts), self.owner[entry], self.place[entry]

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int, int]], np.ndarray]]:
        """``(number of the text, [(item, edits, start, end)], places)`` of each text that holds an item.

        Starts and ends are normalised; ``places`` leads back to the text. The texts are searched as one run of
        codes; q-grams over the border of two texts are left out.
        """
        if not self.ids:
            return
        done = [normalise(t) if t else (np.zeros(0, np.uint32), np.zeros(0, np.int64)) for t in texts]
        ends = np.cumsum([len(c) for c, _ in done])
        if not len(ends) or not ends[-1]:
            return
        whole, found = np.concatenate([c for c, _ in done]), []
        for low in range(0, len(whole), _STRETCH):  # a very long text is hashed in stretches; what they share is small
            some_at, some_item, some_place = self.hits(grams(whole[low : low + _STRETCH + self.q - 1], self.q))
            found.append((some_at + low, some_item, some_place))
        at, item, place = (np.concatenate(x) for x in zip(*found))
        text = np.searchsorted(ends, at, side="right")
        inside = at + self.q <= ends[text]
        at, item, place, text = at[inside], item[inside], place[inside], text[inside]
        pair = text * len(self.ids) + item
        if len(texts) * len(self.ids) <= 4_000_000:
            totals = np.bincount(pair, minlength=1)
            enough = totals[pair] >= self.bound[item]
        else:
            _, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
            enough = counts[back] >= self.bound[item]
        at, place, pair = at[enough], place[enough], pair[enough]
        order = np.argsort(pair, kind="stable")
        at, place, pair = at[order], place[order], pair[order]
        cuts = np.flatnonzero(np.diff(pair)) + 1
        matched: dict[int, list[tuple[int, int, int, int]]] = {}
        for some_at, some_place, some_pair in zip(np.split(at, cuts), np.split(place, cuts), np.split(pair, cuts)):
            if not len(some_pair):
                continue
            n, k = divmod(int(some_pair[0]), len(self.ids))
            start = int(ends[n]) - len(done[n][0])
            regions = self.regions(k, done[n][0], some_at - start - some_place, some_place)
            if regions:
                matched.setdefault(n, []).extend(regions)
        for n in sorted(matched):
            yield n, matched[n], done[n][1]

    def regions(self, k: int, codes: np.ndarray, diagonals: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Regions of one text that hold item k, by the shared q-grams' diagonals and places: the best of overlapping ones."""
        item, edits, bound = self.codes[k], self.budgets[k], self.bounds[k]
        width = edits + 1  # any run of so many diagonals lies in two neighbouring bands
        once = np.unique((diagonals // width) * len(item) + places)
        bands, places = once // len(item), once % len(item)
        first = np.append(np.flatnonzero(np.concatenate([[True], bands[1:] > bands[:-1]])), len(bands))
        counts, names = np.diff(first), bands[first[:-1]]
        after = np.append(np.where(names[1:] == names[:-1] + 1, counts[1:], 0), 0)
        before = np.append(0, np.where(names[1:] == names[:-1] + 1, counts[:-1], 0))
        hits = []
        for b in sorted({int(x) for x in names[counts + after >= bound]} | {int(x) - 1 for x in names[before + counts >= bound]}):
            low, high = np.searchsorted(bands, [b, b + 2])
            if len(np.unique(places[low:high])) >= bound:
                hits.append(align(item, codes, b * width, (b + 2) * width - 1, edits))
        taken: list[tuple[int, int, int]] = []
        for hit in sorted({h for h in hits if h}):
            if all(hit[2] <= start or hit[1] >= end for _, start, end in taken):
                taken.append(hit)
        return [(k, *hit) for hit in taken]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn the item into a stretch of the text, with start and end of that stretch.

    Only diagonals (place in the text less place in the item) from ``low`` to ``high`` are filled.
    None if more than ``most`` edits are needed. Of equal stretches the one that ends first is taken.
    """
    n, m = len(item), len(text)
    if low < 0 or high + n > m:  # make room, so that every cell of the band is there
        room = max(0, -low)
        text = np.concatenate([np.full(room, _NO_CODE), text[: max(0, high + n)], np.full(max(0, high + n - m), _NO_CODE)])
    else:
        room = 0
    width = high - low + 1
    steps = np.arange(width)
    # Cost and start are one number, cost * big + start, so the least cost carries the least start.
    big = 1 << 40
    far = big << 22
    shift = steps * big
    begin = low + steps
    outside = (begin < 0) | (begin > m)
    row = np.where(outside, far, begin - low)
    missing = np.full(width, far)
    cost = (text[np.arange(n)[:, None] + (low + room + steps)] != item[:, None]) * np.int64(big) if n * width <= 4_000_000 else None
    for i in range(n):
        step = cost[i] if cost is not None else (text[i + low + room + steps] != item[i]) * np.int64(big)
        missing[:-1] = row[1:]  # the item's character is missing in the text
        best = np.minimum(row + step, missing + big)
        row = np.minimum.accumulate(best - shift) + shift  # further characters of the text between
        if low + i + 1 < 0 or high + i + 1 > m:
            at = begin + i + 1
            row[(at < 0) | (at > m)] = far
        if not i & 31 and row.min() >= (most + 1) * big:
            return None
    k = int(np.argmin(row >> 40))
    edits = int(row[k] >> 40)
    if edits > most:
        return None
    return edits, int(row[k] & (big - 1)) + low, int(begin[k]) + n


def _store_items(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[str, int]:
    """The folder of the items' blocks and how many there are."""
    usable = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    chars = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    n, path = -(-chars // block_chars), new_path(items.sparkSession, "benchmark-blocks")
    if n:
        dealt = usable.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
        dealt.repartition(F.col("block")).write.partitionBy("block").parquet(path)
    return path, n


def _index(path: str, block: int, q: int, edit_share: float) -> Index:
    """The index of a stored block; a worker keeps the last one between tasks."""
    key = (path, block, q, edit_share)
    if key not in _KEPT:
        _KEPT.clear()
        fs, folder = file_system(f"{path}/block={block}")
        rows = []
        if fs.get_file_info(folder).type != pyarrow.fs.FileType.NotFound:
            rows = pq.read_table(folder, filesystem=fs, columns=["id", "text"], partitioning=None).to_pylist()
        # In an order of their own, so that results don't depend on files.
        block_items = sorted(((r["id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        _KEPT[key] = Index(block_items, q, edit_share)
    return _KEPT[key]


MATCH_SCHEMA = "doc_id long, item_id long, start long, n_chars long, edits long, item_chars long"


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", q: int = Q, edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(doc_id, item_id, start, n_chars, edits, item_chars)``: each region of a text that holds an item.

    ``start`` and ``n_chars`` are characters of the text as it is. Regions of one item don't overlap.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    narrow = narrow.filter("text is not null")
    path, n = _store_items(items, item_id_col, item_text_col, block_chars)
    results = [narrow.mapInArrow(_finder(path, k, q, edit_share), MATCH_SCHEMA) for k in range(n)]
    if not results:
        return docs.sparkSession.createDataFrame([], MATCH_SCHEMA)
    return results[0] if n == 1 else reduce(DataFrame.unionAll, [stored(r, "matches") for r in results])


def _finder(*block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(*block)
        for part in slices(batches):
            rows = []
            ids = part.column("doc_id").to_pylist()
            for n, found, places in index.scan(part.column("text").to_pylist()):
                for k, cost, start, end in found:
                    first = int(places[start])
                    rows.append((ids[n], index.ids[k], first, int(places[end - 1]) + 1 - first, cost, len(index.codes[k])))
            columns = list(zip(*rows)) or [()] * 6
            names = ["doc_id", "item_id", "start", "n_chars", "edits", "item_chars"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    return run


def remove(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    q: int = Q, edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows whose text holds no item, with all their columns. Rows are judged one by one; nothing is joined."""
    path, n = _store_items(items, item_id_col, item_text_col, block_chars)
    out = docs
    for k in range(n):
        left = out.mapInArrow(_remover(text_col, path, k, q, edit_share), docs.schema)
        out = left if k + 1 == n else stored(left, "clean-so-far")
    return out


def _remover(text_col: str, *block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(*block)
        for part in slices(batches):
            keep = np.ones(part.num_rows, bool)
            keep[[n for n, _, _ in index.scan(part.column(text_col).to_pylist())]] = False
            yield part.filter(pa.array(keep))

    return run
