"""Token ids in directly addressable codes.

Ids are cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, level 1 the next chunk of
those ids that have one, and so on. A bitmap beside each level but the last says which ids go on, and a
rank directory counts its ones up to each block of 512 bits. The chunk of an id on the next level stands at the rank of its
bit, so any id, or any run of ids, is read from a few bytes of each level; nothing before it is decoded.

A store is a Parquet table of segments ordered by document id: ``part, seq`` (its order), ``n_tokens``, the
directory ``doc_ids, ends`` and the coded ``payload``. Segments hold whole documents and some
``SEGMENT_TOKENS`` ids. They are written by Spark's own committer to any file system that Spark reaches, so a
lost executor costs its tasks and leaves no half files.

Text is encoded by the tokenizers library. Its byte-level pre-tokenizer never joins what stands before
and behind certain places (a blank before a word, a full stop or comma behind a letter), so equal pieces between
such places are encoded once for each worker and remembered; results are those of encoding whole texts.
Other kinds of tokenizers encode whole texts.

Defined results: text NULL counts as empty; each document ends with the end id, so an empty one has that id alone; rows
come in ascending order of id, NULL first, rows of one id in order of their text; an empty table gives an
empty store; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm.common import slices

SEGMENT_TOKENS = 1 << 20
END_ID = 2
REMEMBERED = 1_000_000  # pieces that a worker knows before it starts anew
_LINES = 64
_BLOCK = 512  # bits between two entries of a rank directory
_MAGIC = b"DAC1"
_CHUNK_BITS = 8

# --- codes -------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """The levels of the ids: magic, number of levels, entries of each, then chunks, bitmap and ranks level by level."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        chunk = (rest & 0xFF).astype(np.uint8)
        rest = rest >> _CHUNK_BITS
        more = rest > 0
        levels.append((chunk, more))
        if not more.any():
            break
        rest = rest[more]
    out = [_MAGIC, struct.pack("<I", len(levels)), struct.pack(f"<{len(levels)}Q", *[len(c) for c, _ in levels])]
    for chunk, more in levels[:-1]:
        padded = np.zeros(-(-len(more) // _BLOCK) * _BLOCK, np.uint8)
        padded[: len(more)] = more
        ones = padded.reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        out += [chunk.tobytes(), np.packbits(padded, bitorder="little").tobytes(), ranks.tobytes()]
    out.append(levels[-1][0].tobytes())
    return b"".join(out)


class Codes:
    """Reads single ids and runs of ids out of ``pack``'s bytes."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of token codes")
        (n,) = struct.unpack_from("<I", data, 4)
        sizes = struct.unpack_from(f"<{n}Q", data, 8)
        at, self.levels = 8 + 8 * n, []
        for k, size in enumerate(sizes):
            chunk = np.frombuffer(data, np.uint8, size, at)
            at += size
            bits = ranks = None
            if k < n - 1:
                blocks = -(-size // _BLOCK)
                bits = np.frombuffer(data, np.uint8, blocks * _BLOCK // 8, at)
                at += len(bits)
                ranks = np.frombuffer(data, "<u4", blocks, at)
                at += 4 * blocks
            self.levels.append((chunk, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, at: int) -> int:
        """Ones before the bit ``at``: the directory's count and the bits of one block."""
        chunk, bits, ranks = self.levels[level]
        block, inside = divmod(at, _BLOCK)
        if block == len(ranks):
            return len(self.levels[level + 1][0])
        start = block * _BLOCK // 8
        part = np.unpackbits(bits[start : start + -(-inside // 8)], count=inside, bitorder="little") if inside else []
        return int(ranks[block]) + int(np.sum(part))

    def run(self, start: int, end: int, level: int = 0) -> np.ndarray:
        """The ids from ``start`` to before ``end``."""
        chunk, bits, _ = self.levels[level]
        found = chunk[start:end].astype(np.uint32)
        if bits is not None and end > start:
            first = start // 8
            more = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")[start - 8 * first : end - 8 * first]
            at = np.flatnonzero(more)
            if len(at):
                low = self._rank(level, start)
                found[at] |= self.run(low, low + len(at), level + 1) << _CHUNK_BITS
        return found

    def __getitem__(self, at: int) -> int:
        return int(self.run(at, at + 1)[0])


# --- encoding ----------------------------------------------------------------

# White space as the byte-level pre-tokenizer sees it.
_W = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(
    f" ?[^{_W}.,]++(?:(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,])|[^{_W}]*+)| ?[.,][^{_W}]*+|[{_W}]+(?![^{_W}])|[{_W}]+"
)
_ENCODERS: dict[str, Encoder] = {}


class _Numbered(dict):
    """Numbers pieces in the order of their first lookup and lists those that are new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.tokenizer = Tokenizer.from_str(text)
        spec = json.loads(text)
        before = spec.get("pre_tokenizer") or {}
        plain = all(
            not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) and not re.search(f"[{_W}.,]", t["content"])
            for t in spec.get("added_tokens", [])
        )
        self.in_pieces = (
            plain and spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        )
        self._forget()
        line_end = np.frombuffer(self._ids("\n"), "<u4")
        self.line_end = line_end[0] if len(line_end) == 1 else None

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _forget(self) -> None:
        self.known = _Numbered()
        self.first, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # of each piece, in ``ids``
        self.ids, self.used = np.zeros(4096, "<u4"), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.in_pieces:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        pieces = [_PIECE.findall(t) for t in texts]
        counts = [len(p) for p in pieces]
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(pieces)), np.int64, sum(counts))
        if self.known.new:
            self._learn()
        length = self.length[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        data = self.ids[np.repeat(self.first[at] - ends[:-1], length) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]).tolist()
        if len(self.known) > REMEMBERED:
            self._forget()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self) -> None:
        """Encode new pieces as lines of short texts: a line end is a piece of its own, before and behind any word."""
        new, self.known.new = self.known.new, []
        start = len(self.known) - len(new)
        if len(self.known) > len(self.first):
            self.first, self.length = (np.concatenate([a, np.zeros(len(self.known), np.int64)]) for a in (self.first, self.length))
        words = [i for i, p in enumerate(new) if not p.isspace()]
        alone = [i for i, p in enumerate(new) if p.isspace()]
        ids, stops = [], []  # of all lines, each closed by a line end
        for low in range(0, len(words), _LINES):
            some = words[low : low + _LINES]
            (found,) = self.tokenizer.encode_batch_fast(["\n".join([new[i] for i in some])], add_special_tokens=False)
            ids += found.ids
            ids.append(-1 if self.line_end is None else self.line_end)
            stops.append(len(ids) - 1)
        if words:
            ids = np.array(ids, np.int64)
            ends = np.flatnonzero(ids == self.line_end) if self.line_end is not None else ids[:0]
            last = np.minimum(np.arange(1, len(stops) + 1) * _LINES, len(words)) - 1
            # Each line must have as many ends as words; else all of them are encoded one by one.
            if len(ends) == len(words) and (ends[last] == stops).all():
                self._add(start + np.array(words), np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
            else:
                alone += words
        for i in alone:
            ids = np.frombuffer(self._ids(new[i]), "<u4")
            self._add(np.array([start + i]), ids, np.array([len(ids)]))

    def _add(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), "<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.used += len(ids)


def encoder(path: str) -> Encoder:
    """One for each worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- store -------------------------------------------------------------------

SEGMENT_SCHEMA = "part long, seq long, n_tokens long, doc_ids array<long>, ends array<long>, payload binary"


def _segment(part: int, seq: int, doc_ids: list, ends: list[int], runs: list[bytes]) -> pa.RecordBatch:
    payload = pack(np.frombuffer(b"".join(runs), "<u4"))
    columns = [
        pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([ends[-1]], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
    ]
    return pa.record_batch(columns, ["part", "seq", "n_tokens", "doc_ids", "ends", "payload"])


def segments(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
             segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """The store's rows, from texts dealt into ranges of the id and sorted there."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, ends, runs = [], [], []
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                doc_ids.append(doc_id)
                runs.append(ids + end)
                ends.append((ends[-1] if ends else 0) + len(runs[-1]) // 4)
                if ends[-1] >= segment_tokens:
                    yield _segment(part, seq, doc_ids, ends, runs)
                    seq += 1
                    doc_ids, ends, runs = [], [], []
        if doc_ids:
            yield _segment(part, seq, doc_ids, ends, runs)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = narrow.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text").mapInArrow(run, SEGMENT_SCHEMA)


def write(docs: DataFrame, store: str, tokenizer: str | None = None, **options) -> None:
    segments(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), **options).write.parquet(store)


def read(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(store)


def segment_starts(store: DataFrame) -> DataFrame:
    """``(part, seq, base)``: ids of all segments before. Sums of parts first, so no window holds all segments."""
    sizes = store.select("part", "seq", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("local"))
    return local.join(parts, "part").select("part", "seq", (F.col("before") + F.col("local")).alias("base"))


def documents(store: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, first_id)`` of each document, read back out of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1):
            part, seq, doc_ids, ends, payload = (batch.column(c)[0].as_py() for c in ("part", "seq", "doc_ids", "ends", "payload"))
            codes, starts = Codes(payload), [0, *ends[:-1]]
            ids = codes.run(0, len(codes)).astype("<u4", copy=False)  # all of its documents are wanted
            data = memoryview(ids.tobytes())
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends)]
            firsts = ids[starts].tolist()
            lengths = [b - a for a, b in zip(starts, ends)]
            columns = [doc_ids, [part] * len(ends), [seq] * len(ends), starts, lengths, crcs, firsts]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "part", "seq", "local", "n_tokens", "ids_crc32", "first_id"])

    rows = store.select("part", "seq", "doc_ids", "ends", "payload").mapInArrow(
        run, "doc_id long, part long, seq long, local long, n_tokens long, ids_crc32 long, first_id long"
    )
    placed = rows.join(segment_starts(store), ["part", "seq"])
    return placed.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "first_id")


def lookup(store: DataFrame, doc_ids: list[int], first: int = 0, n: int | None = None) -> DataFrame:
    """``(doc_id, ids)``: ids from ``first`` on, at most ``n``, of a stated list of documents; nothing else is decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1):
            own, ends = batch.column("doc_ids")[0].as_py(), batch.column("ends")[0].as_py()
            codes, found = Codes(batch.column("payload")[0].as_py()), []
            for doc_id, a, b in zip(own, [0, *ends[:-1]], ends):
                if doc_id in wanted:
                    a = min(a + first, b)
                    found.append((doc_id, codes.run(a, b if n is None else min(b, a + n)).tolist()))
            yield pa.record_batch(
                [pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int64()))], ["doc_id", "ids"]
            )

    wanted = frozenset(doc_ids)
    inside = store.filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(d)) for d in wanted]))) if wanted else store.limit(0)
    return inside.select("doc_ids", "ends", "payload").mapInArrow(run, "doc_id long, ids array<long>")
