"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint of 64 bits is cut into ``max_bits + 3`` blocks. Two fingerprints that differ
in at most ``max_bits`` bits agree in at least three blocks, so every such pair meets under
at least one choice of three blocks; the key of a choice has 31 to 33 bits at the default
distance, which keeps chance meetings few at billions of documents. Inside a key the
Hamming distance is verified.

Equal fingerprints are one node from the start, so exact copies never form pairs. A key with
many different fingerprints is dealt into chunks, and each pair of chunks is one bounded
piece of work that returns a spanning forest of its links, not the links themselves. The
forests of all keys together connect exactly what all links would connect.

A row of a key with n fingerprints is repeated for each of its n / ``CHUNK`` chunks. In a key with more than ``DENSE`` that would
grow with the square, so there each fingerprint is sent to the points around it instead, within the bits that the key
leaves open: with ``max_bits`` of 3, to those one bit away (33 points) as a neighbour, and to those two bits away (496) as a
visitor. Two fingerprints within three bits have a point that one is a neighbour and the other a neighbour or visitor of. At each
point all are linked to the least neighbour, and all such links are close pairs. That is 529 rows for each fingerprint, however many there are.

Defined results: a text that is NULL or has no words has fingerprint zero and is linked like any
other; repeated rows are all returned by ``near_duplicates``, one of them by ``deduplicate``; a row
whose id is NULL takes the least id of its component if that has one, else NULL; an empty table
gives no rows; other columns are ignored by ``near_duplicates`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import as_bytes, slices, stored

SHINGLE, MAX_BITS = 3, 3
SEED = 42
CHUNK = 1024  # different fingerprints of one key that are compared in one piece
DENSE = 1 << 18  # different fingerprints of one key from which on points take the place of chunks
_TASK_ROWS = 65_536
_AGREE = 3  # blocks that a key takes together


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the shingles' hashes, as an unsigned integer."""
    words = (text or b"").lower().split()  # bytes.lower() changes A-Z only, split() cuts at the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :])), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, also: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, fp, *also)`` for every row; ``fp`` is the fingerprint as a signed long, ``also`` are long columns to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=4096):
            found = [fingerprint(t, shingle) for t in part.column("text").to_pylist()]
            kept = [part.column(c) for c in also]
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64)), *kept], ["doc_id", "fp", *also]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"), *also)
    return narrow.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *also)))


def _choices(max_bits: int) -> list[int]:
    """Bit masks, as signed longs: every choice of blocks that a close pair may agree in."""
    n = max_bits + _AGREE
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, _AGREE)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning_links(fps: np.ndarray, ids: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A star for each set of fingerprints that chains of close pairs connect: ``(least id, other id)``."""
    left = np.ones(len(fps), bool)
    links = []
    for first in range(len(fps)):
        if not left[first]:
            continue
        left[first] = False
        members, front = [first], np.array([first])
        while len(front):
            rest = np.flatnonzero(left)
            close = np.zeros(len(rest), bool)
            for at in range(0, len(front), 64):
                near = np.bitwise_count(fps[rest][None, :] ^ fps[front[at : at + 64]][:, None]) <= max_bits
                close |= near.any(axis=0)
            front = rest[close]
            left[front] = False
            members.extend(front.tolist())
        if len(members) > 1:
            own = ids[members]
            least = int(own.min())
            links.extend((least, int(i)) for i in own if i != least)
    return links


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def around(max_bits: int) -> list[tuple[int, int, bool]]:
    """``(choice, bits to flip, visitor)``: the points around a fingerprint within the bits that a choice leaves open."""
    near = max_bits // 2
    out = []
    for choice, mask in enumerate(_choices(max_bits)):
        free = [1 << b for b in range(64) if not mask >> b & 1]
        for n in range(max_bits - near + 1):
            out += [(choice, _signed(sum(flips)), n > near) for flips in combinations(free, n)]
    return out


def point_links(dense: DataFrame, max_bits: int) -> DataFrame:
    """``(u, v)`` within the keys of ``dense (choice, block, fp, id)``, by common points."""
    spark = dense.sparkSession
    # A fixed table: some 10,600 rows at three bits.
    flips = spark.createDataFrame(around(max_bits), "choice int, flip long, visitor boolean")
    points = dense.join(F.broadcast(flips), "choice").select("choice", "block", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "id", "visitor")
    key = ["choice", "block", "point"]
    hubs = points.filter("not visitor").groupBy(*key).agg(F.min("id").alias("hub"))
    met = points.join(hubs, key).filter("id <> hub")
    return met.select(F.least("id", "hub").alias("u"), F.greatest("id", "hub").alias("v")).distinct()


def close_links(nodes: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK, dense: int = DENSE) -> DataFrame:
    """``(u, v)``, u < v: links between nodes ``(fp, id)`` that connect all that lie within ``max_bits``.

    ``fp`` and ``id`` must be unique and not NULL. The links are a subset of the close pairs' closure.
    """
    spread = nodes.repartition(max(1, -(-nodes.count() // _TASK_ROWS)), "fp")  # each row becomes twenty
    keyed = spread.select(
        "fp", "id", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in _choices(max_bits)])).alias("choice", "block")
    )
    shared = keyed.groupBy("choice", "block").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(shared, "shared-blocks")
    crowded, shared = shared.filter(F.col("n") > dense), shared.filter(F.col("n") <= dense)
    pieces = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    meeting = F.explode(
        F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda other: F.struct(F.least("mine", other).alias("a"), F.greatest("mine", other).alias("b")))
    )
    dealt = (
        keyed.join(shared, ["choice", "block"])
        .withColumn("pieces", pieces)
        .withColumn("mine", mine)
        .withColumn("meeting", meeting)
        .groupBy("choice", "block", "meeting")
        .agg(F.collect_list("fp").alias("fps"), F.collect_list("id").alias("ids"))
        .filter(F.size("fps") > 1)
        .select("fps", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=4096):
            links = []
            for fps, ids in zip(part.column("fps"), part.column("ids")):
                fps, ids = fps.values.to_numpy().view(np.uint64), ids.values.to_numpy()
                if len(fps) == 2:
                    if int(fps[0] ^ fps[1]).bit_count() <= max_bits:
                        links.append((min(ids.tolist()), max(ids.tolist())))
                else:
                    links.extend(spanning_links(fps, ids, max_bits))
            u, v = zip(*set(links)) if links else ((), ())
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    links = dealt.mapInArrow(run, "u long, v long")
    if not crowded.isEmpty():
        links = links.unionByName(point_links(keyed.join(crowded.select("choice", "block"), ["choice", "block"]), max_bits))
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links (u, v)`` that isn't the least of its component.

    Rounds of two star steps: each node hands its greater neighbours, then its lesser ones, to
    the least neighbour it knows. Each round is written to the shared folder; the loop ends when a round changes nothing.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    links = stored(links.select("u", "v"), "links")
    before = state(links)
    while before[0]:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to"))
        large = both.join(least, "u").filter("v > u").select(F.col("to").alias("u"), "v").distinct()
        parent = large.groupBy("v").agg(F.min("u").alias("to"))
        moved = large.join(parent, "v")
        small = moved.select(F.col("to").alias("u"), "v").unionAll(moved.select(F.col("to").alias("u"), F.col("u").alias("v")))
        links = stored(small.filter("u <> v").distinct(), "links")
        after = state(links)
        if after == before:
            break
        before = after
    return links.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "id")


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` for every different fingerprint: the least fingerprint that chains of close ones reach.

    Nodes are fingerprints, not ids, since ids may repeat or be NULL.
    """
    nodes = stored(prints.select("fp").distinct(), "fingerprint-nodes")
    reached = components(close_links(nodes.select("fp", F.col("fp").alias("id")), max_bits))
    joined = nodes.join(reached.withColumnRenamed("id", "fp"), "fp", "left")
    return joined.select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: the least id that chains of close fingerprints reach."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    grouped = stored(_grouped(prints, max_bits), "fingerprint-roots")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("id")).join(grouped, "fp")
    found = least.groupBy("root").agg(F.min("id").alias("component_id"))
    labels = grouped.join(found, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One whole row of each component: the one with the least id (a NULL id last), then the least text hash.

    Of rows equal in both, one stays.
    """
    marked = docs.withColumn("_simhash_row", F.xxhash64(F.col(text_col).cast("string")))
    prints = stored(fingerprints(marked, id_col, text_col, shingle, also=("_simhash_row",)), "fingerprints")
    grouped = _grouped(prints, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("kept_id"), F.col("_simhash_row").alias("kept_row"))
    best = prints.groupBy("fp").agg(F.min(order).alias("best")).join(grouped, "fp").groupBy("root").agg(F.min("best").alias("best"))
    # One key of plain columns for the join and for what drops its repeated rows: the texts are shuffled once.
    key = ["_simhash_id", "_simhash_none", "_simhash_row"]
    keep = best.select(F.coalesce("best.kept_id", F.lit(0)), "best.none", "best.kept_row").toDF(*key)
    number = F.col(id_col).cast("long")
    here = marked.withColumns({key[0]: F.coalesce(number, F.lit(0)), key[1]: number.isNull()}).join(keep, key, "left_semi")
    copy = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    first = here.withColumn("_simhash_copy", copy).filter("_simhash_copy = 1")
    return first.select(*[F.col(f"`{c}`") for c in docs.columns])
