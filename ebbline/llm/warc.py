"""Web archives: pages as WARC records in rolled files, written by ranges and committed by a manifest.

- *Order.* Records stand in order of page id, then of a hash of address and digest. Splitters come from a sample whose
  members are drawn by hash with odds in proportion to their size, so equal tables give equal files, on any cluster.
  Rows without an id are ordered by that hash alone and spread like others.
- *Copies.* Equal payloads of ``MIN_SHARED`` bytes or more are stored once: the row of least id (address, where ids tie) is the
  response, the others are revisits that name it. That is settled on digests; a revisit's payload isn't even shuffled.
- *Files.* A task writes one range. Each record is a gzip member of its own; a file is closed before the member that would carry
  it beyond ``roll_bytes`` (a larger record has a file to itself) and opens with a ``warcinfo`` record. Headers are made anew:
  record ids from id, address and digest, SHA-256 of block and payload, lengths.
- *Commit.* Tasks write under temporary names that no other attempt shares. When all have ended, a second job gives the files
  their names and its result is the manifest; both steps can be repeated. A reader goes by the manifest only, so it sees a whole
  archive or none, and what lost attempts left is never read. Files go through Arrow's file systems, to any folder all reach.
- *Reading* takes a file in pieces, a record at a time, and checks the file against the manifest and every digest.

What the driver sees: two sums and a sample of some ``SAMPLES`` pairs of numbers for each of at most ``MAX_PARTS`` ranges. Digests with several
rows are broadcast if there are few of them, else joined.

Defined results: html NULL counts as empty; rows without an id or address keep them missing, and are the last choice as
response; of equal rows (id, address and payload) the first is the response and the others revisit it, in one range; the
address is kept whatever its characters; a long page is one record; an empty table gives an empty manifest; extra columns
are ignored. One row repeated many times stays in one range, in order, but is streamed.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote_to_bytes

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import slices, stored
from ebbline.operators.membership import is_small

MIN_SHARED = 100
PART_BYTES = 32 << 20
ROLL_BYTES = 128 << 20
MAX_PARTS = 16_384
SAMPLES = 64
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
_LEAST = -(1 << 63)
_PIECE = 1 << 20

MANIFEST_SCHEMA = "part int, seq int, name string, records long, size long, sha256 string"
RECORD_SCHEMA = (
    "page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, refers_to_record string, payload binary"
)

# --- records -----------------------------------------------------------------


def record_id(page_id: int | None, url: str | None, digest: str, copy: int = 0) -> str:
    """A name that follows from the row and the number of equal rows before it."""
    seed = f"{'' if page_id is None else page_id}\n{digest}\n{copy}\n{'' if url is None else url}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(seed.encode('utf-8', 'surrogatepass')).digest()[:16], version=5)}>"


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    digest = hashlib.sha256(block).hexdigest()
    return f"WARC/1.1\r\n{head}WARC-Block-Digest: sha256:{digest}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time
    return packer.compress(data) + packer.flush()


def info_record(name: str, date: str) -> bytes:
    body = b"software: ebbline\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name, "")), ("WARC-Date", date), ("WARC-Filename", name),
              ("Content-Type", "application/warc-fields")]
    return _record(fields, body)


def page_record(page_id: int | None, url: str | None, digest: str, payload: bytes | None, n_bytes: int, date: str,
                leader: tuple[int | None, str | None] | None = None, copy: int = 0) -> bytes:
    """A response with its payload, or a revisit of ``leader`` (id, address) with the response's header alone."""
    # Control characters, blanks and per cent signs of an address would break its line or its reading.
    address = [None if u is None else quote(u.encode("utf-8", "surrogatepass"), safe="!#$&'()*+,/:;=?@[]~") for u in (url, leader[1] if leader else None)]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if leader else "response"), ("WARC-Record-ID", record_id(page_id, url, digest, copy)), ("WARC-Date", date),
        ("WARC-Target-URI", address[0]), ("X-Page-Id", None if page_id is None else str(page_id)),
    ]
    if leader:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(*leader, digest)),
            ("WARC-Refers-To-Target-URI", address[1]), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-Id", None if leader[0] is None else str(leader[0])),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    return _record(fields, head if leader else head + payload)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; its block digest is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


# --- files -------------------------------------------------------------------


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


class Roller:
    """Files of one range, under temporary names, and their rows of the manifest."""

    def __init__(self, root: str, part: int, roll_bytes: int, date: str):
        self.fs, self.root = file_system(root)
        self.part, self.roll, self.date = part, roll_bytes, date
        self.attempt, self.seq, self.file, self.done = uuid.uuid4().hex, 0, None, []

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.digest.update(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        member = _member(record)
        if self.file is not None and self.records and self.size + len(member) > self.roll:
            self.close()
        if self.file is None:
            name = f"pages-{self.part:05d}-{self.seq:05d}.warc.gz"
            self.temporary = f"{name}.{self.attempt}"
            self.name, self.records, self.size, self.digest = name, 0, 0, hashlib.sha256()
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.file = self.fs.open_output_stream(f"{self.root}/_temporary/{self.temporary}", compression=None)
            self._write(_member(info_record(name, self.date)))
        self._write(member)
        self.records += 1

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.part, self.seq, self.name, self.records, self.size, self.digest.hexdigest(), self.temporary))
            self.file, self.seq = None, self.seq + 1


def _rows(found: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["part", "seq", "name", "records", "size", "sha256", "temporary"]
    columns = list(zip(*found)) or [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)


# --- writing -----------------------------------------------------------------


def _splitters(keys: DataFrame, total: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries between ranges of about equal size, from a sample drawn by hash with odds by size."""
    draw = (F.pmod(F.xxhash64("place", "tie", F.lit("splitters")), F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52)
    reach = SAMPLES * parts / max(total, 1)
    if parts == 1:
        return np.array([], np.int64), np.array([], np.int64)
    drawn = keys.filter(draw < 1 - F.exp(-F.lit(reach) * (F.col("n_bytes") + 1))).select("place", "tie").toArrow()
    places, ties = (drawn.column(c).to_numpy() for c in ("place", "tie"))
    order = np.lexsort((ties, places))
    cuts = order[[len(order) * i // parts for i in range(1, parts)]] if len(order) else order
    return places[cuts], ties[cuts]


def part_of(places: np.ndarray, ties: np.ndarray, cut_places: np.ndarray, cut_ties: np.ndarray) -> np.ndarray:
    """How many boundaries stand at or before each key."""
    low, high = np.searchsorted(cut_places, places, "left"), np.searchsorted(cut_places, places, "right")
    for i in np.flatnonzero(low < high):
        high[i] = low[i] + np.searchsorted(cut_ties[low[i] : high[i]], ties[i], "right")
    return high.astype(np.int32)


def write(pages: DataFrame, root: str, min_shared: int = MIN_SHARED, part_bytes: int = PART_BYTES, roll_bytes: int = ROLL_BYTES,
          date: str = DATE) -> None:
    """Write the archive into the folder ``root``, which must not hold one yet."""
    fs, folder = file_system(root)
    if fs.get_file_info(f"{folder}/manifest").type != pyarrow.fs.FileType.NotFound:
        raise FileExistsError(f"{root} holds an archive")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    pages = pages.select("*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("n_bytes"))
    pages = pages.withColumns({"place": F.coalesce("page_id", F.lit(_LEAST)), "tie": F.xxhash64("url", "digest")})
    keys = stored(pages.drop("html"), "warc-keys")

    first = F.min(F.struct(F.isnull("page_id").alias("no_id"), "page_id", F.isnull("url").alias("no_url"), "url")).alias("leader")
    shared = keys.filter(F.col("n_bytes") >= min_shared).groupBy("digest").agg(first, F.count("*").alias("n")).filter("n > 1")
    shared = stored(shared.select("digest", F.struct("leader.page_id", "leader.url").alias("leader")), "warc-shared")
    leads = F.col("leader").isNull() | (F.col("page_id").eqNullSafe(F.col("leader.page_id")) & F.col("url").eqNullSafe(F.col("leader.url")))
    rows = pages.join(F.broadcast(shared) if is_small(shared) else shared, "digest", "left")
    rows = rows.withColumn("revisits", ~leads).withColumn("html", F.when(leads, F.col("html")))

    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, min(MAX_PARTS, -(-total // part_bytes)))
    cut_places, cut_ties = _splitters(keys, total, parts)

    @F.pandas_udf("int")
    def part(places: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(part_of(places.to_numpy(), ties.to_numpy(), cut_places, cut_ties))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, before, copy = None, None, 0
        for batch in slices(batches):
            for row in batch.to_pylist():
                if roller is None:
                    roller = Roller(root, row["part"], roll_bytes, date)
                key = (row["page_id"], row["url"], row["digest"])
                before, copy = key, copy + 1 if key == before else 0
                leader = None
                if row["revisits"]:
                    leader = (row["leader"]["page_id"], row["leader"]["url"])
                elif copy and row["n_bytes"] >= min_shared:
                    leader = key[:2]
                roller.add(page_record(*key, row["html"], row["n_bytes"], date, leader, copy))
        if roller is not None:
            roller.close()
            yield _rows(roller.done)

    dealt = rows.withColumn("part", part("place", "tie")).repartitionById(len(cut_places) + 1, "part")
    ordered = dealt.sortWithinPartitions("place", "tie", "url").select("part", "page_id", "url", "digest", "html", "n_bytes", "revisits", "leader")
    written = stored(ordered.mapInArrow(run, f"{MANIFEST_SCHEMA}, temporary string"), "warc-written")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        for batch in batches:
            for row in batch.to_pylist():
                target, info = f"{folder}/{row['name']}", fs.get_file_info(f"{folder}/{row['name']}")
                if info.type == pyarrow.fs.FileType.NotFound or info.size != row["size"]:
                    fs.move(f"{folder}/_temporary/{row['temporary']}", target)
            yield batch.select(["part", "seq", "name", "records", "size", "sha256"])

    fs.create_dir(folder, recursive=True)
    written.mapInArrow(name, MANIFEST_SCHEMA).write.parquet(f"{root}/manifest")
    if fs.get_file_info(f"{folder}/_temporary").type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(f"{folder}/_temporary")


# --- reading -----------------------------------------------------------------


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest")


def members(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpack, found = zlib.decompressobj(31), []
    for piece in pieces:
        while piece:
            found.append(unpack.decompress(piece))
            piece = unpack.unused_data
            if unpack.eof:
                yield b"".join(found)
                unpack, found = zlib.decompressobj(31), []
    if any(found):
        raise ValueError("a member without its end")


def _page(fields: dict[str, str], block: bytes, payload: bool) -> tuple:
    """A row of ``RECORD_SCHEMA``."""
    head, _, body = block.partition(b"\r\n\r\n")
    lengths = [line.split(b":", 1)[1] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest, revisits = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "revisit"
    if not revisits and (hashlib.sha256(body).hexdigest() != digest or len(body) != int(lengths[0])):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    page_id, target = (None if fields.get(f) is None else int(fields[f]) for f in ("X-Page-Id", "X-Refers-To-Page-Id"))
    return (page_id, None if url is None else unquote_to_bytes(url).decode("utf-8", "surrogatepass"), fields["WARC-Record-ID"], fields["WARC-Type"],
            int(lengths[0]), digest, target, fields.get("WARC-Refers-To"), body if payload and not revisits else None)


def records(spark: SparkSession, root: str, payload: bool = False) -> DataFrame:
    """One row for each page, with the payloads of responses if wanted."""
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        rows, size = [], 0

        def flushed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for entry in batch.to_pylist():
                digest, n = hashlib.sha256(), 0

                def pieces(path=f"{folder}/{entry['name']}", digest=digest):
                    with fs.open_input_stream(path, compression=None) as file:
                        while piece := file.read(_PIECE):
                            digest.update(piece)
                            yield piece

                for data in members(pieces()):
                    fields, block = parse(data)
                    if fields["WARC-Type"] != "warcinfo":
                        rows.append(_page(fields, block, payload))
                        n += 1
                        size += len(block) if payload else 0
                        if len(rows) >= 4096 or size > 8 << 20:
                            yield flushed()
                            rows, size = [], 0
                if digest.hexdigest() != entry["sha256"] or n != entry["records"]:
                    raise ValueError(f"{entry['name']} is not the file of the manifest")
        if rows:
            yield flushed()

    files = manifest(spark, root)
    parts = (files.agg(F.max("part")).first()[0] or 0) + 1
    return files.repartitionById(parts, "part").sortWithinPartitions("seq").mapInArrow(run, RECORD_SCHEMA)


def payloads(spark: SparkSession, root: str) -> DataFrame:
    """``(page_id, url, payload)`` with revisits resolved to the payload of the response that they name."""
    found = records(spark, root, payload=True)
    whole = found.filter("record_type = 'response'")
    revisits = found.filter("record_type = 'revisit'").drop("payload").join(
        whole.select(F.col("record_id").alias("refers_to_record"), "payload"), "refers_to_record"
    )
    return whole.select("page_id", "url", "payload").unionByName(revisits.select("page_id", "url", "payload"))
