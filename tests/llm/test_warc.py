import gzip
import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from ebbline.llm import warc
from tests.llm import edge

PAGE_SCHEMA = "page_id long, url string, html string"


def page_table(spark, rows):
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def plain(rows, least=warc.MIN_SHARED):
    """(page_id, bytes, digest, type, refers to) of each row, row by row."""
    seen, out = {}, Counter()
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        leader = seen.setdefault(digest, (page_id,)) if len(data) >= least else None
        first = leader is None or seen[digest] == (page_id,) and not out[digest]
        out[digest] += 1
        yield page_id, len(data), digest, "response" if first else "revisit", None if first else leader[0]


def found(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def some_pages():
    rng = np.random.default_rng(4)
    bodies = ["", "short", *[f"<p>{' '.join(map(str, rng.integers(0, 999, 60)))}</p>" for _ in range(40)]]
    rows = [(int(i), f"http://example.net/{i}?a=b c%41\r\n#é", bodies[int(rng.integers(0, len(bodies)))]) for i in rng.permutation(300)]
    return rows + [(5, "http://x.net", bodies[7]), (400, None, None), (401, "", bodies[3]), (None, "http://y.net", bodies[4]), (None, None, "only here " * 20)]


@pytest.mark.parametrize("options", [{}, {"part_bytes": 4000, "roll_bytes": 1500}, {"part_bytes": 20_000, "roll_bytes": 1}])
def test_types_digests_and_payloads(spark, tmp_path, options):
    rows, root = some_pages(), str(tmp_path / "archive")
    warc.write(page_table(spark, rows), root, **options)
    assert found(warc.records(spark, root)) == Counter(plain(rows))
    back = Counter((r.page_id, r.url, bytes(r.payload)) for r in warc.payloads(spark, root).collect())
    assert back == Counter((i, u, (h or "").encode()) for i, u, h in rows)
    files = warc.manifest(spark, root).orderBy("part", "seq").collect()
    assert sorted(f for f in os.listdir(root) if f.endswith(".gz")) == [f.name for f in files]
    assert not os.path.exists(f"{root}/_temporary")
    if options:
        assert len(files) > 5
        assert all(f.size <= max(options["roll_bytes"], 0) + 400 or f.records == 1 for f in files)
    with pytest.raises(FileExistsError):
        warc.write(page_table(spark, rows), root)


def test_records_stand_in_order_and_name_each_other(spark, tmp_path):
    root = str(tmp_path / "archive")
    warc.write(page_table(spark, some_pages()), root, part_bytes=5000, roll_bytes=3000)
    ids, records = [], {}
    for name in sorted(f for f in os.listdir(root) if f.endswith(".gz")):
        with open(f"{root}/{name}", "rb") as file:
            data = [warc.parse(m) for m in warc.members(iter([file.read()]))]
        assert data[0][0]["WARC-Type"] == "warcinfo" and data[0][0]["WARC-Filename"] == name
        assert b"".join(iter(lambda f=gzip.open(f"{root}/{name}"): f.read(1 << 16), b"")).startswith(b"WARC/1.1\r\n")
        for fields, _ in data[1:]:
            ids.append(int(fields.get("X-Page-Id", -1)))
            assert fields["WARC-Record-ID"] not in records
            records[fields["WARC-Record-ID"]] = fields
    assert ids == sorted(ids)
    for fields in records.values():
        if fields["WARC-Type"] == "revisit":
            response = records[fields["WARC-Refers-To"]]
            assert response["WARC-Type"] == "response" and response["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert response.get("WARC-Target-URI") == fields.get("WARC-Refers-To-Target-URI")


def test_equal_tables_give_equal_files(spark, tmp_path):
    rows = some_pages()
    for name, table in (("a", page_table(spark, rows).coalesce(1)), ("b", page_table(spark, rows[::-1]).repartition(7))):
        warc.write(table, str(tmp_path / name), part_bytes=4000, roll_bytes=2000)
    names = sorted(f for f in os.listdir(tmp_path / "a") if f.endswith(".gz"))
    assert names == sorted(f for f in os.listdir(tmp_path / "b") if f.endswith(".gz")) and len(names) > 3
    for name in names:
        assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()


def test_leftovers_are_not_read_and_damage_is_found(spark, tmp_path):
    rows, root = some_pages(), tmp_path / "archive"
    warc.write(page_table(spark, rows), str(root))
    (root / "pages-00009-00000.warc.gz").write_bytes(b"of a lost attempt")
    assert found(warc.records(spark, str(root))) == Counter(plain(rows))
    name = root / warc.manifest(spark, str(root)).first().name
    data = name.read_bytes()
    other = warc._member(warc.page_record(1, None, hashlib.sha256(b"x").hexdigest(), b"x", 1, warc.DATE))
    for damaged in (data[:-20], data + other, data[:200] + bytes([data[200] ^ 1]) + data[201:]):
        name.write_bytes(damaged)
        with pytest.raises(Exception):
            warc.records(spark, str(root)).collect()


def test_members_in_pieces_of_any_size():
    data = [b"one" * 100, b"", b"two", b"three" * 1000]
    stream = b"".join(map(warc._member, data))
    for size in (1, 2, 7, 64, len(stream)):
        assert list(warc.members(stream[i : i + size] for i in range(0, len(stream), size))) == data
    with pytest.raises(ValueError):
        list(warc.members([stream[:-1]]))


def test_ranges_follow_the_keys():
    rng = np.random.default_rng(1)
    places, ties = rng.integers(0, 20, 500), rng.integers(-50, 50, 500)
    cuts = sorted({(int(p), int(t)) for p, t in zip(rng.integers(0, 20, 30), rng.integers(-50, 50, 30))})
    parts = warc.part_of(places, ties, np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts]))
    assert parts.tolist() == [sum(c <= (p, t) for c in cuts) for p, t in zip(places.tolist(), ties.tolist())]


def test_a_join_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    rows = some_pages()
    monkeypatch.setattr(warc, "is_small", lambda ids: False)
    warc.write(page_table(spark, rows), str(tmp_path / "archive"), part_bytes=4000)
    assert found(warc.records(spark, str(tmp_path / "archive"))) == Counter(plain(rows))


def test_edge_rows(spark, tmp_path):
    rows = [(1, "u", edge.LONG), (1, "u", edge.LONG), (1, "u", edge.LONG), (2, "v", edge.LONG), (None, None, None), (None, None, None), (3, "\u0000\n☃", ""),
            (None, "z", edge.LONG + "x"), (None, "a", edge.LONG + "x")]
    clashing = page_table(spark, rows).selectExpr("*", *[f"7 as {c}" for c in edge.CLASHING if c != "html"], "8 as digest", "9 as tie", "1 as place", "2 as leader")
    for i, table in enumerate((page_table(spark, rows), clashing)):
        root = str(tmp_path / f"archive-{i}")
        warc.write(table, root)
        assert found(warc.records(spark, root)) == Counter(plain(rows))
        assert Counter((r.page_id, r.url) for r in warc.records(spark, root).collect()) == Counter(r[:2] for r in rows)
    warc.write(page_table(spark, []), str(tmp_path / "none"))
    assert warc.records(spark, str(tmp_path / "none")).count() == 0


def test_a_large_range_is_parted(spark, tmp_path):
    """A third of the rows has no id; they are spread by address and payload."""
    rows = [(None if i % 3 == 0 else i, f"u{i}", f"body {i} " * 30) for i in range(900)]
    root = str(tmp_path / "archive")
    warc.write(page_table(spark, rows), root, part_bytes=20_000)
    sizes = [r.records for r in warc.manifest(spark, root).collect()]
    assert sum(sizes) == 900 and len(sizes) >= 10 and max(sizes) < 200
