import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbline.llm import token_store as ts
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**32 - 1], list(range(3000)), [7] * 1025])
def test_codes_round_trip_and_random_access(ids):
    codes = ts.Codes(ts.pack(np.array(ids, np.uint32)))
    assert len(codes) == len(ids) and codes.run(0, len(ids)).tolist() == ids
    assert [codes[i] for i in range(len(ids))] == ids
    for a in range(0, len(ids), 97):
        assert codes.run(a, min(len(ids), a + 130)).tolist() == ids[a : a + 130]


def test_codes_of_random_ids():
    rng = np.random.default_rng(3)
    ids = (rng.integers(0, 2**32, 20_000) >> rng.integers(0, 32, 20_000)).astype(np.uint32)
    codes = ts.Codes(ts.pack(ids))
    for a, b in rng.integers(0, 20_000, (200, 2)):
        assert (codes.run(min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()


def test_pieces_give_the_ids_of_whole_texts(tokenizer, spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    odd = [
        "it's we'll I'd don't.x 'tis ''s", "a.b,c..d ,.e 3.5,6 x². y", "  two  blanks \n\n and\tlines \r\n", "tail ", " .x ,y", "\x1c\x1d a\x85b\xa0c d　e",
        "<|endoftext|> in.<|endoftext|>,it", "漢字。かな, é.è ñ,ß. Ω.α", "𝒳𝒴 🙂.🙂", "İ. ǅ. ªº.½.", "x" * 5000 + ".", "", "\n", " ", "...", "a​b.﻿", "'s.'s",
    ]
    found = ts.Encoder(PATH).encode([*texts, *odd, edge.LONG])
    for text, ids in zip([*texts, *odd, edge.LONG], found):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


def test_any_text_by_characters(tokenizer):
    rng = np.random.default_rng(5)
    alphabet = list("ab Z.,'s\n\t  09!$é漢²") + [" ", "\xa0", "\x1f", "ll", "'re", "🙂"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(3000)]
    encoder = ts.Encoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_encode_whole_texts():
    other = ts.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.in_pieces
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert np.frombuffer(other.encode(["Some Words, here."])[0], "<u4").tolist() == plain.encode("Some Words, here.", add_special_tokens=False).ids


def stored(spark, docs, tmp_path, **options):
    path = str(tmp_path / "tokens")
    ts.write(docs, path, **options)
    return ts.read(spark, path)


def test_store_of_the_given_table(spark, sf_dir, tmp_path, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = stored(spark, docs, tmp_path, segment_tokens=5000)
    assert store.count() > 10
    found = {r.doc_id: r for r in ts.documents(store).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
        own = found.pop(r.doc_id)
        assert (own.start, own.n_tokens, own.ids_crc32, own.first_id) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids[0])
        start += len(ids)
    assert not found
    two = {r.doc_id: r.ids for r in ts.lookup(store, [3, 150], first=2, n=5).collect()}
    for r in docs.filter(F.col("doc_id").isin(3, 150)).collect():
        assert two[r.doc_id] == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2][2:7]


def test_edge_rows(spark, tmp_path, tokenizer):
    store = stored(spark, edge.clashing(spark), tmp_path, segment_tokens=50)
    rows = sorted(ts.documents(store).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert stored(spark, edge.empty(spark), tmp_path / "none").count() == 0
    assert ts.documents(ts.read(spark, str(tmp_path / "none" / "tokens"))).count() == 0
