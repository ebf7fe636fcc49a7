"""The registered queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import (
    decontaminate,
    divergence,
    html_mincut,
    langid,
    line_rules,
    mixing,
    prefix_trie,
    pu_quality,
    secret_scan,
    sharding,
    simhash,
    token_store,
    warc,
)
from ebbline.llm.common import stored, table
from ebbline.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark, sf):
    """Every region of a document that holds a benchmark item within the edit budget."""
    return decontaminate.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def remainder(modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(-1))


@query
def op2_secret_scan(spark, sf):
    return secret_scan.secrets(table(spark, sf, "documents"))


@query
def op3_token_store(spark, sf):
    path = new_path(spark, "tokens")
    token_store.write(table(spark, sf, "documents"), path)
    return token_store.documents(token_store.read(spark, path))


@query
def op4_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_rules.clean(docs, texts=False)


SHARDS = 16


@query
def op6_sharding(spark, sf):
    docs = sharding.keyed(table(spark, sf, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    digest = stored(docs.select("doc_id", "size", crc, "_shard_h", "_shard_i"), "shard-keys")
    placed = sharding.place(digest, *sharding.layout(digest, SHARDS))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("held_out", remainder(3) == 1)
    model = langid.learn(docs.filter("not held_out"))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


@query
def op7_quality_classifier(spark, sf):
    fold = remainder(4) == 2
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", fold)
    labels = table(spark, sf, "labels").select("doc_id", "quality").filter(~fold)
    model = pu_quality.learn(docs.filter("not held_out"), labels)
    return pu_quality.score(docs, model, keep=("doc_id", "held_out"))


@query
def op8_html_extraction(spark, sf):
    return html_mincut.extract(table(spark, sf, "pages"))


@query
def op9_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op10_mixing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).withColumn("rate", F.round("rate", 9))


@query
def op11_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


@query
def op12_warc(spark, sf):
    path = new_path(spark, "warc")
    warc.write(table(spark, sf, "pages"), path)
    return warc.records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_prefix_trie(spark, sf):
    return prefix_trie.nodes(table(spark, sf, "conversations"))
