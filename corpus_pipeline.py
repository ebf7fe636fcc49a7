"""From documents to sharded training data: five stages, each a table of its own.

Operators see the columns that they need; the row's others are packed while one runs, so input columns named like an
operator's own come out as they went in. Missing, empty, very long and repeated rows are treated as each operator's module says;
an empty table passes through all stages.

A stage takes ``(spark, docs, sf_dir)`` and returns a frame. ``run`` writes each stage's result as Parquet to the
shared folder and hands the reread table to the next, so a lost executor costs at most part of one stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import decontaminate, line_rules, mixing, sharding, simhash
from ebbline.llm.common import stored, table
from ebbline.session import scratch

SHARDS = 16


def packed(docs: DataFrame, *needed: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The columns that an operator needs, beside all others but ``without`` as one."""
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in without]
    return docs.select(*needed, F.struct(*rest).alias("_row"))


def unpacked(result: DataFrame, docs: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    return result.select(*[(changed[c] if c in changed else F.col(f"_row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail; ``n_chars`` counts what is left."""
    passed = line_rules.clean(packed(docs, "text", without=("text",))).filter("kept")
    return unpacked(passed, docs, {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints: the one with the least id."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate draws them, in global random order."""
    return unpacked(mixing.mix(packed(docs, "doc_id", "source", "text", without=("text",))), docs, {"text": F.col("text")})


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its size, shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the stages wrote on the way is removed at the end, but the last table."""
    docs = table(spark, sf_dir, "documents")
    last = STAGES[-1][0]
    with scratch(spark, keep=(f"{last}-stage",)):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"{name}-stage")
    return docs


# Fingerprints need XXH64 and alignment needs a loop over cells, which SQL has not; tests hold ``run`` against brute force.
ORACLE_SQL = None
