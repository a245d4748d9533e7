"""From raw documents to token ids: every stage takes the rows that the one before it kept.

Stages are written as Parquet and read again, so a lost executor costs a retry
of one stage at most and no lineage spans two of them.
"""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paperweave.llm import bpe, line_templates, mixing, quality_rules, simhash  # noqa: E402
from paperweave.workspace import stage  # noqa: E402

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Target weights of the mix: an equal share for every source, whatever its size. Sources not named weigh as the smallest.
WEIGHTS = {f"src{i}": 1.0 for i in range(20)}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stay in an earlier one; those with nothing left go."""
    return line_templates.without_emptied(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) link at three bits or fewer."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix by the target weights."""
    return mixing.in_mixed_order(docs, weights=WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with their digests and ``mix_pos``, the document's place in the mix.

    Files keep no order between stages, so the places are worked out again: they
    depend on ids, sources and weights only. Rows without an id share out the
    places of their source's rows without one.
    """
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))
    places = stage(mixing.mix(docs, weights=WEIGHTS).select("id", "source", "mix_pos"), "mix-places")
    turn = F.row_number().over(Window.partitionBy("source").orderBy("mix_pos"))
    text_turn = F.row_number().over(Window.partitionBy("source").orderBy("text"))
    nameless = docs.filter("doc_id is null").withColumn("turn", text_turn).select(
        F.struct(F.col("source"), F.col("turn")).alias("key"), "text")

    def encoded(rows: DataFrame, id_column: str) -> DataFrame:
        return bpe.encode(rows, vocabulary, public_tokenizers.PATTERN, id_column, with_ids=True)

    named = encoded(docs.filter("doc_id is not null"), "doc_id").join(
        places.filter("id is not null").groupBy("id").agg(F.min("mix_pos").alias("mix_pos")).hint("merge"), "id")
    rest = encoded(nameless, "key").join(places.filter("id is null").withColumn("turn", turn).select(
        "mix_pos", F.struct(F.col("source"), F.col("turn")).alias("key")).withColumnRenamed("key", "place"),
        F.col("id").eqNullSafe(F.col("place"))).drop("place").withColumn("id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    return named.unionByName(rest).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]
# Fingerprints and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
