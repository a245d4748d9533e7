"""The operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.llm import (
    bpe, chat_tokens, collocations, licenses, line_templates, mixing, quality_classifier, quality_rules, simhash,
    surrogates, vector_codes, vector_file, warc,
)
from paperweave.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark, folder):
    """Every document's measures and verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", *[F.col(c) for c in quality_rules.BASE], "base_failed", "kept",
        F.array_join("broken", ", ").alias("broken"))


@query
def op2_mixing(spark, folder):
    """Every document's place in the mix of its sources."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs).withColumnRenamed("id", "doc_id")


@query
def op3_licenses(spark, folder):
    """Every document's license phrases and notices."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).withColumnRenamed("id", "doc_id")


@query
def op4_bpe(spark, folder):
    """Every document encoded and decoded again."""
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query
def op7_simhash(spark, folder):
    """Every document's fingerprint and near-duplicate group."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), simhash.hex_digits("fp").alias("fingerprint"),
        F.col("component").alias("component_id"))


@query
def op9_warc(spark, folder):
    """Pages written as deduplicated archives, read back and resolved."""
    pages = warc.resolved(warc.with_digests(table(spark, folder, "pages")))
    path = new_path(spark, "warc")
    warc.write_archives(pages, path)
    return warc.resolve_revisits(warc.read_archives(spark, path)).drop("url")


@query
def op10_line_templates(spark, folder):
    """Every document without the lines that recur in others."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_lines(docs, count="n_dropped")


@query
def op5_surrogates(spark, folder):
    """Every document with surrogates for personal data."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, count="n_entities")


@query
def op6_quality_classifier(spark, folder):
    """Every document's score by a model learned from the labels outside the held-out third."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, folder, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), quality_classifier.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_vector_file(spark, folder):
    """The five nearest of every fiftieth vector."""
    found = vector_file.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query
def op11_collocations(spark, folder):
    """Each language's best phrases of two to four words."""
    return collocations.top_collocations(table(spark, folder, "documents").select("lang", "text"))


@query
def op12_vector_codes(spark, folder):
    """Every vector's code, its error and the codebooks' digest."""
    coded = vector_codes.compress(table(spark, folder, "embeddings"))
    return coded.withColumnRenamed("id", "vec_id").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op13_chat_tokens(spark, folder):
    """All conversations as tokens with a loss mask, read back and digested."""
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    formatted = chat_tokens.format_turns(rows, vocabulary, public_tokenizers.PATTERN)
    return chat_tokens.conversation_digests(chat_tokens.read_turns(formatted, vocabulary, public_tokenizers.PATTERN))
