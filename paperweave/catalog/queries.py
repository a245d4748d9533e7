"""Every operator as a query over the given tables.

A query takes (spark, folder of Parquet tables) and gives a DataFrame with plain
column types, so that its values can be compared with those of the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.functions import naming, text, vectors
from paperweave.functions.tokens import token_count as count_tokens, tokenizer_count
from paperweave.operators import collection, dedup, digests, order, pivots, realign, requests, search, state
from paperweave.plans import clean as clean_job, load as load_job, monitor, prepare as prepare_job
from paperweave.sources import collections, landing, papers as paper_source, state_tables, vectors as vector_store
from paperweave.sources.lines import read_result_lines
from paperweave.streaming import ingest, status as status_stream
from paperweave.workspace import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MODEL = "Qwen/Qwen3-Embedding-8B"
TOKEN_CAP, BATCH_REQUESTS, FILE_BYTES = 4_000, 10, 60_000
TEXTS_PER_RESULT, CHUNK, TOP, ROUNDS = 7, 100, 10, 7
ALLOWED = ["en", "fr", "src3", "src7"]
WORDS = ["small", "widget", "blue"]
EVENT_STATUS = {"view": "in_progress", "click": "finalizing", "purchase": "completed",
                "signup": "validating", "error": "failed"}


def vector_md5(vector: str) -> Column:
    """Digest of a whole vector, each value to six places."""
    parts = F.transform(vector, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return F.md5(F.array_join(parts, ","))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(column: str, values: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)[F.col(column)]


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("row_idx"), "text")


# --- cleaning ---------------------------------------------------------------

@query
def clean_corpus(spark, folder):
    """Filter by category, keep the first of equal texts, tidy the text."""
    docs = table(spark, folder, "documents")
    kept = docs.withColumn("parsed", text.split_words(F.concat_ws(" ", "lang", "source"))).filter(
        text.overlaps(F.col("parsed"), ALLOWED))
    first = dedup.keep_first_text(kept, "text", ["doc_id"])
    return first.select(
        "doc_id", "lang", "source", F.array_join("parsed", ",").alias("categories"),
        text.collapse_spaces(F.col("text")).alias("clean_text"))


@query
def clean_papers_job(spark, folder):
    """The cleaning job on NDJSON written from the documents, two rows per paper id."""
    docs = table(spark, folder, "documents")
    start = F.lit("2007-04-02 19:18:42").cast("timestamp_ntz")
    created = F.date_format(start + F.make_dt_interval(hours=F.col("doc_id").cast("int")),
                            "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    raw = docs.select(
        "doc_id",
        F.call_function("div", F.col("doc_id"), F.lit(2)).cast("string").alias("id"),
        F.concat(F.lit(" "), "source", F.lit("\n \t"), "lang").alias("title"),
        F.col("text").alias("abstract"),
        F.concat_ws(" ", F.lit("math.CO"), F.when(F.col("lang") == "en", "cs.CL"), "source").alias("categories"),
        F.array(F.struct(F.lit("v1").alias("version"), F.lit("not read").alias("created")),
                F.struct(F.lit("v2").alias("version"), created.alias("created"))).alias("versions"),
        F.array(F.array("source", "lang", F.lit("")), F.array("lang", F.lit("Jr"))).alias("authors_parsed"))
    path = new_path(spark, "raw")
    raw.repartitionByRange("doc_id").sortWithinPartitions("doc_id").drop("doc_id").write.json(path)
    done = clean_job.run(spark, path, f"{new_path(spark, 'clean')}.parquet")
    return paper_source.read_papers(spark, done).select(
        "row_idx", "id", "title", "abstract", F.array_join("authors_parsed", "|").alias("authors"),
        F.array_join("categories_parsed", ",").alias("categories"), "license",
        F.col("last_submitted").cast("string").alias("last_submitted"))


@query
def ws_normalize(spark, folder):
    return _texts(spark, folder).select(
        F.col("row_idx").alias("doc_id"), text.collapse_spaces(F.col("text")).alias("clean_text"))


@query
def category_filter(spark, folder):
    parts = table(spark, folder, "part").withColumn("parsed", text.split_words(F.col("p_name")))
    return parts.filter(text.overlaps(F.col("parsed"), WORDS)).select(
        "p_partkey", "p_name", F.size("parsed").cast("bigint").alias("n_categories"))


@query
def category_intersection(spark, folder):
    common = text.common_items(text.split_words(F.col("p_name")), WORDS)
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(F.array_sort(common), ",").alias("common"),
        F.size(common).cast("bigint").alias("n_common"))


@query
def dedupe_keep_first(spark, folder):
    docs = table(spark, folder, "documents")
    return dedup.keep_first_text(docs, "text", ["doc_id"], ["doc_id", "lang", "source", "n_chars"])


@query
def name_reverse_join(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", text.reversed_name(F.split("c_name", "#")).alias("display_name"))


@query
def last_version(spark, folder):
    """Last line of every order, by a unique tuple."""
    columns = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = table(spark, folder, "lineitem").select("l_orderkey", *columns)
    return state.latest_per_key(lines, ["l_orderkey"], columns).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey",
        "l_suppkey", F.col("l_shipdate").cast("string").alias("l_shipdate"))


@query
def last_item(spark, folder):
    """Last word of the part name and of an empty list."""
    words = text.split_words(F.col("p_name"))
    return table(spark, folder, "part").select(
        "p_partkey", text.last_item(words).alias("last_word"),
        text.last_item(F.filter(words, lambda w: w == "ring")).alias("last_ring"))


@query
def parse_http_date(spark, folder):
    sent = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss 'GMT'").alias("http_date"))
    return sent.select("o_orderkey", "http_date",
                       text.parse_http_date(F.col("http_date")).cast("string").alias("submitted"))


@query
def json_fixed_schema(spark, folder):
    parsed = F.from_json("props", "k bigint, absent string", {"mode": "FAILFAST"})
    return table(spark, folder, "events").select(
        "event_id", parsed["k"].alias("k"), parsed["absent"].alias("absent"))


# --- texts, tokens, order -----------------------------------------------------

@query
def concat_fields(spark, folder):
    joined = text.concat_fields(F.nullif(F.col("lang"), F.lit("en")), F.col("text"))
    return table(spark, folder, "documents").select("doc_id", joined.alias("joined"))


@query
def token_count(spark, folder):
    return _texts(spark, folder).select(
        F.col("row_idx").alias("doc_id"), count_tokens(F.col("text")).alias("token_count"))


@query
def tokenizer_udf(spark, folder):
    """A plugged-in tokenizer, here plain splitting at white space."""
    count = tokenizer_count(lambda: str.split)
    return _texts(spark, folder).select(F.col("row_idx").alias("doc_id"), count(F.col("text")).alias("n_words"))


@query
def token_stats(spark, folder):
    docs = table(spark, folder, "documents").select("lang", count_tokens(F.col("text")).alias("n"))
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_tokens"),
        F.min("n").alias("least"), F.max("n").alias("most"))


@query
def row_index(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "doc_id")
    return order.dense_row_index(docs, ["lang", "doc_id"])


@query
def payload_slice(spark, folder):
    """The middle half of the numbered documents."""
    docs = table(spark, folder, "documents").select("lang", "doc_id", "source")
    # Stored, so that the slice prunes the scan by the numbers' ranges.
    numbered = stage(order.dense_row_index(docs, ["lang", "doc_id"]), "numbered")
    n = docs.count()
    return order.row_slice(numbered, "row_idx", n // 4, n // 2)


# --- requests ---------------------------------------------------------------

def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    weights = requests.weigh_texts(_texts(spark, folder))
    return requests.request_rows(weights, 1, TOKEN_CAP, BATCH_REQUESTS)


@query
def pack_requests(spark, folder):
    return _manifest(spark, folder).select(
        "row_idx", "token_count", "request_id", F.col("pos").cast("bigint").alias("pos"))


@query
def request_manifest(spark, folder):
    return requests.request_totals(_manifest(spark, folder), MODEL)


@query
def batch_totals(spark, folder):
    return requests.batch_totals(requests.request_totals(_manifest(spark, folder), MODEL))


@query
def request_lines(spark, folder):
    """Every request's line, with its place in the rolled files."""
    manifest = stage(_manifest(spark, folder), "manifest")
    rolled = requests.roll_files(requests.request_totals(manifest, MODEL), FILE_BYTES)
    lines = requests.request_lines(_texts(spark, folder), manifest, rolled, MODEL)
    return lines.select(
        "request_id", "custom_id", "file_no", F.md5("line").alias("line_md5"),
        (F.octet_length("line") + 1).cast("bigint").alias("line_bytes"))


@query
def roll_files(spark, folder):
    return requests.roll_files(requests.request_totals(_manifest(spark, folder), MODEL), FILE_BYTES)


@query
def file_totals(spark, folder):
    rolled = requests.roll_files(requests.request_totals(_manifest(spark, folder), MODEL), FILE_BYTES)
    return requests.file_totals(rolled, MODEL)


@query
def request_files(spark, folder):
    """The prepare job's files, read back."""
    limits = prepare_job.Limits(TOKEN_CAP, BATCH_REQUESTS, FILE_BYTES)
    path = new_path(spark, "job")
    prepare_job.run(_texts(spark, folder), "text", MODEL, 1, path, limits)
    lines = landing.read_landed(spark, f"{path}/files")
    part = {c: F.regexp_extract("file_name", r"-(\d+)-batch-(\d+)(?:_(\d+))?", n) for n, c in enumerate(requests.FILE_KEYS, 1)}
    return lines.groupBy(*[F.coalesce(F.nullif(x, F.lit("")), F.lit("0")).cast("bigint").alias(c) for c, x in part.items()]).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("value") + 1).alias("n_bytes"))


@query
def landed_files(spark, folder):
    """The prepare job's files under their names, and the result files found from the stored batches."""
    limits = prepare_job.Limits(TOKEN_CAP, BATCH_REQUESTS, FILE_BYTES)
    path, root = new_path(spark, "job"), new_path(spark, "state")
    state_tables.recreate_state(spark, root)
    job, made = prepare_job.run_new_job(_texts(spark, folder), "text", MODEL, root, path, limits)
    fixed = {"status": "completed", "completion_window": "24h", "endpoint": requests.ENDPOINT, "object": "batch"}
    created = made.files.select("job_id", F.col("path").alias("local_file_id"), F.to_json(F.struct(
        F.concat(F.lit("oa-"), "file_name").alias("id"), F.concat(F.lit("in-"), "file_name").alias("input_file_id"),
        F.lit(1704067200).alias("created_at"), *[F.lit(v).alias(k) for k, v in fixed.items()])).alias("raw"))
    monitor.register_batches(created, root)
    batches = state_tables.read_state(spark, root, "batches")
    # The service answers every second request of a file.
    sent = landing.read_landed(spark, f"{path}/{job:04}/files")
    number = F.regexp_extract("value", r"request-(\d+)", 1).cast("bigint")
    answers = sent.filter(number % 2 == 0).select(
        F.regexp_replace("file_name", r"\.jsonl$", "_result.jsonl").alias("file_name"), number.alias("n"), F.col("value").alias("line"))
    landing.land_lines(answers.repartition("file_name"), f"{path}/results", "n")
    results = landing.result_lines(spark, batches, f"{path}/results").groupBy(
        F.substring_index("source_file", "/", -1).alias("result_name")).agg(F.count(F.lit(1)).alias("n_results"))
    named = batches.select(
        F.substring_index("local_file_id", "/", -1).alias("file_name"),
        F.substring_index(naming.result_file_name(F.col("local_file_id")), "/", -1).alias("result_name"))
    landed = landing.landed_files(spark, f"{path}/{job:04}/files").join(
        landing.stored_sizes(spark, f"{path}/{job:04}/files"), "file_name")
    return named.join(landed, "file_name").join(results, "result_name", "left").select(
        "file_name", "file_bytes", "stored_bytes", "n_lines", "result_name", F.coalesce("n_results", F.lit(0)).alias("n_results"))


def _prepared_in_two(spark: SparkSession, folder: str) -> str:
    """A job over the first three fifths of the documents, extended by the rest."""
    limits = prepare_job.Limits(TOKEN_CAP, BATCH_REQUESTS, FILE_BYTES)
    texts, path = _texts(spark, folder), new_path(spark, "job")
    n = texts.count()
    prepare_job.run(texts.filter(F.col("row_idx") < n * 3 // 5), "text", MODEL, 1, path, limits)
    prepare_job.extend(texts, "text", MODEL, 1, path, limits)
    return path


@query
def packed_in_two_runs(spark, folder):
    """The manifest of a job that was extended by later papers: that of one run."""
    return prepare_job.read_manifest(spark, _prepared_in_two(spark, folder)).select(
        "row_idx", "token_count", "request_id", F.col("pos").cast("bigint").alias("pos"))


@query
def extended_files(spark, folder):
    """The files of a job that was extended by later papers, as they lie in the folder."""
    path = f"{_prepared_in_two(spark, folder)}/files"
    lines = landing.read_landed(spark, path).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_read"), F.sum(F.octet_length("value") + 1).alias("bytes_read"))
    return landing.landed_files(spark, path).join(lines, "file_name").select(
        "file_name", "n_lines", "file_bytes", "n_read", "bytes_read")


@query
def file_names(spark, folder):
    model = F.concat(F.lit("Org/Model-"), F.substring("o_orderpriority", 1, 1))
    made = naming.batch_file_name(model, F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderkey") % 3)
    named = table(spark, folder, "orders").select(
        "o_orderkey", made.alias("file_name"),
        naming.custom_id(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderkey") * 100).alias("custom_id"),
        naming.zero_pad(F.col("o_orderkey"), 4).alias("padded"))
    return named.withColumns({
        "result_name": naming.result_file_name(F.concat(F.lit("jobs/1/"), "file_name")),
        "base_name": naming.drop_last_parts(naming.file_stem(F.col("file_name")))})


# --- results ----------------------------------------------------------------

def _asked(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of the embeddings table: a few vectors per request, in id order."""
    request = F.call_function("div", F.col("vec_id"), F.lit(TEXTS_PER_RESULT)) + 1
    return table(spark, folder, "embeddings").select(
        request.alias("request_id"),
        naming.custom_id(F.lit(1), order.chunk_id(request, BATCH_REQUESTS), request).alias("custom_id"),
        (F.col("vec_id") % TEXTS_PER_RESULT).alias("pos"), F.col("vec_id").alias("row_idx"),
        "embedding", "label")


def _answered(asked: DataFrame) -> DataFrame:
    """One result line per request (``TEXTS_PER_RESULT`` vectors at most)."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", "embedding"))),
                        lambda x: F.struct(x["embedding"].alias("embedding")))
    lines = asked.groupBy("request_id", "custom_id").agg(items.alias("data"))
    return lines.select("request_id", F.to_json(F.struct(
        F.struct(F.col("data").alias("data")).alias("response"), "custom_id")).alias("value"))


@query
def realign_results(spark, folder):
    """Vectors to result lines in scattered order, and back to their rows."""
    asked = _asked(spark, folder)
    path = new_path(spark, "results")
    # Hashing the line scatters the requests over files and within them.
    (_answered(asked).select("value").repartition(F.xxhash64("value"))
     .sortWithinPartitions(F.xxhash64("value")).write.text(path))
    good = realign.good_lines(realign.parse_lines(read_result_lines(spark, path)))
    aligned = realign.align_vectors(good, asked.select("custom_id", "pos", "row_idx"))
    return aligned.select("vec_idx", F.posexplode("embedding").alias("dim", "x")).select(
        "vec_idx", F.col("dim").cast("bigint").alias("dim"), F.col("x").cast("double").alias("x"))


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Result lines in three files; every 7th line is spoiled in one of four ways."""
    lines = _answered(_asked(spark, folder))
    broken = F.element_at(F.array(
        F.substring("value", 1, 40), F.lit('{"custom_id": "x", "response": null}'),
        F.replace("value", F.lit('"custom_id"'), F.lit('"other_id"')),
        F.lit('{"custom_id": "y", "response": {"data": [{"vector": [1.0]}]}}')),
        (F.col("request_id") % 4 + 1).cast("int"))
    return lines.select(
        F.concat(F.lit("part-"), F.col("request_id") % 3).alias("source_file"),
        F.when(F.col("request_id") % 7 == 0, broken).otherwise(F.col("value")).alias("value"))


@query
def result_rejects(spark, folder):
    return realign.reject_counts(realign.parse_lines(_damaged(spark, folder)))


@query
def reject_reasons(spark, folder):
    return realign.rejected_lines(realign.parse_lines(_damaged(spark, folder))).groupBy(
        "source_file", "reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def unmatched_requests(spark, folder):
    """Requests whose answer was spoiled."""
    good = realign.good_lines(realign.parse_lines(_damaged(spark, folder)))
    return realign.unmatched_requests(good, _asked(spark, folder).select("custom_id")).withColumn(
        "n_got", F.col("n_got").cast("string"))


@query
def order_results(spark, folder):
    """Vectors numbered in the order asked, without a manifest.

    Request numbers pass 999,999 and each batch has three files whose names sort
    against their order.
    """
    request = F.call_function("div", F.col("vec_id"), F.lit(TEXTS_PER_RESULT)) + 999_990
    batch = order.chunk_id(request, BATCH_REQUESTS)
    asked = table(spark, folder, "embeddings").select(
        request.alias("request_id"), naming.custom_id(F.lit(1), batch, request).alias("custom_id"),
        (F.col("vec_id") % TEXTS_PER_RESULT).alias("pos"), "embedding")
    lines = _answered(asked).select(
        "value", F.concat(F.lit("part-"), 9 - F.col("request_id") % BATCH_REQUESTS).alias("source_file"))
    numbered = realign.vectors_in_order(realign.good_lines(realign.parse_lines(lines)))
    return numbered.select("vec_idx", vector_md5("embedding").alias("vector_md5"))


@query
def repeated_answers(spark, folder):
    """Every 5th request answered twice and every 7th not at all: rows per request, and what is reported."""
    asked = _asked(spark, folder)
    answers = _answered(asked).filter("request_id % 7 <> 0").select("request_id", "value")
    lines = answers.withColumn("source_file", F.lit("part-0")).unionByName(
        answers.filter("request_id % 5 = 0").withColumn("source_file", F.lit("part-1")))
    good = realign.good_lines(realign.parse_lines(lines))
    manifest = asked.select("custom_id", "pos", "row_idx")
    found = realign.align_vectors(good, manifest).join(
        manifest.select("custom_id", F.col("row_idx").alias("vec_idx")), "vec_idx").groupBy("custom_id").agg(
        F.count(F.lit(1)).alias("n_vectors"))
    problems = realign.unmatched_requests(good, manifest).select("custom_id", "problem")
    return manifest.select("custom_id").distinct().join(found, "custom_id", "left").join(
        problems, "custom_id", "left").select("custom_id", F.coalesce("n_vectors", F.lit(0)).alias("n_vectors"), "problem")


@query
def union_results(spark, folder):
    """Vectors of several sources in one, counted per source and in all."""
    source = table(spark, folder, "embeddings").select("vec_id", "label", F.size("embedding").alias("width"))
    low = source.filter("label < 5").withColumn("part", F.lit("low"))
    high = source.filter("label >= 5").withColumn("part", F.lit("high"))
    counts = low.unionByName(high).rollup("part").agg(
        F.count(F.lit(1)).alias("n_vectors"), F.sum("width").alias("n_values"))
    return counts.withColumn("part", F.coalesce("part", F.lit("all")))


@query
def dim_violations(spark, folder):
    """Vectors whose width is not the one their model promises."""
    models = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("model_no"), F.col("r_name").alias("model"),
        F.when(F.col("r_regionkey") == 3, 32).otherwise(64).alias("promised"))
    found = table(spark, folder, "embeddings").withColumn("model_no", F.col("label") % 5).join(models, "model_no")
    return realign.wrong_dimension(found, F.col("promised")).select(
        "vec_id", "model", F.col("promised").cast("bigint").alias("promised"),
        F.size("embedding").cast("bigint").alias("width"))


@query
def alignment_check(spark, folder):
    return realign.alignment(table(spark, folder, "embeddings"), table(spark, folder, "documents"))


def _two_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors against records, with some vectors lost and some doubled."""
    made = table(spark, folder, "embeddings")
    kept = made.filter("vec_id % 97 <> 5").unionByName(made.filter("vec_id % 131 = 7"))
    return digests.sides(kept, table(spark, folder, "documents"), "vec_id", "doc_id")


@query
def alignment_ranges(spark, folder):
    """Ranges of ids in which vectors and records differ."""
    return digests.differing_ranges(_two_sides(spark, folder), 16)


@query
def alignment_ids(spark, folder):
    """Ids that are not there once on both sides, found from wide ranges to narrow ones."""
    return digests.odd_ids(_two_sides(spark, folder), (256, 16))


@query
def missing_vectors(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return realign.missing_rows(docs, table(spark, folder, "embeddings"), "doc_id", "vec_id")


@query
def orphan_vectors(spark, folder):
    """Vectors whose document is gone, here as a repeat of an earlier text."""
    docs = dedup.keep_first_text(table(spark, folder, "documents"), "text", ["doc_id"], ["doc_id"])
    found = table(spark, folder, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"))
    return realign.orphan_rows(found, docs, "vec_id", "doc_id")


# --- collection ---------------------------------------------------------------

def _points(spark: SparkSession, folder: str) -> DataFrame:
    return collection.collection_points(
        table(spark, folder, "embeddings"), table(spark, folder, "documents"),
        ["lang", "source", "n_chars"], "vec_id", "doc_id")


@query
def collection_points(spark, folder):
    points = collection.with_load_chunk(_points(spark, folder), CHUNK)
    return points.select(
        "point_id", "chunk", F.size("vector").cast("bigint").alias("width"),
        vector_md5("vector").alias("vector_md5"), "payload.lang", "payload.source", "payload.n_chars")


@query
def collection_chunks(spark, folder):
    return order.chunk_ranges(_points(spark, folder), "point_id", CHUNK)


@query
def stored_vectors(spark, folder):
    """The middle half of a job's vector dataset, by row number."""
    found = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "vec_idx")
    root = new_path(spark, "vectors")
    vector_store.write_vectors(found, root, 1, 64)
    stored = vector_store.read_vectors(spark, root, 1)
    n = found.count()
    return order.row_slice(stored, "vec_idx", n // 4, n // 2).select(
        "vec_idx", F.size("embedding").cast("bigint").alias("width"), vector_md5("embedding").alias("vector_md5"))


@query
def stored_collection(spark, folder):
    """The load job's collection, read back: payload, code and unit vector of every point."""
    path = new_path(spark, "collection")
    collections.create_collection(spark, path, 64)
    found = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "vec_idx")
    papers = table(spark, folder, "documents").withColumnRenamed("doc_id", "row_idx").join(
        found.select(F.col("vec_idx").alias("row_idx")), "row_idx", "left_semi")
    # Some documents have no vector and some vectors no document; both stay out.
    load_job.run(found.join(papers.select(F.col("row_idx").alias("vec_idx")), "vec_idx", "left_semi"), papers, path)
    return collections.read_points(spark, path).select(
        "point_id", "payload.lang", "payload.source", F.md5("payload.text").alias("text_md5"),
        F.col("code")[0].alias("word"), vector_md5("vector").alias("vector_md5"),
        (F.round(F.col("unit")[0].cast("double"), 5) + 0.0).alias("u0"))


@query
def collection_upsert(spark, folder):
    """A collection after a second load that changes every second vector, sends it twice, and adds new ids."""
    path = new_path(spark, "collection")
    collections.create_collection(spark, path, 64, bucket_ids=CHUNK)
    points = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
        F.struct(F.col("label").cast("bigint").alias("label")).alias("payload"))
    collections.load_points(points, path)
    changed = points.filter("point_id % 2 = 0").withColumn(
        "payload", F.struct((F.col("payload.label") + 100).alias("label")))
    added = changed.withColumn("point_id", F.col("point_id") + 1_000_000)
    earlier = changed.withColumn("payload", F.struct((F.col("payload.label") - 50).alias("label")))
    sent = changed.unionByName(added).withColumn("at", F.lit(2)).unionByName(earlier.withColumn("at", F.lit(1)))
    collections.load_points(sent, path, ["at"])
    return collections.read_points(spark, path).select("point_id", "payload.label", F.col("code")[0].alias("word"))


@query
def unit_vectors(spark, folder):
    """Unit vectors of scaled ones; label 0 gives zero vectors and so nulls."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    found = table(spark, folder, "embeddings").select("vec_id", scaled.alias("v"))
    return found.select("vec_id", F.posexplode(vectors.unit_normalize(F.col("v"), "double")).alias("dim", "x")).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), (F.round("x", 6) + 0.0).alias("x"))


@query
def binary_quantize(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", vectors.bit_string(F.col("embedding")).alias("bits"),
        vectors.bit_words(F.col("embedding"))[0].alias("word"))


def _exemplars(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: its first vector."""
    return table(spark, folder, "embeddings").groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("query_vector"))


def _hits(found: DataFrame) -> DataFrame:
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), "point_id",
                        F.round("score", 6).alias("score"))


@query
def cosine_topk(spark, folder):
    points = table(spark, folder, "embeddings")
    return _hits(search.cosine_topk(points, _exemplars(spark, folder), TOP, "vec_id", "embedding"))


@query
def hamming_rescore(spark, folder):
    points = search.with_codes(table(spark, folder, "embeddings"), "embedding")
    return _hits(search.quantised_topk(points, _exemplars(spark, folder), TOP, 4, "vec_id", "embedding"))


@query
def pivot_topk(spark, folder):
    """The same answer from a pivot table, cell by cell."""
    path = new_path(spark, "pivot-table")
    pivots.write_pivot_table(table(spark, folder, "embeddings"), path, "vec_id", "embedding")
    return _hits(pivots.pivot_topk(spark, path, _exemplars(spark, folder), TOP))


@query
def collection_slice(spark, folder):
    """A range of ids out of a collection of two loads, from the files that can hold them."""
    path = new_path(spark, "collection")
    collections.create_collection(spark, path, 64, bucket_ids=CHUNK)
    points = _points(spark, folder)
    collections.load_points(points, path)
    longer = F.col("payload").withField("n_chars", F.col("payload.n_chars") + 1)
    collections.load_points(points.filter(F.col("point_id") % 3 == 0).withColumn("payload", longer), path)
    largest = points.agg(F.max("point_id")).first()[0]  # one number
    return collections.read_range(spark, path, largest // 4, largest // 2).select(
        "point_id", "payload.lang", F.col("payload.n_chars").cast("bigint").alias("n_chars"), vector_md5("vector").alias("vector_md5"))


# --- state --------------------------------------------------------------------

def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Events as service snapshots: null fields are written, signups lack counts."""
    status = mapped("event_type", EVENT_STATUS)
    seconds = F.unix_seconds(naming.as_utc(F.col("ts")))
    counted = F.struct(F.col("user_id").cast("int").alias("completed"), F.lit(1).alias("failed"),
                       (F.col("user_id") + 1).cast("int").alias("total"))
    raw = F.to_json(F.struct(
        F.concat(F.lit("batch_"), "event_id").alias("id"), status.alias("status"),
        F.lit("/v1/embeddings").alias("endpoint"),
        F.when(F.col("event_type") != "signup", counted).alias("request_counts"),
        F.when(F.col("event_type") == "error", F.struct(F.col("value").alias("at"))).alias("errors"),
        seconds.alias("created_at"),
        F.when(status == "completed", seconds + 60).alias("completed_at")), {"ignoreNullFields": "false"})
    return table(spark, folder, "events").select("event_id", raw.alias("raw"))


@query
def flatten_batch(spark, folder):
    flat = state.flatten_snapshots(_snapshots(spark, folder))
    return flat.select(
        "event_id", "batch_oaid", "status", "endpoint",
        *[F.col(f"request_{c}").cast("string").alias(f"request_{c}") for c in ("completed", "failed", "total")],
        F.col("errors").isNotNull().alias("has_errors"),
        F.unix_seconds("created_at").alias("created_at"), F.unix_seconds("completed_at").cast("string").alias("completed_at"),
        F.size("present").cast("bigint").alias("n_present"))


@query
def latest_status(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return state.latest_per_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", mapped("event_type", EVENT_STATUS).alias("status"))


LINE_STATUS = {"AF": "completed", "AO": "completed", "NO": "completed", "NF": "in_progress",
               "RF": "expired", "RO": "failed"}
ORDER_STATUS = {"F": "failed", "O": "processing", "P": "pending"}


@query
def job_status_rollup(spark, folder):
    """Orders as jobs, their lines as batches."""
    lines = table(spark, folder, "lineitem").withColumn("state", F.concat("l_returnflag", "l_linestatus"))
    # Some batches have no status; they hold their job back.
    status = F.when(F.col("l_suppkey") % 5 > 0, mapped("state", LINE_STATUS))
    batches = lines.select(F.col("l_orderkey").alias("job_id"), status.alias("status"))
    jobs = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), mapped("o_orderstatus", ORDER_STATUS).alias("status"),
        F.col("o_orderdate").alias("updated_at"))
    now = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    return state.roll_up_jobs(jobs, batches, now).withColumn("updated_at", F.col("updated_at").cast("string"))


@query
def status_sets(spark, folder):
    """Distinct line states per order, at most one per kind."""
    lines = table(spark, folder, "lineitem").withColumn("state", F.concat("l_returnflag", "l_linestatus"))
    found = lines.groupBy("l_orderkey").agg(F.collect_set(mapped("state", LINE_STATUS)).alias("found"))
    return found.select("l_orderkey", F.array_join(F.array_sort("found"), ",").alias("statuses"),
                        text.overlaps(F.col("found"), ["cancelled", "failed"]).alias("is_failing"))


@query
def last_changed(spark, folder):
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("returned_at"),
        F.min(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))).alias("opened_at"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("placed_at"))
    changed = state.last_changed(["placed_at", "returned_at", "opened_at"], "timestamp_ntz")
    return orders.join(shipped, "o_orderkey", "left").select(
        "o_orderkey", changed.cast("string").alias("changed_at"))


@query
def partial_upsert(spark, folder):
    """Customers after the changes their last order carries as JSON."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus",
                                                   "o_totalprice", "o_orderpriority")
    last = state.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    keep_nulls = {"ignoreNullFields": "false"}
    segment, balance = F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_totalprice").alias("c_acctbal")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct(segment, balance), keep_nulls))
        .when(F.col("o_orderstatus") == "O", F.to_json(F.struct(balance), keep_nulls))
        .otherwise(F.to_json(F.struct(F.lit(None).cast("string").alias("c_mktsegment")), keep_nulls)))
    changes = last.select(F.col("o_custkey").alias("c_custkey"), raw.alias("raw")).select(
        "c_custkey", F.json_object_keys("raw").alias("present"),
        F.from_json("raw", "c_mktsegment string, c_acctbal double").alias("s")).select("c_custkey", "present", "s.*")
    return state.partial_upsert(
        table(spark, folder, "customer"), changes, "c_custkey", ["c_mktsegment", "c_acctbal"]
    ).withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query
def status_report(spark, folder):
    batches = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("batch_"), "event_id").alias("batch_oaid"),
        mapped("event_type", EVENT_STATUS).alias("status"),
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias("request_completed"),
        F.lit(0).alias("request_failed"), F.col("user_id").alias("request_total"),
        F.when(F.col("event_type") == "error", F.col("props")).when(
            F.col("event_type") == "view", "").alias("errors"),
        F.col("ts").alias("created_at"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("calculated_update_at"))
    return state.status_report(batches)


@query
def job_headers(spark, folder):
    return state.job_header(table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), mapped("o_orderstatus", ORDER_STATUS).alias("status")))


def _jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in credit as jobs; one market segment is no job status."""
    return table(spark, folder, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "completed").when(
            F.col("c_mktsegment") == "MACHINERY", "paused").otherwise("pending").alias("status"),
        F.col("c_name").alias("model"))


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as batches of their customer, some without one or with odd values."""
    some = F.lit("x")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("job_id"),
        F.concat(F.lit("batch_"), "o_orderkey").alias("batch_oaid"),
        some.alias("completion_window"), some.alias("endpoint"), some.alias("object"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(
            F.col("o_orderstatus") == "O", "shipped").alias("status"),
        some.alias("input_file_id"), some.alias("local_file_id"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_orderdate")).alias("created_at"))


@query
def constraint_violations(spark, folder):
    return state.state_violations(_jobs(spark, folder), _batches(spark, folder))


@query
def cascade_prune(spark, folder):
    jobs = _jobs(spark, folder).select(F.col("id").alias("job_id"))
    return state.prune_orphans(_batches(spark, folder), jobs, "job_id").select("id", "job_id")


@query
def completed_only(spark, folder):
    return state.of_completed_jobs(_batches(spark, folder), _jobs(spark, folder)).select("id", "job_id")


@query
def job_lookup(spark, folder):
    """The one job with the largest id, and its batches."""
    jobs, batches = _jobs(spark, folder), _batches(spark, folder)
    last = batches.join(jobs.select(F.col("id").alias("job_id")), "job_id", "left_semi").agg(F.max("job_id")).first()[0]
    job = state.require_one(jobs.filter(F.col("id") == last), "job")
    return state.batches_of(batches, last).select(
        "id", "job_id", F.lit(job["model"]).alias("model"), F.lit(job["status"]).alias("job_status"))


@query
def rejected_batches(spark, folder):
    """Orders registered as batches: those that break rules are given back, the others are stored."""
    root = new_path(spark, "state")
    jobs = _jobs(spark, folder).filter("status <> 'paused'").withColumns(
        {c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at", "finished_at")})
    state_tables.recreate_state(spark, root)
    state_tables.write_state(jobs, root, "jobs")
    rejected = state_tables.create_batches(_batches(spark, folder).drop("id"), root, ["batch_oaid"], reject=True)
    stored = state_tables.read_state(spark, root, "batches")
    return rejected.select("id", "batch_oaid", F.array_join("rules", ", ").alias("rules")).unionByName(
        stored.select("id", "batch_oaid", F.lit("").alias("rules")))


@query
def job_batches(spark, folder):
    joined = state.jobs_with_batches(_jobs(spark, folder), _batches(spark, folder))
    return joined.select("job_id", "job_status", "job_model", "id", "status")


# --- streams --------------------------------------------------------------------

def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files."""
    schema = table(spark, folder, name).schema
    # A stream takes no file for its path, and a filter on names would drop a folder's files; a pattern takes either.
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return table_stream(spark, folder, "events")


@query
def stream_latest_status(spark, folder):
    """``latest_status`` over the events as a stream; every refresh replaces the result."""
    events = _event_stream(spark, folder).select("user_id", "ts", "event_id", "event_type")
    latest = status_stream.latest_status(events, ["user_id"], ["ts", "event_id"])
    path, written = new_path(spark, "stream"), []

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        written.append(epoch)

    run = (latest.writeStream.outputMode("complete").foreachBatch(keep)
           .option("checkpointLocation", new_path(spark, "offsets")).trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(f"{path}/epoch={written[-1]}").select(
        "user_id", "event_id", mapped("event_type", EVENT_STATUS).alias("status"))


@query
def stream_dedupe(spark, folder):
    """Distinct (user, event type) pairs of the event stream."""
    once = ingest.once_per_key(_event_stream(spark, folder), ["user_id", "event_type"], "ts", "3650 days")
    path = new_path(spark, "stream")
    run = (once.select("user_id", "event_type").writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", new_path(spark, "offsets")).option("path", path)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(path)


@query
def stream_papers(spark, folder):
    """Documents landed as NDJSON papers, two rows per id; each wanted id once."""
    docs = table(spark, folder, "documents")
    raw = docs.select(
        F.call_function("div", F.col("doc_id"), F.lit(2)).cast("string").alias("id"),
        F.concat_ws(" ", F.when(F.col("lang") == "en", "cs.CL"), "source").alias("categories"))
    landed, path = new_path(spark, "raw"), new_path(spark, "stream")
    raw.repartition(4).write.json(landed)
    arrived = ingest.stream_raw_papers(spark, landed).withColumn("arrived_at", F.current_timestamp())
    run = (ingest.new_papers(arrived, "30 days").select("id").writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", new_path(spark, "offsets")).option("path", path)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(path)


def _registered(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Stored state with a job per user and four batches of each, and the events that change them."""
    oaid = F.concat(F.lit("batch_"), "user_id", F.lit("_"), F.col("event_id") % 4)
    events = table(spark, folder, "events").select(
        "event_id", "user_id", oaid.alias("oaid"), mapped("event_type", EVENT_STATUS).alias("status"))
    root = new_path(spark, "state")
    state_tables.recreate_state(spark, root)
    jobs = events.select(F.col("user_id").alias("id")).distinct().withColumns({
        "status": F.lit("pending"), "model": F.lit(MODEL),
        **{c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at", "finished_at")}})
    state_tables.write_state(jobs, root, "jobs")
    created = events.select("user_id", "oaid").distinct().select(
        F.col("user_id").alias("job_id"), F.concat("oaid", F.lit(".jsonl")).alias("local_file_id"),
        F.to_json(F.struct(
            F.col("oaid").alias("id"), F.lit("validating").alias("status"), F.lit("24h").alias("completion_window"),
            F.lit("/v1/embeddings").alias("endpoint"), F.lit("batch").alias("object"),
            F.concat(F.lit("in-"), "oaid").alias("input_file_id"), F.lit(1704067200).alias("created_at"))).alias("raw"))
    monitor.register_batches(created, root)
    return root, events


@query
def stream_refresh(spark, folder):
    """Events as status snapshots of four batches per user: stored batches and jobs after the stream."""
    root, events = _registered(spark, folder)
    landed = new_path(spark, "landed")
    events.select("event_id", F.to_json(F.struct(F.col("oaid").alias("id"), "status")).alias("raw")).write.json(landed)
    snapshots = spark.readStream.schema("event_id bigint, raw string").json(landed)
    run = status_stream.write_refresh(snapshots, root, ["event_id"], new_path(spark, "offsets")).trigger(
        availableNow=True).start()
    run.awaitTermination()
    return _stored_statuses(spark, root)


def _stored_statuses(spark: SparkSession, root: str) -> DataFrame:
    stored, jobs = (state_tables.read_state(spark, root, t) for t in ("batches", "jobs"))
    return stored.select("id", "job_id", "batch_oaid", "status").join(
        jobs.select(F.col("id").alias("job_id"), F.col("status").alias("job_status")), "job_id")


def _after_rounds(spark: SparkSession, folder: str) -> str:
    """Events as snapshots in seven refreshes, by event number; the tables are compacted on the way."""
    root, events = _registered(spark, folder)
    raw = events.select("event_id", F.to_json(F.struct(F.col("oaid").alias("id"), "status")).alias("raw"))
    for n in range(ROUNDS):
        monitor.refresh_stored(spark, root, raw.filter(F.col("event_id") % ROUNDS == n), ["event_id"])
        if n == ROUNDS // 2:
            state_tables.compact(spark, root)
    return root


@query
def state_deltas(spark, folder):
    """Stored batches and jobs after many refreshes, each of which wrote its changes only."""
    return _stored_statuses(spark, _after_rounds(spark, folder))


@query
def rollup_by_changes(spark, folder):
    """How many batches each job has in each status, kept by signed changes, with the job's status."""
    root = _after_rounds(spark, folder)
    counts, jobs = (state_tables.read_state(spark, root, t) for t in (state_tables.COUNTS, "jobs"))
    return counts.join(jobs.select(F.col("id").alias("job_id"), F.col("status").alias("job_status")), "job_id")


@query
def stream_collection(spark, folder):
    """Embeddings as a stream of points, read back from the collection they land in."""
    path = new_path(spark, "collection")
    collections.create_collection(spark, path, 64)
    arriving = table_stream(spark, folder, "embeddings")
    points = arriving.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
                             F.struct(F.col("label").cast("bigint").alias("label")).alias("payload"))
    run = ingest.write_points(points, path, new_path(spark, "offsets")).trigger(availableNow=True).start()
    run.awaitTermination()
    return collections.read_points(spark, path).select(
        "point_id", "payload.label", F.col("code")[0].alias("word"))


@query
def stream_collection_twice(spark, folder):
    """Two streams with their own checkpoints and ids in common: the later points win."""
    path = new_path(spark, "collection")
    collections.create_collection(spark, path, 64, bucket_ids=CHUNK)
    arriving = table_stream(spark, folder, "embeddings")
    for part, extra in (("label < 7", 0), ("label >= 5", 100)):
        points = arriving.filter(part).select(
            F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
            F.struct((F.col("label") + extra).cast("bigint").alias("label")).alias("payload"))
        ingest.write_points(points, path, new_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return collections.read_points(spark, path).select("point_id", "payload.label", F.col("code")[0].alias("word"))
