"""The run's places against the schedule of the target weights, with a source that holds most rows."""
from pyspark.sql import functions as F

import corpus_pipeline as pipeline


def test_run_places_by_target_weights(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = F.when(F.pmod("doc_id", F.lit(10)) < 6, "src0").when(F.pmod("doc_id", F.lit(10)) < 8, "src1").otherwise("src2")
    docs.withColumn("source", hot).write.parquet(f"{tmp_path}/documents.parquet")
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    rows = sorted(pipeline.run(spark, str(tmp_path)).select("doc_id", "mix_pos").collect(), key=lambda r: r.mix_pos)
    assert [r.mix_pos for r in rows] == list(range(len(rows))) and len({r.doc_id for r in rows}) == len(rows)
    order = [source[r.doc_id] for r in rows]
    turns = [set(order[i:i + 64]) for i in range(0, 6 * 64, 64)]
    assert all(order.count(s) >= 128 for s in ("src0", "src1", "src2"))
    assert turns == [{"src0"}, {"src1"}, {"src2"}] * 2


def test_rows_without_an_id(spark):
    text = "some words of a text "
    rows = [(None if i % 7 == 0 else i, text * (i % 5), f"src{i % 2}") for i in range(300)]
    out = pipeline.encode(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "").collect()
    assert sorted(r.mix_pos for r in out) == list(range(300))
    assert sum(r.doc_id is None for r in out) == sum(r[0] is None for r in rows)
