"""All jobs in a row, through the stored state."""

import json

import pytest
from pyspark.sql import functions as F

from paperweave import schemas
from paperweave.operators import search
from paperweave.plans import clean, collect, load, monitor, prepare
from paperweave.sources import collections, landing, state_tables
from paperweave.sources.papers import read_papers

MODEL = "tiny/Model-4"


def test_papers_to_search(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(schemas.MODEL_DIMENSIONS, MODEL, 4)
    base, state_root = str(tmp_path), str(tmp_path / "state")
    (tmp_path / "raw.json").write_text("".join(json.dumps({
        "id": str(i % 40), "title": f"T {i}", "abstract": "some words " * (i % 5 + 1), "categories": "cs.IR x",
        "versions": [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}],
        "authors_parsed": [["L", "F", ""]]}) + "\n" for i in range(50)))
    papers = read_papers(spark, clean.run(spark, f"{base}/raw.json"))
    assert papers.count() == 40

    state_tables.recreate_state(spark, state_root)
    job_id, made = prepare.run_new_job(
        papers, ["title", "abstract"], MODEL, state_root, f"{base}/jobs", prepare.Limits(30, 3, 400))
    assert state_tables.get_job(spark, state_root, job_id)["status"] == "pending"
    names = [r["file_name"] for r in made.files.orderBy("batch_id", "file_no").collect()]
    assert names[0] == "model-4-0001-batch-0001.jsonl"

    fixed = {"object": "batch", "endpoint": "/v1/embeddings", "completion_window": "24h", "created_at": 1704067200}
    created = spark.createDataFrame(
        [(job_id, name, json.dumps({**fixed, "id": f"oa-{name}", "input_file_id": f"in-{name}"})) for name in names],
        "job_id bigint, local_file_id string, raw string")
    monitor.register_batches(created, state_root)

    def snapshot(status):
        raws = [(i, json.dumps({**fixed, "id": f"oa-{name}", "status": status, "output_file_id": "out",
                                "completed_at": 1704070800})) for i, name in enumerate(names)]
        return spark.createDataFrame(raws, "at bigint, raw string")

    monitor.refresh_stored(spark, state_root, snapshot("in_progress"), ["at"])
    assert state_tables.get_job(spark, state_root, job_id)["status"] == "processing"
    assert collect.run_completed(spark, state_root, job_id, base, made.manifest, f"{base}/vectors") is None
    monitor.refresh_stored(spark, state_root, snapshot("completed"), ["at"])

    # The service answers each request line with one vector per text.
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "other_result.jsonl").write_text("of another job\n")
    with pytest.raises(FileNotFoundError, match="_result.jsonl"):
        collect.run_completed(spark, state_root, job_id, f"{base}/answers", made.manifest, f"{base}/vectors")
    sent = {}
    for r in landing.read_landed(spark, f"{base}/jobs/0001/files").collect():
        sent.setdefault(r["file_name"], []).append(json.loads(r["value"]))
    assert sorted(sent) == names
    for name, lines in sent.items():
        (tmp_path / "answers" / name.replace(".jsonl", "_result.jsonl")).write_text("".join(json.dumps({
            "custom_id": line["custom_id"],
            "response": {"data": [{"embedding": [float(text.split()[1]) + 1, 1.0, 0.0, 0.0]}
                                  for text in line["body"]["input"]]}}) + "\n" for line in lines))
    got = collect.run_completed(spark, state_root, job_id, f"{base}/answers", made.manifest, f"{base}/vectors")
    assert got.rejects.count() == 0 and got.unmatched.count() == 0

    collections.create_collection(spark, f"{base}/points", 4)
    assert load.run_completed(spark, state_root, job_id, f"{base}/vectors", papers, f"{base}/points") == 40
    points = collections.read_points(spark, f"{base}/points")
    # A vector belongs to the paper its text came from.
    assert points.filter(F.col("vector")[0] != F.split("payload.title", " ")[1].cast("float") + 1).count() == 0
    asked = spark.createDataFrame([(0, [1.0, 1.0, 0.0, 0.0])], "query_id bigint, query_vector array<float>")
    best = search.quantised_topk(points, asked, 1).join(points, "point_id").select("payload.title").first()
    assert best["title"] == "T 0"
