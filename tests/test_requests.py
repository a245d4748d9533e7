"""Request files as the line format says, and back through results."""

import json

import pytest
from pyspark.sql import functions as F

from paperweave import schemas
from paperweave.operators import realign, requests
from paperweave.plans import collect, load, prepare
from paperweave.sources import landing, collections, state_tables, vectors

MODEL = "Qwen/Qwen3-Embedding-8B"


def papers(spark, n=60):
    rows = [(i, None if i % 11 == 5 else f"Title {i} \"q\" \\ é ", f"word {i} " * (i % 9) + "日本\n\t\x01/")
            for i in range(n)]
    return spark.createDataFrame(rows, "row_idx bigint, title string, abstract string")


def fold(counts, cap):
    bins, current = [], 0
    for row, count in counts:
        if bins and current + count > cap:
            bins.append([])
            current = 0
        elif not bins:
            bins.append([])
        bins[-1].append(row)
        current += count
    return bins


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("job"))
    limits = prepare.Limits(max_input_tokens=40, max_requests_per_batch=4, max_batch_file_bytes=900)
    return path, prepare.run(papers(spark), ["title", "abstract"], MODEL, 7, path, limits)


def test_lines_match_python_json(spark, prepared):
    path, made = prepared
    texts = {r["row_idx"]: None if r["title"] is None else f"{r['title']}\n\n{r['abstract']}"
             for r in papers(spark).collect()}
    rows = made.manifest.orderBy("request_id", "pos").collect()
    inputs = {}
    for r in rows:
        inputs.setdefault((r["batch_id"], r["request_id"]), []).append(texts[r["row_idx"]])
    want = {
        request: json.dumps({
            "custom_id": f"batch-0007-{batch:05}-request-{request:06}", "method": "POST",
            "url": "/v1/embeddings", "body": {"model": MODEL, "input": found}}, ensure_ascii=False)
        for (batch, request), found in inputs.items()}
    files = landing.read_landed(spark, f"{path}/files").collect()
    got = {int(json.loads(r["value"])["custom_id"][-6:]): r for r in files}
    assert len(files) == len(got) == len(want)
    for request, line in want.items():
        # Escapes of control characters may use upper-case hex digits.
        assert got[request]["value"].replace("\\u0001", "") == line.replace("\\u0001", "")
        assert f"-0007-batch-{(request - 1) // 4 + 1:04}" in got[request]["file_name"]
    sizes = {r["request_id"]: r["line_bytes"] for r in made.requests.collect()}
    assert sizes == {k: len(v.encode()) + 1 for k, v in want.items()}


def test_packing_and_totals(prepared):
    _, made = prepared
    rows = made.manifest.orderBy("row_idx").collect()
    got = {}
    for r in rows:
        got.setdefault(r["request_id"], []).append(r["row_idx"])
    assert list(got.values()) == fold([(r["row_idx"], r["token_count"]) for r in rows], 40)
    assert [r["row_idx"] for r in made.rejects.orderBy("row_idx").collect()] == list(range(5, 60, 11))
    per_request, batches = made.requests.collect(), made.batches.collect()
    assert sum(b["text_count"] for b in batches) == len(rows) == sum(r["text_count"] for r in per_request)
    assert all(r["token_count"] <= 40 or r["text_count"] == 1 for r in per_request)
    assert all(b["request_count"] <= 4 for b in batches)


def test_files_keep_order_and_limit(spark, prepared):
    path, made = prepared
    files = made.files.collect()
    assert all(f["file_bytes"] <= 900 or f["request_count"] == 1 for f in files)
    assert len({f["file_name"] for f in files}) == len(files)
    assert all(open(f["path"].removeprefix("file://")).read().count("\n") == f["request_count"] for f in files)
    for f in files:
        text = open(f["path"].removeprefix("file://")).read()
        ids = [json.loads(line)["custom_id"] for line in text.split("\n")[:-1]]
        assert ids == sorted(ids) and len(text.encode()) == f["file_bytes"] and f["path"].endswith(f"/{f['file_name']}")


def test_landing_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"f{i % 3}.jsonl", i, f"line {i} é") for i in range(30)], "file_name string, n int, line string")
    assert landing.landed_files(spark, root).count() == 0 and landing.read_landed(spark, root).count() == 0
    with pytest.raises(Exception):  # rows of a file in two tasks
        landing.land_lines(rows.repartition(4, "n"), root, "n")
    assert landing.landed_files(spark, root).count() == 0
    landing.land_lines(rows.repartition(4, "file_name"), root, "n")
    got = {r["file_name"]: r for r in landing.landed_files(spark, root).collect()}
    sizes = {r["file_name"]: r["stored_bytes"] for r in landing.stored_sizes(spark, root).collect()}
    for name, r in got.items():
        want = "".join(f"line {i} é\n" for i in range(30) if f"f{i % 3}.jsonl" == name)
        assert open(r["path"].removeprefix("file://")).read() == want
        assert (r["file_bytes"], r["n_lines"], sizes[name]) == (len(want.encode()), 10, len(want.encode()))
    # A task that fails in its first attempt and one that never commits leave nothing to be read.
    (tmp_path / "out" / "run=x" / "y").mkdir(parents=True)
    (tmp_path / "out" / "run=x" / "y" / "stray.jsonl").write_text("stray\n")
    assert landing.read_landed(spark, root).count() == 30
    # The next listing replaces the former.
    landing.land_lines(rows.filter("n < 3").repartition(1), root, "n")
    assert landing.read_landed(spark, root).count() == 3
    with pytest.raises(Exception):
        landing.land_lines(rows.withColumn("file_name", F.lit("../x")).coalesce(1), root, "n")


def test_results_are_found_by_the_stored_batches(spark, tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    for name in ("a_result.jsonl", "b_result.jsonl", "c_result.jsonl", "a.jsonl"):
        (folder / name).write_text(f"{name}\n")
    batches = spark.createDataFrame([(1, "x", "s3://q/a.jsonl"), (1, "y", "b.jsonl"), (1, "z", "d.jsonl"), (1, "n", None)],
                                    "job_id bigint, batch_oaid string, local_file_id string")
    got = landing.result_lines(spark, batches, str(folder)).collect()
    assert sorted(r["value"] for r in got) == ["a_result.jsonl", "b_result.jsonl"]
    assert [r["result_name"] for r in landing.missing_results(spark, batches, str(folder)).collect()] == ["d_result.jsonl"]


@pytest.mark.parametrize("cuts", [requests.MAX_CUTS, 0])
def test_range_join_finds_the_file(spark, monkeypatch, cuts):
    """Intervals of very different lengths, with gaps, broadcast and shuffled."""
    monkeypatch.setattr(requests, "MAX_CUTS", cuts)
    lengths, at, intervals, want = [1, 500, 2, 3, 90, 1, 1, 40], 7, [], {}
    for n, length in enumerate(lengths):
        intervals.append((1, n // 3, n, n % 3, at, at + length - 1))
        want.update({row: (n // 3, n % 3) for row in range(at, at + length)})
        at += length + n % 2 * 5
    found = requests.file_of_rows(spark.range(at + 20).withColumnRenamed("id", "row_idx"), spark.createDataFrame(
        intervals, "job_id bigint, batch_id bigint, request_id bigint, file_no bigint, first_row bigint, last_row bigint"))
    assert {r["row_idx"]: (r["batch_id"], r["file_no"]) for r in found.collect()} == want and found.count() == len(want)


def test_unknown_model(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown model"):
        prepare.run(papers(spark, 2), "title", "none", 1, str(tmp_path))


def write_results(folder, manifest, spoil=()):
    """Result files as a service would return them, lines in reverse, two files."""
    answers = {}
    for r in manifest.orderBy("request_id", "pos").collect():
        answers.setdefault(r["custom_id"], []).append({"embedding": [r["row_idx"], -0.5, 0.0, 1e-3]})
    lines = []
    for custom_id, data in reversed(answers.items()):
        padding = {"note": "x" * 700} if len(lines) % 2 else {}
        lines.append(json.dumps({**padding, "response": {"data": data}, "custom_id": custom_id}))
    for at, line in spoil:
        lines[at] = line
    folder.mkdir()
    half = len(lines) // 2
    (folder / "b_result.jsonl").write_text("\n".join(lines[:half]) + "\n")
    (folder / "a_result.jsonl").write_text("\n".join(lines[half:]) + "\n")
    return str(folder)


def test_results_to_collection(spark, prepared, tmp_path):
    _, made = prepared
    results = write_results(tmp_path / "results", made.manifest)
    got = collect.run(spark, results, made.manifest, str(tmp_path / "vectors"), 7, 4)
    assert got.rejects.count() == 0 and got.unmatched.count() == 0
    rows = got.vectors.orderBy("vec_idx").collect()
    assert [r["vec_idx"] for r in rows] == sorted(r["row_idx"] for r in made.manifest.collect())
    assert all(r["embedding"][0] == r["vec_idx"] for r in rows)
    # Numbering without a manifest keeps the order inside a file.
    parsed = realign.parse_lines(collect.read_result_lines(spark, f"{results}/a_result.jsonl"))
    alone = realign.vectors_in_order(realign.good_lines(parsed)).orderBy("vec_idx").collect()
    firsts = [r["embedding"][0] for r in alone]
    assert firsts == sorted(firsts) and [r["vec_idx"] for r in alone] == list(range(len(alone)))

    clean = papers(spark).filter("title is not null")
    root = str(tmp_path / "collection")
    collections.create_collection(spark, root, 4)
    assert collections.read_points(spark, root) is None
    assert load.run(vectors.read_vectors(spark, str(tmp_path / "vectors"), 7), clean, root) == len(rows)
    points = collections.read_points(spark, root).orderBy("point_id").collect()
    assert points[0]["payload"]["title"].startswith("Title 0")
    assert [p["point_id"] for p in points] == [r["vec_idx"] for r in rows]
    with pytest.raises(ValueError, match="do not match"):
        load.run(got.vectors, papers(spark), root)
    other = str(tmp_path / "other")
    collections.create_collection(spark, other, 3)
    with pytest.raises(Exception, match="does not have 3 dimensions"):
        load.run(got.vectors, clean, other)


def test_bad_lines_do_not_shift_others(spark, prepared, tmp_path):
    _, made = prepared
    spoil = [(0, "{not json"), (1, '{"custom_id": "ghost", "response": {"data": [{"embedding": [1.0, 2.0, 3.0, 4.0]}]}}'),
             (2, '{"custom_id": "z", "response": null}')]
    results = write_results(tmp_path / "results", made.manifest, spoil)
    got = collect.run(spark, results, made.manifest, str(tmp_path / "vectors"), 7, 4)
    assert sorted(r["reason"] for r in got.rejects.collect()) == ["no custom_id or not JSON", "no response data"]
    problems = [r["problem"] for r in got.unmatched.collect()]
    assert problems.count("missing") == 3 and problems.count("orphan") == 1
    assert all(r["embedding"][0] == r["vec_idx"] for r in got.vectors.collect())


def test_repeated_answers_count_once_and_loads_compare_ids(spark, prepared, tmp_path):
    """One request answered twice and another not at all: the counts agree, the ids don't."""
    _, made = prepared
    ids = [r["custom_id"] for r in made.requests.orderBy("request_id").collect()]
    again = json.dumps({"response": {"data": [{"embedding": [-1.0, 0.0, 0.0, 0.0]}]}, "custom_id": ids[-1]})
    results = write_results(tmp_path / "results", made.manifest, [(1, again)])
    got = collect.run(spark, results, made.manifest, str(tmp_path / "vectors"), 7, 4)
    problems = {r["problem"] for r in got.unmatched.collect()}
    assert problems == {"missing", "answered twice"}
    found = [r["vec_idx"] for r in got.vectors.collect()]
    assert len(found) == len(set(found))
    clean = papers(spark).filter("title is not null")
    root = str(tmp_path / "collection")
    collections.create_collection(spark, root, 4)
    with pytest.raises(ValueError, match="do not match"):
        load.run(got.vectors, clean, root)
    twice = got.vectors.unionAll(got.vectors.limit(clean.count() - len(found)))
    with pytest.raises(ValueError, match="has"):
        load.run(twice, clean, root)
    assert collections.read_points(spark, root) is None


def test_a_failed_rerun_keeps_the_good_vectors(spark, tmp_path):
    root, df = str(tmp_path), spark.createDataFrame([(0, [1.0])], "vec_idx bigint, embedding array<float>")
    vectors.write_vectors(df, root, 1, 1)
    with pytest.raises(Exception, match="does not have 1 dimensions"):
        vectors.write_vectors(spark.createDataFrame([(0, [1.0, 2.0])], df.schema), root, 1, 1)
    assert vectors.read_vectors(spark, root, 1).first()["embedding"] == [1.0]


def test_wrong_dimension_is_an_error(spark, prepared, tmp_path):
    _, made = prepared
    results = write_results(tmp_path / "results", made.manifest)
    with pytest.raises(Exception, match="does not have 5 dimensions"):
        collect.run(spark, results, made.manifest, str(tmp_path / "vectors"), 7, 5)


def test_other_data_path(spark):
    lines = spark.createDataFrame(
        [('{"custom_id": "a", "response": {"body": {"data": [{"embedding": [1.5]}]}}}', "f")], "value string, source_file string")
    parsed = realign.parse_lines(lines, "response.body.data").first()
    assert parsed["is_good"] and parsed["data"][0]["embedding"] == [1.5]


def test_vector_versions(spark, tmp_path):
    root, df = str(tmp_path), spark.createDataFrame([(0, [1.0])], "vec_idx bigint, embedding array<float>")
    with pytest.raises(FileNotFoundError):
        vectors.read_vectors(spark, root, 1)
    vectors.write_vectors(df, root, 1, 1)
    vectors.write_vectors(df, root, 1, 1)
    assert vectors.read_vectors(spark, root, 1).count() == 1
    vectors.write_vectors(df, root, 1, 1, version=2)
    with pytest.raises(ValueError, match="several"):
        vectors.read_vectors(spark, root, 1)


def test_only_completed_jobs_go_on(spark, tmp_path):
    root = str(tmp_path)
    state_tables.recreate_state(spark, root)
    job = state_tables.create_job(spark, root, MODEL)
    assert collect.run_completed(spark, root, job, "unused", None, "unused") is None
    assert load.run_completed(spark, root, job, "unused", None, "unused") is None
    assert schemas.model_dimension(MODEL) == 4096


def test_empty_input(spark, tmp_path):
    made = prepare.run(papers(spark, 0), "title", MODEL, 1, str(tmp_path))
    assert made.manifest.count() == 0 and made.files.count() == 0


def test_request_lines_sizes_without_texts(spark):
    assert requests.weigh_texts(spark.createDataFrame([(0, None)], "row_idx bigint, text string")).count() == 0


LIMITS = prepare.Limits(max_input_tokens=40, max_requests_per_batch=4, max_batch_file_bytes=900)


def landed(spark, path):
    lines = sorted((r["file_name"], r["value"]) for r in landing.read_landed(spark, f"{path}/files").collect())
    return lines, sorted((r["file_name"], r["file_bytes"], r["n_lines"]) for r in landing.landed_files(spark, f"{path}/files").collect())


def manifest_rows(df):
    return sorted(map(tuple, df.collect()))


def test_an_extended_job_equals_one_run(spark, prepared, tmp_path):
    path, made = prepared
    every, grown = papers(spark), str(tmp_path)
    prepare.run(every.filter("row_idx < 20"), ["title", "abstract"], MODEL, 7, grown, LIMITS)
    old = {r["file_name"]: r["path"] for r in landing.landed_files(spark, f"{grown}/files").collect()}
    for n in (20, 33, 1000, 1000):
        now = prepare.extend(every.filter(f"row_idx < {n}"), ["title", "abstract"], MODEL, 7, grown, LIMITS)
    assert manifest_rows(now.manifest) == manifest_rows(made.manifest) == manifest_rows(prepare.read_manifest(spark, grown))
    assert landed(spark, grown) == landed(spark, path)
    columns = ["job_id", "batch_id", "file_no", "request_count", "file_bytes", "file_name"]
    assert manifest_rows(now.files.select(columns)) == manifest_rows(made.files.select(columns))
    # Files of full batches were not written again.
    new = {r["file_name"]: r["path"] for r in landing.landed_files(spark, f"{grown}/files").collect()}
    kept = [name for name in old if old[name] == new[name]]
    assert kept and len(kept) < len(old)


def test_a_broken_extension_can_be_repeated(spark, prepared, tmp_path, monkeypatch):
    path, _ = prepared
    every, grown = papers(spark), str(tmp_path)
    with pytest.raises(FileNotFoundError):
        prepare.extend(every, ["title", "abstract"], MODEL, 7, grown, LIMITS)
    prepare.run(every.filter("row_idx < 20"), ["title", "abstract"], MODEL, 7, grown, LIMITS)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(prepare, "_land", broken)
        with pytest.raises(OSError, match="lost"):
            prepare.extend(every.filter("row_idx < 40"), ["title", "abstract"], MODEL, 7, grown, LIMITS)
    prepare.extend(every, ["title", "abstract"], MODEL, 7, grown, LIMITS)
    assert landed(spark, grown) == landed(spark, path)


@pytest.mark.parametrize("rows", [30, 1000])
def test_two_extensions_at_once(spark, prepared, tmp_path, monkeypatch, rows):
    """Another call extends and lands while one lands; the files are those of the last entry."""
    path, _ = prepared
    every, grown = papers(spark), str(tmp_path)
    prepare.run(every.filter("row_idx < 20"), ["title", "abstract"], MODEL, 7, grown, LIMITS)
    land, calls = prepare._land, []

    def extend(n):
        return prepare.extend(every.filter(f"row_idx < {n}"), ["title", "abstract"], MODEL, 7, grown, LIMITS)

    def crossing(*args):
        if not calls:
            calls.append(1)
            extend(1000)
        land(*args)

    with monkeypatch.context() as patch:
        patch.setattr(prepare, "_land", crossing)
        if rows == 1000:
            extend(rows)
        else:
            with pytest.raises(ValueError, match="with all papers"):
                extend(rows)
    if rows < 1000:
        extend(1000)
    assert landed(spark, grown) == landed(spark, path)


def test_a_sealed_extension_leaves_sent_files(spark, tmp_path):
    every, grown = papers(spark), str(tmp_path)
    prepare.run(every.filter("row_idx < 20"), ["title", "abstract"], MODEL, 7, grown, LIMITS)
    before = landed(spark, grown)
    rows = manifest_rows(prepare.read_manifest(spark, grown))
    now = prepare.extend(every, ["title", "abstract"], MODEL, 7, grown, LIMITS, sealed=True)
    after = landed(spark, grown)
    assert set(before[0]) < set(after[0]) and set(before[1]) < set(after[1])
    added = sorted(set(manifest_rows(now.manifest)) - set(rows))
    assert min(r[1] for r in added) == max(r[1] for r in rows) + 1  # a batch of their own
    texts = {r["row_idx"] for r in every.filter("title is not null").collect()}
    assert {r[5] for r in rows + added} == texts and len(rows + added) == len(texts)
