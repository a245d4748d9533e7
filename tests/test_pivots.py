"""Search through pivot tables against a full scan in numpy."""

import numpy as np
import pytest

from paperweave.operators import pivots
from tests.test_collection import brute, frame, ranked


def clustered(n=2000, dim=24, centres=20, noise=0.03, seed=11):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    rows = (middle[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, dim))).astype(np.float32)
    rows[1], rows[4] = 0, np.nan            # no direction
    rows[np.arange(n) % 3 == 2] = rows[2]   # a third are copies of one vector
    return rows


def asked_of(spark, queries):
    return frame(spark, [(i, q.tolist()) for i, q in enumerate(queries)], "query_id bigint, query_vector array<float>")


def table_of(spark, rows, path, **options):
    points = frame(spark, [(i, r.tolist()) for i, r in enumerate(rows)]).repartition(5)
    pivots.write_pivot_table(points, path, **options)


def cells_of(spark, path):
    return {r["cell"]: r["points"] for r in spark.read.parquet(f"{path}/cells").collect()}


@pytest.mark.parametrize("per_pass", [512, 3])
def test_result_is_that_of_a_scan_and_cells_stay_unread(spark, tmp_path, per_pass):
    rows = clustered()
    path = str(tmp_path / "table")
    table_of(spark, rows, path)
    queries = rows[[0, 2, 9, 31]]
    visited = []
    got = pivots.pivot_topk(spark, path, asked_of(spark, queries), 10, queries_per_pass=per_pass, visited=visited)
    assert ranked(got) == brute(rows, queries, 10)
    cells = cells_of(spark, path)
    assert sum(cells.values()) == len(rows) - 2
    if per_pass == 512:  # all queries in one block, so a cell is read at most once
        read = [c for wave in visited for c in wave]
        assert len(read) == len(set(read)) < len(cells) / 2


def test_unread_cells_are_never_opened(spark, tmp_path):
    """Files of cells that the search rules out may be gone."""
    rows = clustered()
    path = str(tmp_path / "table")
    table_of(spark, rows, path)
    asked, visited = asked_of(spark, rows[[0]]), []
    pivots.pivot_topk(spark, path, asked, 5, visited=visited)
    read = {c for wave in visited for c in wave}
    for folder in (tmp_path / "table" / "points").glob("cell=*"):
        if int(folder.name[5:]) not in read:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not a table")
    assert ranked(pivots.pivot_topk(spark, path, asked, 5)) == brute(rows, rows[[0]], 5)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    points, centres, queries = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (
        rng.normal(size=(500, 6)), rng.normal(size=(7, 6)), rng.normal(size=(40, 6))))
    cosines = points @ centres.T
    nearest = cosines.argmax(axis=1)
    angle = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
    cell = nearest * pivots.RINGS + (angle / pivots.RING).astype(int)
    names = np.unique(cell)
    least, most = (np.array([f(angle[cell == c]) for c in names]) for f in (np.min, np.max))
    bound = pivots.cell_bounds(queries, centres, names, least, most)
    best = np.stack([(queries @ points[cell == c].T).max(axis=1) for c in names], axis=1)
    assert (best <= bound + 1e-9).all()


def test_random_directions_few_points_and_more_than_there_are(spark, tmp_path):
    rows = np.random.default_rng(4).normal(size=(300, 16)).astype(np.float32)
    path = str(tmp_path / "table")
    table_of(spark, rows, path, pivots=8)
    asked = asked_of(spark, rows[:5])
    assert ranked(pivots.pivot_topk(spark, path, asked, 7)) == brute(rows, rows[:5], 7)
    assert ranked(pivots.pivot_topk(spark, path, asked, 1000)) == brute(rows, rows[:5], 1000)


def test_empty_tables_and_queries_without_direction(spark, tmp_path):
    empty, path = str(tmp_path / "empty"), str(tmp_path / "table")
    pivots.write_pivot_table(frame(spark, []), empty)
    rows = clustered(60)
    table_of(spark, rows, path)
    asked = asked_of(spark, np.stack([np.zeros(24), rows[0]]))
    assert pivots.pivot_topk(spark, empty, asked, 3).count() == 0
    assert ranked(pivots.pivot_topk(spark, path, asked, 3)) == {1: brute(rows, rows[[0]], 3)[0]}
    assert pivots.pivot_topk(spark, path, asked.limit(0), 3).count() == 0
