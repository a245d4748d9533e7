"""Digest trees find the ids that a full comparison finds."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperweave.operators import digests, realign

from test_plans import exchanges, plan


def frame(spark, ids, name):
    return spark.createDataFrame([(i,) for i in ids], f"{name} bigint")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [digests.MAX_RANGES, 0])
def test_odd_ids_equal_a_full_comparison(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(digests, "MAX_RANGES", limit)
    some = random.Random(seed)
    start = [0, -70, 10**12, 5][seed]
    ids = [start + i for i in range(300) if seed != 3 or i % 3]  # the last has gaps on both sides
    v, r = list(ids), list(ids)
    for side in (v, r):
        side.remove(some.choice(side))
        side.append(some.choice(side))  # the count stays
    twice = some.choice(ids)
    v.append(twice)
    r.append(twice)
    if seed == 2:
        v.append(None)
    both = digests.sides(frame(spark, v, "vec_idx"), frame(spark, r, "row_idx"))
    n_v, n_r = Counter(v), Counter(r)
    want = {(i, n_v[i], n_r[i]) for i in {*v, *r} if (n_v[i], n_r[i]) != (1, 1)}
    assert {tuple(x) for x in digests.odd_ids(both, (64, 8)).collect()} == want
    ranges = {x["range_no"] for x in digests.differing_ranges(both, 8).collect()}
    # Ranges are cut by division towards zero.
    assert ranges == {None if i is None else -(-i // 8) if i < 0 else i // 8 for i, _, _ in want}


def test_swapped_counts_do_not_pass(spark):
    """Ids that cancel under xor, and equal sets with repeats, are still found."""
    both = digests.sides(frame(spark, [0, 1, 1, 1], "vec_idx"), frame(spark, [0, 0, 0, 1], "row_idx"))
    assert {tuple(x) for x in digests.odd_ids(both).collect()} == {(0, 1, 3), (1, 3, 1)}
    same = digests.sides(frame(spark, [0, 1, 1], "vec_idx"), frame(spark, [0, 1, 1], "row_idx"))
    assert [tuple(x) for x in digests.odd_ids(same).collect()] == [(1, 2, 2)]


def test_empty_sides(spark):
    both = digests.sides(frame(spark, [], "vec_idx"), frame(spark, [], "row_idx"))
    assert digests.odd_ids(both).count() == 0 and digests.differing_ranges(both, 8).count() == 0
    assert realign.require_alignment(frame(spark, [], "vec_idx"), frame(spark, [], "row_idx")) == 0


def test_aligned_ids_stay_in_their_tasks(spark):
    """Each task sends one row per range; the ids themselves don't move."""
    ids = spark.range(200_000, numPartitions=4)
    ranges = digests.range_digests(digests.sides(ids, ids, "id", "id"), digests.WIDTHS[0])
    assert exchanges(plan(ranges)) == 1
    assert ranges.filter("not settled").count() == 0
    assert "partial_bit_xor" in plan(ranges)
    assert realign.require_alignment(ids, ids, "id", "id") == 200_000
    with pytest.raises(ValueError, match="id 7 has 0 vectors and 1 records"):
        realign.require_alignment(ids.withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id"))), ids, "id", "id")
