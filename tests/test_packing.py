"""Packing equals the sequential rule, whatever the cuts."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperweave.operators import packing


def sequential(weights, cap):
    bins, current, number, filled = [], 0, 1, False
    for w in weights:
        if filled and current + w > cap:
            number, current = number + 1, 0
        current += w
        filled = True
        bins.append(number)
    return bins


def in_levels(weights, cap, bucket, fan_in):
    """The operator's three steps on plain arrays."""
    cuts = [np.array(weights[i:i + bucket], np.int64) for i in range(0, len(weights), bucket)]
    columns = ["run_no", "run_total", "run_pin", "run_opens", "run_carry"]
    level = pd.DataFrame([[i, *packing._describe(c, cap)] for i, c in enumerate(cuts)], columns=columns)
    levels = [level]
    while len(level) > 2:
        groups = level.groupby(level["run_no"] // fan_in)
        level = pd.DataFrame([[g, *packing._describe_run(part, cap)] for g, part in groups],
                             columns=columns)
        levels.append(level)
    states = packing._walk(levels[-1], cap, cap + 1, 0)
    for lower in reversed(levels[:-1]):
        down = []
        for group, carry, bins in states:
            part = lower[lower["run_no"] // fan_in == group]
            down += packing._walk(part, cap, carry, bins)
        states = down
    out = []
    for number, carry, bins in states:
        out += packing._bins(cuts[number], cap, carry, bins).tolist()
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 12), st.integers(0, 60)), min_size=1, max_size=80),
       st.integers(1, 40), st.integers(1, 9), st.integers(2, 4))
def test_levels_equal_sequential(weights, cap, bucket, fan_in):
    assert in_levels(weights, cap, bucket, fan_in) == sequential(weights, cap)


@pytest.mark.parametrize("weights,cap", [
    ([5, 5], 10), ([5, 6], 10), ([30, 1, 1], 10), ([1, 30, 0, 1], 10), ([1, 1, 30], 10),
    ([0, 0, 30, 0], 10), ([0, 0, 0], 10), ([11, 11, 11], 10), ([7], 10)])
def test_edge_cases(weights, cap):
    for bucket in (1, 2, 3):
        assert in_levels(weights, cap, bucket, 2) == sequential(weights, cap)


@pytest.mark.parametrize("bucket,entries", [(1 << 18, 1 << 20), (64, 200), (16, 20)])
def test_operator_on_keys(spark, bucket, entries):
    rng = random.Random(7)
    rows, expected = [], {}
    for key, n in (("a", 900), ("b", 300), ("c", 1)):
        weights = [rng.choice([0, 1, 5, 20, 70]) for _ in range(n)]
        rows += [(key, i, w) for i, w in enumerate(weights)]
        expected |= {(key, i): b for i, b in enumerate(sequential(weights, 60))}
    rng.shuffle(rows)
    items = spark.createDataFrame(rows, "k string, i bigint, w bigint").repartition(7)
    got = packing.pack_next_fit(items, "i", "w", 60, by=["k"], rows_per_bucket=bucket,
                                max_group_entries=entries).collect()
    assert {(r["k"], r["i"]): r["bin_id"] for r in got} == expected


@given(st.lists(st.integers(1, 9), min_size=1, max_size=20), st.lists(st.integers(0, 12), max_size=20))
def test_batches_are_cut_at_groups(sizes, cuts):
    """Whole groups in order, however the batches were cut; empty ones are no matter."""
    rows = pd.DataFrame([(g, n) for g, size in enumerate(sizes) for n in range(1, size + 1)], columns=["g", "_nth"])
    borders = [0, *sorted(min(c * 7, len(rows)) for c in cuts), len(rows)]
    got = list(packing._whole_groups(rows.iloc[a:b] for a, b in zip(borders, borders[1:])))
    assert pd.concat(got, ignore_index=True).equals(rows)
    assert all(len(pdf) and pdf["_nth"].iat[0] == 1 for pdf in got)


def test_many_small_keys(spark, monkeypatch):
    """Keys are neighbouring numbers, as batches are of requests: a bucket border parts one key at most."""
    stage, summarised = packing.stage, []

    def seen(df, label, **options):
        made = stage(df, label, **options)
        if label == "runs":
            summarised.append({(r["k"], r["run_no"]) for r in made.collect()})
        return made

    monkeypatch.setattr(packing, "stage", seen)
    weights = [(i * 7919) % 53 for i in range(3000)]
    items = spark.createDataFrame([(i // 10, i, w) for i, w in enumerate(weights)], "k bigint, i bigint, w bigint").repartition(5)
    packed = packing.pack_next_fit(items, "i", "w", 100, by=["k"], rows_per_bucket=1024)
    # Only parted keys are summarised, and no call of Python is for one key alone.
    assert summarised == [{(102, 0), (102, 1), (204, 1), (204, 2)}]
    assert "FlatMapGroupsInPandas" not in plan_above_states(packed)
    monkeypatch.undo()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # keys lie in two batches
    try:
        got = {(r["k"], r["i"]): r["bin_id"] for r in packed.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {(k, 10 * k + n): b for k in range(300) for n, b in enumerate(sequential(weights[10 * k:10 * k + 10], 100))}


def plan_above_states(packed):
    """The plan down to the join with the states that parted keys are entered with."""
    text = packed._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("Join")]


def test_operator_without_keys_and_gaps(spark):
    weights = [(i * 7919) % 53 for i in range(500)]
    items = spark.createDataFrame([(3 * i, w) for i, w in enumerate(weights)], "i bigint, w bigint")
    got = packing.pack_next_fit(items, "i", "w", 100, rows_per_bucket=50, max_group_entries=30)
    assert [r["bin_id"] for r in got.orderBy("i").collect()] == sequential(weights, 100)
    assert packing.pack_next_fit(items.limit(0), "i", "w", 100).count() == 0


def test_missing_weight_is_an_error(spark):
    for row in ((1, None), (None, 1), (1, -1)):
        items = spark.createDataFrame([row], "i bigint, w bigint")
        with pytest.raises(Exception, match="packing needs"):
            packing.pack_next_fit(items, "i", "w", 100).collect()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 12), st.integers(0, 60)), min_size=1, max_size=40),
       st.lists(st.one_of(st.just(0), st.integers(0, 12), st.integers(0, 60)), min_size=1, max_size=40), st.integers(1, 40))
def test_a_packing_goes_on_from_its_open_bin(first, then, cap):
    bins = sequential(first, cap)
    weight = sum(w for w, b in zip(first, bins) if b == bins[-1])
    got = packing._bins(np.array(then, np.int64), cap, weight, bins[-1]).tolist()
    assert bins + got == sequential(first + then, cap)


@pytest.mark.parametrize("bucket", [7, 1 << 18])
def test_resumed_packing(spark, bucket):
    rng = random.Random(5)
    weights = [rng.choice([0, 0, 3, 9, 14, 40]) for _ in range(120)]
    items = spark.createDataFrame(list(enumerate(weights)), "i bigint, w bigint")
    resume, got = None, []
    for low, high in [(0, 50), (50, 50), (50, 51), (51, 120)]:
        packed = packing.pack_next_fit(items.filter(f"i >= {low} and i < {high}"), "i", "w", 20,
                                       rows_per_bucket=bucket, resume=resume)
        now = packing.open_bin(packed, "i", "w")
        if now and resume and now.number == resume.number:
            now = packing.OpenBin(now.number, now.weight + resume.weight, now.items + resume.items, now.last)
        resume = now or resume
        got += [r["bin_id"] for r in packed.orderBy("i").collect()]
    assert got == sequential(weights, 20)
    assert resume == packing.OpenBin(
        got[-1], sum(w for w, b in zip(weights, got) if b == got[-1]), got.count(got[-1]), 119)
    with pytest.raises(Exception, match="behind those packed before"):
        packing.pack_next_fit(items, "i", "w", 20, resume=resume).collect()
