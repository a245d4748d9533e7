import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paperweave.llm import mixing as m


def brute_slots(shares, period):
    """Earliest deadline first among released blocks, one slot at a time."""
    served, out = Counter(), []
    for slot in range(period):
        ready = [(math.ceil(Fraction((served[s] + 1) * period, q)), s) for s, q in sorted(shares.items())
                 if served[s] < q and served[s] * period // q <= slot]
        chosen = min(ready)[1]
        served[chosen] += 1
        out.append(chosen)
    return out


@pytest.mark.parametrize("shares", [
    {"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 50, "b": 33, "c": 16, "d": 1}, {"a": 97, "b": 1, "c": 1, "d": 1},
    {f"s{i}": i + 1 for i in range(13)}, {"only": 5},
])
def test_period_is_the_greedy_schedule(spark, shares):
    period = sum(shares.values())
    plan = spark.createDataFrame(list(shares.items()), "tag string, q int")
    rows = m.period_slots(plan, period).orderBy("slot").collect()
    assert [r.tag for r in rows] == brute_slots(shares, period)
    seen = Counter()
    for slot, r in enumerate(rows, 1):
        assert r.turn == seen[r.tag]
        seen[r.tag] += 1
        assert all(abs(seen[s] - Fraction(slot * q, period)) < 1 for s, q in shares.items())


def mixed(spark, counts, **how):
    rows = [(i, s) for i, s in enumerate(x for s, n in counts.items() for x in [s] * n)]
    return m.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), **how).collect()


def test_every_row_once_and_within_a_block(spark):
    counts, weights = {"a": 3000, "b": 900, "c": 300}, {"a": 0.6, "b": 0.3, "c": 0.1}
    rows = sorted(mixed(spark, counts, weights=weights, block=10, period=40), key=lambda r: r.mix_pos)
    assert [r.mix_pos for r in rows] == list(range(4200)) and len({r.id for r in rows}) == 4200
    plan = {r.tag[1:]: r.q for r in m.source_plan(
        spark.createDataFrame([(f"={s}", n) for s, n in counts.items()], "tag string, n bigint"), weights, 10, 40).collect()}
    assert sum(plan.values()) == 40
    left, seen = dict(counts), Counter()
    for slot, r in enumerate(rows[::10], 1):
        seen[r.source] += 1
        assert len({x.source for x in rows[slot * 10 - 10:slot * 10]}) == 1  # whole blocks
        if all(seen[s] * 10 < left[s] for s in left):  # no source has run out
            assert all(abs(seen[s] - Fraction(slot * q, 40)) < 1 for s, q in plan.items())
    # On the slot clock this holds for every source until it ends.
    for s, q in plan.items():
        own = sorted({r.slot for r in rows if r.source == s})
        assert all(abs(i + 1 - Fraction((slot + 1) * q, 40)) < 1 for i, slot in enumerate(own))


def test_weights_from_sizes(spark):
    plan = m.source_plan(spark.createDataFrame([("=a", 10_000), ("=b", 100), ("-", 1)], "tag string, n bigint"))
    q = {r.tag: r.q for r in plan.collect()}
    assert sum(q.values()) == m.PERIOD and 9 < q["=a"] / q["=b"] < 11 and q["-"] >= 1


def test_odd_rows(odd_docs, no_docs, spread, spark):
    wide = spread(odd_docs)
    assert m.mix(wide).count() == odd_docs.count()
    ordered = m.in_mixed_order(wide)
    assert ordered.columns == wide.columns and ordered.count() == wide.count()
    assert m.mix(no_docs).count() == 0 and m.in_mixed_order(no_docs).count() == 0
    with pytest.raises(ValueError, match="longer period"):
        m.mix(spark.range(5).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source")), period=4)
    with pytest.raises(ValueError, match="positive"):
        m.mix(odd_docs, weights={"s0": 0})


def test_rows_come_in_order(spark):
    rows = [(i, f"s{i % 3}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    places = {r.id: r.mix_pos for r in m.mix(docs, block=4, period=30).collect()}
    assert [places[r.doc_id] for r in m.in_mixed_order(docs, block=4, period=30).collect()] == list(range(500))
