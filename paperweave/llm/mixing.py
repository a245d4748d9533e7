"""Mixing sources to target weights by Pfair scheduling.

A source's rows, in a keyed random order, form blocks. Weights are whole shares
of a period of slots. Block i of a source with q of the period's Q slots is
released at slot floor((i - 1) Q / q) and due by slot ceil(i Q / q); earliest
deadline first among the released ones meets every deadline, so at every slot
each source is less than one block away from its target. All shares are whole
at the end of a period, so the schedule of one period serves all of them and a
block's slot is plain arithmetic.

Every row gets a place; none is dropped or repeated. When a source runs out, its slots
are passed over: the others follow more closely, in their proportions. Until
then the deviation in the result is below one block; afterwards it is so on the
slot clock.

Rows are numbered in buckets of about ``BUCKET`` rows, so a source that holds
most rows is spread over many tasks. Only the per-source table is broadcast; it
has at most ``period`` rows, which is checked.

Defined results: null is a source of its own. Rows with equal ids and sources
are placed like others; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.llm.common import fresh, need, quoted, running_before
from paperweave.workspace import stage

BLOCK, PERIOD, BUCKET, SPAN = 64, 4000, 1000, 100_000
ALPHA = 0.5  # without given weights, a source weighs its row count to this power
KEY = "mixing"


def _tag(source: Column) -> Column:
    """The source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def source_plan(
    counts: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, period: int = PERIOD,
    alpha: float = ALPHA,
) -> DataFrame:
    """Per source: its rows, its buckets and its slots of the period, by largest remainders, one at least.

    ``weights`` are relative; sources that it doesn't name share the smallest of them.
    """
    if weights is not None and (not weights or min(weights.values()) <= 0):
        raise ValueError("weights must be positive")
    weight = F.pow(F.col("n").cast("double"), F.lit(alpha))
    if weights is not None:
        named = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (f"={k}", float(v))])
        weight = F.coalesce(named[F.col("tag")], F.lit(float(min(weights.values()))))
    every = Window.partitionBy()
    sources = F.count(F.lit(1)).over(every)
    share = F.col("weight") / F.sum("weight").over(every) * (F.lit(period) - sources)
    before = Window.orderBy("tag").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("weight", weight)
            .withColumn("share", share)
            .withColumn("whole", F.floor("share"))
            .withColumn("spare", F.lit(period) - sources - F.sum("whole").over(every))
            .withColumn("turn", F.row_number().over(Window.orderBy(F.desc(F.col("share") - F.col("whole")), "tag")))
            .withColumn("q", (F.lit(1) + F.col("whole") + (F.col("turn") <= F.col("spare")).cast("int")).cast("int"))
            .withColumn("buckets", F.ceil(F.col("n") / BUCKET))
            .withColumn("first_bucket", F.coalesce(F.sum("buckets").over(before), F.lit(0)))
            .withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .select("tag", "n", "weight", "q", "buckets", "first_bucket", "rows_before"))


def period_slots(plan: DataFrame, period: int = PERIOD) -> DataFrame:
    """(tag, turn, slot): which slot of the period serves each turn of each source.

    One fold over the slots of a single row, the array of sources.
    """
    sources = plan.agg(F.array_sort(F.collect_list(F.struct("tag", "q"))).alias("sources"))

    def serve(state: Column, slot: Column) -> Column:
        # (deadline, source) of every released block; the smallest is served.
        due = F.transform(F.arrays_zip(F.col("sources"), state["served"].alias("served")), lambda x, s: F.when(
            (x["served"] < x["sources"]["q"])
            & (F.floor(x["served"] * F.lit(period) / x["sources"]["q"]) <= slot),
            F.struct(F.ceil((x["served"] + 1) * F.lit(period) / x["sources"]["q"]).alias("d"), s.alias("s"))))
        chosen = F.array_min(due)["s"]
        return F.struct(
            F.transform(state["served"], lambda n, s: F.when(s == chosen, n + 1).otherwise(n)).alias("served"),
            F.array_append(state["order"], chosen).alias("order"))

    first = F.struct(F.transform("sources", lambda _: F.lit(0)).alias("served"),
                     F.array().cast("array<int>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), first, serve)["order"]
    slots = sources.filter(F.size("sources") > 0).withColumn("order", order).select(
        "sources", F.posexplode("order").alias("slot", "s")).select("slot", F.get("sources", F.col("s"))["tag"].alias("tag"))
    return slots.withColumn("turn", F.row_number().over(Window.partitionBy("tag").orderBy("slot")) - 1)


def mix(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", weights: Mapping[str, float] | None = None,
    block: int = BLOCK, period: int = PERIOD, alpha: float = ALPHA, key: str = KEY,
) -> DataFrame:
    """(id, source, block, slot, mix_pos) of every row; ``mix_pos`` counts from 0 without gaps."""
    need(docs, id_column, source)
    rows = docs.select(quoted(id_column).alias("id"), quoted(source).alias("source")).withColumns({
        "tag": _tag(F.col("source")), "hash": F.xxhash64(F.lit(key), quoted("id"))})
    counts = rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    plan = stage(source_plan(counts, weights, block, period, alpha), "mix-sources")
    if plan.count() > period:
        raise ValueError(f"more sources than the {period} slots of a period; give a longer period")
    slots = stage(period_slots(plan, period), "mix-slots")

    placed = rows.join(F.broadcast(plan.select("tag", "q", "buckets", "first_bucket", "rows_before")), "tag")
    placed = placed.withColumn("bucket", F.col("first_bucket") + F.pmod(F.xxhash64("hash"), F.col("buckets")))
    sizes = running_before(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")), "bucket", "rows", "before", SPAN)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("hash", "id"))
    numbered = placed.withColumn("rank", rank).join(sizes.select("bucket", "before"), "bucket").withColumn(
        "at", F.col("before") - F.col("rows_before") + F.col("rank") - 1)

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    blocks = numbered.withColumn("block", div(F.col("at"), F.lit(block))).withColumn(
        "turn", (F.col("block") % F.col("q")).cast("int"))
    slotted = blocks.join(F.broadcast(slots), ["tag", "turn"]).select(
        "id", "source", "block", (div(F.col("block"), F.col("q").cast("bigint")) * period + F.col("slot")).alias("slot"),
        (F.col("at") % block).alias("inner"))
    slotted = stage(slotted, "mix-rows")
    ahead = running_before(slotted.groupBy("slot").agg(F.count(F.lit(1)).alias("rows")), "slot", "rows", "ahead", SPAN)
    return slotted.join(ahead.select("slot", "ahead"), "slot").select(
        "id", "source", "block", "slot", (F.col("ahead") + F.col("inner")).alias("mix_pos"))


def in_mixed_order(docs: DataFrame, id_column: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """``docs`` in the order of the mix: ranges of places, each sorted. Rows without an id come first."""
    same, place = fresh(docs, "_id", "_place")
    places = mix(docs, id_column, source, **how).groupBy("id").agg(F.min("mix_pos").alias(place))
    placed = docs.join(places.withColumnRenamed("id", same).hint("merge"), quoted(id_column) == F.col(same), "left")
    return placed.repartitionByRange(place).sortWithinPartitions(place).select(*[quoted(c) for c in docs.columns])
