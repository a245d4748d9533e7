"""Next-fit packing by weight, exact and parallel.

Items are taken in order. An item opens a new bin when adding it would pass the
capacity and the current bin holds something; an item heavier than the capacity
gets a bin of its own. Where a bin ends depends on where it began, so the rule
looks sequential. It is run in parallel like this:

* Items are cut into buckets of consecutive order numbers. A bin that reaches
  into a bucket carrying weight c ends at the first item whose running weight
  exceeds ``cap - c``. Only items within the first ``cap`` of weight can be that
  item, so a bucket is described by those *entries* and, for each, what happens
  when a bin opens there: how many more bins open in the bucket and the weight
  the last one carries out.
* Such descriptions join into descriptions of longer runs, level by level, until
  what is left is small. None has more than ``cap + 1`` entries, as weights are
  whole numbers and items of weight zero never end a bin. Every level is a grouped job over narrow rows.
* The few rows left are walked once, and the known states go back down the
  levels to the buckets, where items get their bin numbers.

Keys within one bucket need none of this, as nothing is carried into them. Python
takes batches of whole buckets, so that many small keys cost little more than one large one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperweave.workspace import stage

_SUMMARY = "run_no bigint, run_total bigint, run_pin array<bigint>, run_opens array<bigint>, run_carry array<bigint>"
_STATE = "run_no bigint, carry_in bigint, bins_in bigint"


def _next_start(pin: np.ndarray, weight: np.ndarray, cap: int) -> np.ndarray:
    """For a bin opening at each item, the item that opens the next one (n if none)."""
    after = np.searchsorted(pin, pin - weight + cap, side="right")
    return np.maximum(after, np.arange(1, len(pin) + 1))


def _describe(weight: np.ndarray, cap: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    n = len(weight)
    pin = np.cumsum(weight)
    before = pin - weight
    nxt = _next_start(pin, weight, cap)
    # Follow 'next' from all items at once by doubling the step; an item whose
    # bin reaches the end of the bucket is where the walk rests.
    jump = np.where(nxt < n, nxt, np.arange(n))
    opens = (nxt < n).astype(np.int64)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        opens = opens + opens[jump]
        jump = further
    entry = (weight > 0) & (before <= cap)
    entry[0] = True
    total = int(pin[-1])
    return total, pin[entry], opens[entry], (total - before[jump])[entry]


def _describe_run(pdf: pd.DataFrame, cap: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Join the descriptions of neighbouring runs, given in order."""
    pins, opens, carry, total = [], np.empty(0, np.int64), np.empty(0, np.int64), 0
    for row in pdf.itertuples(index=False):
        pin = np.asarray(row.run_pin)
        at = np.searchsorted(pin, cap - carry, side="right")
        hit = at < len(pin)
        into = np.where(hit, at, 0)
        opens = np.where(hit, opens + 1 + np.asarray(row.run_opens)[into], opens)
        carry = np.where(hit, np.asarray(row.run_carry)[into], carry + row.run_total)
        reachable = total + np.concatenate(([0], pin[:-1])) <= cap
        if reachable.any():
            pins.append(total + pin[reachable])
            opens = np.concatenate((opens, np.asarray(row.run_opens)[reachable]))
            carry = np.concatenate((carry, np.asarray(row.run_carry)[reachable]))
        total += row.run_total
    return total, np.concatenate(pins), opens, carry


def _walk(pdf: pd.DataFrame, cap: int, carry: int, bins: int) -> list[tuple[int, int, int]]:
    """State on entering each run, for runs given in order."""
    states = []
    for row in pdf.itertuples(index=False):
        states.append((row.run_no, carry, bins))
        at = int(np.searchsorted(np.asarray(row.run_pin), cap - carry, side="right"))
        if at < len(row.run_pin):
            bins, carry = bins + 1 + int(row.run_opens[at]), int(row.run_carry[at])
        else:
            carry += int(row.run_total)
    return states


def _bins(weight: np.ndarray, cap: int, carry: int, bins: int) -> np.ndarray:
    pin = np.cumsum(weight)
    nxt = _next_start(pin, weight, cap).tolist()
    starts, at = [], int(np.searchsorted(pin, cap - carry, side="right"))
    while at < len(weight):
        starts.append(at)
        at = nxt[at]
    return bins + np.searchsorted(np.array(starts, np.int64), np.arange(len(weight)), side="right")


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows, cut anew so that no group is in two batches; ``_nth`` counts from 1 in each group."""
    held: list[pd.DataFrame] = []  # of the group that may go on in the next batch
    for pdf in batches:
        starts = np.flatnonzero(pdf["_nth"].to_numpy() == 1)
        if len(starts):
            ended = [*held, pdf.iloc[:starts[-1]]]
            if any(map(len, ended)):
                yield pd.concat(ended, ignore_index=True)
            held, pdf = [], pdf.iloc[starts[-1]:]
        held.append(pdf)
    if any(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def _in_groups(
    rows: DataFrame, group: Sequence[str | Column], order: str,
    work: Callable[[pd.DataFrame, list[tuple[int, int]]], pd.DataFrame], schema: str,
) -> DataFrame:
    """``work(rows, groups)`` on batches of whole groups: where each starts and ends, its rows being in ``order``."""
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(order))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_groups(batches):
            starts = np.flatnonzero(pdf["_nth"].to_numpy() == 1).tolist()
            yield work(pdf, list(zip(starts, [*starts[1:], len(pdf)])))

    return rows.withColumn("_nth", nth).mapInPandas(run, schema)


@dataclass(frozen=True)
class OpenBin:
    """Where a packing stands after its last item; a later packing goes on from here."""

    number: int  # of the last bin
    weight: int  # in it so far
    items: int   # in it so far
    last: int    # order number of the last item


def open_bin(packed: DataFrame, order: str, weight: str, bin_name: str = "bin_id") -> OpenBin | None:
    """The last bin of a packing without keys; None if nothing was packed."""
    last = packed.groupBy(bin_name).agg(
        F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n"), F.max(order).alias("o")).orderBy(F.desc(bin_name)).first()
    return None if last is None else OpenBin(last[bin_name], last["w"], last["n"], last["o"])


def pack_next_fit(
    items: DataFrame,
    order: str,
    weight: str,
    cap: int,
    by: Sequence[str] = (),
    extra: Sequence[str] = (),
    bin_name: str = "bin_id",
    rows_per_bucket: int = 1 << 18,
    max_group_entries: int = 1 << 20,
    resume: OpenBin | None = None,
) -> DataFrame:
    """Bin numbers from 1 within each ``by`` key: ``by``, ``order``, ``weight``, ``extra``, bin.

    ``order`` is a non-negative integer, unique within a key; it may have gaps.
    Only these columns move; ``extra`` ones are carried along and should be
    narrow. ``max_group_entries`` bounds what one task holds while descriptions
    are joined. With ``resume`` the items continue an earlier packing, as if both
    had been packed at once; their order numbers must lie behind its last one.
    """
    by, extra = list(by), list(extra)
    if resume is not None and by:
        raise ValueError("only a packing without keys can be resumed")
    # A carry above the capacity makes the very first item open bin 1.
    carried, opened = (resume.weight, resume.number) if resume else (cap + 1, 0)
    keys = [F.col(c) for c in by]
    sound = (F.col(weight) >= 0) & (F.col(order) > (resume.last if resume else -1))
    for key in keys:
        sound = sound & key.isNotNull()
    bad = F.raise_error(F.lit("packing needs a key, an order and a weight of zero or more on every row, "
                              "and orders behind those packed before"))
    checked = F.when(sound, F.col(weight).cast("bigint")).otherwise(bad.cast("bigint"))
    items = stage(items.select(*keys, F.col(order).cast("bigint").alias(order),
                               checked.alias(weight), *extra), "weights")
    items = items.withColumn("run_no", F.call_function("div", F.col(order), F.lit(rows_per_bucket)))
    types = {f.name: f.dataType.simpleString() for f in items.schema}
    key_ddl = "".join(f"`{c}` {types[c]}, " for c in by)
    # A summary row carries its key columns first.
    summary, state = key_ddl + _SUMMARY, key_ddl + _STATE

    def head(pdf: pd.DataFrame, at: int = 0) -> list:
        return [pdf[c].iat[at] for c in by]

    def describe(pdf: pd.DataFrame, groups: list[tuple[int, int]]) -> pd.DataFrame:
        weights, runs = pdf[weight].to_numpy(np.int64), pdf["run_no"].to_numpy()
        return pd.DataFrame([[*head(pdf, a), runs[a], *_describe(weights[a:b], cap)] for a, b in groups], columns=names)

    def join_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("run_no")
        row = head(pdf) + [pdf["run_group"].iloc[0], *_describe_run(pdf, cap)]
        return pd.DataFrame([row], columns=names)

    def walk_top(pdf: pd.DataFrame) -> pd.DataFrame:
        return walked(pdf, carried, opened)

    def walk_down(pdf: pd.DataFrame) -> pd.DataFrame:
        return walked(pdf, int(pdf["carry_in"].iloc[0]), int(pdf["bins_in"].iloc[0]))

    def walked(pdf: pd.DataFrame, carry: int, bins: int) -> pd.DataFrame:
        key = head(pdf)
        return pd.DataFrame([key + list(s) for s in _walk(pdf.sort_values("run_no"), cap, carry, bins)],
                            columns=by + ["run_no", "carry_in", "bins_in"])

    def assign(pdf: pd.DataFrame, groups: list[tuple[int, int]]) -> pd.DataFrame:
        weights, carry, bins = (pdf[c].to_numpy(np.int64) for c in (weight, "carry_in", "bins_in"))
        pdf[bin_name] = np.concatenate([_bins(weights[a:b], cap, int(carry[a]), int(bins[a])) for a, b in groups])
        return pdf[by + [order, weight] + extra + [bin_name]]

    names = by + ["run_no", "run_total", "run_pin", "run_opens", "run_carry"]
    # What starts and ends within one bucket has nothing carried in.
    ends = items.groupBy(*keys).agg(F.min("run_no").alias("_first"), F.max("run_no").alias("_last")).filter("_first < _last")
    if not ends.take(1):
        states = None
    else:
        parted = items.join(ends.select(*by), by, "left_semi") if by else items
        level = stage(_in_groups(parted, [*keys, "run_no"], order, describe, summary), "runs")
        levels, fan_ins = [level], []
        while True:
            # Sizes of the largest key, of its number of runs and of one run.
            per_key = level.groupBy(*keys).agg(
                F.sum(F.size("run_pin")).alias("entries"), F.count(F.lit(1)).alias("runs"),
                F.max(F.size("run_pin")).alias("largest"))
            entries, runs, largest = per_key.agg(F.max("entries"), F.max("runs"), F.max("largest")).first()
            if entries <= max_group_entries or runs == 1:
                break
            fan_in = max(2, max_group_entries // largest)
            grouped = level.withColumn("run_group", F.call_function("div", F.col("run_no"), F.lit(fan_in)))
            level = stage(grouped.groupBy(*keys, "run_group").applyInPandas(join_runs, summary), "runs")
            levels.append(level)
            fan_ins.append(fan_in)

        states = levels[-1].groupBy(*keys).applyInPandas(walk_top, state)
        for lower, fan_in in zip(reversed(levels[:-1]), reversed(fan_ins)):
            grouped = lower.withColumn("run_group", F.call_function("div", F.col("run_no"), F.lit(fan_in)))
            known = states.withColumnRenamed("run_no", "run_group")
            states = (grouped.join(known, by + ["run_group"])
                      .groupBy(*keys, "run_group").applyInPandas(walk_down, state))

    out = ", ".join(f"`{c}` {types[c]}" for c in by + [order, weight] + extra) + f", `{bin_name}` bigint"
    started = {"carry_in": F.lit(carried), "bins_in": F.lit(opened)}
    entered = (items.withColumns(started) if states is None else items.join(states, by + ["run_no"], "left").withColumns(
        {c: F.coalesce(F.col(c), start) for c, start in started.items()}))
    return _in_groups(entered, [*keys, "run_no"], order, assign, out)
