"""Columns and small helpers that several of these operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The white space of every word rule here, as in [\x20\x09-\x0D].
BLANKS = "\t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def blank_words(text: Column) -> Column:
    """Runs of characters other than white space; plain byte searches, no pattern."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of single bytes take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has (Spark compares them without case)."""
    taken, made = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        made.append(name)
    return made


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def running_before(df: DataFrame, key: str, value: str, name: str, span: int) -> DataFrame:
    """Adds the sum of ``value`` over all smaller ``key``; keys are whole numbers, each once.

    Two levels: spans of ``span`` keys, then the spans' totals. One task never
    orders more than a span or the totals, a ``span``-th of the keys.
    """
    spans = df.withColumn("_span", F.floor(quoted(key) / F.lit(span)))
    totals = spans.groupBy("_span").agg(F.sum(quoted(value)).alias("_total"))
    before = totals.select("_span", (F.sum("_total").over(
        Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    inner = F.sum(quoted(value)).over(
        Window.partitionBy("_span").orderBy(quoted(key)).rowsBetween(Window.unboundedPreceding, -1))
    return (spans.withColumn("_inner", inner).join(before, "_span")
            .withColumn(name, F.coalesce("_inner", F.lit(0)) + F.coalesce("_before", F.lit(0)))
            .drop("_span", "_inner", "_before"))
