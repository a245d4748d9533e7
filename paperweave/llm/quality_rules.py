"""Quality rules: a threshold table compiled into one projection.

Each rule bounds a measure of the text. Measures are built-in functions over
the whole text, so a scan judges it inside the JVM without a shuffle.

Defined results: a null or empty text has no words, fails the base rule and is
not kept. Repeated rows are judged alike. Measures with nothing to divide by
are 0. Other columns pass through; one that has the name of a measure raises.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import blank_words, fresh, need, quoted, text_of

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that it for on with as was by this from be at or are an",
    "fr": "le la les de des du et un une en est que qui pour dans au aux par sur pas plus avec",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "es": "el la los las de del y que en un una por con para se no su al lo como más",
}
ALL_STOP_WORDS = sorted({w for words in STOP_WORDS.values() for w in words.split()})


@dataclass(frozen=True)
class Rule:
    """Keeps texts whose ``measure`` lies between ``least`` and ``most``, ends included."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("mean word length", "mean_word_chars", 2.0, 12.0),
    Rule("symbols per word", "symbol_ratio", None, 0.1),
    Rule("stop words per word", "stop_ratio", 0.05, None),
    Rule("repeated lines", "dup_line_ratio", None, 0.6),
    Rule("list lines", "bullet_line_ratio", None, 0.9),
    Rule("lines cut off", "ellipsis_line_ratio", None, 0.3),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio", "bullet_line_ratio",
          "ellipsis_line_ratio")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once for each row.

    A plain column would be put in the place of its name wherever a filter is
    moved below it, also inside the functions of a list, once for every item.
    """
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by windows that occur more than once.

    Window hashes show which texts repeat anything at all. Only those texts
    sort their windows, by hash and then by the words themselves, so that equal
    ones lie side by side; the starts of these, in order, give the cover.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(ordered: Column) -> Column:
        last = F.size(ordered)

        def same(i: Column, j: Column) -> Column:
            a, b = F.get(ordered, i), F.get(ordered, j)
            return (a["h"] == b["h"]) & (a["w"] == b["w"])

        marked = F.transform(ordered, lambda x, i: F.when(
            ((i > 0) & same(i - 1, i)) | ((i < last - 1) & same(i, i + 1)), x["i"]))
        found = F.array_sort(F.array_compact(marked))
        total = F.aggregate(
            found, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("at")),
            lambda acc, x: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), x - acc["at"])).alias("n"), x.alias("at")))
        return total["n"]

    ordered = F.sort_array(F.transform(starts, lambda i: F.struct(
        F.xxhash64(F.slice(words, i, WINDOW)).alias("h"), F.slice(words, i, WINDOW).alias("w"), i.alias("i"))))
    repeats = _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < WINDOW + 1, F.lit(0)).when(repeats, _let(ordered, covered)).otherwise(F.lit(0)).cast("bigint")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def measures(text: Column, stop_words: Sequence[str] = ALL_STOP_WORDS) -> Column:
    """All measures of a text as one struct; words and lines are split once."""
    forms = sorted({f for w in stop_words for f in (w, w[:1].upper() + w[1:])})

    def lines_like(lines: Column, pattern: str) -> Column:
        return F.size(F.filter(lines, lambda line: line.rlike(pattern)))

    def counted(text: Column, words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: w.isin(forms))).alias("n_stop"),
            lines_like(lines, "^[ \\t-\\r]*[-*•]").alias("n_bullet"),
            lines_like(lines, "(\\.\\.\\.|…)[ \\t-\\r]*$").alias("n_cut"),
            F.size(lines).alias("n_lines"))

    def with_ratios(m: Column) -> Column:
        return F.struct(
            *[m[c].alias(c) for c in BASE],
            _ratio(m["word_chars"], m["n_words"]).alias("mean_word_chars"),
            _ratio(m["n_symbols"], m["n_words"]).alias("symbol_ratio"),
            _ratio(m["n_stop"], m["n_words"]).alias("stop_ratio"),
            _ratio(m["n_dup_lines"], m["n_lines"]).alias("dup_line_ratio"),
            _ratio(m["n_bullet"], m["n_lines"]).alias("bullet_line_ratio"),
            _ratio(m["n_cut"], m["n_lines"]).alias("ellipsis_line_ratio"))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    return _let(blank_words(text), lambda words: _let(
        lines, lambda found: _let(counted(text, words, found), with_ratios)))


def _with_fields(docs: DataFrame, fields: Column, names: Sequence[str]) -> DataFrame:
    """``docs`` with the fields of one struct; a filter on a field works the struct out once more, no more."""
    clash = {c.lower() for c in docs.columns} & set(names)
    if clash:
        raise ValueError(f"columns named like measures: {sorted(clash)}")
    (m,) = fresh(docs, "_measures")
    return docs.withColumn(m, fields).select(
        *[quoted(c) for c in docs.columns], *[F.col(m)[c].alias(c) for c in names])


def measure(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = ALL_STOP_WORDS) -> DataFrame:
    """``docs`` with every measure."""
    need(docs, text)
    return _with_fields(docs, measures(text_of(quoted(text)), stop_words), [*BASE, *RATIOS])


def base_failed(of: Callable[[str], Column] = F.col) -> Column:
    """Too short or too repetitive to be judged further; ``of`` gives a measure by its name."""
    return (of("n_words") < LEAST_WORDS) | (100 * of("n_repeat_words") > MOST_REPEATED * of("n_words"))


def broken_rules(rules: Sequence[Rule] = RULES, of: Callable[[str], Column] = F.col) -> Column:
    """Names of the rules that the measures break, in the table's order."""
    def breaks(rule: Rule) -> Column:
        value, out = of(rule.measure), F.lit(False)
        if rule.least is not None:
            out = out | (value < F.lit(rule.least))
        if rule.most is not None:
            out = out | (value > F.lit(rule.most))
        return out

    return F.array_compact(F.array(*[F.when(breaks(r), F.lit(r.name)) for r in rules]).cast("array<string>"))


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``broken`` and ``kept``."""
    need(docs, text)

    def verdict(m: Column) -> Column:
        failed, broken = base_failed(lambda c: m[c]), broken_rules(rules, lambda c: m[c])
        return F.struct(*[m[c].alias(c) for c in (*BASE, *RATIOS)], failed.alias("base_failed"),
                        broken.alias("broken"), (~failed & (F.size(broken) == 0)).alias("kept"))

    return _with_fields(docs, _let(measures(text_of(quoted(text))), verdict), [*BASE, *RATIOS, "base_failed", "broken", "kept"])


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were."""
    need(docs, text)
    good = _let(measures(text_of(quoted(text))), lambda m: ~base_failed(lambda c: m[c]) & (
        F.size(broken_rules(rules, lambda c: m[c])) == 0))
    return docs.filter(good)
