"""Text, list and date rules of the cleaning job, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) widens \s to every Unicode white space character.
_SPACES = r"(?U)\s+"
_EDGE_SPACES = r"(?U)\A\s+|\s+\z"


def collapse_spaces(text: Column) -> Column:
    """Every white-space run (newlines included) becomes one space; ends are cut."""
    return F.trim(F.regexp_replace(text, _SPACES, " "))


def strip_spaces(text: Column) -> Column:
    """Cut Unicode white space at both ends and leave the inside alone."""
    return F.regexp_replace(text, _EDGE_SPACES, "")


def split_words(text: Column) -> Column:
    """Split on single spaces, keeping empty parts."""
    return F.split(text, " ", -1)


def overlaps(items: Column, allowed: list[str]) -> Column:
    """True where the list shares a value with ``allowed``; null for a null list."""
    return F.arrays_overlap(items, F.array(*[F.lit(v) for v in allowed]))


def common_items(items: Column, allowed: list[str]) -> Column:
    """Distinct values of the list that are in ``allowed``."""
    return F.array_intersect(items, F.array(*[F.lit(v) for v in allowed]))


def reversed_name(parts: Column) -> Column:
    """Name parts in reverse, joined by spaces: [last, first, suffix] -> 'suffix first last'."""
    return strip_spaces(F.array_join(F.reverse(parts), " "))


def display_names(authors: Column) -> Column:
    return F.transform(authors, reversed_name)


def last_item(items: Column) -> Column:
    """Last element, null for an empty or null list."""
    return F.try_element_at(items, F.lit(-1))


def concat_fields(*columns: Column, separator: str = "\n\n") -> Column:
    """Join columns with a separator; a null in any of them makes the text null."""
    parts: list[Column] = []
    for column in columns:
        parts += [column] if not parts else [F.lit(separator), column]
    return F.concat(*parts)


def parse_http_date(text: Column, strict: bool = True) -> Column:
    """'Mon, 2 Apr 2007 19:18:42 GMT' as a timestamp without time zone.

    The weekday must be the date's own. A text that does not fit raises, or
    gives null with ``strict=False``.
    """
    # Spark refuses weekday letters when parsing, so the weekday is cut off and
    # compared with the one the parsed date has.
    moment = F.to_timestamp_ntz if strict else _try_ntz
    parsed = moment(F.substring_index(text, ", ", -1), F.lit("d MMM yyyy HH:mm:ss 'GMT'"))
    fits = F.lower(F.dayname(parsed)) == F.lower(F.substring_index(text, ", ", 1))
    if not strict:
        return F.when(fits, parsed)
    problem = F.raise_error(F.concat(F.lit("not a valid date: "), text)).cast("timestamp_ntz")
    return F.when(text.isNull() | fits, parsed).otherwise(problem)


def _try_ntz(text: Column, pattern: Column) -> Column:
    # Read as an instant in UTC and counted from the epoch, so that the session's
    # time zone and its clock changes play no part.
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.concat(pattern, F.lit(" Z")))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=F.unix_seconds(instant))
