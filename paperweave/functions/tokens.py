"""Token counts, the weights of request packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Pre-tokens: one letter of a script without word gaps, up to four other letters,
# up to three digits, or one other visible character. The bounds keep the count in
# proportion to the text, so a token budget bounds it in any script.
_SINGLE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
_MORE = r"[A-Za-z\p{L}\p{M}]{0,3}+"
_GAP = r"[ \p{Z}\p{C}]"
# Each pre-token with the gap behind it shrinks to its first character, held by one of
# four groups; other visible characters match nothing and stay. The commonest letters
# come first, so that most characters never meet the script classes.
TOKEN_PATTERN = (rf"(?:([A-Za-z]){_MORE}|({_SINGLE})|([\p{{L}}\p{{M}}]){_MORE}|(\p{{N}})\p{{N}}{{0,2}}+){_GAP}*+"
                 rf"|{_GAP}++")
FIRST_CHARACTERS = "$1$2$3$4"


def token_count(text: Column) -> Column:
    """Number of pre-tokens of a text, JVM-side; null for a null text.

    It is the length of what remains, so no list of matches is built. A text of white
    space only counts one, as no tokenizer gives none for it, so a token budget bounds
    the texts of a request too.
    """
    least = F.when(text != "", 1).otherwise(0)
    first = F.length(F.regexp_replace(text, TOKEN_PATTERN, FIRST_CHARACTERS))
    return F.when(text.isNotNull(), F.greatest(first, least)).cast("bigint")


def tokenizer_count(load: Callable[[], Callable[[str], list]]) -> Callable[[Column], Column]:
    """Count with a real tokenizer: ``load`` returns its encode function.

    ``load`` runs once per task, and texts arrive in Arrow batches.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            yield texts.map(lambda t: len(encode(t)), na_action="ignore").astype("Int64")

    return count
