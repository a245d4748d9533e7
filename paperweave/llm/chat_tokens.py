"""Chat formatting on the level of tokens.

Every turn is assembled by itself: role marks are reserved ids beyond the
vocabulary, spliced around the ids of the text, which is encoded separately and
so never yields a reserved id. The loss mask is a prefix sum: +1 after a mark that
opens a trained role, -1 before the one that closes it. A turn's place among its
conversation's tokens is a prefix sum over the turns, taken in spans, so that a
conversation of any length is spread over tasks.

Control strings in a text are escaped before encoding, so that the rendered text
is unambiguous too: a backslash goes before them, and backslashes before a control
string or at a text's end are doubled. A control string is one of the template's
where an even number of backslashes precedes it. Reading back undoes this.

Roles of ``ROLES`` have marks of their own; any other role is written as text
between ``[TURN]`` and ``[TEXT]``.

Defined results: a null text or role is empty. Turns go by number, nulls first;
several with one number by a digest of their tokens. A null conversation id is a
conversation of its own. Repeated rows are turns like others. An empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperweave.llm import bpe
from paperweave.llm.common import need, quoted, running_before
from paperweave.operators.order import dense_row_index
from paperweave.workspace import stage

# Marks that open and close a role's turn.
ROLES = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("<s>", "</s>")}
OTHER, BODY, OTHER_END = "[TURN]", "[TEXT]", "[/TURN]"
TRAINED = ("assistant",)
SPAN = 100_000


class Template(NamedTuple):
    """Control strings in the order of their reserved ids, and the roles that are trained."""

    controls: tuple[str, ...]
    trained: tuple[str, ...]

    def pattern(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True)))


def template(trained: Sequence[str] = TRAINED) -> Template:
    unknown = set(trained) - set(ROLES)
    if unknown:
        raise ValueError(f"no marks for trained roles {sorted(unknown)}")
    return Template((*[c for pair in ROLES.values() for c in pair], OTHER, BODY, OTHER_END), tuple(trained))


def _backslashes(text: str) -> int:
    return len(text) - len(text.rstrip("\\"))


def escape(text: str, controls: re.Pattern) -> str:
    out, at = [], 0
    for found in controls.finditer(text):
        before = text[at:found.start()]
        out += [before, "\\" * (_backslashes(before) + 1), found.group()]
        at = found.end()
    rest = text[at:]
    return "".join([*out, rest, "\\" * _backslashes(rest)])


def unescape(text: str, controls: re.Pattern) -> str:
    out, at = [], 0
    for found in controls.finditer(text):
        before = text[at:found.start()]
        n = _backslashes(before)
        out += [before[:len(before) - n], "\\" * (n // 2), found.group()]
        at = found.end()
    rest = text[at:]
    n = _backslashes(rest)
    return "".join([*out, rest[:len(rest) - n], "\\" * (n // 2)])


def format_turns(
    rows: DataFrame, vocabulary: bytes, pattern: str, how: Template | None = None,
    conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(place, conv_id, turn, ids, mask, n_tokens): a row per turn, ``place`` running through all conversations.

    A conversation's tokens are those of its rows by ``place``. Texts are encoded
    where they are read; only ids are shuffled.
    """
    need(rows, conversation, turn, role, text)
    how = how or template()
    plain = rows.select(
        quoted(conversation).alias("conv_id"), quoted(turn).alias("turn"),
        *[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, controls = bpe.encoder_for(shared.value, pattern), how.pattern()
        first = max(encoder.ranks.values(), default=-1) + 1
        mark = {c: first + n for n, c in enumerate(how.controls)}

        def segment(value: str) -> list[np.ndarray]:
            return [np.fromstring(ids, np.int32, sep=",") for ids in encoder.encoded_runs(value)]

        for batch in batches:
            texts = [escape(t.as_py(), controls) for t in batch.column(3)]
            for value in texts:
                encoder.learn(value)
            encoder.learned()
            ids, masks = [], []
            for name, value in zip(batch.column(2), texts):
                name = name.as_py()
                if name in ROLES:
                    opening, closing = [[mark[ROLES[name][0]]]], [[mark[ROLES[name][1]]]]
                else:
                    opening, closing = [[mark[OTHER]], *segment(escape(name, controls)), [mark[BODY]]], [[mark[OTHER_END]]]
                turn_ids = np.concatenate([np.array(x, np.int32) for x in (*opening, *segment(value), *closing)])
                change = np.zeros(len(turn_ids) + 1, np.int8)
                if name in how.trained:
                    change[1] += 1
                    change[len(turn_ids) - 1] -= 1
                ids.append(turn_ids)
                masks.append(np.cumsum(change[:-1]) > 0)
            sizes = np.array([len(i) for i in ids], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, kind), *x])))
                     for x, kind in ((ids, np.int32), (masks, bool))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists, pa.array(sizes)], ["conv_id", "turn", "ids", "mask", "n_tokens"])

    types = [plain.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    made = plain.mapInArrow(run, "conv_id {}, turn {}, ids array<int>, mask array<boolean>, n_tokens bigint".format(*types))
    made = stage(made, "turns")  # ranging reads its input twice; texts are encoded once
    return dense_row_index(made.withColumn("_digest", F.xxhash64("ids")), ["conv_id", "turn", "_digest"], "place").drop("_digest")


def turn_spans(formatted: DataFrame) -> DataFrame:
    """(place, conv_id, turn, first_token, last_token) of every turn within its conversation, last exclusive."""
    narrow = formatted.select("place", "conv_id", "turn", "n_tokens")
    ahead = running_before(narrow, "place", "n_tokens", "ahead", SPAN)
    start = ahead.groupBy("conv_id").agg(F.min("ahead").alias("start")).withColumnRenamed("conv_id", "_conv")
    return ahead.join(start.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "place", "conv_id", "turn", (F.col("ahead") - F.col("start")).alias("first_token"),
        (F.col("ahead") - F.col("start") + F.col("n_tokens")).alias("last_token"))


def read_turns(formatted: DataFrame, vocabulary: bytes, pattern: str, how: Template | None = None) -> DataFrame:
    """(place, conv_id, turn, role, text, loss_text, formatted): what the tokens and masks say.

    ``loss_text`` is the unescaped text under the mask, null where nothing is
    trained; ``formatted`` is the rendered turn with its marks.
    """
    how = how or template()
    shared = formatted.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["place", "conv_id", "turn", "role", "text", "loss_text", "formatted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, controls = bpe.encoder_for(shared.value, pattern), how.pattern()
        first = max(encoder.ranks.values(), default=-1) + 1
        pieces = {rank: piece for piece, rank in encoder.ranks.items()}
        known = {how.controls.index(marks[0]): role for role, marks in ROLES.items()}
        body = how.controls.index(BODY)

        def text_of(ids: np.ndarray) -> str:
            return b"".join(map(pieces.__getitem__, ids.tolist())).decode()

        for batch in batches:
            out: list[list] = [[], [], [], []]
            for ids, mask in zip(batch.column(3), batch.column(4)):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                marks = np.flatnonzero(ids >= first)
                role = known.get(int(ids[0]) - first)
                if role is None:
                    start = next(m for m in marks if ids[m] == first + body)
                    role = unescape(text_of(ids[1:start]), controls)
                else:
                    start = 0
                text = unescape(text_of(ids[start + 1:-1]), controls)
                trained = how.controls[ids[0] - first] in [ROLES[r][0] for r in how.trained]
                shown, at = [], 0
                for m in marks:
                    shown += [text_of(ids[at:m]), how.controls[ids[m] - first]]
                    at = m + 1
                values = role, text, unescape(text_of(ids[mask]), controls) if trained else None, "".join(shown)
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *[pa.array(c, pa.string()) for c in out]], names)

    types = [formatted.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    return formatted.select("place", "conv_id", "turn", "ids", "mask").mapInArrow(run, (
        "place bigint, conv_id {}, turn {}, role string, text string, loss_text string, formatted string").format(*types))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``read_turns``.

    A conversation's digest is sequential, so its turns pass one task, one at a time;
    the task holds no more than the digest's state.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = turns.select(
        "conv_id", "place", F.concat("role", F.lit("\n"), "text", F.lit("\n")).cast("binary").alias("said"),
        F.coalesce("loss_text", F.lit("")).alias("loss"), F.char_length("formatted").cast("bigint").alias("n")).withColumns({
            "loss_chars": F.char_length("loss").cast("bigint"), "loss": F.col("loss").cast("binary")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        done: list[list] = []

        def out() -> pa.RecordBatch:
            made = [[s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]] for s in done]
            values = [pa.array([m[i] for m in made], t) for i, t in enumerate(
                (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
            done.clear()
            return pa.RecordBatch.from_arrays(values, columns)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for conv, _, said, loss, n, loss_chars in zip(*batch.columns):
                key = conv.as_py()
                if state is None or state[0] != key:
                    if state is not None:
                        done.append(state)
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(said.as_buffer())
                state[3] += loss_chars.as_py()
                state[4].update(loss.as_buffer())
                state[5] += n.as_py()
            if len(done) >= 10_000:
                yield out()
        if state is not None:
            done.append(state)
            yield out()

    conv = turns.schema["conv_id"].dataType.simpleString()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select(
        "conv_id", "place", "said", "loss", "n", "loss_chars").mapInArrow(
        run, f"conv_id {conv}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
