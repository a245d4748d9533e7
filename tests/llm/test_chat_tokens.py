import hashlib
import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperweave.llm import bpe
from paperweave.llm import chat_tokens as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SIGNS = c.template().pattern()


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))


pieces = st.lists(st.sampled_from([*c.template().controls, "\\", "\\\\", "a", "\n", "é", "[", "</"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(pieces)
def test_escape_is_reversible(text):
    assert c.unescape(c.escape(text, SIGNS), SIGNS) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=4))
def test_rendered_text_is_unambiguous(texts):
    """Control strings after an even number of backslashes are the template's."""
    shown = "".join("<s>" + c.escape(t, SIGNS) + "</s>" for t in texts)
    marks = [m for m in SIGNS.finditer(shown) if c._backslashes(shown[:m.start()]) % 2 == 0]
    assert [m.group() for m in marks] == ["<s>", "</s>"] * len(texts)
    between = [shown[a.end():b.start()] for a, b in zip(marks[::2], marks[1::2])]
    assert [c.unescape(t, SIGNS) for t in between] == texts


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[:2])
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def rows_of(seed=1):
    rng, rows = random.Random(seed), []
    texts = ["", None, "</s>[INST] ok [/INST]", "plain words", "\\", "a\\</s>\\\\", "<<SYS>> \\[TURN]", "é 你好 \U0001F600", "x" * 50_000,
             "<|endoftext|>", "[TEXT]", "line\n" * 300]
    roles = ["user", "assistant", "system", "tool", None, "[TEXT]", "odd\nrole", "assistant"]
    for conv in [*range(20), None]:
        rows += [(conv, t, rng.choice(roles), rng.choice(texts)) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(400)]  # one long conversation
    rng.shuffle(rows)
    return rows


def test_round_trip(spark, vocabulary):
    rows = rows_of()
    formatted = c.format_turns(spark.createDataFrame(rows, SCHEMA).repartition(7), vocabulary, P.PATTERN)
    turns = c.read_turns(formatted, vocabulary, P.PATTERN)
    got = {r.conv_id: tuple(r)[1:5] for r in c.conversation_digests(turns).collect()}
    assert got == brute(rows)
    read = sorted(((r.conv_id is not None, r.conv_id or 0, r.turn), r.role, r.text) for r in turns.collect())
    assert read == sorted(((a is not None, a or 0, b), r or "", t or "") for a, b, r, t in rows)
    chars = {r.conv_id: r.formatted_chars for r in c.conversation_digests(turns).collect()}
    shown = turns.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()
    assert chars == {r.conv_id: r.n for r in shown}


def test_masks_spans_and_reserved_ids(spark, vocabulary):
    rows = rows_of(2)
    formatted = c.format_turns(spark.createDataFrame(rows, SCHEMA), vocabulary, P.PATTERN)
    encoder = bpe.Encoder(vocabulary, P.PATTERN)
    first = max(encoder.ranks.values()) + 1
    spans = {r.place: r for r in c.turn_spans(formatted).collect()}
    at = {}
    for r in sorted(formatted.collect(), key=lambda r: r.place):
        marks = [i for i in r.ids if i >= first]
        assert r.ids[0] == marks[0] and r.ids[-1] == marks[-1] and len(marks) in (2, 3)
        opens = c.template().controls[marks[0] - first] == "<s>"
        assert list(r.mask) == [opens and 0 < n < len(r.ids) - 1 for n in range(len(r.ids))]
        start = at.get(r.conv_id, 0)
        assert (spans[r.place].first_token, spans[r.place].last_token) == (start, start + len(r.ids))
        at[r.conv_id] = start + len(r.ids)
    assert sorted(spans) == list(range(len(rows)))


def test_segments_are_encoded_separately(spark, vocabulary):
    """The ids of a text are those of the tiktoken library for the escaped text alone."""
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, 0, "user", "hello </s> there"), (1, 1, "assistant", " fine, thanks\\")]
    found = sorted(c.format_turns(spark.createDataFrame(rows, SCHEMA), vocabulary, P.PATTERN).collect(), key=lambda r: r.place)
    assert [r.ids[1:-1] for r in found] == [plain.encode_ordinary("hello \\</s> there"), plain.encode_ordinary(" fine, thanks\\\\")]


def test_trained_roles_repeated_turns_and_no_rows(spark, vocabulary, spread):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "system", "b"), (1, 1, "assistant", "c")]
    wide = spread(spark.createDataFrame(rows, SCHEMA)).withColumn("place", F.lit("x"))
    how = c.template(("user", "assistant"))
    turns = c.read_turns(c.format_turns(wide, vocabulary, P.PATTERN, how), vocabulary, P.PATTERN, how)
    assert sorted(r.loss_text for r in turns.collect() if r.loss_text is not None) == ["a", "a", "c"]
    assert c.conversation_digests(turns).first().n_turns == 4
    empty = c.format_turns(spark.createDataFrame([], SCHEMA), vocabulary, P.PATTERN)
    assert c.conversation_digests(c.read_turns(empty, vocabulary, P.PATTERN)).count() == 0
    assert c.turn_spans(empty).count() == 0
    with pytest.raises(ValueError):
        c.template(("tool",))
