"""Byte-level BPE by a rank queue.

A text is cut by the vocabulary's pattern; every pre-token is merged by itself.
The merges to do wait in buckets, one per rank, which hold positions of a linked
list of pieces. A bitmap over the buckets, with a bitmap over its words above
it, gives the lowest filled rank by two find-first-set steps. An entry whose
pair has changed meanwhile is stale and skipped. Work is near linear in the
length of a pre-token. A worker keeps the merges of pre-tokens it has seen, up
to a fixed number; the new ones of a batch share one queue and are merged
together, bucket by bucket.

Texts are split once, into numbers of pre-tokens; ids and decoded bytes are looked up
by number and digests are fed in runs, so a long text costs little memory. Rows are
independent: no shuffle, no group.

Defined results: a null text is empty and has no tokens; the digests are then
those of the empty string. Repeated rows are encoded alike. An empty table gives
an empty one. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperweave.llm.common import need, quoted

SEEN = 1_000_000  # pre-tokens a worker remembers, half of them from batch to batch
NEW = 60_000  # pre-tokens merged together; their arrays take some 100 MB
LONG = 64  # longer ones are merged by themselves and not remembered
RUN = 1 << 16  # pre-tokens handled at once
TEXTS = 1 << 25  # bytes of text whose pre-tokens are numbered together


class Encoder:
    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        import regex

        self.ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, vocabulary.splitlines())}
        # White space is the Unicode property, as where these vocabularies come from.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.size = max(self.ranks.values(), default=0) + 2  # one id more, for gaps
        self._pairs, self.new = None, set()
        self.words = [0] * ((max(self.ranks.values(), default=0) >> 8) + 1)
        self.pieces = {str(rank): piece for piece, rank in self.ranks.items()}
        self.seen = _Seen(self)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token.

        ``buckets`` holds positions by rank. ``words`` is a bitmap of the filled
        ranks and ``top`` one of the words that are not zero; both are empty
        again at the end. The queue is written out here, as calls would cost
        more than its steps.
        """
        rank_of, n = self.ranks.get, len(data)
        whole = rank_of(data)
        if whole is not None:
            return [whole]
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * (n + 1)  # rank of the pair that starts at a piece
        buckets: dict[int, list[int]] = {}
        words, top = self.words, 0

        waiting = [(rank, i) for i in range(n - 1) if (rank := rank_of(data[i:i + 2])) is not None]
        while True:
            for rank, i in waiting:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    word = rank >> 8
                    words[word] |= 1 << (rank & 255)
                    top |= 1 << word
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = words[word]
            low = bits & -bits
            words[word] = bits ^ low
            if bits == low:
                top ^= 1 << word
            rank = (word << 8) + low.bit_length() - 1
            positions = buckets.pop(rank)
            if len(positions) > 1:
                positions.sort()  # the leftmost first
            waiting = []
            for turn, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale
                j = following[i]
                k = following[j]
                following[i] = k
                pair[i] = pair[j] = -1
                lowest = rank
                if k < n:
                    before[k] = i
                    new = rank_of(data[i:following[k]])
                    if new is not None:
                        pair[i] = new
                        waiting.append((new, i))
                        lowest = min(lowest, new)
                p = before[i]
                if p >= 0:
                    new = rank_of(data[p:k])
                    if new is None:
                        pair[p] = -1
                    else:
                        pair[p] = new
                        waiting.append((new, p))
                        lowest = min(lowest, new)
                if lowest < rank:  # the rest waits until the lower ranks are done
                    waiting += [(rank, x) for x in positions[turn + 1:] if pair[x] == rank]
                    break
            # A pair that changed again within the bucket has a later entry.
            waiting = [(new, i) for new, i in waiting if pair[i] == new]
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:following[i]]])
            i = following[i]
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, ranks): every pair of tokens that joins to a token, by key for binary search."""
        if self._pairs is None:
            ids, size = self.ranks, self.size
            found = sorted((ids[t[:i]] * size + ids[t[i:]], rank) for t, rank in ids.items()
                           for i in range(1, len(t)) if t[:i] in ids and t[i:] in ids)
            self._pairs = (np.array([k for k, _ in found], np.int64), np.array([r for _, r in found], np.int64))
        return self._pairs

    def merge_many(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of many pre-tokens, by one queue over all of them.

        Pre-tokens stand in one list of positions with a gap between them. A
        bucket is worked off as a whole: its entries have the lowest rank
        everywhere, and where they overlap the leftmost goes first. Where a
        merge opens a pair of lower rank, the order within the pre-token
        matters, so that one is done again by itself.
        """
        keys, of_key = self.pairs()
        gap, size = self.size - 1, self.size
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(sizes + 1) - sizes  # a gap before every pre-token
        total = int(sizes.sum()) + len(parts) + 1
        token = np.full(total, gap, np.int64)
        inside = np.ones(total, bool)
        inside[starts - 1] = inside[-1] = False
        byte_ids = np.array([self.ranks.get(bytes([b]), gap) for b in range(256)], np.int64)
        token[inside] = byte_ids[np.frombuffer(b"".join(parts), np.uint8)]

        def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Rank of the token that two tokens make, -1 if none."""
            key = a * size + b
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where(keys[at] == key, of_key[at], -1) if len(keys) else np.full(len(a), -1)

        def rank_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return joined(token[a], token[b])

        def part_of(positions: np.ndarray) -> list[int]:
            return (np.searchsorted(starts, positions, side="right") - 1).tolist()

        place = np.arange(total)
        following, before, alive = place + 1, place - 1, inside.copy()
        pair = np.append(rank_of(place[:-1], place[1:]), -1)
        buckets: dict[int, list[np.ndarray]] = {}
        words, top, again = self.words, 0, set()

        def by_rank(ranks: np.ndarray, positions: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else []
            for a, b in zip(cuts, [*cuts[1:], len(ranks)]):
                yield int(ranks[a]), positions[a:b]

        filled = np.flatnonzero(pair >= 0)
        waiting = (pair[filled], filled)
        while True:
            for rank, positions in by_rank(*waiting):
                if rank in buckets:
                    buckets[rank].append(positions)
                else:
                    buckets[rank] = [positions]
                    words[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = words[word]
            low = bits & -bits
            words[word] = bits ^ low
            if bits == low:
                top ^= 1 << word
            rank = (word << 8) + low.bit_length() - 1
            i = np.concatenate(buckets.pop(rank))
            i = i[(pair[i] == rank) & alive[i]]  # without stale entries
            i.sort()
            if len(i) > 1:
                i = i[np.concatenate([[True], i[1:] != i[:-1]])]
            if len(i) > 1:  # of entries in a chain every second one overlaps the one before
                linked = np.r_[False, following[i[:-1]] == i[1:]]
                if linked.any():
                    at = np.arange(len(i))
                    i = i[(at - np.maximum.accumulate(np.where(linked, 0, at))) % 2 == 0]
            if not len(i):
                waiting = (i, i)
                continue
            j = following[i]
            k = following[j]
            # One at a time, a piece meets its right neighbour before that one is merged too.
            soon = pair[k] == rank
            early = joined(np.full(soon.sum(), rank), token[k[soon]])
            again.update(part_of(i[soon][(early >= 0) & (early < rank)]))
            token[i], following[i], before[k] = rank, k, i
            alive[j], pair[j] = False, -1
            p = before[i]
            at = np.concatenate([i, p])
            new = rank_of(at, np.concatenate([k, i]))
            pair[at] = new
            filled = new >= 0
            waiting = (new[filled], at[filled])
            if filled.any() and waiting[0].min() < rank:
                again.update(part_of(waiting[1][waiting[0] < rank]))
        counts = np.add.reduceat(alive.astype(np.int64), starts) if len(parts) else []
        ends = np.cumsum(counts)
        ids = token[alive].tolist()
        return [self.merge(parts[n]) if n in again else ids[end - count:end]
                for n, (count, end) in enumerate(zip(counts, ends))]

    def numbered(self, texts: Iterator[str | None]) -> tuple[list[np.ndarray], list[str], list[bytes]]:
        """Numbers of each text's pre-tokens; by number, the ids and the bytes that they decode to.

        Texts are split once, and each different pre-token is merged and decoded once.
        """
        number: dict[str, int] = defaultdict(count().__next__)
        of_texts = [np.concatenate([np.zeros(0, np.int32), *[
            np.fromiter(map(number.__getitem__, parts), np.int32, len(parts)) for parts in self._runs(text or "")]])
            for text in texts]
        if len(self.seen) + len(number) > SEEN // 2:  # what these texts don't have is forgotten
            kept = {p: self.seen[p] for p in number if p in self.seen}
            self.seen.clear()
            self.seen.update(kept)
        fresh = [p for p in number if p not in self.seen]
        for at in range(0, len(fresh), NEW):
            self.new = set(fresh[at:at + NEW])
            self.learned()
        ids = [self.seen[p] for p in number]
        return of_texts, ids, [self.decode(x) for x in ids]

    def learn(self, text: str) -> None:
        """Merge the text's new pre-tokens, many at a time; call ``learned`` after the last text."""
        for parts in self._runs(text):
            self.new.update(p for p in set(parts) if p not in self.seen)
            if len(self.new) > NEW:
                self.learned()

    def learned(self) -> None:
        if len(self.seen) + len(self.new) > SEEN:
            self.seen.clear()
        known = {p: [self.ranks[b]] for p in self.new if (b := p.encode()) in self.ranks}
        rest = [p for p in self.new if p not in known and len(p) <= LONG]
        known.update(zip(rest, self.merge_many([p.encode() for p in rest])))
        self.seen.update((p, ",".join(map(str, ids))) for p, ids in known.items())
        self.new = set()

    def _runs(self, text: str) -> Iterator[list[str]]:
        if len(text) <= RUN * 4:
            if parts := self.split.findall(text):
                yield parts
            return
        found = self.split.finditer(text)
        while parts := [m.group() for m in islice(found, RUN)]:
            yield parts

    def encoded_runs(self, text: str) -> Iterator[str]:
        """Decimal ids joined by commas, a run of pre-tokens at a time."""
        for parts in self._runs(text):
            yield ",".join(map(self.seen.__getitem__, parts))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.split(","))) if ids else b""


class _Seen(dict):
    """Pre-token to its ids; emptied when full."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder

    def __missing__(self, part: str) -> str:
        ids = ",".join(map(str, self.encoder.merge(part.encode())))
        if len(part) <= LONG:
            if len(self) >= SEEN:
                self.clear()
            self[part] = ids
        return ids


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_for(vocabulary: bytes, pattern: str) -> Encoder:
    """The worker's encoder for this vocabulary, made once."""
    key = (hashlib.sha256(vocabulary).hexdigest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, pattern)
    return _ENCODERS[key]


def read_vocabulary(path: str) -> bytes:
    """The rank file's bytes; read on the driver and sent along, so executors need no file."""
    with open(path, "rb") as file:
        return file.read()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``TEXTS`` bytes of text together, or one row with more."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(int(np.searchsorted(ends, before + TEXTS, side="right")), at + 1)
            yield batch.slice(at, end - at)
            at = end


def encode(
    docs: DataFrame, vocabulary: bytes, pattern: str, id_column: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Per row: id, token count, digest of the ids and of the bytes decoded from them; the ids too if asked for."""
    need(docs, id_column, text)
    rows = docs.select(quoted(id_column).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value, pattern)
        for batch in _parts(batches):
            counts, ids_digests, text_digests, all_ids = [], [], [], []
            numbers, ids_of, bytes_of = encoder.numbered(t.as_py() for t in batch.column(1))
            sizes = np.array([ids.count(",") + 1 for ids in ids_of], np.int64)
            for parts in numbers:
                of_ids, of_text = hashlib.sha256(), hashlib.sha256()
                for at in range(0, len(parts), RUN):
                    some = parts[at:at + RUN].tolist()
                    ids = ",".join(map(ids_of.__getitem__, some))
                    of_ids.update((("," if at else "") + ids).encode())
                    of_text.update(b"".join(map(bytes_of.__getitem__, some)))
                    if with_ids:
                        all_ids.append(np.fromstring(ids, np.int32, sep=","))
                counts.append(int(sizes[parts].sum()))
                ids_digests.append(of_ids.hexdigest())
                text_digests.append(of_text.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.int32), *all_ids])
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                           + (", ids array<int>" if with_ids else ""))
