import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.llm import vector_codes as v

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * single(x)) for x in e], y) for i, e, y in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(x[p * width:(p + 1) * width]) for p in range(parts)] for _, x, _ in kept]
    books = [[cut[n][p] for n in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for n, group in groups.items():
                book[n] = tuple(sum(xs) // len(group) for xs in zip(*group))
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, y), e in zip(kept, errors):
        by_label[y] = by_label.get(y, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{n:02x}" for _, n in f), e, by_label[y], sha)
                  for (i, _, y), f, e in zip(kept, found, errors))


def found(spark, rows, parts, entries, rounds):
    df = v.compress(spark.createDataFrame(rows, SCHEMA), parts=parts, entries=entries, rounds=rounds)
    return sorted((str(r.id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def vectors(rng, n, dim, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], rng.choice([1, 2, 3, None])) for i in range(n)]


@pytest.mark.parametrize("memo,hot", [(v.MEMO, v.HOT_ROWS), (5, 20)])
def test_against_brute_force(spark, monkeypatch, memo, hot):
    monkeypatch.setattr(v, "MEMO", memo)
    monkeypatch.setattr(v, "HOT_ROWS", hot)
    monkeypatch.setattr(v, "SLICE", 64)
    rows = vectors(random.Random(1), 300, 12)
    assert found(spark, rows, 4, 16, 2) == brute(rows, 4, 16, 2)
    rows = vectors(random.Random(2), 90, 8, 0.02)  # few distinct parts: ties and unused entries
    assert found(spark, rows, 4, 40, 3) == brute(rows, 4, 40, 3)


def test_copies_few_rows_and_odd_vectors(spark):
    same = [(i, [0.5, -0.25, 1.0, -1.5], i % 2) for i in range(100)]
    odd = [(200, None, 1), (201, [1.0, None, 2.0, 1.0], 1), (202, [float("nan"), 1.0, 1.0, 0.0], 1),
           (203, [float("inf"), 0.0, 0.0, 0.0], None), (None, [1.0, 1.0, 1.0, 1.0], None), (5, [9.0, 8.0, 7.0, 6.0], 7)]
    assert found(spark, same + odd, 2, 8, 2) == brute(same + odd, 2, 8, 2)
    few = vectors(random.Random(3), 3, 4)
    assert found(spark, few + few, 4, 64, 2) == brute(few + few, 4, 64, 2)


def test_other_lengths_names_and_bounds(spark, spread):
    rows = vectors(random.Random(4), 20, 4)
    more = rows + [(99, [1.0], 1), (98, [], 2)]
    df = spread(spark.createDataFrame(more, SCHEMA)).withColumn("code", F.lit(1))
    assert sorted(r.id for r in v.compress(df, parts=2, entries=4).collect()) == list(range(20))
    assert v.compress(spark.createDataFrame([], SCHEMA)).columns == v.compress(df, parts=2, entries=4).columns
    assert v.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        v.compress(df, parts=3)
    with pytest.raises(ValueError):
        v.compress(df, entries=257)


def test_lists_hold_every_nearest_entry():
    """For any point of a box, the nearest entry, the lowest of equals, is on the box's list."""
    rng = np.random.default_rng(5)
    book = rng.integers(-40, 40, (32, 3))
    grid = v.Grid(book)
    x = rng.integers(-60, 60, (5000, 3))
    lists, which = grid.lists(x // grid.width)
    distance = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert all(distance[i].argmin() in lists[which[i]] for i in range(len(x)))
    entry, best = grid.assign(x)
    assert (entry == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()
    assert np.mean([len(found) for found in lists]) < 16  # most entries are ruled out
    grid.weights[:] = 0  # every cell with one hash
    assert (grid.assign(x)[0] == entry).all()


def test_sums_come_by_entry_not_by_row(spark):
    """What the driver reads of a round has a fixed size."""
    rows = spark.createDataFrame(vectors(random.Random(6), 500, 8), SCHEMA)
    kept = v.kept_vectors(rows, "vec_id", "embedding", None)
    books = v.learn_codebooks(kept, 4, 16, 0)
    assert v._sums(kept, books).count() == 16 * 8
