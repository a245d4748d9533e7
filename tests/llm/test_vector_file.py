import math
import random

import pytest
from pyspark.sql import functions as F

from paperweave.llm import vector_file as v

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, every, k=v.TOP):
    whole = {i: [math.floor(256 * x) for x in e] for i, e in rows
             if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, every):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, v.search(df, F.col("id") % every == 0).collect()))


def float32(rows):
    import struct
    return [(i, e and [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in e]) for i, e in rows]


@pytest.mark.parametrize("blocks", [(8192, 1024), (37, 11)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(v, "VECTOR_BLOCK", blocks[0])
    monkeypatch.setattr(v, "QUERY_BLOCK", blocks[1])
    rng = random.Random(1)
    rows = float32([(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(300)])
    assert found(spark, rows, 7) == brute(rows, 7)


def test_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(v, "VECTOR_BLOCK", 50)
    same = [(i, [0.5, -0.25, 1.0]) for i in range(200)]  # one vector fills the table
    odd = [(500, None), (501, [1.0, None, 2.0]), (502, [float("nan"), 1.0, 1.0]), (503, [float("inf"), 0.0, 0.0]),
           (None, [1.0, 1.0, 1.0]), (504, [9.0]), (510, [2.0, 2.0, 2.0, 2.0]), (520, []), (530, [0.0, 0.0, 0.0])]
    rows = same + odd
    assert found(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(i * 50, [float(i), 1.0]) for i in range(n)]
    assert found(spark, rows, 50) == brute(rows, 50)


def test_large_values(spark):
    rng = random.Random(2)
    rows = float32([(i, [rng.uniform(-1e4, 1e4) for _ in range(8)]) for i in range(60)])
    assert found(spark, rows, 5) == brute(rows, 5)


def test_extra_columns(spark, spread):
    rows = [(i, [float(i), 1.0]) for i in range(20)]
    df = spread(spark.createDataFrame(rows, SCHEMA)).withColumn("v", F.lit(1)).withColumn("upper", F.lit(2))
    assert sorted(map(tuple, v.search(df, F.col("id") % 4 == 0).collect())) == brute(rows, 4)
