import numpy as np
import pytest
import xxhash

from paperweave.llm import simhash as s


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id of each group; ``prints`` is a list of (id, fingerprint)."""
    groups = []
    for i, fp in prints:
        near = [g for g in groups if any((fp ^ other).bit_count() <= 3 for _, other in g)]
        groups = [g for g in groups if g not in near] + [[(i, fp), *[x for g in near for x in g]]]
    return {i: min((x for x, _ in g if x is not None), default=None) for g in groups for i, _ in g}


@pytest.mark.parametrize("which", ["odd_docs", "docs"])
def test_against_brute_force(request, which):
    docs = request.getfixturevalue(which)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(i, brute_print(t)) for i, t in texts]
    found = s.near_duplicates(docs).collect()
    assert sorted((r.id or -1, r.fp % 2**64) for r in found) == sorted((i or -1, fp) for i, fp in prints)
    component = brute_components(prints)
    assert all(r.component == component[r.id] for r in found if r.id is not None)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"Wort{i} x" for i in range(500))
    whole = s.fingerprint(text)
    monkeypatch.setattr(s, "PIECE", 64)
    monkeypatch.setattr(s, "HASHES", 10)
    assert s.fingerprint(text) == whole == brute_print(text)


@pytest.mark.parametrize("seed", range(3))
def test_bit_planes_find_every_link(spark, monkeypatch, seed):
    """Random groups of fingerprints, tiles and batches far smaller than usual."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 12).astype(np.uint64)
    values = [int(b) ^ sum(1 << int(x) for x in rng.integers(0, 64, rng.integers(0, 6))) for b in base for _ in range(25)]
    values = sorted({v % 2**64 for v in values} | {0, 1, 2**64 - 1})
    monkeypatch.setattr(s, "TILE", 8)
    nodes = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp bigint")
    found = {r.node % 2**64: r.root % 2**64 for r in s.components(s.links(nodes)).collect()}
    groups, expected = {}, brute_components([(v, v) for v in values])
    for v in values:
        groups.setdefault(found.get(v, v), set()).add(v)
    truth = {}
    for v, c in expected.items():
        truth.setdefault(c, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, truth.values()))


def test_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    assert {r.root for r in s.components(chain).collect()} == {0}


def test_stars_never_hold_pairs():
    """A large linked group gives one edge per member."""
    values = np.array(sorted({x | y << 1 for x in range(2) for y in range(2)} | {1 << b for b in range(3)}), np.uint64)
    fp, root = s.stars(np.repeat(values, 1), np.zeros(len(values), int), 0)
    assert len(fp) < len(values)


def test_keep_one(odd_docs, no_docs, spread):
    wide = spread(odd_docs)
    kept = s.keep_one(wide)
    assert kept.columns == wide.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == [1, 2, 5, 6]  # 7 copies 1; 3 and 4 have no words like 2
    assert kept.filter("doc_id is null").count() == 1
    assert s.keep_one(no_docs).count() == 0
