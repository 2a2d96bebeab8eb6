import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import hard_negatives as hn

SCHEMA = "id bigint, label int, vector array<float>"


def usable(rows):
    found = set()
    for id_, label, vector in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        found.add((id_, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    return sorted(found)


def plain(rows, every=50, n_positives=5, n_negatives=3):
    """The result by scoring every anchor against every row."""
    rows, out = usable(rows), []
    for a in rows:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b) for b in rows]
        liked = sorted((s, b[0]) for s, b in scored if b[1] == a[1] and b != a)[:n_positives]
        others = sorted((s, b[0]) for s, b in scored if b[1] != a[1])
        for score, positive in liked:
            inside = [(s, i) for s, i in others if 50 * -score <= 100 * -s <= 95 * -score][:n_negatives]
            out += [(a[0], positive, rank, i, -score, -s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, every=50):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in hn.mine(frame, F.col("id") % every == 0).collect())


def clustered(rnd, n, dims, centres, noise=0.3):
    middle = rnd.normal(size=(centres, dims))
    own = rnd.integers(centres, size=n)
    x = middle[own] + noise * rnd.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1)[:, None], own


@pytest.mark.parametrize("seed, noise, limits", [(1, 0.3, (64, 16, 60)), (2, 1.5, (2_048, 4_096, 2_048)), (3, 0.05, (32, 8, 5))])
def test_against_all_pairs(spark, monkeypatch, seed, noise, limits):
    for name, value in zip(("BLOCK_ROWS", "GROUP_ROWS", "SEED_ROWS"), limits):
        monkeypatch.setattr(hn, name, value)
    rnd = np.random.default_rng(seed)
    x, own = clustered(rnd, 700, 16, 12, noise)
    labels = np.where(rnd.random(700) < 0.2, rnd.integers(4, size=700), own % 4)
    rows = [(i, int(c), [float(v) for v in vector]) for i, (c, vector) in enumerate(zip(labels, x))]
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "SEED_ROWS", 8)
    rnd = random.Random(4)
    vectors = [[rnd.choice((-1.0, 0.0, 0.5, 1.0)) for _ in range(3)] for _ in range(6)]
    rows = [(i, i % 3, rnd.choice(vectors)) for i in range(120)]
    rows += [(200 + i, 1, vectors[0]) for i in range(150)] + rows[:20]
    rows += [(500, 0, vectors[1]), (500, 0, vectors[2]), (500, 1, vectors[1])]
    rows += [
        (550, None, vectors[0]), (600, 1, None), (650, 1, [1.0, None, 0.0]), (700, 1, [float("nan")] * 3), (750, 1, [float("inf")] * 3),
        (None, 1, vectors[0]), (800, 2, []), (850, 2, [1.0]), (900, 2, [1.0, 1.0, 1.0, 1.0]), (950, 7, [2.0, 0.0, 0.0]), (-50, 0, vectors[3]),
    ]
    assert mined(spark, rows) == plain(rows)


def test_large_components(spark):
    rows = [(i, i % 2, [float(10 ** (i % 5)), -float(i), 3.0e5 * (i % 5)]) for i in range(100)]
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_no_rows(spark):
    assert mined(spark, [(1, None, [1.0])]) == []
    assert mined(spark, [(50, 1, [1.0])]) == []


def test_sequence_is_in_order_and_complete():
    rnd = np.random.default_rng(5)
    x, y = rnd.normal(size=7), rnd.normal(size=9)
    found = list(hn.sequence(x, y))
    assert len(set((i, j) for _, i, j in found)) == 63
    assert [s for s, *_ in found] == sorted((s for s, *_ in found), reverse=True)
    assert all(np.isclose(s, x[i] + y[j]) for s, i, j in found)


def test_clusters_are_passed_over(spark):
    """On vectors with structure a search stops before it has seen most of the rows."""
    rnd = np.random.default_rng(6)
    x, own = clustered(rnd, 4_000, 16, 40, 0.05)
    whole = np.floor(256 * x).astype(np.int64)
    books = hn.fitted(whole[:, :8], 40), hn.fitted(whole[:, 8:], 40)
    (a, da), (b, db) = hn.nearest(whole[:, :8].astype(float), books[0]), hn.nearest(whole[:, 8:].astype(float), books[1])
    sizes = {}
    for cell in zip(a.tolist(), b.tolist()):
        sizes[cell] = sizes.get(cell, 0) + 1
    radii = tuple(np.array([d[w == k].max(initial=0) for k in range(len(book))]) for d, w, book in zip((da, db), (a, b), books))
    index = hn.Index(books, radii, sizes, {})
    shares = []
    for anchor in whole[:50]:
        best = np.sort(whole @ anchor)[-5]
        cells = set(hn.visited(anchor, np.array([best]), np.array([hn.MOST]), index, None))
        needed = {(i, j) for i, j, s in zip(a.tolist(), b.tolist(), whole @ anchor) if s >= best}
        assert needed <= cells
        shares.append(sum(sizes[c] for c in cells) / 4_000)
    assert np.mean(shares) < 0.25
