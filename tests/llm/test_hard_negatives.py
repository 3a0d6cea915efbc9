import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, embedding array<double>, block string, slot string, at string, width string, vector string, score string"


def brute(rows, k=5, m=10, low=30, high=90, every=100):
    ok = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, label, [math.floor(256 * x) for x in v] or [0]))
    out = []
    for i, label, v in ok:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in ok if j != i and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:k]:
            fits = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:m]
            out += [(i, p, r, j, -s, -t) for r, (t, j, _) in enumerate(fits, 1)]
    return sorted(out)


def run(spark, rows, partitions=3, every=100, **options):
    full = [(i, label, v, "b", "s", "a", "w", "v", "c") for i, label, v in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % every == 0, **options).collect())


def made(seed, n, width, labels, spread=1.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(labels, width))
    return [(i, int(label), (centres[label] * 0.3 + random.normal(size=width) * spread).tolist()) for i, label in enumerate(random.integers(0, labels, n))]


@pytest.mark.parametrize("options", [{}, {"tree_rows": 50, "span": 2, "most_anchors": 32}, {"positives": 2, "negatives": 3, "low": 10, "high": 60}])
def test_against_brute_force(spark, options):
    rows = made(1, 900, 8, 5)
    names = {"positives": "k", "negatives": "m"}
    wanted = {names.get(k, k): v for k, v in options.items() if k in ("positives", "negatives", "low", "high")}
    assert run(spark, rows, every=10, **options) == brute(rows, every=10, **wanted)


def test_rows_that_take_no_part(spark):
    rows = made(2, 60, 3, 2) + [
        (100, None, [1.0] * 3), (200, 1, None), (300, 1, [1.0, None, 0.0]), (400, 1, [float("nan")] * 3), (500, 0, [float("inf")] * 3),
        (None, 1, [1.0] * 3), (600, 1, []), (601, 1, []), (602, 0, []), (700, 1, [1.0]), (701, 1, [2.0]), (702, 0, [0.5]), (703, 0, [1.0, 2.0]), (800, 9, [1.0] * 3),
    ]
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_repeated_rows(spark):
    vector = [0.5, -0.25]
    rows = [(i, 0, vector) for i in range(0, 300)] + [(i, 1, [0.25, -0.125]) for i in range(300, 600)] + [(600, 1, [0.3, -0.1]), (600, 1, [0.3, -0.1]), (500, 1, vector)]
    got = run(spark, rows, tree_rows=64, span=1)
    assert got == brute(rows)


def test_scores_of_zero_and_below(spark):
    rows = [(0, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 0, [-1.0, 0.0]), (3, 1, [0.0, 5.0]), (4, 1, [-0.5, 0.0]), (5, 1, [0.5, 0.0])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert (0, 1, 1, 3, 0, 0) in got and not any(p == 2 for _, p, *_ in got)


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [2.0**30 + i, 2.0**22 - i]) for i in range(0, 120)]
    assert run(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="component too large"):
        run(spark, [(0, 0, [1e300]), (1, 1, [1.0])])


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 1, [1.0])]) == []
    assert run(spark, [(100, 1, [1.0])]) == []


def test_boxes_hold_their_rows_and_bound_products():
    random = np.random.default_rng(5)
    vectors, ids, labels = random.integers(-300, 300, (3000, 6)), np.arange(3000), random.integers(0, 4, 3000)
    at = H.tiles(vectors, ids)
    assert sorted(at.tolist()) == ids.tolist()
    tree = H.Tree.of(ids[at], labels[at], vectors[at])
    low, high, *_ = tree.levels[0]
    for n in range(len(low)):
        part = tree.vectors[n * H.LEAF : (n + 1) * H.LEAF]
        assert (low[n] == part.min(axis=0)).all() and (high[n] == part.max(axis=0)).all()
    volume = (high - low).astype(float).prod(axis=1).mean()
    shuffled = random.permutation(3000).reshape(-1, 125)
    assert volume < np.mean([np.ptp(vectors[s], axis=0).astype(float).prod() for s in shuffled]) / 20


def test_boxes_are_skipped(monkeypatch):
    """On clustered rows a search opens few leaves, and finds what a scan finds."""
    random = np.random.default_rng(6)
    centres = random.normal(size=(64, 4)) * 4000
    vectors = np.concatenate([c + random.normal(size=(128, 4)) * 20 for c in centres]).astype(np.int64)
    ids, labels = np.arange(len(vectors)), np.arange(len(vectors)) % 3
    at = H.tiles(vectors, ids)
    tree = H.Tree.of(ids[at], labels[at], vectors[at])
    opened = []
    plain = H.Wanted.offer
    monkeypatch.setattr(H.Wanted, "offer", lambda self, scores, ids: (opened.append(1), plain(self, scores, ids))[1])
    anchor = vectors[5]
    window = H.Wanted(0, -H.NO_BOUND, H.NO_BOUND, 5)
    H.search(tree, ids[5:6], labels[5:6], vectors[5:6], [[window]], True)
    scores = vectors @ anchor
    want = sorted((-int(scores[i]), int(i)) for i in ids if i != 5 and labels[i] == labels[5])[:5]
    assert window.best == want
    assert len(opened) < len(tree.levels[0][0]) / 4
