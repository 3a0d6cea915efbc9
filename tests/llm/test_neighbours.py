import numpy as np
from pyspark.sql import functions as F

from millrace.llm import neighbours as N


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, part string, n string, ids string").repartition(3)


def brute(rows, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            best = {}
            for j, w in ok:
                if j != i:
                    d = float(np.sqrt(((np.float32(w).astype(float) - np.float32(v).astype(float)) ** 2).sum()))
                    best[j] = min(d, best.get(j, d))
            out[i] = sorted((d, j) for j, d in best.items())[:k]
    return out


def run(spark, rows, **options):
    df = table(spark, [(i, v, "x", "y", "z") for i, v in rows])
    got = {}
    for r in N.search(df, F.col("vec_id") % 100 == 0, **options).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    return {q: [x[i] for i in sorted(x)] for q, x in got.items()}


def test_small_table_is_exact(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=4).tolist()) for i in range(40)]
    rows += [(100, None), (200, [0.0] * 4), (300, [1.0, None, 0.0, 1.0]), (400, [float("nan")] * 4), (500, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(600, rows[3][1]), (601, rows[3][1]), (602, rows[3][1]), (602, rows[3][1]), (600, rows[3][1])]
    assert run(spark, rows) == brute(rows, 10)


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [5.0, 2.0])]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, []) == {}
    assert run(spark, [(100, [1.0, 1.0])]) == {}


def test_recall_on_clusters_with_a_hot_vector(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(40, 16)) * 3
    rows = [(i, (centres[i % 40] + random.normal(size=16)).tolist()) for i in range(4000)]
    rows += [(5000 + i, rows[7][1]) for i in range(2000)]
    got, want = run(spark, rows, block=256), brute(rows, 10)
    hit = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hit / (10 * len(want)) >= 0.9
    exact = {q: dict((j, d) for d, j in x) for q, x in want.items()}
    assert all(exact[q].get(j, d) == d for q in want for d, j in got[q])


def test_parts_are_balanced_and_cut_few_edges():
    random = np.random.default_rng(3)
    vectors = np.concatenate([random.normal(size=(200, 8)) + 20 * k for k in range(8)])
    graph = N.nearest(vectors, 10)
    part = N.balanced_parts(graph, 8)
    assert np.bincount(part).max() <= 1.05 * 200 + 1
    assert (part[graph] == part[:, None]).mean() > 0.95
