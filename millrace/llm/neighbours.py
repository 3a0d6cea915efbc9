"""Nearest neighbours by learned partitions: a balanced partition of a neighbour graph, and a classifier that routes.

On a bounded sample of distinct vectors the graph of nearest neighbours is cut into parts of equal size
that cut few of its edges. A small network learns, for a vector, in which parts its neighbours lie. Every
row of the table is stored in its most probable part; a query searches its most probable parts, and all
rows there are ranked by their exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import written

SAMPLE = 8192


@dataclass(frozen=True)
class Router:
    """Two layers of weights; `parts` outputs, of which `probes` are to be searched. Inputs are centred and scaled first."""

    centre: np.ndarray
    scale: float
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    parts: int
    probes: int

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """The parts of each vector, most probable first."""
        if self.parts == 1:
            return np.zeros((len(vectors), 1), np.int64)
        a, b, c, d = self.layers
        hidden = np.maximum((vectors - self.centre) * self.scale @ a + b, 0)
        return np.argsort(-(hidden @ c + d), axis=1, kind="stable")


def nearest(vectors: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other vectors of each, by blocks."""
    n = len(vectors)
    norms = (vectors**2).sum(axis=1)
    found = np.empty((n, k), np.int64)
    for a in range(0, n, 512):
        b = min(n, a + 512)
        distance = norms - 2 * vectors[a:b] @ vectors.T
        distance[np.arange(b - a), np.arange(a, b)] = np.inf
        found[a:b] = np.argpartition(distance, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.05, seed: int = 7) -> np.ndarray:
    """A part for each node: breadth-first growth into equal parts, then moves to the part with most neighbours that has room."""
    n = len(graph)
    around: list[list[int]] = [list(row) for row in graph.tolist()]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            around[j].append(i)
    order, seen = [], np.zeros(n, bool)
    for root in range(n):
        queue = [] if seen[root] else [root]
        seen[root] = True
        for node in queue:
            for other in around[node]:
                if not seen[other]:
                    seen[other] = True
                    queue.append(other)
        order += queue
    part = np.empty(n, np.int64)
    part[order] = np.arange(n) * parts // n
    room = int(np.ceil(n / parts * slack))
    sizes = np.bincount(part, minlength=parts)
    label, random = part.tolist(), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0
        for node in random.permutation(n).tolist():
            votes: dict[int, int] = {}
            for other in around[node]:
                votes[label[other]] = votes.get(label[other], 0) + 1
            own = votes.get(label[node], 0)
            best = max(votes, key=lambda p: (votes[p] if sizes[p] < room or p == label[node] else -1, -p))
            if best != label[node] and votes[best] > own and sizes[best] < room:
                sizes[label[node]] -= 1
                sizes[best] += 1
                label[node] = best
                moved += 1
        if not moved:
            break
    return np.array(label)


def train(vectors: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 7):
    """Weights of the network that predicts the rows of `targets` (shares of parts), by Adam on the cross-entropy."""
    random = np.random.default_rng(seed)
    width, parts = vectors.shape[1], targets.shape[1]
    weights = [random.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden), random.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(vectors))
        for at in range(0, len(order), 256):
            x, y = vectors[order[at : at + 256]], targets[order[at : at + 256]]
            h = np.maximum(x @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            delta = (p / p.sum(axis=1, keepdims=True) - y) / len(x)
            back = (delta @ weights[2].T) * (h > 0)
            step += 1
            rate = 0.003 * (1 - epoch / epochs) + 1e-4
            for i, grad in enumerate((x.T @ back, back.sum(axis=0), h.T @ delta, delta.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def fit(vectors: np.ndarray, parts: int = 32, neighbours: int = 10, recall: float = 0.96) -> Router:
    """A router from distinct sample vectors; fewer than 16 vectors a part make fewer parts.

    A tenth of the sample is held out of the graph and the training. `probes` of the result is the number
    of parts that a held-out vector must search so that `recall` of its neighbours in the rest are found.
    """
    parts = max(1, min(parts, len(vectors) // 16))
    centre = vectors.mean(axis=0) if len(vectors) else np.zeros(0)
    spread = float(np.sqrt(((vectors - centre) ** 2).mean())) if len(vectors) else 1.0
    scale = 1 / spread if spread > 0 else 1.0
    if parts == 1:
        return Router(centre, scale, (), 1, 1)
    scaled = (vectors - centre) * scale
    held = np.arange(len(vectors)) % 10 == 0
    known, asked = scaled[~held], scaled[held]
    graph = nearest(known, neighbours)
    part = balanced_parts(graph, parts)
    targets = np.zeros((len(known), parts))
    np.add.at(targets, (np.arange(len(known))[:, None], part[graph]), 1.0)
    targets[np.arange(len(known)), part] += 1
    router = Router(centre, scale, train(known, targets / targets.sum(axis=1, keepdims=True)), parts, parts)
    home = router.order(vectors[~held])[:, 0]
    distance = (known**2).sum(axis=1) - 2 * asked @ known.T
    true = np.argpartition(distance, neighbours - 1, axis=1)[:, :neighbours]
    place = np.argsort(router.order(vectors[held]), axis=1)
    needed = np.take_along_axis(place, home[true], axis=1)
    found = [(needed < p).mean() for p in range(1, parts + 1)]
    probes = next((p for p, share in enumerate(found, 1) if share >= recall), parts)
    return replace(router, probes=probes)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part: all components finite numbers, not all zero, an id."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def search(rows: DataFrame, is_query, k: int = 10, parts: int = 32, recall: float = 0.96, sample: int = SAMPLE, block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of every row for which the column `is_query` holds.

    `rows` has vec_id and embedding; other columns are ignored. Vectors that are null, zero, or hold a
    null or a non-finite component take no part, nor do rows without an id or whose vector has another
    length than most of the sample. Rows that share a vec_id are one candidate, the nearest of them, and
    one query. Distances are Euclidean, of the original components in double precision; ties go to the
    smaller vec_id. Only the `sample` (rows whose hashed vector falls below the share that leaves about
    that many) comes to the driver; all rows are indexed. A query searches as many of its most probable parts
    as find the share `recall` of neighbours in the sample, and further ones until they hold 10 k rows, so
    a small table is searched whole. Rows and
    queries meet as blocks of at most `block` vectors, however many rows a part has.
    """
    spark = rows.sparkSession
    valid = usable(rows)
    total = valid.count()
    share = min(1.0, sample / max(total, 1))
    draw = F.xxhash64("embedding").bitwiseAND(F.lit(0xFFFFFF)).cast("double") / F.lit(float(1 << 24))
    taken = [r[0] for r in valid.where(draw < share).select("embedding").distinct().orderBy(F.xxhash64("embedding")).limit(2 * sample).collect()]
    if not taken:  # nothing fell into the sample: a tiny table, or copies of one vector
        taken = [r[0] for r in valid.select("embedding").limit(1).collect()]
    lengths = [len(x) for x in taken]
    width = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 1
    router = spark.sparkContext.broadcast(fit(np.array([x for x in taken if len(x) == width], float).reshape(-1, width), parts, k, recall))
    parts, probes = router.value.parts, router.value.probes
    valid = valid.where(F.size("embedding") == width)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {p: [] for p in range(parts)}
        sizes = dict.fromkeys(held, 0)

        def flush(p):
            ids = np.concatenate([x for x, _ in held[p]])
            vectors = np.concatenate([x for _, x in held[p]])
            held[p], sizes[p] = [], 0
            for a in range(0, len(ids), block):
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([len(ids[a : a + block])], pa.int64()), pa.array([ids[a : a + block].astype("<i8").tobytes()]), pa.array([vectors[a : a + block].astype("<f8").tobytes()])], ["part", "n", "ids", "vectors"])

        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            home = router.value.order(vectors)[:, 0] if len(ids) else np.zeros(0, int)
            for p in np.unique(home).tolist():
                mine = home == p
                held[p].append((ids[mine], vectors[mine]))
                sizes[p] += int(mine.sum())
                if sizes[p] >= block:
                    yield from flush(p)
        for p in list(held):
            if sizes[p]:
                yield from flush(p)

    schema = "part int, n bigint, ids binary, vectors binary"
    blocks = written(valid.mapInArrow(index, schema), "index")
    counts = np.zeros(parts, np.int64)
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).collect():
        counts[r["part"]] = r["n"]
    enough = 10 * k

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            order = router.value.order(vectors)
            before = np.cumsum(counts[order], axis=1) - counts[order]
            use = (np.arange(parts) < probes) | (before < enough)
            for p in range(parts):
                mine = np.flatnonzero((use & (order == p)).any(axis=1))
                for a in range(0, len(mine), block):
                    rows = mine[a : a + block]
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([ids[rows].astype("<i8").tobytes()]), pa.array([vectors[rows].astype("<f8").tobytes()])], ["part", "n", "ids", "vectors"])

    queries = valid.where(is_query).dropDuplicates(["vec_id"])
    asked = written(queries.mapInArrow(route, schema), "queries")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, qv, ids, vectors = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in enumerate(("<i8", "<f8", "<i8", "<f8")))
                qv, vectors = qv.reshape(-1, width), vectors.reshape(-1, width)
                out = []
                for one, v in zip(q.tolist(), qv):
                    distance = np.sqrt(((vectors - v) ** 2).sum(axis=1))
                    distance[ids == one] = np.inf
                    # All rows as near as the k-th distinct candidate, in order of distance and id.
                    order = np.lexsort((ids, distance)) if len(ids) <= 4 * k else None
                    if order is None:
                        bound = np.partition(distance, 4 * k - 1)[4 * k - 1]
                        near = np.flatnonzero(distance <= bound)
                        order = near[np.lexsort((ids[near], distance[near]))]
                    best: dict[int, float] = {}
                    for j in order.tolist():
                        if np.isfinite(distance[j]):
                            best.setdefault(int(ids[j]), float(distance[j]))
                        if len(best) == k:
                            break
                    if len(best) < k and len(order) < len(ids):
                        for j in np.lexsort((ids, distance)).tolist():
                            if np.isfinite(distance[j]) and len(best) < k:
                                best.setdefault(int(ids[j]), float(distance[j]))
                    out += [(one, x, d) for x, d in best.items()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    a = asked.select("part", F.col("ids").alias("q"), F.col("vectors").alias("qv"))
    pairs = a.join(blocks.select("part", "ids", "vectors"), "part").select("q", "qv", "ids", "vectors")
    found = pairs.mapInArrow(rank, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
