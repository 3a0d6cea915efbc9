"""Hard negatives by exact inner products, found in R-trees that are packed by Sort-Tile-Recursive.

Rows are range-partitioned and sorted by label and first component: slabs of that order are trees, and each is tiled by
its other components, widest first. A node's minimum bounding box gives, coordinate by coordinate, the least and the
greatest product with an anchor, so an interval for its inner products. A search takes nodes from a
queue, greatest upper bound first, and skips those whose interval misses every score window, whose
labels cannot match, or that cannot reach the k-th row found so far (strictly below it, or equal with greater ids).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import written

LEAF, FAN = 128, 8
NO_BOUND = 1 << 62


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and whole components of the rows that take part: nothing null, all components finite.

    A vector without components counts as one zero. A component of 2^53 or more after scaling is an error.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    whole = lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit("component too large")).cast("bigint"))
    vector = F.when(F.size("embedding") == 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.transform("embedding", whole))
    return rows.select("vec_id", "label", vector.alias("vector"))


def tiles(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """An order in which each run of `leaf` rows is a tile: sorted by one component, cut into slabs, each slab by the next.

    Components are taken by spread. Slabs hold whole leaves; ties go by id, so copies of one vector stay in order of id.
    """
    n, width = vectors.shape
    dims = np.argsort(-(vectors.max(axis=0) - vectors.min(axis=0)).astype(float), kind="stable") if n else np.arange(width)

    def sort(rows: np.ndarray, depth: int) -> np.ndarray:
        leaves = -(-len(rows) // leaf)
        left = width - depth
        if leaves <= 1 or left <= 0:
            return rows[np.argsort(ids[rows], kind="stable")]
        rows = rows[np.lexsort((ids[rows], vectors[rows, dims[depth]]))]
        slabs = max(2, math.ceil(leaves ** (1 / left)))
        size = -(-leaves // slabs) * leaf
        return np.concatenate([sort(rows[a : a + size], depth + 1) for a in range(0, len(rows), size)])

    return sort(np.arange(n), 0)


@dataclass
class Tree:
    """Rows in leaf order, and for each level, leaves first, the boxes of its nodes."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple]  # low, high, least label, greatest label, least id

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
        """The tree over rows that are in leaf order."""
        parts, step = (vectors, vectors, labels, labels, ids), LEAF
        levels: list[tuple] = []
        while not levels or len(levels[-1][4]) > 1:
            at = np.arange(0, len(parts[4]), step)
            folds = (np.minimum, np.maximum, np.minimum, np.maximum, np.minimum)
            parts = tuple(f.reduceat(p, at, axis=0) for f, p in zip(folds, parts))
            levels.append(parts)
            step = FAN
        return cls(ids, labels, vectors, levels)


class Wanted:
    """The best k rows found in a window of scores, best first, smaller ids first among equals."""

    __slots__ = ("key", "low", "high", "k", "best")

    def __init__(self, key: int, low: int, high: int, k: int):
        self.key, self.low, self.high, self.k = key, low, high, k
        self.best: list[tuple[int, int]] = []  # (-score, id)

    def open_to(self, least: int, most: int, least_id: int) -> bool:
        """Whether rows with scores from `least` to `most` and ids from `least_id` on may belong here."""
        if most < self.low or least > self.high:
            return False
        return len(self.best) < self.k or (-min(most, self.high), least_id) <= self.best[-1]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = max(self.low, -self.best[-1][0]) if len(self.best) == self.k else self.low
        fits = np.flatnonzero((scores >= floor) & (scores <= self.high))
        if len(fits) > self.k:
            fits = fits[np.lexsort((ids[fits], -scores[fits]))[: self.k]]
        if len(fits):
            found = [(-int(s), int(i)) for s, i in zip(scores[fits], ids[fits])]
            self.best = sorted(self.best + found)[: self.k]


def _products(a: np.ndarray, b: np.ndarray):
    """The type in which inner products of rows of `a` and `b` are exact: doubles up to 2^53, else Python's integers."""
    top = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    return np.float64 if top[0] * top[1] * a.shape[1] < 1 << 53 else object


def search(tree: Tree, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, wanted: list[list[Wanted]], same: bool) -> None:
    """Offers to each anchor's windows the rows of the tree that have another id and the same label, or another label."""
    kind = _products(vectors, tree.vectors)
    anchors = vectors.astype(kind)
    above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
    bounds = []
    for low, high, *_ in tree.levels:
        low, high = low.astype(kind), high.astype(kind)
        bounds.append((above @ low.T + below @ high.T, above @ high.T + below @ low.T))
    rows = tree.vectors.astype(kind)
    top = len(tree.levels) - 1
    for a, (one, label, windows) in enumerate(zip(ids.tolist(), labels.tolist(), wanted)):
        def admits(level: int, node: int) -> bool:
            _, _, least, most, first = tree.levels[level]
            fits = least[node] <= label <= most[node] if same else not least[node] == label == most[node]
            return fits and any(w.open_to(bounds[level][0][a, node], bounds[level][1][a, node], int(first[node])) for w in windows)

        queue = [(-bounds[top][1][a, n], int(tree.levels[top][4][n]), top, n) for n in range(len(tree.levels[top][4]))]
        heapq.heapify(queue)
        while queue:
            _, _, level, node = heapq.heappop(queue)
            if not admits(level, node):
                continue
            if level == 0:
                part = slice(node * LEAF, (node + 1) * LEAF)
                match = tree.labels[part] == label if same else tree.labels[part] != label
                keep = np.flatnonzero(match & (tree.ids[part] != one))
                if len(keep):
                    scores = (rows[part] @ anchors[a])[keep]
                    for w in windows:
                        w.offer(scores, tree.ids[part][keep])
            else:
                for child in range(node * FAN, min((node + 1) * FAN, len(tree.levels[level - 1][4]))):
                    if admits(level - 1, child):
                        heapq.heappush(queue, (-bounds[level - 1][1][a, child], int(tree.levels[level - 1][4][child]), level - 1, child))


_ROWS = "width int, label_low bigint, label_high bigint, ids binary, labels binary, vectors binary"


def _packed(rows: DataFrame, most: int, tiled: bool) -> DataFrame:
    """Rows with a name (`block`), in groups of at most `most` rows of one vector length that follow each other in the order of label, first component and id."""
    order = [F.size("vector"), F.col("label"), F.col("vector")[0], F.col("vec_id")]
    arranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = width = 0

        def flush():
            ids, labels, vectors = (np.concatenate(x) for x in zip(*held))
            at = tiles(vectors, ids) if tiled else np.arange(len(ids))
            values = [width, int(labels.min()), int(labels.max()), ids[at].tobytes(), labels[at].tobytes(), vectors[at].tobytes()]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["width", "label_low", "label_high", "ids", "labels", "vectors"])

        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column(2).value_lengths().to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and lengths[a] != width:
                    yield flush()
                    held, count = [], 0
                width = int(lengths[a])
                while a < b:
                    part = batch.slice(a, min(b - a, most - count))
                    matrix = part.column(2).flatten().to_numpy().astype("<i8").reshape(-1, width)
                    held.append((part.column(0).to_numpy().astype("<i8"), part.column(1).to_numpy().astype("<i8"), matrix))
                    a, count = a + part.num_rows, count + part.num_rows
                    if count == most:
                        yield flush()
                        held, count = [], 0
        if held:
            yield flush()

    packed = arranged.select("vec_id", "label", "vector").mapInArrow(pack, _ROWS)
    return written(packed.withColumn("block", F.expr("uuid()")), "packed")


def _found(blocks: DataFrame, trees: DataFrame, same: bool, k: int, span: int) -> DataFrame:
    """block, at (the anchor's place in it), key (of the window), vec_id, score: at least the best k rows of each window.

    A block of anchors goes to `slots` tasks with the trees that may hold its labels, each sent on its own, so neither
    the blocks nor the trees of one task are ever held together; what a task has found narrows its search on.
    """
    spark = blocks.sparkSession
    n_trees, n_blocks = trees.count(), blocks.count()
    slots = max(1, -(-n_trees // span))
    asked = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    placed = trees.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).drop("block").alias("t")
    light = asked.select("block", "slot", "width", "label_low", "label_high").alias("b")
    overlap = (F.col("t.label_low") <= F.col("b.label_high")) & (F.col("t.label_high") >= F.col("b.label_low"))
    single = (F.col("t.label_low") == F.col("t.label_high")) & (F.col("b.label_low") == F.col("b.label_high"))
    may = overlap if same else ~(single & (F.col("t.label_low") == F.col("b.label_low")))
    meet = (F.col("t.slot") == F.col("b.slot")) & (F.col("t.width") == F.col("b.width")) & may
    none = F.lit(None).cast("array<struct<at:int,key:int,low:bigint,high:bigint>>")
    pairs = light.join(placed, meet).select("b.block", "b.slot", F.lit(1).alias("tree"), "t.width", "t.ids", "t.labels", "t.vectors", none.alias("wants"))
    heads = asked.select("block", "slot", F.lit(0).alias("tree"), "width", "ids", "labels", "vectors", "wants")
    tasks = max(1, min(n_blocks * slots, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    rows = heads.unionByName(pairs).repartition(tasks, "block", "slot").sortWithinPartitions("block", "slot", "tree")

    def meet_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state = None, None

        def result():
            out = [(at, w.key, i, -s) for at, windows in enumerate(state[3]) for w in windows for s, i in w.best]
            columns = [pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([block] * len(out), pa.string()), *columns], ["block", "at", "key", "vec_id", "score"]) if out else None

        for batch in batches:
            for r in range(batch.num_rows):
                name, _, tree, width, ids, labels, vectors, wants = (batch.column(c)[r].as_py() for c in range(8))
                ids, labels, vectors = (np.frombuffer(x, "<i8") for x in (ids, labels, vectors))
                vectors = vectors.reshape(-1, width)
                if tree == 0:
                    if state is not None and (made := result()):
                        yield made
                    windows: list[list[Wanted]] = [[] for _ in ids]
                    for w in wants:
                        windows[w["at"]].append(Wanted(w["key"], w["low"], w["high"], k))
                    block, state = name, (ids, labels, vectors, windows)
                else:
                    search(Tree.of(ids, labels, vectors), *state, same)
        if state is not None and (made := result()):
            yield made

    return rows.mapInArrow(meet_trees, "block string, at int, key int, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("block", "at", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, tree_rows: int = 4096, most_anchors: int = 2048, span: int = 64,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * component). The positives of an anchor are its best other rows
    of the same label; the negatives of a pair are the best rows of other labels whose score is from `low` to `high`
    percent of the positive's. Greater scores come first, ties by smaller vec_id. `rows` has vec_id, label and
    embedding; other columns are ignored. Rows with a null vec_id, label, vector or component, or a component that is
    not finite, take no part. Only vectors of one length have a score with each other. Rows that repeat a vec_id
    are rows of their own, never partners of each other. Every anchor meets every row, in trees of `tree_rows`
    rows and blocks of at most `most_anchors` anchors, except those whose boxes or labels rule them out.
    """
    spark = rows.sparkSession
    valid = usable(rows, scale)
    trees = _packed(valid, tree_rows, True)
    anchors = valid.where(is_anchor)
    share = -(-anchors.count() // spark.sparkContext.defaultParallelism)
    blocks = _packed(anchors, min(most_anchors, max(32, share)), False)
    size = (F.octet_length("ids") / 8).cast("int")
    window = lambda i: F.struct(i.cast("int").alias("at"), F.lit(0).alias("key"), F.lit(-NO_BOUND).alias("low"), F.lit(NO_BOUND).alias("high"))
    every = blocks.withColumn("wants", F.transform(F.sequence(F.lit(0), size - 1), window))
    kept = written(_best(_found(every, trees, True, positives, span), positives), "positives")

    wants = kept.groupBy("block").agg(F.collect_list(F.struct(
        "at", F.col("rank").alias("key"),
        F.ceil(F.col("score") * low / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("low"),
        F.floor(F.col("score") * high / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("high"),
    )).alias("wants"))
    found = _best(_found(blocks.join(wants, "block"), trees, False, negatives, span), negatives)
    pairs = kept.select("block", "at", F.col("rank").alias("key"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = _anchor_ids(blocks)
    found = found.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score")
    return found.join(pairs, ["block", "at", "key"]).join(names, ["block", "at"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def _anchor_ids(blocks: DataFrame) -> DataFrame:
    """block, at, anchor_id."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[r].as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[r].as_py()] * len(ids), pa.string()), pa.array(np.arange(len(ids), dtype="<i4")), pa.array(ids)], ["block", "at", "anchor_id"])

    return blocks.select("block", "ids").mapInArrow(names, "block string, at int, anchor_id bigint")
