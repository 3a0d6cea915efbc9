"""Near-duplicate documents by BagMinHash: weighted-Jaccard signatures of shingle multisets, bands, exact check.

A document is the multiset of its five-word shingles. Two documents are linked when the sum of the
smaller multiplicities is at least 0.8 of the sum of the larger ones; classes are the connected
components of the links, and exact copies.

1. One pass makes a digest of the text and a signature. Each shingle starts Poisson processes on the
   dyadic pieces (0,1], (1,2], (2,4], ... of the weight axis; a point lies in a unit of the weight, found
   by halving its piece, and counts if the weight reaches that unit. Points fall on registers, and each
   register keeps its earliest point; equal registers have the probability of the weighted Jaccard
   similarity. Only points before a time by which all registers are filled are made.
2. Copies of a text are one representative (smallest doc_id) from here on.
3. Signatures are cut into bands; documents with an equal band form a bucket. Buckets are never expanded
   into pairs: each document is checked against its bucket's hub, the document with most company.
4. Members whom their hub has not joined are compared exactly with the others of that hub's buckets, in
   blocks of bounded size: a task multiplies two blocks and returns at most the links that join components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import slices
from millrace.llm.components import components
from millrace.llm.shingles import mix, shingle_arrays
from millrace.session import written

REGISTERS = 128
BANDS = 32
BROADCAST_ROWS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, their multiplicities, and offsets by text."""
    hashes, offsets = shingle_arrays(texts)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    weights = np.diff(np.concatenate((first, [len(hashes)])))
    return hashes[first], weights, np.searchsorted(text[first], np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """uint64 [texts, registers]: of each register the identity of its earliest point; 0 for texts without shingles."""
    texts = len(offsets) - 1
    best = np.full(texts * registers, np.inf)
    names = np.zeros(texts * registers, np.uint64)
    if not len(hashes):
        return names.reshape(texts, registers)
    text = np.repeat(np.arange(texts), np.diff(offsets))
    total = np.bincount(text, weights, texts)
    # Dyadic pieces of each shingle's weight: piece 0 is the first unit, piece j has 2^(j-1) units from 2^(j-1) on.
    pieces = 1 + np.ceil(np.log2(weights)).astype(np.int64)
    owner = np.repeat(np.arange(len(hashes)), pieces)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    base = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    rate = np.maximum(base, 1).astype(float)
    seed = mix(hashes[owner] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))
    top, where = weights[owner], text[owner]
    until = registers / np.maximum(total, 1) * (np.log(registers) + 10)
    time = np.zeros(len(owner))
    active, made, width = np.arange(len(owner)), 0, 4
    while len(active):
        # `width` further points of every process that has not passed its document's time.
        k = np.arange(made, made + width, dtype=np.uint64)
        name = mix(seed[active, None] + (k + np.uint64(1))[None, :] * _STEP)
        gap = -np.log(((name >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate[active, None]
        at = time[active, None] + np.cumsum(gap, axis=1)
        lot = mix(name + np.uint64(0x632BE59BD9B4E019))
        unit = base[active, None] + ((lot >> np.uint64(32)).astype(float) / (1 << 32) * rate[active, None]).astype(np.int64)
        ok = (at < until[where[active], None]) & (unit < top[active, None])
        slot = (where[active, None] * registers + (lot % np.uint64(registers)).astype(np.int64))[ok]
        when, which = at[ok], name[ok]
        np.minimum.at(best, slot, when)
        won = when == best[slot]
        names[slot[won]] = which[won]
        time[active] = at[:, -1]
        made, width = made + width, min(width * 2, 256)
        going = time[active] < until[where[active]]
        active = active[going]
        if not len(active):
            # A register may still be empty (rare): give that document more time.
            short = (~np.isfinite(best).reshape(texts, registers).all(axis=1)) & (total > 0)
            if short.any():
                until = np.where(short, until * 2, 0.0)
                best[np.repeat(short, registers)] = np.inf
                time[:] = 0
                active, made, width = np.flatnonzero(short[where]), 0, 4
    return names.reshape(texts, registers)


def _signed(docs: DataFrame, bands: int) -> DataFrame:
    """id, digest, n (shingles), keys (one per band, packed) of every row with an id and a text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            hashes, weights, offsets = bags(texts)
            found = signatures(hashes, weights, offsets).reshape(len(texts), bands, -1)
            keys = np.zeros(found.shape[:2], np.uint64)
            for r in range(found.shape[2]):
                keys = mix(keys * np.uint64(3) + found[:, :, r])
            total = np.concatenate(([0], np.cumsum(weights)))
            n = total[offsets[1:]] - total[offsets[:-1]]
            digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            packed = [k.tobytes() if size else None for k, size in zip(keys.astype(">u8"), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["id", "digest", "n", "keys"])

    rows = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null and text is not null")
    return rows.mapInArrow(sign, rows.select("id").schema.add("digest", "binary").add("n", "long").add("keys", "binary"))


def overlap(pairs: DataFrame) -> DataFrame:
    """a, b, similarity of rows (a, b, text_a, text_b): the exact weighted Jaccard of the shingle multisets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, left in slices(batches, "text_a", 1_000_000):
            found = []
            right = batch.column(batch.schema.get_field_index("text_b")).to_pylist()
            distinct = {t: i for i, t in enumerate(dict.fromkeys(left + right))}
            hashes, weights, offsets = bags(list(distinct))
            for x, y in zip(left, right):
                i, j = distinct[x], distinct[y]
                hx, wx = hashes[offsets[i] : offsets[i + 1]], weights[offsets[i] : offsets[i + 1]]
                hy, wy = hashes[offsets[j] : offsets[j + 1]], weights[offsets[j] : offsets[j + 1]]
                at = np.minimum(np.searchsorted(hy, hx), max(len(hy) - 1, 0))
                both = hy[at] == hx if len(hy) else np.zeros(len(hx), bool)
                shared = int(np.minimum(wx[both], wy[at[both]]).sum())
                union = int(wx.sum() + wy.sum()) - shared
                found.append(shared / union if union else 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in "ab"), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    rows = pairs.select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(compare, rows.select("a", "b").schema.add("similarity", "double"))


def block_links(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray, groups: list, least: float) -> list[tuple[int, int]]:
    """Pairs of positions (one of `left`, one of `right`) with at least the similarity `least` that join different groups.

    A spanning set: a pair whose groups earlier pairs have joined is left out. Overlaps are products of
    0/1 matrices, a column for each unit of weight of a shingle that several bags have.
    """
    sizes = np.zeros(len(offsets) - 1)
    owner = np.repeat(np.arange(len(sizes)), np.diff(offsets))
    np.add.at(sizes, owner, weights)
    unit = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
    owner = np.repeat(owner, weights)
    column = np.unique(mix(np.repeat(hashes, weights) + unit.astype(np.uint64) * _STEP), return_inverse=True)[1]
    place_left, place_right = np.full(len(sizes), -1), np.full(len(sizes), -1)
    place_left[left], place_right[right] = np.arange(len(left)), np.arange(len(right))
    # Only units that bags of both sides have add to an overlap.
    both = np.bincount(column, place_left[owner] >= 0).astype(bool) & np.bincount(column, place_right[owner] >= 0).astype(bool)
    keep = both[column]
    owner, column = owner[keep], (np.cumsum(both) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    columns = int(both.sum())
    shared = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, columns, 2048):
        width = min(2048, columns - first)
        a, b = np.searchsorted(column, [first, first + width])
        who, what = owner[a:b], column[a:b] - first
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        mine = place_left[who] >= 0
        x[place_left[who[mine]], what[mine]] = 1
        mine = place_right[who] >= 0
        y[place_right[who[mine]], what[mine]] = 1
        shared += x @ y.T
    either = sizes[left][:, None] + sizes[right][None, :] - shared
    near = shared / np.maximum(either, 1) >= least
    codes: dict = {}
    code = np.array([codes.setdefault(g, len(codes)) for g in groups])
    parent = list(range(len(codes)))

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    found = []
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        # One partner of each group is enough.
        partners = np.flatnonzero(near[i])
        kinds, first_of = np.unique(code[right[partners]], return_index=True)
        for kind, j in zip(kinds.tolist(), right[partners[first_of]].tolist()):
            x, y = root(int(code[left[i]])), root(kind)
            if x != y:
                parent[x] = y
                found.append((int(left[i]), j))
    return found


def _lonely(texts: DataFrame) -> DataFrame:
    """id and how many units of its bag no other of these texts has (id, text); ids without any are left out.

    A unit is a shingle with the number of its copy. Units are folded before they are shuffled, so one that every
    text has is one row a task.
    """

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in slices(batches, "text"):
            hashes, weights, offsets = bags(values)
            unit = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
            names = mix(np.repeat(hashes, weights) + unit.astype(np.uint64) * _STEP)
            owner = np.repeat(np.repeat(np.arange(len(values)), np.diff(offsets)), weights)
            for at in range(0, len(names), 500_000):
                part = slice(at, at + 500_000)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[part])), pa.array(names[part].view(np.int64))], ["id", "unit"])

    rows = texts.select("id", "text")
    found = rows.mapInArrow(units, rows.select("id").schema.add("unit", "long"))
    single = found.groupBy("unit").agg(F.count("*").alias("owners"), F.min("id").alias("id")).where("owners = 1")
    return single.groupBy("id").agg(F.count("*").alias("lonely"))


def _in_blocks(members: DataFrame, texts: DataFrame, least: float, block_rows: int, block_shingles: int) -> DataFrame:
    """Links (a, b) among members (hub, id, n, component) of each hub that join a component other than the hub's.

    Units that no other document has are in no overlap. A member with so many of them that even the smallest
    member could not be near it is left out: it is near to none.
    """
    home = members.where(F.col("id") == F.col("hub")).select("hub", F.col("component").alias("home"))
    marked = members.join(home, "hub").withColumn("stray", F.col("component") != F.col("home")).drop("home")
    smallest = marked.groupBy("hub").agg(F.count("*").alias("all"), F.count_if(F.col("stray")).alias("strays"), F.min("n").alias("smallest"))
    # A hub and one other have been compared with each other.
    smallest = smallest.where("strays > 0 and all > 2").select("hub", "smallest")
    marked = written(marked.join(smallest, "hub"), "marked")
    lonely = _lonely(texts.join(marked.select("id"), "id", "left_semi"))
    marked = marked.join(lonely, "id", "left").withColumn("common", F.col("n") - F.coalesce("lonely", F.lit(0)))
    reach = F.col("common") / (F.col("n") + F.greatest("common", "smallest") - F.col("common"))
    marked = written(marked.where(reach >= least).drop("lonely", "common", "smallest"), "within-reach")
    sizes = marked.groupBy("hub").agg(F.count("*").alias("all"), F.count_if(F.col("stray")).alias("strays"), F.sum("n").alias("shingles"))
    sizes = sizes.where("strays > 0 and all > 1")
    blocks = F.greatest(F.ceil(F.col("all") / block_rows), F.ceil(F.col("shingles") / block_shingles)).cast("int")
    rows = marked.join(sizes.select("hub", blocks.alias("blocks")), "hub")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.select("hub", "id", "component", "stray", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    as_stray = rows.where("stray").select("hub", F.col("own").alias("i"), F.col("other").alias("j"), "id", "component", "stray")
    as_member = rows.select("hub", F.col("other").alias("i"), F.col("own").alias("j"), "id", "component", F.lit(False).alias("stray"))
    tasks = as_stray.union(as_member).join(texts, "id").select("hub", "i", "j", "id", "component", "stray", "text")
    schema = tasks.select(F.col("id").alias("a"), F.col("id").alias("b")).schema

    def compare(table: pa.Table) -> pa.Table:
        ids, values, groups = (table.column(c).to_pylist() for c in ("id", "text", "component"))
        stray = np.array(table.column("stray").to_pylist(), bool)
        found = []
        if stray.any() and not stray.all():
            found = block_links(*bags(values), np.flatnonzero(stray), np.flatnonzero(~stray), groups, least)
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array([ids[i] for i, _ in found], kind), "b": pa.array([ids[j] for _, j in found], kind)})

    return tasks.groupBy("hub", "i", "j").applyInArrow(compare, schema)


def _few(ids: DataFrame) -> DataFrame:
    """Ids of one written column, broadcast when they are few; many are joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) with their exact similarity, written."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return written(overlap(pairs.join(a, "a").join(b, "b")), "similar")


def links(
    docs: DataFrame, least: float = 0.8, bands: int = BANDS, block_rows: int = 512, block_shingles: int = 200_000
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that join near-duplicate representatives, and all rows (id, representative).

    The links hold a spanning set of every class: a link between two documents that other links already
    join need not be among them.
    """
    signed = written(_signed(docs, bands), "signed")
    heads = signed.groupBy("digest").agg(F.min("id").alias("head"))
    members = written(signed.join(heads, "digest").select("id", F.col("head").alias("representative"), "n", "keys"), "members")
    heads = members.where((F.col("id") == F.col("representative")) & F.col("keys").isNotNull())
    rows = heads.select("id", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.substring("keys", i * 8 + 1, F.lit(8)))).alias("band", "key"))
    shared = rows.groupBy("band", "key").agg(F.count("*").alias("company"), F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y")
    active = written(rows.join(shared.select("band", "key", "company"), ["band", "key"]), "buckets")
    ids = written(active.select("id").distinct(), "involved")
    texts = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null and text is not null")
    texts = written(texts.join(_few(ids), "id", "left_semi").dropDuplicates(["id"]), "texts")

    # Against the hub: the member whose buckets hold most documents.
    busy = active.groupBy("id").agg(F.sum("company").alias("busy"))
    ranked = active.join(busy, "id").select("band", "key", "id", "n", "busy")
    hubs = ranked.groupBy("band", "key").agg(F.max(F.struct("busy", F.col("id").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    hubs = written(hubs.select("band", "key", "h.hub", "h.hub_n"), "hubs")
    long_enough = lambda x, y: F.least(x, y) >= F.greatest(x, y) * least
    placed = written(active.select("band", "key", "id", "n").join(hubs, ["band", "key"]), "placed")
    pairs = placed.where((F.col("id") != F.col("hub")) & long_enough(F.col("n"), F.col("hub_n"))).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    near_hub = _checked(pairs, texts)
    found = near_hub.where(F.col("similarity") >= least).select("a", "b")

    # Members whom their hub has not joined.
    joined = written(components(found), "joined")
    groups = placed.select("hub", "id", "n").distinct().join(joined.withColumnRenamed("node", "id"), "id", "left")
    groups = written(groups.select("hub", "id", "n", F.coalesce("component", "id").alias("component")), "groups")
    more = written(_in_blocks(groups, texts, least, block_rows, block_shingles), "more")
    return joined.where("node <> component").toDF("a", "b").union(more), members.select("id", "representative")


def classes(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its class, for every row of `docs`.

    docs has doc_id and text; other columns are ignored. A null text is alike with nothing, so its row is
    a class of its own; equal texts are one class, empty ones too. Rows that share a doc_id are one
    document in all their classes. A null doc_id has class null. An empty table gives no rows.
    """
    found, members = links(docs, least)
    copies = members.where("id <> representative").select(F.col("id").alias("a"), F.col("representative").alias("b"))
    groups = components(found.select("a", "b").union(copies))
    every = docs.select("doc_id").alias("d")
    return every.join(groups.alias("g"), F.expr("d.doc_id = g.node"), "left").select(F.expr("d.doc_id").alias("doc_id"), F.expr("coalesce(g.component, d.doc_id)").alias("class_id"))


def one_per_class(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose doc_id is the smallest of its class (or null)."""
    gone = written(classes(docs, least).where("doc_id <> class_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
