"""Token ids in files, coded by a static range asymmetric numeral system.

A file holds documents in ascending doc_id order, each ended by the end id. One frequency table per file,
counted over all its ids, is shared by its blocks. Blocks are independent: each has its own interleaved
states and a checksum, and checkpoints in it (states and place in the stream) from which decoding can
start. So blocks, or parts of one, are decoded in parallel.

File, little-endian: magic "RANS0001"; blocks; index (JSON, zlib): the table, every block's place, size,
ids, lanes, checkpoints, checksum, and the documents' doc_ids and sizes; the file's place among all files, its ids and
blocks; then the index's length as 8 bytes.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import files
from millrace.llm.batches import slices
from millrace.llm.tokens import encoder, public_file
from millrace.session import written

MAGIC = b"RANS0001"
_PLACE = struct.Struct("<iiqi")  # range of doc_ids, number within it, ids, blocks
PRECISION = 20  # frequencies add up to 2^20
LOWEST = np.uint64(1 << 31)  # states stay from 2^31 up to 2^63; 32 bits move at a time
LANES = 1024
BLOCK_IDS = 1 << 19
CHECKPOINT_STEPS = 256
END = 0
MOST_READERS = 10_000  # tasks of one read


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies that add up to 2^PRECISION, at least 1 for every id that occurs, near its share."""
    whole = 1 << PRECISION
    used = counts > 0
    if used.sum() > whole:
        raise ValueError("more distinct ids than the table has slots")
    freq = np.where(used, np.maximum(1, np.floor(counts / max(counts.sum(), 1) * whole)), 0).astype(np.int64)
    while (excess := int(freq.sum()) - whole) != 0:
        if excess < 0:
            freq[freq.argmax()] -= excess
        else:
            # Take from the largest, never below 1.
            order = np.argsort(-freq, kind="stable")
            can = freq[order] - 1
            take = np.minimum(can, np.maximum(1, can // 2))
            take = np.where(np.cumsum(take) <= excess, take, np.maximum(0, excess - (np.cumsum(take) - take)))
            freq[order] -= take
    return freq


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray) -> tuple[bytes, dict]:
    """The bytes of a block and what its index entry says. Id number i is in lane i % lanes, step i // lanes."""
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    steps = -(-n // lanes)
    grid = np.zeros(steps * lanes, np.int64)
    grid[:n] = ids
    live = n - (steps - 1) * lanes  # lanes of the last step
    state = np.full(lanes, LOWEST, np.uint64)
    word = np.uint64(32)
    f_all, s_all = (x.astype(np.uint64).take(grid).reshape(steps, lanes) for x in (freq, start))
    full_all, rest_all = f_all << np.uint64(63 - PRECISION), np.uint64(1 << PRECISION) - f_all
    chunks: list[np.ndarray] = []
    sent, marks = 0, []
    for step in range(steps - 1, -1, -1):
        width = live if step == steps - 1 else lanes
        x = state[:width]
        full = np.flatnonzero(x >= full_all[step, :width])
        if len(full):
            out = x.take(full)
            chunks.append(out.astype(np.uint32))
            sent += len(out)
            x[full] = out >> word
        # The quotient by f moved up, the remainder, and the start.
        q = x // f_all[step, :width]
        q *= rest_all[step, :width]
        x += q
        x += s_all[step, :width]
        if step and step % CHECKPOINT_STEPS == 0:
            marks.append((step, sent, state.copy()))
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
    # A checkpoint: the step to go on with, the words before it, and the states then.
    points = [(step, sent - words) for step, words, _ in marks[::-1]]
    states = np.concatenate([state, *[m for _, _, m in marks[::-1]]]).astype("<u8").tobytes()
    payload = states + stream.astype("<u4").tobytes()
    return payload, {"ids": n, "lanes": lanes, "points": points, "crc": zlib.crc32(payload)}


def slots(freq: np.ndarray) -> np.ndarray:
    """The id of each of the 2^PRECISION slots."""
    return np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def decode_block(payload: bytes, entry: dict, freq: np.ndarray, start: np.ndarray, table: np.ndarray, point: int = -1, steps: int | None = None) -> np.ndarray:
    """The ids of a block; from checkpoint `point` on, or the block's start, for `steps` steps if given."""
    n, lanes = entry["ids"], entry["lanes"]
    all_steps = -(-n // lanes)
    live = n - (all_steps - 1) * lanes
    sets = 1 + len(entry["points"])
    states = np.frombuffer(payload, "<u8", sets * lanes)
    stream = np.frombuffer(payload, "<u4", offset=sets * lanes * 8)
    step, at = entry["points"][point] if point >= 0 else (0, 0)
    # States are below 2^63. Signed ones are places in a table as they are.
    state = states[(point + 1) * lanes : (point + 2) * lanes].astype(np.int64)
    last = all_steps if steps is None else min(all_steps, step + steps)
    out = np.empty((max(0, last - step), lanes), np.uint32)
    mask, lowest = (1 << PRECISION) - 1, int(LOWEST)
    for row, now in enumerate(range(step, last)):
        width = live if now == all_steps - 1 else lanes
        x = state[:width]
        slot = x & mask
        found = table.take(slot)
        x >>= PRECISION
        x *= freq.take(found)
        slot -= start.take(found)
        x += slot
        low = np.flatnonzero(x < lowest)
        if k := len(low):
            x[low] = (x.take(low) << 32) | stream[at : at + k]
            at += k
        out[row, :width] = found
    return out.reshape(-1)[: min(n, last * lanes) - step * lanes] if last > step else out.reshape(-1)


def encode_file(documents: list[bytes], names: list | None = None, place: tuple[int, int] = (0, 0)) -> bytes:
    """A whole file from documents' ids (unsigned 32-bit, little-endian, end id included).

    The index holds the documents' names (doc_ids, None for null) and the place of the file among all files.
    """
    sizes = [len(d) // 4 for d in documents]
    ids = np.frombuffer(b"".join(documents), "<u4").astype(np.int64)
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    freq = frequencies(counts) if len(ids) else counts
    start = np.cumsum(freq) - freq
    parts, blocks, at = [MAGIC], [], len(MAGIC)
    for first in range(0, len(ids), BLOCK_IDS):
        payload, entry = encode_block(ids[first : first + BLOCK_IDS], freq, start)
        blocks.append(entry | {"at": at, "bytes": len(payload), "first": first})
        parts.append(payload)
        at += len(payload)
    known = np.flatnonzero(freq)
    index = {"known": np.diff(known, prepend=0).tolist(), "freq": freq[known].tolist(), "blocks": blocks, "documents": sizes}
    index["names"] = names if names is not None else [None] * len(documents)
    place_of_file = _PLACE.pack(*place, len(ids), len(blocks))
    packed = zlib.compress(json.dumps(index, separators=(",", ":")).encode())
    return b"".join([*parts, packed, place_of_file, len(packed).to_bytes(8, "little")])


def read_place(file) -> tuple[int, int, int, int]:
    """The range and number of an open file among all files, its ids and blocks: from its last bytes alone."""
    file.seek(file.size() - 8 - _PLACE.size)
    return _PLACE.unpack(file.read(_PLACE.size))


def read_index(file) -> dict:
    """Blocks, documents, and the table as freq, start and slots, from an open file."""
    size = file.size()
    file.seek(0)
    if file.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of this format")
    file.seek(size - 8)
    length = int.from_bytes(file.read(8), "little")
    file.seek(size - 8 - _PLACE.size - length)
    index = json.loads(zlib.decompress(file.read(length)))
    known = np.cumsum(np.array(index["known"], np.int64))
    freq = np.zeros(int(known[-1]) + 1 if len(known) else 0, np.int64)
    if len(known):
        freq[known] = index["freq"]
    return index | {"freq": freq, "start": np.cumsum(freq) - freq, "slots": slots(freq)}


def read_block(file, index: dict, number: int) -> np.ndarray:
    """The ids of one block; an error if its checksum does not hold."""
    entry = index["blocks"][number]
    file.seek(entry["at"])
    payload = file.read(entry["bytes"])
    if zlib.crc32(payload) != entry["crc"]:
        raise ValueError(f"block {number} is damaged")
    return decode_block(payload, entry, index["freq"], index["start"], index["slots"])


def read_ids(file, index: dict, first: int, last: int) -> np.ndarray:
    """The ids from place `first` up to `last` of a file: whole blocks where they lie between, else from checkpoints.

    Every payload that is read must agree with its checksum.
    """
    out = []
    for entry in index["blocks"]:
        a, b = max(first, entry["first"]), min(last, entry["first"] + entry["ids"])
        if a >= b:
            continue
        file.seek(entry["at"])
        payload = file.read(entry["bytes"])
        if zlib.crc32(payload) != entry["crc"]:
            raise ValueError(f"the block at {entry['at']} is damaged")
        lanes = entry["lanes"]
        wanted, past = (a - entry["first"]) // lanes, -(-(b - entry["first"]) // lanes)
        steps = [0, *[step for step, _ in entry["points"]]]
        point = max(i for i, step in enumerate(steps) if step <= wanted)
        ids = decode_block(payload, entry, index["freq"], index["start"], index["slots"], point - 1, past - steps[point])
        skip = a - entry["first"] - steps[point] * lanes
        out.append(ids[skip : skip + b - a])
    return np.concatenate(out).astype("<u4") if out else np.zeros(0, "<u4")


def write(docs: DataFrame, tokenizer: str | None = None, file_ids: int = 4 * BLOCK_IDS) -> DataFrame:
    """Writes the ids of `docs` (doc_id, text; other columns are ignored); the manifest as a written table.

    Manifest: path, and nothing else that a reader needs: the files hold their documents' ids and sizes, and their own
    place, which is the range of doc_ids and the number of the file within it. Documents are ordered by doc_id (null first) by range partitions; rows that share a doc_id are
    ordered by a hash of their text. A null or empty text is its end id alone. A task holds one file's ids
    at a time, at most `file_ids` and one document more. An empty table writes no file.
    """
    spark = docs.sparkSession
    target = files.folder(spark, "rans")
    path_of_tokenizer = tokenizer or public_file()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("file_no"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path_of_tokenizer).encode
        end = np.array([END], "<u4").tobytes()
        held, names, size, part = [], [], 0, 0

        def flush():
            uri = files.new_name(target, ".rans")
            with files.open_new(uri) as out:
                out.write(encode_file(held, pa.chunked_array(names).to_pylist(), (number, part)))
            return pa.RecordBatch.from_arrays([pa.array([uri])], ["path"])

        # Large slices, as each distinct piece is looked up once in a slice.
        for batch, texts in slices(batches, "text", 4_000_000):
            number = batch.column(2)[0].as_py()
            first = 0
            for i, ids in enumerate(encode([t or "" for t in texts])):
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= file_ids:
                    names.append(batch.column(0).slice(first, i + 1 - first))
                    yield flush()
                    held, names, size, part, first = [], [], 0, part + 1, i + 1
            if first < len(texts):
                names.append(batch.column(0).slice(first))
        if held:
            yield flush()

    return written(rows.mapInArrow(save, "path string"), "rans-manifest")


def read(manifest: DataFrame, doc_id_type: str = "bigint", unit_blocks: int = 8) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that a manifest names.

    First the place and the number of ids and blocks are read from the end of every file. start counts the ids of all
    documents before, over all files; it is summed over the files, one row each. Then units of `unit_blocks` blocks
    are decoded by tasks of their own: a task takes the documents that begin in its blocks, and reads on, from the
    checkpoints of later blocks, where the last of them does not end there. `manifest` needs no column but path.
    """
    paths = manifest.select("path")
    count = paths.count()

    def open_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                with files.open_at(path) as file:
                    found.append((path, *read_place(file)))
            if found:
                columns = [pa.array(x, t) for x, t in zip(zip(*found), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["path", "file_no", "part", "n_ids", "blocks"])

    # Given numbers of partitions: by size alone the few rows would be one task that reads all files. Looking at the
    # end of a file takes a moment, so a task looks at 32.
    opened = paths.repartition(max(1, min(-(-count // 32), MOST_READERS))).mapInArrow(open_files, "path string, file_no int, part int, n_ids bigint, blocks int")
    opened = written(opened, "rans-places")
    # Few rows: one per file. Ranges are summed first, so one window orders ranges, not files.
    by_range = opened.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = by_range.select("file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("range_start"))
    within = Window.partitionBy("file_no").orderBy("part")
    placed = opened.join(before, "file_no").withColumn("start", F.col("range_start") + F.sum("n_ids").over(within) - F.col("n_ids"))
    firsts = F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0)), F.lit(unit_blocks))
    units = placed.select("path", "start", F.explode(firsts).alias("block"))
    tasks = opened.agg(F.coalesce(F.sum(F.ceil(F.col("blocks") / unit_blocks)), F.lit(0))).first()[0]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, block in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_at(path) as file:
                    index = read_index(file)
                    entries = index["blocks"][block : block + unit_blocks]
                    sizes = np.array(index["documents"], np.int64)
                    ends = np.cumsum(sizes)
                    begin = ends - sizes
                    mine = np.flatnonzero((begin >= entries[0]["first"]) & (begin < entries[-1]["first"] + entries[-1]["ids"]))
                    if not len(mine):
                        continue
                    first = int(begin[mine[0]])
                    ids = read_ids(file, index, first, int(ends[mine[-1]]))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin[mine] - first, ends[mine] - first)]
                names = [index["names"][i] for i in mine.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if x is None else str(x) for x in names], pa.string()), pa.array(begin[mine] + start), pa.array(sizes[mine]), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = units.repartition(max(1, min(tasks, MOST_READERS))).mapInArrow(load, "doc_id string, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumn("doc_id", F.col("doc_id").cast(doc_id_type))
