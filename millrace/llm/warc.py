"""WARC archives whose records are Zstandard frames that share a dictionary, and the way back.

Each file starts with a skippable frame (magic 0x184D2A5D) that holds a dictionary built from the file's
own records; after it every record is a frame of its own that needs only that dictionary, so one record
can be read without the others. Payloads of at least `least_bytes` that occur more than once are stored
once: the record with the largest page_id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import files
from millrace.llm.batches import slices
from millrace.session import written

SKIPPABLE = 0x184D2A5D.to_bytes(4, "little")  # fixed value: the frame that holds a dictionary
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(" " if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response record, or a revisit record (headers only) if `refers_to` is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if refers_to is not None else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page/{page_id}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{refers_to}')}>", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (empty for a revisit) of one record; an error if a length does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not hold")
    return headers, rest[:size].partition(b"\r\n\r\n")[2]


def train(records: list[bytes], dictionary_bytes: int, sample_bytes: int):
    """A dictionary from the first records that fill the sample, or None where they are too few to train on."""
    import zstandard

    sample, size = [], 0
    for data in records:
        sample.append(data[:65536])
        size += len(sample[-1])
        if size >= sample_bytes:
            break
    try:
        return zstandard.train_dictionary(dictionary_bytes, sample, k=512, d=8)
    except zstandard.ZstdError:
        return None


def encode_file(records: list[bytes], dictionary_bytes: int = 32_768, sample_bytes: int = 2_000_000, level: int = 3) -> bytes:
    """A file: the dictionary's skippable frame (compressed; empty if none could be built), then a frame per record."""
    import zstandard

    trained = train(records, dictionary_bytes, sample_bytes)
    shown = zstandard.ZstdCompressor().compress(trained.as_bytes()) if trained else b""
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True) if trained else zstandard.ZstdCompressor(level=level, write_checksum=True)
    return b"".join([SKIPPABLE, len(shown).to_bytes(4, "little"), shown, *(packer.compress(r) for r in records)])


def records_of(file) -> Iterator[bytes]:
    """The records of an open file, one at a time."""
    import zstandard

    if file.read(4) != SKIPPABLE:
        raise ValueError("no dictionary frame")
    shown = file.read(int.from_bytes(file.read(4), "little"))
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(shown)) if shown else None
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    rest = b""
    while True:
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            if not rest:
                rest = file.read(1 << 20)
                if not rest:
                    if out or frame.unconsumed_tail:
                        raise ValueError("the last record is cut off")
                    return
            out.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(out)


MOST_READERS = 10_000  # tasks of one read


def write(pages: DataFrame, least_bytes: int = 1000, file_bytes: int = 16_000_000) -> DataFrame:
    """Archives `pages` (page_id, url, html; other columns are ignored); the manifest (path, records) as a written table.

    A null or empty html is an empty payload. Copies of one payload are found by its SHA-1 and length in
    a fold per payload; then every page looks up its own page_id, so a payload with very many copies is
    not one group anywhere. Rows that repeat a page_id and its payload are all written alike. A page with
    a null page_id is always a response. An empty table writes no file.
    """
    target = files.folder(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    large = rows.select(F.col("page_id").alias("p"), F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").alias("size"))
    large = written(large.where((F.col("size") >= least_bytes) & F.col("p").isNotNull()), "payloads")
    newest = large.groupBy("digest", "size").agg(F.max("p").alias("newest"), F.min("p").alias("oldest")).where("newest <> oldest")
    revisits = large.join(newest, ["digest", "size"]).where("p <> newest")
    # A page_id may stand for several payloads: the digest decides then.
    revisits = written(revisits.select("p", "digest", "newest").distinct(), "revisits")
    digest = F.when(F.octet_length("html") >= least_bytes, F.sha1(F.encode("html", "UTF-8")))
    rows = rows.withColumn("__digest", digest)
    rows = rows.join(revisits.withColumnRenamed("digest", "__its"), (F.col("page_id") == F.col("p")) & (F.col("__digest") == F.col("__its")), "left")
    rows = rows.select("page_id", "url", "html", F.col("newest").alias("refers_to"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            uri = files.new_name(target, ".warc.zst")
            with files.open_new(uri) as out:
                out.write(encode_file(held))
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(held)], pa.int64())], ["path", "records"])

        for batch, pages_html in slices(batches, "html"):
            for page, url, html, to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pages_html, batch.column(3).to_pylist()):
                held.append(record(page, url, html.encode("utf-8", "surrogatepass"), to))
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return written(rows.mapInArrow(save, "path string, records bigint"), "warc-manifest")


def read(manifest: DataFrame, page_id_type: str = "bigint") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, html of every record in the manifest's files.

    html is null for a revisit. The digest of a response is that of the bytes that were read; the one in
    its header must agree.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path, count in zip(*(c.to_pylist() for c in batch.columns)):
                rows, seen, size = [], 0, 0
                with files.open_at(path) as file:
                    for data in records_of(file):
                        headers, payload = parse(data)
                        digest = base64.b32decode(headers["WARC-Payload-Digest"].partition(":")[2]).hex()
                        first = headers["WARC-Type"] == "response"
                        if first and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(headers["X-Payload-Length"])):
                            raise ValueError(f"a payload in {path} is damaged")
                        page, to = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page")
                        rows.append((page, headers.get("WARC-Target-URI"), int(headers["X-Payload-Length"]), digest, headers["WARC-Type"], to, payload.decode("utf-8", "surrogatepass") if first else None))
                        seen += 1
                        size += len(payload)
                        if size > 4_000_000 or len(rows) >= 5000:
                            yield out(rows)
                            rows, size = [], 0
                if rows:
                    yield out(rows)
                if seen != count:
                    raise ValueError(f"{path} has {seen} of {count} records")

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    # A given number of partitions: by size alone the few rows of a manifest would be one task that reads all files.
    rows = manifest.select("path", "records").repartition(max(1, min(manifest.count(), MOST_READERS)))
    text = rows.mapInArrow(load, "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, html string")
    return text.withColumn("page_id", F.col("page_id").cast(page_id_type)).withColumn("refers_to", F.col("refers_to").cast(page_id_type))


def archived(pages: DataFrame) -> DataFrame:
    """What the archives of `pages` hold when they are read back, one row per page, without the payloads."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return read(write(pages), kind).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
