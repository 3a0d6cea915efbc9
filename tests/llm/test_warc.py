import hashlib
import random

from pyspark.sql import functions as F

from millrace.llm import files, warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, p string, size string")


def test_round_trip(spark, words):
    random.seed(1)
    htmls = [words(i, 300) for i in range(20)]
    rows = [(i, f"http://x/{i}", random.choice(htmls), "x", "y", "z") for i in range(100)]
    rows += [(200, None, None, None, None, None), (201, "u\r\nWARC-Type: no", "", None, None, None), (202, "u", "é" * 700_000, None, None, None), (203, "u", "é" * 700_000, None, None, None), (204, "u", "small", None, None, None), (205, "u", "small", None, None, None), (None, "u", htmls[0], None, None, None)]
    manifest = warc.write(pages(spark, rows), file_bytes=40_000)
    got = {r["page_id"]: r for r in warc.read(manifest).collect()}
    assert len(got) == len(rows)
    for page, _, html, *_ in rows:
        data, r = (html or "").encode(), got[page]
        newest = max((p for p, _, h, *_ in rows if p is not None and h == html), default=None) if len(data) >= 1000 and page is not None else page
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if newest == page else ("revisit", newest))
        assert r["html"] == (data.decode() if newest == page else None)


def test_each_record_is_a_frame_of_its_own(spark, words, root):
    import zstandard

    records = [warc.record(i, None, words(i % 7, 200).encode(), None) for i in range(400)]
    data = warc.encode_file(records)
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    with files.open_new(f"file://{root}/x.warc.zst") as out:
        out.write(data)
    with files.open_at(f"file://{root}/x.warc.zst") as file:
        assert list(warc.records_of(file)) == records
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    second = reader.decompressobj()
    first = reader.decompressobj()
    assert first.decompress(data[8 + size :]) == records[0]
    assert second.decompress(first.unused_data) == records[1]
    assert len(data) < sum(map(len, records)) / 2


def test_repeated_rows_and_empty_table(spark, words):
    row = (1, "u", words(1, 300), "a", "b", "c")
    got = warc.archived(pages(spark, [row, row])).collect()
    assert [r["record_type"] for r in got] == ["response", "response"]
    assert warc.archived(pages(spark, [])).count() == 0


def test_archives_are_read_by_many_tasks(spark, words):
    rows = [(i, "u", words(i, 2000), None, None, None) for i in range(60)]
    manifest = warc.write(pages(spark, rows).repartition(4), file_bytes=20_000)
    files_written = manifest.count()
    assert files_written >= 8
    tasks = warc.read(manifest).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= files_written / 2  # with adaptive execution on
    assert sum(r["count"] for r in tasks) == 60
