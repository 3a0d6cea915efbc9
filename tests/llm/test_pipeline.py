"""The pipeline against a run of every stage by hand, on a small corpus."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import shingles
from test_line_dedup import brute as without_lines
from test_near_dedup import brute as near_classes
from tokenizers import Tokenizer

import corpus_pipeline as C
from millrace.llm.tokens import public_file
from millrace.session import fresh_path

# Names that operators use inside.
CLASHES = ["d", "h", "n", "s", "id", "at", "key", "band", "keys", "gone", "__gone", "n_lines", "data", "t", "group", "part", "unit", "lonely", "hub"]

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark):
    """(folder, rows): prose of two languages with copies, repeated lines, junk and benchmark items."""
    random.seed(6)
    stems = {"en": "the and of to house garden water people under morning", "de": "der und ich nicht haus garten wasser leute unter morgen"}

    def line(lang, n):
        words = stems[lang].split()
        return " ".join(random.choice(words) + random.choice(["", "s", "en", "er", "ly"][: 3 if lang == "de" else 5]) for _ in range(n))

    items = [(i, line("en", 30)) for i in range(4)]
    rows = []
    for i in range(90):
        lang = random.choice(["en", "de"])
        rows.append([i, "\n".join(line(lang, random.randint(8, 70)) for _ in range(random.randint(2, 6))), lang])
    shared = [line("en", 9), line("en", 8), line("en", 60)]
    for i in range(0, 90, 9):
        rows[i][1] += "\n" + "\n".join(shared)
    for i in range(1, 90, 15):
        rows[i][1] += " " + items[i % 4][1]
    for i in range(20, 26):
        w = rows[2][1].split(" ")
        w[random.randrange(len(w))] = "changed"
        rows[i] = [i, " ".join(w), rows[2][2]]
    rows += [[90, None, "en"], [91, "", "en"], [92, "12345 !!", "de"], [93, rows[5][1], rows[5][2]], [94, rows[6][1] + "\n\n", rows[6][2]]]
    base = line("en", 200).split(" ")
    for i in range(95, 98):
        rows.append([i, " ".join([*base[: i - 40], "changed", *base[i - 40 :]]), "en"])
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    folder = fresh_path(spark, "corpus")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def by_hand(rows, items):
    """What each of the first four stages should keep: {doc_id: text}."""
    kept = {d: t for d, t, *_ in rows if t and re.search(r"[^\W\d_]", t)}
    yield dict(kept)
    cut = without_lines(list(kept.items()))
    kept = {d: t for d, t in cut.items() if t == kept[d] or re.search(r"\S", t)}
    yield dict(kept)
    classes = near_classes(list(kept.items()))
    kept = {d: t for d, t in kept.items() if classes[d] == d}
    yield dict(kept)
    wanted = [shingles(t) for _, t in items]
    kept = {d: t for d, t in kept.items() if not any(len(w & shingles(t)) >= 0.8 * len(w) for w in wanted)}
    yield dict(kept)


def test_stages(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for (name, stage), want in zip(C.STAGES, by_hand(rows, items)):
        path = fresh_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert got == want, name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        sizes.append(len(got))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 5


def test_run(spark, corpus):
    folder, rows, items = corpus
    *_, want = by_hand(rows, items)
    library = Tokenizer.from_file(public_file())
    pieces = {}
    for r in C.run(spark, folder).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(want)
    for doc, text in want.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_empty_table(spark, corpus):
    folder, _, items = corpus
    empty = fresh_path(spark, "empty")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert C.run(spark, empty).count() == 0


def test_language_stage_goes_by_labels(spark, corpus):
    folder, rows, _ = corpus
    docs = spark.createDataFrame([*rows, (200, "漢字 " * 40, None, "s", 120)], COLUMNS)
    kept = {r["doc_id"] for r in C.identify_language(spark, docs, folder).collect()}
    assert 200 not in kept and kept == set(next(by_hand(rows, [])))
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert C.identify_language(spark, unlabelled, folder).count() == len(rows) + 1


def test_stages_with_null_and_repeated_ids_and_clashing_columns(spark, words):
    """Each stage alone, on rows that no table should have, with columns called like names that operators use."""
    a, b = words(1, 30), words(2, 40)
    rows = [(1, a), (1, a), (None, a), (2, b), (None, None), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    for name in CLASHES:
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit("x"))
    folder = fresh_path(spark, "odd")
    spark.createDataFrame([(1, b)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wanted = {
        "language_id": [(1, a), (1, a), (2, b), (None, a)],
        "line_dedup": rows,
        "near_dedup": rows,  # copies under one id are one document, and a null id is none
        "decontaminate": [r for r in rows if r[1] != b],
    }
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(wanted[name], key=str), name
        assert {r["s"] for r in out.collect()} == {"x"}
    pieces = C.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted((r["doc_id"] for r in pieces), key=str) == sorted((i for i, _ in rows), key=str)
