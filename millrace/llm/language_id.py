"""Language of documents: script ranges narrow the candidates, Viterbi labels spans of words.

A model holds, for every language that was learned, the log-likelihood ratio of letter pairs and
triples (hashed into a fixed number of buckets) and the scripts its letters come from. A word's
scores are the sums over its letters. The best path over a document's words pays a penalty for
each change of language, so that a span changes only where the evidence outweighs it. A document's
language is the one whose spans hold most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.batches import slices

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (2, 3)

# First and last code points of the scripts that tell languages apart.
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
    ("latin", 0xFF21, 0xFF5A), ("han", 0x20000, 0x2FA1F),
]
SCRIPTS = list(dict.fromkeys(["other", *(name for name, _, _ in SCRIPT_RANGES)]))


@dataclass(frozen=True)
class Model:
    """`scores[order][bucket, language]` and `scripts[script, language]` (true: a candidate)."""

    languages: list[str]
    scores: list[np.ndarray]
    scripts: np.ndarray
    penalty: float


@lru_cache(maxsize=1)
def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter, and which script."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    for name, first, last in SCRIPT_RANGES:
        script[first : last + 1] = SCRIPTS.index(name)
    return letter, script


def _codes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, each text after a blank, and where each starts."""
    lowered = [" " + (t or "").lower() for t in texts]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=starts[1:])
    joined = "".join(lowered) + " "
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), starts


def _grams(codes: np.ndarray, letter: np.ndarray) -> list[np.ndarray]:
    """Bucket of the pair and of the triple that end at each place; anything but letters counts as one blank."""
    c = np.where(letter, codes, 32)
    back = np.concatenate(([32], c[:-1]))
    back2 = np.concatenate(([32], back[:-1]))
    pair = (back * 0x9E3779B1 + c * 0x85EBCA77) & 0xFFFFFFFFFFFF
    triple = (pair * 31 + back2 * 0xC2B2AE3D) & 0xFFFFFFFFFFFF
    return [((x >> 15) ^ x) & (BUCKETS - 1) for x in (pair, triple)]


def fit(docs: DataFrame, penalty: float = 12.0, sample_per_language: int = 2000, least_script_share: float = 0.01) -> Model:
    """A model from columns text and lang of `docs`; rows with a null in either teach nothing.

    Learned on a bounded sample of distinct texts: of each language, those whose hash falls below the
    share that leaves about `sample_per_language` texts, each counted once however many rows have it.
    What comes to the driver is at most buckets x orders rows per language, so it does not grow with
    the documents. A script is a candidate of a language when at least `least_script_share` of its
    letters in the sample are of that script. Without any labelled row the model has no languages.
    """
    rows = docs.select("text", "lang", F.xxhash64("text").alias("hash")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    texts_of = rows.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in texts_of.collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], [], np.zeros((len(SCRIPTS), 0), bool), penalty)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_per_language / sizes[lang]))])
    draw = (F.col("hash").bitwiseAND(F.lit(0xFFFFFF))).cast("double") / F.lit(float(1 << 24))
    drawn = rows.where(draw < share[F.col("lang")])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies go where they are read, so that a text with very many is one row a task in the shuffle.
        seen = set()
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            new = []
            for key in keys:
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    sample = drawn.mapInArrow(once, drawn.schema).dropDuplicates(["lang", "hash"]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, script_of = _code_points()
        index = {lang: i for i, lang in enumerate(languages)}
        sums = np.zeros((len(languages), len(ORDERS) * BUCKETS + len(SCRIPTS)), np.int64)
        for batch, texts in slices(batches, "text", 500_000):
            codes, starts = _codes(texts)
            letter = letters[codes]
            used = letter | np.concatenate(([False], letter[:-1]))
            grams = _grams(codes, letter)
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for i, lang in enumerate(langs):
                part = slice(starts[i], starts[i + 1])
                mine = used[part]
                row = sums[index[lang]]
                for k, gram in enumerate(grams):
                    row[k * BUCKETS : (k + 1) * BUCKETS] += np.bincount(gram[part][mine], minlength=BUCKETS)
                row[len(ORDERS) * BUCKETS :] += np.bincount(script_of[codes[part][letter[part]]], minlength=len(SCRIPTS))
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(sums[lang, bucket], pa.int64())], ["l", "b", "n"])

    counted = sample.mapInArrow(count, "l int, b int, n bigint").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros((len(languages), len(ORDERS) * BUCKETS + len(SCRIPTS)))
    sums[counted["l"], counted["b"]] = counted["n"]
    scores = []
    for k in range(len(ORDERS)):
        part = sums[:, k * BUCKETS : (k + 1) * BUCKETS]
        likely = np.log((part + 0.5) / (part.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
        scores.append(np.ascontiguousarray((likely - likely.mean(axis=0)).T.astype(np.float32)))
    script = sums[:, len(ORDERS) * BUCKETS :]
    allowed = (script / np.maximum(script.sum(axis=1, keepdims=True), 1) >= least_script_share).T
    return Model(languages, scores, allowed, penalty)


def word_scores(texts: list, model: Model):
    """Of all words of all texts: text number, first and end offset in its text, letters, scores by language."""
    letters, script_of = _code_points()
    codes, starts = _codes(texts)
    letter = letters[codes]
    before = np.concatenate(([False], letter[:-1]))
    first = np.flatnonzero(letter & ~before)
    last = np.flatnonzero(~letter & before)
    if not len(first):
        return np.zeros(0, int), first, last, last - first, np.zeros((0, len(model.languages)))
    each = sum(table[gram] for table, gram in zip(model.scores, _grams(codes, letter)))
    each[~(letter | before)] = 0
    scores = np.add.reduceat(each, first, axis=0).astype(np.float64)
    allowed = model.scripts[script_of[codes[first]]]
    some = allowed.any(axis=1, keepdims=True)
    scores = np.where(some, np.where(allowed, scores, -1000.0), 0.0)
    text = np.searchsorted(starts, first, side="right") - 1
    return text, first - starts[text] - 1, last - starts[text] - 1, last - first, scores


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The labels of the words that maximise summed scores minus `penalty` for each change (ties: the lower label).

    One label throughout is best whenever no stretch of words gains more than a change costs by leaving
    the label with the largest total; that is looked at first, in whole arrays.
    """
    label = int(scores.sum(axis=0).argmax())
    n, width = scores.shape
    if width == 1 or n == 1:
        return np.full(n, label)
    others = np.delete(scores, label, axis=1).max(axis=1) - scores[:, label]
    run = np.concatenate(([0.0], np.cumsum(others)))
    if (run - np.minimum.accumulate(run)).max() <= penalty:
        return np.full(n, label)
    value = scores[0].tolist()
    steps = []
    for row in scores[1:].tolist():
        top = max(value)
        origin = value.index(top)
        floor = top - penalty
        step = [k if v >= floor else origin for k, v in enumerate(value)]
        steps.append(step)
        value = [(v if v >= floor else floor) + s for v, s in zip(value, row)]
    state = value.index(max(value))
    path = [state]
    for step in reversed(steps):
        state = step[state]
        path.append(state)
    return np.array(path[::-1])


def label_texts(texts: list, model: Model) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text.

    The score is the share of letters in spans of that language times the mean probability of those
    spans, 0 to 1. Null texts and texts without a letter are `und` with score 0 and no spans, as is
    every text if the model knows no language. Ties go to the language that sorts first.
    """
    found: list[tuple[str, float, list[dict]]] = [(UNDETERMINED, 0.0, []) for _ in texts]
    if not model.languages:
        return found
    text, first, last, letters, scores = word_scores(texts, model)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        a, b = edges[i], edges[i + 1]
        if a == b:
            continue
        path = best_path(scores[a:b], model.penalty)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [b - a]))
        held = np.zeros(len(model.languages))
        sure = np.zeros(len(model.languages))
        spans = []
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            label, size = int(path[x]), int(letters[a + x : a + y].sum())
            total = scores[a + x : a + y].sum(axis=0)
            total = np.exp(np.clip(total - total.max(), -50, 0))
            held[label] += size
            sure[label] += size * total[label] / total.sum()
            spans.append({"start": int(first[a + x]), "end": int(last[a + y - 1]), "lang": model.languages[label]})
        best = int(held.argmax())
        found[i] = (model.languages[best], float(sure[best] / held.sum()), spans)
    return found


def predict(docs: DataFrame, model: Model, keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """Columns `keep` of every row of `docs` with lang_pred, score and spans (start, end, lang; code points).

    One pass without a shuffle. Offsets count code points of the lower-cased text. Repeated rows are
    labelled alike, one by one; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    spans = "array<struct<start:int,end:int,lang:string>>"
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__text", 500_000):
            found = label_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], kinds)],
                [*keep, "lang_pred", "score", "spans"],
            )

    out = schema.add("lang_pred", "string").add("score", "double")
    from pyspark.sql.types import _parse_datatype_string

    return rows.mapInArrow(label, out.add("spans", _parse_datatype_string(spans)))


def known_shares(texts: list, model: Model) -> np.ndarray:
    """Of each text, the share of its letters whose script is a candidate of any language; 1 without a letter."""
    letters, script_of = _code_points()
    codes, starts = _codes(texts)
    letter = letters[codes]
    known = letter & model.scripts.any(axis=1)[script_of[codes]]
    count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[starts])
    return np.where(count(letter) > 0, count(known) / np.maximum(count(letter), 1), 1.0)


def keep_labelled(docs: DataFrame, model: Model, least_score: float = 0.0, least_known: float = 0.0) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text gets a language with at least `least_score`.

    At least `least_known` of a text's letters must be of scripts that a learned language has. Where nothing
    was learned, there is no label to go by, and all rows stay.
    """
    if not model.scripts.any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", 500_000):
            found = label_texts(texts, shared.value)
            known = known_shares(texts, shared.value) if least_known > 0 else np.ones(len(texts))
            yield batch.filter(pa.array([x[0] != UNDETERMINED and x[1] >= least_score and k >= least_known for x, k in zip(found, known)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def is_held_out(doc_id: Column) -> Column:
    """Rows that must not teach: crc32 of the id as text leaves 2 when divided by 4 (a null id teaches)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fold_predictions(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    model = fit(docs.where(~is_held_out(F.col("doc_id"))), **options)
    return predict(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
