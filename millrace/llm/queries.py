"""The registered queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from millrace.llm import (
    decontaminate, fill_middle, hard_negatives, html_text, language_id, line_dedup, near_dedup, neighbours, packing, rans,
    sentence_pieces, suffix_dedup, warc,
)
from millrace.llm.batches import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated runs of two lines or repeated lines of 50 words."""
    return line_dedup.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.fold_predictions(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates, named by its smallest doc_id."""
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes under 100-byte strings that start earlier."""
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as read back from the archives that were written of all pages."""
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a benchmark item and a document that holds at least 0.8 of its shingles."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every row whose vec_id is divisible by 100."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files that were written of all texts."""
    docs = table(spark, sf_dir, "documents")
    return rans.read(rans.write(docs), docs.schema["doc_id"].dataType.simpleString())


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a fill-in-middle string and as restored from it, by digests."""
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids and the text decoded from them, by digests."""
    return sentence_pieces.digests(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100; every seventh row's label is moved on first."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_text": op2_html_text,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_neighbours": op8_neighbours,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_fill_middle": op11_fill_middle,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_line_dedup": """
        WITH numbered AS (
            SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS nr
            FROM documents WHERE text IS NOT NULL),
        full_lines AS (
            SELECT doc_id, nr, md5(trim(line, ' ')) AS h,
                   len(string_split(trim(line, ' '), ' ')) >= 50 AS long,
                   lead(md5(trim(line, ' '))) OVER (PARTITION BY doc_id ORDER BY nr) AS next_h,
                   lead(nr) OVER (PARTITION BY doc_id ORDER BY nr) AS next_at
            FROM numbered WHERE trim(line, ' ') <> ''),
        runs AS (
            SELECT doc_id, nr, next_at AS last, h || next_h AS run FROM full_lines WHERE next_h IS NOT NULL
            UNION ALL SELECT doc_id, nr, nr, h FROM full_lines WHERE long),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, nr) AS nth FROM runs),
        gone AS (
            SELECT doc_id, nr FROM ranked WHERE nth > 1 UNION SELECT doc_id, last FROM ranked WHERE nth > 1),
        texts AS (
            SELECT n.doc_id, count(g.nr) AS n_removed, count(*) FILTER (WHERE trim(line, ' ') <> '') AS n_lines,
                   coalesce(string_agg(line, chr(10) ORDER BY n.nr) FILTER (WHERE g.nr IS NULL), '') AS text
            FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.nr = g.nr GROUP BY n.doc_id)
        SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines,
               CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, t.text AS text
        FROM documents d LEFT JOIN texts t USING (doc_id)
    """,
    "op7_decontaminate": """
        WITH texts AS (
            SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
        split_words AS (
            SELECT kind, id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
            FROM texts WHERE text IS NOT NULL),
        words AS (SELECT kind, id, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) AS nr FROM split_words),
        shingles AS (
            SELECT kind, id, w || coalesce(' ' || lead(w, 1) OVER o, '') || coalesce(' ' || lead(w, 2) OVER o, '')
                   || coalesce(' ' || lead(w, 3) OVER o, '') || coalesce(' ' || lead(w, 4) OVER o, '') AS s, nr, n
            FROM words WINDOW o AS (PARTITION BY kind, id ORDER BY nr)),
        sets AS (SELECT DISTINCT kind, id, s FROM shingles WHERE nr <= greatest(n - 4, 1)),
        sizes AS (SELECT id, count(*) AS n FROM sets WHERE kind = 1 GROUP BY id),
        shared AS (
            SELECT i.id AS item_id, d.id AS doc_id, count(*) AS k
            FROM sets i JOIN sets d ON i.s = d.s AND i.kind = 1 AND d.kind = 0 GROUP BY i.id, d.id)
        SELECT item_id, doc_id, CAST(n AS INTEGER) AS n_shingles, CAST(k AS INTEGER) AS n_shared,
               CAST(k AS DOUBLE) / n AS containment
        FROM shared JOIN sizes ON item_id = id WHERE k >= n * 0.8
    """,
    "op4_near_dedup": """
        WITH RECURSIVE split_words AS (
            SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
            FROM documents WHERE text IS NOT NULL),
        words AS (SELECT doc_id, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) AS nr FROM split_words),
        shingles AS (
            SELECT doc_id, w || coalesce(' ' || lead(w, 1) OVER o, '') || coalesce(' ' || lead(w, 2) OVER o, '')
                   || coalesce(' ' || lead(w, 3) OVER o, '') || coalesce(' ' || lead(w, 4) OVER o, '') AS s, nr, n
            FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY nr)),
        bags AS (SELECT doc_id, s, count(*) AS k FROM shingles WHERE nr <= greatest(n - 4, 1) GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(k) AS n FROM bags GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.k, y.k)) AS k
            FROM bags x JOIN bags y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE k >= (x.n + y.n - k) * 0.8
            UNION SELECT x.doc_id, y.doc_id FROM documents x JOIN documents y ON x.text = y.text AND x.doc_id <> y.doc_id),
        reach AS (
            SELECT a, b FROM links
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT doc_id, coalesce(least(min(b), doc_id), doc_id) AS class_id
        FROM documents LEFT JOIN reach ON doc_id = a GROUP BY doc_id
    """,
    "op11_fill_middle": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units
            FROM documents),
        ranks AS (
            SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y, CAST('0x' || h[25:32] AS BIGINT) % 100 AS kind
            FROM drawn),
        parts AS (
            SELECT *, array_to_string(units[1:least(x, y)], '') AS head,
                   array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
                   array_to_string(units[greatest(x, y) + 1:], '') AS tail,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                        WHEN kind < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM ranks)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(head) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || middle
                      ELSE '<P>' || head || '<S>' || tail || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
    "op13_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
