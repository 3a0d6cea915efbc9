import itertools

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import language_id as L

SF = "/root/testdata/sf0.01"


def path_value(scores, path, penalty):
    return sum(scores[i][p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


def test_best_path_against_all_paths():
    random = np.random.default_rng(1)
    for _ in range(150):
        n, width, penalty = random.integers(1, 7), random.integers(1, 4), random.uniform(0, 4)
        scores = random.normal(0, 2, (n, width))
        best = max(path_value(scores, p, penalty) for p in itertools.product(range(width), repeat=n))
        assert np.isclose(path_value(scores, L.best_path(scores, penalty), penalty), best)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.fold_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("hit"), "score").collect()
    assert len(got) > 200 and sum(r["hit"] for r in got) / len(got) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_spans_scripts_and_odd_texts(spark, documents):
    english, russian = "the house and the garden of the old man", "дом и сад старого человека у реки"
    train = spark.createDataFrame([(english, "en"), (russian, "ru"), (None, "en"), ("x", None)] * 5, "text string, lang string")
    model = L.fit(train)
    assert model.languages == ["en", "ru"]
    mixed = english + ". " + russian
    rows = [(1, english), (2, russian), (3, mixed), (4, None), (5, ""), (6, "123 !?"), (7, "漢字"), (8, (english + " ") * 20_000), (1, english)]
    got = L.predict(documents(rows), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 9
    assert [by[i]["lang_pred"] for i in (1, 2, 4, 5, 6, 8)] == ["en", "ru", "und", "und", "und", "en"]
    assert [s["lang"] for s in by[3]["spans"]] == ["en", "ru"]
    assert mixed[by[3]["spans"][1]["start"] : by[3]["spans"][1]["end"]] == russian
    assert by[7]["lang_pred"] in ("en", "ru") and by[4]["score"] == 0
    assert L.predict(documents([]), model).count() == 0
    kept = L.keep_labelled(documents(rows), model)
    assert kept.columns == documents(rows).columns and kept.count() == 6


def test_nothing_to_learn_from(spark, documents):
    model = L.fit(spark.createDataFrame([], "text string, lang string"))
    assert [r["lang_pred"] for r in L.predict(documents([(1, "word")]), model).collect()] == ["und"]


def test_scripts_that_no_label_has(spark, documents):
    english = "the house and the garden of the old man"
    model = L.fit(spark.createDataFrame([(english, "en")] * 5, "text string, lang string"))
    rows = [(1, english), (2, "漢字"), (3, "дом и сад " + english), (4, english[:9] + " дом и сад старого человека"), (5, "12 !"), (6, None)]
    assert sorted(r["doc_id"] for r in L.keep_labelled(documents(rows), model, least_known=0.5).collect()) == [1, 3]
    nothing = L.fit(spark.createDataFrame([(english, None)], "text string, lang string"))
    assert L.keep_labelled(documents(rows), nothing, least_known=0.5).count() == 6


def test_copies_do_not_crowd_out_other_texts(spark, words):
    copy, other = "hot " * 30, [words(i, 20) for i in range(40)]
    expected = L.fit(spark.createDataFrame([(t, "en") for t in [copy, *other]] + [("дом и сад", "ru")], "text string, lang string"))
    for sample in (2000, 41):
        model = L.fit(spark.createDataFrame([(copy, "en")] * 4000 + [(t, "en") for t in other * 2] + [("дом и сад", "ru")] * 9, "text string, lang string").repartition(4), sample_per_language=sample)
        assert all((x == y).all() for x, y in zip(model.scores, expected.scores)) and (model.scripts == expected.scripts).all()
