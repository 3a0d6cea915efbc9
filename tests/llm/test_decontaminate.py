import random

from millrace.llm import decontaminate as D


def shingles(text, k=5):
    import re

    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, items, least=0.8):
    out = {}
    for item, text in items:
        want = shingles(text)
        for doc, body in docs:
            shared = len(want & shingles(body))
            if want and shared >= least * len(want):
                key = (item, doc)
                out[key] = max(out.get(key, (0, 0)), (len(want), shared))
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "'x' as d", "'y' as h", "'z' as bits")


def found(df):
    return {(r["item_id"], r["doc_id"]): (r["n_shingles"], r["n_shared"]) for r in df.collect()}


def test_against_brute_force(spark, documents, words):
    random.seed(1)
    items = [(i, words(i, random.choice([3, 5, 8, 20, 40]))) for i in range(30)] + [(30, None), (31, ""), (32, "!!")]
    docs = []
    for i in range(60):
        parts = [words(1000 + i, random.randint(0, 600))]
        if i % 2:
            w = random.choice(items[:30])[1].split()
            if random.random() < 0.6:
                w[random.randrange(len(w))] = "changed"
            parts += [" ".join(w).upper(), words(5000 + i, 30)]
        docs.append((i, "\n".join(parts)))
    docs += [(60, None), (61, ""), (62, items[0][1]), (63, words(77, 20_000) + " " + items[29][1]), (None, items[28][1])]
    assert found(D.find_items(documents(docs), items_of(spark, items))) == brute(docs, items)


def test_item_in_very_many_documents(spark, documents, words):
    docs = [(i, f"{words(i, 30)} {words(9999, 40)} {words(i + 500, 30)}") for i in range(400)]
    got = found(D.find_items(documents(docs), items_of(spark, [(7, words(9999, 40))])))
    assert set(got) == {(7, i) for i in range(400)}


def test_kept_rows_repeats_and_empty_tables(spark, documents, words):
    items = items_of(spark, [(1, words(1, 30)), (1, words(2, 30))])
    df = documents([(1, words(1, 30)), (1, words(3, 30)), (2, words(4, 30)), (None, words(5, 30)), (3, None)])
    kept = D.without_items(df, items)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "None"]
    assert D.find_items(documents([]), items).count() == 0
    assert D.without_items(df, items.limit(0)).count() == 5
    assert "MapInArrow" not in D.find_items(df, items)._jdf.queryExecution().toString()


def test_documents_are_scanned_once_for_candidates(spark, documents, words, monkeypatch):
    plans = []
    plain = D.written
    monkeypatch.setattr(D, "written", lambda df, label: (plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())), plain(df, label))[1])
    docs = documents([(i, words(i, 60)) for i in range(20)])
    D.find_items(docs, items_of(spark, [(1, words(3, 8)), (2, words(4, 40))])).count()
    plan = dict(plans)["candidates"]
    assert plan.count("doc_id") > 0 and plan.count("Generate") == 1 and "Union" not in plan
