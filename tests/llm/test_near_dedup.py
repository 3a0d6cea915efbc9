import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import near_dedup as N
from millrace.llm.components import components


def bag(text, k=5):
    import re

    w = re.findall(r"[^\W_]+", text.lower())
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def similarity(x, y):
    both = sum((x & y).values())
    either = sum((x | y).values())
    return both / either if either else 0.0


def brute(docs, least=0.8):
    docs = [d for d in docs if d[0] is not None]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(d, t, bag(t)) for d, t in docs if t is not None]
    for i, (a, s, x) in enumerate(bags):
        for b, t, y in bags[:i]:
            if s == t or similarity(x, y) >= least:
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {d: root(d) for d, _ in docs}


def test_signature_estimates_weighted_jaccard(words):
    random.seed(1)
    pool = [words(i, 5) for i in range(60)]
    estimates, exact = [], []
    for _ in range(40):
        a = ". ".join(random.choice(pool) for _ in range(30))
        b = a + ". " + ". ".join(random.choice(pool) for _ in range(random.randint(1, 40)))
        h, w, o = N.bags([a, b])
        s = N.signatures(h, w, o, 512)
        estimates.append(float((s[0] == s[1]).mean()))
        exact.append(similarity(bag(a), bag(b)))
    assert abs(np.mean(estimates) - np.mean(exact)) < 0.02
    assert max(abs(x - y) for x, y in zip(estimates, exact)) < 0.1


def test_signature_does_not_depend_on_company(words):
    texts = [words(1, 3), words(2, 400), "", "to " * 5000, words(3, 5)]
    h, w, o = N.bags(texts)
    together = N.signatures(h, w, o)
    for i, t in enumerate(texts):
        assert (N.signatures(*N.bags([t]))[0] == together[i]).all()


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 7, "block_shingles": 900}])
def test_classes_against_brute_force(documents, words, monkeypatch, blocks):
    links = N.links
    monkeypatch.setattr(N, "links", lambda docs, least: links(docs, least, **blocks))
    random.seed(3)
    docs = []
    for family in range(6):
        base = words(family, 80).split()
        for _ in range(25):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 3, 4, 5])):
                copy[random.randrange(len(copy))] = words(random.randrange(10**6), 1)
            docs.append((len(docs), " ".join(copy)))
    docs += [(len(docs) + i, t) for i, t in enumerate([None, None, "", "", "one two", "one two", "one  Two!", "a " * 30_000, "a " * 29_000])]
    random.shuffle(docs)
    got = {r["doc_id"]: r["class_id"] for r in N.classes(documents(docs)).collect()}
    assert got == brute(docs)


def test_kept_rows_repeats_and_null_ids(documents, words):
    text = words(5, 50)
    df = documents([(3, text), (1, text), (3, text), (None, text), (4, words(6, 50))])
    assert sorted(str(r["doc_id"]) for r in N.one_per_class(df).collect()) == ["1", "4", "None"]
    assert N.one_per_class(df).columns == df.columns
    assert N.classes(documents([])).count() == 0


def test_components_of_long_chains_and_stars(spark):
    random.seed(8)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3)]
    edges = [e if random.random() < 0.5 else e[::-1] for e in edges]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}}
