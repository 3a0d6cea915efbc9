import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffix_dedup as S
from millrace.llm.suffix_array import permuted_prefixes, suffix_array


def brute(docs, length):
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        spans = int(((gone[:-1]) & ~np.concatenate(([False], gone[:-2])) if len(data) else np.zeros(0, bool)).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("depth", [None, 7])
def test_suffix_array(depth):
    random.seed(3)
    for _ in range(200):
        k = random.choice([1, 2, 3, 40])
        text = [random.randint(1, k) for _ in range(random.randint(0, 60))] + [0]
        order = suffix_array(np.array(text), k + 1, depth)
        cut = depth or len(text)
        assert [text[i : i + cut] for i in order] == sorted(text[i : i + cut] for i in range(len(text)))
        shared = permuted_prefixes(np.array(text), order, 7)
        for x, y in zip(order, order[1:]):
            want = next((c for c in range(7) if text[x + c : x + c + 1] != text[y + c : y + c + 1] or x + c >= len(text)), 7)
            assert shared[y] == want


def test_every_string_is_filed_once():
    random.seed(5)
    for _ in range(100):
        k, (length, gram) = random.choice([1, 2, 3, 50]), random.choice([(20, 8), (100, 32), (10, 3), (9, 8)])
        data = np.array([random.randint(65, 64 + k) for _ in range(random.randint(0, 300))], np.uint8)
        starts = [s for _, p, a, b in zip(*S.contexts(data, length, gram)) for s in range(a, b + 1) if s <= p <= s + length - gram]
        assert sorted(starts) == list(range(max(0, len(data) - length + 1)))


@pytest.mark.parametrize("hot, shard", [(100_000, 4_000_000), (3, 500)])
def test_against_brute_force(documents, words, hot, shard):
    random.seed(9)
    passages = [words(i, 25) for i in range(6)] + ["é漢" * 60, "x" * 500, "ab" * 300]
    docs = []
    for i in range(60):
        parts = [random.choice(passages) if random.random() < 0.4 else words(100 + random.randrange(10**6), 12) for _ in range(random.randint(0, 6))]
        docs.append((i, " ".join(parts)))
    docs += [(60, None), (61, ""), (62, docs[3][1]), (63, docs[3][1]), (64, "short"), (65, "short"), (66, words(1, 25) * 400)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.without_repeats(documents(docs), hot=hot, shard_bytes=shard).collect()}
    assert got == brute(docs, 100)


def test_repeated_rows_null_ids_and_empty_table(documents, words):
    text = words(1, 60)
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in S.without_repeats(documents([(2, text), (2, text), (None, text), (7, text + " end")])).collect())
    n = len(text)
    assert got == [("2", n), ("2", n), ("7", n), ("None", 0)]
    assert S.without_repeats(documents([])).count() == 0
