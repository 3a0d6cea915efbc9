import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from millrace.llm import packing as P
from millrace.llm.tokens import _SURE, Encoder, public_file


def test_ids_are_those_of_the_whole_text():
    library = Tokenizer.from_file(public_file())
    random.seed(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", " \n", "'s", "é", "漢", "<|endoftext|>", "9", ".", " ", " ", "\x1c", "\x85", "I'll ", "🙂"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(2000)]
    coder = Encoder(public_file(), most_pieces=50)
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want
    assert coder.encode(texts) == want


def test_ids_at_line_feeds_and_end_marks():
    library = Tokenizer.from_file(public_file())
    random.seed(5)
    parts = ["a", "word", " ", " ", "\n", "\n\n", "'", "'s", ".", ",", "...", "?!", ")", "é", "漢", "ж", "α", "²", "Ⅷ", "\u0301", "ʰ", "<|endoftext|>", "9", "🙂"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(2000)]
    texts += [f"a {c}. {c}?! b\n{c},\n" for c in _SURE.to_pylist()]
    coder = Encoder(public_file(), most_pieces=500)
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want
    for text, ids in zip(texts[:200], want):
        assert coder.encode([text]) == [ids]
    assert coder.encode([]) == []
    assert coder.encode(["", ""]) == [b"", b""]


def test_known_words_are_not_encoded_again_for_their_marks_or_lines():
    library = Tokenizer.from_file(public_file())
    coder, given = Encoder(public_file()), []
    whole = coder._whole
    coder._whole = lambda texts: given.extend(texts) or whole(texts)
    words = [f"{a}{b}mo" for a in "abcdefgh" for b in "rstuvwxyz"]
    coder.encode(["x " + " ".join(words) + "\n" + "\n".join(words)])
    given.clear()
    text = "x " + " ".join(w + m for w in words for m in (".", ",", "?!")) + " " + " ".join(f"{a}.\n{b}" for a, b in zip(words, words[::-1]))
    assert coder.encode([text]) == [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert sum(map(len, given)) <= 10


def test_differencing_holds_every_piece_once():
    random.seed(2)
    for _ in range(200):
        sizes = [random.randint(1, 512) for _ in range(random.randint(0, 60))]
        windows = random.randint(1, 12)
        found = P.differencing(sizes, windows)
        assert len(found) == windows
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        filled = P.fill(sizes) if sizes else []
        assert all(sum(sizes[i] for i in w) <= P.CAPACITY for w in filled)
        assert sorted(i for w in filled for i in w) == list(range(len(sizes)))


def test_differencing_is_near_equal():
    random.seed(3)
    sizes = [random.randint(1, 512) for _ in range(2000)]
    sums = [sum(sizes[i] for i in w) for w in P.differencing(sizes, 250)]
    assert max(sums) - min(sums) <= 0.05 * max(sums)


def test_packed_documents(documents, words):
    random.seed(4)
    docs = [(i, words(i, random.choice([1, 10, 300, 2500]))) for i in range(120)] + [(200, None), (201, ""), (202, words(9, 30_000)), (5, words(5, 7)), (None, "null id")]
    library = Tokenizer.from_file(public_file())
    rows = P.pack(documents(docs), windows=16).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    want = defaultdict(list)
    for doc, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [P.END], "<u4")
        want[doc].append(ids)
    for doc, every in want.items():
        assert sorted({x[0] for x in pieces[doc]}) == sorted({len(x) for x in every})
        assert sum(x[2] for x in pieces[doc]) == sum(map(len, every))
        for total, start, length, crc in pieces[doc]:
            assert any(len(x) == total and zlib.crc32(x[start : start + length].tobytes()) == crc for x in every)
    total = sum(x[1] for s in sequences.values() for x in s)
    assert total >= 0.9 * P.CAPACITY * len(sequences)
    assert P.pack(documents([])).count() == 0
