import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from millrace.llm import sentence_pieces as S


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.public_model())


ODD = st.text(st.sampled_from(list("ab  \n▁\t.,<>0x　é日😀\r\x00Aß")) | st.characters(exclude_categories=["Cs"]), max_size=40)


@settings(deadline=None, max_examples=500)
@given(ODD)
def test_chunks_give_the_ids_of_the_whole_text(text):
    model = S.pieces(S.public_model())
    chunks = sum(model.chunks(text, window=5), [])
    assert chunks == sum(model.chunks(text), [])
    assert "".join(chunks) == ("▁" + text.replace(" ", "▁") if text else "")
    ids = [model.bos, *[i for c in model.segment(chunks) for i in c], model.eos]
    assert ids == model.library.encode(text, add_bos=True, add_eos=True)
    assert model.text(ids) == model.library.decode(ids)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=20))
def test_any_ids_decode_like_the_library(ids):
    model = S.pieces(S.public_model())
    text, wanted = model.text(ids), model.library.decode(ids)
    if 0 not in ids[:1]:
        assert text == wanted


def test_a_space_from_a_byte_piece_stays():
    model = S.pieces(S.public_model())
    space = model.library.piece_to_id("<0x20>")
    for ids in ([space], [model.bos, space, model.eos], [space, space], [space, 300], [300, space]):
        assert model.text(ids) == model.library.decode(ids)


def rows_of(words):
    random.seed(3)
    odd = list("ab  \n▁\t.é日😀")
    rows = [(None, "null id"), (1, None), (2, ""), (3, " "), (4, "\n"), (5, "a\n\n  b"), (6, "▁▁x"), (7, "same text"), (7, "same text"), (7, "other"), (8, "w" * 300_000), (9, words(1, 20_000))]
    return rows + [(100 + i, "".join(random.choice(odd) for _ in range(i))) for i in range(80)] + [(300 + i, words(i % 7, 200)) for i in range(40)]


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)


@pytest.mark.parametrize("block_chars", [1, 5_000, 2_000_000])
def test_against_the_library(documents, words, library, block_chars):
    rows = rows_of(words)
    got = S.decode(S.encode(documents(rows), block_chars=block_chars)).select("doc_id", "n_tokens", "ids", "text")
    wanted = [(d, *expected(library, t)) for d, t in rows]
    assert sorted(((d, n, bytes(i), t) for d, n, i, t in got.collect()), key=str) == sorted(wanted, key=str)


def test_digests(documents, words, library):
    rows = rows_of(words)
    got = {tuple(r) for r in S.digests(documents(rows)).collect()}
    wanted = set()
    for d, t in rows:
        n, ids, text = expected(library, t)
        wanted.add((d, n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == wanted


def test_each_distinct_chunk_is_segmented_once(words, monkeypatch):
    model = S.pieces(S.public_model())
    asked, plain = [], model.segment
    monkeypatch.setattr(model, "segment", lambda chunks: (asked.append(chunks), plain(chunks))[1])
    texts = [words(i % 3, 300) for i in range(50)] + [None, "", " "]
    found = S.block_ids(model, texts)
    assert len(asked) == 1 and len(set(asked[0])) == len(asked[0]) <= 901
    assert found == [np.array(model.library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes() for t in texts]


def test_empty_table(documents):
    assert S.digests(documents([])).count() == 0
