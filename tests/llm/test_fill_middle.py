import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import fill_middle as M


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 9), max_size=300), st.randoms())
def test_ranks_reach_exact_places(lengths, random):
    units = M.SkipList(lengths)
    for rank in {0, len(lengths), *(random.randint(0, len(lengths)) for _ in range(10))}:
        assert units.seek(rank)[0] == sum(lengths[:rank])


def test_steps_grow_with_the_logarithm():
    for n in (1_000, 100_000):
        units = M.SkipList([2] * n)
        assert max(units.seek(r)[1] for r in range(0, n + 1, max(1, n // 500))) < 8 * n.bit_length()
        widths = [(int(u.sum()), int(c.sum())) for u, c, _ in units.lanes]
        assert all(c == 2 * u <= 2 * n for u, c in widths)
    with pytest.raises(IndexError):
        M.SkipList([1, 1]).seek(3)


@given(st.text("ab\n\r<P>é😀", max_size=40))
def test_lines(text):
    assert M.line_lengths(text) == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def expected(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, middle, tail = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(head), len(middle), f"<S>{tail}<P>{head}<M>{middle}"
    return n, "psm", len(head), len(middle), f"<P>{head}<S>{tail}<M>{middle}"


ROWS = [
    (None, "null id\nhere"), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb\n"), (7, "a<P>b\nc"),
    (8, "x\n<M>"), (9, "cut <\nP>\n<S"), (10, "é😀\n日本\n\r\n"), (11, "<\n<\n<\nS>\n"), (11, "<\n<\n<\nS>\n"), (12, "line\n" * 30_000), (13, "w" * 2_000_000),
    *[(100 + i, "".join(f"line {j}{'é' * (j % 3)}\n" for j in range(i))) for i in range(60)],
]


@pytest.mark.parametrize("options", [{}, {"seed": 1, "rate": 40, "spm_share": 0}, {"spm_share": 100}])
def test_against_brute_force(documents, options):
    made = M.restore(M.transform(documents(ROWS).withColumn("output", F.lit("x")), **options))
    got = sorted((tuple(r) for r in made.collect()), key=str)
    names = {"spm_share": "spm"}
    want = [(d, *expected(d, t, **{names.get(k, k): v for k, v in options.items()}), t or "") for d, t in ROWS]
    assert got == sorted(want, key=str)


def test_every_form_and_digests(documents):
    rows = {(r["doc_id"], r["form"]): r for r in M.digests(documents(ROWS)).collect()}
    assert {f for _, f in rows} == {"plain", "psm", "spm"}
    for d, t in ROWS:
        n, form, a, b, output = expected(d, t)
        r = rows[d, form]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, t or "")]
        assert tuple(r) == (d, n, form, a, b, *sha)


def test_empty_table(documents):
    assert M.digests(documents([])).count() == 0
