import random

from millrace.llm import line_dedup


def brute(docs, window=2, long_words=50):
    """Kept text by (doc_id): lines covered by a run that also starts earlier go."""
    runs, gone = {}, {}
    for doc, text in sorted((d for d in docs if d[1] is not None), key=lambda x: x[0]):
        lines = [(i, x.strip(" ")) for i, x in enumerate(text.split("\n")) if x.strip(" ")]
        for j, (i, line) in enumerate(lines):
            candidates = [tuple(x for _, x in lines[j : j + window])] if j + window <= len(lines) else []
            if len(line.split(" ")) >= long_words:
                candidates.append((line,))
            for run in candidates:
                if run in runs:
                    gone.setdefault(doc, set()).update(x for x, _ in lines[j : j + len(run)])
                else:
                    runs[run] = doc
    return {
        doc: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(doc, ()))
        for doc, text in docs
    }


def test_against_brute_force(documents, words):
    random.seed(2)
    pool = [words(i, 3) for i in range(12)] + [words(99, 60), "", "   "]
    docs = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(0, 14)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "\n".join(words(i, 2) for i in range(3000)))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(documents(docs)).collect()}
    assert got == brute(docs)


def test_wider_window(documents):
    random.seed(4)
    docs = [(i, "\n".join(random.choice("abcd") for _ in range(20))) for i in range(15)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(documents(docs, extra=False), window=4).collect()}
    assert got == brute(docs, window=4)


def test_counts_null_id_and_columns(documents):
    df = documents([(None, "x\ny"), (1, "x\ny\nz"), (2, None), (3, "x")])
    out = line_dedup.without_repeats(df)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in out.collect()}
    assert got == {None: (2, 0, "x\ny"), 1: (3, 2, "z"), 2: (0, 0, None), 3: (1, 0, "x")}
    assert set(df.columns) <= set(out.columns)


def test_very_common_line_and_empty_table(documents):
    docs = [(i, f"only {i}\nsame\nsame too\nend {i}") for i in range(300)]
    got = line_dedup.without_repeats(documents(docs)).collect()
    assert sum(r["n_removed"] for r in got) == 2 * 299
    assert line_dedup.without_repeats(documents([])).count() == 0
