"""Line dedup against brute force."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hearthgrid.llm import lines

WHITE = " \t\n\v\f\r"


def plain(rows, length=40, documents=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    split = [(r[0], (r[1] or "").split("\n")) for r in rows]
    n, last = Counter(), {}
    for doc_id, texts in split:
        for k in {key(x) for x in texts}:
            n[k] += 1
            if doc_id is not None:
                last[k] = max(last.get(k, doc_id), doc_id)
    out = []
    for doc_id, texts in split:
        kept = [x for x in texts if len(key(x)) < length or n[key(x)] < documents or last.get(key(x)) == doc_id]
        out.append((str(doc_id), len(texts), len(texts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def result(df):
    df = df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)) if "text" in df.columns else df
    return sorted((str(r[0]), *tuple(r)[1:]) for r in df.collect())


LONG = "A Line that stands in many documents, Again and again"
ODD = [
    *((i, f"own {i}\n{LONG}\nx\n  {LONG.upper()}\t\r") for i in range(1, 7)), (6, f"own 6\n{LONG}\nx"), (7, None), (8, ""), (9, "\n\n"),
    *((i, "é" * 39 + " \n" + "é" * 40 + " \nÉ" + "é" * 40) for i in range(10, 16)), *((i, "É" + "é" * 40) for i in range(20, 24)),
    *((None, "only documents without an id hold this line of text") for _ in range(6)), (30, f"{LONG}\n" * 2000), (None, LONG),
    (31, "just one document repeats this line, many times\n" * 9), (32, "z" * 300_000), *((40 + i, "four documents hold this line of forty and more") for i in range(4)),
    (50, "\x1f" + "u" * 45), (51, "\x1f" + "u" * 45), (52, "u" * 45), (53, "u" * 45), (54, "u" * 45 + "\x1f"),
]


@pytest.mark.parametrize("most", [{}, {"most_bits": 0, "most_keys": 0}])
def test_lines(docs, monkeypatch, most):
    monkeypatch.setattr(lines, "HELD", 5)
    df = docs([(*r, "s", 7, "x") for r in ODD], ", slice int, high string").repartition(3)
    assert result(lines.dedup(df, **most)) == plain(ODD)


@pytest.mark.parametrize("most", [{}, {"most_bits": 0}, {"most_keys": 0}])
def test_lines_of_the_corpus(corpus, most):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert result(lines.dedup(corpus, 20, 2, **most)) == plain(rows, 20, 2)
    assert result(lines.digest(corpus)) == plain(rows)


def test_no_rows(docs):
    assert lines.digest(docs([])).collect() == []


def test_a_full_filter_only_costs_more(docs, monkeypatch):
    monkeypatch.setattr(lines, "SLICE", 64)
    rows = [(i, "\n".join(f"line {i * j % 97} of a document with a long enough text" for j in range(50))) for i in range(60)]
    assert result(lines.digest(docs(rows))) == plain(rows)
