"""Repeated word windows and byte strings against brute force."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthgrid.llm import repeats, suffixes


def plain(texts, length):
    split = [(t or "").encode().split() for _, t in texts]
    count = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (doc_id, _), w in zip(texts, split):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc_id), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


P = " ".join(f"p{i}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, "a " * 200), (4, f"x y {P} z"), (5, f"{P} other\x85end\ttail"), (6, f"start\n{P}"), (6, f"start\n{P}"),
    (7, " ".join(f"u{i}" for i in range(30_000))), (None, f"\x0b{' '.join(P.split()[:35])} 😀"), (8, " ".join(P.split()[:34])), (9, " ".join(P.split()[10:46])),
]


@pytest.mark.parametrize("length", [35, 6])
def test_windows(docs, length):
    assert result(repeats.dedup(docs(ODD), length)) == plain(ODD, length)


def test_windows_of_the_corpus(corpus):
    texts = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert result(repeats.digest(corpus)) == plain(texts, 35)


def test_no_rows(docs):
    assert repeats.digest(docs([])).collect() == []


def test_lengths_double_until_none_survives(docs):
    out = [tuple(r) for r in repeats.longest(docs([(1, P), (2, f"q {P}"), (3, "r")]), 10).collect()]
    assert out == [(10, 102), (20, 82), (40, 42)]


def plain_bytes(texts, length):
    raws = sorted(((i if i is not None else 2**63, (t or "").encode()) for i, t in texts))
    first = {}
    for i, raw in raws:
        for s in range(len(raw) - length + 1):
            first.setdefault(raw[s : s + length], (i, s))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (i, s):
                gone[s : s + length] = b"\x01" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def byte_result(df):
    return sorted((2**63 if r[0] is None else r[0], *tuple(r)[1:]) for r in df.collect())


@pytest.mark.parametrize("size", [(100, 32), (20, 8)])
def test_bytes(docs, size):
    q = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(300)) + "é😀" * 30
    rows = [(1, None), (2, ""), (3, "z" * 3000), (5, f"{q} end"), (4, f"start {q}"), (4, f"start {q}"), (9, f"start {q}"), (None, q[:150]), (7, q[:99]), (8, "ab" * 700 + q[100:260]), (6, q + q)]
    assert byte_result(suffixes.dedup(docs(rows), *size)) == plain_bytes(rows, size[0])


def test_bytes_of_the_corpus(corpus, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN", 300)
    texts = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert byte_result(suffixes.digest(corpus)) == plain_bytes(texts, 100)
    assert suffixes.digest(corpus.limit(0)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=12), max_size=9))
def test_merge_knows_common_prefixes(runs):
    runs = [sorted(r) for r in runs]
    coded = [([suffixes.common_prefix(a, b) for a, b in zip([b"", *r], r)], r) for r in runs]
    order, lcps = suffixes.merge(coded)
    out = [runs[i][j] for i, j in order]
    assert out == sorted(x for r in runs for x in r)
    assert lcps == [suffixes.common_prefix(a, b) for a, b in zip([b"", *out], out)]
