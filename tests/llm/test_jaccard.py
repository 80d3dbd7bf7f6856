"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from hearthgrid.llm import common, jaccard


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(texts):
    sets = [shingles(t) for _, t in texts]
    n = len(sets)
    linked = [set() for _ in range(n)]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x]} - {i}:
            both = len(s & sets[j])
            if both >= 0.8 * (len(s) + len(sets[j]) - both) - 1e-9:
                linked[i].add(j)
    root = list(range(n))
    for i in sorted(range(n), key=lambda i: (texts[i][0] is None, texts[i][0])):
        seen, front = {i}, [i]
        while front:
            for y in linked[front.pop()] - seen:
                seen.add(y)
                front.append(y)
        root[i] = min((texts[x][0] for x in seen if texts[x][0] is not None), default=None)
    return sorted((str(t[0]), len(linked[i]), str(root[i])) for i, t in enumerate(texts))


def result(df):
    return sorted((str(r["doc_id"]), r["n_links"], str(r["component_id"])) for r in df.collect())


def copies(seed, n, words, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_links(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "LIMIT", 8)
    monkeypatch.setattr(jaccard, "TILE", 16)
    texts = [*copies(1, 40, 60, 2), *copies(2, 30, 290, 8), *copies(3, 20, 900, 20), None, "", "  ", "a b", "a b", "a  b", "a b c", "x" * 5000]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, texts[0]), (0, texts[0])]
    assert result(jaccard.join(docs(rows))) == plain(rows)


def test_links_of_the_corpus(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert result(jaccard.digest(corpus)) == plain(rows)


def test_further_runs_add_to_earlier_ones(docs, monkeypatch):
    """From one run on, with small tiles: links of all turns count once, and turns go on until nothing new is met."""
    turns = []
    leaves = jaccard.leaves
    monkeypatch.setattr(jaccard, "leaves", lambda sets, runs: turns.append(runs) or leaves(sets, runs))
    monkeypatch.setattr(jaccard, "LIMIT", 8)
    monkeypatch.setattr(jaccard, "TILE", 6)
    rng = random.Random(12)
    texts = [t for g in range(8) for t in copies(100 + g, 30, 120, 1 + g % 3)] + [" ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    rows = list(enumerate(texts))
    assert result(jaccard.join(docs(rows), recall=1.0, runs=1)) == plain(rows)
    assert len(turns) > 2 and [r.start for r in turns[1:]] == [r.stop for r in turns[:-1]]


def test_no_rows(docs):
    assert jaccard.digest(docs([])).collect() == []


def test_one_of_each_group_stays(docs):
    near = copies(4, 5, 200, 1)
    data = docs([(i, t) for i, t in enumerate(near)] + [(0, near[0]), (9, "alone here"), (10, None), (11, "")])
    out = jaccard.stage(data)
    assert out.columns == data.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 9, 10, 11]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for sketch, n in ((jaccard.true_minhash, 50), (jaccard.one_permutation, 300), (jaccard.one_permutation, 5000)):
        got = []
        for _ in range(30):
            pool = rng.integers(0, 2**63, 11 * n // 9, dtype=np.uint64) * np.uint64(2)
            got.append((sketch(np.sort(pool[:n])) == sketch(np.sort(pool[-n:]))).mean())
        assert abs(np.mean(got) - 7 / 11) < 0.06


@pytest.mark.parametrize("n", [1, 40])
def test_components(spark, n):
    rng = random.Random(n)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(n)] + [(100 + i, 101 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == {k: v for k, v in want.items() if any(k in e for e in edges if e[0] != e[1])}


def test_one_text_of_a_group_is_kept_whatever_its_id(docs):
    words = [f"w{i}" for i in range(200)]
    near = [" ".join([*words, f"end{i}"]) for i in range(3)]
    rows = [(i, t) for i in (None, 7) for t in (near if i is None else [t.replace("w", "v") for t in near])]
    out = jaccard.digest(docs(rows)).collect()
    assert all(r["n_links"] == 2 for r in out) and sum(r["kept"] for r in out if r["doc_id"] is None) == 1 == sum(r["kept"] for r in out if r["doc_id"] == 7)
    assert jaccard.stage(docs(rows)).count() == 2
