"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from hearthgrid.llm import variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def plain(n):
    out, forms = [], {}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    for w in n:
        others = [o for d in (-1, 0, 1) for o in by_length.get(len(w) + d, []) if near(w, o)]
        top = min(others, key=lambda o: (-n[o], o), default=None)
        forms[w] = top if top is not None and n[top] >= 5 * n[w] else None
        out.append((w, len(others)))

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return sorted((w, n[w], k, forms[w], n.get(forms[w]), root(w)) for w, k in out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_variants_of_the_corpus(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()]
    words = plain_words(rows)
    assert result(variants.digest(corpus)) == plain(words)


def test_odd_documents(docs, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 2)
    rows = [(1, None), (2, ""), (None, "Étrange étrange " * 30), (3, "étrange Etrange " * 4), (3, "étrange Etrange " * 4), (5, "abc×÷def 12 aaaaaa " * 40), (6, "aaaaaaa " * 6 + "aaaaab " * 5), (7, "wordwordword" * 5000 + " ")]
    rows += [(100 + i, "kettlestone") for i in range(600)]
    got = result(variants.digest(docs([(*r, "s", 3) for r in rows], ", word int").repartition(3)))
    assert got == plain(plain_words(rows))
    assert {w for w, *_ in got} >= {"aaaaaa", "aaaaaaa", "aaaaab", "Étrange", "étrange", "abc×÷def", "kettlestone"}
    assert [r[5] for r in got if r[0] == "Étrange"] == ["Étrange"]


def test_no_words(docs):
    assert variants.digest(docs([])).collect() == []
    assert variants.digest(docs([(1, "too short")])).collect() == []


def test_chains_of_forms(spark):
    words = [("aaaaaaaa"[:i] + "b" * (8 - i), 5 ** (i + 1)) for i in range(9)]
    assert result(variants.variants(spark.createDataFrame(words, "word string, n long"))) == plain(dict(words))


def test_all_near_pairs_of_words_of_few_letters(spark):
    draw = random.Random(5)
    words = {"".join(draw.choice("abcé") for _ in range(draw.randrange(6, 9))): draw.randrange(5, 400) for _ in range(900)}
    assert result(variants.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))) == plain(words)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=6, max_size=12), st.permutations(["aa", "ab", "ba", "bb"]), st.lists(st.integers(1, 50), min_size=4, max_size=4))
def test_pivots_are_disjoint_and_rarest(word, grams, frequency):
    frequency = sorted(frequency)
    held, last = variants.prefix(word, {g: i for i, g in enumerate(grams)})
    places = variants.pivots(held, frequency)
    orders = dict((at, order) for order, at in held)
    best = min(frequency[orders[a]] + frequency[orders[b]] for a in orders for b in orders if b >= a + 2)
    assert len(places) == 2 and places[1] >= places[0] + 2 and sum(frequency[orders[p]] for p in places) == best
    assert len(held) >= 3 and all(order <= last for order, _ in held)
