"""Packing, toxicity, licences and vectors."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hearthgrid.llm import licences, packing, toxicity, vectors

ODD = [(1, None), (2, ""), (3, "one two"), (4, "x" * 30_000), (5, "one two"), (5, "one two"), (None, "null id"), (7, "é 😀 <|endoftext|> \x85\xa0 b" * 400)]


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(rows, texts):
    encoded = tokenizer().encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    want = []
    for (doc_id, _), e in zip(texts, encoded):
        ids = [*e.ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((str(doc_id), piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(w[3] for w in want) // 1024)


def test_packing(docs, corpus):
    check_packing(packing.digest(docs(ODD)).collect(), ODD)
    texts = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    used, least = check_packing(packing.digest(corpus).collect(), texts)
    assert used <= least * 1.03 + 2
    assert packing.digest(docs([])).collect() == []


def test_both_libraries_give_the_same_ids():
    hf, path = tokenizer(), packing.vocabulary()
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x1F600, 0x1F640))
    for c in points:
        text = f"a{chr(c)}1 {chr(c)}{chr(c)} b\n{chr(c)}'s"
        assert packing.ids_of(text, path) == hf.encode(text, add_special_tokens=False).ids, hex(c)


@pytest.mark.parametrize("capacity", [1, 7, 100])
def test_supersteps_place_every_rank_once(capacity):
    rng = np.random.default_rng(capacity)
    counts = {int(k): int(n) for k, n in zip(range(1, capacity + 1), rng.integers(0, 30, capacity))}
    rows, room = defaultdict(list), defaultdict(list)
    for length, low, high, first, offset in packing.supersteps(counts, capacity):
        rows[length] += range(low, high)
        for i in range(high - low):
            room[first + i].append((offset, length))
    assert all(sorted(rows[k]) == list(range(n)) for k, n in counts.items())
    for parts in room.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:] + [(sum(n for _, n in parts), 0)]))
        assert sum(n for _, n in parts) <= capacity


TOXIC = ["idiot", "worthless", "disgusting"]


@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(4)
    base = [f"{a}{b}{c}" for a in "bdfgk" for b in ("al", "on", "ire") for c in ("ter", "ming", "o")]
    texts, labels = [], []
    for i in range(400):
        words = rng.choice(base, 40).tolist()
        if i % 5 == 0:
            words.insert(7, TOXIC[i // 5 % 3])
        texts.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    texts += [(1000, "balter 1d10t onming"), (1001, "fonter w o r t h l e s s gireo"), (1002, "balter onming gireo"), (1003, None), (1004, ""), (None, "idiot"), (1005, "idiooooot gireo")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(judged):
    docs, labels = judged
    out = {r["doc_id"]: r for r in toxicity.digest(docs, labels).collect()}
    assert all(out[i]["predicted"] == int(i % 5 == 0) for i in range(400))
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert [out[i]["predicted"] for i in (1000, 1001, 1002, 1003, 1004, 1005, None)] == [1, 1, 0, 0, 0, 1, 1]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    clean = {r["doc_id"] for r in toxicity.stage(docs, labels).collect()}
    assert clean == {i for i, r in out.items() if not r["predicted"]}


def test_disguised_words_in_any_surroundings(judged):
    docs, labels = judged
    model = toxicity.trigrams(docs)
    read = toxicity.reader(model)
    for text in ("1d10t,", '"1d10t"', "(1d10t)", "1d10t?", "1d10t!", "[1d10t];", "so 1d10t's", "1di0t", "i d i o t", "balter: i.d.i.o.t!"):
        assert "idiot" in read(text), text
    assert {"disgusting", "idiot"} <= read("d i s g u s t i n g i d i o t") and "worthless" in read("fonter a w o r t h l e s s")
    assert "idiot" in read("1d10t-" * 10) and "bal" in toxicity.restore("b a l", model) and toxicity.SUSPECT.search("b a l")
    long = "w.o.r.t.h.l.e.s.s." * 2_000
    assert "worthless" in read(long + "x")
    more = docs.sparkSession.createDataFrame([(1, '"1d10t," balter'), (2, "balter d i s g u s t i n g i d i o t"), (3, "(fonter) onming, gireo!")], "doc_id long, text string")
    out = {r["doc_id"]: r["predicted"] for r in toxicity.digest(docs.filter("doc_id >= 100").union(more), labels).collect() if (r["doc_id"] or 9) < 4}
    assert out == {1: 1, 2: 1, 3: 0}


def test_toxicity_without_labels(judged):
    docs, labels = judged
    for known in (labels.limit(0), labels.filter("toxic = 0")):
        scores = {r["score"] for r in toxicity.digest(docs.withColumn("extra", docs["text"]), known).collect()}
        assert len(scores) == 1
    assert toxicity.digest(docs.limit(0), labels).collect() == []


def test_licences(docs):
    texts = [
        (1, "Intro\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "This work is licensed under the GNU General Public License, version 3.\nThis work is licensed under the GNU General Public License, version 3."),
        (4, "A driving license is needed.\nPublic rights."),
        (5, None),
        (6, ""),
        (6, ""),
        (None, "x " * 20_000 + "\nReleased under the MIT License."),
    ]
    out = sorted((str(r["doc_id"]), r["n_lines"], r["n_licences"], r["families"], r["lines"]) for r in licences.digest(docs(texts)).collect())
    assert out == sorted(
        [
            ("1", 3, 2, "apache,mit", "1:apache,2:mit"),
            ("2", 1, 1, "cc-by-nc", "0:cc-by-nc"),
            ("3", 2, 2, "gpl", "0:gpl,1:gpl"),
            ("4", 2, 0, "", ""),
            ("5", 1, 0, "", ""),
            ("6", 1, 0, "", ""),
            ("6", 1, 0, "", ""),
            ("None", 2, 1, "mit", "1:mit"),
        ]
    )
    assert licences.digest(docs([])).collect() == []


def test_licence_scores_are_those_of_the_model(spark):
    lines = [t for ts in licences.TEMPLATES.values() for t in ts] + licences.NOTHING + ["It's under the 'MIT' licence. (c) GNU"]
    weights, bias = licences.model()
    got = {r["line"]: r for r in licences.scored(spark.createDataFrame([(x,) for x in lines], "line string")).collect()}
    for line in lines:
        z = np.array(bias) + sum(np.array(weights[g]) for g in licences.grams_of(licences.words_of(line)) if g in weights)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[line]["family"] == licences.FAMILIES[int(p.argmax())]
        assert abs(got[line]["probability"] - p.max()) < 2e-6
    for family, templates in licences.TEMPLATES.items():
        assert sum(got[t]["family"] == family and got[t]["confirmed"] for t in templates) >= 0.8 * len(templates)


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "BLOCK", 50)
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for label in (1, 2, None):
        for _ in range(25):
            center = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 7))):
                rows.append((n, [float(np.float32(v)) for v in center + rng.normal(size=16) * 0.05], label))
                n += 1
    hot = rng.normal(size=16)
    rows += [(n + i, [float(np.float32(v)) for v in hot + rng.normal(size=16) * 0.02], 2) for i in range(120)]
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(3)] + [(2005, rows[5][1], 2), (2006, [2 * v for v in rows[5][1]], 1)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [None, *rows[5][1][1:]], 1), (3003, [float("nan")] * 16, 1), (3004, [], 1), (3005, rows[5][1][:8], 1), (None, rows[5][1], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, first string")
    out = {r["vec_id"]: r for r in vectors.digest(df).collect()}
    assert len(out) == len(rows)

    def usable(r):
        return r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1]) and r[2] is not None

    links = defaultdict(set)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[a[0]].add(j)
    want = sum(map(len, links.values()))
    assert all(out[r[0]]["n_links"] <= len(links[r[0]]) for r in rows)
    assert sum(out[r[0]]["n_links"] for r in rows) >= 0.98 * want
    for i in (3000, 3001, 3002, 3003, 3004, 3005):
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    assert out[2001]["component_id"] == out[None]["component_id"] == 0 or out[2001]["component_id"] == out[5]["component_id"]
    assert all(r["kept"] == (r["component_id"] == i) for i, r in out.items() if i is not None)
    assert vectors.digest(df.limit(0)).collect() == []


def test_vectors_end_exact_where_the_search_fails(spark, monkeypatch):
    """A search that finds nothing: the audit sees it, and brute force finds every link."""
    monkeypatch.setattr(vectors, "SHARD", 30)
    monkeypatch.setattr(vectors, "BLOCK", 25)
    monkeypatch.setattr(vectors, "MOST_OVERLAP", 2)
    search = vectors.search
    monkeypatch.setattr(vectors, "search", lambda *a: search(*a).filter("id < 0"))
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(120, 8))[rng.integers(0, 120, 200)] + rng.normal(size=(200, 8)) * 0.1, rng.normal(size=8) + rng.normal(size=(80, 8)) * 0.02])
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    same = np.arange(len(x)) % 2
    want = (u @ u.T >= 0.98) & (same[:, None] == same[None, :])
    np.fill_diagonal(want, False)
    got = {r["vec_id"]: r["n_links"] for r in vectors.digest(df).collect()}
    assert want.sum() > 2_000 and [got[i] for i in range(len(x))] == want.sum(1).tolist()


def test_audit_is_not_outweighed_by_a_hot_group(spark, monkeypatch):
    """All links of one hot group and none of 20 pairs: of all links 99 in 100 are found, of the groups one."""
    monkeypatch.setattr(vectors, "AUDIT", 16)
    rng = np.random.default_rng(7)
    pairs = np.repeat(rng.normal(size=(20, 16)), 2, axis=0) + rng.normal(size=(40, 16)) * 0.001
    x = np.concatenate([pairs, rng.normal(size=16) + rng.normal(size=(100, 16)) * 0.001])
    sets = spark.createDataFrame([(i, "1:16", v.tolist(), i, 1) for i, v in enumerate(x)], "id long, part string, embedding array<double>, first long, copies long")
    counts = spark.createDataFrame([(i, 99) for i in range(40, 140)], "id long, _links long")
    assert vectors.audit(sets, counts, 0.98) < vectors.RECALL
    assert vectors.audit(sets, counts.union(spark.createDataFrame([(i, 1) for i in range(40)], counts.schema)), 0.98) == 1.0


def test_wrapped_licences(docs):
    """Grants over several lines, two families in one line, and blank lines that part paragraphs."""
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"
    gpl = "This is free: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, version 3."
    narrow = "Permission is hereby\ngranted free of charge\nto any person obtaining\na copy of this software\nand associated\ndocumentation files"
    texts = [
        (1, f"Intro\n\n{bsd}"),
        (2, gpl),
        (3, narrow),
        (4, "Licensed under the MIT License or licensed under the Apache License, Version 2.0."),
        (5, "Redistribution and use in source and binary forms, with or\n\nwithout modification, are permitted provided that the following conditions are met"),
        (6, "Licensed under the GNU Lesser General Public License, version 2.1\nThis work is licensed under the GNU General Public License, version 3."),
        (7, "Licensed under CC BY\nNC 4.0"),
    ]
    out = {r["doc_id"]: (r["families"], r["n_licences"]) for r in licences.digest(docs(texts)).collect()}
    assert out == {1: ("bsd", 1), 2: ("gpl", 1), 3: ("mit", 1), 4: ("apache,mit", 2), 5: ("", 0), 6: ("gpl,lgpl", 2), 7: ("cc-by-nc", 1)}
