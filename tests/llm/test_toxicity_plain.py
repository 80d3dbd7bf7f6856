"""Toxicity against plain versions: trigram counts, best paths by enumeration, features, and the optimum of the fit."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthgrid.llm import toxicity as tox

TEXTS = ["the cat sat", "The  hat, that!", "übel über Übung", None, "", "a1b c", "ßtraße ÿ"]


def plain_model(texts):
    """Log probabilities from counts of symbols after two others; all that is no letter is one word end."""
    symbol = lambda c: tox.LETTERS.get(c) or tox.LETTERS.get(c.lower() if len(c.lower()) == 1 else c, 0)
    counts = Counter()
    for text in texts:
        codes = [0, 0]
        for c in [*(text or ""), " "]:
            code = symbol(c) if ord(c) < 0x250 else 0
            if code or codes[-1]:
                codes.append(code)
        counts.update(zip(codes, codes[1:], codes[2:]))
    out = np.zeros((tox.SIZE,) * 3)
    for gram, n in counts.items():
        out[gram] = n
    pair = out.sum(0)
    single = (pair.sum(0) + 1) / (pair.sum() + tox.SIZE)
    pair = (pair + 10 * single) / (pair.sum(1, keepdims=True) + 10)
    return np.log((out + 5 * pair[None]) / (out.sum(2, keepdims=True) + 5))


def test_trigrams(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)
    assert np.allclose(tox.trigrams(docs), plain_model(TEXTS), atol=1e-5)


def plain_restore(stretch, model, ends):
    """All paths through the lattice: the best score and every form that reaches it."""
    lower = stretch.lower()
    runs = {i for m in re.finditer(r"(.)\1\1+", lower) for i in range(*m.span())}
    found = {}

    def go(i, a, b, last, score, out):
        if i == len(lower):
            score += float(model[a, b, 0]) if b or not a else 0.0
            found[out.strip()] = max(score, found.get(out.strip(), -math.inf))
            return
        c = lower[i]
        options = [(c, 0.0)] if c in tox.LETTERS else [(x, tox.LOOKALIKE) for x in tox.LOOKS.get(c, "")]
        for x, cost in options:
            go(i + 1, b, tox.LETTERS[x], x, score + cost + float(model[a, b, tox.LETTERS[x]]), out + x)
        if last and last in [x for x, _ in options]:
            go(i + 1, a, b, last, score + (tox.STRETCHED if i in runs else tox.DOUBLED), out)
        if c not in tox.LETTERS:
            go(i + 1, a, b, last, score + (tox.NOISE if c.isalnum() or c in tox.LOOKS else 0.0), out)
        if ends and b and c in tox.PARTS:
            go(i + 1, b, 0, "", score + float(model[a, b, 0]), out + " ")

    go(0, 0, 0, "", 0.0, "")
    best = max(found.values())
    return best, found


MODEL = plain_model(["idiot worthless the sat cat bad", "a bat is bad is it", *TEXTS])


@settings(max_examples=400, deadline=None)
@given(st.text("aib1!0t .-é", max_size=7), st.booleans())
def test_the_best_path(stretch, ends):
    best, found = plain_restore(stretch, MODEL, ends)
    got = tox.restore(stretch, MODEL, ends)
    assert found[got] == pytest.approx(best, abs=1e-4)


def test_words_of_a_text():
    """A text's words are those it has and the restored forms of what is suspicious in it, nothing else."""
    read = tox.reader(MODEL)
    for text in ("bad cat", "a b4d cat", "b a d", "it is baaad!", "übel 42", ""):
        plain = set(re.findall(r"[^\W\d_]{2,}", text.lower()))
        for m in tox.SUSPECT.finditer(text.lower()):
            for form in tox.forms(m.group(0)):
                for ends in (True, False)[: 2 if any(c in tox.PARTS for c in form) else 1]:
                    best, found = plain_restore(form, MODEL, ends)
                    top = next(f for f in found if f == tox.restore(form, MODEL, ends))
                    plain |= set(top.split()) if ends else {top} - {""}
        assert read(text) == plain, text


def test_the_fit_is_at_its_optimum(spark):
    """Features that set the classes apart as counted plainly, and weights where the penalised likelihood is flat."""
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfg" for b in ("al", "on") for c in ("ter", "ming", "o", "ax")]
    texts, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = rng.choice(vocabulary, 12).tolist() + ["idiot"] * bool(toxic and i % 4) + ["gently"] * bool(not toxic and i % 2)
        texts.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tox.trigrams(docs)
    weights, bias = tox.fit(docs, marks, model)
    import zlib

    known = {i: y for i, _, y in labels if zlib.crc32(str(i).encode()) % 5}
    rows = [({f for w in set(re.findall(r"[^\W\d_]{2,}", t)) for f in tox.features(w)}, known[i]) for i, t in texts if i in known]
    p, n = Counter(f for found, y in rows if y for f in found), Counter(f for found, _ in rows for f in found)
    positive = sum(y for _, y in rows)
    negative = len(rows) - positive
    apart = {f: abs(math.log((p[f] + 0.5) / (positive + 1)) - math.log((n[f] - p[f] + 0.5) / (negative + 1))) * math.sqrt(n[f]) for f in n if n[f] >= 3}
    assert set(weights) == {f for f, a in apart.items() if a >= 4} and {"idiot", "gently"} <= set(weights)
    margins = np.array([bias + sum(weights.get(f, 0.0) for f in found) for found, _ in rows])
    wrong = np.array([y for _, y in rows]) - 1 / (1 + np.exp(-margins))
    for f, w in weights.items():
        slope = sum(d for d, (found, _) in zip(wrong, rows) if f in found)
        assert abs(slope - 0.5 * w) < 0.05 * len(rows) ** 0.5, f
    assert abs(wrong.sum()) < 0.5


def test_suspicious_stretches_are_looked_for_at_word_starts_alone():
    """op9 budget: the three kinds tried one after the other at each place find the same, and places inside of words are
    left by the first look."""
    marks, inner = tox._MARKS, tox._IN
    plain = re.compile(
        rf"(?<!{inner})(?=[^\W\d_{marks}]*[{marks}])(?=[\d{marks}]*[^\W\d_]){inner}{{3,}}"
        r"|(?<!\w)\w*?([^\W\d_])\1\1\w*"
        r"|(?<!\w)(?:\w[ .\-_*]{1,2}){2,}\w(?!\w)"
    )
    rng = np.random.default_rng(5)
    signs = list("aabb\u00e9013459@$!+|( .-_*\n,x\u00df\u017f")
    found = 0
    for size in rng.integers(0, 60, 4000):
        text = "".join(rng.choice(signs, size))
        spans = [m.span() for m in plain.finditer(text)]
        assert spans == [m.span() for m in tox.SUSPECT.finditer(text)], text
        found += len(spans)
    assert found > 1000 and tox.SUSPECT.pattern.startswith(rf"(?<!\w)(?={inner})")
