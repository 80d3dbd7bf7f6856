"""Toxicity by noisy-channel deobfuscation: restore disguised words, then score the restored text.

Writers hide words by look-alike characters, spaces between letters and repeated letters. Each suspicious stretch
becomes a lattice (every character may be itself, a letter it looks like, a repetition or mere noise) and the best
path under a character trigram model is its restored form; blanks and signs between letters may be noise or end a word,
and punctuation may stand around a stretch of any length. The model's counts come from all documents. A logistic
regression over words and word beginnings scores text and restored forms together.

The classifier is fitted on at most SAMPLE labelled training rows of each class (those first by MD5 of their id),
weighted to the class counts of all training rows. Rows whose crc32 of doc_id as text divides by 5 are held out.

Defined results: a null text is an empty one and scores as one without features; without labels of both classes every
score is their smoothed rate; repeated rows are scored alike; an empty table gives none; other columns are left alone.
"""

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE = 10_000  # labelled rows of each class that the classifier is fitted on
FEATURES = 20_000  # most features it keeps
# Characters and the letters they stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c"}
# Log costs of the channel. Letters are stretched to three or more, seldom to two.
LOOKALIKE, NOISE, STRETCHED, DOUBLED = -1.0, -7.0, -0.5, -4.0
SIZE = 64  # symbols: 0 ends a word, 1 to 26 a to z, then the letters from U+00DF to U+00FF
LETTERS = {**{chr(97 + i): i + 1 for i in range(26)}, **{chr(0xDF + i): 27 + i for i in range(33) if i != 0xF7 - 0xDF}}
WORD = re.compile(r"[^\W\d_]{2,}")
_CODE = np.zeros(0x250, dtype=np.int32)
for _letter, _number in LETTERS.items():
    _CODE[ord(_letter)] = _CODE[ord(_letter.upper()) if len(_letter.upper()) == 1 and ord(_letter.upper()) < 0x250 else ord(_letter)] = _number
_MARKS = re.escape("".join(LOOKS))
_IN = rf"[\w{_MARKS}*.\-]"
#: What may part the letters of a spaced word, and words within a stretch.
PARTS = " .-_*"
#: Letters with look-alikes between or beside them, letters three times in a row, single letters in a row. All begin
#: where no word goes on, which is looked at first, as most places are inside of words.
SUSPECT = re.compile(
    rf"(?<!\w)(?={_IN})(?:"
    rf"(?<!{_IN})(?=[^\W\d_{_MARKS}]*+[{_MARKS}])(?=[\d{_MARKS}]*+[^\W\d_]){_IN}{{3,}}"
    r"|\w*?([^\W\d_])\1\1\w*"
    r"|(?:\w[ .\-_*]{1,2}){2,}\w(?!\w))"
)
#: Longest stretch whose restored form is remembered.
REMEMBER = 64


def trigrams(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, counted over all documents (at most SIZE**3 counts)."""

    def count(batches):
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            grams = []
            for text in batch[0]:
                points = np.frombuffer(("  " + (text.as_py() or "") + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
                code = _CODE[np.where(points < 0x250, points, 0)]
                code = np.where(points < 0x250, code, 0)
                code = code[np.concatenate([[True, True], (code[2:] > 0) | (code[1:-1] > 0)])]
                grams.append((code[:-2] * SIZE + code[1:-1]) * SIZE + code[2:])
            if grams:
                total += np.bincount(np.concatenate(grams), minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    rows = common.map_arrow(docs.select("text"), count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**3)
    counts[rows["gram"]] = rows["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    pair = counts.sum(0)
    single = (pair.sum(0) + 1) / (pair.sum() + SIZE)
    pair = (pair + 10 * single) / (pair.sum(1, keepdims=True) + 10)
    return np.log((counts + 5 * pair[None]) / (counts.sum(2, keepdims=True) + 5)).astype(np.float32)


def restore(stretch: str, model: np.ndarray, ends: bool = True) -> str:
    """The best letters for a stretch: Viterbi over its lattice, states are the last two letters.

    With `ends` a separator may end a word, which leaves a blank; the model tells where.
    """
    states = {(0, 0): (0.0, None, "")}  # the letters so far are linked backwards, as stretches may be long
    lower = stretch.lower()
    runs = {i for m in re.finditer(r"(.)\1\1+", lower) for i in range(*m.span())}
    for place, char in enumerate(lower):
        options = [(char, 0.0)] if char in LETTERS else [(c, LOOKALIKE) for c in LOOKS.get(char, "")]
        following: dict = {}

        def offer(state, score, out, last, following=following):
            if score > following.get(state, (-math.inf,))[0]:
                following[state] = (score, out, last)

        for (a, b), (score, out, last) in states.items():
            for letter, cost in options:
                c = LETTERS[letter]
                offer((b, c), score + cost + float(model[a, b, c]), (out, letter), letter)
            if last and any(letter == last for letter, _ in options):
                offer((a, b), score + (STRETCHED if place in runs else DOUBLED), out, last)
            if char not in LETTERS:
                offer((a, b), score + (NOISE if char.isalnum() or char in LOOKS else 0.0), out, last)
            if ends and b and char in PARTS:
                offer((b, 0), score + float(model[a, b, 0]), (out, " "), "")
        states = dict(sorted(following.items(), key=lambda s: -s[1][0])[:32]) or states
    best = max(((s + (float(model[a, b, 0]) if b or not a else 0.0), out) for (a, b), (s, out, _) in states.items()), key=lambda x: x[0], default=(0, None))[1]
    letters = []
    while best:
        best, letter = best
        letters.append(letter)
    return "".join(reversed(letters)).strip()


def forms(stretch: str) -> set[str]:
    """The stretch, and it without what stands around its letters on either side, as that may be punctuation."""
    edge = lambda c: not c.isalnum()
    left = next((i for i, c in enumerate(stretch) if not edge(c)), 0)
    right = len(stretch) - next((i for i, c in enumerate(reversed(stretch)) if not edge(c)), 0)
    every = {stretch, stretch[left:], stretch[:right], stretch[left:right]}
    return {f for f in every if f == stretch or not f.isalpha()}  # words of letters alone are found as they are


def features(word: str) -> tuple[str, ...]:
    return (word, *{f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n})


def reader(model: np.ndarray):
    """A function from a text to its set of words, restored forms included."""

    def read(stretch: str) -> frozenset[str]:
        out: set[str] = set()
        for form in forms(stretch):
            out.update(restore(form, model).split())
            if any(c in PARTS for c in form):  # as one word, too
                out.add(restore(form, model, ends=False))
        return frozenset(out - {""})

    remembered = lru_cache(65_536)(read)

    def words(text: str) -> set[str]:
        lower = text.lower()
        found = set(WORD.findall(lower))
        for m in SUSPECT.finditer(lower):
            found |= (remembered if len(m.group(0)) <= REMEMBER else read)(m.group(0))
        return found

    return words


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic) of at most `sample` rows of each class, and the rows of each class."""
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = lambda y: known.filter(F.col("toxic") == y).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    return first(0).union(first(1)), sizes


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE, most: int = FEATURES) -> tuple[dict[str, float], float]:
    """Weights of features and the intercept."""
    rows, sizes = training_rows(docs, labels, sample)
    total = sum(sizes.values())
    rate = (sizes.get(1, 0) + 0.5) / (total + 1)
    if len(sizes) < 2:
        return {}, math.log(rate / (1 - rate))

    # both sides of the join are bounded by the sample
    sampled = docs.join(F.broadcast(rows), "doc_id").select("text", "toxic")

    def spread(batches):
        words = reader(model)
        for batch in batches:
            for text, toxic in zip(batch[0], batch[1], strict=True):
                found = sorted({f for w in words(text.as_py() or "") for f in features(w)})
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic.as_py()] * n, pa.int32())], ["feature", "toxic"])

    classes = {r["toxic"]: r["n"] for r in sampled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return {}, math.log(rate / (1 - rate))
    negative, positive = classes[0], classes[1]
    seen = common.map_arrow(sampled, spread, "feature string, toxic int").groupBy("feature").agg(F.sum("toxic").alias("p"), F.count(F.lit(1)).alias("n"))
    apart = F.abs(F.log((F.col("p") + 0.5) / (positive + 1)) - F.log((F.col("n") - F.col("p") + 0.5) / (negative + 1))) * F.sqrt("n")
    strong = seen.filter("n >= 3").withColumn("apart", apart).filter("apart >= 4").orderBy(F.desc("apart"), "feature").limit(most)
    chosen = [r["feature"] for r in strong.select("feature").collect()]
    number = {f: i for i, f in enumerate(chosen)}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def read(batches):
        words = reader(model)
        for batch in batches:
            found = [sorted({shared.value[f] for w in words(t.as_py() or "") for f in features(w) if f in shared.value}) for t in batch[0]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch[1]], ["found", "toxic"])

    read_rows = common.map_arrow(sampled, read, "found array<int>, toxic int").toArrow()
    y = read_rows["toxic"].to_numpy().astype(float)
    lists = read_rows["found"].combine_chunks()
    which = lists.flatten().to_numpy()
    where = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    per_row = np.where(y > 0, sizes[1] / positive, sizes[0] / negative)
    per_row = per_row / per_row.mean()
    # gradient steps with a diagonal bound on the curvature
    w, bias = np.zeros(len(chosen)), math.log(rate / (1 - rate))
    width = np.maximum(1, np.bincount(where, minlength=len(y)))
    bound = np.bincount(which, weights=(per_row * (width + 1) / 4)[where], minlength=len(chosen)) + 0.5
    for _ in range(200):
        margin = bias + np.bincount(where, weights=w[which], minlength=len(y))
        wrong = per_row * (y - 1 / (1 + np.exp(-np.clip(margin, -40, 40))))
        w = w + 4 * (np.bincount(which, weights=wrong[where], minlength=len(chosen)) - 0.5 * w) / bound
        bias += wrong.sum() / (per_row * (width + 1) / 4).sum()
    return {f: float(v) for f, v in zip(chosen, w, strict=True)}, float(bias)


def score(docs: DataFrame, model: np.ndarray, weights: dict[str, float], bias: float) -> DataFrame:
    """All columns of docs and score, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))
    schema = docs.withColumn("score", F.lit(0.0)).schema
    place = docs.columns.index("text")

    def rate(batches):
        lattice, known = shared.value
        words = reader(lattice)
        hits = lru_cache(200_000)(lambda w: tuple(f for f in features(w) if f in known))
        for batch in batches:
            scores = []
            for text in batch[place]:
                found = set().union(*map(hits, words(text.as_py() or "")))
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, bias + sum(sorted(known[f] for f in found)))))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return common.map_arrow(docs, rate, schema)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    base = docs.drop("score")
    model = trigrams(base)
    return score(base, model, *fit(base.select("doc_id", "text"), labels, model, sample))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    out = scored(docs.select("doc_id", "text"), labels)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@common.apart
def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents scored 0.5 or more go."""
    return scored(docs, labels).filter("score < 0.5").select(*docs.columns)
