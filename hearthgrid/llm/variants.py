"""Spelling variant grouping by pivotal grams: words that differ by one code point, found without comparing all pairs.

All bigrams have one order, rare ones first. The prefix of a word is its bigrams up to the third smallest, ties included;
its pivots are the two disjoint bigrams of the prefix that are rarest together, chosen by dynamic programming. One edit
breaks at most one of two disjoint bigrams, so of two near words, the one whose prefix ends first has a pivot that stands
in the other's prefix. The edit lies to one side of that bigram, so the words agree from the bigram to the end on its
other side: that side with the bigram, and the other word's length, are the position limits that pivots are indexed by.
Pairs that meet are verified: by the characters they have, then by their distance.

Runs are counted in each task before the shuffle, at most HELD different ones at a time; the bigrams number some
thousands (two letters of 90), the forms of a word are followed by doubling, and their chains are short, as each is
RATIO times as frequent as the one before.

Defined results: null and empty texts have no runs; a null doc_id is written as nothing in what is hashed; repeated rows
count again; a word that is near nothing is its own root; an empty table gives no rows; other columns are not read.
"""

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One in so many different runs of a document loses a code point.
EVERY = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: Different words that a task counts before it sends their counts on.
HELD = 1 << 17
#: Bigrams that a prefix has at least, and pivots; for one edit.
PREFIX, PIVOTS = 3, 2


def thinned(run: str, doc_id: int | None) -> str:
    """The lower-cased run as it stands in the document: without one of its code points where the hash says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts with so many code points and occurrences at least."""

    def read(batches):
        held: Counter = Counter()

        def sent():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id, text = doc_id.as_py(), text.as_py()
                for run, n in Counter(RUN.findall((text or "").encode().lower().decode())).items():
                    if len(run) >= length and len(word := thinned(run, doc_id)) >= length:
                        held[word] += n
                if len(held) >= HELD:
                    yield sent()
        yield sent()

    found = common.map_arrow(docs.select("doc_id", "text"), read, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def pivots(grams: list[tuple[int, int]], frequency: list[int]) -> list[int]:
    """Places of PIVOTS disjoint bigrams with the smallest sum of frequencies; grams: (order, place), by place.

    best[k] is the smallest sum of k disjoint bigrams among those seen; the last of them has to end before the next.
    """
    far = (math.inf, ())
    best: list[list[tuple]] = []  # for each bigram, for each k
    for i, (order, place) in enumerate(grams):
        free = next((best[j] for j in range(i - 1, -1, -1) if grams[j][1] <= place - 2), [(0, ())] + [far] * PIVOTS)
        before = best[-1] if best else [(0, ())] + [far] * PIVOTS
        took = [far] + [(free[k][0] + frequency[order], (*free[k][1], place)) for k in range(PIVOTS)]
        best.append([min(a, b) for a, b in zip(before, took, strict=True)])
    return list(best[-1][PIVOTS][1])


def prefix(word: str, orders: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """(order, place) of the bigrams up to the PREFIX-th smallest, by place, and that one's order."""
    grams = [(orders[word[i : i + 2]], i) for i in range(len(word) - 1)]
    last = sorted(grams)[PREFIX - 1][0]
    return [g for g in grams if g[0] <= last], last


def index(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, reach, letters, last, word, n) of all pivots, and of all bigrams of prefixes.

    A pivot's keys name the lengths that a near word can have, so that both sides meet by equality.
    """
    places = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    grams = words.select("word", places.alias("at")).select(F.substring("word", F.col("at"), F.lit(2)).alias("gram"))
    counted = sorted((r["n"], r["gram"]) for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())  # two letters of 90
    orders, frequency = {gram: i for i, (_, gram) in enumerate(counted)}, [n for n, _ in counted]
    names = ["key", "reach", "letters", "last", "word", "n"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64()]

    def entries(pivotal: bool):
        def read(batches):
            for batch in batches:
                out = [[] for _ in names]
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    grams, last = prefix(word, orders)
                    letters = 0
                    for c in word:
                        letters |= 1 << (ord(c) * 11 & 63)
                    letters -= (letters >> 63) << 64
                    places = pivots(grams, frequency) if pivotal else [at for _, at in grams]
                    for at in places:
                        for key in ("<" + word[: at + 2], ">" + word[at:]):
                            for reach in (-1, 0, 1) if pivotal else (0,):
                                for column, value in zip(out, (key, len(word) + reach, letters, last, word, n), strict=True):
                                    column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

        return read

    schema = "key string, reach int, letters long, last int, word string, n long"
    return common.map_arrow(words, entries(True), schema), common.map_arrow(words, entries(False), schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, m): all ordered pairs of words that are one inserted, deleted or replaced code point apart."""
    pivot, gram = index(words)
    gram = gram.select("key", "reach", *(F.col(c).alias(f"g_{c}") for c in ("letters", "last", "word", "n")))
    met = pivot.join(
        gram,
        (pivot["key"] == gram["key"])
        & (pivot["reach"] == gram["reach"])
        & (pivot["last"] <= gram["g_last"])
        & (F.bit_count(pivot["letters"].bitwiseXOR(gram["g_letters"])) <= 2)  # one edit adds one letter and takes one
        & (pivot["word"] != gram["g_word"])
        & (F.levenshtein(pivot["word"], gram["g_word"], 1) == 1),
    ).select("word", "n", F.col("g_word").alias("other"), F.col("g_n").alias("m"))
    return met.unionAll(met.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m"))).distinct()


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root) where forms lead, from (word, form) with chains of at most `longest` forms."""
    known = common.keep(forms.select("word", F.col("form").alias("root")), "roots", free=False)
    for _ in range(math.ceil(math.log2(max(1, longest)))):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = common.keep(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots", free=False)
        common.drop_kept(known)
        known = following
    return known


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words, given as (word, n) with LEAST_LENGTH code points at least."""
    words = common.keep(words.select("word", "n"), "words", free=False)
    least, most = words.agg(F.min("n"), F.max("n")).first()
    longest = int(math.log(most / least, ratio)) + 1 if most else 1
    near = near_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("top")
    )
    near = common.keep(near.select("word", "n_near", F.when(-F.col("top.m") >= ratio * F.col("n"), F.struct(F.col("top.form").alias("form"), (-F.col("top.m")).alias("n"))).alias("top")), "near", free=False)
    root = roots(near.filter("top is not null").select("word", "top.form"), longest)
    return words.join(near, "word", "left").join(root, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("top.form").alias("form"), F.col("top.n").alias("form_n"), F.coalesce("root", "word").alias("root")
    )


def digest(docs: DataFrame) -> DataFrame:
    return variants(vocabulary(docs))


SQL = r"""
WITH RECURSIVE step(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, xor(v >> 1, (v & 1) * 3988292384), k + 1 FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents WHERE text IS NOT NULL),
low AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM d),
runs AS (SELECT id, run, count(*) AS n FROM low GROUP BY id, run HAVING length(run) >= 6),
bytes AS (
  SELECT id, run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)) AS b
  FROM runs),
crc AS (
  SELECT id, run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]))) AS h
  FROM bytes, tab),
word AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM crc),
w AS (SELECT word, sum(n)::BIGINT AS n FROM word WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gone AS (
  SELECT word, n, word AS part FROM w
  UNION SELECT word, n, left(word, i) || substr(word, i + 2) FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
pair AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m
  FROM gone a JOIN gone b ON a.part = b.part AND a.word <> b.word
  WHERE (length(a.word) <> length(b.word) OR len(list_filter(list_zip(string_split(a.word, ''), string_split(b.word, '')), lambda z: z[1] <> z[2])) = 1)),
best AS (SELECT word, n, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS m FROM pair GROUP BY word, n),
near AS (SELECT word, n_near, CASE WHEN m >= 5 * n THEN form END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM best),
chain(word, top) AS (SELECT word, word FROM w UNION ALL SELECT chain.word, near.form FROM chain JOIN near ON chain.top = near.word WHERE near.form IS NOT NULL),
root AS (SELECT chain.word, chain.top AS root FROM chain LEFT JOIN near ON chain.top = near.word WHERE near.form IS NULL)
SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form, form_n::BIGINT AS form_n, root
FROM w LEFT JOIN near USING (word) JOIN root USING (word)
"""
