"""Substring dedup by level-wise doubling: windows of words that start at more than one place.

Level one takes windows of half the length. Of the half windows in each full window the one with the smallest hash is
looked at, so equal full windows look at the same one; those that occur once are done. Only windows around a half window
that repeats are extended to twice that length and counted again: one doubling, and the result is whole. Counting is a partial sum in each task before the shuffle; positions go back to their documents alone.

Texts that occur as a whole more than once need no windows; one of them lends its windows to the others. Hashes of
windows have 96 bits.

Defined results: a null text has no words; texts with fewer words than a window lose nothing; repeated rows are copies of
each other; an empty table gives no rows; other columns are left alone.
"""

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, grams

LENGTH = 35
_SALT = grams.U(0x5851F42D4C957F2D)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def half_windows(docs: DataFrame, length: int) -> DataFrame:
    """(h, k1, k2, at): hashes and places of the half windows that are looked at; k1 and k2 tell the text."""
    half = (length + 1) // 2
    width = length - half + 1

    def read(batches):
        seen: set[tuple[int, int]] = set()  # of one task; further copies of a text add nothing
        for batch in batches:
            copies = list(zip(batch[1].to_pylist(), batch[2].to_pylist(), strict=True))
            fresh = [i for i, c in enumerate(copies) if c not in seen and not seen.add(c)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            keys, others = (batch[i].to_numpy(zero_copy_only=False) for i in (1, 2))
            for first, data, offsets in grams.groups(batch[0]):
                hashes, words = grams.word_hashes(data, offsets)
                h = grams.window_hashes(grams.prefix(hashes, grams.WORD_BASE), grams.WORD_BASE, half)
                n = len(hashes) - length + 1
                if n <= 0:
                    continue
                _, chosen = grams.minima(h, width, grams.inside(words, n, length))
                at = np.flatnonzero(chosen)
                doc = np.searchsorted(words, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(h[at])), pa.array(keys[first + doc]), pa.array(others[first + doc]), pa.array((at - words[doc]).astype(np.int32))],
                    ["h", "k1", "k2", "at"],
                )

    return common.map_arrow(docs.select("text", "k1", "k2"), read, "h long, k1 long, k2 long, at int")


def _candidates(text: bytes, places: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows around half windows that repeat, and 96 bits of their hashes."""
    half = (length + 1) // 2
    data = np.frombuffer(text, dtype=np.uint8)
    hashes, words = grams.word_hashes(data, np.array([0, len(data)]))
    sums = grams.prefix(hashes, grams.WORD_BASE)
    h = grams.window_hashes(sums, grams.WORD_BASE, half)
    n = len(hashes) - length + 1
    least, _ = grams.minima(h, length - half + 1, np.ones(n, dtype=bool))
    known = np.full(len(h), grams.U(2**64 - 1))
    known[places] = h[places]
    starts = np.flatnonzero(grams.sliding(known, length - half + 1, np.minimum) == least)
    other = grams.prefix(grams.mix(hashes ^ _SALT), grams.BYTE_BASE)
    return (
        starts.astype(np.int32),
        _signed(grams.window_hashes(sums, grams.WORD_BASE, length)[starts]),
        (grams.window_hashes(other, grams.BYTE_BASE, length)[starts] >> grams.U(32)).astype(np.uint32).view(np.int32),
    )


def _sha(words) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def settle(docs: DataFrame, length: int) -> DataFrame:
    """Documents with their result, or, where windows have to be counted, with their text and candidates.

    `open`: 0 the result is known; 1 it is, but the text lends its windows; 2 it is not.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("second"), "text")})
    # both written, so that the join is of two plain tables, whose hot hashes Spark may split
    halves = common.keep(half_windows(base, length), "halves")
    twice = common.keep(halves.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "twice", free=False)
    key = ["k1", "k2"]
    places = halves.join(twice, "h", "left_semi").groupBy(*key).agg(F.collect_set("at").alias("places"))
    copies = base.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.struct(F.min("doc_id").alias("doc_id")).alias("first")).filter("n > 1").drop("n")
    joined = base.join(places.join(copies, key, "full"), key, "left").select("doc_id", "text", "places", "first")

    def decide(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, text, places, first in zip(*(batch.column(i) for i in range(4)), strict=True):
                doc_id, raw, places = doc_id.as_py(), text.as_py().encode(), places.as_py() or []
                words = raw.split()
                first = first.as_py()
                if first and len(words) >= length:
                    lends = bool(places) and first["doc_id"] == doc_id
                    row = (doc_id, len(words), len(words), _sha([]), int(lends))
                elif places and len(words) >= length:
                    row = (doc_id, len(words), None, None, 2)
                else:
                    row = (doc_id, len(words), 0, _sha(words), 0)
                for column, value in zip(out, (*row, raw.decode() if row[4] else None, sorted(places) if row[4] else None), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int32()))
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "open", "text", "places"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, open int, text string, places array<int>"
    settled = common.map_arrow(joined, decide, schema).withColumn("row", F.monotonically_increasing_id())
    settled = common.keep(settled, "repeats")  # written, so that row numbers stay
    for done in (halves, twice):
        common.drop_kept(done)
    return settled


def windows(settled: DataFrame, length: int) -> DataFrame:
    """(h, g, row, at) of candidate windows; row is null for those that are lent."""

    def read(batches):
        for batch in batches:
            for row, state, text, places in zip(*(batch.column(i) for i in range(4)), strict=True):
                at, h, g = _candidates(text.as_py().encode(), places.as_py(), length)
                rows = pa.array(np.full(len(at), row.as_py()), mask=np.full(len(at), state.as_py() == 1))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), rows, pa.array(at)], ["h", "g", "row", "at"])

    rows = settled.filter("open > 0").select("row", "open", "text", "places")
    return common.map_arrow(rows, read, "h long, g int, row long, at int")


def repeated(settled: DataFrame, length: int) -> DataFrame:
    """(row, starts) of the windows that start at more than one place."""
    found = common.keep(windows(settled, length), "windows")
    # a lent window stands for at least two places
    count = found.groupBy("h", "g").agg(F.sum(F.when(F.col("row").isNull(), 2).otherwise(1)).alias("n"))
    twice = common.keep(count.filter("n > 1").select("h", "g"), "twice", free=False)
    return found.filter("row is not null").join(twice, ["h", "g"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("starts"))


def covered(n: int, starts, length: int) -> np.ndarray:
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, np.asarray(starts, dtype=np.int64), 1)
    np.add.at(change, np.asarray(starts, dtype=np.int64) + length, -1)
    return np.cumsum(change[:n]) > 0


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each document."""
    settled = settle(docs, length)
    common.sweep(docs.sparkSession)
    rest = settled.filter("open = 2").select("doc_id", "n_words", "text", "row").join(repeated(settled, length), "row", "left")

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(4)]
            for doc_id, n, text, starts in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = text.as_py().encode().split()
                gone = covered(len(words), starts.as_py() or [], length)
                for column, value in zip(out, (doc_id.as_py(), n.as_py(), int(gone.sum()), _sha(compress(words, ~gone))), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rest = common.map_arrow(rest.select("doc_id", "n_words", "text", "starts"), cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return settled.filter("open < 2").select(*names).unionByName(rest)


def longest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(length, windows): how many starts repeat at the length, twice the length and so on until none does.

    A helper that no query uses: each length is counted from the start, and texts that exist as whole copies are left out.
    """
    spark, out = docs.sparkSession, []
    while True:
        n = repeated(settle(docs, length), length).agg(F.sum(F.size("starts"))).first()[0] or 0
        if not n:
            return spark.createDataFrame(out, "length int, windows long")
        out.append((length, n))
        length *= 2


digest = dedup


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM starts),
rep AS (SELECT r, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
cov AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM rep),
each AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
         FROM each e WHERE NOT EXISTS (SELECT 1 FROM cov c WHERE c.r = e.r AND c.p = e.p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
