"""Line dedup with two Bloom filters: lines that many documents share stay in the last of these alone.

Each task sets the bits of the lines it sees in a filter for once-seen and, where it meets one again, in one for
twice-seen. Filters are exchanged by slices of the hash space and merged: a bit is set twice if it was set once in two
places. A line whose bits are all set in the second filter may repeat; any other occurs in one place and goes no
further. Only the hashes of suspects are shuffled, to be counted exactly and to find the document that keeps them.

The filter has about a bit for each eight bytes of text. Up to MOST_BITS it is sent to all tasks; beyond that, tasks
send the hashes they met once to the slices instead, which test them there. Likewise up to MOST_KEYS confirmed lines are
sent to all tasks, and more are joined to the documents. Hashes have 128 bits.

Defined results: a null or empty text is one empty line; a document is a row, so repeated rows count each and keep or
lose alike; a null doc_id comes before all others, and lines of documents with a null doc_id alone stay in all of them;
an empty table gives no rows; other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, DOCUMENTS = 40, 5
#: Bits of a filter that is sent to all tasks, and confirmed lines that are (24 bytes each).
MOST_BITS, MOST_KEYS = 1 << 28, 1 << 19
#: Bits of a slice of the filter as long as there are no more than MOST_SLICES.
SLICE, MOST_SLICES = 1 << 20, 1 << 16
#: Hashes that a task holds before it sends its filters on.
HELD = 1 << 20


def keys(raw: bytes, length: int) -> tuple[list[bytes], list[int | None]]:
    """Lines of a text, and the hash of the key of each that is long enough."""
    lines, out = raw.split(b"\n"), []
    for line in lines:
        key = line.strip().lower()  # of bytes: ASCII white space and A-Z alone
        long = len(key) >= length and (key.isascii() or len(key.decode()) >= length)
        out.append(xxhash.xxh3_128_intdigest(key) if long else None)
    return lines, out


def _halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), dtype=np.uint64).reshape(-1, 2)
    return both[:, 1], both[:, 0]


class Shape:
    """Slices of the filter, and where the bits of a hash stand in its slice."""

    def __init__(self, size: int):
        bits = max(SLICE, 1 << max(0, int(size) // 8 - 1).bit_length())
        self.slices = min(MOST_SLICES, bits // SLICE)
        self.width = bits // self.slices
        self.bits = bits

    def slice_of(self, high: np.ndarray) -> np.ndarray:
        shift = 64 - (self.slices.bit_length() - 1)
        return (high >> np.uint64(shift)).astype(np.int32) if shift < 64 else np.zeros(len(high), dtype=np.int32)

    def places(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(self.width - 1)
        return low & mask, (low >> np.uint64(32)) & mask

    def packed(self, places: np.ndarray) -> bytes:
        """Set bits as a list of places or as a map, whichever is shorter."""
        places = np.unique(places)
        if len(places) * 4 < self.width // 8 and self.width <= 1 << 32:
            return b"l" + places.astype(np.uint32).tobytes()
        bits = np.zeros(self.width, dtype=bool)
        bits[places] = True
        return b"m" + np.packbits(bits).tobytes()

    def unpacked(self, packed: bytes) -> np.ndarray:
        """Places of the set bits."""
        if packed[:1] == b"l":
            return np.frombuffer(packed, dtype=np.uint32, offset=1).astype(np.int64)
        return np.flatnonzero(np.unpackbits(np.frombuffer(packed, dtype=np.uint8, offset=1)))


def _by_slice(slices: np.ndarray):
    """(slice, rows) of sorted slices."""
    cuts = np.flatnonzero(np.diff(slices)) + 1
    for rows in np.split(np.arange(len(slices)), cuts) if len(slices) else ():
        yield int(slices[rows[0]]), rows


def filters(docs: DataFrame, shape: Shape, length: int = LENGTH) -> DataFrame:
    """(slice, bits): the twice-seen filter, in slices."""

    def read(batches):
        held: list[int] = []

        def sent():
            high, low = _halves(held)
            held.clear()
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            again = np.zeros(len(high), dtype=bool)
            again[1:] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
            first, second = shape.places(low)
            numbers, once, twice = [], [], []
            for number, rows in _by_slice(shape.slice_of(high)):
                numbers.append(number)
                once.append(shape.packed(np.concatenate([first[rows], second[rows]])))
                rows = rows[again[rows]]
                twice.append(shape.packed(np.concatenate([first[rows], second[rows]])) if len(rows) else None)
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["slice", "once", "twice"])

        for batch in batches:
            for text in batch.column(0):
                _, found = keys((text.as_py() or "").encode(), length)
                held.extend({h for h in found if h is not None})
                if len(held) >= HELD:
                    yield sent()
        if held:
            yield sent()

    def merge(batches):
        number, once, twice = None, None, None

        def merged():
            places = np.flatnonzero(twice)
            return pa.RecordBatch.from_arrays([pa.array([number] * bool(len(places)), pa.int32()), pa.array([shape.packed(places)] * bool(len(places)), pa.binary())], ["slice", "bits"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["slice"] != number:
                    if number is not None:
                        yield merged()
                    number, once, twice = row["slice"], np.zeros(shape.width, dtype=bool), np.zeros(shape.width, dtype=bool)
                places = shape.unpacked(row["once"])
                twice[places[once[places]]] = True
                once[places] = True
                if row["twice"] is not None:
                    twice[shape.unpacked(row["twice"])] = True
        if number is not None:
            yield merged()

    local = common.map_arrow(docs.select("text"), read, "slice int, once binary, twice binary")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return common.map_arrow(local.repartition(min(tasks, shape.slices), "slice").sortWithinPartitions("slice"), merge, "slice int, bits binary")


NAMES = ["high", "low", "doc_id", "t1", "t2"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
SUSPECT = "high long, low long, doc_id long, t1 long, t2 long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _met(batches, length: int, most: int):
    """(high, low, rows of doc_id, t1 and t2) of the different hashes of each document, many documents at a time."""
    held, owners = [], []
    for batch in batches:
        for doc_id, text, t1, t2 in zip(*(batch.column(i) for i in range(4)), strict=True):
            found = {h for h in keys((text.as_py() or "").encode(), length)[1] if h is not None}
            held.extend(found)
            owners.extend([(doc_id.as_py(), t1.as_py(), t2.as_py())] * len(found))
            if len(held) >= most:
                yield *_halves(held), owners
                held, owners = [], []
    if held:
        yield *_halves(held), owners


def _suspects(high, low, owners, chosen) -> pa.RecordBatch:
    rows = np.flatnonzero(chosen)
    three = [pa.array([owners[i][k] for i in rows], pa.int64()) for k in range(3)]
    return pa.RecordBatch.from_arrays([_signed(high[rows]), _signed(low[rows]), *three], NAMES)


def suspects(docs: DataFrame, twice: DataFrame, shape: Shape, length: int = LENGTH, most_bits: int = MOST_BITS) -> DataFrame:
    """(high, low, doc_id, t1, t2) of the lines whose bits are all set in the twice-seen filter; once for each document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2"))
    if shape.bits <= most_bits:  # one array of bits for all tasks
        bits = np.zeros(shape.bits // 8, dtype=np.uint8)
        for row in twice.toLocalIterator():
            start = row["slice"] * (shape.width // 8)
            part = np.zeros(shape.width, dtype=bool)
            part[shape.unpacked(bytes(row["bits"]))] = True
            bits[start : start + shape.width // 8] = np.packbits(part)
        sent = spark.sparkContext.broadcast(bits)

        def probe(batches):
            bits = sent.value
            for high, low, owners in _met(batches, length, 1 << 14):
                start = shape.slice_of(high).astype(np.uint64) * np.uint64(shape.width)
                chosen = np.ones(len(high), dtype=bool)
                for places in shape.places(low):
                    at = start + places
                    chosen &= (bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
                yield _suspects(high, low, owners, chosen)

        return common.map_arrow(docs, probe, SUSPECT)

    def offer(batches):
        """All hashes with their slices; those that a task meets again need no test."""
        for high, low, owners in _met(batches, length, HELD):
            order = np.lexsort((low, high))
            same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
            again = np.zeros(len(high), dtype=bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            batch = _suspects(high, low, owners, np.ones(len(high), dtype=bool))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shape.slice_of(high)), pa.array(again)], [*NAMES, "slice", "again"])

    offered = common.keep(common.map_arrow(docs, offer, SUSPECT + ", slice int, again boolean"), "offered")
    tests = twice.select("slice", *(F.lit(None).cast("long").alias(c) for c in NAMES), "bits")
    tests = tests.unionAll(offered.filter("not again").select("slice", *NAMES, F.lit(None).cast("binary").alias("bits")))
    tests = tests.repartition("slice").sortWithinPartitions("slice", F.col("bits").isNull())

    def test(batches):
        number, bits = None, None
        for batch in batches:
            slices = batch.column(0).to_numpy()
            chosen = np.zeros(len(slices), dtype=bool)
            low = batch.column(2).fill_null(0).to_numpy().view(np.uint64)
            for part, rows in _by_slice(slices):
                if part != number:
                    number, bits = part, np.zeros(shape.width, dtype=bool)
                if batch.column(6)[int(rows[0])].is_valid:  # a slice's filter comes first
                    bits[shape.unpacked(batch.column(6)[int(rows[0])].as_py())] = True
                    rows = rows[1:]
                first, second = shape.places(low[rows])
                chosen[rows] = bits[first] & bits[second]
            yield batch.filter(pa.array(chosen)).select(NAMES)

    return offered.filter("again").select(*NAMES).unionAll(common.map_arrow(tests, test, SUSPECT))


def confirmed(found: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(high, low, last) of the lines that so many documents hold, with the largest doc_id."""
    count = found.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
    return count.filter(F.col("n") >= documents).select("high", "low", "last")


def cut(raw: bytes, length: int, gone) -> tuple[int, int, bytes]:
    """Lines, lines dropped and the text that stays; gone: whether the hash of a line loses it."""
    lines, hashes = keys(raw, length)
    kept = [line for line, h in zip(lines, hashes, strict=True) if h is None or not gone(h)]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def dedup(docs: DataFrame, length: int = LENGTH, documents: int = DOCUMENTS, most_bits: int = MOST_BITS, most_keys: int = MOST_KEYS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left of each document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shape = Shape(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    twice = filters(docs, shape, length)
    found = common.keep(suspects(docs, twice, shape, length, most_bits), "suspects")
    lines = common.keep(confirmed(found, documents), "lines", free=False)
    schema, names = "doc_id long, n_lines long, n_dropped long, text string", ["doc_id", "n_lines", "n_dropped", "text"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, types, strict=True)], names)

    def few(last):
        def apply(batches):
            known = last.value
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                    doc_id = doc_id.as_py()
                    n, dropped, kept = cut(text.as_py().encode(), length, lambda h: known.get(h, doc_id) != doc_id)
                    rows.append((doc_id, n, dropped, kept.decode()))
                yield batch_of(rows)

        return apply

    def many(batches):
        for batch in batches:
            rows = []
            for doc_id, text, gone in zip(*(batch.column(i) for i in range(3)), strict=True):
                gone = {(g["high"] % 2**64) << 64 | g["low"] % 2**64 for g in gone.as_py() or []}
                n, dropped, kept = cut(text.as_py().encode(), length, gone.__contains__)
                rows.append((doc_id.as_py(), n, dropped, kept.decode()))
            yield batch_of(rows)

    if lines.count() <= most_keys:
        table = lines.toArrow()
        known = {(h % 2**64) << 64 | x % 2**64: last for h, x, last in zip(*(table[c].to_pylist() for c in ("high", "low", "last")), strict=True)}
        return common.map_arrow(docs, few(spark.sparkContext.broadcast(known)), schema)
    gone = found.join(lines, ["high", "low"]).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = gone.groupBy(F.col("doc_id").alias("d"), "t1", "t2").agg(F.collect_set(F.struct("high", "low")).alias("gone"))
    keyed = docs.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), "text")})
    joined = keyed.join(gone, (keyed["doc_id"].eqNullSafe(gone["d"])) & (keyed["t1"] == gone["t1"]) & (keyed["t2"] == gone["t2"]), "left")
    return common.map_arrow(joined.select(keyed["doc_id"], "text", "gone"), many, schema)


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM d),
keyed AS (
  SELECT r, doc_id, line, p, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM each),
rep AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY p) AS t, count(*) AS n
  FROM keyed LEFT JOIN rep USING (k) WHERE rep.k IS NULL OR keyed.doc_id IS NOT DISTINCT FROM rep.last GROUP BY r)
SELECT doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
