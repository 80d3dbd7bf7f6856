"""Suffix-array dedup: byte strings that start earlier, by a distributed merge sort of suffixes that knows common prefixes.

A sparse suffix array suffices: of the K-byte strings inside each LENGTH-byte window the one with the smallest hash is
its anchor, so equal windows have the same anchor at the same offset. Anchors that occur once are done. For the others a
suffix (from the anchor on, as far as its windows reach) is sorted with what stands before it at hand:

1. each task sorts runs of suffixes, settles those whose whole context it has seen earlier, and sends the rest
   front-coded (length of the prefix shared with the one before, then the rest) to ranges of first bytes;
2. each range merges its runs with a loser tree, whose matches start behind prefixes already known to be equal;
3. the merged common prefix lengths cut the suffixes into blocks that agree from the anchor on; windows of one block
   and offset with equal bytes before the anchor are equal, and all but the earliest are removed.

Earlier is a smaller doc_id (null last) or, in one document, an earlier start. Texts that occur as a whole with a smaller
doc_id are removed entirely if they have LENGTH bytes.

Defined results: a null text is an empty one; texts shorter than LENGTH lose nothing; rows with equal doc_id and text are
one document and get equal results; an empty table gives no rows; other columns are left alone.
"""

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, grams

LENGTH, K = 100, 32
#: Suffixes of one sorted run.
RUN = 40_000
LAST = 2**63 - 1  # stands for a null doc_id in comparisons
_META = [("lcp", "u1"), ("right", "u1"), ("left", "u1"), ("low", "u1"), ("doc", "<i8"), ("at", "<i8"), ("row", "<i8")]


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(h, k1, at) of all anchors."""
    width = length - k + 1

    def read(batches):
        seen: set[tuple[int, int]] = set()  # of one task; further copies of a text add nothing
        for batch in batches:
            copies = list(zip(batch[1].to_pylist(), batch[2].to_pylist(), strict=True))
            fresh = [i for i, c in enumerate(copies) if c not in seen and not seen.add(c)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            keys = batch[1].to_numpy(zero_copy_only=False)
            for first, data, offsets in grams.groups(batch[0]):
                n = len(data) - length + 1
                if n <= 0:
                    continue
                h = grams.window_hashes(grams.prefix(grams.byte_values(data), grams.BYTE_BASE), grams.BYTE_BASE, k)
                _, chosen = grams.minima(h, width, grams.inside(offsets, n, length))
                at = np.flatnonzero(chosen)
                doc = np.searchsorted(offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(keys[first + doc]), pa.array((at - offsets[doc]).astype(np.int32))], ["h", "k1", "at"]
                )

    return common.map_arrow(docs.select("text", "k1", "k2"), read, "h long, k1 long, at int")


def repeated_anchors(base: DataFrame, length: int, k: int) -> DataFrame:
    """(k1, places) of anchors that occur more than once, written before texts are shuffled."""
    found = anchors(base, length, k)
    twice = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    return common.keep(found.join(twice, "h", "left_semi").groupBy("k1").agg(F.collect_set("at").alias("places")), "places")


def settle(docs: DataFrame, length: int, k: int) -> DataFrame:
    """Documents with their result or, where suffixes have to be sorted, with text and repeated anchors (open)."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("second"), "text")})
    places = repeated_anchors(base, length, k)
    common.sweep(docs.sparkSession)
    order = F.coalesce("doc_id", F.lit(LAST))
    copies = base.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).filter("n > 1")
    copies = copies.groupBy("k1").agg(F.collect_list(F.struct("k2", "first")).alias("copies"))
    joined = base.join(places.join(copies, "k1", "full"), "k1", "left").select("doc_id", "text", "k2", "places", "copies")

    def decide(batches):
        for batch in batches:
            out = [[] for _ in range(8)]
            for doc_id, text, k2, places, copies in zip(*(batch.column(i) for i in range(5)), strict=True):
                doc_id, raw, places = doc_id.as_py(), text.as_py().encode(), places.as_py() or []
                first = [c["first"] for c in copies.as_py() or [] if c["k2"] == k2.as_py()]
                later = first and first[0] < (LAST if doc_id is None else doc_id)
                if later and len(raw) >= length:
                    row = (doc_id, len(raw), len(raw), 1, hashlib.sha256(b"").hexdigest(), False)
                elif places and len(raw) >= length:
                    row = (doc_id, len(raw), None, None, None, True)
                else:
                    row = (doc_id, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), False)
                for column, value in zip(out, (*row, raw.decode() if row[5] else None, sorted(places) if row[5] else None), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.list_(pa.int32()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "open", "text", "places"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, open boolean, text string, places array<int>"
    settled = common.map_arrow(joined, decide, schema).withColumn("row", F.monotonically_increasing_id())
    return common.keep(settled, "suffixes")  # written, so that row numbers stay


def contexts(raw: bytes, places: list[int], length: int, k: int) -> list[tuple[bytes, bytes, int, int]]:
    """(right, left, at, low) of each repeated anchor with windows; they start at `low` to len(left) bytes before it."""
    data = np.frombuffer(raw, dtype=np.uint8)
    width = length - k + 1
    h = grams.window_hashes(grams.prefix(grams.byte_values(data), grams.BYTE_BASE), grams.BYTE_BASE, k)
    n = len(data) - length + 1
    least = grams.sliding(h, width, np.minimum)
    # the last place of the smallest hash: places count up, so the greatest of those that hold the minimum of the window
    known = np.full(len(h), grams.U(2**64 - 1))
    known[places] = h[places]
    starts = np.flatnonzero(grams.sliding(known, width, np.minimum) == least[:n])
    if not len(starts):
        return []
    marks = np.array(places)
    # candidates from the last mark of each window backwards, until the hash is the smallest
    at = np.searchsorted(marks, starts + width, "left") - 1
    wrong = np.flatnonzero(h[marks[at]] != least[starts])
    while len(wrong):
        at[wrong] -= 1
        wrong = wrong[h[marks[at[wrong]]] != least[starts[wrong]]]
    anchor = marks[at]
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    ends = np.concatenate([cut[1:], [len(starts)]]) - 1
    return [
        (raw[p : last + length], raw[first:p], int(p), int(p - last))
        for p, first, last in zip(anchor[cut].tolist(), starts[cut].tolist(), starts[ends].tolist(), strict=True)
    ]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings of which so much is known to be equal."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (differ.bit_length() + 7) // 8


def encode(run: list[tuple]) -> bytes:
    """A sorted run of (right, left, doc, at, low, row), front-coded."""
    meta = np.zeros(len(run), dtype=_META)
    tails, before = [], b""
    lcps = []
    for x in run:
        lcps.append(common_prefix(before, x[0]))
        tails.append(x[0][lcps[-1] :])
        before = x[0]
    meta["lcp"] = lcps
    for name, values in (("right", (len(x[0]) for x in run)), ("left", (len(x[1]) for x in run)), ("doc", (x[2] for x in run)), ("at", (x[3] for x in run)), ("low", (x[4] for x in run)), ("row", (x[5] for x in run))):
        meta[name] = list(values)
    return struct.pack("<q", len(run)) + meta.tobytes() + b"".join(tails) + b"".join(x[1] for x in run)


def decode(blob: bytes) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    (n,) = struct.unpack_from("<q", blob)
    meta = np.frombuffer(blob, dtype=_META, count=n, offset=8)
    at, before, rights, lefts = 8 + meta.nbytes, b"", [], []
    for lcp, size in zip(meta["lcp"].tolist(), meta["right"].tolist(), strict=True):
        before = before[:lcp] + blob[at : at + size - lcp]
        at += size - lcp
        rights.append(before)
    for size in meta["left"].tolist():
        lefts.append(blob[at : at + size])
        at += size
    return meta, rights, lefts


def merge(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Order of all strings as (run, index), and the common prefix length of each with the one before.

    A loser tree: each node keeps the loser of its match and how much it shares with the winner. Who shares more with
    the last string put out comes first; only of equals bytes are compared, from where they are known to agree.
    """
    width = 1
    while width < max(1, len(runs)):
        width *= 2
    heads = [0] * len(runs)
    tree: list = [None] * width  # losers: (run, common prefix with the winner that passed)

    def match(a, b):
        """Winner and loser of two heads with their common prefixes with the last string put out."""
        if a is None or b is None:
            return (a, b) if b is None else (b, a)
        (i, m), (j, n) = a, b
        if m != n:
            return (a, b) if m > n else (b, a)
        x, y = runs[i][1][heads[i]], runs[j][1][heads[j]]
        same = common_prefix(x, y, m)
        first = len(x) <= len(y) if same == min(len(x), len(y)) else x[same] < y[same]
        return ((i, m), (j, same)) if first else ((j, n), (i, same))

    def build(node):
        if node >= width:
            i = node - width
            return (i, 0) if i < len(runs) and runs[i][1] else None
        winner, tree[node] = match(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    order, lcps = [], []
    while winner is not None:
        i, shared = winner
        order.append((i, heads[i]))
        lcps.append(shared)
        heads[i] += 1
        winner = (i, runs[i][0][heads[i]]) if heads[i] < len(runs[i][1]) else None
        node = (i + width) // 2
        while node:
            winner, tree[node] = match(winner, tree[node])
            node //= 2
    return order, lcps


def earlier(meta: np.ndarray, lcps: np.ndarray, lefts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in order, the windows (bits by offset before the anchor, 64 and further ones) that start earlier."""
    n, deepest = len(meta), int(meta["left"].max(initial=0))
    # a row for each distance from the anchor; made from whole strings, as single columns of a wide table cost a miss a byte
    padded = b"".join([left[::-1].ljust(deepest, b"\0") for left in lefts])
    before = np.ascontiguousarray(np.frombuffer(padded, dtype=np.uint8).reshape(n, deepest).T) if padded else np.zeros((deepest, n), dtype=np.uint8)
    rank = np.zeros(n, dtype=np.int64)
    by = np.lexsort((meta["at"], meta["doc"]))
    new = (np.diff(meta["at"][by]) != 0) | (np.diff(meta["doc"][by]) != 0)
    rank[by] = np.concatenate([[0], np.cumsum(new)])
    bits = np.zeros((2, n), dtype=np.uint64)
    sums, power = np.zeros(n, dtype=np.uint64), 1
    for offset in range(deepest + 1):
        if offset:
            power = power * grams.BYTE_BASE % 2**64
            sums = sums + grams.byte_values(before[offset - 1]) * grams.U(power)
        here = np.flatnonzero((meta["low"] <= offset) & (meta["left"] >= offset))
        if len(here) < 2:
            continue
        block, left = np.cumsum(lcps < length - offset)[here], grams.mix(sums[here])
        by = np.lexsort((rank[here], left, block))
        same = (block[by][1:] == block[by][:-1]) & (left[by][1:] == left[by][:-1])
        start = np.maximum.accumulate(np.where(np.concatenate([[False], same]), 0, np.arange(len(by))))
        later = here[by[rank[here][by] > rank[here][by][start]]]
        bits[offset // 64, later] |= grams.U(1) << grams.U(offset % 64)
    return bits[0], bits[1]


def _masks(low: int, high: int) -> tuple[int, int]:
    every = (1 << (high + 1)) - (1 << low)
    return every & (2**64 - 1), every >> 64


def _found(rows, at, m0, m1):
    arrays = [pa.array(np.asarray(rows, dtype=np.int64)), pa.array(np.asarray(at, dtype=np.int64)), pa.array(np.asarray(m0, dtype=np.uint64).view(np.int64)), pa.array(np.asarray(m1, dtype=np.uint64).view(np.int64))]
    return arrays


def ranges(rows: DataFrame, length: int, k: int, parts: int) -> list[bytes]:
    """First bytes that part the suffixes into ranges, from about 100 anchors for each, picked by hash."""
    total = rows.agg(F.sum(F.size("places"))).first()[0] or 0
    limit = int(min(1.0, 100 * parts / max(1, total)) * (2**64 - 1))

    def pick(batches):
        for batch in batches:
            out = set()
            for text, places in zip(batch[0], batch[1], strict=True):
                raw = text.as_py().encode()
                for p in places.as_py():
                    first = raw[p : p + k]
                    if int.from_bytes(hashlib.blake2b(first, digest_size=8).digest()) <= limit:
                        out.add(first)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.binary())], ["first"])

    seen = sorted(bytes(r["first"]) for r in common.map_arrow(rows.select("text", "places"), pick, "first binary").distinct().collect())
    return [seen[len(seen) * i // parts] for i in range(1, parts)] if seen else []


def duplicates(settled: DataFrame, length: int, k: int) -> DataFrame:
    """(row, found): windows of open documents that start earlier, as anchors and bits of offsets."""
    spark = settled.sparkSession
    rows = settled.filter("open").select("text", "places", "doc_id", "row")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ranges(rows, length, k, parts)

    def runs(batches):
        from bisect import bisect_right

        held: list[tuple] = []

        def flush():
            held.sort(key=lambda x: (x[0], x[1], x[2], x[3]))
            send: dict[int, list] = {}
            settled_here: list[tuple] = []
            kept = None
            for x in held:
                if kept is not None and x[0] == kept[0] and x[1] == kept[1] and x[4] == kept[4]:
                    if (x[2], x[3]) > (kept[2], kept[3]):
                        settled_here.append((x[5], x[3], *_masks(x[4], len(x[1]))))
                        continue
                else:
                    kept = x
                send.setdefault(bisect_right(cuts, x[0][:k]), []).append(x)
            held.clear()
            parts_out = sorted(send)
            blobs = [encode(send[p]) for p in parts_out]
            n = len(settled_here)
            columns = _found(*(zip(*settled_here, strict=True) if n else ([],) * 4))
            nothing = pa.array([None] * len(blobs), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*parts_out, *[None] * n], pa.int32()), pa.array([*blobs, *[None] * n], pa.binary()), *[pa.concat_arrays([nothing, c]) for c in columns]],
                ["part", "run", "row", "at", "m0", "m1"],
            )

        for batch in batches:
            for text, places, doc_id, row in zip(*(batch.column(i) for i in range(4)), strict=True):
                doc = LAST if doc_id.as_py() is None else doc_id.as_py()
                for right, left, at, low in contexts(text.as_py().encode(), places.as_py(), length, k):
                    held.append((right, left, doc, at, low, row.as_py()))
                    if len(held) >= RUN:
                        yield from flush()
        if held:
            yield from flush()

    sent = common.keep(common.map_arrow(rows, runs, "part int, run binary, row long, at long, m0 long, m1 long"), "runs")

    common.sweep(spark)

    def merged(batches):
        parts_seen: dict[int, list] = {}
        for batch in batches:
            for part, run in zip(batch[0].to_pylist(), batch[1], strict=True):
                parts_seen.setdefault(part, []).append(run.as_py())
        for blobs in (parts_seen.pop(p) for p in sorted(parts_seen)):
            decoded = [decode(b) for b in blobs]
            order, lcps = merge([(m["lcp"].tolist(), rights) for m, rights, _ in decoded])
            starts = np.cumsum([0, *(len(m) for m, _, _ in decoded)]).tolist()
            meta = np.concatenate([m for m, _, _ in decoded])[[starts[i] + j for i, j in order]]
            m0, m1 = earlier(meta, np.array(lcps), [decoded[i][2][j] for i, j in order], length)
            hit = np.flatnonzero((m0 | m1) != 0)
            yield pa.RecordBatch.from_arrays(_found(meta["row"][hit], meta["at"][hit], m0[hit], m1[hit]), ["row", "at", "m0", "m1"])

    schema = "row long, at long, m0 long, m1 long"
    far = common.map_arrow(sent.filter("part is not null").select("part", "run").repartition(max(1, parts), "part"), merged, schema)
    near = sent.filter("part is null").select("row", "at", "m0", "m1")
    return near.unionByName(far).groupBy("row").agg(F.collect_list(F.struct("at", "m0", "m1")).alias("found"))


def covered(n: int, at: np.ndarray, marks: np.ndarray, length: int) -> np.ndarray:
    """Which bytes lie in a window that starts earlier elsewhere; bit i of the marks of a place: the one i bytes before it."""
    rows, before = np.nonzero(np.unpackbits(marks.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little"))
    starts = at[rows] - before
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def dedup(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document. Windows have at most 127 bytes before an anchor."""
    settled = settle(docs, length, k)
    common.sweep(docs.sparkSession)
    rest = settled.filter("open").select("doc_id", "text", "row").join(duplicates(settled, length, k), "row", "left")

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            lists = batch.column(2)
            ends, (at, m0, m1) = lists.offsets.to_numpy(), (lists.values.field(c).to_numpy() for c in ("at", "m0", "m1"))
            marks = np.stack([m0, m1], axis=1)
            for i, (doc_id, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                raw, part = text.as_py().encode(), slice(ends[i], ends[i + 1])
                gone = covered(len(raw), at[part], marks[part], length)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                for column, value in zip(out, (doc_id.as_py(), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rest = common.map_arrow(rest.select("doc_id", "text", "found"), cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return settled.filter("not open").select(*names).unionByName(rest)


digest = dedup
