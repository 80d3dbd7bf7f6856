"""N-gram Jaccard join: chosen-path recursion over sets of five-word shingles.

A set is embedded as T minhash values, tokens drawn from the set itself. A node of the recursion samples coordinates
(1.25 on average, one over the threshold) and sends each set on to the child that its tokens there name; two similar sets
go on together with the probability of their similarity. Small buckets are compared by brute force, larger ones split
again, and what is still large at DEPTH is compared in tiles of bounded size. Runs repeat with other paths until the
estimated recall (from the links that met in one and in two leaves only) reaches its target; further runs add to those
before, whose pairs they leave alone.

Equal sets are one class from the start. A pair is compared in the first of its common leaves alone, by sketch and then
exactly, so links are counted once and never sent as pairs; only spanning links of each bucket leave a task.

Fewer than five words make one shingle of them all. Defined results: texts without words (null, empty, blank) link with
nothing and are classes of their own; repeated rows are copies of each other; an empty table gives no rows; other columns
are left alone. Sketches of up to SMALL * 1.25 shingles are true minhash, longer ones one-permutation minhash; sets
between the two sizes have both, so that every pair shares one kind.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, grams

WORDS, THRESHOLD = 5, 0.8
T, SMALL = 128, 256
RUNS, DEPTH, LIMIT, TILE = 10, 2, 512, 768
RECALL = 0.999
#: Equal 8-bit sketch values below which a pair can't reach the threshold (5.5 standard deviations below).
MARGIN = 5.5
LAST = 2**63 - 1
_MULTIPLY = np.random.default_rng(5).integers(1, 2**63, T, dtype=np.uint64) * grams.U(2) + grams.U(1)


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct shingle hashes of one text's word hashes, sorted."""
    if not len(hashes):
        return hashes
    sums = grams.prefix(hashes, grams.WORD_BASE)
    if len(hashes) < words:
        return grams.mix(sums[-1:] + grams.U(len(hashes)))
    return np.unique(grams.window_hashes(sums, grams.WORD_BASE, words))


def true_minhash(s: np.ndarray) -> np.ndarray:
    return ((s[:, None] * _MULTIPLY) >> grams.U(32)).min(0).astype(np.uint32)


def one_permutation(s: np.ndarray) -> np.ndarray:
    """Smallest hash of each of T ranges; empty ranges borrow from one that others with it empty borrow from too."""
    first = np.searchsorted(s, np.arange(T, dtype=np.uint64) << grams.U(57))
    last = np.append(first[1:], len(s))
    filled = last > first
    out = np.zeros(T, dtype=np.uint32)
    out[filled] = (grams.mix(s[first[filled]]) >> grams.U(32)).astype(np.uint32)
    turn, empty = 1, np.flatnonzero(~filled)
    while len(empty):
        donor = (grams.mix((empty * 1_000_003 + turn).astype(np.uint64)) >> grams.U(20)).astype(np.int64) % T
        found = filled[donor]
        out[empty[found]] = out[donor[found]]
        empty, turn = empty[~found], turn + 1
    return out


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, k1, size, f1, f2, small, large): size, fingerprints and sketches of each text's set."""

    def read(batches):
        for batch in batches:
            for first, data, offsets in grams.groups(batch[2]):
                hashes, ends = grams.word_hashes(data, offsets)
                out = [[] for _ in range(5)]
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    s = shingles(hashes[a:b], words)
                    row = (
                        len(s),
                        int(s.sum(dtype=np.uint64).view(np.int64)),
                        int(grams.mix(s + grams.U(len(s))).sum(dtype=np.uint64).view(np.int64)),
                        true_minhash(s).tobytes() if 0 < len(s) < SMALL * 1.25 else None,
                        one_permutation(s).tobytes() if len(s) >= SMALL else None,
                    )
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                n = len(offsets) - 1
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch[0].slice(first, n), batch[1].slice(first, n), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]],
                    ["doc_id", "k1", "size", "f1", "f2", "small", "large"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("k1"), "text")
    return common.map_arrow(rows, read, "doc_id long, k1 long, size long, f1 long, f2 long, small binary, large binary")


def _children(path: np.ndarray, sketch: np.ndarray) -> list[np.ndarray]:
    """Paths that sets with these sketches (rows) take from their nodes: one for each, a second for one node in four."""
    step = grams.mix(path + grams.U(0x632BE59BD9B4E019))
    out = []
    for shift in (8, 24):
        at = ((step >> grams.U(shift)) % grams.U(T)).astype(np.int64)
        token = sketch[np.arange(len(sketch)), at].astype(np.uint64)
        out.append(grams.mix(path ^ grams.mix((token << grams.U(8)) + at.astype(np.uint64) + grams.U(shift << 41))))
    return [out[0], np.where((step & grams.U(3)) == 0, out[1], grams.U(0))]


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype=np.uint32).reshape(-1, T)


def roots(sets: DataFrame, runs: range) -> DataFrame:
    """(path, id, kind): the first buckets of all runs. kind: 0 small sketches, 1 large ones."""

    def split(batches):
        for batch in batches:
            for kind in (0, 1):
                rows = batch.filter(batch[1 + kind].is_valid())
                if not rows.num_rows:
                    continue
                sketch, ids = _sketches(rows[1 + kind]), rows[0].to_numpy()
                for run in runs:
                    start = np.full(len(ids), int(grams.mix(np.array([run * 2 + kind + 1], dtype=np.uint64))[0]), dtype=np.uint64)
                    for path in _children(start, sketch):
                        on = path != 0
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(path[on].view(np.int64)), pa.array(ids[on]), pa.array(np.full(on.sum(), kind, dtype=np.int32))], ["path", "id", "kind"]
                        )

    return common.map_arrow(sets.select("id", "small", "large"), split, "path long, id long, kind int")


def deeper(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(path, id, kind): the children of nodes that are still large."""

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            path, ids, kind = batch[0].to_numpy().view(np.uint64), batch[1].to_numpy(), batch[2].to_numpy()
            for child in _children(path, _sketches(batch[3])):
                on = child != 0
                yield pa.RecordBatch.from_arrays([pa.array(child[on].view(np.int64)), pa.array(ids[on]), pa.array(kind[on])], ["path", "id", "kind"])

    sketch = F.when(F.col("kind") == 0, F.col("small")).otherwise(F.col("large"))
    rows = nodes.join(sets.select("id", "small", "large"), "id").select("path", "id", "kind", sketch.alias("sketch"))
    return common.map_arrow(rows, split, "path long, id long, kind int")


def leaves(sets: DataFrame, runs: range) -> DataFrame:
    """(path, id, kind, n): buckets of two sets or more, none larger than LIMIT but at DEPTH."""
    nodes, out = roots(sets, runs), None
    for depth in range(DEPTH + 1):
        nodes = common.keep(nodes, "nodes")
        counts = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        counted = common.keep(nodes.join(counts, "path"), "buckets")
        common.drop_kept(nodes)
        large = F.col("n") > (LIMIT if depth < DEPTH else LAST)
        done = counted.filter(~large)
        out = done if out is None else out.unionByName(done)
        nodes = counted.filter(large)
        if depth == DEPTH or nodes.isEmpty():
            return out
        nodes = deeper(nodes.drop("n"), sets)


def tiles(leaf: DataFrame) -> DataFrame:
    """(tile, side, path, id, kind, n): large leaves cut into blocks, each two blocks a tile; side tells the block."""
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    block = F.pmod(F.xxhash64("id", "path"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    cut = leaf.withColumns({"_blocks": blocks, "_block": block}).withColumn("_other", other)
    first, second = F.least("_block", "_other"), F.greatest("_block", "_other")
    side = F.when(F.col("_block") == F.col("_other"), 2).when(F.col("_block") < F.col("_other"), 0).otherwise(1)
    return cut.select(F.xxhash64("path", first, second).alias("tile"), side.alias("side"), "path", "id", "kind")


def _meetings(lists: list, before: int = LAST) -> np.ndarray:
    """How many leaves (of those below a path) each two sets share."""
    m = len(lists)
    flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists])
    row = np.repeat(np.arange(m), [len(x) for x in lists])
    row, flat = row[flat < before], flat[flat < before]
    ids, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    mark = np.zeros((m, int((n > 1).sum())), dtype=np.float32)
    pick = n[at] > 1
    mark[row[pick], (np.cumsum(n > 1) - 1)[at[pick]]] = 1
    return mark @ mark.T


def _owned(lists: list, path: int, side: np.ndarray) -> np.ndarray:
    """Pairs (upper half) that this leaf compares: it is the first they share, and they are of two blocks or of one tile's own."""
    owned = np.triu(np.ones((len(lists), len(lists)), dtype=bool), 1) & (_meetings(lists, path) == 0)
    return owned & ((side[:, None] != side[None, :]) | (side[:, None] == 2))


def _table(**columns):
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def near(tiled: DataFrame, places: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Rows of tiles that have a pair there which its sketches leave open; places are all leaves (id, path) so far."""
    least = T * threshold - MARGIN * math.sqrt(T * threshold * (1 - threshold))

    def compare(group):
        if group.num_rows > 1:
            sketch = np.frombuffer(b"".join(group["bits"].to_pylist()), dtype=np.uint8).reshape(-1, T)
            owned = _owned(group["leaves"].to_pylist(), group["path"][0].as_py(), group["side"].to_numpy())
            a, b = np.nonzero(owned)
            close = np.zeros(len(a), dtype=bool)
            for i in range(0, len(a), 1 << 15):
                part = slice(i, i + (1 << 15))
                close[part] = (sketch[a[part]] == sketch[b[part]]).sum(1) >= least
            hit = np.unique(np.concatenate([a[close], b[close]]))
            if len(hit):
                kept = group.select(["tile", "side", "path", "id", "leaves"]).take(pa.array(hit)).combine_chunks()
                yield from kept.to_batches()

    # a set's leaves: a few for each run, so the list is bounded
    lists = places.groupBy("id").agg(F.collect_list("path").alias("leaves"))
    with_bits = lists.join(sets.select("id", "small8", "large8"), "id")
    bits = F.when(F.col("kind") == 0, F.col("small8")).otherwise(F.col("large8"))
    rows = tiled.join(with_bits, "id").select("tile", "side", "path", "id", "leaves", bits.alias("bits"))
    return common.map_sorted(rows, "tile", compare, "tile long, side int, path long, id long, leaves array<long>")


def verify(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(what, a, b, n): links by exact comparison. what: 0 so many links of a, 1 a is linked with b (spanning), 2 pairs
    that met in one leaf, in two, and in all."""

    def compare(group):
        if group.num_rows < 2:
            return
        ids, weights = group["id"].to_numpy(), group["copies"].to_numpy()
        found = [np.frombuffer(x, dtype=np.uint64) for x in group["hashes"].to_pylist()]
        lists = group["leaves"].to_pylist()
        owned = _owned(lists, group["path"][0].as_py(), group["side"].to_numpy())
        sizes = np.array([len(x) for x in found])
        token, at, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        row, keep = np.repeat(np.arange(len(found)), sizes), n[at] > 1
        number = np.cumsum(n > 1) - 1
        row, column = row[keep], number[at[keep]]
        both = np.zeros((len(found), len(found)), dtype=np.float32 if sizes.max() < 1 << 24 else np.float64)  # whole numbers
        by = np.argsort(column, kind="stable")
        row, column = row[by], column[by]
        width = max(1, (1 << 22) // len(found))
        for start in range(0, int((n > 1).sum()), width):
            a, b = np.searchsorted(column, [start, start + width])
            mark = np.zeros((len(found), width), dtype=np.float32)
            mark[row[a:b], column[a:b] - start] = 1
            both += mark @ mark.T
            del mark
        i, j = np.nonzero(owned & (both > 0))
        shared = both[i, j].astype(np.float64)
        del both, owned
        close = shared >= threshold * (sizes[i] + sizes[j] - shared) - 1e-9
        i, j = i[close], j[close]
        if not len(i):
            return
        linked = np.zeros((len(found), len(found)), dtype=bool)
        linked[i, j] = True
        full = linked | linked.T
        links = full @ weights
        has = np.flatnonzero(links)
        met = _meetings(lists)[i, j]
        seen, edges = np.zeros(len(ids), dtype=bool), []
        for start in has.tolist():
            if seen[start]:
                continue
            seen[start], front = True, [start]
            while front:
                x = front.pop()
                for y in np.flatnonzero(full[x] & ~seen).tolist():
                    seen[y] = True
                    edges.append((ids[x], ids[y]))
                    front.append(y)
        a = [*ids[has].tolist(), *[int(x) for x, _ in edges], int((met == 1).sum())]
        b = [*[None] * len(has), *[int(y) for _, y in edges], int((met == 2).sum())]
        what = [*[0] * len(has), *[1] * len(edges), 2]
        count = [*links[has].tolist(), *[None] * len(edges), len(i)]
        yield _table(what=pa.array(what, pa.int32()), a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()), n=pa.array([x if x is None else int(x) for x in count], pa.int64()))

    full = rows.join(texts, "id").select("tile", "side", "path", "id", "leaves", "copies", "hashes")
    return common.map_sorted(full, "tile", compare, "what int, a long, b long, n long")


def hashes_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, copies, hashes): the sets of the wanted classes, from the text of their first document."""

    def read(batches):
        for batch in batches:
            out = []
            for _, data, offsets in grams.groups(batch[2]):
                hashes, ends = grams.word_hashes(data, offsets)
                out += [shingles(hashes[a:b], words).tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield _table(id=batch[0], copies=batch[1], hashes=pa.array(out, pa.binary()))

    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("first"), F.xxhash64("text").alias("k1"), "text")
    rows = keyed.join(wanted.select("id", "copies", "first", "k1"), ["first", "k1"]).select("id", "copies", "text")
    return common.map_arrow(rows, read, "id long, copies long, hashes binary").dropDuplicates(["id"])


def with_bytes(sets: DataFrame) -> DataFrame:
    """The low byte of each sketch value as small8 and large8, and a row number, written so that it stays."""

    def cut(batches):
        for batch in batches:
            low = []
            for name in ("small", "large"):
                column = batch.column(batch.schema.get_field_index(name))
                low.append(pa.array([None if x is None else np.frombuffer(x, dtype=np.uint32).astype(np.uint8).tobytes() for x in column.to_pylist()], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *low], [*batch.schema.names, "small8", "large8"])

    schema = sets.withColumns({c: F.lit(None).cast("binary") for c in ("small8", "large8")}).schema
    return common.keep(common.map_arrow(sets, cut, schema).withColumn("id", F.monotonically_increasing_id()), "sets")


def join(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, runs: int = RUNS) -> DataFrame:
    """One row per document: doc_id, k1 (hash of its text), class_id (first document with the same set), n_links (other
    documents linked directly), component_id (first document reachable), kept (it is that document)."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    everything = sketched(base, words)
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("first"), "k1")).alias("_first")
    grouped = everything.filter("size > 0").groupBy("size", "f1", "f2")
    sets = grouped.agg(first, F.count(F.lit(1)).alias("copies"), F.first("small").alias("small"), F.first("large").alias("large"))
    sets = with_bytes(sets.select("size", "f1", "f2", "_first.first", "_first.k1", "copies", "small", "large"))
    # each turn adds runs; its leaves come after those of the turns before, where a pair that shares one is theirs
    done, turn, found, links, places = 0, 0, 0, None, None
    while True:
        common.sweep(docs.sparkSession)
        path = F.shiftrightunsigned("path", 8).bitwiseOR(F.lit(turn << 56))
        tiled = tiles(leaves(sets, range(done, runs)).withColumn("path", path))
        here = common.keep(tiled.select("id", "path").distinct(), "leaves", free=False)
        places = here if places is None else places.unionAll(here)
        open_rows = common.keep(near(tiled, places, sets, threshold), "open")
        common.sweep(docs.sparkSession)
        wanted = sets.join(open_rows.select("id").distinct(), "id", "left_semi")
        new = common.keep(verify(open_rows, hashes_of(base, wanted, words), threshold), "links")
        links = new if links is None else links.unionAll(new)
        met = new.filter("what = 2").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("a", "b", "n")]).first()
        found += met[2]
        # of the pairs that no turn before has met, those that met nowhere now, from those that met once and twice
        missed = met[0] * (met[0] - 1) / (2 * (met[1] + 1))
        if not met[2] or found / (found + missed) >= recall:
            break
        done, runs, turn = runs, 2 * runs, turn + 1
    counts = links.filter("what = 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("_links"))
    linked = common.components(links.filter("what = 1").select("a", "b")).withColumnRenamed("node", "id")
    known = sets.select("id", "size", "f1", "f2", "first", F.struct("first", "k1").alias("_own"), "copies").join(counts, "id", "left").join(linked, "id", "left")
    root = F.coalesce("root", "id")
    heads = known.filter("root is not null").groupBy("root").agg(F.min("_own").alias("_head"))
    known = known.withColumn("root", root).join(heads, "root", "left").withColumn("_head", F.coalesce("_head", "_own"))
    rows = everything.select("doc_id", "k1", "size", "f1", "f2").join(known, ["size", "f1", "f2"], "left")
    own = F.coalesce("doc_id", F.lit(LAST))
    # the head is one text: others under its doc_id, or without one like it, are not
    itself = F.struct(own.alias("first"), F.col("k1").alias("k1"))
    name = lambda c: F.nullif(F.coalesce(c, own), F.lit(LAST))
    return rows.select(
        "doc_id",
        "k1",
        name(F.col("first")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("_links", F.lit(0)), F.lit(0)).alias("n_links"),
        name(F.col("_head.first")).alias("component_id"),
        (F.col("_head").isNull() | (F.col("_head") == itself)).alias("kept"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return join(docs).drop("k1")


@common.apart
def stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each group of linked documents the first stays, of equal rows one."""
    columns = docs.columns
    drop = join(docs).filter("not kept").select(F.coalesce("doc_id", F.lit(LAST)).alias("_id"), F.col("k1").alias("_k1")).distinct()
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(LAST)), "_k1": F.xxhash64(text)})
    return keyed.join(drop, ["_id", "_k1"], "left_anti").dropDuplicates(["_id", "_k1"]).select(*columns)
