"""Embedding near-dedup: a robust-pruned flat graph over overlapping cluster shards.

Equal vectors of a label are one class from the start. Centroids per label come from a bounded sample; every class joins
its OVERLAP nearest clusters. In each shard (blocks of at most BLOCK classes) a graph is built by greedy searches from
the shard's medoid and robust pruning; the adjacency lists of a class from all its shards are united. Then each class
searches its shards over the united lists: greedily from the medoid, and from what lies in range on to all that can be
reached through nodes in a slightly wider range. What is found is verified by cosine in double precision. Recall is
audited against brute force for AUDIT classes and more, until LINKED of them have links; below its target the build is
repeated with more overlap and wider beams, and if the widest is still below it, all that can reach each other is
compared by brute force.

Defined results: vectors that are null, zero, empty or hold null or non-finite components, and vectors without a label,
link with nothing; vectors of different lengths don't link; repeated rows are copies of each other; an empty table gives
no rows; other columns are left alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD, SLACK = 0.98, 0.02
OVERLAP, BEAM, DEGREE, ALPHA = 2, 32, 20, 1.3
#: Classes a cluster should hold, most classes of a block, vectors that centroids come from, most centroids.
SHARD, BLOCK, SAMPLE, CENTROIDS = 500, 1500, 20_000, 2048
AUDIT, RECALL, MOST_OVERLAP = 1024, 0.98, 5
#: Audited classes with links that an audit needs.
LINKED = 100
LAST = 2**63 - 1


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes(vectors: DataFrame) -> DataFrame:
    """(id, part, embedding, first, copies): distinct vectors that can link; part is label and length."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce((x - x) == 0, F.lit(False)))
    some = F.exists(e, lambda x: x != 0)
    rows = vectors.filter(F.col("label").isNotNull() & e.isNotNull() & finite & some)
    part = F.concat_ws(":", F.col("label").cast("string"), F.size(e).cast("string"))
    grouped = rows.groupBy(part.alias("part"), "embedding").agg(
        F.min(F.coalesce("vec_id", F.lit(LAST))).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    return common.keep(grouped.withColumn("id", F.monotonically_increasing_id()), "vectors")


def centroids(sets: DataFrame) -> dict[str, np.ndarray]:
    """Unit centroids of each label, by spherical k-means on at most SAMPLE vectors (the first by hash)."""
    sizes = {r["part"]: r["n"] for r in sets.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    rows = sets.orderBy(F.xxhash64("first"), "id").limit(SAMPLE).select("part", "embedding").collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["part"], []).append(r["embedding"])
    out = {}
    for part, found in by.items():
        x = np.array(found, dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x = np.unique(x, axis=0)
        k = max(1, min(len(x), -(-sizes[part] // SHARD), CENTROIDS * sizes[part] // total))
        c = x[np.random.default_rng(7).choice(len(x), k, replace=False)]
        for _ in range(8):
            at = (x @ c.T).argmax(1)
            sums = np.zeros_like(c)
            np.add.at(sums, at, x)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), c)
        out[part] = c
    return out


def sharded(sets: DataFrame, overlap: int) -> DataFrame:
    """(shard, block, blocks, id, embedding, copies): every class in its nearest clusters."""
    # at most CENTROIDS vectors; parts that the sample missed are shards of their own
    shared = sets.sparkSession.sparkContext.broadcast(centroids(sets))

    def assign(batches):
        for batch in batches:
            parts = batch[1].to_pylist()
            names: list[str] = []
            rows: list[int] = []
            for part in sorted(set(parts)):
                at = np.flatnonzero(np.array([p == part for p in parts]))
                c = shared.value.get(part)
                if c is None:
                    near = np.zeros((len(at), 1), dtype=int)
                else:
                    near = np.argsort(-(_matrix(batch[2].take(pa.array(at))) @ c.T), axis=1)[:, :overlap]
                for i in range(near.shape[1]):
                    names += [f"{part}/{x}" for x in near[:, i].tolist()]
                    rows += at.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch[0].take(pa.array(rows, pa.int64()))], ["shard", "id"])

    shards = common.map_arrow(sets.select("id", "part", "embedding"), assign, "shard string, id long")
    blocks = shards.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = shards.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), "blocks").cast("int"))
    return common.keep(cut.join(sets.select("id", "embedding", "copies"), "id"), "shards")


def greedy(x: np.ndarray, q: np.ndarray, graph: list[np.ndarray], start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes met on the way from start to the nearest of q, with their cosines."""
    seen = np.zeros(len(x), dtype=bool)
    seen[start] = True
    ids, near = np.array([start]), np.array([x[start] @ q])
    done = np.zeros(1, dtype=bool)
    met_ids, met_near = [ids], [near]
    while not done.all():
        at = np.flatnonzero(~done)[:4]  # ids are sorted by cosine; four nodes at a time
        done[at] = True
        more = np.unique(np.concatenate([graph[i] for i in ids[at]]))
        more = more[~seen[more]]
        if not len(more):
            continue
        seen[more] = True
        close = x[more] @ q
        met_ids.append(more)
        met_near.append(close)
        ids, near, done = np.concatenate([ids, more]), np.concatenate([near, close]), np.concatenate([done, np.zeros(len(more), dtype=bool)])
        by = np.argsort(-near, kind="stable")[:beam]
        ids, near, done = ids[by], near[by], done[by]
    return np.concatenate(met_ids), np.concatenate(met_near)


def prune(x: np.ndarray, node: int, ids: np.ndarray) -> np.ndarray:
    """Robust pruning: nearest first, without what is ALPHA times nearer to one already chosen."""
    ids = np.unique(ids[ids != node])
    away = 1 - x[ids] @ x[node]
    ids, away = ids[np.argsort(away, kind="stable")], np.sort(away, kind="stable")
    between, open_, chosen = 1 - x[ids] @ x[ids].T, np.ones(len(ids), dtype=bool), []
    while open_.any() and len(chosen) < DEGREE:
        at = int(np.argmax(open_))
        chosen.append(at)
        open_ &= ALPHA * between[at] > away
        open_[at] = False
    return ids[chosen]


def build(x: np.ndarray, beam: int) -> list[np.ndarray]:
    """A graph over the rows of x, by inserting them in a shuffled order."""
    n, random = len(x), np.random.default_rng(3)
    graph = [random.choice(n, min(n - 1, 4), replace=False) for _ in range(n)] if n > 1 else [np.zeros(0, dtype=int)]
    graph = [g[g != i] for i, g in enumerate(graph)]
    start = medoid(x)
    for node in random.permutation(n).tolist():
        met, near = greedy(x, x[node], graph, start, beam)
        best = met[np.argsort(-near, kind="stable")[: 2 * beam]]
        graph[node] = prune(x, node, np.concatenate([best, graph[node]]))
        for other in graph[node].tolist():
            if node not in graph[other]:
                back = np.append(graph[other], node)
                graph[other] = back if len(back) <= DEGREE + 8 else prune(x, other, back)
    return graph


def medoid(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(0)))


def in_range(x: np.ndarray, q: np.ndarray, graph: list[np.ndarray], start: int, beam: int, threshold: float, own: int | None) -> np.ndarray:
    """Nodes within threshold of q: a greedy search, widened as long as it meets nodes in range."""
    ids, near = greedy(x, q, graph, start, beam)
    close = np.full(len(x), -2.0)
    close[ids] = near
    front = ids[near >= threshold - SLACK]
    if own is not None and close[own] < -1:
        close[own], front = 1.0, np.append(front, own)
    while len(front):
        more = np.unique(np.concatenate([graph[i] for i in front]))
        more = more[close[more] < -1]
        close[more] = x[more] @ q
        front = more[close[more] >= threshold - SLACK]
    return np.flatnonzero(close >= threshold)


def graphs(shards: DataFrame, beam: int) -> DataFrame:
    """(id, near): the adjacency lists of all shards, united."""

    def grow(group):
        ids = group["id"].to_numpy()
        if len(ids) > 1:
            lists = [ids[g] for g in build(_matrix(group["embedding"]), beam)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], ["id", "near"])

    keyed = shards.select(F.xxhash64("shard", "block").alias("tile"), "id", "embedding")
    lists = common.map_sorted(keyed, "tile", grow, "id long, near array<long>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    return common.keep(united, "graph")


FOUND = "id long, linked array<struct<id: bigint, copies: bigint>>, edges array<long>"


def _found(full: np.ndarray, ids: np.ndarray, copies: np.ndarray):
    """Rows of FOUND from a symmetric table of links."""
    hit = np.flatnonzero(full.any(1))
    seen, edges = np.zeros(len(ids), dtype=bool), {int(h): [] for h in hit}
    for first in hit.tolist():
        if seen[first]:
            continue
        seen[first], front = True, [first]
        while front:
            a = front.pop()
            for b in np.flatnonzero(full[a] & ~seen).tolist():
                seen[b] = True
                edges[a].append(int(ids[b]))
                front.append(b)
    pair = pa.struct([("id", pa.int64()), ("copies", pa.int64())])
    linked = [[{"id": int(ids[b]), "copies": int(copies[b])} for b in np.flatnonzero(full[a])] for a in hit.tolist()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[hit]), pa.array(linked, pa.list_(pair)), pa.array([edges[int(a)] for a in hit], pa.list_(pa.int64()))], ["id", "linked", "edges"]
    )


def exact(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, linked, edges) by brute force: nothing that reaches the threshold is left out.

    Every class lives in its nearest cluster and visits each later one that its angle to the centroid lets reach: nearer
    than the cluster's widest angle and that of the threshold. Clusters and visitors meet in tiles of two blocks.
    """
    middles = centroids(sets)
    shared = sets.sparkSession.sparkContext.broadcast(middles)
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6

    def angles(batch, part):
        at = np.flatnonzero(np.array(batch[1].to_pylist(), dtype=object) == part)
        c = shared.value.get(part)
        x = _matrix(batch[2].take(pa.array(at)))
        return at, np.zeros((len(at), 1)) if c is None else np.arccos(np.clip(x @ c.T, -1, 1))

    def settle(batches):
        for batch in batches:
            for part in sorted(set(batch[1].to_pylist())):
                at, away = angles(batch, part)
                home = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(pa.array(at)), pa.array([part] * len(at), pa.string()), pa.array(home.astype(np.int32)), pa.array(away[np.arange(len(at)), home])],
                    ["id", "part", "home", "away"],
                )

    rows = sets.select("id", "part", "embedding")
    homes = common.map_arrow(rows, settle, "id long, part string, home int, away double")
    # at most CENTROIDS rows and one for each part that the sample missed
    widest: dict[str, dict[int, float]] = {}
    for r in homes.groupBy("part", "home").agg(F.max("away").alias("away")).collect():
        widest.setdefault(r["part"], {})[r["home"]] = r["away"]
    wide = sets.sparkSession.sparkContext.broadcast(widest)

    def visit(batches):
        for batch in batches:
            for part in sorted(set(batch[1].to_pylist())):
                at, away = angles(batch, part)
                home = away.argmin(1)
                bound = np.array([wide.value[part].get(c, -9.0) for c in range(away.shape[1])]) + reach
                goes = (away <= bound) & (np.arange(away.shape[1]) > home[:, None])
                goes[np.arange(len(at)), home] = True
                row, cluster = np.nonzero(goes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{part}/{c}" for c in cluster.tolist()], pa.string()),
                        pa.array((cluster != home[row]).astype(np.int32)),
                        batch[0].take(pa.array(at[row])),
                    ],
                    ["shard", "guest", "id"],
                )

    placed = common.map_arrow(rows, visit, "shard string, guest int, id long")
    counts = placed.groupBy("shard").agg(*[F.ceil(F.sum(w) / BLOCK).cast("int").alias(n) for w, n in ((1 - F.col("guest"), "own"), (F.col("guest"), "guests"))])
    cut = placed.join(counts, "shard").filter("own > 0")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.when(F.col("guest") == 1, F.col("guests")).otherwise(F.col("own"))).cast("int")
    # a guest block meets every own block, an own block every guest block and every own block
    own, guests = F.sequence(F.lit(0), F.col("own") - 1), F.sequence(F.lit(0), F.col("guests") - 1)
    none = F.array().cast("array<struct<a:int,b:int,kind:int>>")
    tile = lambda a, b, kind: F.struct(a.alias("a"), b.alias("b"), F.lit(kind).alias("kind"))
    b = F.col("block")
    with_own = F.transform(own, lambda o: tile(F.least(b, o), F.greatest(b, o), 0))
    with_guests = F.when(F.col("guests") > 0, F.transform(guests, lambda g: tile(b, g, 1))).otherwise(none)
    as_guest = F.transform(own, lambda o: tile(o, b, 1))
    meets = F.explode(F.when(F.col("guest") == 1, as_guest).otherwise(F.concat(with_own, with_guests)))
    tiled = cut.withColumn("block", block).withColumn("t", meets)
    side = F.when(F.col("t.kind") == 1, F.col("guest")).when(F.col("t.a") == F.col("t.b"), 2).when(b == F.col("t.a"), 0).otherwise(1)
    tiled = tiled.select(F.xxhash64("shard", "t.a", "t.b", "t.kind").alias("tile"), side.alias("side"), "id")
    tiled = tiled.join(sets.select("id", "embedding", "copies"), "id")

    def compare(group):
        if group.num_rows > 1:
            x, side = _matrix(group["embedding"]), group["side"].to_numpy()
            full = (x @ x.T >= threshold) & ((side[:, None] != side[None, :]) | (side[:, None] == 2))
            full |= full.T
            np.fill_diagonal(full, False)
            yield from _found(full, group["id"].to_numpy(), group["copies"].to_numpy())

    return common.map_sorted(tiled, "tile", compare, FOUND)


def search(shards: DataFrame, graph: DataFrame, beam: int, threshold: float) -> DataFrame:
    """(id, linked, edges): per class and tile what it links with, and links that span the tile's groups."""

    def find(group):
        if group.num_rows < 2:
            return
        x, ids, side = _matrix(group["embedding"]), group["id"].to_numpy(), group["side"].to_numpy()
        base = np.flatnonzero(side != 1)
        queries = np.flatnonzero(side != 0)
        if not len(base) or not len(queries):
            return
        by = np.argsort(ids[base])
        base = base[by]
        lists = group["near"].take(pa.array(base)).to_pylist()
        local = []
        for near in lists:
            near = np.array(near or [], dtype=np.int64)
            at = np.minimum(np.searchsorted(ids[base], near), len(base) - 1)
            local.append(at[ids[base][at] == near])
        here, start = x[base], medoid(x[base])
        place = {int(b): i for i, b in enumerate(base)}
        full = np.zeros((len(ids), len(ids)), dtype=bool)
        for q in queries.tolist():
            full[q, base[in_range(here, x[q], local, start, beam, threshold, place.get(q))]] = True
        full |= full.T
        np.fill_diagonal(full, False)
        yield from _found(full, ids, group["copies"].to_numpy())

    # blocks of one shard meet in pairs: the graph of the first is searched for the second
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = shards.select("shard", "block", "id", "embedding", "copies", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    tiled = rows.select(F.xxhash64("shard", low, high).alias("tile"), side.alias("side"), "id", "embedding", "copies").join(graph, "id", "left")
    return common.map_sorted(tiled, "tile", find, FOUND)


def audit(sets: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Average share of true links that were found, over audited classes that have links.

    Classes are audited in passes, AUDIT of them (by hash) and then more, until LINKED with links are met or none is left.
    The average over classes and the one that gives every group of linked classes the same weight both count: the lower.
    """
    # how many have been audited decides the range of the hash, so that each pass is one scan
    order = F.pmod(F.xxhash64("first", "id", F.lit("audit")), F.lit(2**40))
    total = sets.count()
    known: dict[int, tuple[int, int]] = {}
    low, wanted = 0, AUDIT
    while low < 2**40 and total and len(known) < LINKED:
        high = min(2**40, low + -(-(2**40) * wanted // total))
        chosen = sets.filter((order >= low) & (order < high))
        known |= _audited(sets, counts, chosen.select("id", "part", "embedding", "copies").collect(), threshold)
        low, wanted = high, min(wanted * 2, 16 * AUDIT)
    if not known:
        return 1.0  # every class was compared with all others, and none has a link
    share = np.array([min(got, want) / want for got, want in known.values()])
    weight = np.array([1 / (1 + want) for _, want in known.values()])
    return float(min(share.mean(), (share * weight).sum() / weight.sum()))


def _audited(sets: DataFrame, counts: DataFrame, rows: list, threshold: float) -> dict[int, tuple[int, int]]:
    """Links found and true links of those rows that have some."""
    if not rows:
        return {}
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["part"], []).append(r)
    queries = sets.sparkSession.sparkContext.broadcast(
        {p: ([r["id"] for r in found], np.array([r["embedding"] for r in found], dtype=np.float64)) for p, found in by.items()}
    )

    def compare(batches):
        total: dict[int, int] = {}
        for batch in batches:
            parts, copies = np.array(batch[0].to_pylist()), batch[2].to_numpy()
            for part in set(parts.tolist()) & queries.value.keys():
                ids, q = queries.value[part]
                at = np.flatnonzero(parts == part)
                x = _matrix(batch[1].take(pa.array(at)))
                linked = (x @ (q / np.linalg.norm(q, axis=1, keepdims=True)).T) >= threshold
                for i, n in zip(ids, (linked * copies[at][:, None]).sum(0).tolist(), strict=True):
                    total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["id", "n"])

    true = common.map_arrow(sets.select("part", "embedding", "copies"), compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    own = {r["id"]: r["copies"] for r in rows}
    want = {r["id"]: r["n"] - own[r["id"]] for r in true.collect()}
    got = {r["id"]: r["n"] for r in counts.join(F.broadcast(true.select("id")), "id").select("id", F.col("_links").alias("n")).collect()}
    return {i: (got.get(i, 0), n) for i, n in want.items() if n > 0}


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM) -> DataFrame:
    """vec_id, n_links, component_id, kept of each vector."""
    base = vectors.select("vec_id", "embedding", "label")
    sets = classes(base)

    def counted(found: DataFrame) -> DataFrame:
        united = found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("linked"))).alias("linked"))
        return common.keep(united.select("id", F.aggregate("linked", F.lit(0).cast("bigint"), lambda a, x: a + x["copies"]).alias("_links")), "counts")

    while True:
        shards = sharded(sets, overlap)
        found = common.keep(search(shards, graphs(shards, beam), beam, threshold), "found")
        counts = counted(found)
        if audit(sets, counts, threshold) >= RECALL:
            break
        if overlap >= MOST_OVERLAP:
            found = common.keep(exact(sets, threshold), "found")
            counts = counted(found)
            break
        overlap, beam = overlap + 1, beam * 2
    roots = common.components(found.select(F.col("id").alias("a"), F.explode("edges").alias("b"))).withColumnRenamed("node", "id")
    known = sets.join(counts, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    heads = known.groupBy("root").agg(F.min("first").alias("_head"))
    known = known.join(heads, "root").select("part", "embedding", "copies", "_links", "_head")
    part = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    own = F.coalesce("vec_id", F.lit(LAST))
    head = F.coalesce("_head", own)
    # vectors that can't link meet no class: theirs are not among the distinct ones, or their label is null
    keyed = base.withColumn("part", F.when(F.col("label").isNotNull(), part))
    return keyed.join(known, ["part", "embedding"], "left").select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("_links", F.lit(0)), F.lit(0)).alias("n_links"),
        F.nullif(head, F.lit(LAST)).alias("component_id"),
        (head == own).alias("kept"),
    )


digest = near_copies
