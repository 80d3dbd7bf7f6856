"""Conversation prefix trie by the Euler tour technique.

A node is a sequence of first turns that conversations share. Each node has an enter and an exit arc; the arcs form one
list that walks round the trie. The list is ranked without walking it: in each round two in five arcs are hosts and take
in the next arcs of the list that are not, so that about half of the arcs are left, until LAST of them are ranked at
once; then the rounds are undone, and each arc that was taken in gets its place from its host. Leaves and savings of a
subtree are the difference of running totals at the exit and the enter arc.

No step holds a conversation, the children of a node or the conversations that end at one: turns are numbered over
sorted partitions, running values are cut into blocks of SPAN places, children are chained in buckets whose number grows
with the root of the number of nodes, and the ids that end at a node are joined in pieces and hashed as a stream.

Sequences are told apart by 128 bits, combined from the MD5 of each turn (role and text) and its place.

Defined results: rows with a null conv_id belong to no conversation and are left out; null turns come first; turns that
tie are ordered by their MD5, and repeated rows are turns of their own; null roles and texts are empty; a negative
conv_id's hundred is the next towards zero; an empty table has no node, not even the root; other columns are not read.
"""

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Conversations of one family, and by how many first turns of its head they can start.
FAMILY, HEADS = 100, 6
#: Places of a block of running values; a power of two.
SPAN = 1 << 12
#: Arcs that are ranked at once, and arcs that a host takes in at most in a round.
LAST, TAKES = 1 << 12, 3
#: Ids that are joined to one piece before they are hashed.
PIECE = 1 << 12


def running(df: DataFrame, key: list[str], at: str, values: dict[str, str], total, combine, most: int) -> DataFrame:
    """Add, as values' keys, the total of each of values' columns up to and with each place `at` (0, 1, 2.. up to `most`) of a key."""
    number, block = f"_block_{at}", F.shiftright(at, SPAN.bit_length() - 1)
    inside = Window.partitionBy(*key, number).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn(number, block)
    out = out.withColumns({name: total(c).over(inside) for name, c in values.items()})
    if most < SPAN:
        return out.drop(number)
    sums = df.groupBy(*key, block.alias(number)).agg(*(total(c).alias(f"_{name}") for name, c in values.items()))
    sums = running(sums, key, number, {f"_before_{name}": f"_{name}" for name in values}, total, combine, most // SPAN)
    sums = sums.select(*key, (F.col(number) + 1).alias(number), *(f"_before_{name}" for name in values))
    out = out.join(sums, [*key, number], "left")
    return out.withColumns({name: combine(F.col(name), F.coalesce(f"_before_{name}", F.lit(0))) for name in values}).drop(number, *(f"_before_{n}" for n in values))


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): turns with their place in their conversation, from 0."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", digest.alias("digest"), F.length(text).alias("chars"))
    turns = turns.withColumn("row", F.monotonically_increasing_id())  # spreads equal turns
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "row"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    turns = common.keep(turns.select("conv_id", "digest", "chars", F.spark_partition_id().alias("part"), in_part.alias("i")), "turns", free=False)
    parts = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("conv_id", "part", (before - F.col("first")).alias("shift"))
    return turns.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("i") + F.col("shift")).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, digest, chars, ends) of the rebuilt conversations, and (conv_id, length) of each."""
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("conv_id").alias("head"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("turns"))  # HEADS - 1 at most
    convs = convs.select("conv_id", (F.col("own") + 1).alias("own"), head.alias("head"), F.crc32(F.col("conv_id").cast("string")).alias("h") % HEADS)
    convs = convs.toDF("conv_id", "own", "head", "h").join(heads, "head", "left")
    taken = F.when(F.col("turns").isNull(), F.array().cast(heads.schema["turns"].dataType)).otherwise(F.slice("turns", 1, F.col("h").cast("int")))
    convs = convs.withColumn("turns", taken).withColumn("taken", F.size("turns"))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = common.keep(convs.select("conv_id", "h", "turns", "taken", "length"), "convs", free=False)
    ends = (F.col("at") + 1 == F.col("length")).alias("ends")
    borrowed = convs.select("conv_id", "length", F.explode("turns").alias("t")).select("conv_id", F.col("t.pos").alias("at"), "t.digest", "t.chars", "length")
    own = turns.join(convs.select("conv_id", "h", "taken", "length"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("at"), "digest", "chars", "length")
    return borrowed.unionAll(own).select("conv_id", "at", "digest", "chars", ends), convs.select("conv_id", "length")


def nodes(turns: DataFrame, convs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(node, k1, k2, depth, p1, p2, conv_id, n_convs, chars) of all nodes, and (k1, k2, depth, conv_id) of all ends."""
    turns = turns.withColumns({"g1": F.xxhash64("digest", "at"), "g2": F.xxhash64("at", "digest")})
    turns = running(turns, ["conv_id"], "at", {"k1": "g1", "k2": "g2"}, F.bit_xor, lambda a, b: a.bitwiseXOR(b), most)
    parent = {"p1": F.col("k1").bitwiseXOR(F.col("g1")), "p2": F.col("k2").bitwiseXOR(F.col("g2"))}
    turns = turns.withColumns(parent).select("conv_id", (F.col("at") + 1).alias("depth"), "k1", "k2", "p1", "p2", "chars", "ends")
    turns = common.keep(turns, "prefixes")
    found = turns.groupBy("k1", "k2", "depth").agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", F.lit(0).alias("chars"))
    found = found.unionByName(root).withColumn("node", F.monotonically_increasing_id())
    at_root = convs.filter("length = 0").select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id")
    return common.keep(found, "nodes", free=False), turns.filter("ends").select("k1", "k2", "depth", "conv_id").unionAll(at_root)


def with_parents(found: DataFrame) -> DataFrame:
    """Nodes with `parent`, the parent's node, and its conv_id."""
    upper = found.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(upper, ["p1", "p2", "depth"], "left").drop("p1", "p2")


def tour(tree: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(arc, next, w): the list of arcs, 2 * node to enter it and one more to exit; and (parent, n_children)."""
    below = tree.filter("parent is not null").select("node", "parent", F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket"))
    groups = below.groupBy("parent", "bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    groups = common.keep(groups, "siblings", free=False)
    order = Window.partitionBy("parent").orderBy("bucket")
    chained = groups.select("parent", "first", "last", F.lead("first").over(order).alias("follow"), F.row_number().over(order).alias("rank"))
    inner = below.select("node", F.lead("node").over(Window.partitionBy("parent", "bucket").orderBy("node")).alias("follow"))
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    children = groups.groupBy("parent").agg(F.sum("n").alias("n_children"))
    childless = tree.select("node").join(children.select(F.col("parent").alias("node")), "node", "left_anti")
    links = [
        inner.filter("follow is not null").select(leave("node").alias("arc"), enter("follow").alias("next")),
        chained.select(leave("last"), F.coalesce(enter("follow"), leave("parent"))),
        chained.filter("rank = 1").select(enter("parent"), enter("first")),
        childless.select(enter("node"), leave("node")),
        tree.filter("parent is null").select(leave("node"), F.lit(None).cast("long")),
    ]
    out = links[0]
    for more in links[1:]:
        out = out.unionAll(more)
    return out.withColumn("w", F.lit(1).cast("long")), children


def walk(arcs: DataFrame) -> DataFrame:
    """(arc, place) of a list of LAST arcs at most, in one task."""

    def read(batches):
        follow = {}
        for batch in batches:
            for arc, following, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                follow[arc] = following, w
        at, place, out = next(iter(follow.keys() - {n for n, _ in follow.values()}), None), 0, []
        while at is not None:
            out.append((at, place))
            at, w = follow[at]
            place += w
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([p for _, p in out], pa.int64())], ["arc", "place"])

    return common.map_arrow(arcs.select("arc", "next", "w").coalesce(1), read, "arc long, place long")


def ranked(arcs: DataFrame, last: int = LAST, takes: int = TAKES) -> DataFrame:
    """(arc, place): places of the arcs of a list from its head, from (arc, next, w); w is the way to the next one."""
    arcs, rounds = common.keep(arcs, "arcs", free=False), []
    while arcs.count() > last:
        host = F.pmod(F.xxhash64("arc", F.lit(len(rounds))), F.lit(5)) < 2
        guests = arcs.filter(~host).select(F.col("arc").alias("next"), F.col("next").alias("after"), F.col("w").alias("more"))
        hosts = arcs.filter(host)
        for i in range(takes):
            took = F.col("more").isNotNull()
            hosts = hosts.join(guests, "next", "left").select(
                "arc", F.when(took, F.col("after")).otherwise(F.col("next")).alias("next"), (F.col("w") + F.coalesce("more", F.lit(0))).alias("w"),
                *(f"{c}{j}" for j in range(i) for c in ("guest", "way")), F.when(took, F.col("next")).alias(f"guest{i}"), F.when(took, F.col("w")).alias(f"way{i}"),
            )
        hosts = common.keep(hosts, "hosts", free=False)
        pairs = F.array(*(F.struct(F.col(f"guest{i}").alias("guest"), F.col(f"way{i}").alias("way")) for i in range(takes)))
        taken = hosts.filter("guest0 is not null").select("arc", F.explode(pairs).alias("g")).filter("g.guest is not null").select("arc", "g.guest", "g.way")
        left = arcs.filter(~host).join(taken.select(F.col("guest").alias("arc")), "arc", "left_anti")
        following = common.keep(hosts.select("arc", "next", "w").unionAll(left), "arcs", free=False)
        common.drop_kept(arcs)
        arcs = following
        rounds.append(taken)
    places = common.keep(walk(arcs), "places", free=False)
    for taken in reversed(rounds):
        guests = taken.join(places, "arc").select(F.col("guest").alias("arc"), (F.col("place") + F.col("way")).alias("place"))
        following = common.keep(places.unionAll(guests), "places", free=False)
        common.drop_kept(places)
        places = following
    return places


def ends_sha(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes where conversations end."""
    key = ["k1", "k2", "depth"]
    schema = "k1 long, k2 long, depth long"

    def pieces(batches):
        held, node = [], None
        for batch in batches:
            for k1, k2, depth, conv_id in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (k1, k2, depth) != node or len(held) == PIECE:
                    if held:
                        yield one(node, held)
                    held, node = [], (k1, k2, depth)
                held.append(conv_id)
        if held:
            yield one(node, held)

    def one(node, held):
        values = [[v] for v in (*node, held[0], ",".join(map(str, held)))]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [pa.int64()] * 4 + [pa.string()], strict=True)], [*key, "first", "ids"])

    def joined(batches):
        def rows(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    yield tuple(batch.column(c)[i].as_py() for c in range(3)), batch.column(4)[i].as_py()

        out, node, sha = [], None, None
        for key_of, ids in rows(batches):
            if key_of != node:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = key_of, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
            if len(out) >= 10_000:
                yield hashes(out)
                out = []
        if node is not None:
            out.append((*node, sha.hexdigest()))
        yield hashes(out)

    def hashes(out):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])], [*key, "ends_sha256"])

    ends = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    chunks = common.map_arrow(ends, pieces, schema + ", first long, ids string")
    chunks = chunks.repartition(*key).sortWithinPartitions(*key, "first")
    return common.map_arrow(chunks, joined, schema + ", ends_sha256 string")


def prefix_trie(conversations: DataFrame, last: int = LAST) -> DataFrame:
    """One row for each node of the trie: smallest member, depth, parent, counts, savings and who ends there."""
    turns, convs = rebuilt(numbered(conversations))
    n_convs, longest = convs.agg(F.count(F.lit(1)), F.max("length")).first()
    found, ends = nodes(turns, convs, longest or 0)
    tree = common.keep(with_parents(found), "tree", free=False)
    n = tree.count()
    arcs, children = tour(tree, max(1, math.isqrt(n)))
    places = ranked(arcs, last)
    children = children.withColumnRenamed("parent", "node")
    tree = tree.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = tree.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    entered = tree.select((F.col("node") * 2).alias("arc"), "leaf", "saved")
    values = places.join(entered, "arc", "left").select("arc", "place", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("leaf", "saved")))
    sums = running(values, [], "place", {"leaves": "leaf", "savings": "saved"}, F.sum, lambda a, b: a + b, 2 * n)
    sign = lambda total, own: F.sum(F.when(F.col("arc") % 2 == 1, F.col(total)).otherwise(F.col(own) - F.col(total)))
    below = sums.groupBy(F.shiftright("arc", 1).alias("node")).agg(sign("leaves", "leaf").alias("n_leaves"), sign("savings", "saved").alias("saved_tokens"))
    out = tree.join(below, "node").join(ends_sha(ends), ["k1", "k2", "depth"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


digest = prefix_trie


SQL = r"""
WITH RECURSIVE step(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, xor(v >> 1, (v & 1) * 3988292384), k + 1 FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8),
own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)),
    lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]))) % 6 AS h
  FROM own, tab),
conv AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS seq
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
member AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM conv),
node AS (
  SELECT seq[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '')) AS ends_sha256
  FROM member GROUP BY ALL),
above AS (SELECT p, depth, n_convs, unnest(range(depth + 1)) AS d FROM node),
sums AS (
  SELECT a.p[1:a.d] AS p, count(*) FILTER (a.depth = a.d + 1) AS n_children,
    sum(CASE WHEN a.depth > 0 THEN (a.n_convs - 1) * length(a.p[a.depth].t) ELSE 0 END) AS saved_tokens,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM node c WHERE c.depth = a.depth + 1 AND c.p[1:a.depth] = a.p)) AS n_leaves
  FROM above a GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN sums s ON s.p = n.p LEFT JOIN node u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]
"""
