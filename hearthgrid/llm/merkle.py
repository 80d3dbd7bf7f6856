"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A text is cut at blank lines ("\\n\\n") into sections, these at line ends into paragraphs; nothing is lost by either, so
equal roots mean equal texts. A paragraph's node is the SHA-256 of its text, a section's that of its paragraphs' nodes,
the root that of its sections' nodes. Below a paragraph lie pieces of PIECE code points, which tell how far two
paragraphs differ. The likeness of two trees is the share of the distinct pieces they have in common (Dice), 1 for
equal roots.

Defined results: a null text is an empty one, whose tree has one empty paragraph; the likeness of two empty texts is 1;
repeated rows give repeated rows; an empty table gives none; other columns are left alone. The next document of a row
is the one that follows by descending doc_id (null last, ties by content), of the last row the first.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

PIECE = 24
#: Rows of one range of documents in which neighbours are found, and the most ranges.
RANGE_ROWS, MOST_RANGES = 2048, 4096


def sections(text: Column) -> Column:
    """Nodes of paragraphs by section: array<array<string>>."""
    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.sha2(p, 256)))


def root(nodes: Column) -> Column:
    return F.sha2(F.array_join(F.transform(nodes, lambda s: F.sha2(F.array_join(s, ""), 256)), ""), 256)


def pieces(text: Column) -> Column:
    """Distinct hashes of the pieces of all paragraphs."""
    cut = F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{PIECE}}}"), F.lit(0))
    return F.array_distinct(F.transform(cut, lambda p: F.xxhash64(p)))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    both = F.size(F.array_intersect(a, b)) * F.lit(2.0)
    total = F.size(a) + F.size(b)
    return F.when(equal, 1.0).when(total == 0, 0.0).otherwise(both / total)


def changed(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of b that differ from those at their place in a.

    Branches whose section nodes are equal are not entered.
    """
    flat_a, flat_b = F.flatten(a), F.flatten(b)
    longer = F.greatest(F.size(flat_a), F.size(flat_b))
    numbers = F.sequence(F.lit(0), longer - 1)
    differs = lambda i: ~F.try_element_at(flat_a, i + 1).eqNullSafe(F.try_element_at(flat_b, i + 1))
    return F.when(a == b, F.array().cast("array<int>")).otherwise(F.filter(numbers, differs))


def with_next(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) with the text of the next by descending doc_id.

    Documents are cut into ranges of doc_id; a range also gets the first document of the one that follows, so
    neighbours are found inside ranges and no window holds the table. One number per range goes to the driver.
    """
    rows = docs.count()
    ranges = min(MOST_RANGES, rows // RANGE_ROWS + 1)
    at = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", at or [0.5], 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts)) if at else []
    # ranges in order of descending doc_id; null comes last
    number = F.lit(len(cuts)) - F.size(F.filter(F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>"), lambda c: c < F.col("doc_id")))
    ranged = docs.withColumns({"_range": F.coalesce(number, F.lit(len(cuts) + 1)), "_tie": F.xxhash64("text")})
    firsts = ranged.groupBy("_range").agg(F.max("doc_id").alias("first")).orderBy("_range").collect()
    if not firsts:
        return docs.withColumn("next_text", F.lit(None).cast("string"))
    # the row that a range needs from the one that follows; the last range needs the first row of all
    pairs = zip([firsts[-1], *firsts], firsts, strict=False)
    entries = [(F.lit(after["_range"]), F.struct(F.lit(after["first"]).cast("bigint").alias("first"), F.lit(before["_range"]).alias("to"))) for before, after in pairs]
    entry = F.try_element_at(F.create_map(*[x for e in entries for x in e]), F.col("_range"))
    also = F.when(F.col("doc_id").eqNullSafe(entry["first"]), entry["to"])
    own = F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy"))
    copy = F.when(F.col("_also").isNotNull(), F.struct(F.col("_also").alias("r"), F.lit(1).alias("copy")))
    doubled = ranged.withColumn("_also", also).withColumn("_to", F.explode(F.array_compact(F.array(own, copy))))
    by = Window.partitionBy("_in").orderBy("_copy", F.desc_nulls_last("doc_id"), "_tie")
    inside = doubled.select("doc_id", "text", "_tie", F.col("_to.r").alias("_in"), F.col("_to.copy").alias("_copy"))
    return inside.withColumn("next_text", F.lead("text").over(by)).filter("_copy = 0").select("doc_id", "text", "next_text")


def digest(docs: DataFrame) -> DataFrame:
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    texts = with_next(base).withColumn("edited", edited)
    trees = texts.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        *[f(F.col(c)).alias(f"{c}_{n}") for c in ("text", "edited", "next_text") for f, n in ((sections, "nodes"), (pieces, "pieces"))],
    )
    own, new, after = (root(F.col(f"{c}_nodes")) for c in ("text", "edited", "next_text"))
    rooted = trees.withColumns({"fingerprint": own, "edited_fingerprint": new, "_next": after})
    where = changed(F.col("text_nodes"), F.col("edited_nodes"))
    return rooted.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("text_pieces"), F.col("edited_pieces"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("text_pieces"), F.col("next_text_pieces"), F.col("fingerprint") == F.col("_next")).alias("near_next"),
        F.size(where).cast("long").alias("n_changed"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (
  SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, (length(t) // 2)::INT AS half
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT doc_id, t, nt, substr(t, 1, length(t) - half) || substr(nt, 1, half) AS x FROM n),
h AS (
  SELECT doc_id, t, nt, x,
         list_transform(string_split(t, E'\n\n'), lambda s: list_transform(string_split(s, E'\n'), lambda p: sha256(p))) AS tn,
         list_transform(string_split(x, E'\n\n'), lambda s: list_transform(string_split(s, E'\n'), lambda p: sha256(p))) AS xn,
         list_distinct(regexp_extract_all(t, '[^\n]{1,24}')) AS tp,
         list_distinct(regexp_extract_all(x, '[^\n]{1,24}')) AS xp,
         list_distinct(regexp_extract_all(nt, '[^\n]{1,24}')) AS np
  FROM e),
f AS (
  SELECT *, sha256(array_to_string(list_transform(tn, lambda s: sha256(array_to_string(s, ''))), '')) AS tf,
         sha256(array_to_string(list_transform(xn, lambda s: sha256(array_to_string(s, ''))), '')) AS xf,
         flatten(tn) AS ta, flatten(xn) AS xa
  FROM h)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(x) AS edited_sha256, tf AS fingerprint, xf AS edited_fingerprint,
       CASE WHEN t = x THEN 1.0::DOUBLE WHEN len(tp) + len(xp) = 0 THEN 0.0
            ELSE len(list_intersect(tp, xp)) * 2.0::DOUBLE / (len(tp) + len(xp)) END AS near_edited,
       CASE WHEN t = nt THEN 1.0::DOUBLE WHEN len(tp) + len(np) = 0 THEN 0.0
            ELSE len(list_intersect(tp, np)) * 2.0::DOUBLE / (len(tp) + len(np)) END AS near_next,
       len(list_filter(range(1, greatest(len(ta), len(xa)) + 1), lambda i: ta[i] IS DISTINCT FROM xa[i]))::BIGINT AS n_changed
FROM f
"""
