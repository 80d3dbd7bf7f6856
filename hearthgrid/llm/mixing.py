"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight schedule, a line of (progress, weight) knots over training progress 0 to 1. Its integral is
the source's weight; targets are the sizes that the weights get of the budget, none above `most` times its source's
size. The documents of a source stand in a fixed shuffled order and are read in turn, once more from the start if the
target is larger than the source. A document that begins after c words of its source's reading is due at the progress
by which the schedule has demanded c words: cumulative demand inverted. The mix is the documents range-sorted by that
position.

Defined results: a null text has size 0, a null source is a source of its own and comes last, sources without words get
target 0, documents of size 0 take nothing and have no position, repeated rows are documents of their own, an empty
table gives no rows. Other columns pass through; the names in OWN must not be among them (they are replaced).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Knots of the weight schedules; sources take them in turn. Their integrals are 3, 1 and 2.
SCHEDULES = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 2.0), (1.0, 2.0)))
OWN = ("size", "source_size", "target", "takes", "positions")


def integral(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def inverse(knots, share: Column) -> Column:
    """Progress by which a schedule has demanded this share of its total."""
    area, out, done = share * F.lit(integral(knots)), F.lit(1.0), []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        before = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in done)
        done.append(((t0, w0), (t1, w1)))
        rest, slope = area - F.lit(before), (w1 - w0) / (t1 - t0)
        inside = rest / w0 if not slope else (F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * rest)) - w0) / slope
        out = F.when(rest >= 0, F.least(F.lit(t1), t0 + inside)).otherwise(out) if before else F.least(F.lit(t1), t0 + inside)
    return out


def targets(totals: DataFrame, schedules=SCHEDULES, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Rows (source, source_size) with their schedule and target, one row per source.

    Giving back what is above a limit and sharing it again ends where every source has its weight times one common
    level or its limit; in order of limit by weight, the sources before the first that is below are those at theirs.
    """
    weights = F.array(*[F.lit(integral(k)) for k in schedules])
    ranked = totals.withColumn(
        "schedule", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(schedules)
    ).withColumn("weight", F.element_at(weights, F.col("schedule") + 1))
    limit = F.col("source_size") * F.lit(most)
    by = Window.orderBy(limit / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum(limit).over(by), F.lit(0.0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by), F.lit(0.0))
    level = ranked.withColumn("limit", limit).withColumn("level", left / weight)
    below = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.col("level"))
    share_of = F.coalesce(F.max(below).over(every) * F.col("weight"), F.col("limit"))
    return level.select("source", "source_size", "schedule", F.least("limit", share_of).alias("target"))


def mix(docs: DataFrame, schedules=SCHEDULES, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Documents (doc_id, source, size and what else they have) with source_size, target, takes and positions.

    `takes` has the words of each reading, `positions` the progress at which it starts; readings without words are
    left out of both. The last document of a target is cut, so a source's words sum to its target's whole part.
    """
    order = docs.withColumns({"_order": common.order_key(F.col("doc_id")), "_key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))})
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    plan = targets(sources.drop("_rows"), schedules, share, most)
    rows = docs.count()
    placed = common.running(order, "_key", "_order", ["doc_id", "size"], "size", rows, "_before")
    plan = plan.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))).drop("source")
    joined = placed.join(plan, "_key")
    whole = F.floor(F.col("target")).cast("long")
    reads = []
    for turn in range(-(-int(most * 1000) // 1000)):
        start = F.col("_before") + F.lit(turn) * F.col("source_size")
        take = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - start))
        part = F.try_divide(start, F.col("target"))  # no word, no place
        at = inverse(schedules[0], part)
        for i, knots in enumerate(schedules[1:], 1):
            at = F.when(F.col("schedule") == i, inverse(knots, part)).otherwise(at)
        reads.append(F.struct(take.alias("take"), F.round(at, 9).alias("position")))
    taken = F.filter(F.array(*reads), lambda r: r["take"] > 0)
    return (
        joined.withColumn("_reads", taken)
        .withColumns({"takes": F.col("_reads.take"), "positions": F.col("_reads.position")})
        .drop("_key", "_order", "_before", "_reads", "schedule")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.drop(*OWN).withColumn("size", F.size(common.words(F.col("text"))).cast("long"))


def curriculum(mixed: DataFrame) -> DataFrame:
    """One row per reading, range-sorted by position: the order of training."""
    reading = F.explode(F.arrays_zip("takes", "positions")).alias("r")
    kept = [c for c in mixed.columns if c not in ("takes", "positions")]
    return mixed.select(*kept, reading).select(*kept, F.col("r.takes").alias("take"), F.col("r.positions").alias("position")).orderBy("position", "doc_id")


def digest(docs: DataFrame) -> DataFrame:
    """Words taken of each document, in the order of their first position."""
    slim = common.keep(sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    mixed = mix(slim)
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x)
    return mixed.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), F.try_element_at("positions", F.lit(1)).alias("position")
    ).orderBy(F.asc_nulls_last("position"), "doc_id")


@common.apart
def stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: each reading becomes a document, the last of a target with the words taken alone."""
    columns = docs.columns
    cut = F.array_join(F.slice(common.words(F.col("text")), 1, F.col("take").cast("int")), " ")
    text = F.when(F.col("take") < F.col("size"), cut).otherwise(F.col("text"))
    out = curriculum(mix(sized(docs))).withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS o
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM totals),
weighted AS (SELECT *, CASE k WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
                    source_size * 2.0::DOUBLE AS lim FROM ranked),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM totals) * 1.5::DOUBLE - coalesce(sum(lim) OVER b, 0))
            / ((SELECT sum(w) FROM weighted) - coalesce(sum(w) OVER b, 0)) AS level
  FROM weighted
  WINDOW b AS (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, k,
         least(lim, coalesce((SELECT max(level) FROM levels WHERE lim > level * w) * w, lim)) AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.k, p.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.o, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
taking AS (
  SELECT *, CAST(greatest(0, least(size, floor(target) - before)) AS BIGINT) AS t0,
         CAST(greatest(0, least(size, floor(target) - before - source_size)) AS BIGINT) AS t1,
         CAST(before AS DOUBLE) / target AS share
  FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, t0 + t1 AS taken,
       CASE WHEN t0 = 0 THEN NULL ELSE round(CASE k
         WHEN 0 THEN (sqrt(greatest(0, 16 - 4 * (share * 3))) - 4) / -2
         WHEN 1 THEN (sqrt(greatest(0, 0.25::DOUBLE + 2 * (share * 1))) - 0.5::DOUBLE) / 1
         ELSE share * 2 / 2 END, 9) END AS position
FROM taking
"""
