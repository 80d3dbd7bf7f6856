"""Exact percentile of a large column without gathering its values."""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLITS = 64


def _sizes(values: DataFrame, bucket: Column) -> list:
    """(bucket, first value, last value, rows, distinct values) in order; as many as there are buckets."""
    grouped = values.groupBy(bucket.alias("b")).agg(F.min("v"), F.max("v"), F.sum("n"), F.count("v"))
    return sorted(tuple(r) for r in grouped.collect())


def percentile_cont(df: DataFrame, column: str, p: float, weight: Column | None = None, splits: int = _SPLITS) -> float | None:
    """Linear interpolation between the two values around rank ``p * (n - 1)``.

    Distributed selection: values are counted first, with map-side combine, so repeated values cost one row. Each round
    cuts the remaining distinct values into ``splits`` about equal ranges, adds up the rows before each, and goes on with
    the ranges that hold the two ranks; once no more than ``splits`` values remain, each is a range of its own. No task
    and not the driver sees more than one row for each range. ``splits`` is 4 at least, so that each round leaves fewer.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    counts = (
        df.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("v"), weight.alias("w"))
        .groupBy("v")
        .agg(F.sum("w").alias("n"))
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        total, distinct = counts.agg(F.sum("n"), F.count("v")).first()
        if not total:
            return None
        position = p * (total - 1)
        lower = int(position)
        ranks = (lower, min(lower + 1, total - 1))
        rest, before = counts, 0
        while True:
            last_round = distinct <= splits
            if last_round:
                bucket = F.col("v")
            else:
                cuts = sorted(set(rest.agg(F.percentile_approx("v", [i / splits for i in range(1, splits)])).first()[0]))
                bucket = sum((F.when(F.col("v") > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
            held, seen = [], before
            for _, low, high, rows, values in _sizes(rest, bucket):
                if any(seen <= r < seen + rows for r in ranks):
                    held.append((low, high, seen, values, [r for r in ranks if seen <= r < seen + rows]))
                seen += rows
            if last_round or all(low == high for low, high, *_ in held):
                break
            # value ranges are written as constants, so the next round is a plain filter
            rest = rest.filter(F.col("v").between(held[0][0], held[-1][1]))
            before, distinct = held[0][2], sum(h[3] for h in held)
        low_v, high_v = held[0][0], held[-1][1]
        return low_v + (high_v - low_v) * (position - lower)
    finally:
        counts.unpersist()
