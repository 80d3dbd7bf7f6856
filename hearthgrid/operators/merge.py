"""Keyed merge and incremental load over plain Parquet."""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthgrid.session import exists, remove


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    The limit of one row per key is applied in the map stage first, so a key with very many copies sends one row per
    task; each column travels once.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], ties: list[str] = ()) -> DataFrame:
    """Target after the merge: rows of the batch replace rows with the same key.

    Within one side the greatest ``ties`` win, then the remaining columns decide, so the result
    does not depend on the order of the rows, and a repeated merge changes nothing. Each side is reduced to its own rows
    first: a side that was merged before lies by its keys already and is not shuffled again, and a batch that several
    merges of a plan take is shuffled once.
    """
    order = [F.col(c) for c in [*ties, *(c for c in target.columns if c not in keys and c not in ties)]]
    own, new = (latest_per_key(side, keys, order).withColumn("_batch", F.lit(n)) for n, side in enumerate((target, batch)))
    return latest_per_key(own.unionByName(new), keys, [F.col("_batch")]).drop("_batch")


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str], blank: list[str] = ()) -> DataFrame:
    """Target plus the batch rows whose key it does not hold; ``blank`` columns arrive as null.

    The target's keys are reduced to those of the batch first: where the planner finds the batch small enough to send
    its keys to all tasks, the target is scanned in place and only the few keys that meet are shuffled.
    """
    nulls = {c: F.lit(None).cast(batch.schema[c].dataType) for c in blank}
    met = target.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi")
    fresh = batch.join(met.distinct(), keys, "left_anti").select(*batch.columns)
    return target.unionByName(fresh.withColumns(nulls) if nulls else fresh)


def high_water(target: DataFrame, time: str, per: list[str] = ()) -> DataFrame:
    """Latest loaded time, per key where given."""
    return target.groupBy(*per).agg(F.max(time).alias("_loaded_to"))


def newer_than(
    batch: DataFrame, target: DataFrame, time: str, per: list[str] = (), start: str | None = None
) -> DataFrame:
    """Rows of the batch after the latest loaded time of their key.

    A key that was never loaded is taken whole, or from `start` on where given. `target` may be the loaded table or a
    small table of marks kept by `advance`.
    """
    first = F.lit(True) if start is None else F.col(time) > F.lit(start).cast("timestamp_ntz")
    mark = target if "_loaded_to" in target.columns else high_water(target, time, per)
    joined = batch.join(mark, list(per), "left") if per else batch.join(F.broadcast(mark))
    newer = F.when(F.col("_loaded_to").isNull(), first).otherwise(F.col(time) > F.col("_loaded_to"))
    return joined.filter(newer).select(*batch.columns)


def advance(marks: DataFrame, batch: DataFrame, time: str, per: list[str]) -> DataFrame:
    """Marks (one row per key) after a load, from the old marks and the batch alone."""
    fresh = high_water(batch, time, per)
    return marks.unionByName(fresh).groupBy(*per).agg(F.max("_loaded_to").alias("_loaded_to"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty for a merged table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def merge_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    partition: str,
    staging: str,
) -> None:
    """Merge a batch into a table partitioned by ``partition``, rewriting only touched partitions.

    The merged partitions are written to ``staging`` first and then replace the old ones one after the other, so the
    folder being read is never overwritten. A failure before the replacement leaves the table as it was, one during it
    leaves some partitions new; repeating the merge completes it. ``staging`` is removed at the end. All rows of a key
    must lie in one partition, as with a day or month of an event time in the key.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for its partitions, then merged
    try:
        if exists(spark, path):
            touched = [r[0] for r in batch.select(partition).distinct().collect()]  # one value per folder
            schema = T.StructType([f for f in batch.schema.fields if f.name != partition] + [batch.schema[partition]])
            current = spark.read.schema(schema).parquet(path).filter(F.col(partition).isin(touched))
        else:
            current = batch.limit(0)
        upsert(current.select(*batch.columns), batch, keys).write.mode("overwrite").parquet(staging)
    finally:
        batch.unpersist()
    # a partition may hold much of the table: the hint lets several tasks write it
    (
        spark.read.parquet(staging)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    remove(spark, staging)
