"""Keyed tables laid out by their key, so that a merge moves the batch alone.

A table is bucketed and sorted by its primary key. The merge takes away from the target what the batch replaces and adds
the batch; the batch is shuffled to the target's buckets, the target is read bucket by bucket where it lies, and what is
written goes to the same buckets. A merge writes a new version, so the one being read stays until it is dropped.

Key columns hold no nulls, as in any primary key; a batch row without its key is refused.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid.operators.merge import latest_per_key
from hearthgrid.session import planned_bytes


#: Bytes of a table, by the planner's estimate, that one bucket holds; a task sorts one bucket as rows, which are wider.
BUCKET_BYTES = 16 << 20


def buckets_for(df: DataFrame, at_least: int) -> int:
    """Number of buckets that keeps a bucket at the same size however large the table is."""
    return max(at_least, -(-planned_bytes(df) // BUCKET_BYTES))


def newest_per_key(batch: DataFrame, keys: list[str], ties: list[str] = ()) -> DataFrame:
    """One row per key; the greatest ``ties`` win, then the remaining columns."""
    rest = [c for c in batch.columns if c not in keys and c not in ties]
    return latest_per_key(batch, keys, [F.col(c) for c in [*ties, *rest]])


def _write(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def create(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, ties: list[str] = ()) -> DataFrame:
    """A bucketed table of unique keys."""
    once = newest_per_key(df, keys, ties)
    _write(once.repartition(buckets, *keys), name, path, keys, buckets)
    return df.sparkSession.table(name)


def merged(target: DataFrame, batch: DataFrame, keys: list[str], buckets: int, ties: list[str] = ()) -> DataFrame:
    """Target after the merge, still in its buckets."""
    missing = F.lit(False)
    for c in keys:
        missing |= F.col(c).isNull()
    checked = batch.filter(F.when(missing, F.raise_error(F.lit("a batch row has no key")).cast("boolean")).otherwise(F.lit(True)))
    fresh = newest_per_key(checked, keys, ties).repartition(buckets, *keys)
    kept = target.join(fresh.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(fresh.select(*target.columns))


def merge(spark: SparkSession, old: str, new: str, path: str, batch: DataFrame, keys: list[str], buckets: int, ties: list[str] = ()) -> DataFrame:
    """Merge a batch into table ``old`` and write the outcome as table ``new`` below ``path``."""
    _write(merged(spark.table(old), batch, keys, buckets, ties), new, path, keys, buckets)
    return spark.table(new)
