"""Writing tables: keyed, partitioned, CSV, views, retention."""

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthgrid.operators.merge import latest_per_key
from hearthgrid.session import folders, planned_bytes, remove, scratch
from hearthgrid.sources.files import home_bucket

_PLAIN = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BooleanType,
    T.DecimalType,
    T.StringType,
)


def plain_types(df: DataFrame) -> DataFrame:
    """Columns of the exported type set; anything else becomes a string, nested values as JSON."""

    def column(field) -> Column:
        kind = field.dataType
        if isinstance(kind, _PLAIN):
            return F.col(field.name)
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(F.col(field.name)).alias(field.name)
        if isinstance(kind, T.BinaryType):
            return F.base64(F.col(field.name)).alias(field.name)
        return F.col(field.name).cast("string").alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def keyed(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """One row per key. The greatest ``order`` values win, then all remaining columns decide."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return latest_per_key(df, keys, [F.col(c) for c in [*order, *rest]])


#: Bytes of repeated hashes that are sent to all tasks; with more, all rows are shuffled.
REPEATED_BYTES = 32 << 20


def repeated_hashes(hashed: DataFrame) -> DataFrame:
    """Values of _hash that occur more than once."""
    return hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_hash")


def export_keyed(df: DataFrame, path: str, name: str, keys: list[str], order: list[str] = ()) -> dict:
    """Replace a table by one with a unique key.

    Rows are read twice: hashes of keys tell which of them occur more than once, and only rows with such a hash are
    shuffled whole, the others are written where they are read.
    """
    started = time.perf_counter()
    spark, rows = df.sparkSession, plain_types(df)
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    listed = scratch(spark, "repeated")
    repeated_hashes(hashed).write.mode("overwrite").parquet(listed)
    repeated = spark.read.schema("_hash bigint").parquet(listed)
    if planned_bytes(repeated) <= REPEATED_BYTES:
        several = hashed.join(F.broadcast(repeated), "_hash", "left_semi").select(*rows.columns)
        out = hashed.join(F.broadcast(repeated), "_hash", "left_anti").select(*rows.columns).unionByName(keyed(several, keys, order))
    else:
        out = keyed(rows, keys, order)
    out.write.mode("overwrite").parquet(f"{path}/{name}")
    remove(spark, listed)
    rows = df.sparkSession.read.parquet(f"{path}/{name}").count()
    return {"table": name, "rows_exported": rows, "write_time_s": time.perf_counter() - started}


def export_all(exports: list[tuple], path: str) -> dict:
    """Export (DataFrame, name, keys) triples and total the figures."""
    results = [export_keyed(df, path, name, keys) for df, name, keys in exports]
    return {
        "tables": results,
        "rows_exported": sum(r["rows_exported"] for r in results),
        "write_time_s": sum(r["write_time_s"] for r in results),
    }


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Hive layout without one small file per task and folder.

    The rebalance hint shuffles by the folder columns, joins small partitions and splits large
    ones, so a folder holding much of the table is written by several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 10_000_000)
        .partitionBy(*by)
        .parquet(path)
    )


def with_home_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """A folder column for tables with very many homes: each bucket holds many homes, so the
    number of folders does not grow with them. Use it in place of home_id when partitioning."""
    return df.withColumn("home_bucket", home_bucket(F.col("home_id"), buckets))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def create_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A named view over an exported table."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def create_views(spark: SparkSession, path: str, names: list[str]) -> None:
    for name in names:
        create_view(spark, f"{path}/{name}", name)


def within_retention(df: DataFrame, days: int, time_column: str = "timestamp") -> DataFrame:
    """Rows of the last ``days`` days before the newest row."""
    newest = df.agg(F.max(time_column)).first()[0]
    if newest is None:
        return df
    limit = F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")
    return df.filter(F.col(time_column) >= limit)


def expire(spark: SparkSession, path: str, days: int, schema, time_column: str = "timestamp", partition: str = "day") -> dict:
    """Remove what is older than ``days`` days before the newest row from a table in folders by day.

    Folders are listed, not scanned: those whose whole day has expired are deleted, and only the folder of the day that
    the limit falls into is read and written again. The newest row is looked for in the newest folder alone. ``schema``
    is that of the rows, without the folder column. Doing it again changes nothing; a failure leaves a table from which
    some expired rows are gone, which the next run completes.
    """
    found = {}
    for name in folders(spark, path):
        key, _, value = name.partition("=")
        if key == partition and not value.startswith("__"):
            found[dt.date.fromisoformat(value)] = f"{path}/{name}"
    done = {"removed": 0, "rewritten": 0}
    if not found:
        return done
    read = lambda day: spark.read.schema(schema).parquet(found[day])
    newest = read(max(found)).agg(F.max(time_column)).first()[0]
    if newest is None:
        return done
    limit = newest - dt.timedelta(days=days)
    for day in sorted(d for d in found if d < limit.date()):
        remove(spark, found.pop(day))
        done["removed"] += 1
    if limit.date() in found:
        edge = limit.date()
        old = F.col(time_column) < F.lit(limit).cast("timestamp_ntz")
        if not read(edge).filter(old).isEmpty():
            staging = f"{path}/_expiring"
            read(edge).filter(~old).write.mode("overwrite").parquet(staging)
            spark.read.schema(schema).parquet(staging).write.mode("overwrite").parquet(found[edge])
            remove(spark, staging)
            done["rewritten"] += 1
    return done
