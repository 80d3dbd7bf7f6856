"""Shared folder, distributed running sums and text columns of the training-data operators."""

import ctypes
import gc
import math
import os
import shutil
import tempfile
import uuid
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthgrid import session

#: White space of all word rules: blank and the code points 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
#: Bytes of a batch that is handed to Python.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)
#: Rows that one window of a running sum should hold.
WINDOW_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """Write rows below the shared folder and read them back, which cuts the lineage.

    The folder goes when the application ends. `free`: shuffle files of plans that are done are to go at once.
    """
    spark = df.sparkSession
    path = f"{session.work_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    if free:
        sweep(spark)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application; Spark serves the file to all executors."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="hearthgrid-code-")
        parent, name = os.path.split(package)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", parent, name))
        _shipped.add(application)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with batches limited by bytes, as texts may be long, and memory given back at the end of a task."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_KEY, None) != BATCH_BYTES:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers stay, and what they keep adds up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def map_sorted(df: DataFrame, key: str, function, schema) -> DataFrame:
    """Call `function` with all rows of each key (an Arrow table; bounded by what `df` puts under a key).

    Rows are sorted by key inside partitions and streamed, so a task holds one key and one batch at a time. The number of
    tasks is stated, as work for each row is great and small partitions are not to be joined.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stream(batches):
        held, number = [], None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and keys[a] != number:
                    yield from function(pa.Table.from_batches(held))
                    held = []
                number = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from function(pa.Table.from_batches(held))

    return map_arrow(df.repartition(tasks, key).sortWithinPartitions(key), stream, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) is connected with.

    Alternating stars: each node hands its neighbours the smallest one it knows, first to the larger and then to the
    smaller side, until every link points to a root. Links never grow in number; rounds grow with their logarithm.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, state = keep(links, "links"), None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionAll(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        following = keep(small, "links")
        drop_kept(links)
        links = following
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def drop_kept(df: DataFrame) -> None:
    """Remove what keep() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Columns that the pipeline's stages read or change.
READ = ("doc_id", "text", "source", "n_chars")


def apart(stage):
    """A stage whose own columns can't meet those of its input: others than READ have names of their own inside it."""

    @wraps(stage)
    def run(docs: DataFrame, *more) -> DataFrame:
        token = uuid.uuid4().hex[:12]
        names = {c: f"_{i}_{token}" for i, c in enumerate(docs.columns) if c not in READ}
        out = stage(docs.withColumnsRenamed(names), *more)
        return out.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)

    return run


def words(text: Column) -> Column:
    """Words of a text, maximal runs of anything but white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def order_key(column: Column) -> Column:
    """60 bits of the MD5 of a value as text (null: the text null), the same in other SQL engines."""
    text = F.coalesce(column.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, key: str, order: str, ties: list[str], value: str, rows: int, out: str) -> DataFrame:
    """Add the sum of `value` over the rows of the same key that come before, by `order` and `ties`.

    `order` holds 60 evenly spread bits, `key` is not null. Each key is cut into 1024 ranges of `order`, each of
    these into as many as keep a window near WINDOW_ROWS rows, so no window holds a hot key whole.
    """
    bits = max(0, math.ceil(math.log2(max(1, rows / 1024 / WINDOW_ROWS))))
    high, low = F.shiftright(order, 50), F.shiftright(order, 50 - bits)
    cut = df.withColumns({"_high": high, "_low": low})
    before = (Window.unboundedPreceding, -1)
    inner = Window.partitionBy(key, "_low").orderBy(order, *ties).rowsBetween(*before)
    totals = cut.groupBy(key, "_high", "_low").agg(F.sum(value).alias("_sum"))
    tops = totals.groupBy(key, "_high").agg(F.sum("_sum").alias("_top"))
    across = Window.partitionBy(key, "_high").orderBy("_low").rowsBetween(*before)
    over = Window.partitionBy(key).orderBy("_high").rowsBetween(*before)
    offsets = (
        totals.withColumn("_mid", F.coalesce(F.sum("_sum").over(across), F.lit(0)))
        .join(tops.withColumn("_first", F.coalesce(F.sum("_top").over(over), F.lit(0))), [key, "_high"])
        .select(key, "_low", (F.col("_mid") + F.col("_first")).alias("_offset"))
    )
    inside = cut.withColumn("_inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (
        inside.join(offsets, [key, "_low"])
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_high", "_low", "_inside", "_offset")
    )
