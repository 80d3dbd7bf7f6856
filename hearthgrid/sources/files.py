"""Configured meter files, exported tables, grid tables, and the registry of readers."""

from collections import Counter, defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid.plans.staging import grid_intensity
from hearthgrid.session import exists, file_key, file_length, qualified
from hearthgrid.sources import espi_xml, meter_csv

DEFAULT_FORMAT = "greenbutton_xml"

# format name -> load(spark, paths, homes); add an entry to support another meter export
READERS = {
    "greenbutton_xml": espi_xml.read,
    "enova_csv": meter_csv.read,
}


def file_lengths(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Lengths of those of the (qualified) files that hold something.

    Their folders are listed, by Spark's parallel listing and without reading a file, so there is no call to the file
    system for each of very many files; the driver gets the configured ones alone.
    """
    parents = [p for p in sorted({p.rsplit("/", 1)[0] for p in paths}) if exists(spark, unquote(p))]
    if not parents:
        return {}
    listed = spark.read.format("binaryFile").load([unquote(p) for p in parents])
    listed = listed.select(file_key(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("length"))
    wanted = spark.createDataFrame([(p,) for p in set(paths)], "path string")
    return {r["path"]: r["length"] for r in listed.join(wanted, "path", "left_semi").collect()}


def plan_files(spark: SparkSession, files: list[dict]) -> tuple[dict, list]:
    """Usable files by format, and (path, reason) for the others."""
    by_format, skipped = defaultdict(list), []
    known = {entry["path"]: qualified(spark, entry["path"]) for entry in files}
    lengths = file_lengths(spark, list(known.values()))
    for entry in files:
        kind = entry.get("format", DEFAULT_FORMAT)
        length = lengths.get(known[entry["path"]])
        if length is None:  # a listing leaves out empty files; missing and empty ones are the exception
            length = file_length(spark, entry["path"])
        if length is None:
            skipped.append((entry["path"], "file not found"))
        elif length == 0:
            skipped.append((entry["path"], "file is empty"))
        elif kind not in READERS:
            skipped.append((entry["path"], f"unknown format {kind}"))
        else:
            by_format[kind].append(entry)
    return dict(by_format), skipped


def read_configured(spark: SparkSession, files: list[dict]) -> tuple[DataFrame, list]:
    """Readings of all configured files, one scan per format.

    Each entry has path, home_id and optionally format; files are told apart by their whole path.
    """
    by_format, skipped = plan_files(spark, files)
    parts = []
    for kind, entries in by_format.items():
        pairs = [(qualified(spark, e["path"]), e["home_id"]) for e in entries]
        if twice := {p for p, n in Counter(p for p, _ in pairs).items() if n > 1}:
            raise ValueError(f"files listed twice: {sorted(twice)}")
        homes = spark.createDataFrame(pairs, "file_path string, home_id string")
        parts.append(READERS[kind](spark, [e["path"] for e in entries], homes))
    if not parts:
        return schemas.empty(spark, "green_button_interval_readings"), skipped
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), skipped


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Hourly grid intensity, hours without intensity left out."""
    return grid_intensity(spark.read.schema(schemas.GRID).parquet(path))


def home_bucket(home_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(home_id), F.lit(buckets)).cast("int")


def read_lake(spark: SparkSession, path: str, home_id: str | None = None, buckets: int | None = None) -> DataFrame:
    """A partitioned table; filters on its partition columns skip whole folders.

    For one home of a table laid out by ``home_bucket`` pass the number of buckets.
    """
    lake = spark.read.parquet(path)
    if home_id is None:
        return lake
    if buckets:
        lake = lake.filter(F.col("home_bucket") == home_bucket(F.lit(home_id), buckets))
    return lake.filter(F.col("home_id") == home_id)
