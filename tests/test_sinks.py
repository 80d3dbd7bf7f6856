"""Written tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from hearthgrid.sinks import tables

T = dt.datetime(2024, 1, 1)


def facts(spark, n=100):
    data = [(f"h{i % 2}", T + dt.timedelta(hours=i % 40), "d", float(i)) for i in range(n)]
    return spark.createDataFrame(data, "home_id string, timestamp timestamp_ntz, device_id string, kwh double")


def test_keyed_export_is_unique_and_repeatable(spark, tmp_path, rows):
    df = facts(spark)
    stats = tables.export_keyed(df, str(tmp_path), "fct", ["home_id", "timestamp"])
    first = rows(spark.read.parquet(str(tmp_path / "fct")))
    assert stats["rows_exported"] == len(first) == len({r[:2] for r in first}) == 40
    tables.export_keyed(df.repartition(7, "kwh"), str(tmp_path), "fct", ["home_id", "timestamp"])
    assert rows(spark.read.parquet(str(tmp_path / "fct"))) == first
    # the greatest of the remaining columns wins
    assert max(r[3] for r in first) == 99.0


def test_export_all_totals(spark, tmp_path):
    df = facts(spark)
    stats = tables.export_all([(df, "a", ["home_id"]), (df, "b", ["timestamp"])], str(tmp_path))
    assert stats["rows_exported"] == 2 + 40 and len(stats["tables"]) == 2


def test_partitioned_layout(spark, tmp_path, rows):
    df = facts(spark).withColumn("year", F.year("timestamp"))
    path = tmp_path / "p"
    tables.write_partitioned(df, str(path), ["home_id", "year"])
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["home_id=h0", "home_id=h1"]
    assert len([f for f in os.listdir(path / "home_id=h0" / "year=2024") if f.endswith(".parquet")]) == 1
    assert rows(spark.read.parquet(str(path)).select(*df.columns)) == rows(df)


def test_csv_round_trip(spark, tmp_path, rows):
    df = facts(spark)
    tables.write_csv(df, str(tmp_path / "c"))
    assert rows(spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "c"))) == rows(df)


def test_views(spark, tmp_path):
    facts(spark).write.parquet(f"{tmp_path}/some_view")
    tables.create_views(spark, str(tmp_path), ["some_view"])
    assert spark.sql("select count(*) from some_view").first()[0] == 100


def test_plain_types(spark):
    df = spark.range(1).selectExpr(
        "id", "array(1, 2) a", "named_struct('x', 1) s", "map('k', 1) m", "cast('ab' as binary) b",
        "interval 1 hour i", "cast(1.5 as decimal(5, 2)) d",
    )
    out = tables.plain_types(df)
    assert dict(out.dtypes) == {
        "id": "bigint", "a": "string", "s": "string", "m": "string", "b": "string", "i": "string", "d": "decimal(5,2)",
    }
    assert tuple(out.select("a", "s", "m").first()) == ("[1,2]", '{"x":1}', '{"k":1}')


def test_retention(spark):
    kept = tables.within_retention(facts(spark), 1)
    assert kept.agg(F.min("timestamp")).first()[0] == T + dt.timedelta(hours=39 - 24)
    assert tables.within_retention(facts(spark).limit(0), 1).count() == 0


def test_only_rows_of_repeated_keys_are_shuffled_for_an_export(spark, tmp_path, rows, monkeypatch):
    """F16: rows whose key occurs once are written where they are read; null keys and repeats come out as before."""
    data = [(None if i % 9 == 0 else f"h{i % 40}", None if i % 11 == 0 else i // 3 % 7, float(i % 5)) for i in range(300)] + [("lone", 1, 2.0)]
    df = spark.createDataFrame(data, "home_id string, at int, kwh double")
    sent = []
    plain = tables.keyed
    monkeypatch.setattr(tables, "keyed", lambda rows, *a: sent.append(rows) or plain(rows, *a))
    want = rows(plain(df, ["home_id", "at"]))
    for limit in (tables.REPEATED_BYTES, 0):  # with too many repeated keys all rows are shuffled
        monkeypatch.setattr(tables, "REPEATED_BYTES", limit)
        stats = tables.export_keyed(df, str(tmp_path), f"t{limit}", ["home_id", "at"])
        assert rows(spark.read.parquet(str(tmp_path / f"t{limit}"))) == want and stats["rows_exported"] == len(want)
    assert sent[1].count() == len(data)
    # its hashes are removed with the export, so the plan is looked at, not run
    assert "LeftSemi" in sent[0]._jdf.queryExecution().optimizedPlan().toString()
