from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillwright import catalog
from tillwright.sources import FORMATS, audit_row, dry_run, read_source, readers, write_table

LINE = r"^([^|]+)\|([^|]+)\|([^|]+)\|([^|]+)\|([^|]+)\|TX:([^;]+);META:(.*)$"
NAMES = ["event_ts_str", "member_id", "event_type", "points", "store_id", "tx_id", "meta_raw"]


def test_ten_formats_and_no_other(spark):
    assert set(FORMATS) == {
        "textfile_csv", "textfile_tsv", "parquet", "avro", "rcfile",
        "sequencefile", "json_serde", "regex_serde", "orc", "kudu",
    }
    with pytest.raises(ValueError, match="no reader"):
        read_source(spark, {"source": {"format": "xml", "path": "/x"}})


def test_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;NULL;x\n2;b;\n")
    spec = {
        "source": {
            "format": "textfile_csv", "path": str(tmp_path), "schema": "id bigint, a string, b string",
            "format_options": {"delimiter": ";", "header": False, "null_value": "NULL"},
        }
    }
    df = read_source(spark, spec)
    assert df.filter("id = 1").first().a is None and df.filter("id = 2").first().a == "b"


def test_csv_without_schema_is_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,d\n1,2024-01-01\n2,\n")
    df = readers.read_csv(spark, str(tmp_path))
    assert [t for _, t in df.dtypes] == ["string", "string"]
    assert rows(df) == [("1", "2024-01-01"), ("2", None)]


def test_tsv_columns_are_numbered_from_one(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\t".join(f"v{i}" for i in range(60)) + "\n")
    df = readers.read_tsv(spark, str(tmp_path), column_count=60)
    assert df.columns == [f"col_{i}" for i in range(1, 61)]
    assert df.first().col_60 == "v59"


def test_json_keeps_broken_lines_and_maps(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "p": {"k": null}}\nnot json\n')
    df = readers.read_json(spark, str(tmp_path), "id bigint, p map<string,string>")
    assert rows(df.filter(F.col(readers.CORRUPT).isNotNull()), "id", readers.CORRUPT) == [(None, "not json")]
    assert df.filter("id = 1").first().p == {"k": None}


def test_regex_lines(spark, tmp_path):
    folder = tmp_path / "date_ts=20230917_06"
    folder.mkdir()
    (folder / "a.txt").write_text(
        "2023-09-17T06:05:59|m-77|REDEEM|-40|s9|TX:t0;META:a=1;b=;c=x y\nno event at all\n"
    )
    df = readers.read_regex(spark, str(tmp_path), LINE, NAMES)
    assert df.columns == [*NAMES, "date_ts"]
    assert rows(df) == [
        ("", "", "", "", "", "", "", "20230917_06"),
        ("2023-09-17T06:05:59", "m-77", "REDEEM", "-40", "s9", "t0", "a=1;b=;c=x y", "20230917_06"),
    ]


def test_directory_values_stay_text(spark, tmp_path):
    spark.range(1).withColumn("date_ts", F.lit("20240101")).write.partitionBy("date_ts").parquet(str(tmp_path / "t"))
    df = readers.read_parquet(spark, str(tmp_path / "t"))
    assert dict(df.dtypes)["date_ts"] == "string"
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_sequence_records(spark, tmp_path):
    path = str(tmp_path / "seq")
    lines = [("k1", "I1|S1|2024-01-01"), ("k2", "I2")]
    spark.sparkContext.parallelize(lines, 1).saveAsSequenceFile(path)
    df = readers.read_sequence(spark, path, ["invoice_no", "supplier_id", "invoice_date"], "|")
    assert rows(df) == [("I1", "S1", "2024-01-01"), ("I2", None, None)]


def test_orc_and_snapshot(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "o"))
    assert read_source(spark, {"source": {"format": "orc", "path": str(tmp_path / "o")}}).count() == 3
    spark.range(2).write.parquet(str(tmp_path / "k"))
    assert read_source(spark, {"source": {"format": "kudu", "gcs_path": str(tmp_path / "k")}}).count() == 2


def test_formats_of_a_metastore_are_read_by_table_name(spark):
    """Which table is asked for; that Spark can read an RCFile table needs a session with Hive, which there is not here."""
    spark.sql("CREATE DATABASE IF NOT EXISTS feeds")
    spark.range(4).write.mode("overwrite").saveAsTable("feeds.named")
    spec = {"source": {"format": "rcfile", "database": "feeds", "table": "named", "path": "/none"}}
    assert "feeds.named" in read_source(spark, spec)._jdf.queryExecution().toString()


def test_bounded_scan_needs_a_bound(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(3).select("id", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("day"))
    days.write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError):
        readers.scan_bounded(df, "day")
    some = readers.scan_bounded(df, "day", "2024-01-02", "2024-01-02")
    assert some.count() == 1
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().toString()


def test_write_table_counts_and_sorts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select(
        "id", (F.col("id") % 7).alias("c"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("day")
    )
    assert write_table(df, path, "day", ["c"]) == 1000
    back = spark.read.parquet(f"{path}/day=2024-01-01")
    assert [r.c for r in back.collect()] == sorted(r.c for r in back.collect())
    assert spark.read.parquet(path).count() == 1000


def test_empty_input_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(5), path) == 5
    assert write_table(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 5


def test_hot_partition_is_split(spark, tmp_path):
    """Half of the rows share one date; its file is written by several tasks."""
    path = str(tmp_path / "t")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
            F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("part"),
        )
        assert write_table(df, path, "part") == 200_000
    finally:
        spark.conf.set(key, before)
    import os

    assert len([f for f in os.listdir(f"{path}/part=0") if f.endswith(".parquet")]) > 1


def test_dry_run_and_audit_row(spark):
    run = dry_run(spark.range(8))
    assert (run.rows, len(run.preview)) == (8, 5) and "id: long" in run.schema
    row = audit_row(spark, "2024-06-01T00:00:00Z", 100, "run-1", completed_at=datetime(2024, 6, 2)).first()
    assert (row.total_tables_loaded, row.dag_run_id) == (100, "run-1")
    assert row.frozen_watermark_w.date() == date(2024, 6, 1)


def test_catalog_is_complete(spark):
    tables = catalog.tables()
    assert len(tables) == 100
    assert sum(t.partition is not None for t in tables.values()) == 65
    assert sum(bool(t.generated_from) for t in tables.values()) == 9
    assert sum(len(t.json_columns) for t in tables.values()) == 10
    assert sum(t.must_bound for t in tables.values()) == 11
    assert sum(len(t.keys) for t in tables.values()) == 176
    for t in tables.values():
        names = t.schema.names
        wanted = {*t.keys, *t.cluster, *t.json_columns, *t.generated_from}
        wanted |= {x for x in (t.partition, t.bound_column) if x}
        assert wanted <= set(names), t.name
    assert len(catalog.table("raw.omniture_logs").schema) == 62
    with pytest.raises(KeyError):
        catalog.table("raw.nothing")


def test_tables_that_must_be_bounded(make):
    strict = [t for t in catalog.tables().values() if t.must_bound]
    assert len(strict) == 11
    free = next(t for t in catalog.tables().values() if not t.must_bound)
    days = make([("2024-01-01",), ("2024-02-01",)], "d string").select(F.to_date("d").alias("d"))
    for t in strict:
        df = days.withColumnRenamed("d", t.partition or t.bound_column)
        with pytest.raises(ValueError):
            t.scan(df)
        assert t.scan(df, low="2024-01-15").count() == 1
    assert free.scan(days).count() == 2
