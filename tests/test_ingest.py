import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from conftest import rows
from tillwright.operators import ingest

W = "1987-10-19T16:30:00Z"


@pytest.mark.parametrize("hour", ["", "_00", "_16", "_23"])
def test_bound_on_text_key_keeps_the_whole_boundary_day(make, hour):
    days = ["19861231", "19871018", "19871019", "19871020", "19880101"]
    df = make([(day + hour, k) for k, day in enumerate(days)] + [(None, 9)], "date_ts string, k bigint")
    assert [r.k for r in ingest.bound(df, "date_ts", W).orderBy("k").collect()] == [0, 1, 2]


def test_bound_on_time_and_date(make):
    times = make([(datetime(1987, 10, 19, 16, 30),), (datetime(1987, 10, 19, 16, 30, 0, 1),)], "t timestamp")
    assert ingest.bound(times, "t", W).count() == 1
    days = make([(date(1987, 10, 19),), (date(1987, 10, 20),)], "d date")
    assert ingest.bound(days, "d", W).count() == 1


def test_no_bound_passes_everything(make):
    df = make([("20770707_07", "far")], "date_ts string, note string")
    assert ingest.bound(df, "date_ts", None).count() == 1
    assert ingest.bound(df, None, W).count() == 1


@pytest.mark.parametrize(
    "column, upto", [("missing", W), ("date_ts", "not a time"), ("n", W)]
)
def test_bound_that_cannot_be_applied(make, column, upto):
    df = make([("20770707_07", 1)], "date_ts string, n bigint")
    with pytest.raises(ValueError):
        ingest.bound(df, column, upto)
    assert ingest.bound(df, column, upto, strict=False).count() == 1


def test_bound_is_idempotent(make):
    df = make([(f"202405{d:02d}_{h:02d}",) for d in range(25, 31) for h in (0, 23)], "k string")
    once = ingest.bound(df, "k", "2024-05-28T12:00:00Z")
    assert rows(once) == rows(ingest.bound(once, "k", "2024-05-28T12:00:00Z"))


def test_partition_date_from_text(make):
    df = make([("20220807_19",), ("20251231_03",), ("20230229",), ("",), (None,)], "date_ts string")
    out = ingest.partition_date(df, "partition_date", source="date_ts")
    found = {r.date_ts: r.partition_date for r in out.collect()}
    assert found == {
        "20220807_19": date(2022, 8, 7), "20251231_03": date(2025, 12, 31), "20230229": None, "": None, None: None,
    }


def test_partition_date_from_parts(make):
    df = make([(2021, 11, 5), (2024, 2, 29), (2023, 2, 29), (2024, None, 1)], "y bigint, m bigint, d bigint")
    out = ingest.partition_date(df, "p", parts=("y", "m", "d")).collect()
    assert [r.p for r in out] == [date(2021, 11, 5), date(2024, 2, 29), None, None]
    months = make([(2022, 9), (2025, 12)], "post_year bigint, post_month bigint")
    out = ingest.partition_date(months, "p", parts=("post_year", "post_month")).collect()
    assert [r.p for r in out] == [date(2022, 9, 1), date(2025, 12, 1)]


@pytest.mark.parametrize("generated", [True, False])
def test_a_generated_partition_is_the_targets_affair(make, generated):
    """The same rule with and without generation, on sources that lack the column and that bring a wrong one."""
    rule = {"source_cols": ["jahr", "monat"], "target_col": "quartal", "parse_fn": "DATE", "generated_column": generated}
    spec = {"transforms": {"partition_key_conversion": rule}}
    without = make([(1999, 12), (2001, 13)], "jahr int, monat int")
    brought = without.withColumn("quartal", F.lit(date(1900, 1, 1)))
    for df in (without, brought):
        out = ingest.apply_transforms(df, spec, None)
        if generated:
            assert out.columns == ["jahr", "monat"] and rows(out) == rows(without)
        else:
            assert rows(out, "quartal") == [(None,), (date(1999, 12, 1),)]


def test_no_steps_change_nothing(make):
    df = make([("x",)], "col string")
    assert rows(ingest.apply_transforms(df, {"transforms": {}}, None)) == [("x",)]


@pytest.mark.parametrize(
    "value, text",
    [({"colour": "red \"deep\"", "Größe": "42"},) * 2, ({}, {}), ({"gift": None, "tier": ""},) * 2],
)
def test_map_to_json(make, value, text):
    df = make([(value,)], "properties map<string,string>")
    assert json.loads(ingest.map_to_json(df, "properties").first().properties) == text


def test_map_to_json_edges(make):
    df = make([(None,)], "properties map<string,string>")
    assert ingest.map_to_json(df, "properties").first().properties is None
    assert ingest.map_to_json(df, "properties", "p").columns == ["p"]
    text = make([("{}",)], "properties string")
    assert ingest.map_to_json(text, "properties", "p").first().p == "{}"


def test_epoch_to_ts(make):
    df = make([(1650000000500, 1650000000)], "last_updated_ts bigint, s bigint")
    out = ingest.epoch_to_ts(ingest.epoch_to_ts(df, "last_updated_ts"), "s", "seconds")
    assert [f.dataType for f in out.schema] == [TimestampType(), TimestampType()]
    assert tuple(out.select(F.date_format("last_updated_ts", "yyyy-MM-dd HH:mm"), F.unix_seconds("s")).first()) == (
        "2022-04-15 05:20", 1650000000,
    )
    with pytest.raises(ValueError):
        ingest.epoch_to_ts(df, "s", "days")


def test_conform_widens_and_fills(make):
    df = make([(1, "12", "x")], "a int, b string, c string")
    from pyspark.sql.types import StructType

    out = ingest.conform(df, StructType.fromDDL("a bigint, b bigint, c date, d string"))
    assert rows(out) == [(1, 12, None, None)]


def test_steps_work_on_each_other(make):
    """Bound, partition date, map and epoch in one specification; the bound sees the key, not the date made of it."""
    schema = "slot string, labels map<string,string>, seen bigint, n int"
    data = [("19871019_23", {"b": None, "a": "1"}, 0, 1), ("19871020_00", {"a": "2"}, 1, 2), ("1987x", {}, None, 3), (None, None, 2, 4)]
    spec = {
        "transforms": {
            "partition_key_conversion": {"source_col": "slot", "target_col": "tag"},
            "map_to_json": [{"source_col": "labels", "target_col": "labels_json"}],
            "kudu_epoch_conversion": [{"col": "seen", "from_unit": "seconds"}],
        },
        "validation": {"watermark_col": "slot"},
    }
    out = ingest.apply_transforms(make(data, schema), spec, W).collect()
    assert [(r.n, r.tag, json.loads(r.labels_json), r.seen) for r in out] == [(1, date(1987, 10, 19), {"a": "1", "b": None}, datetime(1970, 1, 1))]


def test_json_as_variant(make, spark, tmp_path):
    texts = ['{"a": {"b": [1, "x"]}, "n": 12.50}', "[1, 2]", "null", "no json", "", None, '{"n": "12", "n2": 3}']
    df = ingest.json_to_variant(make(list(enumerate(texts)), "k int, payload string"), "payload")
    df.write.parquet(str(tmp_path / "v"))
    back = spark.read.parquet(str(tmp_path / "v"))
    assert dict(back.dtypes)["payload"] == "variant"
    fields = {"b": ("$.a.b[1]", "string"), "n": ("$.n", "decimal(6,2)"), "whole": ("$.n", "int"), "first": ("$[0]", "int")}
    found = {r.k: r for r in ingest.variant_fields(back.withColumn("none", F.col("payload").isNull()), "payload", fields).collect()}
    assert [found[k].none for k in range(7)] == [False, False, False, True, True, True, False]
    assert (found[0].b, found[0].n, found[0].first) == ("x", Decimal("12.50"), None)
    assert found[1].first == 1 and found[6].whole == 12 and found[2].b is None
    maps = ingest.json_to_variant(make([({"a": "1"},), (None,)], "m map<string,string>"), "m", "v")
    assert maps.columns == ["v"] and [r[0] for r in ingest.variant_fields(maps, "v", {"a": ("$.a", "int")}).select("a").collect()] == [1, None]


def spec_for(path, fmt="textfile_csv", **changes):
    return {
        "source": {"database": "raw", "table": "t", "format": fmt, "path": path},
        "target": {"table": "t"},
        "transforms": {},
        "validation": {},
        **changes,
    }


@pytest.mark.parametrize("section", ["source", "target", "transforms", "validation"])
def test_spec_needs_its_sections(section):
    spec = spec_for("/x")
    del spec[section]
    with pytest.raises(ValueError, match=section):
        ingest.check_spec(spec)


def test_spec_from_file(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "t.yaml").write_text(yaml.dump(spec_for("/x")))
    assert ingest.load_spec(spark, str(tmp_path / "t.yaml"))["source"]["table"] == "t"


def test_load_table(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text("id,date_ts,q\n1,19871018_23,5\n,19871019_01,6\n3,19871020_00,7\n")
    spec = spec_for(
        str(source),
        transforms={
            "partition_key_conversion": {"source_col": "date_ts", "target_col": "partition_date"},
            "type_widening": [{"col": "q", "from": "INT", "to": "INT64"}],
        },
        validation={"watermark_col": "date_ts", "null_check_cols": ["id", "date_ts"]},
    )
    load = ingest.load_table(spark, spec, W, str(target))
    assert load.rows == 2
    assert rows(load.checks, "column", "null_count", "status") == [("date_ts", 0, "PASS"), ("id", 1, "FAIL")]
    assert sorted(p.name for p in target.iterdir() if p.is_dir()) == [
        "partition_date=1987-10-18", "partition_date=1987-10-19",
    ]
    # loading again replaces the table
    assert ingest.load_table(spark, spec, "1987-10-18T00:00:00Z", str(target)).rows == 1
    assert spark.read.parquet(str(target)).count() == 1


def test_catalog_specs_load(spark, tmp_path):
    """A delimited, a JSON and a key-value feed loaded by nothing but the catalog."""
    from tillwright import catalog

    sales, target = tmp_path / "sales", str(tmp_path / "sales-out")
    (sales / "date_ts=19871018_23").mkdir(parents=True)
    head = "invoice_no,stock_code,description,quantity,invoice_date,unit_price,customer_id,country"
    (sales / "date_ts=19871018_23" / "a.csv").write_text(f"{head}\nI1,S,d,2,1987-10-18,1.50,c,US\n,S,d,x,,,,\n")
    table = catalog.table("raw.sales_retail")
    load = ingest.load_table(spark, table.spec(str(sales)), W, target)
    back = spark.read.parquet(target)
    assert load.rows == 2 and dict(back.dtypes) == {f.name: f.dataType.simpleString() for f in table.schema}
    assert rows(back, "quantity", "date_ts", "partition_date") == [
        (2, "19871018_23", date(1987, 10, 18)), (None, "19871018_23", date(1987, 10, 18)),
    ]
    assert rows(load.checks, "column", "null_count") == [("invoice_no", 1)]

    events, target = tmp_path / "events", str(tmp_path / "events-out")
    folder = events / "event_date=19871018" / "hour_bucket=5"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(
        '{"event_id": "e1", "user_id": "u", "event_ts": "1987-10-18T05:00:00Z", "properties": {"k": null},'
        ' "context": {"referrer": "ad"}, "items": [{"sku": "s", "qty": 1, "price": 1.5}]}\n'
    )
    table = catalog.table("raw.mobile_events")
    assert ingest.load_table(spark, table.spec(str(events)), W, target).rows == 1
    row = spark.read.parquet(target).first()
    assert (row.properties, row.context.referrer, row.hour_bucket) == ('{"k":null}', "ad", 5)
    assert row.partition_date == date(1987, 10, 18)

    stock, target = str(tmp_path / "stock"), str(tmp_path / "stock-out")
    kudu = "'w' AS warehouse_id, 's' AS sku, 3 AS on_hand, 1 AS allocated, 2 AS available, 1650000000000 AS last_updated_ts"
    spark.sql(f"SELECT {kudu}").write.parquet(stock)
    assert ingest.load_table(spark, catalog.table("retail.inventory_realtime_snapshot").spec(stock), W, target).rows == 1
    back = spark.read.parquet(target)
    assert dict(back.dtypes)["on_hand"] == "bigint" and back.first().last_updated_ts == datetime(2022, 4, 15, 5, 20)


def test_source_and_target_profiles_agree(make):
    """Hourly keys of one day are one partition on both sides."""
    spec = {
        "source": {},
        "transforms": {"partition_key_conversion": {"source_col": "date_ts", "target_col": "partition_date"}},
        "validation": {"watermark_col": "date_ts"},
    }
    df = make([("19871018_22",), ("19871018_23",), ("19871019_00",), ("19871020_00",)], "date_ts string")
    native = {"source": {"partition_cols": ["sale_date"]}, "validation": {}}
    days = make([(date(2024, 1, 1),), (date(2024, 1, 1),)], "sale_date date")
    plain = make([("x",)], "snapshot_hour string")
    out = ingest.load_profile(
        {"a": df, "b": days, "c": plain},
        {"a": spec, "b": native, "c": {"source": {"partition_cols": ["snapshot_hour"]}}},
        W,
    )
    assert rows(out) == [("a", 3, 2), ("b", 2, 1), ("c", 1, None)]


def test_every_catalog_table_has_a_spec():
    from tillwright import catalog

    for table in catalog.tables().values():
        spec = ingest.check_spec(table.spec("/x"))
        rule = ingest._partition_rule(spec)
        assert (rule["target"] if rule else ingest.native_partition(spec)) == table.partition, table.name


def test_load_reports_what_it_could_not_read(spark, tmp_path):
    lines = ['{"k": "1", "amount": "2.50"}', '{"k": "two", "amount": "3"}', '{"k": "3", "amount": "much"}', '{"k": ', '{"k": null}']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    spec = {
        "source": {"database": "d", "table": "x", "format": "json_serde", "path": str(tmp_path / "in"), "schema": "k string, amount string"},
        "target": {"table": "x", "schema": "k bigint, amount decimal(9,2), later date"},
        "transforms": {"type_widening": [{"col": "k", "from": "STRING", "to": "INT64"}]},
        "validation": {"null_check_cols": ["k"]},
    }
    load = ingest.load_table(spark, spec, None, str(tmp_path / "out"))
    assert load.rows == 5 and load.lost == {"_corrupt_record": 1, "k": 1, "amount": 1}
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["k", "amount", "later"]
    (tmp_path / "none").mkdir()
    nothing = spec | {"source": spec["source"] | {"path": str(tmp_path / "none")}}
    assert ingest.load_table(spark, nothing, None, str(tmp_path / "out2")).lost == {"_corrupt_record": 0, "k": 0, "amount": 0}
