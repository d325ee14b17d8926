"""Ingest steps between a source and its table, in the order they are applied."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.dates import date_of_key
from tillwright.operators.checks import null_keys, profile
from tillwright.sources.readers import CORRUPT, read_source
from tillwright.sources.writers import write_counted

log = logging.getLogger(__name__)

# Sorts after every hour suffix of its day.
END_OF_DAY = "_99"


# The greatest value that a bound keeps, by the type of its column, given the bound's text and its day.
_LIMITS = {
    "string": lambda _, day: F.lit(f"{day:%Y%m%d}{END_OF_DAY}"),
    "timestamp": lambda text, _: F.to_timestamp(F.lit(text)),
    "timestamp_ntz": lambda text, _: F.to_timestamp(F.lit(text)).cast("timestamp_ntz"),
    "date": lambda _, day: F.lit(day),
}


def _limit(df: DataFrame, column: str, upto: str) -> Column:
    kind = dict(df.dtypes).get(column, "missing")
    if kind not in _LIMITS:
        raise ValueError(f"no bound on column {column!r} ({kind})")
    return _LIMITS[kind](upto, datetime.fromisoformat(upto).date())


def bound(df: DataFrame, column: str | None, upto: str | None, strict: bool = True) -> DataFrame:
    """Keep rows up to the frozen load bound ``upto`` (ISO time).

    String keys (``yyyyMMdd`` or ``yyyyMMdd_HH``) keep the whole boundary day. Without a
    bound or a bound column everything passes. A bound that cannot be applied raises;
    with ``strict=False`` it is logged and the full table passes.
    """
    if not (column and upto):
        return df
    try:
        return df.filter(F.col(column) <= _limit(df, column, upto))
    except ValueError as reason:
        if strict:
            raise
        log.warning("%s; the whole table passes", reason)
        return df


def date_of_parts(parts: Sequence[str]) -> Column:
    """Date of year, month and optional day columns; null when they make no date."""
    if len(parts) not in (2, 3):
        raise ValueError(f"year, month and optional day expected, got {list(parts)}")
    year, month, *day = [F.col(p).cast("int").cast("string") for p in parts]
    text = F.concat_ws("-", F.lpad(year, 4, "0"), month, day[0] if day else F.lit("1"))
    complete = year.isNotNull() & month.isNotNull() & (day[0].isNotNull() if day else F.lit(True))
    return F.when(complete, F.try_to_date(text, "yyyy-M-d"))


def partition_date(
    df: DataFrame,
    target: str,
    source: str | None = None,
    parts: Sequence[str] = (),
    generated: bool = False,
) -> DataFrame:
    """Add the partition date; a generated one is left to the writer."""
    if generated:
        return df
    if parts:
        return df.withColumn(target, date_of_parts(parts))
    if source is None or source not in df.columns:
        raise ValueError(f"partition source column {source!r} is not in the data")
    return df.withColumn(target, date_of_key(source))


def map_to_json(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Map column to JSON text. Null maps stay null, null values are kept; other types only get the new name."""
    target = target or source
    if isinstance(df.schema[source].dataType, T.MapType):
        as_json = F.to_json(F.col(source), {"ignoreNullFields": "false"})
        df = df.withColumn(target, as_json)
        return df if target == source else df.drop(source)
    return df.withColumnRenamed(source, target)


def json_to_variant(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """JSON text, or a map, to a VARIANT column, parsed once when the table is written.

    Null stays null, the JSON word ``null`` becomes a variant that holds null, and text that is no JSON becomes null;
    ``checks.conformance`` run on the input counts those.
    """
    target = target or source
    df = map_to_json(df, source, target)
    return df.withColumn(target, F.try_parse_json(F.col(target)))


def variant_fields(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns out of a VARIANT column; ``fields`` gives path and type by name.

    A missing field, a null and a value that does not fit the type are null.
    """
    return df.withColumns({name: F.try_variant_get(F.col(column), path, kind) for name, (path, kind) in fields.items()})


_FROM_EPOCH = {
    "millis": F.timestamp_millis,
    "seconds": F.timestamp_seconds,
    "micros": F.timestamp_micros,
}


def epoch_to_ts(df: DataFrame, column: str, unit: str = "millis") -> DataFrame:
    if unit not in _FROM_EPOCH:
        raise ValueError(f"unknown epoch unit {unit!r}; known units: {', '.join(_FROM_EPOCH)}")
    return df.withColumn(column, _FROM_EPOCH[unit](F.col(column).cast("bigint")))


def drop_generated(df: DataFrame, target: str | None, generated: bool) -> DataFrame:
    """Drop a partition column the target computes itself."""
    return df.drop(target) if generated and target else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto the declared columns and types; missing columns become null.

    Casts that cannot be done give null, so that ``checks.conformance`` run on the
    input is what reports them.
    """
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def _partition_rule(spec: Mapping[str, Any]) -> dict[str, Any] | None:
    rule = (spec.get("transforms") or {}).get("partition_key_conversion")
    if not rule:
        return None
    by_parts = rule.get("parse_fn", "PARSE_DATE") == "DATE"
    return {
        "target": rule["target_col"],
        "source": None if by_parts else rule.get("source_col"),
        "parts": tuple(rule.get("source_cols") or ()) if by_parts else (),
        "generated": bool(rule.get("generated_column", False)),
    }


def apply_transforms(
    df: DataFrame, spec: Mapping[str, Any], upto: str | None, strict: bool = True
) -> DataFrame:
    """All steps of a table specification: bound, partition date, maps, epochs, generated columns."""
    transforms = spec.get("transforms") or {}
    rule = _partition_rule(spec)
    df = bound(df, (spec.get("validation") or {}).get("watermark_col"), upto, strict)
    if rule:
        df = partition_date(df, **rule)
    for entry in transforms.get("map_to_json") or ():
        if entry["source_col"] in df.columns:
            df = map_to_json(df, entry["source_col"], entry.get("target_col"))
    for entry in transforms.get("kudu_epoch_conversion") or ():
        if entry["col"] in df.columns:
            df = epoch_to_ts(df, entry["col"], entry.get("from_unit", "millis"))
    for entry in transforms.get("type_widening") or ():
        if entry["col"] in df.columns and entry.get("to") == "INT64":
            df = df.withColumn(entry["col"], F.col(entry["col"]).try_cast("bigint"))
    return drop_generated(df, rule["target"], rule["generated"]) if rule else df


# Sections and keys a table specification must have.
REQUIRED_SECTIONS = ("source", "target", "transforms", "validation")
REQUIRED_SOURCE_KEYS = ("database", "table", "format")


def check_spec(spec: Mapping[str, Any], where: str = "specification") -> Mapping[str, Any]:
    for section in REQUIRED_SECTIONS:
        if section not in spec:
            raise ValueError(f"{where}: section {section!r} is missing")
    for key in REQUIRED_SOURCE_KEYS:
        if key not in spec["source"]:
            raise ValueError(f"{where}: source key {key!r} is missing")
    if not ({"path", "gcs_path"} & set(spec["source"])):
        raise ValueError(f"{where}: source path is missing")
    if "table" not in spec["target"]:
        raise ValueError(f"{where}: target key 'table' is missing")
    return spec


def load_spec(spark: SparkSession, path: str) -> Mapping[str, Any]:
    """Read one specification (YAML or JSON) from any file system Spark can reach."""
    import yaml

    text = "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    return check_spec(yaml.safe_load(text), path)


class Load(NamedTuple):
    """Rows written, the null-key check, and per column how many written rows lost their value
    because it could not be read (``_corrupt_record``: whole lines)."""

    rows: int
    checks: DataFrame | None
    lost: Mapping[str, int] = {}


_LOST = "_lost_values"


def _unreadable(column: str, kind: T.DataType | str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def load_table(
    spark: SparkSession,
    spec: Mapping[str, Any],
    upto: str | None,
    target_path: str,
    cluster: Sequence[str] = (),
    strict: bool = True,
) -> Load:
    """Read, transform and write one table, then set up its null-key check on what was written.

    A schema in the target section types the columns; cluster columns may stand there too.
    Values that the types cannot hold become null and corrupt lines become null rows; both are
    counted in the pass that writes.
    """
    check_spec(spec)
    df = read_source(spark, spec)
    lost = {CORRUPT: F.col(CORRUPT).isNotNull()} if CORRUPT in df.columns else {}
    for entry in (spec.get("transforms") or {}).get("type_widening") or ():
        if entry["col"] in df.columns and entry.get("to") == "INT64":
            lost[entry["col"]] = _unreadable(entry["col"], "bigint")
    # as rows of the source: the transforms below may change or drop the columns
    df = df.withColumn(_LOST, F.struct(F.lit(False).alias("_"), *[c.alias(name) for name, c in lost.items()]))
    df = apply_transforms(df, spec, upto, strict)
    rule = _partition_rule(spec)
    if rule and rule["generated"]:
        # Parquet has no generated columns, so the layout column is computed here
        df = partition_date(df, rule["target"], rule["source"], rule["parts"])
    partition = rule["target"] if rule else native_partition(spec)
    if spec["target"].get("schema"):
        schema = T.StructType.fromDDL(spec["target"]["schema"])
        for field in schema.fields:
            if field.name in df.columns and df.schema[field.name].dataType != field.dataType:
                bad = _unreadable(field.name, field.dataType)
                lost[field.name] = F.col(_LOST)[field.name] | bad if field.name in lost else bad
                df = df.withColumn(_LOST, F.col(_LOST).withField(field.name, lost[field.name]))
        flags = df.schema[_LOST]
        df = conform(df, T.StructType([*schema.fields, flags]))
    counts = {name: F.count_if(F.col(_LOST)[name]) for name in lost}
    found = write_counted(
        df, target_path, partition, cluster or spec["target"].get("cluster") or (), counts, [_LOST]
    )
    rows = found.pop("rows")
    keys = (spec.get("validation") or {}).get("null_check_cols") or ()
    if not rows or not keys:
        return Load(rows, None, found)
    expected = (spec.get("validation") or {}).get("expected_null_counts") or {}
    return Load(rows, null_keys(spark.read.parquet(target_path), keys, expected), found)


def native_partition(spec: Mapping[str, Any]) -> str | None:
    """The first source partition column, when its name says it is a date."""
    columns = spec["source"].get("partition_cols") or ()
    return columns[0] if columns and columns[0].endswith(("_date", "_start")) else None


def load_profile(
    tables: Mapping[str, DataFrame], specs: Mapping[str, Mapping[str, Any]], upto: str | None
) -> DataFrame:
    """Row and partition counts of source tables, bounded and partitioned exactly as a load
    would, so that they can be compared with the profile of the loaded tables."""
    entries = {}
    for name, df in tables.items():
        spec = specs[name]
        rule = _partition_rule(spec)
        df = bound(df, (spec.get("validation") or {}).get("watermark_col"), upto)
        if rule:
            df = partition_date(df, rule["target"], rule["source"], rule["parts"])
        partition = rule["target"] if rule else native_partition(spec)
        entries[name] = (df, [partition] if partition else [])
    return profile(entries)
