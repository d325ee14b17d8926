"""Source readers. Every reader returns a lazy DataFrame and keeps the columns that
come from ``name=value`` directories; those stay strings unless a schema types them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillwright.session import setting

CORRUPT = "_corrupt_record"
# Columns of a supplier invoice record, in the order of its value fields.
INVOICE_FIELDS = (
    "invoice_no", "supplier_id", "invoice_date", "due_date",
    "total_amount", "currency", "line_items", "raw_xml",
)


def _as_struct(schema: StructType | str | None) -> StructType | None:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _load(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    # an all-digit directory such as date_ts=20240101 must not turn into a number
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        return make()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    delimiter: str = ",",
    header: bool = True,
    null_value: str = "",
) -> DataFrame:
    """Delimited text. Without a schema every column is a string.

    A schema that names ``_corrupt_record`` gets the lines there that do not fit it.
    """
    reader = (
        spark.read.option("header", str(header).lower())
        .option("sep", delimiter)
        .option("inferSchema", "false")
        .option("nullValue", null_value)
        .option("emptyValue", null_value)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if schema is not None:
        # with a header, a column in another place than the schema says is an error
        reader = reader.schema(_as_struct(schema)).option("enforceSchema", str(not header).lower())
    return _load(spark, lambda: reader.csv(path))


def read_tsv(
    spark: SparkSession,
    path: str,
    column_count: int = 0,
    schema: StructType | str | None = None,
    header: bool = False,
) -> DataFrame:
    """Tab-separated text; without header or schema the columns are ``col_1``, ``col_2``, ..."""
    reader = spark.read.option("header", str(header).lower()).option("sep", "\t")
    if schema is not None:
        return _load(spark, lambda: reader.schema(_as_struct(schema)).csv(path))
    df = _load(spark, lambda: reader.option("inferSchema", "false").csv(path))
    if header or column_count <= 0:
        return df
    numbered = {f"_c{i}": f"col_{i + 1}" for i in range(column_count)}
    return df.withColumnsRenamed(numbered)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(_as_struct(schema))
    return _load(spark, lambda: reader.parquet(path))


def read_orc(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """ORC base files; transactional tables must be compacted beforehand."""
    reader = spark.read if schema is None else spark.read.schema(_as_struct(schema))
    return _load(spark, lambda: reader.orc(path))


def read_avro(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Avro files; needs Spark's external Avro module on the class path."""
    reader = spark.read.format("avro")
    if schema is not None:
        reader = reader.schema(_as_struct(schema))
    return _load(spark, lambda: reader.load(path))


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A key-value store's snapshot, exported as Parquet. Epoch columns are converted later."""
    return read_parquet(spark, path, schema)


def read_hive(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog table in any format the catalog can read (RCFile, SequenceFile, ...)."""
    return spark.table(f"`{database}`.`{table}`")


def read_sequence(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = INVOICE_FIELDS,
    delimiter: str = "\t",
) -> DataFrame:
    """Text key / text value records; the value is split into ``columns``, short rows padded with null.

    Only the record decoding goes through an RDD; the split is done by Spark SQL.
    """
    records = spark.sparkContext.sequenceFile(
        path, keyClass="org.apache.hadoop.io.Text", valueClass="org.apache.hadoop.io.Text"
    )
    lines = spark.createDataFrame(records.map(lambda record: (record[1],)), "value string")
    fields = F.split("value", f"\\Q{delimiter}\\E", -1)
    return lines.select(*[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(columns)])


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object per line. With a schema, broken lines are kept in ``_corrupt_record``.

    Give map columns an explicit map type: inference would turn them into structs.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    schema = _as_struct(schema)
    if schema is not None:
        if CORRUPT not in schema.names:
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.schema(schema)
    return _load(spark, lambda: reader.json(path))


def read_regex(spark: SparkSession, path: str, pattern: str, columns: Sequence[str]) -> DataFrame:
    """Text lines cut by the groups of a regular expression; a line without a match gives empty strings."""
    lines = _load(spark, lambda: spark.read.text(path))
    groups = [F.regexp_extract("value", pattern, i).alias(c) for i, c in enumerate(columns, start=1)]
    return lines.select(*groups, *[c for c in lines.columns if c != "value"])


def _source(spec: Mapping[str, Any]) -> tuple[str, dict, Any]:
    source = spec["source"]
    path = source.get("path", source.get("gcs_path"))
    return path, source.get("format_options") or {}, source.get("schema")


def _from_csv(spark, spec):
    path, opts, schema = _source(spec)
    return read_csv(
        spark,
        path,
        schema,
        delimiter=opts.get("delimiter", ","),
        header=str(opts.get("header", True)).lower() == "true",
        null_value=opts.get("null_value", opts.get("null_format", "")),
    )


def _from_tsv(spark, spec):
    path, opts, schema = _source(spec)
    header = str(opts.get("header", False)).lower() == "true"
    return read_tsv(spark, path, int(opts.get("column_count", 0)), schema, header)


def _plain(reader):
    def read(spark, spec):
        path, _, schema = _source(spec)
        return reader(spark, path, schema)

    return read


def _from_catalog(spark, spec):
    return read_hive(spark, spec["source"]["database"], spec["source"]["table"])


def _from_sequence(spark, spec):
    source = spec["source"]
    path, opts, _ = _source(spec)
    if source.get("database") and spark.catalog.tableExists(f"{source['database']}.{source['table']}"):
        return _from_catalog(spark, spec)
    return read_sequence(
        spark, path, opts.get("columns", INVOICE_FIELDS), opts.get("value_delimiter", "\t")
    )


def _from_regex(spark, spec):
    path, opts, _ = _source(spec)
    return read_regex(spark, path, opts["regex_pattern"], opts["regex_columns"])


# The format names a table specification may carry.
FORMATS: dict[str, Callable[[SparkSession, Mapping[str, Any]], DataFrame]] = {
    "textfile_csv": _from_csv,
    "textfile_tsv": _from_tsv,
    "parquet": _plain(read_parquet),
    "avro": _plain(read_avro),
    "rcfile": _from_catalog,
    "sequencefile": _from_sequence,
    "json_serde": _plain(read_json),
    "regex_serde": _from_regex,
    "orc": _plain(read_orc),
    "kudu": _plain(read_snapshot),
}


def read_source(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """Read the source a table specification describes."""
    name = spec["source"]["format"]
    if name not in FORMATS:
        raise ValueError(f"no reader for format {name!r}; known formats: {', '.join(sorted(FORMATS))}")
    return FORMATS[name](spark, spec)


def scan_bounded(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """A scan that must carry a bound on its partition column. The bare column stays on
    one side of the comparison, so the bound prunes partitions."""
    if low is None and high is None:
        raise ValueError(f"a bound on {column!r} is required")
    kind = df.schema[column].dataType
    if low is not None:
        df = df.filter(F.col(column) >= F.lit(low).cast(kind))
    if high is not None:
        df = df.filter(F.col(column) <= F.lit(high).cast(kind))
    return df
