"""The platform's tables: schemas, layout and checks, read from ``tables.txt``."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwright.sources.readers import scan_bounded


@dataclass(frozen=True)
class Table:
    name: str
    source_format: str
    ddl: str
    partition: str | None
    cluster: tuple[str, ...]
    generated_from: tuple[str, ...]
    bound_column: str | None
    keys: tuple[str, ...]
    json_columns: tuple[str, ...]
    must_bound: bool

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    def scan(self, df: DataFrame, low: Any = None, high: Any = None) -> DataFrame:
        """The rows of this table within bounds on its partition column.

        Tables that declare it may not be scanned without a bound; the others pass whole.
        """
        if low is None and high is None and not self.must_bound:
            return df
        column = self.partition or self.bound_column
        if column is None:
            raise ValueError(f"{self.name} has no column to bound")
        return scan_bounded(df, column, low, high)

    def spec(self, path: str, **format_options: Any) -> dict[str, Any]:
        """The load specification of this table for a source at ``path``.

        Delimited text is read as text and typed afterwards by the target schema; JSON gets
        the declared types, with maps where the table holds JSON text.
        """
        database, table = self.name.split(".", 1)
        derived = bool(self.generated_from) or (
            self.partition is not None and self.bound_column not in (None, self.partition)
        )
        fields = [f for f in self.schema.fields if not (derived and f.name == self.partition)]
        kinds = {f.name: f.dataType.simpleString() for f in fields}
        source_schema = None
        if self.source_format in ("textfile_csv", "textfile_tsv"):
            source_schema = ", ".join(f"{name} string" for name in kinds)
        elif self.source_format == "json_serde":
            kinds |= {name: "map<string,string>" for name in self.json_columns}
            source_schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
        rule = None
        if derived:
            parts = self.generated_from if len(self.generated_from) > 1 else ()
            rule = {
                "target_col": self.partition,
                "parse_fn": "DATE" if parts else "PARSE_DATE",
                "source_cols": list(parts),
                "source_col": None if parts else (*self.generated_from, self.bound_column)[0],
                "generated_column": bool(self.generated_from),
            }
        return {
            "source": {
                "database": database, "table": table, "format": self.source_format, "path": path,
                "format_options": format_options, "schema": source_schema,
                "partition_cols": [] if derived or not self.partition else [self.partition],
            },
            "target": {"table": table, "schema": self.ddl, "cluster": list(self.cluster)},
            "transforms": {
                "partition_key_conversion": rule,
                "map_to_json": [{"source_col": c, "target_col": c} for c in self.json_columns],
                "kudu_epoch_conversion": [
                    {"col": f.name, "from_unit": "millis"} for f in fields
                    if self.source_format == "kudu" and f.dataType.simpleString() == "timestamp"
                ],
            },
            "validation": {"watermark_col": self.bound_column, "null_check_cols": list(self.keys)},
        }


def _number_columns(ddl: str) -> str:
    """``col_1..col_60 string`` stands for sixty numbered columns of one type."""

    def spread(match: re.Match) -> str:
        stem, first, last, kind = match.group(1), int(match.group(2)), int(match.group(3)), match.group(4)
        return ", ".join(f"{stem}{i} {kind}" for i in range(first, last + 1))

    return re.sub(r"(\w+_)(\d+)\.\.\1(\d+) (\w+)", spread, ddl)


@cache
def tables() -> dict[str, Table]:
    text = Path(__file__).with_name("tables.txt").read_text()
    lines = [line for line in text.splitlines() if line.strip() and not line.startswith("#")]
    found = {}
    for head, ddl in zip(lines[::2], lines[1::2], strict=True):
        name, *facts = head.split("; ")
        fact = dict(item.rstrip(";").split("=", 1) for item in facts)
        many = lambda key, sep=",": tuple(x for x in fact[key].split(sep) if x)
        found[name] = Table(
            name=name,
            source_format=fact["format"],
            ddl=_number_columns(ddl.strip()),
            partition=fact["part"] or None,
            cluster=many("cluster"),
            generated_from=many("from", "+"),
            bound_column=fact["bound"] or None,
            keys=many("keys"),
            json_columns=many("json"),
            must_bound=fact["must"] == "yes",
        )
    return found


def table(name: str) -> Table:
    try:
        return tables()[name]
    except KeyError:
        raise KeyError(f"unknown table {name!r}") from None


class BoundedTables(Mapping[str, DataFrame]):
    """Tables by their short names, as views take them, each scanned the way the catalog demands.

    ``bounds`` gives the lowest and highest partition value of a table, or the column to bound and both. A view over a table that
    may not be scanned whole gets an error unless a bound is given; tables that the catalog does not know pass as they are.
    """

    def __init__(self, held: Mapping[str, DataFrame], bounds: Mapping[str, tuple] | None = None):
        self.held, self.bounds = held, dict(bounds or {})
        self.known = {t.name.split(".", 1)[1]: t for t in tables().values()}
        if unknown := self.bounds.keys() - self.known.keys():
            raise KeyError(f"bounds on unknown tables {sorted(unknown)}")

    def __getitem__(self, name: str) -> DataFrame:
        df = self.held[name]
        if name not in self.known:
            return df
        *column, low, high = self.bounds.get(name, (None, None))
        if column:
            return scan_bounded(df, column[0], low, high)
        return self.known[name].scan(df, low, high)

    def __iter__(self) -> Iterator[str]:
        return iter(self.held.keys())

    def __len__(self) -> int:
        return len(list(self.held.keys()))


class StoredTables(Mapping[str, DataFrame]):
    """Tables by their short names, read from Parquet folders ``root/database.table`` with their declared columns."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.names = {name.split(".", 1)[1]: name for name in tables()}

    def path(self, name: str) -> str:
        return f"{self.root}/{self.names[name]}"

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.schema(table(self.names[name]).schema).parquet(self.path(name))

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)
