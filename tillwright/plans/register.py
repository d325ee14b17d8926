"""The functions and views under their SQL names, for callers that write SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillwright.functions import enrich
from tillwright.plans.views import VIEWS


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_functions(spark: SparkSession, terms: DataFrame | None = None) -> None:
    """Define the five functions as temporary SQL functions.

    Spark inlines their bodies, so they run in generated code like the Column forms in
    ``functions.enrich``; the terms lookup becomes a left join on the terms table.
    """
    trim = f"btrim(x, {_text(enrich.WHITE_SPACE)})"
    spellings = ", ".join(
        f"{_text(word)}, {_text(iso)}" for iso, words in enrich.COUNTRY_SPELLINGS.items() for word in words
    )
    octet = f"substring_index({trim}, '.', 1)"
    number = f"coalesce(try_cast({octet} AS decimal(38,0)), 256)"
    table = enrich.supplier_terms(spark) if terms is None else terms
    table.createOrReplaceTempView("supplier_terms")
    bodies = {
        "normalize_country": (
            "STRING",
            f"""CASE WHEN x IS NOT NULL THEN coalesce(
                    try_element_at(map({spellings}), lower({trim})),
                    CASE WHEN octet_length(encode(lower({trim}), 'UTF-16BE')) = 4 THEN upper({trim}) END,
                    {_text(enrich.UNKNOWN_COUNTRY)}) END""",
        ),
        "hash_customer_email": ("STRING", f"sha2(lower({trim}), 256)"),
        "parse_legacy_sku": (
            "STRING",
            f"""CASE WHEN x IS NULL THEN NULL
                     WHEN {trim} RLIKE {_text(enrich.SKU_PATTERN)}
                     THEN regexp_replace({trim}, {_text(enrich.SKU_PATTERN)}, '$1|$2|$3')
                     ELSE {_text(enrich.UNKNOWN_SKU)} END""",
        ),
        "geoip_city": (
            "STRING",
            f"""CASE WHEN x IS NULL THEN NULL
                     WHEN NOT (contains({trim}, '.') AND {octet} RLIKE {_text(enrich.OCTET_PATTERN)}) THEN 'Unknown'
                     WHEN {number} IN (10, 172, 192) THEN 'Internal'
                     WHEN {number} < 64 THEN 'Americas'
                     WHEN {number} < 128 THEN 'EMEA'
                     WHEN {number} < 192 THEN 'APAC'
                     ELSE 'Other' END""",
        ),
        "lookup_supplier_terms": (
            "BIGINT",
            f"""coalesce((SELECT max(t.term_days) FROM supplier_terms t WHERE t.supplier_id = {trim}),
                         {enrich.DEFAULT_TERM_DAYS})""",
        ),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")


def register_views(
    spark: SparkSession, tables: Mapping[str, DataFrame], as_of: str | date, only: tuple[str, ...] = ()
) -> list[str]:
    """Define the analytical views as temporary views over ``tables``; returns their names."""
    names = only or tuple(VIEWS)
    for name in names:
        VIEWS[name](tables, as_of).createOrReplaceTempView(name)
    return list(names)
