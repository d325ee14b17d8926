"""The five enrichment functions, each as a Column expression and as a table job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.joins import lookup_with_default

# What counts as white space when trimming: ASCII blanks, the Unicode space separators,
# line and paragraph separators, and the byte order mark.
WHITE_SPACE = (
    "\t\n\u000b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Spellings of the countries that are recognised by name.
COUNTRY_SPELLINGS = {
    "US": ["usa", "us", "united states", "united states of america", "u.s.a."],
    "GB": ["uk", "gb", "united kingdom", "great britain"],
    "DE": ["de", "germany", "deutschland"],
    "FR": ["fr", "france"],
    "IT": ["it", "italy", "italia"],
    "CA": ["ca", "canada"],
}
UNKNOWN_COUNTRY = "XX"

# Shape of a legacy product code, and the answer for anything else.
SKU_PATTERN = r"^([A-Z]{2})-(\d{3,5})-(\d{1,3})$"
UNKNOWN_SKU = "UNKNOWN|0|0"
OCTET_PATTERN = r"^\s*[+-]?[0-9]+\s*$"

# Payment terms in days.
STANDARD_TERMS = {"SUP-001": 30, "SUP-002": 45, "SUP-003": 60}
DEFAULT_TERM_DAYS = 30


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    return F.btrim(_column(c), F.lit(WHITE_SPACE))


def country_code(c: str | Column) -> Column:
    """Two-letter country code of a spelling; other two-letter values pass, the rest is ``XX``."""
    name = F.lower(trimmed(c))
    spellings = F.create_map(
        *[F.lit(word) for iso, words in COUNTRY_SPELLINGS.items() for pair in words for word in (pair, iso)]
    )
    # two UTF-16 units, so that one character outside the basic plane counts as two
    two_units = F.octet_length(F.encode(name, "UTF-16BE")) == 4
    code = F.coalesce(
        F.try_element_at(spellings, name), F.when(two_units, F.upper(name)), F.lit(UNKNOWN_COUNTRY)
    )
    return F.when(_column(c).isNotNull(), code)


def email_hash(c: str | Column) -> Column:
    """SHA-256 (hex) of the trimmed lower-case address, taken over its UTF-8 bytes."""
    return F.sha2(F.lower(trimmed(c)), 256)


def sku_parts(c: str | Column) -> Column:
    """``LETTERS|number|number`` of a legacy code."""
    sku = trimmed(c)
    return (
        F.when(sku.isNull(), F.lit(None).cast("string"))
        .when(sku.rlike(SKU_PATTERN), F.regexp_replace(sku, SKU_PATTERN, "$1|$2|$3"))
        .otherwise(UNKNOWN_SKU)
    )


def ip_region(c: str | Column) -> Column:
    """Coarse region by the first octet of an address."""
    octet = F.substring_index(trimmed(c), ".", 1)
    is_number = trimmed(c).contains(".") & octet.rlike(OCTET_PATTERN)
    # more digits than a decimal holds is still just a large number
    number = F.coalesce(octet.try_cast("decimal(38,0)"), F.lit(256))
    return (
        F.when(_column(c).isNull(), F.lit(None).cast("string"))
        .when(~is_number, "Unknown")
        .when(number.isin(10, 172, 192), "Internal")
        .when(number < 64, "Americas")
        .when(number < 128, "EMEA")
        .when(number < 192, "APAC")
        .otherwise("Other")
    )


def with_country_code(df: DataFrame, column: str, out: str = "country_code") -> DataFrame:
    return df.withColumn(out, country_code(column))


def pseudonymise(df: DataFrame, column: str, out: str = "email_hash") -> DataFrame:
    """Replace an e-mail column by its hash."""
    return df.withColumn(out, email_hash(column)).drop(column)


def with_sku_parts(df: DataFrame, column: str, out: str = "sku_parts") -> DataFrame:
    return df.withColumn(out, sku_parts(column))


def with_ip_region(df: DataFrame, column: str, out: str = "ip_region") -> DataFrame:
    return df.withColumn(out, ip_region(column))


def supplier_terms(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Payment terms per supplier code from a ``code,days`` file laid over the standard terms.

    Rows without two fields or with a non-numeric term are skipped. When a code repeats,
    the last line of the file wins; the position is taken from the file block and the row
    order inside it, because partitions of a split file carry no order of their own.
    """
    rows = [
        F.struct(F.lit(code).alias("supplier_id"), F.lit(days).cast("bigint").alias("term_days"))
        for code, days in STANDARD_TERMS.items()
    ]
    standard = spark.range(1).select(F.inline(F.array(*rows)))
    no_position = F.lit(None).cast("struct<file_name:string,block:bigint,line:bigint>")
    standard = standard.withColumn("position", no_position)
    if path is None:
        return standard.drop("position")
    lines = spark.read.text(path).select(
        F.split(F.btrim("value", F.lit(WHITE_SPACE)), ",").alias("fields"),
        F.struct(
            F.col("_metadata.file_path").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
    )
    term = F.btrim(F.get("fields", F.lit(1)), F.lit(WHITE_SPACE))
    listed = (
        lines.filter(F.size("fields") >= 2)
        .select(
            F.btrim(F.get("fields", F.lit(0)), F.lit(WHITE_SPACE)).alias("supplier_id"),
            F.when(term.rlike(r"^[+-]?[0-9]+$"), term.try_cast("bigint")).alias("term_days"),
            "position",
        )
        .filter(F.col("term_days").isNotNull())
    )
    # a null position sorts first, so any listed row beats the standard one
    known = listed.unionByName(standard).groupBy("supplier_id")
    return known.agg(F.max_by("term_days", F.struct("position")).alias("term_days"))


def with_payment_terms(
    df: DataFrame, terms: DataFrame, column: str, out: str = "payment_term_days"
) -> DataFrame:
    keyed = df.withColumn("_supplier", trimmed(column))
    joined = lookup_with_default(
        keyed, terms, "_supplier", "supplier_id", "term_days", out, DEFAULT_TERM_DAYS
    )
    return joined.drop("_supplier")
