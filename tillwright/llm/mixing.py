"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Sources share the mix by weight, none beyond a multiple of its own size; what that cuts off goes to the
others by weight (the level up to which a source's weight counts is found in closed form, by running
totals over the sources). The targets, in blocks of ``BLOCK`` words, are apportioned to the sources by the highest quotients
target / (2k + 1), and each source's blocks likewise to its shards, slices of about ``SHARD_WORDS`` words. A shard
lays its documents in seeded order end to end, takes all its blocks as often as its quota allows, and once
more a run of neighbouring blocks from a seeded place on. So whole documents are taken but for the two
at the ends of that run, quotas are met to within a block, and no document is taken more often than the multiple.

Sizes count words, not characters; a null text has none and is never taken. A null source is a source of its own, the
last. Rows with equal ids are rows of their own. An empty table gives an empty table. Nothing depends on partitioning:
order, shards and places come from MD5 sums of a seed with the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillwright.llm.common import WORD, free_names, row_key, stored

BLOCK = 8
SHARD_WORDS = 1 << 20
SHARE = 1.5
MOST = 2
WEIGHTS = (5, 2, 1)
SEED = "mix"


def _all() -> WindowSpec:
    """All sources: one small row for each."""
    return Window.orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)



def number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, row (hash of all columns) and the seeded key of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), row_key(docs, docs.columns).alias("row"), key.alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, whole: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source; targets are exact but for one division."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.select("source", "source_size", place.alias("place"), F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).alias("weight"))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")), "place")
    capped = F.coalesce(F.sum(F.col("source_size") * most).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", (F.sum("source_size").over(_all()) * whole - capped) / rest).withColumn("at", F.row_number().over(filling))
    holds = F.col("level") * F.col("weight") <= F.col("source_size") * most
    level = F.min_by("level", F.when(holds, F.col("at"))).over(_all())
    cap = (F.col("source_size") * most).cast("double")
    return levels.select("source", "source_size", F.least(cap, F.coalesce(level * F.col("weight"), cap)).alias("target"))


def apportion(parties: DataFrame, within: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group dealt to its parties by the highest quotients votes / (2k + 1).

    Ties go to the party first in order, null last. A quota is within half the number of parties times the party's share of its
    proportional part, so only the quotients in that range are compared: a few for each party.
    """
    group = Window.partitionBy(*within).orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    every, half = F.sum(votes).over(group), F.count(F.lit(1)).over(group) / 2
    part = F.when(every > 0, F.col(votes) / every).otherwise(0.0)
    ranged = parties.withColumns({"_part": part, "_half": half}).withColumns(
        {
            "_low": F.greatest(F.lit(0), F.floor(F.col("_part") * (F.col(seats) - F.col("_half"))) - 1),
            "_high": F.ceil(F.col("_part") * (F.col(seats) + F.col("_half"))) + 1,
        }
    )
    sure = ranged.withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    tried = sure.filter(F.col(votes) > 0).select(*within, party, votes, "_left", F.explode(F.sequence("_low", "_high")).alias("_k"))
    best = Window.partitionBy(*within).orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), F.col(party).asc_nulls_last())
    won = tried.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= F.col("_left"))
    more = won.groupBy(*within, party).agg(F.count(F.lit(1)).alias("_won")).toDF(*[f"_{c}" for c in within], "_party", "_won")
    match = F.col(party).eqNullSafe(F.col("_party"))
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    quota = (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota")
    return sure.join(more, match, "left").select(*parties.columns, quota)


def quotas(sizes: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, **options) -> tuple[DataFrame, DataFrame]:
    """Sources with target, quota and number of shards; shards (source, shard) with words and quota."""
    aims = targets(sizes, **options)
    seats = F.round(F.sum("target").over(_all()) / block).cast("long")
    sources = apportion(aims.withColumns({"all": F.lit(0), "seats": seats}), ["all"], "source", "target", "seats").drop("all", "seats")
    sources = stored(sources.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))), "mix-sources")
    cells = dealt(sizes, sources).groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("source_quota"))
    return sources, stored(apportion(cells, ["source"], "shard", "words", "source_quota"), "mix-shards")


def dealt(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    held = sources.withColumnRenamed("source", "_source")
    joined = sizes.join(held, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("shard", F.pmod(number(F.col("key")), F.col("shards")))


def _overlap(low: Column, high: Column) -> tuple[Column, Column]:
    """Where [low, high) meets the document's words, counted from its first."""
    a = F.least(F.greatest(low - F.col("_at"), F.lit(0)), F.col("size"))
    return a, F.greatest(a, F.least(high - F.col("_at"), F.col("size")))


def mix(docs: DataFrame, block: int = BLOCK, seed: str = SEED, shard_words: int = SHARD_WORDS, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and what is taken of it.

    ``copies`` whole copies, and the words [from_1, to_1) and [from_2, to_2) once more; ``row`` is the hash of the row's columns.
    """
    sizes = stored(measured(docs, seed), "mix-sizes")
    sources, shards = quotas(sizes, block, shard_words, **options)
    cell = shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "words", F.col("quota").alias("cell_quota"))
    rows = dealt(sizes, sources)
    rows = rows.join(cell, rows["source"].eqNullSafe(cell["_source"]) & (rows["shard"] == cell["_shard"])).drop("_source", "_shard")
    laid = Window.partitionBy("source", "shard").orderBy("key", "row")
    rows = rows.withColumn("_at", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / block))
    rows = rows.withColumn("_blocks", blocks)
    limit = F.least(F.col("cell_quota"), F.col("_blocks") * options.get("most", MOST))
    rows = rows.withColumns({"copies": F.floor(limit / F.col("_blocks")), "_more": limit % F.col("_blocks")})
    place = number(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")), F.lit(":"), F.col("shard").cast("string"))))
    rows = rows.withColumn("_from", F.pmod(place, F.col("_blocks")))
    end = F.col("_from") + F.col("_more")
    a1, b1 = _overlap(F.col("_from") * block, F.least(end, F.col("_blocks")) * block)
    a2, b2 = _overlap(F.lit(0), F.greatest(end - F.col("_blocks"), F.lit(0)) * block)
    rows = rows.withColumns({"from_1": a1, "to_1": b1, "from_2": a2, "to_2": b2})
    taken = F.col("copies") * F.col("size") + F.col("to_1") - F.col("from_1") + F.col("to_2") - F.col("from_2")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies", "from_1", "to_1", "from_2", "to_2", "row")


def mixed(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The mix itself, in the columns of ``docs``: whole texts as often as taken, and the words taken once more as a text.

    ``n_chars``, if there, becomes the length of the text. Equal rows are joined as one row with all that is taken of them.
    """
    doc, row, list_, piece, hashed = free_names(["of", "row", "pieces", "piece", "hashed"], docs.columns)
    spans = F.filter(
        F.array(*[F.struct(F.col(f"from_{k}").alias("a"), F.col(f"to_{k}").alias("b")) for k in (1, 2)]),
        lambda s: s["b"] > s["a"],
    )
    pieces = F.concat(F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.lit(None).cast("long").alias("b")), F.col("copies").cast("int")), spans)
    wanted = taken.filter("taken > 0").select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.explode(pieces).alias(piece))
    # equal rows are one; a piece that several of them take comes with its number, so the list is as long as the different pieces
    wanted = wanted.groupBy(doc, row, piece).agg(F.count(F.lit(1)).alias("times")).groupBy(doc, row).agg(F.collect_list(F.struct(piece, "times")).alias(list_))
    rows = docs.withColumn(hashed, row_key(docs, docs.columns)).dropDuplicates(["doc_id", hashed])
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(hashed) == F.col(row)))
    rows = rows.withColumn(list_, F.explode(list_)).withColumn(piece, F.explode(F.array_repeat(F.col(f"{list_}.{piece}"), F.col(f"{list_}.times").cast("int"))))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    first, end = F.col(f"{piece}.a"), F.col(f"{piece}.b")
    part = F.array_join(F.slice(words, first.cast("int") + 1, (end - first).cast("int")), " ")
    whole = end.isNull() | ((first == 0) & (end == F.regexp_count("text", F.lit(WORD))))
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(part))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(*docs.columns)
