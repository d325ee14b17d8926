"""Ordered computations that stay parallel inside one hot key.

A plain window per key puts all rows of that key into one task. Here every key is
cut into slots (a value that never decreases along the ordering, such as the hour of
the event time). The window runs per (key, slot), and one extra "carry" row per
(key, slot) brings in what came before it; neighbours are looked up in the slot, then among the first and last rows of the key's slots. Carry rows are made from map-side combined
aggregates, so their number is bounded by keys x slots, and the window that chains
them sees one row per slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HELPERS = ("_slot", "_carry", "_step")
#: Rows sampled for the bounds of ranking slots, bounds compared at a time, and tasks over which equal rows are spread.
BOUNDS, BLOCK, SALTS = 1024, 32, 64


def time_slot(ts: str | Column, grain: str = "hour") -> Column:
    return F.date_trunc(grain, F.col(ts) if isinstance(ts, str) else ts)


def _with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    return rows.unionByName(carry, allowMissingColumns=True)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    value: Column | str,
    out: str,
    slot: Column,
) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to and including the current one.

    ``order`` must be unique inside a key and ``slot`` must not decrease along it.
    """
    data = df.withColumn("_slot", slot).withColumn(
        "_step", F.col(value) if isinstance(value, str) else value
    )
    totals = data.groupBy(*keys, "_slot").agg(F.sum("_step").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys, "_slot", F.lit(0).alias("_carry"), F.sum("_total").over(earlier).alias("_step")
    )
    upto = (
        Window.partitionBy(*keys, "_slot")
        .orderBy("_carry", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_carry(data.withColumn("_carry", F.lit(1)), carry)
        .withColumn(out, F.sum("_step").over(upto))
        .filter(F.col("_carry") == 1)
        .drop(*_HELPERS)
    )


def _neighbour(df, keys, order, fields, out, slot, forward: bool) -> DataFrame:
    """Rows meet their slot first; then the first and last rows of all slots of a key meet, the others keep apart."""
    look, at = (F.lead, "_last") if forward else (F.lag, "_first")
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    begins, ends = (step(F.lit(True)).over(inside).isNull() for step in (F.lag, F.lead))
    near = [look(f).over(inside).alias(f"_near{k}") for k, f in enumerate(fields)]
    rows = df.withColumn("_slot", slot).select("*", *near, begins.alias("_first"), ends.alias("_last"))
    edge = F.col("_first") | F.col("_last")
    rows = rows.withColumns({"_edge": edge, "_inner": F.when(~edge, F.col("_slot"))})
    across = Window.partitionBy(*keys, "_edge", "_inner").orderBy("_slot", F.col("_first").desc())
    far = [look(f).over(across).alias(f"_far{k}") for k, f in enumerate(fields)]
    rows = rows.select("*", *far, look(F.lit(True)).over(across).alias("_any"))
    step = lambda of: F.struct(*[F.col(f"_{of}{k}").alias(f) for k, f in enumerate(fields)])
    found = F.when(~F.col(at), step("near")).when(F.col("_any"), step("far"))
    return rows.select(*[df[c] for c in df.columns if c != out], found.alias(out))


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    out: str,
    slot: Column,
) -> DataFrame:
    """Add struct ``out`` with ``fields`` of the key's previous row (null for the first)."""
    return _neighbour(df, keys, order, fields, out, slot, forward=False)


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    out: str,
    slot: Column,
) -> DataFrame:
    """Add struct ``out`` with ``fields`` of the key's next row (null for the last)."""
    return _neighbour(df, keys, order, fields, out, slot, forward=True)


def last_before(
    left: DataFrame,
    on: str,
    ts: str,
    others: Mapping[str, tuple[DataFrame, str, str, Sequence[str]]],
    grain: str = "day",
) -> DataFrame:
    """As-of join: for each row of ``left``, the last row of every other table that has its key, at its time or before.

    ``others`` names a new struct column for each table, given with its key, its time and the columns of the struct.
    Of rows with the same time the one with the greatest columns counts. All rows go through one shuffle by
    key and slot of time; what was last before a slot comes in by a carry row, so a hot key is
    spread over its slots and nothing but one row per slot is carried along a key. Rows of ``left``
    that nothing precedes have nulls, and so do those without a key or a time, which are spread by a hash.
    """
    slot = time_slot("_ts", grain)
    kinds = {name: df.select(F.struct(*fields).alias("s")).schema["s"].dataType for name, (df, _, _, fields) in others.items()}
    seen = [
        df.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
            F.col(key).alias("_key"),
            F.col(at).alias("_ts"),
            *[(F.struct(*fields) if of == name else F.lit(None).cast(kind)).alias(of) for of, kind in kinds.items()],
        )
        for name, (df, key, at, fields) in others.items()
    ]
    seen = reduce(DataFrame.unionByName, seen).withColumn("_slot", slot)
    whole = [F.col(c) for c, kind in left.dtypes if "map<" not in kind]
    known = F.col("_key").isNotNull() & F.col("_ts").isNotNull()
    asked = left.withColumns({"_key": F.col(on), "_ts": F.col(ts)}).withColumn("_slot", slot)
    asked = asked.withColumn("_salt", F.when(known, 0).otherwise(F.pmod(F.xxhash64(*whole), F.lit(SALTS))).cast("int"))
    # a slot's last rows, next to the slots that are asked about
    last = [F.max_by(name, F.when(F.col(name).isNotNull(), F.struct("_ts", name))).alias(name) for name in kinds]
    edges = seen.groupBy("_key", "_slot").agg(*last)
    slots = asked.filter(known).select("_key", "_slot").distinct()
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    both = edges.withColumn("_asked", F.lit(False)).unionByName(slots.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    both = both.groupBy("_key", "_slot").agg(F.max("_asked").alias("_asked"), *[F.max(name).alias(name) for name in kinds])
    carry = both.select("_key", "_slot", "_asked", *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in kinds]).filter("_asked")
    # order inside a slot: what is carried in, then by time, the others before the rows that ask
    rows = asked.withColumn("_carry", F.lit(2))
    for mark, brought in ((1, seen), (0, carry.drop("_asked"))):
        rows = rows.unionByName(brought.withColumns({"_carry": F.lit(mark), "_salt": F.lit(0)}), allowMissingColumns=True)
    inside = Window.partitionBy("_key", "_slot", "_salt").orderBy(F.col("_ts").asc_nulls_first(), "_carry", *kinds)
    found = {name: F.last(name, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for name in kinds}
    return rows.withColumns({name: F.when(known, c) for name, c in found.items()}).filter("_carry = 2").drop("_key", "_ts", "_slot", "_salt", "_carry")


def ordered_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], out: str) -> DataFrame:
    """All ``fields`` of a key in order, as one array.

    ``keys`` hold a slot that the data defines (a day), which bounds what one row gathers at any size of the table.
    """
    entries = F.collect_list(F.struct(F.struct(*order).alias("at"), F.struct(*fields).alias("entry")))
    return df.groupBy(*keys).agg(F.array_sort(entries).alias("_entries")).select(*keys, F.col("_entries.entry").alias(out))


def group_ordinal(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_micros: int, out: str, slot: Column
) -> DataFrame:
    """Number the runs of rows that follow each other within ``gap_micros``, per key from 1.

    A narrow pass over key, time and tie-breaker finds the number of runs begun in each
    slot; the carry rows then hold both the last time and the run number so far, and the
    full rows are shuffled once.
    """
    order = [ts, tie]
    apart = lambda later, earlier: F.unix_micros(later) - F.unix_micros(earlier) > gap_micros
    narrow = previous_row(df.select(*keys, *order), keys, order, [ts], "_before", slot)
    begins = F.col("_before").isNull() | apart(ts, f"_before.{ts}")
    per_slot = narrow.groupBy(*keys, slot.alias("_slot")).agg(
        F.count_if(begins).alias("_begun"), F.max(ts).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_slot")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slot.select(
        *keys,
        "_slot",
        F.lit(0).alias("_carry"),
        F.lag("_last").over(across).alias("_time"),
        F.coalesce(F.sum("_begun").over(earlier), F.lit(0)).alias("_step"),
    )
    rows = df.withColumns({"_slot": slot, "_carry": F.lit(1), "_time": F.col(ts)})
    inside = Window.partitionBy(*keys, "_slot").orderBy("_carry", *order)
    before = F.lag("_time").over(inside)
    begun = F.when(before.isNull() | apart("_time", before), 1).otherwise(0).cast("bigint")
    return (
        _with_carry(rows, carry)
        .withColumn("_step", F.when(F.col("_carry") == 0, F.col("_step")).otherwise(begun))
        .withColumn(out, F.sum("_step").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("_carry") == 1)
        .drop("_time", *_HELPERS)
    )


def _between_bounds(rows: DataFrame, value: Column) -> DataFrame:
    """Add ``_slot``: the slot of a value from large to small; in an odd slot all rows are equal.

    The distinct values of a sample are bounds: each is a slot of its own, and so is what lies between two of them.
    The sample holds the rows with the smallest hashes, so it is the same whenever the plan is run, and slots
    are about equally full whatever the values look like; a value that many rows share is a bound almost surely.
    Nulls are the last slot.
    """
    sample = rows.filter(value.isNotNull()).select(value.alias("_bound"), "_row").orderBy("_row", "_bound").limit(BOUNDS)
    found = sample.agg(F.array_sort(F.array_distinct(F.collect_list("_bound"))).alias("_all"))
    found = found.select(F.struct("_all", F.filter("_all", lambda _, k: k % BLOCK == 0).alias("_heads")).alias("_bounds")).scalar()
    bounds, heads = found["_all"], found["_heads"]
    # a search in two steps, for the block of bounds and for the place in it
    smaller = lambda some: (F.array_position(F.sort_array(F.array_append(some, F.col("_v"))), F.col("_v")) - 1).cast("int")
    n, first = F.size(bounds), F.col("_first")
    # a bound at the start of a block is larger than all of the block before it
    next_head = F.coalesce(F.get(bounds, first + BLOCK) == F.col("_v"), F.lit(False))
    searched = (
        rows.withColumn("_v", value)
        .withColumn("_first", F.greatest(smaller(heads) - 1, F.lit(0)) * BLOCK)
        .withColumn("_block", F.slice(bounds, first + 1, F.lit(BLOCK)))
        .withColumn("_is", (F.array_contains("_block", F.col("_v")) | next_head).cast("int"))
        .withColumn("_below", first + smaller(F.col("_block")))
    )
    slot = F.when(F.col("_v").isNull() | (n == 0), 2 * n + 1).otherwise(2 * (n - F.col("_below") - F.col("_is")) + F.col("_is"))
    return searched.withColumn("_slot", slot.cast("int")).drop("_v", "_first", "_block", "_is", "_below")


def rank_desc(
    df: DataFrame,
    value: str,
    within: Sequence[str] = (),
    rank_as: str | None = None,
    dense_rank_as: str | None = None,
) -> DataFrame:
    """RANK inside ``within`` and/or DENSE_RANK over everything, both from large to small, nulls last.

    Rows are dealt to slots of the value that a sample bounds (see above), and rank inside their slot; what lies in
    greater slots comes in by carry rows, one for each slot and group. Equal values of a slot
    of their own need not meet, so a hot value is spread by a hash of its rows. No task holds a whole group.
    """
    kind = dict(df.dtypes)[value]
    number = F.when(F.col(value) == 0, F.lit(0).cast(kind)).otherwise(F.col(value)) if kind in ("double", "float") else F.col(value)
    whole = [F.col(c) for c, k in df.dtypes if "map<" not in k]
    # the hash needs all columns, so every use of the rows reads the same exchanges below
    rows = _between_bounds(df.withColumn("_row", F.xxhash64(*whole)), number)
    equal = F.col("_slot") % 2 == 1
    rows = rows.withColumn("_salt", F.when(equal, F.pmod("_row", F.lit(SALTS))).otherwise(0).cast("int")).drop("_row")
    falling = F.col(value).desc_nulls_last()

    here = ["_slot", "_salt"]
    before = F.lag(number).over(Window.partitionBy(*here).orderBy(falling))
    # of the distinct values, those that are bounds are counted by their slots' numbers
    fresh = F.when(F.col("_slot") % 2 == 1, 0).when(before.isNull() | (before != number), 1).otherwise(0)
    counted = rows.select(*within, *here, fresh.alias("_fresh"))
    counted = counted.withColumn("_entry", F.explode(F.array(*[F.struct(F.lit(k).alias("of"), n.cast("long").alias("n")) for k, n in ((0, F.lit(1)), (1, F.col("_fresh")))])))
    groups = [F.when(F.col("_entry.of") == 0, F.col(c)).alias(c) for c in within]
    sums = counted.groupBy(F.col("_entry.of").alias("_of"), *groups, *here).agg(F.sum("_entry.n").alias("_n"))
    earlier = Window.partitionBy("_of", *within).orderBy("_slot").rangeBetween(Window.unboundedPreceding, -1)
    carry = sums.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")

    both = rows.withColumn("_of", F.lit(-1)).unionByName(carry, allowMissingColumns=True)
    found = both
    brought = lambda of, *group: F.max(F.when(F.col("_of") == of, F.col("_before"))).over(Window.partitionBy(*here, *group))
    if rank_as:
        inside = F.rank().over(Window.partitionBy(*here, "_of", *within).orderBy(falling))
        found = found.withColumn(rank_as, brought(0, *within) + inside)
    if dense_rank_as:
        inside = F.dense_rank().over(Window.partitionBy(*here, "_of").orderBy(falling))
        found = found.withColumn(dense_rank_as, brought(1) + F.floor(F.col("_slot") / 2) + inside)
    return found.filter(F.col("_of") == -1).drop("_of", "_before", *here)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``newest_first``; ties go by a hash of the row.

    ``row_number() = 1`` is planned with a group limit below the shuffle, so each map
    task sends at most one row per key, however hot the key is.
    """
    tie = F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])
    w = Window.partitionBy(*keys).orderBy(*newest_first, tie)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
