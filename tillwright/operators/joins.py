"""Join shapes the views need beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MICROS_PER_SECOND = 1_000_000
#: Pairs that the rows of one equality key may make before its left rows are dealt to several keys.
PAIRS_PER_KEY = 1 << 24


def followed_within(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    seconds: int,
    how: str = "left",
    pairs_per_key: int = PAIRS_PER_KEY,
) -> DataFrame:
    """Join where ``right_ts`` lies in ``[left_ts, left_ts + seconds]``, bounds included.

    Both sides are cut into time slots as wide as the interval, and the slot becomes an
    equality key. Each right row is listed in the two slots its partners can start in;
    a left row has one slot only, so every pair appears once and outer rows stay single.

    A hot key can still have so many rows in one slot that their pairs, few bytes before the
    join, overwhelm one task. So both sides are counted per key and slot, and where the product
    of the counts passes ``pairs_per_key``, the left rows are dealt to as many parts as that
    takes; only the right rows of such slots are copied, once for each part.
    """
    lhs, rhs = dealt_by_pairs(left, right, on, left_ts, right_ts, seconds, pairs_per_key)
    condition = [lhs[a] == rhs[b] for a, b in on]
    condition += [
        F.col("_lslot") == F.col("_rslot"),
        F.col("_lpart") == F.col("_rpart"),
        F.col(right_ts).between(
            F.col(left_ts), F.col(left_ts) + F.make_dt_interval(secs=F.lit(seconds))
        ),
    ]
    return lhs.join(rhs, condition, how).drop("_lslot", "_rslot", "_lpart", "_rpart")


def dealt_by_pairs(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    seconds: int,
    pairs_per_key: int,
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an interval join with their slots and parts."""
    width = F.lit(seconds * _MICROS_PER_SECOND)
    # start of the slot in whole microseconds; all arithmetic stays in integers
    slot_of = lambda ts: F.unix_micros(ts) - F.pmod(F.unix_micros(ts), width)
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    both = lambda slot: F.explode(F.array(slot - width, slot))
    lhs = left.withColumn("_lslot", slot_of(F.col(left_ts)))
    rhs = right.filter(F.col(right_ts).isNotNull()).withColumn("_rslot", slot_of(F.col(right_ts)))

    names = [f"_k{k}" for k in range(len(on))]
    starts = lhs.groupBy(*[F.col(c).alias(n) for c, n in zip(lkeys, names)], F.col("_lslot").alias("_cell"))
    starts = starts.agg(F.count(F.lit(1)).alias("_n"))
    # counted before the rows are listed twice
    ends = rhs.groupBy(*[F.col(c).alias(n) for c, n in zip(rkeys, names)], "_rslot").agg(F.count(F.lit(1)).alias("_m"))
    ends = ends.withColumn("_cell", both(F.col("_rslot"))).groupBy(*names, "_cell").agg(F.sum("_m").alias("_m"))
    pairs = F.col("_n").cast("double") * F.col("_m")
    parts = F.least(F.col("_n"), F.ceil(pairs / pairs_per_key)).cast("int")
    hot = starts.join(ends, [*names, "_cell"]).filter(pairs > pairs_per_key).select(*names, "_cell", parts.alias("_parts"))

    def with_parts(df: DataFrame, keys: list[str], slot: str) -> DataFrame:
        same = [F.col(c) == F.col(n) for c, n in zip(keys, names)]
        return df.join(hot, [*same, F.col(slot) == F.col("_cell")], "left").drop(*names, "_cell")

    columns = [F.col(c) for c, kind in left.dtypes if "map<" not in kind]
    part = F.coalesce(F.pmod(F.xxhash64(*columns), F.col("_parts")), F.lit(0)).cast("int")
    lhs = with_parts(lhs, lkeys, "_lslot").withColumn("_lpart", part).drop("_parts")
    rhs = with_parts(rhs.withColumn("_rslot", both(F.col("_rslot"))), rkeys, "_rslot")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return lhs, rhs.withColumn("_rpart", F.explode(every)).drop("_parts")


def lookup_with_default(
    df: DataFrame, table: DataFrame, on: str, key: str, value: str, out: str, default
) -> DataFrame:
    """Left join one value from a keyed table, with a default for misses and null keys.

    No broadcast hint: the table's size is not known here, and adaptive execution
    broadcasts it when its measured size allows that.
    """
    side = table.select(F.col(key).alias("_lookup_key"), F.col(value).alias("_lookup_value"))
    return (
        df.join(side, F.col(on) == F.col("_lookup_key"), "left")
        .withColumn(out, F.coalesce(F.col("_lookup_value"), F.lit(default)))
        .drop("_lookup_key", "_lookup_value")
    )


def with_ancestry(
    df: DataFrame, node: str, parent: str, label: str, max_depth: int, separator: str = " > "
) -> DataFrame:
    """Path and depth of every node that hangs below a root within ``max_depth`` steps.

    Roots have a null or empty parent. Every row holds the labels and parents of a chain that
    ends in its node; a join with the chain that ends in the first one's parent doubles its
    length, so the plan holds about log2(``max_depth``) joins. Both sides of a join are the
    same frame with the same columns, which lets Spark reuse the exchanges below. A finished
    chain gets a key of its own that nothing matches (zero characters, which no id holds), so
    finished rows stay spread out. The key of a node without an id is never null, or the filter
    that Spark adds for a nullable key would make the two sides differ. Nodes whose chain is
    longer or has no root (orphans, cycles) are left out.
    """
    rows = df.select(node, F.array(label).alias("_labels"), F.array(parent).alias("_ups"))
    first = F.element_at("_ups", 1)
    at_root = first.isNull() | (first == "")
    for _ in range(max_depth.bit_length()):
        upper = rows.select(
            F.coalesce(node, F.lit("\0")).alias("_end"), F.col("_labels").alias("_up_labels"), F.col("_ups").alias("_up_ups")
        )
        chains = rows.withColumn("_key", F.when(at_root, F.concat(F.lit("\0\0"), node)).otherwise(first))
        longer = lambda up, own: F.when(F.col("_end").isNull(), F.col(own)).otherwise(F.concat(up, own)).alias(own)
        rows = chains.join(upper, F.col("_key") == F.col("_end"), "left").select(
            node, longer("_up_labels", "_labels"), longer("_up_ups", "_ups")
        )
    named = F.forall("_labels", lambda x: x.isNotNull())
    return rows.filter(at_root & (F.size("_labels") <= max_depth + 1)).select(
        node,
        F.element_at("_labels", -1).alias(label),
        F.element_at("_ups", -1).alias(parent),
        F.when(named, F.array_join("_labels", separator)).alias("path"),
        (F.size("_labels") - 1).cast("bigint").alias("depth"),
    )
