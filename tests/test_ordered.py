"""Slot-wise operators against brute force, with one key that holds a third of all rows."""

import random
from datetime import datetime, timedelta
from itertools import accumulate

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tillwright.operators import joins, ordered

START = datetime(2024, 1, 1)


def skewed(n=900, seed=1, spread_minutes=3000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        ts = START + timedelta(minutes=rnd.randrange(spread_minutes), seconds=rnd.choice([0, 30]))
        out.append((key, ts, i, rnd.randrange(-5, 9)))
    return out


SCHEMA = "k string, ts timestamp, id bigint, v bigint"


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("grain", ["minute", "hour", "day", "year"])
def test_running_total(make, grain):
    data = skewed()
    df = make(data, SCHEMA)
    out = ordered.running_total(df, ["k"], ["ts", "id"], "v", "total", ordered.time_slot("ts", grain))
    want = {}
    for group in by_key(data).values():
        want.update(zip((r[2] for r in group), accumulate(r[3] for r in group), strict=True))
    assert out.columns == [*df.columns, "total"]
    assert {r.id: r.total for r in out.collect()} == want


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbours(make, step):
    data = skewed(seed=2)
    look = ordered.previous_row if step < 0 else ordered.next_row
    out = look(make(data, SCHEMA), ["k"], ["ts", "id"], ["id", "v"], "n", ordered.time_slot("ts"))
    want = {}
    for group in by_key(data).values():
        for i, row in enumerate(group):
            j = i + step
            want[row[2]] = (group[j][2], group[j][3]) if 0 <= j < len(group) else None
    assert {r.id: r.n and tuple(r.n) for r in out.collect()} == want


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_group_ordinal(make, grain):
    data = skewed(seed=3, spread_minutes=9000)
    gap = 30 * 60 * 1_000_000
    out = ordered.group_ordinal(make(data, SCHEMA), ["k"], "ts", "id", gap, "run", ordered.time_slot("ts", grain))
    want = {}
    for group in by_key(data).values():
        run, last = 0, None
        for row in group:
            run += last is None or row[1] - last > timedelta(minutes=30)
            last = row[1]
            want[row[2]] = run
    assert {r.id: r.run for r in out.collect()} == want


def test_gap_of_exactly_thirty_minutes_stays_together(make):
    times = [START, START + timedelta(minutes=30), START + timedelta(minutes=60, microseconds=1)]
    df = make([("a", t, i, 0) for i, t in enumerate(times)], SCHEMA)
    out = ordered.group_ordinal(df, ["k"], "ts", "id", 30 * 60 * 1_000_000, "run", ordered.time_slot("ts"))
    assert [r.run for r in out.orderBy("id").collect()] == [1, 1, 2]


def test_ordered_lists_lose_nothing(make):
    data = skewed(seed=4)
    df = make(data, SCHEMA).withColumn("hour", ordered.time_slot("ts"))
    out = ordered.ordered_lists(df, ["k", "hour"], ["ts", "id"], ["id"], "ids")
    found = {}
    for r in sorted(out.collect(), key=lambda r: r.hour):
        found.setdefault(r.k, []).extend(e.id for e in r.ids)
    assert found == {k: [r[2] for r in g] for k, g in by_key(data).items()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-9, 9))), min_size=1, max_size=40))
def test_rank_desc(make, values):
    data = [(g, None if v is None else v * 10, i) for i, (g, v) in enumerate(values)]
    df = make(data, "g string, v bigint, id bigint").withColumn("v", F.col("v").cast("decimal(12,2)"))
    out = ordered.rank_desc(df, "v", ["g"], "r", "d")
    size = lambda v: float("-inf") if v is None else v
    distinct = sorted({size(v) for _, v, _ in data}, reverse=True)
    for row in out.collect():
        mine = size(None if row.v is None else float(row.v))
        assert row.r == 1 + sum(1 for g, v, _ in data if g == row.g and size(v) > mine)
        assert row.d == 1 + distinct.index(mine)
    assert out.count() == len(data)


ODD_VALUES = (None, float("-inf"), -1e15, -12.5, -0.01, 0.0, -0.0, 0.004, 0.5, 3.0, 1e6, 1e15, float("inf"), float("nan"))


@pytest.mark.parametrize("bounds, block", [(1024, 32), (4, 2), (1, 1)])
def test_ranks_of_odd_values_and_few_bounds(make, monkeypatch, bounds, block):
    monkeypatch.setattr(ordered, "BOUNDS", bounds)
    monkeypatch.setattr(ordered, "BLOCK", block)
    data = [(g, v, i) for i, (g, v) in enumerate((g, v) for v in ODD_VALUES for g in ("a", "a", "b", None))]
    size = lambda v: -2e308 if v is None else 1e400 if v != v else v
    place = {id(v): k for k, v in enumerate(ODD_VALUES)}
    order = lambda v: (0 if v is None else 2 if v != v else 1, size(v))
    distinct = sorted({order(v) for v in ODD_VALUES}, reverse=True)
    out = ordered.rank_desc(make(data, "g string, v double, id bigint").repartition(3), "v", ["g"], "r", "d").collect()
    assert len(out) == len(data) and place
    for row in out:
        assert row.d == 1 + distinct.index(order(row.v))
        assert row.r == 1 + sum(g == row.g and order(v) > order(row.v) for g, v, _ in data)


def test_ranking_is_spread_when_all_values_are_close_and_one_is_hot(spark):
    """All values within a hundredth, a third of the rows with one and the same."""
    close = 1_000_000 + F.pmod(F.xxhash64("id"), F.lit(10_000))
    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1_000_500).otherwise(close).alias("v"), (F.col("id") % 5).alias("g"), "id")
    rows_ = df.withColumn("_row", F.xxhash64("v", "g", "id"))
    dealt = ordered._between_bounds(rows_, F.col("v"))
    dealt = dealt.withColumn("salt", F.when(F.col("_slot") % 2 == 1, F.pmod("_row", F.lit(ordered.SALTS))))
    sizes = sorted(r["count"] for r in dealt.groupBy("_slot", "salt").count().collect())
    assert len(sizes) > 1000 and sizes[-1] < 60_000 / 64
    out = ordered.rank_desc(df, "v", ["g"], "r", "d")
    values = [r.v for r in df.select("v").distinct().collect()]
    place = {v: k + 1 for k, v in enumerate(sorted(values, reverse=True))}
    found = out.collect()
    assert len(found) == 60_000 and all(r.d == place[r.v] for r in found)
    first = {g: sorted((r.v for r in found if r.g == g), reverse=True) for g in range(5)}
    for g, vs in first.items():
        ranks = {}
        for k, v in enumerate(vs):
            ranks.setdefault(v, k + 1)
        assert all(r.r == ranks[r.v] for r in found if r.g == g)


def test_latest_per_key(make):
    data = skewed(seed=5)
    out = ordered.latest_per_key(make(data, SCHEMA), ["k"], [F.col("ts").desc(), F.col("id").desc()])
    assert {r.k: r.id for r in out.collect()} == {k: g[-1][2] for k, g in by_key(data).items()}


@pytest.mark.parametrize("pairs_per_key", [1 << 24, 50, 1])
def test_followed_within(make, pairs_per_key):
    left = [(r[0], r[1], r[2]) for r in skewed(200, 6, 20000)]
    right = [(r[0], r[1], r[2]) for r in skewed(200, 7, 20000)]
    # exactly one day later still counts, a second more does not; times before 1970 work too
    for shift in (0, -80 * 365):
        base = START + timedelta(days=shift)
        left.append(("edge", base, 1000 + shift))
        right += [("edge", base + timedelta(days=1), 2000 + shift), ("edge", base + timedelta(days=1, seconds=1), 3000 + shift)]
        right.append(("edge", base - timedelta(microseconds=1), 4000 + shift))
    day = timedelta(days=1)
    want = []
    for k, t, i in left:
        hits = [j for k2, t2, j in right if k is not None and k2 == k and t <= t2 <= t + day]
        want += [(i, j) for j in hits] or [(i, None)]
    a, b = make(left, "k string, ts timestamp, id bigint"), make(right, "rk string, rts timestamp, rid bigint")
    out = joins.followed_within(a, b, [("k", "rk")], "ts", "rts", 24 * 3600, pairs_per_key=pairs_per_key)
    assert rows(out, "id", "rid") == sorted(want, key=repr)


def test_pairs_of_a_hot_key_are_dealt_to_many_tasks(spark):
    """Two thirds of both sides belong to one customer, most of them to one day."""
    spread = lambda n, key: spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias(key),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7200 * 3).alias(f"{key}_ts"),
        F.col("id").alias(f"{key}_id"),
    )
    left, right, limit = spread(6000, "l"), spread(3000, "r"), 100_000
    lhs, rhs = joins.dealt_by_pairs(left, right, [("l", "r")], "l_ts", "r_ts", 24 * 3600, limit)
    starts = lhs.groupBy("l", "_lslot", "_lpart").agg(F.count(F.lit(1)).alias("n"))
    ends = rhs.groupBy("r", "_rslot", "_rpart").agg(F.count(F.lit(1)).alias("m"))
    cells = starts.join(ends, (F.col("l") == F.col("r")) & (F.col("_lslot") == F.col("_rslot")) & (F.col("_lpart") == F.col("_rpart")))
    hot = cells.filter("l = 'hot'").collect()
    assert len(hot) > 40 and max(r.n * r.m for r in hot) < 1.6 * limit
    # rows of other keys are listed in their two slots and no more
    assert rhs.filter("r <> 'hot'").count() == 2 * 1000 and lhs.count() == 6000
    want = left.join(right, (F.col("l") == F.col("r")) & (F.col("r_ts").between(F.col("l_ts"), F.col("l_ts") + F.expr("interval 1 day"))), "left")
    got = joins.followed_within(left, right, [("l", "r")], "l_ts", "r_ts", 24 * 3600, pairs_per_key=limit)
    mark = [F.count(F.lit(1)), F.count("r"), F.sum(F.xxhash64("l_id", "r_id").cast("decimal(38,0)"))]
    assert got.agg(*mark).first() == want.agg(*mark).first()


def test_last_before_takes_nothing_later(make):
    """Two other tables, ties, guests without a key, a hot key, slots without rows."""
    data, others = skewed(300, 11, 20000), {"a": skewed(200, 12, 20000), "b": skewed(60, 13, 20000)}
    data += [("hot", START, 900, 0), (None, START, 901, 0), ("a", None, 902, 0), ("late", START, 903, 0)]
    others["a"] += [("hot", START, 5, 1), ("hot", START, 7, 1), ("late", START + timedelta(microseconds=1), 8, 1), (None, START, 9, 1), ("a", None, 9, 1)]
    tables = {name: (make(rows_, "rk string, rts timestamp, rid bigint, rv bigint"), "rk", "rts", ["rid", "rv"]) for name, rows_ in others.items()}
    left = make(data, SCHEMA)
    out = ordered.last_before(left, "k", "ts", tables)
    assert out.columns == [*left.columns, "a", "b"] and out.count() == len(data)
    for row in out.collect():
        for name, rows_ in others.items():
            seen = [(t, i, v) for k, t, i, v in rows_ if k == row.k and k and t and row.ts and t <= row.ts]
            assert (row[name] and tuple(row[name])) == (max(seen)[1:] if seen else None)


@pytest.mark.parametrize("look", [ordered.previous_row, ordered.next_row])
def test_neighbours_read_their_rows_once(spark, tmp_path, look):
    path = str(tmp_path / "rows")
    spark.range(50).selectExpr("id % 3 AS k", "timestamp_seconds(id * 900) AS ts", "id").write.parquet(path)
    found = look(spark.read.parquet(path), ["k"], ["ts"], ["id"], "near", ordered.time_slot("ts"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_what_one_task_reads_is_bounded_unless_the_session_says_otherwise(spark):
    from tillwright import session

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        for given, want in ((None, "16m"), ("5m", "5m")):
            spark.conf.unset(key) if given is None else spark.conf.set(key, given)
            assert session.prepare(spark).conf.get(key) == want
        assert session.BYTES_PER_PARTITION <= 8 << 20
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
