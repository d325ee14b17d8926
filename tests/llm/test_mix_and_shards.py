import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwright.llm import mixing, sharding
from tillwright.llm.queries import QUERIES, SHARDS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """sizes: source -> words. Reshare until none is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]


def check_mix(rows, docs):
    sizes = Counter()
    for _, source, text in docs:
        sizes[source] += len(WORD.findall(text or ""))
    want = plain_targets(sizes)
    taken = Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK, source


def test_mix_meets_its_targets_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    rows = mixing.mix(docs).collect()
    check_mix(rows, plain)
    again = mixing.mix(docs.repartition(7, "text")).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_mix_over_many_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs, shard_words=3000).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - t) <= 0.02 * t + 16 for s, t in target.items())


def test_odd_rows_and_the_mix_itself(odd, nothing):
    rows = mixing.mix(odd, block=2)
    found = rows.collect()
    check_mix([r for r in found], [(r.doc_id, r.source, r.text) for r in odd.collect()])
    texts = mixing.mixed(odd, rows).collect()
    words = Counter()
    for r in texts:
        words[r.doc_id] += len(WORD.findall(r.text))
    want = Counter()
    for r in found:
        want[r.doc_id] += r.taken
    assert +words == +want
    assert all(r.n_chars == len(r.text) for r in texts)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing, mixing.mix(nothing)).count() == 0


def highest_quotients(votes, seats):
    got = Counter()
    for _ in range(seats):
        best = min(votes, key=lambda p: (-votes[p] / (2 * got[p] + 1), p is None, p or ""))
        got[best] += 1
    return got


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 333])
def test_apportionment_is_by_highest_quotients(spark, seats):
    votes = {"a": 1000.0, "b": 333.0, "c": 333.0, "d": 1.0, None: 90.0, "e": 0.0, "f": 12.5}
    rows = [(1, p, v, seats) for p, v in votes.items()] + [(2, "x", 1.0, 5)]
    got = mixing.apportion(spark.createDataFrame(rows, "g int, party string, votes double, seats long"), ["g"], "party", "votes", "seats").collect()
    assert {r.party: r.quota for r in got if r.g == 1} == {p: highest_quotients(votes, seats)[p] for p in votes}
    assert {r.quota for r in got if r.g == 2} == {5}


def plain_fill(shards, slots):
    order = []
    for name in shards:
        at, step = sharding._number(f"offset:{name}") % slots, sharding._number(f"step:{name}") % (slots - 1) + 1
        order.append([(at + k * step) % slots for k in range(slots)])
    table = {}
    while len(table) < slots:
        for k in range(len(shards)):
            if len(table) < slots:
                table[next(s for s in order[k] if s not in table)] = k
    return [table[s] for s in range(slots)]


def test_table_is_filled_by_turns_and_even():
    names = [f"s{k}" for k in range(7)]
    assert sharding.fill(names, 251) == plain_fill(names, 251)
    counts = Counter(sharding.fill(SHARDS))
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == len(SHARDS)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 250)


def test_losing_a_shard_moves_little():
    before, after = sharding.fill(SHARDS), sharding.fill(SHARDS[:-1])
    stayed = [b == a for b, a in zip(before, after) if b != len(SHARDS) - 1]
    assert sum(stayed) > 0.85 * len(stayed)


def test_place_is_native_and_total(spark, odd, nothing, tmp_path):
    rows = QUERIES["op10_shard"](spark, SF)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Python" not in plan and "Scan ExistingRDD" not in plan
    assert rows.filter("shard is null").isEmpty() and rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    placed = sharding.place(odd, "doc_id", ["x", "y"], 11)
    assert placed.count() == odd.count() and placed.filter("shard is null").isEmpty()
    sharding.write_shards(placed, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd.count()
    assert sharding.place(nothing, "doc_id", ["x"], 11).count() == 0
    taken = sharding.place(odd.withColumns({"slot": F.lit(1), "held": F.lit(2)}), "doc_id", ["x"])
    assert taken.columns == [*odd.columns, "slot", "held", "slot_", "shard"] and {(r.slot, r.held) for r in taken.collect()} == {(1, 2)}


def test_columns_named_like_the_mix_own_ones_stay(odd):
    named = odd.withColumns({c: F.lit(7) for c in ("of", "row", "pieces", "piece", "hashed", "_doc", "_p")})
    taken = mixing.mix(named)
    out = mixing.mixed(named, taken)
    assert out.dtypes == named.dtypes and all(r["of"] == r["row"] == r["_p"] == 7 for r in out.collect())
    words = lambda t: len(WORD.findall(t or ""))
    assert sum(words(r.text) for r in out.collect()) == taken.agg(F.sum("taken")).first()[0]
