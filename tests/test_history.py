"""Histories kept up to date by batches: the same as one made of all states at once, and only what changes is rewritten."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from conftest import rows
from tillwright.operators import history
from tillwright.operators.history import History
from tillwright.plans import derived

H = History("k", ("a", "b"), "ts", "n", ("who",))
SCHEMA = "k string, ts timestamp, n bigint, a string, b bigint, who string, extra int"
START = datetime(2023, 11, 1)


def states(n, seed, keys=("hot", "x", "y", None)):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(keys)
        at = START + timedelta(hours=rnd.randrange(24 * 150)) if i % 40 else None
        out.append((key, at, i, rnd.choice(["p", "q", None]), rnd.choice([1, 2]), f"w{i}", 0))
    return out


def whole(df):
    return rows(derived.change_history(df, H.key, H.attributes, H.changed, H.tie, H.grain, H.carried))


def merged(spark, path, df):
    return rows(history.changes(spark, path, H, df.schema))


@pytest.mark.parametrize("order", ["in time", "backwards", "any"])
def test_batches_give_the_whole_history(spark, make, tmp_path, order):
    data = states(100, 1)
    key = lambda r: (r[1] or datetime.min, r[2])
    data.sort(key=key, reverse=order == "backwards")
    if order == "any":
        random.Random(2).shuffle(data)
    path, seen = str(tmp_path / "h"), data[:40]
    history.create(make(seen, SCHEMA), path, H)
    for a in (40, 70):
        batch = data[a : a + 30]
        seen = seen + batch
        # a part of what is known already comes again
        history.merge(make(batch + seen[a - 5 : a], SCHEMA), path, H)
        assert merged(spark, path, make(seen, SCHEMA)) == whole(make(seen, SCHEMA))
    assert history.merge(make(data[50:80], SCHEMA), path, H) == []
    assert history.merge(make([], SCHEMA), path, H) == []


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_only_open_and_changed_periods_are_rewritten(spark, make, tmp_path):
    months = [datetime(2024, m, 1) for m in range(1, 9)]
    data = [(k, at, i, f"{k}{i}", 1, "w", 0) for k in ("x", "y", "z") for i, at in enumerate(months)]
    path = str(tmp_path / "h")
    history.create(make(data, SCHEMA), path, H)
    before = files(path)
    # in time: the open change is closed in its month, nothing else moves
    assert history.merge(make([("x", datetime(2024, 9, 3), 50, "new", 1, "w", 0)], SCHEMA), path, H) == ["2024-09", "open"]
    after = files(path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "period=open" in f}
    # late: the change it falls into ends earlier, its own end is the next one
    assert history.merge(make([("y", datetime(2024, 3, 10), 51, "late", 1, "w", 0)], SCHEMA), path, H) == ["2024-03", "2024-04"]
    # late and without change: one row more, in its own month
    assert history.merge(make([("y", datetime(2024, 6, 10), 52, "y5", 1, "w", 0)], SCHEMA), path, H) == ["2024-06"]
    data += [("x", datetime(2024, 9, 3), 50, "new", 1, "w", 0), ("y", datetime(2024, 3, 10), 51, "late", 1, "w", 0), ("y", datetime(2024, 6, 10), 52, "y5", 1, "w", 0)]
    assert merged(spark, path, make(data, SCHEMA)) == whole(make(data, SCHEMA))


def test_a_period_that_loses_its_last_row_is_emptied(spark, make, tmp_path):
    data = [("x", datetime(2024, 1, 1), 1, "a", 1, "w", 0), ("x", datetime(2024, 5, 1), 2, "b", 1, "w", 0)]
    late = [("x", datetime(2024, 3, 1), 3, "b", 1, "w", 0)]
    path = str(tmp_path / "h")
    history.create(make(data, SCHEMA), path, H)
    history.merge(make(late, SCHEMA), path, H)
    got = history.changes(spark, path, H, make(data, SCHEMA).schema)
    assert rows(got) == whole(make(data + late, SCHEMA)) and got.count() == 2


def test_a_merge_that_broke_off_can_be_run_again(spark, make, tmp_path):
    """One of two periods was replaced, the other was not: a state stands in both."""
    data = states(60, 5)
    path, other = str(tmp_path / "h"), str(tmp_path / "again")
    history.create(make(data[:40], SCHEMA), path, H)
    history.create(make(data[:40], SCHEMA), other, H)
    touched = history.merge(make(data[40:], SCHEMA), other, H)
    done = spark.read.parquet(other).filter(f"period = '{touched[0]}'")
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    history.merge(make(data[40:], SCHEMA), path, H)
    assert merged(spark, path, make(data, SCHEMA)) == whole(make(data, SCHEMA))


def test_a_merge_computes_its_states_once(spark, make, tmp_path, monkeypatch):
    """They are stored, and both the altered periods and their rows are read from there."""
    data, path, kept = states(40, 7), str(tmp_path / "h"), str(tmp_path / "kept")
    monkeypatch.setattr(history, "scratch_dir", lambda _, name: f"{kept}-{name}", raising=False)
    history.create(make(data[:30], SCHEMA), path, H)
    history.merge(make(data[30:], SCHEMA), path, H)
    assert spark.read.parquet(f"{kept}-merged-states").count() >= 10
    assert merged(spark, path, make(data, SCHEMA)) == whole(make(data, SCHEMA))
