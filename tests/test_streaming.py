from datetime import datetime, timedelta

from conftest import rows
from tillwright.session import scratch_dir
from tillwright.streaming import jobs

CHANGES = "return_id bigint, return_ts timestamp, status string, op string, snapshot_date date"
T0 = datetime(2024, 1, 1)


def test_change_log_over_several_batches(spark, make, tmp_path):
    source, log, checkpoint = str(tmp_path / "in"), scratch_dir(spark, "log"), scratch_dir(spark, "cp")

    def feed(*changes):
        data = [(k, T0 + timedelta(hours=h), s, op, T0.date()) for k, h, s, op in changes]
        make(data, CHANGES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(CHANGES).parquet(source)
        jobs.log_changes(stream, log, checkpoint).awaitTermination()
        return rows(jobs.current_returns(spark, log, stream.schema), "return_id", "status", "is_deleted")

    assert feed((1, 0, "a", "I"), (1, 1, "b", "U"), (2, 0, "x", "I")) == [(1, "b", False), (2, "x", False)]
    # a late older change does not win, a delete stays flagged
    assert feed((1, 0, "late", "U"), (2, 5, "x", "D")) == [(1, "b", False), (2, "x", True)]
    schema = spark.read.parquet(source).schema
    compact = scratch_dir(spark, "compact")
    jobs.compact_changes(spark, log, compact, schema)
    assert spark.read.parquet(compact).count() == 2
    assert rows(jobs.current_returns(spark, compact, schema), "return_id", "status", "is_deleted") == [
        (1, "b", False), (2, "x", True),
    ]


def test_sessions_over_batches_out_of_order(spark, make, tmp_path):
    source, log, checkpoint = str(tmp_path / "in"), scratch_dir(spark, "sessions"), scratch_dir(spark, "cp")
    schema = "user_sk bigint, event_ts timestamp"
    for minutes in ([600, 61], [0], [30, 610, 610]):  # a gap of exactly thirty minutes is one session
        make([(1, T0 + timedelta(minutes=m)) for m in minutes], schema).coalesce(1).write.mode("append").parquet(source)
        jobs.log_click_times(spark.readStream.schema(schema).parquet(source), log, checkpoint).awaitTermination()
    found = rows(jobs.click_sessions(spark, log), "started_ts", "clicks", "is_open")
    assert found == [(T0, 2, False), (T0 + timedelta(minutes=61), 1, False), (T0 + timedelta(minutes=600), 3, True)]


def test_a_batch_reads_open_sessions_and_late_clicks_open_closed_ones(spark, make, tmp_path):
    """Random clicks of two users, a hot one among them, in batches of which some come late, against one fold of all."""
    import random

    rnd, store, schema = random.Random(4), str(tmp_path / "store"), "user_sk bigint, event_ts timestamp"
    clicks = sorted(((rnd.randrange(60 * 72), rnd.choice([1, 1, 1, 2, None])) for _ in range(300)), key=str)
    clicks.sort(key=lambda c: c[0])
    batches = [clicks[k : k + 60] for k in range(0, 300, 60)]
    # two clicks of the first day come last, and one of the second between
    batches[-1].append(batches[0].pop(20))
    batches[-1].append(batches[0].pop(30))
    batches[3].append(batches[1].pop(5))
    frames = [make([(u, T0 + timedelta(minutes=m)) for m, u in b], schema) for b in batches]
    for gen, frame in enumerate(frames):
        jobs.take_clicks(frame, store, gen, 30, 60)
        if gen == 2:  # a batch that is run again
            jobs.take_clicks(frame, store, gen, 30, 60)
        held = jobs._open(spark, store, gen)
        latest = max(m for b in batches[: gen + 1] for m, _ in b)
        assert all(r.last_event_ts >= T0 + timedelta(minutes=latest - 90) for r in held.collect())
    assert [spark.read.parquet(f"{store}/reopened/gen={g}").count() > 0 for g in range(5)] == [False, False, False, True, True]
    single = [(u, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m), 1) for b in batches for m, u in b]
    want = jobs.fold_sessions(make(single, jobs.SESSION), 30)
    columns = ["user_sk", "started_ts", "last_event_ts", "clicks"]
    assert rows(jobs.click_sessions(spark, store), *columns) == rows(want, *columns)
    gap, plain = timedelta(minutes=30), 0
    for user in (1, 2, None):
        times = sorted(t for u, t, _, _ in single if u == user)
        plain += 1 + sum(b - a > gap for a, b in zip(times, times[1:]))
    assert want.count() == plain


def test_sessions_longer_than_the_gap_fold_like_their_clicks(spark, make):
    part = lambda a, b, n: (1, T0 + timedelta(minutes=a), T0 + timedelta(minutes=b), n)
    parts = make([part(0, 100, 9), part(130, 130, 1), part(50, 60, 2), part(161, 161, 1), (2, None, None, 3)], jobs.SESSION)
    found = rows(jobs.fold_sessions(parts, 30), "user_sk", "started_ts", "last_event_ts", "clicks")
    assert found == [part(0, 130, 12), part(161, 161, 1), (2, None, None, 3)]


def test_compacted_clicks_are_the_same(spark, make, tmp_path):
    source, log, new_log = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "new")
    schema = "user_id string, event_ts timestamp, page_url string"
    for _ in range(2):
        make([("u", T0, "/a"), ("u", T0, "/b"), (None, T0, "/a")], schema).coalesce(1).write.mode("append").parquet(source)
        jobs.log_clicks(spark.readStream.schema(schema).parquet(source), log, str(tmp_path / "cp")).awaitTermination()
    jobs.compact_clicks(spark, log, new_log, schema)
    assert spark.read.parquet(new_log).count() == 3
    assert rows(jobs.deduplicated_clicks(spark, new_log, schema)) == rows(jobs.deduplicated_clicks(spark, log, schema))


def test_clicks_of_late_batches_stay_and_repeats_go(spark, make, tmp_path):
    source, log, checkpoint = str(tmp_path / "in"), scratch_dir(spark, "dedup"), scratch_dir(spark, "cp")
    schema = "user_id string, event_ts timestamp, page_url string"
    day = lambda d: T0 + timedelta(days=d)
    for batch in ([("u", day(1), "/a"), ("u", day(1), "/a")], [("u", day(2), "/a")], [("u", day(0), "/b"), ("u", day(1), "/a")]):
        make(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.log_clicks(stream, log, checkpoint).awaitTermination()
    assert rows(jobs.deduplicated_clicks(spark, log, schema), "event_ts", "page_url") == [(day(0), "/b"), (day(1), "/a"), (day(2), "/a")]
