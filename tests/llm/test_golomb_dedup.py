import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tillwright.llm import golomb_dedup
from tillwright.llm.golomb_dedup import Ranges, answer, decode, encode


def plain_rows(rows):
    """rows: (doc_id, text). doc_id, keep_id, group_size, text_sha256 of each, and the texts."""
    lower = {k: k + 32 for k in range(65, 91)}
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(lower)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("n, width", [(1, 1), (1, 40), (500, 600), (500, 1 << 20), (3000, 1 << 40), (20, 1 << 60)])
def test_codes_come_back(n, width):
    values = np.unique(np.random.default_rng(n).integers(0, width, n))
    shift, unary, rest = encode(values)
    assert decode(len(values), shift, unary, rest).tolist() == values.tolist()


def test_codes_come_near_their_entropy():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 26, 1 << 16))
    _, unary, rest = encode(values)
    # a gap of mean 1024: 10 bits and about one and a half more
    assert 8 * (len(unary) + len(rest)) < 12 * len(values)


def test_owners_mark_what_several_parts_sent():
    import pyarrow as pa

    rng, ranges = np.random.default_rng(1), Ranges(30, 3)
    hashes = {p: rng.integers(-(1 << 63), 1 << 63, 200) for p in range(5)}
    hashes[3][:50] = hashes[1][:50]
    hashes[4][:9] = hashes[1][:9]
    hashes[0][:7] = hashes[0][7:14]
    tables = {p: pa.table({"hash": pa.array(h)}) for p, h in hashes.items()}
    sent = pa.concat_tables([ranges.send((pa.scalar(p),), t) for p, t in tables.items()])
    answers = pa.concat_tables([answer((o,), sent.filter(pa.compute.equal(sent["owner"], o))) for o in set(sent["owner"].to_pylist())])
    for p, h in hashes.items():
        found = ranges.suspects((pa.scalar(p),), tables[p], answers.filter(pa.compute.equal(answers["part"], p)))["hash"].to_pylist()
        others = np.concatenate([ranges.fingerprints(x) for q, x in hashes.items() if q != p])
        own = ranges.fingerprints(h).tolist()
        want = {int(x) for x, f in zip(h, own) if f in others or own.count(f) > 1}
        assert set(found) == want and len(found) == len(want)


def test_fingerprints_widen_with_the_table():
    assert [Ranges.of(n).bits for n in (0, 1, 1000, 10**6, 10**11, 10**18)] == [11, 11, 20, 30, 47, 62]
    assert [Ranges.of(n).owner_bits for n in (0, 1 << 22, (1 << 22) + 1, 1 << 30)] == [0, 0, 1, 8]


def test_equals_plain_version_on_copies_in_many_parts(spark):
    rng = random.Random(5)
    texts = [None, "", "x", "É", "é", *(f"Text {k} " * 9 for k in range(300))]
    rows = [(i, rng.choice(texts)) for i in range(900)] + [(i, "ONE text in a third of all rows") for i in range(900, 1400)]
    rows += [(i, rng.choice([str.upper, str.lower])("copies of the same id")) for i in [7, 7, 7, None, None]]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(23)
    want, groups = plain_rows(rows)
    found = golomb_dedup.exact_duplicates(docs)
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_no_fingerprint_bits_to_spare_only_makes_more_suspects(spark, monkeypatch):
    rows = [(i, f"text {i % 150}") for i in range(400)]
    want, _ = plain_rows(rows)
    monkeypatch.setattr(golomb_dedup, "SPARE_BITS", -6)
    got = golomb_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want


def test_odd_rows(odd, nothing):
    got = golomb_dedup.exact_duplicates(odd).collect()
    want, groups = plain_rows([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups
    assert golomb_dedup.exact_duplicates(nothing).collect() == []


def test_tables_in_buckets_of_part_are_joined_in_place(spark):
    from tillwright.llm.common import by_part, in_place

    rows = spark.range(200).selectExpr("id % 9 AS part", "id AS hash", "'t' AS text")
    held, few = by_part(rows, "held"), by_part(rows.filter("hash % 5 = 0").select("part", "hash"), "few").hint("shuffle_hash")
    texts = held.join(few, ["part", "hash"], "left_semi").select("part", "text").distinct()
    with in_place(spark):
        plan = texts._jdf.queryExecution().executedPlan().toString()
        assert texts.count() == 9
    assert "Exchange" not in plan and "Bucketed: true" in plan
