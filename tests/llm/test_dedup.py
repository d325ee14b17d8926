from xxhash import xxh64_intdigest

from tillwright.llm import simhash
from tillwright.llm.graph import components
from tillwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    bits = 0
    for b in range(64):
        if 2 * sum(xxh64_intdigest(s, 42) >> b & 1 for s in shingles) > len(shingles):
            bits |= 1 << b
    return bits


def plain_components(rows):
    """rows: (doc_id, fingerprint); the smallest id reachable of each fingerprint."""
    prints = list({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, f in enumerate(prints):
        for g in prints[:i]:
            if (f ^ g).bit_count() <= 3:
                root[find(f)] = find(g)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {(i, f"{f:016x}", least.get(find(f))) for i, f in rows}


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_components([(r.doc_id, plain_print(r.text)) for r in docs])
    got = QUERIES["op5_simhash"](spark, SF).collect()
    assert len(got) == len(docs)
    assert {tuple(r) for r in got} == want


def test_odd_rows(odd, nothing):
    found = simhash.near_duplicates(odd)
    rows = found.collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fp == by_id[3].fp == by_id[4].fp == 0 and by_id[4].component_id == 2
    assert by_id[7].component_id == 1
    kept = simhash.one_of_each(odd, found)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, {r.component_id for r in rows if r.component_id is not None} | {None}))
    assert simhash.near_duplicates(nothing).count() == 0


def test_every_close_pair_links(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 20)]
    prints = set(base)
    for f in base:
        for n in (1, 2, 3, 4, 5):
            g = f
            for b in rng.choice(64, n, replace=False):
                g ^= 1 << int(b)
            prints.add(g)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    assert got == {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1200)] + [(-5, -7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1200)}, -5: -7, -7: -7}


def test_one_of_each_keeps_columns_of_any_name(odd):
    from pyspark.sql import functions as F

    named = odd.withColumns({c: F.lit(5) for c in ("_hash", "hashed", "of", "row")})
    kept = simhash.one_of_each(named, simhash.near_duplicates(named))
    assert kept.columns == named.columns and all(r["_hash"] == r["hashed"] == r["row"] == 5 for r in kept.collect())
