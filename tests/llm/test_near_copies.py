import random
from collections import defaultdict

from tillwright.llm import near_copies, simhash

SF = "/root/testdata/sf0.01"


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def grouped(docs):
    return {r.doc_id: r.cluster for r in near_copies.near_copies(docs).collect()}


def test_planted_near_copies_link_and_distant_ones_do_not(spark):
    rng, rows, near, far = random.Random(6), [], [], []
    for k in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        close, distant = words.copy(), words.copy()
        for at in (10, 60, 110, 160)[: k % 4 + 1]:
            close[at] = "other"
        for at in range(0, 200, 10):
            distant[at] = "other"
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(close).upper()), (3 * k + 2, " ".join(distant))]
        near.append((3 * k, 3 * k + 1))
        far.append((3 * k, 3 * k + 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = grouped(docs)
    assert all(found[a] == found[b] for a, b in near)
    assert all(found[a] != found[b] for a, b in far)
    # what the query's own defaults would leave
    kept = simhash.one_of_each(docs, near_copies.near_copies(docs))
    assert kept.count() == 80 < simhash.one_of_each(docs, simhash.near_duplicates(docs)).count()


def test_all_pairs_of_the_test_table_are_found_and_no_others(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: plain_set(r.text) for r in docs.collect()}
    meet = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            meet[g].add(i)
    pairs = {(a, b) for ids in meet.values() if len(ids) < 200 for a in ids for b in ids if a < b and similar(sets[a], sets[b])}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    found = grouped(docs)
    assert all(found[a] == found[b] for a, b in pairs)
    assert len(set(found.values())) == len({find(i) for i in sets if sets[i]}) + any(not s for s in sets.values())


def test_pairs_inside_a_family_that_shares_most_of_its_words(spark):
    """Near pairs among strangers of similarity 0.6 to 0.75: every pair shares band keys with thousands."""
    rng, rows = random.Random(3), []
    shared = [f"s{k}" for k in range(174)]
    for k in range(600):
        own = [f"o{k}_{j}" for j in range(26)]
        close = own.copy()
        for at in rng.sample(range(26), 2):
            close[at] = f"x{k}_{at}"
        rows += [(2 * k, " ".join(shared + own)), (2 * k + 1, " ".join(shared + close))]
    near = [k for k in range(600) if similar(plain_set(rows[2 * k][1]), plain_set(rows[2 * k + 1][1]))]
    assert len(near) > 500 and not similar(plain_set(rows[0][1]), plain_set(rows[2][1]))
    found = grouped(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sum(found[2 * k] == found[2 * k + 1] for k in near) >= 0.99 * len(near)
    assert len(set(found.values())) >= 600


def test_a_frequent_passage_alone_pairs_nothing(spark):
    """400 texts that share a passage: no shared sum is rare, and the bands' centres rule the rest out."""
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"w{k}_{j}" for j in range(140))) for k in range(400)]
    sets = [(k, [1, 2, 3, 10 + k]) for k in range(400)]
    shared = near_copies._sharing_rare(spark.createDataFrame(sets, "set long, sketch array<long>"))
    assert shared.count() == 0
    assert len(set(grouped(spark.createDataFrame(rows, "doc_id long, text string")).values())) == 400


def test_odd_rows(odd, nothing):
    rows = near_copies.near_copies(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r.cluster for r in rows}
    assert by_id[2] == by_id[3] == by_id[4] and by_id[7] == by_id[1] and by_id[None] != by_id[8]
    assert near_copies.near_copies(nothing).count() == 0
