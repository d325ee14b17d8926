import numpy as np
import pytest

from tillwright.llm import ball_tree, multi_index, search
from tillwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
INF, NAN = float("inf"), float("nan")
SCHEMA = "vec_id long, embedding array<float>, label int, x string, block int"


@pytest.fixture(scope="module")
def table(spark):
    return {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}


def plain(vectors, every, k, whole):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=float)
    x = np.floor(64 * x) if whole else x
    found = {}
    for q in range(len(ids)):
        if ids[q] % every == 0:
            scores = (x * x[q]).sum(1)
            order = [o for o in np.lexsort((ids, -scores)) if o != q][:k]
            found[int(ids[q])] = [(int(ids[o]), float(scores[o])) for o in order]
    return found


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, float(r.score)))
        assert r.rank == len(found[r.query_id])
    return found


def test_ball_tree_is_exact(spark, table):
    assert by_query(QUERIES["op6_ball_tree"](spark, SF).collect()) == plain(table, 20, 20, True)


def test_ball_tree_over_many_blocks(spark, table, monkeypatch):
    monkeypatch.setattr(ball_tree, "blocks", lambda n, size=0: 3)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert by_query(ball_tree.best(rows, 7, 5).collect()) == plain(table, 7, 5, True)


def test_multi_index_recall_scores_and_order(spark, table, monkeypatch):
    monkeypatch.setattr(multi_index, "blocks", lambda n, size=0: 2)
    got, want = by_query(QUERIES["op1_multi_index"](spark, SF).collect()), plain(table, 20, 20, False)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        for i, score in found:
            assert score == pytest.approx(np.dot(np.array(table[q]), np.array(table[i])), abs=1e-12)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (3000, 8), dtype=np.uint8)
    codes[:400] = codes[0] ^ np.packbits(rng.random((400, 64)) < 0.15, axis=1)
    index = multi_index.Index(codes)
    apart = np.bitwise_count(codes ^ codes[0]).sum(1)
    for radius in (0, 3, 7, 8, 13, 24, 31, 64):
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(apart <= radius).tolist()


ODD = [
    (0, [1.0, 0.0], 1, "a", 1),
    (20, [1.0, 0.0], 1, "a", 1),
    (20, [1.0, 0.0], 1, "a", 1),
    (40, [1e30, -1e30], None, None, None),
    (3, [0.0, 0.0], 1, "a", 1),
    (4, None, 1, "a", 1),
    (5, [1.0, None], 1, "a", 1),
    (6, [NAN, 1.0], 1, "a", 1),
    (7, [INF, 1.0], 1, "a", 1),
    (8, [], 1, "a", 1),
    (9, [1.0, 2.0, 3.0], 1, "a", 1),
    (None, [1.0, 1.0], 1, "a", 1),
    (11, [-1.0, 0.5], 1, "a", 1),
]


def test_odd_vectors(spark):
    rows = spark.createDataFrame(ODD, SCHEMA)
    near = lists(multi_index.nearest(rows, 20, 20).collect())
    assert near == {
        0: [[40, 20, 20, 11]],
        20: [[40, 0, 20, 11]] * 2,
        40: [[0, 20, 20, 11]],
    }
    with pytest.raises(ValueError, match="vec_id 40"):
        ball_tree.best(rows, 20, 20)
    small = ball_tree.best(rows.filter("vec_id is null or vec_id <> 40"), 20, 20).collect()
    assert lists(small) == {0: [[20, 20, 3, 11]], 20: [[0, 20, 3, 11]] * 2}
    assert {(r.vec_id, r.score) for r in small} == {(0, 4096), (20, 4096), (3, 0), (11, -4096)}
    for f in (multi_index.nearest, ball_tree.best):
        assert f(spark.createDataFrame([], SCHEMA), 20, 20).count() == 0
        assert f(rows.filter("vec_id = 0"), 20, 20).count() == 0
        assert f(rows.filter("vec_id in (4, 5, 6)"), 20, 20).count() == 0


def lists(rows):
    """The lists of each query_id; rows that share the id have equal lists here, so ranks repeat."""
    by_id = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        by_id.setdefault(r.query_id, {}).setdefault(r.rank, []).append(r.vec_id)
    return {q: [list(c) for c in zip(*ranks.values())] for q, ranks in by_id.items()}


def test_rows_that_share_an_id_are_candidates_of_their_own(spark):
    """As the query's SQL has it."""
    vectors = [(7, [1.0, 0.5]), (7, [3.0, 0.5]), (7, [0.5, 0.5]), (20, [1.0, 1.0]), (20, [2.0, 0.0]), (1, [0.0, 1.0]), (40, [1.0, 0.5])]
    rows = spark.createDataFrame([(*v, None, None, None) for v in vectors], SCHEMA).repartition(3)
    x = [[int(np.floor(64 * c)) for c in v] for _, v in vectors]
    want = []
    for q, (of, _) in enumerate(vectors):
        if of % 20 == 0:
            scores = sorted((-int(np.dot(x[q], x[c])), vectors[c][0]) for c in range(len(vectors)) if c != q)
            want += [(of, k + 1, i, -s) for k, (s, i) in enumerate(scores[:4])]
    assert sorted(tuple(r) for r in ball_tree.best(rows, 20, 4).collect()) == sorted(want)
    found = multi_index.nearest(rows, 20, 6).collect()
    assert sorted(r.vec_id for r in found if r.query_id == 40) == [1, 7, 7, 7, 20, 20] and sum(r.query_id == 20 for r in found) == 12


def test_large_whole_numbers_stay_exact(spark):
    rows = spark.createDataFrame([(k, [float(2**20 + k), float(2**21 - k)], 1, "", 1) for k in range(40)], "vec_id long, embedding array<double>, label int, x string, block int")
    want = {q: sorted(((i, 64 * 64 * ((2**20 + q) * (2**20 + i) + (2**21 - q) * (2**21 - i))) for i in range(40) if i != q), key=lambda f: (-f[1], f[0]))[:3] for q in (0, 20)}
    assert {q: [(i, int(s)) for i, s in v] for q, v in by_query(ball_tree.best(rows, 20, 3).collect()).items()} == want


def test_top_breaks_ties_by_id():
    assert search.top(np.array([1.0, 2.0, 2.0, 2.0]), np.array([1, 9, 4, 7]), 2).tolist() == [2, 3]
