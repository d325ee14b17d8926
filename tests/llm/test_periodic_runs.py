import hashlib
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import periodic_runs
from tillwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(x, least=24, times=3):
    """Every stretch of every period, those with a smaller period left out."""
    found, n = set(), len(x)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, times * q) and not any(all(x[t] == x[t + p] for t in range(i, i + size - p)) for p in range(1, q)):
                found.add((i, size, q))
            i = j + 1
    return sorted(found)


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    )


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {plain_row(r.doc_id, r.text) for r in docs}
    found = QUERIES["op11_periodic_runs"](spark, SF)
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    }
    got = found.collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == want
    assert sum(r.n_runs > 0 for r in got) > 10


@st.composite
def sequences(draw):
    letters = st.integers(0, draw(st.sampled_from([0, 1, 2, 30])))
    parts = []
    for _ in range(draw(st.integers(0, 4))):
        parts += draw(st.lists(letters, max_size=40))
        period = draw(st.lists(letters, min_size=1, max_size=14))
        parts += [period[k % len(period)] for k in range(draw(st.integers(0, 70)))]
    return parts


@settings(max_examples=300, deadline=None)
@given(sequences())
def test_runs_equal_plain_version(words):
    assert periodic_runs.runs_of(words) == plain_runs(words)


@settings(max_examples=100, deadline=None)
@given(sequences())
def test_other_bounds(words):
    assert periodic_runs.runs_of(words, 8, 4) == plain_runs(words, 8, 4)


def test_rare_words_split_again_and_again():
    # b becomes rare only after x has cut its segment
    words = ["a", "b"] * 6 + ["x"] + ["a", "c"] * 20 + ["b"]
    codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
    import numpy as np

    assert periodic_runs.split(np.array([codes[w] for w in words])) == [(13, 53)]


def test_long_texts_take_no_squared_time():
    n = 200_000
    assert periodic_runs.runs_of(["a"] * n) == [(0, n, 1)]
    assert periodic_runs.runs_of([k % 37 for k in range(n)]) == [(0, n, 37)]
    # half a million words without a run that all stay in one segment
    words = [k.bit_count() % 2 for k in range(n)]
    assert periodic_runs.runs_of(words) == []


def test_odd_rows(odd, nothing):
    found = periodic_runs.periodic_runs(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    for k in (2, 3, 4):
        assert (by_id[k].n_words, by_id[k].runs, by_id[k].collapsed) == (0, [], "")
    long = by_id[6]
    assert [tuple(r) for r in long.runs] == [(0, 36000, 9)] and long.collapsed == "a long text about many things, again and again."
    assert long.lang_pred == "y" and by_id[2].text is None
    assert sum(r.doc_id == 1 for r in found) == 2
    assert periodic_runs.periodic_runs(nothing).collect() == []


def test_collapsed_keeps_other_texts_as_they_are(odd):
    cut = periodic_runs.collapsed(odd)
    assert cut.dtypes == odd.dtypes
    before, after = ({(r.doc_id, r.text) for r in df.collect()} for df in (odd, cut))
    assert before - after == {r for r in before if r[0] == 6} and len(after) == len(before)


def test_names_that_are_taken(odd):
    named = odd.withColumns({"runs": odd["doc_id"], "Collapsed": odd["n_chars"]})
    found = periodic_runs.periodic_runs(named)
    assert found.columns == [*named.columns, "n_words", "runs_", "collapsed_"]
    assert {(r.doc_id, r.runs) for r in found.collect()} == {(r.doc_id, r.doc_id) for r in odd.collect()}
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(odd, times=2)
