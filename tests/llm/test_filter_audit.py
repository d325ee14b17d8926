import re
from collections import Counter
from itertools import permutations

import pytest

from tillwright.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_failures(rows):
    """rows: (doc_id, text, lang); the letters that each row fails."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words, fails = WORD.findall(text), set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if i is not None and i > least[text]:
            fails.add("E")
        out.append(fails)
    return out


def plain_audit(rows, labels):
    """Every order applied row by row."""
    parts = {lang or "" for _, _, lang in rows}
    fails, found = plain_failures(rows), {}
    for order in permutations("ABCDE"):
        alive = list(range(len(rows)))
        for step, letter in enumerate(order, 1):
            gone = [k for k in alive if letter in fails[k]]
            left = set(alive)
            for part in parts:
                own = [k for k in range(len(rows)) if (rows[k][2] or "") == part]
                lost = [k for k in gone if (rows[k][2] or "") == part]
                found[part, "".join(order), step] = [
                    sum(k in left and letter not in fails[k] for k in own),
                    len(lost),
                    sum(letter in fails[k] and k not in left for k in own),
                    sum(fails[k] == {letter} for k in own),
                    sum(labels.get(rows[k][0], (0, 0))[0] == 1 for k in lost),
                    sum(labels.get(rows[k][0], (0, 0))[1] == 1 for k in lost),
                ]
            alive = [k for k in alive if letter not in fails[k]]
    total = Counter()
    for (part, order, step), counts in found.items():
        total[part, order[step - 1]] += counts[1]
    return {(*key, *counts, total[key[0], key[1][key[2] - 1]]) for key, counts in found.items()}


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LONG = " ".join(f"word{k}" for k in range(250))
ROWS = [
    (5, LONG, "en"), (3, LONG, "fr"), (9, LONG, "en"), (3, LONG, "fr"), (None, LONG, "en"),
    (8, "short", "en"), (2, "short", "en"), (1, "SHORT", "en"), (4, "a # b", None), (6, "a # b", ""), (7, None, "en"), (0, "", "de"),
    (11, "same " * 300, "en"), (12, "same " * 300, "en"), (10, "same " * 300, "de"), (13, LONG + " $", "en"), (None, None, None), (14, "É" * 99 + "ABC", "en"),
]
LABELS = [(3, 1, 0), (5, 1, 1), (9, 0, 1), (8, 1, None), (None, 1, 1), (10, 0, 0), (10, 1, 0), (99, 1, 1)]
BEST = {3: (1, 0), 5: (1, 1), 9: (0, 1), 8: (1, 0), 10: (1, 0)}


def written(spark, path, rows, columns="doc_id long, text string, lang string, mask string, n string"):
    spark.createDataFrame([(*r, "m", None) for r in rows], columns).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def audited(spark, log):
    found = filter_audit.interactions(filter_audit.counters(spark, log), "ABCDE")
    assert sorted(found.columns) == sorted(COLUMNS)
    return {tuple(r[c] for c in COLUMNS) for r in found.collect()}


@pytest.mark.parametrize("order", [1, -1])
def test_smaller_ids_in_later_files_take_masks_back(spark, tmp_path, labels, order):
    path, rows = str(tmp_path / "documents"), sorted(ROWS, key=repr)[::order]
    for k in range(0, len(rows), 3):
        written(spark, path, rows[k : k + 3])
    log = filter_audit.new_log(spark, path)
    filter_audit.add_files(spark, path, labels, log, batches=6)
    changes = spark.read.parquet(f"{log}/changes")
    assert changes.select("batch_id").distinct().count() >= 5
    assert order > 0 or changes.filter("n < 0").count() > 0
    assert audited(spark, log) == plain_audit(ROWS, BEST)


def test_files_that_come_later_are_added(spark, tmp_path, labels):
    path = str(tmp_path / "documents")
    written(spark, path, ROWS[:9])
    log = filter_audit.new_log(spark, path)
    filter_audit.add_files(spark, path, labels, log)
    assert audited(spark, log) == plain_audit(ROWS[:9], BEST)
    written(spark, path, ROWS[9:])
    filter_audit.add_files(spark, path, labels, log)
    assert audited(spark, log) == plain_audit(ROWS, BEST)
    # nothing new, nothing counted twice
    filter_audit.add_files(spark, path, labels, log)
    assert audited(spark, log) == plain_audit(ROWS, BEST)


def test_copies_of_one_text_are_folded_before_they_are_sent(spark, tmp_path, labels):
    path, rows = str(tmp_path / "documents"), [(i, LONG, "en") for i in range(400, 0, -1)] + [(1000 + i, f"{i}", "en") for i in range(50)]
    written(spark, path, rows[:225])
    written(spark, path, rows[225:])
    log = filter_audit.new_log(spark, path)
    filter_audit.add_files(spark, path, labels, log, batches=2)
    assert audited(spark, log) == plain_audit(rows, BEST | {99: (1, 1)})


def test_fold_keeps_the_smallest_id_and_its_rows():
    import pyarrow as pa

    rows = [(1, "d", "en", 0, 0, 0, i) for i in (7, 4, None, 4, 9)] + [(1, "d", "en", 0, 1, 0, 3)]
    names = ["bucket", "digest", "part", "mask", "good", "toxic", "doc_id"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    got = {tuple(r.values()) for out in filter_audit._folded(iter([batch])) for r in out.to_pylist()}
    assert got == {(1, "d", "en", 0, 0, 0, True, 4, 2, 4), (1, "d", "en", 0, 0, 0, False, 0, 1, 1), (1, "d", "en", 0, 1, 0, True, 3, 1, 1)}


def test_ids_beyond_floating_numbers_beside_null_ones(spark, tmp_path, labels):
    big = 2**62
    rows = [(big + 1, LONG, "en"), (None, LONG, "en"), (big, LONG, "en"), (-big - 1, "short", "en"), (-big, "short", "en"), (None, "short", "de")]
    path = str(tmp_path / "documents")
    written(spark, path, rows)
    log = filter_audit.new_log(spark, path)
    filter_audit.add_files(spark, path, labels, log)
    assert audited(spark, log) == plain_audit(rows, {})


def test_odd_rows_and_nothing(spark, odd, nothing, tmp_path, labels):
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    for name, docs, want in (("odd", odd, plain_audit(rows, BEST)), ("nothing", nothing, set())):
        path = str(tmp_path / name)
        docs.write.parquet(path)
        log = filter_audit.new_log(spark, path)
        filter_audit.add_files(spark, path, labels, log)
        assert audited(spark, log) == want


def test_other_filters(spark, tmp_path, labels):
    """Two filters of one's own and the one of repeated texts: six orders."""
    path = str(tmp_path / "documents")
    written(spark, path, ROWS)
    log = filter_audit.new_log(spark, path)
    checks = lambda text: {"X": text == "", "Y": text.startswith("a")}
    filter_audit.add_files(spark, path, labels, log, checks=checks)
    found = filter_audit.interactions(filter_audit.counters(spark, log), "XYZ").collect()
    assert len(found) == 6 * 3 * len({lang or "" for _, _, lang in ROWS})
    first = {(r.part, r.filter_order[0]): r for r in found if r.step == 1}
    assert first["en", "X"].removed == 1 and first["", "Y"].removed == 2 and first["", "Z"].removed == 1
    assert all(r.kept + r.removed == sum((lang or "") == r.part for _, _, lang in ROWS) for r in found if r.step == 1)
