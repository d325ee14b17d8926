"""The pipeline's stages against plain versions of what each must do."""

from collections import Counter
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tillwright.llm import langid, simhash

from .test_mix_and_shards import WORD, plain_targets
from .test_near_copies import plain_set, similar

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    found.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs)
    return found


def test_all_but_the_last_return_the_columns_of_documents(steps):
    assert all(df.dtypes == steps[0].dtypes for df in steps[:-1])


def test_language_stage_drops_what_cannot_be_told(steps):
    classifier = langid.Classifier(langid.learn(steps[0]))
    want = set()
    for r in steps[0].collect():
        lang, score = classifier.predict(r.text)
        if lang != "und" and score >= 0.001:
            want.add(tuple(r))
    assert {tuple(r) for r in steps[1].collect()} == want
    assert len(want) >= 0.98 * steps[0].count()


def test_one_of_each_group_stays(steps):
    """The smallest id of each component under five-word shingles and a similarity of 0.8."""
    sets = {r.doc_id: plain_set(r.text) for r in steps[1].collect()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if not (sets[a] or sets[b]) or similar(sets[a], sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    want = {find(i) for i in sets}
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(want)
    assert len(want) < len(sets)


def test_mix_comes_near_its_targets(steps):
    size, source, sizes, taken = {}, {}, Counter(), Counter()
    for r in steps[2].collect():
        size[r.doc_id], source[r.doc_id] = len(WORD.findall(r.text)), r.source
        sizes[r.source] += size[r.doc_id]
    per_document = Counter()
    for r in steps[3].collect():
        n = len(WORD.findall(r.text))
        per_document[r.doc_id] += n
        taken[source[r.doc_id]] += n
        assert r.n_chars == len(r.text) and r.source == source[r.doc_id]
    assert all(n <= 2 * size[i] for i, n in per_document.items())
    assert all(abs(taken[s] - t) <= 16 for s, t in plain_targets(sizes).items())


def test_sequences_hold_all_that_the_mix_took(steps):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in steps[3].collect():
        want[r.doc_id] += len(plain.encode(r.text, add_special_tokens=False).ids) + 1
    got, places = Counter(), {}
    for r in steps[4].collect():
        got[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.03 * -(-sum(want.values()) // 2048) + 1


def test_run_equals_its_stages(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[-1])


def test_odd_rows_and_nothing_pass_every_stage(spark, odd, nothing):
    for docs in (odd, nothing):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() >= 0


def test_columns_named_as_the_prediction_pass_every_stage(spark, odd, nothing):
    for docs in (odd, nothing):
        columns = docs.dtypes
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert docs.dtypes == columns or name == "pack_sequences"


def test_near_duplicates_link_by_fingerprint_or_by_shingles(spark):
    """Fingerprints within three bits link texts whose five-word shingles are mostly different, and both kinds of links chain."""
    line = " ".join(f"r{k}" for k in range(11))
    own = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    repeated = {k: f"{line} " * 80 + own(f"t{k}_", 16) for k in (1, 2, 3)}
    words = own("w", 200).split()
    close = ["other" if k in (50, 100, 150) else w for k, w in enumerate(words)]
    texts = {**repeated, 4: " ".join(words), 5: " ".join(close), 6: own("z", 200), 7: None, 8: "  "}
    # a near copy by shingles, not by fingerprint, of a text that only its fingerprint links to the others
    texts[9] = f"{line} " * 3 + own("t3_", 16)
    prints = {k: simhash.fingerprint(t) for k, t in texts.items()}
    sets = {k: plain_set(t) for k, t in texts.items()}
    bits = lambda a, b: ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count()
    assert bits(1, 3) <= 3 and not similar(sets[1], sets[3])
    assert bits(4, 5) > 3 and similar(sets[4], sets[5])
    assert all(bits(9, k) > 3 for k in (1, 2, 3)) and similar(sets[9], sets[3]) and not similar(sets[9], sets[1])
    docs = spark.createDataFrame([*texts.items(), (None, texts[6]), (6, texts[6])], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7]
