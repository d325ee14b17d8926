import math
import random

import numpy as np
import pytest

from tillwright.llm import masked_lm as lm
from tillwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_score(text, weights, vocabulary):
    """The definition, word by word, with plain loops."""
    e, b, w, c = (p.reshape(s) for p, s in zip(np.split(weights.astype(float), lm._ENDS[:-1]), lm._SHAPES))
    numbers = lm.numbers(text)
    classes = [int(vocabulary.of[n]) for n in numbers]
    total = 0.0
    for k, n in enumerate(numbers):
        h = b.copy()
        for p, step in enumerate((-2, -1, 1, 2)):
            other = classes[k + step] if 0 <= k + step < len(classes) else lm.CLASSES
            h = h + e[other + p * (lm.CLASSES + 1)]
        z = np.tanh(h) @ w + c
        total += z[classes[k]] - math.log(np.exp(z).sum()) + vocabulary.log_share[n]
    return total


def test_scores_are_the_summed_conditionals(spark, odd):
    rows = odd.filter("doc_id is null or doc_id <> 6")
    texts = rows.select("text")
    vocabulary = lm.Vocabulary(lm.count(texts))
    weights = lm.train(texts, vocabulary)
    got = {r.doc_id: r for r in lm.score(rows).collect()}
    for r in rows.collect():
        assert got[r.doc_id].log_likelihood == pytest.approx(plain_score(r.text, weights, vocabulary), rel=1e-4, abs=1e-9)
        assert got[r.doc_id].n_words == len((r.text or "").split(None))or r.doc_id == 8
    assert got[2].log_likelihood == got[3].log_likelihood == 0 and got[4].per_word is None


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    model = lm.Network(rng.normal(0, 0.3, lm._ENDS[-1]))
    classes = rng.integers(0, lm.CLASSES, 30)
    around, target = lm.windows(classes, np.arange(30)), classes
    g = model.gradient(around, target)
    for k in (int(around[3, 1]) * lm.WIDTH + 4, lm._ENDS[0] + 7, lm._ENDS[1] + 99, lm._ENDS[2] + int(target[0])):
        moved = []
        for step in (1e-2, -1e-2):
            other = lm.Network(model.weights.copy())
            other.weights[k] += step
            moved.append(-other.log_probability(around, target).mean())
        assert (moved[0] - moved[1]) / 2e-2 == pytest.approx(g[k], rel=0.05, abs=2e-4)


def test_order_matters_after_training(spark):
    rng = random.Random(1)
    pattern = "one two three four five six seven eight".split()
    rows = [(k, " ".join(pattern[(k + j) % 8] for j in range(400))) for k in range(60)]
    mixed = [(100 + k, " ".join(rng.sample(t.split(), 400))) for k, t in rows[:3]]
    docs = spark.createDataFrame(rows + mixed, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.per_word for r in lm.score(docs, rounds=4).collect()}
    assert max(got[100], got[101], got[102]) < min(got[k] for k in range(60)) - 0.5


def test_query_covers_every_document_and_repeats(spark, nothing):
    rows = QUERIES["op8_masked_lm"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sorted(rows) == sorted(QUERIES["op8_masked_lm"](spark, SF).collect())
    assert lm.score(nothing).count() == 0


def test_every_word_is_a_target_in_documents_of_one_to_ten_words_and_small_tasks(spark):
    rng = random.Random(4)
    docs = [" ".join(rng.choices("abcdefgh", k=k % 10 + 1)) for k in range(60)]
    texts = spark.createDataFrame([(t,) for t in docs], "text string").repartition(20)
    vocabulary = lm.Vocabulary(lm.count(texts))
    start = lm.Network.start(vocabulary).weights
    seen = 0
    for turn in range(2):
        given = texts.mapInArrow(lm._trained(start, vocabulary, turn, 2), "k int, weight long, seen long")
        seen += sum(r.seen for r in given.filter("k = 0").collect())
    assert seen == sum(len(t.split()) for t in docs)
    moved = lm.train(texts, vocabulary) != start
    ends = moved[: lm._ENDS[0]].reshape(lm.PLACES, lm.CLASSES + 1, lm.WIDTH)[:, lm.CLASSES]
    assert ends.all()


def test_a_last_partial_batch_and_a_long_document_are_learned_from():
    import pyarrow as pa

    vocabulary = lm.Vocabulary(np.ones(lm.WORDS))
    start = lm.Network.start(vocabulary).weights
    for n in (1, 7, lm.BATCH, lm.BATCH + 1, 3 * lm.BATCH + 5):
        batch = pa.RecordBatch.from_arrays([pa.array(["w " * n])], ["text"])
        got = [next(lm._trained(start, vocabulary, turn, 2)(iter([batch])), None) for turn in range(2)]
        assert sum(g.column("seen")[0].as_py() for g in got if g) == n


def test_a_long_text_is_padded_once(monkeypatch):
    """Not once for each batch of its words, which copies a long text as often as it has batches."""
    import pyarrow as pa

    calls, padded = [], lm._padded
    monkeypatch.setattr(lm, "_padded", lambda classes: calls.append(len(classes)) or padded(classes))
    vocabulary = lm.Vocabulary(np.ones(lm.WORDS))
    weights = lm.Network.start(vocabulary).weights
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["w v " * 3 * lm.BATCH])], ["doc_id", "text"])
    list(lm._trained(weights, vocabulary, 0, 2)(iter([batch])))
    list(lm._scored(weights, vocabulary)(iter([batch])))
    assert len(calls) == 2


@pytest.mark.parametrize("slice_bytes", [1 << 20, 1, 5, 40, 100])
def test_words_of_many_texts_are_numbered_together_and_as_one_by_one(monkeypatch, slice_bytes):
    from zlib import crc32

    monkeypatch.setattr(lm, "SLICE_BYTES", slice_bytes)
    texts = ["", " ", "A bC\tde\r\nF\x0bg\x0ch", "\x1c\x1d \x1e\x1f\x00 \x85\u00a0x", "\u00c4\u00d6 \u65e5\u672c \u2003.", " a" * 9, "x" * 5000 + " y"]
    texts += [" ".join("Ab!z"[k % 4] * k for k in range(1, 140)), "end", " led by space"]
    got, n = lm._numbered([t.encode() for t in texts])
    want = [[crc32(w) & (lm.WORDS - 1) for w in t.encode().lower().split()] for t in texts]
    assert n.tolist() == [len(w) for w in want] and got.tolist() == [x for w in want for x in w]
    assert [lm.numbers(t).tolist() for t in texts] == want
    assert lm._numbered([])[0].size == 0 and lm.numbers(None).size == 0


def test_many_short_texts_are_laid_out_together(monkeypatch):
    """Not one by one in training, which takes as many small steps as there are texts."""
    import pyarrow as pa

    calls, padded = [], lm._padded
    monkeypatch.setattr(lm, "_padded", lambda classes: calls.append(len(classes)) or padded(classes))
    vocabulary = lm.Vocabulary(np.ones(lm.WORDS))
    weights = lm.Network.start(vocabulary).weights
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three", None, "", "four"] * 200)], ["text"])
    got = list(lm._trained(weights, vocabulary, 0, 2)(iter([batch])))
    assert got[0].column("seen")[0].as_py() == 600 and len(calls) == 1
