"""Masked pseudo-likelihood of documents under a bidirectional window network.

Words (ASCII case ignored) are hashed to ``WORDS`` numbers. The ``OWN`` most frequent of them over all documents are classes of their own; the others
fall into ``SHARED`` classes by their number. A word's probability given both its sides is that of its class, from the network, times its
share of the class's count in the corpus. The network adds embeddings of the classes ``REACH`` places to each side (each
place has its own), takes the hyperbolic tangent and predicts the class by a softmax. A document's score
is the sum of the logarithms over all its words, each predicted with itself masked.

Training meets every word of every document as a target, in one of the rounds: each task starts from the same network, learns in round ``turn`` of
``rounds`` from the words at the places ``turn``, ``turn + rounds`` and so on of each of its documents, however few there are, and gives back its network
weighted by its windows; the mean is the next round's start. Counts and weights
are summed as whole numbers, so the order of tasks makes no difference. The network and the counts have a fixed size.

Null and empty texts have no words and score 0. Equal rows give equal rows; ids may be null; other columns play no part. In an empty table nothing
is learned and nothing returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import text_slices

WORDS = 1 << 15
OWN, SHARED = 128, 64
CLASSES = OWN + SHARED
REACH, WIDTH = 2, 32
PLACES = 2 * REACH
ROUNDS = 2
BATCH = 1024
RATE = 0.01
#: Weights are summed as whole multiples of 2^-20.
FIXED = 1 << 20
_SHAPES = [(PLACES * (CLASSES + 1), WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,)]
_ENDS = np.cumsum([int(np.prod(s)) for s in _SHAPES])
#: Bytes of text that are numbered together, and of a word that is numbered with others.
SLICE_BYTES = 1 << 20
SHORT = 64
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\r\x0b\x0c" else c for c in range(256))
# a CRC is the exclusive or of one term for each byte and its distance to the word's end, and one for the word's length
_TERMS = np.array([[crc32(bytes([b]) + bytes(d)) ^ crc32(bytes(d + 1)) for b in range(256)] for d in range(SHORT)]) & (WORDS - 1)
_TERMS[:, 32] = 0
_TERMS = _TERMS.astype(np.uint16).ravel()
_CELLS = np.arange((CLASSES + 1) * WIDTH).reshape(-1, WIDTH)
_LENGTHS = np.array([crc32(bytes(n)) & (WORDS - 1) for n in range(SHORT + 1)], np.uint16)


def numbers(text: str | None) -> np.ndarray:
    """The number of every word of a text."""
    return _numbered([(text or "").encode()])[0]


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of every word of the texts, and each text's count of words."""
    data = (b" " + b" ".join(texts) + b" ").translate(_PLAIN)
    raw = np.frombuffer(data, np.uint8)
    space = raw == 32
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    after = 1 + np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    n = np.diff(np.searchsorted(starts, after), prepend=0)
    lengths = ends - starts
    found = _LENGTHS.take(lengths, mode="clip").astype(np.int64)
    # words are taken by where they end, so that a long text needs no more memory here than a short one
    cuts = np.searchsorted(ends, np.arange(0, len(raw) + 2 * SLICE_BYTES, 2 * SLICE_BYTES))
    for j, k in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if j < k:
            stop = ends[j:k]
            begin = max(int(ends[j - 1]) if j else 0, int(stop[0]) - SHORT - 1)
            left = np.repeat(stop, np.diff(stop, prepend=begin))
            left -= np.arange(begin + 1, begin + 1 + len(left))
            np.minimum(left, SHORT - 1, out=left)
            left <<= 8
            left |= raw[begin : begin + len(left)]
            terms = np.bitwise_xor.accumulate(_TERMS.take(left, mode="clip"))
            found[j:k] ^= terms[stop - 1 - begin] ^ terms[np.maximum(starts[j:k] - 1 - begin, 0)]
    for k in np.flatnonzero(lengths > SHORT).tolist():
        found[k] = crc32(data[starts[k] : ends[k]]) & (WORDS - 1)
    return found, n


def _encoded(texts: pa.Array) -> list[bytes]:
    """Nulls count as empty."""
    return [(t or "").encode() for t in texts.to_pylist()]


class Vocabulary:
    def __init__(self, counts: np.ndarray):
        """counts of each number over the corpus."""
        order = np.lexsort((np.arange(WORDS), -counts))
        self.of = (OWN + np.arange(WORDS) % SHARED).astype(np.int64)
        self.of[order[:OWN]] = np.arange(OWN)
        smooth = counts + 1.0
        classes = np.bincount(self.of, smooth, CLASSES)
        self.log_share = np.log(smooth) - np.log(classes)[self.of]
        self.log_class = np.log(classes / classes.sum())


class Network:
    def __init__(self, weights: np.ndarray):
        self.weights = weights.astype(np.float32)
        self.embedding, self.bias, self.out, self.out_bias = (
            p.reshape(s) for p, s in zip(np.split(self.weights, _ENDS[:-1]), _SHAPES)
        )
        self._last = self.weights[_ENDS[1] :].reshape(WIDTH + 1, CLASSES)
        self._room(BATCH)

    def _room(self, n: int) -> None:
        """Memory for n windows, used again by every batch; new pages for each take longer than the sums in them."""
        self._h, self._one, self._z = (np.empty((n, k), np.float32) for k in (WIDTH, WIDTH, CLASSES))
        # a column of ones takes the bias into the product
        self._wide = np.ones((n, WIDTH + 1), np.float32)
        self._at, self._dh, self._rows = np.empty((n, WIDTH), np.int64), np.empty((n, WIDTH)), np.arange(n)

    @staticmethod
    def start(vocabulary: Vocabulary, seed: int = 5) -> Network:
        """Random, but for the classes' own frequencies."""
        weights = np.random.default_rng(seed).normal(0, 0.1, _ENDS[-1])
        weights[_ENDS[2] :] = vocabulary.log_class
        return Network(weights)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        n = len(around)
        if n > len(self._h):
            self._room(n)
        h, one = self._h[:n], self._one[:n]
        # clipping changes no row and, unlike the check, needs no copy
        np.add(self.bias, self.embedding.take(around[:, 0], axis=0, out=one, mode="clip"), out=h)
        for p in range(1, PLACES):
            h += self.embedding.take(around[:, p], axis=0, out=one, mode="clip")
        return np.tanh(h, out=h)

    def _logits(self, h: np.ndarray) -> np.ndarray:
        """Less the greatest of each row."""
        wide = self._wide[: len(h)]
        wide[:, :WIDTH] = h
        z = np.matmul(wide, self._last, out=self._z[: len(h)])
        z -= z[self._rows[: len(z)], z.argmax(axis=1)][:, None]
        return z

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        z = self._logits(self.hidden(around))
        own = z[self._rows[: len(z)], target]
        return own.astype(np.float64) - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))

    def gradient(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability."""
        h = self.hidden(around)
        z = self._logits(h)
        np.exp(z, out=z)
        z *= 1 / (len(z) * z.sum(axis=1, keepdims=True))
        z[self._rows[: len(z)], target] -= 1 / len(z)
        dh = (z @ self.out.T) * (1 - h**2)
        g = np.empty_like(self.weights)
        de, db, dw, dc = np.split(g, _ENDS[:-1])
        de = de.reshape(PLACES, -1)
        at, exact = self._at[: len(h)], self._dh[: len(h)]
        exact[:] = dh
        for p in range(PLACES):
            # the cells of each row, from a table
            _CELLS.take(around[:, p] - p * (CLASSES + 1), axis=0, out=at, mode="clip")
            de[p] = np.bincount(at.ravel(), exact.ravel(), (CLASSES + 1) * WIDTH)
        dh.sum(0, out=db)
        dw.reshape(WIDTH, CLASSES)[:] = (z.T @ h).T
        z.sum(0, out=dc)
        return g


def windows(classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of the embedding around the given words; beyond the ends is a class of its own."""
    return _windows(_padded(classes), at)


def _padded(classes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.full(REACH, CLASSES), classes, np.full(REACH, CLASSES)])


def _windows(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    steps = [s for s in range(2 * REACH + 1) if s != REACH]
    return np.stack([padded[at + s] + p * (CLASSES + 1) for p, s in enumerate(steps)]).T


def _in_one_row(vocabulary: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words' numbers, each text's count of them, their places in a row of all classes, and that row, padded.

    Texts stand in the row with gaps at least as wide as a window reaches.
    """
    words, n = _numbered(_encoded(texts))
    starts = np.cumsum(n + REACH) - n
    row = np.full(int(starts[-1] + n[-1] + REACH), CLASSES)
    at = np.arange(len(words)) + np.repeat(starts - (np.cumsum(n) - n), n)
    row[at] = vocabulary.of[words]
    return words, n, at, _padded(row)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(WORDS, np.int64)
    for batch in batches:
        for some in text_slices(batch, "text", SLICE_BYTES):
            counts += np.bincount(_numbered(_encoded(some.column("text")))[0], minlength=WORDS)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["number", "n"])


def count(texts: DataFrame) -> np.ndarray:
    rows = texts.mapInArrow(_counted, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(WORDS)
    for r in rows:
        counts[r["number"]] = r["n"]
    return counts


def _trained(network: np.ndarray, vocabulary: Vocabulary, turn: int, rounds: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Network(network.copy()), 0
        first, second, one, two = np.zeros((4, _ENDS[-1]), np.float32)
        step = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def learn() -> None:
            nonlocal step, seen, held, size
            around, target = held[0] if len(held) == 1 else (np.concatenate(x) for x in zip(*held))
            g, step = model.gradient(around, target), step + 1
            np.subtract(g, first, out=one)
            np.multiply(one, 0.1, out=one)
            np.add(first, one, out=first)
            np.multiply(g, g, out=two)
            np.subtract(two, second, out=two)
            np.multiply(two, 0.001, out=two)
            np.add(second, two, out=second)
            np.divide(first, 1 - 0.9**step, out=one)
            np.multiply(one, RATE / (1 + step / 500), out=one)
            np.divide(second, 1 - 0.999**step, out=two)
            np.sqrt(two, out=two)
            np.add(two, 1e-8, out=two)
            np.divide(one, two, out=one)
            model.weights -= one
            seen, held, size = seen + size, [], 0

        for batch in batches:
            for some in text_slices(batch, "text", SLICE_BYTES):
                _, n, at, padded = _in_one_row(vocabulary, some.column("text"))
                place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                at = at[place % rounds == turn]
                while len(at):
                    part, at = at[: BATCH - size], at[BATCH - size :]
                    held.append((_windows(padded, part), padded[part + REACH]))
                    size += len(part)
                    if size >= BATCH:
                        learn()
        if held:
            learn()
        if seen:
            whole = np.rint(model.weights.astype(np.float64) * FIXED).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole), dtype=np.int32)), pa.array(whole), pa.array(np.full(len(whole), seen))], ["k", "weight", "seen"])

    return rows


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    weights = Network.start(vocabulary).weights
    for turn in range(rounds):
        given = texts.mapInArrow(_trained(weights, vocabulary, turn, rounds), "k int, weight long, seen long")
        exact = (F.col("weight").cast("decimal(20,0)") * F.col("seen").cast("decimal(12,0)")).cast("decimal(32,0)")
        sums = given.groupBy("k").agg(F.sum(exact).alias("weight"), F.sum("seen").alias("seen"))
        means = sums.select("k", (F.col("weight").cast("double") / F.col("seen")).alias("mean")).collect()
        if means:
            weights = np.zeros(_ENDS[-1], np.float32)
            for r in means:
                weights[r["k"]] = r["mean"] / FIXED
    return weights


def _scored(network: np.ndarray, vocabulary: Vocabulary):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(network)
        for batch in batches:
            for some in text_slices(batch, "text", SLICE_BYTES):
                words, n, at, padded = _in_one_row(vocabulary, some.column("text"))
                logs = vocabulary.log_share[words]
                for a in range(0, len(at), BATCH):
                    part = at[a : a + BATCH]
                    logs[a : a + BATCH] += model.log_probability(_windows(padded, part), padded[part + REACH])
                ends = np.cumsum(n)
                total = [float(logs[b - k : b].sum()) for b, k in zip(ends.tolist(), n.tolist())]
                columns = [some.column("doc_id"), pa.array(n), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "log_likelihood"])

    return rows


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, log_likelihood, per_word (null without words) of every document, under a network trained on all of them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.select("text")
    vocabulary = Vocabulary(count(texts))
    weights = train(texts, vocabulary, rounds)
    scored = rows.mapInArrow(_scored(weights, vocabulary), "doc_id long, n_words long, log_likelihood double")
    return scored.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
