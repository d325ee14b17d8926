"""Periodic runs in texts by recursive frequency splitting, and texts without their repeats.

A run is a stretch of consecutive words that has a smallest period q (words q apart are identical), is at least ``max(least, times * q)`` words long
and is not extended by a neighbouring word. All words of a run occur at least ``times`` times in it. So a word that occurs more rarely in a
segment is in no run there and splits it; the parts are counted anew, until every word of a segment occurs often enough. Segments shorter than
``least`` are given up. Almost all of an ordinary text falls away here.

What is left is scanned by lags. For lag q the segment is cut at the multiples of q: a run of period q covers two whole neighbouring blocks, as it is
three blocks long, and these are equal. Sums over powers of an odd number tell equal blocks in one step each, so the lags of a segment of s words
cost s log s in all; from each equal pair the stretch is followed word by word to both sides, which settles it exactly. Lags are taken in ascending
order, and a pair inside a run that is known already has that run's period, so each run is followed once and found with its smallest period.

The work is one pass over the documents without a shuffle; a document is looked at whole.

Null and empty texts have no words and no run. Equal rows give equal rows, doc_ids may be null. Other columns are kept; an added column whose name
is taken gets underscores until its name is free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillwright.llm.common import free_names, ready, text_slices

LEAST = 24
TIMES = 3
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: An odd number whose powers weigh the words of a block, and one that spreads the words' numbers.
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

Run = tuple[int, int, int]


def split(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Bounds of the segments in which every word occurs ``times`` times or more, ascending."""
    open_, stable = [(0, len(codes))], []
    while open_:
        a, b = open_.pop()
        if b - a < least:
            continue
        _, place, counts = np.unique(codes[a:b], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[place] < times)
        if not len(rare):
            stable.append((a, b))
            continue
        starts = a + np.concatenate([[0], rare + 1])
        ends = a + np.concatenate([rare, [b - a]])
        long = ends - starts >= least
        open_ += zip(starts[long].tolist(), ends[long].tolist())
    return sorted(stable)


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """How many first numbers agree, read in growing steps."""
    n, at, step = min(len(one), len(other)), 0, 64
    while at < n:
        end = min(n, at + step)
        differ = np.flatnonzero(one[at:end] != other[at:end])
        if len(differ):
            return at + int(differ[0])
        at, step = end, 2 * step
    return n


def scan(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """(start, length, period) of every run of a segment."""
    n, found = len(codes), []
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _SPREAD * powers[:-1])])
    known = np.zeros(n, np.int64)  # for every word, the furthest end of the known runs that hold it
    for q in range(1, n // times + 1):
        blocks = np.diff(sums[::q])
        for k in np.flatnonzero(blocks[:-1] * powers[q] == blocks[1:]).tolist():
            at = k * q
            if known[at] >= at + 2 * q:
                continue
            end = at + q + _agreeing(codes[at:], codes[at + q :])
            start = at - _agreeing(codes[:at][::-1], codes[: at + q][::-1])
            if end - start >= max(least, times * q):
                found.append((start, end - start, q))
                np.maximum(known[start:end], end, out=known[start:end])
    return found


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs of a sequence of words, by start, then period."""
    if len(words) < least:
        return []
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return sorted((a + s, n, q) for a, b in split(codes, least, times) for s, n, q in scan(codes[a:b], least, times))


def first_periods(n_words: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    kept = np.ones(n_words, bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return kept


def _found(text: str, least: int, times: int, collapse: bool, as_is: bool) -> tuple[int, list[Run], str | None]:
    words = text.encode().split()
    runs = runs_of(words, least, times)
    if not collapse:
        return len(words), runs, None
    if not runs and as_is:
        return len(words), runs, text
    kept = first_periods(len(words), runs).tolist()
    return len(words), runs, b" ".join([w for w, k in zip(words, kept) if k]).decode()


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES, names: tuple[str, str, str] = ("n_words", "runs", "collapsed")
) -> DataFrame:
    """``docs`` with three more columns, named by ``names``: number of words, all runs by start and period, and the words that stay, joined by one space."""
    if times < 3:
        raise ValueError("a run must hold its period three times at least")
    names = free_names(list(names), docs.columns)
    ready(docs.sparkSession)
    more = StructType.fromDDL(f"{names[0]} bigint, {names[1]} {RUNS}, {names[2]} string")
    place = docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([c.cast(pa.string()) if k == place else c for k, c in enumerate(batch.columns)], batch.schema.names)
            for some in text_slices(batch, batch.schema.names[place]):
                found = [_found(t.as_py() or "", least, times, True, False) for t in some.column(place)]
                runs = [[dict(zip(("start", "length", "period"), r)) for r in f[1]] for f in found]
                columns = [pa.array([f[0] for f in found], pa.int64()), pa.array(runs, _RUNS), pa.array([f[2] for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays([*some.columns, *columns], [*some.schema.names, *names])

    texts = docs.withColumn(text, F.col(text).cast("string"))
    fields = [StructField(f.name, f.dataType, True) for f in texts.schema]
    return texts.mapInArrow(rows, StructType([*fields, *more]))


def collapsed(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with every run cut to its first period; a text without a run stays as it is, white space included."""
    ready(docs.sparkSession)
    texts = docs.withColumn(text, F.col(text).cast("string"))
    place = docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in text_slices(batch, batch.schema.names[place]):
                cut = [None if t.as_py() is None else _found(t.as_py(), least, times, True, True)[2] for t in some.column(place)]
                yield some.set_column(place, batch.schema.names[place], pa.array(cut, some.column(place).type))

    return texts.mapInArrow(rows, texts.schema)
