"""How quality filters interact under every order, counted by a stream that takes back what later files correct.

The files of a table are processed as available-now micro-batches. Of each row a mask says which filters it fails. All filters but one look at the
row's text alone; the last one fails rows whose text a row with a smaller id holds too, anywhere in the table. The state of a stateful operator keeps
for every text the smallest id seen so far and the rows that have it. When a smaller id arrives, the earlier rows' masks are taken back from the
counters of their parts and counted again as failing. Each micro-batch leaves its changes to the counters in a folder of its own, which
it overwrites if it is run again; their sum is exact whatever the order of files.

The counters (part, mask, quality, toxicity) hold all that is asked: a filter at some place of some order removes the rows that fail it and none
of those before it. So the table is read once for all orders together.

Texts are told apart by their SHA-256. Their state is kept in groups of about ``TEXTS_IN_GROUP`` texts, as a call for each text would cost more
than its work; the number of groups follows the number of rows. Rows of one text are folded in each task before they are sent, so a text that a
third of all rows hold arrives as one row from each task. State lives in RocksDB, with its log in the shared folder.

Null texts count as empty, null parts as the empty string. A null doc_id never is a smaller id and never fails the last filter. Rows with the same doc_id
and text do not fail it for each other's sake. Of several labels of a doc_id the highest counts; labels without an id match nothing. Other columns
play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import WORD, ready, shared_path
from tillwright.session import setting

BATCHES = 4
TEXTS_IN_GROUP = 256
#: Folded rows that a task holds before it sends them on.
FOLDED = 1 << 17
#: State on the executors' disks, of which each micro-batch logs its changes only; many small stores, so no space is allocated ahead.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SEEN = "bucket long, digest string, part string, mask int, good int, toxic int, known boolean, low long, at_low long, n long"
CHANGE = "part string, mask int, good int, toxic int, n long"


def text_filters(text: Column) -> dict[str, Column]:
    """Filters of a text by letter; true where it fails. The text must not be null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one text, part and label as one: smallest id, how many have it, how many there are."""
    held: dict[tuple, list] = {}

    def sent() -> pa.RecordBatch:
        # an id that is null is sent as 0, since nulls would turn the column into floating numbers on the way
        rows = [(*key, value[0] or 0, *value[1:]) for key, value in held.items()]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        names = [f.split()[0] for f in SEEN.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for *key, doc_id in zip(*(c.to_pylist() for c in batch.columns)):
            key = (*key, doc_id is not None)
            one = held.get(key)
            if one is None:
                held[key] = [doc_id, 1, 1]
                continue
            one[2] += 1
            if doc_id == one[0]:
                one[1] += 1
            elif doc_id < one[0]:  # never with null ids, which are equal
                one[:2] = doc_id, 1
        if len(held) >= FOLDED:
            yield sent()
            held.clear()
    if held:
        yield sent()


def _updater(repeats: int):
    """The stateful step of a group of texts. ``repeats``: the mask's bit for the filter of repeated texts."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        texts = json.loads(state.get[0]) if state.exists else {}
        arrived, change = defaultdict(list), defaultdict(int)
        for frame in frames:
            for digest, part, mask, good, toxic, known, low, at_low, n in zip(*(frame[c].tolist() for c in list(frame.columns)[1:])):
                if known:
                    arrived[digest].append((part, mask, good, toxic, low, at_low, n))
                else:
                    change[part, mask, good, toxic] += n
        for digest, rows in arrived.items():
            least = min(row[4] for row in rows)
            before, holders = texts.get(digest, (least, []))
            if least < before:
                for part, mask, good, toxic, n in holders:
                    change[part, mask, good, toxic] -= n
                    change[part, mask | repeats, good, toxic] += n
                holders = []
            least = min(least, before)
            now = defaultdict(int, {tuple(h[:4]): h[4] for h in holders})
            for part, mask, good, toxic, low, at_low, n in rows:
                first = at_low if low == least else 0
                if first:
                    now[part, mask, good, toxic] += first
                    change[part, mask, good, toxic] += first
                change[part, mask | repeats, good, toxic] += n - first
            texts[digest] = (least, [(*k, n) for k, n in now.items()])
        state.update((json.dumps(texts, separators=(",", ":")),))
        rows = [(*k, n) for k, n in change.items() if n]
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"]).astype({"mask": "int32", "good": "int32", "toxic": "int32", "n": "int64"})

    return update


def new_log(spark: SparkSession, path: str) -> str:
    """A folder for the state and the changes of the table under ``path``, with the number of groups that its rows call for."""
    log = shared_path(spark, "filter-audit")
    groups = max(1, -(-spark.read.parquet(path).count() // TEXTS_IN_GROUP))
    spark.createDataFrame([(groups,)], "groups long").write.parquet(f"{log}/groups")
    spark.createDataFrame([], CHANGE).write.parquet(f"{log}/changes/batch_id=-1")
    return log


def add_files(spark: SparkSession, path: str, labels: DataFrame, log: str, part: str = "lang", batches: int = BATCHES, checks=text_filters) -> None:
    """Count the Parquet files under ``path`` (doc_id, text, the ``part`` column) that ``log`` has not met yet, in about so many micro-batches.

    Bit k of a mask is the k-th of ``checks``; the next one is the filter of repeated texts.
    """
    ready(spark)
    table = spark.read.parquet(path)
    groups = spark.read.parquet(f"{log}/groups").first()["groups"]
    per_batch = max(1, -(-len(table.inputFiles()) // batches))
    # as a pattern, the path may be a single file as well as a folder
    folder, name = path.rstrip("/").rsplit("/", 1)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/{{{name}}}")
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stream = stream.select(F.col("doc_id").cast("long").alias("doc_id"), plain(part).alias("part"), plain("text").alias("text"))
    fails = checks(F.col("text"))
    mask = sum((F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails.values())), F.lit(0)).cast("int")
    masked = stream.select("doc_id", "part", mask.alias("mask"), F.sha2("text", 256).alias("digest"))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled"))
    known = known.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    group = F.pmod(F.xxhash64("digest"), F.lit(groups)).alias("bucket")
    label = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    rows = masked.join(known, F.col("doc_id") == F.col("labelled"), "left")
    rows = rows.select(group, "digest", "part", "mask", label("good"), label("toxic"), "doc_id").mapInArrow(_folded, SEEN)
    changes = rows.groupBy("bucket").applyInPandasWithState(_updater(1 << len(fails)), CHANGE, "texts string", "update", "NoTimeout")

    def write(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{log}/changes/batch_id={batch_id}")

    writer = changes.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{log}/checkpoint")
    with ExitStack() as held:
        for key, value in STORE.items():
            held.enter_context(setting(spark, key, value))
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def counters(spark: SparkSession, log: str) -> DataFrame:
    """part, mask, n, good, toxic: how many rows fail just the filters of the mask, and how many of them are good or toxic."""
    changes = spark.read.schema(CHANGE).parquet(f"{log}/changes")
    sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    return changes.groupBy("part", "mask").agg(*sums)


def interactions(counted: DataFrame, letters: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    n, whole = len(letters), (1 << len(letters)) - 1
    orders = []
    for order in permutations(range(n)):
        gone = 0
        for step, k in enumerate(order):
            orders.append(("".join(letters[j] for j in order), step + 1, k, gone))
            gone |= 1 << k
    orders = counted.sparkSession.createDataFrame(orders, "filter_order string, step int, filter int, gone int")
    before = [[F.struct(F.lit(k).alias("filter"), F.lit(gone).alias("gone")) for gone in range(whole + 1) if not gone >> k & 1] for k in range(n)]
    cells = counted.select("*", F.explode(F.array(*[x for some in before for x in some])).alias("cell")).select("part", "mask", "n", "good", "toxic", "cell.*")
    own = F.expr("shiftleft(1, filter)")
    fails, earlier = F.col("mask").bitwiseAND(own) != 0, F.col("mask").bitwiseAND(F.col("gone")) != 0
    # of all orders, those in which the filter comes before the others that a row fails
    factorial = len(list(permutations(range(n))))
    first = F.when(fails, F.col("n") * F.expr(f"{factorial} div bit_count(mask)")).otherwise(0)
    total = lambda of, when, name: F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long").alias(name)
    cells = cells.groupBy("part", "filter", "gone").agg(
        total("n", ~fails & ~earlier, "kept"),
        total("n", fails & ~earlier, "removed"),
        total("n", fails & earlier, "redundant"),
        total("n", F.col("mask") == own, "unique_fails"),
        total("good", fails & ~earlier, "good_lost"),
        total("toxic", fails & ~earlier, "toxic_lost"),
        F.sum(first).cast("long").alias("shapley"),
    )
    return cells.join(F.broadcast(orders), ["filter", "gone"]).drop("filter", "gone")
