"""From raw documents to packed training sequences, one operator per stage, each stage written before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import langid, mixing, near_copies, packing, simhash
from tillwright.llm.common import shared_path, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    # other columns go by their places, so none is taken for the prediction
    inner = ["text" if c == "text" else f"column{k}" for k, c in enumerate(docs.columns)]
    found = langid.identify(docs.toDF(*inner), langid.learn(docs), inner)
    return langid.accepted(found).select(*inner).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints at most three bits apart link, or five-word shingles of which two texts share 0.8.

    Fingerprints alone miss most near copies that differ in more than a few words; the shingles bring these in.
    """
    return simhash.one_of_each(docs, simhash.joined(simhash.near_duplicates(docs), near_copies.near_copies(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; of a document taken in part, the words taken."""
    return mixing.mixed(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences. The workers also hold the language stage's coders."""
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, kept_bytes=32 << 20)
    return packing.pack(pieces)


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Language models, fingerprints and packing have no SQL form; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
