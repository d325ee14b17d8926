"""Language identification by compression.

For each language a zstandard dictionary of raw text is taken from labelled documents. A text, in lower case and
with all but letters as spaces, is encoded whole, piece by piece, with every dictionary; the language whose dictionary gives the fewest bytes is the answer. The score is the margin
to the second, as a share of its bytes; a narrow margin, or no letter at all, is a rejection.

Learning reads a sample of bounded size: ``SAMPLE`` documents of at most ``LONGEST`` characters for each language, those with
the smallest hash. Rows without text or language are not learned from, nor are held-out ones. Predicting reads the text alone. A null text, or
one without letters, is ``und`` with score 0, and so is every text if there is nothing to learn from. Equal sizes go to
the language first in order. Rows with null or repeated ids each get their row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import free_names, ready, text_slices

SAMPLE = 400
LONGEST = 20_000
DICTIONARY = 128 << 10
#: Bytes of text encoded at a time; a new piece knows the dictionary only.
PIECE = 512
LEVEL = 9
UNKNOWN = "und"
#: Margins below this are rejected.
NARROW = 0.001

_NO_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower())


def held_out(doc_id: Column) -> Column:
    """Documents kept for testing; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, size: int = DICTIONARY) -> dict[str, bytes]:
    """The dictionary of each language: whole texts of the sample, as many as fit."""
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= longest))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # twice the wanted share of each language passes; of those the smallest hashes are taken
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    passing = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 2.0 * sample / n)])[F.col("lang")]
    some = known.select("lang", "text", place.alias("place")).filter(F.col("place") < passing)
    rows = some.orderBy("place", "lang", "text").limit(3 * sample * len(counts)).collect()
    texts: dict[str, dict[str, None]] = {}
    for r in rows:
        texts.setdefault(r["lang"], {})[folded(r["text"])] = None
    found = {}
    for lang, own in sorted(texts.items()):
        data = b""
        for text in list(own)[:sample]:
            if len(data) + len(text.encode()) <= size or not data:
                data += text.encode() + b"\n"
        found[lang] = data
    return found


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], piece: int = PIECE, level: int = LEVEL):
        self.names, self.piece, self.coders = sorted(dictionaries), piece, []
        for name in self.names:
            held = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = folded(text).encode()
        pieces = [data[a : a + self.piece] for a in range(0, len(data), self.piece)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.coders]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        ordered = sorted(zip(self.sizes(text), self.names))
        if len(ordered) == 1:
            return ordered[0][1], 1.0
        return ordered[0][1], 1 - ordered[0][0] / ordered[1][0]


def _predicted(dictionaries: dict[str, bytes], added: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            for some in text_slices(batch, "text"):
                found = [classifier.predict(t.as_py()) for t in some.column("text")]
                columns = [some.column(k) for k in range(some.num_columns)]
                columns += [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*some.schema.names, *added])

    return rows


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str]) -> DataFrame:
    """The columns named in ``keep`` (``text`` must be one), lang_pred and score, of every document; no shuffle.

    Where ``keep`` has one of these two names, the added column's name gets an underscore more.
    """
    ready(docs.sparkSession)
    kinds = dict(docs.dtypes)
    language, score = free_names(["lang_pred", "score"], keep)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", {language} string, {score} double"
    return docs.select(*keep).mapInArrow(_predicted(dictionaries, [language, score]), schema)


def accepted(found: DataFrame, narrow: float = NARROW) -> DataFrame:
    """Of what ``identify`` gives, the rows whose language is known and whose margin, in the last two columns, is wide enough."""
    language, score = found.columns[-2:]
    return found.filter((F.col(language) != UNKNOWN) & (F.col(score) >= narrow))
