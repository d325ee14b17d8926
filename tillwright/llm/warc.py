"""WARC archives: written as records with equal payloads stored once, read back by verified chains of records.

Writing. A page is a record whose block is an HTTP header and the page's bytes. Of pages with equal payloads of ``LEAST`` bytes or more, that
with the smallest page_id is a response and the others revisit it without its bytes. (Rows that share that
smallest id are all responses; null ids revisit, unless all are null. Rows that share an id may have different payloads; a revisit names the
page and the payload's digest.) Null pages are empty. The files are uncompressed archives under ``path``.

Reading. A file is cut wherever a line begins with ``WARC/1.``, in splits of any size. Each such place may begin a record, or
be part of a payload. Tasks read the header there and emit where the record after it would begin. Starting from a file's first byte, pointers
are doubled until they pass the file's end, which marks the records that can be reached; all else is payload. A record in one piece is digested
where it was found; pieces of a record that holds the mark within its payload are gathered by a second
scan. Only numbers and digests are shuffled, payloads never but for those records. Records after a damaged one are not reached, and a file
that does not begin with a record has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import stored

LEAST = 100
DATE = "1970-01-01T00:00:00Z"
MARK = b"WARC/1."
#: What separates pieces: the mark at the start of a line. No byte of it repeats its first, so no match can hide in another.
CUT = "\n" + MARK.decode()
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PIECE = f"path string, block long, rel long, bytes long, head long, whole boolean, {RECORD}"

_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*(?=\r\n)", re.I)
_NAMES = (b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-payload-digest")
_FIELD = {name: re.compile(rb"\r\n" + name + rb":[ \t]*([^\r\n]*)", re.I) for name in _NAMES}
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write(pages: DataFrame, path: str, least: int = LEAST, date: str = DATE) -> None:
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "n": F.octet_length("html")})
    copies = rows.filter(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # only payloads that repeat; a stored table has a known size, so a small one is broadcast instead of shuffling the pages
    copies = stored(copies.filter("copies > 1").select(F.col("digest").alias("copied"), "first"), "copied-payloads")
    rows = rows.join(copies, F.col("digest") == F.col("copied"), "left")
    revisit = F.col("copied").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(F.col("first"))), _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
    )
    # the last byte of a record's end is the line feed that the text writer adds
    rows.select(F.concat(header, http, body, F.lit("\r\n\r")).alias("value")).write.option("lineSep", "\n").text(path)


def _head(data: bytes) -> tuple[int, int] | None:
    """Bytes of header (after the mark) and of block, if a record may begin here."""
    if data[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    end = data.find(b"\r\n\r\n")
    # a block that itself begins with the mark has its header's last byte in the cut
    head = data[: end + 2] if end >= 0 else data[:-1] if data.endswith(b"\r\n\r") else b""
    found = _LENGTH.search(head)
    return (len(head) + 2, int(found[1])) if found else None


def _fields(data: bytes, head: int, length: int) -> tuple:
    """What a record says: page_id, payload bytes and digest, type, page referred to. A revisit holds no payload; its header names the digest."""
    header, block = data[:head], data[head : head + length]
    kind, own, other, said = (m[1] if (m := _FIELD[k].search(header)) else b"" for k in _NAMES)
    page, refers = (int(m[1]) if (m := _PAGE.match(x)) else None for x in (own, other))
    body = block[block.find(b"\r\n\r\n") + 4 :] if block.startswith(b"HTTP/") else block
    if kind == b"revisit" and said:
        return page, len(body), said.decode("latin-1").removeprefix("sha256:"), "revisit", refers
    return page, len(body), sha256(body).hexdigest(), kind.decode("latin-1"), refers


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", CUT).text(path)
    return read.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes, int]]:
    """Each piece with its place in its split: path, block, rel (of what follows the mark), bytes, data, row of its batch."""
    split, at = None, 0
    for batch in batches:
        paths, blocks, values = (batch.column(c) for c in ("path", "block", "value"))
        for k in range(batch.num_rows):
            here = (paths[k].as_py(), blocks[k].as_py())
            if here != split:
                split, at = here, 0
            data = values[k].as_buffer().to_pybytes()
            skipped = len(MARK) if here[1] == 0 and at == 0 and data.startswith(MARK) else 0
            yield *here, at + skipped, len(data) + len(CUT), data[skipped:], int(at == 0 and here[1] == 0 and not skipped)
            at += len(data) + len(CUT)


def _frame(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_LONG, _TEXT = pa.int64(), pa.string()
_PIECES = pa.schema([("path", _TEXT), ("block", _LONG), ("rel", _LONG), ("bytes", _LONG), ("head", _LONG), ("whole", pa.bool_()), ("page_id", _LONG), ("payload_bytes", _LONG), ("payload_digest", _TEXT), ("record_type", _TEXT), ("refers_to", _LONG)])
_DATA = pa.schema([("path", _TEXT), ("block", _LONG), ("rel", _LONG), ("data", pa.binary())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece; head is the distance from rel to the next record, null where no record begins."""
    rows = []
    for path, block, rel, size, data, stray in _placed(batches):
        head = None if stray else _head(data)
        whole = head is not None and len(data) >= sum(head)
        fields = _fields(data, *head) if whole else (None,) * 5
        rows.append((path, block, rel, size, sum(head) + 4 if head else None, whole, *fields))
        if len(rows) >= 5000:
            yield _frame(rows, _PIECES)
            rows = []
    if rows:
        yield _frame(rows, _PIECES)


def _data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path, block, rel, _, data, _ in _placed(batches):
        yield _frame([(path, block, rel, data)], _DATA)


def _reached(candidates: DataFrame) -> DataFrame:
    """path, start of the records that the chain from each file's first byte reaches.

    Round k knows what fewer than 2^k steps reach, and where 2^k steps lead from any candidate.
    """
    starts = candidates.select(F.col("path").alias("p"), F.col("start").alias("s"))
    jump = candidates.join(starts, (F.col("path") == F.col("p")) & (F.col("succ") == F.col("s")), "left")
    jump = stored(jump.select("path", "start", F.col("s").alias("next"), (F.col("start") == 0).alias("reached")), "chain")
    while not jump.filter("reached AND next IS NOT NULL").isEmpty():
        far = jump.select(F.col("path").alias("p"), F.col("start").alias("s"), F.col("next").alias("beyond"))
        hit = jump.filter("reached AND next IS NOT NULL").select(F.col("path").alias("hp"), F.col("next").alias("hs")).distinct()
        moved = jump.join(far, (F.col("path") == F.col("p")) & (F.col("next") == F.col("s")), "left")
        moved = moved.join(hit, (F.col("path") == F.col("hp")) & (F.col("start") == F.col("hs")), "left")
        jump = stored(moved.select("path", "start", F.col("beyond").alias("next"), (F.col("reached") | F.col("hs").isNotNull()).alias("reached")), "chain")
    return jump.filter("reached").select("path", "start")


def _glued(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("start")
    data = CUT.encode().join(frame["data"])
    fields = _fields(data, *_head(data))
    return pd.DataFrame([fields], columns=[f.split()[0] for f in RECORD.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record as it stands in the archives."""
    pieces = stored(_lines(spark, path).mapInArrow(_scan, PIECE), "pieces")
    splits = pieces.groupBy("path", "block").agg(F.sum("bytes").alias("total"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("path").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = pieces.join(splits, (F.col("path") == F.col("p")) & (F.col("block") == F.col("b"))).drop("p", "b")
    placed = placed.withColumns({"start": F.col("base") + F.col("rel") - len(MARK), "succ": F.col("base") + F.col("rel") + F.col("head")})
    reached = _reached(placed.filter("head IS NOT NULL").select("path", "start", "succ")).select(F.col("path").alias("p"), F.col("start").alias("s"))
    marked = placed.join(reached, (F.col("path") == F.col("p")) & (F.col("start") == F.col("s")), "left")
    marked = stored(marked.withColumn("record", F.col("s").isNotNull()).drop("p", "s"), "marked")
    columns = [f.split()[0] for f in RECORD.split(", ")]
    single = marked.filter("record AND whole").select(*columns)
    # pieces of records that do not end within their first piece: that piece, and what follows up to the next record
    order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    parts = marked.filter("NOT record OR NOT whole").select("path", "block", "rel", "start", "record", "whole", "succ")
    parts = parts.withColumn("owner", F.last(F.when(F.col("record"), F.struct("start", "succ")), ignorenulls=True).over(order))
    parts = parts.filter("start < owner.succ").select(F.col("path").alias("p"), F.col("block").alias("b"), F.col("rel").alias("r"), "start", F.col("owner.start").alias("owner"))
    parts = stored(parts, "parts")
    data = _lines(spark, path).mapInArrow(_data, "path string, block long, rel long, data binary")
    data = data.join(parts, (F.col("path") == F.col("p")) & (F.col("block") == F.col("b")) & (F.col("rel") == F.col("r")))
    glued = data.groupBy("path", "owner").applyInPandas(_glued, RECORD)
    return single.unionByName(glued.select(*columns))


def resolved(found: DataFrame) -> DataFrame:
    """Revisits take the size of the full payload from the response that they refer to and whose payload has the digest they name.

    A page_id may stand for several payloads, so both must agree. Revisits without such a response have a null size.
    """
    full = found.filter("record_type = 'response'").select(F.col("page_id").alias("r"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n"))
    full = full.groupBy("r", "d").agg(F.min("n").alias("n"))
    match = F.col("refers_to").eqNullSafe(F.col("r")) & (F.col("payload_digest") == F.col("d"))
    rows = found.filter("record_type = 'revisit'").join(full, match, "left")
    rows = rows.select("page_id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return found.filter("record_type <> 'revisit'").unionByName(rows)
