"""One query per operator over its whole table, and SQL for DuckDB where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import ball_tree, filter_audit, golomb_dedup, langid, masked_lm, mixing, multi_index, packing, periodic_runs, sharding, simhash, token_orc, warc
from tillwright.llm.common import WORD, shared_path, table

SHARDS = [f"shard-{k:03d}" for k in range(128)]


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), 20, 20)


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_orc.write_token_orc(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2, lower=True)
    return token_orc.document_index(spark, path)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return packing.pack(pieces)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.best(table(spark, sf_dir, "embeddings"), 20, 20)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs), ["doc_id", "text"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.records(spark, path))


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS)


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document, by a checksum of the id, the words from some place on repeat the first of them."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), number.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    rows = rows.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    left = F.col("n") - F.col("a")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    changed = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), tail)
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(repeating(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # a / b > c / d in whole numbers; of equal ones the first by start, then period, stays
    best = F.reduce("runs", F.element_at("runs", 1), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_golomb_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    log = filter_audit.new_log(spark, path)
    filter_audit.add_files(spark, path, table(spark, sf_dir, "labels"), log)
    return filter_audit.interactions(filter_audit.counters(spark, log), "ABCDE")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_multi_index, op2_token_orc, op3_mix, op4_pack, op5_simhash, op6_ball_tree, op7_language, op8_masked_lm, op9_warc, op10_shard,
              op11_periodic_runs, op12_golomb_dedup, op13_filter_audit)
}
_WORDS = "len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _number(digest: str, digits: int) -> str:
    return f"('0x' || substr({digest}, 1, {digits}))::BIGINT"


#: Each quotient of the apportionment is a row, the blocks' runs are compared word by word in closed form.
_MIX = f"""
WITH d AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS p FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][(p % 3 + 1)::INTEGER] AS weight FROM t
), l AS (
  SELECT *, row_number() OVER filling AS nth,
    ((sum(s) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(2 * s) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w WINDOW filling AS (ORDER BY s::DOUBLE / weight, p)
), g AS (
  SELECT min_by(level, nth) AS lv FROM l WHERE level * weight <= 2 * s
), a AS (
  SELECT source, s, least((2 * s)::DOUBLE, coalesce(lv * weight, (2 * s)::DOUBLE)) AS target, greatest(1, ceil(s / 1048576))::BIGINT AS shards
  FROM l, g
), n AS (
  SELECT round(sum(target) / 8)::BIGINT AS seats, sum(target) AS whole, count(*) AS parties FROM a
), q AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS place, seats
  FROM (SELECT *, unnest(range(0, (target / whole * (seats + parties))::BIGINT + 2)) AS k FROM a, n WHERE target > 0)
), sq AS (
  SELECT source, count(*) AS quota FROM q WHERE place <= seats GROUP BY source
), e AS (
  SELECT d.*, a.s, a.target, coalesce(sq.quota, 0) AS source_quota, {_number("d.k", 8)} % a.shards AS shard
  FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN sq ON d.source IS NOT DISTINCT FROM sq.source
), c AS (
  SELECT source, shard, sum(size)::BIGINT AS words, first(source_quota) AS seats, first(s) AS s FROM e GROUP BY source, shard
), cn AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS parties FROM c
), cq AS (
  SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT *, unnest(range(0, (words / s * (seats + parties))::BIGINT + 2)) AS k FROM cn WHERE words > 0)
), cs AS (
  SELECT source, shard, count(*) AS quota FROM cq WHERE place <= seats GROUP BY source, shard
), b AS (
  SELECT c.source, c.shard, greatest(1, ceil(words / 8))::BIGINT AS blocks, coalesce(cs.quota, 0) AS quota,
    {_number("md5('mix:' || coalesce(c.source, '') || ':' || c.shard)", 8)} AS seed
  FROM c LEFT JOIN cs ON c.source IS NOT DISTINCT FROM cs.source AND c.shard = cs.shard
), r AS (
  SELECT e.*, least(quota, 2 * blocks) // blocks AS copies, least(quota, 2 * blocks) % blocks AS more, seed % blocks AS f, blocks,
    (sum(size) OVER (PARTITION BY e.source, e.shard ORDER BY k ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS a0
  FROM e JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.shard = b.shard
)
SELECT doc_id, size, s AS source_size, target, (copies * size
  + greatest(0, least(a0 + size, least(f + more, blocks) * 8) - greatest(a0, f * 8))
  + greatest(0, least(a0 + size, (f + more - blocks) * 8) - a0))::BIGINT AS taken
FROM r
"""

_BEST = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c)))
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d
)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""


_COPIES = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""

#: Every order is a row of its own; each document's failures are compared with the filters before each step.
_AUDIT = f"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(words) < 200)::INT
    + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT unnest([0, 1, 2, 3, 4]) AS k
), o AS (
  SELECT [a.k, b.k, x.k, y.k, z.k] AS ks, list_transform([a.k, b.k, x.k, y.k, z.k], lambda k: substr('ABCDE', k + 1, 1)) AS letters
  FROM f a, f b, f x, f y, f z WHERE len(list_distinct([a.k, b.k, x.k, y.k, z.k])) = 5
), s AS (
  SELECT array_to_string(letters, '') AS filter_order, step, 1 << ks[step] AS own, list_sum(list_transform(ks[1:step - 1], lambda k: 1 << k)) AS gone
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM o)
), r AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (mask & (own | coalesce(gone, 0)::INT) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & own > 0 AND mask & coalesce(gone, 0)::INT = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & own > 0 AND mask & coalesce(gone, 0)::INT > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & own > 0 AND mask & coalesce(gone, 0)::INT = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & coalesce(gone, 0)::INT = 0), 0) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


def _shards() -> str:
    """The table of slots as a literal, tested against a plain filling."""
    held = ",".join(map(str, sharding.fill(SHARDS)))
    slot = _number("md5(coalesce(doc_id::VARCHAR, ''))", 12)
    return f"""
WITH s AS (SELECT doc_id, {slot} % {sharding.SLOTS} AS slot FROM documents), h AS (SELECT string_split('{held}', ',') AS held)
SELECT doc_id, slot, 'shard-' || lpad(held[slot + 1], 3, '0') AS shard FROM s, h
"""


ORACLE: dict[str, str] = {
    "op3_mix": _MIX, "op6_ball_tree": _BEST, "op9_warc": _WARC, "op10_shard": _shards(),
    "op12_golomb_dedup": _COPIES, "op13_filter_audit": _AUDIT,
}
