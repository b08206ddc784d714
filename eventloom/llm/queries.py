"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    hamming, html, language, lexical, lines, mixing, neighbors, pieces, pii, quality, sharding, simhash, whitening,
)
from eventloom.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


_WORDS = r"'[^\x20\x09-\x0D]+'"

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS BIGINT) AS size,
    md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)) AS k
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS BIGINT) AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS most,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
      ORDER BY CAST(3 * source_size AS DOUBLE) / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(w) OVER (
      ORDER BY CAST(3 * source_size AS DOUBLE) / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked),
targets AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), max(level) OVER () * w) AS target FROM levels),
rated AS (
  SELECT *, coalesce(CAST(floor(least(target / nullif(CAST(source_size AS DOUBLE), 0), 3.0) * 4294967296) AS HUGEINT), 0) AS each,
    CAST(CAST('0x' || substr(md5('7' || coalesce('=' || source, '')), 1, 8) AS BIGINT) AS HUGEINT) AS shift
  FROM targets),
placed AS (
  SELECT s.*, r.source_size, r.target, r.each, r.shift + r.each * row_number() OVER (
    PARTITION BY s.source
    ORDER BY lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || rpad(substr(bin(size), 1, 4), 4, '0'), k, doc_id) AS upto
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  CAST((upto // 4294967296 - (upto - each) // 4294967296) * size AS BIGINT) AS taken
FROM placed"""


@_query("op1_mix_sources", _MIX)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # Texts are read once: what is left of them is written and read twice.
    rows = stored(mixing.sized(docs).drop("text"), "sizes")
    return mixing.copies(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@_query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = F.filter("spans", lambda s: s["plain"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(_joined(plain), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["plain"])).cast("long").alias("n_disguised"),
    )


@_query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


@_query("op4_pieces")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"))
    return pieces.encode(docs).select(
        "doc_id", "n_chars", F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "score", F.to_json("others").alias("others"), "round_trip",
    )


@_query("op5_hamming_top_k", """
WITH bits AS (
  SELECT vec_id, i, sum(CASE WHEN embedding[i + 1] > 0 THEN 1 ELSE 0 END) AS b
  FROM embeddings, range(64) t(i) GROUP BY vec_id, i),
codes AS (
  SELECT vec_id, string_agg(CAST(b AS VARCHAR), '' ORDER BY i) AS code FROM bits GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, CAST(hamming(q.code, r.code) AS INT) AS distance
  FROM codes q JOIN codes r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INT) AS rank FROM pairs)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code")
    )
    rows = stored(rows, "sign-codes")
    return hamming.top_k(rows, rows.filter("id % 50 = 0"), k=10)


# The CRC table is the polynomial 0xEDB88320 applied eight times to each byte.
@_query("op6_shards", r"""
WITH crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t
  FROM range(256) r(i)),
rows AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size, coalesce(text, '') AS text,
    md5(coalesce(text, '')) AS k, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents),
summed AS (
  SELECT doc_id, size, k, d, xor(list_reduce(
      [4294967295] || list_transform(range(size - 16), lambda i: CAST(('0x' || substr(hex(encode(text)), CAST(2 * i + 1 AS INT), 2)) AS BIGINT)),
      lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)), 4294967295) AS text_crc32
  FROM rows, crc),
placed AS (
  SELECT doc_id, size, text_crc32, k, d,
    CAST(((sum(size) OVER (ORDER BY k, d ROWS UNBOUNDED PRECEDING) - size) * 40) // sum(size) OVER () AS INT) AS shard
  FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY k, d) - 1 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs).withColumn("grown_shard", F.lit(None).cast("int"))


@_query("op7_line_dedup", r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> keeper, FALSE) AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@_query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("lang", "source")


@_query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return named.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "coverage")


@_query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


@_query("op12_lexical", r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tfs AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM d GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY ALL),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, corpus GROUP BY term, n_docs),
impacts AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms))) AS impact
  FROM tfs JOIN sizes USING (doc_id), corpus),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM i JOIN impacts USING (term) JOIN weights USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@_query("op13_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbors.top_k(rows, rows.where("vec_id % 100 = 0"))
