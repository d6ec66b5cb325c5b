"""The registered query of every operator, with the SQL that checks it where SQL can.

Every query reads its whole table and returns the operator's digest of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, common, divergence, exact_dedup, hard_negatives, html_text, ngram_join, packing, pq_dedup, quality_fm, secret_scan, sharding, warc, weighted_sampling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(common.read_table(spark, sf_dir, "pages"))


@query
def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(common.read_table(spark, sf_dir, "documents"))


@query
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read_back(common.read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op3_warc_index"] = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY payload_digest)
"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.read_table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op5_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.read_table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(common.read_table(spark, sf_dir, "documents"))


ORACLES["op7_ngram_jaccard"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS g
  FROM worded
), filed AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM filed a JOIN filed b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(node, start) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT y, start FROM reach JOIN links ON node = x
), least AS (
  SELECT node AS doc_id, min(start) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, len(g) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""


@query
def op8_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(common.read_table(spark, sf_dir, "embeddings"))


ORACLES["op8_pq_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM vectors
  WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reach(node, start) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION SELECT y, start FROM reach JOIN links ON node = x
), least AS (
  SELECT node AS vec_id, min(start) AS component_id FROM reach GROUP BY node
), degrees AS (
  SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least USING (vec_id) LEFT JOIN degrees USING (vec_id)
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(common.read_table(spark, sf_dir, "documents")))


@query
def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(common.read_table(spark, sf_dir, "documents"))


ORACLES["op10_rendezvous_shards"] = """
WITH crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))
), draws AS (
  SELECT doc_id, s, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496 AS u
  FROM (SELECT DISTINCT doc_id FROM documents), (SELECT unnest(['0', '1', '2', '3', '4', '5', '6', '7', '8', 'slot']) AS s)
), placed AS (
  SELECT doc_id, arg_max(s, -1 / ln(u)) FILTER (WHERE s NOT IN ('8', 'slot')) AS shard,
         arg_max(s, -1 / ln(u)) FILTER (WHERE s <> 'slot') AS grown, floor(max(u) FILTER (WHERE s = 'slot') * 4096) AS part
  FROM draws GROUP BY doc_id
), sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                                         lambda x: ('0x' || x)::BIGINT)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot, grown::INT AS grown_shard
FROM sized JOIN placed USING (doc_id)
"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.read_table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), tokens AS MATERIALIZED (
  SELECT d, lang, source, unnest(w) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term
), dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, v
  FROM sources JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counted USING (lang, source, term)
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT)::BIGINT AS p FROM dense
), whole AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(n) + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v))::HUGEINT)::BIGINT AS q
  FROM dense GROUP BY lang, term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT
FROM terms QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200
"""


@query
def op12_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(common.read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


ORACLES["op12_slot_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""


@query
def op13_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compare_with_next(common.read_table(spark, sf_dir, "documents"))
