"""Registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (bpe_chunks, decontamination, hard_negatives, language_id, line_dedup, maxent_lm, merkle, pii, quality, sharding, simhash_dedup, toxicity,
                          warc)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 8
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _remainder(parts: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; learned from rows whose remainder is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    trees = language_id.learn(docs.filter(~held_out).select("lang", "text"))
    return language_id.identify(docs.select("doc_id", "text", held_out.alias("held_out")), trees, keep=("held_out",))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document; labels are learned from rows whose remainder is not 0."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    index = toxicity.learn_joined(docs.filter(~held_out).select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_texts(docs.select("doc_id", "text", held_out.alias("held_out")), index, keep=("held_out",))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)


@query
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each text without later copies of line runs."""
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, trim(line, E' \t\r\x0b\x0c') AS line FROM (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
    FROM documents WHERE text IS NOT NULL)),
words AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^ 	
]+')) AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM lines WHERE line <> ''),
sums AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY j) AS upto, sum(w) OVER (PARTITION BY doc_id) AS total FROM words),
whole AS (SELECT doc_id, list(line ORDER BY j) AS seq FROM words GROUP BY doc_id),
spans AS (
  SELECT doc_id, j AS a, j - 1 + count(*) OVER (PARTITION BY doc_id ORDER BY upto - w RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS b,
         total - upto + w >= 50 AS fits FROM sums
  UNION
  SELECT doc_id, j + 1 - count(*) OVER (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW), j, upto >= 50 FROM sums),
found AS (SELECT doc_id, a, b, array_to_string(seq[a:b], chr(10)) AS content FROM spans JOIN whole USING (doc_id) WHERE fits),
later AS (
  SELECT doc_id, a, b FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS copy FROM found) WHERE copy > 1),
gone AS (
  SELECT DISTINCT s.doc_id, s.j, s.i FROM sums s JOIN later x ON s.doc_id = x.doc_id AND s.j BETWEEN x.a AND x.b),
runs AS (
  SELECT doc_id, min(i) AS low, max(i) AS high FROM (
    SELECT *, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS run FROM gone) GROUP BY doc_id, run),
dropped AS (SELECT DISTINCT l.doc_id, l.i FROM lines l JOIN runs r ON l.doc_id = r.doc_id AND l.i BETWEEN r.low AND r.high),
removed AS (SELECT doc_id, list(i) AS at FROM dropped GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       coalesce(len(r.at), 0)::BIGINT AS n_removed,
       sha256(coalesce(CASE WHEN r.at IS NULL THEN d.text ELSE array_to_string(
         list_transform(list_filter(list_zip(string_split(d.text, chr(10)), range(1, len(string_split(d.text, chr(10))) + 1)),
                                    lambda x: NOT list_contains(r.at, x[2])), lambda x: x[1]), chr(10)) END, '')) AS text_sha256
FROM documents d LEFT JOIN removed r USING (doc_id)
"""


@query
def op6_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.digest(bpe_chunks.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, read back, and placed in the order of captures."""
    captures = warc.archive_pages(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "capture_no")


ORACLES["op7_warc"] = r"""
WITH sized AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
owned AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS owner FROM sized),
keyed AS (
  SELECT *, regexp_replace(regexp_extract(trim(url), '^[a-z]+://([^/?#:]*)', 1), '^www[.]', '') AS host,
         regexp_extract(trim(url), '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(trim(url), '^[^?#]*([?][^#]+)', 1) AS query,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 630720000), '%Y%m%d%H%M%S') AS captured_at FROM owned),
named AS (
  SELECT *, lower(array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END || query) AS url_key FROM keyed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < owner THEN owner END AS refers_to, url_key, captured_at,
       row_number() OVER (PARTITION BY url_key ORDER BY captured_at, page_id) AS capture_no
FROM named
"""


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect_pii(table(spark, sf_dir, "documents")))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document."""
    indexes = decontamination.build_indexes(table(spark, sf_dir, "benchmark"))
    found = decontamination.find_contaminated(table(spark, sf_dir, "documents"), indexes)
    return found.select("doc_id", "contaminated", F.transform("items", lambda x: x["item"]).alias("item_ids"),
                        F.coalesce(F.get("items", F.lit(0)).getField("score"), F.lit(0.0)).alias("best_score"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.build_references(docs))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; where 7 divides the checksum of the id, a changed n_chars must be noticed."""
    n_chars, doc_id = F.col("n_chars").cast("decimal(20,0)"), F.col("doc_id")
    tampered = F.when(F.coalesce(_remainder(7) == 0, F.lit(False)), n_chars + 1).otherwise(n_chars)
    leaf = lambda n: merkle.leaf_digest([doc_id, F.col("source"), F.col("lang"), n, F.col("text")])  # noqa: E731
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", leaf(n_chars).alias("leaf"), leaf(tampered).alias("claimed"))
    proofs = merkle.manifest(rows, "lang", ["doc_id"], keep=("doc_id", "claimed"))
    return merkle.verify(proofs, "claimed").select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("hops")).alias("proof_sha256"),
                                                   "folded_root", "verified")


ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE sums AS (
  SELECT d.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [3988292384, 3988292384, 3988292384, 3988292384, 3988292384, 3988292384, 3988292384, 3988292384]),
      lambda r, p: xor(r >> 1, p * (r & 1))))) AS crc FROM documents d),
fields AS (
  SELECT doc_id, lang, crc, n_chars,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         coalesce(strlen(text) || ':' || text, '-') AS z FROM sums),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
         CASE WHEN crc % 7 = 0 THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z)
              ELSE sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) END AS claimed FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS slot, count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree AS (
  SELECT g, 0 AS level, slot, leaf AS digest, n FROM placed
  UNION ALL
  SELECT g, level + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)), (max(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, level, slot // 2),
subroots AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS slot, count(*) OVER () AS n FROM tree WHERE n = 1),
above AS (
  SELECT 0 AS level, slot, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)), (max(n) + 1) // 2 FROM above WHERE n > 1 GROUP BY level, slot // 2),
hops AS (
  SELECT p.doc_id, p.g, p.slot, t.level AS lvl, (p.slot >> t.level) % 2 = 1 AS turned, s.digest
  FROM placed p JOIN (SELECT DISTINCT g, level FROM tree WHERE n > 1) t USING (g)
  LEFT JOIN tree s ON s.g = p.g AND s.level = t.level AND s.slot = xor(p.slot >> t.level, 1)
  UNION ALL
  SELECT p.doc_id, p.g, p.slot, 1000 + t.level, (r.slot >> t.level) % 2 = 1, s.digest
  FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT DISTINCT level FROM above WHERE n > 1) t
  LEFT JOIN above s ON s.level = t.level AND s.slot = xor(r.slot >> t.level, 1)),
ways AS (
  SELECT g, slot, sha256(string_agg(coalesce(digest, ''), '' ORDER BY lvl)) AS proof_sha256,
         list({'turned': turned, 'digest': coalesce(digest, '')} ORDER BY lvl) AS way FROM hops GROUP BY g, slot),
folds AS (
  SELECT p.g, p.slot, 1 AS i, claimed AS now, way FROM placed p LEFT JOIN ways USING (g, slot)
  UNION ALL
  SELECT g, slot, i + 1, CASE WHEN way[i].turned THEN sha256(way[i].digest || now) ELSE sha256(now || way[i].digest) END, way
  FROM folds WHERE i <= coalesce(len(way), 0)),
ends AS (SELECT g, slot, now AS folded_root FROM folds WHERE i = coalesce(len(way), 0) + 1)
SELECT p.doc_id, p.leaf, r.subroot, a.digest AS root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = a.digest AS verified
FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT digest FROM above WHERE n = 1) a JOIN ends e ON e.g = p.g AND e.slot = p.slot
LEFT JOIN ways w ON w.g = p.g AND w.slot = p.slot
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


ORACLES["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.no, a.vec_id AS anchor_id, o.vec_id AS other_id, o.no AS other_no, a.label = o.label AS same, list_inner_product(a.q, o.q)::BIGINT AS score
  FROM v a JOIN v o ON a.no <> o.no WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT no, anchor_id, other_id AS positive_id, other_no AS positive_no, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY no ORDER BY score DESC, other_id, other_no) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.no = p.no AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.no, p.positive_no ORDER BY s.score DESC, s.other_id, s.other_no)
QUALIFY row_number() OVER w <= 5
"""


@query
def op13_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those whose remainder is not 0."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(10) == 0, F.lit(False))
    model, counts = maxent_lm.learn(docs, ~held_out)
    return maxent_lm.score_texts(docs.withColumn("held_out", held_out), model, counts, keep=("held_out",))
