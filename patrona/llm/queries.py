"""The registered query of each operator: whole tables, production parameters, contract columns first."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from patrona.llm import text as T
from patrona.llm.byte_bpe import encode_documents
from patrona.llm.edit_fingerprints import fingerprint_documents
from patrona.llm.langid import identify
from patrona.llm.licenses import scan_licenses
from patrona.llm.merkle import manifest
from patrona.llm.minhash_forest import near_duplicates
from patrona.llm.mixing import mix_sources
from patrona.llm.perplexity import quality_rules
from patrona.llm.pii import find_pii, summarise
from patrona.llm.quality import quality_scores
from patrona.llm.secret_scan import find_secrets
from patrona.llm.toxicity import toxicity
from patrona.llm.whitening import whiten_embeddings


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = T.in_share("doc_id", 3, 1)
    scored = toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op5_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir), shingle_words=4)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_documents(spark, sf_dir))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir))


def op8_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = T.in_share("doc_id", 3, 1)
    found = identify(_documents(spark, sf_dir), ~held_out, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out, calibrating = T.in_share("doc_id", 5, 0), T.in_share("doc_id", 5, 4)
    scored = quality_scores(_documents(spark, sf_dir), _labels(spark, sf_dir), ~held_out & ~calibrating, calibrating)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_documents(spark, sf_dir))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(find_pii(_documents(spark, sf_dir)))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_toxicity, op3_license_scan, op4_byte_bpe, op5_minhash_forest, op6_secret_scan,
        op7_source_mix, op8_edit_fingerprints, op9_language_id, op10_quality_classifier,
        op11_merkle_manifest, op12_pii, op13_embedding_whitening)
} | {"pipeline": corpus_pipeline.run}

#: Exact similarity of all pairs that share a shingle, then the smallest reachable id.
ORACLES = {
    "op5_minhash_forest": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS r FROM documents
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r),
lowest AS (SELECT u, min(r) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest ON lowest.u = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    # Both trees in one recursion each; the CRC-32 is stated bit by bit.
    "op11_merkle_manifest": r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS grp, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_transform(range(0, 8 * strlen(doc_id::VARCHAR)),
      lambda i: (ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) >> (i % 8)::INT)::BIGINT & 1) AS bits
  FROM documents),
leaves AS (
  SELECT rid, doc_id, grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295::BIGINT], bits), lambda c, b:
        xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 3 = 0
      THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY grp) AS n
  FROM leaves),
lower_nodes AS (
  SELECT grp, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT grp, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM lower_nodes WHERE n > 1 GROUP BY grp, level, pos // 8),
subroots AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n
  FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 100 AS level, pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 8),
runs AS (
  SELECT grp, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM lower_nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT '*', level, pos // 8, list(h ORDER BY pos) FROM upper_nodes WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT p.rid, row_number() OVER (PARTITION BY p.rid ORDER BY r.level) AS k, r.hs,
    CASE WHEN r.level < 100 THEN p.pos // (8 ** r.level)::BIGINT % 8
         ELSE s.pos // (8 ** (r.level - 100))::BIGINT % 8 END AS slot
  FROM placed p JOIN subroots s ON s.grp = p.grp
  JOIN runs r ON r.grp = p.grp AND r.run = p.pos // (8 ** (r.level + 1))::BIGINT
    OR r.grp = '*' AND r.level >= 100 AND r.run = s.pos // (8 ** (r.level - 99))::BIGINT),
proofs AS (
  SELECT rid, max(k) AS depth, sha256(string_agg(
    array_to_string(list_concat(hs[1:slot], hs[slot + 2:]), ''), '' ORDER BY k)) AS proof
  FROM steps GROUP BY rid),
folds AS (
  SELECT rid, 0::BIGINT AS k, coalesce(tampered, leaf) AS h FROM placed
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(array_to_string(list_concat(list_append(hs[1:slot], f.h), hs[slot + 2:]), ''))
  FROM folds f JOIN steps s ON s.rid = f.rid AND s.k = f.k + 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, u.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = u.h AS verified
FROM placed p JOIN subroots s ON s.grp = p.grp JOIN upper_nodes u ON u.n = 1
LEFT JOIN proofs q ON q.rid = p.rid JOIN folds f ON f.rid = p.rid AND f.k = coalesce(q.depth, 0)""",
}
