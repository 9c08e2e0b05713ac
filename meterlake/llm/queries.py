"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import (
    decontaminate, hard_negatives, jaccard_join, lm, mixing, pii, quality, secrets, shards, simhash_dups, suffix_dups,
    toxicity, whitening,
)
from meterlake.llm.common import read

SHARDS = 24
TARGETS = {"good": 0.93, "poor": 0.05, "toxic": 0.02}


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(toxicity.sample_labelled(docs, read(spark, sf_dir, "labels"))))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.label_domains(read(spark, sf_dir, "labels"))
    return mixing.mix(read(spark, sf_dir, "documents"), labelled, TARGETS).drop("doc_hash")


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(read(spark, sf_dir, "documents"), SHARDS)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dups.remove_repeats(read(spark, sf_dir, "documents"), length=400).drop("kept")


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.score(read(spark, sf_dir, "documents"), min_count=1)
    return found.select("doc_id", "n_words", *[F.round(c, 3).alias(c) for c in ("log_score", "mean_log_score")])


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dups.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), relabel=relabel)


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_copies(read(spark, sf_dir, "documents"), shingle=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_decontamination, op3_pii, op4_toxicity, op5_mixing, op6_hilbert_shards,
        op7_suffix_dedup, op8_lm_scores, op9_simhash_dedup, op10_secret_scan, op11_whitening, op12_hard_negatives,
        op13_ngram_jaccard)}

def _secret_hits(place: int, kind: str, pattern: str, least: int, group: int = 0) -> str:
    """Matches of one rule: what lies between them gives their places."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a, length(hits[i]) AS n
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS hits,
             regexp_extract_all(t, '{p}', {group}) AS parts FROM d))
    WHERE length(parts[i]) >= {least}"""


# The rules in RE2's syntax: it needs neither possessive loops nor look-behinds.
_SECRET_SQL = "\n    UNION ALL ".join([
    _secret_hits(0, "assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    _secret_hits(1, "access", "AKIA[A-Z0-9]+", 16),
    _secret_hits(2, "hex", "[0-9a-f]{32,}", 32),
    _secret_hits(3, "github", "gh[pousr]_[A-Za-z0-9]{36,}", 40),
    _secret_hits(4, "slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    _secret_hits(5, "jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    _secret_hits(6, "pem", "-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----", 20)])

ORACLES: dict[str, str] = {
    "op8_lm_scores": f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
tok AS (SELECT doc_id, u, v, CASE WHEN m = 1 THEN 1 WHEN i > 1 AND i < m THEN -1 ELSE 0 END AS adds FROM (
  SELECT doc_id, len(w) AS m, unnest(w) AS u, unnest(list_append(w[2:], NULL)) AS v, unnest(range(1, len(w) + 1)) AS i FROM d)),
uni AS (SELECT u, count(*) AS n, CAST(round(ln(count(*)) * {lm.SCALE}) AS BIGINT) AS gain FROM tok GROUP BY u),
total AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM uni),
bi AS (SELECT u, v, CAST(round(ln(count(*)) * {lm.SCALE}) AS BIGINT) AS gain FROM tok WHERE v IS NOT NULL GROUP BY u, v),
sums AS (SELECT tok.doc_id, sum(adds * uni.gain + coalesce(bi.gain, 0)) AS s
  FROM tok JOIN uni ON tok.u = uni.u LEFT JOIN bi ON tok.u = bi.u AND tok.v = bi.v GROUP BY tok.doc_id),
out AS (SELECT d.doc_id, len(w) AS n_words,
  CASE WHEN len(w) > 0 THEN coalesce(s, 0) / {lm.SCALE} - ln(t) ELSE 0 END AS l
  FROM d LEFT JOIN sums ON d.doc_id = sums.doc_id, total)
SELECT doc_id, n_words, round(l, 3) AS log_score,
       CASE WHEN n_words > 0 THEN round(l / n_words, 3) END AS mean_log_score FROM out""",
    "op10_secret_scan": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS (SELECT *, kind || ':' || a || ':' || (a + n) AS said FROM (
    {_SECRET_SQL})),
found AS (SELECT doc_id,
  count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY a, place) FILTER (place < 3), '')) AS base_sha256,
  string_agg(said, ',' ORDER BY a, place) AS spans FROM hits GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found ON d.doc_id = found.doc_id""",
}
