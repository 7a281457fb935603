"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmotion.llm import decontaminate, interactions, lexical, lm, packing, quality, rules, sharding, simhash, substring, tokenized, topk, warc
from gridmotion.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    """Path of the public vocabulary the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = quality.graded_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    )
    return graded.select("doc_id", "expected_grade", "tail", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents")).drop("mark")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized.token_table(spark, table(spark, sf_dir, "documents"), vocabulary())


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_simhash,
        op3_topk,
        op4_lm,
        op5_quality,
        op6_warc,
        op7_decontamination,
        op8_packing,
        op9_substring,
        op10_tokens,
        op11_rules,
        op12_lexical,
        op13_interactions,
        pipeline,
    )
}

# The other operators end in hashes, models, files or searches that SQL cannot state; their
# tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op3_topk": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS v FROM embeddings
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op6_warc": """
WITH rows AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages
), held AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM rows
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to, url
FROM held""",
    "op12_lexical": r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, sum(tf) AS n FROM postings GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS docs, sum(n) AS terms FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM corpus) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS HUGEINT) AS w
  FROM postings GROUP BY term
), norms AS (
  SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, corpus
), asked AS (
  SELECT item_id, term, count(*) AS times FROM item_terms GROUP BY item_id, term
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * CAST(tf AS HUGEINT)) // (1000 * tf + 8 * m))) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10""",
    "op13_interactions": r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), measured AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts
), said AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), firsts AS (
  SELECT text, min(doc_id) AS first FROM texts GROUP BY text
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(m.text, '[^A-Z]', '', 'g')) > 3 * length(m.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(m.text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN m.doc_id > first THEN 'E' ELSE '' END) AS failed
  FROM measured m JOIN firsts USING (text) LEFT JOIN said s ON s.doc_id = m.doc_id
), cells AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, failed
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f <> b.f AND a.f <> c.f AND a.f <> d.f AND a.f <> e.f AND b.f <> c.f AND b.f <> d.f
    AND b.f <> e.f AND c.f <> d.f AND c.f <> e.f AND d.f <> e.f
), steps AS (
  SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, CAST(step AS INT), 1) AS f,
    substr(filter_order, 1, CAST(step AS INT) - 1) AS prefix
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT hit AND NOT early THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT early THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND early THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT early THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT early THEN toxic ELSE 0 END) AS toxic_lost
  FROM (
    SELECT *, contains(failed, f) AS hit, translate(failed, prefix, '') <> failed AS early
    FROM cells, steps
  ) GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted""",
}
