"""The registered query of each training-data operator, and its SQL where SQL can express it.

Each takes (spark, sf_dir), applies its operator to the whole table and derives the columns to compare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm import bpe, decontaminate, exact_dedup, filter_audit, lm_scoring, merkle, mixing, pii, quality, secrets_scan, simhash, spans, token_counts, token_shards
from barmill.llm.common import documents

QUERIES: dict = {}
ORACLES: dict = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.round_trip(documents(spark, sf_dir), tokenizer()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer(), limit=512)


@_query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every document."""
    base = F.col("base")
    return pii.find_pii(documents(spark, sf_dir)).select(
        "doc_id", *(spans.count(base, k).alias(f"n_{k}") for k in pii.KINDS), F.sha2(spans.joined(base), 256).alias("base_sha256"), spans.joined(pii.all_spans()).alias("spans")
    )


@_query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of secrets in every document; a source is an owner, its part in one language a repository."""
    source = F.col("source")
    found = secrets_scan.find_secrets(documents(spark, sf_dir), repo=F.concat_ws("/", source, F.col("lang")), owner=source)
    base = F.col("base")
    return found.select(
        "doc_id",
        *(spans.count(base, k).alias(f"n_{k}") for k in secrets_scan.KINDS),
        F.sha2(spans.joined(base), 256).alias("base_sha256"),
        spans.joined(secrets_scan.in_order(F.concat("base", "added"))).alias("spans"),
        "n_live",
        "n_example",
    )


@_query
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written shards hold of every document, each found by its key through the shards' indexes."""
    docs = documents(spark, sf_dir)
    manifest = token_shards.write_shards(docs, tokenizer(), end_id=0)
    return token_shards.lookup(manifest, docs).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled ones that aren't held out."""
    found = quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted")


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark occurs in every document."""
    found = decontaminate.find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    n_hit = F.aggregate("hit", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "utf-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op7_decontaminate"] = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT item_id, least(len(w), 10) AS m, unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) AS s
  FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM doc, (SELECT DISTINCT m FROM win)),
hit AS (
  SELECT p.doc_id, p.m, p.i, win.item_id FROM (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS s FROM place) p JOIN win USING (m, s)),
pos AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model score and smoothed word-share score of every document."""
    return lm_scoring.score(documents(spark, sf_dir), tokenizer())


@_query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op9_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_groups(documents(spark, sf_dir), shingle=3, tau=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every language in all 120 orders."""
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLES["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT part, coalesce(quality = 1, false)::INT AS good, coalesce(toxic = 1, false)::INT AS toxic,
    [f for f in [
      CASE WHEN len(w) < 100 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
      CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END] if f IS NOT NULL] AS fails
  FROM d LEFT JOIN labels USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT array_to_string(o, '') AS filter_order, step::INT AS step, o[step] AS own, o[1 : step - 1] AS before_ FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT list_contains(fails, own) AND NOT list_has_any(fails, before_) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, before_) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN list_contains(fails, own) AND list_has_any(fails, before_) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = [own] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, before_) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN list_contains(fails, own) AND NOT list_has_any(fails, before_) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its row as tampered still gives the root."""
    proofs, _ = merkle.manifest(documents(spark, sf_dir))
    return merkle.verified(proofs)


@_query
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    rows, mixed = mixing.mix(documents(spark, sf_dir))
    return mixing.taken(rows, mixed).select("doc_id", "size", "source_size", "target", "taken")
