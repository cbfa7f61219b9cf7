"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm import byte_bpe, exact_dedup, hard_negatives, html_extract, jaccard_join, latent_vote, mixing, rule_forest, token_counts, toxicity, url_filter, wavelet_tokens, whitening
from clusterlens.llm.common import held_out, read, small_batches

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed values of the task: (host, path prefix, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


#: Fixed values of the task: weights of the sources in turn, and the mix's share of all words.
SOURCE_WEIGHTS, MIX_SHARE = [3.0, 1.0, 2.0], 1.5
#: Scores from here on count as label 1.
QUALITY_CUT, TOXIC_CUT = 0.3, 0.5
#: Fixed value of the task: added to each whole component before whitening.
WHITENING_SHIFT = 1_000_000
#: Documents with more tokens are over the limit.
TOKEN_LIMIT = 1024


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents")
    voter = latent_vote.train(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), latent_vote.score(F.col("text"), voter).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url against the rules; urls without a rule are allowed."""
    small_batches(spark, 2048)
    judged = read(spark, sf_dir, "pages").select("page_id", url_filter.judge_urls(spark, F.col("url"), URL_RULES).alias("j"))
    return judged.select("page_id", "j.host", "j.path", "j.rule", "j.verdict")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document and the forest's verdict."""
    docs = read(spark, sf_dir, "documents")
    forest = rule_forest.train(docs, read(spark, sf_dir, "labels"))
    judged = docs.select("doc_id", rule_forest.judge(F.col("text"), forest).alias("j"))
    return judged.select("doc_id", "j.n_words", "j.word_chars", "j.n_symbols", "j.n_dup_lines", "j.n_repeat_words", "j.base_failed", "j.kept", "j.anomaly")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their decoding, as counts and digests."""
    small_batches(spark)
    trip = byte_bpe.round_trip(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return (
        read(spark, sf_dir, "documents")
        .select("doc_id", trip.alias("t"))
        .select(
            "doc_id",
            (F.octet_length("t.ids") / 4).cast("long").alias("n_tokens"),
            F.sha2("t.ids", 256).alias("ids_sha256"),
            F.sha2("t.decoded", 256).alias("decoded_sha256"),
        )
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document."""
    docs = read(spark, sf_dir, "documents")
    return exact_dedup.mark(docs, exact_dedup.duplicate_groups(docs))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = mixing.mix(read(spark, sf_dir, "documents"), SOURCE_WEIGHTS, MIX_SHARE, n_shards=shards)
    return found.docs.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the wavelet files."""
    docs = read(spark, sf_dir, "documents")
    back = wavelet_tokens.token_shards(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    found = jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages")
    weights = html_extract.train(pages)
    return pages.select("page_id", "url", html_extract.main_text(F.col("html"), weights).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_CUT).cast("int"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), hard_negatives.whole_components(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen whitened coordinates of every vector."""
    whole = F.transform(hard_negatives.whole_components(F.col("embedding"), 64), lambda x: x + WHITENING_SHIFT)
    found = whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", whole.alias("vector")), n_components=16)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    found = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_url_filter": op2_url_filter,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_wavelet_tokens": op7_wavelet_tokens,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html_extract": op9_html_extract,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_counts": op13_token_counts,
}

ORACLE: dict[str, str] = {
    "op2_url_filter": r"""
WITH rules(host_rule, path_rule, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (SELECT page_id,
    CASE WHEN coalesce(url, '') LIKE '%://%' THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN coalesce(url, '') LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
fits AS (SELECT p.page_id, p.host, p.path, r.host_rule || r.path_rule AS rule, r.verdict
  FROM parts p LEFT JOIN rules r ON (p.host = r.host_rule OR ends_with(p.host, '.' || r.host_rule)) AND starts_with(p.path, r.path_rule)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS k FROM fits)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE k = 1
""",
    "op5_exact_dedup": r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents),
g AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY sha)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.sha AS text_sha256 FROM n JOIN g USING (sha)
""",
    "op11_hard_negatives": r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
}
