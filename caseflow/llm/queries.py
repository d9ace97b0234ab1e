"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from pyspark.sql import functions as F

from caseflow.llm.alignment import align_tokens
from caseflow.llm.exact_dedup import exact_dedup
from caseflow.llm.hard_negatives import hard_negatives
from caseflow.llm.language_id import identify
from caseflow.llm.main_text import main_text
from caseflow.llm.mixing import mix_report
from caseflow.llm.near_dedup import near_dedup
from caseflow.llm.packing import pack
from caseflow.llm.quality import classify
from caseflow.llm.quotation import reply_order
from caseflow.llm.sharding import SHARDS, place
from caseflow.llm.token_counts import count_tokens
from caseflow.llm.topk import top_k


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return identify(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return count_tokens(_table(spark, sf_dir, "documents"))


def op4_quotation_linking(spark, sf_dir):
    return reply_order(_table(spark, sf_dir, "conversations"))


def op5_packing(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), ids=False)


def op6_mixing(spark, sf_dir):
    return mix_report(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_near_dedup(spark, sf_dir):
    return near_dedup(_table(spark, sf_dir, "documents"), width=4)


def op9_sharding(spark, sf_dir):
    shards = [f"shard-{i:02d}" for i in range(SHARDS)]
    placed = place(_table(spark, sf_dir, "documents"), ["doc_id"], shards)
    return placed.select("doc_id", "slot", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))


def op10_topk(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op11_token_alignment(spark, sf_dir):
    return align_tokens(_table(spark, sf_dir, "documents"))


def op12_main_text(spark, sf_dir):
    return main_text(_table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id % 50 = 0")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_quotation_linking": op4_quotation_linking,
    "op5_packing": op5_packing,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_near_dedup": op8_near_dedup,
    "op9_sharding": op9_sharding,
    "op10_topk": op10_topk,
    "op11_token_alignment": op11_token_alignment,
    "op12_main_text": op12_main_text,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_topk": """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 20""",
    # The one layout of the given pages; the operator itself knows no layout.
    "op12_main_text": r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS x FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS x FROM articles),
decoded AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    x, '&quot;?', '"', 'g'), '&#(x27|39);', '''', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS x
  FROM plain)
SELECT page_id, url, trim(regexp_replace(x, '\s+', ' ', 'g')) AS text,
       length(trim(regexp_replace(x, '\s+', ' ', 'g'))) AS n_chars FROM decoded""",
    "op13_hard_negatives": """
WITH distinct_rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT row_number() OVER (ORDER BY vec_id, label, v) AS n, * FROM distinct_rows),
scores AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, c.n, c.vec_id, c.label = a.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM numbered a JOIN numbered c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, n) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, s.vec_id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
  AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW best AS (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.vec_id, s.n)
QUALIFY row_number() OVER best <= 3""",
}
