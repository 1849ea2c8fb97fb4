"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidegate.llm import (
    compress_quality,
    decontaminate,
    dual_tree_search,
    edit_embedding,
    html_templates,
    inverted_multi_index,
    pii_boost,
    poisson_mix,
    rule_thresholds,
    simhash_partitions,
    substring_dedup,
    token_attribution,
    warc_shards,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_template_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(table(spark, sf_dir, "pages"))


def op2_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return compress_quality.classify(documents, labels)


def op3_pii_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.find(table(spark, sf_dir, "documents")).drop("redacted")


def op4_simhash_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_partitions.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc_sharded_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_shards.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    return decontaminate.contamination(documents, benchmark).drop("hit_at")


def op7_substring_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op8_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_attribution.attribute(table(spark, sf_dir, "documents"), ["source", "text"])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return rule_thresholds.judge(documents, labels).drop("rejected_by")


def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mix(table(spark, sf_dir, "documents"))


def op11_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.near_duplicates(table(spark, sf_dir, "documents"))


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    return dual_tree_search.rank(documents, benchmark)


def op13_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return inverted_multi_index.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_template_classes,
        op2_compression_classifier,
        op3_pii_candidate_boosting,
        op4_simhash_partitions,
        op5_warc_sharded_writer,
        op6_benchmark_decontamination,
        op7_substring_automata,
        op8_token_attribution,
        op9_quality_rules,
        op10_poisson_mixing,
        op11_edit_embedding,
        op12_dual_tree_search,
        op13_inverted_multi_index,
    )
} | {"pipeline": corpus_pipeline.run}

OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS first FROM p),
c AS (SELECT *, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a,
  list_transform(range(0, 8), lambda i: ('0x' || substr(s, i * 5 + 1, 5))::BIGINT) AS v FROM f)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(v, lambda x: a[(x >> 15) % 32 + 1] || a[(x >> 10) % 32 + 1]
    || a[(x >> 5) % 32 + 1] || a[x % 32 + 1]), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM c"""

OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b
        WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens
        WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM f WHERE first < doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

OP10_SQL = """
WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, (sum(n) OVER ())::DOUBLE * pow(n, 0.5) / sum(pow(n, 0.5)) OVER () / n AS rate FROM s),
c AS (SELECT source, list_transform(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1),
    lambda k: exp(-rate) * pow(rate, k) / gamma(k + 1)) AS pmf FROM r),
f AS (SELECT source, list_transform(range(1, len(pmf) + 1),
    lambda k: list_sum(pmf[1:k])) AS cdf FROM c),
d AS (SELECT documents.*, len(list_filter(cdf, lambda x: x <= ('0x' ||
      substr(md5('20:' || doc_id || ':1'), 1, 13))::BIGINT / 4503599627370496)) AS n
  FROM documents JOIN f ON documents.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, text, lang, source, n_chars, k::INTEGER AS copy,
  md5('order:20:' || doc_id || ':' || k) AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS k FROM d)"""

OP12_SQL = r"""
WITH cut AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM documents),
asked AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM cut
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
ws AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM dfs, totals),
ms AS (SELECT doc_id, 100 - 50 + ((50 * n * big_n) // big_l) AS m FROM sizes, totals),
parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part
  FROM tfs JOIN ws USING (term) JOIN ms USING (doc_id)),
scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score
  FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50"""

OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id
    ORDER BY score DESC, other)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

ORACLES: dict[str, str] = {
    "op5_warc_sharded_writer": OP5_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op7_substring_automata": OP7_SQL,
    "op10_poisson_mixing": OP10_SQL,
    "op12_dual_tree_search": OP12_SQL,
    "op13_inverted_multi_index": OP13_SQL,
}
