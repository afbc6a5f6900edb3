"""One query per training-data operator: (spark, sf_dir) -> DataFrame, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (alignment, decontam, exact, jaccard, negatives, packing, secrets, sharding, substrings, tiers, toxicity,
                         urls, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_vector_shards(spark, sf_dir):
    return sharding.vector_shards(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(_table(spark, sf_dir, "documents")).drop("found")


def op3_url_rules(spark, sf_dir):
    return urls.filter_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), min_lift=urls.MIN_LIFT, level=urls.LEVEL)


def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard.ngram_groups(_table(spark, sf_dir, "documents")).drop("set_id")


def op5_toxicity_crf(spark, sf_dir):
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")) \
        .withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op6_bm25_decontamination(spark, sf_dir):
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_warc(spark, sf_dir):
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark, sf_dir):
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_tiered_packing(spark, sf_dir):
    return tiers.tiered_packing(_table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.align(_table(spark, sf_dir, "documents"), keep_groups=False).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_vector_shards, op2_secret_scan, op3_url_rules, op4_ngram_jaccard_join, op5_toxicity_crf, op6_bm25_decontamination, op7_warc,
    op8_substring_dedup, op9_exact_dedup, op10_best_fit_packing, op11_hard_negatives, op12_tiered_packing, op13_tokenizer_alignment)}

#: translate() in the SQL below: exactly A-Z become a-z.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words of every text; those of op4 in lower case.
_SPLIT = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

ORACLE = {
    "op4_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format(_LOWER)} AS w FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
             e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
             p AS (SELECT a.doc_id AS i, b.doc_id AS j FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
                   HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
             l AS (SELECT i, j FROM p UNION ALL SELECT j, i FROM p),
             r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.j FROM r JOIN l ON r.c = l.i)
        SELECT doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(c) AS component_id FROM r JOIN s USING (doc_id) GROUP BY doc_id""",
    "op8_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS w FROM documents),
             g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
                   FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
             o AS (SELECT x, min(doc_id) AS least FROM g GROUP BY x),
             c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN o USING (x) WHERE least < doc_id),
             k AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.p) AS kept, count(*) AS n
                   FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w) t ANTI JOIN c USING (doc_id, p) GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                          CAST(list_sum(list_transform(list_zip(a.q, r.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
                   FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
    "op7_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
             g AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                             ELSE page_id END AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to FROM g""",
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
}
