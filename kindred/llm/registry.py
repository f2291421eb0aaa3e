"""The queries of this subpackage over the driver's tables, and DuckDB SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import jaccard, language, lm, media, packing, positional, pseudonyms, sharding, toxicity, urlfilter
from kindred.session import settle

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes as lossless WebP, stored in a table and read back from it."""
    return media.read_webp(settle(media.store_as_webp(table(spark, sf_dir, "documents")), "media"))


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms for its personal numbers and dates."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonyms.key_of(spark))


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document stands in the benchmark's items."""
    return positional.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, equal texts together."""
    rows = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under 4-word shingles at a similarity of 0.85."""
    return jaccard.similarity_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def remainder(n: int):
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def held_out(n: int):
    """Whether the remainder is 2; a null id isn't held out."""
    return F.coalesce(remainder(n) == 2, F.lit(False))


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under the interpolated word model."""
    return lm.interpolated_scores(table(spark, sf_dir, "documents"), ~held_out(7))


def op5_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    return language.predict_language(docs, ~held_out(4)).select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels of three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out(4))
    return scored.select("doc_id", held_out(4).alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_lossless_webp": op1_lossless_webp,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_positional_index": op3_positional_index,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_word_first_language": op5_word_first_language,
    "op6_minimax_shards": op6_minimax_shards,
    "op7_url_rules": op7_url_rules,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_deleted_interpolation": op9_deleted_interpolation,
    "op10_kneser_ney_toxicity": op10_kneser_ney_toxicity,
}

ORACLES = {
    "op3_positional_index": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), items AS (
            SELECT item_id, w, least(len(w), 10) AS n, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS phrase FROM items
        ), sizes AS (
            SELECT DISTINCT n FROM windows
        ), places AS (
            SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS p, w FROM d, sizes WHERE len(w) >= n
        ), runs AS (
            SELECT doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') AS phrase FROM places
        ), hits AS (
            SELECT r.doc_id, r.n, r.p, v.item_id FROM runs r JOIN windows v ON r.n = v.n AND r.phrase = v.phrase
        ), covered AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM hits) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
            sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
    """,
    "op7_url_rules": r"""
        WITH urls AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), rules(action, rule, rule_host, rule_path) AS (
            VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
                ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
        ), best AS (
            SELECT u.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.action, length(r.rule)) AS action
            FROM urls u JOIN rules r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
            GROUP BY u.page_id
        )
        SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.action, 'allow') AS verdict
        FROM urls u LEFT JOIN best b USING (page_id)
    """,
    "op8_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[k + 1:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 3, 1))) AS k FROM d WHERE len(w) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), met AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
        ), edges AS (
            SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM d
            UNION
            SELECT e.y, r.root FROM reach r JOIN edges e ON e.x = r.doc_id
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id
        FROM d JOIN reach r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
    """,
}
