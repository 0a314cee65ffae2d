"""Queries over the given tables, one for each operator, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.common import table
from paperloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_hilbert_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.sharding import document_shards

    return document_shards(table(spark, sf_dir, "documents"))


@query("op10_aho_corasick_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
        FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM win),
pieces AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM d JOIN lengths ON len(w) >= n, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, item_id, n, i FROM pieces JOIN win USING (n, s)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN owners USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.decontaminate import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_karmarkar_karp_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from paperloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_warc_salvage", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY sha256(h)) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


@query("op6_compression_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_block_tree_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), carry=["page_id", "url"])


@query("op9_convolutional_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_minhash_components", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
links AS MATERIALIZED (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN component ON node = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_log_bilinear_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.lm import document_scores

    return document_scores(table(spark, sf_dir, "documents"))


@query("op4_sorted_projections", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON node = vec_id LEFT JOIN degree ON a = vec_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.embed_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op11_run_length_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.conversations import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


@query("op12_overlapping_chunk_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from paperloom.llm.bpe import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op13_bit_sliced_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paperloom.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))
