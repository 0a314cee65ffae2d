"""A stored inverted index over whole texts, and exact top-k search that skips blocks.

Documents are cut into blocks of about `block_docs` texts of similar length. A row of the index is one term in one block: how many of
the block's documents have it, its largest number of occurrences in one of them, and the occurrences. No row grows with the
collection, however frequent the term is. A query first reads the narrow columns, which bound what any document of a block can score.
It ranks the most promising blocks, and then only those whose bound reaches the k-th score found: the others hold no better document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.english import positioned, stem
from paperloom.operators.text_search import PLAIN_WEIGHT, cover_rank, matches, plain_queries, top_per_query, web_queries
from paperloom.session import cut_lineage

BLOCK_DOCS = 1024
BUCKETS = 64
BLOCK_BYTES = 16 << 20
"""Bytes of text in a block, and in a task that indexes blocks."""
FEW_WORDS = 1_000_000
_WORD = ("query_id", "grp", "item", "negated", "offset", "n_words", "needed_items", "term")


def blocked(docs: DataFrame, key: str, text: str, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(key, text, block): texts whose lengths are within a factor of the square root of two, dealt into blocks by a hash of the key."""
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    rows = rows.withColumn("__band", F.floor(2 * F.log2(F.octet_length("__text") + 1)).cast("bigint"))
    sizes = rows.groupBy("__band").agg(F.count("*").alias("__size"), F.sum(F.octet_length("__text")).alias("__bytes"))  # at most 62 rows
    parts = F.greatest(F.ceil(F.col("__size") / block_docs), F.ceil(F.col("__bytes") / BLOCK_BYTES)).cast("bigint")
    block = F.col("__band") * (1 << 40) + F.pmod(F.xxhash64(key), parts)
    return rows.join(F.broadcast(sizes), "__band").select(key, "__text", block.alias("block"))


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", stemmed: bool = False, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(bucket, term, block, df, max_tf, docs array<struct<key, positions>>). Null texts are empty; keys are distinct and not null.

    One shuffle, of the texts by block, in tasks of about `BLOCK_BYTES`: their words, many times larger, are grouped where they arise. A
    stemmed index shuffles the words, too."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES))
    texts = blocked(docs, key, text, block_docs).repartition(tasks, "block")
    words = texts.select(F.col(key).alias("key"), "block", F.explode(positioned(F.col("__text"), PLAIN_WEIGHT)).alias("w"))
    words = words.select("key", "block", "w.term", "w.pos")
    words = stem(words) if stemmed else words
    per_doc = words.groupBy("term", "block", "key").agg(F.sort_array(F.collect_list("pos")).alias("positions"))
    rows = per_doc.groupBy("term", "block").agg(
        F.count("*").alias("df"), F.max(F.size("positions")).cast("bigint").alias("max_tf"), F.sort_array(F.collect_list(F.struct("key", "positions"))).alias("docs"),
    )
    return rows.select(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("bucket"), "term", "block", "df", "max_tf", "docs")


def write_index(index: DataFrame, path: str) -> None:
    """One folder a bucket of terms, sorted by term and block, so that a search opens the folders of its words and their row groups."""
    index.repartition("bucket", F.pmod(F.xxhash64("block"), F.lit(8))).sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def of_words(index: DataFrame, words: DataFrame) -> DataFrame:
    """Index rows of query words. The bucket stands in the join, so that Spark prunes a stored index to the folders of these words. Unless
    there are very many, the words go to the index: the other way round, the whole index would be shuffled in each join."""
    asked = words.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int"))
    few = asked.limit(FEW_WORDS + 1).count() <= FEW_WORDS
    return index.join(F.broadcast(asked) if few else asked, ["bucket", "term"])


def candidate_blocks(index: DataFrame, words: DataFrame) -> DataFrame:
    """(query_id, block, bound): the blocks that can hold a hit, and no rank in them is larger than the bound.

    The k-th cover of a group of m words begins at an occurrence of its rarest word or at one of the m - 1 others' last before it, so
    a document has at most m covers for each occurrence of that word; a cover weighs at most one word's weight."""
    asked = words.filter(~F.col("negated")).select("query_id", "grp", "term").distinct()
    size = asked.groupBy("query_id", "grp").agg(F.count("*").alias("m"))
    heads = of_words(index, asked).select("query_id", "grp", "block", "max_tf")
    groups = heads.groupBy("query_id", "grp", "block").agg(F.count("*").alias("have"), F.min("max_tf").alias("tf"))
    whole = groups.join(size, ["query_id", "grp"]).filter(F.col("have") == F.col("m"))
    return whole.groupBy("query_id", "block").agg((F.sum(F.col("m") * F.col("tf")) * PLAIN_WEIGHT).alias("bound"))


def found_in(index: DataFrame, words: DataFrame, blocks: DataFrame) -> DataFrame:
    """Occurrences of query words in the given (query_id, block)."""
    rows = of_words(index, words).select(*_WORD, "block", "docs").join(blocks.select("query_id", "block"), ["query_id", "block"], "left_semi")
    docs = rows.select(*_WORD, F.explode("docs").alias("d"))
    return docs.select(*_WORD, F.col("d.key").alias("paper_id"), F.explode("d.positions").alias("pos"), F.lit(PLAIN_WEIGHT).alias("weight"))


def ranked_in(index: DataFrame, words: DataFrame, blocks: DataFrame) -> DataFrame:
    found = cut_lineage(found_in(index, words, blocks))
    return cover_rank(found, words, matches(found)).select("query_id", "paper_id", F.round("rank", 9).alias("rank"))


def totals(index: DataFrame, words: DataFrame, candidates: DataFrame) -> DataFrame:
    """(query_id, total) of all hits. A query of a single word needs only the stored numbers of documents; others are matched whole."""
    shape = words.groupBy("query_id").agg(F.count("*").alias("n"), F.bool_or("negated").alias("less"))
    single = shape.filter((F.col("n") == 1) & ~F.col("less")).select("query_id")
    stored = of_words(index, words.join(single, "query_id", "left_semi"))
    counted = stored.groupBy("query_id").agg(F.sum("df").alias("total"))
    others = words.join(single, "query_id", "left_anti")
    hits = matches(found_in(index, others, candidates))
    return counted.unionByName(hits.groupBy("query_id").agg(F.count("*").alias("total")))


def top_documents(index: DataFrame, queries: DataFrame, limit: int = 20, web: bool = True, stemmed: bool = False, first_blocks: int = 2) -> tuple[DataFrame, DataFrame]:
    """The best `limit` documents of each query (query_id, paper_id, rank, position, total), the same as without an index, and the blocks
    (query_id, block, bound, read) with whether they were read to rank. Ties go to the smaller key."""
    words = cut_lineage((web_queries if web else plain_queries)(queries, stemmed))
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    candidates = cut_lineage(candidate_blocks(index, words).withColumn("turn", F.row_number().over(by_bound)))
    early = cut_lineage(ranked_in(index, words, candidates.filter(F.col("turn") <= first_blocks)))
    least = top_per_query(early, limit).filter(F.col("position") == limit).select("query_id", F.col("rank").alias("least"))
    reach = F.col("least").isNull() | (F.col("bound") >= F.col("least") - 1e-9)
    judged = cut_lineage(candidates.join(least, "query_id", "left").withColumn("read", (F.col("turn") <= first_blocks) | reach))
    late = ranked_in(index, words, judged.filter(F.col("read") & (F.col("turn") > first_blocks)))
    page = top_per_query(early.unionByName(late), limit)
    return page.join(totals(index, words, candidates), "query_id"), judged.select("query_id", "block", "bound", "read")
