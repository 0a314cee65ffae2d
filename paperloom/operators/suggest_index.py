"""Stored autocomplete: the best entries of every short prefix, and a sorted dictionary in pages for longer ones.

An entry is a distinct title, venue or author name of published papers with its frequency. For prefixes of 1 to DEPTH characters the first
`limit` entries are stored, so a request for one of them reads `limit` rows, however many entries start so. Longer prefixes are looked
up in pages of about PAGE_ROWS entries sorted by lower-case text: a page knows its first and last entry, and a request opens only the
pages whose range its prefix can lie in. Pages meet requests by page, never by first letter, so a frequent beginning is spread
over as many tasks as it has pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.operators.text_search import top_per_query

DEPTH = 4
LIMIT = 10
PAGE_ROWS = 1024
RANGE_ROWS = 65_536
KINDS = ("title", "venue", "author")


@dataclass(frozen=True)
class SuggestIndex:
    best: DataFrame
    """kind, prefix (lower case), text, frequency, position: the first entries of each short prefix in text order"""
    entries: DataFrame
    """kind, page, folded, text, frequency"""
    pages: DataFrame
    """kind, page, head, low, high: one row for each beginning of DEPTH characters that a page holds"""


def dictionary(papers: DataFrame) -> DataFrame:
    """(kind, text, frequency); authors count entries, titles and venues count papers. Missing and empty texts are no entries."""
    shown = papers.filter(F.col("status") == "PUBLISHED")
    have = [k for k in ("title", "venue") if k in papers.columns]
    texts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("text")) for k in have])
    if "authors" in papers.columns:
        names = F.transform(F.coalesce("authors", F.array().cast(papers.schema["authors"].dataType)), lambda a: F.struct(F.lit("author").alias("kind"), a["name"].alias("text")))
        texts = F.concat(texts, names)
    return shown.select(F.inline(texts)).filter(F.length("text") > 0).groupBy("kind", "text").agg(F.count("*").alias("frequency"))


def build_index(papers: DataFrame, limit: int = LIMIT, depth: int = DEPTH) -> SuggestIndex:
    folded = F.lower("text")
    words = dictionary(papers)
    # The group limit before the shuffle lets `limit` rows a prefix and task travel, so the prefix "t" is no hot key.
    starts = words.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(depth), F.length(folded)))).alias("n"))
    starts = starts.select("kind", F.substring(folded, F.lit(1), F.col("n")).alias("prefix"), "text", "frequency")
    place = Window.partitionBy("kind", "prefix").orderBy("text")
    best = starts.withColumn("position", F.row_number().over(place)).filter(F.col("position") <= limit)
    ranges = max(1, -(-words.count() // RANGE_ROWS))
    dealt = words.withColumn("folded", folded).repartitionByRange(ranges, "kind", "folded", "text").withColumn("part", F.spark_partition_id())
    in_range = Window.partitionBy("part").orderBy("kind", "folded", "text")
    entries = dealt.withColumn("page", F.col("part").cast("bigint") * 2**32 + F.floor((F.row_number().over(in_range) - 1) / PAGE_ROWS))
    entries = entries.select("kind", "page", "folded", "text", "frequency")
    return SuggestIndex(best, entries, _pages(entries, depth))


def _pages(entries: DataFrame, depth: int = DEPTH) -> DataFrame:
    by_head = entries.groupBy("kind", "page", F.substring("folded", 1, depth).alias("head"))
    return by_head.agg(F.min("folded").alias("low"), F.max("folded").alias("high"))


def write_index(index: SuggestIndex, path: str) -> None:
    """`best` is sorted by prefix and `entries` by page within their files, so that row groups can be skipped. The pages are read off
    the written entries, so that both hold the same cut."""
    index.best.repartitionByRange("kind", "prefix").sortWithinPartitions("kind", "prefix", "position").write.parquet(f"{path}/best")
    index.entries.sortWithinPartitions("page", "folded", "text").write.parquet(f"{path}/entries")
    _pages(index.entries.sparkSession.read.parquet(f"{path}/entries")).write.parquet(f"{path}/pages")


def read_index(spark: SparkSession, path: str) -> SuggestIndex:
    return SuggestIndex(*[spark.read.parquet(f"{path}/{part}") for part in ("best", "entries", "pages")])


def opened_pages(index: SuggestIndex, requests: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(query_id, kind, page, prefix): the pages that requests for prefixes longer than `depth` have to open."""
    asked = _asked(requests).filter(F.length("prefix") > depth).withColumn("head", F.substring("prefix", 1, depth))
    near = index.pages.join(asked, ["kind", "head"]).filter((F.col("high") >= F.col("prefix")) & ((F.col("low") <= F.col("prefix")) | F.startswith("low", F.col("prefix"))))
    return near.select("query_id", "kind", "page", "prefix")


def _asked(requests: DataFrame) -> DataFrame:
    kind: Column = F.col("kind") if "kind" in requests.columns else F.lit("title")
    return requests.select("query_id", kind.alias("kind"), F.lower("prefix").alias("prefix")).filter(F.length("prefix") > 0)


def suggest(index: SuggestIndex, requests: DataFrame, limit: int = LIMIT, depth: int = DEPTH) -> DataFrame:
    """The first `limit` entries in text order for every request (`query_id`, `prefix`, optionally `kind`): (query_id, text, frequency,
    position). `limit` and `depth` may be at most what the index was built with. An empty or missing prefix finds nothing."""
    asked = _asked(requests)
    short = index.best.filter(F.col("position") <= limit).join(asked, ["kind", "prefix"]).select("query_id", "text", "frequency", F.col("position").cast("bigint").alias("position"))
    found = index.entries.join(opened_pages(index, requests, depth), ["kind", "page"]).filter(F.startswith("folded", F.col("prefix")))
    ranked = found.select("query_id", "text", "frequency", F.lit(0).alias("tie"))
    return short.unionByName(top_per_query(ranked, limit, score="tie", key="text").drop("tie"))
