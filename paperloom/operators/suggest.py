"""Autocomplete over titles, venues and author names: bounded ordered results with frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.text_search import top_per_query


def has_prefix(c: Column, prefix: str) -> Column:
    """Case-insensitive literal prefix; `%` and `_` have no special meaning."""
    return F.startswith(F.lower(c), F.lower(F.lit(prefix)))


def _published(papers: DataFrame, column: str, prefix: str) -> DataFrame:
    return papers.filter((F.col("status") == "PUBLISHED") & has_prefix(F.col(column), prefix))


def suggest_titles(papers: DataFrame, prefix: str, limit: int = 10, distinct: bool = False) -> DataFrame:
    """One row per paper (or per title) in title order with the frequency of that title.

    Frequencies come from a partial aggregation instead of a per-title window, so one very common title does not land in
    one task; only `limit` title rows are joined back.
    """
    found = _published(papers, "title", prefix).select(F.col("title").alias("text"), "paper_id")
    counts = found.groupBy("text").agg(F.count("*").alias("frequency"))
    if distinct:
        return counts.orderBy("text").limit(limit)
    page = found.orderBy("text", "paper_id").limit(limit)
    return page.join(counts, "text").select("text", "frequency", "paper_id").orderBy("text", "paper_id")


def suggest_venues(papers: DataFrame, prefix: str, limit: int = 10) -> DataFrame:
    found = _published(papers, "venue", prefix)
    return found.groupBy(F.col("venue").alias("text")).agg(F.count("*").alias("frequency")).orderBy("text").limit(limit)


def suggest_authors(papers: DataFrame, prefix: str, limit: int = 10) -> DataFrame:
    """Counts author entries, not papers."""
    names = papers.filter(F.col("status") == "PUBLISHED").select(F.explode("authors.name").alias("text"))
    found = names.filter(has_prefix(F.col("text"), prefix))
    return found.groupBy("text").agg(F.count("*").alias("frequency")).orderBy("text").limit(limit)


def suggest_batch(papers: DataFrame, prefixes: DataFrame, limit: int = 10) -> DataFrame:
    """Distinct title suggestions for a table of prefixes (`query_id`, `prefix`): (query_id, text, frequency, position).

    Titles are counted first and then meet prefixes on their first one to three characters (as many as the prefix has), an
    equi join whose residual condition checks the whole prefix, of any length.
    """
    titles = (
        papers.filter(F.col("status") == "PUBLISHED").groupBy(F.col("title").alias("text"))
        .agg(F.count("*").alias("frequency"))
    )
    keyed = titles.withColumn("head_length", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)])))
    keyed = keyed.withColumn("head", F.lower(F.expr("substring(text, 1, head_length)")))
    wanted = (
        prefixes.filter(F.length("prefix") > 0)
        .select("query_id", F.lower("prefix").alias("prefix"), F.least(F.length("prefix"), F.lit(3)).alias("head_length"))
        .withColumn("head", F.expr("substring(prefix, 1, head_length)"))
    )
    found = keyed.join(wanted, ["head_length", "head"]).filter(F.startswith(F.lower("text"), F.col("prefix")))
    ranked = found.select("query_id", "text", "frequency", F.lit(0).alias("tie"))
    return top_per_query(ranked, limit, score="tie", key="text").drop("tie")
