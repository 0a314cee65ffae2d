"""Reciprocal rank fusion of keyword and semantic result lists, for a batch of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.text_search import headline, keyword_search, top_per_query, web_queries
from paperloom.operators.vector_search import semantic_search
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings


def fuse(keyword: DataFrame, semantic: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Fuse ranked lists (`query_id`, `paper_id`, `position`): raw and normalised score, dominant mode, fused position.

    A paper's score is the sum of 1 / (k + position) over the lists it is in, divided by the best score of its query. The
    keyword side dominates only if strictly better placed. Ties go to the smaller id.
    """
    kw = keyword.select("query_id", "paper_id", F.col("position").alias("keyword_position"))
    sem = semantic.select("query_id", "paper_id", F.col("position").alias("semantic_position"))
    k = settings.rrf_k

    def share(position: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(k) + F.col(position)), F.lit(0.0))

    merged = kw.join(sem, ["query_id", "paper_id"], "full_outer").withColumn(
        "fused_score", share("keyword_position") + share("semantic_position")
    )
    best = F.max("fused_score").over(Window.partitionBy("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("fused_score"), F.asc("paper_id"))
    keyword_better = F.col("keyword_position").isNotNull() & (
        F.col("semantic_position").isNull() | (F.col("keyword_position") < F.col("semantic_position"))
    )
    return (
        merged.withColumn("relevance_score", F.col("fused_score") / best)
        .withColumn("dominant_mode", F.when(keyword_better, "keyword").otherwise("semantic"))
        .withColumn("position", F.row_number().over(order).cast("bigint"))
    )


def hybrid_search(
    papers: DataFrame, queries: DataFrame, limit: int = 20, offset: int = 0, stemmed: bool = True,
    settings: Settings = DEFAULTS, digits: int = 12, index: DataFrame | None = None, pool: int | None = None, **filters,
) -> DataFrame:
    """Keyword and semantic search of the same queries (`query_id`, `query_text`, `embedding`), fused.

    All hits of both lists are fused, so `total` counts every paper found and every page can be reached. A caller who wants less
    work for first pages sets `pool`: each list is then cut to that many rows before. The keyword half sees papers without a vector.
    """
    keyword = cut_lineage(keyword_search(papers, queries, limit=pool, stemmed=stemmed, index=index, **filters))
    semantic = cut_lineage(semantic_search(
        papers, queries, threshold=settings.hybrid_semantic_threshold, limit=pool, settings=settings, digits=digits, **filters
    ))
    fused = cut_lineage(fuse(keyword, semantic, settings))
    totals = fused.groupBy("query_id").agg(F.count("*").alias("total"))
    page = fused.filter(F.col("position").between(offset + 1, offset + limit))
    return page.join(totals, "query_id")


def shape_results(page: DataFrame, papers: DataFrame, words: DataFrame, mode: str, stemmed: bool = True) -> DataFrame:
    """Attach paper columns and highlights to a result page.

    Scores are clamped to [0, 1], authors keep name and affiliation only, and only rows with a keyword match get a
    highlight. `page` is small; the papers side is reduced to it by the join.
    """
    columns = [c for c in ("title", "venue", "year", "doi", "paper_type", "status", "overall_confidence", "created_at") if c in papers.columns]
    rows = page.join(papers.select("paper_id", *columns, *(["authors"] if "authors" in papers.columns else [])), "paper_id")
    if "authors" in papers.columns:
        fields = {f.name for f in papers.schema["authors"].dataType.elementType.fields}
        rows = rows.withColumn("authors", F.transform("authors", lambda a: F.struct(
            a["name"].alias("name"),
            (a["affiliation"] if "affiliation" in fields else F.lit(None).cast("string")).alias("affiliation"),
        )))
    clamped = F.greatest(F.least(F.col("relevance_score"), F.lit(1.0)), F.lit(0.0))
    rows = rows.withColumn("relevance_score", clamped).withColumn("search_mode", F.lit(mode))
    if mode == "semantic":
        return rows.withColumn("highlight_snippet", F.lit(None).cast("string"))
    marked = headline(rows, words, stemmed=stemmed)
    if mode == "hybrid":
        return marked.withColumn("highlight_snippet", F.when(F.col("keyword_position").isNotNull(), F.col("highlight_snippet")))
    return marked


def search_batch(
    papers: DataFrame, requests: DataFrame, limit: int = 20, stemmed: bool = True, settings: Settings = DEFAULTS, **filters
) -> DataFrame:
    """A table of search requests (`query_id`, `mode`, `query_text`, `embedding`) to one table of shaped result rows."""
    def of(mode: str) -> DataFrame:
        return requests.filter(F.col("mode") == mode)

    keyword = cut_lineage(keyword_search(papers, of("keyword"), limit=limit, stemmed=stemmed, **filters))
    keyword = keyword.withColumnRenamed("rank", "relevance_score")
    semantic = cut_lineage(semantic_search(papers, of("semantic"), limit=limit, settings=settings, **filters))
    semantic = semantic.withColumnRenamed("similarity", "relevance_score")
    hybrid = hybrid_search(papers, of("hybrid"), limit=limit, stemmed=stemmed, settings=settings, **filters)
    words = web_queries(requests, stemmed)
    parts = [
        shape_results(page, papers, words, mode, stemmed)
        for page, mode in ((keyword, "keyword"), (semantic, "semantic"), (hybrid, "hybrid"))
    ]
    shown = [
        "query_id", "search_mode", "position", "paper_id", "relevance_score", "highlight_snippet", "total",
        *[c for c in ("title", "venue", "year") if c in papers.columns],
    ]
    out = parts[0].select(*shown)
    for part in parts[1:]:
        out = out.unionByName(part.select(*shown))
    return out
