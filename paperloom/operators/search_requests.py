"""Search requests as data: who asks, filters, page size and the place to go on from are columns of the request table.

Rights and filters are applied to (request, paper) pairs as soon as these exist, before ranks, totals and pages, so that a request
can not learn anything from papers it may not see. A request without a full context (department, role, user) finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.fusion import fuse, shape_results
from paperloom.operators.text_search import cover_rank, matches, occurrences, postings, web_queries
from paperloom.operators.vector_search import similarities
from paperloom.schemas import ACCESS_ROLES, FINALISED_OR_IN_REVIEW
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings

COLUMNS = {
    "query_text": "string", "embedding": "array<float>", "user_department": "string", "role": "string", "user_id": "string", "year": "int",
    "paper_type": "string", "department_code": "string", "status": "string", "faculty_id": "string", "min_confidence": "double", "page_size": "int", "cursor": "string",
}
"""What a request may carry besides `query_id` and `mode`; a missing column is null in every request."""
PAGE_SIZE = 20
_EXACT = ("year", "paper_type", "department_code", "faculty_id")
_PLACE = "score double, id string"


def complete(requests: DataFrame) -> DataFrame:
    """The requests with all columns, and the page's size and start."""
    have = {c.lower() for c in requests.columns}
    filled = requests.select("query_id", "mode", *[(F.col(c) if c in have else F.lit(None)).cast(requests.schema[c].dataType if c in have and c == "embedding" else kind).alias(c) for c, kind in COLUMNS.items()])
    place = F.from_json(F.unbase64("cursor").cast("string"), _PLACE)
    return filled.withColumn("page_size", F.coalesce("page_size", F.lit(PAGE_SIZE))).withColumn("place", place)


def cursor(score: Column, key: Column) -> Column:
    """Text that names a row of a ranked list: its score and id."""
    return F.base64(F.to_json(F.struct(score.alias("score"), key.cast("string").alias("id"))).cast("binary"))


def may_see() -> Column:
    """The row policy over a request's `user_department`, `role`, `user_id` and a paper's `p_` columns; see `access.paper_policy`."""
    known = F.col("role").isin(*ACCESS_ROLES) & (F.length("user_department") > 0) & (F.length("user_id") > 0)
    own_draft = (F.col("p_status") == "DRAFT") & (F.col("p_faculty_id").cast("string") == F.col("user_id"))
    own_department = (F.col("p_department_code") == F.col("user_department")) & (F.col("p_status").isin(*FINALISED_OR_IN_REVIEW) | own_draft)
    return F.coalesce(known & ((F.col("role") == "admin") | own_department), F.lit(False))


def asks_for() -> Column:
    """A request's filters; published papers unless it names another status."""
    out = F.col("p_status") == F.coalesce("status", F.lit("PUBLISHED"))
    for name in _EXACT:
        out = out & (F.col(name).isNull() | (F.col(f"p_{name}").cast("string") == F.col(name).cast("string")))
    return out & (F.col("min_confidence").isNull() | (F.col("p_overall_confidence") >= F.col("min_confidence")))


def admitted(pairs: DataFrame, papers: DataFrame, requests: DataFrame, key: str = "paper_id") -> DataFrame:
    """The rows of `pairs` (query_id, paper_id, ...) whose request may see the paper and asks for it."""
    facts = papers.select(key, *[F.col(c).alias(f"p_{c}") for c in ("status", "overall_confidence", *_EXACT)])
    asked = requests.select("query_id", "user_department", "role", "user_id", "status", "min_confidence", *_EXACT)
    return pairs.join(facts, key).join(asked, "query_id").filter(may_see() & asks_for()).select(*pairs.columns)


def placed(scored: DataFrame, score: str) -> DataFrame:
    """`scored` with each row's position in its request."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), F.asc("paper_id"))
    return scored.withColumn("position", F.row_number().over(order).cast("bigint"))


def search(papers: DataFrame, requests: DataFrame, stemmed: bool = True, settings: Settings = DEFAULTS, digits: int = 9, index: DataFrame | None = None) -> DataFrame:
    """One page of result rows for every request of `requests` (`query_id`, `mode` and any of COLUMNS).

    Rows carry `position` in the request's whole list, `total` of it, the paper's columns, a highlight where a word matched, and a
    `cursor`; the request with that cursor gives the rows behind it. `index` may be stored postings of all papers."""
    asked = cut_lineage(complete(requests))
    mode = F.col("mode")
    by_words = asked.filter(mode.isin("keyword", "hybrid"))
    words = cut_lineage(web_queries(by_words, stemmed))
    index = postings(papers, stemmed=stemmed) if index is None else index
    found = cut_lineage(admitted(occurrences(index, words), papers, asked))
    ranked = cover_rank(found, words, matches(found)).select("query_id", "paper_id", F.round("rank", digits).alias("score"))
    ranked = cut_lineage(ranked.join(asked.select("query_id", "mode"), "query_id"))
    floor = F.when(mode == "semantic", settings.semantic_threshold).otherwise(settings.hybrid_semantic_threshold)
    by_vector = asked.filter(mode.isin("semantic", "hybrid"))
    close = similarities(papers, by_vector, min(settings.semantic_threshold, settings.hybrid_semantic_threshold))
    close = admitted(close.withColumn("score", F.round("similarity", digits)).drop("similarity"), papers, asked)
    close = cut_lineage(close.join(asked.select("query_id", "mode"), "query_id").filter(F.col("score") >= floor))
    fused = fuse(placed(ranked.filter(mode == "hybrid"), "score"), placed(close.filter(mode == "hybrid"), "score"), settings)
    none = F.lit(None).cast("bigint")
    lists = (
        ranked.filter(mode == "keyword").select("query_id", "mode", "paper_id", "score", none.alias("keyword_position"))
        .unionByName(close.filter(mode == "semantic").select("query_id", "mode", "paper_id", "score", none.alias("keyword_position")))
        .unionByName(fused.select("query_id", F.lit("hybrid").alias("mode"), "paper_id", F.round("relevance_score", digits).alias("score"), "keyword_position"))
    )
    lists = cut_lineage(lists)
    totals = lists.groupBy("query_id").agg(F.count("*").alias("total"))
    paged = placed(lists, "score").join(asked.select("query_id", "page_size", "place"), "query_id")
    score, key = F.col("score"), F.col("paper_id").cast("string")
    start = F.col("place.score")
    own_kind = papers.schema["paper_id"].dataType
    behind = F.col("place").isNull() | (score < start) | ((score == start) & (F.col("paper_id") > F.col("place.id").cast(own_kind)))
    first = Window.partitionBy("query_id").orderBy("position")
    page = paged.filter(behind).withColumn("on_page", F.row_number().over(first)).filter(F.col("on_page") <= F.col("page_size"))
    page = page.select("query_id", "mode", "paper_id", F.col("score").alias("relevance_score"), "position", "keyword_position", cursor(score, key).alias("cursor"))
    page = cut_lineage(page.join(totals, "query_id"))
    parts = [shape_results(page.filter(mode == m), papers, words, m, stemmed) for m in ("keyword", "semantic", "hybrid")]
    out = parts[0].drop("mode", "keyword_position")
    for part in parts[1:]:
        out = out.unionByName(part.drop("mode", "keyword_position"))
    return out
