"""Counts, listings, keyset paging and exports over the papers table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.text_search import facet_filters

EXPORT_COLUMNS = [
    "paper_id", "title", "venue", "year", "doi", "paper_type", "faculty_email", "department_code", "status",
    "overall_confidence", "created_at",
]


def confidence_bucket(c: Column) -> Column:
    """A missing confidence counts in the last bucket."""
    return F.when(c < 0.5, "0.0-0.5").when(c < 0.7, "0.5-0.7").when(c < 0.9, "0.7-0.9").otherwise("0.9-1.0")


def confidence_band(c: Column) -> Column:
    return F.when(c >= 0.85, "high").when(c >= 0.7, "mid").otherwise("low")


def facet_counts(papers: DataFrame, status: str = "PUBLISHED") -> DataFrame:
    """(facet, value, n) for year, type and confidence bucket from a single scan and one partial aggregation."""
    scope = papers.filter(F.col("status") == status).select(
        F.col("year").cast("string").alias("year"), "paper_type",
        confidence_bucket(F.col("overall_confidence")).alias("confidence"),
    )
    sets = [[F.col("year")], [F.col("paper_type")], [F.col("confidence")]]
    counted = scope.groupingSets(sets, "year", "paper_type", "confidence").agg(
        F.count("*").alias("n"), F.grouping_id().alias("gid")
    )
    facet = F.when(F.col("gid") == 3, "year").when(F.col("gid") == 5, "paper_type").otherwise("confidence")
    value = F.when(F.col("gid") == 3, F.col("year")).when(F.col("gid") == 5, F.col("paper_type")).otherwise(F.col("confidence"))
    return counted.select(facet.alias("facet"), value.alias("value"), "n")


def status_total(facets: DataFrame) -> DataFrame:
    """Total per status, taken from the year counts instead of another scan."""
    return facets.filter(F.col("facet") == "year").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def count_papers(papers: DataFrame, **filters) -> DataFrame:
    return facet_filters(papers, **filters).groupBy("department_code", "status").agg(F.count("*").alias("n"))


def list_papers(papers: DataFrame, limit: int | None = 50, offset: int = 0, **filters) -> DataFrame:
    """Newest first; the id breaks ties so that pages never overlap."""
    ordered = facet_filters(papers, **filters).orderBy(F.desc_nulls_first("created_at"), F.asc("paper_id"))
    ordered = ordered.offset(offset) if offset else ordered
    return ordered if limit is None else ordered.limit(limit)


def cursor_of(created_at: Column, paper_id: Column) -> Column:
    """Opaque page cursor: base64 of a small JSON object."""
    body = F.to_json(F.struct(
        paper_id.cast("string").alias("paper_id"),
        F.date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
    ))
    return F.regexp_replace(F.base64(F.encode(body, "utf-8")), "[\r\n]", "")


def cursor_fields(cursor: Column) -> Column:
    text = F.decode(F.unbase64(cursor), "utf-8")
    return F.from_json(text, "paper_id string, created_at timestamp")


def keyset_page(papers: DataFrame, cursor: str | None, limit: int = 20, **filters) -> DataFrame:
    """The page after `cursor` in newest-first order, with each row's own cursor.

    The position is a comparison on (created_at, paper_id), so a deep page costs the same as the first one.
    """
    scope = facet_filters(papers, **filters)
    if cursor:
        at = cursor_fields(F.lit(cursor))
        last_id = at["paper_id"].cast(papers.schema["paper_id"].dataType)
        scope = scope.filter(
            (F.col("created_at") < at["created_at"])
            | ((F.col("created_at") == at["created_at"]) & (F.col("paper_id") > last_id))
        )
    page = scope.orderBy(F.desc("created_at"), F.asc("paper_id")).limit(limit)
    return page.withColumn("cursor", cursor_of(F.col("created_at"), F.col("paper_id")))


def export_rows(papers: DataFrame, limit: int | None = 1000, status: str | None = "PUBLISHED", **filters) -> DataFrame:
    """The export table: newest first, 11 columns, missing text as ''; every row if `limit` is None."""
    if limit is not None and limit < 1:
        raise ValueError("the export limit must be positive, or None for all rows")
    rows = list_papers(papers, limit=limit, status=status, **filters)
    return rows.select(*EXPORT_COLUMNS).na.fill("", subset=["venue", "doi"])


def lookup_by_keys(table: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is in `keys` (ids, idempotency keys, or id + version number)."""
    on = [on] if isinstance(on, str) else on
    return table.join(keys.select(*on), on, "left_semi")
