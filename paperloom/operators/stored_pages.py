"""Newest-first pages from file statistics: papers written in page order, and a table of what each file holds.

Files are cut by range over (created_at descending, id), so each holds one stretch of the whole list, and a manifest row keeps the ends
of that stretch. A page opens the first file its cursor can reach; only if filters leave too few rows there, the next files follow,
twice as many each time. No other file is read, however deep the page is.

Rows without a time come last, by id, and can be reached by cursors like any others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.facets import cursor_fields, cursor_of, facet_filters
from paperloom.session import cut_lineage

ROWS_PER_FILE = 1_000_000
NAMED_FILES = 1024
"""So many files are opened by name; what is still needed then is read by time from the whole table."""
_LAST = 2**63 - 1


def place(created_at: Column, paper_id: Column) -> Column:
    """A row's place in the list; smaller is earlier."""
    return F.struct(F.coalesce(-F.unix_micros(created_at), F.lit(_LAST)).alias("age"), paper_id.alias("id"))


def write_pages(papers: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    files = max(1, -(-papers.count() // rows_per_file))
    order = [F.desc_nulls_last("created_at"), F.asc("paper_id")]
    papers.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(f"{path}/rows")
    rows = papers.sparkSession.read.parquet(f"{path}/rows").select(place(F.col("created_at"), F.col("paper_id")).alias("at"), F.col("_metadata.file_path").alias("file"))
    ends = rows.groupBy("file").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))
    ends.write.parquet(f"{path}/files")


def reachable_files(spark: SparkSession, path: str, cursor: str | None) -> DataFrame:
    """(file, first, last, n) of the files that hold rows behind `cursor`."""
    files = spark.read.parquet(f"{path}/files")
    return files if cursor is None else files.filter(F.col("last") > _cursor_place(cursor, files.schema["last"].dataType["id"].dataType))


def _cursor_place(cursor: str, id_type) -> Column:
    at = cursor_fields(F.lit(cursor))
    return place(at["created_at"], at["paper_id"].cast(id_type))


def read_page(spark: SparkSession, path: str, cursor: str | None, limit: int = 20, **filters) -> tuple[DataFrame, int]:
    """The `limit` rows behind `cursor` that pass the filters, each with its own cursor, and how many files were opened for them."""
    names = reachable_files(spark, path, cursor).orderBy("first")
    schema = spark.read.parquet(f"{path}/rows").schema
    count = 1
    while True:
        files = [r["file"] for r in names.select("file").limit(min(count, NAMED_FILES + 1)).collect()]
        everything = len(files) > NAMED_FILES
        rows = spark.read.schema(schema).parquet(*([f"{path}/rows"] if everything else files)) if files else spark.createDataFrame([], schema)
        scope = facet_filters(rows, **filters)
        if cursor is not None:
            at = cursor_fields(F.lit(cursor))
            # The first comparison reaches the scan, the second one decides.
            scope = scope.filter(at["created_at"].isNull() | F.col("created_at").isNull() | (F.col("created_at") <= at["created_at"]))
            scope = scope.filter(place(F.col("created_at"), F.col("paper_id")) > _cursor_place(cursor, schema["paper_id"].dataType))
        page = cut_lineage(scope.orderBy(F.desc_nulls_last("created_at"), F.asc("paper_id")).limit(limit))
        if everything or len(files) < count or page.count() >= limit:
            return page.withColumn("cursor", cursor_of(F.col("created_at"), F.col("paper_id"))), names.count() if everything else len(files)
        count *= 2
