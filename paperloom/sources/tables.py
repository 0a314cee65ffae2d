"""Scans of the stored tables with their declared schemas, and of report files as bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import schemas

TABLES: dict[str, T.StructType] = {
    "papers": schemas.PAPERS, "validation_issues": schemas.ISSUES, "paper_versions": schemas.VERSIONS,
    "audit_log": schemas.AUDIT_LOG, "generated_reports": schemas.REPORTS, "report_checksums": schemas.CHECKSUMS,
    "users": schemas.USERS,
}
# Layout: papers prune by the filters searches and reports use; logs prune by month.
PARTITIONS = {"papers": ["department_code", "year"], "paper_versions": ["month"], "audit_log": ["month"]}
_MONTH_OF = {"paper_versions": "changed_at", "audit_log": "logged_at"}


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    schema = TABLES[name]
    if name in _MONTH_OF:
        schema = T.StructType([*schema.fields, T.StructField("month", T.StringType())])
    return spark.read.schema(schema).parquet(f"{base}/{name}")


def write_table(df: DataFrame, base: str, name: str, mode: str = "append") -> None:
    """Append to a stored table in its partition layout. Rows are first shuffled on the partition columns plus a small salt,
    so files stay few and a busy partition is still written by several tasks."""
    month = _MONTH_OF.get(name)
    out = df.withColumn("month", F.date_format(month, "yyyy-MM")) if month else df
    parts = PARTITIONS.get(name)
    if parts:
        out = out.repartition(*parts, F.pmod(F.xxhash64(df.columns[0]), F.lit(8)))
    writer = out.write.mode(mode)
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{base}/{name}")


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, content) of every file below `path`."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content")


def report_file_id(path_column: str = "path"):
    """The `report_id=...` segment of a report file's path."""
    return F.regexp_extract(path_column, r"report_id=([^/]+)/", 1)
