"""Outputs: routed events, dead letters, attachments, exports, report files and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.columns import dated_key, html_escape
from paperloom.operators.facets import export_rows
from paperloom.operators.reports import REPORT_COLUMNS, html_lines


def event_records(events: DataFrame, topic: str = "target_topic", key: str = "idempotency_key", extra: Sequence[str] = ()) -> DataFrame:
    """(topic, key, value) for a sink that routes per row; every column but topic and `extra` goes into the JSON value."""
    payload = [c for c in events.columns if c != topic and c not in extra]
    return events.select(
        F.col(topic).alias("topic"), F.col(key).alias("key"), F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("value"), *extra
    )


def write_events_kafka(records: DataFrame, servers: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_events_files(records: DataFrame, path: str, mode: str = "append") -> None:
    """File form of the routed topics: one folder per topic."""
    records.withColumnRenamed("topic", "target_topic").write.mode(mode).partitionBy("target_topic").parquet(path)


def attachment_paths(messages: DataFrame, prefix: str = "attachments") -> DataFrame:
    """One row per attachment with the key it is stored under."""
    rows = messages.select("message_id", "idempotency_key", "received_at", F.explode("attachments").alias("a"))
    key = dated_key(prefix, F.col("received_at"), F.col("idempotency_key"), F.col("a.filename"))
    return rows.select("message_id", "idempotency_key", "received_at", "a.*", key.alias("s3_key"))


def write_attachments(messages: DataFrame, path: str, prefix: str = "attachments") -> None:
    """Attachment bytes with their keys, in date folders."""
    rows = attachment_paths(messages, prefix).withColumn("day", F.date_format("received_at", "yyyy-MM-dd"))
    rows.write.mode("append").partitionBy("day").parquet(f"{path}/{prefix}")


def write_quarantine(messages: DataFrame, reason: Column, path: str) -> None:
    """Withheld attachments with the reason, in the same layout below `quarantine`."""
    rows = attachment_paths(messages.withColumn("attachments", F.col("attachments")), "quarantine")
    rows.withColumn("reason", reason).withColumn("day", F.date_format("received_at", "yyyy-MM-dd")).write.mode("append").partitionBy("day").parquet(f"{path}/quarantine")


def export_ndjson(papers: DataFrame, path: str, limit: int | None = None, **filters) -> None:
    export_rows(papers, limit, **filters).write.mode("overwrite").json(path)


def export_csv(papers: DataFrame, path: str, limit: int | None = None, **filters) -> None:
    """The 11-column CSV with header; missing text stays an empty cell."""
    writer = export_rows(papers, limit, **filters).write.mode("overwrite")
    writer.option("header", "true").option("emptyValue", "").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def write_report_csv(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report cells as CSV below `report_id=...` folders, in report order within each file.

    Range partitioning by report order gives a large report several ordered files instead of one task. `mode`: `overwrite` the whole
    folder, `replace` only the reports in `cells`, or `append` parts.
    """
    order = ["report_id", F.desc("Year"), F.asc("Title"), F.asc("paper_id")]
    shaped = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    shaped.select("report_id", *[F.col(f"`{c}`") for c in REPORT_COLUMNS]).write.mode("append" if mode == "append" else "overwrite").option(
        "partitionOverwriteMode", "dynamic" if mode == "replace" else "static"
    ).partitionBy("report_id").option("header", "true").csv(path)


def report_parts(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, part, size_bytes, checksum_sha256) of every file that a report writer left below `path`, from the files' bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select(
        F.regexp_extract("path", "/report_id=([^/]+)/", 1).alias("report_id"), F.regexp_extract("path", "[^/]+$", 0).alias("part"),
        F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("checksum_sha256"),
    )


def report_checksums(parts: DataFrame) -> DataFrame:
    """(report_id, checksum_sha256): one hash a report, over its parts' names and hashes in order. The parts of a report are few."""
    lines = F.sort_array(F.collect_list(F.concat_ws(" ", "part", "checksum_sha256")))
    return parts.groupBy("report_id").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("checksum_sha256"))


def verify_reports(spark: SparkSession, path: str, recorded: DataFrame) -> DataFrame:
    """(report_id, checksum_sha256, event_type) of every recorded report: VERIFIED if the files below `path` still have the recorded
    hash, MISMATCH if they changed or are gone."""
    now = report_checksums(report_parts(spark, path)).withColumnRenamed("checksum_sha256", "actual")
    same = F.coalesce(F.col("actual") == F.col("checksum_sha256"), F.lit(False))
    joined = recorded.select("report_id", "checksum_sha256").join(now, "report_id", "left")
    return joined.select("report_id", "checksum_sha256", F.when(same, "VERIFIED").otherwise("MISMATCH").alias("event_type"))


def write_report_html(cells: DataFrame, manifest: DataFrame, path: str) -> None:
    """Page form: a heading line per report, one line per paper, in order, below `report_id=...` folders."""
    rows = html_lines(cells).select("report_id", F.lit(1).alias("section"), "Year", "Title", "paper_id", "line")
    text = F.concat(
        F.lit("<h1>"), html_escape(F.col("department_code")), F.lit(" "), F.col("academic_year"), F.lit("</h1><p>Papers: "),
        F.col("total_papers").cast("string"), F.lit(", journal: "), F.col("journal_count").cast("string"), F.lit(", conference: "),
        F.col("conference_count").cast("string"), F.lit("</p>"),
    )
    heads = manifest.filter(F.col("status") == "COMPLETED").select(
        "report_id", F.lit(0).alias("section"), F.lit(None).cast("int").alias("Year"), F.lit(None).cast("string").alias("Title"),
        F.lit(None).cast(cells.schema["paper_id"].dataType).alias("paper_id"), text.alias("line"),
    )
    order = ["report_id", "section", F.desc("Year"), F.asc("Title"), F.asc("paper_id")]
    lines = heads.unionByName(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("report_id", "line").write.mode("overwrite").partitionBy("report_id").text(path)
