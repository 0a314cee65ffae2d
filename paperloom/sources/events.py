"""Event sources: Kafka topics in production, files with the same columns elsewhere; one JSON contract for both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.schemas import ACTION_TOPIC, INGEST_TOPIC, struct

ENVELOPE = struct(key="string", value="string", topic="string", timestamp="timestamp")
CORRUPT = "_corrupt"


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], **options: str) -> DataFrame:
    """A Kafka subscription from the earliest offset as (key, value, topic, timestamp)."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp"
    )


def ingest_stream(spark: SparkSession, servers: str, **options: str) -> DataFrame:
    return kafka_stream(spark, servers, [INGEST_TOPIC], **options)


def extracted_stream(spark: SparkSession, servers: str, **options: str) -> DataFrame:
    """The union of the three routed topics; `topic` tells them apart."""
    return kafka_stream(spark, servers, list(ACTION_TOPIC.values()), **options)


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = ENVELOPE, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def union_topics(streams: dict[str, DataFrame]) -> DataFrame:
    out = None
    for topic, df in streams.items():
        tagged = df.withColumn("topic", F.lit(topic))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add `event` (struct) and `parse_error` (null if the value is a JSON object of the contract's shape)."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(value, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.withColumn("__p", parsed)
    broken = F.col("__p").isNull() | F.col(f"__p.{CORRUPT}").isNotNull()
    event = F.struct(*[F.col(f"__p.{f}").alias(f) for f in schema.fieldNames()])
    return (
        out.withColumn("parse_error", F.when(broken, "invalid JSON for the event contract"))
        .withColumn("event", F.when(~broken, event)).drop("__p")
    )


def missing_fields(event: Column, required: list[str]) -> Column:
    """Required paths (`a` or `a.b`) that are null, as an array of names."""
    def path(name: str) -> Column:
        c = event
        for part in name.split("."):
            c = c[part]
        return c

    return F.array_compact(F.array(*[F.when(path(n).isNull(), F.lit(n)) for n in required]))


INGESTED_REQUIRED = [
    "event_id", "email.message_id", "email.subject", "email.sender", "email.received_at", "email.idempotency_key", "content.raw_text",
    "content.raw_text_hash", "security.pii_redacted", "security.source_domain_verified",
]
EXTRACTED_REQUIRED = [
    "extraction_id", "event_id", "idempotency_key", "contract_version", "routing_decision", "extraction_result", "enriched_context",
    "content_reference",
]


def read_contract(df: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    """Add `event` and `reason` to messages (`key`, `value`, ...); `reason` is null for messages that follow the contract."""
    parsed = parse_json(df, schema)
    missing = F.when(F.col("parse_error").isNull(), missing_fields(F.col("event"), required))
    checked = parsed.withColumn("missing", missing)
    absent = F.when(F.size("missing") > 0, F.concat(F.lit("missing fields: "), F.array_join("missing", ", ")))
    reason = F.concat(F.lit("schema_validation_failed: "), F.coalesce("parse_error", absent))
    return checked.withColumn("reason", reason).drop("parse_error", "missing")
