"""Parallel work of the routing stream."""

from pyspark.sql import functions as F

from paperloom.plans.stream_queries import replay
from paperloom.session import scratch_path


def test_a_replayed_batch_is_several_files(spark):
    messages = spark.range(200).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), F.lit("t").alias("topic"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    stream, sizes = replay(spark, messages.unionByName(messages), "growth"), []

    def each(batch, _):
        keys = batch.groupBy("key").count()
        sizes.append((len(batch.inputFiles()) or batch.rdd.getNumPartitions(), keys.count(), keys.filter("count = 2").count()))

    stream.writeStream.foreachBatch(each).option("checkpointLocation", scratch_path(spark, "growth-ck")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == 3 and all(files > 1 and keys == twice for files, keys, twice in sizes) and sum(k for _, k, _ in sizes) == 200
