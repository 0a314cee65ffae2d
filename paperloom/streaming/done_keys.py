"""The keys that a stage is done with, as runs of key buckets, of which a batch reads only its own.

Batch n writes its keys as the run [n, n]. After every FAN batches their runs are merged into one of the next level, after FAN of those
again, so the keys before batch n are in at most (FAN - 1) runs a level, and which runs these are follows from n alone: nothing is
listed, and what a failed attempt left behind is either overwritten by its replay or never read. A key lies in one of BUCKETS folders
of its run; a batch opens the folders its own keys fall into. Files have their keys in order, so that row groups can be skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
FAN = 8
_RUN = "key string, level int, first bigint, bucket int"


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def runs_before(batch_id: int) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that together hold the batches 0 to batch_id - 1."""
    runs, at = [], 0
    while at < batch_id:
        level = 0
        while at % FAN ** (level + 1) == 0 and at + FAN ** (level + 1) <= batch_id:
            level += 1
        runs.append((level, at))
        at += FAN**level
    return runs


def _read(spark: SparkSession, path: str, runs: list[tuple[int, int]]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], _RUN)
    return spark.read.schema(_RUN).option("basePath", path).parquet(*[_folder(path, *run) for run in runs])


def _folder(path: str, level: int, first: int) -> str:
    return f"{path}/level={level}/first={first}"


def _write(keys: DataFrame, path: str, level: int, first: int) -> None:
    rows = keys.select("key", bucket_of(F.col("key")).alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "key")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(_folder(path, level, first))


def add(keys: DataFrame, path: str, batch_id: int) -> None:
    """Write the keys (`key`) of a batch, and merge the runs that it completes. Null keys are none. Call it before the batch is marked
    complete; a replay writes the same files again."""
    spark = keys.sparkSession
    _write(keys.select("key").filter("key is not null").distinct(), path, 0, batch_id)
    level, end = 1, batch_id + 1
    while end % FAN**level == 0:
        first, step = end - FAN**level, FAN ** (level - 1)
        _write(_read(spark, path, [(level - 1, first + i * step) for i in range(FAN)]).select("key").distinct(), path, level, first)
        level += 1


def seen(spark: SparkSession, path: str, batch_id: int, keys: DataFrame) -> DataFrame:
    """The keys of earlier batches that lie in the buckets of `keys` (`key`): a superset of those of `keys` that are done."""
    own = [r["bucket"] for r in keys.filter("key is not null").select(bucket_of(F.col("key")).alias("bucket")).distinct().collect()]
    return _read(spark, path, runs_before(batch_id)).filter(F.col("bucket").isin(own)).select("key")
