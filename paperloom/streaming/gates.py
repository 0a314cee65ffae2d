"""Stateful stream gates: TTL duplicates and the sliding-log rate limiter."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store keeps key state on local disk and its change log in the checkpoint, which survives executors."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


GATE_BUCKETS = 4096
NO_TIME = 2**63 - 1


def _in_time_order(batches: Iterator[pd.DataFrame], ts: str, row_id: str) -> pd.DataFrame:
    return pd.concat(list(batches), ignore_index=True).sort_values([ts, row_id], kind="stable")


def accept_once_per_ttl(columns: list[str], row_id: str, ttl_seconds: int, number_ids: bool):
    """Accept a key's first row, refuse the others until the TTL since the last accepted row is over.

    Called once for a bucket of keys: a call of its own for each key would cost more than the few rows that most keys have. The state
    of a bucket is its keys, the time of each one's last accepted row, and when that is forgotten."""

    def run(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        known = {k: (micros, ends) for k, micros, ends in zip(*state.get) if ends > now} if state.exists else {}
        keep = []
        if not state.hasTimedOut:
            frame = pd.concat(list(frames), ignore_index=True)
            frame["__id"] = pd.Series([None if v is None else int(v) for v in frame[row_id]], dtype=object) if number_ids else frame[row_id]
            frame = frame.sort_values(["__micros", "__id"], kind="stable")
            for at, (key, value) in enumerate(zip(frame["__key"].tolist(), frame["__micros"].tolist())):
                if value == NO_TIME:
                    value = -(2**63)
                last = known.get(key)
                if last is None or value >= last[0] + ttl_seconds * 1_000_000:
                    known[key] = (value, now + ttl_seconds * 1000)
                    keep.append(at)
        if known:
            state.update((list(known), [v for v, _ in known.values()], [e for _, e in known.values()]))
            state.setTimeoutDuration(max(1, min(e for _, e in known.values()) - now))
        elif state.exists:
            state.remove()
        if keep:
            yield frame.iloc[keep][columns]

    return run


class SlidingLog(StatefulProcessor):
    """Count each row's attempts in (t - window, t]; the state holds the times still inside the window."""

    def __init__(self, ts: str, row_id: str, window_seconds: int, limit: int, columns: list[str]):
        self.ts, self.row_id, self.limit, self.columns = ts, row_id, limit, columns
        self.window_seconds = window_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.log = handle.getListState("attempts", T.StructType([T.StructField("micros", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        width = self.window_seconds * 1_000_000
        frame = _in_time_order(rows, self.ts, self.row_id)
        micros = frame[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        earlier = sorted(t[0] for t in self.log.get()) if self.log.exists() else []
        times = pd.Index([*earlier, *micros.tolist()]).sort_values()
        # rows with the same time see each other, as in the batch form
        counts = times.searchsorted(micros, side="right") - times.searchsorted(micros - width, side="right")
        self.log.put([(int(t),) for t in times[times > int(micros.max()) - width]])
        out = frame[self.columns].copy()
        out["attempts"] = counts
        out["allowed"] = counts <= self.limit
        out["remaining"] = (self.limit - counts).clip(min=0)
        yield out

    def close(self) -> None:
        pass


def ttl_gate(stream: DataFrame, keys: list[str], ts: str, row_id: str, ttl_seconds: int, buckets: int = GATE_BUCKETS) -> DataFrame:
    """Accepted rows of a stream. Rules run on event time; the state itself expires by the same TTL.

    A key's rows of one micro-batch are sorted in one task, with those of the other keys of its bucket, so limit the batch (files or
    offsets per trigger). Where single keys are too hot for that, `jobs.run_ttl_gate` gives the same result without keyed state.
    """
    # Whole numbers travel as text: in a frame, one null turns a column of them into floating point.
    whole = {f.name for f in stream.schema if isinstance(f.dataType, T.IntegralType)}
    as_sent = [F.col(c).cast("string").alias(c) if c in whole else F.col(c) for c in stream.columns]
    marks = stream.select("*", F.to_json(F.struct(*keys)).alias("__key"), F.coalesce(F.unix_micros(ts), F.lit(NO_TIME)).alias("__micros"))
    marks = marks.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)))
    marks = marks.select(*as_sent, "__key", "__micros", "__bucket")
    run = accept_once_per_ttl(stream.columns, row_id, ttl_seconds, row_id in whole)
    state = "keys array<string>, micros array<bigint>, ends array<bigint>"
    accepted = marks.groupBy("__bucket").applyInPandasWithState(run, stream.select(*as_sent).schema, state, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return accepted.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stream.schema])


def rate_gate(stream: DataFrame, keys: list[str], ts: str, row_id: str, limit: int = 5, window_seconds: int = 60) -> DataFrame:
    extra = [T.StructField("attempts", T.LongType()), T.StructField("allowed", T.BooleanType()), T.StructField("remaining", T.LongType())]
    schema = T.StructType([*stream.schema.fields, *extra])
    processor = SlidingLog(ts, row_id, window_seconds, limit, stream.columns)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "None")


def run_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available into files, then stop.

    Processing-time state asks for another batch after every batch, so batches without data are switched off for this run;
    otherwise it would never end.
    """
    spark, setting = stream.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        query = (
            stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start(path)
        )
    finally:
        spark.conf.set(setting, before)
    query.awaitTermination()


def event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))
