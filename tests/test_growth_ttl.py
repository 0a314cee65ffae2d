"""Groups and state of the TTL gate."""

from datetime import datetime, timedelta

from paperloom.operators.dedup import ttl_accepted
from paperloom.sources.events import file_stream
from paperloom.streaming import gates


def test_ttl_gate_keeps_one_state_a_bucket(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(k, None if k % 9 == 0 else 2**60 + k % 40, "ab"[k % 2], start + timedelta(seconds=37 * k)) for k in range(400)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, event_type string, ts timestamp")
    for part in range(2):
        df.filter(f"id div 200 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    gates.use_rocksdb(spark)
    stream = file_stream(spark, str(tmp_path / "in"), schema=df.schema, files_per_trigger=1)
    gated = gates.ttl_gate(stream, ["k", "event_type"], "ts", "id", 3000, buckets=4)
    query = gated.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        run = query.start(str(tmp_path / "out"))
        run.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress) <= 4
    want = {r["id"] for r in ttl_accepted(df, ["k", "event_type"], "ts", "id", 3000).collect()}
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["id"] for r in got} == want and len(got) == len(want)
    assert all(tuple(r) == rows[r["id"]] for r in got)
