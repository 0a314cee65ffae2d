"""The storage stage stopped at different points and started again, and its table of done keys."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from paperloom.plans import stream_queries
from paperloom.sources.events import file_stream
from paperloom.streaming import done_keys, jobs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", range(0, 70))
def test_runs_hold_every_earlier_batch_once(n):
    held = [first + i for level, first in done_keys.runs_before(n) for i in range(done_keys.FAN**level)]
    assert held == list(range(n))
    assert len(done_keys.runs_before(n)) <= 3 * (done_keys.FAN - 1)


def test_done_keys_over_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(done_keys, "FAN", 2)
    path, all_keys = str(tmp_path / "keys"), []
    for batch in range(5):
        asked = spark.createDataFrame([(k,) for k in ["k0", "k7", "other", None]], "key string")
        got = {r.key for r in done_keys.seen(spark, path, batch, asked).collect()}
        assert {"k0", "k7"} & set(all_keys) <= got <= set(all_keys)
        own = [f"k{batch * 3 + i}" for i in range(3)] if batch != 2 else []
        for _ in range(2):  # a replay changes nothing
            done_keys.add(spark.createDataFrame([(k,) for k in [*own, *own, None]], "key string"), path, batch)
        all_keys += own
    everything = spark.createDataFrame([(k,) for k in all_keys], "key string")
    assert sorted(r.key for r in done_keys.seen(spark, path, 5, everything).collect()) == sorted(all_keys)
    few = done_keys.seen(spark, path, 5, everything.filter("key = 'k0'"))
    assert "k0" in [r.key for r in few.collect()] and few.count() < len(all_keys)
    # The bucket is a condition on folders: other buckets' files are not opened.
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def rows_of(spark, base):
    return {name: sorted(map(str, jobs.read_output(spark, base, name).collect())) for name in ("papers", "issues", "versions", "audit", "rejected", "skipped")}


def test_a_stopped_stage_gives_the_same_rows(spark, tmp_path, monkeypatch):
    messages = stream_queries.extracted_messages(spark, SF).limit(60)
    topic = str(tmp_path / "topic")
    for part in range(2):  # the second file repeats half of the first
        messages.filter(F.pmod(F.xxhash64("value"), F.lit(4)).isin([0, 1] if part == 0 else [1, 2, 3])).coalesce(1).write.mode("append").parquet(topic)

    def run(name):
        stream = file_stream(spark, topic, files_per_trigger=1)
        jobs.run_stage(stream, stream_queries.store_stage, jobs.split_stored, str(tmp_path / name), str(tmp_path / f"{name}-cp"), "papers", "ingestion_idempotency_key")

    run("whole")
    stops = {"after the outcomes": 1, "after the keys": 2, "after some outputs": 3}
    add, write = done_keys.add, jobs.write_outputs

    def stop_at(point):
        def adding(keys, path, batch_id):
            if point == 1 and batch_id == 1:
                raise RuntimeError("stopped")
            add(keys, path, batch_id)

        def writing(outputs, base, batch_id):
            if point > 1 and batch_id == 1:
                for name in list(outputs)[: 0 if point == 2 else 3]:
                    outputs[name].write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")
                raise RuntimeError("stopped")
            write(outputs, base, batch_id)

        monkeypatch.setattr(done_keys, "add", adding)
        monkeypatch.setattr(jobs, "write_outputs", writing)

    for point in stops.values():
        stop_at(point)
        with pytest.raises(StreamingQueryException):
            run("stopped")
        before = rows_of(spark, str(tmp_path / "stopped"))
        assert len(before["papers"]) < len(rows_of(spark, str(tmp_path / "whole"))["papers"])
    stop_at(0)
    run("stopped")
    assert rows_of(spark, str(tmp_path / "stopped")) == rows_of(spark, str(tmp_path / "whole"))
