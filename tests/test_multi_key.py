"""The duplicate gate over several keys a message, against a plain walk in order of time."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from paperloom.operators import dedup, intake
from paperloom.session import scratch_path
from paperloom.settings import DEFAULTS
from paperloom.streaming import jobs

START = datetime.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, checked array<string>, marked array<string>"


def plain(rows, ttl):
    """Ids of accepted rows, one row after the other."""
    last, accepted = {}, set()
    for id_, ts, checked, marked in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0])):
        keys = {k for k in [*(checked or []), *(marked or [])] if k is not None}
        if not any(k in last and ts < last[k] + datetime.timedelta(seconds=ttl) for k in keys):
            accepted.add(id_)
            last.update({k: ts for k in marked or [] if k is not None})
    return accepted


def messages(n, keys, span, seed, hot=None):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        marked = [f"k{rng.randrange(keys)}" for _ in range(rng.randrange(3))]
        if hot and rng.random() < hot:
            marked.append("hot")
        checked = [f"k{rng.randrange(keys)}"] if rng.random() < 0.3 else []
        rows.append((k, START + datetime.timedelta(seconds=rng.randrange(span)), checked, marked))
    rows += [
        (n, None, ["k1"], ["k1"]), (n + 1, START, None, None), (n + 2, START, [None], [None, "k2"]), (n + 3, START, [], []),
        (n + 4, START, ["k2", "k2"], ["k2", None, "k2"]), (n + 5, START, [""], []),
    ]
    return rows


def accepted_ids(df):
    return {r["id"] for r in df.select("id").distinct().collect()}


def test_any_key_hits_as_in_a_plain_walk(spark):
    for seed, n, keys, span, hot in ((1, 300, 60, 5000, None), (2, 200, 15, 4000, 0.35)):
        rows = messages(n, keys, span, seed, hot)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = dedup.multi_key_accepted(df, "checked", "marked", "ts", "id", 600)
        assert accepted_ids(got) == plain(rows, 600)


def test_refused_rows_mark_nothing_and_do_not_extend(spark):
    at = [START + datetime.timedelta(seconds=s) for s in (0, 50, 90, 120, 150)]
    rows = [(1, at[0], [], ["a"]), (2, at[1], [], ["a", "b"]), (3, at[2], [], ["b"]), (4, at[3], [], ["a", "c"]), (5, at[4], ["c"], ["d"])]
    df = spark.createDataFrame(rows, SCHEMA)
    flags = {r["id"]: r["is_duplicate"] for r in dedup.flag_multi_key_duplicates(df, "checked", "marked", "ts", "id", 100).collect()}
    assert flags == {1: False, 2: True, 3: False, 4: False, 5: True}


def test_no_rows_and_rows_without_time(spark):
    assert dedup.multi_key_accepted(spark.createDataFrame([], SCHEMA), "checked", "marked", "ts", "id", 100).count() == 0
    df = spark.createDataFrame([(1, None, ["a"], ["a"])], SCHEMA)
    assert dedup.flag_multi_key_duplicates(df, "checked", "marked", "ts", "id", 100).first()["is_duplicate"] is None


def test_keys_of_a_message(spark):
    df = spark.createDataFrame(
        [("m1", "i1", "m0", "<m7> <m8>\t<m7> <>"), (None, "", None, None)], "m string, i string, reply string, refs string"
    )
    checked, marked = intake.gate_keys(F.col("m"), F.col("i"), F.col("reply"), F.col("refs"))
    first, second = df.select(checked.alias("checked"), marked.alias("marked")).collect()
    assert first["marked"] == ["msgid:m1", "idem:i1", "reply:m0"]
    assert first["checked"] == ["msgid:m1", "idem:i1", "reply:m0", "msgid:m7", "msgid:m8"]
    assert second["checked"] == second["marked"] == []


def test_stream_in_three_batches_equals_the_batch_form(spark, tmp_path):
    ttl = DEFAULTS.dedup_ttl_seconds
    rows = sorted((r for r in messages(90, 20, 5 * ttl, 5) if r[1] is not None), key=lambda r: (r[1], r[0]))
    third = len(rows) // 3
    for k, part in enumerate((rows[:third], rows[third : 2 * third], rows[2 * third :])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    base = scratch_path(spark, "multi-key")
    jobs.run_multi_key_gate(stream, "checked", "marked", "ts", "id", base, str(tmp_path / "checkpoint"))
    assert accepted_ids(jobs.read_output(spark, base, "accepted")) == plain(rows, ttl)
