"""Duplicate gates with a time-to-live: a key is accepted, then refused until the TTL since the last *accepted* row is over.

Refused rows do not extend the window, so this is neither a lag nor a distinct. In the batch form each row points to the first row
of its key that is at least the TTL later: the row accepted next, should this one be. Rows without another one less than the TTL before
them are accepted whatever came earlier; what can be reached from them over the pointers is accepted, too. Each round doubles the
pointers' reach, so the rounds are as many as the logarithm of the longest chain of acceptances, and no key's rows are ever gathered in
one place.

A message can have several keys, any of which makes it a duplicate (`multi_key_accepted`). Messages and keys then form a two-sided
graph, and whether a message counts depends on what became of earlier ones over other keys. Each round decides all messages that
are the earliest undecided ones of all their keys, and refuses what those cover; only undecided rows go on to the next round.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage


def ttl_accepted(
    df: DataFrame, keys: list[str], ts: str, row_id: str, ttl_seconds: int, remembered: DataFrame | None = None
) -> DataFrame:
    """Accepted rows as (keys..., ts, row_id). Within one timestamp the smaller `row_id` comes first. A null key is a key like any
    other; rows without a time can not be judged and are never accepted.

    `remembered` (keys..., last_accepted) continues after earlier batches.
    """
    # Keys and times only, materialised: the rounds below must not repeat whatever text work `df` stands for.
    rows = df.select(*keys, F.col(ts).cast("timestamp").alias(ts), row_id).filter(F.col(ts).isNotNull())
    if remembered is not None:
        known = rows.join(remembered, _same(rows, remembered, keys), "left").select(*[rows[c] for c in rows.columns], "last_accepted")
        due = F.col(ts) >= F.timestamp_add("SECOND", F.lit(ttl_seconds), F.col("last_accepted"))
        rows = known.filter(F.col("last_accepted").isNull() | due).drop("last_accepted")
    rows = cut_lineage(rows.distinct())
    nodes = cut_lineage(_successors(rows, keys, ts, row_id, ttl_seconds))
    # What follows a row that is accepted anyway needs no step to reach it.
    starts = nodes.filter("starts").select("node")
    steps = nodes.filter("next is not null").select("node", "next")
    steps = cut_lineage(steps.join(starts.withColumnRenamed("node", "next"), "next", "left_anti"))
    reached = [cut_lineage(starts)]
    while not steps.isEmpty():
        found = cut_lineage(reduce(DataFrame.unionByName, reached).join(steps, "node").select(F.col("next").alias("node")))
        if found.isEmpty():
            break
        reached.append(found)
        steps = cut_lineage(steps.alias("a").join(steps.alias("b"), F.col("a.next") == F.col("b.node")).select("a.node", "b.next"))
    return reduce(DataFrame.unionByName, reached).select("node.*").select(*[F.col(c) for c in rows.columns])


def _successors(rows: DataFrame, keys: list[str], ts: str, row_id: str, ttl_seconds: int) -> DataFrame:
    """(node, starts, next): each row as a struct, whether no row of its key lies less than the TTL before it, and the key's first row
    at least the TTL after it.

    Windows are over (key, time chunk); what lies in other chunks comes from one row a chunk. A chunk is a thousandth of the TTL, but
    never less than a minute, so that a key has at most half a million of them a year.
    """
    ttl = ttl_seconds * 1_000_000
    width = max(ttl // 1024, 60_000_000)
    node, at = F.struct(*keys, ts, row_id), F.unix_micros(ts)
    own = rows.select(*keys, at.alias("at"), F.lit(1).alias("kind"), F.col(row_id).alias("seq"), node.alias("node"), node.alias("asker"))
    asks = rows.select(*keys, (at + ttl).alias("at"), F.lit(0).alias("kind"), F.col(row_id).alias("seq"), F.lit(None).cast(own.schema["node"].dataType).alias("node"), node.alias("asker"))
    marks = own.unionByName(asks).withColumn("chunk", F.floor(F.col("at") / width))
    in_chunk = Window.partitionBy(*keys, "chunk").orderBy("at", "kind", "seq")
    marks = marks.withColumn("next", F.first("node", ignorenulls=True).over(in_chunk.rowsBetween(0, Window.unboundedFollowing)))
    is_row = F.col("kind") == 1
    marks = marks.withColumn("before", F.max(F.when(is_row, F.col("at"))).over(in_chunk.rowsBetween(Window.unboundedPreceding, -1)))
    chunks = marks.groupBy(*keys, "chunk").agg(
        F.min_by("node", F.when(is_row, F.struct("at", "seq"))).alias("head"), F.max(F.when(is_row, F.col("at"))).alias("tail"),
    )
    by_key = Window.partitionBy(*keys).orderBy("chunk")
    chunks = chunks.select(
        *[F.col(k).alias(f"of_{i}") for i, k in enumerate([*keys, "chunk"])], F.first("head", ignorenulls=True).over(by_key.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
        F.max("tail").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{i}")) for i, k in enumerate([*keys, "chunk"])])
    full = marks.join(chunks, same).select(
        "asker", "kind", F.coalesce("next", "later").alias("next"), F.coalesce("before", "earlier").alias("before"), "at",
    )
    starts = F.bool_or(F.when(is_row, F.coalesce(F.col("at") - F.col("before") >= ttl, F.lit(True))))
    return full.groupBy(F.col("asker").alias("node")).agg(starts.alias("starts"), F.max(F.when(~is_row, F.col("next"))).alias("next"))


def multi_key_accepted(
    df: DataFrame, checked: str, marked: str, ts: str, row_id: str, ttl_seconds: int, remembered: DataFrame | None = None
) -> DataFrame:
    """Accepted rows as (row_id, ts, key), one a key the row marks; `key` is null for an accepted row without such keys.

    `checked` and `marked` are arrays of key texts. A row is refused if one of its checked keys was marked by an accepted row before
    it (by time, then `row_id`) less than the TTL ago; otherwise it is accepted and marks its own. A row always checks what it marks.
    Null keys are none; a row without keys is accepted; rows without a time can not be judged and are never accepted. `row_id` must
    be unique. `remembered` (key, last_accepted) continues after earlier batches; rows that arrive late count as covered by them.

    The rounds are as many as the longest chain of messages each of which waits for the one before (over any keys); a round shuffles
    (key, row) pairs of undecided rows only, and a hot key's rows meet one row a key.
    """
    own, both = F.coalesce(F.col(marked), F.array().cast("array<string>")), F.coalesce(F.col(checked), F.array().cast("array<string>"))
    timed = df.select(F.col(row_id).alias("id"), F.col(ts).cast("timestamp").alias("t"), F.array_union(own, both).alias("keys"), own.alias("own")).filter("t is not null")
    pairs = timed.select("id", "t", F.explode_outer("keys").alias("key"), "own").withColumn("marks", F.coalesce(F.array_contains("own", F.col("key")), F.lit(False))).drop("own")
    # Null keys are dropped here, but a row keeps one pair, so that a row without keys is decided, too.
    has_key = F.exists(F.col("keys"), lambda k: k.isNotNull())
    none = timed.filter(~has_key).select("id", "t", F.lit(None).cast("string").alias("key"))
    open_pairs = cut_lineage(pairs.filter("key is not null"))
    row, covers = F.struct("t", "id"), F.timestamp_add("SECOND", F.lit(ttl_seconds), F.col("last_accepted"))
    if remembered is not None:
        late = open_pairs.join(remembered, "key").filter(F.col("t") < covers).select("id").distinct()
        open_pairs = cut_lineage(open_pairs.join(late, "id", "left_anti"))
    done = [cut_lineage(none)]
    while not open_pairs.isEmpty():
        heads = open_pairs.filter("marks").groupBy("key").agg(F.min(row).alias("head"))
        waits = open_pairs.join(heads, "key", "left").groupBy("id").agg(F.bool_or(F.coalesce(F.col("head") < row, F.lit(False))).alias("waits"))
        clear = cut_lineage(open_pairs.join(waits.filter("not waits").select("id"), "id"))
        done.append(_marks_of(clear))
        # One accepted row at most marks a key in a round: it was the key's head.
        marks = clear.filter("marks").select("key", F.col("t").alias("last_accepted"), F.col("id").alias("by"))
        rest = open_pairs.join(clear.select("id").distinct(), "id", "left_anti")
        covered = rest.join(marks, "key").filter((row > F.struct(F.col("last_accepted").alias("t"), F.col("by").alias("id"))) & (F.col("t") < covers))
        open_pairs = cut_lineage(rest.join(covered.select("id").distinct(), "id", "left_anti"))
    return reduce(DataFrame.unionByName, done).select(F.col("id").alias(row_id), F.col("t").alias(ts), "key")


def _marks_of(clear: DataFrame) -> DataFrame:
    """(id, t, key) of the pairs that mark, and one row with a null key for rows that mark nothing."""
    silent = clear.groupBy("id").agg(F.min("t").alias("t"), F.bool_or("marks").alias("any")).filter("not any")
    return clear.filter("marks").select("id", "t", "key").unionByName(silent.select("id", "t", F.lit(None).cast("string").alias("key")))


def flag_multi_key_duplicates(df: DataFrame, checked: str, marked: str, ts: str, row_id: str, ttl_seconds: int) -> DataFrame:
    """All rows of `df` with a boolean `is_duplicate`, null for rows without a time."""
    accepted = multi_key_accepted(df, checked, marked, ts, row_id, ttl_seconds).select(row_id).distinct().withColumn("__accepted", F.lit(True))
    return df.join(accepted, row_id, "left").withColumn(
        "is_duplicate", F.when(F.col(ts).isNotNull(), F.col("__accepted").isNull())
    ).drop("__accepted")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def flag_duplicates(df: DataFrame, keys: list[str], ts: str, row_id: str, ttl_seconds: int) -> DataFrame:
    """All rows of `df` with a boolean `is_duplicate`, null for rows without a time."""
    accepted = ttl_accepted(df, keys, ts, row_id, ttl_seconds).select(row_id, F.lit(True).alias("__accepted"))
    return df.join(accepted, row_id, "left").withColumn(
        "is_duplicate", F.when(F.col(ts).isNotNull(), F.col("__accepted").isNull())
    ).drop("__accepted")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the smallest by `order`; a partial aggregation, so copies collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return picked.select(*keys, "row.*").select(*df.columns)


def absent_from(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is not stored yet."""
    return df.join(existing.select(*keys), keys, "left_anti")
