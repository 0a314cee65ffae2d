"""Rule lists: each rule is (code, condition-that-is-wrong, message); a row carries all its violations as an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column, str | Column]

HEX64 = "^[a-f0-9]{64}$"


def violations(rules: list[Rule]) -> Column:
    """Array of struct<rule, message>, one entry per broken rule, in rule order. An unknown condition counts as broken."""
    checks = []
    for code, broken, message in rules:
        text = message if isinstance(message, Column) else F.lit(message)
        entry = F.struct(F.lit(code).alias("rule"), F.coalesce(text, F.lit("")).alias("message"))
        checks.append(F.when(F.coalesce(broken, F.lit(True)), entry))
    return F.array_compact(F.array(*checks))


def split_by_rules(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that fail with their `violations`)."""
    checked = df.withColumn("violations", violations(rules))
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def longer_than(c: Column, limit: int) -> Column:
    """True if a present value is too long; a null value passes."""
    return F.coalesce(F.length(c) > limit, F.lit(False))


def outside(c: Column, values: tuple[str, ...]) -> Column:
    return ~F.coalesce(c.isin(*values), F.lit(False))


def off_unit_interval(c: Column) -> Column:
    return F.coalesce((c < 0) | (c > 1), F.lit(False))
