"""Shards along a Hilbert curve, in DataFrame functions only.

Every metadata dimension is quantised into 2^bits cells at approximate quantiles taken over all rows, the cells' coordinates
become an index on the Hilbert curve, and the rows sorted by (index, tie columns) are cut into runs of equal length. Rows that
are near each other in all dimensions share a shard, so min/max statistics of a shard's files prune on each of them.

The sort is never done in one place. Its order is (cell, chunk, tie columns), where the chunk is a hash of the tie columns: ranks
are counted inside each (cell, chunk), and the start of a (cell, chunk) comes from counts alone (at most 2^(bits*dims) * chunks
numbers, summed per cell and then over the cells). A cell that holds a third of all rows is thus spread over `chunks` groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage


def ordered_number(c: Column, kind: str) -> Column:
    """A number in the order of the column: strings by their first seven bytes, numbers as they are, null below everything."""
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0")
        number = F.conv(head, 16, 10).cast("double")
    else:
        number = F.when(~F.isnan(c.cast("double")), c.cast("double"))
    return F.coalesce(number, F.lit(float("-inf")))


def quantised(number: Column, bounds: Column, bits: int) -> Column:
    """How many of the 2^bits - 1 quantile bounds lie below the number: equal numbers share a cell."""
    below = F.aggregate(bounds, F.lit(0), lambda n, b: n + F.when(b < number, 1).otherwise(0))
    return F.least(below, F.lit(2**bits - 1)).cast("int")


def hilbert_index(axes: Column, dims: int, bits: int) -> Column:
    """Index of a cell on the Hilbert curve (Skilling's transposed form), as folds over arrays so that each step is evaluated once."""
    top = 1 << (bits - 1)
    undo = F.array(*[
        F.struct(F.lit(1 << q).alias("bit"), F.lit(i).alias("axis")) for q in range(bits - 1, 0, -1) for i in range(dims)
    ])

    def step(x: Column, s: Column) -> Column:
        low = s["bit"] - 1
        swapped = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, s["axis"])).bitwiseAND(low)
        return F.when(
            F.get(x, s["axis"]).bitwiseAND(s["bit"]) != 0,
            F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)),
        ).otherwise(F.transform(x, lambda v, j: F.when((j == 0) | (j == s["axis"]), v.bitwiseXOR(swapped)).otherwise(v)))

    turned = F.aggregate(undo, axes, step) if bits > 1 else axes
    gray = F.aggregate(
        F.sequence(F.lit(1), F.lit(dims - 1)), turned,
        lambda x, i: F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v)),
    ) if dims > 1 else turned
    flips = F.aggregate(
        F.array(*[F.lit(1 << q) for q in range(bits - 1, 0, -1)]), F.lit(0),
        lambda t, q: F.when(F.get(gray, F.lit(dims - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
    ) if bits > 1 else F.lit(0)
    places = F.array(*[F.struct(F.lit(top >> b).alias("bit"), F.lit(i).alias("axis")) for b in range(bits) for i in range(dims)])
    packed = F.struct(gray.alias("x"), flips.alias("t"))
    return F.aggregate(
        places, F.struct(packed.alias("p"), F.lit(0).cast("long").alias("h")),
        lambda a, s: F.struct(
            a["p"].alias("p"),
            (a["h"] * 2 + F.when(F.get(a["p"]["x"], s["axis"]).bitwiseXOR(a["p"]["t"]).bitwiseAND(s["bit"]) != 0, 1).otherwise(0)).alias("h"),
        ),
        lambda a: a["h"],
    )


def hilbert_shards(
    df: DataFrame, dimensions: Sequence[str], ties: Sequence[str], shards: int = 40, bits: int = 4, chunks: int = 64,
) -> DataFrame:
    """`df` with `curve` (long), `shard` (int) and `slot` (long, gapless from 0 in its shard); shard sizes differ by one row at most.

    Nulls in a dimension or tie column sort first; rows that are equal in dimensions and tie columns take neighbouring slots in
    any order; an empty table gives no rows; fewer rows than shards leave some shards empty. `df` must be narrow and is read
    three times, so cut its lineage before. Columns of the three result names are replaced."""
    if not 1 <= len(dimensions) * bits <= 14:
        raise ValueError("the curve has 2^(dimensions * bits) cells; keep that at 16,384 or fewer")
    kinds = dict(df.dtypes)
    numbers = [ordered_number(F.col(d), kinds[d]) for d in dimensions]
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    bounds = df.agg(*[F.percentile_approx(n, cuts, 1000).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    none = F.array().cast("array<double>")
    axes = F.array(*[
        quantised(n, F.array(*map(F.lit, bounds[i])) if bounds[i] else none, bits) for i, n in enumerate(numbers)
    ])
    at = df.withColumn("curve", hilbert_index(axes, len(dimensions), bits)).withColumn(
        "__chunk", F.pmod(F.xxhash64(*[F.col(t) for t in ties]), F.lit(chunks)).cast("int")
    )
    counts = at.groupBy("curve", "__chunk").agg(F.count("*").alias("__n"))
    # Both windows below run over counts: at most `chunks` rows a cell, and one row a cell (their number is bounded by the curve).
    in_cell = Window.partitionBy("curve").orderBy("__chunk")
    counts = counts.withColumn("__before", F.sum("__n").over(in_cell) - F.col("__n"))
    cells = at.groupBy("curve").agg(F.count("*").alias("__n"))
    cells = cells.select("curve", (F.sum("__n").over(Window.orderBy("curve")) - F.col("__n")).alias("__cell_start"), F.sum("__n").over(Window.partitionBy()).alias("__total"))
    starts = counts.join(cells, "curve").select("curve", "__chunk", (F.col("__cell_start") + F.col("__before")).alias("__start"), "__total")
    own = Window.partitionBy("curve", "__chunk").orderBy(*[F.col(t) for t in ties])
    ranked = at.withColumn("__own", F.row_number().over(own).cast("long") - 1)
    # Whole-number arithmetic: shard s begins at the first rank r with r * shards >= s * total.
    placed = ranked.join(starts, ["curve", "__chunk"]).withColumn("shard", F.expr(f"cast(((__start + __own) * {shards}) div __total as int)"))
    first = F.expr(f"(shard * __total + {shards} - 1) div {shards}")
    return placed.withColumn("slot", F.col("__start") + F.col("__own") - first).drop("__chunk", "__own", "__start", "__total")


def document_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Documents in `shards` shards along a curve over language, source, size and id. A null text has size 16 and the crc of the
    empty text. The text is read once; what moves between tasks is a few numbers a row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    placed = hilbert_shards(cut_lineage(narrow), ["lang", "source", "size", "doc_id"], ["doc_id", "text_crc32", "size"], shards, bits=3)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
