"""Small helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from paperloom.session import cut_lineage

UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
"""Lower-cases A-Z in UTF-8 bytes and nothing else."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """`df` materialised in the shared folder, and the shuffle files behind it deleted as soon as that is done, so that disk holds the
    files of one step only."""
    conf = df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, None)
    conf.set(_FREE_SHUFFLES, "true")
    try:
        return cut_lineage(df.select("*"))  # the setting holds for plans that are made under it
    finally:
        conf.unset(_FREE_SHUFFLES) if before is None else conf.set(_FREE_SHUFFLES, before)


def text_bytes(text: str | None) -> bytes:
    """UTF-8 bytes of a text, null as empty; lone surrogates (which Spark strings can not hold) would become '?'."""
    return text.encode("utf-8", "replace") if text else b""


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of bytes other than space and \\x09-\\x0D: exactly what `bytes.split()` splits on."""
    return text_bytes(text).translate(UPPER_TO_LOWER).split()


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, also when the name holds dots or backticks."""
    return df["`" + re.sub("`", "``", name) + "`"]


def append_by_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], inputs: Sequence[str], added: Sequence[tuple[str, str]],
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """`df`'s columns `carry` (all if None) followed by the columns `added` as (name, type), computed an Arrow batch at a time.

    `make` runs once in each task and returns the function from a batch, whose columns are `inputs` in that order, to arrays.
    Input columns travel under positional names, so that no name of `df` can clash with an added one inside the task."""
    carried = list(df.columns) if carry is None else list(carry)
    clash = {c.lower() for c in carried} & {n.lower() for n, _ in added}
    if clash:
        raise ValueError(f"the result columns {sorted(clash)} exist already; rename them first")
    sent = df.select(*[column(df, c).alias(f"i{k}") for k, c in enumerate(inputs)], *[column(df, c).alias(f"c{k}") for k, c in enumerate(carried)])
    out = StructType([StructField(f"c{k}", df.schema[c].dataType) for k, c in enumerate(carried)])
    for k, (_, kind) in enumerate(added):
        out = out.add(f"a{k}", DataType.fromDDL(kind))
    n_in, names = len(inputs), out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            own = batch.select(list(range(n_in)))
            arrays = work(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[n_in:], *arrays], names=names)

    done = sent.mapInArrow(run, out)
    return done.toDF(*carried, *[n for n, _ in added])
