"""A stored vector index: vectors in cells around fitted centres, and for every cell the widest angle between its centre and a vector.

By the triangle inequality for angles no vector of a cell is closer to a query than the query's angle to the centre less that width. A
search first reads the few cells whose centres are nearest; the k-th similarity found there rules out all cells whose bound is below it,
and the cells left over are read as well. The result is therefore that of an exact search, however good the centres are; with
`exact=False` the second step is left out, and the recall is what the centres give.

Cells are stored in parts of about PART_ROWS vectors and meet queries in blocks of about QUERY_ROWS, so that neither a crowded cell nor
a cell that most queries ask for lands in one task. A task returns at most k rows for each of its queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.text_search import top_per_query
from paperloom.operators.vector_search import _ARROW, _Best, _unit
from paperloom.session import cut_lineage

MAX_CELLS = 4096
"""Centres are the only part of an index that the driver and every task hold: MAX_CELLS vectors at most."""
SAMPLE_ROWS = 100_000
PART_ROWS = 8192
QUERY_ROWS = 1024
SLACK = 1e-7
"""Angles are computed in doubles; bounds are widened by this much."""


@dataclass(frozen=True)
class VectorIndex:
    vectors: DataFrame
    """key, embedding, cell, part"""
    cells: DataFrame
    """cell, centre, radius (radians), n, parts"""


def usable(embedding: Column, dim: int) -> Column:
    """Vectors of the index's length whose components are all finite and not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) == dim) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def fit_centres(vectors: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 1) -> np.ndarray:
    """Unit centres fitted on a sample of about `sample_rows` vectors; by default as many as the root of the number of vectors."""
    n = vectors.count()
    k = max(1, min(cells or math.isqrt(n), MAX_CELLS, n))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = vectors.select(F.transform("embedding", lambda x: x.cast("double") / norm).alias("unit"))
    rows = unit if n <= sample_rows else unit.sample(sample_rows / n, seed)
    rows = cut_lineage(rows.select(array_to_vector("unit").alias("features")))
    centres = np.asarray(KMeans(k=k, seed=seed, maxIter=10, initMode="random").fit(rows).clusterCenters())
    return _unit(centres[np.linalg.norm(centres, axis=1) > 0]) if centres.any() else _unit(np.ones((1, centres.shape[1])))


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(vectors) @ centres.T, -1.0, 1.0))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def build_index(vectors: DataFrame, dim: int, cells: int | None = None, key: str = "paper_id") -> VectorIndex:
    """The index of (key, embedding); vectors of another length and those that are not `usable` are left out."""
    rows = vectors.select(key, "embedding").filter(usable(F.col("embedding"), dim))
    if rows.isEmpty():
        none = rows.withColumn("cell", F.lit(0)).withColumn("part", F.lit(0))
        return VectorIndex(none, none.groupBy("cell").agg(F.first("embedding").cast("array<double>").alias("centre"), F.lit(0.0).alias("radius"), F.count("*").alias("n"), F.lit(0).alias("parts")))
    centres = fit_centres(rows, cells)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _angles(_matrix(batch.column("embedding"), dim), centres)
            cell = angles.argmin(1)
            columns = [batch.column(key), batch.column("embedding"), pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "embedding", "cell", "angle"])

    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    placed = cut_lineage(rows.mapInArrow(assign, schema))
    facts = placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
    own = rows.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    facts = own.join(facts, "cell").withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))
    parted = placed.join(facts.select("cell", "parts"), "cell").withColumn("part", F.pmod(F.xxhash64(key), "parts").cast("int"))
    return VectorIndex(parted.select(key, "embedding", "cell", "part"), facts)


def write_index(index: VectorIndex, path: str) -> None:
    """Vectors in a folder a cell, so that a search opens only the cells it asks for."""
    index.vectors.repartition("cell", "part").write.partitionBy("cell").parquet(f"{path}/vectors")
    index.cells.write.parquet(f"{path}/cells")


def read_index(spark: SparkSession, path: str) -> VectorIndex:
    return VectorIndex(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/cells"))


def wanted_cells(cells: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, cell, bound, nearness): for each query all cells that may hold a vector of at least its `floor`, `bound` being the
    highest similarity possible in the cell and `nearness` the place of its centre, from 1. Queries: query_id, embedding, floor."""
    facts = cells.select("cell", "centre", "radius").limit(MAX_CELLS + 1).toArrow().to_pylist()
    if len(facts) > MAX_CELLS:
        raise ValueError(f"an index has at most {MAX_CELLS} cells")
    id_type = queries.schema["query_id"].dataType
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("cell", T.IntegerType()), T.StructField("bound", T.DoubleType()), T.StructField("nearness", T.IntegerType())])
    kind = _ARROW.get(id_type.simpleString(), pa.string())
    number, radius = np.asarray([f["cell"] for f in facts], np.int32), np.asarray([f["radius"] for f in facts])
    centres = np.asarray([f["centre"] for f in facts], np.float64)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            angles = _angles(_matrix(batch.column("embedding"), centres.shape[1]), centres)
            bound = np.cos(np.maximum(angles - radius, 0.0)) + SLACK
            nearness = angles.argsort(1, kind="stable").argsort(1, kind="stable") + 1
            row, col = np.nonzero(bound >= batch.column("floor").to_numpy()[:, None])
            columns = [batch.column("query_id").take(pa.array(row)).cast(kind), pa.array(number[col]), pa.array(bound[row, col]), pa.array(nearness[row, col].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    if not facts:
        return queries.sparkSession.createDataFrame([], schema)
    return queries.select("query_id", "embedding", F.col("floor").cast("double").alias("floor")).mapInArrow(bounds, schema)


def _meet(index: VectorIndex, asked: DataFrame, targets: DataFrame, keep: int, digits: int, key: str) -> DataFrame:
    """(query_id, key, similarity): at most `keep` rows of each query and stored part among its target cells, at its floor or over it."""
    demand = targets.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    blocked = targets.join(demand, "cell").join(index.cells.select("cell", "parts"), "cell").join(asked, "query_id")
    blocked = blocked.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), "query_id", F.col("embedding").alias("asked"), "floor")
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    stored = index.vectors.join(demand, "cell").select("cell", "part", blocks, key, "embedding")
    id_type, key_type = asked.schema["query_id"].dataType, index.vectors.schema[key].dataType
    kinds = [_ARROW.get(id_type.simpleString(), pa.string()), _ARROW.get(key_type.simpleString(), pa.string()), pa.float64()]
    names = ["query_id", key, "similarity"]

    def best(have: pa.Table, want: pa.Table) -> pa.Table:
        rows = []
        if len(have) and len(want):
            queries = _unit(np.asarray(want.column("asked").to_pylist(), np.float64))
            ids, floor = want.column("query_id").to_pylist(), want.column("floor").to_numpy()
            found = _Best(len(ids), keep, digits)
            docs = _unit(np.asarray(have.column("embedding").to_pylist(), np.float64))
            found.take(docs @ queries.T, have.column(key).to_pylist(), floor)
            rows = [(ids[q], k, s) for q, own in enumerate(found.rows) for _, k, s in own]
        return pa.Table.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows) if rows else ([], [], []), kinds)], names=names)

    schema = T.StructType([T.StructField("query_id", id_type), T.StructField(key, key_type), T.StructField("similarity", T.DoubleType())])
    groups = ("cell", "part", "block")
    return stored.groupBy(*groups).cogroup(blocked.groupBy(*groups)).applyInArrow(best, schema)


def nearest(
    index: VectorIndex, queries: DataFrame, limit: int = 10, threshold: float = -1.0, probes: int = 8, exact: bool = True, digits: int = 12, key: str = "paper_id",
) -> DataFrame:
    """The `limit` most similar vectors of each query (`query_id`, `embedding`) at `threshold` or over it: (query_id, key, similarity, position).

    Similarities are rounded to `digits` before they are ranked; ties go to the smaller key. Queries of another length and those that
    are not `usable` find nothing. `query_id` must be unique."""
    dim = index.vectors.select(F.size("embedding").alias("dim")).first()
    asked = queries.select("query_id", "embedding", F.lit(float(threshold)).alias("floor")).filter(usable(F.col("embedding"), dim["dim"] if dim else 0))
    asked = cut_lineage(asked)
    near = wanted_cells(index.cells, asked).filter(F.col("nearness") <= probes).select("query_id", "cell")
    found = cut_lineage(_meet(index, asked, near, limit, digits, key).withColumn("similarity", F.round("similarity", digits)))
    if exact:
        last = top_per_query(found, limit, score="similarity", key=key).filter(F.col("position") == limit).select("query_id", F.col("similarity").alias("last"))
        # A similarity that ties with the last one after rounding may still win by its key.
        floor = F.greatest("floor", F.coalesce(F.col("last") - 10.0**-digits, F.lit(-1.0)))
        again = cut_lineage(asked.join(last, "query_id", "left").select("query_id", "embedding", floor.alias("floor")))
        rest = wanted_cells(index.cells, again).filter(F.col("nearness") > probes).select("query_id", "cell")
        more = _meet(index, again, rest, limit, digits, key).withColumn("similarity", F.round("similarity", digits))
        found = found.unionByName(more)
    return top_per_query(found, limit, score="similarity", key=key)
