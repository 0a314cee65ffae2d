"""Exact cosine search over an embedding column.

Scores are computed where the vectors are: an Arrow function multiplies each batch with the query matrix and returns only
scores over the threshold, so neither vectors nor below-threshold pairs are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.columns import blank_to_null
from paperloom.operators.text_search import facet_filters, top_per_query
from paperloom.settings import DEFAULTS, Settings

QUERY_BLOCK = 1024
PUBLISHED = "PUBLISHED"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns in double precision (null if either has no length)."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def has_dimension(embedding: Column, dim: int) -> Column:
    """Dimension rule; a missing vector is fine."""
    return embedding.isNull() | (F.size(embedding) == dim)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _block_scorer(ids: list, vectors: list[Sequence[float]], threshold: float, schema: T.StructType, key: str):
    """A batch function that emits (query_id, key, similarity) for pairs at or over the threshold."""
    queries = _unit(np.asarray(vectors, dtype=np.float64))
    query_ids = np.asarray(ids)
    key_type = _ARROW.get(schema[key].dataType.simpleString(), pa.string())
    id_type = _ARROW.get(schema["query_id"].dataType.simpleString(), pa.string())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            docs = _unit(values.reshape(len(column), queries.shape[1]))
            sims = docs @ queries.T
            row, col = np.nonzero(np.round(sims, 12) >= threshold)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids[col], type=id_type),
                    batch.column(key).take(pa.array(row)).cast(key_type),
                    pa.array(sims[row, col], type=pa.float64()),
                ],
                names=["query_id", key, "similarity"],
            )

    return score


def similarities(papers: DataFrame, queries: DataFrame, threshold: float, key: str = "paper_id") -> DataFrame:
    """All (query_id, key, similarity) at or over `threshold`, exactly; a query meets the papers whose vectors have its length.

    Query vectors (`query_id`, `embedding`) are request data. They are read in blocks of about QUERY_BLOCK and each block makes
    one pass over the papers of its length. A query without a vector finds nothing.
    """
    asked = queries.filter(F.size("embedding") > 0).withColumn("__dim", F.size("embedding"))
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField(key, papers.schema[key].dataType),
        T.StructField("similarity", T.DoubleType()),
    ])
    out = papers.sparkSession.createDataFrame([], schema)
    for r in asked.groupBy("__dim").count().orderBy("__dim").collect():
        docs = papers.filter(F.size("embedding") == r["__dim"]).select(key, "embedding")
        n_blocks = -(-r["count"] // QUERY_BLOCK)
        for b in range(n_blocks):
            block = asked.filter((F.col("__dim") == r["__dim"]) & (F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b))
            rows = block.select("query_id", "embedding").toArrow().to_pylist()
            for start in range(0, len(rows), QUERY_BLOCK):
                part = rows[start:start + QUERY_BLOCK]
                scorer = _block_scorer([q["query_id"] for q in part], [q["embedding"] for q in part], threshold, schema, key)
                out = out.unionByName(docs.mapInArrow(scorer, schema))
    return out


class _Best:
    """The best rows of each query so far: at most `keep` (larger rounded similarity first, then smaller key) and the number of all."""

    def __init__(self, queries: int, keep: int, digits: int):
        self.rows: list[list[tuple]] = [[] for _ in range(queries)]
        self.hits = np.zeros(queries, np.int64)
        self.keep, self.digits = keep, digits

    def take(self, sims: np.ndarray, keys: list, threshold: float) -> None:
        over = np.round(sims, 12) >= threshold
        self.hits += over.sum(0)
        rounded = np.round(sims, self.digits)
        for q in np.flatnonzero(over.any(0)):
            at = np.flatnonzero(over[:, q])
            if len(at) > self.keep:  # all that tie with the last one wanted stay for the keys to decide
                own = rounded[at, q]
                at = at[own >= np.partition(own, len(own) - self.keep)[len(own) - self.keep]]
            own = [(-float(rounded[i, q]), keys[i], float(sims[i, q])) for i in at if keys[i] is not None]
            self.rows[q] = sorted(self.rows[q] + own)[: self.keep]


def best_similar(papers: DataFrame, queries: DataFrame, threshold: float, keep: int, digits: int, key: str = "paper_id") -> DataFrame:
    """(query_id, key, similarity, hits): what the tasks found, each of them at most `keep` rows a query with no `hits`, and one row a
    query without a key whose `hits` is how many of its papers reach the threshold. The best `keep` of all are among the rows; however
    many pairs there are, a task sends `keep` + 1 rows a query. Queries as in `similarities`."""
    asked = queries.filter(F.size("embedding") > 0).withColumn("__dim", F.size("embedding"))
    id_type, key_type = queries.schema["query_id"].dataType, papers.schema[key].dataType
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField(key, key_type), T.StructField("similarity", T.DoubleType()), T.StructField("hits", T.LongType())])
    kinds = [_ARROW.get(id_type.simpleString(), pa.string()), _ARROW.get(key_type.simpleString(), pa.string()), pa.float64(), pa.int64()]

    def finder(ids: list, vectors: list[Sequence[float]]):
        matrix = _unit(np.asarray(vectors, dtype=np.float64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(len(ids), keep, digits)
            for batch in batches:
                column = batch.column("embedding")
                docs = _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), matrix.shape[1]))
                best.take(docs @ matrix.T, batch.column(key).to_pylist(), threshold)
            rows = [(ids[q], k, s, None) for q, own in enumerate(best.rows) for _, k, s in own]
            rows += [(ids[q], None, None, int(n)) for q, n in enumerate(best.hits) if n]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)], names=["query_id", key, "similarity", "hits"])

        return run

    out = papers.sparkSession.createDataFrame([], schema)
    for r in asked.groupBy("__dim").count().orderBy("__dim").collect():
        docs = papers.filter(F.size("embedding") == r["__dim"]).select(key, "embedding")
        n_blocks = -(-r["count"] // QUERY_BLOCK)
        for b in range(n_blocks):
            block = asked.filter((F.col("__dim") == r["__dim"]) & (F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b))
            rows = block.select("query_id", "embedding").toArrow().to_pylist()
            for start in range(0, len(rows), QUERY_BLOCK):
                part = rows[start:start + QUERY_BLOCK]
                out = out.unionByName(docs.mapInArrow(finder([q["query_id"] for q in part], [q["embedding"] for q in part]), schema))
    return out


def _best_rows(scope: DataFrame, queries: DataFrame, threshold: float, limit: int, offset: int, digits: int) -> DataFrame:
    """(query_id, paper_id, similarity, position, total) of the best rows, from what the tasks kept."""
    kept = best_similar(scope, queries, threshold, limit + offset, digits).withColumn("similarity", F.round("similarity", digits))
    own = Window.partitionBy("query_id")
    ranked = kept.withColumn("total", F.sum("hits").over(own))
    ranked = ranked.withColumn("position", F.row_number().over(own.orderBy(F.desc_nulls_last("similarity"), F.asc("paper_id"))).cast("bigint"))
    page = ranked.filter(F.col("hits").isNull() & F.col("position").between(offset + 1, offset + limit))
    return page.select("query_id", "paper_id", "similarity", "position", "total")


def semantic_search(
    papers: DataFrame, queries: DataFrame, threshold: float | None = None, limit: int | None = 20, offset: int = 0,
    settings: Settings = DEFAULTS, digits: int = 12, **filters,
) -> DataFrame:
    """Published papers most similar to each query vector: (query_id, paper_id, similarity, position, total).

    Scores are rounded to `digits` before ranking so that equal vectors tie and the smaller id wins on every run.
    """
    scope = facet_filters(papers, status=PUBLISHED, **filters)
    limit_at = settings.semantic_threshold if threshold is None else threshold
    if limit is not None:
        return _best_rows(scope, queries, limit_at, limit, offset, digits)
    scored = similarities(scope, queries, limit_at).withColumn("similarity", F.round("similarity", digits))
    totals = scored.groupBy("query_id").agg(F.count("*").alias("total"))
    return top_per_query(scored, limit, score="similarity", offset=offset).join(totals, "query_id")


def nearest_by_distance(
    papers: DataFrame, queries: DataFrame, threshold: float | None = None, limit: int = 10,
    department_code: str | None = None, settings: Settings = DEFAULTS, digits: int = 12,
) -> DataFrame:
    """The storage-side variant: cosine distance at most 1 - threshold, nearest first."""
    limit_at = settings.storage_semantic_threshold if threshold is None else threshold
    scope = facet_filters(papers, status=PUBLISHED, department_code=department_code)
    ranked = _best_rows(scope, queries, limit_at, limit, 0, digits).drop("total")
    return ranked.withColumn("distance", F.lit(1.0) - F.col("similarity"))


def embedding_input(title: Column, venue: Column, status: Column) -> Column:
    """Text to encode: title, plus venue if there is one; only published papers are encoded."""
    return F.when(status == PUBLISHED, F.concat_ws(" ", title, blank_to_null(venue)))


def encode(df: DataFrame, text: str, load_encoder: Callable[[], Callable[[list[str]], np.ndarray]], output: str = "embedding") -> DataFrame:
    """Add `output` by a pluggable encoder; `load_encoder` runs once per worker task, texts go through it in batches."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for texts in batches:
            present = texts.notna()
            result = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if present.any():
                vectors = np.asarray(encoder(texts[present].tolist()), dtype=np.float32)
                result[present] = pd.Series(list(vectors), index=texts.index[present])
            yield result

    return df.withColumn(output, run(F.col(text)))
