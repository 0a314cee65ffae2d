"""Text quality by compression: which of two dictionaries, of good and of bad text, makes a text smaller?

Two zstandard dictionaries are trained on labelled rows. A text is cut into blocks (all of it, each block compressed on its own so
that the dictionary and not the text's own past counts), and the compressed sizes with either dictionary give
(bad - good) / (bad + good). A logistic curve over that difference and the text's length, fitted on labelled rows that neither
dictionary has seen, makes it a probability; its prior is that of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import append_by_batch, column, id_remainder, text_bytes
from paperloom.session import cut_lineage

FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Sample:
    """Bounds of what a model is fitted on. Rows are taken in the order of a hash of their text, `rows` per label at most."""

    rows: int = 2000
    max_bytes: int | None = 16_384
    """Longer texts are not sampled (they are scored whole); so a sample is at most 2 * rows * max_bytes. None: texts of all lengths."""
    total_bytes: int | None = None
    """Rows of a label are taken until they hold this many bytes; the row that passes the bound is the last one."""


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the ids with one label, 0 or 1."""
    return labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("y"), F.max(label).alias("top")
    ).filter("y = top").select("doc_id", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bounds: Sample) -> tuple[list[tuple[str, int]], float]:
    """(text, label) rows in a fixed order, and the share of label 1 among all rows to learn from. Labels other than 0 and 1, null
    ids and null texts teach nothing; a row labelled twice alike counts once, one labelled both ways not at all."""
    known = known_labels(labels, label)
    texts = docs.select("doc_id", F.col("text").alias("t"), F.xxhash64("text", "doc_id").alias("place")).filter(learn & F.col("t").isNotNull())
    # Only ids and hashes are joined and sorted; the texts of the rows chosen are read by a lookup of at most 2 * rows keys.
    fits = F.lit(True) if bounds.max_bytes is None else F.octet_length("t") <= bounds.max_bytes
    rows = cut_lineage(texts.select("doc_id", "place", fits.alias("fits"), F.octet_length("t").alias("bytes")).join(known, "doc_id"))
    shares = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = []
    for y in (0, 1):
        held = 0
        for r in rows.filter((F.col("y") == y) & F.col("fits")).select("doc_id", "place", "y", "bytes").distinct().orderBy("place", "doc_id").limit(bounds.rows).collect():
            if bounds.total_bytes is not None and held >= bounds.total_bytes:
                break
            chosen.append((r["doc_id"], r["place"], r["y"]))
            held += r["bytes"]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, place long, y int"
    keys = F.broadcast(docs.sparkSession.createDataFrame(chosen, schema))
    taken = sorted(texts.join(keys, ["doc_id", "place"]).select("place", "t", "y").distinct().collect())
    total = sum(shares.values())
    return [(r["t"], int(r["y"])) for r in taken], shares.get(1, 0) / total if total else 0.5


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first column of x is the constant and is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge * len(y))
    shrink[0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + shrink * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(shrink)
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    level: int
    block: int

    def scorer(self):
        """A function from UTF-8 bytes to (compressed size with the good dictionary, with the bad one)."""
        import zstandard

        packers = []
        for d in (self.good, self.bad):
            # No checksum, size or dictionary id in the frames: only content counts.
            options = {"level": self.level, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
            if d:
                dictionary = zstandard.ZstdCompressionDict(d)
                dictionary.precompute_compress(level=self.level)
                options["dict_data"] = dictionary
            packers.append(zstandard.ZstdCompressor(**options).compress)
        good, bad = packers

        def sizes(raw: bytes) -> tuple[int, int]:
            blocks = even_blocks(raw, self.block)
            return sum(len(good(b)) for b in blocks), sum(len(bad(b)) for b in blocks)

        return sizes


def even_blocks(raw: bytes, block: int) -> list[bytes]:
    """All of `raw` in near-equal blocks of at most `block` bytes; one empty block if it is empty."""
    n = max(1, -(-len(raw) // block))
    return [raw[len(raw) * i // n : len(raw) * (i + 1) // n] for i in range(n)]


def features(good: np.ndarray, bad: np.ndarray, length: np.ndarray) -> np.ndarray:
    d = 10 * (bad - good) / (bad + good)
    size = np.log1p(length) / 8 - 1
    return np.column_stack((np.ones(len(d)), d, d * size, size))


def _trained(samples: Sequence[bytes], size: int) -> bytes:
    """A dictionary of the samples, or their raw text where there is too little to train on."""
    import zstandard

    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), list(samples), k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fit_compression(sample: Iterable[tuple[str, int]], prior: float, dictionary_bytes: int = 65_536, level: int = 3, block: int = 2048) -> CompressionModel:
    """Dictionaries from the even rows of either label, calibration on the odd ones. With one label or none the score is the prior."""
    rows = [(text_bytes(t), y) for t, y in sample]
    by_label = [[t for t, y in rows if y == k] for k in (0, 1)]
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    if min(map(len, by_label)) < 4:
        return CompressionModel(b"", b"", (float(np.log(prior / (1 - prior))), 0.0, 0.0, 0.0), level, block)
    bad, good = (_trained([b for t in texts[::2] for b in even_blocks(t, block) if b], dictionary_bytes) for texts in by_label)
    sizes = CompressionModel(good, bad, (), level, block).scorer()
    tests = [(t, y) for y in (0, 1) for t in by_label[y][1::2]]
    y = np.array([v for _, v in tests], float)
    pairs = np.array([sizes(t) for t, _ in tests], float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    w = logistic(features(pairs[:, 0], pairs[:, 1], np.array([len(t) for t, _ in tests], float)), y, weight)
    return CompressionModel(good, bad, tuple(map(float, w)), level, block)


def score_compression(docs: DataFrame, model: CompressionModel, text_col: str = "text", carry: Sequence[str] | None = None, out: str = "score") -> DataFrame:
    """`docs` (columns `carry`, all by default) with the probability of label 1. Null scores as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        sizes = model.scorer()
        w = np.array(model.weights)

        def work(batch: pa.RecordBatch) -> list:
            raws = [text_bytes(t.as_py()) for t in batch.column(0)]
            pairs = np.array([sizes(r) for r in raws], float).reshape(-1, 2)
            x = features(pairs[:, 0], pairs[:, 1], np.array([len(r) for r in raws], float))
            return [pa.array(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))]

        return work

    return append_by_batch(docs, make, [text_col], [(out, "double")], carry)


def quality_model(docs: DataFrame, labels: DataFrame, bounds: Sample = Sample()) -> CompressionModel:
    learn = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    return fit_compression(*labelled_sample(docs, labels, "quality", learn, bounds))


def quality_scores(docs: DataFrame, labels: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; learns from the rows outside the held-out fold only."""
    scored = score_compression(docs.select("doc_id", "text"), quality_model(docs, labels, bounds), carry=["doc_id"])
    return scored.select(
        "doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """The documents that the classifier accepts, with their columns and nothing else."""
    from paperloom.llm.common import free_name

    name = free_name(docs, "__quality")
    scored = score_compression(docs, quality_model(docs, labels, bounds), out=name)
    return scored.filter(column(scored, name) >= 0.5).drop(name)
