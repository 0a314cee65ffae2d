"""Log-bilinear neural language model, trained in numpy with noise-contrastive estimation.

    p(word | two words before) = p(class of the word | classes of the two) * p(word | its class)

The first factor is the network: each class has a context vector and an output vector, the context is a sum of the two context
vectors through one matrix a place, and the score of a class is the product with its output vector. Frequent words and the end of a
text are classes of their own; all other words share classes by their spelling (first two characters, last one), so the network's
size is fixed whatever the vocabulary. The second factor comes from counts over all training tokens, with one left for the unseen.

Training: counts of all words (pre-aggregated in the tasks); a warm start on a small sample; then every task goes once over all its
training tokens from there, and the tasks' parameters are averaged by their tokens. Scores are normalised: the sums over all classes
come from batched matrix products over every pair of context classes, once, into a table of fixed size.

Counts of frequent words (at least a millionth of all tokens, so at most a million words) are broadcast; the rest meets the tail of
each document's words in a join.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, id_remainder, words_of
from paperloom.session import cut_lineage

FOLDS, HELD_OUT = 7, 2
END = b""
"""The end of a text as a token; no word is empty."""


@dataclass(frozen=True)
class Sizes:
    singles: int = 255
    """Most frequent words with classes of their own, besides the end."""
    spellings: int = 256
    dim: int = 16
    noise: int = 32
    """Noise classes drawn for each batch and shared by its rows."""
    batch: int = 1024
    head_share: float = 1e-6
    warm_rows: int = 300
    warm_bytes: int = 16_384
    """The warm start reads this many texts of at most this size; the pass over all tokens follows."""
    warm_epochs: int = 12
    rate: float = 0.2
    piece: int = 65_536
    """Tokens a task scores at a time."""

    @property
    def classes(self) -> int:
        return 1 + self.singles + self.spellings


class Classes:
    """Words to classes: 0 is the end, then the single words, then the spellings (first two characters and the last one)."""

    def __init__(self, singles: list[bytes], sizes: Sizes):
        self.sizes = sizes
        self.known = pa.array([END, *singles], pa.binary())

    def __call__(self, words: pa.Array | list[bytes]) -> np.ndarray:
        words = pa.array(words, pa.binary()) if isinstance(words, list) else words
        out = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = np.flatnonzero(out < 0)
        if len(other):
            text = words.take(pa.array(other)).cast(pa.string())
            spelling = pc.binary_join_element_wise(pc.utf8_slice_codeunits(text, 0, 2), pc.utf8_slice_codeunits(text, -1), "\x00").dictionary_encode()
            crcs = np.array([zlib.crc32(x.encode()) for x in spelling.dictionary.to_pylist()], np.int64)
            out[other] = 1 + self.sizes.singles + crcs[spelling.indices.to_numpy()] % self.sizes.spellings
        return out


def word_runs(texts: pa.Array, tokens: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """All texts in runs of about `tokens` tokens: number of texts, tokens of each with its end, and every token as a code into the run's
    distinct words, which follow. A text counts as a token for every four bytes, and can not have more than twice as many."""
    if not len(texts):
        return
    texts, space = pc.fill_null(texts, ""), [pa.scalar(x, texts.type) for x in ("", " ")]
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) // 4 + 1)
    done = 0
    while done < len(texts):
        stop = min(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + tokens)) + 1, len(texts))
        own = pc.ascii_trim_whitespace(pc.ascii_lower(texts.slice(done, stop - done)))
        # One space behind the last word makes one empty word, the end; a text without words is that empty word itself.
        words = pc.ascii_split_whitespace(pc.if_else(pc.equal(own, space[0]), own, pc.binary_join_element_wise(own, *space)))
        coded = words.flatten().dictionary_encode()
        yield stop - done, pc.list_value_length(words).to_numpy().astype(np.int64), coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
        done = stop


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class one and two places before each token; before a text stand ends."""
    one = np.concatenate((np.zeros(1, classes.dtype), classes[:-1]))
    return one, np.concatenate((np.zeros(1, classes.dtype), one[:-1]))


@dataclass(frozen=True)
class Network:
    context: np.ndarray
    output: np.ndarray
    places: np.ndarray
    """One matrix for each of the two places."""
    bias: np.ndarray

    @classmethod
    def fresh(cls, noise: np.ndarray, dim: int, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        k = len(noise)
        near_one = np.stack([np.eye(dim), np.eye(dim) * 0.5]) + rng.normal(0, 0.02, (2, dim, dim))
        return cls(*(a.astype(np.float32) for a in (rng.normal(0, 0.3, (k, dim)), rng.normal(0, 0.3, (k, dim)), near_one, np.log(noise))))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.context, self.output, self.places, self.bias

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores (class before, class) of either place; the bias is in the first."""
        first, second = (self.context @ m @ self.output.T for m in self.places)
        return (first + self.bias).astype(np.float32), second.astype(np.float32)

    def mean_log(self, two: np.ndarray, one: np.ndarray, target: np.ndarray) -> float:
        """Mean normalised log-probability of these next classes."""
        s = (self.context[one] @ self.places[0] + self.context[two] @ self.places[1]) @ self.output.T + self.bias
        top = s.max(1)
        return float((s[np.arange(len(target)), target] - top - np.log(np.exp(s - top[:, None]).sum(1))).mean())

    def normalisers(self) -> np.ndarray:
        """log of the sum over all classes of exp(score), for (two before, one before), a batched product and sum each row."""
        one, two = self.context @ self.places[0], self.context @ self.places[1]
        out = np.empty((len(two), len(one)), np.float32)
        for k in range(len(two)):
            s = (one + two[k]) @ self.output.T + self.bias
            top = s.max(1)
            out[k] = top + np.log(np.exp(s - top[:, None]).sum(1))
        return out


class Trainer:
    """Noise-contrastive estimation: tell a text's next class from `noise` drawn by frequency, with Adagrad steps."""

    def __init__(self, net: Network, noise: np.ndarray, sizes: Sizes, seed: int, seen: tuple[np.ndarray, ...] | None = None):
        self.net = Network(*(a.copy() for a in net.parts()))
        self.seen = tuple(a.copy() for a in seen) if seen else tuple(np.full(a.shape, 1e-6, np.float32) for a in net.parts())
        self.noise, self.sizes = noise.astype(np.float64), sizes
        self.edges = np.cumsum(self.noise) / self.noise.sum()
        self.shift = np.log(sizes.noise * self.noise).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def step(self, two: np.ndarray, one: np.ndarray, target: np.ndarray) -> None:
        net, n, k = self.net, np.float32(len(target)), len(self.shift)
        c1, c2 = net.context.take(one, 0), net.context.take(two, 0)
        q = c1 @ net.places[0] + c2 @ net.places[1]
        out = net.output.take(target, 0)
        drawn = np.minimum(np.searchsorted(self.edges, self.rng.random(self.sizes.noise)), k - 1)
        off = net.output[drawn]
        level = net.bias - self.shift
        real = -1 / (1 + np.exp(np.minimum((q * out).sum(1) + level[target], 30))) / n
        fake = q @ off.T  # 1 / (1 + exp(min(-(fake + level), 30))) / n, in place
        fake += level[drawn]
        np.minimum(np.negative(fake, out=fake), 30, out=fake)
        np.exp(fake, out=fake)
        fake += 1
        np.divide(1, fake, out=fake)
        fake /= n
        dq = real[:, None] * out + fake @ off
        d_out = by_class(target, real[:, None] * q, k) + by_class(drawn, fake.T @ q, k)
        d_bias = (np.bincount(target, real, k) + np.bincount(drawn, fake.sum(0), k)).astype(np.float32)
        d_ctx = by_class(one, dq @ net.places[0].T, k) + by_class(two, dq @ net.places[1].T, k)
        d_places = np.stack((c1.T @ dq, c2.T @ dq))
        rate = np.float32(self.sizes.rate)
        for value, seen, g in zip(net.parts(), self.seen, (d_ctx, d_out, d_places, d_bias)):
            seen += g * g
            value -= rate * g / np.sqrt(seen)
        self.tokens += len(target)

    def learn(self, texts: list[np.ndarray]) -> None:
        """Steps over the tokens of these texts' classes, shuffled."""
        if not texts:
            return
        pairs = [contexts(t) for t in texts]
        one, two, target = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), np.concatenate(texts)
        order = self.rng.permutation(len(target))
        for a in range(0, len(order), self.sizes.batch):
            rows = order[a : a + self.sizes.batch]
            self.step(two.take(rows), one.take(rows), target.take(rows))


def by_class(classes: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each class."""
    order = np.argsort(classes.astype(np.min_scalar_type(k)), kind="stable")  # of 16 bits and less, a radix sort
    own = classes.take(order)
    start = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
    out = np.zeros((k, rows.shape[1]), np.float32)
    out[own[start]] = np.add.reduceat(rows.take(order, 0), start, axis=0)
    return out


def word_counts(texts: DataFrame, piece: int = 1 << 21) -> DataFrame:
    """(word, n) over all texts (column `t`), the end of each counted as a word of its own; summed in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, codes, words in word_runs(batch.column(0), piece):
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    sizes: Sizes
    tokens: int
    distinct: int
    head: dict[bytes, int]
    """Counts of the frequent words (and of the end)."""
    singles: list[bytes]
    log_class: np.ndarray
    """log10 of what a word's count + 1 is divided by within each class."""
    network: Network
    normaliser: np.ndarray


def class_totals(counts: DataFrame, singles: list[bytes], sizes: Sizes) -> np.ndarray:
    """(tokens, distinct words) of each class over the whole vocabulary."""
    shared = counts.sparkSession.sparkContext.broadcast(singles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total, distinct = Classes(shared.value, sizes), np.zeros(sizes.classes), np.zeros(sizes.classes)
        for batch in batches:
            c = classes(batch.column(0))
            total += np.bincount(c, batch.column(1).to_numpy(), sizes.classes)
            distinct += np.bincount(c, minlength=sizes.classes)
        yield pa.RecordBatch.from_arrays([pa.array(range(sizes.classes), pa.int32()), pa.array(total.astype(int)), pa.array(distinct.astype(int))], names=["c", "n", "v"])

    out = np.zeros((sizes.classes, 2))
    for r in counts.mapInArrow(run, "c int, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        out[r["c"]] = r["n"], r["v"]
    return out


def warm_start(rows: list[np.ndarray], noise: np.ndarray, sizes: Sizes) -> Trainer:
    """Epochs over four fifths of the texts; the state that does best on the rest (8,192 tokens of it at most) is kept."""
    tests = [contexts(t)[::-1] + (t,) for t in rows[::5]]
    held = [np.concatenate(c)[:8192] for c in zip(*tests)] if tests else []
    trainer = Trainer(Network.fresh(noise, sizes.dim), noise, sizes, seed=1)
    best = Trainer(trainer.net, noise, sizes, 1, trainer.seen)
    top = best.net.mean_log(*held) if held else 0.0
    for _ in range(sizes.warm_epochs if held else 0):
        trainer.learn([t for k, t in enumerate(rows) if k % 5])
        now = trainer.net.mean_log(*held)
        if now > top:
            best, top = Trainer(trainer.net, noise, sizes, 1, trainer.seen), now
    return best


def train_network(texts: DataFrame, noise: np.ndarray, singles: list[bytes], sizes: Sizes) -> Network:
    """Warm start on a bounded sample, then one pass over all texts (column `t`) in every task, then the average by tokens."""
    sample = texts.filter(F.octet_length("t") <= sizes.warm_bytes).orderBy(F.xxhash64("t"), "t").limit(sizes.warm_rows).collect()
    classes = Classes(singles, sizes)
    rows = [classes([*words_of(r["t"]), END]) for r in sample]
    best = warm_start(rows, noise, sizes)
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((best.net, best.seen, noise, singles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen, noise, singles = shared.value
        classes, own = Classes(singles, sizes), Trainer(net, noise, sizes, seed=2, seen=seen)
        waiting, held = [], 0
        for batch in batches:
            for _, lengths, codes, words in word_runs(batch.column(0), sizes.piece):
                c = classes(words)[codes]
                for start, n in zip(np.cumsum(lengths) - lengths, lengths):
                    waiting.append(c[start : start + n])
                    held += n
                    if held >= 16 * sizes.batch:
                        own.learn(waiting)
                        waiting, held = [], 0
        own.learn(waiting)
        if own.tokens:
            yield _sent(own.tokens, own.net)

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((n.as_py(), pickle.loads(p.as_py())) for b in batches for n, p in zip(b.column(0), b.column(1)))
        total, net = _mean(rows)
        if net:
            yield _sent(total, net)

    tasks = texts.mapInArrow(run, "tokens long, net binary")
    few = tasks.repartition(16).mapInArrow(average, "tokens long, net binary").collect()
    return _mean((r["tokens"], pickle.loads(r["net"])) for r in few)[1] or best.net


def _sent(tokens: int, net: Network) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([pickle.dumps(net)], pa.binary())], names=["tokens", "net"])


def _mean(rows: Iterator[tuple[int, Network]]) -> tuple[int, Network | None]:
    total, sums = 0, None
    for n, net in rows:
        parts = [a.astype(np.float64) * n for a in net.parts()]
        sums = parts if sums is None else [a + b for a, b in zip(sums, parts)]
        total += n
    return total, Network(*((a / total).astype(np.float32) for a in sums)) if total else None


def fit(texts: DataFrame, sizes: Sizes = Sizes()) -> tuple[Model, DataFrame]:
    """The model of `texts` (column `t`) and the counts (word, n) of their whole vocabulary, materialised."""
    counts = cut_lineage(word_counts(texts))
    sums = counts.filter("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = sums["n"] or 0, sums["v"] or 0
    frequent = counts.filter((F.col("n") >= F.lit(sizes.head_share * tokens)) & (F.col("n") > 0)).toArrow()
    head = dict(zip(frequent["word"].to_pylist(), frequent["n"].to_pylist()))
    singles = [w for _, w in sorted((-n, w) for w, n in head.items() if w != END)[: sizes.singles]]
    totals = class_totals(counts, singles, sizes)
    inside = totals[:, 0] + totals[:, 1] + 1
    alone = 1 + len(singles)
    inside[:alone] = totals[:alone, 0] + 1  # a class of one word leaves nothing for other words
    noise = (totals[:, 0] + 1) / (totals[:, 0] + 1).sum()
    network = train_network(texts, noise, singles, sizes)
    return Model(sizes, tokens, distinct, head, singles, np.log10(inside), network, network.normalisers()), counts


def scored_pieces(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """What the network and the frequent words say about the texts of batches (doc_id, t, row), with the other words of each.

    A batch holds a number of rows, whatever their length; it is scored in runs of texts of about `sizes.piece` tokens, so that a task's
    arrays do not grow with the texts."""
    sizes, ln10 = model.sizes, np.log(10)
    classes, k = Classes(model.singles, sizes), sizes.classes
    first, second, normaliser = (a.ravel() for a in (*model.network.scores(), model.normaliser))
    for batch in batches:
        done = 0
        for rows, lengths, codes, words in word_runs(batch.column(1), sizes.piece):
            counts = np.fromiter((model.head.get(w, 0) for w in words.to_numpy(zero_copy_only=False).tolist()), np.int64, len(words))
            start = np.cumsum(lengths) - lengths
            c = classes(words)[codes]
            one, two = contexts(c)
            two[start] = 0  # the token before is another text's end, of class 0 as it should be; the one before that is a word
            logs = (first.take(one * k + c) + second.take(two * k + c) - normaliser.take(two * k + one)).astype(np.float64) / ln10 - model.log_class.take(c)
            tail = counts.take(codes) == 0
            pairs, times = np.unique(np.repeat(np.arange(rows), lengths)[tail] * len(words) + codes[tail], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(rows + 1) * len(words))
            met = pa.StructArray.from_arrays([words.take(pa.array(pairs % len(words))), pa.array(times.astype(np.int64))], names=["word", "times"])
            piece = batch.slice(done, rows)
            arrays = [
                piece.column(2), piece.column(0), pa.array(lengths), pa.array(np.add.reduceat((counts > 0).astype(np.int64).take(codes), start)),
                pa.array(np.add.reduceat(logs, start)), pa.array(np.add.reduceat(np.log10(counts + 1.0).take(codes), start)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), met),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_tokens", "known", "class_log", "head_log", "tail"])
            done += rows


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_tokens, n_known, train_tokens, base_score (unigram) and score, log10 of either probability.

    A null text is the empty one (its end is still a token); rows may repeat; an empty table gives no rows; with nothing to learn
    from, every word is unknown. Extra columns are ignored."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("t"), F.monotonically_increasing_id().alias("row"))
    schema = f"row long, doc_id {kind}, n_tokens long, known long, class_log double, head_log double, tail array<struct<word:binary,times:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return scored_pieces(batches, shared.value)

    scored = cut_lineage(sent.mapInArrow(run, schema))
    rare = counts.filter(F.col("n") < F.lit(model.sizes.head_share * model.tokens))
    tail = scored.select("row", F.inline("tail"))
    # A word that no training text has joins nothing; its log10(0 + 1) is 0, so an inner join loses nothing.
    found = tail.join(rare, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_log"), F.sum("times").alias("tail_known")
    )
    all_log = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    even = F.lit(float(np.log10(model.tokens + model.distinct + 1)))
    return scored.drop("tail").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (all_log - F.col("n_tokens") * even).alias("base_score"), (F.col("class_log") + all_log).alias("score"),
    )


def document_scores(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """The scores of all documents, learnt from those outside the held-out fold."""
    learn = docs.filter(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT).select(F.coalesce("text", F.lit("")).alias("t"))
    model, counts = fit(learn, sizes)
    scored = score(docs.select("doc_id", "text"), model, counts)
    return scored.withColumn("held_out", id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT)
