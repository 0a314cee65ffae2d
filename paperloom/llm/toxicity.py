"""Toxicity by a small convolutional network over hashed words, trained in numpy.

A word (lower-cased letters of any script; all other ASCII is a gap) is hashed, and so are its first four and five bytes, which
inflected and compound forms share. Its embedding is the sum of those three. Hashes that fewer than `least` sampled texts have no
embedding, so the tables are bounded by the sample and a word unlike all sampled ones is neutral. Filters of several widths slide
over the embeddings, each filter's largest response in the text is kept (max pooling over time), and a logistic layer adds the pooled
responses up. A maximum can only rise with a text's length, so a term for the length is taken off. That term and a threshold for each
language are set on all labelled rows to learn from whose texts the network was not trained on, of every length; the language is
guessed from the text's own function words, never read from a column. The score is the network's probability moved so that the
language's threshold lies at 0.5.

A filter of width w is a sum of w products, one for each place, so after training every embedding's products are tabulated once and
a text is scored by looking them up, adding neighbours and taking maxima.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import append_by_batch, column, free_name, id_remainder, text_bytes
from paperloom.llm.quality import Sample, known_labels, labelled_sample, logistic

FOLDS, HELD_OUT = 5, 0
LANGUAGES = ("en", "fr", "de", "es", "other")
# Frequent function words that tell these languages apart.
_FUNCTION_WORDS = (
    "the of and to is that with was are this from by for be",
    "et le les des du au une dans pour qui sur pas aux est",
    "der die und das den von zu mit nicht ein ist dem auf sich",
    "el los las y por una del con para es se al su como",
)
_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or 97 <= c <= 122 or 65 <= c <= 90 else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_LETTERS).split()


_LANGUAGE_OF = {w: k for k, words in enumerate(_FUNCTION_WORDS) for w in words.encode().split()}


def guessed_language(words: Sequence[bytes]) -> int:
    """Which language's function words stand in the text most often, as a place in LANGUAGES; the earlier one on a tie, the last
    one without any."""
    counts = [0] * 4
    for w in words:
        k = _LANGUAGE_OF.get(w)
        if k is not None:
            counts[k] += 1
    best = max(counts)
    return counts.index(best) if best else 4


PARTS = 3


def hashed_parts(word: bytes) -> tuple[int, int, int]:
    """64-bit hashes of the word, of its first four and of its first five bytes; each kind has hashes of its own."""
    import xxhash

    return tuple(xxhash.xxh3_64_intdigest(part, seed=k) for k, part in enumerate((word, word[:4], word[:5])))


@dataclass(frozen=True)
class Shape:
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    """Filters of each width."""
    least: int = 3
    """Sampled texts that must share a hash for it to have an embedding."""
    chance: float = 0.02
    """How likely its share of texts of label 1 may be by chance; rare words of a toxic text would be taken for its toxic ones."""


class Vocabulary:
    """Hashes to embedding rows; row 0 is what has no embedding. Remembers the rows of words, a bounded number of them."""

    def __init__(self, hashes: Sequence[int]):
        self.row_of = {h: k + 1 for k, h in enumerate(hashes)}
        self.combined: list[tuple[int, ...]] = [(0,) * PARTS]
        self.number_of = {self.combined[0]: 0}
        self.words: dict[bytes, int] = {}

    def number(self, word: bytes) -> int:
        rows = tuple(self.row_of.get(h, 0) for h in hashed_parts(word))
        n = self.number_of.get(rows)
        if n is None:
            n = self.number_of[rows] = len(self.combined)
            self.combined.append(rows)
        return n

    def __call__(self, words: list[bytes], least: int = 3) -> np.ndarray:
        """A number for each word, with neutral words up to `least` words; `combined` has the PARTS rows of each number, 0 is neutral."""
        known = self.words
        if len(known) > 300_000:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            for k, n in enumerate(out):
                if n is None:
                    w = words[k]
                    n = known.get(w)
                    if n is None:
                        n = known[w] = self.number(w)
                    out[k] = n
        out.extend([0] * (least - len(out)))
        return np.array(out, np.int32)

    @classmethod
    def of(cls, texts: Sequence[tuple[list[bytes], int]], shape: Shape) -> tuple[Vocabulary, list[int]]:
        """The vocabulary of texts with labels: what `shape.least` texts share, and texts of label 1 more often than by chance."""
        seen: Counter[int] = Counter()
        toxic: Counter[int] = Counter()
        for words, y in texts:
            own = {h for w in set(words) for h in hashed_parts(w)}
            seen.update(own)
            if y:
                toxic.update(own)
        share = sum(y for _, y in texts) / max(len(texts), 1)
        hashes = sorted(h for h, n in seen.items() if n >= shape.least and chance(n, toxic[h], share) <= shape.chance)
        return cls(hashes), hashes


@lru_cache(maxsize=None)
def chance(n: int, k: int, share: float) -> float:
    """How likely at least k of n texts are of label 1 if each is with probability `share`."""
    if not 0 < share < 1:
        return 1.0
    log = np.array([lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * np.log(share) + (n - j) * np.log(1 - share) for j in range(k, n + 1)])
    return float(np.exp(log).sum())


@dataclass(frozen=True)
class Network:
    shape: Shape
    hashes: tuple[int, ...]
    embed: np.ndarray
    """One row for each hash after the neutral row."""
    kernels: tuple[np.ndarray, ...]
    """For each width, (width, dim, filters)."""
    offsets: np.ndarray
    out: np.ndarray
    bias: float
    thresholds: np.ndarray
    """Log-odds for each of LANGUAGES that counts as even, for a text of length_of() zero."""
    slope: float = 0.0
    """What a unit of length_of() adds to them."""

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A trained network with its vocabulary and, for each combination of rows that a word has had, the products of its embedding."""

    def __init__(self, net: Network):
        self.net, self.vocabulary = net, Vocabulary(net.hashes)
        self.width = max(net.shape.widths)
        self.products = [[np.ascontiguousarray(net.embed @ k[j], np.float32) for j in range(len(k))] for k in net.kernels]
        self.tables: list[list[np.ndarray]] = []
        self.tabled = self.filled = 0

    def log_odds(self, words: list[bytes]) -> float:
        numbers = self.vocabulary(words, self.width)
        if self.tabled < len(self.vocabulary.combined):
            # Twice as many as needed, so that the table is made anew a logarithmic number of times only.
            self.tabled = 2 * len(self.vocabulary.combined)
        if not self.tables or len(self.tables[0][0]) < self.tabled:
            rows = np.zeros((self.tabled, PARTS), np.int32)
            rows[: len(self.vocabulary.combined)] = self.vocabulary.combined
            self.filled = len(self.vocabulary.combined)
            self.tables = [[p[rows].sum(1) for p in own] for own in self.products]
        elif self.filled < len(self.vocabulary.combined):
            rows = np.array(self.vocabulary.combined[self.filled :], np.int32)
            for table, own in zip(self.tables, self.products):
                for t, p in zip(table, own):
                    t[self.filled : self.filled + len(rows)] = p[rows].sum(1)
            self.filled += len(rows)
        if len(numbers) > 4 * self.width:
            # Neutral words all respond alike: keep those near others, and one stretch of them.
            near = numbers != 0
            known = near.copy()
            for j in range(1, self.width):
                near[j:] |= known[:-j]
                near[:-j] |= known[j:]
            near[np.flatnonzero(~near)[: self.width]] = True
            numbers = numbers[near]
        v, _ = pooled(self.tables, numbers[:, None])
        return float(leaky(v + self.net.offsets) @ self.net.out + self.net.bias)


SLOPE = 0.1


def leaky(x: np.ndarray) -> np.ndarray:
    """The filters' activation; its slope below zero keeps words that no filter has learnt yet learnable."""
    return np.where(x > 0, x, SLOPE * x)


def pooled(tables: list[list[np.ndarray]], rows: np.ndarray, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest response in the text and where it starts (the first on a tie), a stretch of words at a time."""
    best, place = [], []
    for own in tables:
        width, n = len(own), len(rows) - len(own) + 1
        top = at = None
        for a in range(0, n, step):
            b = min(a + step, n)
            r = sum(own[j][rows[a + j : b + j, k]] for j in range(width) for k in range(rows.shape[1]))
            k = r.argmax(0)
            v = r[k, np.arange(r.shape[1])]
            if top is None:
                top, at = v, k + a
            else:
                better = v > top
                top, at = np.where(better, v, top), np.where(better, k + a, at)
        best.append(top)
        place.append(at)
    return np.concatenate(best), np.concatenate(place)


def train(rows: Sequence[tuple[np.ndarray, int]], hashes: list[int], shape: Shape, epochs: int = 10, batch: int = 16, rate: float = 0.05, drop: float = 0.4, seed: int = 7) -> Network:
    """Adagrad on the log loss. Only the words at the pooled places carry gradients, so a long text costs one forward pass."""
    rng = np.random.default_rng(seed)
    per, n_widths = shape.filters, len(shape.widths)
    embed = rng.normal(0, 0.02, (len(hashes) + 1, shape.dim)).astype(np.float32)
    embed[0] = 0
    kernels = [rng.normal(0, 0.3, (w, shape.dim, per)).astype(np.float32) for w in shape.widths]
    offsets, out, bias = np.zeros(per * n_widths), np.abs(rng.normal(0, 0.3, per * n_widths)), 0.0
    seen_e, seen_k = np.full(embed.shape, 1e-4, np.float32), [np.full(k.shape, 1e-4, np.float32) for k in kernels]
    seen_o, seen_w, seen_b = np.full(offsets.shape, 1e-4), np.full(out.shape, 1e-4), 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            group = order[start : start + batch]
            used = np.unique(np.concatenate([[0], *(rows[i][0].ravel() for i in group)]))
            local, zero = embed[used], np.searchsorted(used, 0)
            tables = [[local @ k[j] for j in range(len(k))] for k in kernels]
            g_e, g_k = np.zeros_like(local), [np.zeros_like(k) for k in kernels]
            g_o, g_w, g_b = np.zeros_like(offsets), np.zeros_like(out), 0.0
            moved, pushes = [], []
            for i in group:
                ids, y = np.searchsorted(used, rows[i][0]), rows[i][1]
                if y:  # words left out at random: one strong word must not hide the others from training
                    ids = np.where(rng.random((len(ids), 1)) < drop, zero, ids)
                v, at = pooled(tables, ids)
                act = leaky(v + offsets)
                err = 1 / (1 + np.exp(-np.clip(act @ out + bias, -30, 30))) - y
                g_w += err * act
                g_b += err
                back = err * out * np.where(act > 0, 1, SLOPE)
                g_o += back
                for w, k in enumerate(kernels):
                    own = slice(w * per, (w + 1) * per)
                    words = ids[at[own][:, None] + np.arange(len(k))]  # filter, place, part
                    g = back[own].astype(np.float32)[:, None, None]
                    g_k[w] += (g * local[words].sum(2)).transpose(1, 2, 0)
                    moved.append(words.ravel())
                    pushes.append(np.repeat((g * k.transpose(2, 0, 1)).reshape(-1, shape.dim), PARTS, axis=0))
            np.add.at(g_e, np.concatenate(moved), np.concatenate(pushes))
            size = len(group)
            g_e /= size
            seen_e[used] += g_e**2
            embed[used] -= rate * g_e / np.sqrt(seen_e[used])
            embed[0] = 0
            for w in range(n_widths):
                g = g_k[w] / size + 1e-4 * kernels[w]
                seen_k[w] += g**2
                kernels[w] -= rate * g / np.sqrt(seen_k[w])
            for value, g, seen in ((offsets, g_o / size, seen_o), (out, g_w / size + 1e-4 * out, seen_w)):
                seen += g**2
                value -= rate * g / np.sqrt(seen)
            np.maximum(out, 0, out=out)  # filters speak for toxicity alone: what else a long text holds takes nothing back
            seen_b += (g_b / size) ** 2
            bias -= rate * (g_b / size) / np.sqrt(seen_b)
    # Embeddings that training hardly moved are noise of the start: such hashes become neutral.
    moved = np.flatnonzero(np.sqrt((embed[1:] ** 2).sum(1)) > 0.15)
    kept = np.concatenate((embed[:1], embed[1:][moved]))
    return Network(shape, tuple(hashes[k] for k in moved), kept, tuple(kernels), offsets, out, float(bias), np.zeros(len(LANGUAGES)))


def length_of(words: int) -> float:
    return float(np.log1p(words)) - 5


def best_threshold(odds: np.ndarray, y: np.ndarray, weight: np.ndarray, around: float, strength: float) -> float:
    """The cut with the smallest weighted error, held towards `around` by `strength` errors for each unit of distance; the middle
    of the best gap between different neighbouring values."""
    if not len(odds):
        return around
    order = np.argsort(odds, kind="stable")
    o, yy, w = odds[order], y[order], weight[order]
    cuts = np.concatenate(([o[0] - 1], (o[1:] + o[:-1]) / 2, [o[-1] + 1]))
    missed = np.concatenate(([0], np.cumsum(w * (yy == 1))))
    wrong = (w * (yy == 0)).sum() - np.concatenate(([0], np.cumsum(w * (yy == 0))))
    apart = np.concatenate(([True], o[1:] > o[:-1], [True]))  # a cut between equal values would not part them
    return float(cuts[np.argmin(np.where(apart, missed + wrong + strength * np.abs(cuts - around), np.inf))])


def calibrated(odds: np.ndarray, size: np.ndarray, language: np.ndarray, y: np.ndarray, times: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Thresholds of LANGUAGES with the smallest weighted error, and the length's slope, which is that of a logistic curve over log-odds
    and length and never negative; `times` counts rows of a kind."""
    share = float((times * (y == 1)).sum() / times.sum())
    weight = times * np.where(y == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    by_odds, by_size = logistic(np.column_stack((np.ones(len(odds)), odds, size)), y, weight)[1:]
    slope = max(0.0, float(-by_size / by_odds)) if by_odds > 0 else 0.0
    level = odds - slope * size
    overall = best_threshold(level, y, weight, 0.0, 0.1)
    return np.array([best_threshold(level[language == k], y[language == k], weight[language == k], overall, 0.5) for k in range(len(LANGUAGES))]), slope


def fit_network(sample: Sequence[tuple[str, int]], prior: float, shape: Shape = Shape()) -> Network:
    """Four fifths of the sample train the network, the rest sets the thresholds. With one label or none every score is the prior."""
    words = [plain_words(t) for t, _ in sample]
    vocabulary, hashes = Vocabulary.of([(w, sample[k][1]) for k, w in enumerate(words) if k % 5], shape)
    numbers = [vocabulary(w, max(shape.widths)) for w in words]
    combined = np.array(vocabulary.combined, np.int32)
    rows = [(combined[n], y) for n, (_, y) in zip(numbers, sample)]
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    if min(sum(y == k for _, y in rows) for k in (0, 1)) < 5:
        net = train([], hashes, shape)
        return Network(shape, net.hashes, net.embed, net.kernels, net.offsets, np.zeros_like(net.out), float(np.log(prior / (1 - prior))), net.thresholds)
    tests = [k % 5 == 0 for k in range(len(rows))]
    net = train([r for r, t in zip(rows, tests) if not t], hashes, shape)
    scorer = net.scorer()
    held = [k for k, t in enumerate(tests) if t]
    odds = np.array([scorer.log_odds(words[k]) for k in held])
    y = np.array([rows[k][1] for k in held])
    language = np.array([guessed_language(words[k]) for k in held])
    size = np.array([length_of(len(words[k])) for k in held])
    cuts, slope = calibrated(odds, size, language, y, np.ones(len(y)), prior)
    return replace(net, thresholds=cuts, slope=slope)


def trained_texts(sample: Sequence[tuple[str, int]]) -> frozenset[int]:
    """Hashes of the texts that `fit_network` trains on."""
    import xxhash

    return frozenset(xxhash.xxh3_64_intdigest(text_bytes(t)) for k, (t, _) in enumerate(sample) if k % 5)


def recalibrated(net: Network, docs: DataFrame, known: DataFrame, trained: frozenset[int], prior: float) -> Network:
    """Thresholds and slope from all rows of `docs` with a label in `known` whose texts are not among the trained ones. What reaches the
    driver is a count for each language, quarter of length and hundredth of log-odds."""
    shared = docs.sparkSession.sparkContext.broadcast((net, trained))

    def make():
        import xxhash

        net, trained = shared.value
        scorer = net.scorer()

        def work(batch: pa.RecordBatch) -> list:
            odds, size, language = [], [], []
            for text in batch.column(0):
                t = text.as_py()
                words = plain_words(t)
                new = xxhash.xxh3_64_intdigest(text_bytes(t)) not in trained
                odds.append(round(scorer.log_odds(words), 2) if new else None)
                size.append(round(4 * length_of(len(words))) / 4)
                language.append(guessed_language(words))
            return [pa.array(odds, pa.float64()), pa.array(size, pa.float64()), pa.array(language, pa.int32())]

        return work

    scored = append_by_batch(docs.select("doc_id", "text"), make, ["text"], [("odds", "double"), ("size", "double"), ("language", "int")], ["doc_id"])
    counts = scored.filter("odds is not null").join(known, "doc_id").groupBy("odds", "size", "language", "y").agg(F.count("*").alias("n")).collect()
    odds, size, language, y, n = (np.array([r[c] for r in counts]) for c in ("odds", "size", "language", "y", "n"))
    if not len(counts) or min(n[y == k].sum() for k in (0, 1)) < 5:
        return net
    cuts, slope = calibrated(odds, size, language, y, n, min(max(prior, 1e-3), 1 - 1e-3))
    return replace(net, thresholds=cuts, slope=slope)


def score_toxicity(docs: DataFrame, net: Network, text_col: str = "text", carry: Sequence[str] | None = None, out: str = "score") -> DataFrame:
    """`docs` (columns `carry`, all by default) with the probability of label 1; null scores as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        net = shared.value
        scorer = net.scorer()

        def one(text: str | None) -> float:
            words = plain_words(text)
            odds = scorer.log_odds(words) - net.thresholds[guessed_language(words)] - net.slope * length_of(len(words))
            return 1 / (1 + np.exp(-min(max(odds, -30), 30)))

        return lambda batch: [pa.array([one(t.as_py()) for t in batch.column(0)], pa.float64())]

    return append_by_batch(docs, make, [text_col], [(out, "double")], carry)


BOUNDS = Sample(rows=1000, max_bytes=None, total_bytes=1 << 23)


def toxicity_model(docs: DataFrame, labels: DataFrame, bounds: Sample = BOUNDS) -> Network:
    learn = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    sample, prior = labelled_sample(docs, labels, "toxic", learn, bounds)
    net = fit_network(sample, prior)
    if not net.out.any():
        return net
    return recalibrated(net, docs.filter(learn & F.col("text").isNotNull()), known_labels(labels, "toxic"), trained_texts(sample), prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame, bounds: Sample = BOUNDS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; learns from the rows outside the held-out fold only."""
    scored = score_toxicity(docs.select("doc_id", "text"), toxicity_model(docs, labels, bounds), carry=["doc_id"])
    return scored.select(
        "doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame, bounds: Sample = BOUNDS) -> DataFrame:
    """The documents that are not found toxic, with their columns and nothing else."""
    name = free_name(docs, "__toxic")
    scored = score_toxicity(docs, toxicity_model(docs, labels, bounds), out=name)
    return scored.filter(column(scored, name) < 0.5).drop(name)
