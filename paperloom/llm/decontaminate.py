"""Benchmark passages in documents, found by one Aho-Corasick automaton over the benchmark's word windows.

Words are what the contract names: lower-cased runs of ASCII letters, digits and all non-ASCII characters. Each benchmark word has
a number; the automaton's patterns are windows of numbers, a document becomes a row of numbers (0 for a word no item has, which
no pattern holds) and is scanned once. A match gives word positions, and these give character offsets in the original text.

The automaton is built in each Python worker from the items, which are broadcast. Its size is bounded by `part_words`: a benchmark
of more words is cut into parts of whole items, each with an automaton and a scan of its own, whose findings add up.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import append_by_batch, column, text_bytes

WINDOW = 13
_IS_WORD = [c >= 128 or chr(c).isalnum() for c in range(256)]
_NORMAL = bytes((c + 32 if 65 <= c <= 90 else c) if _IS_WORD[c] else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_NORMAL).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Character offsets of the normalised words in the original text (normalising keeps every byte's place)."""
    raw = text_bytes(text)
    at = np.cumsum([0] + [(b & 0xC0) != 0x80 for b in raw])  # characters begun before each byte
    return [(int(at[m.start()]), int(at[m.end()])) for m in re.finditer(rb"[^ ]+", raw.translate(_NORMAL))]


class Matcher:
    """The automaton of some items; `scan` gives the hit mask over a document's words and the numbers of the items found."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int):
        import ahocorasick

        self.ids = [i for i, _ in items]
        self.numbers: dict[bytes, int] = {}
        patterns: dict[tuple[int, ...], set[int]] = {}
        for k, (_, text) in enumerate(items):
            row = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text)]
            for i in range(max(1, len(row) - window + 1) if row else 0):
                patterns.setdefault(tuple(row[i : i + window]), set()).add(k)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, owners in patterns.items():
            self.automaton.add_word(pattern, (len(pattern), owners))
        self.empty = not patterns
        self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]] | None:
        if self.empty or not words:
            return None
        found = list(self.automaton.iter(tuple(map(self.numbers.get, words, [0] * len(words)))))
        if not found:
            return None
        edge, owners = np.zeros(len(words) + 1, np.int32), set()
        for last, (n, own) in found:
            edge[last - n + 1] += 1
            edge[last + 1] -= 1
            owners |= own
        return np.cumsum(edge[:-1]) > 0, owners


def parts_of(benchmark: DataFrame, id_col: str, text_col: str, part_words: int) -> Iterator[list[tuple[str, str]]]:
    """Items in parts of at most `part_words` words (an item is never cut); null ids count as the empty text."""
    rows = benchmark.select(
        F.coalesce(column(benchmark, id_col).cast("string"), F.lit("")).alias("id"), column(benchmark, text_col).cast("string").alias("text")
    ).filter("text is not null")
    part: list[tuple[str, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        n = len(normal_words(r["text"]))
        if part and size + n > part_words:
            yield part
            part, size = [], 0
        part.append((r["id"], r["text"]))
        size += n
    yield part


_matchers: dict[str, Matcher] = {}


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, part_words: int = 50_000, carry: Sequence[str] | None = None, with_spans: bool = True,
) -> DataFrame:
    """`docs` (columns `carry`, all by default) with n_words, n_hit (words inside an occurring window), items (sorted ids of the items
    with occurring windows), spans (maximal runs of hit words as character offsets, end exclusive; empty unless `with_spans`) and
    contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    Null and empty texts have no words; items without words have no windows; equal items are found together; an empty benchmark
    finds nothing; documents keep their number and order within a task whatever their ids. No shuffle."""
    spark = docs.sparkSession
    kept = list(docs.columns) if carry is None else list(carry)
    names = ["__n_words", "__n_hit", "__bits", "__items", "__spans"]
    kinds = ["long", "long", "binary", "array<string>", "array<struct<start:int,end:int>>"]
    state = docs
    for k, items in enumerate(parts_of(benchmark, item_id, item_text, part_words)):
        shared = spark.sparkContext.broadcast(items)
        mark = hashlib.sha256(repr((window, items)).encode()).hexdigest()
        earlier = [] if k == 0 else ["__bits", "__items"]
        outer = list(dict.fromkeys([*kept, text_col]))

        def make(shared=shared, mark=mark, first=k == 0):
            if mark not in _matchers:  # a worker keeps the automaton of its last part between tasks
                _matchers.clear()
                _matchers[mark] = Matcher(shared.value, window)
            matcher = _matchers[mark]

            def work(batch: pa.RecordBatch) -> list:
                out: list[list] = [[], [], [], [], []]
                columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
                for row in range(batch.num_rows):
                    text = columns[0][row]
                    words = normal_words(text)
                    found = matcher.scan(words)
                    bits = None if first else columns[1][row]
                    hit = np.unpackbits(np.frombuffer(bits, np.uint8))[: len(words)].astype(bool) if bits else None
                    ids = set() if first else set(columns[2][row])
                    if found:
                        hit = found[0] if hit is None else hit | found[0]
                        ids |= {matcher.ids[i] for i in found[1]}
                    spans = []
                    if hit is not None and with_spans:
                        at = word_spans(text)
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                        spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edge[::2], edge[1::2])]
                    for into, value in zip(out, (
                        len(words), 0 if hit is None else int(hit.sum()), None if hit is None else np.packbits(hit).tobytes(), sorted(ids), spans,
                    )):
                        into.append(value)
                span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                return [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), span_type))]

            return work

        added = [(f"{n}{k}", t) for n, t in zip(names, kinds)]
        source = state if k == 0 else state.withColumnsRenamed({f"{n}{k - 1}": n for n in names})
        state = append_by_batch(source, make, [text_col, *earlier], added, outer)
        last = k
    result = state.select(
        *[column(state, c) for c in kept], F.col(f"__n_words{last}").alias("n_words"), F.col(f"__n_hit{last}").alias("n_hit"),
        F.col(f"__items{last}").alias("items"), F.col(f"__spans{last}").alias("spans"),
    )
    return result.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of every document."""
    found = find_benchmark(docs.select("doc_id", "text"), benchmark, carry=["doc_id"], with_spans=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns and nothing else. No shuffle."""
    renamed = docs.toDF(*[f"d{k}" for k in range(len(docs.columns))])  # result columns may have names that documents have too
    found = find_benchmark(renamed, benchmark, text_col=f"d{docs.columns.index(text_col)}", with_spans=False)
    return found.filter(~F.col("contaminated")).select(*[F.col(f"d{k}").alias(c) for k, c in enumerate(docs.columns)])
