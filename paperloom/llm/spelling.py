"""Spelling variants: words one inserted, deleted or replaced letter apart, by bit-sliced position indexes.

Two words at distance one agree on all letters before the change and on all after it, so that they share their first or their last
`L // 2` letters, L being the shorter length. Words meet in groups by (L, side, those letters). In a group an index holds one bit set
for each (position, letter), one bit a word. A query walks its letters once and carries, for all words of the index at the same time,
the set that agrees so far and the sets that agree but for one change: the changed sets read the index at a position shifted by
none, one back or one on. The bit sets are Python integers.

A group of more than `block` words is cut into blocks of the index, one task's work each; the group's words pass all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, settled

# The runs that count as words, and the numbers of the contract.
RUNS = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH, MIN_COUNT, RATIO, DAMAGED = 7, 2, 10, 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 16_384


class PositionIndex:
    """Bit sets over words of length `short` and `short + 1`, found by any query of these lengths."""

    def __init__(self, words: Sequence[str], short: int):
        self.words, self.short, self.everyone = words, short, (1 << len(words)) - 1
        self.short_words = sum(1 << j for j, w in enumerate(words) if len(w) == short) if len(words) < 64 else _bits(j for j, w in enumerate(words) if len(w) == short)
        self.long_words = self.everyone ^ self.short_words
        where: list[dict[str, list[int]]] = [{} for _ in range(short + 1)]
        for j, word in enumerate(words):
            for here, letter in zip(where, word):
                here.setdefault(letter, []).append(j)
        self.at = [{letter: _bits(js) for letter, js in here.items()} for here in where]

    def near(self, word: str) -> int:
        """The words one change from `word`, but for two words that are both of the longer length."""
        agree, at = self.everyone, self.at
        if len(word) > self.short:  # one letter more than a short word: it is left out somewhere
            dropped, before = 0, {}
            for letter, here in zip(word, at):
                dropped = dropped & before.get(letter, 0) | agree
                agree &= here.get(letter, 0)
                before = here
            return dropped & self.short_words
        replaced = added = 0
        for i, letter in enumerate(word):
            bits = at[i].get(letter, 0)
            added = (added | agree) & at[i + 1].get(letter, 0)
            both = agree & bits
            replaced = replaced & bits | agree ^ both
            agree = both
        return replaced & self.short_words | (added | agree) & self.long_words


def _bits(js) -> int:
    js = list(js)
    if not js:
        return 0
    raw = bytearray((max(js) >> 3) + 1)
    for j in js:
        raw[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(raw, "little")


def members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def damaged_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, damaged: int | None = DAMAGED) -> DataFrame:
    """One row (word) for each run of letters of at least `min_length` code points, A-Z in lower case.

    With `damaged`, a run whose crc32 of `<id>:<run>` that number divides loses one code point first. A null text has no runs; a null
    id counts as empty text. Shorter runs can only get shorter, so they are not even taken out of the text."""
    runs = docs.select(
        F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("d"),
        F.explode(F.regexp_extract_all(column(docs, text_col), F.lit(f"{RUNS}{{{min_length},}}"), F.lit(0))).alias("run"),
    ).select("d", F.translate("run", UPPER, LOWER).alias("w"))
    if damaged is None:
        return runs.select(F.col("w").alias("word"))
    h = F.crc32(F.concat_ws(":", "d", "w").cast("binary"))
    kept = runs.select("w", h.alias("h")).select("w", "h", (F.col("h") % F.char_length("w")).cast("int").alias("p"))
    shorter = F.concat(F.substring(F.col("w"), F.lit(1), F.col("p")), F.substring(F.col("w"), F.col("p") + 2, F.char_length("w")))
    word = F.when(F.col("h") % damaged == 0, shorter).otherwise(F.col("w"))
    return kept.select(word.alias("word")).filter(F.char_length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least `min_count` times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _meeting_keys(min_length: int) -> Column:
    """The groups of a word: as the shorter and as the longer of a pair, by its first and by its last letters."""
    word, m = F.col("word"), F.char_length("word")
    by_length = F.filter(F.array(m, m - 1), lambda x: x >= min_length)

    def two(short: Column) -> Column:
        half = F.floor(short / 2).cast("int")
        return F.array(
            F.struct(short.alias("short"), F.lit("first").alias("side"), F.substring(word, F.lit(1), half).alias("part")),
            F.struct(short.alias("short"), F.lit("last").alias("side"), F.substring(word, m - half + 1, half).alias("part")),
        )

    return F.explode(F.flatten(F.transform(by_length, two)))


def near_words(vocab: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) for each word of `vocab` (word, n; distinct) that has near words: their number, and the one with the
    largest n (ties: the first in code-point order). Words shorter than `min_length` (at least 2) are near nothing.

    A pair is counted in one group only: by its first letters if it shares them, else by its last."""
    if min_length < 2:
        raise ValueError("words of one letter share no half")
    keyed = vocab.filter(F.char_length("word") >= min_length).select("word", "n", _meeting_keys(min_length).alias("k")).select("word", "n", "k.*")
    key = ["short", "side", "part"]
    crowded = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    places = F.when(F.col("size").isNull(), F.array(F.struct(F.lit(0).alias("b"), F.lit(0).alias("turn")))).otherwise(
        F.concat(F.array(F.struct(own.alias("b"), F.lit(0).alias("turn"))), F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(b.alias("b"), F.lit(1).alias("turn"))))
    )
    dealt = keyed.join(crowded, key, "left").withColumn("at", F.explode(places)).select(*key, "at.b", "at.turn", "word", "n", F.col("size").isNotNull().alias("cut"))
    dealt = dealt.repartition(*key, "b").sortWithinPartitions(*key, "b", "turn")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, counts, index = None, [], [], None
        found: list[tuple[str, int, int, str]] = []

        def ask(group: tuple, word: str) -> None:
            _, side, part, _ = group
            count, best_n, best = 0, 0, ""
            for j in members(index.near(word)):
                other = words[j]
                if side == "last" and other[: len(part)] == word[: len(part)]:
                    continue
                count += 1
                if counts[j] > best_n or counts[j] == best_n and other < best:
                    best_n, best = counts[j], other
            if count:
                found.append((word, count, best_n, best))

        def ready(group: tuple) -> None:
            nonlocal index
            index = PositionIndex(words, group[0])

        def finish(group: tuple | None, was_cut: bool) -> None:
            if group is not None and not was_cut and len(words) > 1:
                ready(group)
                for word in words:
                    ask(group, word)

        def rows() -> pa.RecordBatch:
            nonlocal found
            columns = [list(c) for c in zip(*found)] or [[], [], [], []]
            found = []
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"])

        was_cut = False
        for batch in batches:
            for short, side, part, b, turn, word, n, cut in zip(*(c.to_pylist() for c in batch.columns)):
                group = (short, side, part, b)
                if group != current:
                    finish(current, was_cut)
                    current, was_cut, words, counts, index = group, cut, [], [], None
                if turn == 0:
                    words.append(word)
                    counts.append(n)
                else:
                    if index is None:
                        ready(group)
                    ask(group, word)
            if len(found) >= 4096:
                yield rows()
        finish(current, was_cut)
        yield rows()

    parts = dealt.mapInArrow(look_up, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("m")).select("word", "n_near", (-F.col("m.less")).alias("best_n"), F.col("m.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by pointer doubling. Counts grow tenfold along a chain, so that it has
    at most 18 links and five rounds reach its end."""
    at = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settled(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        at = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            return at


def group_variants(vocab: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of `vocab` (word, n; distinct words, no nulls).

    A word's form is its near word of largest n if that is at least `ratio` times its own n (ratio over 1), else null; the root is the
    last form along the chain, the word itself if it has none. An empty vocabulary gives no rows."""
    near = vocab.join(near_words(vocab, min_length, block), "word", "left")
    fits = F.col("best_n") >= F.col("n") * ratio
    formed = settled(near.select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n"),
    ))
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, damaged: int | None = DAMAGED) -> DataFrame:
    """The variants among the words of whole texts, see `damaged_words` and `group_variants`."""
    return group_variants(settled(vocabulary(damaged_words(docs, id_col, text_col, damaged=damaged))), block=block)
