"""Byte-level BPE of whole texts in overlapping chunks, and back.

A text is cut every `chunk` characters; each chunk also carries the next `overlap` characters and is split into pre-tokens as if a
pre-token began at its first character. The pattern looks only forward, so once two splits share one boundary they share all later
ones: the stitcher walks on from the last boundary it is sure of until it meets one of the next chunk, and takes over that chunk's
from there. A pre-token that is longer than the overlap is walked to its end, so no length is special. The stitched pre-tokens are
encoded one by one; decoding concatenates the raw bytes of the ids.

Texts of at most `long_chars` are cut, stitched and encoded inside one task. Longer ones are dealt out: chunks are split in parallel,
stitched in order, the stitched pieces encoded in parallel and put together in order.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import append_by_batch, column

CHUNK, OVERLAP, LONG_CHARS = 65_536, 1_024, 1 << 20
LOOK_AHEAD = 2
"""How many characters after a pre-token can have a say in its end (two: an apostrophe alone, or with `ll`, `re` or `ve`)."""
_REMEMBERED = 400_000
"""Distinct pre-tokens whose ids a task keeps."""
SLICE_BYTES = 1 << 20
"""Text whose ids a task holds at a time; a longer text stands alone."""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """The vocabulary of one rank file under one split pattern."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self._tiktoken, self._source = tiktoken, pattern
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.raw[rank] = token
        self._known: dict[str, list[int]] = {}
        self._stand_ins: dict[str, str] = {}

    def shadow(self, text: str) -> str:
        """The text as the split pattern should see it here. Python's pattern library may know newer characters than the encoder's:
        a character that Python's own tables do not assign is replaced by a letter, digit or sign, as the encoder takes it."""
        if text.isascii():
            return text
        odd = {ord(c): self._stand_in(c) for c in set(text) if unicodedata.category(c) == "Cn"}
        return text.translate(odd) if odd else text

    def _stand_in(self, char: str) -> str:
        if char not in self._stand_ins:
            ranks = {bytes([b]): b for b in range(256)} | {("a" + char).encode(): 256, ("1" + char).encode(): 257}
            probe = self._tiktoken.Encoding("probe", pat_str=self._source, mergeable_ranks=ranks, special_tokens={})
            as_letter, as_digit = (len(probe.encode_ordinary(first + char)) == 1 for first in "a1")
            self._stand_ins[char] = "a" if as_letter else "1" if as_digit else "!"
        return self._stand_ins[char]

    def ends(self, text: str) -> np.ndarray:
        """Where the pre-tokens of `text` end, if one begins at its first character."""
        return np.fromiter((m.end() for m in self.pattern.finditer(self.shadow(text))), np.int32)

    def encode(self, tokens: list[str]) -> list[int]:
        """The ids of pre-tokens, one after the other."""
        ids: list[int] = []
        known = self._known
        for token in tokens:
            found = known.get(token)
            if found is None:
                found = self._encoding._encode_single_piece(token)
                if len(token) <= 64:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[token] = found
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


class Stitcher:
    """Takes the chunks of one text in order and hands out stretches of it that end on true boundaries."""

    def __init__(self, codec: Codec, chunk: int):
        self.codec, self.chunk, self.number = codec, chunk, 0
        self.start, self.held = 0, ""  # text from the last sure boundary on, as far as it is known

    def add(self, text: str, ends: np.ndarray, last: bool) -> tuple[str, np.ndarray]:
        """The next chunk with the ends of its own split: the stretch that is sure now, and the ends of its pre-tokens in it.

        A pre-token that ends within `LOOK_AHEAD` characters of the end of what is known may go on, unless this is the last chunk."""
        begin = self.number * self.chunk
        self.number += 1
        known = begin + len(text)
        held = self.held + text[self.start + len(self.held) - begin :]
        own = begin + ends.astype(np.int64)
        if not last:
            own = own[own + LOOK_AHEAD <= known]
        at, walked = self.start, []
        meets = {begin, *own.tolist()}
        if at not in meets:
            for m in self.codec.pattern.finditer(self.codec.shadow(held)):
                end = self.start + m.end()
                if end + LOOK_AHEAD > known and not last:
                    break
                walked.append(end)
                at = end
                if at in meets:
                    break
        sure = np.concatenate((np.array(walked, np.int64), own[own > at] if at in meets else own[:0]))
        if not len(sure):
            self.held = held
            return "", np.empty(0, np.int32)
        upto, begun = int(sure[-1]), self.start
        stretch, self.held = held[: upto - begun], held[upto - begun :]
        self.start = upto
        return stretch, (sure - begun).astype(np.int32)


def slices(text: str, ends: np.ndarray) -> list[str]:
    bounds = ends.tolist()
    return [text[a:b] for a, b in zip([0, *bounds], bounds)]


def chunks(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str, bool]]:
    """(number, characters, whether it is the last) of a text's overlapping chunks."""
    count = max(1, -(-len(text) // chunk))
    for k in range(count):
        yield k, text[k * chunk : (k + 1) * chunk + overlap], k == count - 1


def pre_tokens(codec: Codec, text: str, chunk: int, overlap: int) -> list[str]:
    if len(text) <= chunk and (text.isascii() or codec.shadow(text) is text):
        return codec.pattern.findall(text)
    stitcher, out = Stitcher(codec, chunk), []
    for _, part, last in chunks(text, chunk, overlap):
        out += slices(*stitcher.add(part, codec.ends(part), last))
    return out


def _encoded(codec: Codec, texts: Iterator[list[str]], with_bytes: bool) -> list[pa.Array]:
    """The ids of texts given as pre-tokens, and if asked for the bytes that these ids decode to."""
    ids, raw = [], []
    for tokens in texts:
        found = codec.encode(tokens)
        ids.append(np.array(found, np.int32))
        if with_bytes:
            raw.append(codec.decode(found))
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))
    return [lists, pa.array(raw, pa.binary())] if with_bytes else [lists]


def _slices(batch: pa.RecordBatch, texts: int) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of about `SLICE_BYTES` of its column number `texts`."""
    column = batch.column(texts)
    size = np.cumsum([0 if n is None else n for n in pc.binary_length(column).to_pylist()])
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + SLICE_BYTES, "right")))
        yield batch.slice(start, end - start)
        start = end


def encode_texts(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
    long_chars: int = LONG_CHARS, with_bytes: bool = False,
) -> DataFrame:
    """One row per row of `docs`: its id and `ids array<int>`, what the encoder gives for the whole text without special tokens, and if
    asked for `decoded binary`, the bytes that these ids stand for (as `decode_ids` gives them, in the same task).

    A null text is empty and has no ids; ids may be null or repeat; an empty table gives no rows; other columns are not looked at.
    Memory: a batch of short texts, and of a long text what one pre-token or its ids take."""
    if not 0 <= overlap <= chunk:
        raise ValueError("the overlap can not be longer than a chunk")
    sent = docs.select(column(docs, id_col).alias("d"), column(docs, text_col).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    length = F.coalesce(F.char_length("t"), F.lit(0))

    names = ["ids", "decoded"] if with_bytes else ["ids"]
    found = "ids array<int>, decoded binary" if with_bytes else "ids array<int>"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for whole in batches:
            for batch in _slices(whole, 1):
                tokens = (pre_tokens(own, t, chunk, overlap) if t else [] for t in batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), *_encoded(own, tokens, with_bytes)], names=["d", *names])

    done = sent.filter(length <= long_chars).mapInArrow(short, f"d {kind}, {found}")
    cut = sent.filter(length > long_chars).withColumn("r", F.monotonically_increasing_id())

    def to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for k, part, last in chunks(batch.column(1)[i].as_py(), chunk, overlap):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([k], pa.int64()), pa.array([part]), pa.array([last])],
                        names=["d", "r", "k", "t", "last"],
                    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            ends = [own.ends(t).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], names=["d", "r", "k", "t", "last", "ends"])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row, stitcher = codec(vocabulary, pattern), None, None
        for batch in batches:
            for i in range(batch.num_rows):
                _, r, k, text, last, ends = (c[i].as_py() for c in batch.columns)
                if r != row:
                    row, stitcher = r, Stitcher(own, chunk)
                stretch, sure = stitcher.add(text, np.frombuffer(ends, np.int32), last)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, 1) for c in batch.columns[:3]], pa.array([stretch]), pa.array([sure.tobytes()], pa.binary())],
                    names=["d", "r", "k", "t", "ends"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for whole in batches:
            for batch in _slices(whole, 3):
                tokens = (slices(t, np.frombuffer(e, np.int32)) for t, e in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_encoded(own, tokens, with_bytes)], names=["d", "r", "k", *names])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        raw: list[bytes] = []
        row = first = None

        def text_ids() -> pa.RecordBatch:
            ids = pa.ListArray.from_arrays(pa.array([0, sum(map(len, held))], pa.int32()), pa.concat_arrays(held))
            return pa.RecordBatch.from_arrays([first, ids, *([pa.array([b"".join(raw)], pa.binary())] if with_bytes else [])], names=["d", *names])

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.column(1)[i].as_py()
                if r != row:
                    if held:
                        yield text_ids()
                    row, first, held, raw = r, batch.column(0).slice(i, 1), [], []
                held.append(pa.array(batch.column(3)[i].values, pa.int32()))
                if with_bytes:
                    raw.append(batch.column(4)[i].as_py())
        if held:
            yield text_ids()

    head = f"d {kind}, r long, k long"
    parts = cut.mapInArrow(to_chunks, f"{head}, t string, last boolean").repartition("r", "k").mapInArrow(split, f"{head}, t string, last boolean, ends binary")
    parts = parts.repartition("r").sortWithinPartitions("r", "k").mapInArrow(stitch, f"{head}, t string, ends binary")
    parts = parts.repartition("r", "k").mapInArrow(encode, f"{head}, {found}").repartition("r").sortWithinPartitions("r", "k")
    joined = parts.mapInArrow(together, f"d {kind}, {found}")
    return done.unionByName(joined).toDF(id_col, *names)


def decode_ids(encoded: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` with `decoded binary`: the raw bytes of its ids, in order. Null ids give null; an id that the vocabulary does not
    have fails the query."""

    def work(batch: pa.RecordBatch) -> list:
        own = codec(vocabulary, pattern)
        return [pa.array([None if ids is None else own.decode(ids) for ids in batch.column(0).to_pylist()], pa.binary())]

    return append_by_batch(encoded, lambda: work, [ids_col], [("decoded", "binary")])


def digests(docs: DataFrame, vocabulary: str, pattern: str, **sizes: int) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of every text, see `encode_texts`."""
    both = encode_texts(docs, vocabulary, pattern, with_bytes=True, **sizes)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
