"""Token windows of near-equal fill by multiway Karmarkar-Karp differencing.

Documents are tokenised whole and cut: a long one into full windows, which stand alone, and what is left into near-equal pieces of
at most `piece` tokens. A task gathers pieces until they fill about `windows` windows and partitions them: a partial partition
holds one sum for each window, and the two with the largest differences merge, large sums with small ones, until one is left.
If its largest window exceeds the capacity, the same pieces are dealt again over one window more. Each task packs its own
documents, so there is no shuffle, and a lost task gives the same sequences again.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paperloom.llm.common import column

CAPACITY = 2048
END_ID = 1
# Fixed value: the published split pattern of this family of byte-level vocabularies.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# tiktoken's splitter backtracks through a run of white space and overflows its stack at about a million characters.
_LONG_BLANK = re.compile(r"(?:\A|\S)\s{10000}")


def _byte_letters() -> dict[str, int]:
    """Which letter a byte-level vocabulary writes for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids as `tokenizers` gives them for this file without added special tokens.

    Where the file is a plain byte-level BPE whose merges stand in the order of their ids, `tiktoken` finds the same ids several
    times faster; any other file, and a text that holds one of its special strings or a very long run of white space, goes to `tokenizers` itself."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def by_tokenizers(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    ranks = _plain_ranks(spec)
    if ranks is None:
        return by_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("plain", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t["content"] for t in spec.get("added_tokens", [])]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or _LONG_BLANK.search(text):
            return by_tokenizers(text)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def _plain_ranks(spec: dict) -> dict[bytes, int] | None:
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not spec.get("normalizer")
    plain = plain and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain:
        return None
    letters, special = _byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    for n, pair in enumerate(model["merges"]):
        token = "".join(pair.split(" ") if isinstance(pair, str) else pair)
        if model["vocab"].get(token) != 256 + n:
            return None
    return ranks


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (0 to windows - 1) of each item, sums near equal.

    Items of one window are chained: a partial partition keeps, for each window that is not empty, its sum above the smallest and
    the first and last item of its chain, so a merge joins two chains at once. Ties go to the earlier partition."""
    n = len(sizes)
    after = np.full(n, -1, np.int64)
    heap = [(-int(s), k, np.array([s], np.int64), np.array([k]), np.array([k])) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, sum_a, head_a, tail_a = heapq.heappop(heap)
        _, _, sum_b, head_b, tail_b = heapq.heappop(heap)
        # Both are kept with sums falling; b's run backwards over the windows, so its largest meets a's smallest.
        spare = windows - len(sum_a)
        meet = len(sum_b) - spare
        if meet <= 0:
            sums, head, tail = np.concatenate((sum_a, sum_b)), np.concatenate((head_a, head_b)), np.concatenate((tail_a, tail_b))
        else:
            sums = np.concatenate((sum_a, sum_b[:spare]))
            head, tail = np.concatenate((head_a, head_b[:spare])), np.concatenate((tail_a, tail_b[:spare]))
            at = np.arange(len(sum_a) - 1, len(sum_a) - 1 - meet, -1)
            after[tail[at]] = head_b[spare:]
            sums[at] += sum_b[spare:]
            tail[at] = tail_b[spare:]
        order = np.argsort(-sums, kind="stable")
        sums, head, tail = sums[order], head[order], tail[order]
        if len(sums) == windows:
            sums = sums - sums[-1]  # only differences matter from here on
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == windows else 0)), serial, sums, head, tail))
        serial += 1
    window = np.zeros(n, np.int64)
    for w, item in enumerate(heap[0][3] if heap else ()):
        while item >= 0:
            window[item] = w
            item = after[item]
    return window


def fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of `sizes`, none above the capacity; their number rises by one for as long as one would be."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, count)
        if np.bincount(window, weights=sizes, minlength=count).max() <= capacity:
            return window
        count += 1


def cuts(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then near-equal pieces of at most `piece`."""
    full = tokens // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    rest = tokens - full * capacity
    parts = -(-rest // piece)
    edge = [full * capacity + rest * i // parts for i in range(parts + 1)] if parts else []
    return out + [(a, b - a) for a, b in zip(edge, edge[1:])]


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, piece: int = 512,
    windows: int = 128, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A null or empty text is the end token alone; ids may be null or repeat (each row is a document of its own); an empty table
    gives no rows. A sequence is what its pieces fill; the caller pads it to `capacity`. Memory: the pieces of `windows` windows
    and one document's ids."""
    sent = docs.select(column(docs, id_col).alias("d"), column(docs, text_col).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<long>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary)
        next_id = TaskContext.get().partitionId() << 36
        waiting: list[tuple] = []
        held, id_type = 0, None

        def packed() -> pa.RecordBatch:
            nonlocal next_id, waiting, held
            sizes = np.array([r[2] for r in waiting], np.int64)
            window = np.full(len(sizes), -1, np.int64)
            short = sizes < capacity
            if short.any():
                window[short] = fit(sizes[short], capacity)
            full = np.flatnonzero(~short)
            window[full] = window.max(initial=-1) + 1 + np.arange(len(full))
            order = np.argsort(window, kind="stable")
            run_sums = np.cumsum(sizes[order]) - sizes[order]
            first = np.searchsorted(window[order], window[order])
            offset = np.empty_like(sizes)
            offset[order] = run_sums - run_sums[first]
            columns = [list(c) for c in zip(*waiting)]
            out = [
                pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:5]],
                pa.array(window + next_id, pa.int64()), pa.array(offset, pa.int64()),
            ]
            if with_ids:
                out.append(pa.array(columns[5], pa.list_(pa.int64())))
            next_id += int(window.max()) + 1
            waiting, held = [], 0
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays(out, names=names[: len(out)])

        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                raw = memoryview(ids).cast("B")
                for start, length in cuts(len(ids), capacity, piece):
                    row = (doc_id, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), len(ids))
                    waiting.append((*row, ids[start : start + length].tolist()) if with_ids else row)
                    held += length
                if held >= windows * capacity:
                    yield packed()
        if waiting:
            yield packed()

    return sent.mapInArrow(run, schema)
