"""Near-duplicate documents: MinHash signatures, banding, verification on full sets, large-star and small-star components.

1. Each document becomes the set of hashes of its word shingles. Documents with one set are one class (a 128-bit digest names it),
   and everything below is between classes, so thousands of copies cost one.
2. A class has one minimum for each of `bands * rows` universal hash functions. Classes that agree in all rows of a band share a
   bucket; buckets of one class end here.
3. Inside a bucket, signatures are compared where the set sizes allow the similarity at all. A bucket of more than `block` classes
   is cut into blocks, and every two blocks meet in a group of their own: no group grows with the bucket.
4. First a group sends a forest of its most similar pairs, fewer than it has classes. The pairs whose full shingle sets are similar
   enough are links and give components so far. Then the classes of a group that still have a possible partner in another
   component meet again, now with their full sets; all such pairs are checked exactly inside the task, and only links that join two
   components go out. A group of n mutual copies thus gives about n pairs and not n squared, and no possible link that could join two
   components is left out.
5. A pair is a link only if the full shingle sets meet the similarity. Links give components.

A pair at similarity s shares no bucket with probability (1 - s^rows)^bands: 5e-6 at 0.75 with the defaults. Signatures are trusted
down to `slack` below the wanted similarity (more than four standard deviations).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, free_name, settled, words_of
from paperloom.llm.components import connected_components
from paperloom.session import cut_lineage

SHINGLE = 5
BANDS, ROWS = 32, 4
SIMILAR = (75, 100)
SLACK = 0.16
BLOCK = 2048
# Odd multipliers and offsets of the hash functions h(x) = a * x + b modulo 2^32, drawn once from a fixed seed.
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BAND_KEYS = _RNG.integers(0, 2**63, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of the whole sequence if it is shorter; none without words."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out ^ each[j : j + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minima(hashes: np.ndarray, step: int = 512) -> np.ndarray:
    """The smallest value of each hash function over the set, as uint32."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), step):
        np.minimum(out, (x[i : i + step, None] * _A + _B).min(0), out=out)
    return out


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key (a hash of the text that finds it again), n_shingles, node (the class's digest, null for an empty set), sketch
    (the low byte of each minimum) and buckets (one number a band)."""
    sent = docs.select(column(docs, id_col).alias("doc_id"), F.xxhash64(column(docs, text_col)).alias("text_key"), column(docs, text_col).alias("t"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, text_key long, n_shingles long, node binary, sketch binary, buckets array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, sketches, buckets = [], [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(words_of(text.as_py()))
                n.append(len(hashes))
                if not len(hashes):
                    nodes.append(None), sketches.append(None), buckets.append(None)
                    continue
                low = minima(hashes)
                keys = (low.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_KEYS[:, :ROWS]).sum(1) + _BAND_KEYS[:, ROWS]
                keys = (keys ^ (keys >> np.uint64(31))) * _MIX
                nodes.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                sketches.append((low & np.uint32(255)).astype(np.uint8).tobytes())
                buckets.append(keys.view(np.int64))
            arrays = [
                batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sketches, pa.binary()),
                pa.array(buckets, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_shingles", "node", "sketch", "buckets"])

    return sent.mapInArrow(run, schema)


def crowded(classes: DataFrame) -> DataFrame:
    """(bucket, node, n, sketch, i, j, second) for the classes of buckets that hold two or more, once for each group of two blocks
    that the class is in; `second` says that it is of the block j of a group of two different blocks."""
    rows = classes.select("node", F.explode("buckets").alias("bucket"))
    full = cut_lineage(rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"))
    rows = rows.join(full, "bucket")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.select("bucket", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("bucket", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"))
    return settled(rows.join(classes.select("node", F.col("n_shingles").alias("n"), "sketch"), "node"))


def similarities(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of every row of a with every row of b, from byte sketches (a chance match in 256 taken off)."""
    out = np.empty((len(a), len(b)), np.float32)
    for i in range(0, len(a), 64):
        out[i : i + 64] = (a[i : i + 64, None, :] == b[None, :, :]).sum(2, dtype=np.int32)
    return (out / a.shape[1] - 1 / 256) / (1 - 1 / 256)


class Parts:
    """Disjoint sets of small numbers."""

    def __init__(self, start: np.ndarray):
        self.of = start.copy()

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart until now."""
        p, q = self.of[x], self.of[y]
        if p == q:
            return False
        self.of[self.of == q] = p
        return True


def possible(n: np.ndarray, sketch: np.ndarray, a: np.ndarray, b: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows a and b, 0 where they can not be a link that joins two parts."""
    s = similarities(sketch[a], sketch[b])
    lo, hi = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
    s[(part[a][:, None] == part[b]) | (SIMILAR[1] * lo < SIMILAR[0] * hi) | (s < SIMILAR[0] / SIMILAR[1] - SLACK)] = 0
    return s


def sides(second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows to compare with each other: two blocks, or one with itself."""
    a, b = np.flatnonzero(~second), np.flatnonzero(second)
    return (a, a) if not len(b) else (a, b)


def forest(n: np.ndarray, sketch: np.ndarray, part: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Each row's most similar partner and, in one block, the most central row with all near it, as far as they join parts."""
    a, b = sides(second)
    if not len(a) or not len(b):
        return []
    s = possible(n, sketch, a, b, part)
    pairs = [(float(s[x, y]), int(a[x]), int(b[y])) for x, y in enumerate(s.argmax(1)) if s[x, y] > 0]
    if a is b:
        centre = int(s.sum(1).argmax())
        rest = [(float(s[centre, y]), int(a[centre]), int(b[y])) for y in np.flatnonzero(s[centre])]
    else:
        rest = [(float(s[x, y]), int(a[x]), int(b[y])) for y, x in enumerate(s.argmax(0)) if s[x, y] > 0]
    sets = Parts(part)
    return [(x, y) for own in (pairs, rest) for _, x, y in sorted(own, key=lambda p: (-p[0], p[1], p[2])) if sets.join(x, y)]


def joining_links(n: np.ndarray, sketch: np.ndarray, part: np.ndarray, second: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between rows of different parts, exact, as many as it takes to join all parts that links join."""
    a, b = sides(second)
    if not len(a) or not len(b):
        return []
    s = possible(n, sketch, a, b, part)
    everything = np.concatenate([sets[k] for k in b])
    start = np.concatenate(([0], np.cumsum([len(sets[k]) for k in b])[:-1]))
    now, out = Parts(part), []
    for x in range(len(a)):
        row = int(a[x])
        open_ = np.flatnonzero((s[x] > 0) & (now.of[b] != now.of[row]))
        if not len(open_):
            continue
        own = sets[row]
        if 4 * len(open_) > len(b):
            at = np.minimum(np.searchsorted(own, everything), len(own) - 1)
            shared = np.add.reduceat((own[at] == everything).astype(np.int64), start)[open_]
        else:
            shared = np.array([len(np.intersect1d(own, sets[b[y]], assume_unique=True)) for y in open_])
        link = SIMILAR[1] * shared >= SIMILAR[0] * (len(own) + n[b[open_]] - shared)
        out += [(row, int(b[y])) for y in open_[link] if now.join(row, int(b[y]))]
    return out


GROUP = ("bucket", "i", "j")
_MEMBER = "bucket long, i int, j int, second boolean, node binary, n long, sketch binary, part binary"


def by_group(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *GROUP).sortWithinPartitions(*GROUP)


def _groups(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(from, to, n, sketch, part, second) of each group of the table that has two parts at least; parts as numbers."""
    keys = np.column_stack([table[c].to_numpy() for c in GROUP])
    edge = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1), [True])))
    own = table["part"].to_pylist()
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
    n, second = table["n"].to_numpy(), table["second"].to_numpy(zero_copy_only=False)
    for lo, hi in zip(edge, edge[1:]):
        numbers: dict[bytes, int] = {}
        part = np.array([numbers.setdefault(p, len(numbers)) for p in own[lo:hi]])
        if len(numbers) > 1:
            yield lo, hi, n[lo:hi], sketch[lo:hi], part, second[lo:hi]


def _pair_batch(pairs: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
    out = sorted((min(p), max(p)) for p in pairs)
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.binary()) for k in (0, 1)], names=["a", "b"])


def likely_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: the forests of all groups of `members` (with `part`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[bytes, bytes]] = set()
        for table in whole_groups(batches, GROUP):
            nodes, found = table["node"].to_pylist(), set()
            for lo, _, n, sketch, part, second in _groups(table):
                found |= {(nodes[lo + x], nodes[lo + y]) for x, y in forest(n, sketch, part, second)}
            yield _pair_batch(found - sent)
            sent = sent | found if len(sent) < 200_000 else found

    return by_group(members.select(*[f.split()[0] for f in _MEMBER.split(", ")])).mapInArrow(run, "a binary, b binary").distinct()


def still_open(members: DataFrame) -> DataFrame:
    """The rows of `members` that have a possible partner of another part in their group."""
    names = [f.split()[0] for f in _MEMBER.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, GROUP):
            keep = np.zeros(table.num_rows, bool)
            for lo, _, n, sketch, part, second in _groups(table):
                a, b = sides(second)
                if len(a) and len(b):
                    s = possible(n, sketch, a, b, part) > 0
                    keep[lo + a] |= s.any(1)
                    keep[lo + b] |= s.any(0)
            yield from table.filter(pa.array(keep)).to_batches()

    return by_group(members.select(*names)).mapInArrow(run, _MEMBER)


def exact_links(rows: DataFrame) -> DataFrame:
    """(a, b): links that join parts, from `rows` of groups with their `hashes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, GROUP):
            nodes, raw, found = table["node"].to_pylist(), table["hashes"].to_pylist(), set()
            for lo, hi, n, sketch, part, second in _groups(table):
                sets = [np.frombuffer(h, np.uint64) for h in raw[lo:hi]]
                found |= {(nodes[lo + x], nodes[lo + y]) for x, y in joining_links(n, sketch, part, second, sets)}
            yield _pair_batch(found)

    return by_group(rows).mapInArrow(run, "a binary, b binary")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of the sorted stream; what may go on in the next batch waits for it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for k in keys:
            v = batch[k].to_numpy()
            same &= v == v[-1]
        begun = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if begun:  # the groups before the last one of this batch are whole
            yield pa.Table.from_batches([*held, batch.slice(0, begun)])
            held = []
        held.append(batch.slice(begun))
    if held:
        yield pa.Table.from_batches(held)


def shingle_sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, hashes) of the classes whose texts' keys are in `wanted` (text_key), from the texts themselves."""
    texts = docs.select(F.xxhash64(column(docs, text_col)).alias("text_key"), column(docs, text_col).alias("t")).join(wanted, "text_key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, bytes] = {}
            nodes, sets = [], []
            for text in batch.column(0).to_pylist():
                if text is None or text in seen:
                    continue
                raw = shingle_hashes(words_of(text)).tobytes()
                seen[text] = b""
                if raw:
                    nodes.append(hashlib.blake2b(raw, digest_size=16).digest())
                    sets.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    return texts.select("t").mapInArrow(run, "node binary, hashes binary").dropDuplicates(["node"])


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough, in whole numbers: 100 * intersection >= 75 * union."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                similar.append(SIMILAR[1] * shared >= SIMILAR[0] * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest id of its component), kept (it has that id), text_key.

    Null, empty and blank texts have no shingles and are linked with nothing: their component is their own id. A null id is never a
    component's smallest while another is there; where a component has null ids alone, its rows have a null component and are kept.
    Rows that repeat an id and a text share their fate. Extra columns are ignored; an empty table gives no rows."""
    signed = settled(sign(docs, id_col, text_col))
    some = signed.filter("node is not null")
    classes = settled(some.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"),
        F.first("buckets").alias("buckets"),
    ))
    members = crowded(classes)
    busy = members.select("node").distinct()
    wanted = classes.join(busy, "node", "left_semi").select("text_key")
    sets = settled(shingle_sets(docs, text_col, wanted))
    apart = members.withColumn("part", F.col("node"))
    found = settled(links(settled(likely_pairs(apart)), sets))
    roots = cut_lineage(connected_components(found))
    parted = members.join(roots, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")
    rest = settled(still_open(parted))
    more = settled(exact_links(rest.join(sets, "node")))
    roots = cut_lineage(connected_components(found.unionByName(more)))
    rooted = classes.select("node", "first_id").join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = cut_lineage(rooted)
    smallest = cut_lineage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = cut_lineage(rooted.join(smallest, "root").select("node", "component_id"))
    linked = some.join(named, "node").select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")
    alone = signed.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_key")
    return linked.unionByName(alone)


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their columns and nothing else."""
    gone, key = free_name(docs, "gone"), free_name(docs, "text_key")
    rows = near_duplicates(docs, id_col, text_col).filter(~F.col("kept")).select(F.col("doc_id").alias(gone), F.col("text_key").alias(key)).distinct()
    same = column(docs, id_col).eqNullSafe(rows[gone]) & (F.xxhash64(column(docs, text_col)) == rows[key])
    return docs.join(rows, same, "left_anti")
