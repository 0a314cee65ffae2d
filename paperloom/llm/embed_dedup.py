"""Near-duplicate vectors by sorted projection passes.

1. A vector becomes a unit vector in double precision. Vectors with one label and equal components are one class.
2. Every label of two or more classes goes through sorted passes, which find the bulk of the links: around the label's centre, random
   hyperplanes give a class 63 sign bits; classes are ordered by (label, bits) and every class is compared, by exact cosine, with the
   `window` before it in that order. Each task unites what it links and sends one row a united class. A pass is one job, whose shuffle
   files are deleted before the next.
3. The passes' unions become components by large-star and small-star steps.
4. The completion finds every link between different components that is left. A label is cut into blocks of at most about `SIDE`
   classes around pivots (classes drawn by hash, a bounded number); a class meets all blocks that the triangle inequality of angles does
   not rule out. Compared by exact cosine, so components do not depend on what the passes found.
5. Links are counted exactly inside each component: a vector is at some angle from the component's centre, and two angles whose sum
   is below the wanted one make a link for certain, so that in a tight component nothing is compared. The rest is compared with the
   whole component in groups of two bounded blocks.

The number of passes is set from a label's number of classes and its centred vectors' lengths, up to `MAX_PASSES`; it says how much
is left to the completion and never what is found. Where vectors are spread so wide that no block can be ruled out, the completion
compares all blocks of a label.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, settled
from paperloom.llm.components import connected_components
from paperloom.llm.minhash import whole_groups
from paperloom.session import cut_lineage

COSINE = 0.93
WINDOW = 32
BLOCK = 1024
SIDE = 8192
"""Classes of a block in the completion."""
PIVOTS = 1024
"""Pivots of one label at most, about one for each `SIDE` classes below that."""
PIVOT_BYTES = 64 << 20
"""Pivots of all labels together at most."""
MAX_PASSES = 32
_MARGIN = 1e-9
"""Angles this near the limit are not taken as certain."""
_ANGLE_MARGIN = 1e-6
"""What rounding can take from an angle that is computed from a cosine near one."""


def unit(values: list | None) -> np.ndarray | None:
    """The unit vector in double precision; None for null, empty and zero vectors and those with null or non-finite components."""
    if not values or None in values:
        return None
    v = np.array(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(v).all() or top == 0:
        return None
    v = v / top  # very large and very small components keep their ratio
    return v / math.sqrt(v @ v)


def units(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label (as text), dims, node (the class's digest, null for a vector that links with nothing) and unit."""
    sent = vectors.select(column(vectors, id_col).alias("vec_id"), column(vectors, label_col).cast("string").alias("label"), column(vectors, vector_col).alias("v"))
    schema = f"vec_id {vectors.schema[id_col].dataType.simpleString()}, label string, dims int, node binary, unit binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, nodes, out = [], [], []
            for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                v = None if label is None else unit(values)
                dims.append(0 if v is None else len(v))
                out.append(None if v is None else v.tobytes())
                raw = None if v is None else repr(label).encode() + np.array(values, np.float64).tobytes()
                nodes.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(nodes, pa.binary()), pa.array(out, pa.binary())],
                names=["vec_id", "label", "dims", "node", "unit"],
            )

    return sent.mapInArrow(run, schema)


def passes_for(members: int, length: float, window: int, cosine: float, most: int, missed: float = 1e-3) -> int:
    """Passes after which a pair at the threshold is missed with probability `missed`, among `members` vectors whose root mean square
    distance from their centre is `length`: each bit halves them, and a pair's angle is that around the centre. At least 4."""
    if length < 1e-6:
        return min(most, 4)
    bits = max(0.0, math.log2(max(members, 1) / (2 * window))) + 1
    chord = math.sqrt(max(0.0, 2 - 2 * cosine))
    found = (1 - 2 * math.asin(min(1.0, chord / (2 * length))) / math.pi) ** bits
    return min(most, max(4, math.ceil(math.log(missed) / math.log(1 - min(max(found, 1e-9), 0.999)))))


def _planes(number: int, dims: int) -> np.ndarray:
    return np.random.default_rng((977, number, dims)).standard_normal((dims, 63))


def sort_keys(u: np.ndarray, number: int) -> np.ndarray:
    """63 sign bits of random projections as a non-negative integer; the same for a pass whatever the task."""
    return ((u @ _planes(number, u.shape[1]) > 0) @ (np.int64(1) << np.arange(62, -1, -1, dtype=np.int64))).astype(np.int64)


class Union:
    """Disjoint sets of digests; the smallest stands for its set."""

    def __init__(self) -> None:
        self.above: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        path = []
        while (up := self.above.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            self.above[p] = x
        return x

    def join(self, x: bytes, y: bytes) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)


def by_kind(batch: pa.RecordBatch, label: int, dims: int) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch's rows for each (label, dims); `label` and `dims` are column numbers."""
    places: dict[tuple[str, int], list[int]] = {}
    for k, kind in enumerate(zip(batch.column(label).to_pylist(), batch.column(dims).to_pylist())):
        places.setdefault(kind, []).append(k)
    for kind, rows in places.items():
        yield kind, batch.take(pa.array(rows))


def label_table(classes: DataFrame, window: int, cosine: float) -> DataFrame:
    """label, dims, n (classes), mean (the centre of the label's unit vectors) and passes of each (label, dims) with two or more classes."""
    kind = F.encode(F.concat("label", F.lit("\n"), F.col("dims").cast("string")), "UTF-8").alias("root")
    counts = classes.groupBy("label", "dims").agg(F.count("*").alias("n")).filter("n > 1")
    rows = counts.withColumn("root", kind).join(centres(classes.select(kind, "unit")), "root").select("label", "dims", "n", "centre")
    most = MAX_PASSES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, passes = [], []
            for n, raw in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                mean = np.frombuffer(raw) / n
                means.append(mean.tobytes())
                passes.append(passes_for(n, math.sqrt(max(0.0, 1 - float(mean @ mean))), window, cosine, most))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(means, pa.binary()), pa.array(passes, pa.int32())], names=["label", "dims", "n", "mean", "passes"])

    return rows.mapInArrow(work, "label string, dims int, n long, mean binary, passes int")


def drawn_pivots(large: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Unit vectors drawn by the classes' hashes, about one in `SIDE` of each (label, dims) and within `PIVOTS` and `PIVOT_BYTES`.
    `large`: node, label, dims, unit and n."""
    whole = large.agg(F.count("*").alias("rows"), F.max("dims").alias("dims")).first()
    if not whole["rows"]:
        return {}
    share = PIVOT_BYTES / (8 * whole["dims"]) / whole["rows"]
    wanted = F.least(F.lit(1 / SIDE), F.lit(PIVOTS) / F.col("n"), F.lit(share))
    drawn = large.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < wanted * (1 << 30)).select("label", "dims", "unit")
    out: dict[tuple[str, int], list[np.ndarray]] = {}
    for r in drawn.toLocalIterator():
        out.setdefault((r["label"], r["dims"]), []).append(np.frombuffer(r["unit"]))
    return {kind: np.array(rows) for kind, rows in out.items()}


def united(classes: DataFrame, number: int, window: int, cosine: float, step: int = 256) -> DataFrame:
    """(a, b): classes and what stands for them in their task's union after pass `number`. `classes`: node, label, dims, unit and mean,
    the centre of the label."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, own in by_kind(batch, 1, 2):
                u = np.frombuffer(b"".join(own.column(3).to_pylist())).reshape(-1, kind[1])
                u = u - np.frombuffer(own.column(4)[0].as_py())
                yield pa.RecordBatch.from_arrays([*own.columns[:4], pa.array(sort_keys(u, number))], names=["node", "label", "dims", "unit", "key"])

    rows = classes.select("node", "label", "dims", "unit", "mean").mapInArrow(keys, "node binary, label string, dims int, unit binary, key long")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dims", "key", "node"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Union()
        tail_key, tail_nodes, tail = None, [], None
        for batch in batches:
            nodes, raw = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            kinds = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            edge = [0, *[k for k in range(1, len(kinds)) if kinds[k] != kinds[k - 1]], len(kinds)]
            for lo, hi in zip(edge, edge[1:]):
                if lo == hi:
                    continue
                own, u = nodes[lo:hi], np.frombuffer(b"".join(raw[lo:hi])).reshape(hi - lo, -1)
                if tail_key == kinds[lo]:
                    own, u = [*tail_nodes, *own], np.concatenate((tail, u))
                for a in range(0, len(u), step):
                    begin = max(0, a - window)
                    s = u[a : a + step] @ u[begin : a + step].T
                    for x, y in zip(*np.nonzero(s >= cosine)):
                        if begin + y < a + x:
                            sets.join(own[a + x], own[begin + y])
                tail_key, tail_nodes, tail = kinds[lo], own[-window:], u[-window:]
        pairs = [(x, sets.root(x)) for x in list(sets.above)]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(compare, "a binary, b binary")


def pass_links(classes: DataFrame, kinds: DataFrame, window: int, cosine: float) -> DataFrame:
    """(a, b): what all passes over all labels unite. `kinds`: `label_table`."""
    most = kinds.agg(F.max("passes").alias("p")).first()["p"] or 0
    # The last pass only serves the labels that ask for so many.
    done = [
        settled(united(classes.join(kinds.filter(F.col("passes") > p).select("label", "dims", "mean"), ["label", "dims"]), p, window, cosine))
        for p in range(most)
    ]
    return reduce(DataFrame.unionByName, done) if done else classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)


def placed_classes(large: DataFrame, pivots) -> DataFrame:
    """Adds `cell` and `angle`: the nearest pivot of the class's label and the angle to it."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, own in by_kind(batch, 1, 2):
                u = np.frombuffer(b"".join(own.column(3).to_pylist())).reshape(-1, kind[1])
                cell, angle = np.zeros(len(u), np.int32), np.full(len(u), math.pi)
                if kind in pivots.value:
                    p = pivots.value[kind]
                    step = max(1, 4_000_000 // len(p))
                    for k in range(0, len(u), step):
                        near = u[k : k + step] @ p.T
                        cell[k : k + step] = near.argmax(1)
                        angle[k : k + step] = np.arccos(np.clip(near.max(1), -1, 1))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(cell), pa.array(angle)], names=["node", "label", "dims", "unit", "root", "cell", "angle"])

    sent = large.select("node", "label", "dims", "unit", "root")
    return sent.mapInArrow(place, "node binary, label string, dims int, unit binary, root binary, cell int, angle double")


def cell_table(placed: DataFrame, pivots: dict[tuple[str, int], np.ndarray]) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each (label, dims): the cells' widest angles, how many blocks each has and its first block's number."""
    out = {}
    for r in placed.groupBy("label", "dims", "cell").agg(F.max("angle").alias("widest"), F.count("*").alias("n")).toLocalIterator():
        kind = (r["label"], r["dims"])
        cells = len(pivots.get(kind, (0,)))
        widest, parts, _ = out.setdefault(kind, (np.full(cells, -10.0), np.zeros(cells, np.int64), np.zeros(cells, np.int64)))
        widest[r["cell"]], parts[r["cell"]] = r["widest"], -(-r["n"] // SIDE)
    return {kind: (widest, parts, np.cumsum(parts) - parts) for kind, (widest, parts, _) in out.items()}


def completing_links(small: DataFrame, placed: DataFrame, pivots, cells, cosine: float, step: int = 512) -> DataFrame:
    """(a, b): components that links join, over all pairs of classes with one label. `small`: node, label, dims, unit, root of labels that
    are one block; `placed`: `placed_classes` of the others; `pivots` and `cells`: broadcasts of what belongs to them."""
    limit = math.acos(cosine) + _ANGLE_MARGIN

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, rows in by_kind(batch, 1, 2):
                widest, parts, first = cells.value[kind]
                block_cell = np.repeat(np.arange(len(parts)), parts)
                for k in range(0, rows.num_rows, chunk := max(1, 4_000_000 // max(1, len(block_cell)))):
                    some = rows.slice(k, chunk)
                    cell = some.column(5).to_numpy()
                    spread = np.array([int.from_bytes(n[:6], "big") for n in some.column(0).to_pylist()])
                    own = first[cell] + spread % parts[cell]
                    reach = np.ones((len(cell), len(parts)), bool)
                    if kind in pivots.value:
                        u = np.frombuffer(b"".join(some.column(3).to_pylist())).reshape(-1, kind[1])
                        reach = np.arccos(np.clip(u @ pivots.value[kind].T, -1, 1)) <= widest + limit
                        reach[np.arange(len(cell)), cell] = True
                    x, block = np.nonzero(reach[:, block_cell])
                    for i in range(0, len(x), 20_000):
                        at, other = x[i : i + 20_000], block[i : i + 20_000]
                        taken = some.select(["node", "label", "dims", "unit", "root"]).take(pa.array(at))
                        mine = own[at]
                        yield pa.RecordBatch.from_arrays(
                            [*taken.columns, pa.array(np.minimum(mine, other)), pa.array(np.maximum(mine, other)), pa.array(mine <= other)],
                            names=["node", "label", "dims", "unit", "root", "i", "j", "first"],
                        )

    schema = "node binary, label string, dims int, unit binary, root binary, i long, j long, first boolean"
    alone = small.select("node", "label", "dims", "unit", "root", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(True).alias("first"))
    rows = alone.unionByName(placed.mapInArrow(send, schema)).withColumn("bucket", F.xxhash64("label", "dims"))
    parts = int(small.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket", "i", "j")):
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(*(table[c].to_pylist() for c in ("label", "dims", "i", "j")))):
                groups.setdefault(key, []).append(k)
            raw, root, first = table["unit"].to_pylist(), table["root"].to_pylist(), table["first"].to_pylist()
            pairs: list[tuple[bytes, bytes]] = []
            for (_, _, i, j), rows in groups.items():
                q, r = [k for k in rows if first[k]], rows if i == j else [k for k in rows if not first[k]]
                pairs += joined_roots(*([np.frombuffer(b"".join(raw[k] for k in side)).reshape(len(side), -1) for side in (q, r)] if q and r else (None, None)),
                                      [root[k] for k in q], [root[k] for k in r], cosine, step)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return grouped.select("bucket", "label", "dims", "i", "j", "first", "root", "unit").mapInArrow(compare, "a binary, b binary")


def joined_roots(u: np.ndarray | None, v: np.ndarray | None, of_u: list[bytes], of_v: list[bytes], cosine: float, step: int) -> list[tuple[bytes, bytes]]:
    """Pairs of components that some link between a row of `u` and one of `v` joins, one for each component that is not the last of its set."""
    if u is None:
        return []
    names = sorted({*of_u, *of_v})
    if len(names) == 1:
        return []
    number = {n: k for k, n in enumerate(names)}
    now = np.arange(len(names))  # the set of each component
    mine, others = np.array([number[n] for n in of_u]), np.array([number[n] for n in of_v])
    for k in range(0, len(u), step):
        near = u[k : k + step] @ v.T >= cosine
        for x in np.flatnonzero((near & (now[mine[k : k + step]][:, None] != now[others][None, :])).any(1)):
            sets = np.unique(np.append(now[others[near[x]]], now[mine[k + x]]))
            if len(sets) > 1:
                now[np.isin(now, sets)] = sets[0]
    return [(names[k], names[n]) for k, n in enumerate(now) if k != n]


def centres(members: DataFrame) -> DataFrame:
    """(root, centre): the sum of a component's unit vectors, added up in the tasks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, np.ndarray] = {}

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(sums.keys(), pa.binary()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["root", "centre"]
            )
            sums.clear()
            return out

        for batch in batches:
            for root, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.frombuffer(raw)
                sums[root] = sums[root] + v if root in sums else v
            if len(sums) > 50_000:
                yield sent()
        yield sent()

    schema = "root binary, centre binary"
    partial = members.select("root", "unit").mapInArrow(add, schema)
    return partial.repartition("root").mapInArrow(add, schema)


def link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(node, linked): the number of vectors within the angle of each class, itself and its copies included. `members`: root, node,
    size and unit of classes in components of two or more."""
    limit = math.acos(cosine)
    centred = members.join(cut_lineage(centres(members)), "root")

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, centre in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                u, c = np.frombuffer(raw), np.frombuffer(centre)
                length = math.sqrt(c @ c)
                out.append(math.acos(min(1.0, max(-1.0, float(u @ c) / length))) if length > 0 else math.pi)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.float64())], names=["root", "node", "size", "unit", "angle"])

    placed = cut_lineage(centred.select("root", "node", "size", "unit", "centre").mapInArrow(angles, "root binary, node binary, size long, unit binary, angle double"))
    whole = cut_lineage(placed.groupBy("root").agg(F.max("angle").alias("widest"), F.sum("size").alias("all"), F.count("*").alias("n")))
    known = cut_lineage(placed.join(whole, "root"))
    certain = F.col("angle") + F.col("widest") <= limit - _MARGIN
    tight = known.filter(certain).select("node", F.col("all").alias("linked"))
    loose_roots = known.filter(~certain).select("root").distinct()
    loose = known.join(loose_roots, "root", "left_semi").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    loose = loose.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = loose.filter(~certain).select("root", F.col("own").alias("i"), others.alias("j"), F.lit(True).alias("asks"), "node", "size", "unit")
    asked = loose.select("root", others.alias("i"), F.col("own").alias("j"), F.lit(False).alias("asks"), "node", "size", "unit")
    rows = asking.unionByName(asked).withColumn("bucket", F.xxhash64("root"))
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("bucket", "i", "j")):
            keys = list(zip(table["root"].to_pylist(), table["i"].to_pylist(), table["j"].to_pylist()))
            asks = table["asks"].to_numpy(zero_copy_only=False)
            nodes, raw, size = table["node"].to_pylist(), table["unit"].to_pylist(), table["size"].to_numpy()
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(keys):
                groups.setdefault(key, []).append(k)
            found: list[tuple[bytes, int]] = []
            for rows in groups.values():
                q, r = [k for k in rows if asks[k]], [k for k in rows if not asks[k]]
                if q and r:
                    u, v = (np.frombuffer(b"".join(raw[k] for k in x)).reshape(len(x), -1) for x in (q, r))
                    near = u @ v.T >= cosine
                    near |= np.array([nodes[k] for k in q], object)[:, None] == np.array([nodes[k] for k in r], object)
                    found += zip((nodes[k] for k in q), (near @ size[r]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64())], names=["node", "linked"])

    counted = grouped.select("bucket", "i", "j", "root", "asks", "node", "size", "unit").mapInArrow(count, "node binary, linked long")
    return tight.unionByName(counted.groupBy("node").agg(F.sum("linked").alias("linked")))


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, window: int = WINDOW,
) -> DataFrame:
    """One row a vector: vec_id, n_links (other vectors linked directly), component_id (smallest id reachable), kept.

    Vectors without a label, null, empty, zero or with null or non-finite components link with nothing: n_links 0, their own id, kept.
    Vectors of different lengths never link. Equal vectors of one label link with each other. Rows with a null id count as vectors and
    never name a component unless all its ids are null. Extra columns are ignored; an empty table gives no rows."""
    rows = cut_lineage(units(vectors, id_col, vector_col, label_col))
    some = rows.filter("node is not null")
    classes = cut_lineage(some.groupBy("node").agg(
        F.count("*").alias("size"), F.min("vec_id").alias("first_id"), F.min("label").alias("label"), F.min("dims").alias("dims"), F.min("unit").alias("unit"),
    ))
    spark = vectors.sparkSession
    kinds = cut_lineage(label_table(classes, window, cosine))
    pairs = pass_links(classes, kinds, window, cosine)
    found = cut_lineage(connected_components(pairs))
    rooted = classes.join(kinds.select("label", "dims", "n"), ["label", "dims"]).join(found, "node", "left")
    rooted = cut_lineage(rooted.withColumn("root", F.coalesce("root", "node")))
    large, small = rooted.filter(F.col("n") > SIDE), rooted.filter(F.col("n") <= SIDE)
    few = drawn_pivots(large)
    pivots = spark.sparkContext.broadcast(few)
    placed = cut_lineage(placed_classes(large, pivots))
    cells = spark.sparkContext.broadcast(cell_table(placed, few))
    left = settled(completing_links(small, placed, pivots, cells, cosine))
    roots = cut_lineage(connected_components(pairs.unionByName(left)))
    members = cut_lineage(classes.join(roots, "node").select("root", "node", "size", "unit"))
    linked = cut_lineage(link_counts(members, cosine))
    rooted = classes.select("node", "first_id", "size").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut_lineage(rooted)
    smallest = cut_lineage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = rooted.join(smallest, "root").select("node", "size", "component_id").join(linked, "node", "left")
    named = cut_lineage(named.select("node", "component_id", (F.coalesce("linked", "size") - 1).alias("n_links")))
    out = some.select("vec_id", "node").join(named, "node").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    alone = rows.filter("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)
