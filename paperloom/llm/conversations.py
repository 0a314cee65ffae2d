"""Repair of the turn structure of conversations by a run-length dynamic programme.

A turn is a symbol of its role's initial and its fault. The roles left must read `(s?(ua)+)?`, an automaton of four states; each
symbol is a min-plus matrix of what it costs to get from state to state by keeping, re-roling, deleting and inserting. Equal
consecutive symbols are one run, and the costs of what follows are carried over a run by the cached binary powers of its matrix.
Forward, the first letter (in ASCII order) among the cheapest edits is taken turn by turn, a run being halved until it is one turn.

Turns are dealt out by range of (conversation, turn, role, text), so that a long conversation lies in many partitions. One inside a
partition is finished there. Of the others a partition gives pieces of bounded size and each piece's matrix; the costs behind each
piece follow from the matrices alone, and one pass in order then writes the edits, because a SHA-256 is made in order. That pass
holds one piece at a time and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, settled

# Costs, damage and characters of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK = "\t\n\x0b\x0c\r "
FAR = 1 << 60
DROPPED = 8
"""The symbol of a turn that must go; any other is twice the place of its initial in `sua` (3: any other) plus whether it is cut short."""
PIECE_ROWS, PIECE_BYTES = 16_384, 1 << 24

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}
_ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
"""Where a turn of the one role that may come next leads, and which role that is."""

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
UNIT: Matrix = tuple(tuple(0 if a == b else FAR for b in range(4)) for a in range(4))


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(x + b[k][j] for k, x in enumerate(row))) for j in range(4)) for row in a)


def onto(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, row[0] + v[0], row[1] + v[1], row[2] + v[2], row[3] + v[3]) for row in a)


def _insertions() -> Matrix:
    out = [list(row) for row in UNIT]
    for a in range(4):
        at, cost = a, 0
        for _ in range(3):
            at, cost = _NEXT[at], cost + INSERT
            out[a][at] = min(out[a][at], cost)
    return tuple(map(tuple, out))


INSERTIONS = _insertions()
END: Vector = onto(INSERTIONS, (0, FAR, FAR, 0))
"""What it costs to end well behind the last turn."""


def kept_state(symbol: int, state: int) -> int | None:
    """Where keeping a turn leads, if it may be kept."""
    initial = symbol // 2
    if initial == 0:
        return AFTER_SYSTEM if state == START else None
    if initial == 3 or symbol == DROPPED:
        return None
    return _NEXT[state] if (_NEXT[state] == AFTER_USER) == (initial == 1) else None


@lru_cache(maxsize=None)
def matrix(symbol: int) -> Matrix:
    edit = [[FAR] * 4 for _ in range(4)]
    late = TRUNCATED * (symbol % 2)
    for state in range(4):
        edit[state][state] = DELETE
        if symbol != DROPPED:
            onward = _NEXT[state]
            edit[state][onward] = min(edit[state][onward], REROLE + late)
            kept = kept_state(symbol, state)
            if kept is not None:
                edit[state][kept] = min(edit[state][kept], late)
    return times(INSERTIONS, tuple(map(tuple, edit)))


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> Matrix:
    """The matrix of 2 ** bit equal turns."""
    if bit == 0:
        return matrix(symbol)
    half = power(symbol, bit - 1)
    return times(half, half)


def over_run(symbol: int, count: int, behind: Vector) -> Vector:
    """The costs before `count` equal turns, given those behind them."""
    bit = 0
    while count:
        if count & 1:
            behind = onto(power(symbol, bit), behind)
        count >>= 1
        bit += 1
    return behind


def run_matrix(symbol: int, count: int) -> Matrix:
    out, bit = UNIT, 0
    while count:
        if count & 1:
            out = times(out, power(symbol, bit))
        count >>= 1
        bit += 1
    return out


def _level(v: Vector) -> Vector:
    low = min(v)
    return tuple(x if x >= FAR else x - low for x in v)


@lru_cache(maxsize=65_536)
def _one_turn(symbol: int, state: int, behind: Vector) -> tuple[str, int]:
    here, letters = onto(matrix(symbol), behind), ""
    late = TRUNCATED * (symbol % 2)
    while True:
        if DELETE + behind[state] == here[state]:
            return letters + "D", state
        if INSERT + here[_NEXT[state]] == here[state]:
            letters, state = letters + "I", _NEXT[state]
            continue
        kept = kept_state(symbol, state)
        if kept is not None and late + behind[kept] == here[state]:
            return letters + "K", kept
        return letters + "R", _NEXT[state]


def unroll(symbol: int, count: int, state: int, behind: Vector) -> tuple[list[str], int]:
    """The letters of each of `count` equal turns and the state after them; `behind` are the costs after the run."""
    out: list[str] = []
    waiting = [(count, behind)]
    while waiting:
        count, behind = waiting.pop()
        level = _level(behind)
        letters, onward = _one_turn(symbol, state, level)
        if count == 1 or (onward == state and _level(onto(matrix(symbol), behind)) == level):
            out += [letters] * count  # one turn, or costs that no longer change along the run and a turn that leads back to its state
            state = onward
        else:
            half = count // 2
            waiting.append((count - half, behind))
            waiting.append((half, over_run(symbol, count - half, behind)))
    return out, state


class Repair:
    """The edits of one conversation, its pieces taken in order."""

    def __init__(self, with_turns: bool = False):
        self.low = self.high = self.last_turn = self.last_initial = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.state, self.hash, self.lines = START, hashlib.sha256(), 0
        self.turns: list[dict] | None = [] if with_turns else None

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + role.encode("utf-8", "replace") + b":" + text.encode("utf-8", "replace"))
        self.lines += 1
        if self.turns is not None:
            self.turns.append({"role": role, "text": text})

    def _edit(self, letters: str, symbol: int, role: str, text: str) -> None:
        for letter in letters:
            if letter == "I":
                self.state = _NEXT[self.state]
                self.cost += INSERT
                self._write(_ROLE[self.state], "")
            elif letter == "D":
                self.cost += DELETE
            else:
                kept = letter == "K"
                self.cost += TRUNCATED * (symbol % 2) + (0 if kept else REROLE)
                self.state = kept_state(symbol, self.state) if kept else _NEXT[self.state]
                self._write(role if kept else _ROLE[self.state], text)
        self.audit.append(letters)

    def take(self, rows: list[tuple], behind: Vector) -> None:
        """`rows` are (turn, role, text, copies, first of its role and text); `behind` are the costs after them."""
        runs: list[tuple[int, int, list[tuple[str, str]]]] = []
        for row in rows:
            turn, role, text, copies, _ = row
            for symbol, count in symbols(row):
                if runs and runs[-1][0] == symbol:
                    symbol, before, held = runs.pop()
                    count += before
                else:
                    held = []
                if symbol != DROPPED:
                    held.append((role, text))
                runs.append((symbol, count, held))
            if not copies:
                continue
            if turn is not None:
                self.distinct += turn != self.last_turn
                self.low = turn if self.low is None else self.low
                self.high = self.last_turn = turn
            initial = role[:1]
            if self.last_initial is not None:
                self.illegal += self.last_initial + initial not in ("su", "ua", "au")
            self.illegal += copies - 1
            self.last_initial = initial
            fault = fault_of(text)
            first = copies if fault == "blank" else 1 if row[4] else 0
            self.blank += copies if fault == "blank" else 0
            self.truncated += first if fault == "truncated" else 0
            self.duplicate += copies - first
        after: list[Vector] = []
        for symbol, count, _ in reversed(runs):
            after.append(behind)
            behind = over_run(symbol, count, behind)
        for (symbol, count, held), behind in zip(runs, reversed(after)):
            if symbol == DROPPED:
                self.audit.append("D" * count)
                self.cost += DELETE * count
                continue
            groups, state = unroll(symbol, count, self.state, behind)
            for letters, (role, text) in zip(groups, held):
                self._edit(letters, symbol, role, text)
            assert state == self.state

    def result(self) -> tuple:
        self._edit({START: "", AFTER_SYSTEM: "II", AFTER_USER: "I", AFTER_ASSISTANT: ""}[self.state], 0, "", "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
        return counts if self.turns is None else (*counts, self.turns)


def fault_of(text: str) -> str | None:
    seen = text.rstrip(BLANK)
    return "blank" if not seen else None if seen[-1] in ".!?" else "truncated"


def symbols(row: tuple) -> list[tuple[int, int]]:
    """(symbol, count) of a row with copies: at most one that may stay, then those that must go."""
    _, role, text, copies, first = row
    if not copies:
        return []
    fault = fault_of(text)
    if fault == "blank" or not first:
        return [(DROPPED, copies)]
    own = [(2 * ("sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + (fault == "truncated"), 1)]
    return own + [(DROPPED, copies - 1)] if copies > 1 else own


def rows_matrix(rows: list[tuple]) -> Matrix:
    out, run, length = UNIT, None, 0
    for row in rows:
        for symbol, count in symbols(row):
            if symbol != run and length:
                out, length = times(out, run_matrix(run, length)), 0
            run, length = symbol, length + count
    return times(out, run_matrix(run, length)) if length else out


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text and `copies` of every row after the contract's damage by crc32 of `conv:turn` (nulls: one space)."""
    part = [F.coalesce(column(conversations, c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col)]
    h = F.crc32(F.concat_ws(":", part[0], part[1]).cast("binary")) % 20
    sent = conversations.select(column(conversations, conv_col).alias("conv"), column(conversations, turn_col).alias("turn"), part[2].alias("role"), part[3].alias("text"), h.alias("h"))
    return sent.select(
        "conv", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _exact(value: Column) -> Column:
    """Text that tells all values apart, null too."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(":"), value.cast("string")))


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = ", repaired array<struct<role:string,text:string>>"
_DONE, _PIECE, _ROW = range(3)


def repair(turns: DataFrame, with_turns: bool = False, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row for each conversation of `turns` (conv, turn, role, text, copies): conv, its faults, the cheapest repair and its digest,
    with `with_turns` also the repaired turns.

    A row with 0 copies only names its conversation; one with several stands as often, side by side. Turns go by (turn, role, text),
    nulls first; a null role or text is one space; a null conversation is one of its own. A turn that is no whole number counts as
    null. An empty table gives no rows. Memory: a piece of a conversation, and the audit that is its result."""
    conv_kind = turns.schema["conv"].dataType.simpleString()
    sent = turns.select(
        "conv", F.col("turn").try_cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.col("copies").cast("long").alias("copies"),
    )
    gone = F.col("copies") <= 0
    sent = sent.select(
        "conv", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").otherwise(F.col("role")).alias("role"), F.when(gone, "").otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).otherwise(F.col("copies")).alias("copies"), F.when(gone, "").otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("h"),
    ).withColumns({"kc": _exact(F.col("conv")), "kt": _exact(F.col("turn"))})
    key = ["kc", "kt", "role", "h"]
    together = sent.groupBy(*key).agg(F.min("conv").alias("conv"), F.min("turn").alias("turn"), F.min("text").alias("text"), F.sum("copies").alias("copies"))
    # Where each (role, text) of a conversation stands first. The key of the join has the turn in it, so that no key is a frequent one.
    seen = sent.filter("copies > 0").groupBy(*key).agg(F.min("turn").alias("turn"))
    first = seen.groupBy("kc", "role", "h").agg(F.min(F.struct("turn", "kt")).alias("m")).select("kc", F.col("m.kt").alias("kt"), "role", "h", F.lit(True).alias("first"))
    rows = together.join(first, key, "left").select("conv", "turn", "role", "text", "copies", F.coalesce("first", F.lit(False)).alias("first"))
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange("conv", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64)).sortWithinPartitions(*order)
    result = _RESULT + (_TURNS if with_turns else "")
    names = [part.strip().split(" ")[0] for part in _RESULT.split(",")] + (["repaired"] if with_turns else [])
    head = ["kind", "part", "pos", "conv", "turn", "role", "text", "copies", "first", "costs"]
    schema = f"kind int, part long, pos long, conv {conv_kind}, turn long, role string, text string, copies long, first boolean, costs array<long>, {result}"
    kinds = [pa.int32(), pa.int64(), pa.int64(), None, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
    kinds += [pa.int64()] * 6 + [pa.string()] * 2 + ([pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))] if with_turns else [])
    empty = (None,) * (len(names))

    def batch_of(found: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(list(c), k or conv_type) for c, k in zip(columns, kinds)], names=head + names)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        found: list[tuple] = []
        held: list[tuple] = []
        held_bytes, conv, begun, opened, conv_type = 0, None, False, True, None  # the partition's first conversation may have begun before

        def piece() -> None:
            """What is held becomes a piece of a conversation that is not finished here."""
            nonlocal part, held, held_bytes
            flat = [x for row in rows_matrix(held) for x in row]
            found.append((_PIECE, part, 0, conv, None, None, None, None, None, flat, *empty))
            found.extend((_ROW, part, n, conv, *row, None, *empty) for n, row in enumerate(held))
            part, held, held_bytes = part + 1, [], 0

        def close(is_last: bool) -> None:
            nonlocal held, held_bytes
            if opened or is_last:
                piece()
            else:
                done = Repair(with_turns)
                done.take(held, END)
                found.append((_DONE, None, None, conv, None, None, None, None, None, None, *done.result()))
                held, held_bytes = [], 0

        for batch in batches:
            conv_type = batch.column(0).type
            for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and own != conv:
                    close(False)
                    opened = False
                conv, begun = own, True
                held.append(tuple(row))
                held_bytes += len(row[2])
                if len(held) >= piece_rows or held_bytes >= piece_bytes:
                    piece()
                    opened = True
            if len(found) >= 512:
                yield batch_of(found, conv_type)
                found = []
        if begun:
            close(True)
        if found:
            yield batch_of(found, conv_type)

    def behind_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces from the last to the first: the costs behind each."""
        conv, begun, behind = None, False, END
        for batch in batches:
            out = []
            for own, flat in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if not begun or own != conv:
                    conv, begun, behind = own, True, END
                out.append(list(behind))
                behind = onto(tuple(tuple(flat[4 * a : 4 * a + 4]) for a in range(4)), behind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["conv", "part", "costs"])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A piece's costs come before its rows."""
        conv, begun, work, held, behind, conv_type = None, False, None, [], END, None
        for batch in batches:
            found, conv_type = [], batch.column(0).type
            for own, _, pos, turn, role, text, copies, first, costs in zip(*(c.to_pylist() for c in batch.columns)):
                if pos < 0 and begun:
                    work.take(held, behind)
                    held = []
                if not begun or own != conv:
                    if begun:
                        found.append((conv, *work.result()))
                    conv, begun, work = own, True, Repair(with_turns)
                if pos < 0:
                    behind = tuple(costs)
                else:
                    held.append((turn, role, text, copies, first))
            if found:
                yield results(found, conv_type)
        if begun:
            work.take(held, behind)
            yield results([(conv, *work.result())], conv_type)

    def results(found: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found), [conv_type, *kinds[len(head) :]])], names=["conv", *names])

    met = settled(rows.mapInArrow(inside, schema))
    pieces = met.filter(F.col("kind") == _PIECE).select("conv", "part", "costs").repartition("conv").sortWithinPartitions(F.col("conv"), F.col("part").desc())
    behind = pieces.mapInArrow(behind_pieces, f"conv {conv_kind}, part long, costs array<long>").withColumn("pos", F.lit(-1).cast("long"))
    stream = met.filter(F.col("kind") == _ROW).select("conv", "part", "pos", "turn", "role", "text", "copies", "first", "costs").unionByName(behind, allowMissingColumns=True)
    others = stream.repartition("conv").sortWithinPartitions("conv", "part", "pos").mapInArrow(in_order, f"conv {conv_kind}, {result}")
    return met.filter(F.col("kind") == _DONE).select("conv", *names).unionByName(others)
