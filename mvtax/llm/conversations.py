"""Conversation structure repair by a square-root checkpointed dynamic programme.

A conversation is read as its rows by turn. Its roles must follow ``(s?(ua)+)?`` (system, user, assistant by
their first letter); keeping a row costs nothing, giving it the user or assistant role 2, deleting it 3 -
required for blank and repeated rows - and inserting an empty user or assistant row 2; a row that stays
although it ends without a full stop costs 1 more. The cheapest edits are found backward: for every
row and each of the four states (nothing yet, after system, user, assistant) the cost of what follows. Only
the vectors at checkpoints are stored; the walk forward recomputes one stretch at a time from the
checkpoint behind it, and takes the ASCII-least edit that is tight. An edit's letter fixes the next state,
so that choice gives the least string of all cheapest ones.

The same scheme is used twice. In a task, a block of rows is solved with a checkpoint every square root of
its length. On the cluster, rows are sorted by range, so a long conversation lies in many tasks, and cut into
blocks of the square root of the longest conversation's rows (``BLOCK`` at least, ``BLOCK_BYTES`` of text at
most). A conversation inside one block is finished there. Of the others every block gives the 4 x 4 matrix of its
costs (they combine by minimum and sum); one small row a block meets in a task per conversation, which yields
each block's checkpoint; the blocks walk from all four states at once; the states that are really
reached are chosen from another small row a block.

What remains serial is the digest: SHA-256 over a whole conversation must read its text in order, so one task
streams the repaired rows of a conversation that is longer than a block, in bounded memory; and ``audit``
holds a letter an edit, so a conversation of more than 2 ** 31 edits has no such row. ``repaired_turns`` has neither limit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import checkpoint, prepare, slices, tasks

BLOCK = 1024
BLOCK_BYTES = 1 << 20

#: By state - 0 nothing yet, 1 system, 2 user, 3 assistant: the state after a row of each letter.
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
#: The only state an inserted or renamed row can lead to, and its role.
GROW = (2, 2, 3, 2)
ROLE = {2: b"user", 3: b"assistant"}
FAR = 1 << 50
#: Costs after the last row: the roles may end with nothing or an assistant; a missing row is inserted.
END = (0, 4, 2, 0)

Vector = tuple[int, int, int, int]


def row_code(role: bytes, truncated: bool) -> str:
    """The letter of a row that may stay; a capital if it is truncated."""
    first = chr(role[0]) if role[:1] in (b"s", b"u", b"a") else "x"
    return first.upper() if truncated else first


def step(code: str, v: Vector) -> Vector:
    """Costs before a row, from those after it (``d``: the row must go). Insertions before it are included."""
    if code == "d":
        return v[0] + 3, v[1] + 3, v[2] + 3, v[3] + 3
    more, to = int(code.isupper()), NEXT[code.lower()]
    out = []
    for s in range(4):
        best = min(3 + v[s], 2 + more + v[GROW[s]])
        if to[s] is not None:
            best = min(best, more + v[to[s]])
        out.append(best)
    user, assistant = min(out[2], 2 + out[3]), min(out[3], 2 + out[2])
    return min(out[0], 2 + user), min(out[1], 2 + user), user, assistant


def walk(codes: str, end: Vector, state: int) -> tuple[str, int]:
    """The edits of a block from ``state`` on, as letters, and the state after it. ``end``: costs after the block."""
    n, width = len(codes), isqrt(len(codes)) + 1
    marks, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = step(codes[i], v)
        if i % width == 0:
            marks[i] = v
    said = []
    for low in range(0, n, width):
        high = min(low + width, n)
        costs = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            costs.append(step(codes[i], costs[-1]))
        costs.reverse()
        for i in range(low, high):
            now, after, code = costs[i - low], costs[i - low + 1], codes[i]
            while True:
                left = now[state]
                if 3 + after[state] == left:
                    said.append("D")
                elif 2 + now[GROW[state]] == left:
                    said.append("I")
                    state = GROW[state]
                    continue
                else:
                    to = NEXT[code.lower()][state]
                    if to is not None and int(code.isupper()) + after[to] == left:
                        said.append("K")
                        state = to
                    else:
                        said.append("R")
                        state = GROW[state]
                break
    return "".join(said), state


def closing(state: int) -> str:
    """Insertions after the last row."""
    return "I" * (END[state] // 2)


def replay(rows: list[tuple[bytes, bytes]], audit: str, state: int) -> list[tuple[bytes, bytes]]:
    """The rows ``(role, text)`` that the edits leave."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = rows[at]
            state = NEXT[row_code(role, False)][state]
        else:
            state = GROW[state]
            role, text = ROLE[state], rows[at][1] if letter == "R" else b""
        at += letter != "I"
        out.append((role, text))
    return out


def describe(turns: list, rows: list[tuple[bytes, bytes]], first: set[int] | None = None) -> dict:
    """Codes and counts of consecutive rows. ``first``: places of rows seen nowhere before in the conversation;
    left out, the rows are all there is. Turns come in order, nulls first."""
    seen: set = set()
    codes, counts = [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    for i, (role, text) in enumerate(rows):
        body = text.rstrip()
        new = (role, text) not in seen and (first is None or i in first)
        seen.add((role, text))
        fault = "blank" if not body else "duplicate" if not new else "truncated" if body[-1:] not in b".!?" else None
        if fault:
            counts[fault] += 1
        codes.append("d" if fault in ("blank", "duplicate") else row_code(role, fault == "truncated"))
    letters = [r[:1] for r, _ in rows]
    counts["illegal"] = sum(a + b not in (b"su", b"ua", b"au") for a, b in zip(letters, letters[1:]))
    known = [t for t in turns if t is not None]
    return {"codes": "".join(codes), **counts, "low": known[0] if known else None, "high": known[-1] if known else None,
            "distinct": len(set(known)), "first": letters[0] if rows else None, "last": letters[-1] if rows else None}


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


_RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
           ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_RESULT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW = pa.struct([("turn", pa.int64()), ("role", pa.binary()), ("text", pa.binary())])
_ROWS_DDL = "rows array<struct<turn: long, role: binary, text: binary>>"
RESULTS = [n for n, _ in _RESULT]


def _digest(rows: list[tuple[bytes, bytes]]) -> str:
    return sha256(b"\n".join([r + b":" + t for r, t in rows])).hexdigest()


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _blocks(rows: DataFrame, block: int, keep_rows: bool) -> DataFrame:
    """One row a block. ``whole``: the block is a conversation, with its results; else (or with ``keep_rows``) with its rows."""
    fields = [("conv_id", pa.int64()), ("pid", pa.int32()), ("blk", pa.int32()), ("whole", pa.bool_()), *_RESULT, ("rows", pa.list_(_ROW))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        out: list[tuple] = []
        held = blk = size = 0
        turns: list = []
        rows: list[tuple[bytes, bytes]] = []
        conv, started, opened = None, False, True  # opened: the conversation may have begun before this block

        def close(ended: bool) -> None:
            nonlocal blk, held
            kept = None
            if opened or not ended:
                results: tuple = (None,) * len(_RESULT)
            else:
                d = describe(turns, rows)
                v: Vector = END
                for code in reversed(d["codes"]):
                    v = step(code, v)
                audit, state = walk(d["codes"], END, 0) if rows else ("", 0)
                audit += closing(state)
                results = (_gaps(d["low"], d["high"], d["distinct"]), d["blank"], d["duplicate"], d["truncated"], d["illegal"],
                           v[0], audit, _digest(replay(rows, audit, 0)))
            if keep_rows or results[0] is None:
                kept = [{"turn": t, "role": r, "text": x} for t, (r, x) in zip(turns, rows)]
                held += size
            out.append((conv, pid, blk, results[0] is not None, *results, kept))
            blk += 1
            turns.clear()
            rows.clear()

        for batch in slices(batches, "text", 1 << 20):
            for c, turn, role, text, copies in zip(*[batch.column(i).to_pylist() for i in ("conv_id", "turn", "role", "text", "copies")]):
                if started and c != conv:
                    close(True)
                    opened, size = False, 0
                elif len(rows) >= block or size > BLOCK_BYTES:
                    close(False)
                    opened, size = True, 0
                conv, started = c, True
                for _ in range(copies):
                    turns.append(turn)
                    rows.append((role, text))
                    size += len(text)
                if len(out) >= 512 or held > BLOCK_BYTES:
                    yield _table(out, fields)
                    out.clear()
                    held = 0
        if started:
            close(False)  # the next task may go on with it
        if out:
            yield _table(out, fields)

    n = tasks(rows.sparkSession)
    order = ["conv_id", "turn", "role", "tie", "spread"]
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return sorted_rows.select("conv_id", "turn", "role", "text", "copies").mapInArrow(
        run, f"conv_id long, pid int, blk int, whole boolean, {_RESULT_DDL}, {_ROWS_DDL}")


def _pairs(rows: list[dict]) -> tuple[list, list[tuple[bytes, bytes]]]:
    return [r["turn"] for r in rows], [(r["role"], r["text"]) for r in rows]


_CODED = [("conv_id", pa.int64()), ("pid", pa.int32()), ("blk", pa.int32()), ("codes", pa.string()), ("matrix", pa.list_(pa.int64())),
          ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("low", pa.int64()),
          ("high", pa.int64()), ("distinct", pa.int64()), ("first", pa.binary()), ("last", pa.binary())]


def _coded(parts: DataFrame) -> DataFrame:
    """Per block of the conversations that are not whole: codes, counts and the matrix of its costs. A row is new if it
    is the first of its role and text in the block, and its block holds the first one of the conversation."""
    here = F.posexplode("rows").alias("pos", "r")
    seen = parts.select("conv_id", "pid", "blk", here).select(
        "conv_id", F.sha2(F.concat("r.role", F.lit(b"\0"), "r.text"), 256).alias("key"), F.struct("pid", "blk", "pos").alias("place"))
    new = (seen.groupBy("conv_id", "key").agg(F.min("place").alias("p")).groupBy("p.pid", "p.blk")
           .agg(F.collect_list("p.pos").alias("new")))  # at most a block's rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                turns, rows = _pairs(r["rows"])
                d = describe(turns, rows, set(r["new"] or ()))
                matrix = []
                for j in range(4):
                    v: Vector = tuple(0 if s == j else FAR for s in range(4))
                    for code in reversed(d["codes"]):
                        v = step(code, v)
                    matrix += v  # column j: from each state before to state j after
                out.append(tuple({**r, **d, "matrix": matrix}[n] for n, _ in _CODED))
            yield _table(out, _CODED)

    ddl = ("conv_id long, pid int, blk int, codes string, matrix array<long>, blank long, duplicate long, truncated long, illegal long, "
           "low long, high long, distinct long, first binary, last binary")
    return parts.join(new, ["pid", "blk"], "left").select("conv_id", "pid", "blk", "rows", "new").mapInArrow(run, ddl)


def _ordered(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: (r["pid"], r["blk"]))


def _ends(coded: DataFrame) -> DataFrame:
    """``pid, blk, end, is_last, cost``: the checkpoint behind every block; the whole cost at a conversation's first."""

    def run(table: pa.Table) -> pa.Table:
        out, v, last = [], np.array(END, np.int64), True
        for r in reversed(_ordered(table)):
            m = np.array(r["matrix"], np.int64).reshape(4, 4)  # [after, before]
            out.append([r["pid"], r["blk"], v.tolist(), last, None])
            v, last = np.minimum((m + v[:, None]).min(axis=0), FAR), False
        out[-1][4] = int(v[0])
        return pa.Table.from_batches([_table(out, [("pid", pa.int32()), ("blk", pa.int32()), ("end", pa.list_(pa.int64())),
                                                   ("is_last", pa.bool_()), ("cost", pa.int64())])])

    return coded.select("conv_id", "pid", "blk", "matrix").groupBy("conv_id").applyInArrow(
        run, "pid int, blk int, end array<long>, is_last boolean, cost long")


def _walked(coded: DataFrame, ends: DataFrame) -> DataFrame:
    """The edits of every block from each of the four states, and the state after it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                got = [walk(r["codes"], tuple(r["end"]), s) for s in range(4)]
                if r["is_last"]:
                    got = [(a + closing(s), s) for a, s in got]
                out.append((r["conv_id"], r["pid"], r["blk"], [a for a, _ in got], [s for _, s in got]))
            yield _table(out, [("conv_id", pa.int64()), ("pid", pa.int32()), ("blk", pa.int32()), ("audits", pa.list_(pa.string())), ("states", pa.list_(pa.int32()))])

    return coded.join(ends, ["pid", "blk"]).select("conv_id", "pid", "blk", "codes", "end", "is_last").mapInArrow(
        run, "conv_id long, pid int, blk int, audits array<string>, states array<int>")


def _starts(walked: DataFrame) -> DataFrame:
    """``pid, blk, start``: the state in which the walk reaches each block."""

    def run(table: pa.Table) -> pa.Table:
        out, state = [], 0
        for r in _ordered(table):
            out.append((r["pid"], r["blk"], state))
            state = r["states"][state]
        return pa.Table.from_batches([_table(out, [("pid", pa.int32()), ("blk", pa.int32()), ("start", pa.int32())])])

    return walked.select("conv_id", "pid", "blk", "states").groupBy("conv_id").applyInArrow(run, "pid int, blk int, start int")


def _streamed(parts: DataFrame) -> DataFrame:
    """Results of the conversations of several blocks: their blocks in order, one task reading a conversation."""
    order = ["conv_id", "pid", "blk"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("conv_id", pa.int64()), *_RESULT]
        now: dict | None = None

        def result() -> tuple:
            return (now["conv_id"], _gaps(now["low"], now["high"], now["distinct"]), *[now[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                    "".join(now["audits"]), now["sha"].hexdigest())

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        out.append(result())
                    now = {"conv_id": r["conv_id"], "low": None, "high": None, "distinct": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                           "illegal": 0, "cost": r["cost"], "audits": [], "sha": sha256(), "any": False, "last": None}
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    now[c] += r[c]
                if r["first"] is not None:
                    now["illegal"] += now["last"] is not None and now["last"] + r["first"] not in (b"su", b"ua", b"au")
                    now["last"] = r["last"]
                if r["low"] is not None:
                    now["distinct"] += r["distinct"] - (now["high"] == r["low"])
                    now["low"], now["high"] = r["low"] if now["low"] is None else now["low"], r["high"]
                now["audits"].append(r["audit"])
                for role, text in replay(_pairs(r["rows"])[1], r["audit"], r["start"]):
                    now["sha"].update((b"\n" if now["any"] else b"") + role + b":" + text)
                    now["any"] = True
            if out:
                yield _table(out, fields)
        if now is not None:
            yield _table([result()], fields)

    columns = [*order, "rows", "start", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct", "first", "last"]
    return parts.select(columns).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id long, {_RESULT_DDL}")


def _solved(rows: DataFrame, block: int, keep_rows: bool) -> tuple[DataFrame, DataFrame]:
    """Blocks that are whole conversations, and all others with ``start``, ``audit`` and ``cost``."""
    spark = rows.sparkSession
    prepare(spark)
    copies = F.greatest(F.coalesce(F.col("copies").cast("int"), F.lit(1)), F.lit(0)) if "copies" in rows.columns else F.lit(1)
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    flat = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.cast("binary").alias("role"),
                       text.cast("binary").alias("text"), copies.alias("copies"), F.md5(text.cast("binary")).alias("tie"),
                       F.monotonically_increasing_id().alias("spread"))
    longest = flat.groupBy("conv_id").agg(F.sum("copies").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    blocks = checkpoint(_blocks(flat, max(block, isqrt(longest)), keep_rows))
    parts = blocks.where("not whole").select("conv_id", "pid", "blk", "rows")
    coded = checkpoint(_coded(parts))
    ends = checkpoint(_ends(coded))
    walked = checkpoint(_walked(coded, ends))
    ways = walked.join(_starts(walked), ["pid", "blk"]).select("pid", "blk", "start", F.col("audits")[F.col("start")].alias("audit"))
    counted = coded.drop("conv_id", "codes", "matrix")
    solved = parts.join(counted, ["pid", "blk"]).join(ends.select("pid", "blk", "cost"), ["pid", "blk"]).join(ways, ["pid", "blk"])
    return blocks.where("whole"), solved


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text``, and optionally ``copies``: how often the row
    stands there, 0 if it is gone but its conversation is to be reported): ``gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn, nulls first; rows of one turn by role, then md5 of the text. A null conv_id is a conversation
    like any other; a null role or text is one space - a role without an initial, a blank row. An empty role has no
    initial either, so its row cannot be kept. A conversation without rows has zeros, an empty audit and the digest of
    the empty string; an empty table gives an empty result. Repeated rows are duplicates of each other. A text is held
    whole in a task."""
    whole, parts = _solved(rows, block, False)
    return whole.select("conv_id", *RESULTS).unionByName(_streamed(parts))


def repaired_turns(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (an array that orders their rows), ``role, text``."""
    whole, parts = _solved(rows, block, True)
    both = whole.select("conv_id", "pid", "blk", "rows", F.lit(0).alias("start"), "audit").unionByName(
        parts.select("conv_id", "pid", "blk", "rows", "start", "audit"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                turns = replay(_pairs(r["rows"])[1], r["audit"], r["start"])
                yield _table([(r["conv_id"], [r["pid"], r["blk"], n], role.decode("utf-8", "replace"), text.decode("utf-8", "replace"))
                              for n, (role, text) in enumerate(turns)],
                             [("conv_id", pa.int64()), ("place", pa.list_(pa.int32())), ("role", pa.string()), ("text", pa.string())])

    return both.mapInArrow(run, "conv_id long, place array<int>, role string, text string")


def damage(rows: DataFrame) -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20 - 0 drops the row, 1 empties its text, 2 takes
    its full stops, 3 repeats it, 4 makes its role user - as rows with ``copies``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
                       F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
