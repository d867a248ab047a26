"""Chat formatting by minimum-cost role repair.

Legal conversations: at most one system turn, then user and assistant in turn,
from user to assistant. The automaton's states are the role of the last turn
rendered: START, SYSTEM, USER, ASSISTANT; a conversation ends after ASSISTANT.
Each input turn may be kept, relabelled, or merged into the turn before it; an
empty turn may be inserted before a turn or at the end. Dynamic programming
finds the cheapest repair.

A turn is a 4 x 4 cost matrix (from state to state), and turns in a row multiply
in the (min, +) sense. Conversations are cut into chunks of turns by the turn
number; chunks are multiplied by themselves, the few chunk matrices of a
conversation are followed in order, and each chunk is then solved again from its
entry state. So one conversation with a third of all turns is many small groups,
and the result is one row per turn: concatenated in order, ``rendered`` is the
conversation.

Defined results: an unknown or null role costs a relabelling; a null text is
empty; null turn numbers come first; equal turn numbers are ordered by role and
text (nulls first); repeated rows are turns of their own; a null conv_id is a
conversation; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import saved

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
CHUNK = 512                # turn numbers of a chunk
MERGE, RELABEL, INSERT = 2.0, 3.0, 4.0
KEEP, MERGED, RELABELLED, MERGED_RELABELLED = "keep", "merge", "relabel", "relabel+merge"
_INF = np.inf
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}   # legal turns


def _paths() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest inserted turns that lead from a state to where a turn of a role is legal."""
    out: dict[tuple[int, int], tuple[int, ...]] = {}
    for s in range(4):
        todo: list[tuple[int, tuple[int, ...]]] = [(s, ())]
        for state, path in todo:
            for role in _NEXT[state]:
                out.setdefault((s, role), path)
                if len(path) < 3:
                    todo.append((role, (*path, role)))
    return out


_INSERTS = _paths()


def _options(role: int) -> list[tuple[int, int, float, str, tuple[int, ...]]]:
    """(from, to, cost, operation, inserted roles) of a turn of the given role (0: unknown)."""
    out = []
    for s in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            change = 0.0 if to == role else RELABEL
            if (s, to) in _INSERTS:
                path = _INSERTS[s, to]
                out.append((s, to, change + INSERT * len(path), KEEP if to == role else RELABELLED, path))
            if s == to:
                out.append((s, to, change + MERGE, MERGED if to == role else MERGED_RELABELLED, ()))
    return out


def _best(role: int) -> tuple[np.ndarray, dict[tuple[int, int], tuple[str, tuple[int, ...]]]]:
    cost, what = np.full((4, 4), _INF), {}
    for s, to, c, op, path in _options(role):
        if c < cost[s, to]:
            cost[s, to], what[s, to] = c, (op, path)
    return cost, what


_COST, _WHAT = zip(*(_best(r) for r in range(4)), strict=True)
# the end: an empty user or assistant turn makes the conversation legal
_END = {START: 0.0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0.0}
_END_INSERTS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _role(r: str | None) -> int:
    return ROLES.index(r) if r in ROLES[1:] else 0


def _product(roles: list[int]) -> np.ndarray:
    """(min, +) product of the turns' matrices."""
    out = np.where(np.eye(4, dtype=bool), 0.0, _INF)
    for r in roles:
        out = (out[:, :, None] + _COST[r][None]).min(1)
    return out


def solve(roles: list[int], entry: int, leave: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """(new role, operation, inserted before) per turn of the cheapest way from ``entry`` to ``leave``.
    Ties go to the earlier state in the order START, SYSTEM, USER, ASSISTANT."""
    best, back = np.full(4, _INF), []
    best[entry] = 0.0
    for r in roles:
        via = best[:, None] + _COST[r]
        back.append(via.argmin(0))
        best = via.min(0)
    out, state = [], leave
    for r, b in zip(reversed(roles), reversed(back), strict=True):
        before = int(b[state])
        op, path = _WHAT[r][before, state]
        out.append((state, op, path))
        state = before
    return out[::-1]


KEYS = ("nul", "conv", "chunk")


def _keyed(turns: DataFrame) -> DataFrame:
    turn, conv = F.col("turn").cast("long"), F.col("conv_id").cast("long")
    return turns.select(
        conv.isNull().alias("nul"), F.coalesce(conv, F.lit(0)).alias("conv"),
        F.coalesce(F.floor(turn / CHUNK), F.lit(-(1 << 62))).cast("long").alias("chunk"),
        turn.alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def _together(df: DataFrame, keys: tuple[str, ...], *order: str) -> DataFrame:
    """The rows of a key in one task, one after the other, in order."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *[F.col(c).asc_nulls_first() for c in order])


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys, as lists by column, of sorted batches."""
    held: dict[str, list] | None = None
    for b in batches:
        cols = b.to_pydict()
        key = list(zip(*(cols[k] for k in keys), strict=True))
        edges = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)] if key else []
        for lo, hi in zip(edges, edges[1:], strict=False):
            part = {c: v[lo:hi] for c, v in cols.items()}
            if held is not None and tuple(held[k][0] for k in keys) == key[lo]:
                for c, v in part.items():
                    held[c] += v
            else:
                if held is not None:
                    yield held
                held = part
    if held is not None:
        yield held


def _matrices(keyed: DataFrame) -> DataFrame:
    """The cost matrix of each chunk."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, KEYS):
            cost = _product([_role(r) for r in g["role"]])
            yield pa.RecordBatch.from_pydict({**{k: g[k][:1] for k in KEYS}, "cost": [cost.ravel().tolist()]})

    rows = _together(keyed.select(*KEYS, "turn", "role", "text"), KEYS, "turn", "role", "text")
    return rows.select(*KEYS, "role").mapInArrow(job, "nul boolean, conv long, chunk long, cost array<double>")


def _entries(chunks: DataFrame) -> DataFrame:
    """Entry and exit state of each chunk, from the chunk matrices of its conversation in order."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, KEYS[:2]):
            best, back = np.full(4, _INF), []
            best[START] = 0.0
            for m in g["cost"]:
                via = best[:, None] + np.array(m).reshape(4, 4)
                back.append(via.argmin(0))
                best = via.min(0)
            state = int(np.argmin(best + np.array([_END[s] for s in range(4)])))
            entry, leave = [], []
            for b in reversed(back):
                leave.append(state)
                state = int(b[state])
                entry.append(state)
            last = [False] * (len(back) - 1) + [True]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(g[k]) for k in KEYS), pa.array(entry[::-1], pa.int32()), pa.array(leave[::-1], pa.int32()),
                 pa.array(last)], [*KEYS, "entry", "leave", "last"])

    return _together(chunks, KEYS[:2], "chunk").mapInArrow(
        job, "nul boolean, conv long, chunk long, entry int, leave int, last boolean")


def repair(turns: DataFrame, begin: str = "<|{role}|>\n", end: str = "\n") -> DataFrame:
    """Per turn: conv_id, turn, role, new_role, op, inserted (roles before it), closing (roles inserted
    after the last turn) and rendered. ``begin`` opens a rendered turn and ``end`` closes it; a
    merged turn continues the one before it on a new line."""
    keyed = _keyed(turns)
    states = saved(_entries(_matrices(keyed)), "chat-states")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, KEYS):
            n, leave, first = len(g["role"]), g["leave"][0], g["entry"][0] == START
            out: dict[str, list] = {c: [] for c in ("new_role", "op", "inserted", "closing", "rendered")}
            for i, (new, op, path) in enumerate(solve([_role(r) for r in g["role"]], g["entry"][0], leave)):
                piece = []
                merged = op in (MERGED, MERGED_RELABELLED)
                for r in (*path, *(() if merged else (new,))):
                    piece.append(("" if first else end) + begin.format(role=ROLES[r]))
                    first = False
                piece.append(("\n" if merged else "") + (g["text"][i] or ""))
                closing = _END_INSERTS[leave] if g["last"][0] and i == n - 1 else ()
                piece += [end + begin.format(role=ROLES[r]) for r in closing]
                if g["last"][0] and i == n - 1:
                    piece.append(end)
                for c, v in zip(out, (ROLES[new], op, [ROLES[r] for r in path], [ROLES[r] for r in closing],
                                      "".join(piece)), strict=True):
                    out[c].append(v)
            strings = pa.list_(pa.string())
            conv = [None if nul else c for nul, c in zip(g["nul"], g["conv"], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(g["turn"], pa.int64()), pa.array(g["role"], pa.string()),
                 pa.array(out["new_role"]), pa.array(out["op"]), pa.array(out["inserted"], strings),
                 pa.array(out["closing"], strings), pa.array(out["rendered"])],
                ["conv_id", "turn", "role", "new_role", "op", "inserted", "closing", "rendered"])

    return _together(keyed.join(states, [*KEYS]), KEYS, "turn", "role", "text").mapInArrow(
        job, "conv_id long, turn long, role string, new_role string, op string, inserted array<string>, "
             "closing array<string>, rendered string")


def repair_cost(turns: DataFrame) -> DataFrame:
    """conv_id and the cost of its repair."""
    done = repair(turns)
    cost = (F.when(F.col("op").isin(RELABELLED, MERGED_RELABELLED), RELABEL).otherwise(0.0)
            + F.when(F.col("op").isin(MERGED, MERGED_RELABELLED), MERGE).otherwise(0.0)
            + (F.size("inserted") + F.size("closing")) * INSERT)
    return done.groupBy("conv_id").agg(F.sum(cost).alias("cost"))


def chat_digest(turns: DataFrame) -> DataFrame:
    done = repair(turns)
    return done.select("conv_id", "turn", "role", "new_role", "op",
                       F.array_join("inserted", ",").alias("inserted"), F.array_join("closing", ",").alias("closing"),
                       F.sha2("rendered", 256).alias("rendered_sha256"))
