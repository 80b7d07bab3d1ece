"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation from a user on, ending
with an assistant.  The automaton's states are the role of the last turn: none, system, user, assistant.  Each turn
is used in one of these ways, and dynamic programming finds the cheapest way through:

* keep its role (0) or relabel it (``RELABEL``), as the next legal turn;
* before that, insert an empty turn (``INSERT``) where the next legal role is missing;
* merge it into the turn before (``MERGE``), if it has that turn's role, or relabelled (``MERGE + RELABEL``).

A missing answer at the end is an inserted empty assistant turn.  Ties take the first in the order of ``WAYS``.

A turn acts on the costs as a 4 x 4 matrix in (min, +) algebra, and such matrices multiply in any
grouping.  So a conversation of any length is cut into blocks of at most ``BLOCK`` turns: every block's matrix is
computed by itself, the matrices of a conversation's blocks are folded in order (4 x 4 numbers a block; blocks of blocks when there are
more than ``BLOCK``), and each block is then solved between its known first and last state.  No task ever holds a whole long conversation.

The rendering is one row per turn: the pieces of a conversation, joined in order, are its text.  A marker that a turn's
own text holds is escaped (``<|`` becomes ``<\\|``, and one more backslash where there are some already), so no text can close a
conversation or open a turn; ``parse`` reads the rendering back.

Defined cases: unknown or null roles are relabelled (no role is kept for free); a null text is an empty one; turns are
ordered by turn (nulls last), then role and text, so repeated rows follow each other; null conversation ids form one conversation;
extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, map_groups, running_sums, written

ROLES = ["none", "system", "user", "assistant"]
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: roles that may follow each state
NEXT = {NONE: [SYSTEM, USER], SYSTEM: [USER], USER: [ASSISTANT], ASSISTANT: [USER]}
RELABEL, INSERT, MERGE = 4, 2, 1
BLOCK = 512
FAR = 1 << 40


def _ways() -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(state before, state after, cost without relabelling, kind, roles inserted before), in the order of preference."""
    out = [(s, r, 0, "turn", ()) for s in NEXT for r in NEXT[s]]
    out += [(s, s, MERGE, "merge", ()) for s in (SYSTEM, USER, ASSISTANT)]
    out += [(s, r, INSERT, "turn", (gap,)) for s in NEXT for gap in NEXT[s] for r in NEXT[gap]]
    out += [(s, r, 2 * INSERT, "turn", (gap, second)) for s in NEXT for gap in NEXT[s] for second in NEXT[gap] for r in NEXT[second]]
    return out


WAYS = _ways()
#: what is missing at the end of a conversation, by its last state
ENDS = {NONE: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
END_COST = np.array([INSERT * len(ENDS[s]) for s in range(4)])


def _matrices() -> np.ndarray:
    """Cost from state to state of one turn, by its own role (0: unknown), least over all ways."""
    m = np.full((4, 4, 4), FAR, dtype=np.int64)
    for role in range(4):
        for before, after, cost, _, _ in WAYS:
            m[role, before, after] = min(m[role, before, after], cost + RELABEL * (role != after))
    return m


TURN = _matrices()


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product of 4 x 4 matrices."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def role_numbers(roles) -> np.ndarray:
    known = {r: i for i, r in enumerate(ROLES) if i}
    return np.array([known.get(r, 0) for r in roles], dtype=np.int64)


def block_matrix(roles: np.ndarray) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for r in roles:
        out = times(out, TURN[r])
    return out


def solve(roles: np.ndarray, first: int, last: int) -> list[tuple[str, int, tuple[int, ...]]]:
    """The cheapest (kind, role, inserted before) of each turn, from state ``first`` to state ``last``."""
    best = [np.full(4, FAR, dtype=np.int64)]
    best[0][first] = 0
    for r in roles:
        best.append(np.minimum((best[-1][:, None] + TURN[r]).min(axis=0), FAR))
    out, state = [], last
    for i in range(len(roles) - 1, -1, -1):
        for before, after, cost, kind, gaps in WAYS:
            if after == state and best[i][before] + cost + RELABEL * (roles[i] != after) == best[i + 1][state] < FAR:
                out.append((kind, after, gaps))
                state = before
                break
    return out[::-1]


def chain(matrices: list[np.ndarray], first: int, last: int) -> list[tuple[int, int]]:
    """(state before, state after) of each of consecutive blocks, on a cheapest way from ``first`` to ``last``."""
    best = [np.full(4, FAR, dtype=np.int64)]
    best[0][first] = 0
    for m in matrices:
        best.append(np.minimum((best[-1][:, None] + m).min(axis=0), FAR))
    out, state = [], last
    for i in range(len(matrices) - 1, -1, -1):
        before = int(np.argmax(best[i] + matrices[i][:, state] == best[i + 1][state]))
        out.append((before, state))
        state = before
    return out[::-1]


def _matrix(cells: list[int]) -> np.ndarray:
    return np.array(cells, dtype=np.int64).reshape(4, 4)


# per group of rows: (conv_no, block), rows sorted as their columns say

def _block_summary(key, rows):  # rows: pos, role
    return [(*key, block_matrix(role_numbers([r[1] for r in rows])).ravel().tolist())]


def _fold_summary(key, rows):  # rows: block, cells
    out = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for _, cells in rows:
        out = times(out, _matrix(cells))
    return [(*key, out.ravel().tolist())]


def _fold_solve(key, rows):  # rows: block, cells, first, last: the states at the two ends of them all
    states = chain([_matrix(r[1]) for r in rows], rows[0][2], rows[0][3])
    return [(key[0], r[0], first, last) for r, (first, last) in zip(rows, states)]


def _block_solve(key, rows):  # rows: pos, role, first, last
    ways = solve(role_numbers([r[1] for r in rows]), rows[0][2], rows[0][3])
    return [(key[0], r[0], kind, ROLES[role], [ROLES[g] for g in gaps]) for r, (kind, role, gaps) in zip(rows, ways)]


def _grouped(df: DataFrame, columns: list[str], run, schema: str) -> DataFrame:
    return map_groups(df.select(*columns), 2, 1, run, [c.split()[0] for c in schema.split(", ")], schema)


CELLS = "conv_no bigint, block bigint, cells array<bigint>"
STATES = "conv_no bigint, block bigint, first int, last int"
WAYS_TAKEN = "conv_no bigint, pos bigint, kind string, new_role string, inserted array<string>"


def repair_roles(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per turn of the input: conv_id, turn, pos (from 0), role, text, kind (turn or merge), new_role,
    inserted (roles of empty turns before it), at_end, closing (roles of empty turns after the last one)."""
    slim = turns.select(F.col(conv_col).cast("string").alias("conv_key"), F.col(conv_col).alias("conv_id"),
                        F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    slim = slim.withColumns({"one": F.lit(1).cast("bigint"), "content": F.xxhash64("role", "text")})
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("content"), F.col("text")]
    placed = running_sums(slim, order, ["one"], "turns", ["conv_key"])
    numbers = written(placed.groupBy("conv_key").agg(F.count(F.lit(1)).alias("turns"))
                      .withColumn("conv_no", F.monotonically_increasing_id()), "conversations")
    rows = written(join_groups(placed.withColumnRenamed("before_one", "pos"), numbers, ["conv_key"], "turns")
                   .select("conv_no", "conv_id", "turn", "pos", "role", "text", "turns"), "placed-turns")
    slim_rows = rows.select("conv_no", "pos", "role", F.expr(f"pos div {block}").alias("block"))
    levels = [written(_grouped(slim_rows, ["conv_no", "block", "pos", "role"], _block_summary, CELLS), "blocks")]
    while not levels[-1].where("block > 0").isEmpty():
        up = levels[-1].withColumn("inner", F.col("block")).withColumn("block", F.expr(f"block div {block}"))
        grouped = up.select("conv_no", F.col("block").alias("outer"), F.col("inner").alias("block"), "cells")
        levels.append(written(_grouped(grouped, ["conv_no", "outer", "block", "cells"], _fold_summary, CELLS), "folds"))
    # the whole conversation: from no turn at all to the last state that is cheapest with its missing end
    ends = [F.element_at("cells", s + 1) + int(END_COST[s]) for s in range(4)]  # row 0 of the matrix: from NONE
    cheapest = F.least(*ends)
    last = F.when(ends[ASSISTANT] == cheapest, ASSISTANT).when(ends[USER] == cheapest, USER).when(
        ends[SYSTEM] == cheapest, SYSTEM).otherwise(NONE)
    states = levels[-1].select("conv_no", "block", F.lit(NONE).alias("first"), last.alias("last"))
    for below in levels[-2::-1]:
        asked = below.withColumn("outer", F.expr(f"block div {block}")).join(
            states.withColumnRenamed("block", "outer"), ["conv_no", "outer"])
        states = written(_grouped(asked, ["conv_no", "outer", "block", "cells", "first", "last"], _fold_solve, STATES),
                         "states")
    solved = _grouped(slim_rows.join(states, ["conv_no", "block"]), ["conv_no", "block", "pos", "role", "first", "last"],
                      _block_solve, WAYS_TAKEN)
    closing = F.create_map(*[x for s, e in ENDS.items() for x in (
        F.lit(ROLES[s]), F.array(*[F.lit(ROLES[r]) for r in e]).cast("array<string>"))])
    at_end = F.col("pos") == F.col("turns") - 1
    return rows.join(solved, ["conv_no", "pos"]).select(
        "conv_no", "conv_id", "turn", "pos", "role", "text", "kind", "new_role", "inserted",
        at_end.alias("at_end"),
        F.when(at_end, closing[F.col("new_role")]).otherwise(F.array().cast("array<string>")).alias("closing"))


def render(repaired: DataFrame) -> DataFrame:
    """``repaired`` with ``piece``: the turn's share of the conversation's text.

    A turn is ``<|role|>`` and its text on lines of their own; a merged text follows after a line end;
    ``<|end|>`` closes a conversation; markers inside texts are escaped."""
    def empty(roles):
        return F.concat_ws("", F.transform(roles, lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n\n"))))

    plain = F.regexp_replace(F.coalesce("text", F.lit("")), r"<(\\*)\|", r"<$1\\|")  # one backslash more
    text = F.concat(plain, F.lit("\n"))
    own = F.when(F.col("kind") == "merge", text).otherwise(F.concat(F.lit("<|"), "new_role", F.lit("|>\n"), text))
    end = F.when(F.col("at_end"), F.lit("<|end|>\n")).otherwise(F.lit(""))
    return repaired.withColumn("piece", F.concat(empty(F.col("inserted")), own, empty(F.col("closing")), end))


_MARKER = re.compile(r"^<\|(system|user|assistant|end)\|>\n", re.MULTILINE)
_ESCAPED = re.compile(r"<(\\*)\\\|")


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) of a rendered conversation; the texts of merged turns stay joined by a line end."""
    marks = list(_MARKER.finditer(text))
    ends = [m.start() for m in marks[1:]] + [len(text)]
    return [(m.group(1), _ESCAPED.sub(r"<\1|", text[m.end():end - 1])) for m, end in zip(marks, ends) if m.group(1) != "end"]
