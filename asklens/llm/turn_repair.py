"""Conversation structure repair: the cheapest edits that give a conversation legal turns.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in alternation, ending
with an assistant.  A role counts by its first letter (s, u, a).  Edits of a row: K keep, R change the role to user or
assistant, D delete; before a row and at the end, I inserts an empty user or assistant turn.  Blank rows and rows whose role and
text the conversation had before must be deleted; a row whose last visible character is not ``.``, ``!`` or ``?`` costs ``truncated``
unless deleted.  Among equally cheap repairs the one with the ASCII-least string of edits wins.

Survivor-coalescence Viterbi: for each state of the automaton (nothing, system, user, assistant) one cheapest way to it
survives a row.  The ways form a tree of back pointers whose nodes count their references; a node without any goes, and once
all survivors share an ancestor, the edits up to it are final and are emitted at once.  A state whose cost exceeds another's by more than
the rest can win back does not survive.  So a task holds the unresolved tail
of one conversation, never the whole.  Ties of cost compare the complete unresolved tails.  That is exact: the
edits of a row, its insertions first, are a word that ends with its only letter other than I, so no word begins another one and the first
row in which two tails differ decides; and two tails at one cost cannot have equal words, as the words fix the state and the cost.

Conversations of up to ``long_rows`` turns, or up to 1 / ``LONG_SHARE`` of all rows, are streamed whole by the task that their key
falls to.  Longer ones (at most ``LONG_SHARE`` by counting, so their ids are broadcast) are dealt by ranges of their
turns over all tasks and cut into blocks of ``long_rows``: repeated turns are found by a group-by of digests, every block gives the
cost of its best edits from state to state with the rank of their strings among the block's, the blocks' tables are streamed through the same survivor tree
(labels are ranks then), and each block is solved between its two states.  Both paths give the same rows.

Defined cases: a null role or text is one space; turns are ordered by number, nulls first, then role, XXH64 of the
text and text, so repeated rows follow each other; rows with a null conversation id are one conversation; extra columns are
not looked at; an empty table gives an empty result; texts of any length are handled whole.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import map_batches, map_groups, running_sums, written

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLE_OF = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: the role that a change or an insertion gives, by the state before
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: state after keeping a row with this initial
KEEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL_PAIRS = frozenset(["su", "ua", "au"])
CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
SPACE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")

LONG_ROWS = 256
LONG_SHARE = 100_000
FAR = 1 << 60


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def ways(costs: Costs, initial: str, fault: str | None) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, word) of one row."""
    out = []
    for before in STATES:
        state, word = before, ""
        for _ in range(3):  # a third insertion would lead back to a state already met
            spent = costs.insert * len(word)
            out.append((before, state, spent + costs.delete, word + "D"))
            if fault not in ("blank", "duplicate"):
                spent += costs.truncated * (fault == "truncated")
                if (state, initial) in KEEP:
                    out.append((before, KEEP[state, initial], spent, word + "K"))
                out.append((before, NEXT[state], spent + costs.rerole, word + "R"))
            state, word = NEXT[state], word + "I"
    return out


class Ways(dict):
    """The ways of a row by (initial, fault), made when first asked for."""

    def __init__(self, costs: Costs):
        super().__init__()
        self.costs = costs

    def __missing__(self, key):
        self[key] = ways(self.costs, *key)
        return self[key]


class Node:
    __slots__ = ("up", "label", "state", "refs", "children")

    def __init__(self, up: "Node | None", label, state: int):
        self.up, self.label, self.state, self.refs, self.children = up, label, state, 0, set()


def behind(costs: Costs) -> dict[tuple[int, int], int]:
    """(state, other): at most so much dearer the rest of any conversation is from ``state`` than from ``other``.

    From ``state`` one inserts what leads to where the other's rest can be repeated; a system turn that the other
    would still keep is deleted instead, and a system turn that stands alone at the end gets its two turns."""
    one, two = costs.insert, 2 * costs.insert
    return {(ASSISTANT, NOTHING): costs.delete, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): one,
            (USER, NOTHING): one + costs.delete, (USER, SYSTEM): one, (USER, ASSISTANT): one,
            (NOTHING, SYSTEM): 0, (NOTHING, USER): one, (NOTHING, ASSISTANT): 0,
            (SYSTEM, NOTHING): two + costs.delete, (SYSTEM, USER): one, (SYSTEM, ASSISTANT): two}


class Survivors:
    """One cheapest way to each state, as a tree of back pointers; ``step`` gives the labels that became final.

    With ``bounds`` (see ``behind``) a state that can no longer be on a cheapest way, not even a tied one, is let go:
    otherwise the way that deletes every row would keep the whole conversation unresolved."""

    def __init__(self, start: int, bounds: dict[tuple[int, int], int] | None = None):
        self.bounds = bounds or {}
        self.root = Node(None, None, start)
        self.live: dict[int, tuple[int, Node]] = {start: (0, self.root)}
        self.root.refs = 1

    def _tail(self, node: Node) -> list:
        out = []
        while node is not self.root:
            out.append(node.label)
            node = node.up
        out.reverse()
        return out

    def _less(self, a: tuple, b: tuple) -> bool:
        """Whether the first of two equally cheap (node, label) has the lesser labels."""
        if a[0] is b[0]:
            return a[1] < b[1]
        return [*self._tail(a[0]), a[1]] < [*self._tail(b[0]), b[1]]

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            node.up.children.discard(node)
            node = node.up
            node.refs -= 1

    def step(self, options) -> list:
        best: dict[int, tuple[int, Node, object]] = {}
        live = self.live
        for before, after, cost, label in options:
            if before in live:
                so_far, node = live[before]
                cost += so_far
                if cost >= FAR:
                    continue
                held = best.get(after)
                if held is None or cost < held[0] or (cost == held[0] and self._less((node, label), held[1:])):
                    best[after] = (cost, node, label)
        for (state, other), more in self.bounds.items():
            if state in best and other in best and best[state][0] + more < best[other][0]:
                del best[other]
        new = {}
        for state, (cost, up, label) in best.items():
            node = Node(up, label, state)
            node.refs = 1
            up.refs += 1
            up.children.add(node)
            new[state] = (cost, node)
        self.live = new
        for _, node in live.values():
            self._release(node)
        return self._final()

    def _final(self) -> list:
        """The labels that all survivors share, as (label, state after); the tree then starts below them."""
        out = []
        while len(self.root.children) == 1 and self.root.refs == 1:
            (self.root,) = self.root.children
            self.root.up = None
            out.append((self.root.label, self.root.state))
        return out

    def finish(self, extra) -> tuple[int, list, object]:
        """Cost, remaining (label, state after) and closing label of the cheapest of ``extra``: (state, cost, closing label)."""
        best = None
        for state, cost, closing in extra:
            if state in self.live:
                so_far, node = self.live[state]
                cost += so_far
                if best is None or cost < best[0] or (
                        cost == best[0] and [*self._tail(node), closing] < [*self._tail(best[1]), best[2]]):
                    best = (cost, node, closing)
        cost, node, closing = best
        rest = []
        while node is not self.root:
            rest.append((node.label, node.state))
            node = node.up
        return cost, rest[::-1], closing


def endings(costs: Costs) -> list[tuple[int, int, str]]:
    return [(s, costs.insert * len(CLOSING[s]), CLOSING[s]) for s in STATES]


def plain_fault(text: str) -> str | None:
    shown = text.rstrip(SPACE)
    if not shown:
        return "blank"
    return None if shown[-1] in ".!?" else "truncated"


def inserted(state: int, word: str) -> tuple[list[str], int]:
    roles = []
    for letter in word:
        if letter == "I":
            state = NEXT[state]
            roles.append(ROLE_OF[state])
    return roles, state


def expand(state: int, word: str, row: tuple) -> list[tuple]:
    """The output rows of one input row (conv_id, pos, turn, role, text, fault): insertions, then the row itself."""
    conv, pos, turn, role, text, fault = row
    roles, state = inserted(state, word)
    out = [(conv, pos, i, None, "I", None, r, "", None) for i, r in enumerate(roles)]
    letter = word[-1]
    new = role if letter == "K" else ROLE_OF[NEXT[state]] if letter == "R" else None
    return [*out, (conv, pos, 2, turn, letter, role, new, text, fault)]


def closing_rows(conv, pos: int, state: int, word: str) -> list[tuple]:
    return [(conv, pos, 3 + i, None, "I", None, r, "", None) for i, r in enumerate(inserted(state, word)[0])]


COLUMNS = ["conv_id", "pos", "place", "turn", "edit", "old_role", "role", "text", "fault"]


def _schema(conv: str, turn: str) -> str:
    return f"conv_id {conv}, pos bigint, place int, turn {turn}, edit string, old_role string, role string, text string, fault string"


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _batches(rows: Iterator[tuple], names: list[str], kind, size: int = 2048, chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), kind)], names)

    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight >= chars:
            yield made()
            held, weight = [], 0
    if held:
        yield made()


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _streamed(rows: Iterator[tuple], costs: Costs) -> Iterator[tuple]:
    """Output rows of conversations that lie whole and in order in ``rows`` (conv_id, turn, role, text)."""
    table, ends, bounds = Ways(costs), endings(costs), behind(costs)
    conv, survivors, pending, seen, pos, state = None, None, deque(), set(), 0, NOTHING

    def close():
        _, rest, closing = survivors.finish(ends)
        at = state
        for word, after in rest:
            yield from expand(at, word, pending.popleft())
            at = after
        yield from closing_rows(conv, pos, at, closing)

    for key, turn, role, text in rows:
        if survivors is None or key != conv:
            if survivors is not None:
                yield from close()
            conv, survivors, pos, state = key, Survivors(NOTHING, bounds), 0, NOTHING
            pending.clear()
            seen.clear()
        fault = plain_fault(text)
        if fault != "blank":
            content = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
            if content in seen:
                fault = "duplicate"
            seen.add(content)
        pending.append((conv, pos, turn, role, text, fault))
        pos += 1
        for word, after in survivors.step(table[role[:1], fault]):
            yield from expand(state, word, pending.popleft())
            state = after
    if survivors is not None:
        yield from close()


# long conversations: a row's symbol is its initial and its fault

def _symbol(text: str):
    initial, _, fault = text.partition("/")
    return initial, fault or None


def block_table(symbols: list, table: Ways) -> tuple[list[int], list[int]]:
    """Cost from state to state of a block of rows, 16 numbers, and the rank of the least edits of that cost among the block's."""
    found = {}
    for start in STATES:
        best = {start: (0, ())}
        for s in symbols:
            new: dict[int, tuple] = {}
            for before, after, cost, word in table[s]:
                if before in best:
                    way = (best[before][0] + cost, (*best[before][1], word))
                    if after not in new or way < new[after]:
                        new[after] = way
            best = new
        found |= {(start, end): way for end, way in best.items()}
    order = {words: i for i, words in enumerate(sorted({w for _, w in found.values()}))}
    pairs = [(a, b) for a in STATES for b in STATES]
    return ([found[p][0] if p in found else FAR for p in pairs], [order[found[p][1]] if p in found else 0 for p in pairs])


def _fold(rows: Iterator[tuple], costs: Costs) -> Iterator[tuple]:
    """(key, block, first state, last state, null) of all blocks, then (key, blocks, last state, null, closing);
    ``rows``: (key, block, costs, ranks) in order."""
    ends, bounds, pairs = endings(costs), behind(costs), [(a, b) for a in STATES for b in STATES]
    key, survivors, block, state = None, None, 0, NOTHING

    def close():
        _, rest, closing = survivors.finish(ends)
        at = state
        for i, (_, after) in enumerate(rest):
            yield key, block + i, at, after, None
            at = after
        yield key, block + len(rest), at, None, closing

    for k, _, prices, ranks in rows:
        if survivors is None or k != key:
            if survivors is not None:
                yield from close()
            key, survivors, block, state = k, Survivors(NOTHING, bounds), 0, NOTHING
        for _, after in survivors.step([(a, b, c, r) for (a, b), c, r in zip(pairs, prices, ranks)]):
            yield key, block, state, after, None
            block, state = block + 1, after
    if survivors is not None:
        yield from close()


def solve_block(symbols: list, table: Ways, first: int, last: int) -> list[tuple[str, int]]:
    """(word, state before) of each row of a block between two states."""
    survivors, words = Survivors(first), []
    for s in symbols:
        words += survivors.step(table[s])
    _, rest, _ = survivors.finish([(last, 0, "")])
    out, state = [], first
    for word, after in words + rest:
        out.append((word, state))
        state = after
    return out


def _long_edits(rows: DataFrame, costs: Costs, block: int, schema: str) -> DataFrame:
    """The output rows of long conversations: no task holds more than a block of one."""
    table = Ways(costs)
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = running_sums(rows.withColumns({"one": F.lit(1).cast("bigint"), "content": content}),
                          [F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.col("text")], ["one"],
                          "long-turns", ["key"])
    placed = written(placed.withColumnRenamed("before_one", "pos").drop("one"), "long-placed")
    slim = placed.select("key", "pos", "content", F.substring("role", 1, 1).alias("initial"),
                         F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).alias("shown"))
    first = slim.groupBy("key", "content").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("shown") == "", "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.col("shown").isin(".", "!", "?"), "truncated").otherwise(""))
    symbols = written(slim.join(first, ["key", "pos"], "left").select(
        "key", F.expr(f"pos div {block}").alias("block"), "pos", F.concat("initial", F.lit("/"), fault).alias("symbol")),
        "long-symbols")

    def tables(key, held):
        return [(*key, *block_table([_symbol(r[1]) for r in held], table))]

    priced = map_groups(symbols, 2, 1, tables, ["key", "block", "costs", "ranks"],
                        "key string, block bigint, costs array<bigint>, ranks array<int>")

    def fold(batches):
        yield from _batches(_fold(_tuples(batches), costs), ["key", "block", "first", "last", "closing"], fold_kind)

    fold_schema = "key string, block bigint, first int, last int, closing string"
    fold_kind = _arrow(fold_schema)
    # a 16 x 2 table of numbers a block, streamed in order: the survivor tree holds its unresolved tail only
    states = written(map_batches(priced.repartition("key").sortWithinPartitions("key", "block"), fold, fold_schema), "long-states")

    def solve(key, held):
        words = solve_block([_symbol(r[1]) for r in held], table, held[0][2], held[0][3])
        return [(key[0], r[0], r[1], word, state) for r, (word, state) in zip(held, words)]

    solved = map_groups(symbols.join(states.where("last IS NOT NULL").drop("closing"), ["key", "block"])
                        .select("key", "block", "pos", "symbol", "first", "last"), 2, 1, solve,
                        ["key", "pos", "symbol", "word", "state"], "key string, pos bigint, symbol string, word string, state int")

    kind = _arrow(schema)

    def emit(batches):
        rows = (out for conv, pos, turn, role, text, symbol, word, state in _tuples(batches)
                for out in expand(state, word, (conv, pos, turn, role, text, _symbol(symbol)[1])))
        yield from _batches(rows, COLUMNS, kind)

    edits = map_batches(placed.join(solved, ["key", "pos"]).select(
        "conv_id", "pos", "turn", "role", "text", "symbol", "word", "state"), emit, schema)
    ids = rows.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))

    def close(batches):
        rows = (out for conv, n, state, word in _tuples(batches) for out in closing_rows(conv, n, state, word))
        yield from _batches(rows, COLUMNS, kind)

    closed = map_batches(states.where("closing <> ''").join(ids, "key").select("conv_id", "n", "first", "closing"), close, schema)
    return edits.unionByName(closed)


def _split(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, long_rows: int,
           share: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of short conversations, rows of long ones or None)."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"))
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    counts = turns.groupBy(F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit("null")).alias("key")).agg(
        F.count(F.lit(1)).alias("n"))
    total = turns.count()
    # those above 1 / share of all rows are at most ``share`` keys: a proven bound for the broadcast
    long_keys = written(counts.where((F.col("n") > long_rows) & (F.col("n") * share > total)).select("key"), "long-keys")
    if long_keys.isEmpty():
        return rows, None
    keyed = rows.withColumn("key", key)
    return (keyed.join(F.broadcast(long_keys), "key", "left_anti").drop("key"),
            keyed.join(F.broadcast(long_keys), "key", "left_semi"))


def _short_edits(rows: DataFrame, costs: Costs, schema: str) -> DataFrame:
    kind = _arrow(schema)

    def run(batches):
        yield from _batches(_streamed(_tuples(batches), costs), COLUMNS, kind)

    dealt = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "text")
    return map_batches(dealt, run, schema)


def _edits(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, costs: Costs, long_rows: int,
           share: int) -> tuple[DataFrame, DataFrame | None]:
    short, long = _split(turns, conv_col, turn_col, role_col, text_col, long_rows, share)
    kinds = dict(short.dtypes)
    schema = _schema(kinds["conv_id"], kinds["turn"])
    return _short_edits(short, costs, schema), None if long is None else _long_edits(long, costs, long_rows, schema)


def repair_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", costs: Costs = Costs(), long_rows: int = LONG_ROWS,
                 share: int = LONG_SHARE) -> DataFrame:
    """The repaired conversations with their edits, one row a turn: conv_id, pos (of the row, from 0), place (order at a
    position), turn, edit (K, R, D or I), old_role, role (null if deleted), text, fault (blank, duplicate, truncated or null).

    Rows without edit D, by (pos, place), are the repaired conversation."""
    short, long = _edits(turns, conv_col, turn_col, role_col, text_col, costs, long_rows, share)
    return short if long is None else short.unionByName(long)


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _reported(rows: Iterator[tuple], costs: Costs) -> Iterator[tuple]:
    """One report per conversation of edit rows in order; only counters, the digest and the audit string are held."""
    conv, open_ = None, False
    for key, _, _, turn, edit, old_role, role, text, fault in rows:
        if not open_ or key != conv:
            if open_:
                yield result()
            conv, open_ = key, True
            counts, audit, digest = dict.fromkeys(FAULTS, 0), [], hashlib.sha256()
            least = most = None
            turns, illegal, cost, last, turns_out = 0, 0, 0, None, 0

            def result():
                gaps = 0 if least is None else most - least + 1 - turns
                return (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, "".join(audit),
                        digest.hexdigest())
        audit.append(edit)
        cost += costs.insert * (edit == "I") + costs.delete * (edit == "D") + costs.rerole * (edit == "R")
        if edit != "I":
            if fault:
                counts[fault] += 1
            cost += costs.truncated * (fault == "truncated" and edit != "D")
            if last is not None and last + old_role[:1] not in LEGAL_PAIRS:
                illegal += 1
            last = old_role[:1]
            if turn is not None and turn != most:  # in order: an equal number was just before
                turns += 1
                least, most = turn if least is None else least, turn
        if edit != "D":
            digest.update((("\n" if turns_out else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            turns_out += 1
    if open_:
        yield result()


def conversation_report(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", costs: Costs = Costs(), long_rows: int = LONG_ROWS,
                        share: int = LONG_SHARE) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The edit rows come in order from the repair; those of long conversations are sorted again.  A
    SHA-256 has no parallel form, so a conversation's digest is one stream, of bounded memory."""
    short, long = _edits(turns, conv_col, turn_col, role_col, text_col, costs, long_rows, share)
    conv = dict(short.dtypes)["conv_id"]
    schema = (f"conv_id {conv}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
              "audit string, repaired_sha256 string")
    kind = _arrow(schema)

    def run(batches):
        yield from _batches(_reported(_tuples(batches), costs), REPORT, kind)

    out = map_batches(short, run, schema)
    if long is not None:
        out = out.unionByName(map_batches(long.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "place"), run, schema))
    return out
