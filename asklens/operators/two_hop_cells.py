"""Two-hop path counts and best candidates where the paths are made, without a shuffle of the paths.

Users are dealt into groups and candidates into blocks, by hashes.  Cell (group, block) gets all first hops of its users and all
second hops into its candidates, so every path of a (user, candidate) pair is in one cell and its count is final there.
What is shuffled is ``first hops x blocks + second hops x groups``, many times less than the paths.

A task holds the second hops of its block (about ``block_edges``) as sorted arrays; the first hops stream by in user order,
``CHUNK_PATHS`` paths at a time, so its memory grows neither with its users nor with a user's paths.

Rows of all pairs leave a chunk by candidate and count: equal values lie together, so files of them need about half the bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.session import default_parallelism

BLOCK_EDGES = 3_000_000
CHUNK_PATHS = 500_000  # arrays of a few MB, which the allocator reuses
CHUNK_ROWS = 2_000_000  # paths of a chunk whose rows are all given out: the more, the longer the runs of a candidate
CELL_PATHS = 2_000_000    # paths from which one more task is worth starting
OUT_ROWS = 1 << 16


def count_in_cells(e1: DataFrame, e2: DataFrame, n1: float, n2: float, paths: float, block_edges: int = BLOCK_EDGES,
                   per_user: bool = False) -> DataFrame:
    """(id, sn_id, sn_rank, count) from first hops (a, b, m1) and second hops (b, c, m2, rank_c), ``n1`` and ``n2`` rows.

    With ``per_user`` a cell's rows of a user are reduced to what ``per_user_parts`` makes of them before they leave the task."""
    cells = _cells(e1, e2, n1, n2, paths, block_edges)
    if per_user:
        return cells.mapInArrow(_reduce_cell, PARTS)
    return cells.mapInArrow(_count_cell, "id bigint, sn_id bigint, sn_rank double, count bigint")


def _cells(e1: DataFrame, e2: DataFrame, n1: float, n2: float, paths: float, block_edges: int) -> DataFrame:
    """(a, b, c, m, rank, ...): in a partition a cell's second hops, without an a, and then its first hops in user order.

    Further columns of ``e2`` are kept."""
    blocks = max(1, math.ceil(n2 / block_edges))
    tasks = min(2 * default_parallelism(e1.sparkSession), math.ceil(paths / CELL_PATHS))
    groups = max(1, math.ceil(n1 / block_edges), math.ceil(tasks / blocks))
    more = [x for x in e2.schema.fields if x.name not in ("b", "c", "m2", "rank_c")]

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    no_id, no_rank = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    first = (e1.select("a", "b", "m1", every(blocks).alias("k"))
             .select((F.pmod(F.xxhash64("a"), F.lit(groups)) * blocks + F.col("k")).cast("int").alias("cell"),
                     "a", "b", no_id.alias("c"), F.col("m1").alias("m"), no_rank.alias("rank"),
                     *[F.lit(None).cast(x.dataType).alias(x.name) for x in more]))
    second = (e2.select("b", "c", "m2", "rank_c", *[x.name for x in more], every(groups).alias("k"))
              .select((F.col("k") * blocks + F.pmod(F.xxhash64("c"), F.lit(blocks))).cast("int").alias("cell"),
                      no_id.alias("a"), "b", "c", F.col("m2").alias("m"), F.col("rank_c").alias("rank"), *[x.name for x in more]))
    return (second.unionByName(first).repartitionById(groups * blocks, "cell").drop("cell")
            .sortWithinPartitions(F.col("a").asc_nulls_first()))  # the second hops come first, then user by user


def _reduce_cell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _count_cell(batches, True)


def _count_cell(batches: Iterable[pa.RecordBatch], per_user: bool = False) -> Iterator[pa.RecordBatch]:
    return _run_cell(batches, lambda second: _Cell(second, CHUNK_PATHS if per_user else CHUNK_ROWS, per_user))


def _run_cell(batches: Iterable[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    """``make``: of the table of second hops, what takes the first hops by ``add`` and ends by ``flush``."""
    second, cell = [], None
    for batch in batches:
        n = batch.column("a").null_count
        if n:
            second.append(batch.slice(0, n))
        if n < batch.num_rows and (second or cell):
            if cell is None:
                cell, second = make(pa.Table.from_batches(second)), []
            yield from cell.add(batch.slice(n))
    if cell is not None:
        yield from cell.flush(True)


def _starts(key: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def _by_candidate(user: np.ndarray, code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows by candidate, count and user."""
    if not len(user):
        return user, code, counts
    u, n = int(user.max()).bit_length(), int(counts.max()).bit_length()
    if int(code.max()).bit_length() + n + u < 63:  # sorted as one number, which is faster than a lexsort
        key = (((code << n) | counts) << u) | user
        key.sort()
        return key & ((1 << u) - 1), key >> (n + u), (key >> u) & ((1 << n) - 1)
    order = np.lexsort((user, counts, code))
    return user[order], code[order], counts[order]


def grouped(key: np.ndarray, paths: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, each once, and the sum of its paths (None: one each)."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    if paths is None:
        key.sort()
        starts = _starts(key)
        return key[starts], np.diff(np.append(starts, len(key)))
    width = int(paths.max()).bit_length()
    if int(key.max()).bit_length() + width < 63:  # sorted as one number, which is faster than an argsort
        both = (key << width) | paths
        both.sort()
        key, paths = both >> width, both & ((1 << width) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, paths = key[order], paths[order]
    starts = _starts(key)
    return key[starts], np.add.reduceat(paths, starts)


class _Cell:
    """The second hops of a block, by middle vertex; ``add`` takes first hops in user order."""

    def __init__(self, second: pa.Table, chunk: int, per_user: bool = False):
        self.chunk, self.per_user = chunk, per_user
        b, c, m = (second[x].to_numpy() for x in ("b", "c", "m"))
        rank = second["rank"].combine_chunks()
        known = rank.is_valid().to_numpy(zero_copy_only=False)
        value = rank.fill_null(0.0).to_numpy(zero_copy_only=False)
        order = np.lexsort((value, known, c))
        new = np.zeros(len(c), bool)
        new[0] = True
        for x in (c, known, value.view(np.int64)):
            y = x[order]
            new[1:] |= y[1:] != y[:-1]
        code = np.empty(len(c), np.int64)
        code[order] = np.cumsum(new) - 1
        at = order[new]
        self.ids, self.values, self.ranks = c[at], value[at], pa.array(value[at], mask=~known[at])
        self.bits = len(at).bit_length()
        by = np.argsort(b, kind="stable")
        self.code, self.m = code[by], m[by]
        self.b, self.start = np.unique(b[by], return_index=True)
        self.degree = np.diff(np.append(self.start, len(b)))
        self.plain = bool((self.m == 1).all())
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0
        self.user, self.counts = None, None  # a user with more paths than a chunk, and its counts so far

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b, m = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("a", "b", "m"))
        at = np.minimum(np.searchsorted(self.b, b), len(self.b) - 1)
        hit = self.b[at] == b
        a, at, m = a[hit], at[hit], m[hit]
        paths = np.cumsum(self.degree[at])
        i, done = 0, 0
        while i < len(a):  # one first hop may have more paths than a chunk, a batch of them many more
            j = max(i + 1, int(np.searchsorted(paths, done + self.chunk, "right")))
            self.held.append((a[i:j], at[i:j], m[i:j]))
            self.n_held += int(paths[j - 1]) - done
            i, done = j, int(paths[j - 1])
            if self.n_held >= self.chunk:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Gives out the users that are complete: all but the latest one, with ``last`` that too."""
        rows = tuple(np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 3
        self.held, self.n_held = [], 0
        if self.user is not None:
            n = int(np.searchsorted(rows[0], self.user, "right"))
            self._collect(*(x[:n] for x in rows))
            rows = tuple(x[n:] for x in rows)
            if last or len(rows[0]):
                code = np.flatnonzero(self.counts)
                yield from self._out(np.full(len(code), self.user), code, self.counts[code])
                self.user, self.counts = None, None
        if not len(rows[0]):
            return
        cut = len(rows[0]) if last else int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if cut:
            a, at, m = (x[:cut] for x in rows)
            starts = _starts(a)
            key, counts = self._grouped(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, cut))), at, m)
            user, code = key >> self.bits, key & ((1 << self.bits) - 1)
            if not self.per_user:
                user, code, counts = _by_candidate(user, code, counts)
            yield from self._out(a[starts][user], code, counts)
        rest = tuple(x[cut:] for x in rows)
        if len(rest[0]):
            paths = int(self.degree[rest[1]].sum())
            if paths >= self.chunk:
                self.user, self.counts = rest[0][0], np.zeros(len(self.ids), np.int64)
                self._collect(*rest)
            else:
                self.held, self.n_held = [rest], paths

    def _collect(self, a: np.ndarray, at: np.ndarray, m: np.ndarray) -> None:
        if len(a):
            code, counts = self._grouped(np.zeros(len(a), np.int64), at, m)
            self.counts[code] += counts

    def _grouped(self, user: np.ndarray, at: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, paths), the key being the user's number above the candidate's code."""
        degree = self.degree[at]
        ends = np.cumsum(degree)
        total = int(ends[-1])
        edge = np.arange(total) + np.repeat(self.start[at] - (ends - degree), degree)
        return grouped((np.repeat(user, degree) << self.bits) | self.code[edge],
                       None if self.plain and bool((m == 1).all()) else self.m[edge] * np.repeat(m, degree))

    def _out(self, user: np.ndarray, code: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.per_user:
            if len(code):
                yield _reduced(user, self.ids[code], self.values[code] * counts, counts)
            return
        for i in range(0, len(code), OUT_ROWS):
            some = code[i:i + OUT_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(user[i:i + OUT_ROWS]), pa.array(self.ids[some]), self.ranks.take(pa.array(some)), pa.array(counts[i:i + OUT_ROWS])],
                names=["id", "sn_id", "sn_rank", "count"])


PARTS = "id bigint, candidates bigint, paths bigint, weight double, w double, minus_id bigint"


def per_user_parts(two_hop: DataFrame) -> DataFrame:
    """(id, candidates, paths, weight, w, minus_id) of a user's rows in a batch: how many, their paths and weights in all, the
    largest weight, cut by ``steady``, and minus the smallest candidate that has it."""
    count = F.col("count") if "count" in two_hop.columns else F.lit(1)
    rows = two_hop.select(F.col("id").cast("bigint"), F.col("sn_id").cast("bigint"), F.col("weight").cast("double"),
                          count.cast("bigint").alias("count"))
    return rows.mapInArrow(_reduce_batches, PARTS)


def best_candidates(two_hop: DataFrame) -> DataFrame:
    """Per user (id): candidates, paths, weight (sums) and top, a struct of the largest weight, compared by ``steady``, and
    minus the smallest candidate that has it.  ``two_hop``: candidates, or their parts per user.

    A batch's rows of a user become one where they are made, so the aggregate, which must sort for a struct, gets few."""
    parts = two_hop if "minus_id" in two_hop.columns else per_user_parts(two_hop)
    return parts.groupBy("id").agg(F.sum("candidates").alias("candidates"), F.sum("paths").alias("paths"), F.sum("weight").alias("weight"),
                                   F.max(F.struct("w", "minus_id")).alias("top"))


def _reduce_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = tuple(batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "sn_id", "weight", "count"))
        if (rows[0][1:] < rows[0][:-1]).any():
            order = np.argsort(rows[0], kind="stable")
            rows = tuple(x[order] for x in rows)
        yield _reduced(*rows)


def _reduced(user: np.ndarray, sn: np.ndarray, weight: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """One row per user of rows in user order."""
    starts = _starts(user)
    sizes = np.diff(np.append(starts, len(user)))
    far = weight * 8193.0  # ``steady`` of graph.py
    w = far - (far - weight)
    most = np.maximum.reduceat(w, starts)
    best = np.minimum.reduceat(np.where(w == np.repeat(most, sizes), sn, np.iinfo(np.int64).max), starts)
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (user[starts], sizes, np.add.reduceat(count, starts), np.add.reduceat(weight, starts), most, -best)],
        names=["id", "candidates", "paths", "weight", "w", "minus_id"])
