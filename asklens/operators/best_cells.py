"""The best two-hop candidate of every user in cells, by tiers inside the cell.

A cell (``two_hop_cells``) holds all paths of its users into its candidates, so the search by tiers of
``best_two_hop`` needs no more than the cell: the tiers are visited in the task that has the second hops, a chunk of users
at a time, and a user that is done in this cell is expanded no further there.  The best of a user's cells is its best of all.
So first hops are shuffled once, not once a tier, and no state is kept between the tiers.

The bounds are those of ``best_two_hop``, over the candidates of the cell.  Memory is that of a cell of ``two_hop_cells``: the
second hops of a block, a chunk of paths, and the first hops (not the paths) of one user.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from asklens.operators.two_hop_cells import BLOCK_EDGES, CHUNK_PATHS, _cells, _run_cell, _starts, grouped

MARGIN = 1e-9
NO_ID = np.iinfo(np.int64).max


def best_in_cells(e1: DataFrame, e2: DataFrame, n1: float, n2: float, paths: float, tiers: int,
                  block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(id, w, minus_id, last, p0, p1, ...) of users in a cell, from first hops (a, b, m1) and second hops
    (b, c, m2, rank_c, tier): the largest weight, cut by ``steady``, minus the smallest candidate that has it, the tier that the user
    was done in, and the paths expanded in each tier."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _run_cell(batches, lambda second: TierCell(second, tiers))

    return _cells(e1, e2, n1, n2, paths, block_edges).mapInArrow(run, found_schema(tiers))


def found_schema(tiers: int) -> str:
    return "id bigint, w double, minus_id bigint, last int" + "".join(f", p{t} bigint" for t in range(tiers))


class TierCell:
    """The second hops of a block, by middle vertex and tier; ``add`` takes first hops in user order."""

    def __init__(self, second: pa.Table, tiers: int, chunk: int = CHUNK_PATHS):
        self.tiers, self.chunk = tiers, chunk
        b, c, m, rank, tier = (second[x].to_numpy() for x in ("b", "c", "m", "rank", "tier"))
        self.ids, at, code = np.unique(c, return_index=True, return_inverse=True)
        self.values, tier_of = rank[at], tier[at].astype(np.int64)
        by = np.argsort(code, kind="stable")
        starts = _starts(code[by])
        potential, most = self.values * np.add.reduceat(m[by], starts), np.maximum.reduceat(m[by], starts)
        self.left = []  # of the tiers after each: the largest potential, rank and most parallel edges
        for t in range(tiers):
            more = tier_of > t
            self.left.append((potential[more].max(), self.values[more].max(), most[more].max()) if more.any() else None)
        self.bits = len(self.ids).bit_length()
        self.b, middle = np.unique(b, return_inverse=True)
        slot = middle * tiers + tier_of[code]
        by = np.argsort(slot, kind="stable")
        self.code, self.m = code[by], m[by]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=len(self.b) * tiers))])
        self.degree = self.start[tiers::tiers] - self.start[:-1:tiers]  # over all tiers
        self.out_m = np.add.reduceat(self.m, self.start[:-1:tiers])
        self.plain = bool((self.m == 1).all())
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b, m = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("a", "b", "m"))
        at = np.minimum(np.searchsorted(self.b, b), len(self.b) - 1)
        hit = self.b[at] == b
        if hit.any():
            self.held.append((a[hit], at[hit], m[hit]))
            self.n_held += int(self.degree[self.held[-1][1]].sum())
            if self.n_held >= self.chunk and self.held[0][0][0] != self.held[-1][0][-1]:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Gives out the users that are complete: all but the latest one, with ``last`` that too."""
        if not self.held:
            return
        a, at, m = (np.concatenate(x) for x in zip(*self.held))
        starts = np.append(_starts(a), len(a))
        users = len(starts) - 1 if last else len(starts) - 2
        paths = np.add.reduceat(self.degree[at], starts[:-1]).cumsum()
        i, done = 0, 0
        while i < users:  # users of a chunk of paths, or one with more
            j = min(users, max(i + 1, int(np.searchsorted(paths, done + self.chunk, "right"))))
            some = slice(starts[i], starts[j])
            yield self._best(a[some], at[some], m[some])
            i, done = j, int(paths[j - 1])
        rest = slice(starts[users], len(a))
        self.held, self.n_held = ([], 0) if last else ([(a[rest], at[rest], m[rest])], int(self.degree[at[rest]].sum()))

    def _best(self, a: np.ndarray, at: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        starts = _starts(a)
        n = len(starts)
        user = np.repeat(np.arange(n), np.diff(np.append(starts, len(a))))
        paths, follows = np.add.reduceat(m * self.out_m[at], starts), np.add.reduceat(m, starts)
        parallel = np.maximum.reduceat(m, starts)
        best, best_id = np.full(n, -np.inf), np.full(n, NO_ID)
        expanded, last, open_ = np.zeros((self.tiers, n), np.int64), np.zeros(n, np.int32), np.ones(n, bool)
        for t in range(self.tiers):
            rows = slice(None) if open_.all() else open_[user]
            u, code, counts = self._expand(user[rows], at[rows], m[rows], t)
            if len(u):
                weight = self.values[code] * counts
                far = weight * 8193.0  # ``steady`` of graph.py
                w = far - (far - weight)
                at_u = _starts(u)
                who, sizes = u[at_u], np.diff(np.append(at_u, len(u)))
                expanded[t, who] = np.add.reduceat(counts, at_u)
                top = np.maximum.reduceat(w, at_u)
                top_id = np.minimum.reduceat(np.where(w == np.repeat(top, sizes), self.ids[code], NO_ID), at_u)
                best_id[who] = np.where(top > best[who], top_id, np.where(top == best[who], np.minimum(top_id, best_id[who]), best_id[who]))
                best[who] = np.maximum(top, best[who])
            last[open_] = t
            if self.left[t] is None:
                break
            potential, rank, most = self.left[t]
            unseen = paths - expanded.sum(axis=0)
            bound = np.minimum(np.minimum(parallel * potential, rank * follows * most), rank * unseen)
            open_ &= ~((unseen == 0) | (best > bound * (1 + MARGIN)))
            if not open_.any():
                break
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[starts], best, -best_id, last, *expanded)],
                                          names=["id", "w", "minus_id", "last", *[f"p{t}" for t in range(self.tiers)]])

    def _expand(self, user: np.ndarray, at: np.ndarray, m: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(user, candidate's code, paths) of the paths into a tier, by user and code."""
        start = self.start[at * self.tiers + t]
        degree = self.start[at * self.tiers + t + 1] - start
        some = degree > 0
        user, m, start, degree = user[some], m[some], start[some], degree[some]
        ends = np.cumsum(degree)
        if not len(ends) or ends[-1] <= self.chunk or user[0] != user[-1]:
            key, counts = self._grouped(user, m, start, degree)
            return key >> self.bits, key & ((1 << self.bits) - 1), counts
        total = np.zeros(len(self.ids), np.int64)  # one user with more paths than a chunk
        i, done = 0, 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, done + self.chunk, "right")))
            code, counts = self._grouped(np.zeros(j - i, np.int64), m[i:j], start[i:j], degree[i:j])
            total[code] += counts
            i, done = j, int(ends[j - 1])
        code = np.flatnonzero(total)
        return np.full(len(code), user[0]), code, total[code]

    def _grouped(self, user: np.ndarray, m: np.ndarray, start: np.ndarray, degree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(degree)
        edge = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - degree), degree)
        return grouped((np.repeat(user, degree) << self.bits) | self.code[edge],
                       None if self.plain and bool((m == 1).all()) else self.m[edge] * np.repeat(m, degree))
