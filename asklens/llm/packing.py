"""Sum-of-squares online packing of tokenised documents into windows.

Every task tokenises its documents and packs them as they come.  A document's whole windows are full sequences of
their own; what is left over, 1 to ``window`` - 1 tokens, goes to the fill level that minimises the sum, over all levels,
of the squared number of partially filled windows at that level.  The counts live in a level array, so a placement
costs one pass over ``window`` numbers, however many windows are open.

At the end of a task its open windows are closed: the emptiest are cut up to fill the fullest, so one window at most
stays partially filled, and that one is cut into sequences whose lengths are powers of two (which take no padding).

A window is written out as soon as it is full; a task holds its open windows only.  If they ever hold more than
``max_open_tokens`` tokens (32 MB of ids by default), they are closed as at the end: a bound of memory that costs at most one
partially filled window each time, and loses nothing.  Sequence numbers become gapless by adding the number of sequences
of the tasks before.

Defined cases: a null or empty text is the end id alone; repeated rows and null ids are documents of their own; extra
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import map_batches, running_offsets, written
from asklens.llm.tokens import ChunkEncoder

WINDOW = 1024
END_ID = 0
MAX_OPEN_TOKENS = 8_000_000
ROWS_OUT = 4096

#: (document, start, ids as bytes) in order, in one sequence
Piece = tuple[int, int, bytes]


class SumOfSquares:
    """The level array, and the open windows behind it."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)  # open windows at each fill level; both ends stay 0
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.tokens = 0

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece of less than ``window`` ids into a window; that window's pieces, if it is full now."""
        size = len(piece[2]) // 4
        # (n + 1)^2 - n^2 at the level it reaches, (n - 1)^2 - n^2 at the level it leaves; an empty or full window counts nothing
        cost = 2 * self.count[size:] + 1
        cost[-1] = 0
        cost[1:] += 1 - 2 * self.count[1:self.window - size + 1]
        cost[1:][self.count[1:self.window - size + 1] == 0] = np.iinfo(np.int64).max
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))  # of equal ones the fullest
        pieces = self.open[level].pop() if level else []
        pieces.append(piece)
        self.count[level] -= level > 0
        self.tokens += size
        if level + size == self.window:
            self.tokens -= self.window
            return pieces
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """All open windows as sequences: full ones by cutting up the emptiest, and the rest at powers of two."""
        left = [(level, pieces) for level in range(self.window, 0, -1) for pieces in self.open[level]]
        self.__init__(self.window)
        loose: list[Piece] = []  # of the emptiest windows, cut up so far
        at, end = 0, len(left)
        while at < end:
            level, pieces = left[at]
            at += 1
            gap = self.window - level
            while gap:
                if not loose:
                    if at == end:
                        break
                    end -= 1
                    loose = list(left[end][1])
                doc, start, ids = loose.pop()
                take = min(gap, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * take]))
                if 4 * take < len(ids):
                    loose.append((doc, start + take, ids[4 * take:]))
                gap -= take
            if not gap:
                yield pieces
            else:
                loose = pieces
        rest = sum(len(p[2]) // 4 for p in loose)
        loose.reverse()
        while rest:  # 700 = 512 + 128 + 32 + 16 + 8 + 4
            want = min(self.window, 1 << (rest.bit_length() - 1))
            rest -= want
            pieces = []
            while want:
                doc, start, ids = loose.pop()
                take = min(want, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * take]))
                if 4 * take < len(ids):
                    loose.append((doc, start + take, ids[4 * take:]))
                want -= take
            yield pieces


def pack_task(docs: Iterator[tuple[int, bytes]], window: int, max_open_tokens: int = MAX_OPEN_TOKENS) -> Iterator[list[Piece]]:
    """Sequences of pieces for (document, ids as bytes)."""
    levels = SumOfSquares(window)
    wide = 4 * window
    for doc, ids in docs:
        whole = len(ids) // wide * wide
        for at in range(0, whole, wide):
            yield [(doc, at // 4, ids[at:at + wide])]
        if whole < len(ids) and (full := levels.place((doc, whole // 4, ids[whole:]))):
            yield full
        if levels.tokens > max_open_tokens:
            yield from levels.close()
    yield from levels.close()


SCHEMA = "part int, sequence bigint, doc_id bigint, start bigint, length bigint, offset bigint, doc_tokens bigint, ids binary"


def _runner(tokenizer: str, end_id: int, window: int, max_open_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = ChunkEncoder.get(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        about: dict[int, list] = {}  # of documents with pieces not written yet: id, tokens, tokens written

        def documents() -> Iterator[tuple[int, bytes]]:
            n = 0
            for b in batches:
                for doc, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_column(b.column("text"))):
                    ids += end
                    about[n] = [doc, len(ids) // 4, 0]
                    yield n, ids
                    n += 1

        rows: list[tuple] = []
        for number, pieces in enumerate(pack_task(documents(), window, max_open_tokens)):
            offset = 0
            for doc, start, ids in pieces:
                known = about[doc]
                size = len(ids) // 4
                rows.append((part, number, known[0], start, size, offset, known[1], ids))
                offset += size
                known[2] += size
                if known[2] == known[1]:
                    del about[doc]
            if len(rows) >= ROWS_OUT:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
    names = ["part", "sequence", "doc_id", "start", "length", "offset", "doc_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", max_open_tokens: int = MAX_OPEN_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, sequence_id, offset, doc_tokens, ids (little-endian unsigned 32-bit)."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(map_batches(slim, _runner(tokenizer, end_id, window, max_open_tokens), SCHEMA), "pieces")
    counts = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("sequences"))
    before = running_offsets(counts, "part", "sequences")
    return (pieces.join(F.broadcast(before), "part")  # one row per task
            .select("doc_id", "start", "length", (F.col("sequence") + F.col("before")).alias("sequence_id"), "offset",
                    "doc_tokens", "ids"))
