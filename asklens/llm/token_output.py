"""Token ids as binary files with Elias-Fano document boundaries.

Documents are range-sorted by id over all tasks.  Each task writes segments: the ids of consecutive documents as one
array of little-endian unsigned integers (16 bits if the vocabulary allows), and the documents' boundaries in it as an
Elias-Fano sequence: the low bits packed, the high bits in unary as a bit vector, and the place of every
``SAMPLE``-th one bit.  A boundary costs about 2 + log2(tokens / documents) bits instead of 64, and ``select`` finds
any of them by a sample and a scan of less than ``SAMPLE`` ones.  The documents' own ids, ascending, are a second such
sequence, counted from the first one; null ids come last, so their number is enough.  The full read takes ``READ_DOCS``
documents at a time from both, by ``select`` through the samples.

The files are Parquet with a row a segment (Spark writes and reads them wherever the shared folder is):
part, segment, docs, tokens, inside (tokens of the part's segments before it), width, ids, low_bits, low, high, samples, known_ids, first_id, id_low_bits, id_low, id_high,
id_samples.  A segment ends when it has
``SEGMENT_TOKENS`` tokens, so a row is bounded by that or by one document.

Defined cases: a null or empty text is the end id alone; null ids come last; repeated ids follow each other (by
text); extra columns are not looked at; an empty table gives no segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import map_batches, running_offsets
from asklens.llm.tokens import ChunkEncoder

END_ID = 2
SEGMENT_TOKENS = 1 << 18
SAMPLE = 64
READ_DOCS = 1024

SCHEMA = ("part int, segment int, docs int, tokens bigint, inside bigint, width int, ids binary, low_bits int, low binary, "
          "high binary, samples binary, known_ids int, first_id bigint, id_low_bits int, id_low binary, id_high binary, "
          "id_samples binary")


class EliasFano:
    """A non-decreasing sequence of numbers below ``limit`` (1 to 2^64), in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, dtype=np.uint8)
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.samples = np.frombuffer(samples, dtype="<u4")

    @classmethod
    def encode(cls, values: np.ndarray, limit: int) -> "EliasFano":
        n = len(values)
        low_bits = max(0, (limit // max(1, n)).bit_length() - 1)
        values = values.astype("<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :low_bits]
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits.ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The place of the ``i``-th one bit (from 0) of the high part."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, skip = divmod(place, 8)
        word = int(self.high[byte]) >> skip << skip  # the sample's own bit is the first one
        while True:
            here = word.bit_count()
            if left < here:
                for _ in range(left):
                    word &= word - 1
                return 8 * byte + (word & -word).bit_length() - 1
            left -= here
            byte += 1
            word = int(self.high[byte])

    def __getitem__(self, i: int) -> int:
        at = i * self.low_bits
        first, last = at // 8, (at + self.low_bits + 7) // 8
        low = int.from_bytes(self.low[first:last].tobytes(), "little") >> (at % 8) & ((1 << self.low_bits) - 1)
        return (self.select(i) - i) << self.low_bits | low

    def some(self, first: int, stop: int) -> np.ndarray:
        """The values from ``first`` up to ``stop``, as 64 bits each: ``select`` for all of them, from the sample before to the one after."""
        n, bits = stop - first, self.low_bits
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        place, after = int(self.samples[first // SAMPLE]), -(-stop // SAMPLE)
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[place // 8:end], bitorder="little")[place % 8:]) + place
        ones = ones[first % SAMPLE:first % SAMPLE + n]
        at = first * bits
        packed = np.unpackbits(self.low[at // 8:(stop * bits + 7) // 8], bitorder="little")[at % 8:at % 8 + n * bits]
        wide = np.zeros((n, 64), dtype=np.uint8)
        wide[:, :bits] = packed.reshape(n, bits)
        low = np.packbits(wide, axis=1, bitorder="little").view("<i8").ravel()
        return ((ones - np.arange(first, stop)) << bits) | low

    def all(self) -> np.ndarray:
        """Every value at once, from the same bits."""
        return self.some(0, self.n)


def _segment(part: int, number: int, inside: int, doc_ids: list, texts: list[bytes], width: int) -> pa.RecordBatch:
    ends = np.cumsum([len(t) // 4 for t in texts])
    tokens = int(ends[-1])
    ids = np.frombuffer(b"".join(texts), dtype="<u4").astype(f"<u{width}").tobytes()
    bounds = EliasFano.encode(ends - [len(t) // 4 for t in texts], tokens + 1)
    known = np.array([d for d in doc_ids if d is not None], dtype="<i8")
    ahead = known.view("<u8") - known[:1].view("<u8")  # modulo 2^64: ids may lie further apart than 63 bits hold
    keys = EliasFano.encode(ahead, int(ahead[-1]) + 1 if len(known) else 1)
    row = (part, number, len(texts), tokens, inside, width, ids, bounds.low_bits, bounds.low.tobytes(), bounds.high.tobytes(),
           bounds.samples.tobytes(), len(known), int(known[0]) if len(known) else 0, keys.low_bits, keys.low.tobytes(),
           keys.high.tobytes(), keys.samples.tobytes())
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), *[pa.binary()] * 3,
             pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


def _writer(tokenizer: str, end_id: int, segment_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = ChunkEncoder.get(tokenizer)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        keys, texts, size, number, inside = [], [], 0, 0, 0
        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_column(b.column("text"))):
                keys.append(doc)
                texts.append(ids + end)
                size += len(texts[-1]) // 4
                if size >= segment_tokens:
                    yield _segment(part, number, inside, keys, texts, width)
                    keys, texts, size, number, inside = [], [], 0, number + 1, inside + size
        if keys:
            yield _segment(part, number, inside, keys, texts, width)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending id order under ``path``."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # only ids and a hash decide the ranges: no task has to sample texts, and repeated ids may be split
    dealt = slim.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    map_batches(dealt, _writer(tokenizer, end_id, segment_tokens), SCHEMA).write.mode("errorifexists").parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(name)[i].as_py() for name in b.schema.names}
            n, known = row["docs"], row["known_ids"]
            bounds = EliasFano(n, row["low_bits"], row["low"], row["high"], row["samples"])
            keys = EliasFano(known, row["id_low_bits"], row["id_low"], row["id_high"], row["id_samples"])
            ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}").astype("<u4")
            for at in range(0, n, READ_DOCS):
                stop = min(n, at + READ_DOCS)
                starts = bounds.some(at, min(n, stop + 1))
                if stop == n:
                    starts = np.append(starts, row["tokens"])
                doc_ids = np.zeros(stop - at, dtype=np.int64)
                here = keys.some(at, min(stop, known))
                doc_ids[:len(here)] = here + np.int64(row["first_id"])
                raw = [ids[a:e].tobytes() for a, e in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64(), mask=np.arange(at, stop) >= known), pa.array(starts[:-1] + row["before"]),
                     pa.array(np.diff(starts)), pa.array(raw, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids (32-bit little-endian)."""
    files = spark.read.schema(SCHEMA).parquet(path)
    sums = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = running_offsets(sums, "part", "tokens")  # a row a task that wrote: broadcast, so that no ids are shuffled
    placed = files.join(F.broadcast(parts), "part").withColumn("before", F.col("inside") + F.col("before"))
    return map_batches(placed, _reader, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
