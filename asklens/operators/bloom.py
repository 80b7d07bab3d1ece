"""A Bloom filter of one table's keys, to thin another table before an exact join shuffles it.

Spark puts such filters under inner and semi joins when its estimates allow; it has none for the right side of an anti-join
(a ledger that only grows) and none across several joins.  Bits are set by an aggregate with map-side
combine, one row a word, so the driver gets ``bits / 64`` rows at most whatever the number of keys.  A filter that is too
full to help says so and keeps all rows: results never depend on it, as an exact join follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27      # 16 MB; three keys in a hundred pass wrongly at 18 million keys
PROBES = 4
FULL = 0.9          # share of set bits from which a filter is not worth asking


def _positions(key: Column, bits: int) -> list[Column]:
    """PROBES bit positions of a key by double hashing of its two 32-bit halves."""
    h = F.xxhash64(key)
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return [((low + F.lit(i) * high + F.lit(i * i)) % F.lit(bits)) for i in range(PROBES)]


class KeyFilter:
    """Whether a key may be among those the filter was made from; a key that is, always may."""

    def __init__(self, keys: DataFrame, key: str, bits: int = BITS):
        if bits < 64 or bits & (bits - 1):
            raise ValueError("bits must be a power of two, 64 at least")
        self.bits = bits
        place = keys.select(F.explode(F.array(*_positions(F.col(key), bits))).alias("p"))
        words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("b")).toArrow()
        self.words = np.zeros(bits // 64, np.int64)
        self.words[words["w"].to_numpy()] = words["b"].to_numpy()
        self.sent = keys.sparkSession.sparkContext.broadcast(self.words)
        self.fill = int(np.bitwise_count(self.words.view(np.uint64)).sum()) / bits

    def keep(self, df: DataFrame, *keys: str, every: bool = False) -> DataFrame:
        """The rows of which any of ``keys`` (``every``: each of them) may be in the filter; all rows when the filter is full."""
        if self.fill >= FULL:
            return df
        sent = self.sent

        @F.pandas_udf("boolean")
        def may(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            words = sent.value
            for batch in batches:
                at = np.stack([p.to_numpy(np.int64) for p in batch])
                hit = ((words[at >> 6] >> (at & 63)) & 1 == 1).reshape(-1, PROBES, at.shape[1]).all(axis=1)
                yield pd.Series(hit.all(axis=0) if every else hit.any(axis=0))

        return df.where(may(*[p for k in keys for p in _positions(F.col(k), self.bits)]))
