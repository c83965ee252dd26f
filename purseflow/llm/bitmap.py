"""A bit map of 64-bit keys with a bounded size, to leave out rows that can't find a partner.

Its size is fixed, or follows the number of keys up to a limit (``bits_for``), so broadcasting it
is safe at any scale. It has false positives, never false negatives: an exact join always follows.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped

BITS = 26  # 8 MB
MOST_BITS = 30  # 128 MB
KEY_BITS = 8  # two of them are set: at most a quarter of the map, which lets one in 16 other keys pass


def bits_for(n: int) -> int:
    """The size of a map that ``n`` keys don't fill, from ``BITS`` to ``MOST_BITS``."""
    return min(max(BITS, (KEY_BITS * n - 1).bit_length()), MOST_BITS)


def bit_map(keys: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """Broadcast the bit map of a long column (hash it first if it isn't a hash)."""
    both = F.array(*[F.shiftrightunsigned(F.col(column), s).bitwiseAND((1 << bits) - 1) for s in (0, 64 - bits)])
    with shuffles_dropped(keys.sparkSession):
        cells = (
            keys.select(F.explode(both).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("cell"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
        )
        found = cells.toArrow()  # at most 2^(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("cell").to_numpy()] = found.column("mask").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out.view(np.uint64))


def marked(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the map."""
    bits = len(cells).bit_length() - 1 + 6
    low = keys & np.uint64((1 << bits) - 1)
    out = (cells[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) == 1
    some = np.flatnonzero(out)
    high = keys[some] >> np.uint64(64 - bits)
    out[some] = (cells[high >> np.uint64(6)] >> (high & np.uint64(63))) & np.uint64(1) == 1
    return out
