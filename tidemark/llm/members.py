"""A filter that spares most rows a join, sized by the number of its members."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Bits for each member, so that about one row in eight or fewer that is none passes, and the least and the most in all
#: (64 MB). Beyond that wrong hits grow with the number of members; they only cost time.
EACH, LEAST, MOST = 8, 1 << 20, 1 << 29


def bits_for(n: int) -> int:
    bits = LEAST
    while bits < min(MOST, EACH * n):
        bits *= 2
    return bits


def likely_members(members: DataFrame, column: str, bits: int | None = None) -> Callable[[Column], Column]:
    """A test that is true for every value of ``column`` (long) and false for most others; NULL gives false.

    ``members`` is read twice, the first time to count it where ``bits`` aren't given.
    """
    bits = bits or bits_for(members.count())

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits)) + 1  # bitmaps count from 1

    at = members.select(place(F.col(column)).alias("p"))
    rows = at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    table = np.zeros((bits // 32_768, 4096), np.uint8)
    for r in rows.toLocalIterator():
        table[r["bucket"] - 1] = np.frombuffer(r["bits"], np.uint8)
    flags = table.ravel()

    @F.pandas_udf("boolean")
    def test(p: pd.Series) -> pd.Series:
        i = p.to_numpy(np.int64) - 1
        return pd.Series((flags[i >> 3] >> (i & 7) & 1).astype(bool))

    return lambda c: test(place(c)) & c.isNotNull()
