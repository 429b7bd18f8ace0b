"""A bounded set of numbers that tasks can hold: it may say yes wrongly, never no."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


class Membership:
    """Bits of the numbers modulo ``bits``: 8 MB by default, however many numbers there are.

    Put before an exact join, it keeps rows that cannot match out of the shuffle. When the
    numbers outgrow it, more rows reach the join, and the result stays the same.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, df: DataFrame, number: Column, bits: int = BITS) -> Membership:
        slot = F.pmod(number, F.lit(bits))
        filled = (
            df.select(slot.alias("s"))
            .where("s IS NOT NULL")
            .groupBy(F.floor(F.col("s") / 64).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 AS int))")).alias("b"))
            .toArrow()  # bits / 64 rows at most
        )
        words = np.zeros(bits // 64, np.int64)
        words[filled.column("w").to_numpy()] = filled.column("b").to_numpy()
        return cls(words.view(np.uint64))

    def may_hold(self, numbers: np.ndarray) -> np.ndarray:
        slot = numbers.view(np.int64) % np.int64(len(self.words) * 64)
        return (self.words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
