"""A bitmap of hashed ids: tells most rows that a join would not match before they are shuffled."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 16
MOST_BITS = 1 << 27  # 16 MB; a fuller bitmap lets more rows pass and the join decides


class Bitmap:
    """Fixed-size set of hashed ids that may say yes too often, never no."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def hits(self, hashed: np.ndarray) -> np.ndarray:
        place = hashed & np.int64(len(self.words) * 64 - 1)
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def bitmap(ids: DataFrame) -> Bitmap:
    """Of the one id column of ``ids``; of at most ``MOST_BITS`` bits, or'ed together by Spark."""
    count = max(1, ids.count())
    bits = 1 << min(int(math.log2(MOST_BITS)), max(6, math.ceil(math.log2(count * BITS_PER_ID))))
    place = F.xxhash64(F.col(ids.columns[0])).bitwiseAND(F.lit(bits - 1))
    word = F.shiftright(place, 6)
    one = F.expr(f"shiftleft(1L, cast(xxhash64(`{ids.columns[0]}`) & 63 as int))")
    rows = ids.select(word.alias("word"), one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bitmap(words)


def split(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key surely isn't among ``ids``, and those whose key may be."""
    held = bitmap(ids)

    def check(hashed: pa.Array) -> pa.Array:
        return pa.array(held.hits(hashed.to_numpy(zero_copy_only=False)))

    may_be = F.arrow_udf(check, "boolean")(F.xxhash64(F.col(key)))
    return rows.filter(~may_be), rows.filter(may_be)
