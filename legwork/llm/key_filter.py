"""A Bloom filter of fixed size over keys, which keeps large rows without a partner from moving."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: With more keys the filter lets more rows pass; a join behind it decides.
FILTER_BITS = 1 << 26
HASHES = 2


def _spots(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(FILTER_BITS)) for i in range(HASHES)]


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """The filter's words; at most ``FILTER_BITS / 32`` rows reach the driver."""
    bits = keys.select(F.explode(F.array(*_spots(key))).alias("bit"))
    mask = F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("mask")
    table = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(mask).toArrow()
    found = np.zeros(FILTER_BITS // 32, np.uint32)
    found[table.column("word").to_numpy()] = table.column("mask").to_numpy().astype(np.uint32)
    return found


def maybe_in(key: str, keys: DataFrame) -> Column:
    """Whether a row's key may be among the keys; never false for one that is."""
    shared = keys.sparkSession.sparkContext.broadcast(key_filter(keys, key))

    @F.arrow_udf("boolean")
    def held(first: pa.Array, second: pa.Array) -> pa.Array:
        words, found = shared.value, np.ones(len(first), bool)
        for spots in (first, second):
            at = spots.to_numpy(zero_copy_only=False)
            found &= (words[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
        return pa.array(found)

    return held(*_spots(key))
