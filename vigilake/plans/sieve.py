"""A Bloom-like bitmap of keys, to keep rows that cannot match out of a shuffle.

One bit per key in a bitmap of a bounded size, built by Spark's bitmap aggregates (combined in the map tasks)
and broadcast. A row whose bit is not set is not among the keys; one whose bit is set may be, and a join says.
Where the keys are too many for the bitmap all bits are set in the end: nothing is saved, and nothing is wrong.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 32_768  # bits of a page, as Spark's bitmap functions have it
MOST = 1 << 27  # bits: 16 MB to broadcast


def hashed(*columns: Column | str) -> Column:
    """The key of a row: one number of any columns, nulls too."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\u0000")) for c in columns])


def maybe_among(keys: DataFrame, key: Column, expected: int, most: int = MOST):
    """A function of a Column of keys (longs as of `hashed`): whether it may be among `keys`; `expected` is their number."""
    bits = PAGE
    while bits < min(most, 16 * expected):
        bits *= 2
    at = F.pmod(key, F.lit(bits)) + 1
    pages = keys.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    held = np.zeros(bits // 8, np.uint8)
    for page, raw in pages.collect():  # at most `bits` / PAGE rows of 4 KB
        held[(page - 1) * PAGE // 8 : page * PAGE // 8] = np.frombuffer(raw, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(held.tobytes())

    @F.arrow_udf("boolean")
    def among(column: pa.Array) -> pa.Array:
        held = np.frombuffer(shared.value, np.uint8)
        x = np.asarray(column).astype(np.int64) % bits
        return pa.array((held[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1)

    return among
