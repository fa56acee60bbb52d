"""Sets of numbers as bitmaps of fixed size: what is in the set passes, and some of the rest.

A bitmap is small enough to send to every task whatever the size of the set. It only
spares work; whoever uses one decides exactly afterwards.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKET_BYTES = 4096  # of Spark's bitmap functions


def bitmap_of(numbers: DataFrame, column: str, bits: int) -> np.ndarray:
    """The bitmap of a LONG column; ``bits`` is a multiple of 32768."""
    place = F.pmod(F.col(column), F.lit(bits)) + 1  # places count from 1
    parts = numbers.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for bucket, part in parts.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        bitmap[(bucket - 1) * _BUCKET_BYTES : bucket * _BUCKET_BYTES] = np.frombuffer(part, np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    place = np.mod(numbers, len(bitmap) * 8)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
