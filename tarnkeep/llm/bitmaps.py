"""Bitmaps of fixed size that spare the shuffle of rows which cannot match."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**24 bits are 2 MB.  A fuller bitmap lets more rows pass that then find no partner; it never
#: loses one.
BITS = 24


def bitmap_of(rows: DataFrame, number: Column, bits: int = BITS) -> np.ndarray:
    """The bitmap of a 64-bit ``number`` in all rows: 2**(bits - 6) words, whatever their count.

    Spark combines the bits by word, so the driver receives at most 2**(bits - 6) rows, which is a
    bound on the bytes that are collected and broadcast.  Rows with a null number are left out.
    """
    words = 1 << (bits - 6)
    place = number.bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    word = F.shiftrightunsigned(number, 6).bitwiseAND(F.lit(words - 1))
    found = (
        rows.filter(number.isNotNull())
        .groupBy(word.cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(words, dtype=np.uint64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap
