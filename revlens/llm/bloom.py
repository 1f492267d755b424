"""Bit sets of a fixed size that stand for a set of hashes, to leave rows out of a shuffle before an exact join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 23


def bit_set(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A bit array of 2**bits bits with one bit set per hash. It stays that size whatever the number of hashes;
    when it is full it holds back nothing, and the join that follows does all the work."""
    place = F.col(column).bitwiseAND((1 << bits) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = hashes.where(F.col(column).isNotNull()).select(F.shiftright(place, 6).alias("word"), bit.alias("bit"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for batch in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():  # 2**(bits - 6) rows at most
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def may_hold(bit_array: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set; false is certain."""
    place = hashes.astype(np.uint64) & np.uint64(len(bit_array) * 64 - 1)
    return (bit_array.view(np.uint64)[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def held(column: Column, bit_array: np.ndarray) -> Column:
    """`may_hold` as a column."""
    shared = SparkSession.active().sparkContext.broadcast(bit_array)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(may_hold(shared.value, values.to_numpy(np.int64)))

    return test(column)
