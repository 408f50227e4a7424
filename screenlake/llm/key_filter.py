"""A fixed-size bit table of hashed keys, for a second scan of the documents.

The first scan emits small key rows; Spark finds the keys that matter; their bits
are put together by a grouped ``bit_or`` (at most ``2**bits / 64`` words, whatever
the number of keys) and broadcast. The second scan emits only what may matter. A
false positive costs work and is dropped later by the exact step; nothing is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 25


def key_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS):
    """Broadcast uint64 words with a bit set for each value of a bigint column."""
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (keys.select(F.shiftright(slot, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow())
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each uint64 key's bit is set."""
    slot = keys & np.uint64(table.size * 64 - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
