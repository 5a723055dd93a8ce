"""Helpers that several of the corpus operators share."""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blobframe.session import materialize

#: What separates words: blanks and the controls from tab to carriage return.
BREAK = r"[\x20\x09-\x0D]+"
BREAK_CHARACTERS = " \t\n\x0b\x0c\r"

#: A side with at most so many (narrow) rows is broadcast; beyond that the join shuffles.
BROADCAST_ROWS = 200_000
#: The same for rows that are two numbers alone, which take some 50 bytes in memory.
BROADCAST_KEYS = 1_000_000
#: Seconds in which the listeners of the session hear of a query's end.
LISTENERS_S = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text that is not NULL, as an array."""
    return F.array_remove(F.split(text, BREAK), "")


def join_measured(
    left: DataFrame, right: DataFrame, on: list[str], label: str, how: str = "left"
) -> DataFrame:
    """Join with a side that is stored and counted first.

    A right side of up to BROADCAST_ROWS rows is broadcast. Beyond that both sides are shuffled;
    since the right one is a stored table, adaptive execution can split a hot key of the left one.
    """
    return join_stored(left, materialize(right, label), on, how)


def join_stored(left: DataFrame, stored: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """:func:`join_measured` with a side that is stored already."""
    if stored.count() <= BROADCAST_ROWS:
        stored = F.broadcast(stored)
    return left.join(stored, on, how)


def settled(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """:func:`materialize`, and let Spark delete the shuffle files that made the table.

    Spark does so once the driver's JVM has noticed that no plan needs them any more, which it can
    only after its listeners have heard of the end of the query.
    """
    stored = materialize(df, label, keep)
    for _ in range(2):
        df.sparkSession._jvm.System.gc()
        time.sleep(LISTENERS_S)
    return stored


def square_bits(rows: int) -> int:
    """Bits of a hash that cut ``rows`` rows into about as many cells as a cell has rows."""
    return max(0, round(math.log2(max(rows, 1)) / 2))


def top_bits(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits) if bits else F.lit(0).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
