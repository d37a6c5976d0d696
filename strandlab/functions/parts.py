"""Shuffles whose partitions do not grow with the input: their number does."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files behind one partition, and the least number of partitions.
PART_BYTES, LEAST = 4 << 20, 12

#: From here on the optimizer's size stands for an unknown one.
_UNKNOWN = 1 << 55


def input_bytes(df: DataFrame) -> int | None:
    """Size of the files that a table is made from, as the optimizer knows it; None where that of any source is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(n >= _UNKNOWN for n in sizes) else sum(sizes)


def spread(df: DataFrame, *keys: str, size: int | None = None) -> DataFrame:
    """Rows in hash partitions by ``keys``, so many that each stands for ``PART_BYTES`` of input, however large that is; what
    groups or windows by the keys needs no other shuffle. With inputs of unknown size the shuffle is left to Spark's settings."""
    size = input_bytes(df) if size is None else size
    return df if size is None else df.repartition(max(LEAST, -(-size // PART_BYTES)), *keys)
