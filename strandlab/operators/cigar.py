"""CIGAR operators. The signal and the coverage dialects advance on different operations; both are walked within the row.
A record's ``cigar`` is a list of operations or its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cigars import bin_spans, parsed, walk


def parse_cigar(text: Column) -> Column:
    """array<struct<op, len>> of a CIGAR string; empty for ``*``."""
    return parsed(text)


def with_walk(records: DataFrame) -> DataFrame:
    """Adds ``blocks``, each M block's ix, q (1-based in the read), len and r (1-based on the reference), and ``read_length``.

    M advances both, I and S the read, D and N the reference; H, P, = and X advance nothing here. The read length is, with a last S
    of some length, all of the read that was walked, otherwise up to the last M block; null with neither."""
    rows = records.withColumn("_walk", walk(F.col("pos").cast("bigint"), "cigar"))
    return rows.withColumns({"blocks": F.col("_walk.blocks"), "read_length": F.col("_walk.read_length")}).drop("_walk")


def with_blocks(records: DataFrame) -> DataFrame:
    """Adds ``blocks`` alone."""
    return records.withColumn("blocks", walk(F.col("pos").cast("bigint"), "cigar")["blocks"])


def with_placed_blocks(records: DataFrame, min_len: int = 1) -> DataFrame:
    """Adds ``start`` and ``end`` (1-based, inclusive, over M and D operations) and ``blocks`` in one walk; keeps end - start > min_len."""
    rows = records.withColumn("_walk", walk(F.col("pos").cast("bigint"), "cigar"))
    pos = F.col("pos").cast("bigint")
    placed = rows.withColumns({"start": pos + 1, "end": pos + F.col("_walk.span"), "blocks": F.col("_walk.blocks")}).drop("_walk")
    return placed.where(F.col("end") - F.col("start") > min_len)


def signal_blocks(records: DataFrame) -> DataFrame:
    """ordinal and the fields of each M block, as rows."""
    return with_blocks(records.select("ordinal", "pos", "cigar")).select("ordinal", F.inline("blocks"))


def with_read_length(records: DataFrame) -> DataFrame:
    """Adds ``read_length`` alone."""
    return records.withColumn("read_length", walk(F.lit(0).cast("bigint"), "cigar")["read_length"])


def read_lengths(records: DataFrame) -> DataFrame:
    """ordinal and read_length; records with none drop out."""
    return with_read_length(records).select("ordinal", "read_length").where("read_length is not null")


def with_bin_spans(records: DataFrame, bin_size: int, bins: Column) -> DataFrame:
    """Adds ``spans``, the half-open runs of bins (s, e) that a record's M, = and X blocks touch: disjoint, ascending, and before
    ``bins`` where that is not null. D and N advance; empty blocks are skipped."""
    return records.withColumn("spans", bin_spans(F.col("pos").cast("bigint"), "cigar", F.lit(bin_size).cast("bigint"), bins.cast("bigint")))


def query_intervals() -> Column:
    """m_query of a record with ``blocks`` and ``sa``: the [q, q + len) of its M blocks in order; null without SA or blocks."""
    spans = F.transform("blocks", lambda b: F.struct(b["q"].alias("s"), (b["q"] + b["len"]).alias("e")))
    return F.when(F.col("sa").isNotNull() & (F.size("blocks") > 0), spans)
