"""Record filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Flag bits and sets (fixed values of the format).
UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 4, 16, 256, 2048


def is_mapped() -> Column:
    """Mapped, not secondary, on a known reference: what both outputs start from."""
    return (F.col("flag").bitwiseAND(UNMAPPED | SECONDARY) == 0) & (F.col("ref_id") >= 0)


def mapped(records: DataFrame) -> DataFrame:
    return records.where(is_mapped())


def exclude_prefixes(records: DataFrame, prefixes) -> DataFrame:
    """Drop chromosomes whose name starts with any prefix; empty prefixes are ignored."""
    tests = [F.col("chrom").startswith(p) for p in prefixes if p]
    return records.where(~reduce(lambda a, b: a | b, tests)) if tests else records


def is_plain(supplementary: bool = True) -> Column:
    """Only plain primaries, and plain supplementaries if asked for; other bits, such as duplicate, drop the record."""
    return F.col("flag").isin(0, REVERSE, *((SUPPLEMENTARY, SUPPLEMENTARY | REVERSE) if supplementary else ()))


def exact_flags(records: DataFrame, supplementary: bool = True) -> DataFrame:
    return records.where(is_plain(supplementary))


def strand() -> Column:
    return F.when(F.col("flag").bitwiseAND(REVERSE) != 0, "-").otherwise("+")


def has_tags(records: DataFrame) -> DataFrame:
    """Records with modification tags that are not empty."""
    return records.where(F.col("mm").isNotNull() & (F.size("ml") > 0))


def fits_sa() -> Column:
    """Supplementaries must name their own chromosome and strand in the first entry of SA; primaries pass."""
    part = F.split("sa", ",")
    same = (F.get(part, F.lit(0)) == F.col("chrom")) & (F.get(part, F.lit(2)) == strand())
    return (F.col("flag").bitwiseAND(SUPPLEMENTARY) == 0) | F.coalesce(same, F.lit(False))


def sa_agrees(records: DataFrame) -> DataFrame:
    return records.where(fits_sa())


def span_end() -> Column:
    """Last place (1-based, inclusive) that M and D operations reach from ``pos`` on."""
    return F.col("pos").cast("bigint") + F.aggregate("cigar", F.lit(0).cast("bigint"), lambda a, c: a + F.when(c["op"].isin("M", "D"), c["len"]).otherwise(0))


def with_span(records: DataFrame, min_len: int = 1) -> DataFrame:
    """start and end (1-based, inclusive) over M and D operations; keeps end - start > min_len."""
    placed = records.withColumn("start", (F.col("pos") + 1).cast("bigint")).withColumn("end", span_end())
    return placed.where(F.col("end") - F.col("start") > min_len)
