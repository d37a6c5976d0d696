"""Per-read filter of supplementary alignments against the read's leading alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lists import shared_length
from ..functions.parts import spread


def overlap(a: Column, b: Column) -> Column:
    """Bases that two lists of half-open intervals share; lists are sorted and disjoint. Null if either is."""
    side = lambda x, name: F.transform(x, lambda i: i[name])
    return shared_length(side(a, "s"), side(a, "e"), side(b, "s"), side(b, "e"))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda t, x: t + (x["e"] - x["s"]))


def with_leader(mappings: DataFrame) -> DataFrame:
    """Adds place (1: leader) and the leader's start, end and intervals. Groups are reads within one reference; equal rows
    are in the order of ``ordinal``."""
    w = Window.partitionBy("ref_id", "read_id").orderBy("flag", "start", "ordinal")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leader = F.first(F.struct("start", "end", F.col("m_query"))).over(whole)
    return spread(mappings, "ref_id", "read_id").withColumn("place", F.row_number().over(w)).withColumn("leader", leader)


def judged(mappings: DataFrame, max_dist: int = 15000) -> DataFrame:
    """Adds keep and missing_query to mappings (ref_id, read_id, flag, start, end, ordinal, m_query)."""
    lead, none = F.col("leader"), F.array().cast("array<struct<s:bigint,e:bigint>>")
    rows = with_leader(mappings).withColumn("_shared", overlap(F.coalesce("m_query", none), F.coalesce(F.col("leader.m_query"), none)))
    missing = F.col("m_query").isNull() | lead["m_query"].isNull()
    fits = missing | (F.col("_shared") == total(lead["m_query"])) | (F.col("_shared") == 0)
    distance = F.least(*[F.abs(x - y) for x in (F.col("start"), F.col("end")) for y in (lead["start"], lead["end"])])
    first = F.col("place") == 1
    return rows.withColumn("keep", first | (fits & (distance < max_dist))).withColumn("missing_query", ~first & missing).drop("_shared")


def supplementary_filter(mappings: DataFrame, max_dist: int = 15000) -> DataFrame:
    return judged(mappings, max_dist).where("keep").drop("place", "leader", "keep", "missing_query")
