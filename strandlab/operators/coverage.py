"""Binned coverage, dense run-length tracks and their comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage
from .cigar import with_bin_spans

#: Bins, and bases, of a reference that one window group holds; longer references are many groups.
BUCKET_BINS = 1 << 16
BUCKET_BASES = 1 << 20


def coverage_edges(records: DataFrame, bin_size: int = 50, refs: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, ref_id, bin and delta: how many more records touch the bin than the one before it, where that is not none.

    A record touches each bin once, as its spans are disjoint; each span is two edges, however long it is, so what is shuffled are
    partial sums of edges. With ``refs`` (ref_id, length) bins past the end go."""
    rows, last = records.select(*keys, "ref_id", "pos", "cigar"), F.lit(None)
    if refs is not None:
        rows = rows.join(F.broadcast(refs.select("ref_id", F.ceil(F.col("length") / bin_size).alias("_bins"))), "ref_id")
        last = F.col("_bins")
    spans = with_bin_spans(rows, bin_size, last).select(*keys, "ref_id", F.explode("spans").alias("x"))
    edge = lambda at, d: F.struct(F.col(at).alias("bin"), F.lit(d).cast("bigint").alias("d"))
    edges = spans.select(*keys, "ref_id", F.inline(F.array(edge("x.s", 1), edge("x.e", -1))))
    return edges.groupBy(*keys, "ref_id", "bin").agg(F.sum("d").alias("delta")).where("delta <> 0")


def coverage_runs(edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, ref_id, first, past and n: the bins from each edge to the next and how many records touch them, zeros between two
    others included. Neighbours differ, as every edge is a change.

    Sums run within buckets of a reference; what they need from around is carried over by one row for each bucket. ``edges`` is
    read twice and should be a staged table."""
    group = [*keys, "ref_id"]
    rows = edges.withColumn("bucket", F.floor(F.col("bin") / BUCKET_BINS))
    along, here = Window.partitionBy(*group).orderBy("bucket"), Window.partitionBy(*group, "bucket").orderBy("bin")
    sums = rows.groupBy(*group, "bucket").agg(F.sum("delta").alias("total"), F.min("bin").alias("begin"))
    around = sums.select(*group, "bucket", F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.lead("begin").over(along).alias("after"))
    placed = rows.join(around, [*group, "bucket"])
    n = F.coalesce("before", F.lit(0)) + F.sum("delta").over(here)
    return placed.select(*group, F.col("bin").alias("first"), F.coalesce(F.lead("bin").over(here), "after").alias("past"), n.alias("n")).where("past is not null")


def coverage_bins(records: DataFrame, bin_size: int = 50, refs: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, ref_id, bin and number of records that touch the bin, each once, of all bins that any touches."""
    runs = coverage_runs(stage(coverage_edges(records, bin_size, refs, keys), "edges"), keys).where("n > 0")
    return runs.select(*keys, "ref_id", F.explode(F.sequence("first", F.col("past") - 1)).alias("bin"), "n")


def coverage_intervals(edges: DataFrame, refs: DataFrame, bin_size: int = 50) -> DataFrame:
    """ref_id, chrom, start, end, value of staged edges: the whole of every reference, equal neighbours merged, zeros included.

    Only what lies before the first and after the last edge is added to the runs; empty stretches are never filled in."""
    runs = coverage_runs(edges)
    lengths = refs.select("ref_id", "chrom", F.col("length").cast("bigint").alias("length")).where("length > 0")
    ends = lengths.join(edges.groupBy("ref_id").agg(F.min("bin").alias("low"), F.max("bin").alias("high")), "ref_id", "left").withColumn("all", F.ceil(F.col("length") / bin_size))
    none = lambda first, past: F.struct(first.cast("bigint").alias("first"), past.cast("bigint").alias("past"), F.lit(0).cast("bigint").alias("n"))
    outer = F.array(none(F.lit(0), F.coalesce("low", "all")), none(F.coalesce("high", "all"), F.col("all")))
    pieces = runs.unionByName(ends.select("ref_id", F.inline(outer)).where("first < past")).join(F.broadcast(lengths), "ref_id")
    return pieces.select("ref_id", "chrom", (F.col("first") * bin_size).alias("start"), F.least(F.col("past") * bin_size, "length").alias("end"), F.col("n").cast("float").alias("value"))


def _segments(track: DataFrame, ends: DataFrame | None) -> DataFrame:
    """Intervals up to the ends of their references, cut at the edges of buckets, so that each bucket is compared on its own."""
    rows = track.select("chrom", F.col("start").cast("bigint").alias("s"), F.col("end").cast("bigint").alias("e"), F.col("value").cast("float").alias("value"))
    if ends is not None:
        rows = rows.join(F.broadcast(ends.select("chrom", "length")), "chrom").withColumn("e", F.least("e", "length"))
    rows = rows.where("s < e").withColumn("bucket", F.explode(F.sequence(F.floor(F.col("s") / BUCKET_BASES), F.floor((F.col("e") - 1) / BUCKET_BASES))))
    edge = F.col("bucket") * BUCKET_BASES
    return rows.select("chrom", "bucket", F.greatest("s", edge).alias("start"), F.least("e", edge + BUCKET_BASES).alias("end"), "value")


def _changes(segments: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a track may change, ascending, whether it has a value from there on, and which; it has none before the first."""
    start, end, value = (segments.column(c) for c in ("start", "end", "value"))
    n, known = segments.num_rows, value.is_valid().to_numpy()
    at = np.concatenate([start.to_numpy(), end.to_numpy()])
    begins, has = np.repeat([True, False], n), np.concatenate([known, np.zeros(n, bool)])
    value = np.concatenate([value.fill_null(0).to_numpy(), np.zeros(n, np.float32)])
    # at a position the start of an interval comes after the end of another
    order = np.lexsort((value, has, begins, at))
    order = order[np.concatenate([np.diff(at[order]) > 0, np.ones(min(n, 1), bool)])]
    before = lambda x, first: np.concatenate([np.array([first], x.dtype), x[order]])
    return before(at, np.iinfo(np.int64).min), before(has, False), before(value, 0)


def _sweep(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Bases of a bucket at which two tracks differ, and the first of them; no row where there are none."""
    (a_at, a_has, a), (b_at, b_has, b) = _changes(left), _changes(right)
    at = np.union1d(a_at[1:], b_at[1:])
    i, j = (np.searchsorted(x, at, side="right") - 1 for x in (a_at, b_at))
    values = (a[i] == b[j]) | (np.isnan(a[i]) & np.isnan(b[j]))
    same = (a_has[i] == b_has[j]) & (~a_has[i] | values)
    differs = np.flatnonzero(~same[:-1])
    bases = np.diff(at)[differs]
    rows = 1 if len(differs) else 0
    return pa.table({"chrom": pa.array([key[0].as_py()] * rows, pa.string()), "diff_bases": pa.array([int(bases.sum())] * rows, pa.int64()), "first_diff": pa.array(at[differs[:1]], pa.int64())})


def diff_tracks(left: DataFrame, right: DataFrame, length: DataFrame | None = None) -> DataFrame:
    """chrom, diff_bases and first_diff (0-based) of two tracks (chrom, start, end, value), swept together and never by base.

    Intervals of a track do not overlap. Missing stretches and null values equal each other and differ from any value; NaN equals
    NaN. With ``length`` (chrom, length) bases past it are left out, as are chromosomes that it lacks. Each side is shuffled once, by
    buckets of a reference of which a task holds one at a time."""
    parts = _segments(left, length).groupBy("chrom", "bucket").cogroup(_segments(right, length).groupBy("chrom", "bucket"))
    found = parts.applyInArrow(_sweep, "chrom string, diff_bases long, first_diff long")
    return found.groupBy("chrom").agg(F.sum("diff_bases").alias("diff_bases"), F.min("first_diff").alias("first_diff"))
