"""Whole runs: BAM to mappings and coverage, and the comparison of two tracks; also the command line."""

from __future__ import annotations

import argparse
import os
import sys
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.params import Params, parse_mods
from ..functions.staging import shared_dir, stage
from ..operators import coverage as C
from ..operators import filters as L
from ..operators import signal as S
from ..operators import supplementary as U
from ..sources.bam import read_bam, references
from ..sources.files import drop_pieces, spool
from ..sources.bigwig import read_bigwig, write_bigwig
from ..sources.rds import write_rds
from .compare import TOLERANCE, compare_files
from .progress import Phases

ORDER = ("ref_id", "read_id", "flag", "start", "ordinal")


def alignment_results(records: DataFrame, refs: DataFrame, params: Params, extracted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(nested mappings after the supplementary filter, coverage intervals) of alignment records.

    The edges of the coverage, which are read twice, are staged. The signal is summarised within its rows, so mappings are shuffled
    once, for the supplementary filter; ``extracted`` gives rows that are extracted already."""
    usable = L.mapped(records)
    coverage = C.coverage_intervals(stage(C.coverage_edges(usable, params.cov_bin_size, refs), "edges"), refs, params.cov_bin_size)
    maps = S.nested_rows(S.extract(usable, params) if extracted is None else extracted, params)
    return U.supplementary_filter(maps, params.max_dist), coverage


def counters(extracted: DataFrame, params: Params) -> dict[str, int]:
    """Counts of a run: candidates after the row filters, extracted mappings, modifications that were skipped as they have more
    calls than bases, and secondary mappings of a read that the supplementary filter kept without overlap check."""
    counts = extracted.agg(F.count("*").alias("candidates"), F.count_if(F.size("signals") > 0).alias("extracted"), F.coalesce(F.sum("overflows"), F.lit(0)).alias("mm_overflow")).first().asDict()
    judged = U.judged(extracted.where(F.size("signals") > 0).drop("signals"), params.max_dist)
    return counts | judged.agg(F.count_if(F.col("missing_query")).alias("missing_query"), F.count_if("keep").alias("mappings")).first().asDict()


def run(
    spark: SparkSession, bam: str, params: Params = Params(), *, rds: str | None = None, bw: str | None = None, parquet: str | None = None, phases: Phases | None = None
) -> dict[str, int]:
    """Read a BAM once into a staged table, then write what is asked for; returns counts of all records, of those that are
    mapped, and of :func:`counters`. ``phases`` takes the times."""
    if not (rds or bw or parquet):
        raise ValueError("no output: give rds, bw or parquet")
    phases = Phases(spark) if phases is None else phases
    refs = references(spark, bam)
    with phases.phase("reading"):
        seen = Observation("records")
        everything = read_bam(spark, bam).observe(seen, F.count("*").alias("records"), F.count_if(L.is_mapped()).alias("mapped"))
        records = stage(L.mapped(everything), "records")
        counts = dict(seen.get)
    with phases.phase("signal"):
        extracted = stage(S.extract(records, params), "signal")
        counts |= counters(extracted, params)
    mappings, coverage = alignment_results(records, refs, params, extracted)
    if rds or parquet:
        with phases.phase("mappings"):
            mappings = mappings.orderBy(*ORDER)
            mappings = stage(mappings, "mappings").orderBy(*ORDER) if rds and parquet else mappings
            if parquet:
                mappings.write.mode("overwrite").parquet(f"{parquet}/mappings")
            if rds:
                write_rds(mappings, refs, rds, params.rds_level)
    if bw or parquet:
        with phases.phase("coverage"):
            if parquet:
                coverage.write.mode("overwrite").parquet(f"{parquet}/coverage")
            if bw:
                counts["intervals"] = write_bigwig(coverage, refs, bw)
    return counts


def messages(counts: dict[str, int], seconds: dict[str, float] | None = None) -> list[str]:
    """What a run tells its user about its counts, and about the times of its phases."""
    seconds = seconds or {}
    took = seconds.get("reading", 0) + seconds.get("signal", 0)
    rate = f" in {took:.1f} s ({counts['records'] / took:,.0f} a second)" if took else ""
    skipped = f", {counts['mm_overflow']} skipped (more modification calls than target bases)" if counts["mm_overflow"] else ""
    out = [f"read {counts['records']} records{rate}: {counts['candidates']} candidate mappings, {counts['extracted']} with modifications{skipped}"]
    if counts["missing_query"]:
        out.append(f"warning: {counts['missing_query']} mappings of reads with several kept without overlap check, as SA is missing")
    out.append(f"{counts['mappings']} mappings after the supplementary filter")
    if seconds:
        out.append(", ".join(f"{k} {v:.1f} s" for k, v in seconds.items()) + f", {sum(seconds.values()):.1f} s in all")
    return out


def bw_compare(spark: SparkSession, left: str, right: str) -> tuple[DataFrame, int]:
    """(chrom, diff_bases, first_diff) and their total; chromosomes that one side lacks are listed without counting."""
    from ..sources.bigwig import chromosomes, open_file

    a, b = ({n: s for n, s in chromosomes(open_file(p)).values()} for p in (left, right))
    both = spark.createDataFrame([(n, s) for n, s in a.items() if n in b], "chrom string, length long")
    keep = lambda p: read_bigwig(spark, p).where(F.col("chrom").isin([n for n in a if n in b]))
    found = C.diff_tracks(keep(left), keep(right), both)
    lone = spark.createDataFrame([(n, "left") for n in a if n not in b] + [(n, "right") for n in b if n not in a], "chrom string, only_in string")
    sizes = spark.createDataFrame([(n, s, b.get(n)) for n, s in a.items()], "chrom string, left_length long, right_length long")
    rows = sizes.join(found, "chrom", "left").join(lone, "chrom", "full_outer").withColumn("diff_bases", F.when(F.col("only_in").isNull(), F.coalesce("diff_bases", F.lit(0))))
    total = rows.agg(F.coalesce(F.sum("diff_bases"), F.lit(0))).first()[0]
    return rows, total


def write_bedgraph(track: DataFrame, path: str) -> None:
    """chrom, start, end and value as tab-separated text parts."""
    track.select(F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.col("value").cast("string"))).write.text(path)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="strandlab")
    sub = out.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("-b", "--bam", required=True)
    r.add_argument("-o", "--out-prefix")
    r.add_argument("--rds")
    r.add_argument("--bw")
    r.add_argument("-t", "--threads", type=int, default=os.cpu_count() or 4)
    r.add_argument("--mod", action="append")
    r.add_argument("--binarise", type=float)
    r.add_argument("--no-supplementary", action="store_true")
    r.add_argument("--max-dist", type=int, default=15000)
    r.add_argument("--min-len", type=int, default=1)
    r.add_argument("--bin-size", type=int, default=1000)
    r.add_argument("--cov-bin-size", type=int, default=50)
    r.add_argument("--exclude-prefix", default="chrM")
    r.add_argument("--rds-level", type=int, default=6)
    r.add_argument("--float-mode", choices=["x87", "f64"], default="x87")
    c = sub.add_parser("bw-compare")
    c.add_argument("left")
    c.add_argument("right")
    c = sub.add_parser("compare")
    c.add_argument("left")
    c.add_argument("right")
    c.add_argument("chroms", nargs="?")
    c.add_argument("--tolerance", type=float, default=TOLERANCE)
    return out


def _session(threads: int) -> SparkSession:
    return SparkSession.builder.master(os.environ.get("SPARK_MASTER", f"local[{max(1, threads)}]")).appName("strandlab").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "bw-compare":
        rows, total = bw_compare(_session(os.cpu_count() or 4), args.left, args.right)
        for r in rows.orderBy("chrom").toLocalIterator():
            print(*r, sep="\t")
        print(f"total\t{total}")
        return 0
    if args.command == "compare":
        checks = compare_files(_session(os.cpu_count() or 4), args.left, args.right, args.chroms.split(",") if args.chroms else None, args.tolerance)
        print(*checks, sep="\n")
        return 0 if all(c.passed for c in checks) else 1
    prefix = args.out_prefix
    rds = args.rds or (prefix and f"{prefix}_nanoT_alldata.rds")
    bw = args.bw or (prefix and f"{prefix}.bw")
    if not (rds or bw):
        print("no output: give --out-prefix, --rds or --bw", file=sys.stderr)
        return 2
    spark, say = _session(args.threads), lambda line: print(line, file=sys.stderr, flush=True)
    phases, bam = Phases(spark, say), args.bam
    if bam == "-":  # a stream goes to the shared folder piece by piece, as splits need files
        with phases.phase("standard input"):
            bam = spool(sys.stdin.buffer, f"{shared_dir(spark)}/strandlab/stdin-{uuid.uuid4().hex}")
    params = Params(
        mods=tuple(parse_mods(args.mod or ["T+B"])), binarise=args.binarise, supplementary=not args.no_supplementary, max_dist=args.max_dist, min_len=args.min_len, bin_size=args.bin_size,
        cov_bin_size=args.cov_bin_size, exclude_prefix=tuple(p for p in args.exclude_prefix.split(",") if p), float_mode=args.float_mode, rds_level=args.rds_level,
    )
    try:
        for line in messages(run(spark, bam, params, rds=rds, bw=bw, phases=phases), phases.seconds):
            say(line)
    finally:
        if args.bam == "-":
            drop_pieces(bam)
    return 0


if __name__ == "__main__":
    sys.exit(main())
