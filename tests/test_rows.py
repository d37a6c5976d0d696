"""Work within rows: summaries of signal, CIGAR walks and coverage edges against plain versions."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlab.functions import numerics as N
from strandlab.functions import summaries as Y
from strandlab.functions.params import Params, parse_mods
from strandlab.operators import coverage as C
from strandlab.operators import signal as S
from strandlab.operators.cigar import parse_cigar, read_lengths, signal_blocks, with_bin_spans
from strandlab.plans.run import alignment_results

from test_signal import records, two_pass


def made_reads(n=60, seed=3):
    """Reads with two modifications; some have one, some none, some no calls at all."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 400))
        seq = "".join(rng.choice(list("TTTCA"), size))
        flag = int(rng.choice([0, 16]))
        targets = {b: seq.count(b.translate(str.maketrans("ACGT", "TGCA")) if flag else b) for b in "TC"}
        entries, ml = [], []
        for base, code, tail in (("T", "B", rng.choice(["?", "."])), ("C", "m", "?")):
            if rng.random() < 0.8 and targets[base]:
                called = int(rng.integers(0, targets[base] // 2 + 1))
                entries.append(f"{base}+{code}{tail}" + ",".join(["", *map(str, rng.integers(0, 2, called))]))
                ml += rng.integers(0, 256, called).tolist()
        cut = int(rng.integers(0, size))
        rows.append((f"r{i}", int(rng.integers(0, 500)), f"{cut}M7D{size - cut}M" if cut else f"{size}M", flag, seq, ";".join(entries) + ";", ml or [1]))
    return rows


@pytest.mark.parametrize("mode, binarise", [("x87", None), ("x87", 0.5), ("f64", None), ("f64", 0.3)])
def test_summaries_within_rows_equal_those_of_long_tables(spark, mode, binarise):
    params = Params(mods=tuple(parse_mods("T+B,C+m")), bin_size=37, binarise=binarise, float_mode=mode)
    extracted = S.extract(records(spark, made_reads()).repartition(3), params).persist()
    long = {r.ordinal: r for r in S.nested(*S.parts(extracted, params), params.mods, mode).collect()}
    rows = S.nested_rows(extracted, params)
    got = {r.ordinal: r for r in rows.collect()}
    extracted.unpersist()
    assert got.keys() == long.keys() and len(got) > 40
    names = ["signalbin", "med_signalB", "med_signalbinB", "med_signalm", "med_signalbinm"]
    for k, r in got.items():
        assert [tuple(x) for x in r.signalbin] == [tuple(x) for x in long[k].signalbin]  # to the last bit
        assert [r[c] for c in names[1:]] == [long[k][c] for c in names[1:]]
    assert any(r.med_signalB is None for r in got.values()) and any(x.signalm is None for r in got.values() for x in r.signalbin)


def test_means_are_exact_and_sums_sequential():
    rng = np.random.default_rng(1)
    count = rng.integers(1, 300, 200)
    start = np.cumsum(count) - count
    codes = rng.integers(0, 256, count.sum())
    values = codes / 255
    exact, passes = Y.exact_means(codes, start, count), Y.two_pass_means(values, start, count)
    for k, (a, n) in enumerate(zip(start, count)):
        assert exact[k] == N.r_mean_reference(values[a : a + n].tolist()) and passes[k] == two_pass(values[a : a + n].tolist())
        x = np.array(values[a : a + n], np.longdouble)
        s = np.add.accumulate(x)[-1] / n
        assert exact[k] == float(s + np.add.accumulate(x - s)[-1] / n)
    assert not len(Y.sequential_sums(np.zeros(0), start[:0], count[:0]))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_signal_is_not_shuffled_before_the_supplementary_window(spark):
    params = Params(mods=tuple(parse_mods("T+B,C+m")))
    assert "Exchange" not in plan_of(S.nested_rows(S.extract(records(spark, made_reads(5)), params), params))
    refs = spark.createDataFrame([(0, "chrI", 10_000)], "ref_id int, chrom string, length long")
    mappings, _ = alignment_results(records(spark, made_reads(5)), refs, params)
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan_of(mappings).split("Initial Plan")[-1])) == 1


def test_edges_are_few_and_give_the_bins(spark):
    rng = np.random.default_rng(8)
    rows = [(f"r{i}", int(rng.integers(0, 3000)), f"{rng.integers(2000, 9000)}M{rng.integers(1, 40)}D{rng.integers(1, 900)}={rng.integers(1, 900)}N30X", 0, "", None, None) for i in range(50)]
    df = records(spark, rows)
    spans = with_bin_spans(df, 50, F.lit(None)).select("ordinal", F.explode("spans").alias("x")).select("ordinal", "x.*").collect()
    assert len(spans) <= 2 * len(rows) < sum(s.e - s.s for s in spans) / 20  # what is shuffled are two edges for each
    want = {}
    for i, (_, pos, cigar, *_) in enumerate(rows):
        at, last = pos, 0
        for n, op in ((int(x[:-1]), x[-1]) for x in re.findall(r"\d+[A-Z=]", cigar)):
            if op in "M=X":
                for b in range(max(at // 50, last), -(-(at + n) // 50)):
                    want[b] = want.get(b, 0) + 1
                last = max(last, -(-(at + n) // 50))
            at += n
    assert {r.bin: r.n for r in C.coverage_bins(df, 50).collect()} == want
    refs = spark.createDataFrame([(0, 5000)], "ref_id int, length long")
    assert {r.bin: r.n for r in C.coverage_bins(df, 50, refs).collect()} == {b: n for b, n in want.items() if b < 100}


def test_long_references_are_summed_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_BINS", 4)
    rng = np.random.default_rng(2)
    n = np.repeat(rng.integers(0, 4, 30), rng.integers(1, 15, 30))
    edges = spark.createDataFrame([(half, 0, i, int(d)) for half in (0, 1) for i, d in enumerate(np.diff(n * (half + 1), prepend=0, append=0)) if d], "half int, ref_id int, bin long, delta long")
    for half in (0, 1):
        runs = C.coverage_runs(edges, ("half",)).where(F.col("half") == half).collect()
        assert {b: r.n for r in runs for b in range(r.first, r.past) if r.n} == {b: int(x) * (half + 1) for b, x in enumerate(n) if x}


def test_cigars_of_any_kind(spark):
    texts = ["*", "", None, "5M", "10S5M3I2D7M4S", "M5", "3M5H", "0S5M0S", "12M999999999999N1M", "7Q3M", "5H"]
    df = spark.createDataFrame([(i, 100, t) for i, t in enumerate(texts)], "ordinal long, pos int, text string").repartition(2).withColumn("cigar", parse_cigar(F.col("text")))
    want = {i: [(op, int(n)) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", t or "")] for i, t in enumerate(texts)}
    assert {r.ordinal: [(x.op, x.len) for x in r.cigar] for r in df.collect()} == want
    blocks = {}
    for r in signal_blocks(df).collect():
        blocks.setdefault(r.ordinal, []).append((r.q, r.len, r.r))
    assert blocks[4] == [(11, 5, 101), (19, 7, 108)] and blocks[8][1] == (13, 1, 100 + 12 + 999999999999 + 1) and 0 not in blocks
    assert {r.ordinal: r.read_length for r in read_lengths(df).collect()} == {3: 5, 4: 29, 6: 3, 7: 5, 8: 13, 9: 3}


def test_medians_of_nothing_are_null(spark):
    spec = "array<struct<r:bigint,code:int>>"
    df = spark.createDataFrame([(1, [(5, 255), (1005, 0)]), (2, []), (3, None)], f"ordinal long, x {spec}")
    got = {r.ordinal: r for r in S.with_summary(df, ["x"], tuple(parse_mods("T+B"))).collect()}
    assert [tuple(c) for c in got[1].signalbin] == [(1, 1.0), (1001, 0.0)] and got[1].med_signal == 0.5 == got[1].med_signalbin
    assert all(got[k].signalbin == [] and got[k].med_signal is None and got[k].med_signalbin is None for k in (2, 3))
    assert math.isnan(N.r_mean_reference([]))
