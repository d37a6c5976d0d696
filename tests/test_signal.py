"""Golden records of the signal, coverage and supplementary operators."""

import numpy as np
import pytest

from strandlab.functions import numerics as N
from strandlab.functions.params import ModSpec, Params, parse_mods
from strandlab.operators import coverage as C
from strandlab.operators import signal as S
from strandlab.operators import supplementary as U
from strandlab.operators.cigar import parse_cigar, read_lengths, signal_blocks
from strandlab.plans.compare import compare_mappings, key_difference
from pyspark.sql import functions as F

RECORD = "ordinal long, read_id string, ref_id int, chrom string, pos int, cigar_text string, flag int, seq string, mm string, ml array<int>, sa string"

GOLDEN = [
    ("G1", 0, "5M", 0, "TTATT", "T+B?,1,0;", [51, 204]),
    ("G2", 0, "5M", 0, "TTATT", "T+B.,1,0;", [51, 204]),
    ("G3", 0, "5M", 0, "TTATT", "T+B?,3,0;", [51, 204]),
    ("G4", 100, "5M", 16, "AACAA", "T+B?,0,1;", [51, 204]),
    ("G5", 0, "10M5S3H", 16, "A" * 15, "T+B.;", [1]),
    ("G6", 0, "6M", 0, "CCACAC", "C+mh?,0,1;A+a?,0;", [10, 20, 30, 40, 99]),
    ("G8", 0, "5S10M2D3I7M4S", 0, "T" * 29, "T+B.,5,9;", [255, 128]),
    ("G10", 0, "5M10N5M", 0, "T" * 10, "T+B.;", [1]),
]


def records(spark, rows):
    data = [(i, name, 0, "chrI", pos, cigar, flag, seq, mm, ml, None) for i, (name, pos, cigar, flag, seq, mm, ml) in enumerate(rows)]
    df = spark.createDataFrame(data, RECORD)
    return df.withColumn("cigar", parse_cigar(F.col("cigar_text"))).withColumn("l_seq", F.length("seq"))


def run(spark, mods, **kw):
    params = Params(mods=tuple(parse_mods(mods)), **kw)
    maps, bins, calls = S.mappings(records(spark, GOLDEN), params)
    name = {r.ordinal: (r.read_id, r.start, r.end) for r in maps.collect()}
    sig, means = {}, {}
    for r in calls.collect():
        sig.setdefault((name[r.ordinal][0], r.mod), []).append((r.r, r.code))
    for r in bins.collect():
        means.setdefault((name[r.ordinal][0], r.mod), {})[r.bin_position] = r.signal
    out = S.nested(maps, bins, calls, params.mods).collect()
    return name, {k: sorted(v) for k, v in sig.items()}, means, {r.read_id: r for r in out}


def test_golden_records(spark):
    name, sig, means, rows = run(spark, "T+B")
    t = lambda g: (g, "T+B")
    assert sig[t("G1")] == [(2, 51), (4, 204)] and means[t("G1")] == {1: 0.5} and rows["G1"].med_signal == 0.5 and rows["G1"].med_signalbin == 0.5
    assert sig[t("G2")] == [(1, 0), (2, 51), (4, 204), (5, 0)] and means[t("G2")] == {1: 0.25} and rows["G2"].med_signal == 0.1
    assert t("G3") not in sig and "G3" not in rows and "G6" not in rows
    assert sig[t("G4")] == [(102, 204), (105, 51)] and (rows["G4"].start, rows["G4"].end) == (101, 105)
    assert sig[t("G5")] == [(r, 0) for r in range(1, 11)]
    assert sig[t("G10")] == [(r, 0) for r in range(1, 6)] and rows["G10"].end == 10
    assert rows["G8"].end == 19 and [tuple(x) for x in rows["G1"].signalbin] == [(1, 0.5)]


def test_indels_and_small_bins(spark):
    _, _, means, rows = run(spark, "T+B", bin_size=5)
    assert means[("G8", "T+B")] == {1: 0.2, 6: 0.0, 11: 0.0, 16: 0.0} and rows["G8"].med_signal == 0
    df = records(spark, GOLDEN[6:7])
    assert [(r.q, r.len, r.r) for r in signal_blocks(df).orderBy("q").collect()] == [(6, 10, 1), (19, 7, 13)]
    assert read_lengths(records(spark, GOLDEN[4:5])).first().read_length == 10


def test_combined_codes_and_binarise(spark):
    _, sig, means, rows = run(spark, ["C+h,A+a"])
    assert sig[("G6", "C+h")] == [(1, 20), (4, 40)] and means[("G6", "C+h")] == {1: 0.11764705882352941}
    assert sig[("G6", "A+a")] == [(3, 99)] and means[("G6", "A+a")] == {1: 0.38823529411764707}
    assert rows["G6"].med_signalh == 0.11764705882352941 and [tuple(x) for x in rows["G6"].signalbin] == [(1, 0.11764705882352941, 0.38823529411764707)]
    _, _, means, rows = run(spark, "T+B", binarise=0.5)
    assert means[("G2", "T+B")] == {1: 0.25} and rows["G2"].med_signal == 0.1


def test_specifications():
    assert ModSpec.parse("C+17802").code == "17802" and [m.name for m in parse_mods(["T+B,C+m", "A+a"])] == ["T+B", "C+m", "A+a"]
    for bad in ("T-B", "X+B", "C+mh", "T+"):
        with pytest.raises(ValueError):
            ModSpec.parse(bad)


def test_entry_matching(spark):
    entries = ["T+B.", "T+B?", "T+B", "T+e.", "C+B.", "C+mh.", "C+17802?", "C+1780.", "T-B"]
    df = spark.createDataFrame([(e,) for e in entries], "e string")
    got = lambda spec: [r[0] for r in df.select(S.code_slot(F.col("e"), ModSpec.parse(spec))).collect()]
    assert got("T+B") == [0, 0, 0] + [None] * 6
    assert got("C+h") == [None] * 5 + [1] + [None] * 3 and got("C+17802") == [None] * 6 + [0] + [None] * 2
    assert [r[0] for r in df.select(S.code_count(F.col("e"))).collect()] == [1, 1, 1, 1, 1, 2, 1, 1, 1]


def test_exact_means(spark):
    rng = np.random.default_rng(1)
    data = [(k, int(c)) for k in range(120) for c in rng.integers(0, 256, rng.integers(1, 300))]
    by = {}
    for k, c in data:
        by.setdefault(k, []).append(c / 255)
    got = spark.createDataFrame(data, "k int, code int").groupBy("k").agg(N.exact_mean(F.col("code")).alias("m")).collect()
    for r in got:
        x = np.array(by[r.k], np.longdouble)
        s = np.add.accumulate(x)[-1] / len(x)
        assert r.m == N.r_mean_reference(by[r.k]) == float(s + np.add.accumulate(x - s)[-1] / len(x))


def test_coverage_golden(spark):
    rows = [("a", 0, "5S10M2D3I7M4S", 0, "", None, None), ("b", 45, "10M200N10M", 0, "", None, None), ("c", 95, "3=2X5M", 0, "", None, None)]
    refs = spark.createDataFrame([(0, "chrI", 310), (1, "chrII", 60), (2, "none", 0)], "ref_id int, chrom string, length long")
    got = C.coverage_intervals(C.coverage_edges(records(spark, rows), 50, refs), refs, 50).orderBy("ref_id", "start").collect()
    assert [(r.chrom, r.start, r.end, r.value) for r in got] == [
        ("chrI", 0, 100, 2), ("chrI", 100, 150, 1), ("chrI", 150, 250, 0), ("chrI", 250, 300, 1), ("chrI", 300, 310, 0), ("chrII", 0, 60, 0)
    ]


def test_track_difference(spark):
    schema = "chrom string, start long, end long, value float"
    a = spark.createDataFrame([("x", 0, 10, 1.0), ("x", 10, 20, 2.0), ("y", 0, 5, 1.0)], schema)
    b = spark.createDataFrame([("x", 0, 12, 1.0), ("x", 14, 20, 2.0), ("y", 0, 5, 1.0)], schema)
    assert [tuple(r) for r in C.diff_tracks(a, b).collect()] == [("x", 4, 10)]


def random_track(rng):
    """Intervals with gaps, null and NaN values, and the value of each base that has one."""
    rows, bases = [], {}
    for chrom in "xyz":
        at = int(rng.integers(0, 30))
        while at < 500:
            past, value = at + int(rng.integers(1, 90)), [1.0, 2.0, float("nan"), None][rng.integers(0, 4)]
            rows.append((chrom, at, past, value))
            bases.update({(chrom, i): str(value) for i in range(at, past) if value is not None})
            at = past + int(rng.integers(0, 2)) * 5
    return rows, bases


def test_track_difference_base_by_base(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_BASES", 64)
    rng = np.random.default_rng(8)
    (left, a), (right, b) = random_track(rng), random_track(rng)
    right = [r for r in right if r[0] != "z"] + [("only", 5, 9, 1.0)]
    b = {k: v for k, v in b.items() if k[0] != "z"} | {("only", i): "1.0" for i in range(5, 9)}
    schema = "chrom string, start long, end long, value float"
    tracks = [spark.createDataFrame(x, schema).repartition(3) for x in (left, right)]
    for lengths in (None, {"x": 333, "y": 64, "z": 1000}):
        want = {}
        for chrom, at in sorted(a.keys() | b.keys()):
            if a.get((chrom, at)) != b.get((chrom, at)) and (lengths is None or at < lengths.get(chrom, 0)):
                n, first = want.get(chrom, (0, at))
                want[chrom] = (n + 1, first)
        sizes = lengths and spark.createDataFrame(list(lengths.items()), "chrom string, length long")
        found = C.diff_tracks(*tracks, sizes)
        assert {r.chrom: (r.diff_bases, r.first_diff) for r in found.collect()} == want
    empty = spark.createDataFrame([], schema)
    assert C.diff_tracks(empty, empty).count() == 0 and C.diff_tracks(tracks[0], tracks[0]).count() == 0
    plan = C.diff_tracks(*[spark.createDataFrame(x, schema) for x in (left, right)])._jdf.queryExecution().executedPlan().toString()
    # one shuffle of each side by bucket, one of the buckets' results
    assert plan.count("Exchange hashpartitioning") == 3


def test_supplementary_golden(spark):
    rows = [(0, 0, 10, 100, [(1, 50)]), (1, 2048, 200, 300, [(60, 90)]), (2, 2048, 90000, 90100, [(60, 90)]), (3, 2064, 20, 90, None), (4, 2048, 20, 90, [(10, 30)]), (5, 2048, 200, 300, [(1, 50)])]
    df = spark.createDataFrame([(o, "r", 0, f, s, e, q) for o, f, s, e, q in rows], "ordinal long, read_id string, ref_id int, flag int, start long, end long, m_query array<struct<s:bigint,e:bigint>>")
    got = {r.ordinal: (r.keep, r.missing_query) for r in U.judged(df).collect()}
    assert got == {0: (True, False), 1: (True, False), 2: (False, False), 3: (True, True), 4: (False, False), 5: (True, False)}


def two_pass(values):
    """The two-pass mean in 64-bit floats, in order."""
    first = 0.0
    for v in values:
        first += v
    first /= len(values)
    rest = 0.0
    for v in values:
        rest += v - first
    return first + rest / len(values)


def test_means_and_medians_in_64_bits(spark):
    rng = np.random.default_rng(3)
    data = [(k, r, int(c)) for k in range(60) for r, c in enumerate(rng.integers(0, 256, rng.integers(1, 40)), 1)]
    calls = spark.createDataFrame(data, "ordinal long, r long, code int").withColumn("mod", F.lit("T+B")).repartition(3)
    bins = S.signal_bins(calls, ["ordinal", "mod"], 10, float_mode="f64")
    maps = calls.select("ordinal").distinct()
    got = {r.ordinal: r for r in S.nested(maps, bins, calls, (ModSpec.parse("T+B"),), "f64").collect()}

    def median(values):
        v, k = sorted(values), len(values) // 2
        return v[k] if len(v) % 2 else two_pass(v[k - 1 : k + 1])

    differs = 0
    for k in range(60):
        codes = [c / 255 for o, _, c in data if o == k]
        means = [two_pass(codes[i : i + 10]) for i in range(0, len(codes), 10)]
        assert [tuple(x) for x in got[k].signalbin] == [(10 * i + 1, m) for i, m in enumerate(means)]
        assert got[k].med_signal == median(codes) and got[k].med_signalbin == median(means)
        differs += got[k].med_signal != N.r_median_reference(codes)
    assert differs  # the mode reaches the medians


def test_first_entry_wins_and_broken_skips_end_the_scan(spark):
    rows = [
        ("two", 0, "6M", 0, "TTTTAA", "T+B?,0;T+B?,1,0;", [7, 8, 9]), ("later", 0, "6M", 0, "TTTTAA", "T+e?,0,0;T+B?,1;", [1, 2, 3]), ("broken", 0, "6M", 0, "TTTTAA", "T+B?,0,x,0;", [7, 8, 9]),
        ("minus", 0, "6M", 0, "TTTTAA", "T+B?,1,-1,0;", [7, 8, 9]), ("blank", 0, "6M", 0, "TTTTAA", "T+B?, 1 ;", [7]), ("short", 0, "6M", 0, "TTTTAA", "T+B.,0,0;", [7]), ("none", 0, "6M", 0, "TTTTAA", "T+B?;", [7]),
    ]
    _, _, calls = S.mappings(records(spark, rows), Params(mods=tuple(parse_mods("T+B"))))
    got = {}
    for r in calls.collect():
        got.setdefault(rows[r.ordinal][0], []).append((r.r, r.code))
    assert {k: sorted(v) for k, v in got.items()} == {"two": [(1, 7)], "later": [(2, 3)], "broken": [(1, 7)], "minus": [(2, 7)], "blank": [(2, 7)], "short": [(1, 7), (2, 0), (3, 0), (4, 0)]}


def test_any_base_drops_what_is_not_reported(spark):
    rows = [("n", 0, "6M", 0, "TTCTAA", "N+B.,1,2;", [7, 8])]
    _, _, calls = S.mappings(records(spark, rows), Params(mods=tuple(parse_mods("N+B"))))
    assert sorted((r.r, r.code) for r in calls.collect()) == [(2, 7), (5, 8)]


def test_places_within_rows_against_plain_walks(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(80):
        cigar = "".join(f"{rng.integers(0, 9)}{rng.choice(list('MIDNSHP=X'))}" for _ in range(rng.integers(1, 12)))
        rows.append((f"r{i}", int(rng.integers(0, 400)), cigar, 0, "", None, None))
    df = records(spark, rows)
    blocks, cover = [], {}
    for i, (_, pos, cigar, *_) in enumerate(rows):
        q, r, at, last = 1, pos + 1, pos, 0
        for n, op in ((int(x[:-1]), x[-1]) for x in __import__("re").findall(r"\d+[A-Z=]", cigar)):
            if op == "M":
                blocks.append((i, q, n, r))
            q += n if op in "MIS" else 0
            r += n if op in "MDN" else 0
            if op in "M=X" and n:
                low, high = max(at // 50, last), -(-(at + n) // 50)
                for b in range(low, high):
                    cover[b] = cover.get(b, 0) + 1
                last = max(last, high)
            at += n if op in "M=XDN" else 0
    assert sorted((r.ordinal, r.q, r.len, r.r) for r in signal_blocks(df).collect()) == sorted(blocks)
    assert {r.bin: r.n for r in C.coverage_bins(df, 50).collect()} == cover


def test_tracks_longer_than_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_BINS", 8)
    monkeypatch.setattr(C, "BUCKET_BASES", 64)
    rng = np.random.default_rng(9)
    dense = np.repeat(rng.integers(0, 3, 60), rng.integers(1, 30, 60))
    dense[300:500] = 2
    edges = spark.createDataFrame([(0, i, int(d)) for i, d in enumerate(np.diff(dense, prepend=0, append=0)) if d], "ref_id int, bin long, delta long")
    refs = spark.createDataFrame([(0, "x", 10 * len(dense) + 25), (1, "y", 40)], "ref_id int, chrom string, length long")
    got = [tuple(r) for r in C.coverage_intervals(edges, refs, 10).orderBy("ref_id", "start").select("chrom", "start", "end", "value").collect()]
    full = [*dense, 0, 0, 0]
    cuts = [0, *(i for i in range(1, len(full)) if full[i] != full[i - 1]), len(full)]
    assert got == [("x", 10 * a, min(10 * b, 10 * len(dense) + 25), float(full[a])) for a, b in zip(cuts, cuts[1:])] + [("y", 0, 40, 0.0)]
    other = dense.copy()
    other[[3, 250, 251]] += 1
    rows = lambda x: spark.createDataFrame([("x", 10 * i, 10 * i + 10, float(n)) for i, n in enumerate(x)], "chrom string, start long, end long, value float")
    whole = spark.createDataFrame([("x", 10 * a, 10 * b, float(dense[a])) for a, b in zip([0, *(np.flatnonzero(np.diff(dense)) + 1).tolist()], [*(np.flatnonzero(np.diff(dense)) + 1).tolist(), len(dense)])], "chrom string, start long, end long, value float")
    assert [tuple(r) for r in C.diff_tracks(whole, rows(other)).collect()] == [("x", 30, 30)] and C.diff_tracks(whole, rows(dense)).count() == 0


def test_overlap_against_plain_sets(spark):
    rng = np.random.default_rng(12)
    def lists():
        cut = np.cumsum(rng.integers(1, 9, 2 * rng.integers(0, 7))).tolist()
        return [(a, b) for a, b in zip(cut[::2], cut[1::2])]
    rows = [(lists(), lists()) for _ in range(200)] + [(None, [(1, 2)]), ([(1, 2)], None)]
    spec = "array<struct<s:bigint,e:bigint>>"
    df = spark.createDataFrame(rows, f"a {spec}, b {spec}").repartition(2)
    for r in df.withColumn("n", U.overlap(F.col("a"), F.col("b"))).collect():
        places = lambda x: {p for s, e in x for p in range(s, e)}
        assert r.n == (None if r.a is None or r.b is None else len(places(r.a) & places(r.b)))


def test_comparison_of_tables(spark):
    schema = "read_id string, flag int, chrom string, start double, strand string, med double"
    a = spark.createDataFrame([("a", 0, "x", 1.0, "+", 0.5), ("b", 0, "x", 1.0, "+", 0.5), ("c", 0, "x", 1.0, "+", None), ("d", 0, "x", 1.0, "+", None), ("e", 0, "x", 1.0, "+", 1.0), ("g", 0, "x", 1.0, "+", 0.0)], schema)
    b = spark.createDataFrame([("a", 0, "x", 1.0, "-", 0.7), ("b", 0, "x", 1.0, "+", 0.5 + 1e-14), ("c", 0, "x", 1.0, "+", float("nan")), ("d", 0, "x", 1.0, "+", 0.5), ("e", 0, "x", 1.0, "+", 1.0 + 1e-9), ("f", 0, "x", 1.0, "+", 1.0), ("g", 0, "x", 1.0, "+", 0.0)], schema)
    got = {r.read_id: r.column for r in compare_mappings(a, b, ["strand"], ["med"]).collect()}
    assert got == {"a": "strand", "d": "med", "e": "med"}
    assert sorted((r.read_id, r.side) for r in key_difference(a, b, ["read_id"]).collect()) == [("f", "right")]
