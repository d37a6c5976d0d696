"""Registered queries over the test tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.params import ModSpec
from ..operators import coverage as C
from ..operators import filters as L
from ..operators import signal as S
from ..operators import supplementary as U
from ..functions.staging import stage
from ..operators.cigar import query_intervals, signal_blocks, with_blocks, with_placed_blocks, with_read_length
from . import adapters as A
from .compare import compare_mappings, key_difference

QUERIES: dict = {}
ORACLES: dict = {}

#: Alignments and their operations, numbered, for the oracle.
_AL = f"with al as ({A.ALIGN}), "


def _ops(cigar: str, source: str = "al") -> str:
    return f"""ops as (
  select *, cast(regexp_extract(t, '^[0-9]+') as bigint) len, right(t, 1) op from (
    select *, unnest(regexp_extract_all({cigar}, '[0-9]+[MIDNSHP=X]')) t, unnest(range(len(regexp_extract_all({cigar}, '[0-9]+[MIDNSHP=X]')))) ix from {source})
)"""


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


@_query(_AL + "x as (select 1) select read_id, k, flag_x flag from al where (flag_x & 260) = 0 and ref_id >= 0 and flag_x in (0, 16, 2048, 2064)")
def mapped_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.exact_flags(L.mapped(A.alignments(spark, sf_dir, True))).select("read_id", "k", "flag")


@_query(_AL + "x as (select 1) select read_id, k, chrom from al where not starts_with(chrom, 'chr1') and not starts_with(chrom, 'chrM')")
def exclude_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.exclude_prefixes(A.alignments(spark, sf_dir), ["chr1", "chrM", ""]).select("read_id", "k", "chrom")


@_query(_AL + _ops("cigar_x") + ", s as (select read_id, k, pos, sum(case when op in ('M', 'D') then len else 0 end) n from ops group by all) select read_id, k, cast(pos + 1 as bigint) as \"start\", cast(pos + n as bigint) as \"end\" from s where n - 1 > 60")
def ref_span_min_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.with_span(A.alignments(spark, sf_dir, True), 60).select("read_id", "k", "start", "end")


_BEFORE = "over (partition by ordinal order by ix rows between unbounded preceding and 1 preceding)"


@_query(_AL + _ops("cigar_x") + f""", p as (
  select ordinal, op, len, 1 + coalesce(sum(case when op in ('M', 'I', 'S') then len else 0 end) {_BEFORE}, 0) q,
         pos + 1 + coalesce(sum(case when op in ('M', 'D', 'N') then len else 0 end) {_BEFORE}, 0) r from ops)
select ordinal, cast(q as bigint) q, len, cast(r as bigint) r from p where op = 'M'""")
def cigar_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_blocks(A.alignments(spark, sf_dir, True, parse=False)).select("ordinal", "q", "len", "r")


@_query(_AL + _ops("cigar_x") + """, n as (
  select ordinal, flag_x flag, sum(case when op in ('M', 'I', 'S') then len else 0 end) walked, max(case when op = 'M' then ix end) last_m, arg_max(op, ix) op, arg_max(len, ix) len from ops group by all
), m as (
  select ordinal, sum(case when op in ('M', 'I', 'S') then len else 0 end) done from ops join (select ordinal, last_m from n) using (ordinal) where ix <= last_m group by ordinal
)
select n.ordinal, cast(case when op = 'S' and len > 0 then walked else done end as bigint) read_length,
  cast(case when (flag & 16) <> 0 then case when op = 'S' and len > 0 then walked else done end - 200 else 0 end as bigint) shift
from n left join m using (ordinal) where (op = 'S' and len > 0) or done is not null""")
def read_length_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_read_length(A.alignments(spark, sf_dir, True, parse=False).select("ordinal", "flag", "l_seq", "cigar")).where("read_length is not null")
    shift = F.when(F.col("flag").bitwiseAND(L.REVERSE) != 0, F.col("read_length") - F.col("l_seq")).otherwise(0)
    return rows.select("ordinal", "read_length", shift.cast("bigint").alias("shift"))


def _cov(cigar: str, flag: str, where: str = "true") -> str:
    return f"""bl as (
  select ordinal, ref_id, op, len, pos + coalesce(sum(case when op in ('M', '=', 'X', 'D', 'N') then len else 0 end) {_BEFORE}, 0) s from ops where ({flag} & 260) = 0 and {where}
), bins as (
  select distinct ordinal, ref_id, unnest(range(cast(floor(s / 50) as bigint), cast(ceil((s + len) / 50) as bigint))) bin from bl where op in ('M', '=', 'X') and len > 0
), cov as (select ref_id, bin, count(*) n from bins group by all)"""


@_query(_AL + _ops("cigar_x") + ", " + _cov("cigar_x", "flag_x") + " select ref_id, bin, n from cov")
def coverage_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage_bins(L.mapped(A.alignments(spark, sf_dir, True, parse=False)), 50).select("ref_id", "bin", "n")


def _refs(edges: DataFrame) -> DataFrame:
    """References whose lengths end 30 bases after the last occupied bin, which is the one before the last edge."""
    return edges.groupBy("ref_id").agg((F.max("bin") * 50 + 30).cast("bigint").alias("length")).withColumn("chrom", F.concat(F.lit("chr"), (F.col("ref_id") + 1).cast("string")))


@_query(_AL + _ops("cigar_x") + ", " + _cov("cigar_x", "flag_x") + """, refs as (select ref_id, max(bin) * 50 + 80 length from cov group by ref_id),
grid as (select ref_id, length, unnest(range(cast(ceil(length / 50) as bigint))) bin from refs),
dense as (select g.ref_id, g.length, g.bin, coalesce(n, 0) n from grid g left join cov using (ref_id, bin)),
mark as (select *, case when n = lag(n) over (partition by ref_id order by bin) then 0 else 1 end new from dense),
runs as (select *, sum(new) over (partition by ref_id order by bin) run from mark)
select concat('chr', cast(ref_id + 1 as varchar)) chrom, cast(min(bin) * 50 as bigint) as "start", cast(least((max(bin) + 1) * 50, max(length)) as bigint) as "end", cast(min(n) as float) as "value"
from runs group by ref_id, run""")
def coverage_dense_rle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.mapped(A.alignments(spark, sf_dir, True, parse=False))
    edges = stage(C.coverage_edges(rows, 50), "edges")
    return C.coverage_intervals(edges, _refs(edges), 50).select("chrom", "start", "end", "value")


@_query(_AL + "two as (select *, k % 2 half from al), " + _ops("cigar_x", "two") + ", " + _cov("cigar_x", "flag_x").replace("select ordinal, ref_id, op,", "select half, ordinal, ref_id, op,").replace("distinct ordinal", "distinct half, ordinal").replace("select ref_id, bin, count(*) n from bins", "select half, ref_id, bin, count(*) n from bins") + """,
a as (select ref_id, bin, n from cov where half = 0), b as (select ref_id, bin, n from cov where half = 1),
d as (select coalesce(a.ref_id, b.ref_id) ref_id, coalesce(a.bin, b.bin) bin from a full join b using (ref_id, bin) where a.n is distinct from b.n)
select concat('chr', cast(ref_id + 1 as varchar)) chrom, cast(count(*) * 50 as bigint) diff_bases, cast(min(bin) * 50 as bigint) first_diff from d group by ref_id""")
def coverage_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.mapped(A.alignments(spark, sf_dir, True, parse=False)).withColumn("half", F.col("k") % 2)
    runs = C.coverage_runs(stage(C.coverage_edges(rows, 50, keys=("half",)), "edges"), ("half",)).where("n > 0")

    def track(half):
        return runs.where(F.col("half") == half).select(F.concat(F.lit("chr"), (F.col("ref_id") + 1).cast("string")).alias("chrom"), (F.col("first") * 50).alias("start"), (F.col("past") * 50).alias("end"), F.col("n").cast("float").alias("value"))

    return C.diff_tracks(track(0), track(1)).select("chrom", "diff_bases", F.col("first_diff").cast("bigint").alias("first_diff"))


_MAPS = _AL + _ops("cigar_text") + f""", p as (
  select *, 1 + coalesce(sum(case when op in ('M', 'I', 'S') then len else 0 end) {_BEFORE}, 0) q from ops
), m as (
  select ordinal, read_id, ref_id, chrom, flag, sa, pos + 1 s, pos + sum(case when op in ('M', 'D') then len else 0 end) e,
    list(struct_pack(s := q, e := q + len) order by ix) filter (op = 'M') iv, sum(len) filter (op = 'M') tot
  from p group by ordinal, read_id, ref_id, chrom, flag, sa, pos
), maps as (
  select *, row_number() over (partition by ref_id, read_id order by flag, s, ordinal) place from m
  where e - s > 1 and ((flag & 2048) = 0 or (sa is not null and split_part(sa, ',', 1) = chrom and split_part(sa, ',', 3) = case when (flag & 16) <> 0 then '-' else '+' end))
)"""


def _maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_placed_blocks(L.sa_agrees(A.alignments(spark, sf_dir, parse=False)), 1)
    return rows.select("ordinal", "read_id", "ref_id", "flag", "start", "end", query_intervals().alias("m_query"))


@_query(_MAPS + " select ordinal, cast(place as integer) place, cast(first_value(s) over w as bigint) leader_start, cast(first_value(e) over w as bigint) leader_end from maps window w as (partition by ref_id, read_id order by place rows between unbounded preceding and unbounded following)")
def supp_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.with_leader(_maps(spark, sf_dir)).select("ordinal", "place", F.col("leader.start").alias("leader_start"), F.col("leader.end").alias("leader_end"))


@_query(_MAPS + """, pairs as (
  select x.ordinal, x.place, x.s, x.e, l.s ls, l.e le, l.tot, x.sa is null or l.sa is null missing,
    (select coalesce(sum(greatest(0, least(a.e, b.e) - greatest(a.s, b.s))), 0) from (select unnest(x.iv, max_depth := 2)) a, (select unnest(l.iv, max_depth := 2)) b) shared
  from maps x join maps l on l.place = 1 and l.ref_id = x.ref_id and l.read_id = x.read_id
)
select ordinal from pairs where place = 1 or ((missing or shared = tot or shared = 0) and least(abs(s - ls), abs(e - ls), abs(s - le), abs(e - le)) < 15000)""")
def supp_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.supplementary_filter(_maps(spark, sf_dir)).select("ordinal")


def _mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose MM has the adapter's entry and then an A entry of one skip."""
    rows = A.frame(spark, sf_dir, A.MOD_SPARK)
    mm = F.concat(F.col("entry"), F.lit(","), F.array_join(F.transform("rel", lambda x: x.cast("string")), ","), F.lit(";A+a?,0;"))
    return rows.select("ordinal", mm.alias("mm"), "ml")


_MOD = f"with mod as ({A.MOD_DUCK}), "
_CALLS = _MOD + "rels as (select ordinal, entry, ml, unnest(rel) rel, unnest(range(32)) i from mod), calls as (select ordinal, ml, entry, cast(i as int) i, cast(sum(rel + 1) over (partition by ordinal order by i) as bigint) idx from rels) "


@_query(_MOD + "x as (select 1) select ordinal, 0 entry_ix, entry code, 2 n_codes, cast(0 as bigint) ml_offset, 32 n_skips from mod union all select ordinal, 1, 'A+a?', 1, 64, 1 from mod")
def mm_split_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.modification_entries(_mod(spark, sf_dir))
    return e.select("ordinal", "entry_ix", "code", "n_codes", F.col("ml_offset").cast("bigint").alias("ml_offset"), F.size("skips").alias("n_skips"))


@_query(_CALLS + "select ordinal, i, idx from calls")
def mm_call_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.call_indexes(_mod(spark, sf_dir), ModSpec.parse("C+h")).select("ordinal", "i", "idx")


@_query(_CALLS + "select ordinal, idx, ml[2 * i + 2] code from calls")
def mm_call_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.with_calls(S.with_chosen(S.with_entries(_mod(spark, sf_dir)), ModSpec.parse("C+h")))
    return rows.select("ordinal", "ml", F.inline("calls")).select("ordinal", "idx", F.try_element_at("ml", (F.col("at") + 1).cast("int")).alias("code"))


_SEQ = f"seqs as ({A.SEQ_DUCK}), bases as (select ordinal, flag, unnest(string_split(seq, '')) base, unnest(range(length(seq))) + 1 j from seqs), targets as (select ordinal, flag, cast(j as bigint) j, cast(row_number() over (partition by ordinal order by case when flag = 16 then -j else j end) as integer) idx from bases where base = case when flag = 16 then 'G' else 'C' end) "


@_query("with " + _SEQ + "select ordinal, j, idx from targets")
def target_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.target_bases(A.frame(spark, sf_dir, A.SEQ_SPARK), ModSpec.parse("C+h")).select("ordinal", "j", "idx")


#: Calls placed on reads aligned as 100M 10I 17D and M to their end from position 1001 on.
_PLACED = _CALLS.rstrip() + ", " + _SEQ + """, over_end as (
  select ordinal from calls c left join (select ordinal, max(idx) n from targets group by ordinal) t using (ordinal) group by ordinal having max(idx) > max(coalesce(n, 0))
), placed as (
  select t.ordinal, t.j, t.flag, coalesce(c.ml[2 * c.i + 2], case when m.entry like '%?' then null else 0 end) code
  from targets t join mod m using (ordinal) left join calls c on c.ordinal = t.ordinal and c.idx = t.idx where t.ordinal not in (select ordinal from over_end)
), found as (select ordinal, case when j <= 100 then 1000 + j else 1007 + j end r, code from placed where code is not null and (j <= 100 or j > 110))"""


@_query(_PLACED + " select ordinal, r, code from found")
def base_to_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir).select("ordinal", F.inline("signal"))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads aligned as 100M 10I 17D and M to their end from position 1001 on, with their signal."""
    seqs = A.frame(spark, sf_dir, A.SEQ_SPARK)
    rows = seqs.join(_mod(spark, sf_dir), "ordinal").withColumn("l_seq", F.length("seq").cast("bigint")).withColumn("pos", F.lit(1000))
    step = lambda op, n: F.struct(F.lit(op).alias("op"), n.cast("bigint").alias("len"))
    long = F.array(step("M", F.lit(100)), step("I", F.lit(10)), step("D", F.lit(17)), step("M", F.greatest(F.col("l_seq") - 110, F.lit(0))))
    short = F.array(step("M", F.least(F.col("l_seq"), F.lit(100))), step("I", F.greatest(F.col("l_seq") - 100, F.lit(0))))
    rows = rows.withColumn("cigar", F.when(F.col("l_seq") > 110, long).otherwise(short))
    rows = rows.withColumn("start", F.lit(1001).cast("bigint")).withColumn("end", F.col("l_seq") + 1007)  # past every base
    # the whole read counts as walked, so a reverse read is not shifted
    rows = S.with_entries(with_blocks(rows)).withColumn("read_length", F.col("l_seq"))
    return S.with_signal(rows, ModSpec.parse("C+h"))


@_query(_PLACED + """, binned as (
  select ordinal, cast(floor((r - 1) / 200) * 200 + 1 as bigint) bin, sum(code / 255.0::double) / count(*) signal from found group by all
), nested as (
  select ordinal, cast(count(*) as bigint) n_bins, string_agg(concat(cast(bin as varchar), ':', cast(cast(round(signal * 1000000) as bigint) as varchar)), ',' order by bin) signalbin,
    round(median(signal), 9) med_signalbin from binned group by ordinal
)
select ordinal, n_bins, signalbin, round(med, 9) med_signal, med_signalbin from nested join (select ordinal, median(code / 255.0::double) med from found group by ordinal) using (ordinal)""")
def mapping_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested bins of 200 bases and medians of each read that has signal, summarised within its row."""
    mods = (ModSpec.parse("C+h"),)
    rows = S.with_summary(_placed(spark, sf_dir).where(F.size("signal") > 0), ["signal"], mods, 200)
    return rows.select("ordinal", F.size("signalbin").cast("bigint").alias("n_bins"), _cells("h"), F.round("med_signal", 9).alias("med_signal"), F.round("med_signalbin", 9).alias("med_signalbin"))


def _cells(code: str):
    cell = lambda c: F.concat(c["positions"].cast("string"), F.lit(":"), F.round(c[f"signal{code}"] * 1000000).cast("bigint").cast("string"))
    return F.array_join(F.transform("signalbin", cell), ",").alias("signalbin")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.frame(spark, sf_dir, A.EVENT_SPARK)


_EV = f"with ev as ({A.EVENT_DUCK}), bins as (select read_id, cast(floor((r - 1) / 1000) * 1000 + 1 as bigint) bin_position, sum(code / 255.0::double) / count(*) signal, avg(case when code / 255.0::double < 0.5 then 0.0 else 1.0 end) bin_signal from ev group by all) "
_KEY = ["read_id"]


@_query(_EV + "select read_id, bin_position, round(signal, 9) signal from bins")
def signal_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.signal_bins(_events(spark, sf_dir), _KEY).select("read_id", "bin_position", F.round("signal", 9).alias("signal"))


@_query(_EV + "select read_id, bin_position, round(bin_signal, 9) signal from bins")
def signal_bins_binarised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.signal_bins(_events(spark, sf_dir), _KEY, binarise=0.5).select("read_id", "bin_position", F.round("signal", 9).alias("signal"))


@_query(_EV + "select read_id, round(median(code / 255.0::double), 9) med_signal from ev group by read_id")
def med_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.median_signal(_events(spark, sf_dir), _KEY).select("read_id", F.round("med_signal", 9).alias("med_signal"))


@_query(_EV + "select read_id, round(median(signal), 9) med_signalbin from bins group by read_id")
def med_signalbin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.median_bins(S.signal_bins(_events(spark, sf_dir), _KEY), _KEY).select("read_id", F.round("med_signalbin", 9).alias("med_signalbin"))


@_query(_EV + "select read_id, cast(count(*) as bigint) n_bins, string_agg(concat(cast(bin_position as varchar), ':', cast(cast(round(signal * 1000000) as bigint) as varchar)), ',' order by bin_position) signalbin from bins group by read_id")
def signal_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _events(spark, sf_dir).withColumnRenamed("read_id", "ordinal").withColumn("mod", F.lit("T+B"))
    maps = calls.select("ordinal").distinct()
    out = S.nested(maps, S.signal_bins(calls, ["ordinal", "mod"]), calls, (ModSpec.parse("T+B"),))
    return out.select(F.col("ordinal").alias("read_id"), F.size("signalbin").cast("bigint").alias("n_bins"), _cells("B"))


@_query(_AL + """a as (select read_id, flag, chrom, pos from al where k <= 3), b as (select read_id, flag, chrom, pos from al where k >= 2)
select *, 'left' side from (select distinct * from a except select * from b) union all select *, 'right' from (select distinct * from b except select * from a)""")
def key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.alignments(spark, sf_dir)
    keys = ["read_id", "flag", "chrom", "pos"]
    return key_difference(rows.where("k <= 3"), rows.where("k >= 2"), keys)


@_query(_AL + _ops("cigar_x") + """, s as (select ordinal, flag_x flag, chrom, sa, sum(case when op in ('M', 'D') then len else 0 end) n from ops group by all)
select cast(count(*) as bigint) records,
  cast(count(*) filter (flag in (0, 16, 2048, 2064) and n - 1 > 1 and ((flag & 2048) = 0 or (sa is not null and split_part(sa, ',', 1) = chrom and split_part(sa, ',', 3) = case when (flag & 16) <> 0 then '-' else '+' end))) as bigint) candidates
from s""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, and those that may carry signal, in one pass."""
    rows = A.alignments(spark, sf_dir, True)
    fits = L.is_mapped() & L.is_plain() & L.fits_sa() & (L.span_end() - (F.col("pos") + 1) > 1)
    return rows.agg(F.count("*").alias("records"), F.count_if(fits).alias("candidates"))


def _mapping_table(rows: DataFrame, shift: float) -> DataFrame:
    value = F.col("pos") / 7.0
    return rows.select("read_id", "flag", "chrom", F.col("pos").alias("start"), F.when(F.col("k") == 3, F.col("ref_id") + 1).otherwise(F.col("ref_id")).alias("ref"), F.when(F.col("k") == 2, value * (1 + shift)).otherwise(value).alias("med"))


@_query(_AL + """keys as (select *, count(*) over (partition by read_id, flag, chrom, pos) c from al)
select read_id, flag, chrom, pos as "start", case when k = 3 then 'ref' else 'med' end "column" from keys where c = 1 and (k = 3 or (k = 2 and pos > 0))""")
def mapping_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a mappings table: the second has other references where k = 3 and medians off by 1e-9 where k = 2."""
    rows = A.alignments(spark, sf_dir)
    once = rows.withColumn("c", F.count("*").over(Window.partitionBy("read_id", "flag", "chrom", "pos"))).where("c = 1")
    left = _mapping_table(once.withColumn("k", F.lit(0)), 0.0)
    return compare_mappings(left, _mapping_table(once, 1e-9), ["ref"], ["med"])
