"""Modification signal: tag decoding, base-to-reference mapping, bins and medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import moved, places_of, running_before, spread
from ..functions.numerics import exact_mean, mean_f64
from ..functions.params import ModSpec, Params
from ..functions.summaries import signal_summary
from . import filters as L
from .cigar import query_intervals, with_walk

#: Complements of the four bases; others stand for themselves (fixed values).
PLUS, MINUS = "ACGT", "TGCA"


def code_count(entry: Column) -> Column:
    """Modifications that an entry code, such as ``C+mh?``, names: letters count one each, a ChEBI number or nothing one."""
    codes = _codes(entry)
    return F.when(codes.rlike("^[0-9]*$"), 1).otherwise(F.length(codes))


def _codes(entry: Column) -> Column:
    return F.regexp_replace(F.substring(entry, 3, 1 << 20), "[.?]$", "")


def code_slot(entry: Column, spec: ModSpec) -> Column:
    """Place of the specification's code in an entry from 0 on, or null without match."""
    codes, number = _codes(entry), spec.code.isdigit()
    fits = (F.length(entry) >= 3) & entry.startswith(f"{spec.base}+") & (F.length(codes) > 0)
    digits = codes.rlike("^[0-9]+$")
    if number:
        return F.when(fits & digits & (codes == spec.code), F.lit(0))
    return F.when(fits & ~digits & (F.instr(codes, spec.code) > 0), F.instr(codes, spec.code) - 1)


_ENTRY = "array<struct<entry_ix:int,code:string,skips:array<string>,n_codes:int,ml_offset:bigint>>"


def with_entries(records: DataFrame) -> DataFrame:
    """Adds ``entries``: code, skips, n_codes and ml_offset of each entry of MM; the offset counts all values before."""
    texts = F.filter(F.split(F.regexp_replace("mm", ";$", ""), ";"), lambda e: e != "")
    parts = F.transform(texts, lambda e: F.split(e, ","))
    rows = records.withColumn("_parts", F.transform(parts, lambda p: F.struct(p[0].alias("code"), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))).alias("skips"), code_count(p[0]).cast("int").alias("n"))))
    rows = rows.withColumn("_before", running_before(F.transform("_parts", lambda p: (F.size(p["skips"]) * p["n"]).cast("bigint"))))
    entries = F.transform("_parts", lambda p, i: F.struct(i.alias("entry_ix"), p["code"], p["skips"], p["n"].alias("n_codes"), F.get("_before", i).alias("ml_offset")))
    return rows.withColumn("entries", entries.cast(_ENTRY)).drop("_parts", "_before")


def modification_entries(records: DataFrame) -> DataFrame:
    """ordinal and the fields of each entry, as rows."""
    return with_entries(records.select("ordinal", "mm")).select("ordinal", F.inline("entries"))


def with_chosen(records: DataFrame, spec: ModSpec) -> DataFrame:
    """Adds ``chosen``: of a record's ``entries`` the first that matches, with the code's slot and whether unreported bases are
    dropped; null without match."""
    fits = F.filter("entries", lambda e: code_slot(e["code"], spec).isNotNull())
    rows = records.withColumn("_e", F.get(fits, F.lit(0)))
    drops = F.col("_e.code").endswith("?") | F.lit(spec.base == "N")
    fields = [F.col(f"_e.{c}").alias(c) for c in ("code", "skips", "n_codes", "ml_offset")]
    return rows.withColumn("chosen", F.when(F.col("_e").isNotNull(), F.struct(*fields, code_slot(F.col("_e.code"), spec).alias("slot"), drops.alias("drops")))).drop("_e")


def with_calls(records: DataFrame) -> DataFrame:
    """Adds ``calls`` of the chosen entry: idx (1-based among target bases) and at (0-based place in ML) of each.

    A skip that is no whole number ends the scan; calls before it stand."""
    steps = F.transform("chosen.skips", lambda s: F.trim(s).try_cast("bigint") + 1)
    rows = records.withColumn("_steps", steps)
    broken = F.array_position(F.transform("_steps", lambda x: F.coalesce(x < 1, F.lit(True))), True)
    rows = rows.withColumn("_steps", F.when(broken > 0, F.slice("_steps", F.lit(1), (broken - 1).cast("int"))).otherwise(F.col("_steps")))
    rows = rows.withColumn("_before", running_before("_steps"))
    at = lambda i: (F.col("chosen.ml_offset") + i * F.col("chosen.n_codes") + F.col("chosen.slot")).cast("bigint")
    return rows.withColumn("calls", F.transform("_steps", lambda x, i: F.struct((F.get("_before", i) + x).alias("idx"), at(i).alias("at")))).drop("_steps", "_before")


def call_indexes(records: DataFrame, spec: ModSpec) -> DataFrame:
    """ordinal, i (from 0), idx and at of each call of a specification, as rows."""
    rows = with_calls(with_chosen(with_entries(records), spec))
    return rows.select("ordinal", F.posexplode("calls").alias("i", "c")).select("ordinal", "i", "c.idx", "c.at")


def _reverse() -> Column:
    return F.col("flag").bitwiseAND(L.REVERSE) != 0


def with_targets(records: DataFrame, spec: ModSpec, where: Column | None = None) -> DataFrame:
    """Adds ``targets``: the places (1-based in the stored sequence) of the bases a code can be on, in reading direction; none of
    records for which ``where`` does not hold."""
    other = spec.base.translate(str.maketrans(PLUS, MINUS))
    letter = F.lit(None).cast("string") if spec.base == "N" else F.when(_reverse(), other).otherwise(spec.base)
    seq = F.col("seq") if where is None else F.when(where, F.col("seq"))
    return records.withColumn("targets", places_of(seq, letter)).withColumn("targets", F.when(_reverse(), F.reverse("targets")).otherwise(F.col("targets")))


def target_bases(records: DataFrame, spec: ModSpec) -> DataFrame:
    """ordinal, j (1-based in the stored sequence) and idx (1-based in reading direction) of the bases a code can be on, as rows."""
    rows = with_targets(records, spec).select("ordinal", F.posexplode("targets").alias("p", "j"))
    return rows.select("ordinal", "j", (F.col("p") + 1).alias("idx"))


def with_signal(records: DataFrame, spec: ModSpec) -> DataFrame:
    """Adds ``signal``, the reference places r and codes of reported bases that lie in an M block and within [start, end], in
    reading direction, and ``overflow``, whether the calls run past the target bases, which leaves no signal.

    Takes records with entries, blocks, read_length, start and end; everything happens within the row."""
    rows = with_calls(with_chosen(records, spec))
    rows = with_targets(rows, spec, F.col("chosen").isNotNull())
    rows = rows.withColumn("overflow", F.coalesce(F.try_element_at("calls.idx", F.lit(-1)) > F.size("targets"), F.lit(False)))
    # a call whose value lies past ML's end leaves its base unreported
    values = F.transform("calls", lambda c: F.try_element_at("ml", (c["at"] + 1).cast("int")).cast("int"))
    default = F.when(F.col("chosen.drops"), F.lit(None).cast("int")).otherwise(0)
    size = F.when(F.col("chosen").isNotNull() & ~F.col("overflow"), F.size("targets")).otherwise(0)
    shift = F.when(_reverse(), F.col("read_length") - F.col("l_seq")).otherwise(0).cast("bigint")
    block = lambda name: F.transform("blocks", lambda b: b[name])
    rows = rows.withColumn("_codes", spread(size, "calls.idx", values, default))
    rows = rows.withColumn("_places", moved(F.transform("targets", lambda j: j + shift), block("q"), block("len"), block("r")))
    found = F.zip_with(F.slice("_places", F.lit(1), F.size("_codes")), "_codes", lambda r, c: F.struct(r.alias("r"), c.alias("code")))
    inside = F.filter(found, lambda x: x["code"].isNotNull() & x["r"].between(F.col("start"), F.col("end")))
    return rows.withColumn("signal", inside).drop("_codes", "_places", "targets", "calls", "chosen")


def bin_start(r: Column, bin_size: int) -> Column:
    return ((r - 1) - F.pmod(r - 1, F.lit(bin_size)) + 1).cast("bigint")


def signal_bins(calls: DataFrame, keys: list[str], bin_size: int = 1000, binarise: float | None = None, float_mode: str = "x87") -> DataFrame:
    """keys, bin_position and signal: R's mean of each occupied bin. Codes of a bin are counted first, so at most 256 rows of a
    bin are shuffled; 64-bit mode depends on the order of positions and gathers a bin's codes instead."""
    rows = calls.withColumn("bin_position", bin_start(F.col("r"), bin_size))
    cell = [*keys, "bin_position"]
    probability = F.col("code") / F.lit(255.0)
    value = probability if binarise is None else F.when(probability < binarise, 0.0).otherwise(1.0)
    if float_mode == "f64":
        gathered = rows.groupBy(*cell).agg(F.array_sort(F.collect_list(F.struct("r", value.alias("v")))).alias("x"))
        return gathered.select(*cell, mean_f64(F.transform("x", lambda s: s["v"])).alias("signal"))
    if binarise is not None:
        return rows.groupBy(*cell).agg((F.sum(value) / F.count("*")).alias("signal"))
    return rows.groupBy(*cell).agg(exact_mean(F.col("code")).alias("signal"))


def _medians(rows: DataFrame, keys: list[str], name: str, float_mode: str) -> DataFrame:
    """keys and R's median of ``_v``; an even count takes the mean of the middle two, in the mode's arithmetic."""
    if float_mode != "f64":
        return rows.groupBy(*keys).agg(F.median("_v").alias(name))
    low, high = F.expr("percentile_disc(0.5) within group (order by _v)"), F.expr("percentile_disc(0.5) within group (order by _v desc)")
    middle = rows.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"))
    return middle.select(*keys, mean_f64(F.array("_low", "_high")).alias(name))


def median_signal(calls: DataFrame, keys: list[str], float_mode: str = "x87") -> DataFrame:
    """keys and med_signal: median of code / 255, never binarised."""
    return _medians(calls.withColumn("_v", F.col("code") / F.lit(255.0)), keys, "med_signal", float_mode)


def median_bins(bins: DataFrame, keys: list[str], float_mode: str = "x87") -> DataFrame:
    return _medians(bins.withColumn("_v", F.col("signal")), keys, "med_signalbin", float_mode)


def candidates(records: DataFrame, params: Params) -> DataFrame:
    """Records that may carry signal: all row filters before tags are decoded."""
    rows = L.exclude_prefixes(L.mapped(records), params.exclude_prefix)
    rows = L.sa_agrees(L.has_tags(L.exact_flags(rows, params.supplementary)))
    return L.with_span(rows, params.min_len)


def extract(records: DataFrame, params: Params) -> DataFrame:
    """One row for each candidate: its place, m_query, the found signal of each modification as ``signals`` (mod, signal), and
    how many modifications overflowed. Narrow: nothing is shuffled."""
    rows = with_entries(with_walk(candidates(records, params))).withColumn("m_query", query_intervals())
    kept = ["ordinal", "read_id", "flag", "ref_id", "chrom", L.strand().alias("strand"), "start", "end", "m_query"]
    names = []
    for k, spec in enumerate(params.mods):
        rows = with_signal(rows, spec).withColumnsRenamed({"signal": f"_signal{k}", "overflow": f"_over{k}"})
        # a read without any aligned block has no signal
        names.append(F.struct(F.lit(spec.name).alias("mod"), F.when(F.col("read_length").isNotNull(), F.col(f"_signal{k}")).alias("signal")))
    found = F.filter(F.array(*names), lambda s: F.size(s["signal"]) > 0)
    over = sum((F.col(f"_over{k}") & F.col("read_length").isNotNull()).cast("int") for k in range(len(params.mods)))
    return rows.select(*kept, found.alias("signals"), over.alias("overflows"))


def with_summary(rows: DataFrame, columns: list[str], mods, bin_size: int = 1000, binarise: float | None = None, float_mode: str = "x87") -> DataFrame:
    """Adds signalbin, an array of (positions, signal<code>...) aligned on bins, and the medians of the signal columns (arrays of r and
    code, one for each modification), all within the row.

    With one modification the medians have plain names, with several the code is appended. A modification without value in a bin
    is null there, so columns of several modifications always line up."""
    found = rows.withColumn("_summary", signal_summary([m.code for m in mods], bin_size, binarise, float_mode)(*columns))
    names = found.schema["_summary"].dataType.names
    return found.withColumns({c: F.col(f"_summary.{c}") for c in names}).drop("_summary")


def nested_rows(extracted: DataFrame, params: Params) -> DataFrame:
    """One row for each mapping of an extracted table, with its nested signal and medians. Narrow: nothing is shuffled."""
    rows = extracted.where(F.size("signals") > 0).drop("overflows")
    columns = [f"_signal{k}" for k in range(len(params.mods))]
    own = lambda m: F.get(F.filter("signals", lambda s: s["mod"] == m.name), F.lit(0))["signal"]
    rows = rows.withColumns({c: own(m) for c, m in zip(columns, params.mods)}).drop("signals")
    return with_summary(rows, columns, params.mods, params.bin_size, params.binarise, params.float_mode).drop(*columns)


def parts(extracted: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mappings, bins, calls) of an extracted table, which is read for each of them: bins and calls are long, by ordinal and mod."""
    found = extracted.where(F.size("signals") > 0)
    calls = found.select("ordinal", F.inline("signals")).select("ordinal", "mod", F.inline("signal"))
    bins = signal_bins(calls, ["ordinal", "mod"], params.bin_size, params.binarise, params.float_mode)
    return found.drop("signals", "overflows"), bins, calls


def mappings(records: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mappings, bins, calls) before the supplementary filter."""
    return parts(extract(records, params), params)


def nested(maps: DataFrame, bins: DataFrame, calls: DataFrame, mods, float_mode: str = "x87") -> DataFrame:
    """As :func:`with_summary`, from long tables of bins and calls whose mappings may have any number of rows."""
    single = len(mods) == 1
    wide = bins.groupBy("ordinal", "bin_position").agg(*[F.max(F.when(F.col("mod") == m.name, F.col("signal"))).alias(f"signal{m.code}") for m in mods])
    cells = wide.groupBy("ordinal").agg(F.array_sort(F.collect_list(F.struct(F.col("bin_position").alias("positions"), *[f"signal{m.code}" for m in mods]))).alias("signalbin"))
    out = maps.join(cells, "ordinal")
    for m in mods:
        tail = "" if single else m.code
        one = calls.where(F.col("mod") == m.name)
        medians = median_signal(one, ["ordinal"], float_mode).join(median_bins(bins.where(F.col("mod") == m.name), ["ordinal"], float_mode), "ordinal")
        out = out.join(medians.select("ordinal", F.col("med_signal").alias(f"med_signal{tail}"), F.col("med_signalbin").alias(f"med_signalbin{tail}")), "ordinal", "left")
    return out
