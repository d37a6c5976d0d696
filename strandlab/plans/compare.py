"""Comparison of result tables by key, and of two saved result files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parts import spread
from ..functions.staging import stage, unstage
from ..sources import rds

KEYS = ("read_id", "flag", "chrom", "start")
TOLERANCE = 1e-12


def key_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that only one side has, and which; missing values equal each other."""
    side = lambda df, name: df.select(*[F.col(f"`{k}`") for k in keys], F.lit(name).alias("side"))
    both = spread(side(left, "left").unionByName(side(right, "right")), *[f"`{k}`" for k in keys])
    found = both.groupBy(*[f"`{k}`" for k in keys]).agg(F.min("side").alias("side"), F.max("side").alias("_last"))
    return found.where("side = _last").drop("_last")


def _value(x):
    return F.when(~F.isnan(x), x)


def _apart(a, b):
    """Relative difference of two numbers; none where both are missing, any where one is."""
    a, b = _value(a.cast("double")), _value(b.cast("double"))
    one = a.isNull() != b.isNull()
    return F.when(one, float("inf")).when(a.isNull() | (a == b), 0.0).otherwise(F.abs(a - b) / F.greatest(F.abs(a), F.abs(b)))


def compare_mappings(left: DataFrame, right: DataFrame, exact: list[str], close: list[str], tolerance: float = TOLERANCE, keys=KEYS) -> DataFrame:
    """Rows of common keys that differ: in an exact column, or in a number by more than the relative tolerance. Missing and
    NaN values equal each other. ``column`` names the first difference."""
    keys = list(keys)
    both = left.select(*keys, F.struct(*exact, *close).alias("a")).join(right.select(*keys, F.struct(*exact, *close).alias("b")), keys)
    tests = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c) for c in exact]
    tests += [F.when(_apart(F.col(f"a.{c}"), F.col(f"b.{c}")) > tolerance, c) for c in close]
    return both.withColumn("column", F.coalesce(*tests)).where("column is not null").select(*keys, "column")


@dataclass(frozen=True)
class Check:
    """One line of a comparison."""

    what: str
    passed: bool
    detail: str = ""

    def __str__(self) -> str:
        return f"{self.what:<28} {'ok' if self.passed else 'DIFFERS':<8} {self.detail}".rstrip()


def _layout(a: rds.Index, b: rds.Index) -> list[Check]:
    """What two files say of their tables, before any row is read."""
    names = [[c.name for c in x.columns] for x in (a, b)]
    kinds = [{c.name: (c.kind, tuple(c.attributes.get("class", ()))) for c in x.columns} for x in (a, b)]
    out = [Check("columns", names[0] == names[1], ",".join(names[0]) if names[0] == names[1] else f"{','.join(names[0])} and {','.join(names[1])}")]
    other = [c for c in names[0] if c in names[1] and kinds[0][c] != kinds[1][c]]
    out += [Check("column types", not other, ",".join(other)), Check("class", a.attributes.get("class") == b.attributes.get("class")), Check("rows", a.rows == b.rows, f"{a.rows} and {b.rows}")]
    right = {c.name: c for c in b.columns}
    for c in a.columns:
        d = right.get(c.name)
        if d and ("levels" in c.attributes or "levels" in d.attributes):
            out.append(Check(f"{c.name} levels", c.attributes.get("levels") == d.attributes.get("levels")))
        if d and (c.inner or d.inner):
            out.append(Check(f"{c.name} attributes", c.inner_attributes == d.inner_attributes))
    return out


def compare_files(spark: SparkSession, left: str, right: str, chroms: list[str] | None = None, tolerance: float = TOLERANCE) -> list[Check]:
    """Compare two saved tables of mappings: columns, types, class, factor levels, rows, keys, and for common keys the plain columns, the
    medians and the signal within ``tolerance``, and the nested positions. With ``chroms`` only rows of these count.

    Rows of equal keys are matched in the order of the files. One pass over the joined tables gives all counts."""
    a, b = rds.index_rds(left), rds.index_rds(right)
    out = _layout(a, b)
    missing = [k for k in KEYS if any(k not in [c.name for c in x.columns] for x in (a, b))]
    if missing:
        return [*out, Check("keys", False, f"no {','.join(missing)}")]

    def rows(index, side):
        df = read_rds_rows(spark, index, chroms)
        return stage(df.select(*KEYS, "_copy", F.struct(*[c for c in df.columns if c not in (*KEYS, "_copy")]).alias(side)), f"compare-{side}")

    x, y = rows(a, "a"), rows(b, "b")
    both = x.join(y, [*KEYS, "_copy"], "full_outer")
    types = [{c.name: c for c in i.columns} for i in (a, b)]
    common = [c.name for c in a.columns if c.name in types[1] and types[1][c.name].kind == c.kind and c.name not in KEYS]
    paired = F.col("a").isNotNull() & F.col("b").isNotNull()
    sums = {"only_left": F.count_if(F.col("b").isNull()), "only_right": F.count_if(F.col("a").isNull()), "both": F.count_if(paired)}
    exact, close, nested = [], [], []
    for c in common:
        p, q = F.col(f"a.{c}"), F.col(f"b.{c}")
        if types[0][c].kind == rds.LIST:
            if types[0][c].inner != types[1][c].inner:
                continue
            place, *signals = types[0][c].inner or ["positions"]
            nested.append((c, signals))
            same = F.transform(p, lambda z: z[place]) == F.transform(q, lambda z: z[place])
            sums[f"{c}:positions"] = F.count_if(paired & ~F.coalesce(same, F.lit(False)))
            for s in signals:
                apart = F.array_max(F.zip_with(p, q, lambda u, v: _apart(u[s], v[s])))
                sums[f"{c}:{s}"] = F.max(F.when(paired & same, F.coalesce(apart, F.lit(0.0))))
                sums[f"{c}:{s}:bits"] = F.count_if(paired & same & (F.coalesce(apart, F.lit(0.0)) == 0))
        elif c.startswith("med_signal"):
            close.append(c)
            sums[c], sums[f"{c}:bits"] = F.max(F.when(paired, _apart(p, q))), F.count_if(paired & (_apart(p, q) == 0))
        else:
            exact.append(c)
            sums[c] = F.count_if(paired & ~p.eqNullSafe(q))
    got = both.agg(*[v.alias(k) for k, v in sums.items()]).first().asDict()
    unstage(x, y)
    out.append(Check("keys", not got["only_left"] and not got["only_right"], f"{got['both']} common, {got['only_left']} only left, {got['only_right']} only right"))
    out += [Check(c, not got[c], f"{got[c]} differ" if got[c] else "") for c in exact]
    far = lambda c: Check(c.split(":")[-1], (got[c] or 0.0) <= tolerance, f"largest difference {got[c] or 0.0:.3g}, equal to the bit {got[c + ':bits']} of {got['both']}")
    out += [far(c) for c in close]
    for c, signals in nested:
        out.append(Check(f"{c} positions", not got[f"{c}:positions"], f"{got[f'{c}:positions']} differ" if got[f"{c}:positions"] else ""))
        out += [far(f"{c}:{s}") for s in signals]
    return out


def read_rds_rows(spark: SparkSession, index: rds.Index, chroms: list[str] | None) -> DataFrame:
    """Rows of a file with ``_copy``, their number among rows of the same key."""
    df = rds.read_rds(spark, index.path, index)
    df = df if chroms is None else df.where(F.col("chrom").isin(chroms))
    return df.withColumn("_copy", F.row_number().over(Window.partitionBy(*KEYS).orderBy("row"))).drop("row")
