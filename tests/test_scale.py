"""What a task of the alignment queries holds: Python processes and rows."""

import os
import re

import numpy as np
from pyspark.sql import functions as F

from strandlab.functions import parts as P
from strandlab.operators import filters as L
from strandlab.operators.cigar import parse_cigar, with_bin_spans, with_placed_blocks, with_walk
from strandlab.plans import queries as Q
from strandlab.plans.compare import key_difference

SMALL = "/root/testdata/sf0.001"


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def test_a_task_before_the_supplementary_window_has_one_python_process(spark):
    for query in (Q.supp_filter, Q.supp_leader):
        before = first_plan(query(spark, SMALL)).split("Exchange hashpartitioning(ref_id")[-1]
        assert before.count("ArrowEvalPython") == 1
    for query in (Q.cigar_blocks, Q.read_length_shift):
        assert first_plan(query(spark, SMALL)).count("ArrowEvalPython") == 1


def test_walks_of_texts_are_those_of_lists(spark):
    rng = np.random.default_rng(21)
    texts = ["".join(f"{rng.integers(0, 90)}{rng.choice(list('MIDNSHP=X'))}" for _ in range(rng.integers(1, 12))) for _ in range(80)]
    texts += [None, "*", "", "M", "5M3", "12S", "7Q4M", "3M" * 300]
    rows = spark.createDataFrame([(i, 11 * i, t) for i, t in enumerate(texts)], "ordinal int, pos int, cigar string").repartition(3)
    lists = rows.withColumn("cigar", parse_cigar(F.col("cigar")))
    same = lambda f, g=None: sorted(map(str, f(rows).drop("cigar").collect())) == sorted(map(str, (g or f)(lists).drop("cigar").collect()))
    assert same(with_walk) and same(lambda df: with_bin_spans(df, 7, F.lit(None)))
    for least in (-9, 1, 60):
        assert same(lambda df: with_placed_blocks(df, least).drop("blocks"), lambda df: L.with_span(df, least))
    blocks = lambda df: with_placed_blocks(df, -9).select("ordinal", "blocks").collect()
    want = {r.ordinal: r.blocks for r in with_walk(lists).collect()}
    assert len(blocks(rows)) == len(texts) and all(r.blocks == want[r.ordinal] for r in blocks(rows))


def test_partitions_are_as_many_as_the_input_needs(spark, monkeypatch):
    size = os.path.getsize(f"{SMALL}/lineitem.parquet")
    monkeypatch.setattr(P, "PART_BYTES", size // 40 + 1)
    for query, numbers in ((Q.key_diff, {"40", "80"}), (Q.supp_filter, {"40"}), (Q.supp_leader, {"40"})):
        plan = first_plan(query(spark, SMALL))
        assert set(re.findall(r"Exchange hashpartitioning\([^\n]*?, (\d+)\)", plan)) == numbers
    # nothing is sorted or joined on the files' own partitions, which are as large as Spark makes them
    assert "Join" not in first_plan(Q.key_diff(spark, SMALL)) and "Window" not in first_plan(Q.key_diff(spark, SMALL)).split("Exchange hashpartitioning(l_orderkey")[-1]
    assert P.input_bytes(spark.createDataFrame([(1,)], "a int")) is None


def test_keys_of_many_partitions_are_those_of_plain_sets(spark, tmp_path):
    rng = np.random.default_rng(5)
    names = [None, "", "a", "b", "c"]
    made = lambda: [(names[rng.integers(5)], [None, 1, 2, 3][rng.integers(4)]) for _ in range(14)]
    a, b = made(), made()
    spark.createDataFrame(a, "x string, y int").write.parquet(f"{tmp_path}/a")
    for right in (spark.createDataFrame(b, "x string, y int"), spark.createDataFrame([], "x string, y int")):
        found = [tuple(r) for r in key_difference(spark.read.parquet(f"{tmp_path}/a"), right, ["x", "y"]).collect()]
        other = set(map(tuple, right.collect()))
        assert len(found) == len(set(found)) and set(found) == {(*k, "left") for k in set(a) - other} | {(*k, "right") for k in other - set(a)}
    assert set(a) & set(b) and any(None in k for k in set(a) & set(b))
