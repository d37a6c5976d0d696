"""Alignment-shaped, call-shaped and tag-shaped tables made from the test tables by SQL that both engines accept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parts import spread
from ..operators.cigar import parse_cigar

_AL0 = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber ln, cast(l_quantity as bigint) q, l_returnflag rf,
       row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
                          l_extendedprice, l_shipdate, l_quantity, l_returnflag) k
from lineitem
"""

#: Alignments. flag_x adds unmapped, secondary and duplicate bits; cigar_x swaps operations that only one dialect counts.
ALIGN = f"""
select concat('read', cast(l_orderkey as string)) read_id, cast(l_orderkey % 17 as int) ref_id,
       concat('chr', cast(l_orderkey % 17 + 1 as string)) chrom, cast(k as int) k, l_orderkey * 64 + k ordinal,
       cast(case when k = 1 then 0 else 2048 end + case when rf = 'R' then 16 else 0 end as int) flag,
       cast(case when k = 1 then 0 else 2048 end + case when rf = 'R' then 16 else 0 end
         + case l_suppkey % 13 when 0 then 4 when 1 then 256 when 2 then 1024 else 0 end as int) flag_x,
       cast(l_partkey * 25 as int) pos,
       concat(cast(case when k % 3 = 0 then 0 else (k-1)*60 end + l_suppkey % 7 as string), 'S',
              cast(q as string), 'M', cast(ln as string), 'I', cast(q as string), 'M',
              cast(l_partkey % 60 as string), 'D', cast(q as string), 'M') cigar_text,
       concat(cast(l_suppkey % 7 as string), 'S', cast(q as string), case when k % 4 = 1 then '=' else 'M' end,
              cast(l_partkey % 60 as string), case when k % 5 = 2 then 'N' else 'D' end, cast(q as string), 'M',
              cast(ln as string), case when k % 3 = 1 then 'X' else 'I' end, cast(l_suppkey % 4 as string), case when k % 2 = 1 then 'S' else 'H' end) cigar_x,
       case when l_partkey % 10 = 0 then null
            else concat('chr', cast(l_orderkey % 17 + 1 as string), ',1,',
                        case when (rf = 'R') <> (l_suppkey % 9 = 0) then '-' else '+' end, ',10M,60,0') end sa
from ({_AL0}) al0
"""

EVENT_SPARK = "select concat('u', cast(user_id as string)) read_id, cast(floor((unix_micros(cast(ts as timestamp)) / 1000000 - 1704067200) / 60) as bigint) + 1 r, cast(floor(value) as int) % 256 code from events"
EVENT_DUCK = "select concat('u', cast(user_id as string)) read_id, cast(floor((epoch_us(ts) / 1000000 - 1704067200) / 60) as bigint) + 1 r, cast(floor(value) as int) % 256 code from events"

#: Tags. rel and ml are lists of whole numbers; mm is the text of two entries, the second of which follows the first in ML.
MOD_SPARK = """
select vec_id ordinal, case when vec_id % 2 = 0 then 'C+mh?' else 'C+mh.' end entry,
       transform(slice(embedding, 1, 32), x -> cast(floor(abs(cast(x as double)) * 1000) as bigint) % 4) rel,
       transform(embedding, x -> cast(cast(floor(abs(cast(x as double)) * 1000) as bigint) % 256 as int)) ml
from embeddings
"""
MOD_DUCK = """
select vec_id ordinal, case when vec_id % 2 = 0 then 'C+mh?' else 'C+mh.' end entry,
       list_transform(embedding[1:32], lambda x: cast(floor(abs(cast(x as double)) * 1000) as bigint) % 4) rel,
       list_transform(embedding, lambda x: cast(cast(floor(abs(cast(x as double)) * 1000) as bigint) % 256 as int)) ml
from embeddings
"""

_LETTERS, _BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
#: Sequences of whole texts.
SEQ_SPARK = f"select doc_id ordinal, cast(case when doc_id % 2 = 1 then 16 else 0 end as int) flag, translate(regexp_replace(lower(text), '[^a-z]', ''), '{_LETTERS}', '{_BASES}') seq from documents"
SEQ_DUCK = f"select doc_id ordinal, cast(case when doc_id % 2 = 1 then 16 else 0 end as int) flag, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{_LETTERS}', '{_BASES}') seq from documents"


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """An adapter over the tables of a folder; nothing is registered in the session."""
    names = [n for n in ("lineitem", "events", "embeddings", "documents") if f"from {n}" in sql]
    for n in names:
        sql = sql.replace(f"from {n}", f"from {{{n}}}")
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    if "lineitem" in tables:  # numbered within orders
        tables["lineitem"] = spread(tables["lineitem"], "l_orderkey")
    return spark.sql(sql, **tables)


def alignments(spark: SparkSession, sf_dir: str, extended: bool = False, parse: bool = True) -> DataFrame:
    """Alignments; ``cigar`` is parsed or, for what walks it, the text."""
    rows = frame(spark, sf_dir, ALIGN)
    flag, cigar = ("flag_x", "cigar_x") if extended else ("flag", "cigar_text")
    return rows.select("read_id", "ref_id", "chrom", "k", "ordinal", F.col(flag).alias("flag"), "pos", (parse_cigar(F.col(cigar)) if parse else F.col(cigar)).alias("cigar"), "sa", F.lit(200).alias("l_seq"))
