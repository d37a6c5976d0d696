"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled by a seeded hash within each source and ranked there; (rank - 1/2) / rows of the source is a row's
fractional rank. Sorted by fractional rank, every stretch of the table mixes the sources in their overall proportion,
so cutting it into equal stretches gives shards that match the mixture.

No rank is taken over a whole source or table in one task: ranks come from row numbers within buckets of the shuffle
hash (or of the fractional rank) plus running totals of the small tables of bucket counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the shuffle hash for each source, and of the fractional rank. A bucket holds about 1/4096 of a source.
BUCKETS = 4096


def _before(counts: DataFrame, part: list[str], order: str) -> DataFrame:
    """Rows in the buckets before, within ``part``."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def shard_rows(
    docs: DataFrame, *, shards: int = 16, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot and grown_shard of every row.

    Law ``rows``: shard counts differ by at most one. Size is the UTF-8 bytes of the text plus 1; a null text counts as
    empty (size 1, crc32 0). A null source is a source of its own, a null doc_id hashes as empty text. Repeated rows are
    ranked one after the other. Very long texts are sized and hashed whole. An empty table gives no rows. Only the three named columns are read.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        (F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text_crc32").cast("string")).cast("binary")))
    rows = rows.withColumns({
        "stratum": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
        "bucket": F.conv(F.substring("key", 1, 3), 16, 10).cast("int"),
    })

    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    totals = Window.partitionBy("stratum")
    offsets = _before(counts, ["stratum"], "bucket").select("stratum", "bucket", "before", F.sum("n").over(totals).alias("total"))

    local = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id")
    ranked = rows.withColumn("k", F.row_number().over(local)).join(offsets.hint("shuffle_hash"), ["stratum", "bucket"])
    # (2 rank - 1) / (2 total) in whole numbers: which of BUCKETS stretches the row falls in, and its place there
    twice = (2 * (F.col("before") + F.col("k")) - 1).cast("long")
    ranked = ranked.select(
        "doc_id", "source", "size", "text_crc32", "key", "stratum",
        (twice / (2 * F.col("total")).cast("double")).alias("fraction"),
        F.expr(f"cast(((2 * (before + k) - 1) * {BUCKETS}) div (2 * total) as int)").alias("stretch"),
    )

    per = ranked.groupBy("stretch").agg(F.count("*").alias("n"))
    starts = _before(per, [], "stretch").select("stretch", "before", F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("stretch").orderBy("fraction", "stratum", "key", "doc_id")
    placed = ranked.withColumn("k", F.row_number().over(within)).join(F.broadcast(starts), "stretch")  # at most BUCKETS rows
    placed = placed.withColumn("at", (F.col("before") + F.col("k") - 1).cast("long"))
    # shard s holds the positions from ceil(s * total / shards) on; whole-number division keeps this exact
    placed = placed.withColumn("shard", F.expr(f"cast((at * {shards}) div total as int)"))
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("at") - F.expr(f"((shard * total + {shards} - 1) div {shards})")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
