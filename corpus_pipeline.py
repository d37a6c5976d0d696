"""Corpus pipeline: quality filter, near-duplicate removal, repeated-substring removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; all but the last
return the columns of ``documents``. A row is kept or dropped whole by stages 1, 2 and 4; stage 3 shortens texts. Further
columns may have any name and are passed on; an empty table stays empty; texts of any length are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlab.llm.common import crc_bucket, free_name, stage, unstage
from strandlab.llm.decontaminate import contaminated, find_contamination
from strandlab.llm.jaccard_join import near_duplicate_classes
from strandlab.llm.packing import pack_documents
from strandlab.llm.quality import fit_quality, statistics_table, training_rows, with_quality
from strandlab.llm.queries import table, tokenizer_path
from strandlab.llm.suffix_dedup import with_repeats_removed

#: Documents scored below this are rejected.
LEAST_QUALITY = 0.7


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier accepts; null and empty texts are judged like any other, repeated rows alike."""
    stats = stage(statistics_table(docs), "statistics")
    model = fit_quality(training_rows(stats, table(spark, sf_dir, "labels"), crc_bucket("doc_id", 4) != 2, "quality"))
    score = free_name(docs.columns, "score")
    return _columns(with_quality(docs, model, score_col=score).where(F.col(score) >= LEAST_QUALITY), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component; rows without id, rows without words, and repeated rows of one
    id, stay."""
    found = near_duplicate_classes(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return _columns(docs.join(found, "doc_id", "left_anti"), docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated 50-byte strings; a text left without any character goes, others keep their remaining text.

    Removal works on bytes and may cut a character in two: what is left of such a character is replaced. Rows with one id
    and several texts keep their own."""
    return with_repeats_removed(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents; null and empty texts stay, repeated rows are judged alike."""
    name = free_name(docs.columns, "contamination")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), result_col=name)
    return _columns(found.where(~contaminated(F.col(name))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places; a null or empty text is one token, repeated rows are packed row by row."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder and read by the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, last = stage(docs, name), before
            before = docs
            unstage(last)
    return docs
