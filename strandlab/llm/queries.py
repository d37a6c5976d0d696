"""The numbered queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # bounds the text of one Arrow batch, by rows and by bytes
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _judged(scored: DataFrame, least: float) -> DataFrame:
    from .common import crc_bucket

    held = (crc_bucket("doc_id", 4) == 2).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op1_quality_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import crc_bucket, stage
    from .quality import fit_quality, score_statistics, statistics_table, training_rows

    stats = stage(statistics_table(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels")
    model = fit_quality(training_rows(stats, labels, crc_bucket("doc_id", 4) != 2, "quality"))
    return _judged(score_statistics(stats, model), 0.7)


def op3_toxicity_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit_toxicity, with_toxicity

    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return _judged(with_toxicity(docs, model, score_col="score", keep=["doc_id"]), 0.3)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op5_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_rows

    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")


def op7_decontaminate_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated, find_contamination, item_digest

    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    c = F.col("contamination")
    return out.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), c["n_items"].alias("n_items"),
        item_digest(c["items"]).alias("items_sha256"), contaminated(c).alias("contaminated"),
    )


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op9_url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op10_jaccard_adaptive_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicate_classes

    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentence_pieces import encode_texts, ids_digest

    out = encode_texts(table(spark, sf_dir, "documents"), piece_model_path(), keep=["doc_id"])
    pieces = F.col("pieces")
    return out.select(
        "doc_id", F.size(pieces["ids"]).cast("long").alias("n_tokens"), ids_digest(pieces["ids"]).alias("ids_sha256"), F.sha2(pieces["text"], 256).alias("decoded_sha256")
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_middle import fill_in_middle, restore_texts

    out = fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    back = restore_texts(out.select("doc_id", "fim.*"), text_col="text", form_col="form")
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.col("sha256").alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_fourier, op2_suffix_dedup, op3_toxicity_subsequence, op4_voronoi_top_k, op5_pack_sum_of_squares, op6_stratified_shards, op7_decontaminate_wu_manber, op8_maxent_lm,
        op9_url_template_tree, op10_jaccard_adaptive_prefix, op11_sentence_pieces, op12_fill_in_middle, op13_phrase_collocations,
    )
}
