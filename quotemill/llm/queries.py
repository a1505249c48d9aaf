"""Registered queries of the corpus operators; digest columns come from the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import centroids, decontam, edit_counts, html_text, knn, language, mixing, sharding, simhash, spelling, substrings, toxicity, warc
from quotemill.llm.common import held_out
from quotemill.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def voronoi_top10(spark: SparkSession, folder: str) -> DataFrame:
    vectors = knn.integer_vectors(_table(spark, folder, "embeddings"))
    return knn.voronoi_top_k(vectors, F.col("vec_id") % 100 == 0, 10)


def toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    tagger = toxicity.fit_toxicity(spark, docs, _table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), tagger)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("toxicity.spans").alias("spans"),
    )


def byte_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    network = language.fit_languages(docs)
    return language.identify(docs.select("doc_id", "text"), network).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def template_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract_text(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def warc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, folder, "pages"))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def edit_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """First a count that keeps the leaves, then the edits, counted from the leaves kept."""
    none = F.lit(None).cast("array<struct<start: int, stop: int, replacement: string>>")
    docs = _table(spark, folder, "documents").select("doc_id", "text", none.alias("edits"))
    kept = edit_counts.count_edited(docs).withColumnRenamed("counted", "kept")
    counted = edit_counts.count_edited(edit_counts.with_edits(kept), known="kept")
    return counted.select(
        "doc_id",
        "counted.tokens_before",
        "counted.tokens_after",
        F.size("edits").alias("edits"),
        "counted.reencoded",
        F.size("counted.leaf_tokens").alias("leaves"),
    )


def spaced_seed_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    classes = simhash.simhash_classes(_table(spark, folder, "documents"))
    return classes.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, folder, "documents"))


def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    digest = docs.select(
        "doc_id",
        sharding.document_size(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        sharding.text_group(F.col("text")).alias("grp"),
    )
    return sharding.shard_by_bytes(digest).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def orchard_clusters(spark: SparkSession, folder: str) -> DataFrame:
    vectors = centroids.scaled_vectors(_table(spark, folder, "embeddings"))
    return centroids.cluster(vectors).select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"),
    )


def repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.vocabulary(_table(spark, folder, "documents"))
    return spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Query]:
    return {
        "op1_voronoi_top10": voronoi_top10,
        "op2_toxic_spans": toxic_spans,
        "op3_byte_language": byte_language,
        "op4_template_text": template_text,
        "op5_edit_token_counts": edit_token_counts,
        "op8_spaced_seed_leaks": spaced_seed_leaks,
        "op7_warc_roundtrip": warc_roundtrip,
        "op6_simhash_components": simhash_components,
        "op9_mixed_sources": mixed_sources,
        "op10_byte_shards": byte_shards,
        "op11_orchard_clusters": orchard_clusters,
        "op12_spelling_variants": spelling_variants,
        "op13_repeated_windows": repeated_windows,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
