"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, embed_dedup, langid, licences, line_dedup, minhash_dedup, mixing, pii, prefix_trie, quality, repeats, suffix_tree, variants
from tidemark.llm.common import table
from tidemark.llm.sql import SQL  # noqa: F401  (registered with the queries)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.digest_columns(pii.find(table(spark, sf_dir, "documents")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.keep_first_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings of equal label, cosine 0.98."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document (4-word shingles, 80 per cent)."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mixture in which a source weighs the
    square root of its number of documents."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document whose whole text is one, and the known
    notices among its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = licences.known_digests(spark)
    whole = licences.scan_texts(docs, known).select("doc_id", "license_id")
    lines = licences.scan_lines(docs, known).groupBy(F.col("doc_id").alias("d")).agg(
        F.sum("n_lines").alias("n_notice_lines"),
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    return whole.join(lines, F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "doc_id", "license_id", F.coalesce("n_notice_lines", F.lit(0)).alias("n_notice_lines"),
        F.coalesce("notices", F.lit("")).alias("notices"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that start earlier elsewhere."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    turns, convs = prefix_trie.shared_openings(prefix_trie.placed(table(spark, sf_dir, "conversations")))
    return prefix_trie.with_ends_digest(prefix_trie.build(turns, convs)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of all texts."""
    return variants.variants(variants.words(table(spark, sf_dir, "documents")))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every whole text, by a suffix tree learned from
    four fifths of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(
        "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 5 = 1").alias("held_out"))
    model, counts = suffix_tree.fit(docs, "not held_out")
    return suffix_tree.score(docs, model, counts, keep=["doc_id", "held_out"])


QUERIES = {f.__name__: f for f in (op1_pii, op2_line_dedup, op3_decontamination, op4_embedding_dedup, op5_minhash_dedup,
                                    op6_quality, op7_mixing, op8_licences, op9_repeats, op10_language, op11_prefix_trie,
                                    op12_spelling_variants, op13_lm_scores)}
