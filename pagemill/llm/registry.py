"""Queries of problems 2 to 8, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import confusables, garbled, leaks, reading, repeats, scans, tokens
from pagemill.llm.sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of noise on each scanned page: page_id, noise."""
    return scans.found_noise(_table(spark, sf_dir, "pages"))


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page, scanned ones as continuous corrected paragraphs: page_id, text."""
    return scans.repaired(_table(spark, sf_dir, "pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of lines repeated within their source: page_id, line_no."""
    return repeats.repeated_lines(_table(spark, sf_dir, "pages"))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page without the lines repeated in its source: page_id, text, n_removed."""
    return repeats.remove_repeated(_table(spark, sf_dir, "pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with wrongly decoded text: page_id."""
    return garbled.found_pages(_table(spark, sf_dir, "pages"))


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page with its garbled text restored as far as it survived: page_id, text, n_restored."""
    return garbled.restored_pages(_table(spark, sf_dir, "pages"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of visually identical differences on each page: page_id, form."""
    return confusables.found_forms(_table(spark, sf_dir, "pages"))


def p5_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page in its one form: page_id, text, skeleton_key."""
    return confusables.normalized(_table(spark, sf_dir, "pages"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of each document by byte_bpe_50k: doc_id, ids."""
    return tokens.encode(_table(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the test items they hold: doc_id, item_id."""
    return leaks.leaked_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest verbatim match of each leaked pair and its places: doc_id, item_id, n_words, doc_word, item_word."""
    return leaks.longest_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without leaks: doc_id, text."""
    return leaks.without_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items")).select("doc_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading band of each document of at least 25 words: doc_id, band."""
    return reading.reading_bands(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "reading_labels"))


QUERIES = {
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p3_found": p3_found,
    "p3_clean": p3_clean,
    "p4_found": p4_found,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p5_normalized": p5_normalized,
    "p6_ids": p6_ids,
    "p7_found": p7_found,
    "p7_longest": p7_longest,
    "p7_clean": p7_clean,
    "p8_found": p8_found,
}
