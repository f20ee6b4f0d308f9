"""The registered queries: each operator over its whole table, reduced to the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.fingerprints import fingerprints
from rowloom.llm.hard_negatives import hard_negatives, hard_negatives_sql
from rowloom.llm.lexical import search, search_sql
from rowloom.llm.licenses import scan_licenses, scan_licenses_sql
from rowloom.llm.line_dedup import dedup_lines
from rowloom.llm.minhash import near_duplicates
from rowloom.llm.neighbours import nearest_neighbours
from rowloom.llm.packing import pack_documents
from rowloom.llm.quality import fit_quality, rate_quality
from rowloom.llm.rules import repetition_rules, repetition_rules_sql
from rowloom.llm.tokenize import round_trip_digests
from rowloom.llm.toxicity import fit_toxicity, rate_toxicity
from rowloom.llm.urls import filter_urls, outcomes_of

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingle sets overlap by three quarters."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every text, by a model of the labelled ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    return rate_toxicity(docs, model).select("doc_id", "expected_severity", "severity", "toxic")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected rating of every text and the chance that it is acceptable, by a model of the labelled ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    return rate_quality(docs, model).select("doc_id", "expected_quality", "tail_probability", "keep")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat, exactly or nearly, elsewhere."""
    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded with a byte-level BPE vocabulary, as digests."""
    return round_trip_digests(_table(spark, sf_dir, "documents"), RANKS)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of 1024-token sequences that lexical neighbours fill."""
    return pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases of every text."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text and of its edited form, and how alike they and the next document's are."""
    return fingerprints(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules and by its host's reputation."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, outcomes_of(pages, _table(spark, sf_dir, "labels")))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text judged by how much of it stands in duplicated n-grams and lines."""
    return repetition_rules(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector for each of its five positives; every seventh label is shifted first."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_quality": op3_quality,
        "op4_line_dedup": op4_line_dedup,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_packing": op6_packing,
        "op7_license_scan": op7_license_scan,
        "op8_nearest": op8_nearest,
        "op9_fingerprints": op9_fingerprints,
        "op10_url_filter": op10_url_filter,
        "op11_quality_rules": op11_quality_rules,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_lexical_search": op13_lexical_search,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op7_license_scan": scan_licenses_sql(),
        "op11_quality_rules": repetition_rules_sql(),
        "op12_hard_negatives": hard_negatives_sql(),
        "op13_lexical_search": search_sql(),
    }
