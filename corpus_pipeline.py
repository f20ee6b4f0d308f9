"""A corpus pipeline of five stages over the documents table, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.line_dedup import dedup_lines
from rowloom.llm.minhash import near_duplicates
from rowloom.llm.packing import pack_documents
from rowloom.llm.quality import fit_quality, rate_quality
from rowloom.llm.queries import VOCABULARY
from rowloom.llm.shared import store
from rowloom.llm.toxicity import fit_toxicity, rate_toxicity


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _boxed(docs: DataFrame) -> DataFrame:
    """Key, text and the whole row in one column, so that no name of docs meets one that an operator adds."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(F.col("doc_id"), F.col("text"), row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of an acceptable rating is high enough, all columns as they were.

    Without words there is nothing to rate: null, empty and blank texts stay, and so do null keys. Rows that repeat are
    judged each. An empty table gives an empty result.
    """
    rated = rate_quality(_boxed(docs), fit_quality(docs, _labels(spark, sf_dir)))
    return rated.where(F.col("keep") | (F.trim(F.coalesce("text", F.lit(""))) == "")).select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, all columns as they were; null and empty texts, repeated rows as in quality."""
    rated = rate_toxicity(_boxed(docs), fit_toxicity(docs, _labels(spark, sf_dir)))
    return rated.where(~F.col("toxic")).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, n_chars counted anew, other columns as they were.

    Those that lose all their text go; null, empty and blank texts and rows with a null key stay.
    """
    cut = dedup_lines(_boxed(docs))
    bare = F.trim(F.coalesce("text", F.lit(""))) == ""
    cut = cut.where(~bare | (F.col("n_removed") == 0))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("row")["n_chars"])
    new = {"text": F.col("text"), "n_chars": changed}
    return cut.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Of rows that repeat a doc_id the one with the smallest text stays (ties: by the row's JSON). Null, empty and
    wordless texts are near nothing and stay, and so does every row with a null key.
    """
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    held = _boxed(docs).join(kept, "doc_id", "left_semi")
    first = held.groupBy("doc_id").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row")).select("row.*")
    return first.union(docs.where("doc_id IS NULL").select(*[F.col(f"`{c}`") for c in docs.columns]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in pieces of 1024-token sequences."""
    return pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_copies", near_copies),
    ("packing", packing),
]

#: No stage can be put into SQL: trained models, signatures and retrieval are in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
