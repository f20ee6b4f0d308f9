"""Toxicity: expected severity of texts by ordinal regression on words and word beginnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.ordinal import OrdinalModel, fit_on, grade_texts, word_features

#: Expected severity from which on a text is toxic.
TOXIC_FROM = 0.5


def fit_toxicity(docs: DataFrame, labels: DataFrame, severity: Column | None = None, **named) -> OrdinalModel:
    """The model of severity grades 0, 1, ... (by default labels' column toxic) on a bounded sample of labelled rows."""
    return fit_on(docs, labels, F.col("toxic") if severity is None else severity, word_features, **named)


def rate_toxicity(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """docs with expected_severity, severity (the most likely grade) and toxic behind its columns.

    Expected severity sums the chances of each grade or a worse one, which share one weight vector and differ in
    their thresholds. Null and empty texts have no words and so the least severity that the model can give. Columns
    of docs that bear one of the three names are replaced. An empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in ("expected_severity", "severity", "toxic")]
    graded = grade_texts(docs.select(*[F.col(f"`{c}`") for c in rest]), model, word_features, text)
    likely = F.size(F.filter("tails", lambda t: t >= 0.5))
    return graded.select(
        *[F.col(f"`{c}`") for c in rest],
        F.col("expected_grade").alias("expected_severity"),
        likely.alias("severity"),
        (F.col("expected_grade") >= TOXIC_FROM).alias("toxic"),
    )
