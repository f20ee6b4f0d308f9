"""Quality: expected rating of texts and the chance of an acceptable one, by ordinal regression on their style."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.ordinal import OrdinalModel, fit_on, grade_texts, style_features

#: Least chance of a grade of LEAST_GRADE or more at which a text is kept.
KEEP_FROM, LEAST_GRADE = 0.5, 1


def rating() -> Column:
    """The grade of a row of labels: 0 for bad quality, 1 for good quality with toxic words, 2 for good quality."""
    return F.col("quality") * (2 - F.col("toxic"))


def fit_quality(docs: DataFrame, labels: DataFrame, grade: Column | None = None, **named) -> OrdinalModel:
    """The model of graded ratings 0, 1, ... (by default rating()) on a bounded sample of labelled rows."""
    return fit_on(docs, labels, rating() if grade is None else grade, style_features, **named)


def rate_quality(docs: DataFrame, model: OrdinalModel, text: str = "text", least_grade: int = LEAST_GRADE) -> DataFrame:
    """docs with expected_quality, tail_probability (of `least_grade` or better) and keep behind its columns.

    Null and empty texts have no style and get what the thresholds give, which depends on the labels. Columns of docs
    that bear one of the three names are replaced. An empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in ("expected_quality", "tail_probability", "keep")]
    graded = grade_texts(docs.select(*[F.col(f"`{c}`") for c in rest]), model, style_features, text)
    tail = F.coalesce(F.get("tails", F.lit(least_grade - 1)), F.lit(0.0))
    return graded.select(
        *[F.col(f"`{c}`") for c in rest],
        F.col("expected_grade").alias("expected_quality"),
        tail.alias("tail_probability"),
        (tail >= KEEP_FROM).alias("keep"),
    )
