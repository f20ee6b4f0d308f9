"""Vectors written as text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.vectors import fill_gaps


def _numbers(text, kind: str):
    trimmed = F.trim(text)
    empty = F.array().cast(f"array<{kind}>")
    return F.when(trimmed == "", empty).otherwise(F.split(trimmed, r"\s*,\s*").cast(f"array<{kind}>"))


def parse_vectors(table: DataFrame, index: str, text: str) -> DataFrame:
    """Rows from text: dense ``[1.0, 2.0]`` or sparse ``(size, [indices], [values])``; anything else fails.

    Column expressions only; the whole text is parsed.
    """
    body = F.trim(F.col(text))
    dense = r"^\[([^\[\]]*)\]$"
    sparse = r"^\(\s*(\d+)\s*,\s*\[([^\[\]]*)\]\s*,\s*\[([^\[\]]*)\]\s*\)$"
    size = F.regexp_extract(body, sparse, 1).cast("int")
    indices = _numbers(F.regexp_extract(body, sparse, 2), "bigint")
    values = _numbers(F.regexp_extract(body, sparse, 3), "double")
    lengths = F.raise_error(F.concat(F.lit("indices and values differ in number: "), body))
    named = F.transform(
        F.arrays_zip(indices.alias("j"), values.alias("x")),
        lambda c: F.struct(c["j"].alias("j"), c["x"].alias("x")),
    )
    cells = F.when(F.size(indices) == F.size(values), F.sort_array(named)).otherwise(
        lengths.cast("array<struct<j:bigint,x:double>>")
    )
    unreadable = F.raise_error(F.concat(F.lit("not a vector: "), F.coalesce(body, F.lit("NULL"))))
    is_dense, is_sparse = body.rlike(dense), body.rlike(sparse)
    parsed = table.select(
        F.col(index).cast("bigint").alias("i"),
        F.when(is_dense, _numbers(F.regexp_extract(body, dense, 1), "double"))
        .when(~F.coalesce(is_sparse, F.lit(False)), unreadable.cast("array<double>"))
        .alias("dense"),
        F.when(is_sparse, cells).alias("cells"),
        F.when(is_sparse, size).alias("size"),
    )
    return parsed.select("i", F.coalesce("dense", fill_gaps("cells", F.col("size"))).alias("v"))
