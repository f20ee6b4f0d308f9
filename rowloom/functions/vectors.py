"""Column expressions over ``ARRAY<DOUBLE>`` vectors. All of them stay inside the JVM.

Arrays are arguments of the higher-order functions here, never captured by a lambda: Spark may replace a captured
column by the expression behind it, which would then be evaluated once per element.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_norm(v) -> Column:
    """Squared Euclidean norm."""
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)


def norm(v) -> Column:
    """Euclidean norm."""
    return F.sqrt(sq_norm(v))


def dot(a, b) -> Column:
    """Inner product; vectors of different length give NULL through ``zip_with``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sqdist(a, b) -> Column:
    """Squared Euclidean distance."""
    return sq_norm(F.zip_with(a, b, lambda x, y: x - y))


def paired_or_zero(a, b) -> tuple[Column, Column]:
    """Two vectors of equal length, where one that is absent reads as zeros; other lengths fail."""
    a, b = (F.col(v) if isinstance(v, str) else v for v in (a, b))
    unequal = F.raise_error(F.concat(F.lit("rows of "), F.size(a), F.lit(" and "), F.size(b), F.lit(" elements")))
    b = F.when(b.isNull(), zeros(F.size(a))).otherwise(b)
    a = F.when(a.isNull(), zeros(F.size(b))).otherwise(a)
    return F.when(F.size(a) == F.size(b), a).otherwise(unequal.cast("array<double>")), b


def index(column) -> Column:
    """A row or column index as BIGINT; a negative one fails in the projection that reads it."""
    column = (F.col(column) if isinstance(column, str) else column).cast("bigint")
    negative = F.raise_error(F.concat(F.lit("negative index "), column)).cast("bigint")
    return F.when(column < 0, negative).otherwise(column)


def zeros(n) -> Column:
    """A vector of ``n`` zeros."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_repeat(F.lit(0.0), n.cast("int"))


def strided(v, start, end, step) -> Column:
    """Elements ``start, start+step, ...`` of ``v``, both ends inclusive, cut at the vector's end.

    Looks at the range only, so a narrow slice of a wide row is cheap.
    """
    v = F.col(v) if isinstance(v, str) else v
    start, end, step = (F.lit(x) if isinstance(x, int) else x for x in (start, end, step))
    inside = F.slice(v, start.cast("int") + 1, F.greatest(end - start + 1, F.lit(0)).cast("int"))
    return F.filter(inside, lambda _, k: k % step == 0)


def fill_gaps(cells, n) -> Column:
    """Dense vector of length ``n`` from ``cells``, an array of (j, x) structs sorted by distinct ``j``.

    Linear in ``n``: each cell contributes the run of zeros in front of it and its value. A negative, repeated or
    unsorted ``j`` fails, and so does one of ``n`` or more.
    """
    cells = F.col(cells) if isinstance(cells, str) else cells
    n = F.lit(n) if isinstance(n, int) else n
    none = F.struct(F.lit(-1).cast("bigint").alias("j"), F.lit(0.0).alias("x"))
    before = F.slice(F.concat(F.array(none), cells), 1, F.size(cells))
    runs = F.zip_with(
        cells,
        before,
        lambda c, p: F.concat(zeros(c["j"] - p["j"] - 1), F.array(c["x"])),
    )
    last = F.coalesce(F.get(cells, F.size(cells) - 1)["j"], F.lit(-1).cast("bigint"))
    full = F.transform(cells, lambda c: c["x"])
    padded = F.concat(F.flatten(runs), zeros(n - 1 - last))
    outside = F.raise_error(F.concat(F.lit("column index "), last, F.lit(" outside a matrix of width "), n))
    disordered = F.exists(F.zip_with(cells, before, lambda c, p: c["j"] <= p["j"]), lambda bad: bad)
    repeated = F.raise_error(F.lit("column indices are negative or repeat"))
    return F.when(disordered, repeated.cast("array<double>")).when(last >= n, outside.cast("array<double>")).when(F.size(cells) == n, full).otherwise(padded)
