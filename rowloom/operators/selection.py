"""Picking rows, columns and blocks; index sets."""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.vectors import strided
from rowloom.operators.catalog import BLOCKS, CELLS, form_of

# Longest list of indices written into a predicate.
IDS_IN_PREDICATE = 1000

# Copies that one task emits when a row index is repeated very often.
COPIES_PER_RECORD = 10_000


def row_spine(spark: SparkSession, num_rows: int) -> DataFrame:
    """Indices ``0..num_rows-1``, generated on the executors."""
    return spark.range(num_rows).select(F.col("id").alias("i"))


def row_indices(matrix: DataFrame) -> DataFrame:
    """The row index of every record; only that column is read."""
    return matrix.select("i")


def select_rows(matrix: DataFrame, ids) -> DataFrame:
    """Rows whose index is in ``ids``, a DataFrame with column ``i`` or a Python collection.

    A short collection becomes an IN predicate that reaches the Parquet scan. A DataFrame or a longer
    collection becomes a semi join on its distinct indices, which Spark broadcasts or shuffles by its size.
    """
    if not isinstance(ids, DataFrame):
        ids = [int(i) for i in ids]
        if len(ids) <= IDS_IN_PREDICATE:
            return matrix.where(F.col("i").isin(ids))
        ids = matrix.sparkSession.createDataFrame(pa.table({"i": pa.array(ids, pa.int64())}))
    return matrix.join(ids.select("i").distinct(), "i", "left_semi").select(*matrix.columns)


def _bounds(index) -> tuple[int, int, int]:
    """(start, end, step) of a range given as such or as a single index."""
    start, end, step = (index, index, 1) if isinstance(index, int) else index
    if step < 1 or start < 0:
        raise ValueError(f"a range needs a start of 0 or more and a positive step, not {(start, end, step)}")
    return start, end, step


def _within(column, bounds):
    start, end, step = bounds
    inside = column.between(start, end)
    return inside if step == 1 else inside & ((column - start) % step == 0)


def block_slices(matrix: DataFrame, ranges, tile: tuple[int, int] | None = None) -> DataFrame:
    """Cells of several pairs of ranges in one scan, each cell once however many pairs hold it."""
    cells, wanted = matrix, [(_bounds(rows), _bounds(cols)) for rows, cols in ranges]
    if form_of(matrix) == BLOCKS:
        from rowloom.operators.forms import blocks_to_cells

        cells = blocks_to_cells(matrix.where(reduce(Column.__or__, [_touched(r, c, tile) for r, c in wanted])))
    elif form_of(matrix) != CELLS:
        from rowloom.operators.forms import rows_to_coo

        cells = rows_to_coo(matrix.where(reduce(Column.__or__, [_within(F.col("i"), r) for r, _ in wanted])))
    return cells.where(reduce(Column.__or__, [_within(F.col("i"), r) & _within(F.col("j"), c) for r, c in wanted]))


def block_ranges(blocks: DataFrame, ranges: DataFrame, tile: tuple[int, int]) -> DataFrame:
    """(request, i, j, x): the cells of very many pairs of ranges, one record for each request that holds a cell.

    ``ranges`` has columns request, row_start, row_end, row_step, col_start, col_end, col_step, both ends included;
    ``tile`` is the size of the tiles, those at the edges may be smaller. Each request is laid over the tile
    coordinates it meets and joined with the tiles on them, an equi-join however many requests there are; inside a tile
    only the requested elements are touched. A range with a negative start or a step below 1 fails.
    """
    bad = (F.col("row_start") < 0) | (F.col("col_start") < 0) | (F.col("row_step") < 1) | (F.col("col_step") < 1)
    message = F.raise_error(F.concat(F.lit("a range needs a start of 0 or more and a positive step, request "), "request"))
    checked = F.when(bad, message.cast("bigint")).otherwise(F.col("request"))
    asked = ranges.select(checked.alias("request"), *RANGE_COLUMNS).where("row_end >= row_start AND col_end >= col_start")
    last = blocks.agg(F.max("bi").alias("bi"), F.max("bj").alias("bj"))
    for at, start, end, size in (("bi", "row_start", "row_end", tile[0]), ("bj", "col_start", "col_end", tile[1])):
        asked = asked.withColumns(
            {"low": F.expr(f"{start} div {size}"), "top": F.least(F.expr(f"{end} div {size}"), last.select(at).scalar())}
        )
        asked = asked.where("low <= top").withColumn(at, F.explode(F.sequence("low", "top"))).drop("low", "top")
    met = blocks.select("bi", "bj", "i0", "j0", "nr", "nc", "data").join(asked, ["bi", "bj"])

    def inside(start: str, end: str, step: str, origin: str, size: str):
        after = F.greatest(F.lit(0).cast("bigint"), F.col(origin) - F.col(start))
        first = F.col(start) + F.ceil(after / F.col(step)) * F.col(step)
        top = F.least(F.col(end), F.col(origin) + F.col(size) - 1)
        return F.when(first <= top, F.sequence(first, top, F.col(step))).otherwise(F.array().cast("array<bigint>"))

    columns = met.withColumn("j", inside("col_start", "col_end", "col_step", "j0", "nc"))
    lines = columns.select(
        "request", "i0", "j0", "nc", "data", "j", F.explode(inside("row_start", "row_end", "row_step", "i0", "nr")).alias("i")
    )
    cells = lines.select("request", "i", "i0", "j0", "nc", "data", F.explode("j").alias("j"))
    place = (F.col("i") - F.col("i0")) * F.col("nc") + F.col("j") - F.col("j0")
    return cells.select("request", "i", "j", F.get("data", place.cast("int")).alias("x"))


RANGE_COLUMNS = ["row_start", "row_end", "row_step", "col_start", "col_end", "col_step"]


def _touched(rows, cols, tile: tuple[int, int] | None):
    """Tiles that meet both ranges. With the tiles' largest size the lower bounds reach the scan as well."""
    met = (F.col("i0") <= rows[1]) & (F.col("j0") <= cols[1])
    if tile is not None:
        met = met & (F.col("i0") > rows[0] - tile[0]) & (F.col("j0") > cols[0] - tile[1])
    return met & (F.col("i0") + F.col("nr") > rows[0]) & (F.col("j0") + F.col("nc") > cols[0])


def block_slice(matrix: DataFrame, rows, cols, tile: tuple[int, int] | None = None) -> DataFrame:
    """Sub-matrix of two strided ranges ``(start, end, step)``, both ends inclusive, original indices kept.

    Either range may be one index instead: a single row, a single column or one cell. The
    range on ``i`` is pushed to the scan, and so are both bounds on tile origins where ``tile`` names the tiles' largest
    size. Row form returns ``(i, v)`` where
    ``v`` holds the selected columns in order; cells and blocks return cells.
    """
    form, rows, cols = form_of(matrix), _bounds(rows), _bounds(cols)
    if form == BLOCKS:
        from rowloom.operators.forms import blocks_to_cells

        matrix, form = blocks_to_cells(matrix.where(_touched(rows, cols, tile))), CELLS
    if form == CELLS:
        return matrix.where(_within(F.col("i"), rows) & _within(F.col("j"), cols))
    return matrix.where(_within(F.col("i"), rows)).select("i", strided("v", *cols).alias("v"))


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All records of several matrices in the same form, copies kept. Narrow: no shuffle."""
    for other in others:
        first = first.unionByName(other)
    return first


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row indices present in both, each as often as in the matrix where it is rarer.

    Copies are counted with map-side combine before the join, and an index with very many copies is emitted
    from many tasks.
    """
    left = a.groupBy("i").agg(F.count("*").alias("ca"))
    right = b.groupBy("i").agg(F.count("*").alias("cb"))
    both = left.join(right, "i").select("i", F.least("ca", "cb").alias("copies"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES_PER_RECORD}"))
    spread = both.select("i", "copies", F.explode(chunks).alias("chunk"))
    here = F.least(F.lit(COPIES_PER_RECORD), F.col("copies") - F.col("chunk") * COPIES_PER_RECORD)
    # A fixed number of partitions: sized by bytes, the short chunk records would end up in one task.
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spread.select("i", "chunk", here.cast("int").alias("here")).repartition(tasks, "i", "chunk")
    return spread.select(F.explode(F.array_repeat("i", F.col("here"))).alias("i"))
