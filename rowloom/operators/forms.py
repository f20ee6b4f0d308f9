"""Conversions between row, cell and block form, zero filling and transposition."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom import kernels
from rowloom.functions.vectors import fill_gaps, index as valid_index, zeros
from rowloom.limits import check_row_width
from rowloom.operators.catalog import BLOCKS, CELLS, SPARSE, dims, form_of, of_width, require_unique, row_width
from rowloom.operators.selection import row_spine


def as_rows(table: DataFrame, index, *values) -> DataFrame:
    """Row form from an index column and either one array or MLlib vector column or several numeric columns.

    A negative index fails.
    """
    index = F.col(index) if isinstance(index, str) else index
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    vector = columns[0] if len(columns) == 1 else F.array(*[c.cast("double") for c in columns])
    if isinstance(table.select(vector).schema[0].dataType, VectorUDT):
        vector = vector_to_array(vector)
    return table.select(valid_index(index).alias("i"), vector.cast("array<double>").alias("v"))


def rows_to_coo(rows: DataFrame) -> DataFrame:
    """One record per stored element. Narrow: no shuffle.

    The outer form of the explode with a filter behind it gives the same records as the inner form, for which
    Spark first evaluates the vector once more to drop empty ones.
    """
    cells = rows.select("i", F.posexplode_outer("v").alias("j", "x")).where("j IS NOT NULL")
    return cells.select("i", F.col("j").cast("bigint").alias("j"), "x")


def _summed(cells: DataFrame, unique: bool) -> DataFrame:
    """Add up repeated cells with map-side combine, so a cell repeated without end is one record per task."""
    return cells if unique else cells.groupBy("i", "j").agg(F.sum("x").alias("x"))


def coo_to_rows(cells: DataFrame, num_cols: int | None = None, unique: bool = False) -> DataFrame:
    """Dense rows from cells; an absent cell is 0.0 and repeated cells add up.

    The group behind one row never exceeds ``num_cols`` cells. ``unique=True`` promises that no cell
    repeats and saves the shuffle that adds them up.
    """
    n = check_row_width(dims(cells)[1] if num_cols is None else num_cols)
    gathered = F.sort_array(F.collect_list(F.struct("j", "x")))
    rows = _summed(cells, unique).groupBy("i").agg(gathered.alias("c"))
    return rows.select("i", fill_gaps("c", n).alias("v"))


def zero_fill(rows: DataFrame, num_rows: int | None = None, num_cols: int | None = None) -> DataFrame:
    """Add a zero row for every index in ``0..num_rows-1`` that has none.

    Only the index column is shuffled (deduplicated first, then an anti join against the index range);
    the stored vectors stay where they are.
    """
    n = check_row_width(row_width(rows) if num_cols is None else num_cols)
    m = dims(rows, width=n)[0] if num_rows is None else num_rows
    present = rows.select("i").distinct()
    missing = row_spine(rows.sparkSession, m).join(present, "i", "left_anti")
    # The length depends on the row in form only: a constant vector would be spelled out in the plan.
    length = F.least(F.lit(n), F.col("i") + n)
    return rows.select("i", "v").unionByName(missing.select("i", zeros(length).alias("v")))


def densify(cells: DataFrame, num_rows: int, num_cols: int, unique: bool = False) -> DataFrame:
    """Full dense matrix from cells: gaps inside a row and wholly absent rows become zeros."""
    return zero_fill(coo_to_rows(cells, num_cols, unique), num_rows, num_cols)


def _tile(index: str, size: int):
    return F.expr(f"{index} div {size}")


def _finish_blocks(tiles: DataFrame, block_rows: int, block_cols: int) -> DataFrame:
    return tiles.select(
        "bi",
        "bj",
        (F.col("bi") * block_rows).alias("i0"),
        (F.col("bj") * block_cols).alias("j0"),
        "nr",
        "nc",
        "data",
    )


def _rows_to_blocks(rows: DataFrame, block_rows: int, block_cols: int, m: int, n: int) -> DataFrame:
    """Cut each row into column segments, then stack the segments of a tile: one shuffle of the data."""
    cuts = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // block_cols)))
    segment = F.slice("v", F.col("bj") * block_cols + 1, F.lit(block_cols))
    cut = of_width(rows, n).select(valid_index("i").alias("i"), "v", cuts.alias("bj")).select(
        _tile("i", block_rows).alias("bi"),
        F.col("bj").cast("bigint").alias("bj"),
        F.struct((F.col("i") % block_rows).cast("int").alias("r"), segment.alias("seg")).alias("s"),
    )
    stacks = cut.groupBy("bi", "bj").agg(F.sort_array(F.collect_list("s")).alias("s"))
    sized = stacks.withColumns(
        {
            "nr": F.least(F.lit(block_rows), m - F.col("bi") * block_rows).cast("int"),
            "nc": F.least(F.lit(block_cols), n - F.col("bj") * block_cols).cast("int"),
        }
    )
    none = F.struct(F.lit(-1).alias("r"), F.array().cast("array<double>").alias("seg"))
    before = F.concat(F.array(none), F.slice("s", 1, F.size("s") - 1))
    nc, last = F.col("nc"), F.element_at("s", -1)["r"]
    stacked = F.zip_with("s", before, lambda s, p: F.concat(zeros((s["r"] - p["r"] - 1) * nc), s["seg"]))
    outside = F.raise_error(F.concat(F.lit("row index "), F.col("bi") * block_rows + last, F.lit(f" outside {m} rows")))
    padded = F.concat(F.flatten(stacked), zeros((F.col("nr") - 1 - last) * nc))
    data = F.when(last < F.col("nr"), padded).otherwise(outside.cast("array<double>"))
    return _finish_blocks(sized.withColumn("data", data), block_rows, block_cols)


def cells_to_blocks(
    cells: DataFrame,
    block_rows: int,
    block_cols: int,
    num_rows: int | None = None,
    num_cols: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Dense tiles from cells; only tiles that hold a cell are stored, and repeated cells add up."""
    if num_rows is None or num_cols is None:
        found = dims(cells)
        num_rows = found[0] if num_rows is None else num_rows
        num_cols = found[1] if num_cols is None else num_cols
    check_row_width(block_rows * block_cols)
    nr = F.least(F.lit(block_rows), num_rows - F.col("bi") * block_rows).cast("int")
    nc = F.least(F.lit(block_cols), num_cols - F.col("bj") * block_cols).cast("int")
    checked = cells.select(valid_index("i").alias("i"), valid_index("j").alias("j"), "x")
    placed = _summed(checked, unique).select(
        _tile("i", block_rows).alias("bi"), _tile("j", block_cols).alias("bj"), "i", "j", "x"
    )
    offset = (F.col("i") % block_rows) * nc + F.col("j") % block_cols
    gathered = F.sort_array(F.collect_list(F.struct(offset.alias("j"), "x")))
    tiles = placed.groupBy("bi", "bj").agg(gathered.alias("c")).withColumns({"nr": nr, "nc": nc})
    filled = tiles.withColumn("data", fill_gaps("c", F.col("nr") * F.col("nc")))
    return _finish_blocks(filled, block_rows, block_cols)


def to_blocks(
    matrix: DataFrame,
    block_rows: int,
    block_cols: int,
    num_rows: int | None = None,
    num_cols: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Tiles of ``block_rows x block_cols`` (smaller at the edges) from rows or cells.

    A tile gathers at most ``block_rows`` row segments because row indices are distinct, which is
    checked on the index column first unless ``unique=True`` promises it.
    """
    if form_of(matrix) == CELLS:
        return cells_to_blocks(matrix, block_rows, block_cols, num_rows, num_cols, unique)
    check_row_width(block_rows * block_cols)
    n = row_width(matrix) if num_cols is None else num_cols
    m = dims(matrix, width=n)[0] if num_rows is None else num_rows
    if m == 0 or n == 0:
        raise ValueError("an empty matrix has no blocks")
    rows = matrix if unique else require_unique(matrix)
    return _rows_to_blocks(rows, block_rows, block_cols, m, n)


def blocks_to_cells(blocks: DataFrame) -> DataFrame:
    """One record per element of every tile. Narrow: no shuffle."""
    flat = blocks.select("i0", "j0", "nc", F.posexplode_outer("data").alias("p", "x")).where("p IS NOT NULL")
    return flat.select(
        (F.col("i0") + F.expr("p div nc")).alias("i"), (F.col("j0") + F.col("p") % F.col("nc")).alias("j"), "x"
    )


def blocks_to_rows(blocks: DataFrame, num_cols: int | None = None, unique: bool = False) -> DataFrame:
    """Reassemble rows from tiles; a tile that is absent from a row reads as zeros. One shuffle.

    A row gathers one segment per tile column; tiles are checked to be distinct on their coordinates.
    """
    n = check_row_width(dims(blocks)[1] if num_cols is None else num_cols)
    blocks = blocks if unique else require_unique(blocks, "bi", "bj")
    lines = F.explode(F.sequence(F.lit(0), F.col("nr") - 1))
    segment = F.slice("data", F.col("r") * F.col("nc") + 1, F.col("nc"))
    cut = blocks.select("i0", "j0", "nc", "data", lines.alias("r"))
    parts = cut.select((F.col("i0") + F.col("r")).alias("i"), F.struct("j0", segment.alias("seg")).alias("s"))
    grouped = parts.groupBy("i").agg(F.sort_array(F.collect_list("s")).alias("s"))
    none = F.struct(F.lit(0).cast("bigint").alias("j0"), F.array().cast("array<double>").alias("seg"))
    before = F.concat(F.array(none), F.slice("s", 1, F.size("s") - 1))
    filled = F.zip_with(
        "s", before, lambda s, p: F.concat(zeros(s["j0"] - p["j0"] - F.size(p["seg"])), s["seg"])
    )
    last = F.element_at("s", -1)
    end = last["j0"] + F.size(last["seg"])
    outside = F.raise_error(F.concat(F.lit("row "), "i", F.lit(" ends at column "), end, F.lit(f" of {n}")))
    whole = F.concat(F.flatten(filled), zeros(n - end))
    return grouped.select("i", F.when(end <= n, whole).otherwise(outside.cast("array<double>")).alias("v"))


def transpose(matrix: DataFrame, num_rows: int | None = None, tile: int = 256) -> DataFrame:
    """Transpose in the form given. Cells and blocks are narrow; rows go through tiles (two shuffles).

    A transposed row has ``num_rows`` elements, so only matrices short enough for that stay in row form.
    """
    form = form_of(matrix)
    if form == CELLS:
        return matrix.select(F.col("j").alias("i"), F.col("i").alias("j"), "x")
    if form == BLOCKS:
        return matrix.select(*kernels.BLOCK_COLUMNS).mapInArrow(kernels.transpose_blocks, kernels.BLOCK_SCHEMA)
    n = row_width(matrix)
    m = check_row_width(dims(matrix, width=n)[0] if num_rows is None else num_rows)
    return blocks_to_rows(transpose(to_blocks(matrix, tile, tile, m, n)), m, unique=True)


def to_rows(matrix: DataFrame) -> DataFrame:
    """Row form of a matrix in any form; rows pass through untouched."""
    form = form_of(matrix)
    if form == CELLS:
        return coo_to_rows(matrix)
    if form == SPARSE:
        from rowloom.operators.sparse import sparse_to_rows

        return sparse_to_rows(matrix)
    return blocks_to_rows(matrix) if form == BLOCKS else matrix
