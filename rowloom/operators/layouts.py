"""Element-cyclic distribution of a matrix over a process grid, as column expressions.

Ownership is arithmetic on the indices, so assigning owners needs neither a join nor a shuffle. Layouts that
keep copies explode only the free grid coordinate.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.vectors import index
from rowloom.operators.catalog import BLOCKS, CELLS, ROWS, form_of
from rowloom.operators.forms import blocks_to_cells
from rowloom.operators.grids import LAYOUTS, Grid, column_step, coordinates, row_step

def _known(layout: str) -> str:
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; known: {sorted(LAYOUTS)}")
    return layout


def grid_table(spark: SparkSession, grid: Grid) -> DataFrame:
    """The grid as a table: worker number and its coordinates."""
    worker = F.col("id")
    return spark.range(grid.size).select(
        worker.cast("int").alias("worker"),
        (worker % grid.rows).cast("int").alias("a"),
        F.floor(worker / grid.rows).cast("int").alias("b"),
    )


def _every(count: int):
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def place(frame: DataFrame, layout: str, grid: Grid, j) -> DataFrame:
    """Add a, b and owner of (i, j); one output record per copy."""
    _known(layout)
    a, b = coordinates(layout, index("i"), index(j), grid)
    frame = frame.withColumn("a", _every(grid.rows) if a is None else a.cast("int"))
    frame = frame.withColumn("b", _every(grid.cols) if b is None else b.cast("int"))
    return frame.withColumn("owner", grid.owner(F.col("a"), F.col("b")))


def _pieces(rows: DataFrame, layout: str, grid: Grid, values: bool) -> DataFrame:
    """Each row as the strided pieces its owners hold: (i, j0, jstep, count[, v], a, b, owner).

    A row is cut into at most one piece per column class, never into single cells. The lambda may capture the
    row here because the explode in front of it has fixed its value; the work stays linear in the row.
    """
    step = column_step(layout, grid)
    if step == 1:
        cut = rows.select("i", F.lit(0).alias("j0"), F.size("v").alias("count"), "v")
    else:
        classes = F.explode(F.sequence(F.lit(0), F.least(F.lit(step), F.size("v")) - 1))
        dealt = rows.where(F.size("v") > 0).select("i", classes.alias("j0"), F.col("v").alias("row"))
        last = F.size("row") - 1
        held = F.transform(F.sequence(F.col("j0"), last, F.lit(step)), lambda j: F.get("row", j))
        cut = dealt.select("i", "j0", (F.floor((last - F.col("j0")) / step).cast("int") + 1).alias("count"), held.alias("v"))
    cut = cut.withColumn("jstep", F.lit(step))
    return place(cut if values else cut.drop("v"), layout, grid, F.col("j0"))


def layout_assign(matrix: DataFrame, layout: str, grid: Grid) -> DataFrame:
    """Who owns what: cells get (a, b, owner); rows become owned pieces (i, j0, jstep, v, a, b, owner).

    A piece holds elements ``j0, j0 + jstep, ...`` of row ``i``. Layouts that replicate return one record
    per copy. No shuffle.
    """
    _known(layout)
    if form_of(matrix) == BLOCKS:
        matrix = blocks_to_cells(matrix)
    if form_of(matrix) == CELLS:
        return place(matrix.select("i", "j", "x"), layout, grid, F.col("j"))
    return _pieces(matrix, layout, grid, True).select("i", "j0", "jstep", "v", "a", "b", "owner")


def _first_index(kind: str, grid: Grid):
    """Smallest index an owner (worker, a, b) holds under one dealing rule; NULL if it holds none."""
    a, b = F.col("a"), F.col("b")
    if kind == "MC":
        return a
    if kind == "MR":
        return b
    if kind == "VC":
        return a + b * grid.rows
    if kind == "VR":
        return b + a * grid.cols
    if kind == "MD":
        diagonal = F.sequence(F.lit(0), F.lit(row_step("MD_STAR", grid) - 1))
        return F.get(F.filter(diagonal, lambda x: (x % grid.rows == a) & (x % grid.cols == b)), F.lit(0))
    if kind == "CIRC":
        return F.when((a == 0) & (b == 0), F.lit(0))
    return F.lit(0)


def layout_ranges(info: DataFrame, layout: str, grid: Grid) -> DataFrame:
    """Per worker the owned (start, end, step) of rows and columns, both ends inclusive, and the cell count.

    ``info`` is a matrix handle (``matrix_info``); each handle yields one record per worker.
    """
    by_row, by_col = _known(layout).split("_")
    worker = F.col("worker")
    workers = info.select("num_rows", "num_cols", _every(grid.size).alias("worker")).withColumns(
        {"a": (worker % grid.rows).cast("int"), "b": F.floor(worker / grid.rows).cast("int")}
    )
    starts = workers.withColumns(
        {
            "row_start": _first_index(by_row, grid).cast("bigint"),
            "col_start": _first_index(by_col, grid).cast("bigint"),
        }
    )

    def held(start, size, step):
        count = F.expr(f"({size} - 1 - {start}) div {step} + 1")
        return F.when(F.col(start) < F.col(size), count).otherwise(F.lit(0)).cast("bigint")

    rs, cs = row_step(layout, grid), column_step(layout, grid)
    return starts.select(
        "worker",
        "a",
        "b",
        "row_start",
        (F.col("num_rows") - 1).alias("row_end"),
        F.lit(rs).cast("bigint").alias("row_step"),
        "col_start",
        (F.col("num_cols") - 1).alias("col_end"),
        F.lit(cs).cast("bigint").alias("col_step"),
        (held("row_start", "num_rows", rs) * held("col_start", "num_cols", cs)).alias("cells"),
    )


def _meeting(first: str, step: str, other: str, other_step: int):
    """Smallest index in both progressions ``first + k*step`` and ``other + k*other_step``; NULL where they never meet.

    By the Chinese remainder theorem one exists among the first ``other_step`` members of the former, or none does.
    """
    members = F.transform(F.sequence(F.lit(0), F.lit(other_step - 1)), lambda k: F.col(first) + k * F.col(step))
    meets = F.filter(members, lambda x: (x >= F.col(other)) & ((x - F.col(other)) % other_step == 0))
    return F.get(meets, F.lit(0))


def _held(first: str, size: str, step):
    count = (F.expr(f"{size} - 1") - F.col(first)) / step
    return F.when(F.col(first) < F.col(size), F.floor(count) + 1).otherwise(0)


def layout_moves(info: DataFrame, layout: str, grid: Grid, to_layout: str, to_grid: Grid) -> DataFrame:
    """Who sends what to whom when a matrix changes its layout: one record per pair of workers that share cells.

    (source, target, row_start, row_step, col_start, col_step, cells, moves): the cells are those with row
    ``row_start + k*row_step`` and column ``col_start + k*col_step``. Where the old layout keeps copies, the first
    owner of each sends; ``moves`` is false where the target holds the cells already. Only handles and worker numbers
    are read, so the plan of any matrix has at most one record for each two workers.
    """
    old = layout_ranges(info, layout, grid).where("cells > 0")
    sender, first = F.col("worker"), F.lit(True)
    if layout == "STAR_STAR":
        sender, first = F.lit(0), F.col("worker") < 1
    elif layout in ("MC_STAR", "STAR_MC"):
        sender, first = F.col("a"), F.col("b") < 1
    elif layout in ("MR_STAR", "STAR_MR"):
        sender, first = F.col("b") * grid.rows, F.col("a") < 1
    new = layout_ranges(info, to_layout, to_grid)
    wanted = new.select(
        "worker", F.struct("row_start", "col_start", F.col("cells").alias("c")).alias("n")
    ).agg(F.collect_list(F.struct("worker", "n")).alias("targets"))
    # One record with at most a grid's number of workers, beside one record per source worker.
    senders = old.where(first).select(
        F.col("worker").alias("source"), "row_start", "row_step", "row_end", "col_start", "col_step", "col_end", F.explode(wanted.scalar()).alias("t")
    )
    rows, cols = row_step(to_layout, to_grid), column_step(to_layout, to_grid)
    pairs = senders.where("t.n.c > 0").select(
        "source",
        F.col("t.worker").alias("target"),
        (F.col("row_end") + 1).alias("m"),
        (F.col("col_end") + 1).alias("n"),
        F.col("row_start").alias("r"),
        F.col("col_start").alias("c"),
        F.col("row_step").alias("rs"),
        F.col("col_step").alias("cs"),
        F.col("t.n.row_start").alias("tr"),
        F.col("t.n.col_start").alias("tc"),
    )
    met = pairs.withColumns({"row_start": _meeting("r", "rs", "tr", rows), "col_start": _meeting("c", "cs", "tc", cols)})
    row_common, col_common = _lcm("rs", rows), _lcm("cs", cols)
    cells = _held("row_start", "m", row_common) * _held("col_start", "n", col_common)
    counted = met.select(
        "source",
        "target",
        "row_start",
        row_common.cast("bigint").alias("row_step"),
        "col_start",
        col_common.cast("bigint").alias("col_step"),
        cells.cast("bigint").alias("cells"),
    ).where("cells > 0")
    copies = old.select(F.col("worker").alias("target"), sender.cast("int").alias("keeper"))
    found = counted.join(copies, "target", "left")
    return found.select(*counted.columns, (~F.col("source").eqNullSafe(F.col("keeper"))).alias("moves"))


def _lcm(step: str, other: int):
    """Least common multiple of a step column, which has one value per layout, and a number."""
    multiples = F.transform(F.sequence(F.lit(1), F.lit(other)), lambda k: k * F.col(step))
    return F.get(F.filter(multiples, lambda x: x % other == 0), F.lit(0))


def _owned(matrix: DataFrame, layout: str, grid: Grid) -> DataFrame:
    """(owner, i, count) per owned row: how many elements of a row an owner holds; vectors are not carried."""
    if form_of(matrix) == ROWS:
        return _pieces(matrix, layout, grid, False).select("owner", "i", "count")
    if form_of(matrix) == BLOCKS:
        matrix = blocks_to_cells(matrix)
    placed = place(matrix.select("i", "j"), layout, grid, F.col("j"))
    return placed.groupBy("owner", "i").agg(F.count("*").alias("count"))


def layout_volume(matrix: DataFrame, layout: str, grid: Grid) -> DataFrame:
    """Rows, elements and bytes per owner; owners that hold nothing do not appear."""
    _known(layout)
    totals = _owned(matrix, layout, grid).groupBy("owner").agg(
        F.count("*").alias("rows"), F.sum(F.col("count").cast("bigint")).alias("elements")
    )
    return totals.withColumn("bytes", 8 * F.col("elements"))


def route(pieces: DataFrame, grid: Grid, buckets: int = 1) -> DataFrame:
    """Move every owner's pieces to its own Spark partitions: owner k gets ``k*buckets .. (k+1)*buckets-1``.

    ``buckets`` splits an owner by row, so a two-owner grid, or a layout that gives one owner everything,
    still uses as many tasks as asked for.
    """
    bucket = F.pmod(F.xxhash64("i"), F.lit(buckets)).cast("int")
    return pieces.repartitionById(grid.size * buckets, F.col("owner") * buckets + bucket)
