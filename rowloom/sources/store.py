"""Matrices stored as Parquet in a distribution layout, read back whole or in part, extended, moved and reopened.

A stored matrix is a folder with ``pieces`` (partitioned by owner and write) and ``info`` (one record per write,
committed after its pieces). Pieces of a write that ``info`` does not name, or that a later record replaces, are never
read, so a failed write can simply be repeated and a compaction takes effect at once. Pieces are parts of rows, cells
or tiles; ``info`` says which.
"""

import uuid
from math import gcd

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.limits import check_row_width
from rowloom.operators.catalog import BLOCKS, CELLS, ROWS, dims, of_width, require_unique, row_width
from rowloom.operators.forms import zero_fill
from rowloom.operators.grids import Grid, column_step, coordinates
from rowloom.operators.layouts import layout_assign, place, route
from rowloom.operators.selection import IDS_IN_PREDICATE, block_ranges, select_rows

INFO_SCHEMA = (
    "name string, num_rows bigint, num_cols bigint, rows_written bigint, layout string, grid_rows int, grid_cols int, "
    "write string, form string, mixed boolean, tile_rows int, tile_cols int, replaces array<string>"
)

def _index_facts(rows: DataFrame) -> tuple[int, int]:
    """(number of rows, highest index plus one), failing on a repeated index. Reads the index column only."""
    copies = rows.groupBy("i").agg(F.count("*").alias("copies"))
    count, top, most = copies.agg(F.sum("copies"), F.max("i"), F.max("copies")).first()
    if (most or 0) > 1:
        raise ValueError(f"repeated row index: up to {most} copies of one row")
    return count or 0, 0 if top is None else top + 1


def _write(
    rows: DataFrame, path: str, name: str, n: int, layout: str, grid: Grid, buckets: int | None, mode: str
) -> int:
    """Write pieces and then their info record; returns how many rows were written."""
    if mode == "errorifexists":
        _refuse_existing(rows.sparkSession, path)
    count, height = _index_facts(rows)
    pieces = layout_assign(of_width(rows, n), layout, grid)
    pieces = pieces.hint("rebalance", "owner") if buckets is None else route(pieces, grid, buckets)
    write = _write_pieces([pieces.drop("a", "b")], path, ["i"])
    _commit(rows.sparkSession, path, mode, write, name, height, n, count, layout, grid)
    return count


def _refuse_existing(spark: SparkSession, path: str) -> None:
    if _exists(spark, f"{path}/info"):
        raise ValueError(f"a matrix is stored at {path} already")


def _write_pieces(parts: list[DataFrame], path: str, order: list[str]) -> str:
    """Write pieces under a new write's number, each part with its own distribution, sorted inside each task."""
    write = uuid.uuid4().hex
    for part in parts:
        part.sortWithinPartitions("owner", *order).withColumn("write", F.lit(write)).write.mode("append").partitionBy(
            "owner", "write"
        ).parquet(f"{path}/pieces")
    return write


def _commit(
    spark: SparkSession,
    path: str,
    mode: str,
    write: str,
    name: str,
    height: int,
    width: int,
    count: int,
    layout: str,
    grid: Grid,
    form: str = ROWS,
    mixed: bool = False,
    tile: tuple[int, int] = (0, 0),
    replaces: tuple = (),
) -> None:
    """The info record that makes a write part of the matrix."""
    record = [(name, height, width, count, layout, grid.rows, grid.cols, write, form, mixed, *tile, list(replaces))]
    spark.createDataFrame(record, INFO_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{path}/info")


def put_matrix(
    rows: DataFrame,
    path: str,
    layout: str = "VC_STAR",
    grid: Grid | None = None,
    name: str = "",
    buckets: int | None = None,
) -> int:
    """Store a row-form matrix by owner at a new path and return the number of rows written.

    Pieces are brought together by owner, owners with much data split over several tasks by their measured size,
    and sorted by row index; so files are as many as owners and data need. ``buckets`` instead sends each owner to exactly that many tasks (``route``).
    Repeated row indices fail before anything is written.
    """
    width = row_width(rows)
    if width == 0:
        raise ValueError("an empty matrix cannot be stored")
    return _write(rows, path, name, width, layout, grid or Grid(1, 1), buckets, "errorifexists")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.schema(INFO_SCHEMA).parquet(path).columns)
    except AnalysisException:
        return False


def _records(spark: SparkSession, path: str) -> DataFrame:
    """The info records of the writes that make up a matrix: those that no later one replaces."""
    records = spark.read.schema(INFO_SCHEMA).parquet(f"{path}/info")
    replaced = records.select(F.explode("replaces").alias("write"))
    return records.join(replaced, "write", "left_anti")


def _pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of committed writes."""
    writes = [r["write"] for r in _records(spark, path).select("write").collect()]
    return spark.read.parquet(f"{path}/pieces").where(F.col("write").isin(writes))


def stored_info(spark: SparkSession, path: str) -> DataFrame:
    """The handle of a stored matrix: dimensions over all writes, layout and grid."""
    return (
        _records(spark, path)
        .groupBy("layout", "grid_rows", "grid_cols", "form", "tile_rows", "tile_cols")
        .agg(
            F.max("name").alias("name"),
            F.max("num_rows").alias("num_rows"),
            F.max("num_cols").alias("num_cols"),
            F.sum("rows_written").alias("stored_rows"),
            F.bool_or("mixed").alias("mixed"),
        )
    )


def _opened(spark: SparkSession, path: str, form: str):
    """(info, grid) of a stored matrix that must be in the given form."""
    info = stored_info(spark, path).first()
    if info["form"] != form:
        raise ValueError(f"the matrix at {path} is stored in {info['form']}, not in {form}")
    return info, Grid(info["grid_rows"], info["grid_cols"])


def append_rows(rows: DataFrame, path: str) -> int:
    """Add rows to a stored matrix in its own layout and return how many were written.

    Indices must be new and rows as wide as the stored ones; both are checked on the info records and the index column
    of one copy's first column class.
    """
    spark = rows.sparkSession
    info, grid = _opened(spark, path, ROWS)
    width = row_width(rows)
    if width != info["num_cols"]:
        raise ValueError(f"rows of {width} elements cannot extend a matrix of {info['num_cols']} columns")
    pieces = _one_copy(_pieces_of(spark, path), info["layout"], grid)
    stored = pieces.where("j0 = 0").select("i")
    if not rows.join(stored, "i", "left_semi").isEmpty():
        raise ValueError("some row indices are stored already")
    return _write(rows, path, info["name"], width, info["layout"], grid, None, "append")


def _one_copy(pieces: DataFrame, layout: str, grid: Grid, i: str = "i", j: str | None = None) -> DataFrame:
    """Keep the first copy where a layout replicates: a filter on the partition column, so other copies are
    never read."""
    column = F.col(j or ("j" if "j" in pieces.columns else "j0"))
    a, b = coordinates(layout, F.col(i), column, grid)
    if a is None and b is None:
        return pieces.where(F.col("owner") == 0)
    if a is None:
        return pieces.where(F.col("owner").isin([b * grid.rows for b in range(grid.cols)]))
    if b is None:
        return pieces.where(F.col("owner").isin(list(range(grid.rows))))
    return pieces


def get_matrix(spark: SparkSession, path: str, fill: bool = True) -> DataFrame:
    """Read a stored matrix back in row form; with ``fill`` absent rows return as zeros.

    Stored indices are distinct, so a matrix with as many rows as indices has no gaps and needs no filling.

    Layouts that keep rows whole are read without a shuffle. The others gather each row's pieces, at most
    one per column class of the grid.
    """
    info, grid = _opened(spark, path, ROWS)
    layout, n = info["layout"], info["num_cols"]
    pieces = _one_copy(_pieces_of(spark, path), layout, grid)
    rows = _whole_rows(pieces, layout, grid, n, info["mixed"])
    gaps = info["stored_rows"] < info["num_rows"]
    return zero_fill(rows, info["num_rows"], n) if fill and gaps else rows


def get_rows(spark: SparkSession, path: str, ids) -> DataFrame:
    """The stored rows whose index is in ``ids``, a DataFrame with column ``i`` or a Python collection.

    Absent ones do not appear. Only the folders of owners that hold one of them are read; the indices of a short
    collection are also pushed to the scan, where sorted files skip what lies between.
    """
    info, grid = _opened(spark, path, ROWS)
    layout, n = info["layout"], info["num_cols"]
    if not isinstance(ids, DataFrame):
        ids = sorted({int(i) for i in ids})
    wanted = ids.select("i") if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], "i bigint")
    wanted = wanted.withColumn("v", F.array_repeat(F.lit(0.0), min(n, column_step(layout, grid))))
    owners = [r["owner"] for r in layout_assign(wanted, layout, grid).select("owner").distinct().collect()]
    pieces = _one_copy(_pieces_of(spark, path).where(F.col("owner").isin(owners)), layout, grid)
    return _whole_rows(select_rows(pieces, ids), layout, grid, n, info["mixed"])


# Column classes up to which rows are dealt together class by class; with more, or pieces of several strides, elements
# are sorted by their column.
DEALT_CLASSES = 16


def _whole_rows(pieces: DataFrame, layout: str, grid: Grid, n: int, mixed: bool) -> DataFrame:
    """Rows from their pieces, one per column class, or of several strides where a matrix was moved."""
    step = column_step(layout, grid)
    if step == 1 and not mixed:
        rows = pieces.select("i", "v")
    elif mixed or step > DEALT_CLASSES:
        check_row_width(n)
        held = pieces.groupBy("i").agg(F.collect_list(F.struct("j0", "jstep", "v")).alias("p"))
        placed = F.transform(
            "p", lambda q: F.transform(q["v"], lambda x, k: F.struct((q["j0"] + k * q["jstep"]).alias("j"), x.alias("x")))
        )
        rows = held.select("i", F.transform(F.sort_array(F.flatten(placed)), lambda c: c["x"]).alias("v"))
    else:
        check_row_width(n)
        gathered = F.sort_array(F.collect_list(F.struct("j0", "v")))
        held = pieces.groupBy("i").agg(gathered.alias("p"))
        classes = [F.get("p", F.lit(q))["v"].alias(f"c{q}") for q in range(min(step, n))]
        dealt = F.transform(F.arrays_zip(*classes), lambda s: F.array(*[s[f"c{q}"] for q in range(len(classes))]))
        rows = held.select("i", F.slice(F.flatten(dealt), 1, n).alias("v"))
    return rows


def put_blocks(blocks: DataFrame, path: str) -> None:
    """Store distinct tiles at a new path, in ranges of their coordinates, so that a slice skips files and row groups."""
    tiles = require_unique(blocks, "bi", "bj").repartitionByRange("bi", "bj")
    tiles.sortWithinPartitions("bi", "bj").write.mode("errorifexists").parquet(path)


def get_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Read stored tiles."""
    return spark.read.parquet(path)


def redistribute(spark: SparkSession, path: str, target: str, layout: str, grid: Grid) -> int:
    """Store a matrix, kept at ``path``, at a new path in another layout or on another grid; returns its rows.

    Every piece is cut by the new layout's column classes only, never into cells; a piece of strides s and t has the
    stride of both. Pieces whose owner stays the same are written where they are read; only the others are shuffled.
    """
    info, old = _opened(spark, path, ROWS)
    _refuse_existing(spark, target)
    step, width = column_step(info["layout"], old), info["num_cols"]
    parts = column_step(layout, grid)
    period = parts // gcd(step, parts)
    held = _one_copy(_pieces_of(spark, path), info["layout"], old).withColumnRenamed("owner", "was").drop("write")
    if period > 1:
        cut = held.withColumn("r", F.explode(F.sequence(F.lit(0), F.least(F.lit(period), F.size("v")) - 1)))
        taken = F.transform(F.sequence(F.col("r"), F.size("v") - 1, F.lit(period)), lambda k: F.get("v", k))
        held = cut.select(
            "i", (F.col("j0") + F.col("r") * F.col("jstep")).alias("j0"), (F.col("jstep") * period).alias("jstep"), taken.alias("v"), "was"
        )
    placed = place(held, layout, grid, F.col("j0")).drop("a", "b")
    same = F.col("was") == F.col("owner")
    stay, go = placed.where(same).drop("was"), placed.where(~same).drop("was").hint("rebalance", "owner")
    write = _write_pieces([stay, go], target, ["i"])
    mixed = bool(info["mixed"]) or (step > 1 and step != parts) or (period > 1 and step > 1)
    name, rows = info["name"], info["stored_rows"]
    _commit(spark, target, "errorifexists", write, name, info["num_rows"], width, rows, layout, grid, mixed=mixed)
    return rows


def put_cells(cells: DataFrame, path: str, layout: str = "VC_STAR", grid: Grid | None = None, name: str = "") -> int:
    """Store distinct cells by owner at a new path; returns how many. Repeated cells fail before anything is written."""
    spark, grid = cells.sparkSession, grid or Grid(1, 1)
    _refuse_existing(spark, path)
    (height, width), count = dims(cells), cells.count()
    placed = layout_assign(require_unique(cells, "i", "j"), layout, grid).drop("a", "b").hint("rebalance", "owner")
    write = _write_pieces([placed], path, ["i", "j"])
    _commit(spark, path, "errorifexists", write, name, height, width, count, layout, grid, form=CELLS)
    return count


def get_cells(spark: SparkSession, path: str) -> DataFrame:
    """Stored cells; of a layout that keeps copies one copy is read."""
    info, grid = _opened(spark, path, CELLS)
    return _one_copy(_pieces_of(spark, path), info["layout"], grid).select("i", "j", "x")


def put_tiles(blocks: DataFrame, path: str, layout: str = "MC_MR", grid: Grid | None = None, name: str = "") -> int:
    """Store distinct tiles at a new path; returns how many. The layout deals whole tiles by their coordinates."""
    spark, grid = blocks.sparkSession, grid or Grid(1, 1)
    _refuse_existing(spark, path)
    facts = blocks.agg(F.max("nr"), F.max("nc"), F.count("*"), F.max(F.col("i0") + F.col("nr")), F.max(F.col("j0") + F.col("nc"))).first()
    if not facts[2]:
        raise ValueError("an empty matrix cannot be stored")
    tiles = require_unique(blocks, "bi", "bj").withColumn("i", F.col("bi"))
    placed = place(tiles, layout, grid, F.col("bj")).drop("a", "b", "i").hint("rebalance", "owner")
    write = _write_pieces([placed], path, ["bi", "bj"])
    tile = (facts[0], facts[1])
    _commit(spark, path, "errorifexists", write, name, facts[3], facts[4], facts[2], layout, grid, form=BLOCKS, tile=tile)
    return facts[2]


def get_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Stored tiles; of a layout that keeps copies one copy is read."""
    info, grid = _opened(spark, path, BLOCKS)
    pieces = _one_copy(_pieces_of(spark, path), info["layout"], grid, "bi", "bj")
    return pieces.select("bi", "bj", "i0", "j0", "nr", "nc", "data")


def get_ranges(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """(request, i, j, x) of very many pairs of ranges of a matrix stored in tiles; see ``block_ranges``.

    The tile rows that requests touch reach the scan, as a list or, where they are many, as their lowest and highest;
    files are sorted by them, so what lies between is skipped.
    """
    info, _ = _opened(spark, path, BLOCKS)
    rows, cols = info["tile_rows"], info["tile_cols"]
    top = (info["num_rows"] - 1) // rows
    lowest, highest = F.expr(f"row_start div {rows}"), F.least(F.expr(f"row_end div {rows}"), F.lit(top))
    met = ranges.where(lowest <= highest).select(lowest.alias("low"), highest.alias("high"))
    touched = met.select(F.explode(F.sequence("low", "high")).alias("bi")).distinct().limit(IDS_IN_PREDICATE + 1).collect()
    tiles = get_tiles(spark, path)
    if len(touched) <= IDS_IN_PREDICATE:
        tiles = tiles.where(F.col("bi").isin([r["bi"] for r in touched]))
    else:
        low, high = met.agg(F.min("low"), F.max("high")).first()
        tiles = tiles.where(F.col("bi").between(low, high))
    return block_ranges(tiles, ranges, (rows, cols))


def stored_matrices(spark: SparkSession, root: str) -> DataFrame:
    """(name, path, form, num_rows, num_cols, layout, grid_rows, grid_cols, writes, changed) of all matrices in a folder."""
    records = spark.read.schema(INFO_SCHEMA).parquet(f"{root.rstrip('/')}/*/info").select("*", "_metadata")
    path = F.regexp_replace(F.col("_metadata.file_path"), "/info/[^/]*$", "")
    return records.groupBy(path.alias("path"), "form", "layout", "grid_rows", "grid_cols").agg(
        F.max("name").alias("name"),
        F.max("num_rows").alias("num_rows"),
        F.max("num_cols").alias("num_cols"),
        F.count("*").alias("writes"),
        F.max("_metadata.file_modification_time").alias("changed"),
    )


def open_matrix(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The matrix of that name among those stored in the folder ``root``, in the form it is stored in.

    Of several with one name the one changed last opens (ties: the last path); an unknown name is an error.
    """
    found = stored_matrices(spark, root).where(F.col("name") == name).orderBy(F.desc("changed"), F.desc("path")).first()
    if found is None:
        raise KeyError(f"no matrix named {name!r} is stored in {root}")
    return {ROWS: get_matrix, CELLS: get_cells, BLOCKS: get_tiles}[found["form"]](spark, found["path"])


def compact_matrix(spark: SparkSession, path: str) -> int:
    """Write all pieces of a matrix of rows anew as one write that replaces the earlier ones; returns how many those were.

    The new record takes effect at once; readers that began before still find the old files. ``remove_replaced`` deletes
    them.
    """
    info, grid = _opened(spark, path, ROWS)
    writes = [r["write"] for r in _records(spark, path).select("write").collect()]
    pieces = _pieces_of(spark, path).drop("write").hint("rebalance", "owner")
    write = _write_pieces([pieces], path, ["i"])
    _commit(
        spark, path, "append", write, info["name"], info["num_rows"], info["num_cols"], info["stored_rows"],
        info["layout"], grid, mixed=bool(info["mixed"]), replaces=tuple(writes),
    )
    return len(writes)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files of failed and replaced writes of a stored matrix; returns how many folders went."""
    kept = {r["write"] for r in _records(spark, path).select("write").collect()}
    found = spark.read.parquet(f"{path}/pieces").select("owner", "write").distinct().where(~F.col("write").isin(sorted(kept)))
    gone = [(r["owner"], r["write"]) for r in found.collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for owner, write in gone:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/pieces/owner={owner}/write={write}")
        folder.getFileSystem(conf).delete(folder, True)
    return len(gone)
