"""Gram matrix, row projection and matrix product."""

from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom import kernels
from rowloom.functions.vectors import zeros
from rowloom.limits import (
    BROADCAST_BYTES,
    GRAM_MAX_COLS,
    PARTIALS_PER_SUM,
    PIECE_BYTES,
    SQL_GRAM_COLS,
    TILE_SUM_BYTES,
    check_driver_bytes,
)
from rowloom.operators.catalog import CELLS, ROWS, dims, form_of, require_unique, row_width
from rowloom.operators.forms import blocks_to_rows, to_blocks, to_rows, transpose
from rowloom.sources.scratch import stored

# Edge of the square tiles of a blocked product: 2 MiB each.
TILE = 512


def vectors(rows: DataFrame) -> DataFrame:
    """The vectors alone, in as many tasks as the scan has splits."""
    return rows.select("v")


def summed(partials: DataFrame, width: int) -> DataFrame:
    """Rows of the sum of all partial results, in two levels: first within groups of tasks, then over the groups.

    Each piece is added up as a stream of Arrow batches, and no task reads more than PARTIALS_PER_SUM partial results
    of a piece on the first level.
    """
    near = partials.withColumn("g", F.expr(f"spark_partition_id() div {PARTIALS_PER_SUM}"))
    near = near.groupBy("c", "g").applyInArrow(kernels.add_pieces, kernels.PARTIAL_SCHEMA)
    return near.groupBy("c").applyInArrow(kernels.sum_pieces(width), kernels.ROW_SCHEMA)


def _sql_gramian(rows: DataFrame, n: int) -> DataFrame:
    """Few columns: n(n+1)/2 sums in one codegen aggregate, one record per task through the shuffle."""
    v = F.col("v")
    pairs = list(combinations_with_replacement(range(n), 2))
    ragged = F.raise_error(F.lit(f"matrix row of a length other than {n}"))
    present = F.when(F.size("v") == n, v).otherwise(ragged.cast("array<double>"))
    sums = [F.sum(v[p] * v[q]).alias(f"g{p}_{q}") for p, q in pairs]
    counts = [F.count(v[p]).alias(f"n{p}") for p in range(n)]
    total = rows.select(present.alias("v")).agg(F.count("*").alias("n"), *counts, *sums)
    complete = F.lit(True)
    for p in range(n):
        complete = complete & (F.col(f"n{p}") == F.col("n"))
    entry = lambda p, q: F.col(f"g{min(p, q)}_{max(p, q)}")
    lines = F.array(
        *[
            F.struct(F.lit(p).cast("bigint").alias("i"), F.array(*[entry(p, q) for q in range(n)]).alias("v"))
            for p in range(n)
        ]
    )
    null = F.raise_error(F.lit("matrix has a NULL element")).cast("array<struct<i:bigint,v:array<double>>>")
    return total.where("n > 0").select(F.inline(F.when(complete, lines).otherwise(null)))


def gramian(rows: DataFrame, num_cols: int | None = None) -> DataFrame:
    """Row form of A'A (n x n). One pass; what crosses the shuffle is n^2 numbers per task, not the matrix.

    Partial products are cut into pieces that are added up on the executors, so neither the driver nor any
    task holds more than one partial result. Beyond GRAM_MAX_COLS columns the result is formed by column panels.
    """
    rows = to_rows(rows)
    n = row_width(rows) if num_cols is None else num_cols
    if 0 < n <= SQL_GRAM_COLS:
        return _sql_gramian(rows, n)
    if n > GRAM_MAX_COLS:
        return blocks_to_rows(gramian_panels(rows, n), n, unique=True)
    partials = vectors(rows).mapInArrow(kernels.gram_partials(n, PIECE_BYTES), kernels.PARTIAL_SCHEMA)
    return summed(partials, n)


def gramian_panels(matrix: DataFrame, num_cols: int | None = None, panel: int = TILE) -> DataFrame:
    """Tiles of A'A from panels of ``panel`` columns; no task and no node ever holds the whole result.

    A stays in place and is read once for every TILE_SUM_BYTES of result: each pass forms the tiles of as many pairs of
    panels as a task may hold. Only tiles on and above the diagonal are computed and shuffled; the others are their
    transposes.
    """
    rows = to_rows(matrix)
    n = row_width(rows) if num_cols is None else num_cols
    if n == 0:
        raise ValueError("an empty matrix has no blocks")
    pairs = [(p, q) for p in range(-(-n // panel)) for q in range(p, -(-n // panel))]
    each = max(1, TILE_SUM_BYTES // (panel * panel * 8))
    passes = [
        vectors(rows).mapInArrow(kernels.panel_partials(n, panel, pairs[lo : lo + each]), kernels.PART_SCHEMA)
        for lo in range(0, len(pairs), each)
    ]
    upper = _sum_tiles(reduce(DataFrame.unionAll, passes))
    return upper.unionByName(transpose(upper.where("bi < bj")))


def collect_dense(rows: DataFrame, num_rows: int, num_cols: int, what: str) -> np.ndarray:
    """A small matrix on the driver; its size is checked first. Absent rows are zero.

    A row index that repeats or lies outside the matrix fails.
    """
    check_driver_bytes(num_rows * num_cols * 8, what)
    table = rows.select("i", "v").toArrow()
    out = np.zeros((num_rows, num_cols))
    every = table["i"].to_numpy()
    if len(every) and not 0 <= every.min() <= every.max() < num_rows:
        raise ValueError(f"{what} has row indices outside 0..{num_rows - 1}")
    if len(np.unique(every)) < len(every):
        raise ValueError(f"{what} has a repeated i")
    for batch in table.to_batches():
        out[batch.column("i").to_numpy()] = kernels.dense(batch.column("v"), num_cols)
    return out


def local_rows(spark: SparkSession, matrix: np.ndarray) -> DataFrame:
    """Row form of an array that is on the driver already."""
    table = pa.Table.from_batches([kernels.row_batch(np.arange(len(matrix)), matrix)])
    return spark.createDataFrame(table, kernels.ROW_SCHEMA)


def project_rows(rows: DataFrame, b, num_cols: int | None = None) -> DataFrame:
    """A.B for a dense B (numpy array or row form), one result row per row of A.

    While B is within the broadcast bound it travels to every task and A does not move. Beyond that the
    product is formed from tiles.
    """
    if isinstance(b, DataFrame):
        inner, (k, n) = row_width(rows) if num_cols is None else num_cols, dims(b)
        if k > inner:
            raise ValueError(f"inner dimensions differ: {inner} columns against {k} rows")
        if inner * n * 8 > BROADCAST_BYTES:
            return _row_block_product(rows, b, inner, n)
        b = collect_dense(b, inner, n, "the right factor")
    b = np.asarray(b, dtype=np.float64)
    if b.nbytes > BROADCAST_BYTES:
        return _row_block_product(rows, local_rows(rows.sparkSession, b), *b.shape)
    return rows.select("i", "v").mapInArrow(kernels.project(b), kernels.ROW_SCHEMA)


def _parallelism(matrix: DataFrame) -> int:
    return int(matrix.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _hot_indices(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner indices whose part of the join is more than one task's fair share: (k, s cuts left, t cuts right).

    An index with l records left and r right costs l*r products plus reading both. A share of w tasks is cut
    into s x t pieces, in the proportion that repeats the fewest records, and never finer than the records
    allow. Shares add up to the number of shuffle partitions, so the table is smaller than that and safe to
    broadcast.
    """
    parts = _parallelism(left)
    tagged = left.select("k", F.lit(1.0).alias("l"), F.lit(0.0).alias("r")).unionAll(
        right.select("k", F.lit(0.0).alias("l"), F.lit(1.0).alias("r"))
    )
    held = tagged.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    costed = held.withColumn("cost", F.col("l") * F.col("r") + F.col("l") + F.col("r"))
    share = F.try_divide(F.col("cost") * parts, costed.agg(F.sum("cost")).scalar())
    hot = costed.withColumn("w", share).where("w > 1")
    one = F.lit(1.0)
    most_left, most_right = F.greatest(one, "l"), F.greatest(one, "r")
    hot = hot.withColumn("t", F.least(most_right, F.greatest(one, F.ceil(F.sqrt(F.col("w") * most_right / most_left)))))
    hot = hot.withColumn("s", F.least(most_left, F.greatest(one, F.ceil(F.col("w") / F.col("t")))))
    return F.broadcast(hot.select("k", F.col("s").cast("int"), F.col("t").cast("int")))


def _salted(side: DataFrame, own: str, other: str, spread: str) -> DataFrame:
    """Spread one side over its own salts and repeat it for the other side's."""
    every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    salt = F.pmod(F.xxhash64(spread), F.col(own)).cast("int")
    return side.withColumn(f"{own}_at", salt).withColumn(f"{other}_at", every).drop(own, other)


def _join_inner(left: DataFrame, right: DataFrame, left_spread: str, right_spread: str) -> DataFrame:
    """Join on the inner index ``k``, hot values split into s x t sub-keys; every other value joins as it is."""
    hot = _hot_indices(left, right)
    left = left.join(hot, "k", "left").fillna(1, ["s", "t"])
    right = right.join(hot, "k", "left").fillna(1, ["s", "t"])
    return _salted(left, "s", "t", left_spread).join(_salted(right, "t", "s", right_spread), ["k", "s_at", "t_at"])


def _cell_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sparse product: join on the inner index, add up with map-side combine."""
    left = a.select("i", F.col("j").alias("k"), F.col("x").alias("xa"))
    right = b.select(F.col("i").alias("k"), "j", F.col("x").alias("xb"))
    joined = _join_inner(left, right, "i", "j")
    return joined.groupBy("i", "j").agg(F.sum(F.col("xa") * F.col("xb")).alias("x"))


def _block_product(a: DataFrame, b: DataFrame, salts: int | None = None) -> DataFrame:
    """Blocked product: tiles are joined on the inner tile index, multiplied, and added up per result tile.

    ``salts`` replaces the count of hot indices where every index is known to hold equally many tiles.
    """
    left = a.select(F.col("bj").alias("k"), "bi", "i0", "nr", F.col("nc").alias("nk"), F.col("data").alias("a_data"))
    right = b.select(F.col("bi").alias("k"), "bj", "j0", "nc", F.col("data").alias("b_data"))
    if salts is None:
        joined = _join_inner(left, right, "bi", "bj")
    else:
        same = {"s": F.lit(salts), "t": F.lit(1)}
        joined = _salted(left.withColumns(same), "s", "t", "bi").join(
            _salted(right.withColumns(same), "t", "s", "bj"), ["k", "s_at", "t_at"]
        )
    inputs = joined.select("bi", "bj", "i0", "j0", "nr", "nk", "nc", "a_data", "b_data")
    return _sum_tiles(inputs.mapInArrow(kernels.block_products(TILE_SUM_BYTES), kernels.PART_SCHEMA))


def _sum_tiles(partials: DataFrame) -> DataFrame:
    """Tiles added up from partial ones: where there may be more than PARTIALS_PER_SUM of one, in two levels.

    The first level adds those of a group of tasks, so that no task reads thousands of partial tiles of one result.
    """
    if _parallelism(partials) > PARTIALS_PER_SUM:
        near = partials.withColumn("g", F.expr(f"spark_partition_id() div {PARTIALS_PER_SUM}"))
        partials = near.groupBy("bi", "bj", "g").applyInArrow(kernels.add_blocks, kernels.PART_SCHEMA)
    return partials.groupBy("bi", "bj").applyInArrow(kernels.sum_blocks, kernels.BLOCK_SCHEMA)


def keyed(rows: DataFrame, *values: str) -> DataFrame:
    """(key, i, values) with a number of its own for every record, as a stored table: repeated indices stay apart."""
    return stored(rows.select(F.monotonically_increasing_id().alias("key"), "i", *values), "keyed")


def _row_block_product(a: DataFrame, b: DataFrame, inner: int, n: int) -> DataFrame:
    """Row-form product through tiles; a row of A that meets only zeros is a zero row.

    Records of A are numbered first, so repeated indices give a row each, as on the narrow path.
    Every inner tile index holds the same number of tiles of A, so all get the same number of salts, enough
    to occupy every shuffle partition.
    """
    held = keyed(a, "v")
    records = held.select(F.col("key").alias("i"), "v")
    m = dims(records, width=inner)[0]
    if m == 0:
        return a.select("i", "v").limit(0)
    left, right = to_blocks(records, TILE, TILE, m, inner, unique=True), to_blocks(b, TILE, TILE, inner, n)
    salts = max(1, -(-_parallelism(a) // -(-inner // TILE)))
    found = blocks_to_rows(_block_product(left, right, salts), n, unique=True)
    length = F.least(F.lit(n), F.col("i") + n)
    found = held.select("key", "i").join(found.select(F.col("i").alias("key"), "v"), "key", "left")
    return found.select("i", F.coalesce("v", zeros(length)).alias("v"))


def matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """A.B in the form of the operands.

    Rows: B is broadcast when its size allows it, else both go through tiles. Cells: a join on the inner
    index. Blocks: a join on the inner tile index, tiles multiplied in numpy.
    """
    form = form_of(a)
    if form != form_of(b):
        raise TypeError(f"factors in different forms: {form} and {form_of(b)}")
    if form == ROWS:
        return project_rows(a, b)
    return _cell_product(a, b) if form == CELLS else _block_product(a, b)
