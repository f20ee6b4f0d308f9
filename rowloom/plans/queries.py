"""One Spark query per operator, each over whole tables."""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.sql import register_functions
from rowloom.operators.catalog import describe_matrix, dims, matrix_density, matrix_info, register_matrix
from rowloom.operators.compare import matrix_diff
from rowloom.operators.factorize import reconstruct, reconstruction_error, relative_error, truncated_svd
from rowloom.operators.forms import (
    blocks_to_cells,
    blocks_to_rows,
    cells_to_blocks,
    coo_to_rows,
    densify,
    rows_to_coo,
    to_blocks,
    transpose,
    zero_fill,
)
from rowloom.operators.grids import LAYOUTS, Grid
from rowloom.operators.layouts import grid_table, layout_assign, layout_moves, layout_ranges, layout_volume, route
from rowloom.operators.products import gramian, gramian_panels, matmul, project_rows
from rowloom.operators.reductions import frobenius_sq, row_dots, row_norms, row_sqdist
from rowloom.operators.selection import (
    block_slice,
    block_slices,
    common_rows,
    row_indices,
    row_spine,
    select_rows,
    union_rows,
)
from rowloom.operators.sparse import gramian_sparse, project_rows_sparse, sparse_rows, sparse_to_cells
from rowloom.plans import matrices as M
from rowloom.sources.libsvm import read_libsvm_matrix, read_libsvm_sparse
from rowloom.sources.matrix_source import register_source
from rowloom.sources.random import random_rows
from rowloom.sources.scratch import scratch_path
from rowloom.sources.store import (
    append_rows,
    compact_matrix,
    get_blocks,
    get_cells,
    get_matrix,
    get_ranges,
    get_rows,
    get_tiles,
    open_matrix,
    put_blocks,
    put_cells,
    put_matrix,
    put_tiles,
    redistribute,
    remove_replaced,
)
from rowloom.sources.text import parse_vectors

Query = Callable[[SparkSession, str], DataFrame]

GRID = Grid(2, 3)


def rounded(column, places: int = 6):
    """Rounded for comparison, with negative zero and noise around zero made plain zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.abs(column) < 0.5 * 10**-places, F.lit(0.0)).otherwise(F.round(column, places))


def _cells(rows: DataFrame, places: int | None = None) -> DataFrame:
    cells = rows_to_coo(rows)
    return cells if places is None else cells.withColumn("x", rounded("x", places))


# Sources and sinks


def read_libsvm(spark, sf):
    path = scratch_path(spark, "libsvm")
    rows = M.embeddings(spark, sf)
    lines = rows.select(F.col("i").cast("double").alias("label"), array_to_vector("v").alias("features"))
    lines.write.format("libsvm").save(path)
    return _cells(read_libsvm_matrix(spark, path))


def read_sparse(spark, sf):
    """Order x part quantities written as libsvm text and read back without zeros."""
    path = scratch_path(spark, "libsvm")
    pairs = F.transform(F.arrays_zip("idx", "val"), lambda c: F.concat_ws(":", c["idx"] + 1, c["val"]))
    lines = sparse_rows(M.order_parts(spark, sf)).select(F.concat_ws(" ", F.col("i"), F.array_join(pairs, " ")))
    lines.write.text(path)
    return sparse_to_cells(read_libsvm_sparse(spark, path))


def random_from_spine(spark, sf):
    spine = M.table(spark, sf, "customer").select(F.col("c_custkey").alias("i"))
    return _cells(random_rows(spine, 16))


def spine(spark, sf):
    return row_spine(spark, dims(M.orders(spark, sf), width=2)[0])


def put_get(matrix, layout, spark, sf):
    path = scratch_path(spark, "matrix")
    put_matrix(matrix(spark, sf), path, layout, GRID)
    return _cells(get_matrix(spark, path))


def read_source(matrix, layout, spark, sf):
    """A stored matrix read through Spark's data source interface, its pieces' elements as cells."""
    path = scratch_path(spark, "source")
    put_matrix(matrix(spark, sf), path, layout, GRID)
    found = spark.read.format(register_source(spark)).load(path)
    if "j0" not in found.columns:
        return _cells(found)
    cells = found.select("i", "j0", "jstep", F.posexplode("v").alias("k", "x"))
    return cells.select("i", F.expr("j0 + k * jstep").alias("j"), "x")


def rows_stored(spark, sf):
    """The rows of customers with orders, fetched from their owners' folders."""
    path = scratch_path(spark, "rows")
    put_matrix(M.customers(spark, sf), path, "MC_MR", GRID)
    buyers = M.table(spark, sf, "orders").select(F.col("o_custkey").cast("bigint").alias("i"))
    return _cells(get_rows(spark, path, buyers))


def append(spark, sf):
    path = scratch_path(spark, "append")
    rows = M.orders(spark, sf)
    half = dims(rows, width=2)[0] // 2
    put_matrix(rows.where(F.col("i") < half), path, "VR_STAR", GRID)
    append_rows(rows.where(F.col("i") >= half), path)
    return _cells(get_matrix(spark, path))


def put_get_tuples(layout, spark, sf):
    path = scratch_path(spark, "cells")
    put_cells(M.event_counts(spark, sf), path, layout, GRID)
    return get_cells(spark, path)


def put_get_tiled(layout, spark, sf):
    path = scratch_path(spark, "tiles")
    put_tiles(to_blocks(M.embeddings(spark, sf), 32, 16), path, layout, GRID)
    return _cells(blocks_to_rows(get_tiles(spark, path)))


def reopened(spark, sf):
    """Two matrices stored in one folder, one of them opened by its name."""
    root = scratch_path(spark, "folder")
    put_matrix(M.suppliers(spark, sf), f"{root}/first", "VC_STAR", GRID, name="suppliers")
    put_matrix(M.customers(spark, sf), f"{root}/second", "MC_MR", GRID, name="customers")
    return _cells(open_matrix(spark, root, "customers"))


def compacted(spark, sf):
    """Orders stored in two writes, made one, and the files of the earlier ones deleted."""
    path = scratch_path(spark, "compact")
    rows = M.orders(spark, sf)
    half = dims(rows, width=2)[0] // 2
    put_matrix(rows.where(F.col("i") < half), path, "MR_STAR", GRID)
    append_rows(rows.where(F.col("i") >= half), path)
    compact_matrix(spark, path)
    remove_replaced(spark, path)
    return _cells(get_matrix(spark, path))


def moved(layout, grid, to_layout, to_grid, spark, sf):
    root = scratch_path(spark, "moved")
    put_matrix(M.embeddings(spark, sf), f"{root}/old", layout, grid)
    redistribute(spark, f"{root}/old", f"{root}/new", to_layout, to_grid)
    return _cells(get_matrix(spark, f"{root}/new"))


def ranges_stored(spark, sf):
    """A pair of ranges for every order, all in one query on stored tiles."""
    path = scratch_path(spark, "ranged")
    put_tiles(to_blocks(M.embeddings(spark, sf), 32, 16), path, "MC_MR", GRID)
    key, buyer = F.col("o_orderkey"), F.col("o_custkey").cast("bigint")
    asked = M.table(spark, sf, "orders").select(
        key.alias("request"),
        (key % 400).alias("row_start"),
        (key % 400 + buyer % 25).alias("row_end"),
        (1 + key % 3).alias("row_step"),
        (buyer % 50).alias("col_start"),
        (buyer % 50 + 9).alias("col_end"),
        (1 + buyer % 4).alias("col_step"),
    )
    return get_ranges(spark, path, asked)


def blocks_stored(spark, sf):
    path = scratch_path(spark, "blocks")
    put_blocks(to_blocks(M.embeddings(spark, sf), 32, 16), path)
    return _cells(blocks_to_rows(get_blocks(spark, path)))


def parse_dense(spark, sf):
    text = F.concat(F.lit("["), F.array_join(F.transform("v", lambda x: x.cast("string")), ","), F.lit("]"))
    written = M.embeddings(spark, sf).select("i", text.alias("text"))
    return _cells(parse_vectors(written, "i", "text"))


def parse_sparse(spark, sf):
    marks = M.labels(spark, sf).select("i", F.posexplode("v").alias("j", "x"))
    kept = F.sort_array(F.collect_list(F.when(F.col("x") != 0.0, F.struct("j", "x"))))
    lists = marks.groupBy("i").agg(kept.alias("c"))

    def listed(field):
        return F.array_join(F.transform("c", lambda c: c[field].cast("string")), ",")

    text = F.format_string("(2,[%s],[%s])", listed("j"), listed("x"))
    return _cells(parse_vectors(lists.select("i", text.alias("text")), "i", "text"))


# Handles


def info(spark, sf):
    return matrix_info(M.embeddings(spark, sf), "embeddings", "VC_STAR", GRID)


def info_gaps(spark, sf):
    return matrix_info(M.label_cells(spark, sf), "labels", "MC_MR", GRID).drop("stored_rows")


def description(spark, sf):
    return describe_matrix(matrix_info(M.orders(spark, sf), "orders", "VR_STAR", GRID))


def registered(spark, sf):
    register_matrix(M.suppliers(spark, sf), "supplier_matrix")
    return spark.sql("SELECT i, CAST(j AS BIGINT) AS j, x FROM supplier_matrix LATERAL VIEW posexplode(v) cells AS j, x")


def density(spark, sf):
    return matrix_density(M.event_counts(spark, sf))


def density_rows(spark, sf):
    return matrix_density(M.labels(spark, sf)).withColumn("density", F.round("density", 9))


# Forms


def fill(spark, sf):
    return _cells(zero_fill(M.labels(spark, sf), M.document_count(spark, sf), 2))


def dense_labels(spark, sf):
    return _cells(densify(M.label_cells(spark, sf), M.document_count(spark, sf), 2))


def coo_rows(spark, sf):
    return _cells(coo_to_rows(rows_to_coo(M.embeddings(spark, sf)), 64, unique=True))


def events_rows(spark, sf):
    return _cells(coo_to_rows(M.event_counts(spark, sf)))


def repeated_cells(spark, sf):
    """Customer x status counts straight from raw records: every order is a cell that adds one."""
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    raw = M.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("i"), status.cast("bigint").alias("j"), F.lit(1.0).alias("x")
    )
    return _cells(coo_to_rows(raw, 3))


def _tiles(blocks):
    return blocks.select("bi", "bj", "i0", "j0", "nr", "nc", F.posexplode_outer("data").alias("p", "x"))


def row_tiles(spark, sf):
    return _tiles(to_blocks(M.embeddings(spark, sf), 48, 20))


def gap_tiles(spark, sf):
    return blocks_to_cells(to_blocks(M.labels(spark, sf), 16, 2))


def cell_tiles(spark, sf):
    return _tiles(cells_to_blocks(M.event_counts(spark, sf), 32, 3))


def blocks_roundtrip(spark, sf):
    return _cells(blocks_to_rows(to_blocks(M.embeddings(spark, sf), 32, 16), unique=True))


def transpose_cells(spark, sf):
    return transpose(M.event_counts(spark, sf))


def transpose_tiles(spark, sf):
    return blocks_to_cells(transpose(to_blocks(M.embeddings(spark, sf), 48, 20)))


def transpose_rows(spark, sf):
    return _cells(transpose(M.embeddings(spark, sf)))


# Sparse rows


def sparse_events(spark, sf):
    return sparse_to_cells(sparse_rows(M.event_counts(spark, sf)))


def sparse_labels(spark, sf):
    return sparse_to_cells(sparse_rows(M.labels(spark, sf)))


def gram_sparse(matrix, spark, sf):
    return gramian_sparse(matrix(spark, sf))


def projected_sparse(spark, sf):
    return _cells(project_rows_sparse(M.order_parts(spark, sf), M.parts(spark, sf)))


def squares_sparse(spark, sf):
    return frobenius_sq(sparse_rows(M.order_parts(spark, sf)))


def density_sparse(spark, sf):
    return matrix_density(sparse_rows(M.event_counts(spark, sf)))


# Selection


def selected(spark, sf):
    buyers = M.table(spark, sf, "orders").select(F.col("o_custkey").alias("i"))
    return _cells(select_rows(M.customers(spark, sf), buyers))


def indices(spark, sf):
    return row_indices(M.orders(spark, sf))


def sliced_rows(spark, sf):
    rows = M.embeddings(spark, sf)
    m = dims(rows, width=64)[0]
    return _cells(block_slice(rows, (1, m - 1, 3), (2, 61, 5)))


def sliced_cells(spark, sf):
    cells = M.order_parts(spark, sf)
    m, n = dims(cells)
    return block_slice(cells, (0, m - 1, 2), (1, n - 1, 3))


def sliced_blocks(spark, sf):
    blocks = to_blocks(M.embeddings(spark, sf), 32, 16)
    m = dims(blocks)[0]
    return block_slice(blocks, (10, m - 10, 7), (5, 60, 4))


SLICES = [((0, 40, 4), (0, 30, 3)), ((20, 90, 5), (10, 63, 1)), (7, (0, 63, 2))]


def sliced_many(spark, sf):
    """Three overlapping pairs of ranges in one scan."""
    return block_slices(to_blocks(M.embeddings(spark, sf), 32, 16), SLICES, (32, 16))


def united(spark, sf):
    return union_rows(M.customers(spark, sf), M.suppliers(spark, sf)).select("i", F.posexplode("v").alias("j", "x"))


def common(spark, sf):
    placed = M.table(spark, sf, "orders").select(F.col("o_custkey").alias("i"))
    seen = M.table(spark, sf, "events").select(F.col("user_id").alias("i"))
    return common_rows(placed, seen)


# Layouts


def owners_of_cells(layout, spark, sf):
    return layout_assign(rows_to_coo(M.embeddings(spark, sf)), layout, GRID)


def owners_of_rows(layout, spark, sf):
    pieces = layout_assign(M.embeddings(spark, sf), layout, GRID)
    place = (F.col("j0") + F.col("p") * F.col("jstep")).cast("bigint")
    spread = pieces.select("i", "j0", "jstep", "a", "b", "owner", F.posexplode("v").alias("p", "x"))
    return spread.select("i", place.alias("j"), "x", "a", "b", "owner")


def ranges(spark, sf):
    handle = matrix_info(M.embeddings(spark, sf))
    per_layout = [layout_ranges(handle, name, GRID).withColumn("layout", F.lit(name)) for name in LAYOUTS]
    return reduce(DataFrame.unionByName, per_layout)


def moves(spark, sf):
    """What each worker sends to which when the embeddings go from MC_MR to VR_STAR on a 3 x 2 grid."""
    found = layout_moves(matrix_info(M.embeddings(spark, sf)), "MC_MR", GRID, "VR_STAR", Grid(3, 2))
    return found.withColumn("moves", F.col("moves").cast("int"))


def volume(layout, spark, sf):
    return layout_volume(M.embeddings(spark, sf), layout, GRID)


def routed(spark, sf):
    """Records per Spark partition and owner, each owner in a partition of its own."""
    pieces = route(layout_assign(M.orders(spark, sf), "VC_STAR", GRID), GRID)
    return pieces.groupBy(F.spark_partition_id().alias("partition"), "owner").agg(F.count("*").alias("records"))


def volume_orders(spark, sf):
    return layout_volume(M.orders(spark, sf), "VC_STAR", GRID)


def volume_cells(spark, sf):
    return layout_volume(M.event_counts(spark, sf), "MC_MR", GRID)


def grid_of_workers(spark, sf):
    """Rows owned per grid position."""
    owned = layout_assign(M.orders(spark, sf), "VR_STAR", GRID).groupBy(F.col("owner").alias("worker"))
    return grid_table(spark, GRID).join(owned.agg(F.count("*").alias("records")), "worker")


# Reductions and products


def squares(matrix, places, spark, sf):
    return frobenius_sq(matrix(spark, sf)).withColumn("frobenius_sq", F.round("frobenius_sq", places))


def norms(spark, sf):
    return row_norms(M.embeddings(spark, sf)).withColumn("norm", rounded("norm"))


def _reversed(spark, sf):
    rows = M.embeddings(spark, sf)
    m = dims(rows, width=64)[0]
    return rows.select((m - 1 - F.col("i")).alias("i"), "v")


def distances(spark, sf):
    found = row_sqdist(M.embeddings(spark, sf), _reversed(spark, sf))
    return found.withColumn("sqdist", rounded("sqdist"))


def dots(spark, sf):
    return row_dots(M.embeddings(spark, sf), _reversed(spark, sf)).withColumn("dot", rounded("dot"))


def gram(matrix, spark, sf):
    return _cells(gramian(matrix(spark, sf)), 6)


def gram_panels(spark, sf):
    return blocks_to_cells(gramian_panels(M.embeddings(spark, sf), 64, 24)).withColumn("x", rounded("x"))


def gram_panels_wide(spark, sf):
    """The Gram matrix of 4,800 columns, summed up by row where its tiles lie: diagonal, sum and sum of squares."""
    wide = coo_to_rows(M.event_buckets(spark, sf), M.EVENT_COLUMNS, unique=True)
    cells = blocks_to_cells(gramian_panels(wide, M.EVENT_COLUMNS))
    own = F.sum(F.when(F.col("i") == F.col("j"), F.col("x")).otherwise(0.0))
    return cells.groupBy("i").agg(own.alias("own"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"))


def projected(spark, sf):
    right = coo_to_rows(M.centroids(spark, sf), unique=True)
    return _cells(project_rows(M.embeddings(spark, sf), right), 6)


def product_rows(spark, sf):
    right = coo_to_rows(M.centroids(spark, sf), unique=True)
    return _cells(matmul(M.embeddings(spark, sf), right), 6)


def product_blocks(spark, sf):
    left = to_blocks(M.embeddings(spark, sf), 32, 16)
    right = cells_to_blocks(M.centroids(spark, sf), 16, 4, unique=True)
    return blocks_to_cells(matmul(left, right)).withColumn("x", rounded("x"))


def product_cells(spark, sf):
    """Quantity-weighted part attributes per order: sparse x thin, integer-valued."""
    return matmul(M.order_parts(spark, sf), rows_to_coo(M.parts(spark, sf)))


# Comparison


def differences(spark, sf):
    rows = M.customers(spark, sf)
    cut = rows.select("i", F.transform("v", lambda x: F.floor(x).cast("double")).alias("v"))
    return matrix_diff(rows, cut, 0.25)


def differences_absent(spark, sf):
    rows = M.labels(spark, sf)
    toxic = rows.where(F.col("v")[1] > 0)
    return matrix_diff(rows, toxic)


def differences_cells(spark, sf):
    dense = rows_to_coo(M.labels(spark, sf))
    doubled = M.label_cells(spark, sf).withColumn("x", F.col("x") * 2)
    return matrix_diff(dense, doubled, 0.5)


def differences_tiles(spark, sf):
    rows, m = M.labels(spark, sf), M.document_count(spark, sf)
    toxic = rows.where(F.col("v")[1] > 0)
    return matrix_diff(to_blocks(rows, 16, 2, m, 2), to_blocks(toxic, 16, 2, m, 2))


def differences_stored(spark, sf):
    path = scratch_path(spark, "diff")
    rows = M.embeddings(spark, sf)
    put_matrix(rows, path, "MC_MR", GRID)
    return matrix_diff(rows, get_matrix(spark, path))


# Singular value decomposition


def sigma(matrix, method, places, spark, sf):
    found = truncated_svd(matrix(spark, sf), 2, method).S
    return found.select("k", F.round("sigma", places).alias("sigma"))


def right_vectors(spark, sf):
    return _cells(truncated_svd(M.parts(spark, sf), 2).V, 6)


def left_vectors(spark, sf):
    return _cells(truncated_svd(M.parts(spark, sf), 2).U, 6)


def error_2col(spark, sf):
    rows = M.parts(spark, sf)
    found = relative_error(rows, truncated_svd(rows, 1).V)
    return found.select(F.round("relative_error", 9).alias("relative_error"))


def full_reconstruct(spark, sf):
    """U.S.V' with all columns kept gives the matrix back."""
    rows = M.embeddings(spark, sf)
    svd = truncated_svd(rows, 64)
    scaled = rows_to_coo(svd.V).join(svd.S, F.col("j") == F.col("k"))
    right = scaled.select(F.col("j").alias("i"), F.col("i").alias("j"), (F.col("sigma") * F.col("x")).alias("x"))
    return _cells(project_rows(svd.U, coo_to_rows(right, 64, unique=True)), 6)


def gram_reconstruct(spark, sf):
    """V.S^2.V' with all columns kept gives the Gram matrix."""
    svd = truncated_svd(M.embeddings(spark, sf), 64)
    basis = rows_to_coo(svd.V)
    scaled = basis.join(svd.S, F.col("j") == F.col("k"))
    left = scaled.select("i", "j", (F.col("x") * F.col("sigma") * F.col("sigma")).alias("x"))
    return matmul(left, transpose(basis)).withColumn("x", rounded("x"))


def orthonormal(side, spark, sf):
    svd = truncated_svd(M.embeddings(spark, sf), 64)
    return _cells(gramian(svd.U if side == "U" else svd.V), 6)


def energy(method, spark, sf):
    """The squares of all singular values add up to the squared Frobenius norm."""
    found = truncated_svd(M.embeddings(spark, sf), 64, method).S
    return found.agg(F.round(F.sum(F.col("sigma") * F.col("sigma")), 6).alias("frobenius_sq"))


def sigma_wide(spark, sf):
    """The five largest singular values of a matrix with a column for every order."""
    found = truncated_svd(M.nation_orders(spark, sf), 5, "bidiagonal").S
    return found.select("k", F.round("sigma", 2).alias("sigma"))


def vectors_wide(side, spark, sf):
    svd = truncated_svd(M.nation_orders(spark, sf), 5, "bidiagonal")
    return _cells(svd.U if side == "U" else svd.V, 6)


def sigma_small(spark, sf):
    """Singular values down to 3e-9 of the largest, as logarithms."""
    found = truncated_svd(M.fading_nation_orders(spark, sf), 18, "bidiagonal", rcond=1e-11).S
    return found.select("k", F.round(F.ln("sigma"), 3).alias("ln_sigma"))


def sigma_brands(method, spark, sf):
    """Five of fifty singular values."""
    found = truncated_svd(M.brand_parts(spark, sf), 5, method).S
    return found.select("k", F.round("sigma", 6).alias("sigma"))


def vectors_brands(side, method, spark, sf):
    svd = truncated_svd(M.brand_parts(spark, sf), 5, method)
    return _cells(svd.U if side == "U" else svd.V, 6)


def spectrum_brands(spark, sf):
    rows = M.brand_parts(spark, sf)
    svd = truncated_svd(rows, 5)
    error = relative_error(rows, svd.V).select("relative_error").scalar()
    return svd.S.select("k", F.round("sigma", 6).alias("sigma"), F.round(error, 9).alias("relative_error"))


def errors_brands(spark, sf):
    rows = M.brand_parts(spark, sf)
    found = relative_error(rows, truncated_svd(rows, 5).V)
    return found.select(F.round("squared_error", 4).alias("squared_error"), "frobenius_sq", F.round("relative_error", 9).alias("relative_error"))


def sum_of_errors_brands(spark, sf):
    rows = M.brand_parts(spark, sf)
    found = reconstruction_error(rows, truncated_svd(rows, 5).V)
    return found.select(F.round("squared_error", 4).alias("squared_error"))


def reconstruct_brands(spark, sf):
    rows = M.brand_parts(spark, sf)
    return _cells(reconstruct(rows, truncated_svd(rows, 5).V), 6)


def svd_part(part, method, spark, sf):
    found = truncated_svd(M.embeddings(spark, sf), 5, method)
    return found.S if part == "S" else _cells(found.U if part == "U" else found.V)


def svd_errors(spark, sf):
    rows = M.embeddings(spark, sf)
    return relative_error(rows, truncated_svd(rows, 5).V)


def svd_sum_of_errors(spark, sf):
    rows = M.embeddings(spark, sf)
    return reconstruction_error(rows, truncated_svd(rows, 5).V)


def svd_reconstruct(spark, sf):
    rows = M.embeddings(spark, sf)
    return _cells(reconstruct(rows, truncated_svd(rows, 5).V))


def svd_spectrum(spark, sf):
    """Singular values of the rank-5 approximation with its relative error."""
    rows = M.embeddings(spark, sf)
    svd = truncated_svd(rows, 5)
    error = relative_error(rows, svd.V).select("relative_error").scalar()
    return svd.S.withColumn("relative_error", error)


# SQL functions


def sql_function(text, spark, sf):
    register_functions(spark)
    M.embeddings(spark, sf).createOrReplaceTempView("embedding_rows")
    _reversed(spark, sf).createOrReplaceTempView("embedding_rows_reversed")
    return spark.sql(text)


SQL_TEXTS = {
    "sql_vec_norm": "SELECT i, round(vec_norm(v), 6) AS norm FROM embedding_rows",
    "sql_vec_dot": """
        SELECT a.i, CASE WHEN abs(vec_dot(a.v, b.v)) < 5e-7 THEN 0D ELSE round(vec_dot(a.v, b.v), 6) END AS dot
        FROM embedding_rows a JOIN embedding_rows_reversed b ON a.i = b.i""",
    "sql_vec_sqdist": """
        SELECT a.i, CASE WHEN vec_sqdist(a.v, b.v) < 5e-7 THEN 0D ELSE round(vec_sqdist(a.v, b.v), 6) END AS sqdist
        FROM embedding_rows a JOIN embedding_rows_reversed b ON a.i = b.i""",
    "sql_vec_cells": "SELECT r.i, c.j, c.x FROM embedding_rows r, LATERAL vec_cells(r.v) c",
}


def all_queries() -> dict[str, Query]:
    """Every registered query by name."""
    found: dict[str, Query] = {
        "read_libsvm_matrix": read_libsvm,
        "random_matrix": random_from_spine,
        "row_spine": spine,
        "append_rows": append,
        "put_get_blocks": blocks_stored,
        "get_rows_stored": rows_stored,
        "parse_vectors": parse_dense,
        "parse_vectors_sparse": parse_sparse,
        "matrix_info": info,
        "matrix_info_cells": info_gaps,
        "describe_matrix": description,
        "register_matrix": registered,
        "matrix_density": density,
        "matrix_density_rows": density_rows,
        "zero_fill": fill,
        "densify": dense_labels,
        "rows_to_coo": lambda spark, sf: rows_to_coo(M.embeddings(spark, sf)),
        "coo_to_rows": coo_rows,
        "coo_from_events": events_rows,
        "coo_repeated_cells": repeated_cells,
        "to_blocks": row_tiles,
        "to_blocks_gaps": gap_tiles,
        "cells_to_blocks": cell_tiles,
        "blocks_roundtrip": blocks_roundtrip,
        "transpose": transpose_cells,
        "transpose_blocks": transpose_tiles,
        "transpose_rows": transpose_rows,
        "select_rows": selected,
        "row_indices": indices,
        "block_slice": sliced_rows,
        "block_slice_cells": sliced_cells,
        "block_slice_blocks": sliced_blocks,
        "union_rows": united,
        "common_rows": common,
        "layout_ranges": ranges,
        "layout_volume_orders": volume_orders,
        "layout_volume_cells": volume_cells,
        "grid_table": grid_of_workers,
        "frobenius_sq": partial(squares, M.embeddings, 6),
        "frobenius_sq_lines": partial(squares, M.lines, 4),
        "row_norms": norms,
        "row_sqdist": distances,
        "row_dots": dots,
        "gramian": partial(gram, M.embeddings),
        "gramian_lines": partial(gram, M.lines),
        "project_rows": projected,
        "matmul": product_cells,
        "matmul_rows": product_rows,
        "matmul_blocks": product_blocks,
        "matrix_diff": differences,
        "matrix_diff_absent": differences_absent,
        "matrix_diff_cells": differences_cells,
        "matrix_diff_stored": differences_stored,
        "svd_s_2col": partial(sigma, M.parts, "gram", 6),
        "svd_s_2col_tsqr": partial(sigma, M.parts, "tsqr", 6),
        "svd_s_2col_krylov": partial(sigma, M.parts, "krylov", 6),
        "svd_s_lines": partial(sigma, M.line_pairs, "gram", 6),
        "svd_v_2col": right_vectors,
        "svd_u_2col": left_vectors,
        "relative_error_2col": error_2col,
        "svd_full_reconstruct": full_reconstruct,
        "svd_gram_reconstruct": gram_reconstruct,
        "svd_orthonormal_u": partial(orthonormal, "U"),
        "svd_orthonormal_v": partial(orthonormal, "V"),
        "svd_energy": partial(energy, "gram"),
        "svd_energy_tsqr": partial(energy, "tsqr"),
        "svd_energy_krylov": partial(energy, "krylov"),
        "put_get_cells_mc_mr": partial(put_get_tuples, "MC_MR"),
        "put_get_cells_star_vr": partial(put_get_tuples, "STAR_VR"),
        "put_get_tiles_mc_mr": partial(put_get_tiled, "MC_MR"),
        "put_get_tiles_mr_star": partial(put_get_tiled, "MR_STAR"),
        "read_matrix_source": partial(read_source, M.embeddings, "VC_STAR"),
        "read_matrix_source_orders": partial(read_source, M.orders, "MR_STAR"),
        "read_matrix_source_pieces": partial(read_source, M.embeddings, "MC_MR"),
        "reopen_matrix": reopened,
        "compact_matrix": compacted,
        "redistribute_mc_mr_to_vr_star": partial(moved, "MC_MR", GRID, "VR_STAR", Grid(3, 2)),
        "redistribute_vc_star_to_star_vr": partial(moved, "VC_STAR", GRID, "STAR_VR", GRID),
        "redistribute_mc_mr_to_mr_mc": partial(moved, "MC_MR", GRID, "MR_MC", Grid(2, 2)),
        "layout_moves": moves,
        "block_ranges_stored": ranges_stored,
        "matrix_diff_blocks": differences_tiles,
        "read_libsvm_sparse": read_sparse,
        "sparse_rows": sparse_events,
        "sparse_rows_labels": sparse_labels,
        "gramian_sparse": partial(gram_sparse, M.order_parts),
        "gramian_sparse_events": partial(gram_sparse, M.event_counts),
        "project_rows_sparse": projected_sparse,
        "frobenius_sq_sparse": squares_sparse,
        "matrix_density_sparse": density_sparse,
        "block_slices": sliced_many,
        "route": routed,
        "gramian_panels": gram_panels,
        "gramian_panels_wide": gram_panels_wide,
        "svd_s_wide": sigma_wide,
        "svd_v_wide": partial(vectors_wide, "V"),
        "svd_u_wide": partial(vectors_wide, "U"),
        "svd_s_small": sigma_small,
        "svd_s_brands": partial(sigma_brands, "auto"),
        "svd_s_brands_krylov": partial(sigma_brands, "krylov"),
        "svd_s_brands_tsqr": partial(sigma_brands, "tsqr"),
        "svd_s_brands_bidiagonal": partial(sigma_brands, "bidiagonal"),
        "svd_u_brands": partial(vectors_brands, "U", "auto"),
        "svd_v_brands": partial(vectors_brands, "V", "auto"),
        "svd_spectrum_brands": spectrum_brands,
        "relative_error_brands": errors_brands,
        "reconstruction_error_brands": sum_of_errors_brands,
        "reconstruct_brands": reconstruct_brands,
        "svd_s": partial(svd_part, "S", "auto"),
        "svd_u": partial(svd_part, "U", "auto"),
        "svd_v": partial(svd_part, "V", "auto"),
        "svd_s_krylov": partial(svd_part, "S", "krylov"),
        "svd_spectrum": svd_spectrum,
        "relative_error": svd_errors,
        "reconstruction_error": svd_sum_of_errors,
        "reconstruct": svd_reconstruct,
    }
    for name in LAYOUTS:
        found[f"layout_assign_{name.lower()}"] = partial(owners_of_cells, name)
        found[f"layout_pieces_{name.lower()}"] = partial(owners_of_rows, name)
    for name in ("MC_MR", "VC_STAR", "MR_STAR", "STAR_STAR"):
        found[f"layout_volume_{name.lower()}"] = partial(volume, name)
    for name in LAYOUTS:
        found[f"put_get_{name.lower()}"] = partial(put_get, M.embeddings, name)
    found["put_get_orders"] = partial(put_get, M.orders, "VC_STAR")
    for name, text in SQL_TEXTS.items():
        found[name] = partial(sql_function, text)
    return found
