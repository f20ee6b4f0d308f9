"""Matrices as Spark tables: conversion, selection, layouts, products and truncated SVD.

A matrix is a DataFrame in one of four forms:

* rows:   ``i BIGINT, v ARRAY<DOUBLE>``                       one dense row per record
* sparse: ``i BIGINT, idx ARRAY<BIGINT>, val ARRAY<DOUBLE>``     the stored elements of a row, absent = 0.0
* cells:  ``i BIGINT, j BIGINT, x DOUBLE``                    one entry per record, absent = 0.0
* blocks: ``bi, bj, i0, j0 BIGINT, nr, nc INT, data ARRAY<DOUBLE>``  row-major tiles
"""

from pyspark import cloudpickle

from rowloom import kernels
from rowloom.functions.sql import register_functions
from rowloom.operators.catalog import (
    describe_matrix,
    duplicate_rows,
    matrix_density,
    matrix_info,
    register_matrix,
    require_unique,
)
from rowloom.operators.compare import matrix_diff
from rowloom.operators.factorize import (
    SVD,
    reconstruct,
    reconstruction_error,
    relative_error,
    truncated_svd,
)
from rowloom.operators.forms import (
    as_rows,
    blocks_to_cells,
    blocks_to_rows,
    cells_to_blocks,
    coo_to_rows,
    densify,
    form_of,
    rows_to_coo,
    to_blocks,
    to_rows,
    transpose,
    zero_fill,
)
from rowloom.operators.layouts import (
    LAYOUTS,
    Grid,
    grid_table,
    layout_assign,
    layout_moves,
    layout_ranges,
    layout_volume,
    route,
)
from rowloom.operators.products import collect_dense, gramian, gramian_panels, local_rows, matmul, project_rows
from rowloom.operators.reductions import frobenius_sq, row_dots, row_norms, row_sqdist
from rowloom.operators.selection import (
    block_ranges,
    block_slice,
    block_slices,
    common_rows,
    row_indices,
    row_spine,
    select_rows,
    union_rows,
)
from rowloom.operators.sparse import gramian_sparse, project_rows_sparse, sparse_rows, sparse_to_cells, sparse_to_rows
from rowloom.sources import matrix_source
from rowloom.sources.libsvm import read_libsvm_matrix, read_libsvm_sparse
from rowloom.sources.matrix_source import register_source
from rowloom.sources.random import random_matrix, random_rows
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
    stored_matrices,
)
from rowloom.sources.text import parse_vectors

# Executors receive the task helpers with the task itself, so the library needs no installation there.
cloudpickle.register_pickle_by_value(kernels)
cloudpickle.register_pickle_by_value(matrix_source)
