"""Stored matrices as a Spark data source: ``spark.read.format("rowloom").load(path)``, also from SQL.

The pieces of one copy are read in parallel, file by file, inside tasks. Comparisons on ``i`` reach the files, where row groups
that hold none of the wanted rows are skipped. Executors need pyarrow only: this module travels with the scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pds
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

#: Bytes of files that one task reads; a larger file is read by one task alone.
SPLIT_BYTES = 128 << 20
#: Bytes of row elements in one Arrow batch.
BATCH_BYTES = 4 << 20

_TESTS = {
    EqualTo: lambda i, x: i == x,
    GreaterThan: lambda i, x: i > x,
    GreaterThanOrEqual: lambda i, x: i >= x,
    LessThan: lambda i, x: i < x,
    LessThanOrEqual: lambda i, x: i <= x,
    In: lambda i, x: i.isin(list(x)),
}


def first_copy(layout: str, rows: int, cols: int) -> list[int] | None:
    """The owners on a grid of rows x cols that hold a layout's first copy; None where it keeps one copy only."""
    kinds = layout.split("_")
    if any(kind in ("VC", "VR", "MD", "CIRC") for kind in kinds) or {"MC", "MR"} <= set(kinds):
        return None
    if "MC" in kinds:
        return list(range(rows))
    return [b * rows for b in range(cols)] if "MR" in kinds else [0]


@dataclass
class Files(InputPartition):
    """What one task reads."""

    files: Sequence[str]
    batch_rows: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class MatrixSource(DataSource):
    """A matrix that ``put_matrix`` or ``redistribute`` stored: rows (i, v) where the layout keeps rows whole, else the
    pieces (i, j0, jstep, v), whose elements have the columns j0, j0 + jstep, ..."""

    @classmethod
    def name(cls) -> str:
        return "rowloom"

    def info(self) -> dict:
        """Layout, grid, width and writes, from the info records."""
        files, path = _opened(self.options["path"])
        records = pds.dataset(f"{path}/info", filesystem=files, format="parquet").to_table().to_pylist()
        replaced = {write for r in records for write in r["replaces"] or ()}
        records = [r for r in records if r["write"] not in replaced]
        if any(r["form"] != "rows" for r in records):
            raise ValueError("the matrix is not stored in rows")
        last = records[0]
        by_column = last["layout"].split("_")[1]
        return {
            "owners": first_copy(last["layout"], last["grid_rows"], last["grid_cols"]),
            "whole": by_column in ("STAR", "CIRC") and not any(r["mixed"] for r in records),
            "writes": sorted(r["write"] for r in records),
            "width": last["num_cols"],
        }

    def schema(self) -> str:
        return "i bigint, v array<double>" if self.info()["whole"] else "i bigint, j0 bigint, jstep bigint, v array<double>"

    def reader(self, schema) -> MatrixReader:
        return MatrixReader(self.options["path"], self.info(), schema.fieldNames())


class MatrixReader(DataSourceReader):
    """Reads the files of committed writes, several small ones in one task."""

    def __init__(self, path: str, info: dict, columns: list[str]):
        self.path, self.info, self.columns = path, info, columns
        self.tests: list[tuple[type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for found in filters:
            if type(found) in _TESTS and found.attribute == ("i",):
                self.tests.append((type(found), found.value))
            elif not (isinstance(found, IsNotNull) and found.attribute == ("i",)):  # a stored index is never null
                yield found

    def partitions(self) -> list[Files]:
        files, path = _opened(self.path)
        parts = pds.partitioning(pa.schema([("owner", pa.int32()), ("write", pa.string())]), flavor="hive")
        found = pds.dataset(f"{path}/pieces", filesystem=files, format="parquet", partitioning=parts)
        wanted = pc.field("write").isin(self.info["writes"])
        if self.info["owners"] is not None:
            wanted = wanted & pc.field("owner").isin(self.info["owners"])
        names = sorted(fragment.path for fragment in found.get_fragments(filter=wanted))
        sizes = [held.size for held in files.get_file_info(names)]
        rows = max(1, BATCH_BYTES // (8 * max(1, self.info["width"])))
        tasks, room = [], 0
        for name, size in zip(names, sizes):
            if not tasks or size > room:
                tasks.append(Files([], rows))
                room = SPLIT_BYTES
            tasks[-1].files.append(name)
            room -= size
        return tasks

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a matrix without files
            return
        files, _ = _opened(self.path)
        types = {"v": pa.list_(pa.float64())}
        schema = pa.schema([(c, types.get(c, pa.int64())) for c in self.columns])
        wanted = None
        for kind, value in self.tests:
            test = _TESTS[kind](pc.field("i"), value)
            wanted = test if wanted is None else wanted & test
        held = pds.dataset(list(partition.files), schema=schema, filesystem=files, format="parquet")
        yield from held.to_batches(
            filter=wanted, batch_size=partition.batch_rows, batch_readahead=1, fragment_readahead=1
        )


def register_source(spark: SparkSession) -> str:
    """Make the format known to a session and let comparisons reach it, which Spark leaves off; returns its name."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MatrixSource)
    return MatrixSource.name()
