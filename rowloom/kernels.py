"""Numpy helpers that run inside Spark tasks on Arrow batches.

The module is pickled by value (see ``rowloom/__init__.py``), so executors need no installed copy.
Every helper streams its partition: memory is one batch plus one accumulator of known size.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PARTIAL_SCHEMA = "c bigint, part binary"
ROW_SCHEMA = "i bigint, v array<double>"
BLOCK_COLUMNS = ["bi", "bj", "i0", "j0", "nr", "nc", "data"]
PART_SCHEMA = "bi bigint, bj bigint, i0 bigint, j0 bigint, nr int, nc int, part binary"
BLOCK_SCHEMA = "bi bigint, bj bigint, i0 bigint, j0 bigint, nr int, nc int, data array<double>"


def dense(column: pa.Array, n: int) -> np.ndarray:
    """A list column as a (rows, n) float64 array; ragged rows and nulls are errors."""
    if column.null_count:
        raise ValueError("matrix has a NULL row vector")
    lengths = pc.list_value_length(column)
    if len(lengths) and (pc.min(lengths).as_py() != n or pc.max(lengths).as_py() != n):
        raise ValueError(f"matrix row of a length other than {n}")
    values = column.flatten()
    if values.null_count:
        raise ValueError("matrix has a NULL element")
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), n)


def row_batch(index, matrix: np.ndarray) -> pa.RecordBatch:
    """A row-form batch from an index array and a 2-d array."""
    rows, n = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(n)
    vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(index, pa.int64()), vectors], ["i", "v"])


def row_slices(batch: pa.RecordBatch, n: int):
    """Cut a batch so that one dense slice stays near 32 MiB, whatever the row width."""
    step = max(1, (4 << 20) // max(n, 1))
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)


def pieces(total: np.ndarray, piece_bytes: int):
    """Cut an accumulator into row chunks keyed by their first row, a few MiB per batch."""
    step = max(1, piece_bytes // max(1, total.shape[1] * 8))
    starts = list(range(0, total.shape[0], step))
    per_batch = max(1, (4 << 20) // piece_bytes)
    for lo in range(0, len(starts), per_batch):
        part = starts[lo : lo + per_batch]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([total[s : s + step].tobytes() for s in part], pa.binary())],
            ["c", "part"],
        )


def gram_partials(n: int, piece_bytes: int):
    """Partial X'X of one partition of vectors (column ``v``)."""

    def run(batches):
        total = None
        for batch in batches:
            for cut in row_slices(batch, n):
                x = dense(cut.column("v"), n)
                total = np.zeros((n, n)) if total is None else total
                total += x.T @ x
        if total is not None:
            yield from pieces(total, piece_bytes)

    return run


def whitened_partials(w: np.ndarray, piece_bytes: int):
    """Partial (XW)'(XW) of one partition of vectors."""

    def run(batches):
        total = None
        for batch in batches:
            for cut in row_slices(batch, w.shape[0]):
                x = dense(cut.column("v"), w.shape[0]) @ w
                total = np.zeros((w.shape[1], w.shape[1])) if total is None else total
                total += x.T @ x
        if total is not None:
            yield from pieces(total, piece_bytes)

    return run


def cross_partials(n: int, width: int, piece_bytes: int):
    """Partial X'U of one partition of pairs of vectors (columns ``v`` and ``u``)."""

    def run(batches):
        total = None
        for batch in batches:
            for cut in row_slices(batch, n):
                total = np.zeros((n, width)) if total is None else total
                total += dense(cut.column("v"), n).T @ dense(cut.column("u"), width)
        if total is not None:
            yield from pieces(total, piece_bytes)

    return run


def panel_partials(n: int, panel: int, pairs: list):
    """Partial tiles X_p'X_q of one partition of vectors, for pairs of column panels."""

    def run(batches):
        total = None
        for batch in batches:
            for cut in row_slices(batch, n):
                x = dense(cut.column("v"), n)
                cuts = {p: x[:, p * panel : (p + 1) * panel] for pair in pairs for p in pair}
                if total is None:
                    total = {(p, q): np.zeros((cuts[p].shape[1], cuts[q].shape[1])) for p, q in pairs}
                for (p, q), tile in total.items():
                    tile += cuts[p].T @ cuts[q]
        for (p, q), tile in (total or {}).items():
            yield part_batch((p, q, p * panel, q * panel, *tile.shape), tile)

    return run


def part_batch(head: tuple, tile: np.ndarray) -> pa.RecordBatch:
    """A partial tile (bi, bj, i0, j0, nr, nc, part)."""
    columns = [pa.array([x], t) for x, t in zip(head, [pa.int64()] * 4 + [pa.int32()] * 2)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([tile.tobytes()], pa.binary())], PART_COLUMNS)


PART_COLUMNS = ["bi", "bj", "i0", "j0", "nr", "nc", "part"]


def normal_partials(q: np.ndarray, piece_bytes: int):
    """Partial X'(XQ) of one partition of vectors."""

    def run(batches):
        total = None
        for batch in batches:
            for cut in row_slices(batch, q.shape[0]):
                x = dense(cut.column("v"), q.shape[0])
                total = np.zeros(q.shape) if total is None else total
                total += x.T @ (x @ q)
        if total is not None:
            yield from pieces(total, piece_bytes)

    return run


def add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the pieces of one chunk from one group of tasks, batch by batch."""
    first, total = 0, None
    for batch in batches:
        first = batch.column("c")[0].as_py()
        for raw in batch.column("part"):
            part = np.frombuffer(raw.as_buffer(), dtype=np.float64)
            total = part.copy() if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["c", "part"])


def sum_pieces(width: int):
    """Add the pieces of one chunk, batch by batch, and emit its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = 0, None
        for batch in batches:
            first = batch.column("c")[0].as_py()
            for raw in batch.column("part"):
                part = np.frombuffer(raw.as_buffer(), dtype=np.float64)
                if total is None:
                    total = part.copy()
                else:
                    total += part
        matrix = total.reshape(-1, width)
        yield row_batch(np.arange(first, first + len(matrix)), matrix)

    return run


def ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def compressed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets, column indices and values of a batch of sparse rows; nulls and unequal lists are errors."""
    idx, val = batch.column("idx"), batch.column("val")
    if idx.null_count or val.null_count or idx.flatten().null_count or val.flatten().null_count:
        raise ValueError("matrix has a NULL element")
    counts = idx.value_lengths().to_numpy()
    if not np.array_equal(counts, val.value_lengths().to_numpy()):
        raise ValueError("indices and values differ in number")
    offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    j, x = idx.flatten().to_numpy(), val.flatten().to_numpy()
    inner = np.ones(len(j), dtype=bool)
    inner[offsets[:-1][counts > 0]] = False
    if len(j) and (j.min() < 0 or (np.diff(j, prepend=-1)[inner] <= 0).any()):
        raise ValueError("column indices are negative, repeat or do not ascend")
    return offsets, j, x


# Products of two elements that a sparse kernel holds at once: 16 bytes each, a few copies of them.
PAIRS = 1 << 20


def sparse_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper triangle of X'X of sparse rows as cells, equal ones added up, PAIRS products at a time."""
    for batch in batches:
        offsets, j, x = compressed(batch)
        names, code = np.unique(j, return_inverse=True)
        after = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(j))
        done = np.concatenate([[0], np.cumsum(after)])
        lo = 0
        while lo < len(j):
            hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, side="right")) - 1)
            first = np.repeat(np.arange(lo, hi), after[lo:hi])
            second = first + ragged(after[lo:hi])
            cell, kind = np.unique(code[first] * np.int64(len(names)) + code[second], return_inverse=True)
            sums = np.bincount(kind, weights=x[first] * x[second], minlength=len(cell))
            columns = [names[cell // len(names)], names[cell % len(names)], sums]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "x"])
            lo = hi


def sparse_project(b: np.ndarray):
    """Sparse row times ``b``, reading only the rows of ``b`` at the stored indices."""

    def run(batches):
        width = max(b.shape[1], 1)
        for batch in batches:
            offsets, j, x = compressed(batch)
            if len(j) and j.max() >= len(b):
                raise ValueError(f"column index {j.max()} outside a right factor of {len(b)} rows")
            out = np.zeros((batch.num_rows, b.shape[1]))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            step = max(1, (4 << 20) // width)
            for lo in range(0, len(j), step):
                hi = min(lo + step, len(j))
                opens = np.flatnonzero(np.diff(row[lo:hi], prepend=-1))
                out[row[lo:hi][opens]] += np.add.reduceat(x[lo:hi, None] * b[j[lo:hi]], opens, axis=0)
            yield row_batch(batch.column("i"), out)

    return run


def project(b: np.ndarray):
    """Row times ``b`` for every row."""

    def run(batches):
        for batch in batches:
            for cut in row_slices(batch, max(b.shape)):
                yield row_batch(cut.column("i"), dense(cut.column("v"), b.shape[0]) @ b)

    return run


def reproject(v: np.ndarray):
    """Row times V, then times V' - never the n x n product."""

    def run(batches):
        for batch in batches:
            for cut in row_slices(batch, v.shape[0]):
                yield row_batch(cut.column("i"), (dense(cut.column("v"), v.shape[0]) @ v) @ v.T)

    return run


def residual_sums(v: np.ndarray):
    """Per partition: sum of squared residuals against span(V) and sum of squares."""

    def run(batches):
        err, norm = 0.0, 0.0
        for batch in batches:
            for cut in row_slices(batch, v.shape[0]):
                x = dense(cut.column("v"), v.shape[0])
                err += float(np.square(x - (x @ v) @ v.T).sum())
                norm += float(np.square(x).sum())
        yield pa.RecordBatch.from_pydict({"err": [err], "norm": [norm]})

    return run


def stack_r(r, x: np.ndarray) -> np.ndarray:
    """R factor of ``x`` stacked under an earlier R factor."""
    return np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")


def opened(batch: pa.RecordBatch, n: int) -> np.ndarray:
    """Rows of a batch, dense (``v``) or sparse (``idx``, ``val``), as a (rows, n) array."""
    if "v" in batch.schema.names:
        return dense(batch.column("v"), n)
    offsets, j, x = compressed(batch)
    if len(j) and j.max() >= n:
        raise ValueError(f"column index {j.max()} outside a matrix of width {n}")
    out = np.zeros((batch.num_rows, n))
    out[np.repeat(np.arange(batch.num_rows), np.diff(offsets)), j] = x
    return out


def project_twice(first: np.ndarray, last: np.ndarray):
    """Row times ``first``, then times ``last``, for every dense or sparse row."""

    def run(batches):
        for batch in batches:
            for cut in row_slices(batch, max(first.shape)):
                yield row_batch(cut.column("i"), (opened(cut, len(first)) @ first) @ last)

    return run


def column_tops(count: int):
    """Largest magnitude in each column of one partition of vectors."""

    def run(batches):
        top = np.zeros(count)
        for batch in batches:
            for cut in row_slices(batch, count):
                top = np.maximum(top, np.abs(dense(cut.column("v"), count)).max(axis=0, initial=0.0))
        yield pa.RecordBatch.from_pydict({"j": np.arange(count), "x": top})

    return run


def first_tops(least: np.ndarray):
    """For each column of one partition, the element of smallest index whose magnitude is at least ``least``."""

    def run(batches):
        count, none = len(least), np.iinfo(np.int64).max
        at, value = np.full(count, none), np.zeros(count)
        for batch in batches:
            for cut in row_slices(batch, count):
                x = dense(cut.column("v"), count)
                index = np.where(np.abs(x) >= least, cut.column("i").to_numpy()[:, None], none)
                if len(x):
                    low = index.argmin(axis=0)
                    found = index[low, np.arange(count)]
                    value = np.where(found < at, x[low, np.arange(count)], value)
                    at = np.minimum(at, found)
        hit = np.flatnonzero(at < none)
        yield pa.RecordBatch.from_pydict({"j": hit, "i": at[hit], "x": value[hit]})

    return run


def qr_partials(n: int, factor: np.ndarray | None = None):
    """R factor of one partition of dense or sparse rows, times ``factor`` if given, keyed by the partition number."""

    def run(batches):
        from pyspark import TaskContext

        r = None
        for batch in batches:
            for cut in row_slices(batch, n):
                x = opened(cut, n)
                r = stack_r(r, x if factor is None else x @ factor)
        if r is not None:
            yield pa.RecordBatch.from_pydict({"c": [TaskContext.get().partitionId()], "part": [r.tobytes()]})

    return run


def merge_r(n: int):
    """R factor of all R factors of one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, r = 0, None
        for batch in batches:
            group = batch.column("c")[0].as_py()
            for raw in batch.column("part"):
                r = stack_r(r, np.frombuffer(raw.as_buffer(), dtype=np.float64).reshape(-1, n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([group], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["c", "part"]
        )

    return run


def transpose_blocks(batches):
    """Every block turned: row and column fields swapped, ``data`` transposed."""
    for batch in batches:
        sizes = zip(batch.column("nr").to_pylist(), batch.column("nc").to_pylist())
        turned = [
            data.values.to_numpy(zero_copy_only=False).reshape(nr, nc).T.ravel()
            for data, (nr, nc) in zip(batch.column("data"), sizes)
        ]
        swapped = [batch.column(name) for name in ("bj", "bi", "j0", "i0", "nc", "nr")]
        yield pa.RecordBatch.from_arrays(swapped + [pa.array(turned, pa.list_(pa.float64()))], BLOCK_COLUMNS)


def block_products(held_bytes: int):
    """Dense products of the two blocks in each row (``data`` is row-major, ``nk`` the inner size), added up by result.

    Up to ``held_bytes`` of result tiles are held; beyond that they are passed on as partial sums.
    """

    def run(batches):
        total, size = {}, 0
        for batch in batches:
            keys = [batch.column(name).to_pylist() for name in ("bi", "bj", "i0", "j0", "nr", "nk", "nc")]
            left, right = batch.column("a_data"), batch.column("b_data")
            for row, (bi, bj, i0, j0, nr, nk, nc) in enumerate(zip(*keys)):
                a = left[row].values.to_numpy(zero_copy_only=False).reshape(nr, nk)
                b = right[row].values.to_numpy(zero_copy_only=False).reshape(nk, nc)
                head = (bi, bj, i0, j0, nr, nc)
                if head in total:
                    total[head] += a @ b
                    continue
                if size + nr * nc * 8 > held_bytes:
                    yield from (part_batch(*held) for held in total.items())
                    total, size = {}, 0
                total[head] = a @ b
                size += nr * nc * 8
        yield from (part_batch(*held) for held in total.items())

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> tuple[tuple, np.ndarray]:
    """Head and sum of the partial tiles of one result, batch by batch."""
    head, total = None, None
    for batch in batches:
        head = head or tuple(batch.column(name)[0].as_py() for name in PART_COLUMNS[:-1])
        for raw in batch.column("part"):
            part = np.frombuffer(raw.as_buffer(), dtype=np.float64)
            if total is None:
                total = part.copy()
            else:
                total += part
    return head, total


def add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partial tiles of one result from one group of tasks."""
    yield part_batch(*_added(batches))


def sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partial tiles of one result block."""
    head, total = _added(batches)
    columns = [pa.array([x], t) for x, t in zip(head, [pa.int64()] * 4 + [pa.int32()] * 2)]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([total], pa.list_(pa.float64()))], BLOCK_COLUMNS)
