"""Size bounds that decide between a broadcast or driver-side path and a shuffled one.

Every object that is broadcast or held on the driver is checked against one of these first.
"""

# Longest dense row (doubles) that may exist as one ARRAY<DOUBLE> value: 32 MiB.
MAX_ROW_WIDTH = 1 << 22

# Largest dense factor (bytes) shipped to every task.
BROADCAST_BYTES = 256 << 20

# Largest dense working set (bytes) the driver may hold during a factorisation.
DRIVER_BYTES = 1 << 30

# Widest matrix whose n x n Gram matrix is formed and decomposed on the driver (128 MiB).
GRAM_MAX_COLS = 4096

# Widest matrix handled by tall-skinny QR; one n x n factor travels as a single value (32 MiB).
QR_MAX_COLS = 2048

# Longest short side of a matrix that bidiagonalisation reduces to its R factor first (2 MiB).
SHORT_SIDE = 512

# Up to this width the Gram matrix is a handful of plain SQL sums.
SQL_GRAM_COLS = 8

# Bytes of the partial result that a task holds when it multiplies dense rows by a block of vectors.
DENSE_STEP_BYTES = 64 << 20

# Bytes of the partial result tiles that a task adds up before it passes them on.
TILE_SUM_BYTES = 128 << 20

# Bytes of one shuffled piece of a partial sum.
PIECE_BYTES = 64 << 10

# Partial sums of one piece that a task of the first level adds up.
PARTIALS_PER_SUM = 64


def check_row_width(n: int) -> int:
    """Refuse a dense row too long for one array value."""
    if n > MAX_ROW_WIDTH:
        raise ValueError(
            f"a dense row of {n} doubles exceeds {MAX_ROW_WIDTH}; keep the matrix in cell or block form"
        )
    return n


def check_driver_bytes(size: int, what: str) -> None:
    """Refuse a driver-side array beyond the agreed working set."""
    if size > DRIVER_BYTES:
        raise ValueError(f"{what} needs {size} bytes on the driver; the limit is {DRIVER_BYTES}")
