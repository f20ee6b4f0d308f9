"""Process grids and the names of the element-cyclic layouts over them."""

from dataclasses import dataclass
from math import lcm

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """An r x c grid of owners; owner (a, b) has number a + b*r."""

    rows: int
    cols: int

    def __post_init__(self):
        if self.rows < 1 or self.cols < 1:
            raise ValueError(f"a grid needs at least one row and one column, not {self.rows} x {self.cols}")

    @property
    def size(self) -> int:
        return self.rows * self.cols

    def owner(self, a, b) -> Column:
        return (a + b * self.rows).cast("int")


@dataclass(frozen=True)
class Layout:
    """Code and printed label of a layout."""

    code: int
    label: str


# Layout names, codes and labels of the public element-cyclic matrix distributions.
# A name's first half says how rows are dealt, its second half how columns are.
LAYOUTS = {
    "MC_MR": Layout(0, "MC/MR"),
    "MC_STAR": Layout(1, "MC/STAR"),
    "MD_STAR": Layout(2, "MD/STAR"),
    "MR_MC": Layout(3, "MR/MC"),
    "MR_STAR": Layout(4, "MR/STAR"),
    "STAR_MC": Layout(5, "STAR/MC"),
    "STAR_MD": Layout(6, "STAR/MD"),
    "STAR_MR": Layout(7, "STAR/MR"),
    "STAR_STAR": Layout(8, "STAR/STAR"),
    "STAR_VC": Layout(9, "STAR/VC"),
    "STAR_VR": Layout(10, "STAR/VR"),
    "VC_STAR": Layout(11, "VC/STAR"),
    "VR_STAR": Layout(12, "VR/STAR"),
    "CIRC_CIRC": Layout(13, "CIRC/CIRC"),
}


def _deal(kind: str, x, grid: Grid):
    """Grid coordinates (a, b) fixed by one index under one dealing rule; None where it leaves one free."""
    r, c = grid.rows, grid.cols
    if kind == "MC":
        return x % r, None
    if kind == "MR":
        return None, x % c
    if kind == "VC":
        rank = x % grid.size
        return rank % r, F.floor(rank / r)
    if kind == "VR":
        rank = x % grid.size
        return F.floor(rank / c), rank % c
    if kind == "MD":
        return x % r, x % c
    if kind == "CIRC":
        return F.lit(0), F.lit(0)
    return None, None


def coordinates(layout: str, i, j, grid: Grid):
    """Owner coordinates (a, b) of cell (i, j); a coordinate left as None means a copy on every value of it."""
    by_row, by_col = layout.split("_")
    row_a, row_b = _deal(by_row, i, grid)
    col_a, col_b = _deal(by_col, j, grid)
    a = col_a if row_a is None else row_a
    b = col_b if row_b is None else row_b
    return a, b


def _step(kind: str, grid: Grid) -> int:
    """Stride between indices that one owner holds under one dealing rule."""
    steps = {"MC": grid.rows, "MR": grid.cols, "VC": grid.size, "VR": grid.size, "MD": lcm(grid.rows, grid.cols)}
    return steps.get(kind, 1)


def row_step(layout: str, grid: Grid) -> int:
    return _step(layout.split("_")[0], grid)


def column_step(layout: str, grid: Grid) -> int:
    return _step(layout.split("_")[1], grid)
