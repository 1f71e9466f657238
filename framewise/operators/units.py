"""Detections of a camera in units that have nothing to do with each other.

Two detections can only meet if they are at most ``SLAB`` frames and less than ``CELL`` px apart. Detections are put into
cells of that size; two of them can only meet if their cells are the same or touch. Units are the connected
components of touching cells, found in two steps without rounds: within blocks of frames, one task each, and then
between neighbouring blocks, for which only the cells on both sides of each border are looked at.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.schemas import MATCH_DISTANCE, MAX_MISSED_FRAMES
from framewise.settings import write_through

SLAB = MAX_MISSED_FRAMES + 1
CELL = MATCH_DISTANCE
# Slabs of a block: about sixteen thousand frames of one camera in a task.
BLOCK_SLABS = 256

# A place that touches all cells of the same slab and of those next to it.
EVERYWHERE = None

Cell = tuple[int, int | None, int | None]


class Joined:
    """Sets of numbers that are joined, each named by its smallest."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def join_touching(cells: list[Cell], joined: Joined) -> None:
    """Joins the numbers of touching cells (slab, x, y); x is ``EVERYWHERE`` for cells that touch a whole slab."""
    numbers = {cell: i for i, cell in enumerate(cells)}
    by_slab: dict[int, list[int]] = {}
    for i, (slab, _, _) in enumerate(cells):
        by_slab.setdefault(slab, []).append(i)
    # Half of the neighbours: the other half looks back.
    near = [d for d in product((0, 1), (-1, 0, 1), (-1, 0, 1)) if d > (0, 0, 0)]
    for i, (slab, x, y) in enumerate(cells):
        if x is EVERYWHERE:
            for other in (slab - 1, slab, slab + 1):
                for j in by_slab.get(other, ()):
                    joined.join(i, j)
        else:
            for ds, dx, dy in near:
                j = numbers.get((slab + ds, x + dx, y + dy))
                if j is not None:
                    joined.join(i, j)


def _cells(table: pa.Table) -> tuple[list[Cell], np.ndarray]:
    """The distinct cells of some rows, in order, and for each row the number of its cell."""
    columns = [table.column(c).to_pylist() for c in ("slab", "cell_x", "cell_y")]
    rows = list(zip(*columns, strict=True))
    cells = sorted(set(rows), key=lambda c: (c[0], c[1] is not None, c[1] or 0, c[2] or 0))
    numbers = {cell: i for i, cell in enumerate(cells)}
    return cells, np.fromiter((numbers[r] for r in rows), np.int64, len(rows))


def _with_parts(table: pa.Table) -> pa.Table:
    """Rows of a block with ``part``, their component within it."""
    cells, at = _cells(table)
    joined = Joined(len(cells))
    join_touching(cells, joined)
    roots = np.array([joined.root(i) for i in range(len(cells))], np.int64)
    return table.append_column("part", pa.array(roots[at]))


def _linked(table: pa.Table) -> pa.Table:
    """Parts of one camera's blocks, by their cells on borders, to the units they belong to."""
    rows = table.sort_by([("block", "ascending"), ("part", "ascending")]).to_pylist()
    parts = sorted({(r["block"], r["part"]) for r in rows})
    numbers = {p: i for i, p in enumerate(parts)}
    joined = Joined(len(parts))
    by_slab: dict[int, dict[tuple, int]] = {}
    for r in rows:
        by_slab.setdefault(r["slab"], {})[r["cell_x"], r["cell_y"]] = numbers[r["block"], r["part"]]
    for slab, here in by_slab.items():
        # Only borders of blocks: all else has been joined inside.
        beyond = by_slab.get(slab + 1) if (slab + 1) % BLOCK_SLABS == 0 else None
        if not beyond:
            continue
        cells = [(0, *c) for c in here] + [(1, *c) for c in beyond]
        owners = [*here.values(), *beyond.values()]
        touching = Joined(len(cells))
        join_touching(cells, touching)
        for i in range(len(cells)):
            joined.join(owners[i], owners[touching.root(i)])
    units = [parts[joined.root(i)] for i in range(len(parts))]
    columns = {
        "camera_id": pa.array([rows[0]["camera_id"]] * len(parts), pa.int64()),
        "block": pa.array([p[0] for p in parts], pa.int64()),
        "part": pa.array([p[1] for p in parts], pa.int64()),
        "unit_block": pa.array([u[0] for u in units], pa.int64()),
        "unit_part": pa.array([u[1] for u in units], pa.int64()),
    }
    return pa.table(columns)


def with_units(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``unit``, a number within the camera. Needs camera_id, at (a frame), cx and cy.

    In slabs that ``whole`` lists (camera_id, slab), everything is one unit, with all that touches it.
    """
    slab = F.floor(F.col("at") / SLAB)
    placed = rows.withColumns({"slab": slab, "cell_x": F.floor(F.col("cx") / CELL), "cell_y": F.floor(F.col("cy") / CELL)})
    if whole is not None:
        placed = placed.join(whole.withColumn("_whole", F.lit(True)), ["camera_id", "slab"], "left")
        alone = F.col("_whole").isNull()
        placed = placed.withColumns({c: F.when(alone, F.col(c)) for c in ("cell_x", "cell_y")}).drop("_whole")
    placed = placed.withColumn("block", F.floor(F.col("slab") / BLOCK_SLABS))
    schema = T.StructType([*placed.schema.fields, T.StructField("part", T.LongType())])
    parted = write_through(placed.groupBy("camera_id", "block").applyInArrow(_with_parts, schema), "unit-parts")

    border = F.pmod("slab", F.lit(BLOCK_SLABS)).isin(0, BLOCK_SLABS - 1)
    edges = parted.where(border).select("camera_id", "block", "slab", "cell_x", "cell_y", "part").distinct()
    links = edges.groupBy("camera_id").applyInArrow(_linked, "camera_id long, block long, part long, unit_block long, unit_part long")
    joined = parted.join(links, ["camera_id", "block", "part"], "left")
    # Parts that touch no border are units by themselves.
    unit = F.shiftleft(F.coalesce("unit_block", "block"), 32) + F.coalesce("unit_part", "part")
    return joined.withColumn("unit", unit).drop("slab", "cell_x", "cell_y", "block", "part", "unit_block", "unit_part")
