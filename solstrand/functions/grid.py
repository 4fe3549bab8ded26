"""Multi-resolution grid cells from longitude and latitude.

Resolution r cuts the globe into 2^r columns and 2^r rows.  A cell id is `row * 2^r + column`
within its resolution, so the cell one level up is found by halving row and column.  The ids are
NOT hexagon ids and cannot be matched with them; the use (count, aggregate and join per cell, at
resolutions 0 to 15) is the same.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

FINEST = 15


def _steps(value: Column, low: float, width: float, resolution: int) -> Column:
    last = (1 << resolution) - 1
    step = F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(1 << resolution)))
    # The upper edge (180 or 90 degrees) belongs to the last cell.
    return F.when(value == low + width, F.lit(last).cast("bigint")).otherwise(step)


def cell(longitude: Column, latitude: Column, resolution: int = FINEST) -> Column:
    """Cell id as BIGINT; NULL if a coordinate is NULL or off the globe."""
    if not 0 <= resolution <= FINEST:
        raise ValueError(f"resolution must be 0..{FINEST}, got {resolution}")
    column = _steps(longitude, -180.0, 360.0, resolution)
    row = _steps(latitude, -90.0, 180.0, resolution)
    on_globe = longitude.between(-180, 180) & latitude.between(-90, 90)
    return F.when(on_globe, row * (1 << resolution) + column)


def coarser(cell_id: Column, resolution: int, target: Column | int) -> Column:
    """The cell at `target` (<= resolution) that holds a cell of `resolution`."""
    target = F.lit(target) if isinstance(target, int) else target.cast("int")
    levels = F.lit(resolution) - target
    row = F.shiftright(cell_id, resolution)
    column = cell_id.bitwiseAND(F.lit((1 << resolution) - 1).cast("bigint"))
    shifted_row = F.call_function("shiftright", row, levels)
    shifted_column = F.call_function("shiftright", column, levels)
    return F.call_function("shiftleft", shifted_row, target) + shifted_column


def cell_columns(
    prefix: str, finest: str, resolutions: Iterable[int] = range(FINEST + 1)
) -> list[Column]:
    """`<prefix>_cell_res_0` .. `<prefix>_cell_res_15` from the column of the finest cell id.

    The coordinates are looked at once, for the finest cell; the others are shifts of it.
    """
    row, column = f"shiftright({finest}, {FINEST})", f"({finest} & {(1 << FINEST) - 1}L)"
    return [
        F.expr(
            f"shiftleft(shiftright({row}, {FINEST - r}), {r}) + shiftright({column}, {FINEST - r})"
            f" AS {prefix}_cell_res_{r}"
        )
        for r in resolutions
    ]
