"""An invertible grid of near-equal areas: point to cell id and back, in plain arithmetic.

Rows are bands of latitude; each holds as many cells as make them about square. An id packs
resolution, row and column, so the centre follows from the id alone. Ids are our own: they are not
those of any other grid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import valid_location

#: Degrees of a cell's side at resolution 6; seven times the area for each step down.
BASE_DEGREES, BASE_RESOLUTION = 0.05, 6
ROW_BITS, COLUMN_BITS = 25, 26


def check_resolution(resolution: int) -> None:
    if isinstance(resolution, bool) or not isinstance(resolution, int) or not 0 <= resolution <= 15:
        raise ValueError("resolution must be a whole number from 0 to 15")


def step_degrees(resolution: int) -> float:
    check_resolution(resolution)
    return BASE_DEGREES * math.sqrt(7.0) ** (BASE_RESOLUTION - resolution)


def _columns(row: Column, step: Column) -> Column:
    middle = F.least(row * step + step / 2 - 90, F.lit(90.0))
    return F.greatest(F.lit(1.0), F.round(360 * F.cos(F.radians(middle)) / step)).cast("long")


def cell_id(latitude: Column, longitude: Column, resolution: int) -> Column:
    """The cell of a point; null where the point is not on the globe."""
    step = F.lit(step_degrees(resolution))
    row = F.floor((latitude + 90) / step).cast("long")
    across = _columns(row, step)
    column = F.least(F.floor((longitude + 180) / 360 * across).cast("long"), across - 1)
    packed = F.shiftleft(F.shiftleft(F.lit(resolution).cast("long"), ROW_BITS).bitwiseOR(row), COLUMN_BITS).bitwiseOR(column)
    return F.when(valid_location(latitude, longitude), packed)


def with_cell(df: DataFrame, *, resolution: int = 6, latitude: str = "latitude", longitude: str = "longitude", output: str = "weather_query_cell_id") -> DataFrame:
    """Add the cell of each row's point; null where it is not on the globe.

    The id is handed on through a generator of one element. Filters on it, and on a centre derived
    from it, would else be pushed below the projection as copies of the whole expression, which is
    then evaluated many times a row.
    """
    check_resolution(resolution)
    return df.withColumn(output, F.explode(F.array(cell_id(F.col(latitude), F.col(longitude), resolution))))


def with_center(df: DataFrame, *, cell: str = "weather_query_cell_id") -> DataFrame:
    """Add query_latitude and query_longitude, a cell's centre, from its id.

    Rows with a null or malformed id are dropped. Each step is a projection of its own, so that
    values used twice are computed once.
    """
    cell_col = F.col(cell)
    parts = {
        "__gr_resolution": F.shiftright(cell_col, ROW_BITS + COLUMN_BITS).cast("int"),
        "__gr_row": F.shiftright(cell_col, COLUMN_BITS).bitwiseAND((1 << ROW_BITS) - 1),
        "__gr_column": cell_col.bitwiseAND((1 << COLUMN_BITS) - 1),
    }
    steps = F.array(*(F.lit(step_degrees(r)) for r in range(16)))
    split = df.withColumns(parts).filter(F.shiftright(cell_col, ROW_BITS + COLUMN_BITS).between(0, 15))
    sized = split.withColumn("__gr_step", F.element_at(steps, F.col("__gr_resolution") + 1))
    wide = sized.withColumn("__gr_across", _columns(F.col("__gr_row"), F.col("__gr_step")))
    latitude = F.least(F.col("__gr_row") * F.col("__gr_step") + F.col("__gr_step") / 2 - 90, F.lit(90.0))
    longitude = (F.col("__gr_column") + 0.5) * 360 / F.col("__gr_across") - 180
    out = wide.filter("__gr_column < __gr_across").withColumns({"query_latitude": latitude, "query_longitude": longitude})
    return out.drop(*parts, "__gr_step", "__gr_across")
