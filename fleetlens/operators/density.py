"""Distinct vessels per 10 km grid cell.

A distinct count runs as two aggregations: (cell, vessel) pairs are de-duplicated in the map tasks and
shuffled on both columns, so a vessel or cell that holds a large share of all fixes is spread and small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators.filters import current_day, last


def grid_density(df: DataFrame) -> DataFrame:
    cell = X.exprs("sea_area", f"{X.grid_index('x')} AS grid_x", f"{X.grid_index('y')} AS grid_y")
    return df.where(X.HAS_CELL).groupBy(*cell).agg(F.expr("count(DISTINCT vessel_id) AS density"))


def grid_density_today(df: DataFrame, as_of: str | None = None) -> DataFrame:
    cell = X.exprs(f"{X.grid_origin('x')} AS x", f"{X.grid_origin('y')} AS y")
    return current_day(df, as_of).where(X.HAS_CELL).groupBy(*cell).agg(F.expr("count(DISTINCT vessel_id) AS ship_cnt"))


def with_scale(density: DataFrame, value: str) -> DataFrame:
    """Put the largest value of the result beside every row, as the upper end of a colour scale."""
    return density.withColumn("scale_max", last(density, f"max({value})"))


def grid_density_pivot(df: DataFrame) -> DataFrame:
    """Per area, the matrix of distinct vessels, as one row per cell that occurs: whatever the coordinates, no cell is merged.

    Zero coordinates are kept; rows without an area, or without coordinates that have a cell, belong to no matrix.
    """
    cells = df.where(f"{X.HAS_POINT} AND sea_area IS NOT NULL").selectExpr(
        "sea_area", f"{X.grid_origin('y')} AS grid_y", f"{X.grid_origin('x')} AS grid_x", "vessel_id"
    )
    counted = cells.where("grid_x IS NOT NULL AND grid_y IS NOT NULL").groupBy("sea_area", "grid_y", "grid_x")
    return counted.agg(F.expr("count(DISTINCT vessel_id) AS density"))


# Columns of the matrix that one row holds at most.
MATRIX_COLUMNS = 1024


def grid_density_matrix(df: DataFrame, columns: int = MATRIX_COLUMNS) -> DataFrame:
    """Per area, the whole matrix: rows are all `grid_y` of the area, columns all its `grid_x`, cells without vessels are 0.

    One row per matrix row and block of columns, as two arrays: the columns of the block, in order, and their densities. A block
    spans `columns` grid lines, so that no row grows with the spread of the coordinates.
    """
    width = int(S.GRID_KM) * columns
    cells = grid_density_pivot(df).withColumn("block", F.expr(f"CAST(floor(grid_x / {width}D) AS INT)"))
    axis = cells.groupBy("sea_area", "block").agg(F.sort_array(F.collect_set("grid_x")).alias("xs"))
    rows = cells.select("sea_area", "grid_y").distinct()
    filled = cells.groupBy("sea_area", "grid_y", "block").agg(F.map_from_entries(F.collect_list(F.struct("grid_x", "density"))).alias("held"))
    # Every row of an area has every block of that area.
    whole = rows.join(axis, "sea_area").join(filled, ["sea_area", "grid_y", "block"], "left")
    return whole.selectExpr("sea_area", "grid_y", "xs AS grid_xs", "transform(xs, x -> coalesce(try_element_at(held, x), 0L)) AS densities")
