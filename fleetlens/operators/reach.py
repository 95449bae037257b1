"""Largest distance of a vessel from its first fix.

The distance needs the group's first fix beside every other fix. A window would bring all fixes of a
vessel into one task. Instead the first fixes are aggregated (combining in the map tasks, by hash), written to
the shared folder, and joined back on (group, split), a group of many fixes having several splits. Spark
broadcasts the first fixes if their bytes allow, else it shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import expressions as X
from fleetlens.operators.filters import valid_points
from fleetlens.session import stored

# A group with more fixes than this is spread over several tasks.
ROWS_PER_SPLIT = 5_000_000
# The limit grows with the table, so that fewer than this many groups can exceed it: their list is broadcast.
MOST_LARGE_GROUPS = 100_000


def first_fixes(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Earliest fix and number of fixes per group; equal times are ordered by id."""
    ranked = points.selectExpr("*", f"{X.TIME_RANK} AS time_rank")
    firsts = ranked.groupBy(*keys).agg(
        *X.exprs("min_by(x, time_rank) AS first_x", "min_by(y, time_rank) AS first_y", "count(*) AS fixes")
    )
    return firsts.selectExpr(*keys, "struct(first_x AS x, first_y AS y) AS origin", "fixes")


def same_group(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [left[key].eqNullSafe(right[f"of_{key}"]) for key in keys])


def _renamed(df: DataFrame, keys: tuple[str, ...], *others: str) -> DataFrame:
    return df.selectExpr(*[f"{key} AS of_{key}" for key in keys], *others)


def join_origins(
    points: DataFrame, firsts: DataFrame, keys: tuple[str, ...], rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Each fix with its group's `origin`, joined on (group, split); only large groups have more than one split.

    `firsts` (keys, origin, fixes) is read several times, so it should be stored.
    """
    total = firsts.selectExpr("coalesce(sum(fixes), 0L) AS total").scalar()
    limited = firsts.withColumn("total", total).withColumn("most", F.expr(f"greatest({rows_per_split}L, total div {MOST_LARGE_GROUPS}L)"))
    large = limited.where("fixes > most").selectExpr(*keys, "CAST(ceil(fixes / CAST(most AS DOUBLE)) AS INT) AS splits")
    sizes = F.broadcast(_renamed(large, keys, "splits"))
    spread = points.join(sizes, same_group(points, sizes, keys), "left").selectExpr(
        *points.columns, "CAST(pmod(xxhash64(point_id), coalesce(splits, 1)) AS INT) AS split"
    )
    origins = firsts.join(sizes, same_group(firsts, sizes, keys), "left").selectExpr(
        *keys, "origin", "explode(sequence(0, coalesce(splits, 1) - 1)) AS of_split"
    )
    origins = _renamed(origins, keys, "of_split", "origin")
    return spread.join(origins, same_group(spread, origins, keys) & (spread["split"] == origins["of_split"]))


AWAY_FROM_ORIGIN = X.distance("x", "y", "origin.x", "origin.y")


def farthest(
    df: DataFrame, keys: tuple[str, ...], rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Largest distance from the group's first fix, per group."""
    points = df.select(*keys, "record_time", "point_id", "x", "y")
    firsts = stored(first_fixes(points, keys), "first-fixes")
    joined = join_origins(points, firsts, keys, rows_per_split)
    return joined.groupBy(*keys).agg(F.expr(f"max({AWAY_FROM_ORIGIN}) AS dist"))


def max_range(df: DataFrame, **options: int) -> DataFrame:
    """Per vessel, from its first valid fix over all time."""
    ranges = farthest(valid_points(df), ("vessel_id",), **options)
    return ranges.selectExpr("vessel_id", f"{X.half_up('dist', 2)} AS max_dist")


def vessel_day_range(df: DataFrame, **options: int) -> DataFrame:
    """Per vessel and day, from the day's first fix that has coordinates (zero counts)."""
    return farthest(df.where(X.HAS_POINT).withColumn("day", F.expr(X.DAY)), ("vessel_id", "day"), **options)


def max_range_daily(df: DataFrame, **options: int) -> DataFrame:
    """Per vessel, the largest of its daily ranges (unrounded)."""
    timed = df.where("record_time IS NOT NULL")
    return vessel_day_range(timed, **options).groupBy("vessel_id").agg(F.expr("max(dist) AS max_dist"))


def top_range(df: DataFrame, k: int = 20, **options: int) -> DataFrame:
    """The vessels with the largest daily range, smallest first."""
    top = max_range_daily(df, **options).orderBy(F.desc_nulls_last("max_dist"), "vessel_id").limit(k)
    return top.orderBy("max_dist", F.desc("vessel_id"))


def label_ranges(ranges: DataFrame, k: int = 20, *further: str) -> DataFrame:
    """The largest vessel-day ranges as `vessel(date)` labels, with `further` columns such as the unrounded `dist`."""
    top = ranges.orderBy(F.desc("dist"), "vessel_id", "day").limit(k)
    return top.selectExpr("concat(vessel_id, '(', day, ')') AS ship", f"{X.half_up('dist', 2)} AS value", *further)


def range_vessel_day(df: DataFrame, k: int = 20, *further: str, **options: int) -> DataFrame:
    return label_ranges(vessel_day_range(df, **options), k, *further)


# --- running form --------------------------------------------------------------------------------


def running_range(df: DataFrame, **options: int) -> DataFrame:
    """Per fix with coordinates: the largest distance from the day's first fix so far, in order of time and id.

    A window per vessel-day would hold all its fixes in one task. Instead the fixes are sorted over all tasks, so that a vessel-day
    with many fixes lies in several of them; each such block's maximum is carried on to the blocks after it, and the running
    maximum is taken inside the blocks alone.
    """
    keys = ("vessel_id", "day")
    points = df.where(X.HAS_POINT).withColumn("day", F.expr(X.DAY)).select(*keys, "record_time", "point_id", "x", "y")
    measured = join_origins(points, stored(first_fixes(points, keys), "first-fixes"), keys, **options)
    away = measured.select(*keys, "record_time", "point_id", F.expr(f"{AWAY_FROM_ORIGIN} AS dist"))
    sorted_ = away.repartitionByRange(*keys, "record_time", "point_id")
    blocks = stored(sorted_.withColumn("block", F.spark_partition_id()), "blocks")
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.groupBy(*keys, "block").agg(F.max("dist").alias("dist"))
    carried = carried.withColumn("carried", F.max("dist").over(before)).where("carried IS NOT NULL")
    carried = _renamed(carried, (*keys, "block"), "carried")
    joined = blocks.join(carried, same_group(blocks, carried, (*keys, "block")), "left")
    upto = Window.partitionBy(*keys, "block").orderBy("record_time", "point_id").rowsBetween(Window.unboundedPreceding, 0)
    running = F.greatest(F.max("dist").over(upto), F.col("carried"))
    return joined.select("vessel_id", F.col("day").cast("string").alias("day"), "record_time", "point_id", running.alias("running_dist"))
