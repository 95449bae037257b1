"""Row filters over the trajectory frame: valid points, current day and month, replay prefix."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlens.functions import expressions as X

# Ranges of ids that are counted at a time, where equal times are cut.
ID_RANGES = 4096


def valid_points(df: DataFrame) -> DataFrame:
    return df.where(X.HAS_VALID_POINT)


def last(df: DataFrame, text: str = f"max({X.DATED})") -> Column:
    """A one-row aggregate of `df` as a value to compare its rows with."""
    return df.selectExpr(text).scalar()


def current_day(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows of the latest date in the data, or of `as_of`.

    The filter is on `dt`, so on the partitioned table it selects folders, not rows.
    """
    return df.where(F.col("dt") == (last(df) if as_of is None else as_of))


def current_month(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows of the month of the latest date in the data, or of `as_of`."""
    month = last(df, f"substring(max({X.DATED}), 1, 7)") if as_of is None else F.lit(as_of[:7])
    # A range on `dt` itself, so that it prunes partitions: 'yyyy-MM' <= 'yyyy-MM-dd' < 'yyyy-MM~'.
    return df.where(F.col("dt").between(month, F.concat(month, F.lit("~"))))


def latest_date(df: DataFrame) -> DataFrame:
    """One row: the latest date, or today's date when there are no rows."""
    return df.selectExpr(f"coalesce(max({X.DATED}), CAST(current_date() AS STRING)) AS today")


def latest_only(result: DataFrame, time_column: str) -> DataFrame:
    """Rows of a finished result that fall on its own latest date."""
    day = X.day_of_text(time_column)
    return result.where(F.expr(day) == last(result, f"max({day})"))


# --- replay prefix -------------------------------------------------------------------------------


def replay_prefix(df: DataFrame, n: int) -> DataFrame:
    """The first `n` rows in (record_time, point_id) order; rows without a time come first.

    It is cut at the key of its n-th row: the result is an ordinary filter that stays spread over all tasks
    and reaches the scan.
    """
    return cut_prefix(df, n)


def cut_prefix(df: DataFrame, n: int, ranges: int = ID_RANGES) -> DataFrame:
    """Find the last row's time by counts per day, then per second inside one day.

    Each running total is over a table whose length the calendar bounds, whatever the number of fixes.
    """
    time = F.col("record_time")

    def seconds(date: date) -> DataFrame:
        return df.where(F.to_date(time) == F.lit(date)).groupBy(time.alias("step")).count()

    return cut_by_counts(df, n, df.groupBy(F.to_date(time).alias("step")).count(), seconds, ranges)


def cut_by_counts(df: DataFrame, n: int, days: DataFrame, seconds: Callable[[date], DataFrame], ranges: int = ID_RANGES) -> DataFrame:
    """The same, given the (step, count) of every date, NULL being that of rows without a time, and of the seconds of a date."""
    time = F.col("record_time")
    cut = _first_reaching(days, n)
    if cut is None:
        return df
    day, needed, _ = cut
    if day is None:
        return _smallest_ids(df.where(time.isNull()), needed, ranges)
    second, needed, size = _first_reaching(seconds(day), needed)
    # NULL times sort first, so they belong to every prefix that reaches a real time.
    if needed == size:
        return df.where(time.isNull() | (time <= F.lit(second)))
    before = df.where(time.isNull() | (time < F.lit(second)))
    return before.unionAll(_smallest_ids(df.where(time == F.lit(second)), needed, ranges))


def _first_reaching(counts: DataFrame, n: int):
    """The first `step` (NULL first) whose running total reaches `n`: step, rows needed of it, its size."""
    running = counts.withColumn(
        "total", F.sum("count").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    row = running.where(F.col("total") >= n).orderBy("step").first()
    return None if row is None else (row["step"], n - (row["total"] - row["count"]), row["count"])


def _smallest_ids(ties: DataFrame, n: int, ranges: int) -> DataFrame:
    """The `n` rows with the smallest ids among rows of equal time.

    The range of ids in which the n-th lies is cut into `ranges` again and again, until it ends with that row or is a single id. The
    result is a filter; rows of equal time and id cannot be told apart, and of these any will do.
    """
    low, high, size = ties.agg(F.min("point_id"), F.max("point_id"), F.count("*")).first()
    needed = n
    while size > needed and high > low:
        width = (high - low) // ranges + 1
        span = ties.where((F.col("point_id") >= low) & (F.col("point_id") <= high))
        slot = F.expr(f"(point_id - {low}L) div {width}L").alias("step")
        number, needed, size = _first_reaching(span.groupBy(slot).count(), needed)
        low = low + number * width
        high = min(high, low + width - 1)
    if size <= needed:
        return ties.where(F.col("point_id") <= high) if size else ties
    return ties.where(F.col("point_id") < low).unionAll(ties.where(F.col("point_id") == low).limit(needed))
