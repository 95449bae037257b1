"""Time between the first and last fix of a vessel on a day, and its distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators.filters import last

HISTOGRAM_BINS = 20


def vessel_days(df: DataFrame) -> DataFrame:
    """Seconds between first and last fix per vessel and day. First and last combine in the map tasks."""
    seconds = X.seconds_between("min(record_time)", "max(record_time)")
    return df.groupBy("vessel_id", F.expr(f"{X.DAY} AS day")).agg(F.expr(f"{seconds} AS seconds"))


def work_hours(df: DataFrame) -> DataFrame:
    return vessel_days(df).selectExpr("vessel_id", "CAST(day AS STRING) AS work_date", "seconds / 3600D AS work_hours")


def work_minutes(df: DataFrame) -> DataFrame:
    days = vessel_days(df).where("day IS NOT NULL")
    return days.selectExpr("vessel_id", "CAST(day AS STRING) AS work_date", "seconds / 60D AS work_minutes")


def _minutes_histogram(df: DataFrame) -> DataFrame:
    """Vessel-days per duration in whole seconds: at most 86,400 rows, however many vessel-days there are.

    Exact quantiles and bins come from this table instead of from the vessel-days themselves.
    """
    counts = vessel_days(df).where("seconds IS NOT NULL").groupBy("seconds").agg(F.expr("count(*) AS n"))
    return counts.selectExpr("seconds / 60D AS minutes", "n")


# Within 1.5 interquartile ranges of the quartiles `q`.
INSIDE_FENCES = "(minutes BETWEEN q[0] - 1.5D * (q[2] - q[0]) AND q[2] + 1.5D * (q[2] - q[0]))"


def _with_quartiles(df: DataFrame) -> DataFrame:
    """The durations with their quartiles (linear interpolation) beside them."""
    histogram = _minutes_histogram(df)
    return histogram.withColumn("q", last(histogram, "percentile(minutes, array(0.25, 0.5, 0.75), n)"))


def work_minutes_box(df: DataFrame) -> DataFrame:
    """Quartiles, whiskers at the last values inside the fences, and the number of outliers."""
    return _with_quartiles(df).selectExpr(
        "any_value(q[0]) AS q1",
        "any_value(q[1]) AS median",
        "any_value(q[2]) AS q3",
        f"min(minutes) FILTER (WHERE {INSIDE_FENCES}) AS whisker_low",
        f"max(minutes) FILTER (WHERE {INSIDE_FENCES}) AS whisker_high",
        f"coalesce(sum(n) FILTER (WHERE NOT {INSIDE_FENCES}), 0L) AS outliers",
    )


def work_minutes_outliers(df: DataFrame) -> DataFrame:
    """The durations outside the fences, with the number of vessel-days of each."""
    return _with_quartiles(df).where(f"NOT {INSIDE_FENCES}").select("minutes", "n")


def work_minutes_hist(df: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram between the smallest and largest value; the last bin is closed.

    When all values are equal the range is widened by half a minute each way, as plotting libraries do.
    Every bin gets a row, also the empty ones.
    """
    histogram = _minutes_histogram(df)
    flat = "IF(min(minutes) = max(minutes), 0.5D, 0D)"
    bounds = f"struct(min(minutes) - {flat} AS low, max(minutes) + {flat} AS high)"
    ranged = histogram.withColumn("b", last(histogram, bounds)).selectExpr(
        "minutes", "n", "b.low AS low", f"(b.high - b.low) / {bins}D AS width"
    )
    bin_of = f"least(floor((minutes - low) / width), {bins - 1})"
    counts = ", ".join(f"coalesce(sum(n) FILTER (WHERE {bin_of} = {i}), 0L)" for i in range(bins))
    one_row = ranged.selectExpr(f"array({counts}) AS counts", "any_value(low) AS low", "any_value(width) AS width")
    rows = one_row.where("low IS NOT NULL").selectExpr("low", "width", "posexplode(counts) AS (bin, cnt)")
    return rows.selectExpr("bin", "low + width * bin AS bin_low", "low + width * (bin + 1) AS bin_high", "cnt")


def duration_buckets(seconds: DataFrame) -> DataFrame:
    """Six right-closed buckets in fixed order, zero-filled, from one row per vessel-day."""
    upper = [f"seconds <= {3600 * hours:.0f}" for hours in S.DURATION_UPPER_HOURS]
    cases = " ".join(f"WHEN {test} THEN {i}" for i, test in enumerate(upper))
    bucket = f"CASE {cases} ELSE {len(upper)} END"
    rows = ", ".join(
        f"struct({i} AS ord, '{label}' AS range, count_if(bucket = {i}) AS value)"
        for i, label in enumerate(S.DURATION_LABELS)
    )
    return seconds.selectExpr(f"{bucket} AS bucket").selectExpr(f"array({rows}) AS rows").selectExpr("inline(rows)")


def work_hours_buckets(df: DataFrame) -> DataFrame:
    return duration_buckets(vessel_days(df).where("seconds IS NOT NULL"))
