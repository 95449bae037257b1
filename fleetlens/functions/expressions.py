"""SQL expressions shared by the operators.

They are texts for `selectExpr`, `where` and `exprs`: one call to the JVM per expression instead of one per
node of its tree, and all of them compile into whole-stage code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import schema as S


def exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def half_up(value: str, digits: int) -> str:
    """Round through DECIMAL, half up, so that binary near-ties round the way they read.

    NaN and infinities have no decimal form and become NULL.
    """
    return f"CAST(round(try_cast({value} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


# --- coordinates ---------------------------------------------------------------------------------

# Both coordinates are known; zero counts as known.
HAS_POINT = "(x IS NOT NULL AND y IS NOT NULL)"
# Both are known, finite and non-zero: NULL, NaN and infinities fail the comparisons, which all reach the scan.
_FINITE = "{0} BETWEEN -1.7976931348623157E308D AND 1.7976931348623157E308D"
HAS_VALID_POINT = f"(x <> 0D AND y <> 0D AND {_FINITE.format('x')} AND {_FINITE.format('y')})"
# They also have a grid cell.
_IN_GRID = f"x > -{S.GRID_LIMIT}D AND x < {S.GRID_LIMIT}D AND y > -{S.GRID_LIMIT}D AND y < {S.GRID_LIMIT}D"
HAS_CELL = f"(x <> 0D AND y <> 0D AND {_IN_GRID})"


def grid_index(coordinate: str) -> str:
    """Number of the 10 km grid line at or below the coordinate."""
    return f"try_cast(floor({coordinate} / {S.GRID_KM}D) AS INT)"


def grid_origin(coordinate: str) -> str:
    """Lower edge, in km, of the 10 km grid cell."""
    return f"try_cast(try_multiply(floor({coordinate} / {S.GRID_KM}D), {S.GRID_KM:.0f}L) AS INT)"


def distance(x: str, y: str, x0: str, y0: str) -> str:
    return f"sqrt(({x} - {x0}) * ({x} - {x0}) + ({y} - {y0}) * ({y} - {y0}))"


# --- speed ---------------------------------------------------------------------------------------

IS_SLOW = f"(speed < {S.SLOW_SPEED}D)"
WORK_STATUS = f"IF(coalesce(speed, 0D) > {S.WORKING_SPEED}D, '{S.WORKING}', '{S.RETURNING}')"
SPEED_BAND = "CASE WHEN speed > 12 THEN 'high' WHEN speed >= 8 THEN 'mid' ELSE 'low' END"


# --- labels --------------------------------------------------------------------------------------


def label_if_null(column: str) -> str:
    """`未知` for NULL only; an empty text is kept."""
    return f"coalesce({column}, '{S.UNKNOWN}')"


def label_if_blank(column: str) -> str:
    """`未知` for NULL and for the empty text."""
    return f"coalesce(nullif({column}, ''), '{S.UNKNOWN}')"


# --- time ----------------------------------------------------------------------------------------

# The `dt` of a fix if it names a date in full; the one definition of a day, also for fixes whose time did not parse.
DATED = "CASE WHEN dt RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' AND try_cast(dt AS DATE) IS NOT NULL THEN dt END"
# Calendar day of a fix as a DATE, which groups and hashes faster than text.
DAY = f"coalesce(to_date(record_time), CAST({DATED} AS DATE))"


def parse_time(text: str) -> str:
    """Timestamp of a `yyyy-MM-dd HH:mm:ss` text, NULL when it is malformed."""
    return f"try_to_timestamp({text}, '{S.TIME_FORMAT}')"


def hour_of_text(text: str) -> str:
    """Hour of a time text; a malformed text still gives its hour when the digits are in place."""
    return f"coalesce(hour({parse_time(text)}), try_cast(substring({text}, 12, 2) AS INT))"


# Hour of a fix. Frames read from text also carry `text_hour`, the hour that the digits of the time name.
HOUR = "hour(record_time)"


def hour_or_digits(columns: list[str]) -> str:
    """Hour of a fix of a frame with these columns, by its digits if its time did not parse."""
    return f"coalesce({HOUR}, text_hour)" if "text_hour" in columns else HOUR


def finite(number: str) -> str:
    """NULL for NaN and infinities, which no comparison of the published rules accepts."""
    return f"CASE WHEN abs({number}) < 1.7976931348623157E308D THEN {number} END"


def day_of_text(text: str) -> str:
    return f"substring({text}, 1, 10)"


def time_text(timestamp: str) -> str:
    return f"date_format({timestamp}, '{S.TIME_FORMAT}')"


# A fix without a time comes before all others.
NO_TIME = -(10**17)
_MICROS = f"CAST(coalesce(unix_micros(CAST(record_time AS TIMESTAMP)), {NO_TIME}L) AS DECIMAL(20,0))"
# Time and id as one number, in the order of (record_time, point_id): as a struct they would rule out aggregation by hash.
TIME_RANK = f"CAST({_MICROS} * CAST(18446744073709551616 AS DECIMAL(20,0)) + coalesce(point_id, -9223372036854775807L) AS DECIMAL(38,0))"


def seconds_between(start: str, end: str) -> str:
    return f"(unix_timestamp({end}) - unix_timestamp({start}))"
