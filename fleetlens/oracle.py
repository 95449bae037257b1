"""The same results in DuckDB SQL over the same tables, for checking."""

from __future__ import annotations


def _area(*values: object) -> str:
    cases = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values[:4]))
    return f"CASE user_id % 5 {cases} ELSE {values[4]!r} END"


def _num(*values: float) -> str:
    return f"CAST({_area(*values)} AS DOUBLE)"


def _coordinate(low: str, width: str, stride: int) -> str:
    return (
        f"CASE event_id % 100 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) "
        f"ELSE {low} + {width} * CAST((event_id * {stride}) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) END"
    )


_X = _coordinate(_num(100, 250, 450, 500, 300), _num(100, 150, 150, 80, 200), 37)
_Y = _coordinate(_num(300, 200, 150, 280, 50), _num(100, 150, 150, 80, 130), 61)
_AREA = _area("渤海湾", "黄海中部", "东海近海", "舟山群岛", "南海北部")

_FIXES = f"""
SELECT event_id AS point_id, CAST(user_id AS VARCHAR) AS vessel_id, {_X} AS x, {_Y} AS y,
  value / CAST(10 AS DOUBLE) AS speed, CAST((event_id * 7) % 360 AS INTEGER) AS direction,
  date_trunc('second', ts) AS record_time,
  CASE event_type WHEN 'click' THEN '拖网' WHEN 'view' THEN '围网' WHEN 'error' THEN NULL ELSE '流刺网' END AS operation_type,
  CASE WHEN event_id % 50 = 3 THEN NULL ELSE {_AREA} END AS sea_area,
  strftime(ts, '%Y-%m-%d') AS dt
FROM events"""

# Every query starts from `f` (all fixes) and `t` (cleaned fixes).
_T = f"WITH f AS ({_FIXES}), t AS (SELECT * FROM f WHERE speed > 0 AND speed < 20)"


# The same over the first fixes in time order.
_PREFIX = _T.replace(", t AS (", ", every AS (") + ", t AS (SELECT * FROM every ORDER BY record_time, point_id LIMIT 2500)"

# Where the time holds no minutes, its hour is left.
_DIRTY_HOURS = f"""{_T}, d AS (SELECT * FROM t WHERE point_id % 40 <> 8)
  SELECT CAST(hour(record_time) AS VARCHAR) AS hour, count(*) AS value FROM d WHERE dt = (SELECT max(dt) FROM d) GROUP BY 1"""

_DIRTY_DAYS = f"""{_T} SELECT vessel_id, count(DISTINCT CASE WHEN point_id % 40 <> 8 THEN dt END) AS days_at_sea
  FROM t GROUP BY 1"""


# Landing text with coordinates and times that do not belong there, after cleaning. Only a full date is a day.
_UNDATED = "point_id % 40 IN (8, 18, 28)"
_DIRTY = f"""{_T.replace(", t AS (", ", clean AS (")}, t AS (SELECT * REPLACE (
    CASE WHEN point_id % 40 IN (5, 7) THEN NULL WHEN point_id % 40 = 6 THEN CAST(1e12 AS DOUBLE) ELSE x END AS x,
    CAST(CAST(speed AS FLOAT) AS DOUBLE) AS speed,
    CASE WHEN {_UNDATED} OR point_id % 10 = 9 THEN NULL ELSE record_time END AS record_time,
    CASE WHEN {_UNDATED} THEN NULL ELSE dt END AS dt) FROM clean)"""


def _r(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def _r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_TIME = _text("record_time")
_VALID = "x <> 0 AND y <> 0"
_LOCATED = "x IS NOT NULL AND y IS NOT NULL"
_TODAY = "dt = (SELECT max(dt) FROM t)"
_MONTH = "substr(dt, 1, 7) = (SELECT substr(max(dt), 1, 7) FROM t)"
_GX, _GY = "CAST(floor(x / 10) AS INTEGER)", "CAST(floor(y / 10) AS INTEGER)"
_ROW = (
    f"point_id, vessel_id, {_r6('x', 'y', 'speed')}, direction, {_TIME} AS record_time, operation_type, sea_area, dt"
)
_OUTSIDE = """(
  (sea_area = '渤海湾' AND NOT (x BETWEEN 100 AND 200 AND y BETWEEN 320 AND 400)) OR
  (sea_area = '黄海中部' AND NOT (x BETWEEN 200 AND 300 AND y BETWEEN 250 AND 380)) OR
  (sea_area = '东海近海' AND NOT (x BETWEEN 300 AND 450 AND y BETWEEN 150 AND 320)) OR
  (sea_area = '舟山群岛' AND NOT (x BETWEEN 350 AND 450 AND y BETWEEN 100 AND 250)) OR
  (sea_area = '南海北部' AND NOT (x BETWEEN 400 AND 600 AND y BETWEEN 0 AND 200)))"""


def _label(column: str) -> str:
    return f"coalesce(nullif({column}, ''), '未知')"


_VESSEL_DAYS = """, vd AS (
  SELECT vessel_id, dt, date_diff('second', min(record_time), max(record_time)) AS seconds FROM t GROUP BY ALL)"""
_MINUTES = _VESSEL_DAYS + ", m AS (SELECT seconds / CAST(60 AS DOUBLE) AS minutes FROM vd)"
_BUCKETS = (
    _VESSEL_DAYS
    + """, b AS (SELECT CASE WHEN seconds <= 7200 THEN 0 WHEN seconds <= 14400 THEN 1 WHEN seconds <= 21600 THEN 2
      WHEN seconds <= 28800 THEN 3 WHEN seconds <= 36000 THEN 4 ELSE 5 END AS ord FROM vd),
  buckets AS (SELECT l.ord, l.range, count(b.ord) AS value FROM (VALUES (0, '0-2小时'), (1, '2-4小时'), (2, '4-6小时'),
    (3, '6-8小时'), (4, '8-10小时'), (5, '10小时以上')) AS l(ord, range) LEFT JOIN b ON b.ord = l.ord GROUP BY ALL)"""
)


def _ranges(keys: str, where: str) -> str:
    """`rng`: largest distance from the first fix per `keys`, by a window over all fixes of the group."""
    window = f"OVER (PARTITION BY {keys} ORDER BY record_time, point_id)"
    return f""", o AS (
  SELECT *, first_value(x) {window} AS x0, first_value(y) {window} AS y0 FROM t WHERE {where}),
rng AS (SELECT {keys}, max(sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0))) AS dist FROM o GROUP BY {keys})"""


_DAY_RANGE = _ranges("vessel_id, dt", _LOCATED)
_LATEST = f""", l AS (SELECT * FROM t WHERE {_TODAY}
  QUALIFY row_number() OVER (PARTITION BY vessel_id ORDER BY record_time DESC, point_id DESC) = 1)"""
_POSITIONS = (
    _LATEST
    + f""", p AS (SELECT vessel_id AS ship_id, coalesce(x, 0.0) AS x, coalesce(y, 0.0) AS y,
  {_label("operation_type")} AS work_type, {_label("sea_area")} AS sea_area FROM l ORDER BY vessel_id LIMIT 500)"""
)
_STATUS = (
    _LATEST
    + f""", s AS (SELECT vessel_id AS ship, {_label("sea_area")} AS area, coalesce({_r("speed", 1)}, 0.0) AS speed,
  CASE WHEN coalesce(speed, 0) > 5 THEN '作业中' ELSE '返港中' END AS status, {_TIME} AS time FROM l)"""
)
_SLOW = f""", g AS (SELECT vessel_id AS ship_id, {_label("sea_area")} AS sea_area, count(*) AS cnt,
    avg(x) FILTER (WHERE {_LOCATED}) AS x, avg(y) FILTER (WHERE {_LOCATED}) AS y
  FROM t WHERE {_TODAY} AND speed < 3 GROUP BY 1, 2 HAVING count(*) >= 2),
stops AS (SELECT ship_id, sea_area, coalesce({_r("x", 2)}, 0.0) AS x, coalesce({_r("y", 2)}, 0.0) AS y, cnt,
    (SELECT {_text("max(record_time)")} FROM t) AS time
  FROM g ORDER BY cnt DESC, ship_id, sea_area LIMIT 30)"""
_CROSS = f""", cross_today AS (SELECT vessel_id AS ship_id, sea_area, x, y, {_TIME} AS time FROM t
  WHERE {_TODAY} AND {_VALID} AND {_OUTSIDE} ORDER BY record_time, point_id LIMIT 500)"""


def _figures(prefix: str, where: str) -> str:
    return f"""SELECT count(*) AS {prefix}points, count(DISTINCT vessel_id) AS {prefix}ships,
  coalesce({_r("avg(speed)", 1)}, 0.0) AS {prefix}avg_speed,
  count(DISTINCT CASE WHEN {_VALID} AND abs(x) < 1e9 THEN {_GX} * 100000 + {_GY} END) AS {prefix}hot_grid_count FROM t WHERE {where}"""


_KPI = _SLOW + f""", kd AS ({_figures("total_", _TODAY)}), km AS ({_figures("monthly_", _MONTH)}),
kpi AS (SELECT total_points, total_ships, total_avg_speed AS avg_speed, total_hot_grid_count AS hot_grid_count,
  (SELECT count(*) FROM g) AS abnormal_count FROM kd)"""
_GEAR_TODAY = f""", gt AS (SELECT {_label("operation_type")} AS name, count(*) AS value,
  {_r("avg(speed)", 2)} AS speed FROM t WHERE {_TODAY} GROUP BY 1)"""
_HOURS_TODAY = f""", ht AS (SELECT CAST(hour(record_time) AS INTEGER) AS h, count(*) AS value FROM t WHERE {_TODAY} GROUP BY 1)"""
_GRID_TODAY = f""", gr AS (SELECT {_GX} * 10 AS x, {_GY} * 10 AS y, count(DISTINCT vessel_id) AS ship_cnt
  FROM t WHERE {_TODAY} AND {_VALID} GROUP BY 1, 2)"""
_TOP20 = ", top20 AS (SELECT vessel_id AS ship, count(*) AS value FROM t GROUP BY 1 ORDER BY value DESC, ship LIMIT 20)"
_LAST7 = ", last7 AS (SELECT dt AS date, count(*) AS value FROM t GROUP BY 1 ORDER BY date DESC LIMIT 7)"
_RANGE20 = _DAY_RANGE + f""", range20 AS (SELECT vessel_id || '(' || dt || ')' AS ship, {_r("dist", 2)} AS value, dist
  FROM (SELECT * FROM rng ORDER BY dist DESC, vessel_id, dt LIMIT 20))"""


def _lists(source: str, order: str, **arrays: str) -> str:
    columns = ", ".join(f"{name} := list({column} ORDER BY {order})" for name, column in arrays.items())
    return f"SELECT to_json(struct_pack({columns}))::VARCHAR AS payload FROM {source}"


def _named(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, payload FROM ({sql})" for name, sql in parts.items())


def _rows(source: str, *columns: str) -> str:
    packed = ", ".join(f"{c} := {c}" for c in columns)
    return f"SELECT to_json(struct_pack({packed}))::VARCHAR AS payload FROM {source}"


_BOUNDS = "(SELECT min(minutes) AS lo, max(minutes) AS hi FROM m)"


def _entry(result: str, label: str, value: str, source: str) -> str:
    return f"SELECT '{result}' AS result, {label} AS label, CAST({value} AS DOUBLE) AS value FROM {source}"


# Rows of each result.
_AUDIT = f""", c AS (SELECT
        (SELECT count(*) FROM (SELECT DISTINCT sea_area, {_GX}, {_GY} FROM t WHERE {_VALID})) AS r1,
        (SELECT count(*) FROM (SELECT DISTINCT operation_type FROM t)) AS r2,
        (SELECT count(*) FROM (SELECT DISTINCT hour(record_time) FROM t)) AS r3,
        (SELECT count(*) FROM (SELECT DISTINCT vessel_id, dt FROM t)) AS r4,
        (SELECT count(DISTINCT vessel_id) FROM t) AS r5,
        (SELECT count(*) FROM (SELECT DISTINCT operation_type FROM t)) AS r6,
        (SELECT count(DISTINCT dt) FROM t) AS r7,
        (SELECT count(DISTINCT vessel_id) FROM t WHERE {_VALID}) AS r8,
        (SELECT count(*) FROM (SELECT 1 FROM t WHERE speed < 3 AND {_LOCATED}
           GROUP BY vessel_id, coalesce(sea_area, '未知') HAVING count(*) >= 2)) AS r9,
        (SELECT count(*) FROM t WHERE {_VALID} AND {_OUTSIDE}) AS r10)"""
_RESULTS = "[" + ", ".join(f"'ads_result{k:03d}'" for k in range(1, 11)) + "]"


def _values(result: int, source: str, label: list[str], *measures: str) -> str:
    """Measures of a result as rows."""
    text = " || '|' || ".join(f"coalesce(CAST({column} AS VARCHAR), 'NULL')" for column in label)
    return " UNION ALL ".join(
        f"SELECT 'ads_result{result:03d}' AS result, {text} AS label, '{m}' AS measure, {_r(m, 4)} AS value FROM ({source})"
        for m in measures
    )


_VALUES = f"{_T}{_VESSEL_DAYS}{_ranges('vessel_id', _VALID)} " + " UNION ALL ".join(
    [
        _values(1, f"SELECT sea_area, {_GX} AS gx, {_GY} AS gy, count(DISTINCT vessel_id) AS density FROM t WHERE {_VALID} GROUP BY 1, 2, 3",
                ["sea_area", "gx", "gy"], "density"),
        _values(2, "SELECT operation_type, count(DISTINCT vessel_id) AS cnt FROM t GROUP BY 1", ["operation_type"], "cnt"),
        _values(3, "SELECT hour(record_time) AS h, count(*) AS cnt FROM t GROUP BY 1", ["h"], "cnt"),
        _values(4, "SELECT vessel_id, dt, seconds / CAST(3600 AS DOUBLE) AS work_hours FROM vd", ["vessel_id", "dt"], "work_hours"),
        _values(5, "SELECT vessel_id, count(DISTINCT dt) AS days_at_sea FROM t GROUP BY 1", ["vessel_id"], "days_at_sea"),
        _values(6, f"""SELECT operation_type, {_r("avg(speed)", 2)} AS avg_speed, {_r("max(speed)", 2)} AS max_speed,
                {_r("min(speed)", 2)} AS min_speed, count(*) AS cnt FROM t GROUP BY 1""", ["operation_type"], "avg_speed", "max_speed", "min_speed", "cnt"),
        _values(7, "SELECT dt, count(*) AS cnt FROM t GROUP BY 1", ["dt"], "cnt"),
        _values(8, f"SELECT vessel_id, {_r('dist', 2)} AS max_dist FROM rng", ["vessel_id"], "max_dist"),
        _values(9, f"""SELECT vessel_id, '' AS s, count(*) AS duration_hrs, avg(x) AS coord_x, avg(y) AS coord_y FROM t
                WHERE speed < 3 AND {_LOCATED} GROUP BY vessel_id, coalesce(sea_area, '未知') HAVING count(*) >= 2""",
                ["vessel_id", "s", "s"], "duration_hrs", "coord_x", "coord_y"),
        _values(10, f"SELECT vessel_id, sea_area, {_TIME} AS ts, x AS coord_x, y AS coord_y FROM t WHERE {_VALID} AND {_OUTSIDE}",
                ["vessel_id", "sea_area", "ts"], "coord_x", "coord_y"),
    ]
)

_DISTINCT = f"count(DISTINCT vessel_id) AS vessels, count(DISTINCT CASE WHEN {_VALID} THEN {_GX} * 100000 + {_GY} END) AS cells"

ORACLES: dict[str, str] = {
    "raw_scan": f"""{_T} SELECT vessel_id, CAST(x AS VARCHAR) AS x, CAST(y AS VARCHAR) AS y, CAST(speed AS VARCHAR) AS speed,
      CAST(direction AS VARCHAR) AS direction, {_TIME} AS record_time, operation_type, sea_area FROM f""",
    "clean_scan": f"""{_T} SELECT point_id, vessel_id, x, y, round(CAST(CAST(speed AS FLOAT) AS DOUBLE), 4) AS speed,
      direction, {_TIME} AS record_time, operation_type, sea_area, dt FROM t""",
    "clean_csv_scan": f"""{_T} SELECT vessel_id, x, y, round(CAST(CAST(speed AS FLOAT) AS DOUBLE), 4) AS speed,
      direction, {_TIME} AS record_time, operation_type, sea_area, dt FROM t""",
    "catalog_tables": f"""{_T} SELECT 'ais_trajectory_raw' AS table_name, count(*) AS row_count FROM f
      UNION ALL SELECT 'ais_trajectory_cleaned', count(*) FROM t
      UNION ALL SELECT * FROM (WITH {_AUDIT.lstrip(", ")} SELECT unnest({_RESULTS}), unnest([r1, r2, r3, r4, r5, r6, r7, r8, r9, r10]) FROM c)""",
    "etl_clean": f"""{_T} SELECT vessel_id, x, y, round(CAST(CAST(speed AS FLOAT) AS DOUBLE), 4) AS speed,
      direction, {_TIME} AS record_time, operation_type, sea_area, point_id, {_TIME} AS event_time, dt FROM t""",
    "etl_partition_write": f"""{_T} SELECT dt, count(*) AS row_count, count(DISTINCT vessel_id) AS vessels FROM t GROUP BY dt""",
    "ads_audit": f"""{_T}{_AUDIT} SELECT unnest({_RESULTS}) AS result, unnest([r1, r2, r3, r4, r5, r6, r7, r8, r9, r10]) AS row_count FROM c""",
    "ads_sink": _VALUES,
    "ordered_extract": f"{_T} SELECT {_ROW} FROM t ORDER BY t.record_time, point_id",
    "load_audit": f"""{_T} SELECT count(*) AS row_count, {_text("min(record_time)")} AS first_time,
      {_text("max(record_time)")} AS last_time FROM t""",
    "payload_rows": f"{_T}{_GRID_TODAY}{_GEAR_TODAY}{_KPI}{_CROSS}{_POSITIONS}{_STATUS.replace(_LATEST, '')} "
    + _named(
        {
            "sea-grid-heatmap": _rows("gr", "x", "y", "ship_cnt"),
            "worktype-ratio": _rows("gt", "name", "value"),
            "abnormal-stop-points": _rows("stops", "ship_id", "sea_area", "x", "y", "cnt", "time"),
            "cross-border": _rows("cross_today", "ship_id", "sea_area", "x", "y", "time"),
            "ship-locations": _rows("p", "ship_id", "x", "y", "work_type", "sea_area"),
            "latest-boats": _rows("s", "ship", "area", "speed", "status", "time"),
            "summary": _rows(
                "kpi, km", "total_points", "total_ships", "avg_speed", "hot_grid_count", "abnormal_count",
                "monthly_points", "monthly_ships", "monthly_avg_speed", "monthly_hot_grid_count",
            ),
        }
    ),
    "payload_arrays": f"{_T}{_HOURS_TODAY}{_BUCKETS}{_TOP20}{_GEAR_TODAY}{_LAST7}{_RANGE20} "
    + _named(
        {
            "peak-hour": _lists("ht", "h", hours="CAST(h AS VARCHAR)", values="value"),
            "work-duration-dist": _lists("buckets", "ord", ranges="range", values="value"),
            "ship-top20": _lists("top20", "value DESC, ship", ships="ship", values="value"),
            "avg-speed": _lists("gt", "speed DESC, name", types="name", values="speed"),
            "daily-points": _lists("last7", "date", dates="date", values="value"),
            "max-distance-top20": _lists("range20", "dist DESC, ship", ships="ship", values="value"),
        }
    ),
    "valid_points": f"{_T} SELECT {_ROW} FROM t WHERE {_VALID}",
    "current_day": f"{_T} SELECT {_ROW} FROM t WHERE {_TODAY}",
    "current_month": f"{_T} SELECT {_ROW} FROM t WHERE {_MONTH}",
    "latest_date": f"{_T} SELECT coalesce(max(dt), strftime(current_date, '%Y-%m-%d')) AS today FROM t",
    "replay_prefix": f"""{_T}, n AS (SELECT *, row_number() OVER (ORDER BY record_time, point_id) AS rn FROM t)
      SELECT {_ROW} FROM n WHERE rn <= (SELECT count(*) // 2 FROM t)""",
    "label_defaults": f"""{_T}, b AS (SELECT CASE WHEN operation_type = '流刺网' THEN '' ELSE operation_type END AS gear,
        sea_area FROM t)
      SELECT coalesce(gear, '未知') AS null_label, {_label("gear")} AS blank_label, {_label("sea_area")} AS area_label,
        count(*) AS cnt FROM b GROUP BY 1, 2, 3""",
    "time_parse": f"""{_T}, s AS (SELECT point_id, substr({_TIME}, 1,
        CASE point_id % 7 WHEN 0 THEN 13 WHEN 1 THEN 10 ELSE 19 END) AS text FROM f)
      SELECT point_id, CASE WHEN length(text) = 19 THEN text END AS record_time,
        TRY_CAST(nullif(substr(text, 12, 2), '') AS INTEGER) AS hour, substr(text, 1, 10) AS dt FROM s""",
    "grid_density": f"""{_T} SELECT sea_area, {_GX} AS grid_x, {_GY} AS grid_y, count(DISTINCT vessel_id) AS density
      FROM t WHERE {_VALID} GROUP BY 1, 2, 3""",
    "grid_density_today": f"{_T}{_GRID_TODAY} SELECT * FROM gr",
    "grid_density_pivot": f"""{_T}, c AS (SELECT sea_area, {_GX} * 10 AS gx, {_GY} * 10 AS grid_y, vessel_id FROM t
        WHERE {_LOCATED} AND sea_area IS NOT NULL)
      SELECT sea_area, grid_y, gx AS grid_x, count(DISTINCT vessel_id) AS density FROM c GROUP BY 1, 2, 3""",
    "grid_density_matrix": f"""{_T}, c AS (SELECT sea_area, {_GX} * 10 AS gx, {_GY} * 10 AS gy, vessel_id FROM t
        WHERE {_LOCATED} AND sea_area IS NOT NULL),
      d AS (SELECT sea_area, gy, gx, count(DISTINCT vessel_id) AS density FROM c GROUP BY 1, 2, 3),
      w AS (SELECT * FROM (SELECT DISTINCT sea_area, gy FROM c) JOIN (SELECT DISTINCT sea_area, gx FROM c) USING (sea_area))
      SELECT w.sea_area, w.gy AS grid_y, w.gx AS grid_x, coalesce(density, 0) AS density
      FROM w LEFT JOIN d ON d.sea_area = w.sea_area AND d.gy = w.gy AND d.gx = w.gx""",
    "running_range": f"""{_T}, o AS (SELECT *, first_value(x) OVER v AS x0, first_value(y) OVER v AS y0 FROM t WHERE {_LOCATED}
        WINDOW v AS (PARTITION BY vessel_id, dt ORDER BY record_time, point_id))
      SELECT vessel_id, dt AS day, {_TIME} AS record_time, point_id,
        round(max(sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0))) OVER (
          PARTITION BY vessel_id, dt ORDER BY o.record_time, point_id ROWS UNBOUNDED PRECEDING), 6) AS running_dist FROM o""",
    "distinct_by_month": f"{_T} SELECT substr(dt, 1, 7) AS month, {_DISTINCT} FROM t GROUP BY 1",
    "distinct_of_weeks": f"""{_T} SELECT CAST(1 + 7 * ((day(record_time) - 1) // 7) AS INTEGER) AS first_day, {_DISTINCT} FROM t
      WHERE day(record_time) <= 28 GROUP BY 1""",
    "grid_density_scaled": f"""{_T}, d AS (SELECT sea_area, {_GX} AS grid_x, {_GY} AS grid_y,
        count(DISTINCT vessel_id) AS density FROM t WHERE {_VALID} GROUP BY 1, 2, 3)
      SELECT *, max(density) OVER () AS scale_max FROM d""",
    "vessels_by_gear": f"{_T} SELECT operation_type AS op_type, count(DISTINCT vessel_id) AS cnt FROM t GROUP BY 1",
    "gear_share": f"""{_T}, c AS (SELECT operation_type, count(*) AS cnt FROM t WHERE operation_type IS NOT NULL GROUP BY 1)
      SELECT *, {_r("cnt * CAST(100 AS DOUBLE) / CAST((SELECT sum(cnt) FROM c) AS DOUBLE)", 1)} AS share FROM c""",
    "gear_share_today": f"""{_T}{_GEAR_TODAY} SELECT name, value,
      {_r("value * CAST(100 AS DOUBLE) / CAST((SELECT sum(value) FROM gt) AS DOUBLE)", 2)} AS share FROM gt""",
    "speed_by_gear": f"""{_T} SELECT operation_type AS op_type, {_r("avg(speed)", 2)} AS avg_speed,
      {_r("max(speed)", 2)} AS max_speed, {_r("min(speed)", 2)} AS min_speed, count(*) AS cnt FROM t GROUP BY 1""",
    "speed_stats_gear": f"""{_T} SELECT operation_type, round(avg(speed), 6) AS mean_speed, round(min(speed), 6) AS min_speed,
      round(max(speed), 6) AS max_speed, round(stddev_samp(speed), 6) AS std_speed
      FROM t WHERE operation_type IS NOT NULL GROUP BY 1""",
    "speed_by_gear_today": f"{_T}{_GEAR_TODAY} SELECT name AS type, speed AS value FROM gt",
    "hour_hist": f"{_T} SELECT CAST(hour(record_time) AS INTEGER) AS hour_val, count(*) AS cnt FROM t GROUP BY 1",
    "hour_hist_peak": f"""{_T} SELECT CAST(hour(record_time) AS INTEGER) AS hour_val, count(*) AS cnt,
      hour_val BETWEEN 6 AND 9 OR hour_val BETWEEN 14 AND 17 AS is_peak FROM t GROUP BY 1""",
    "hour_hist_today": f"{_T}{_HOURS_TODAY} SELECT CAST(h AS VARCHAR) AS hour, value FROM ht",
    "daily_points": f"{_T} SELECT dt AS work_date, count(*) AS cnt FROM t GROUP BY 1",
    "monthly_points": f"""{_T} SELECT CAST(month(record_time) AS INTEGER) AS month, count(*) AS points,
      count(DISTINCT vessel_id) AS vessels FROM t GROUP BY 1""",
    "last7_days": f"{_T}{_LAST7} SELECT * FROM last7",
    "days_at_sea": f"{_T} SELECT vessel_id, count(DISTINCT dt) AS days_at_sea FROM t GROUP BY 1",
    "top30_days": f"""{_T} SELECT vessel_id, count(DISTINCT dt) AS days_at_sea FROM t GROUP BY 1
      ORDER BY days_at_sea DESC, vessel_id LIMIT 30""",
    "top20_vessels": f"{_T}{_TOP20} SELECT * FROM top20",
    "work_hours": f"""{_T}{_VESSEL_DAYS} SELECT vessel_id, dt AS work_date,
      round(seconds / CAST(3600 AS DOUBLE), 6) AS work_hours FROM vd""",
    "work_minutes": f"""{_T}{_VESSEL_DAYS} SELECT vessel_id, dt AS work_date,
      round(seconds / CAST(60 AS DOUBLE), 6) AS work_minutes FROM vd""",
    "work_minutes_box": f"""{_T}{_MINUTES}, q AS (SELECT quantile_cont(minutes, 0.25) AS q1, quantile_cont(minutes, 0.5) AS median,
        quantile_cont(minutes, 0.75) AS q3 FROM m),
      w AS (SELECT minutes, q.*, minutes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM m, q)
      SELECT round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
        round(min(minutes) FILTER (WHERE inside), 6) AS whisker_low,
        round(max(minutes) FILTER (WHERE inside), 6) AS whisker_high,
        count(*) FILTER (WHERE NOT inside) AS outliers FROM w""",
    "work_minutes_outliers": f"""{_T}{_MINUTES}, q AS (SELECT quantile_cont(minutes, 0.25) AS q1,
        quantile_cont(minutes, 0.75) AS q3 FROM m)
      SELECT round(minutes, 6) AS minutes, count(*) AS n FROM m, q
      WHERE NOT minutes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1""",
    "work_minutes_hist": f"""{_T}{_MINUTES}, h AS (SELECT least(CAST(floor((minutes - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin,
        count(*) AS cnt FROM m, {_BOUNDS} GROUP BY 1)
      SELECT CAST(i.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 20 * i.bin, 6) AS bin_low,
        round(lo + (hi - lo) / 20 * (i.bin + 1), 6) AS bin_high, coalesce(cnt, 0) AS cnt
      FROM range(20) AS i(bin) CROSS JOIN {_BOUNDS} LEFT JOIN h ON h.bin = i.bin""",
    "work_hours_buckets_prefix": f"{_PREFIX}{_BUCKETS} SELECT * FROM buckets",
    "top20_vessels_prefix": f"{_PREFIX}{_TOP20} SELECT * FROM top20",
    "last7_days_prefix": f"{_PREFIX}{_LAST7} SELECT * FROM last7",
    "range_vessel_day_prefix": f"{_PREFIX}{_RANGE20} SELECT ship, value FROM range20",
    "dirty_grid_density": f"""{_T} SELECT sea_area, {_GX} AS grid_x, {_GY} AS grid_y, count(DISTINCT vessel_id) AS density
      FROM t WHERE {_VALID} AND point_id % 40 NOT IN (5, 6, 7) GROUP BY 1, 2, 3""",
    "dirty_days_at_sea": _DIRTY_DAYS,
    "dirty_days_at_sea_rollup": _DIRTY_DAYS,
    "dirty_hour_hist_today": _DIRTY_HOURS,
    "dirty_hour_hist_today_rollup": _DIRTY_HOURS,
    "dirty_current_day": f"""{_T}, d AS (SELECT dt FROM t WHERE point_id % 40 <> 8)
      SELECT dt, count(*) AS count FROM d WHERE dt = (SELECT max(dt) FROM d) GROUP BY 1""",
    "dirty_area_violations": f"""{_DIRTY} SELECT vessel_id, sea_area, round(x, 6) AS coord_x, round(y, 6) AS coord_y, {_TIME} AS ts
      FROM t WHERE {_VALID} AND {_OUTSIDE}""",
    "dirty_valid_points": f"{_DIRTY} SELECT count(*) AS fixes, count(*) FILTER (WHERE x > 1e9) AS far FROM t WHERE {_VALID}",
    "dirty_kpi_day": f"{_DIRTY}{_KPI} SELECT * FROM kpi",
    "dirty_kpi_month": f"{_DIRTY}{_KPI} SELECT * FROM km",
    "dirty_kpi_month_rollup": f"{_DIRTY}{_KPI} SELECT * FROM km",
    "dirty_daily_points": f"{_DIRTY} SELECT dt AS work_date, count(*) AS cnt FROM t GROUP BY 1",
    "dirty_daily_points_rollup": f"{_DIRTY} SELECT dt AS work_date, count(*) AS cnt FROM t GROUP BY 1",
    "work_hours_buckets": f"{_T}{_BUCKETS} SELECT * FROM buckets",
    "max_range": f"{_T}{_ranges('vessel_id', _VALID)} SELECT vessel_id, {_r('dist', 2)} AS max_dist FROM rng",
    "max_range_daily": f"{_T}{_DAY_RANGE} SELECT vessel_id, round(max(dist), 6) AS max_dist FROM rng GROUP BY 1",
    "top20_range": f"""{_T}{_DAY_RANGE}, v AS (SELECT vessel_id, max(dist) AS d FROM rng GROUP BY 1)
      SELECT vessel_id, round(d, 6) AS max_dist FROM v ORDER BY d DESC NULLS LAST, vessel_id LIMIT 20""",
    "range_vessel_day": f"{_T}{_RANGE20} SELECT ship, value FROM range20",
    "abnormal_stop": f"""{_T} SELECT vessel_id, coalesce(sea_area, '未知') AS sea_area, count(*) AS cnt,
      round(avg(x), 6) AS avg_x, round(avg(y), 6) AS avg_y FROM t WHERE speed < 3 AND {_LOCATED}
      GROUP BY 1, 2 HAVING count(*) >= 2""",
    "abnormal_stop_record": f"""{_T} SELECT vessel_id, '' AS start_time, '' AS end_time, CAST(count(*) AS DOUBLE) AS duration_hrs,
      round(avg(x), 6) AS coord_x, round(avg(y), 6) AS coord_y FROM t WHERE speed < 3 AND {_LOCATED}
      GROUP BY vessel_id, coalesce(sea_area, '未知') HAVING count(*) >= 2""",
    "abnormal_stop_today": f"{_T}{_SLOW} SELECT * FROM stops",
    "stop_alerts": f"""{_T}{_SLOW} SELECT ship_id, sea_area, cnt, CASE WHEN cnt > 3 THEN 1 ELSE 2 END AS level,
      '渔船 ' || ship_id || ' 在 ' || sea_area || ' 出现 ' || cnt || ' 个低速点' AS message FROM stops""",
    "area_violations": f"""{_T} SELECT vessel_id, sea_area, round(x, 6) AS coord_x, round(y, 6) AS coord_y, {_TIME} AS ts
      FROM t WHERE {_VALID} AND {_OUTSIDE}""",
    "area_violations_last_day": f"""{_T}, v AS (SELECT vessel_id, sea_area, round(x, 6) AS coord_x, round(y, 6) AS coord_y,
        {_TIME} AS ts FROM t WHERE {_VALID} AND {_OUTSIDE})
      SELECT * FROM v WHERE substr(ts, 1, 10) = (SELECT max(substr(ts, 1, 10)) FROM v)""",
    "area_violations_today": f"{_T}{_CROSS} SELECT ship_id, sea_area, {_r6('x', 'y')}, time FROM cross_today",
    "kpi_day": f"{_T}{_KPI} SELECT * FROM kpi",
    "kpi_month": f"{_T}{_KPI} SELECT * FROM km",
    "latest_position": f"{_T}{_POSITIONS} SELECT ship_id, {_r6('x', 'y')}, work_type, sea_area FROM p",
    "latest_status": f"{_T}{_STATUS} SELECT * FROM s",
    "speed_bands": f"""{_T}{_STATUS} SELECT ship, speed,
      CASE WHEN speed > 12 THEN 'high' WHEN speed >= 8 THEN 'mid' ELSE 'low' END AS band FROM s""",
    "map_positions": f"""{_T}{_POSITIONS}, k AS (SELECT count(*) FILTER (WHERE x <> 0 OR y <> 0) AS known FROM p),
      e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p, k WHERE known = 0 OR x <> 0 OR y <> 0),
      w AS (SELECT CASE WHEN x1 - x0 < 0.1 THEN x0 - 0.5 ELSE x0 END AS x0, CASE WHEN x1 - x0 < 0.1 THEN x1 + 0.5 ELSE x1 END AS x1,
        CASE WHEN y1 - y0 < 0.1 THEN y0 - 0.5 ELSE y0 END AS y0, CASE WHEN y1 - y0 < 0.1 THEN y1 + 0.5 ELSE y1 END AS y1 FROM e),
      d AS (SELECT x0 - (x1 - x0) / 10 AS x0, (x1 - x0) * 1.2 AS dx, y0 - (y1 - y0) / 10 AS y0, (y1 - y0) * 1.2 AS dy FROM w)
      SELECT ship_id, work_type, round(least(100, greatest(0, (x - x0) / dx * 100)), 6) AS left_pct,
        round(least(100, greatest(0, (y - y0) / dy * 100)), 6) AS top_pct FROM p, d""",
    "day_index": f"""{_T} SELECT dt, count(*) AS fixes, {_text("min(record_time)")} AS first_time,
      {_text("max(record_time)")} AS last_time FROM t GROUP BY 1""",
    "table_prefix": f"""{_T}, n AS (SELECT *, row_number() OVER (ORDER BY record_time, point_id) AS rn FROM t)
      SELECT point_id, vessel_id, {_r6("x", "y")}, round(CAST(CAST(speed AS FLOAT) AS DOUBLE), 4) AS speed, direction,
        {_TIME} AS record_time, operation_type, sea_area, dt FROM n WHERE rn <= (SELECT count(*) // 2 FROM t)""",
    "table_top20_vessels_prefix": f"{_PREFIX}{_TOP20} SELECT * FROM top20",
    "table_last7_days_prefix": f"{_PREFIX}{_LAST7} SELECT * FROM last7",
    "table_work_hours_buckets_prefix": f"{_PREFIX}{_BUCKETS} SELECT * FROM buckets",
    "table_range_vessel_day_prefix": f"{_PREFIX}{_RANGE20} SELECT ship, value FROM range20",
    "table_kpi_day": f"{_T}{_KPI} SELECT * FROM kpi",
    "table_latest_position": f"{_T}{_POSITIONS} SELECT ship_id, {_r6('x', 'y')}, work_type, sea_area FROM p",
    "table_latest_status": f"{_T}{_STATUS} SELECT * FROM s",
    "table_abnormal_stop_today": f"{_T}{_SLOW} SELECT * FROM stops",
    "table_area_violations_today": f"{_T}{_CROSS} SELECT ship_id, sea_area, {_r6('x', 'y')}, time FROM cross_today",
    "table_gear_counts_today": f"{_T}{_GEAR_TODAY} SELECT name, value FROM gt",
    "table_speed_by_gear_today": f"{_T}{_GEAR_TODAY} SELECT name AS type, speed AS value FROM gt",
    "table_hour_hist_today": f"{_T}{_HOURS_TODAY} SELECT CAST(h AS VARCHAR) AS hour, value FROM ht",
    "table_grid_density_today": f"{_T}{_GRID_TODAY} SELECT * FROM gr",
    "activity_rollup": f"""{_T} SELECT dt, CAST(hour(record_time) AS INTEGER) AS hour, vessel_id, operation_type, sea_area,
      count(*) AS fixes, count(speed) AS speeds, round(sum(speed), 6) AS speed_sum, round(min(speed), 6) AS speed_min,
      round(max(speed), 6) AS speed_max, {_text("min(record_time)")} AS first_time, {_text("max(record_time)")} AS last_time,
      count(*) FILTER (WHERE speed < 3) AS slow_fixes, count(*) FILTER (WHERE speed < 3 AND {_LOCATED}) AS slow_points,
      round(sum(x) FILTER (WHERE speed < 3 AND {_LOCATED}), 6) AS slow_x_sum,
      round(sum(y) FILTER (WHERE speed < 3 AND {_LOCATED}), 6) AS slow_y_sum FROM t GROUP BY ALL""",
    "grid_rollup": f"""{_T} SELECT dt, sea_area, {_GX} AS grid_x, {_GY} AS grid_y, vessel_id, count(*) AS fixes
      FROM t WHERE {_VALID} GROUP BY ALL""",
    "stream_replay": f"{_T} SELECT {_ROW} FROM t",
    "replay_status": f"{_T} SELECT count(*) AS current, count(*) AS total FROM t",
    "stream_cumulative": f"{_T}{_BUCKETS}{_TOP20}{_LAST7}{_RANGE20} "
    + " UNION ALL ".join(
        [
            _entry("work-duration-dist", "range", "value", "buckets"),
            _entry("ship-top20", "ship", "value", "top20"),
            _entry("daily-points", "date", "value", "last7"),
            _entry("max-distance-top20", "ship", "value", "range20"),
        ]
    ),
    "stream_current_day": f"{_T}{_KPI}{_GEAR_TODAY}{_HOURS_TODAY}{_GRID_TODAY}{_CROSS}{_POSITIONS} "
    + " UNION ALL ".join(
        [_entry("summary", f"'{c}'", c, "kpi") for c in
         ("total_points", "total_ships", "avg_speed", "hot_grid_count", "abnormal_count")]
        + [
            _entry("worktype-ratio", "name", "value", "gt"),
            _entry("avg-speed", "name", "speed", "gt"),
            _entry("peak-hour", "CAST(h AS VARCHAR)", "value", "ht"),
            _entry("sea-grid-heatmap", "x || '|' || y", "ship_cnt", "gr"),
            _entry("abnormal-stop-points", "ship_id || '|' || sea_area", "cnt", "stops"),
            _entry("abnormal-stop-x", "ship_id || '|' || sea_area", "x", "stops"),
            _entry("abnormal-stop-y", "ship_id || '|' || sea_area", "y", "stops"),
            _entry("ship-locations-x", "ship_id || '|' || work_type || '|' || sea_area", "round(x, 6)", "p"),
            _entry("ship-locations-y", "ship_id || '|' || work_type || '|' || sea_area", "round(y, 6)", "p"),
            _entry("cross-border-y", "ship_id || '|' || sea_area || '|' || time", "round(y, 6)", "cross_today"),
            _entry("cross-border", "ship_id || '|' || sea_area || '|' || time", "round(x, 6)", "cross_today"),
        ]
    ),
    "stream_current_month": f"{_T}{_KPI} SELECT * FROM km",
    "stream_latest": f"{_T}{_STATUS} SELECT * FROM s",
    "stream_progress": f"""{_T}, b AS (SELECT CAST(CASE WHEN point_id % 50 = 7 THEN 3 WHEN day(record_time) <= 10 THEN 0
        WHEN day(record_time) <= 20 THEN 1 ELSE 2 END AS BIGINT) AS batch, record_time FROM t),
      c AS (SELECT batch, count(*) AS fixes, {_text("min(record_time)")} AS first_time, {_text("max(record_time)")} AS last_time
        FROM b GROUP BY 1)
      SELECT batch, fixes, CAST(sum(fixes) OVER (ORDER BY batch) AS BIGINT) AS current, first_time, last_time,
        (SELECT count(*) FROM t) AS total FROM c""",
    "stream_daily_window": f"""{_T}, m AS (SELECT max(record_time) - INTERVAL 1 DAY AS mark FROM t WHERE point_id % 50 <> 7),
      d AS (SELECT dt AS day, point_id % 50 = 7 AS late, date_trunc('day', record_time) + INTERVAL 1 DAY <= (SELECT mark FROM m) AS done
        FROM t)
      SELECT CASE WHEN late THEN 'late' ELSE 'closed' END AS kind, day, count(*) AS fixes FROM d WHERE done GROUP BY 1, 2""",
}
