"""Every operator as a query over a data folder, under the name it is known by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import session
from fleetlens.functions import expressions as X
from fleetlens.operators import activity, alerts, density, duration, filters, gear, monitor, reach
from fleetlens.plans import distinct, etl, payloads, prefix, results
from fleetlens.plans import rollup as R
from fleetlens.plans.today import Today
from fleetlens.sources import catalog, cleaned, days, events, raw
from fleetlens.streaming import replay, views, windows

Query = Callable[[SparkSession, str], DataFrame]

DATABASE = "fleet"
RESULTS = "fleet_results"


def _as_text(df: DataFrame) -> DataFrame:
    """Times as text, so that results compare across engines."""
    return df.withColumn("record_time", F.expr(X.time_text("record_time"))) if "record_time" in df.columns else df


def _over_trajectories(operator: Callable[[DataFrame], DataFrame], *, six_digits: tuple[str, ...] = ()) -> Query:
    """A query that applies `operator` to the trajectories; unrounded doubles are compared to six digits."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _as_text(operator(events.trajectories(session.configure(spark), sf_dir)))
        return result.withColumns({name: F.round(name, 6) for name in six_digits})

    return query


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(session.configure(spark), sf_dir)


# --- sources and sinks ---------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The raw fixes as landing-layer CSV files."""
    path = session.scratch_path(spark, "raw")
    events.raw_fixes(spark, sf_dir).drop("point_id").write.option("header", True).csv(path)
    return path


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_raw(spark, _landed(spark, sf_dir))


def over_today(view: Callable[[Today], DataFrame], *, six_digits: tuple[str, ...] = ()) -> Query:
    """A current-day view of the cleaned table, whose latest day the day index tells."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = view(Today(spark, _written_cleaned(spark, sf_dir)))
        return result.withColumns({name: F.round(name, 6) for name in six_digits})

    return _configured(query)


def over_table_prefix(operator: Callable[[DataFrame], DataFrame], n: int = 2_500) -> Query:
    """The operator over the first `n` fixes of the cleaned table, found by its index."""
    return _configured(lambda spark, sf_dir: operator(prefix.table_prefix(spark, _written_cleaned(spark, sf_dir), n)))


def table_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the cleaned table."""
    path = _written_cleaned(spark, sf_dir)
    half = days.day_index(spark, path).selectExpr("CAST(sum(fixes) div 2 AS INT)").first()[0]
    rows = _as_text(prefix.table_prefix(spark, path, half)).drop("text_hour")
    return rows.withColumns({"x": F.round("x", 6), "y": F.round("y", 6), "speed": F.round("speed", 4)})


def day_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after a second write has replaced one of the days by itself."""
    path = _written_cleaned(spark, sf_dir)
    latest = days.latest_day(spark, path)
    etl.write_cleaned(etl.clean(events.raw_fixes(spark, sf_dir)).where(F.col("dt") == latest.dt), path)
    index = days.day_index(spark, path).drop("timed")
    return index.withColumns({c: F.expr(X.time_text(c)) for c in ("first_time", "last_time")})


def _written_cleaned(spark: SparkSession, sf_dir: str) -> str:
    path = session.scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(events.raw_fixes(spark, sf_dir)), path)
    return path


def etl_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.clean(events.raw_fixes(spark, sf_dir)).withColumns(
        {"speed": F.round(F.col("speed").cast("double"), 4), "event_time": F.expr(X.time_text("event_time"))}
    )


def clean_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned.read_cleaned(spark, _written_cleaned(spark, sf_dir))
    return _as_text(rows).drop("text_hour").withColumn("speed", F.round("speed", 4))


def clean_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "cleaned-csv")
    rows = etl.clean(events.raw_fixes(spark, sf_dir)).withColumn("speed", F.round(F.col("speed").cast("double"), 4))
    rows.drop("point_id", "event_time").write.option("header", True).csv(path)
    return _as_text(raw.read_cleaned_csv(spark, path))


def etl_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table twice; the second run replaces the days it contains and leaves no duplicates."""
    path = session.scratch_path(spark, "cleaned")
    rows = etl.clean(events.raw_fixes(spark, sf_dir))
    etl.write_cleaned(rows, path)
    etl.write_cleaned(rows, path)
    written = cleaned.read_cleaned(spark, path)
    return written.groupBy("dt").agg(F.count("*").alias("row_count"), F.countDistinct("vessel_id").alias("vessels"))


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declare and fill the tables; each listed table with its row count."""
    location = session.scratch_path(spark, "catalog")
    catalog.create_tables(spark, DATABASE, location, raw_path=_landed(spark, sf_dir))
    table = f"{DATABASE}.{catalog.CLEANED_TABLE}"
    etl.insert_cleaned(etl.clean(spark.table(f"{DATABASE}.{catalog.RAW_TABLE}")), table)
    results.publish(cleaned.as_trajectory(spark.table(table)), DATABASE, session.scratch_path(spark, "published"))
    listed = catalog.list_tables(spark, DATABASE).select(F.col("tableName").alias("table_name"))
    counts = [
        spark.table(f"{DATABASE}.{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in (catalog.RAW_TABLE, catalog.CLEANED_TABLE, *results.RESULT_NAMES)
    ]
    return listed.join(_stacked(counts), "table_name")


def ads_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of the ten declared result tables, read back."""
    location = session.scratch_path(spark, "published")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {RESULTS} LOCATION '{location}/database'")
    results.publish(events.trajectories(spark, sf_dir), RESULTS, location)
    return results.published_values(spark, RESULTS).withColumn("value", F.expr(X.half_up("value", 4)))


def ads_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "results")
    return results.sink_audit(results.run_offline(events.trajectories(spark, sf_dir), path))


# --- filters -------------------------------------------------------------------------------------


def time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time texts cut to the hour or the day for some events; malformed ones fall back to their digits."""
    full = X.time_text("date_trunc('SECOND', ts)")
    text = f"substring({full}, 1, CASE event_id % 7 WHEN 0 THEN 13 WHEN 1 THEN 10 ELSE 19 END) AS text"
    return events.read_events(spark, sf_dir).selectExpr("event_id AS point_id", text).selectExpr(
        "point_id",
        f"{X.time_text(X.parse_time('text'))} AS record_time",
        f"{X.hour_of_text('text')} AS hour",
        f"{X.day_of_text('text')} AS dt",
    )


def label_defaults(df: DataFrame) -> DataFrame:
    """Labels with an empty text among the values: gear `流刺网` is blanked first."""
    blanked = df.selectExpr("IF(operation_type = '流刺网', '', operation_type) AS gear", "sea_area")
    labels = X.exprs(
        f"{X.label_if_null('gear')} AS null_label",
        f"{X.label_if_blank('gear')} AS blank_label",
        f"{X.label_if_blank('sea_area')} AS area_label",
    )
    return blanked.groupBy(*labels).agg(F.expr("count(*) AS cnt"))


def half_prefix(df: DataFrame) -> DataFrame:
    """The first half of the fixes, cut at its last key."""
    return filters.cut_prefix(df, df.count() // 2)


def over_prefix(operator: Callable[[DataFrame], DataFrame], n: int = 2_500) -> Query:
    """The operator over the first `n` fixes in time order."""
    return _over_trajectories(lambda df: operator(filters.replay_prefix(df, n)))


def dirty_fixes(df: DataFrame, undated: str = "WHEN 8 THEN 'garbage'") -> DataFrame:
    """The fixes as landing text with values that do not belong there, cleaned again."""
    text = df.selectExpr(
        "vessel_id",
        "CASE point_id % 40 WHEN 5 THEN 'Infinity' WHEN 6 THEN '1e12' WHEN 7 THEN 'NaN' ELSE CAST(x AS STRING) END AS x",
        "CAST(y AS STRING) AS y",
        "CAST(speed AS STRING) AS speed",
        "CAST(direction AS STRING) AS direction",
        f"CASE point_id % 40 {undated} ELSE substring({X.time_text('record_time')}, 1, IF(point_id % 10 = 9, 13, 19)) END AS record_time",
        "operation_type",
        "sea_area",
        "point_id",
    )
    return cleaned.as_trajectory(etl.clean(text))


def over_dirty(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_trajectories(lambda df: operator(dirty_fixes(df)))


def over_undated(operator: Callable[[DataFrame], DataFrame], *, six_digits: tuple[str, ...] = ()) -> Query:
    """The operator over landing text that also has times whose date is not written in full."""
    texts = "WHEN 8 THEN 'garbage' WHEN 18 THEN '2025' WHEN 28 THEN '2025-6-2 05:00:00'"
    return _over_trajectories(lambda df: operator(dirty_fixes(df, texts)), six_digits=six_digits)


# --- streams -------------------------------------------------------------------------------------


# Four steps: the days up to the 10th, to the 20th, the rest, and last the late events of all days.
STEP = "CASE WHEN event_id % 50 = 7 THEN 3 WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END"
STEPS = 4


def _in_steps(spark: SparkSession, sf_dir: str, run: Callable[[Callable[[], DataFrame]], None]) -> None:
    """Let the events come step by step; after each, `run` works off what its stream has found, from where it stopped."""
    folder = session.scratch_path(spark, "steps")
    for step in range(STEPS):
        arriving = events.read_events(spark, sf_dir).where(f"{STEP} = {step}")
        arriving.write.parquet(f"{folder}/step={step}")
        run(lambda: replay.event_stream(spark, folder))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "replayed")
    _in_steps(spark, sf_dir, lambda stream: replay.run_to_end(replay.replay(stream(), path)))
    return spark.read.schema(events.trajectories(spark, sf_dir).schema).parquet(path)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_replayed(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("x", "y", "speed")})


def replay_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_status(_replayed(spark, sf_dir), events.trajectories(spark, sf_dir))


def _maintained(spark: SparkSession, sf_dir: str, *parts: str) -> list[DataFrame]:
    path = session.scratch_path(spark, "views")
    _in_steps(spark, sf_dir, lambda stream: replay.run_to_end(views.maintain(stream(), path, parts, merge_every=3)))
    return [views.read_part(spark, path, part) for part in parts]


def _entries(df: DataFrame, result: str, label: str, value: str) -> DataFrame:
    return df.selectExpr(f"'{result}' AS result", f"{label} AS label", f"CAST({value} AS DOUBLE) AS value")


def _stacked(frames: list[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionAll(frame)
    return stacked


def stream_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, ranges = _maintained(spark, sf_dir, "activity", "reach")
    return _stacked(
        [
            _entries(R.work_hours_buckets(rollup), "work-duration-dist", "range", "value"),
            _entries(R.top_vessels(rollup), "ship-top20", "ship", "value"),
            _entries(R.last_days(rollup), "daily-points", "date", "value"),
            _entries(views.range_vessel_day(ranges), "max-distance-top20", "ship", "value"),
        ]
    )


def stream_current_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, grid, violations, latest = _maintained(spark, sf_dir, "activity", "grid", "violations", "latest")
    kpi = R.kpi_day(rollup, grid)
    figures = ", ".join(f"struct('{name}' AS name, CAST({name} AS DOUBLE) AS value)" for name in kpi.columns)
    ship_area = "concat_ws('|', ship_id, sea_area)"
    crossings = views.area_violations_today(violations, rollup)
    stops, positions = R.abnormal_stop_today(rollup), views.latest_position(latest)
    labels = "concat_ws('|', ship_id, work_type, sea_area)"
    return _stacked(
        [
            _entries(kpi.selectExpr(f"inline(array({figures}))"), "summary", "name", "value"),
            _entries(R.gear_counts_today(rollup), "worktype-ratio", "name", "value"),
            _entries(R.speed_by_gear_today(rollup), "avg-speed", "type", "value"),
            _entries(R.hour_hist_today(rollup), "peak-hour", "hour", "value"),
            _entries(R.grid_density_today(grid), "sea-grid-heatmap", "concat_ws('|', x, y)", "ship_cnt"),
            _entries(stops, "abnormal-stop-points", ship_area, "cnt"),
            _entries(stops, "abnormal-stop-x", ship_area, "x"),
            _entries(stops, "abnormal-stop-y", ship_area, "y"),
            _entries(positions, "ship-locations-x", labels, "round(x, 6)"),
            _entries(positions, "ship-locations-y", labels, "round(y, 6)"),
            _entries(crossings, "cross-border-y", "concat_ws('|', ship_id, sea_area, time)", "round(y, 6)"),
            _entries(crossings, "cross-border", "concat_ws('|', ship_id, sea_area, time)", "round(x, 6)"),
        ]
    )


def stream_current_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.kpi_month(*_maintained(spark, sf_dir, "activity", "grid"))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "views")
    _in_steps(spark, sf_dir, lambda stream: replay.run_to_end(views.keep_latest(stream(), path)))
    return views.latest_status(views.read_part(spark, path, "latest"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch brought, as written while the stream ran, beside the total of the source."""
    (rows,) = _maintained(spark, sf_dir, "progress")
    texts = {c: F.expr(X.time_text(c)) for c in ("first_time", "last_time")}
    total = filters.last(events.trajectories(spark, sf_dir), "count(*)")
    return views.progress(rows).withColumn("total", total).withColumns(texts)


def stream_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days of the window with watermark, and the late fixes that no longer counted."""
    path = session.scratch_path(spark, "windows")
    _in_steps(spark, sf_dir, lambda stream: windows.run(stream, path))
    fixes = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.trajectories(spark, sf_dir).schema)
    late = windows.late_days(windows.late_rows(spark, path, fixes))
    closed = windows.closed_days(spark, path).selectExpr("'closed' AS kind", "day", "fixes")
    return closed.unionAll(late.selectExpr("'late' AS kind", "day", "fixes"))


def distinct_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from day bitmaps that were written in two runs, the second with vessels and cells the first did not know."""
    return distinct.counts_by_month(_bitmaps(spark, sf_dir))


def distinct_of_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bitmaps merged over other sets of days."""
    bits = _bitmaps(spark, sf_dir)
    weeks = [distinct.counts(bits.where(f"day(dt) BETWEEN {a} AND {a + 6}")).withColumn("first_day", F.lit(a)) for a in (1, 8, 15, 22)]
    return _stacked(weeks)


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch_path(spark, "distinct")
    fixes = events.trajectories(spark, sf_dir)
    for rows in (fixes.where("day(record_time) <= 12"), fixes.where("day(record_time) > 12")):
        distinct.write(rows, path)
    return distinct.read_bitmaps(spark, path)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "raw_scan": _configured(raw_scan),
    "clean_scan": _configured(clean_scan),
    "clean_csv_scan": _configured(clean_csv_scan),
    "catalog_tables": _configured(catalog_tables),
    "etl_clean": _configured(etl_clean),
    "etl_partition_write": _configured(etl_partition_write),
    "ads_sink": _configured(ads_sink),
    "ads_audit": _configured(ads_audit),
    "ordered_extract": _over_trajectories(cleaned.ordered_extract, six_digits=("x", "y", "speed")),
    "load_audit": _over_trajectories(cleaned.load_audit),
    "payload_rows": _over_trajectories(lambda df: payloads.tagged(payloads.row_payloads(df))),
    "payload_arrays": _over_trajectories(lambda df: payloads.tagged(payloads.array_payloads(df))),
    # filters
    "valid_points": _over_trajectories(filters.valid_points, six_digits=("x", "y", "speed")),
    "current_day": _over_trajectories(filters.current_day, six_digits=("x", "y", "speed")),
    "current_month": _over_trajectories(filters.current_month, six_digits=("x", "y", "speed")),
    "latest_date": _over_trajectories(filters.latest_date),
    "replay_prefix": _over_trajectories(half_prefix, six_digits=("x", "y", "speed")),
    "label_defaults": _over_trajectories(label_defaults),
    "time_parse": _configured(time_parse),
    # density
    "grid_density": _over_trajectories(density.grid_density),
    "grid_density_today": _over_trajectories(density.grid_density_today),
    "grid_density_pivot": _over_trajectories(density.grid_density_pivot),
    "grid_density_matrix": _over_trajectories(
        lambda df: density.grid_density_matrix(df, 4).selectExpr("sea_area", "grid_y", "inline(arrays_zip(grid_xs, densities)) AS (grid_x, density)")
    ),
    "grid_density_scaled": _over_trajectories(lambda df: density.with_scale(density.grid_density(df), "density")),
    # gear and speed
    "vessels_by_gear": _over_trajectories(gear.vessels_by_gear),
    "gear_share": _over_trajectories(gear.gear_share),
    "gear_share_today": _over_trajectories(gear.gear_share_today),
    "speed_by_gear": _over_trajectories(gear.speed_by_gear),
    "speed_stats_gear": _over_trajectories(
        gear.speed_stats_gear, six_digits=("mean_speed", "min_speed", "max_speed", "std_speed")
    ),
    "speed_by_gear_today": _over_trajectories(gear.speed_by_gear_today),
    # activity
    "hour_hist": _over_trajectories(activity.hour_hist),
    "hour_hist_peak": _over_trajectories(activity.hour_hist_peak),
    "hour_hist_today": _over_trajectories(activity.hour_hist_today),
    "daily_points": _over_trajectories(activity.daily_points),
    "monthly_points": _over_trajectories(activity.monthly_points),
    "last7_days": _over_trajectories(activity.last_days),
    "days_at_sea": _over_trajectories(activity.days_at_sea),
    "top30_days": _over_trajectories(activity.top_days_at_sea),
    "top20_vessels": _over_trajectories(activity.top_vessels),
    # duration
    "work_hours": _over_trajectories(duration.work_hours, six_digits=("work_hours",)),
    "work_minutes": _over_trajectories(duration.work_minutes, six_digits=("work_minutes",)),
    "work_minutes_box": _over_trajectories(
        duration.work_minutes_box, six_digits=("q1", "median", "q3", "whisker_low", "whisker_high")
    ),
    "work_minutes_outliers": _over_trajectories(duration.work_minutes_outliers, six_digits=("minutes",)),
    "work_minutes_hist": _over_trajectories(duration.work_minutes_hist, six_digits=("bin_low", "bin_high")),
    "work_hours_buckets_prefix": over_prefix(duration.work_hours_buckets),
    "top20_vessels_prefix": over_prefix(activity.top_vessels),
    "last7_days_prefix": over_prefix(activity.last_days),
    "range_vessel_day_prefix": over_prefix(reach.range_vessel_day),
    "dirty_grid_density": over_dirty(density.grid_density),
    "dirty_days_at_sea": over_dirty(activity.days_at_sea),
    "dirty_days_at_sea_rollup": over_dirty(lambda df: R.days_at_sea(R.vessel_day_rollup(df))),
    "dirty_hour_hist_today": over_dirty(activity.hour_hist_today),
    "dirty_hour_hist_today_rollup": over_dirty(lambda df: R.hour_hist_today(R.activity_rollup(df))),
    "dirty_current_day": over_dirty(lambda df: filters.current_day(df).groupBy("dt").count()),
    "dirty_area_violations": over_undated(alerts.area_violations, six_digits=("coord_x", "coord_y")),
    "dirty_valid_points": over_undated(
        lambda df: filters.valid_points(df).selectExpr("count(*) AS fixes", "count_if(x > 1e9D) AS far")
    ),
    "dirty_kpi_day": over_undated(monitor.kpi_day),
    "dirty_kpi_month": over_undated(monitor.kpi_month),
    "dirty_kpi_month_rollup": over_undated(lambda df: R.kpi_month(R.activity_rollup(df), R.grid_rollup(df))),
    "dirty_daily_points": over_undated(activity.daily_points),
    "dirty_daily_points_rollup": over_undated(lambda df: R.daily_points(R.activity_rollup(df))),
    "work_hours_buckets": _over_trajectories(duration.work_hours_buckets),
    # range
    "max_range": _over_trajectories(reach.max_range),
    "max_range_daily": _over_trajectories(reach.max_range_daily, six_digits=("max_dist",)),
    "top20_range": _over_trajectories(reach.top_range, six_digits=("max_dist",)),
    "running_range": _over_trajectories(reach.running_range, six_digits=("running_dist",)),
    "range_vessel_day": _over_trajectories(reach.range_vessel_day),
    # alerts
    "abnormal_stop": _over_trajectories(alerts.abnormal_stop, six_digits=("avg_x", "avg_y")),
    "abnormal_stop_record": _over_trajectories(
        lambda df: alerts.stop_record(alerts.abnormal_stop(df)), six_digits=("coord_x", "coord_y")
    ),
    "abnormal_stop_today": _over_trajectories(alerts.abnormal_stop_today),
    "stop_alerts": _over_trajectories(lambda df: alerts.stop_alerts(alerts.abnormal_stop_today(df))),
    "area_violations": _over_trajectories(alerts.area_violations, six_digits=("coord_x", "coord_y")),
    "area_violations_last_day": _over_trajectories(
        lambda df: filters.latest_only(alerts.area_violations(df), "ts"), six_digits=("coord_x", "coord_y")
    ),
    "area_violations_today": _over_trajectories(alerts.area_violations_today, six_digits=("x", "y")),
    # monitoring
    "kpi_day": _over_trajectories(monitor.kpi_day),
    "kpi_month": _over_trajectories(monitor.kpi_month),
    "latest_position": _over_trajectories(monitor.latest_position, six_digits=("x", "y")),
    "latest_status": _over_trajectories(monitor.latest_status),
    "speed_bands": _over_trajectories(lambda df: monitor.speed_bands(monitor.latest_status(df))),
    "map_positions": _over_trajectories(
        lambda df: monitor.map_positions(monitor.latest_position(df)), six_digits=("left_pct", "top_pct")),
    # current-day views of the cleaned table
    "day_index": _configured(day_index),
    "table_prefix": _configured(table_prefix),
    "table_top20_vessels_prefix": over_table_prefix(activity.top_vessels),
    "table_last7_days_prefix": over_table_prefix(activity.last_days),
    "table_work_hours_buckets_prefix": over_table_prefix(duration.work_hours_buckets),
    "table_range_vessel_day_prefix": over_table_prefix(reach.range_vessel_day),
    "table_kpi_day": over_today(Today.kpi),
    "table_latest_position": over_today(Today.latest_position, six_digits=("x", "y")),
    "table_latest_status": over_today(Today.latest_status),
    "table_abnormal_stop_today": over_today(Today.abnormal_stops),
    "table_area_violations_today": over_today(Today.area_violations, six_digits=("x", "y")),
    "table_gear_counts_today": over_today(Today.gear_counts),
    "table_speed_by_gear_today": over_today(Today.speed_by_gear),
    "table_hour_hist_today": over_today(Today.hour_hist),
    "table_grid_density_today": over_today(Today.grid_density),
    # summaries
    "activity_rollup": _over_trajectories(
        lambda df: R.activity_rollup(df).withColumns(
            {c: F.expr(X.time_text(c)) for c in ("first_time", "last_time")}
        ),
        six_digits=("speed_sum", "speed_min", "speed_max", "slow_x_sum", "slow_y_sum"),
    ),
    "distinct_by_month": _configured(distinct_by_month),
    "distinct_of_weeks": _configured(distinct_of_weeks),
    "grid_rollup": _over_trajectories(R.grid_rollup),
    # streams
    "stream_replay": _configured(stream_replay),
    "replay_status": _configured(replay_status),
    "stream_cumulative": _configured(stream_cumulative),
    "stream_current_day": _configured(stream_current_day),
    "stream_current_month": _configured(stream_current_month),
    "stream_latest": _configured(stream_latest),
    "stream_progress": _configured(stream_progress),
    "stream_daily_window": _configured(stream_daily_window),
}
