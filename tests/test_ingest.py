"""Landing, cleaning, partitioned writes, catalog."""

from __future__ import annotations

import pytest
from conftest import plan_of, rows

from fleetlens.operators import activity, density, filters, monitor
from fleetlens.plans import rollup
from fleetlens.sources import cleaned as cleaned_source
from fleetlens.plans import etl
from fleetlens.session import scratch_path, shared_dir
from fleetlens.sources import catalog, cleaned, raw

HEADER = "渔船ID,坐标X,坐标Y,速度,方向,时间,作业类型,海域\n"
LINES = [
    "v1,150.5,350.25,5.1,90,2025-06-01 04:00:00,拖网,渤海湾",
    "v1,,,6,91,2025-06-01 04:30:00,拖网,渤海湾",
    "v1,151,351,,92,2025-06-01 05:00:00,拖网,渤海湾",
    "v1,151,351,0,93,2025-06-01 05:30:00,拖网,渤海湾",
    "v1,151,351,-1,94,2025-06-01 06:00:00,拖网,渤海湾",
    "v1,151,351,19.9,95,2025-06-01 06:30:00,拖网,渤海湾",
    "v1,151,351,20,96,2025-06-01 07:00:00,拖网,渤海湾",
    "v1,151,351,30,97,2025-06-01 07:30:00,拖网,渤海湾",
    "v2,abc,351,7,north,2025-06-02 08:00:00,围网,",
    "v2,152,352,fast,10,2025-06-02 08:30:00,围网,黄海中部",
]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    (folder / "a.csv").write_text(HEADER + "\n".join(LINES[:6]) + "\n", encoding="utf-8")
    (folder / "b.csv").write_text(HEADER + "\n".join(LINES[6:]) + "\n", encoding="utf-8")
    return str(folder)


def test_raw_scan_keeps_dirty_text_and_skips_headers(spark, landing):
    df = raw.read_raw(spark, landing)
    assert df.count() == len(LINES)
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.where("speed = 'fast'").count() == 1
    assert df.where("vessel_id = 'v1' AND direction = '91' AND x IS NULL").count() == 1


def test_clean_types_filters_and_derives_day(spark, landing):
    df = etl.clean(raw.read_raw(spark, landing))
    kept = rows(df, "vessel_id", "x", "y", "direction", "sea_area", "dt")
    assert kept == [
        ("v1", None, None, 91, "渤海湾", "2025-06-01"),
        ("v1", 150.5, 350.25, 90, "渤海湾", "2025-06-01"),
        ("v1", 151.0, 351.0, 95, "渤海湾", "2025-06-01"),
        ("v2", None, 351.0, None, None, "2025-06-02"),
    ]
    assert dict(df.dtypes)["speed"] == "float"
    assert rows(df.where("direction = 90").selectExpr("round(CAST(speed AS DOUBLE), 2)")) == [(5.1,)]
    ids = [r.point_id for r in df.select("point_id").collect()]
    assert len(set(ids)) == 4 and min(ids) >= 0


def test_partition_write_replaces_only_its_days(spark, landing):
    path = scratch_path(spark, "cleaned")
    df = etl.clean(raw.read_raw(spark, landing))
    etl.write_cleaned(df, path)
    etl.write_cleaned(df, path)
    assert cleaned.read_cleaned(spark, path).count() == 4
    etl.write_cleaned(df.where("dt = '2025-06-02'").limit(0).unionAll(df.where("dt = '2025-06-01'").limit(1)), path)
    assert rows(cleaned.read_cleaned(spark, path).groupBy("dt").count()) == [("2025-06-01", 1), ("2025-06-02", 1)]


def test_cleaned_scan_prunes_and_types(spark, landing):
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(raw.read_raw(spark, landing)), path)
    one_day = cleaned.read_cleaned(spark, path, dt="2025-06-02")
    assert one_day.count() == 1
    plan = plan_of(one_day.where("speed < 3.0D").select("vessel_id"))
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "LessThan(speed,3.0)" in plan
    assert "ReadSchema: struct<vessel_id:string,speed:float>" in plan
    types = dict(cleaned.read_cleaned(spark, path).dtypes)
    assert (types["speed"], types["record_time"], types["dt"]) == ("double", "timestamp", "string")
    assert rows(cleaned.load_audit(cleaned.read_cleaned(spark, path))) == [
        (4, "2025-06-01 04:00:00", "2025-06-02 08:00:00")
    ]


def test_time_filter_reaches_the_cleaned_files(spark, landing):
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(raw.read_raw(spark, landing)), path)
    plan = plan_of(cleaned.read_cleaned(spark, path).where("record_time < timestamp'2025-06-01 05:00:00'"))
    assert "LessThan(event_time" in plan


def test_cleaned_csv_is_renamed_by_position(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "a,b,c,d,e,f,g,h,i\nv1,1.5,2.5,3.5,90,2025-06-01 04:00:00,拖网,渤海湾,2025-06-01\n"
        "v2,,,4.5,91,bad,围网,,2025-06-01\n",
        encoding="utf-8",
    )
    df = raw.read_cleaned_csv(spark, str(tmp_path))
    assert df.columns == [
        "vessel_id", "x", "y", "speed", "direction", "record_time", "operation_type", "sea_area", "dt",
    ]
    assert rows(df.selectExpr("vessel_id", "x", "speed", "CAST(record_time AS STRING)")) == [
        ("v1", 1.5, 3.5, "2025-06-01 04:00:00"),
        ("v2", None, 4.5, None),
    ]


def test_catalog_tables_can_be_declared_again(spark, landing):
    location = scratch_path(spark, "catalog")
    for _ in range(2):
        catalog.create_tables(spark, "fleet_test", location, raw_path=landing)
        etl.insert_cleaned(etl.clean(spark.table("fleet_test.ais_trajectory_raw")), "fleet_test.ais_trajectory_cleaned")
    names = [r.tableName for r in catalog.list_tables(spark, "fleet_test").collect()]
    assert names == ["ais_trajectory_cleaned", "ais_trajectory_raw"]
    assert spark.table("fleet_test.ais_trajectory_raw").count() == len(LINES)
    table = "fleet_test.ais_trajectory_cleaned"
    assert spark.table(table).count() == 4
    one_day = etl.clean(raw.read_raw(spark, landing)).where("dt = '2025-06-01' AND x IS NULL")
    etl.insert_cleaned(one_day, table)
    assert rows(spark.table(table).groupBy("dt").count()) == [("2025-06-01", 1), ("2025-06-02", 1)]


def test_shared_dir_is_the_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or shared_dir(spark))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_dirty_landing_text(spark):
    columns = "vessel_id string, x string, y string, speed string, direction string, record_time string, operation_type string, sea_area string"
    time = "2025-06-01 04:00:00"
    dirty = [
        ("a", "Infinity", "1", "4", "1", time, "g", "s"), ("b", "1e12", "1", "4", "1", time, "g", "s"), ("c", "NaN", "5", "4", "1", time, "g", "s"),
        ("d", "15", "15", "4", "1", time, "g", "s"), ("d", "15", "15", "4", "1", "garbage", "g", "s"), ("e", None, "5", "4", "1", time, "g", "s"), ("e", "5", None, "4", "1", time, "g", "s"),
    ]
    cleaned = etl.clean(spark.createDataFrame(dirty, columns))
    df = cleaned_source.as_trajectory(cleaned)
    assert rows(density.grid_density(df)) == [("s", 1, 1, 1)]
    assert rows(density.grid_density_pivot(df)) == [("s", 10, 10, 1)]
    assert rows(activity.days_at_sea(df)) == rows(rollup.days_at_sea(rollup.vessel_day_rollup(df)))
    assert rows(activity.daily_points(df)) == rows(rollup.daily_points(rollup.vessel_day_rollup(df)))
    assert filters.latest_date(df).first().today == "2025-06-01"
    assert filters.current_day(df).count() == 6
    assert monitor.kpi_day(df).count() == 1
    assert cleaned.select("point_id").distinct().count() == 7
