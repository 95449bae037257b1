"""Declared result tables, zero-filled matrices, running ranges, distinct counts from bitmaps."""

from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetlens.operators import density, reach
from fleetlens.plans import distinct, results
from fleetlens.session import scratch_path
from fleetlens.sources import catalog, events

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def df(spark):
    return events.trajectories(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def database(spark, df):
    name, location = f"published_{uuid.uuid4().hex[:8]}", scratch_path(spark, "published")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}/database'")
    results.publish(df, name, location)
    return name, location


def test_result_tables_are_typed_and_replaced(spark, df, database):
    name, location = database
    listed = rows(catalog.list_tables(spark, name).select("tableName"))
    assert [t for (t,) in listed] == list(results.RESULT_NAMES)
    direct = results.ten_results(df, *results.build_summaries(df, scratch_path(spark, "summary")))
    for table, frame in direct.items():
        kept = spark.table(f"{name}.{table}")
        assert kept.dtypes == [(c, t) for c, t in frame.dtypes]
        rounded = [f"round({c}, 6) AS {c}" if t == "double" else c for c, t in frame.dtypes]
        assert rows(kept.selectExpr(*rounded)) == rows(frame.selectExpr(*rounded))
    for table, frame in direct.items():
        catalog.replace_result(spark, name, location, table, frame.where("false"))
    assert all(spark.table(f"{name}.{t}").count() == 0 for t in results.RESULT_NAMES)
    results.publish(df, name, location)
    assert spark.table(f"{name}.ads_result007").count() == direct["ads_result007"].count()


def test_a_failed_write_keeps_the_old_rows(spark, df, database):
    name, location = database
    before = rows(spark.table(f"{name}.ads_result002"))
    broken = df.select(F.col("operation_type").alias("op_type"), F.expr("raise_error('lost')").cast("bigint").alias("cnt"))
    with pytest.raises(Exception, match="lost"):
        catalog.replace_result(spark, name, location, "ads_result002", broken)
    assert before and rows(spark.table(f"{name}.ads_result002")) == before


def test_matrix_is_complete_for_any_coordinates(fixes):
    df = fixes(
        {"x": 5.0, "y": 5.0}, {"x": 5.0, "y": 5.0, "vessel_id": "b"}, {"x": 95.0, "y": 15.0}, {"x": -1e9, "y": 5.0}, {"x": 1e30, "y": 5.0},
        {"x": 0.0, "y": 0.0, "sea_area": "东海近海"}, {"x": None, "y": 7.0}, {"sea_area": None},
    )
    made = density.grid_density_matrix(df, 4).selectExpr("sea_area", "grid_y", "inline(arrays_zip(grid_xs, densities)) AS (grid_x, density)")
    home = [(y, x, n) for area, y, x, n in rows(made) if area == "渤海湾"]
    assert home == [(0, -1000000000, 1), (0, 0, 2), (0, 90, 0), (10, -1000000000, 0), (10, 0, 0), (10, 90, 1)]
    assert [(y, x, n) for area, y, x, n in rows(made) if area == "东海近海"] == [(0, 0, 1)]
    assert max(len(r.grid_xs) for r in density.grid_density_matrix(df, 4).collect()) <= 4


def test_running_range_over_blocks(spark, fixes):
    import random

    draw = random.Random(2)
    data = [
        {"point_id": k, "vessel_id": "a" if k % 3 else "b", "record_time": None if k == 50 else f"2025-06-0{1 + k % 2} {draw.randrange(24):02d}:00:00", "x": draw.random() * 9, "y": None if k % 17 == 0 else 3.0}
        for k in range(200)
    ]
    df = fixes(*data).withColumn("dt", F.coalesce("dt", F.lit("2025-06-01")))
    got = {r.point_id: r.running_dist for r in reach.running_range(df.repartition(7)).collect()}
    groups, want = {}, {}
    for r in sorted(df.where("y IS NOT NULL").collect(), key=lambda r: (r.vessel_id, str(r.record_time or r.dt)[:10], str(r.record_time or ""), r.point_id)):
        key = (r.vessel_id, str(r.record_time or r.dt)[:10])
        x0, best = groups.get(key, (r.x, 0.0))
        best = max(best, abs(r.x - x0))
        groups[key], want[r.point_id] = (x0, best), best
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    final = df.sparkSession.createDataFrame([(v, d, b) for (v, d), (_, b) in groups.items()], "v string, d string, b double")
    assert {(r.v, r.d): round(r.b, 9) for r in final.collect()} == {(r.vessel_id, str(r.day)): round(r.dist, 9) for r in reach.vessel_day_range(df).collect()}


def test_numbers_are_dense_and_stay(spark, df):
    path = scratch_path(spark, "distinct")
    days = sorted(r.dt for r in df.select("dt").distinct().collect())
    distinct.write(df.where(F.col("dt") < days[10]), path)
    before = {(r.kind, r.value): r.number for r in distinct.read_dictionary(spark, path).collect()}
    distinct.write(df.where(F.col("dt") >= days[8]), path)
    after = {(r.kind, r.value): r.number for r in distinct.read_dictionary(spark, path).collect()}
    assert all(after[k] == n for k, n in before.items())
    for kind in distinct.KINDS:
        numbers = sorted(n for (k, _), n in after.items() if k == kind)
        assert numbers == list(range(len(numbers))) and len(numbers) > 10
    bits = distinct.read_bitmaps(spark, path)
    direct = df.selectExpr("count(DISTINCT vessel_id) AS vessels", f"count(DISTINCT {distinct.KINDS['cell']}) AS cells")
    assert rows(distinct.counts(bits)) == rows(direct)
    assert rows(distinct.counts(bits.where("false"))) == [(0, 0)]
