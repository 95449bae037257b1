"""Files of a replay hold all rows."""

from __future__ import annotations

from fleetlens.session import scratch_path
from replaying import write_replay_files


def test_rows_without_a_time_are_in_the_first_step(spark):
    rows = [(k, f"2025-06-01 04:00:{k:02d}" if k < 9 else None) for k in range(12)]
    df = spark.createDataFrame(rows, "id int, time string").selectExpr("id", "CAST(time AS TIMESTAMP) AS record_time")
    for part in (df, df.where("record_time IS NULL")):
        path = scratch_path(spark, "steps")
        write_replay_files(part, path, 3)
        read = spark.read.option("recursiveFileLookup", True).schema(df.schema)
        assert sorted(r.id for r in read.parquet(path).collect()) == sorted(r.id for r in part.collect())
        first = {r.id for r in read.parquet(f"{path}/step=00000").collect()}
        assert first >= {9, 10, 11}
