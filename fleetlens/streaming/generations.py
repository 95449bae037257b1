"""Compaction of the stored summaries: the batches of a day merged into one generation, switched by a manifest.

A part has a folder per batch (`<part>/batch_id=…`), and, once merged, a generation per day (`_base/<part>/gen=…/dt=…`). The manifest
(`_merged/<part>/v=…`, one file a version, all of it) says for each day which generation holds it and up to which batch. Readers take
the highest version: its generations, and of later batches their own folders. So a merge that fails, or is still running, changes
nothing for them. What a version has made obsolete is deleted when the next but one is there, so that a reader which
started before the switch finds its files.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "dt string, gen bigint, v bigint"


def _found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What is read, or nothing if its folder was never written."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def manifest(spark: SparkSession, path: str, part: str) -> tuple[int, dict[str | None, int]]:
    """The highest version (the last batch merged, or -1) and the generation of each day; days are as many as the calendar has."""
    stored = _found(lambda: spark.read.schema(MANIFEST).parquet(f"{path}/_merged/{part}"))
    if stored is None:
        return -1, {}
    # At most two versions are there.
    rows = stored.collect()
    version = max((row.v for row in rows), default=-1)
    return version, {row.dt: row.gen for row in rows if row.v == version}


def _days_of(generations: dict[str | None, int], test: Callable[[int], Column]) -> Column:
    """Rows whose day and number meet the test of the day's generation. Both are folder columns, so this selects folders."""
    days = defaultdict(list)
    for dt, gen in generations.items():
        days[gen].append(dt)
    tests = []
    for gen, held in days.items():
        known = F.col("dt").isin([d for d in held if d is not None]) if any(d is not None for d in held) else F.lit(False)
        among = F.coalesce(known, F.lit(False))
        tests.append((among | F.col("dt").isNull() if None in held else among) & test(gen))
    return reduce(Column.__or__, tests, F.lit(False))


def read(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """All rows of a part: merged generations, and the batches after them. `batch_id` is the batch, or the generation's last."""
    return _read(spark, path, part, schema, manifest(spark, path, part)[1])


def _read(spark: SparkSession, path: str, part: str, schema: str, generations: dict[str | None, int]) -> DataFrame:
    number = F.col("batch_id").cast("long")
    batches = _found(lambda: spark.read.schema(f"{schema}, batch_id string").parquet(f"{path}/{part}"))
    later = None if batches is None else batches.where(~_days_of(generations, lambda gen: number <= gen))
    if not generations:
        return later if later is not None else spark.createDataFrame([], f"{schema}, batch_id string")
    base = spark.read.schema(f"{schema}, gen bigint").parquet(f"{path}/_base/{part}")
    base = base.where(_days_of(generations, lambda gen: F.col("gen") == gen)).withColumn("batch_id", F.format_string("%08d", "gen")).drop("gen")
    return base if later is None else base.unionByName(later)


def merge(spark: SparkSession, path: str, part: str, schema: str, upto: int, merged: Callable[[DataFrame], DataFrame]) -> int:
    """Merge the days that batches since the last merge touched, up to batch `upto`; returns the number of those days.

    Of each such day all rows are read, those of other days not. A repeated call finds nothing new.
    """
    version, generations = manifest(spark, path, part)
    number = F.col("batch_id").cast("long")
    batches = _found(lambda: spark.read.schema(f"{schema}, batch_id string").parquet(f"{path}/{part}"))
    if batches is None or upto <= version:
        return 0
    touched = [row.dt for row in batches.where((number > version) & (number <= upto)).select("dt").distinct().collect()]
    if not touched:
        return 0
    chosen = _days_of({dt: 0 for dt in touched}, lambda _: F.lit(True))
    rows = _read(spark, path, part, schema, generations).where((number <= upto) & chosen).drop("batch_id")
    merged(rows).hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{path}/_base/{part}/gen={upto:08d}")
    switched = [(dt, gen) for dt, gen in {**generations, **{dt: upto for dt in touched}}.items()]
    rows = spark.createDataFrame(switched, "dt string, gen bigint").coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path}/_merged/{part}/v={upto:08d}")
    _forget(spark, path, part, version, generations)
    return len(touched)


def _forget(spark: SparkSession, path: str, part: str, version: int, generations: dict[str | None, int]) -> None:
    """Delete what neither the last version nor the one before (given here) names: merged batches and replaced generations."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder, keep in (
        (f"{path}/{part}", lambda k: k > version),
        (f"{path}/_base/{part}", lambda k: k > version or k in generations.values()),
        (f"{path}/_merged/{part}", lambda k: k >= version),
    ):
        place = jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(conf)
        for status in files.listStatus(place) if files.exists(place) else []:
            name, _, value = status.getPath().getName().partition("=")
            if name in ("batch_id", "gen", "v") and not keep(int(value)):
                files.delete(status.getPath(), True)
