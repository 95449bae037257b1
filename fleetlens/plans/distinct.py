"""Exact distinct counts that add up: bitmaps of numbered vessels and grid cells per day.

A distinct count of a month is not the sum of its days'. Here vessels and cells get dense numbers from a stored dictionary, and a day
holds one bit for each that it saw: 4 KB for every 32,768 numbers. Days, months, batches and any other sets of days then merge with OR,
in the map tasks first, and the count is that of the bits. The dictionary grows by what is new; numbers once given stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions import expressions as X
from fleetlens.operators.monitor import CELL
from fleetlens.session import stored

KINDS = {"vessel": "vessel_id", "cell": CELL}
DICTIONARY = "kind string, value string, number bigint"
BITMAPS = "kind string, bucket bigint, bits binary, dt string"


def seen(df: DataFrame) -> DataFrame:
    """(dt, kind, value): the vessels and valid grid cells of each day."""
    entries = ", ".join(f"struct('{kind}' AS kind, {value} AS value)" for kind, value in KINDS.items())
    return df.selectExpr("dt", f"inline(array({entries}))").where("value IS NOT NULL").distinct()


def number_new(values: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, value, number) of the distinct `values` that `known` does not hold, numbered on from its highest number per kind.

    Values are sorted over all tasks. A value's number is its place in its task, behind what the tasks before it hold.
    """
    fresh = values.select("kind", "value").distinct().join(known, ["kind", "value"], "left_anti")
    placed = fresh.repartitionByRange("kind", "value").sortWithinPartitions("kind", "value")
    # The identifier counts the rows of a task in its lower 33 bits; the task's number is above them.
    placed = placed.withColumn("at", F.monotonically_increasing_id()).selectExpr("kind", "value", "at >> 33 AS task", "at & 8589934591 AS place")
    placed = stored(placed, "numbered")
    tasks = placed.groupBy("kind", "task").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("kind").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).select("kind", "task", "start")
    highest = known.groupBy("kind").agg((F.max("number") + 1).alias("base"))
    # One row per kind and task, and one per kind.
    numbered = placed.join(F.broadcast(starts), ["kind", "task"]).join(F.broadcast(highest), "kind", "left")
    return numbered.selectExpr("kind", "value", "coalesce(base, 0L) + start + place AS number")


def bitmaps(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(kind, bucket, bits, dt): a bit for each number that the day saw."""
    numbered = values.join(dictionary, ["kind", "value"])
    groups = numbered.groupBy("dt", "kind", F.expr("bitmap_bucket_number(number) AS bucket"))
    return groups.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(number)) AS bits")).select("kind", "bucket", "bits", "dt")


def write(df: DataFrame, path: str) -> None:
    """Add what is new to the dictionary under `path` and replace the bitmaps of the days in `df`."""
    spark = df.sparkSession
    values = stored(seen(df), "seen")
    known = read_dictionary(spark, path)
    number_new(values, known).write.mode("append").parquet(f"{path}/dictionary")
    days = bitmaps(values, read_dictionary(spark, path)).hint("rebalance", "dt")
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{path}/bitmaps")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    folder = spark.createDataFrame([], DICTIONARY)
    folder.write.mode("append").parquet(f"{path}/dictionary")
    return spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary")


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BITMAPS).parquet(f"{path}/bitmaps")


def counts(bits: DataFrame) -> DataFrame:
    """One row: distinct vessels and cells of all days in `bits`."""
    merged = bits.groupBy("kind", "bucket").agg(F.expr("bitmap_or_agg(bits) AS bits"))
    return merged.selectExpr(*[f"coalesce(sum(bitmap_count(bits)) FILTER (WHERE kind = '{kind}'), 0L) AS {kind}s" for kind in KINDS])


def counts_by_month(bits: DataFrame) -> DataFrame:
    """Distinct vessels and cells per month, merged from the days' bitmaps."""
    dated = bits.where(F.expr(X.DATED).isNotNull()).withColumn("month", F.expr("substring(dt, 1, 7)"))
    merged = dated.groupBy("month", "kind", "bucket").agg(F.expr("bitmap_or_agg(bits) AS bits"))
    sums = [F.expr(f"coalesce(sum(bitmap_count(bits)) FILTER (WHERE kind = '{kind}'), 0L) AS {kind}s") for kind in KINDS]
    return merged.groupBy("month").agg(*sums)
