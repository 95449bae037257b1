"""Landing layer: comma-delimited text with one header line, all columns text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RAW_SCHEMA).option("header", True).csv(path)


def read_cleaned_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export of the cleaned table whose nine columns are known by position only.

    The header's own names are ignored. Times are parsed; malformed ones become NULL.
    """
    names = (*S.RAW_COLUMNS, "dt")
    types = ("string", "double", "double", "double", "int", "string", "string", "string", "string")
    declared = ", ".join(f"{name} {kind}" for name, kind in zip(names, types, strict=True))
    df = spark.read.schema(declared).option("header", True).option("enforceSchema", True).csv(path)
    return df.withColumn("record_time", F.expr(X.parse_time("record_time")))
