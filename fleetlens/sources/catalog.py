"""Database and table declarations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema as S

# Names of the landing and the cleaned table.
RAW_TABLE = "ais_trajectory_raw"
CLEANED_TABLE = "ais_trajectory_cleaned"


def create_tables(spark: SparkSession, database: str, location: str, raw_path: str | None = None) -> None:
    """(Re)declare the landing and cleaned tables. Dropping an external table leaves its files alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for table in (RAW_TABLE, CLEANED_TABLE):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    raw_columns = ", ".join(f"{name} STRING" for name in S.RAW_COLUMNS)
    spark.sql(
        f"CREATE TABLE {database}.{RAW_TABLE} ({raw_columns}) USING csv "
        f"OPTIONS (header 'true') LOCATION '{raw_path or location + '/raw'}'"
    )
    cleaned_columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.CLEANED_SCHEMA)
    spark.sql(
        f"CREATE TABLE {database}.{CLEANED_TABLE} ({cleaned_columns}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (dt) LOCATION '{location}/cleaned'"
    )


# NULL has a mark of its own in the text of a result, so that an empty text stays one.
RESULT_TEXT = r"OPTIONS (header 'true', nullValue '\\N', emptyValue '')"


def create_result_tables(spark: SparkSession, database: str, location: str) -> None:
    """Declare the ten result tables: typed, external, delimited text. A table that exists keeps the rows it has."""
    for name, columns in S.RESULT_TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING csv {RESULT_TEXT} LOCATION '{location}/{name}/empty'")


def replace_result(spark: SparkSession, database: str, location: str, name: str, rows: DataFrame) -> None:
    """Replace the rows of a result table at once: written to a folder of its own first, to which the table is then switched.

    Readers have the old rows until the switch and the new ones after it; a write that fails changes nothing.
    """
    folder = f"{location}/{name}/{uuid.uuid4().hex}"
    declared = [field.split() for field in S.RESULT_TABLES[name].split(", ")]
    rows.select(*[F.col(column).cast(kind) for column, kind in declared]).write.options(header=True, nullValue="\\N").csv(folder)
    spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {database}.{name}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")
