"""Session settings and the shared folder that intermediate data goes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; all of them can be changed on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # `dt` is a text partition: without this Spark reads it back as a DATE.
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    # The default, INT96, carries no statistics that a filter on time could skip row groups by.
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session may go without that setting; there a temporary folder stands in for it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="fleetlens-")
        folder = _local_dirs[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def together(action: Callable[[str], None], names: Iterable[str]) -> None:
    """Submit independent Spark jobs at the same time; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=10) as pool:
        list(pool.map(action, names))


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, where it outlives the executors that computed it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: unlike a checkpoint, Spark then knows its size in bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
