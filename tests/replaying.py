"""Files of a paced replay, for tests of the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows per step of the replay.
REPLAY_ROWS = 50


def replay_steps(rows: int) -> int:
    """Steps of a replay at the fixed pace."""
    return max(1, -(-rows // REPLAY_ROWS))


def write_replay_files(df: DataFrame, path: str, steps: int, time: str = "record_time") -> None:
    """Write `df` as `steps` folders of about equal size in time order, one after the other.

    The file source takes files by modification time, so the writing order is the replay order. Rows without a time come first.
    """
    shares = [F.lit(step / steps) for step in range(1, steps)]
    cuts = df.agg(F.percentile_approx(time, F.array(*shares)).alias("cuts")).first()["cuts"] or [] if shares else []
    for step, (low, high) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        part = df
        if low is not None:
            part = part.where(F.col(time) > F.lit(low))
        if high is not None:
            early = F.col(time) <= F.lit(high)
            part = part.where(early | F.col(time).isNull() if low is None else early)
        part.write.parquet(f"{path}/step={step:05d}")
