"""The points of a group that can be the farthest from some place: the corners of its convex hull, or a few more.

The farthest point from any place is a corner of the hull, so the hull stands for all points whatever the place turns out to be, and
hulls of two sets of points together hold the hull of both. SQL has no expression for it; it is made by numpy, batch by batch, before
and after a shuffle on the group. A group with most of the points sends a few corners per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _chain(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the lower corners of each group; rows come in order of group, x and y.

    A point on or above the line between its neighbours is no corner, whether or not these are. So all such points go at once,
    until none is left.
    """
    at = np.arange(len(group))
    while True:
        g, u, v = group[at], x[at], y[at]
        turn = (u[1:-1] - u[:-2]) * (v[2:] - v[:-2]) - (v[1:-1] - v[:-2]) * (u[2:] - u[:-2])
        gone = np.zeros(len(at), bool)
        gone[1:-1] = (g[1:-1] == g[:-2]) & (g[1:-1] == g[2:]) & (turn <= 0)
        if not gone.any():
            return at
        at = at[~gone]


def corners(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the rows that are corners of their group's hull; of equal rows one. Rows that are not finite all stay."""
    finite = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
    order = finite[np.lexsort((y[finite], x[finite], group[finite]))]
    g, u, v = group[order], x[order], y[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    order = order[new]
    lower = _chain(group[order], x[order], y[order])
    # The upper corners are the lower ones of the picture upside down, in whose order y falls.
    back = order[np.lexsort((-y[order], x[order], group[order]))]
    upper = _chain(group[back], x[back], -y[back])
    rest = np.setdiff1d(np.arange(len(x)), finite)
    return np.unique(np.concatenate([order[lower], back[upper], rest]))


def _corner_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        group = np.zeros(len(batch), np.int64)
        for column in batch.columns[:-2]:
            codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy()
            group = group * (codes.max(initial=0) + 1) + codes
        x, y = (pc.cast(c, pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[-2:])
        yield batch.take(pa.array(corners(group, x, y)))


def corner_points(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, x, y): points of each group among which is the farthest from any place. Coordinates must not be NULL."""
    rows = points.select(*keys, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    partial = rows.mapInArrow(_corner_rows, rows.schema)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_corner_rows, rows.schema)
