"""Rows ``sign, item, meta`` of which only the signatures held by two items or more are kept.

Tasks write one row per item and signature; a shuffle sorts them by signature and a stream drops the lonely ones, so no
group is ever held. A signature that a task meets often is known to be shared: its rows are spread over salted keys, and
a marker row tells the remaining holders elsewhere. Rows whose meta has a high part (salted or forced) always pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KIND = "sign long, item long, meta long"
HEAVY, SALTS = 64, 64
SHIFT = 48
FORCED = 1 << 60
MARK = -1


def batch(sign: np.ndarray, item: np.ndarray, meta: np.ndarray, forced: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """One task's rows, frequent signatures salted, and the rows that pass in any case."""
    values, back, count = np.unique(sign, return_inverse=True, return_counts=True)
    often = count >= HEAVY
    meta = meta + (np.where(often[back], 1 + (item & (SALTS - 1)), 0) << SHIFT)
    marks = values[often]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([sign, marks, forced[0]])),
            pa.array(np.concatenate([item, np.full(len(marks), MARK, np.int64), forced[1]])),
            pa.array(np.concatenate([meta, np.zeros(len(marks), np.int64), forced[2] + FORCED])),
        ],
        ["sign", "item", "meta"],
    )


def shared(rows: DataFrame, distinct: bool = True) -> DataFrame:
    """Rows of signatures with two items or more (``distinct=False``: two rows), and the rows that always pass."""
    sorted_ = rows.repartition("sign", F.shiftright("meta", SHIFT)).sortWithinPartitions("sign")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shared(batches, distinct)

    return sorted_.mapInArrow(run, KIND).withColumn("forced", F.col("meta") >= FORCED).withColumn("meta", F.col("meta") % (1 << SHIFT))


def _shared(batches: Iterator[pa.RecordBatch], distinct: bool) -> Iterator[pa.RecordBatch]:
    """Only the last signature of a batch is held over, and of that its first row once it is known to be shared."""
    held: pa.RecordBatch | None = None
    shared_before = False
    for rows in batches:
        if held is not None:
            rows = pa.concat_batches([held, rows])
        if not rows.num_rows:
            continue
        sign, item, meta = (rows.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(sign)]]))
        many = np.minimum.reduceat(item, starts) != np.maximum.reduceat(item, starts) if distinct else sizes > 1
        many[0] |= shared_before
        skip = 1 if held is not None and shared_before else 0
        shared_before = bool(many[-1])
        keep = (np.repeat(many, sizes) | (meta >> SHIFT != 0)) & (item != MARK)
        keep[:skip] = False  # passed on with the batch before
        last = int(starts[-1])
        if shared_before:
            held = rows.slice(last, 1)
        else:
            held = rows.slice(last)
            keep[last:] = False
        yield rows.filter(pa.array(keep))
    if held is not None and not shared_before:
        meta, item = held.column(2).to_numpy(), held.column(1).to_numpy()
        yield held.filter(pa.array((meta >> SHIFT != 0) & (item != MARK)))
