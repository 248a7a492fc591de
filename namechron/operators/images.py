"""The gutter of scanned double pages, from grey matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows and columns that are looked at, what is dark, how clean and how wide a gutter is.
ROWS, COLUMNS, DARK, CLEAN, LEAST_WIDTH = (0.10, 0.92), (0.38, 0.62), 128, 0.002, 0.012


def gutter(grey: np.ndarray) -> tuple[int, int, bool]:
    """(x, width, found): middle of the longest run of clean columns near the centre, else the centre."""
    height, width = grey.shape
    low, high = int(width * COLUMNS[0]), int(width * COLUMNS[1])
    share = (grey[int(height * ROWS[0]) : int(height * ROWS[1])] < DARK).mean(axis=0)
    clean = np.concatenate(([0], (share[low:high] < CLEAN).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(clean)).reshape(-1, 2)
    if not len(edges):
        return width // 2, 0, False
    lengths = edges[:, 1] - edges[:, 0]
    begin, end = edges[lengths.argmax()]
    if end - begin < width * LEAST_WIDTH:
        return width // 2, int(end - begin), False
    return int(begin + end + 2 * low) // 2, int(end - begin), True


def gutters(scans: DataFrame) -> DataFrame:
    """scan, x, width and found for rows (scan, height, width, pixels: grey bytes in row order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gutter(np.frombuffer(p, np.uint8).reshape(h, w)) for h, w, p in zip(*(batch.column(c).to_pylist() for c in ("height", "width", "pixels")), strict=True)]
            x, width, ok = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("scan"), pa.array(x, pa.int32()), pa.array(width, pa.int32()), pa.array(ok, pa.bool_())], names=["scan", "x", "width", "found"])

    return scans.select("scan", "height", "width", "pixels").mapInArrow(run, "scan string, x int, width int, found boolean")
