"""Vector columns: which rows take part, and their entries as scaled integers in numpy, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry c stands as floor(SCALE * c).
SCALE = 1024
#: Entries of this magnitude have scaled squares whose sums leave 64 bits; vectors that hold one are left out.
LARGEST = 1 << 17
#: Rows of a block.
BLOCK = 2048


def kept(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """rows whose vector takes part, and the dimension.

    A vector takes part if it is not null, no entry is null, NaN, infinite or of magnitude LARGEST or more, and it has
    the dimension that most of these have (of equally many, the larger one). Without any such row the dimension is 0.
    """
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    sound = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    most = sound.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return rows.filter("false"), 0
    return sound.filter(F.size(vector) == most.d), most.d


def scaled(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) of a column of vectors of one dimension; exact, as SCALE is a power of two."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dims)


def blocks(batches: Iterator[pa.RecordBatch], vector: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most BLOCK rows with their scaled vectors."""
    for batch in batches:
        for s in range(0, batch.num_rows, BLOCK):
            part = batch.slice(s, BLOCK)
            yield part, scaled(part.column(vector), dims)
