"""Small helpers for operators that read Arrow batches inside a task.

Batches are cut into slices of bounded size, so a task holds a few texts at a
time however large its partition is. A single text is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_ROWS = 256
SLICE_BYTES = 4 << 20


def slices(
    batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``rows`` rows and about ``size`` bytes of a column."""
    n = batch.num_rows
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + size, side="right"))
        stop = min(max(stop, start + 1), start + rows, n)
        yield batch.slice(start, stop - start)
        start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a column; a null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: T.StructType | str,
    column: str = "text",
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Apply a function to slices. ``make`` runs once per task and gives the function."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch, column, rows):
                out = apply(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def text_udf(
    make: Callable[[], Callable[[list[str]], pa.Array]], kind: T.DataType
) -> Callable:
    """A column function of a text column, computed slice by slice.

    Only the texts go to Python and only the results come back; the other columns of
    the row stay where they are. ``make`` runs once per task and gives a function of
    texts (a null is an empty one).
    """
    empty = pa.array([], to_arrow_type(kind))

    @F.arrow_udf(kind)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = make()
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            parts = [apply(texts(part, "text")) for part in slices(batch, "text")]
            yield pa.concat_arrays([empty, *parts])

    return run


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case; output columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])
