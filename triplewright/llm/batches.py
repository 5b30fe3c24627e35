"""Python over Arrow batches that passes all other columns through unchanged, nulls included."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Values of new columns by name, for the values of the columns read.
Columns = dict[str, Iterable]


def cut(batches: Iterator[pa.RecordBatch], rows: int | None) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows."""
    for batch in batches:
        if rows is None:
            yield batch
        else:
            yield from (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def add_columns(
    df: DataFrame,
    inputs: list[str],
    fields: str,
    compute: Callable[..., Columns],
    drop: bool = False,
    rows_at_once: int | None = None,
) -> DataFrame:
    """Add the columns ``fields`` (``name type, …``), which ``compute`` makes from the lists of
    values of ``inputs``. ``drop`` leaves the inputs out. Columns of the new names are replaced.
    ``rows_at_once`` bounds the rows of a call, for values that are large beside their texts."""
    added = StructType.fromDDL(fields).names
    left_out = set(inputs) if drop else set()
    kept = [f for f in df.schema if f.name not in left_out and f.name not in added]
    names = [f.name for f in kept]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, rows_at_once):
            if batch.num_rows:
                values = compute(*(batch.column(name).to_pylist() for name in inputs))
                arrays = [batch.column(name) for name in names]
                arrays += [v if isinstance(v := values[name], pa.Array) else pa.array(v, from_pandas=True) for name in added]
                yield pa.RecordBatch.from_arrays(arrays, names=names + added)

    # Only what is read or passed on crosses into Python.
    return df.select(*dict.fromkeys([*names, *inputs])).mapInArrow(run, schema)
