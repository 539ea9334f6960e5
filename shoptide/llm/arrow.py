"""Small helpers around mapInArrow: carried columns, added columns, list columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shoptide.llm.words import small_batches


def add_columns(
    frame: DataFrame,
    text: str,
    added: Sequence[T.StructField],
    work: Callable[[pa.RecordBatch], Sequence[pa.Array]],
) -> DataFrame:
    """``frame`` with the columns ``added``, which ``work`` makes of a few megabytes of rows at a time.
    A column of the frame that has the name of an added one is replaced."""
    names = {field.name for field in added}
    carried = [c for c in frame.columns if c not in names]
    schema = T.StructType([f for f in frame.schema.fields if f.name not in names] + list(added))
    added_names = [field.name for field in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, text):
                made = work(part)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + list(made), carried + added_names)

    return frame.mapInArrow(run, schema)


def lists(items: Iterable[Sequence], kind: pa.DataType) -> pa.Array:
    return pa.array(list(items), type=pa.list_(kind))


def per_row(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of flags[first[i]:first[i + 1]] for each i."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]
