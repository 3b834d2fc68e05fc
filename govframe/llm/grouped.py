"""Sorted rows of numbers as NumPy arrays of whole groups, for steps that compare the members of small groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows that are gathered before they are handed on (a matter of speed; groups are never cut).
GATHER = 50_000


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first ``keys`` columns; no group of equal keys is spread over two results."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < GATHER:
            continue
        columns = _columns(held)
        cut = int(starts_of(columns[:keys])[-1])
        if cut:
            yield [c[:cut] for c in columns]
            rest = pa.RecordBatch.from_arrays([pa.array(c[cut:]) for c in columns], names=batch.schema.names)
            held, rows = [rest], rest.num_rows
    if rows:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    return [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(held[0].num_columns)]


def starts_of(keys: list[np.ndarray]) -> np.ndarray:
    """Index of each group's first row."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)
