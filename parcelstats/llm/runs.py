"""Whole groups out of a stream of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, first row of each group and the end) with every group complete.

    Rows come sorted by the integer ``keys``; the last group of a batch waits for the next
    batch. What is held is one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = np.stack([batch.column(batch.schema.names.index(k)).to_numpy(False) for k in keys])
        if last is not None and (values == last[:, None]).all():
            held.append(batch)
            continue
        new = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        cut = int(new[-1]) if len(new) else 0
        table = pa.Table.from_batches([*held, batch.slice(0, cut)])
        if table.num_rows:
            yield table, _edges(table, keys)
        held, last = [batch.slice(cut)], values[:, -1]
    if held:
        table = pa.Table.from_batches(held)
        yield table, _edges(table, keys)


def _edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows + 1, dtype=bool)
    changed[[0, -1]] = True
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:-1] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def pairs_of_runs(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all pairs within each run of consecutive positions."""
    end = np.repeat(edges[1:], np.diff(edges))
    place = np.arange(edges[0], edges[-1])
    later = end - place - 1
    i = np.repeat(place, later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    return i, j
