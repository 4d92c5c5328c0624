"""A pair of words travels to its shard once per unit of documents, however often it occurs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from parcelstats.llm import language_model


def test_frequent_pairs_travel_once_per_unit(monkeypatch):
    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 0)  # noqa: N815

    monkeypatch.setattr(language_model, "TaskContext", Task)
    texts = ["of the " * 5000] * 20
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20)), pa.array(texts), pa.array([k % 2 == 0 for k in range(20)])], names=["id", "text", "train"]
    )
    hot = np.array([int(language_model.END)], np.uint64)
    rows = [r for out in language_model._requests(hot, 1)(iter([batch])) for r in out.to_pylist()]
    # (of, <s>), (the, of), (of, the), (<end>, the), five bytes each
    assert [len(r["contexts"]) for r in rows if r["shard"] >= 0] == [20]
    times = language_model._unplaned(next(r["times"] for r in rows if r["shard"] >= 0), np.uint32)
    assert sorted(times.tolist()) == [10, 10, 49_990, 50_000]
