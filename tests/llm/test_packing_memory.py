"""What a packing task holds at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tickhouse.llm import packing


def test_op5_task_holds_no_second_vocabulary():
    model = packing._encoder(packing.ByteBpe.public())
    plain = model.encode("some words of a text")
    assert "_whole" not in model.__dict__ and model.size == 50_257
    special = model.encode(f"some words of a text{model.special[0]}")
    assert special[:-1].tolist() == plain.tolist() and "_whole" in model.__dict__


def test_op5_batches_are_sliced_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 1000)
    sizes = np.random.default_rng(1).integers(0, 400, 500).tolist() + [5000, 0, 0, 5000]
    texts = ["x" * n for n in sizes] + [None, "é" * 700, ""]
    batches = [pa.RecordBatch.from_pydict({"at": range(n), "text": pa.array(texts[:n], pa.string())})
               for n in (0, 1, len(texts))]
    got = list(packing.sliced(iter(batches), "text"))
    assert [x for b in got for x in b.column("text").to_pylist()] == texts[:1] + texts
    for b in got:
        assert b.num_rows
        assert sum(len((t or "").encode()) for t in b.column("text").to_pylist()[1:]) <= 1000
    assert len(got) > 60
