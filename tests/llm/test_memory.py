"""Memory that workers hand back, as they live on from job to job."""

from pathlib import Path

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from bantin.llm import decontamination, packing
from bantin.llm.common import release
from bantin.llm.tokenise import default_tokenizer


def resident() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096


def test_release_hands_free_pages_back():
    kept, held = [], []
    for _ in range(1_000):  # small blocks that stay lie between those that go, so the heap cannot shrink by itself
        held.append(np.ones(100_000, np.uint8))
        kept.append(np.ones(1_000, np.uint8))
    held.clear()
    before = resident()
    release()
    assert before - resident() > 50_000_000


def test_packing_and_decontamination_work_on_few_texts_at_a_time():
    n = 2_000
    docs = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"gold price {i}" for i in range(n)])], ["doc_id", "text"])
    cut = list(packing._cut(default_tokenizer(), 4096, 1, False)(iter([docs])))
    assert max(map(len, cut)) <= 500 and [i for b in cut for i in b["doc_id"].to_pylist()] == list(range(n))

    make, _ = decontamination._benchmark_windows(10)
    bench = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array(["price 1234"])], ["item_id", "text"])
    windows = SimpleNamespace(value=pa.Table.from_batches(make(iter([bench]))))
    runs = pa.array([[]] * n, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    columns = [docs["doc_id"], docs["text"], pa.array([0] * n, pa.int64()), runs, pa.array([[]] * n, pa.list_(pa.int64()))]
    state = pa.RecordBatch.from_arrays(columns, ["row", "text", "n_words", "runs", "items"])
    hits = list(decontamination._scan(windows)(iter([state])))
    assert max(map(len, hits)) <= 500
    assert [i for b in hits for i, found in zip(b["row"].to_pylist(), b["items"].to_pylist()) if found] == [1234]
