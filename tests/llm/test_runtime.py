import numpy as np
import pyarrow as pa

from spindle.llm import bpe
from spindle.llm.runtime import released


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_a_task_gives_its_memory_back():
    kept = []

    def batches():
        held = [np.ones(8_000) for _ in range(3_000)]       # 192 MB in small pieces
        kept.append(np.ones(8_000))                         # behind them, so the heap cannot just end earlier
        yield len(held)
    before = resident()
    assert list(released(batches())) == [3_000]
    assert resident() - before < 48 << 20


def test_few_texts_are_held_while_encoding():
    class Sent:
        value = bpe.Bpe({"a</w>": 0}, {}, ["a</w>"], {}, "</w>")
    batch = pa.RecordBatch.from_pydict({"k": list(range(40)), "t": ["a " * 50_000] * 40})
    sizes = [b.nbytes for b in bpe._decoded(bpe._encoded([batch], Sent), Sent)]
    assert sum(sizes) > 40 * 50_000 * 8 and max(sizes) < 4 << 20
