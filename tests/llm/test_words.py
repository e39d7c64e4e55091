import numpy as np
import pyarrow as pa

from tasteforge.llm.decontaminate import Templates, symbols_of, windows_of
from tasteforge.llm.words import slices, words_of


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["id", "text"])


def test_slices_are_short_and_lose_no_row():
    texts = [f"word{i} " * 100 for i in range(3000)] + [None, "", "long " * 300_000, "end"]
    parts = list(slices(batch_of(texts), "text"))
    assert [r for p in parts for r in p.column(1).to_pylist()] == texts
    sizes = [[len(t or "") for t in p.column(1).to_pylist()] for p in parts]
    assert all(sum(s) <= 512 << 10 or len([x for x in s if x]) == 1 for s in sizes)


def test_words_and_windows_do_not_depend_on_slices():
    batch = batch_of([f"Here Anna {i} has {i % 9} apples and gives {i} to Bob Smith, so what is left of all the apples? " * 20 for i in range(900)])

    def hashes(max_bytes):
        parts = [p.column(1) for p in slices(batch, "text", max_bytes)]
        words = np.concatenate([words_of(p).hash for p in parts])
        windows = [np.concatenate([h for h, _, _ in windows_of(symbols_of(p), 8, Templates())]) for p in parts]
        return words, np.sort(np.concatenate(windows))

    (words, windows), (again, others) = hashes(1 << 30), hashes(512 << 10)
    assert (words == again).all() and (windows == others).all()
