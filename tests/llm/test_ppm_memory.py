"""What a Python worker holds at once while it counts a chunk's grams."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np

from tidemark.llm import ppm


def test_grams_of_a_chunk_are_sorted_in_small_blocks():
    docs = ppm.ChunkBuilder(ppm.ORDER)
    for k in range(400):
        docs.add(k, k % 10 == 0, "a price of the day and its volume " * 600)
    assert docs.size > 8_000_000
    tracemalloc.start()
    try:
        keys, n = docs.grams()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100_000_000
    assert n.sum() == sum(len(s) for s, h in zip(docs.streams, docs.held) if not h) and len(keys) == len(set(keys.tolist()))


def test_a_chunk_of_many_grams_is_merged_as_it_is_read():
    rng = np.random.default_rng(1)
    docs = ppm.ChunkBuilder(ppm.ORDER)
    for k in range(400):
        docs.add(k, k % 10 == 0, bytes(rng.integers(97, 123, 10_000).astype(np.uint8)).decode())
    want = Counter()
    for stream, held in zip(docs.streams, docs.held):
        keys, n = np.unique(ppm.gram_keys(np.frombuffer(stream, np.uint8), np.array([0]), ppm.ORDER), return_counts=True)
        want.update(dict(zip(keys.tolist(), n.tolist() if not held else [0] * len(keys))))
    tracemalloc.start()
    try:
        sizes, got = [], {}
        for batch in ppm._chunk_rows(7, docs):
            sizes.append(batch.num_rows)
            grams = [(k, n) for k, n, kind in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "kind"))) if kind == ppm.GRAM]
            assert not set(got) & {k for k, _ in grams}
            got.update(grams)
    finally:
        tracemalloc.stop()
    assert max(sizes) <= ppm.NEED_ROWS and sizes[0] == 1
    assert got == dict(want)
