"""Decontamination: words hashed a block of texts at a time, grams looked up and met with items in blocks."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import xxhash

from tidemark.llm import decontaminate


def test_words_of_many_texts_are_hashed_at_once():
    r = random.Random(12)
    some = lambda n: "".join(r.choice(" \t\n\x0b\x0c\r\x1c.,(?abAB\xa0é") for _ in range(n))
    long = "y" * (decontaminate.LONG_WORD - 1)
    texts = [some(r.randint(0, 60)) for _ in range(800)] + [None, "", " ", "...", " . x ", f"{long} {long}y ({long}yy) {long}yz.", "abcdefgh abcdefghi"]
    names = {}
    for column in (pa.array(texts), pa.array(["x y", *texts], pa.large_string()).slice(1), pa.array(["x y", *texts]).slice(1)):
        hashes, begin = decontaminate.hash_words(column)
        words = [decontaminate.words_of(t) for t in texts]
        assert np.diff(begin).tolist() == [len(w) for w in words]
        for w, x in zip([w for ws in words for w in ws], hashes.tolist(), strict=True):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)
    assert [len(x) for x in decontaminate.hash_words(pa.array([], pa.string()))] == [0, 1]


def test_pairs_do_not_span_texts():
    words, begin = decontaminate.hash_words(pa.array(["a b", None, "c", "a b a b c", "", "d a"]))
    pair = {p: int(decontaminate.Hasher.pairs(decontaminate.hash_words(pa.array([p]))[0])[0]) for p in ("a b", "b a", "b c", "c a", "d a")}
    want = {(0, "a b"), (3, "a b"), (3, "b a"), (3, "b c"), (5, "d a")}
    for known in (None, decontaminate.GramSet(np.array(list(pair.values())))):
        row, gram = decontaminate._grams(words, begin, known, False)
        assert list(zip(row.tolist(), gram.tolist())) == sorted((k, pair[p]) for k, p in want)


def test_hashing_costs_less_than_looking_words_up():
    r = random.Random(13)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)) for _ in range(300)]
    column = pa.array(texts)

    def cpu(job):
        took = []
        for _ in range(5):
            start = time.process_time()
            job()
            took.append(time.process_time() - start)
        return min(took)

    def one_by_one():
        memo = {}
        for t in texts:
            for w in decontaminate.words_of(t):
                if w not in memo:
                    memo[w] = xxhash.xxh64_intdigest(w)

    # The texts are split into words either way; hashing all of these takes a fraction of a look-up a word.
    assert sum(len(h) for _, _, h, _ in decontaminate._hashed(column)) == 400 * 300
    assert 2 * cpu(lambda: list(decontaminate._hashed(column))) < cpu(one_by_one)


def test_items_are_met_alike_in_small_blocks(spark, monkeypatch):
    r = random.Random(14)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    common = [word() for _ in range(6)]
    items = [[*common, *(word() for _ in range(12))] for _ in range(15)] + [["aa", "bb", "cc"]]
    docs = [[word(), *items[d % 16], word(), *common] if d % 4 == 0 else [*common, word()] for d in range(64)]
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id bigint, text string").coalesce(1)
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    for size in (decontaminate.BLOCK_GRAMS, 1):
        monkeypatch.setattr(decontaminate, "BLOCK_GRAMS", size)
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = {(x.doc_id, x.item_id) for x in decontaminate.find_contamination(frame, tests).collect()}
        assert got == {(d, d % 16) for d in range(0, 64, 4)}
