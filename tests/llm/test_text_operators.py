"""Classifier, SimHash, substring dedup, decontamination, pieces, PPM and the pipeline
against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, ordinal, ppm, sentencepiece_codec, simhash, substring_dedup

SF = "/root/testdata/sf0.01"


# -- ordinal classifier ------------------------------------------------------


def test_ordinal_recovers_order_of_planted_grades():
    rng = np.random.default_rng(3)
    index, grades = [], []
    for _ in range(900):
        g = int(rng.integers(3))
        noise = rng.choice(np.arange(10, 200), 20, replace=False)
        index.append(np.concatenate([noise, [g], [3 + g]]).astype(np.int32))
        grades.append(g)
    m = ordinal.fit_ordinal(index[:600], np.array(grades[:600]), 3, dimensions=256)
    assert m.thresholds[0] < m.thresholds[1]
    s = np.array([m.score(x) for x in index[600:]])
    tails = m.tails(s)
    assert (tails[:, 0] >= tails[:, 1]).all()
    predicted = (tails > 0.5).sum(axis=1)
    assert (predicted == np.array(grades[600:])).mean() > 0.95


def test_ordinal_without_rows_or_with_one_grade():
    assert not ordinal.fit_ordinal([], np.array([], dtype=int), 3, dimensions=8).weights.any()
    one = ordinal.fit_ordinal([np.array([1], np.int32)] * 4, np.array([2] * 4), 3, dimensions=8)
    assert np.isfinite(one.weights).all() and np.isfinite(one.thresholds).all()


def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    grades = ordinal.grades_of_labels(spark.read.parquet("/root/testdata/sf0.1/labels.parquet")).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    test = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    model = ordinal.train_classifier(docs, grades.filter(~test), 3)
    scored = ordinal.score_documents(docs.join(grades.filter(test), "doc_id"), model)
    rows = scored.select("grade", (F.col("tail_probability") >= ordinal.KEEP_FROM).alias("kept")).collect()
    share = {g: np.mean([r.kept for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert share[2] > 0.9 and share[0] < 0.35 and share[1] < 0.25


def test_classifier_edges(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (5, 0, 0), (6, 0, 1), (None, 1, 0), (7, None, None)], "doc_id bigint, quality int, toxic int")
    got = ordinal.classify(odd_docs, labels)
    assert got.count() == odd_docs.count()
    assert {"score", "expected_grade", "tail_probability", "kept", "fp"} <= set(got.columns)
    assert dict(got.dtypes)["score"] == "double"
    assert ordinal.classify(empty_docs, labels).count() == 0
    assert ordinal.classify(odd_docs, labels.limit(0)).count() == odd_docs.count()


# -- SimHash -----------------------------------------------------------------


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(values, near):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("max_bits", [2, 3, 4, 5])
def test_links_lose_no_pair(spark, max_bits):
    r = random.Random(max_bits)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(64)
        fps.add(x)
        for _ in range(6):
            y = x
            for b in r.sample(range(64), r.randint(0, 7)):
                y ^= 1 << b
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), max_bits).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits}
    assert Counter((x.a, x.b) for x in got) == Counter(want)  # each pair exactly once


def test_components_of_chains(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(r.randint(200, 230), r.randint(200, 230)) for _ in range(25)]
    got = {x.node: x.root for x in simhash.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    links = {frozenset(e) for e in edges}
    group = roots(nodes, lambda a, b: frozenset((a, b)) in links)
    least = {g: min(n for n, x in zip(nodes, group) if x == g) for g in group}
    assert got == {n: least[g] for n, g in zip(nodes, group)}


def test_near_duplicates_match_brute_force(spark, odd_docs, empty_docs):
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    )
    rows = docs.collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    group = roots(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(lambda: None)
    for r, g in zip(rows, group):
        if r.doc_id is not None:
            least[g] = r.doc_id if least[g] is None else min(least[g], r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, group))
    got = simhash.near_duplicates(docs.withColumn("fp", F.lit("x"))).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty_docs).count() == 0


def test_keep_first_keeps_one_row_a_group(spark, odd_docs, empty_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    fps = [brute_fingerprint(r.text) for r in odd_docs.collect()]
    assert kept.count() == len(set(roots(fps, lambda a, b: (a ^ b).bit_count() <= 4)))
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 1 in ids and 2 not in ids  # null and empty texts share fingerprint zero
    assert simhash.keep_first(empty_docs).count() == 0


# -- substring dedup ---------------------------------------------------------


def picked_next(q, p, units):
    """Whether no window was picked between those at q and p."""
    pos, line = units[0], units[4]
    return not ((pos[~line] > q) & (pos[~line] < p)).any()


def brute_passages(rows, least=substring_dedup.MIN_RUN_WORDS):
    """rows: (doc_id, text) in rank order. (doc_id, start, stop, words) of what goes, by comparing words; the places of units are the cutter's."""
    cut, seen, out = substring_dedup.UnitCutter(), {}, []
    texts, units = [t.encode().lower().split() for _, t in rows], [cut(t) for _, t in rows]
    for at, (d, t) in enumerate(rows):
        mine, pieces, runs, k_before = texts[at], [], [], None
        for p, n, line in sorted(zip(*(x.tolist() for i, x in enumerate(units[at]) if i in (0, 1, 4)))):
            k_at, k = seen.setdefault((line, *mine[p : p + n]), (at, p))
            if (k_at, k) == (at, p) or (k_at == at and p < k + n):
                continue
            if line:
                pieces.append((p, p + n, True))
                continue
            q = runs[-1][1] - n if runs else None  # the window before
            along = k_before and k_before[0] == k_at and p - q == k - k_before[1] and mine[q:p] == texts[k_at][k_before[1] : k]
            if runs and (p <= q + n or (along and picked_next(q, p, units[at]) and picked_next(k_before[1], k, units[k_at]))):
                runs[-1][1:] = [p + n, runs[-1][2], (k_at, k + n)]
            else:
                runs.append([p, p + n, (k_at, k), (k_at, k + n)])
            k_before = (k_at, k)
        for a, b, (l_at, l), (r_at, r) in runs:
            p, q = a, b
            reach = min(least - 8, p - l - 8) if l_at == at else least - 8
            while p - a < reach and a and l - (p - a) and mine[a - 1] == texts[l_at][l - (p - a) - 1]:
                a -= 1
            while b - q < least - 8 and b < len(mine) and r + b - q < len(texts[r_at]) and mine[b] == texts[r_at][r + b - q]:
                b += 1
            pieces.append((a, b, False))
        groups = []
        for a, b, line in sorted(pieces):
            if groups and a <= groups[-1][1]:
                groups[-1][1] = max(b, groups[-1][1])
            else:
                groups.append([a, b, set()])
            groups[-1][2] |= {(a, b)} if line else set()
        spans = [m.span() for m in re.finditer(r"[^\x09-\x0d\x20]+", t)]
        for a, b, lines in groups:
            out += [(d, spans[x][0], spans[y - 1][1], y - x) for x, y in ([(a, b)] if b - a >= least else sorted(lines))]
    return out


def test_units_are_lines_and_windows():
    text = " Été  the quick\tbrown\n\nfox 😀 jumps \x0bover the LAZY dog\r\nend"
    pos, words, digest, _, line = substring_dedup.UnitCutter()(text)
    assert [(p, n) for p, n, x in zip(pos.tolist(), words.tolist(), line.tolist()) if x] == [(4, 7)]
    assert [n for n, x in zip(words.tolist(), line.tolist()) if not x] == [8] and len(set(digest.tolist())) == 2
    r = random.Random(4)
    some = [str(r.randrange(10**6)) for _ in range(300)]
    inside = " ".join(some[100:120])
    mine = set(substring_dedup.UnitCutter()(" ".join(some))[2].tolist())
    for at in range(0, 80, 7):  # twenty shared words always share a window
        other = " ".join([f"x{i}" for i in range(at)] + [inside] + [f"y{i}" for i in range(99 - at)])
        assert mine & set(substring_dedup.UnitCutter()(other)[2].tolist())


def test_inline_passage_is_found_and_clean_text_left(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(55))
    texts = [" ".join(word() for _ in range(40)) for _ in range(30)]
    for i in (3, 11, 20):
        w = texts[i].split()
        texts[i] = " ".join(w[:13]) + " " + passage.upper() + "  " + " ".join(w[13:])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = substring_dedup.duplicate_passages(docs).collect()
    assert {(x.doc_id, x.kept_doc_id) for x in rows} == {(11, 3), (20, 3)}
    assert all(x.words >= 30 for x in rows)
    clean = {x.doc_id: x.text for x in substring_dedup.remove_passages(docs).collect()}
    assert all(clean[i] == texts[i] for i in range(30) if i not in (11, 20))
    assert passage.upper() not in clean[11] and passage.upper() in clean[3]


def test_substring_dedup_matches_brute_force(spark, odd_docs, empty_docs, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = substring_dedup.duplicate_passages(docs).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.words) for r in got) == sorted(brute_passages(rows))
    text = dict(rows)
    for r in got[::7]:  # the kept document has the passage's first window or line
        words = text[r.doc_id][r.start : r.stop].lower().split()
        assert " ".join(words[: min(len(words), 8)]) in " ".join(text[r.kept_doc_id].lower().split()) or r.words >= 20
    # without hot digests, and with all texts shuffled, the result is the same
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 1.0)
    monkeypatch.setattr(substring_dedup, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, substring_dedup.duplicate_passages(docs).collect())) == sorted(map(tuple, got))
    odd = substring_dedup.duplicate_passages(odd_docs).collect()
    named = sorted((r.doc_id, r.text) for r in odd_docs.collect() if r.text and r.doc_id)
    assert sorted((r.doc_id, r.start, r.stop, r.words) for r in odd) == sorted(brute_passages(named))
    cut = substring_dedup.remove_passages(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert Counter(r.doc_id for r in cut.collect() if r.text is None) == Counter([1, None])
    assert substring_dedup.remove_passages(empty_docs).count() == 0


def test_every_passage_is_cut_out_to_its_last_word(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    docs, want = [], {}
    for i in range(400):
        passage = [word() for _ in range(r.choice([20, 24, 35, 51, 60]))]
        plain = [[word() for _ in range(30)] for _ in range(2)]
        for k, w in enumerate(plain):
            docs.append((2 * i + k, " ".join(w[:15]) + "  " + (" ".join(passage) if k else "\t".join(passage).upper()) + " " + " ".join(w[15:])))
        want[2 * i + 1] = (len(passage), " ".join(plain[1][:15]) + "  " + " ".join(plain[1][15:]))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {x.doc_id: x.words for x in substring_dedup.duplicate_passages(frame).collect()}
    assert got == {d: n for d, (n, _) in want.items()}
    clean = {x.doc_id: x.text for x in substring_dedup.remove_passages(frame).collect()}
    assert all(clean[d] == t for d, (_, t) in want.items())
    assert all(clean[d] == t for d, t in docs if d % 2 == 0)


def test_lone_repeated_lines_go(spark):
    r = random.Random(13)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    line = " ".join(word() for _ in range(9))
    some = lambda: " ".join(word() for _ in range(12))
    docs = [(i, f"{some()}\n{line}\n{some()} {' '.join(line.split()[:4])}") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = substring_dedup.duplicate_passages(frame).collect()
    assert sorted((x.doc_id, x.words, x.kept_doc_id) for x in got) == [(i, 9, 0) for i in range(1, 200)]
    texts = dict(docs)
    assert all(texts[x.doc_id][x.start : x.stop] == line for x in got)


def test_periodic_text_keeps_its_first_period(spark):
    frame = spark.createDataFrame([(1, "x " * 100), (2, " ".join(f"w{i % 30}" for i in range(120)))], "doc_id bigint, text string")
    got = substring_dedup.duplicate_passages(frame).collect()
    assert sorted((x.doc_id, x.start, x.stop, x.words) for x in got) == sorted(brute_passages([(r.doc_id, r.text) for r in frame.collect()]))
    left = {x.doc_id: len(x.text.split()) for x in substring_dedup.remove_passages(frame).collect()}
    assert left[1] >= 8 and left[2] >= 30


# -- decontamination ---------------------------------------------------------


def brute_align(a, b):
    best = 0
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def test_alignment_matches_table():
    r = random.Random(2)
    for _ in range(200):
        a = np.array([r.randint(0, 4) for _ in range(r.randint(1, 25))], dtype=np.int32)
        b = np.array([r.randint(0, 4) for _ in range(r.randint(1, 12))], dtype=np.int32)
        score, start, end = decontaminate.align(a, b)
        assert score == brute_align(a, b)
        if score:
            assert brute_align(a[start:end], b) == score


def test_edited_copies_are_found(spark, odd_docs, empty_docs):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items = [[word() for _ in range(r.randint(15, 40))] for _ in range(12)]
    docs = []
    for d in range(60):
        w = [word() for _ in range(80)]
        if d % 3 == 0:
            copy = list(items[d % 12])
            if d % 2:  # edited: every ninth word changed, one dropped
                copy = [word() if k % 9 == 4 else x for k, x in enumerate(copy)]
                del copy[len(copy) // 2]
            w[20:20] = [x.upper() for x in copy]
        docs.append((d, " ".join(w)))
    tests = spark.createDataFrame([(i, ", ".join(x)) for i, x in enumerate(items)] + [(50, None), (51, "one two"), (52, "")], "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find_contamination(frame, tests).collect()}
    assert got == {(d, d % 12) for d in range(0, 60, 3)}
    left = {x.doc_id for x in decontaminate.clean_documents(frame, tests).collect()}
    assert left == {d for d in range(60) if d % 3}
    assert decontaminate.clean_documents(odd_docs, tests).count() == odd_docs.count()
    assert decontaminate.clean_documents(empty_docs, tests).count() == 0
    assert decontaminate.clean_documents(odd_docs, tests.limit(0)).count() == odd_docs.count()


def test_densely_edited_copies_are_found(spark, monkeypatch):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items = [[word() for _ in range(r.randint(15, 59))] for _ in range(20)]
    edits = [
        *(lambda x, n=n: [word() if k % n == n - 1 else y for k, y in enumerate(x)] for n in (4, 5, 6)),
        lambda x: [z for k, y in enumerate(x) for z in ([y, word()] if k % 2 else [y])],  # a word more after every second
        lambda x: [word() if r.random() < 0.2 else y for y in x],
    ]
    docs = [(20 * e + i, [word() for _ in range(9)] + edit(x) + [word() for _ in range(9)]) for e, edit in enumerate(edits) for i, x in enumerate(items)]
    want = set()
    for d, w in docs:
        for i, x in enumerate(items):
            names = {y: k for k, y in enumerate(dict.fromkeys(x))}
            score = brute_align([names.get(y, -1) for y in w], [names[y] for y in x])
            want |= {(d, i)} if score >= decontaminate.MIN_SCORE * 2 * len(x) else set()
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string")
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    for most in (decontaminate.BROADCAST_GRAMS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", most)
        assert {(x.doc_id, x.item_id) for x in decontaminate.find_contamination(frame, tests).collect()} == want
    assert {d // 20 for d, _ in want} == set(range(5))


def test_alignment_within_reach_is_the_whole_alignment():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(2, 14)
        item = np.array([r.randint(1, 9) for _ in range(n)], dtype=np.uint64)
        doc = np.array([r.randint(1, 12) for _ in range(r.randint(0, 60))], dtype=np.uint64)
        if r.random() < 0.7:  # an edited copy somewhere
            copy = [x if r.random() < 0.8 else 99 for x in item.tolist()]
            at = r.randint(0, len(doc))
            doc = np.concatenate([doc[:at], np.array(copy, dtype=np.uint64), doc[at:]])
        share = brute_align(doc.tolist(), item.tolist()) / (2 * n)
        got = decontaminate.contamination(doc, item, 0.6)
        assert (got is not None) == (share >= 0.6) and (got is None or math.isclose(got[0], share))


def test_short_long_and_nameless_items(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    long, nameless = [word() for _ in range(200)], [word() for _ in range(12)]
    noise = lambda n: [word() for _ in range(n)]
    docs = [
        (1, ["aa", "z", "bb", "z", "cc"]),  # a three-word item with a word between all
        (2, [*noise(30), *long[40:150], *noise(30)]),  # 110 of 200 words
        (3, [*noise(9), *nameless, *noise(9)]),
        (4, [*noise(9), *long[:24], *noise(9)]),  # a word short of the verbatim length
        (5, [*noise(9), *long[100:125], *noise(9)]),
        (6, ["aa", "x", "x", "x", "x", "cc"]),
        (7, noise(40)),
        (8, ["one"]),
    ]
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string")
    tests = spark.createDataFrame(
        [(0, "aa bb cc"), (1, " ".join(long)), (None, " ".join(nameless)), (3, "one"), (None, None), (4, "")], "item_id bigint, text string"
    )
    got = {(x.doc_id, x.item_id): x.score for x in decontaminate.find_contamination(frame, tests).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, None), (5, 1)}
    assert math.isclose(got[1, 0], 4 / 6) and got[2, 1] == 0.55 and got[3, None] == 1.0
    assert {x.doc_id for x in decontaminate.clean_documents(frame, tests).collect()} == {4, 6, 7, 8}


def test_seeds_are_the_rarest_grams(spark):
    grams = spark.createDataFrame([(1, g, 1, 2) for g in range(5)] + [(2, 9, 3, 1)], "item bigint, gram bigint, places bigint, need bigint")
    counts = spark.createDataFrame([(0, 50), (1, 7), (2, 9), (3, 1), (9, 4)], "gram bigint, count bigint")
    rows = decontaminate._seeds(grams, counts).collect()
    assert {(r.item, r.gram) for r in rows if r.seed} == {(1, 4), (1, 3), (1, 1), (1, 2), (2, 9)}  # n - need + 1 = 4 of 5


# -- SentencePiece -----------------------------------------------------------


def test_pieces_match_the_library(spark, odd_docs, empty_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    vocabulary = sentencepiece_codec.Vocabulary.load(sentencepiece_codec.MODEL)
    r = random.Random(8)
    parts = ["a", "th", "the", " ", "  ", "\n", "▁", "é", "中", "😀", "<s>", "<0x0A>", "...", "00", "\t", "ing", "St", "\x07", "."]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    coded = sentencepiece_codec.encode_documents(docs, vocabulary, check=True)
    for x in coded.collect():
        assert x.ids == sp.encode(texts[x.doc_id]) and x.n_tokens == len(x.ids) and x.round_trip
    for x in sentencepiece_codec.decode_documents(coded, vocabulary).collect():
        assert x.decoded == sp.decode(sp.encode(texts[x.doc_id]))
    odd = sentencepiece_codec.encode_documents(odd_docs, vocabulary, check=True)
    assert dict(odd.dtypes)["ids"] == "array<int>"
    for x in odd.collect():
        assert x.ids == sp.encode(x.text or "") and x.round_trip
    assert sentencepiece_codec.encode_documents(empty_docs, vocabulary).count() == 0


def test_unigram_walk_is_viterbi():
    r = random.Random(6)
    pieces = ["<unk>", *"abc▁", "ab", "bc", "abc", "▁a", "ca", "cab", "▁ab"]
    scores = [0.0] + [-r.random() * 5 for _ in pieces[1:]]
    v = sentencepiece_codec.Vocabulary(pieces, scores, [True] + [False] * (len(pieces) - 1), {}, 0, "unigram")
    codec = sentencepiece_codec.Codec(v)
    unknown = min(scores[1:]) - sentencepiece_codec.UNKNOWN_PENALTY
    for _ in range(300):
        text = "".join(r.choice("abcx ") for _ in range(r.randint(1, 14)))
        marked = codec.marked(text)
        best = [0.0] + [-math.inf] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(end):
                piece = marked[start:end]
                s = scores[pieces.index(piece)] if piece in pieces[1:] else unknown if end - start == 1 else -math.inf
                best[end] = max(best[end], best[start] + s)
        ids, _ = codec.encode([text])
        assert math.isclose(sum(scores[i] if i else unknown for i in ids), best[-1], abs_tol=1e-9)


# -- PPM ---------------------------------------------------------------------


def brute_ppm(docs, held, order):
    words, contexts = Counter(), defaultdict(Counter)
    for d, t in docs:
        if held(d):
            continue
        ws = (t or "").encode().lower().split()
        words.update([*ws, b"\n"])
        s = b"\0" * order + b" ".join(ws) + b"\n"
        for i in range(order, len(s)):
            for j in range(order + 1):
                contexts[s[i - j : i]][s[i]] += 1

    def log10(history, symbol):
        gone, p = set(), 1.0
        for j in range(order, -1, -1):
            c = contexts.get(history[order - j :])
            if not c:
                continue
            left = {k: n for k, n in c.items() if k not in gone}
            total = sum(left.values())
            if symbol in left:
                return math.log10(p * (left[symbol] - 0.5) / total)
            if left:
                p *= 0.5 * len(left) / total
            gone |= set(c)
        return math.log10(p / (256 - len(gone)))

    return words, log10


@pytest.mark.parametrize("chunk", [300, 10_000_000])
def test_ppm_matches_brute_force(spark, odd_docs, chunk):
    small = odd_docs.filter("length(text) < 1000 or text is null").select("doc_id", "text")
    more = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("n_chars", "doc_id").limit(30)
    docs = small.unionByName(more.select((F.col("doc_id") + 50).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    words, log10 = brute_ppm(rows, held, ppm.ORDER)
    n, v = sum(words.values()), len(words)
    want = []
    for d, t in rows:
        ws = [*(t or "").encode().lower().split(), b"\n"]
        s = b"\0" * ppm.ORDER + b" ".join(ws[:-1]) + b"\n"
        score = sum(log10(s[i - ppm.ORDER : i], s[i]) for i in range(ppm.ORDER, len(s)))
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want.append((str(d), held(d), len(ws), sum(words[w] > 0 for w in ws), n, round(base, 5), round(score, 5)))
    got = ppm.score_documents(docs, chunk_bytes=chunk).collect()
    key = lambda r: (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5))
    assert sorted(map(key, got)) == sorted(want)
    assert math.isclose(sum(10 ** log10(b"the ", s) for s in range(256)), 1.0)


def test_ppm_edges(spark, empty_docs, odd_docs):
    assert ppm.score_documents(empty_docs).count() == 0
    none = ppm.score_documents(odd_docs.withColumn("h", F.lit(True)), held_col="h").collect()
    assert len(none) == odd_docs.count() and all(r.train_tokens == 0 and r.n_known == 0 for r in none)
    empty = [r for r in none if r.n_tokens == 1]
    assert all(math.isclose(r.score, -math.log10(256)) for r in empty)


# -- pipeline ----------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    at = docs
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in at.select("doc_id", "text").collect()}
        out = stage(spark, at, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(at.count())
        if k < 4:
            assert at.columns == corpus_pipeline.COLUMNS
            after = {r.doc_id: r.text for r in at.collect()}
            assert set(after) <= set(before)
            if k != 2:
                assert all(before[d] == t for d, t in after.items())
        if k == 1:
            fps = {d: brute_fingerprint(t) for d, t in before.items()}
            ids = sorted(fps)
            group = roots([fps[d] for d in ids], lambda a, b: (a ^ b).bit_count() <= 4)
            assert set(after) == {min(d for d, x in zip(ids, group) if x == g) for g in set(group)}
        if k == 2:
            cut = {d for d, *_ in brute_passages(sorted(before.items()))}
            assert {d for d in after if after[d] != before[d]} == cut
        if k == 3:
            lowered = [" ".join(w.decode() for w in decontaminate.words_of(b)) for b in bench]
            joined = {d: " ".join(w.decode() for w in decontaminate.words_of(t)) for d, t in before.items()}
            leaked = {d for d, t in joined.items() if any(b in t for b in lowered)}
            assert not leaked & set(after)
    last = at.collect()
    assert all(r.round_trip for r in last) and counts[0] < len(texts) and counts[3] == counts[4]
