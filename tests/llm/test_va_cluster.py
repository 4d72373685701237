"""Centroid clustering against comparing every vector with every centroid."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import va_cluster
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, k, rounds, dims):
    """rows: (id, embedding). Sorted (id, cluster, distance, cluster_inertia, inertia) and centroids."""
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cents = [v for _, v in start]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((dist(v, c), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        cents = [
            [sum(col) // len(m) for col in zip(*m)] if (m := [v for (_, v), o in zip(kept, own) if o == n]) else c
            for n, c in enumerate(cents)
        ]
    last = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, n in last:
        per[n] += d
    return Counter((i, n, d, per[n], sum(per.values())) for i, d, n in last), cents


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want, cents = brute([(r.vec_id, r.embedding) for r in rows], 16, 3, 64)
    got = QUERIES["op11_va_clusters"][0](spark, SF).collect()
    assert Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia) for r in got) == want
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest() for r in got)


@pytest.mark.parametrize("bits,keys", [(2, 0), (4, 10**6), (8, 10**6)])
def test_odd_vectors(spark, monkeypatch, bits, keys):
    """Coarse cells fetch nearly all vectors, fine ones none but ties; nulls, ties, repeated rows, outliers, clashing names."""
    monkeypatch.setattr(va_cluster, "BROADCAST_KEYS", keys)
    r = random.Random(bits)
    rows = [(i, [float(np.float32(r.gauss(i % 3, 0.3))) for _ in range(5)]) for i in range(120)]
    rows += [(200, [0.5] * 5)] * 9 + [(None, [0.25] * 5), (None, [1.25] * 5), (201, [-3000.0, 0.0, 0.0, 0.0, 2e4]), (202, [0.1] * 4), (203, [0.1] * 6), (204, [])]
    rows += [(205, None), (206, [1.0, None, 1.0, 1.0, 1.0]), (207, [float("nan"), 1.0, 1.0, 1.0, 1.0]), (208, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("*", F.lit("x").alias("rid"), F.lit("y").alias("cluster"), F.lit(1).alias("vec"))
    got, cents = va_cluster.cluster_vectors(df, k=7, rounds=3, dims=5, bits=bits)
    want, brute_cents = brute(rows, 7, 3, 5)
    assert Counter(map(tuple, got.collect())) == want and cents == brute_cents


def test_few_empty_and_too_large(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25])], "vec_id bigint, embedding array<float>")
    rows, cents = va_cluster.cluster_vectors(one, k=4, dims=2)
    assert [tuple(r) for r in rows.collect()] == [(1, 0, 0, 0, 0)] and cents == [[32, 16]]
    rows, cents = va_cluster.cluster_vectors(one.limit(0), k=4, dims=2)
    assert rows.count() == 0 and cents == []
    far = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        va_cluster.cluster_vectors(far, k=4, dims=2)


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 8), st.lists(st.tuples(*[st.integers(-500, 500)] * 3), min_size=1, max_size=40), st.integers(0, 9))
def test_intervals_hold_the_distance(bits, points, seed):
    v = np.array(points, dtype=np.int64)
    r = random.Random(seed)
    limits = []
    for col in v.T:
        s = sorted(col.tolist())
        a = r.randrange(len(s))
        limits.append((s[0], s[a], s[r.randrange(a, len(s))], s[-1]))
    cells = va_cluster.Cells(limits, bits)
    codes = cells.unpack(cells.pack(v))
    at = np.arange(3)
    assert (cells.lower[at, codes] <= v).all() and (v <= cells.upper[at, codes]).all()
    c = v[:4]
    least, greatest = cells.tables(c)
    exact = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    for k in range(len(c)):
        assert (least[k][at, codes].sum(axis=1) <= exact[:, k]).all() and (exact[:, k] <= greatest[k][at, codes].sum(axis=1)).all()
    open_ = va_cluster.candidates(cells.pack(v), cells, (least, greatest))
    assert open_[np.arange(len(v)), exact.argmin(axis=1)].all()
