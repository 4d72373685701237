"""dense_index (scalable row_number) and first_hole against brute force, with
a hot group holding most rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators.offsets import dense_index, first_hole


def test_dense_index_matches_ranking_with_hot_group(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        g = 0 if rnd.random() < 0.7 else rnd.randint(1, 5)  # group 0 is hot
        rows.append((g, rnd.randint(0, 50), i))  # (group, a, unique b)
    df = spark.createDataFrame(rows, "g int, a int, b int").repartition(7)
    got = {(r.g, r.b): r.idx for r in dense_index(df, ["g"], ["a", "b"], num_partitions=8).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        want.update({(g, r[2]): i for i, r in enumerate(ordered)})
    assert got == want


def test_dense_index_without_groups(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    got = sorted((r.k, r.idx) for r in dense_index(df, [], ["k"], num_partitions=5).collect())
    assert got == [(k, k) for k in range(500)]


def test_first_hole(spark):
    live = spark.createDataFrame(
        [("t", 0, o) for o in [3, 4, 5, 7]] + [("t", 1, o) for o in [0, 1, 2]] + [("t", 2, o) for o in [6, 7]],
        "topic string, partition int, offset long",
    )
    base = spark.createDataFrame([("t", 0, 3), ("t", 1, 0), ("t", 2, 5)], "topic string, partition int, next0 long")
    got = {r.partition: r.hole for r in first_hole(live, base).collect()}
    assert got == {0: 6, 1: 3, 2: 5}
