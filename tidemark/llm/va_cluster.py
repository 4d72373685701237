"""Centroid clustering over a VA-file.

Each vector is held twice: whole, and as an approximation of a few bits per dimension that name the cell
its component lies in. A round reads the approximations alone. For every centroid two tables per dimension, the least
and greatest squared difference to each cell, add up to an interval that holds the vector's distance. Where
one interval lies below all others the vector is assigned; only where intervals overlap is the whole vector fetched
and its exact distances compared. Ties go to the smaller centroid number, and results are those of comparing every vector.

Componentwise sums move with the vectors: a round fetches those that change their centroid, takes them
from the old centroid's sum and adds them to the new one's. All arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.session import materialize

ship(__name__)

BITS = 6
# Share of a dimension's values at either end that the two outer cells hold; the others divide the range between evenly.
TAIL = 0.001
# Greatest component after scaling whose squared distances are sure to fit a long.
MAX_COMPONENT = 1 << 27
# Keys of vectors to fetch are broadcast up to this many (8 bytes each); beyond it both sides are shuffled.
BROADCAST_KEYS = 500_000


class Cells:
    """Cell limits of every dimension, and the packing of a vector's cell numbers into bytes."""

    def __init__(self, limits: list[tuple[int, int, int, int]], bits: int):
        """``limits``: per dimension the least value, the inner range's two ends and the greatest value."""
        self.bits, n = bits, 1 << bits
        inner = n - 2
        self.lower = np.empty((len(limits), n), dtype=np.int64)
        self.upper = np.empty((len(limits), n), dtype=np.int64)
        for d, (least, a, b, greatest) in enumerate(limits):
            # cell 0 ends below a, the last begins above b; cells that hold no integer are empty
            ends = [a - 1, *(a - 1 + (b - a + 1) * k // inner for k in range(1, inner + 1)), greatest]
            self.upper[d] = ends
            self.lower[d] = [least, *(e + 1 for e in ends[:-1])]

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector."""
        n, dims = vectors.shape
        codes = np.empty((n, dims), dtype=np.uint8)
        for d in range(dims):
            codes[:, d] = np.searchsorted(self.upper[d, :-1], vectors[:, d])
        bits = codes[:, :, None] >> np.arange(self.bits, dtype=np.uint8) & 1
        return np.packbits(bits.reshape(n, -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        """Cell numbers of every dimension, one row per vector."""
        dims = len(self.upper)
        bits = np.unpackbits(packed, axis=1, count=dims * self.bits).reshape(len(packed), dims, self.bits)
        return bits @ (1 << np.arange(self.bits))

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference per centroid, dimension and cell."""
        c = centroids[:, :, None]
        below, above = self.lower[None] - c, c - self.upper[None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        greatest = np.maximum(np.abs(below), np.abs(above)) ** 2
        return least, greatest


def candidates(packed: np.ndarray, cells: Cells, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Boolean (vectors, centroids): whose distance interval begins no higher than every interval's end."""
    codes = cells.unpack(packed)
    k, dims, n = tables[0].shape
    at = codes + np.arange(dims) * n
    low = np.stack([tables[0][c].ravel()[at].sum(axis=1) for c in range(k)], axis=1)
    high = np.stack([tables[1][c].ravel()[at].sum(axis=1) for c in range(k)], axis=1)
    return low <= high.min(axis=1, keepdims=True)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def scaled(embedding: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of every component as a double; null unless there are ``dims`` finite components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    values = F.transform(embedding, lambda x: F.floor(x.cast("double") * float(scale)))
    return F.when((F.size(embedding) == dims) & finite, values)


def _cells_of(points: DataFrame, dims: int, bits: int) -> Cells:
    """Cell limits from all vectors: one row of aggregates."""
    aggs = []
    for d in range(dims):
        x = F.col("vec")[d]
        aggs += [F.min(x).alias(f"a{d}"), F.percentile_approx(x, [TAIL, 1 - TAIL], 10_000).alias(f"q{d}"), F.max(x).alias(f"b{d}")]
    row = points.agg(*aggs).first()
    return Cells([(row[f"a{d}"], *row[f"q{d}"], row[f"b{d}"]) for d in range(dims)], bits)


def _approximate(points: DataFrame, cells: Cells, dims: int) -> DataFrame:
    def run(batches):
        for b in batches:
            packed = cells.pack(_vectors(b.column("vec"), dims))
            yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array([r.tobytes() for r in packed], pa.binary())], names=["rid", "cells"])

    return points.select("rid", "vec").mapInArrow(run, "rid bigint, cells binary")


def _by_intervals(state: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """rid, cells, was, cluster (null: intervals overlap), mask of the candidates then."""
    tables, width = cells.tables(centroids), -(-centroids.shape[1] * cells.bits // 8)

    def run(batches):
        for b in batches:
            open_ = candidates(_bytes(b.column("cells"), width), cells, tables)
            many = open_.sum(axis=1) > 1
            cluster = pa.array(open_.argmax(axis=1), pa.int32(), mask=many)
            masks = [m.tobytes() if x else None for m, x in zip(np.packbits(open_, axis=1), many)]
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("cells"), b.column("cluster"), cluster, pa.array(masks, pa.binary())],
                names=["rid", "cells", "was", "cluster", "mask"],
            )

    return state.mapInArrow(run, "rid bigint, cells binary, was int, cluster int, mask binary")


def _by_distance(fetched: DataFrame, centroids: np.ndarray) -> DataFrame:
    """rid, cells, was, cluster, vec: the nearest of the candidates by exact distance."""
    k, dims = centroids.shape

    def run(batches):
        for b in batches:
            vec = _vectors(b.column("vec"), dims)
            open_ = np.unpackbits(_bytes(b.column("mask"), -(-k // 8)), axis=1, count=k).astype(bool)
            best = np.full(len(vec), np.iinfo(np.int64).max)
            cluster = np.zeros(len(vec), dtype=np.int32)
            for c in range(k):
                d = ((vec - centroids[c]) ** 2).sum(axis=1)
                nearer = open_[:, c] & (d < best)
                best[nearer], cluster[nearer] = d[nearer], c
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("cells"), b.column("was"), pa.array(cluster), b.column("vec")],
                names=["rid", "cells", "was", "cluster", "vec"],
            )

    return fetched.select("rid", "cells", "was", "mask", "vec").mapInArrow(run, "rid bigint, cells binary, was int, cluster int, vec array<bigint>")


def _fetch(points: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` rows with their whole vectors. While few are wanted, only theirs leave the scan."""
    vectors = points.select("rid", "vec")
    keys = wanted.select("rid")
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        vectors = vectors.join(F.broadcast(keys), "rid", "left_semi")
    return wanted.join(vectors, "rid")


def _assign(points: DataFrame, state: DataFrame, cells: Cells, centroids: np.ndarray) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New state (rid, cells, cluster); and what moved: rows decided by intervals, and fetched ones with vec."""
    marked = materialize(_by_intervals(state, cells, centroids), "va-marked")
    resolved = materialize(_by_distance(_fetch(points, marked.filter("cluster is null")), centroids), "va-resolved")
    decided = marked.filter("cluster is not null")
    out = decided.select("rid", "cells", "cluster").unionByName(resolved.select("rid", "cells", "cluster"))
    moved = "was is null or was <> cluster"
    return out, decided.filter(moved).select("rid", "was", "cluster"), resolved.filter(moved).select("rid", "was", "cluster", "vec")


def _move_sums(points: DataFrame, decided: DataFrame, resolved: DataFrame, sums: np.ndarray, counts: list[int]) -> None:
    """Take the moved vectors from their old centroids' sums and add them to the new ones'."""
    dims = sums.shape[1]
    moved = _fetch(points, decided).select("was", "cluster", "vec").unionByName(resolved.select("was", "cluster", "vec"))
    sides = moved.select(
        F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("s")))).alias("x"), "vec"
    ).filter("x.c is not null")
    sign = F.col("x.s").cast("bigint")
    per = sides.groupBy(F.col("x.c").alias("c")).agg(F.sum(sign).alias("n"), *(F.sum(sign * F.col("vec")[d]).alias(f"s{d}") for d in range(dims)))
    for r in per.collect():  # at most one row per centroid
        counts[r["c"]] += r["n"]
        sums[r["c"]] += np.array([r[f"s{d}"] for d in range(dims)], dtype=object)


def cluster_vectors(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, bits: int = BITS,
    seed: str = "1", id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia), one row per kept row, and the final centroids.

    Kept are vectors of exactly ``dims`` components, all finite; each becomes floor(scale * x). Centroids start as the k
    kept vectors with the smallest SHA-256 of ``seed:id`` (null id: nothing behind the colon; equal ids: by
    components). Rounds replace non-empty centroids by the floor of the mean. Distances are squared.

    Repeated rows and null ids count as rows of their own; other columns, whatever their names, are not read. With fewer than k
    vectors there are as many centroids; an empty table gives no rows. A component whose scaled value is beyond
    2^27 raises an error, as its distances need not fit a long.
    """
    spark: SparkSession = vectors.sparkSession
    ids, embedding = F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`")
    too_far = F.raise_error(F.lit("a component is too large for exact distances")).cast("array<bigint>")
    points = materialize(
        vectors.select(ids, scaled(embedding, dims, scale).alias("vec"))
        .filter("vec is not null")
        .select("vec_id", F.when(F.exists("vec", lambda x: F.abs(x) > MAX_COMPONENT), too_far).otherwise(F.col("vec")).alias("vec"))
        .withColumn("rid", F.monotonically_increasing_id()),
        "va-vectors",
    )
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = points.select("vec", h.alias("h")).orderBy("h", "vec").limit(k).collect()
    out_schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint"
    if not first:
        return spark.createDataFrame([], out_schema), []
    centroids = np.array([r.vec for r in first], dtype=np.int64)
    cells = _cells_of(points, dims, bits)
    approximations = materialize(_approximate(points, cells, dims), "va-cells")
    state = approximations.withColumn("cluster", F.lit(None).cast("int"))
    sums = np.zeros(centroids.shape, dtype=object)
    counts = [0] * len(centroids)
    for _ in range(rounds):
        state, decided, resolved = _assign(points, state, cells, centroids)
        _move_sums(points, decided, resolved, sums, counts)
        centroids = np.array([s // n if n else c for s, n, c in zip(sums, counts, centroids)], dtype=np.int64)
    state, _, _ = _assign(points, state, cells, centroids)
    # Every vector is asked for its distance now, so each is read once more.
    final = [[int(x) for x in c] for c in centroids]
    own = F.array(*(F.array(*(F.lit(x).cast("bigint") for x in c)) for c in final))[F.col("cluster")]
    squares = F.zip_with("vec", own, lambda a, b: (a - b) * (a - b))
    placed = materialize(
        points.join(state.select("rid", "cluster"), "rid").select(
            "vec_id", "cluster", F.aggregate(squares, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("distance")
        ),
        "va-placed",
    )
    per = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # at most k rows
    by_cluster = F.create_map(*(F.lit(x) for c, s in per.items() for x in (c, s)))
    return (
        placed.select("vec_id", "cluster", "distance", by_cluster[F.col("cluster")].cast("bigint").alias("cluster_inertia"), F.lit(sum(per.values())).cast("bigint").alias("inertia")),
        final,
    )
