"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k | x) = logistic(theta_k - w.x): one weight vector over hashed text
features, shared by all grades, and ordered thresholds. A document gets its expected grade
and the probability of the top grade, which selects it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship

ship(__name__)

DIMENSIONS = 1 << 18
# Labelled rows that the fit reads at most: those with the smallest hash of their id.
MAX_TRAIN_ROWS = 16_000
# Words whose features are kept between documents of a task; beyond it the memory starts anew.
MEMO_WORDS = 500_000


class Featurizer:
    """Hashed features of a text: the presence of each lower-case word and of its
    first four letters, and the share (in tenths) of words of some shapes: all capitals, with several marks of each kind at the
    end, without a letter or digit, any of these, equal to the word before, distinct."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.memo: dict[str, tuple[int, int, str]] = {}

    def bucket(self, feature: str) -> int:
        return xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass")) % self.dimensions

    def of_word(self, word: str) -> tuple[int, int, str]:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            core = word.rstrip("".join(c for c in set(word) if not c.isalnum()))
            tail = word[len(core) :]
            if not core:
                shape = "marks"
            elif len(tail) > 1:
                shape = "tail " + tail[:3]
            elif core.isupper() and len(core) > 1:
                shape = "capitals"
            else:
                shape = ""
            low = core.lower()
            got = self.memo[word] = (self.bucket("w " + low), self.bucket("p " + low[:4]), shape)
        return got

    def __call__(self, text: str | None) -> np.ndarray:
        ws = (text or "").split()
        if not ws:
            return np.array([self.bucket("empty")], dtype=np.int32)
        found, shapes = set(), Counter()
        for word, n in Counter(ws).items():
            whole, start, shape = self.of_word(word)
            found.add(whole)
            found.add(start)
            if shape:
                shapes[shape] += n
                shapes["odd"] += n
        shapes["again"] = sum(a == b for a, b in zip(ws, ws[1:]))
        shapes["distinct"] = len(set(ws))
        for shape, n in shapes.items():
            # A tenth counts from its middle, so one odd word in a long text is no shape.
            found.add(self.bucket(f"s {shape} {(10 * n + len(ws) // 2) // len(ws)}"))
        return np.fromiter(found, dtype=np.int32, count=len(found))


@dataclass
class OrdinalModel:
    weights: np.ndarray  # float32[dimensions]
    thresholds: np.ndarray  # ascending, one fewer than grades

    def score(self, index: np.ndarray) -> float:
        return float(self.weights[index].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k: rows x thresholds."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit_ordinal(index: list[np.ndarray], grades: np.ndarray, levels: int, dimensions: int = DIMENSIONS, l2: float = 2e-3, epochs: int = 120, rate: float = 0.05, min_rows: int = 3) -> OrdinalModel:
    """Maximum likelihood with ridge penalty by Adam over the full sample.

    Thresholds stay ordered: the first is free, each further one adds a positive
    gap. Rows weigh inversely to the size of their grade, so rare grades count.
    A feature of fewer than ``min_rows`` rows has weight zero.
    Without rows, or with one grade, the weights are zero.
    """
    n = len(index)
    theta = np.linspace(-1.0, 1.0, levels - 1)
    if n == 0:
        return OrdinalModel(np.zeros(dimensions, np.float32), theta)
    flat = np.concatenate(index)
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in index])
    common = np.bincount(flat, minlength=dimensions) >= min_rows
    used = np.flatnonzero(common)
    place = np.zeros(dimensions, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    rows, flat = rows[common[flat]], place[flat[common[flat]]]
    # Feature by feature numbers only ever exist for a block of them.
    blocks = [slice(k, k + 1_000_000) for k in range(0, max(1, len(flat)), 1_000_000)]
    sizes = np.bincount(grades, minlength=levels)
    row_weight = np.sqrt(n / np.maximum(sizes, 1) / np.count_nonzero(sizes))[grades]
    row_weight /= row_weight.sum()
    w = np.zeros(len(used))
    a, gaps = theta[0], np.log(np.diff(theta))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros(levels - 1), np.zeros(levels - 1)]
    for step in range(1, epochs + 1):
        theta = a + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        s = sum(np.bincount(rows[k], weights=w[flat[k]], minlength=n) for k in blocks)
        upper = np.concatenate([theta, [np.inf]])[grades]
        lower = np.concatenate([[-np.inf], theta])[grades]
        cu, cl = _logistic(upper - s), _logistic(lower - s)
        p = np.maximum(cu - cl, 1e-12)
        du, dl = cu * (1 - cu), cl * (1 - cl)
        # Gradients of the mean negative log likelihood.
        ds = row_weight * (du - dl) / p
        gw = sum(np.bincount(flat[k], weights=ds[rows[k]], minlength=len(used)) for k in blocks) + l2 * w
        gt = np.zeros(levels)
        np.add.at(gt, grades, -row_weight * du / p)
        low = np.zeros(levels)
        np.add.at(low, np.maximum(grades - 1, 0), np.where(grades > 0, row_weight * dl / p, 0.0))
        gt = (gt + low)[: levels - 1]
        gp = np.concatenate([[gt.sum()], [gt[k:].sum() * np.exp(gaps[k - 1]) for k in range(1, levels - 1)]])
        for k, (grad, m, v) in enumerate(((gw, state[0], state[1]), (gp, state[2], state[3]))):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
            if k == 0:
                w -= move
            else:
                a -= move[0]
                gaps -= move[1:]
    theta = a + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    full = np.zeros(dimensions, np.float32)
    full[used] = w
    return OrdinalModel(full, theta)


def train_classifier(docs: DataFrame, ratings: DataFrame, levels: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", max_rows: int = MAX_TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``max_rows`` rated documents, those with the smallest hash of their id.

    Several ratings of an id count as the lowest; null ids and ratings are left out. The
    sample's ids are few by the bound, so they are broadcast to the documents, and
    only packed feature numbers come to the driver.
    """
    ids = (
        ratings.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
        .dropna()
        .groupBy("id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    sample = (
        docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .join(F.broadcast(ids), "id")
        .select("id", "grade", "text")
    )

    def extract(batches):
        features = Featurizer()
        for batch in batches:
            packed = [features(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("grade"), pa.array(packed, pa.binary())], ["id", "grade", "features"])

    got = sample.mapInArrow(extract, "id bigint, grade int, features binary").orderBy(F.xxhash64("id", "features"), "id", "features").limit(max_rows).collect()
    grades = np.array([min(max(r["grade"], 0), levels - 1) for r in got], dtype=np.int64)
    index = [np.frombuffer(r["features"], dtype=np.int32) for r in got]
    return fit_ordinal(index, grades, levels)


def score_documents(docs: DataFrame, model: OrdinalModel, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with score, expected_grade and tail_probability (of the top grade).

    Every row of ``docs`` stays, whole texts are read, a null text counts as empty. Input
    columns with the names of the three new ones give way to them.
    """
    new = [f"{prefix}score", f"{prefix}expected_grade", f"{prefix}tail_probability"]
    taken = {c.lower() for c in new}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken or f.name == text_col]
    base = docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = T.StructType(kept + [T.StructField(c, T.DoubleType()) for c in new])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches):
        m = OrdinalModel(*shared.value)
        features = Featurizer(len(m.weights))
        for batch in batches:
            scores = np.array([m.score(features(t.as_py())) for t in batch.column("__text")], dtype=np.float64)
            tails = m.tails(scores)
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            cols += [pa.array(scores), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in out.fields])

    return base.mapInArrow(run, out)


def grades_of_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One scale of three from the two marks: 0 toxic, 1 poor, 2 good; null where both are null."""
    toxic, good = F.coalesce(F.col("toxic"), F.lit(0)) > 0, F.coalesce(F.col("quality"), F.lit(1)) > 0
    return labels.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.when(F.col("toxic").isNull() & F.col("quality").isNull(), F.lit(None).cast("int"))
        .when(toxic, F.lit(0))
        .when(~good, F.lit(1))
        .otherwise(F.lit(2))
        .alias("grade"),
    )


LEVELS = 3
KEEP_FROM = 0.4


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with score, expected_grade, tail_probability and kept (tail of KEEP_FROM or more)."""
    model = train_classifier(docs, grades_of_labels(labels), LEVELS)
    scored = score_documents(docs, model)
    return scored.withColumn("kept", F.col("tail_probability") >= F.lit(KEEP_FROM))
