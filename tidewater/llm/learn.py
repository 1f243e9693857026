"""What the trained operators share: a bounded labelled sample and linear fitting.

Models are small and are fitted on at most ``max_rows`` labelled rows, those whose
ids hash lowest, so the sample does not depend on the layout of the tables.  The
features of the sample are made in tasks; the driver receives at most ``max_rows``
feature rows and fits with numpy.  Scoring then reads every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate

MAX_ROWS = 4000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn, max_rows: int, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of at most ``max_rows`` documents that have a label, with ``label``.

    ``learn`` is a condition on doc_id.  The chosen ids are at most ``max_rows``, so
    they are broadcast.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).select("doc_id", label).orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(max_rows).dropDuplicates(["doc_id"])
    own = docs.select("doc_id", *[F.col(c).alias(c) for c in carry if c != label])
    return own.join(F.broadcast(chosen), "doc_id").select(label, *[c for c in carry if c != label])


def sample_features(sample: DataFrame, label: str, fields: list[tuple[str, T.DataType]], start, text: str, max_rows: int, also: tuple[str, ...] = ()):
    """Label and features of the sample as an Arrow table on the driver, at most ``max_rows`` rows."""
    return annotate(sample, fields, start, text, [label, *also]).select(label, *[n for n, _ in fields]).limit(max_rows).toArrow()


def sparse_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every entry of a list column of numbers."""
    if not len(column):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    flat = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(flat), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(flat), dtype=np.int32), size), flat.flatten().to_numpy(zero_copy_only=False)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Steps of one parameter array."""

    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        return -self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def fit_logistic(row: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, dim: int, start: np.ndarray, l2: float, rounds: int, rate: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model over sparse rows, by full-batch steps.

    With one class only, or without rows, the weights are zero and the bias is the
    smoothed log odds.
    """
    n, good = len(y), float(y.sum())
    bias = float(np.log((good + 0.5) / (n - good + 0.5)))
    if good in (0.0, float(n)):
        return np.zeros(dim), bias
    weight, move_w, move_b = start.astype(float).copy(), Adam(dim, rate), Adam(1, rate)
    for _ in range(rounds):
        gap = sigmoid(np.bincount(row, weight[index] * value, n) + bias) - y
        grad = np.bincount(index, gap[row] * value, dim) / n + l2 * weight
        weight += move_w.step(grad)
        bias += float(move_b.step(np.array([gap.mean()]))[0])
    return weight, bias
