"""Follow-the-regularised-leader updates on sparse rows, and the bounded labelled samples that they learn from."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most labelled rows that a classifier is fitted on. The sample is drawn by a hash of the id, so it is the same at
#: every run and does not depend on how the table is split.
SAMPLE_ROWS = 12_000


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled documents. labels: (id, label), docs: (id, text). Of several texts of
    one id the largest is taken, of several labels too, so that repeated rows stay within the bound."""
    chosen = labels.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    joined = docs.join(F.broadcast(chosen), "id")  # at most ``rows`` ids and labels
    return joined.groupBy("id", "label").agg(F.max("text").alias("text")).select("id", "text", "label")


def in_one_task(sample: DataFrame, fit: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> list:
    """Fits a model on a bounded sample inside one executor task; its rows, bounded by the model's size, come back."""

    def run(batches):
        parts = list(batches)
        yield fit(pd.concat(parts).sort_values("id", kind="stable")) if sum(map(len, parts)) else pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    return sample.repartition(1).mapInPandas(run, schema).collect()


class Leader:
    """FTRL-proximal state for ``outputs`` linear functions of ``size`` features, with an unpenalised bias."""

    def __init__(self, size: int, outputs: int = 1, alpha: float = 0.3, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3):
        self.z, self.n = np.zeros((size, outputs)), np.zeros((size, outputs))
        self.zb, self.nb = np.zeros(outputs), np.zeros(outputs)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def bias(self) -> np.ndarray:
        return -self.zb * self.alpha / (self.beta + np.sqrt(self.nb))

    def step(self, idx: np.ndarray, val: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray]) -> None:
        """gradient: of the loss by the outputs, given the outputs. idx has no repeats."""
        w, b = self.weights(idx), self.bias()
        d = gradient(val @ w + b)
        g = val[:, None] * d
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = n + g * g
        self.zb += d - (np.sqrt(self.nb + d * d) - np.sqrt(self.nb)) / self.alpha * b
        self.nb += d * d


def epochs(count: int, rows: int, seed: int = 7):
    """Row numbers of several passes, each in another order."""
    rng = np.random.default_rng(seed)
    for _ in range(count):
        yield from rng.permutation(rows)
