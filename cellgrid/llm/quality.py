"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's tokens are runs of word characters and runs of other marks. N-grams of one to three tokens are taken in two
views: the words in lower case, and their forms (case, digits, length, marks, "as the one before").
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, word_hashes
from .ftrl import SAMPLE_ROWS, Leader, epochs, in_one_task, labelled_sample

BITS = 20
CUT = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")


def _form(token: str) -> bytes:
    if token[0] == "\n" or not (token[0].isalnum() or token[0] == "_"):
        return token[:4].encode("utf-8", "surrogatepass")
    case = "0" if token[0].isdigit() else "U" if len(token) > 1 and token.isupper() else "A" if token[0].isupper() else "a"
    return f"{case}{min(len(token), 20) // 7}".encode()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers below 2**BITS and values; each view and order has length 1."""
    tokens = _TOKEN.findall(text) if text else []
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    forms: dict[str, bytes] = {}
    for t in tokens:
        if t not in forms:
            forms[t] = _form(t)
    surface = word_hashes([t.lower().encode("utf-8", "surrogatepass") for t in tokens])
    form = word_hashes([forms[t] for t in tokens])
    again = np.append(False, surface[1:] == surface[:-1])
    form = form + again.astype(np.uint64)
    parts, values = [], []
    with np.errstate(over="ignore"):
        for salt, h, orders in ((1, surface, (1, 2)), (2, form, (1, 2, 3))):
            gram = np.zeros(len(h), np.uint64)
            for n in range(1, max(orders) + 1):
                if len(h) < n:
                    break
                gram = gram[: len(h) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + h[n - 1 :]
                if n in orders:
                    idx, k = np.unique(mix(gram + np.uint64(salt * 8 + n)) >> np.uint64(64 - BITS), return_counts=True)
                    parts.append(idx.astype(np.int64))
                    values.append(np.sqrt(k / k.sum()))
    idx, where = np.unique(np.concatenate(parts), return_inverse=True)
    return idx, np.bincount(where, np.concatenate(values))


def fit(sample: pd.DataFrame, passes: int = 4) -> pd.DataFrame:
    rows = [features(t) for t in sample["text"]]
    y = sample["label"].to_numpy().astype(float)
    leader = Leader(1 << BITS, alpha=0.5, l1=0.05, l2=0.01)
    for i in epochs(passes, len(rows)):
        leader.step(*rows[i], lambda out, i=i: 1 / (1 + np.exp(-np.clip(out, -40, 40))) - y[i])
    w = leader.weights()[:, 0]
    used = np.flatnonzero(w)
    return pd.DataFrame({"feature": np.append(used, -1), "value": np.append(w[used], leader.bias()[0])})


def score(docs: DataFrame, model: list) -> DataFrame:
    """(id, text) to (id, score)."""
    idx = np.array([r["feature"] for r in model if r["feature"] >= 0], np.int64)
    val = np.array([r["value"] for r in model if r["feature"] >= 0], np.float32)
    bias = next((r["value"] for r in model if r["feature"] < 0), 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros(1 << BITS, np.float32)
        w[idx] = val
        for pdf in batches:
            s = np.fromiter((w[i] @ v for i, v in map(features, pdf["text"])), np.float64, len(pdf))
            yield pd.DataFrame({"id": pdf["id"], "score": 1 / (1 + np.exp(-np.clip(s + bias, -40, 40)))})

    return docs.mapInPandas(run, f"id {docs.schema['id'].dataType.simpleString()}, score double")


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text, ...). labels: (doc_id, quality).

    Held out are ids whose crc32 as text is divisible by 5; they are never learned from. A null id is not held out and
    has no label. Null and empty texts have no features and get the score of the bias alone. Repeated rows are scored
    alike. Without labels all scores are 0.5. Empty tables give empty tables. Other columns are not read.
    """
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    d = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    seen = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).filter(~held)
    model = in_one_task(labelled_sample(d, seen, rows), fit, "feature long, value double")
    out = score(d, model)
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
