"""Toxicity by cumulative-link ordinal regression on sparse word features.

Features are words and their prefixes, each by count and by density, screened by their excess in toxic documents. Labels
say only whether a document is toxic. Severity grades are made from them: features that are mostly seen in toxic
documents form a lexicon, and toxic documents are graded 1, 2, 3 by the thirds of their lexicon occurrences;
documents that are not toxic have grade 0. One weight vector is shared by the ordered thresholds between grades.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ftrl import epochs, in_one_task, labelled_sample

GRADES = 4
ROWS = 8000  # labelled rows that the model is fitted on at most
MIN_DOCS = 8  # labelled documents that must hold a feature; one for each 25 toxic rows if those are fewer, and two at least
FOLDS = 2  # parts of the sample, each scored by a model of the others to choose the threshold
MODEL = "kind string, feature long, value double"
_WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
SCREEN = 4.0  # a feature's excess in toxic documents, in standard deviations


def _counts(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


@lru_cache(maxsize=1 << 15)
def _keys(word: str) -> tuple[int, ...]:
    """Features of a word: itself and its prefixes, which inflected and compound forms share."""
    forms = [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)]
    return tuple(xxhash.xxh3_64_intdigest(f.encode("utf-8", "surrogatepass")) - (1 << 63) for f in forms)


def _row(counts: Counter, known: dict[str, tuple[int, ...]], at: dict[int, int]) -> dict[int, float]:
    """Values of the features in ``at``: how often (even number) and how densely (odd number) each occurs."""
    found: dict[int, int] = {}
    for word, k in counts.items():
        if (slots := known.get(word)) is None:
            if len(known) > 1 << 17:
                known.clear()
            slots = known[word] = tuple(at[x] for x in _keys(word) if x in at)
        for i in slots:
            found[i] = found.get(i, 0) + k
    n = sum(counts.values()) if found else 0
    out = {}
    for i, k in found.items():
        out[2 * i], out[2 * i + 1] = math.log1p(k), math.log1p(200 * k / n)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _grade_probabilities(s: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    above = np.column_stack([np.ones(len(s)), _sigmoid(s[:, None] - cuts), np.zeros(len(s))])
    return above[:, :-1] - above[:, 1:]


def _learn(rows: list, grade: np.ndarray, size: int, l1: float, l2: float, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts from rows (feature numbers, values) and their grades, by AdaGrad steps with soft thresholds."""
    w, acc = np.zeros(size), np.full(size, 1e-8)
    # cut[0] and the logarithms of the gaps between cuts are free, so the cuts keep their order
    gap, gap_acc = np.array([2.0, 0.0, 0.0]), np.full(GRADES - 1, 1e-8)
    for i in epochs(passes, len(rows)):
        idx, val = rows[i]
        cuts = np.cumsum(np.append(gap[0], np.exp(gap[1:])))
        s, y = float(w[idx] @ val), grade[i]
        low, high = (_sigmoid(s - cuts[y - 1]) if y else 1.0), (_sigmoid(s - cuts[y]) if y < GRADES - 1 else 0.0)
        p, dl, dh = max(low - high, 1e-9), low * (1 - low), high * (1 - high)
        ds = -(dl - dh) / p
        dcut = np.zeros(GRADES - 1)
        if y:
            dcut[y - 1] += dl / p
        if y < GRADES - 1:
            dcut[y] -= dh / p
        dgap = np.cumsum(dcut[::-1])[::-1] * np.append(1.0, np.exp(gap[1:]))
        gap_acc += dgap * dgap
        gap = np.clip(gap - 0.1 * dgap / np.sqrt(gap_acc), -8, 8)
        g = ds * val + l2 * w[idx]
        acc[idx] += g * g
        rate = 0.2 / np.sqrt(acc[idx])
        x = w[idx] - rate * g
        w[idx] = np.sign(x) * np.maximum(np.abs(x) - rate * l1, 0)
    return w, np.cumsum(np.append(gap[0], np.exp(gap[1:])))


def _severity(rows: list, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return _grade_probabilities(np.array([float(w[i] @ v) for i, v in rows]), cuts) @ np.arange(GRADES)


def fit(sample: pd.DataFrame, l1: float = 0.001, l2: float = 1e-4, passes: int = 12) -> pd.DataFrame:
    """Weights, cuts and the decision threshold from (text, label) rows."""
    toxic = sample["label"].to_numpy() == 1
    keys = [np.unique(np.array([x for word in _counts(t) for x in _keys(word)], np.int64)) for t in sample["text"]]
    seen, k = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_counts=True)
    often = k >= min(MIN_DOCS, max(2, toxic.sum() // 25))
    seen, k = seen[often], k[often]
    in_toxic = np.zeros(len(seen), np.int64)
    for own in (x for x, y in zip(keys, toxic, strict=True) if y):
        place = np.searchsorted(seen, own)
        place = place[(place < len(seen)) & (seen[np.minimum(place, len(seen) - 1)] == own)]
        in_toxic[place] += 1
    del keys
    rate = toxic.mean() if len(toxic) else 0.0
    above = (in_toxic - k * rate) / np.sqrt(k * rate * (1 - rate) + 1e-9) > SCREEN
    chosen = seen[above]
    at = {int(x): i for i, x in enumerate(chosen)}
    lexicon = set(np.flatnonzero(in_toxic[above] > 0.5 * k[above]).tolist())
    known: dict[str, tuple[int, ...]] = {}
    values = [_row(_counts(t), known, at) for t in sample["text"]]  # texts are counted again rather than kept as counts
    hits = np.array([sum(math.expm1(v) for i, v in x.items() if i % 2 == 0 and i // 2 in lexicon) for x in values])
    thirds = np.quantile(hits[toxic], [1 / 3, 2 / 3]) if toxic.any() else np.zeros(2)
    grade = np.where(toxic, 1 + (hits[:, None] > thirds).sum(axis=1), 0) if len(hits) else np.zeros(0, np.int64)

    rows, size = [(np.array(list(x), np.int64), np.array(list(x.values()))) for x in values], 2 * len(chosen)
    w, cuts = _learn(rows, grade, size, l1, l2, passes)
    severity, fold = np.zeros(len(rows)), np.arange(len(rows)) % FOLDS
    for f in range(FOLDS):
        others, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        if len(own):
            severity[own] = _severity([rows[i] for i in own], *_learn([rows[i] for i in others], grade[others], size, l1, l2, passes))
    options = np.unique(np.append(np.quantile(severity, np.linspace(0, 1, 401)), 0.5)) if len(severity) else np.array([0.5])
    f1 = [2 * (toxic & (severity >= t)).sum() / max(1, toxic.sum() + (severity >= t).sum()) for t in options]
    best = np.flatnonzero(np.array(f1) >= max(f1) - 0.003)
    threshold = float(np.clip(options[best].mean(), 0.15, 1.5))
    used = np.flatnonzero(w)
    return pd.DataFrame({
        "kind": [("often", "dense")[i % 2] for i in used] + ["cut"] * len(cuts) + ["threshold"],
        "feature": [*(int(chosen[i // 2]) for i in used), *range(len(cuts)), 0],
        "value": [*w[used], *cuts, threshold],
    })


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> list:
    """docs: (id, text); labels: (id, label 0 or 1)."""
    return in_one_task(labelled_sample(docs, labels, rows), fit, MODEL)


def score(docs: DataFrame, model: list) -> DataFrame:
    """(id, text) to (id, text_digest, severity, grade, toxic)."""
    chosen = sorted({r["feature"] for r in model if r["kind"] in ("often", "dense")})
    at = {x: i for i, x in enumerate(chosen)}
    weight = {2 * at[r["feature"]] + (r["kind"] == "dense"): r["value"] for r in model if r["kind"] in ("often", "dense")}
    cuts = np.array([r["value"] for r in sorted((r for r in model if r["kind"] == "cut"), key=lambda r: r["feature"])] or [1.0, 2.0, 3.0])
    threshold = next((r["value"] for r in model if r["kind"] == "threshold"), math.inf)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for pdf in batches:
            s = np.array([sum(weight.get(i, 0.0) * v for i, v in _row(_counts(t), known, at).items()) for t in pdf["text"]], np.float64)
            p = _grade_probabilities(s, cuts)
            severity = p @ np.arange(GRADES)
            yield pd.DataFrame({"id": pdf["id"], "text_digest": pdf["text_digest"], "severity": severity, "grade": p.argmax(axis=1), "toxic": severity >= threshold})

    t = docs.schema["id"].dataType.simpleString()
    return docs.withColumn("text_digest", F.xxhash64("text")).mapInPandas(run, f"id {t}, text_digest long, severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_digest, severity, grade, toxic) for each row of docs (doc_id, text, ...): expected severity (0 to 3),
    likeliest grade and decision; text_digest (xxhash64) tells texts of one id apart.

    labels: (doc_id, toxic). Null and empty texts have no features and get the severity of the cuts alone. Null ids are
    scored, but never learned from. Repeated rows are scored alike. Without labelled rows the severity is that of fixed
    cuts and nothing is toxic. An empty table gives an empty table. Other columns are not read. Texts are read whole.
    """
    d = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    model = train(d, labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")), rows)
    return score(d, model).withColumnRenamed("id", "doc_id")
