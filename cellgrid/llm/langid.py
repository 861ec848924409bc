"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader updates under an elastic-net penalty, then calibrated by one temperature
chosen on rows that training has not seen. Document frequencies are counted over all documents that may be learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ftrl import SAMPLE_ROWS, Leader, epochs, in_one_task, labelled_sample

BITS = 15
ORDERS = 3
UNKNOWN = "und"
_WORDY = re.compile(r"[^\W\d_]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str) -> bool:
    """Numerals such as a half or a superscript two are word characters, but no letters."""
    m = _WORDY.search(text)
    return bool(m) and (m[0].isalpha() or any(map(str.isalpha, text)))


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed character n-grams of one to three characters, in lower case."""
    if not text:
        return np.zeros(1 << BITS, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    grams, parts = np.zeros(len(c), np.uint64), []
    with np.errstate(over="ignore"):
        for n in range(1, min(ORDERS, len(c)) + 1):
            grams = (grams[: len(c) - n + 1] << np.uint64(21)) | c[n - 1 :]
            parts.append(((grams + np.uint64(n)) * _ODD) >> np.uint64(64 - BITS))
    return np.bincount(np.concatenate(parts).astype(np.int64), minlength=1 << BITS)


def _row(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = gram_counts(text)
    idx = np.flatnonzero(k)
    v = (1 + np.log(k[idx])) * idf[idx] if len(idx) else np.zeros(0)
    return idx, v / max(np.sqrt(v @ v), 1e-12)


def document_frequencies(docs: DataFrame) -> list:
    """(feature, n) over all rows of docs (text); feature -1 has the number of documents. Bounded by the feature space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for pdf in batches:
            n += len(pdf)
            for text in pdf["text"]:
                df += gram_counts(text) > 0
        yield pd.DataFrame({"feature": np.append(np.arange(1 << BITS), -1), "n": np.append(df, n)}).query("n > 0")

    return docs.select("text").mapInPandas(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit(idf: np.ndarray, passes: int):
    """Weights, biases with the languages of the sample, and the temperature, as rows (feature, output, value, name)."""

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(sample["label"]))
        y = sample["label"].map({x: i for i, x in enumerate(names)}).to_numpy()
        rows = [_row(t, idf) for t in sample["text"]]
        leader = Leader(1 << BITS, len(names), alpha=0.5, l1=0.01, l2=0.01)
        one = np.eye(len(names))
        aside = np.arange(len(rows)) % 10 == 9  # for the temperature
        order = np.flatnonzero(~aside)
        for i in epochs(passes, len(order)):
            j = order[i]
            leader.step(*rows[j], lambda out, j=j: _softmax(out) - one[y[j]])
        w, b = leader.weights(), leader.bias()
        out = np.array([rows[i][1] @ w[rows[i][0]] + b for i in np.flatnonzero(aside)]).reshape(-1, len(names))
        options = np.geomspace(0.05, 20, 121)
        nll = [-np.log(np.maximum(_softmax(out / t)[np.arange(len(out)), y[aside]], 1e-12)).sum() for t in options]
        temperature = options[int(np.argmin(nll))] if len(out) else 1.0
        f, k = np.nonzero(w)
        return pd.DataFrame({"feature": [*f, *[-1] * len(names), -2], "output": [*k, *range(len(names)), 0], "value": [*w[f, k], *b, temperature], "name": [*[None] * len(f), *names, None]})

    return fit


def language_id(docs: DataFrame, rows: int = SAMPLE_ROWS, passes: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs (doc_id, text, lang, ...).

    Held out are ids whose crc32 as text leaves 2 when divided by 4; neither their texts nor their languages are learned
    from. A null id is neither held out nor learned from. A text that is null or has no letter is "und" with score 0, and
    so is every text if nothing can be learned. Repeated rows are predicted alike. An empty table gives an empty table.
    Other columns are not read. Texts are read whole.
    """
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    d = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("label"))
    seen = d.filter(~held & F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("text").isNotNull())
    counts = document_frequencies(seen)
    total = max([r["n"] for r in counts if r["feature"] < 0], default=0)
    idf = np.full(1 << BITS, np.log(1 + total) + 1)
    for r in counts:
        if r["feature"] >= 0:
            idf[r["feature"]] = np.log((1 + total) / (1 + r["n"])) + 1
    idf = idf.astype(np.float32)
    sample = labelled_sample(d.select("id", "text").filter("text is not null"), seen.select("id", "label"), rows)
    model = in_one_task(sample, _fit(idf, passes), "feature long, output int, value double, name string")

    f, k, v = ([r[i] for r in model if r[0] >= 0] for i in range(3))
    learned = sorted((r for r in model if r[0] == -1), key=lambda r: r[1])  # the languages of the sample
    names, b = [r[3] for r in learned], np.array([r[2] for r in learned])
    temperature = next((r[2] for r in model if r[0] == -2), 1.0)
    f, k, v = np.array(f, np.int64), np.array(k, np.int64), np.array(v, np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros((1 << BITS, len(names)), np.float32)
        w[f, k] = v
        for pdf in batches:
            best, score = [], []
            for text in pdf["text"]:
                if not names or not text or not has_letter(text):
                    best.append(UNKNOWN)
                    score.append(0.0)
                    continue
                idx, val = _row(text, idf)
                p = _softmax((val @ w[idx] + b) / temperature)
                best.append(names[int(p.argmax())])
                score.append(float(p.max()))
            yield pd.DataFrame({"id": pdf["id"], "lang_pred": best, "score": score})

    out = d.select("id", "text").mapInPandas(run, f"id {d.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")
