"""Tables, scratch space and word hashing shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

SHINGLE = 5
NEAR = 0.75
RELEASE = 5  # tables saved after which a release is due
RELEASE_S = 10  # seconds between two releases, at least


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares. One is set here only where nobody has and all runs on this machine, as in tests."""
    if path := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Tables of one call, written to the shared folder so that a lost executor costs no recomputation.

    join: a hint for the joins that read them. With "merge", loops over tables that get small do not fill the driver with
    broadcast tables, which take a thread and some MB each until they are collected.
    """

    released = -RELEASE_S  # by the clock of the process, by any call

    def __init__(self, spark: SparkSession, join: str | None = None):
        self.spark, self.root, self.join = spark, f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}", join
        self.saved = self.clean = 0  # tables, and those before the last release
        self.release()  # of what earlier calls have left

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path := self.path(name))
        self.saved += 1
        if self.saved - self.clean >= RELEASE:
            self.release()
        saved = self.spark.read.schema(df.schema).parquet(path)
        return saved.hint(self.join) if self.join else saved

    def release(self) -> None:
        """Has Spark delete the shuffle files of ended jobs: it does so when the driver's collector finds their handles. The
        plans of those jobs go as well, so that many small jobs in a row do not fill the driver's heap. One that follows
        another at once is left out: the collector takes full collections in quick succession for a heap that is too small,
        and has it grow."""
        if time.monotonic() - Scratch.released >= RELEASE_S:
            self.spark._jvm.System.gc()
            Scratch.released, self.clean = time.monotonic(), self.saved

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def drop(self, *names: str) -> None:
        """Removes tables that no later job reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8, with A-Z in lower case (bytes.lower and bytes.split know ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: bijective, and each output bit depends on each input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_set(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words are one shingle, none give an empty set."""
    k = len(hashes)
    if not k:
        return hashes
    width = min(n, k)
    with np.errstate(over="ignore"):
        out = np.zeros(k - width + 1, np.uint64)
        for i in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : k - width + 1 + i]
        return np.unique(mix(out + np.uint64(width)))


_P = 0x9E3779B97F4A7C15
_SPACES = np.isin(np.arange(256), [*range(9, 14), 32])
_MARKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


@cache
def powers(bits: int, base: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(1 << bits, base, np.uint64)))


def hashed_words(texts: list[str | None], marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and the number of words of each text.

    Words are those of ``words``; with marks, ASCII marks divide words as well. A word's hash is a polynomial of its bytes
    modulo 2**64, as a difference of running sums divided by the power at which the word starts.
    """
    h, counts, *_ = scanned_words(texts, marks)
    return h, counts


def scanned_words(texts: list[str | None], marks: bool = False) -> tuple[np.ndarray, ...]:
    """hashed_words, with the bytes of all texts, one line end after each, and the positions where words start and stop."""
    raw = np.frombuffer(b"".join((t.encode("utf-8", "surrogatepass") if t else b"") + b"\n" for t in texts), np.uint8)
    data = raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
    gap = (_MARKS if marks else _SPACES)[data]
    edge = np.diff(gap.astype(np.int8), prepend=1)
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bits = max(16, len(data).bit_length())
    with np.errstate(over="ignore"):
        run = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * powers(bits, _P)[: len(data)]))
        h = mix((run[stop] - run[start]) * powers(bits, pow(_P, -1, 1 << 64))[start])
    lengths = [len(t) if t and t.isascii() else len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
    ends = np.cumsum(np.array(lengths, np.int64) + 1)
    return h, np.diff(np.searchsorted(start, ends), prepend=0), raw, start, stop


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """shingle_set of the words of each text."""
    h, counts = hashed_words(texts)
    if len(h) >= n:
        with np.errstate(over="ignore"):
            g = np.zeros(len(h) - n + 1, np.uint64)
            for i in range(n):
                g = g * np.uint64(_P) + h[i : len(h) - n + 1 + i]
            g = mix(g + np.uint64(n))
    out, at = [], 0
    for k in counts:
        out.append(np.unique(g[at : at + k - n + 1]) if k >= n else shingle_set(h[at : at + k], n))
        at += k
    return out


def chunks(texts, most_bytes: int = 1 << 20):
    """Ranges of texts that hold about most_bytes together, or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size > most_bytes:
            yield at, i
            at, size = i, 0
        size += len(t) if t else 0
    if at < len(texts):
        yield at, len(texts)
