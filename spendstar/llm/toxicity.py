"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the byte n-grams (3, 5 and 7) of the text with A-Z lower-cased and
white space as spaces, hashed to ``1 << BITS`` buckets and taken as present or absent. A feature's value is
its naive Bayes log-count ratio (smoothed; 0 if the classes' shares do not
differ beyond chance, by a chi-squared of at least ``min_chi2``), and a
logistic regression is fitted on these values by Adagrad. Ratio and weight are
multiplied into one table of ``1 << BITS`` floats, which is all that a task
needs to score texts of any length.

Training takes a bounded sample of labelled rows: at most ``max_per_class``
texts of each class, of at most ``max_bytes`` bytes, chosen by hash; the
intercept is corrected for the classes' true shares. Scoring covers whole
texts and every row.

Defined cases: a null or empty text has no features and gets the score of the
intercept; without labels of both classes the score is the share of label 1
(0 without labels) for every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import IS_SPACE, LOWER, runs, text_array
from .common import lean, ship

BITS = 20
ORDERS = (3, 5, 7)
_FOLD = np.where(IS_SPACE, 32, LOWER).astype(np.uint32)
MAX_PER_CLASS = 1500
MAX_BYTES = 1 << 16
SEED = 5


@dataclass
class Model:
    weights: np.ndarray  # float32, 1 << BITS
    intercept: float


def ngram_buckets(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, bucket of the n-gram at each position); the last order - 1 positions have none."""
    low = _FOLD[data]
    h = low * np.uint32(0x01000193) + np.uint32(1)
    for n in range(2, max(ORDERS) + 1):
        if len(low) < n:
            return
        h = h[:-1] * np.uint32(0x9E3779B1) + low[n - 1:] + np.uint32(n)
        if n in ORDERS:
            m = h ^ (h >> np.uint32(15))
            m *= np.uint32(0x85EBCA77)
            yield n, m >> np.uint32(32 - BITS)


def present(data: np.ndarray, off: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) pairs present, each once; only buckets with ``keep``."""
    found = []
    data = np.insert(data, off[:-1], 32)  # every text starts with a space, as every word does
    off = off + np.arange(len(off))
    for n, bucket in ngram_buckets(data):
        at = np.arange(len(bucket)) if keep is None else np.flatnonzero(keep[bucket])
        doc = np.searchsorted(off, at, "right") - 1
        same = at + n <= off[doc + 1]  # within one document
        found.append((doc[same] << BITS) | bucket[at[same]].astype(np.int64))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(texts: list[bytes], label: np.ndarray, share: float, min_chi2: float = 25.0,
        epochs: int = 12, rate: float = 0.3, penalty: float = 1e-3) -> Model:
    """Fit on whole texts; ``share``: of label 1 among all labelled rows."""
    def features(keep=None):
        """(document, bucket) of the sample, a few texts at a time: counted first, kept only where used."""
        for a in range(0, len(texts), 50):
            part = texts[a:a + 50]
            d, b = present(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0, *map(len, part)]), keep)
            yield d + a, b

    p, q = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for doc, bucket in features():
        one = label[doc] == 1
        p += np.bincount(bucket[one], minlength=1 << BITS)
        q += np.bincount(bucket[~one], minlength=1 << BITS)
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    ratio = np.log((p + 1) / (n1 + 2)) - np.log((q + 1) / (n0 + 2))
    seen = p + q
    chi2 = (p * n0 - q * n1) ** 2 * (n1 + n0) / np.maximum(n1 * n0 * seen * (n1 + n0 - seen), 1)
    ratio[chi2 < min_chi2] = 0  # a difference that chance makes among a million features
    kept = list(features(ratio != 0))
    doc, bucket = (np.concatenate([x[k] for x in kept]) for k in (0, 1))
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    w, b = np.zeros(1 << BITS), 0.0
    g2, gb2 = np.full(1 << BITS, 1e-8), 1e-8
    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), 50):
            batch = np.sort(order[i:i + 50])
            at = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in batch])
            row = np.repeat(np.arange(len(batch)), starts[batch + 1] - starts[batch])
            f = bucket[at]
            x = ratio[f]
            z = np.bincount(row, x * w[f], minlength=len(batch)) + b
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[batch]
            ids, inv = np.unique(f, return_inverse=True)
            g = np.bincount(inv, err[row] * x) / len(batch) + penalty * w[ids]
            g2[ids] += g * g
            w[ids] -= rate * g / np.sqrt(g2[ids])
            gb = err.mean()
            gb2 += gb * gb
            b -= rate * gb / np.sqrt(gb2)
    share = min(max(share, 1e-6), 1 - 1e-6)
    b += np.log(share / (1 - share)) - np.log(n1 / n0)
    return Model((ratio * w).astype(np.float32), float(b))


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, max_bytes: int = MAX_BYTES,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Model from the labelled rows given (the caller leaves held-out rows out)."""
    lab = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")) \
                .filter("__id is not null and __y in (0, 1)")
    counts = {r["__y"]: r["n"] for r in lab.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    flat = Model(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    if len(counts) < 2:
        return flat
    # a bounded number of rows: the sample's size is a parameter
    parts = [lab.filter(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(max_per_class) for y in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
                .filter(F.octet_length("__t") <= max_bytes).join(sample, "__id")
                .limit(4 * max_per_class).collect())
    rows = sorted(rows, key=lambda r: (r["__id"], r["__t"]))
    y = np.array([r["__y"] for r in rows])
    if not len(y) or y.min() == y.max():
        return flat
    return fit([r["__t"].encode() for r in rows], y, share)


def score_texts(column, model: Model, keep: np.ndarray) -> np.ndarray:
    data, off = text_array(column)
    out = np.full(len(off) - 1, model.intercept)
    for a, b in runs(off):
        doc, bucket = present(data[off[a]:off[b]], off[a:b + 1] - off[a], keep)
        out[a:b] += np.bincount(doc, model.weights[bucket].astype(np.float64), minlength=b - a)
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` (without an older ``out_col``) plus the score, a double from 0 to 1."""
    cols = [c for c in docs.columns if c != out_col]
    schema = docs.select(*cols).schema.add(out_col, "double")
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = cols.index(text_col)

    def run(batches):
        m = held.value
        keep = m.weights != 0
        for batch in batches:
            s = score_texts(batch.column(place), m, keep)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*cols, out_col])

    return docs.select(*cols).mapInArrow(lean(run), schema)


def fold(id_col, n: int):
    """crc32 of the id as text, mod n; a null id counts as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")), F.lit(n))
