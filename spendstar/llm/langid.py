"""Language ID: a small bidirectional gated recurrent network over bytes, in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes; in each, one
gated unit reads forwards and one backwards, every position gets a label
distribution from both states, and a document's probabilities are the mean
over all its positions. The gates are hard (clipped linear) functions, so that
a step is one small matrix product and a few clips over thousands of windows
side by side. Training is backpropagation through time with Adam over windows
of a bounded, documented sample of labelled rows, in which every language has
a part.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
the same holds for every row if no labelled row is given. Output columns
replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .buffers import text_array
from .common import ship

HIDDEN = 8
WINDOW = 256
LANES = 2048
MAX_PER_LANG = 300
MAX_TEXTS = 20_000
SEED = 11


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray   # (2, 3H, 256): input part of each gate, by direction and byte
    cycle: np.ndarray   # (2, 3H, H)
    out: np.ndarray     # (C, 2H)
    bias: np.ndarray    # (C,)


def _start(langs: list[str], hidden: int, rng) -> Model:
    table = rng.normal(0, 0.3, (2, 3 * hidden, 256))
    table[:, :2 * hidden] += 0.5  # gates half open
    return Model(langs, table.astype(np.float32), rng.normal(0, 0.3, (2, 3 * hidden, hidden)).astype(np.float32),
                 rng.normal(0, 0.3, (len(langs), 2 * hidden)).astype(np.float32), np.zeros(len(langs), np.float32))


def _step(table, cycle, x, h):
    """One step for all lanes: the gates u (update) and r (reset), the candidate c and the new state."""
    n = h.shape[0]
    rec = cycle @ h
    inp = np.take(table, x, axis=1)
    gate = np.clip(inp[:2 * n] + rec[:2 * n], 0, 1)
    u, r = gate[:n], gate[n:]
    c = np.clip(inp[2 * n:] + r * rec[2 * n:], -1, 1)
    return u, r, c, rec[2 * n:], h + u * (c - h)


def _softmax(z):
    z = z - z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def gradients(m: Model, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
    """Loss and gradients for windows x (T, N) with labels y (N,): BPTT in both directions."""
    steps, lanes = x.shape
    hid = m.cycle.shape[2]
    states, kept = [], []
    for d in (0, 1):
        h, hs, ks = np.zeros((hid, lanes), np.float32), [None] * steps, [None] * steps
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            before = h
            u, r, c, rec, h = _step(m.table[d], m.cycle[d], x[t], h)
            h = h * mask[t]
            hs[t], ks[t] = h, (before, u, r, c, rec)
        states.append(np.stack(hs))
        kept.append(ks)
    both = np.concatenate(states, axis=1)                        # (T, 2H, N)
    z = np.einsum("ch,thn->ctn", m.out, both) + m.bias[:, None, None]
    p = _softmax(z)
    weight = mask / mask.sum()
    one = (np.arange(len(m.langs))[:, None] == y).astype(np.float32)
    loss = float(-(np.log(np.maximum(p, 1e-9)) * one[:, None, :]).sum(axis=0).ravel() @ weight.ravel())
    dz = (p - one[:, None, :]) * weight
    g_out = np.einsum("ctn,thn->ch", dz, both)
    g_bias = dz.sum(axis=(1, 2))
    d_both = np.einsum("ch,ctn->thn", m.out, dz)
    g_table, g_cycle = np.zeros_like(m.table), np.zeros_like(m.cycle)
    for d in (0, 1):
        carry = np.zeros((hid, lanes), np.float32)
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            before, u, r, c, rec = kept[d][t]
            dh = (carry + d_both[t, d * hid:(d + 1) * hid]) * mask[t]
            da = np.empty((3 * hid, lanes), np.float32)          # at the inputs of u, r and c
            du, dc = dh * (c - before), dh * u
            dc = dc * ((c > -1) & (c < 1))
            dr = dc * rec
            da[:hid] = du * ((u > 0) & (u < 1))
            da[hid:2 * hid] = dr * ((r > 0) & (r < 1))
            da[2 * hid:] = dc
            drec = da.copy()
            drec[2 * hid:] = dc * r
            g_cycle[d] += drec @ before.T
            hot = np.zeros((256, lanes), np.float32)
            hot[x[t], np.arange(lanes)] = 1
            g_table[d] += da @ hot.T
            carry = dh * (1 - u) + m.cycle[d].T @ drec
    return loss, [g_table, g_cycle, g_out, g_bias]


def fit(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = 64, lanes: int = 96,
        rounds: int = 250, rate: float = 0.02) -> Model:
    """Fit on random windows of the texts, the languages in equal shares."""
    langs = sorted(set(labels))
    lanes = max(lanes, 8 * len(langs))
    rng = np.random.default_rng(SEED)
    m = _start(langs, hidden, rng)
    by = [[t for t, v in zip(texts, labels, strict=True) if v == lang] for lang in langs]
    params = [m.table, m.cycle, m.out, m.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, rounds + 1):
        y = rng.integers(0, len(langs), lanes)
        x, mask = np.zeros((steps, lanes), np.uint8), np.zeros((steps, lanes), np.float32)
        for j, lang in enumerate(y):
            t = by[lang][rng.integers(len(by[lang]))]
            a = rng.integers(0, max(1, len(t) - steps + 1))
            piece = np.frombuffer(t[a:a + steps], np.uint8)
            x[:len(piece), j], mask[:len(piece), j] = piece, 1
        if not mask.any():
            continue
        _, grads = gradients(m, x, mask, y)
        now = rate * min(1, 3 * (1 - k / (rounds + 1)))
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            np.clip(g, -1, 1, out=g)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (now / (1 - 0.9**k)) * a / (np.sqrt(b / (1 - 0.99**k)) + 1e-8)
    return m


def position_sums(m: Model, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sum of the label distributions over the positions of each window: x (T, N) bytes, N lengths -> (C, N)."""
    steps, lanes = x.shape
    hid, classes = m.cycle.shape[2], len(m.langs)
    seen = np.empty((steps, classes, lanes), np.float32)
    inp, rec = np.empty((3 * hid, lanes), np.float32), np.empty((3 * hid, lanes), np.float32)
    total = np.zeros((classes, lanes), np.float32)
    for d in (0, 1):
        table, cycle, out = m.table[d], m.cycle[d], np.ascontiguousarray(m.out[:, d * hid:(d + 1) * hid])
        h = np.zeros((hid, lanes), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            # the products of _step in place; _step is the readable form
            np.matmul(cycle, h, out=rec)
            np.take(table, x[t], axis=1, out=inp, mode="clip")
            gate, c = inp[:2 * hid], inp[2 * hid:]
            gate += rec[:2 * hid]
            np.clip(gate, 0, 1, out=gate)
            c += np.multiply(gate[hid:], rec[2 * hid:], out=rec[2 * hid:])
            np.clip(c, -1, 1, out=c)
            c -= h
            c *= gate[:hid]
            h += c
            short = length <= t
            if d == 1 and short.any():
                h[:, short] = 0  # the backward state starts at the window's last byte
            if d == 0:
                np.matmul(out, h, out=seen[t])
            else:
                z = seen[t]
                z += out @ h
                z += m.bias[:, None]
                z -= z.max(axis=0)
                np.exp(z, out=z)
                z /= z.sum(axis=0)
                if short.any():
                    z[:, short] = 0
                total += z
    return total


def probabilities(m: Model, column) -> np.ndarray:
    """(documents, classes): mean distribution over all bytes of each text."""
    data, off = text_array(column)
    size = np.diff(off)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = off[doc] + nth * WINDOW
    length = np.minimum(WINDOW, off[doc + 1] - start)
    out = np.zeros((len(size), len(m.langs)))
    order = np.argsort(-length, kind="stable")  # full windows together, short ones with short ones
    for a in range(0, len(order), LANES):
        lot = order[a:a + LANES]
        steps = int(length[lot].max())
        at = start[lot][None, :] + np.arange(steps)[:, None]
        x = data[np.minimum(at, len(data) - 1)]
        part = position_sums(m, x, length[lot])
        np.add.at(out, doc[lot], part.T)
    return out / np.maximum(size, 1)[:, None]


def train(docs: DataFrame, max_per_lang: int = MAX_PER_LANG, max_texts: int = MAX_TEXTS, max_bytes: int = 4096,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from labelled rows (the caller leaves held-out rows out): every
    language found is learned, from at most ``max_per_lang`` of its texts, fewer
    where all languages together would have more than ``max_texts`` (but one at
    least). Of a text training sees ``max_bytes`` characters from a place given
    by its hash."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"), F.xxhash64(text_col).alias("__h"),
                       F.col(lang_col).cast("string").alias("__l")).filter(
        F.col("__id").isNotNull() & F.col("__l").isNotNull() & F.col("__t").rlike(r"\p{L}"))
    n_langs = rows.select("__l").distinct().count()
    each = max(1, min(max_per_lang, max_texts // max(n_langs, 1)))
    # the sample is chosen by hashes, so that no text meets in the ranking, and each task keeps its first ones only
    first = Window.partitionBy("__l").orderBy(F.xxhash64("__id", "__h"), "__id", "__h")
    keys = rows.select("__l", "__id", "__h").distinct() \
               .withColumn("__r", F.row_number().over(first)).filter(F.col("__r") <= each).drop("__r")
    place = F.pmod("__h", F.greatest(F.char_length("__t") - max_bytes, F.lit(0)) + 1).cast("int") + 1
    picked = rows.join(F.broadcast(keys), ["__l", "__id", "__h"]).select(
        "__l", "__id", "__h", F.substring("__t", place, F.lit(max_bytes)).alias("__t")).distinct().collect()
    picked = sorted(picked, key=lambda r: (r["__l"], r["__id"], r["__t"]))
    return fit([r["__t"].encode() for r in picked], [r["__l"] for r in picked]) if picked else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score (the pooled probability of lang_pred)."""
    made = ("lang_pred", "score")
    cols = [c for c in docs.columns if c not in made]
    if model is None:
        return docs.select(*cols, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = docs.select(*cols).schema.add("lang_pred", "string").add("score", "double")
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = cols.index(text_col)

    def run(batches):
        m = held.value
        names = np.array([*m.langs, "und"])
        for batch in batches:
            if not batch.num_rows:
                continue
            letter = np.array(batch.column(batch.num_columns - 1).fill_null(False))
            p = probabilities(m, batch.column(place))
            best = p.argmax(axis=1)
            top = np.where(letter, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[np.where(letter, best, len(m.langs))].tolist(), pa.string()),
                 pa.array(top)], names=[*cols, *made])

    return docs.select(*cols, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letter")) \
               .mapInArrow(run, schema)
