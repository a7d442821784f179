"""Quality by line labels: a linear-chain conditional random field marks content and boilerplate.

Each line with a word is one position of its document's chain. Its features
are shares and logarithms of counts (words, word length, capitals, digits,
symbols, marks, immediate and earlier repeats). The field has two labels;
Viterbi decoding labels every line of every document, and a document is kept
if the words in content lines reach ``MIN_SHARE`` of all its words.

Training is exact (forward-backward, Adam) on a bounded sample of documents
with a quality label; their lines take the document's label as a noisy line
label, and the chain's transitions smooth single lines out.

The rule columns are computed with the labels in one pass over whole texts:
see ``RULE_COLUMNS``. Null or empty texts have no words and fail the base
rule. Without quality labels of both kinds every line is content. Output
columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import mix64, prefix_hash, runs, span_hash, sums, text_array, words
from .common import ship

MIN_SHARE = 0.5
MAX_PER_CLASS = 600
MAX_BYTES = 1 << 15
WINDOW = 8
RULE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MADE = (*RULE_COLUMNS, "content_share", "base_failed", "kept")
N_FEATURES = 12
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass
class Model:
    emit: np.ndarray    # (N_FEATURES, 2): label 1 is content
    move: np.ndarray    # (2, 2): from, to
    first: np.ndarray   # (2,)


ALL_CONTENT = Model(np.zeros((N_FEATURES, 2)), np.array([[0.0, 9.0], [0.0, 9.0]]), np.array([0.0, 9.0]))


def repeated(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its (doc, value) occur twice or more; has it occurred before."""
    key = mix64(value ^ mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    many, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    many[order[1:]] |= same
    many[order[:-1]] |= same
    later[order[1:]] = same
    return many, later


def measure(data: np.ndarray, off: np.ndarray):
    """Rule columns (dict of arrays by document), and for lines with a word:
    features (lines, N_FEATURES), words per line, and line bounds by document."""
    n = len(off) - 1
    start, end, n_words = words(data, off)
    word_doc = np.repeat(np.arange(n), n_words)
    prefix = prefix_hash(data)
    word = span_hash(prefix, start, end)
    lead = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(lead)])
    word_len = chars[end] - chars[start]
    at = np.concatenate([[0], np.cumsum(n_words)])
    cols = {"n_words": n_words, "word_chars": sums(word_len, at), "n_symbols": sums(_SYMBOL[data], off)}

    # words in 8-word windows that occur twice or more in their text
    covered = np.zeros(len(word) + 1, np.int64)
    if len(word) >= WINDOW:
        w = np.zeros(len(word) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            w = w * np.uint64(0xD6E8FEB86659FD93) + word[k:k + len(w)]
        inside = np.flatnonzero(word_doc[:len(w)] == word_doc[WINDOW - 1:])
        hit = inside[repeated(word_doc[inside], w[inside])[0]]
        covered[:] += np.bincount(hit, minlength=len(covered))
        covered[:] -= np.bincount(hit + WINDOW, minlength=len(covered))[:len(covered)]
    cols["n_repeat_words"] = sums(np.cumsum(covered)[:-1] > 0, at)

    # lines: cut at \n and at document ends
    breaks = np.flatnonzero(data == 10)
    line_start = np.concatenate([off[:-1], breaks + 1])
    line_end_doc = np.searchsorted(off, breaks, "right") - 1
    owner = np.concatenate([np.arange(n), line_end_doc])
    order = np.lexsort((line_start, owner))
    line_start, owner = line_start[order], owner[order]
    last = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(owner) else np.zeros(0, bool)
    line_end = np.where(last, off[owner + 1], np.concatenate([line_start[1:] - 1, [0]]) if len(owner) else 0)
    first_word = np.searchsorted(start, line_start)
    count = np.searchsorted(start, line_end) - first_word
    real = count > 0
    line_start, line_end, owner = line_start[real], line_end[real], owner[real]
    first_word, count = first_word[real], count[real]
    _, dup = repeated(owner, span_hash(prefix, line_start, line_end))
    cols["n_dup_lines"] = np.bincount(owner[dup], minlength=n).astype(np.int64)

    def share(flags):
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[line_end] - total[line_start]) / np.maximum(length, 1)

    length = line_end - line_start
    same_as_last = np.zeros(len(word) + 1, np.int64)
    if len(word) > 1:
        np.cumsum((word[1:] == word[:-1]) & (word_doc[1:] == word_doc[:-1]), out=same_as_last[2:])
    again = same_as_last[first_word + count] - same_as_last[np.minimum(first_word + 1, len(word))]
    total_len = np.concatenate([[0], np.cumsum(word_len)])
    mean_len = (total_len[first_word + count] - total_len[first_word]) / np.maximum(count, 1)
    cover = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    mark = (data == 33) | (data == 63) | (data == 61) | (data == 95) | (data == 126)
    features = np.stack([
        np.ones(len(count)), np.log1p(count) / 3, np.minimum(mean_len, 20) / 8, share(upper) * 2, share(lower),
        share((data >= 48) & (data <= 57)) * 4, share(_SYMBOL[data]) * 8, share(mark) * 8,
        again / np.maximum(count, 1), (cover[first_word + count] - cover[first_word]) / np.maximum(count, 1),
        dup.astype(float), (data[line_end - 1] == 46).astype(float) if len(line_end) else np.zeros(0)], axis=1)
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return cols, features, count, bounds


def _by_step(bounds: np.ndarray):
    """Chains side by side, longest first: yields (step, documents that have it)."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    for t in range(int(size.max(initial=0))):
        yield t, order[:int(np.searchsorted(-size[order], -t, "left"))]


def viterbi(m: Model, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best label (1: content) of every line."""
    emit = features @ m.emit
    n = len(bounds) - 1
    best, back = np.zeros((n, 2)), np.zeros((len(features), 2), np.int8)
    steps = list(_by_step(bounds))
    for t, docs in steps:
        line = bounds[docs] + t
        if t == 0:
            best[docs] = m.first + emit[line]
        else:
            ways = best[docs][:, :, None] + m.move
            back[line] = ways.argmax(axis=1)
            best[docs] = ways.max(axis=1) + emit[line]
    label, now = np.zeros(len(features), np.int8), best.argmax(axis=1)
    size = np.diff(bounds)
    for t, docs in reversed(steps):
        line = bounds[docs] + t
        now[docs] = np.where(size[docs] - 1 == t, best[docs].argmax(axis=1), now[docs])
        label[line] = now[docs]
        now[docs] = back[line, now[docs]]
    return label


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def fit(features: np.ndarray, bounds: np.ndarray, label: np.ndarray, rounds: int = 120, rate: float = 0.1,
        penalty: float = 1e-3) -> Model:
    """Maximum likelihood of the labels (0 or 1 per line) by Adam."""
    params = [np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)]
    size, n = np.diff(bounds), max(1, len(bounds) - 1)
    steps = list(_by_step(bounds))
    first = bounds[:-1][size > 0]
    follow = np.ones(len(features), bool)
    follow[first] = False
    follow = np.flatnonzero(follow)
    one = np.eye(2)
    true = [features.T @ one[label], np.zeros((2, 2)), one[label[first]].sum(axis=0)]
    np.add.at(true[1], (label[follow - 1], label[follow]), 1)
    a1, a2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, rounds + 1):
        emit = features @ params[0]
        fwd, bwd = np.zeros((len(features), 2)), np.zeros((len(features), 2))
        for t, docs in steps:
            line = bounds[docs] + t
            fwd[line] = emit[line] + (params[2] if t == 0 else _log_sum(fwd[line - 1][:, :, None] + params[1], 1))
        for t, docs in reversed(steps):
            line = (bounds[docs] + t)[size[docs] > t + 1]
            bwd[line] = _log_sum(params[1] + (emit[line + 1] + bwd[line + 1])[:, None, :], 2)
        post = fwd + bwd
        norm = _log_sum(post, 1)
        post = np.exp(post - norm[:, None])
        pair = np.exp(fwd[follow - 1][:, :, None] + params[1] + (emit[follow] + bwd[follow])[:, None, :]
                      - norm[follow][:, None, None])
        model = [features.T @ post, pair.sum(axis=0), post[first].sum(axis=0)]
        for p, e, t, a, b in zip(params, model, true, a1, a2, strict=True):
            g = (e - t) / n + penalty * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.99**k)) + 1e-8)
    return Model(*params)


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, max_bytes: int = MAX_BYTES,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Model from at most ``max_per_class`` documents of each quality label, of
    at most ``max_bytes`` bytes, chosen by hash."""
    lab = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).filter("__id is not null")
    parts = [lab.filter(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(max_per_class) for y in (0, 1)]
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
                .filter(F.octet_length("__t") <= max_bytes)
                .join(F.broadcast(parts[0].unionByName(parts[1])), "__id").limit(4 * max_per_class).collect())
    rows = sorted(rows, key=lambda r: (r["__id"], r["__t"]))
    if len({r["__y"] for r in rows}) < 2:
        return ALL_CONTENT
    data, off = text_array(pa.array([r["__t"] for r in rows]))
    _, features, _, bounds = measure(data, off)
    label = np.repeat([r["__y"] for r in rows], np.diff(bounds))
    return fit(features, bounds, label)


def judge(docs: DataFrame, model: Model, min_share: float = MIN_SHARE, text_col: str = "text") -> DataFrame:
    """``docs`` plus the rule columns, content_share, base_failed and kept."""
    cols = [c for c in docs.columns if c not in MADE]
    schema = docs.select(*cols).schema
    for c in RULE_COLUMNS:
        schema = schema.add(c, "long")
    schema = schema.add("content_share", "double").add("base_failed", "boolean").add("kept", "boolean")
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = cols.index(text_col)

    def run(batches):
        m = held.value
        for batch in batches:
            data, off = text_array(batch.column(place))
            parts = []
            for a, b in runs(off):
                rules, features, count, bounds = measure(data[off[a]:off[b]], off[a:b + 1] - off[a])
                rules["content"] = sums(count * viterbi(m, features, bounds), bounds)
                parts.append(rules)
            got = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
                   for k in (*RULE_COLUMNS, "content")}
            n = got["n_words"]
            share = got["content"] / np.maximum(n, 1)
            failed = (n < 20) | (100 * got["n_repeat_words"] > 30 * n)
            made = [pa.array(got[c].astype(np.int64)) for c in RULE_COLUMNS]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made, pa.array(share), pa.array(failed), pa.array(~failed & (share >= min_share))],
                names=[*cols, *MADE])

    return docs.select(*cols).mapInArrow(run, schema)
