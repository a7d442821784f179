"""Block-Max MaxScore search against brute force."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendstar.llm import search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(rows, items, k=20):
    docs = [(i, Counter(split(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in docs:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    word = [f"w{k}" for k in range(300)]
    return [" ".join(word[int(300 * rng.random() ** 3)] for _ in range(rng.randint(1, 80))) for _ in range(n)]


def test_numbers_and_terms():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(0, 2**int(b), 200) for b in (1, 7, 8, 14, 31, 50, 62)] + [np.array([0, 127, 128, 2**63 - 1])])
    raw, size = search.put_numbers(v)
    assert (search.take_numbers(raw) == v).all() and size.sum() == len(raw)
    assert len(search.take_numbers(raw[:0])) == 0
    texts = ["", "a b", "é-x", "", "x", "y", "  ", "Ab\x00c", "日本 z9", "a"]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    start, end, count = search.terms(data, off)
    whole = data.tobytes()
    assert [whole[a:b].decode() for a, b in zip(start, end, strict=True)] == [t for x in texts for t in TERM.findall(x)]
    assert count.tolist() == [len(TERM.findall(x)) for x in texts]


@pytest.mark.parametrize("seed", range(4))
def test_pruning_is_exact(seed, monkeypatch):
    """A shard alone, with small blocks and ranges: the result of scoring everything, with fewer blocks opened."""
    monkeypatch.setattr(search, "BLOCK", 8)
    monkeypatch.setattr(search, "RANGE", 64)
    texts = corpus(1200, seed)
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    count = [Counter(t.split()) for t in texts]
    n_docs, n_terms = len(texts), sum(sum(c.values()) for c in count)
    s = search.index_shard(data, off, n_docs, n_terms)
    names = [data[a:b].tobytes().decode() for a, b in zip(s["start"], s["end"], strict=True)]
    cut, byte = np.cumsum(np.append(0, s["blocks"])), np.cumsum(np.append(0, s["bytes"]))
    rng = random.Random(seed)
    opened = total = 0
    for _ in range(30):
        query = [q for q in rng.sample(range(len(names)), 3)] + [names.index("w0"), names.index("w1"), names.index("w2")]
        query = sorted(set(query))
        lists = [search.PostingList(int(s["df"][q]), s["last"][cut[q]:cut[q + 1]], s["best"][cut[q]:cut[q + 1]],
                                    s["bytes"][cut[q]:cut[q + 1]], s["raw"][byte[cut[q]]:byte[cut[q + 1]]]) for q in query]
        w = np.array([search.weight(int(s["df"][q]), n_docs) for q in query])
        doc, score = search.best_documents(lists, w, w * s["top"][query], s["m"], 5)
        want = np.zeros(len(texts), np.int64)
        for q, x in zip(query, w, strict=True):
            tf = np.array([c[names[q]] for c in count])
            want += x * search.part(tf, s["m"])
        best = [d for d in np.lexsort((np.arange(len(want)), -want))[:5] if want[d] > 0]
        assert doc.tolist() == best and score.tolist() == want[best].tolist()
        opened += sum(len(x.open) for x in lists)
        total += sum(len(x.last) for x in lists)
    assert opened < 0.8 * total


def test_ranked_against_brute_force(spark, make_docs):
    texts = corpus(300, 9)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    rows += [(5, None), (6, ""), (7, " ,;"), (None, "rare É é"), (None, "w1 rare"), (8, "rare"), (9, "RARE"), (9, "rare"),
             (10, "rare-x.rare"), (11, "w0 " * 50_000 + "rare"), (12, "日本 w5"), (13, "Straße w5\x00w6")]
    items = [(1, "rare w1"), (1, "rare w1"), (2, None), (3, ""), (4, "nothing here"), (None, "rare É"), (5, "w0 w0 w0 w1 rare RARE"),
             (6, " ".join(texts[:3])), (6, "w7"), (7, "日本 straße")]
    docs = make_docs(rows).withColumns({"rank": F.lit("clash"), "score": F.lit(1), "item_id": F.lit(2)}).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(1), "term": F.lit("x")})
    want = brute(rows, items)
    assert got(search.ranked(docs, asked)) == want
    assert got(search.ranked(docs, asked, shard_bytes=2000)) == want
    assert got(search.ranked(make_docs([]), asked)) == got(search.ranked(docs, asked.limit(0))) == []


def test_chunks_of_queries(spark, make_docs, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_ITEMS", 3)
    rows = list(enumerate(corpus(200, 3)))
    items = list(enumerate(corpus(20, 4)))
    assert got(search.ranked(make_docs(rows), spark.createDataFrame(items, "item_id long, text string"), k=7)) == brute(rows, items, 7)
