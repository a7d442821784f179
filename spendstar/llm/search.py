"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

1. ``statistics`` counts the documents with a term (N) and all terms (L).
2. ``build_index`` reads the texts once more, where they are: every run of
   ``SHARD_BYTES`` of texts becomes a shard, with its documents in order of
   their ids and a posting list per term: document numbers and frequencies in
   blocks of ``BLOCK`` postings, as variable-length bytes. Of each block the
   index keeps the last document and the largest frequency part of the score;
   that part needs N and L, not the term's weight, so it is exact. The index is
   written to the shared folder and can serve many searches.
3. ``search`` looks the queries' terms up, weighs them by their frequencies over
   all shards, and gives every shard its lists. A term's bound is its largest
   score part in any shard times its weight. Per query, terms are ordered by
   bound, and as long as the bounds of the first ones together stay within the
   kth score, these are non-essential: only the documents of the others, the
   essential lists, are candidates. A candidate is dropped when its score so
   far, the bounds left and, list by list from the highest bound, the maximum
   of the one block that could hold it do not exceed the kth score; only blocks
   that are still asked for after that are decompressed.
4. Every shard returns its k best per query; these heaps are merged.

Scores are 64-bit integers throughout; weights come from one logarithm in
doubles. A shard groups equal terms by a 64-bit hash of their bytes; a list
answers a query's term only if hash and bytes are equal.

Scale: the texts are not shuffled. A shard's task holds the lists of the
queries' terms in one shard and a chunk of at most ``CHUNK_ITEMS`` queries or
``CHUNK_BYTES`` of them (or one query), whatever their number. The merge keeps
k rows per query and task before it shuffles (a ranked window limit).

Defined cases: a null or empty text has no terms, is no result and does not
count in N; documents without an id are results with a null id, after all ids
of the same score; documents sharing an id are ranked one by one. Repeated query
rows count once; a query without terms or without a match has no rows; one
without an id is a query, its rows have a null id. Queries sharing an id and
differing in text are ranked together as one list per text.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .buffers import BYTE_LOWER, LOWER, span_hashes, text_array
from .common import cut, lean, shared_folder, ship

SHARD_BYTES = 16 << 20
BLOCK = 128
RANGE = 1024                 # documents whose candidates are scored at a time
CHUNK_ITEMS, CHUNK_BYTES = 1024, 1 << 20
K = 20
K1_PART, B_PART, UNIT = 12, 25, 1_000_000_000
IS_TERM = np.zeros(256, bool)
IS_TERM[48:58] = IS_TERM[65:91] = IS_TERM[97:123] = IS_TERM[128:] = True
_NO_ID = np.iinfo(np.int64).max


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every term, and the number of terms of each document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    inside = IS_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.diff(np.searchsorted(start, off))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with n terms."""
    return 100 - B_PART + (B_PART * n.astype(np.int64) * n_docs) // max(n_terms, 1)


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's frequency adds per unit of its weight."""
    return (UNIT * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + K1_PART * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def put_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes, seven bits each, of numbers below 2**63, and their sizes."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 9):
        size += v >= np.uint64(1) << np.uint64(7 * k)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        use = size > k
        byte = (v[use] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[use] + k] = byte.astype(np.uint8) | np.where(size[use] > k + 1, 128, 0).astype(np.uint8)
    return out, size


def take_numbers(data: np.ndarray) -> np.ndarray:
    """The numbers of put_numbers."""
    if not len(data):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    nth = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * nth), first)


def index_shard(data: np.ndarray, off: np.ndarray, n_docs: int, n_terms: int) -> dict[str, np.ndarray]:
    """Lists of one shard, whose documents are numbered as they come. Of every
    list: hash, term (start and end in data), df and largest part; of its
    blocks: last document, largest part and size in bytes; all postings as
    bytes; m of the documents."""
    start, end, count = terms(data, off)
    value = span_hashes(data, start, end, BYTE_LOWER)
    m = length_norm(count, n_docs, n_terms)
    order = np.argsort(value, kind="stable")
    doc = np.repeat(np.arange(len(count)), count)[order]
    value = value[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = value[1:] != value[:-1]
    post = np.flatnonzero(fresh | np.concatenate([[True], doc[1:] != doc[:-1]])[:len(order)])
    tf = np.diff(post, append=len(order))
    doc, new = doc[post], fresh[post]
    first = np.flatnonzero(new)
    df = np.diff(first, append=len(post))
    at = np.arange(len(post)) - np.repeat(first, df)                 # in its list
    head = at % BLOCK == 0
    before = np.concatenate([[0], doc[:-1]])[:len(doc)]
    delta = np.where(new, doc, doc - before)
    both = np.empty(2 * len(post), np.int64)
    both[0::2], both[1::2] = delta, tf - 1
    raw, size = put_numbers(both)
    block = np.flatnonzero(head)
    score = part(tf, m[doc])
    return {"hash": value[post[first]].view(np.int64), "start": start[order[post[first]]], "end": end[order[post[first]]],
            "df": df, "blocks": -(-df // BLOCK), "last": doc[np.append(block[1:], len(post)) - 1] if len(block) else block,
            "best": np.maximum.reduceat(score, block) if len(block) else block,
            "top": np.maximum.reduceat(score, first) if len(first) else first,
            "bytes": np.add.reduceat(size, 2 * block) if len(block) else block, "raw": raw, "m": m}


class PostingList:
    """A term's list in one shard; blocks are decompressed when asked for."""

    def __init__(self, df: int, last: np.ndarray, best: np.ndarray, size: np.ndarray, raw: np.ndarray):
        self.df, self.last, self.best, self.raw = df, last, best, raw
        self.off = np.concatenate([[0], np.cumsum(size)])
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of block b."""
        got = self.open.get(b)
        if got is None:
            both = take_numbers(self.raw[self.off[b]:self.off[b + 1]])
            base = int(self.last[b - 1]) if b else 0
            got = self.open[b] = np.cumsum(both[0::2]) + base, both[1::2] + 1
        return got

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings of the documents low <= d < high."""
        a = int(np.searchsorted(self.last, low))
        b = min(int(np.searchsorted(self.last, high - 1)), len(self.last) - 1)
        if a > b:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = [self.block(x) for x in range(a, b + 1)]
        doc = np.concatenate([d for d, _ in parts])
        tf = np.concatenate([t for _, t in parts])
        use = slice(np.searchsorted(doc, low), np.searchsorted(doc, high))
        return doc[use], tf[use]

    def block_of(self, doc: np.ndarray) -> np.ndarray:
        """The block that could hold each document; one past the last: none."""
        return np.searchsorted(self.last, doc)

    def frequency(self, doc: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Frequencies of rising documents in their blocks, 0 where absent."""
        out = np.zeros(len(doc), np.int64)
        at = 0
        while at < len(doc):
            to = int(np.searchsorted(block, block[at], "right"))
            d, t = self.block(int(block[at]))
            k = np.minimum(np.searchsorted(d, doc[at:to]), len(d) - 1)
            out[at:to] = np.where(d[k] == doc[at:to], t[k], 0)
            at = to
        return out


def best_documents(lists: list[PostingList], weights: np.ndarray, bounds: np.ndarray, m: np.ndarray,
                   k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k best documents of a shard (scores above 0,
    ties to the smaller number). ``weights``: per list, with repeats of the
    term in the query; ``bounds``: largest score of the term in any shard."""
    order = np.argsort(bounds, kind="stable")
    lists = [lists[i] for i in order]
    weights, bounds = weights[order], bounds[order]
    below = np.concatenate([[0], np.cumsum(bounds)])                # bound of all lists before
    top_doc, top_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    floor = 0                                                       # the kth score, once there are k
    for low in range(0, len(m), RANGE):
        high = min(low + RANGE, len(m))
        # non-essential: what only these lists hold cannot exceed the kth score
        split = int(np.searchsorted(below, floor, "right")) - 1
        if split >= len(lists):
            break
        score = np.zeros(high - low, np.int64)
        for j in range(split, len(lists)):
            d, tf = lists[j].between(low, high)
            score[d - low] += weights[j] * part(tf, m[d])
        doc = np.flatnonzero(score)
        score = score[doc]
        doc = doc + low
        for j in range(split - 1, -1, -1):
            use = score + below[j + 1] > floor
            doc, score = doc[use], score[use]
            if not len(doc):
                break
            block = lists[j].block_of(doc)
            some = block < len(lists[j].last)
            limit = np.zeros(len(doc), np.int64)
            limit[some] = weights[j] * lists[j].best[block[some]]
            use = score + limit + below[j] > floor                  # before any block is opened
            doc, score, block, some = doc[use], score[use], block[use], some[use]
            at = np.flatnonzero(some)
            if len(at):
                tf = lists[j].frequency(doc[at], block[at])
                score[at] += np.where(tf > 0, weights[j] * part(tf, m[doc[at]]), 0)
        use = score > floor
        if use.any():
            top_doc, top_score = np.concatenate([top_doc, doc[use]]), np.concatenate([top_score, score[use]])
            best = np.lexsort((top_doc, -top_score))[:k]
            top_doc, top_score = top_doc[best], top_score[best]
            floor = int(top_score[-1]) if len(best) == k else 0
    return top_doc, top_score


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as f:
        return {k: f[k] for k in f.files}


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Number of documents with a term, and of all terms."""

    def run(batches):
        for batch in batches:
            data, off = text_array(batch.column(0))
            n, total = 0, 0
            for a in range(0, batch.num_rows, 512):
                b = min(a + 512, batch.num_rows)
                _, _, count = terms(data[off[a]:off[b]], off[a:b + 1] - off[a])
                n, total = n + int((count > 0).sum()), total + int(count.sum())
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])

    ship(docs.sparkSession)
    r = docs.select(text_col).mapInArrow(lean(run), "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return r[0] or 0, r[1] or 0


LISTS = ("shard long, hash long, term binary, df long, top long, last binary, best binary, sizes binary, raw binary, "
         "docs binary")


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> tuple[int, int]:
    """Write the index of all documents to ``path``; returns N and L. A row
    with a null hash holds a shard's documents, every other row one list."""
    n_docs, n_terms = statistics(docs, text_col)

    def shard_rows(number, ids, texts):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        raw = [texts[i].encode() for i in order]
        off = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        name = np.array([_NO_ID if ids[i] is None else ids[i] for i in order], np.int64)
        s = index_shard(data, off, n_docs, n_terms)
        low = LOWER[data].tobytes()
        n = len(s["hash"])
        cuts = np.concatenate([[0], np.cumsum(s["blocks"])])
        ends = np.concatenate([[0], np.cumsum(s["bytes"])])[cuts]
        known = np.array([ids[i] is not None for i in order], bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *(pa.array([None], t) for t in [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
               + 4 * [pa.binary()]), pa.array([_pack(ids=name, known=known, m=s["m"])], pa.binary())], names=NAMES)

        def slices(values, kind, at):
            off_ = (at * np.dtype(kind).itemsize).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(at) - 1,
                                         [None, pa.py_buffer(off_), pa.py_buffer(np.ascontiguousarray(values, kind))])
        last, best, size = (slices(s[c], "<i4", cuts) for c in ("last", "best", "bytes"))
        lists = slices(s["raw"], "u1", ends)
        word = pa.array([low[a:b] for a, b in zip(s["start"].tolist(), s["end"].tolist(), strict=True)], pa.binary())
        for a in range(0, n, 20_000):
            c = min(20_000, n - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(c, number)), pa.array(s["hash"][a:a + c]), word.slice(a, c), pa.array(s["df"][a:a + c]),
                 pa.array(s["top"][a:a + c]), *(x.slice(a, c) for x in (last, best, size, lists)), pa.nulls(c, pa.binary())],
                names=NAMES)

    def run(batches):
        place, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1]) + 16
                if size >= shard_bytes:
                    yield from shard_rows((place << 24) + number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield from shard_rows((place << 24) + number, ids, texts)

    ship(docs.sparkSession)
    docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(lean(run), LISTS).write.parquet(path)
    return n_docs, n_terms


NAMES = [c.split()[0] for c in LISTS.split(", ")]


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, given, hash, term, times): the distinct terms of every distinct query."""

    def run(batches):
        for batch in batches:
            data, off = text_array(batch.column(2))
            low = LOWER[data]
            start, end, count = terms(data, off)
            raw = low.tobytes()
            value = span_hashes(low, start, end, BYTE_LOWER).view(np.int64)
            who = pa.array(np.repeat(np.arange(batch.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(who), batch.column(1).take(who), pa.array(value),
                 pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())],
                names=["item", "given", "hash", "term"])

    # the key of a query: hashes skip nulls, so a null id is hashed as such
    text, given = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    item = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(k), given.isNull(), given, text)) for k in (1, 2)])
    rows = queries.select(item.alias("item"), given.alias("given"), text.alias("text")).dropDuplicates(["item"])
    return rows.mapInArrow(lean(run), "item string, given long, hash long, term binary") \
               .groupBy("item", "given", "hash", "term").agg(F.count(F.lit(1)).alias("times"))


def search(path: str, n_docs: int, queries: DataFrame, k: int = K, item_col: str = "item_id",
           text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(item_col, rank, id_col, score): every query's k best documents."""
    spark = queries.sparkSession
    ship(spark)
    index = spark.read.parquet(path)
    asked = cut(query_terms(queries, item_col, text_col))
    size = asked.agg(F.countDistinct("item").alias("n"), F.sum(F.octet_length("term") + 40).alias("b")).first()
    chunks = max(1, -(-size["n"] // CHUNK_ITEMS), -(-(size["b"] or 0) // CHUNK_BYTES))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("item"), F.lit(chunks)).cast("int"))

    # document frequencies over all shards, and each term's largest part in any of them
    vocabulary = cut(asked.select("hash", "term").distinct())
    found = index.filter(F.col("hash").isNotNull()).join(vocabulary, ["hash", "term"], "left_semi")
    whole = cut(found.groupBy("hash", "term").agg(F.sum("df").alias("df"), F.max("top").alias("top")))
    weighed = cut(asked.join(whole, ["hash", "term"]))

    # every chunk of queries meets every shard that has one of its terms, as one group
    wanted = weighed.select("chunk", "hash", "term").distinct()
    lists = found.select("shard", "hash", "term", "df", "last", "best", "sizes", "raw").join(wanted, ["hash", "term"])
    documents = spark.read.parquet(path).filter(F.col("hash").isNull()).select("shard", "docs")
    queries_of = weighed.groupBy("chunk").agg(F.collect_list(F.struct("item", "given", "hash", "term", "times", "df", "top"))
                                              .alias("queries"))
    met = documents.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(queries_of, "chunk")

    def visit(left, right):
        if not right.num_rows or not left.num_rows:
            return pa.table({n: pa.array([], t) for n, t in OUT})
        of = _unpack(right.column("docs")[0].as_py())
        place = {(h, t): i for i, (h, t) in enumerate(zip(left.column("hash").to_pylist(), left.column("term").to_pylist(),
                                                          strict=True))}
        made: dict[int, PostingList] = {}

        def opened(i):
            if i not in made:
                last, best, size_ = (np.frombuffer(left.column(c)[i].as_py(), "<i4").astype(np.int64)
                                     for c in ("last", "best", "sizes"))
                made[i] = PostingList(left.column("df")[i].as_py(), last, best, size_,
                                      np.frombuffer(left.column("raw")[i].as_py(), np.uint8))
            return made[i]

        by_item: dict[str, list] = {}
        for q in right.column("queries")[0].as_py():
            i = place.get((q["hash"], q["term"]))
            w = weight(q["df"], n_docs) * q["times"]
            if i is not None and w > 0:
                by_item.setdefault(q["item"], []).append((q["given"], i, w, q["top"]))
        out = {n: [] for n, _ in OUT}
        for item, rows in by_item.items():
            w = np.array([r[2] for r in rows], np.int64)
            top = np.array([r[3] for r in rows], np.int64)
            doc, score = best_documents([opened(r[1]) for r in rows], w, w * top, of["m"], k)
            out["item"] += [item] * len(doc)
            out["given"] += [rows[0][0]] * len(doc)
            out["doc"] += [int(of["ids"][d]) if of["known"][d] else None for d in doc]
            out["score"] += score.tolist()
        return pa.table({n: pa.array(out[n], t) for n, t in OUT})

    heaps = lists.groupBy("shard", "chunk").cogroup(met.groupBy("shard", "chunk")) \
                 .applyInArrow(visit, "item string, given long, doc long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        F.col("given").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")


OUT = [("item", pa.string()), ("given", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())]


def ranked(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index ``docs`` in the shared folder and search it."""
    path = f"{shared_folder(docs.sparkSession, 'search')}/index"
    n_docs, _ = build_index(docs, path, id_col, text_col, shard_bytes)
    return search(path, n_docs, queries, k, item_col, item_text_col, id_col)
