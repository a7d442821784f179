"""Packing by lexical retrieval: neighbours of a seed document fill its window.

1. Document frequencies, the number of documents and the mean length are those
   of the whole table (counted in Spark by 64-bit word hash).
2. Documents that share rare heavy words are placed together. Of the
   ``PLACE_WORDS`` words with the highest BM25 weight in a document, its lead is
   the one that most documents have, as long as their texts fit a shard; the
   next one orders the documents of a lead. Leads are hashed into buckets of
   about ``SHARD_BYTES`` bytes (a lead with more than that is split by id), and
   a bucket is cut, in the order of its leads, into shards of at most
   ``SHARD_BYTES``.
3. One task handles a bucket, shard after shard: it tokenizes the texts, builds
   an inverted index with BM25 weights, and then repeats: the current document
   is the seed, all its words are the query, and the best unused neighbours of
   the shard are appended until the window is full. A document that crosses the
   end of a window is cut there; its rest opens the next window and is the next
   seed. When no neighbour is left the next unused document in order of lead
   and id follows. Only the last window of a shard is padded.

Neighbours that were placed in another shard are not found; README gives the
share that is.

Tokens are looked up per word: words are tokenized once per worker and kept in
a bounded table (the tokenizer never joins tokens across white space), which
gives the ids of tokenizing the whole text.

Scale: the texts are shuffled twice, to meet their places and by bucket. At
most ``HEAD_WORDS`` words, the commonest, are broadcast with their frequencies;
rarer words that two documents have are joined. A shard is bounded by its bytes
(or one id: rows that share an id share a shard). The driver gets the totals,
the number of words per frequency and the broadcast words.

Defined cases: a null or empty text is the end token alone; rows with one id
are separate documents, told apart by ``copy`` (0, 1, ...); an empty table
gives no rows. Input columns other than id and text are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import BYTE_LOWER, LOWER, runs, span_hashes, stable_order, text_array, words
from .common import discard, lean, lean_group, release_shuffles, shared_folder, ship

WINDOW = 2048
END = 1
SHARD_BYTES = 4 << 20
COUNT_BYTES = 32 << 20
PLACE_WORDS = 24
HEAD_WORDS = 1 << 20
BEST = 24
K1, B = 1.2, 0.75
CACHE_WORDS = 1_500_000
_MARK = np.zeros(256, bool)       # ASCII characters that are neither letters, digits nor white space
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
HEAVY = np.dtype([("minus", "<f4"), ("word", "<i8"), ("df", "<i4")])
PIECES = ("doc_id long, copy int, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters of U+00C0 to U+00FF. Other
    bytes are no letters here: their words are tokenized whole."""
    low = data | 32
    out = (low >= 97) & (low <= 122)
    if len(data) > 1:
        pair = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        out[:-1] |= pair
        out[1:] |= pair
    return out


def _lower(data: np.ndarray) -> np.ndarray:
    """Words of the letters of ``_letters`` in lower case."""
    out = LOWER[data]
    out[1:] += ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)).view(np.uint8) << 5
    return out


def _picked(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of data joined by a space, and where each begins and ends there."""
    if not len(start):
        return np.zeros(0, np.uint8), start, stop
    size = stop - start + 1
    after = np.cumsum(size)
    out = data.take(np.repeat(start - (after - size), size) + np.arange(after[-1]), mode="clip")
    out[after - 1] = 32
    return out[:-1], after - size, after - 1


class Growing:
    """An array that is appended to; room doubles, so that a part costs its own length."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1 << 16, kind), 0

    def append(self, part: np.ndarray) -> int:
        """Append; returns the length before."""
        before, self.n = self.n, self.n + len(part)
        if self.n > len(self.held):
            self.held = np.concatenate([self.held[:before], np.zeros(max(self.n, 2 * before) - before, self.held.dtype)])
        self.held[before:self.n] = part
        return before

    def __getitem__(self, at):
        return self.held[at]


class WordTokenizer:
    """Ids of whole texts from a table of words' ids."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        # lower-cased words of letters need no normalizer and no pattern to be split
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        probe = " ".join(["the quick brown fox jumps over the lazy dog", *map(chr, range(97, 123)),
                          *(chr(c) + "a" + chr(c) for c in range(0xDF, 0x100) if c != 0xF7)])
        if any(a.ids != b.ids for a, b in zip(*(t.encode_batch_fast([probe], add_special_tokens=False)
                                                for t in (self.tok, self.letters)), strict=True)):
            self.letters = self.tok
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self):
        """Forget all words. Known words are kept by 64-bit hash, sorted."""
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool, self.first, self.size = Growing(np.uint32), Growing(np.int64), Growing(np.int32)
        self.end: dict[int, int] = {}

    def _add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """New entries for consecutive runs of ids; their numbers."""
        start = self.pool.append(ids)
        number = self.first.append(start + np.cumsum(size) - size) + np.arange(len(size))
        self.size.append(size)
        return number

    def _find(self, value: np.ndarray) -> np.ndarray:
        """Entries of hashed words, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(value), -1)
        at = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
        return np.where(self.keys[at] == value, self.entry[at], -1)

    def _learn(self, value: np.ndarray, number: np.ndarray) -> None:
        """Keep entries of distinct hashes in rising order; a known one keeps its entry."""
        fresh = self._find(value) < 0
        value, number = value[fresh], number[fresh]
        at = np.searchsorted(self.keys, value)
        self.keys, self.entry = np.insert(self.keys, at, value), np.insert(self.entry, at, number)

    def _stems(self, joined: np.ndarray) -> np.ndarray:
        """Entries of words of letters: one tokenizer unit each, so their ids end at a word end."""
        low, space = _lower(joined), np.flatnonzero(joined == 32)
        low[space[999::1000]] = 10
        parts = self.letters.encode_batch_fast(low.tobytes().decode().split("\n"), add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in parts])
        cuts = np.flatnonzero(self.ends[flat]) + 1
        return self._add(flat, np.diff(cuts, prepend=0)) if len(cuts) == len(space) + 1 else self._single(joined)

    def _single(self, joined: np.ndarray) -> np.ndarray:
        words, out = joined.tobytes().decode().split(" ") if len(joined) else [], [np.zeros(0, np.int64)]
        for a in range(0, len(words), 20_000):
            ids = [e.ids for e in self.tok.encode_batch_fast(words[a:a + 20_000], add_special_tokens=False)]
            out.append(self._add(np.array([i for x in ids for i in x], np.uint32),
                                 np.array([len(x) for x in ids], np.int64)))
        return np.concatenate(out)

    def numbers(self, value: np.ndarray, start: np.ndarray, stop: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Entries of distinct words: their hashes and places in data. A word
        of letters, with ASCII marks after it or not, is put together from its
        lower-cased letters and its marks, which the tokenizer never joins;
        any other word is tokenized by itself."""
        if len(self.keys) + len(value) > CACHE_WORDS:
            self.clear()
        found = self._find(value)
        new = np.flatnonzero(found < 0)
        if len(new):
            # the new words only, one after the other with a space between
            data, a, b = _picked(data, start[new], stop[new])
            letters = np.concatenate([[0], np.cumsum(_letters(data), dtype=np.int32)])
            other = np.maximum.accumulate(np.where(_MARK[data], -1, np.arange(len(data), dtype=np.int32)))
            end = np.maximum(other[b - 1] + 1, a)          # of the part before trailing marks
            plain = (end > a) & (letters[end] - letters[a] == end - a)
            stem = span_hashes(data, a[plain], end[plain], BYTE_LOWER)
            marked = plain & (b > end)
            mark = span_hashes(data, end[marked], b[marked])
            entry = np.empty(len(new), np.int64)
            entry[plain] = self._known(stem, data, a[plain], end[plain], self._stems)
            both = np.stack([entry[marked], self._known(mark, data, end[marked], b[marked], self._single)], axis=1)
            entry[marked] = self._add(self._gather(both.ravel()), self.size[both].sum(axis=1))
            entry[~plain] = self._single(_picked(data, a[~plain], b[~plain])[0])
            self._learn(value[new], entry)
            found[new] = entry
        return found

    def _known(self, value: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray, make) -> np.ndarray:
        """Entries of parts of words by hash; ``make`` gives those of parts not met before."""
        out = self._find(value)
        miss = np.flatnonzero(out < 0)
        if len(miss):
            distinct, at, which = np.unique(value[miss], return_index=True, return_inverse=True)
            made = make(_picked(data, start[miss[at]], stop[miss[at]])[0])
            self._learn(distinct, made)
            out[miss] = made[which]
        return out

    def _gather(self, number: np.ndarray) -> np.ndarray:
        n = self.size[number]
        stop = np.cumsum(n)
        return self.pool[np.repeat(self.first[number] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]

    def expand(self, number: np.ndarray, count: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts given as table numbers, each with ``end`` after it, and their token counts."""
        if not len(count):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if end not in self.end:
            self.end[end] = int(self._add(np.array([end], np.uint32), np.array([1]))[0])
        number = np.insert(number, np.cumsum(count), self.end[end])
        return self._gather(number), np.add.reduceat(self.size[number], np.cumsum(count + 1) - count - 1, dtype=np.int64)


class Statistics:
    """Document count, mean length and document frequencies of the whole
    table. ``words`` is sorted; a word that is neither in it nor in ``more``
    occurs in one document."""

    def __init__(self, n: int, mean: float, words: np.ndarray, df: np.ndarray, more: Statistics | None = None):
        self.n, self.mean, self.words, self.df, self.more = n, mean, words, df, more

    def find(self, value: np.ndarray) -> np.ndarray:
        """Frequencies of hashed words, 1 for unknown ones."""
        out = np.ones(len(value), np.int64) if self.more is None else self.more.find(value)
        if not len(self.words):
            return out
        at = np.minimum(np.searchsorted(self.words, value), len(self.words) - 1)
        return np.where(self.words[at] == value, self.df[at], out)

    def plus(self, words: np.ndarray, df: np.ndarray) -> Statistics:
        """With more words, none of which is known yet."""
        if not len(words):
            return self
        words, at = np.unique(words, return_index=True)
        return Statistics(self.n, self.mean, words, df[at], self)

    def idf(self, df: np.ndarray) -> np.ndarray:
        return np.log1p((self.n - df + 0.5) / (df + 0.5))

    def norm(self, count: np.ndarray) -> np.ndarray:
        return K1 * (1 - B + B * count / max(self.mean, 1))


def _changes(x: np.ndarray) -> np.ndarray:
    """Where an ordered array has another value than before, the first place included."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def postings(value: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, document and term frequency of every (word, document), sorted by
    both, from the hashed words of consecutive documents; positions of new words."""
    by, value = stable_order(value)
    new = _changes(value)
    doc = np.repeat(np.arange(len(count)), count)[by]
    post = np.flatnonzero(new | _changes(doc))
    return value[post], doc[post], np.diff(post, append=len(by)), np.flatnonzero(new[post])


class Index:
    """Inverted index of one shard: postings with BM25 weights."""

    def __init__(self, word: np.ndarray, doc: np.ndarray, tf: np.ndarray, df: np.ndarray, count: np.ndarray,
                 of: Statistics, df_all: np.ndarray):
        """Postings sorted by word, then document; ``df`` in the shard and
        ``df_all`` in the table by word, ``count``: words by document."""
        n = len(count)
        self.doc = doc
        self.first = np.concatenate([[0], np.cumsum(df)])
        self.weight = of.idf(df_all)[word] * tf * (K1 + 1) / (tf + of.norm(count)[self.doc])
        # the query of each document: its words that another document of the shard has too
        shared = np.flatnonzero(df[word] > 1)
        # 16-bit numbers are sorted by radix
        order = shared[np.argsort(self.doc[shared].astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
        start = np.concatenate([[0], np.cumsum(np.bincount(self.doc[order], minlength=n))])
        self.query = np.split(word[order], start[1:-1]) if n else []
        self.n = n

    def forget(self, used: np.ndarray) -> None:
        """Drop the postings of used documents: they would be added up for nothing."""
        keep = ~used[self.doc]
        self.first = np.concatenate([[0], np.cumsum(keep)])[self.first]
        self.doc, self.weight = self.doc[keep], self.weight[keep]

    def neighbours(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents by falling BM25 score, ties to the smaller number."""
        q = self.query[seed]
        if not len(q):
            return
        size = self.first[q + 1] - self.first[q]
        stop = np.cumsum(size)
        at = np.arange(stop[-1]) + np.repeat(self.first[q] - (stop - size), size)
        score = np.bincount(self.doc[at], self.weight[at], minlength=self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > 4 * BEST:                # a window takes a few: the best ones are put in order first
            least = np.partition(score[found], len(found) - BEST)[len(found) - BEST]
            top = found[score[found] >= least]
            yield from top[np.argsort(-score[top], kind="stable")].tolist()
            found = found[score[found] < least]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def reading_order(index: Index, size: np.ndarray, window: int) -> np.ndarray:
    """The shard's documents in the order in which they fill the windows."""
    n, out, used, following, free = len(size), [], np.zeros(len(size), bool), 0, 0
    seed, indexed = -1, n
    while len(out) < n:
        if n - len(out) < 0.8 * indexed:
            index.forget(used)
            indexed = n - len(out)
        if seed < 0:
            while used[following]:
                following += 1
            seed = following
            used[seed] = True
            out.append(seed)
            free -= int(size[seed])
        if free <= 0:                 # the seed runs on: the window it ends in is filled next
            free %= window
            if free == 0:
                seed = -1
                continue
        last = -1
        for d in index.neighbours(seed, used):
            used[d] = True
            out.append(d)
            free -= int(size[d])
            last = d
            if free <= 0:
                break
        seed = last if last >= 0 and free < 0 else -1
    return np.array(out, np.int64)


def pack_shard(ids_of: list, texts: list[str], tok: WordTokenizer, shard: int, window: int, end: int,
               of: Statistics | None = None) -> pa.Table:
    """Pieces of one shard (documents in the order given); ``of``: the table's
    statistics, by default the shard's own."""
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    start, stop, count = words(data, off)
    # equal words by 64-bit hash: one sort gives the distinct words and the postings
    value = span_hashes(data, start, stop)
    by, value = stable_order(value)
    new = _changes(value)
    nth = np.cumsum(new) - 1                                 # distinct word
    lead = by[new]
    table = tok.numbers(value[new], start[lead], stop[lead], data)
    number = np.empty(len(by), np.int64)
    number[by] = table[nth]
    ids, size = tok.expand(number, count, end)
    doc = np.repeat(np.arange(len(count)), count)[by]
    post = np.flatnonzero(new | _changes(doc))
    word = nth[post]
    df = np.bincount(word, minlength=len(lead))
    if of is None:
        of, df_all = Statistics(len(count), count.mean() if len(count) else 0, value[new], df), df
    else:
        df_all = of.find(value[new])
    index = Index(word, doc[post], np.diff(post, append=len(by)), df, count, of, df_all)
    order = reading_order(index, size, window)
    begin = (np.cumsum(size) - size)[order]
    place = np.cumsum(size[order]) - size[order]             # in the shard's stream
    total = size[order]
    # cut at multiples of the window
    parts = (place + total - 1) // window - place // window + 1
    doc = np.repeat(np.arange(len(order)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    left = np.maximum(place[doc], (place[doc] // window + nth) * window)
    right = np.minimum(place[doc] + total[doc], (place[doc] // window + nth + 1) * window)
    a = begin[doc] + left - place[doc]
    flat = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
    crc = [zlib.crc32(flat[4 * x:4 * (x + y)]) for x, y in zip(a.tolist(), (right - left).tolist(), strict=True)]
    name = [ids_of[i] for i in order[doc]]
    seen: dict = {}
    copy = []
    for x in ids_of:
        seen[x] = seen.get(x, -1) + 1
        copy.append(seen[x])
    return pa.table({
        "doc_id": pa.array(name, pa.int64()), "copy": pa.array([copy[i] for i in order[doc]], pa.int32()),
        "start": pa.array(left - place[doc]), "length": pa.array(right - left), "ids_crc32": pa.array(crc, pa.int64()),
        "doc_tokens": pa.array(total[doc]), "sequence_id": pa.array((np.int64(shard) << 32) + left // window),
        "offset": pa.array(left % window)})


@lru_cache(1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a worker, with the words it knows from earlier tasks.
    A function of the module: tasks find it there, while a table that they
    refer to would come with each of them, empty."""
    return WordTokenizer(path)


def _sortable(x: np.ndarray) -> np.ndarray:
    """64-bit unsigned numbers in the order of floating-point numbers (no -0.0)."""
    bits = x.view(np.int64)
    return bits.view(np.uint64) ^ ((bits >> 63).view(np.uint64) | np.uint64(1 << 63))


def _hashed(column):
    """Hashed words and word counts of a batch's texts, in runs of documents: (first, last, values, counts)."""
    data, off = text_array(column)
    for a, b in runs(off):
        part = data[off[a]:off[b]]
        start, stop, count = words(part, off[a:b + 1] - off[a])
        yield a, b, span_hashes(part, start, stop), count


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """values[cuts[i]:cuts[i + 1]] as byte strings."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
        None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))])


def count_words(texts: DataFrame, ranges: int = 1) -> DataFrame:
    """(word, df, n_words): document frequency by word hash, and one row
    without a word that has the number of all words. ``texts``: one column;
    ``ranges``: how many ranges of hashes are counted by themselves. Words
    travel as arrays, one row for each range and million of words."""

    def merged(held):
        by, value = stable_order(np.concatenate([v for v, _ in held]))
        first = np.flatnonzero(_changes(value))
        df = np.concatenate([c for _, c in held])[by]
        return value[first], np.add.reduceat(df, first) if len(first) else df

    def run(batches):
        total, held, size = 0, [], 0

        def rows(value, df):
            cuts = np.searchsorted((value >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            cuts = np.append(cuts[some], len(value))
            return pa.RecordBatch.from_arrays([
                pa.array(some.astype(np.int32)), _binary(value, cuts), _binary(df.astype(np.int32), cuts),
                pa.array(np.zeros(len(some), np.int64))], names=["range", "words", "df", "n_words"])

        for batch in batches:
            for _, _, value, count in _hashed(batch.column(0)):
                total += int(count.sum())
                if len(value):
                    word, _, _, new = postings(value, count)
                    held.append((word[new], np.diff(new, append=len(word))))
                    size += len(new)
                if size > 1_000_000:
                    one = merged(held)
                    if len(one[0]) > 500_000:          # little left to combine
                        yield rows(*one)
                        held, size = [], 0
                    else:
                        held, size = [one], len(one[0])
        if held:
            yield rows(*merged(held))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b""]), pa.array([b""]), pa.array([total])],
                                         names=["range", "words", "df", "n_words"])

    def count(key, table):
        value, df = merged([(np.frombuffer(w, np.uint64), np.frombuffer(d, np.int32).astype(np.int64)) for w, d in
                            zip(table.column("words").to_pylist(), table.column("df").to_pylist(), strict=True)])
        value, df = value[df > 1].view(np.int64), df[df > 1]
        if key[0].as_py():
            return pa.table({"word": value, "df": df, "n_words": np.zeros(len(df), np.int64)})
        total = sum(table.column("n_words").to_pylist())
        return pa.table({"word": pa.array([None, *value.tolist()], pa.int64()), "df": np.append([0], df).astype(np.int64),
                         "n_words": np.append([total], np.zeros(len(df))).astype(np.int64)})

    return texts.mapInArrow(lean(run), "range int, words binary, df binary, n_words long") \
                .groupBy("range").applyInArrow(lean_group(count), "word long, df long, n_words long")


def places(rows: DataFrame, table: DataFrame, head, low: int, cap: int, path: str) -> DataFrame:
    """(id, bytes, lead, next, rare): where a document belongs, and its words
    of fewer than ``low`` documents. ``table``: (word, df), ``head``: broadcast
    statistics of the words of ``low`` documents or more; ``path``: for what is
    read from the texts."""
    item = "array<struct<minus: float, word: long, df: int>>"

    def run(batches):
        for batch in batches:
            cand, rare = [], []
            of = head.value
            for a, b, value, count in _hashed(batch.column(1)):
                word, doc, tf, new = postings(value, count)
                df = np.repeat(of.find(word[new]), np.diff(new, append=len(word)))
                part = tf * (K1 + 1) / (tf + of.norm(count)[doc])
                known = np.flatnonzero(df > 1)
                weight = of.idf(df[known]) * part[known]
                # by document and falling weight (below 256); equal weights stay in the order of their words
                order, _ = stable_order(_sortable(doc[known] * 256.0 - weight))
                own = np.bincount(doc[known], minlength=b - a)
                nth = np.arange(len(order)) - np.repeat(np.cumsum(own) - own, own)
                top = order[nth < PLACE_WORDS]
                at = known[top]
                heavy = np.empty(len(at), HEAVY)
                heavy["minus"], heavy["word"], heavy["df"] = -weight[top], word[at].view(np.int64), np.minimum(df[at], 2**31 - 1)
                cand.append((np.minimum(own, PLACE_WORDS), heavy))
                new = np.flatnonzero(df == 1) if low > 2 else np.zeros(0, np.int64)
                new = new[np.argsort(doc[new], kind="stable")]
                rare.append((np.bincount(doc[new], minlength=b - a), part[new].astype(np.float32), word[new]))

            def strings(parts):
                size, values = [np.concatenate(x) for x in zip(*parts, strict=True)]
                return _binary(values, np.concatenate([[0], np.cumsum(size)]))

            def lists(parts, names):
                size, *columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                values = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
                return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                                pa.StructArray.from_arrays(values, names))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), strings(cand), lists(rare, ["part", "word"])],
                    names=["id", "bytes", "cand", "rare"])

    # read once: stored for the two uses
    rows.select("id", "text", (F.octet_length("text") + 16).cast("long").alias("bytes")).mapInArrow(
        lean(run), "id long, bytes long, cand binary, rare array<struct<part: float, word: long>>").write.parquet(path)
    read = rows.sparkSession.read.parquet(path)
    # of rows with one id one chooses the place; arrays are aggregated by sorting, once they have met
    own = read.repartition("id").groupBy("id").agg(F.sum("bytes").alias("bytes"), F.max("cand").alias("cand"))
    if low > 2:
        n = head.value.n
        few = table.filter((F.col("df") > 1) & (F.col("df") < low)).select("word", "df")
        minus = -F.log1p((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("part")
        found = read.select("id", F.explode("rare").alias("r")).select("id", "r.word", "r.part") \
                    .join(few.hint("shuffle_hash"), "word").groupBy("id", "word") \
                    .agg(F.struct(F.min(minus).cast("float").alias("minus"), F.col("word"), F.max("df").cast("int").alias("df"))
                         .alias("r")) \
                    .groupBy(F.col("id").alias("__id")).agg(F.sort_array(F.collect_list("r")).alias("rare"))
        own = own.join(found, F.col("id").eqNullSafe(F.col("__id")), "left").drop("__id")
    else:
        own = own.withColumn("rare", F.lit(None).cast(item))

    def choose(batches):
        for batch in batches:
            n = batch.num_rows
            data, off = text_array(batch.column(2))
            cand, lists = np.frombuffer(data.tobytes(), HEAVY), batch.column(3)
            size = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            rare = [x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten()]
            doc = np.concatenate([np.repeat(np.arange(n), np.diff(off) // HEAVY.itemsize), np.repeat(np.arange(n), size)])
            minus, word, df = (np.concatenate([cand[k], r]) for k, r in zip(HEAVY.names, rare, strict=True))
            # the heaviest of a document's words, equally heavy ones by hash
            order = np.lexsort((word, doc * 256.0 + minus))
            first = np.searchsorted(doc[order], np.arange(n + 1))
            top = order[np.arange(len(order)) - first[doc[order]] < PLACE_WORDS]
            # words whose documents fit a shard first, the commonest of them leading
            doc, word, rank = doc[top], word[top], np.where(df[top] <= cap, -df[top].astype(np.int64), df[top])
            chosen = []
            for _ in range(2):
                some = np.flatnonzero(_changes(doc))
                least = np.zeros(n, np.int64)
                least[doc[some]] = np.minimum.reduceat(rank, some) if len(some) else 0
                tied = rank == least[doc]
                there = doc[tied]
                some = np.flatnonzero(_changes(there))
                best, has = np.zeros(n, np.int64), np.zeros(n, bool)
                best[there[some]] = np.minimum.reduceat(word[tied], some) if len(some) else 0
                has[there[some]] = True
                chosen.append(pa.array(best, mask=~has))
                keep = ~(tied & (word == best[doc]))
                doc, word, rank = doc[keep], word[keep], rank[keep]
            words_ = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                              pa.StructArray.from_arrays([pa.array(rare[1], pa.int64()), pa.array(rare[2], pa.int32())],
                                                                         ["word", "df"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), words_, *chosen],
                                             names=["id", "bytes", "rare", "lead", "next"])

    return own.select("id", "bytes", "cand", "rare").mapInArrow(
        lean(choose), "id long, bytes long, rare array<struct<word: long, df: int>>, lead long, next long") \
        .select("id", "bytes", "rare", F.coalesce("lead", F.xxhash64("id")).alias("lead"), F.coalesce("next", F.lit(0)).alias("next"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, shard_bytes: int = SHARD_BYTES,
         id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per piece: doc_id, copy, start, length, ids_crc32, doc_tokens,
    sequence_id (bucket << 44 | shard << 32 | window), offset. ``tokenizer``:
    path of a tokenizer file that every executor has."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sums = rows.agg(F.sum(F.octet_length("text") + 16).alias("b"), F.count(F.lit(1)).alias("n")).first()
    total, n = sums["b"] or 0, sums["n"]
    folder = shared_folder(spark, "packing")
    count_words(rows.select("text"), max(1, -(-total // COUNT_BYTES))).write.parquet(f"{folder}/words")
    table = spark.read.parquet(f"{folder}/words")
    n_words = table.filter(F.col("word").isNull()).agg(F.sum("n_words")).first()[0] or 0
    table = table.filter(F.col("word").isNotNull())
    # the commonest words, whole classes of frequencies (an eighth of a doubling each) at a time
    classes = table.groupBy(F.floor(8 * F.log2("df")).alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.min("df").alias("a"), F.max("df").alias("b")).orderBy(F.desc("c")).collect()
    low, known = 2, 0
    for r, above in zip(classes, [None, *classes], strict=False):
        known += r["n"]
        if known > head_words:
            low = above["a"] if above else r["b"] + 1
            break
    common = table.filter(F.col("df") >= low).select("word", "df").toArrow()
    value = common.column("word").to_numpy().view(np.uint64)
    by = np.argsort(value)
    head = spark.sparkContext.broadcast(Statistics(n, n_words / max(n, 1), value[by], common.column("df").to_numpy()[by]))
    places(rows, table, head, low, max(2, n * shard_bytes // max(total, 1)), f"{folder}/read").write.parquet(f"{folder}/places")
    place = spark.read.parquet(f"{folder}/places")
    # the words and what was shuffled up to here are done with
    del table, common
    discard(spark, f"{folder}/read")
    discard(spark, f"{folder}/words")
    release_shuffles(spark)

    buckets = max(1, -(-total // shard_bytes))
    # at most ``buckets`` leads are that large; how they are joined is left to their measured size
    large = place.groupBy("lead").agg(F.sum("bytes").alias("b")).filter(F.col("b") > shard_bytes) \
                 .select("lead", F.ceil(F.col("b") / F.lit(shard_bytes)).alias("parts"))
    place = place.join(large, "lead", "left").withColumn(
        "part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(F.lit(0)))
    place = place.select(F.col("id").alias("__id"), "lead", "next", "rare",
                         F.pmod(F.xxhash64("lead", "part"), F.lit(buckets)).cast("long").alias("bucket"))
    placed = rows.join(place.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("__id"))) \
                 .select("bucket", "id", "text", "lead", "next", "rare")

    def run(key, batch):
        tok = word_tokenizer(tokenizer)
        rows_ = sorted(zip(*(batch.column(c).to_pylist() for c in ("lead", "next", "id", "text")),
                           range(batch.num_rows), strict=True),
                       key=lambda p: (p[0], p[1], p[2] is not None, p[2] or 0, p[3]))
        size = np.array([len(p[3].encode()) + 16 for p in rows_])
        shards = shard_cuts([p[2] for p in rows_], size, shard_bytes)
        out = []
        for k, (a, b) in enumerate(shards):
            part = rows_[a:b]
            rare = batch.column("rare").take(pa.array([p[4] for p in part])).combine_chunks().flatten()
            of = head.value.plus(rare.field(0).to_numpy(zero_copy_only=False).view(np.uint64),
                                 rare.field(1).to_numpy(zero_copy_only=False)) if len(rare) else head.value
            out.append(pack_shard([p[2] for p in part], [p[3] for p in part], tok, key[0].as_py() << 12 | k,
                                  window, end, of))
        return pa.concat_tables(out)

    return placed.groupBy("bucket").applyInArrow(lean_group(run), PIECES)


def shard_cuts(ids: list, size: np.ndarray, shard_bytes: int) -> list[tuple[int, int]]:
    """Ranges of at most ``shard_bytes`` of about the same bytes; rows of one id in a row stay together."""
    first = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]] + [len(ids)]
    full = np.concatenate([[0], np.cumsum(size)])
    goal = full[-1] / max(1, -(-int(full[-1]) // shard_bytes))
    out, a = [], 0
    for i, j in zip(first[:-1], first[1:], strict=True):
        if i > a and (full[j] - full[a] > shard_bytes or full[i] - full[a] >= goal):
            out.append((a, i))
            a = i
    return [*out, (a, len(ids))]
