"""Encoding and decoding with a merge-type (BPE) SentencePiece vocabulary, by backtracking.

A sequence of pieces is the merge result of a text exactly if every two
neighbours are compatible: re-merging the two pieces' characters gives the same
two pieces back. So no text has to be merged as a whole:

1. An Aho-Corasick automaton over the vocabulary lists every piece that starts
   at every position of a stretch of known characters, in one pass.
2. From the left, the longest piece that is compatible with the piece before it
   and does not end at a failed position is taken. If there is none, the
   position is marked as failed in a bit field, the last piece is taken back
   and its next shorter one is tried. A position fails once at most, so the
   work follows the length of the text.
3. ``Vocabulary.compatible`` re-merges two pieces (a few characters) by the
   merge law, highest score first, leftmost among equals, and is remembered per
   pair.

Characters without a piece become their UTF-8 bytes' pieces and bound the
stretches. Where no piece holds a space mark after another character, a text is
further cut before the marks that follow one, and likewise (``apart``) between
any two characters that are neighbours in no piece: no merge crosses such a
place, and most of the resulting stretches are words seen before, whose ids come from
a table per worker bounded by ``CACHE_BYTES``.

Scale: rows are handled where they are, without a shuffle. A worker holds the
automaton, the tables and one run of texts (or one text) at a time.

Defined cases: a null text is encoded as the empty one (the end id alone, if
asked for) and decoded as empty; null ids decode as a null text; extra columns
stay, those named like an output are replaced.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType

from .common import lean, ship

SPACE_MARK = "▁"
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 240            # of a stretch in the table, about
CACHE_STRETCH = 48           # longer stretches are not kept
PAIRS = 1 << 20
RUN_CHARS = 1 << 19


class Vocabulary:
    """Pieces, scores and special ids of a model file, and the merge law."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalized = sp.normalize     # the model's own character rules and space marks
        self.leading = bool(sp.normalize("x") != "x")
        self.end, n = sp.eos_id(), sp.vocab_size()
        self.ids: dict[str, int] = {}
        self.text = [""] * n
        self.score = np.zeros(n)
        self.byte = [-1] * 256
        self.raw: list[bytes | None] = [None] * n     # what an id stands for; None: nothing (control)
        self.fallback: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for i in range(n):
            piece, self.score[i] = sp.id_to_piece(i), sp.get_score(i)
            self.text[i] = piece
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.fallback[i] = value
            elif sp.is_unknown(i):
                self.raw[i] = sp.decode([i]).encode()
            elif not sp.is_control(i):
                if sp.is_unused(i):
                    raise ValueError("vocabularies with unused pieces are not supported")
                self.ids[piece] = i
                self.raw[i] = piece.replace(SPACE_MARK, " ").encode()
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.inside = {x + y for p in self.ids for x, y in zip(p, p[1:], strict=False)}      # neighbours in some piece
        self.alphabet = frozenset(c for c in self.ids if len(c) == 1)
        if not {c for p in self.ids for c in p} <= self.alphabet:
            raise ValueError("a character of a piece is no piece itself")
        if len(self.fallback) < 256:
            raise ValueError("vocabularies without byte pieces are not supported")
        # a line break is the commonest character without a piece
        alone = "" if "\n" in self.ids else "\n"
        if any(p[1] == SPACE_MARK != p[0] for p in self.inside):
            pattern = f"[^{alone}]+" if alone else ".+"
        else:
            pattern = f"{SPACE_MARK}*[^{SPACE_MARK}{alone}]+|{SPACE_MARK}+"
        self.cut = re.compile(pattern + ("|\n" if alone else ""), re.S)
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        # what ids stand for as bytes, byte pieces as their byte
        plain = [bytes([self.fallback[i]]) if i in self.fallback else self.raw[i] or b"" for i in range(n)]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_off = np.cumsum([0, *map(len, plain)])
        self.clear()

    def apart(self, text: str) -> list[str]:
        """``text`` cut wherever two characters are neighbours in no piece: no merge crosses such a place."""
        out, a = [], 0
        for k in range(1, len(text)):
            if text[k - 1:k + 1] not in self.inside:
                out.append(text[a:k])
                a = k
        out.append(text[a:])
        return out

    def clear(self) -> None:
        """Forget the stretches seen."""
        self.known: dict[str, int] = {}
        self.size, self.first, self.pool = array("q"), array("q"), array("i")
        self.held = 0

    def merged(self, text: str) -> list[int]:
        """The merge law itself, for a few known characters: of all neighbours
        whose concatenation is a piece the best score goes first, the leftmost
        among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether re-merging the two pieces gives them back; left -1: a piece alone."""
        after = self.pairs.setdefault(left, {})
        known = after.get(right)
        if known is None:
            if left < 0:
                known = self.merged(self.text[right]) == [right]
            else:
                known = self.merged(self.text[left] + self.text[right]) == [left, right]
            after[right] = known
            self.n_pairs += 1
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a stretch of known characters."""
        n = len(text)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, (size, i) in self.automaton.iter(text):
            starts[last - size + 1].append((size, i))          # by rising size
        failed, any_failed = bytearray(n // 8 + 1), False
        pairs = self.pairs
        out: list[int] = []
        tried: list[int] = []                                  # of each piece taken: its place among its start's
        at, before, place = 0, -1, len(starts[0]) - 1 if n else 0
        while at < n:
            options, after = starts[at], pairs.get(before)
            if after is None:
                after = pairs[before] = {}
            while place >= 0:
                size, i = options[place]
                good = after.get(i)
                if good is None:
                    good = self.compatible(before, i)
                if good:
                    stop = at + size
                    if not any_failed or not failed[stop >> 3] >> (stop & 7) & 1:
                        break
                place -= 1
            if place >= 0:
                out.append(i)
                tried.append(place)
                at, before = stop, i
                place = len(starts[at]) - 1 if at < n else 0
            else:
                if not out:
                    raise ValueError(f"no encoding of {text[:40]!r}")
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                at -= len(self.text[out.pop()])
                before = out[-1] if out else -1
                place = tried.pop() - 1
        return out

    def stretch(self, text: str) -> list[int]:
        """Ids of any normalized text; characters without a piece stand alone."""
        if self.alphabet.issuperset(text):
            return self.backtrack(text)
        out: list[int] = []
        a, n = 0, len(text)
        while a < n:
            b = a
            while b < n and text[b] in self.alphabet:
                b += 1
            if b > a:
                out += self.backtrack(text[a:b])
            if b < n:
                out += [self.byte[x] for x in text[b].encode()]
                b += 1
            a = b
        return out

    def _number(self, part: str, extra: dict[str, int]) -> int:
        """The table's entry of a stretch that had none. ``extra``: entries of long ones, of one call only."""
        table = self.known if len(part) <= CACHE_STRETCH else extra
        number = table.get(part)
        if number is None:
            ids, parts = [], self.apart(part)
            if len(parts) == 1:
                ids = self.stretch(part)
            else:
                for k in [self._number(x, extra) for x in parts]:
                    ids += self.pool[self.first[k]:self.first[k] + self.size[k]]
            number = table[part] = len(self.size)
            self.first.append(len(self.pool))
            self.size.append(len(ids))
            self.pool.extend(ids)
            self.held += ENTRY_BYTES + 4 * len(ids)
        return number

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and the number of each text's ids."""
        if self.held > CACHE_BYTES:
            self.clear()
        if self.n_pairs > PAIRS:
            self.pairs, self.n_pairs = {}, 0
        numbers: list[int] = []
        counts, extra = [], {}
        for text in texts:
            parts = self.cut.findall(self.normalized(text)) if text else []
            got = list(map(self.known.get, parts))
            if None in got:
                got = [self._number(p, extra) if k is None else k for p, k in zip(parts, got, strict=True)]
            numbers += got
            counts.append(len(got))
        number, count = np.array(numbers, np.int64), np.array(counts, np.int64)
        first, each = (np.frombuffer(x, np.int64)[number] if len(number) else number for x in (self.first, self.size))
        stop = np.cumsum(each)
        at = np.repeat(first - (stop - each), each) + np.arange(stop[-1] if len(stop) else 0)
        flat = np.frombuffer(self.pool, np.int32)[at] if len(at) else np.zeros(0, np.int32)
        total = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(count)])]
        n = np.diff(total)
        if end:
            flat = np.insert(flat, total[1:], self.end)
            n = n + 1
        return flat.astype(np.int32), n

    def decode_all(self, flat: np.ndarray, count: np.ndarray) -> list[str]:
        """``decode`` of consecutive texts' ids, by their bytes; texts with byte
        pieces that are no whole characters are decoded piece by piece."""
        out = []
        off = np.concatenate([[0], np.cumsum(count)])
        size = (self.plain_off[1:] - self.plain_off[:-1])[flat]
        where = np.concatenate([[0], np.cumsum(size)])
        raw = b"".join(self._bytes(flat[a:a + RUN_CHARS], size[a:a + RUN_CHARS]) for a in range(0, len(flat), RUN_CHARS))
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            text = raw[where[a]:where[b]]
            first = next((i for i in flat[a:b].tolist() if self.raw[i] is not None or i in self.fallback), None)
            if self.leading and first is not None and self.text[first][:1] == SPACE_MARK:
                text = text[1:]
            try:
                out.append(text.decode())
            except UnicodeDecodeError:
                out.append(self.decode(flat[a:b]))
        return out

    def _bytes(self, ids: np.ndarray, size: np.ndarray) -> bytes:
        stop = np.cumsum(size)
        at = np.repeat(self.plain_off[ids] - (stop - size), size) + np.arange(stop[-1])
        return self.plain[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control ids stand for nothing, runs of byte pieces
        for their UTF-8 characters, invalid bytes for U+FFFD each; the space
        that the encoder puts before a text is taken off."""
        parts: list[bytes] = []
        run = bytearray()
        for i in ids.tolist():
            value = self.fallback.get(i)
            if value is not None:
                run.append(value)
                continue
            if run:
                parts.append(_characters(run))
                run = bytearray()
            raw = self.raw[i]
            if raw is not None:
                if self.leading and not parts and self.text[i][:1] == SPACE_MARK:
                    raw = raw[1:]
                    parts.append(b"")
                parts.append(raw)
        if run:
            parts.append(_characters(run))
        return b"".join(parts).decode()


def _characters(raw: bytes) -> bytes:
    """Valid UTF-8 characters as they are, every other byte as U+FFFD."""
    raw = bytes(raw)
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    raw[at:at + size].decode()
                except UnicodeDecodeError:
                    continue
                if at + size <= len(raw):
                    out.append(raw[at:at + size])
                    at += size
                    break
            else:
                out.append(b"\xef\xbf\xbd")
                at += 1
        return b"".join(out)


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The model of this worker."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _text_runs(texts: list[str]):
    a, size = 0, 0
    for b, t in enumerate(texts):
        if size and size + len(t) > RUN_CHARS:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def _with_columns(docs: DataFrame, made: dict[str, DataType], read: str, make) -> DataFrame:
    """``docs`` plus the columns ``made`` (name: type), which ``make`` gives
    for every Arrow array of the column ``read``."""
    cols = [c for c in docs.columns if c not in made or c == read]
    schema = docs.select(*cols).schema
    for name, kind in made.items():
        schema = schema.add(name, kind)
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch.column(read))], names=[*cols, *made])

    return docs.select(*cols).mapInArrow(lean(run), schema)


def encode(docs: DataFrame, model: str, end: bool = True, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` plus the ids of every whole text (array<int>); with
    ``decoded_col`` also the text that these ids decode to. ``model``: path of
    a model file that every executor has."""

    def make(column):
        of = vocabulary(model)
        texts = [t or "" for t in column.to_pylist()]
        parts = [of.encode(texts[a:b], end) for a, b in _text_runs(texts)]
        sizes = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([f for f, _ in parts]) if parts else np.zeros(0, np.int32)
        off = np.concatenate([[0], np.cumsum(sizes)])
        out = [pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat))]
        if decoded_col:
            out.append(pa.array(of.decode_all(flat, sizes), pa.string()))
        return out

    made: dict[str, DataType] = {ids_col: ArrayType(IntegerType())}
    return _with_columns(docs, made | ({decoded_col: StringType()} if decoded_col else {}), text_col, make)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` plus the text of every row's ids."""

    def make(column):
        of = vocabulary(model)
        return [pa.array([None if x is None else of.decode(np.array(x, np.int64)) for x in column.to_pylist()], pa.string())]

    return _with_columns(rows, {text_col: StringType()}, ids_col, make)
