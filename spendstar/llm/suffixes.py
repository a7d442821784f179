"""Removal of 400-byte strings that occur more than once, by sorted suffixes.

A string of ``LENGTH`` bytes that starts in two places is found through a
sparse suffix array. Of every window of LENGTH bytes the suffix that starts at
its leftmost smallest ``GRAM``-byte hash stands for it (a minimizer): equal
windows choose the same place, so only about one suffix in 185 is sorted, with
the bytes before it that its windows need.

1. Texts are read once: each suffix keeps the range of windows it stands for
   and the hashes of the ``HALF`` bytes after and before it. Equal windows
   agree in one of the two halves, so suffixes without a repeated half drop
   out. Exact copies of a text are known by a 128-bit hash and stand in once:
   with two copies every byte of a long enough text goes.
2. The remaining suffixes are range-partitioned by their leading bytes
   (Spark samples the splitters); each bucket is sorted by a multikey
   quicksort over 8-byte words, which gives the runs of suffixes with equal
   leading bytes. In a run, windows are matched by hash and each match is
   confirmed on the bytes, by extending the two suffixes to the left and to
   the right. The splitters are the leading GRAM bytes, so no run crosses a
   boundary.
3. Halves that occur more than ``HOT`` times do not go to one bucket: their
   windows are exploded to 128-bit hashes and counted with map-side combine.
4. Windows that occur twice cover their bytes; runs of covered bytes are cut
   from the texts.

Scale: 26 bytes per suffix, one shuffle of the texts and one of the suspicious
suffixes; no bucket holds a hot string.

Defined cases: null and empty texts have no bytes and stay as they are; ids are
may be null or repeated: rows are told apart by a 128-bit hash of id and text.
Repeated rows (same id and text) count as copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import mix64, prefix_hash, runs, span_hash, text_array
from .common import cut, shared_folder, ship

LENGTH = 400
GRAM = 32
HALF = 200
HOT = 20_000
_POS = 24
_NONE = np.uint64(2**64 - 1)
SUFFIX = np.dtype([("pos", "<i4"), ("lo", "<i2"), ("hi", "<i2"), ("right", "<i8"), ("left", "<i8")])


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of key[i:i + width] for every i that has one."""
    n = len(key) - width + 1
    pad = -len(key) % width
    blocks = np.concatenate([key, np.full(pad, _NONE)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def suffixes(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(document, suffix records) of the texts: pos in the text, and the
    offsets lo..hi that pos has in the windows it stands for."""
    gram, half = min(GRAM, length // 2), length // 2
    empty = np.zeros(0, np.int64), np.zeros(0, SUFFIX)
    if len(data) < length:
        return empty
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    hashed = span_hash(prefix, at, at + gram)
    anchors = []
    for part in range(0, len(at), 1 << 23):  # positions take 24 bits beside the hash
        stop = min(len(at), part + (1 << 23) + length - gram)
        key = (hashed[part:stop] >> np.uint64(_POS) << np.uint64(_POS)) | np.arange(stop - part, dtype=np.uint64)
        if len(key) >= length - gram + 1:
            least = _sliding_min(key, length - gram + 1)
            least = least[:min(len(least), 1 << 23)]
            anchors.append((least & np.uint64((1 << _POS) - 1)).astype(np.int64) + part)
    anchor = np.concatenate(anchors)                       # of the window starting at each position
    start = np.arange(len(anchor))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(anchor)]
    ok = start + length <= off[doc + 1]
    start, anchor, doc = start[ok], anchor[ok], doc[ok]
    if not len(start):
        return empty
    first = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    begin = np.flatnonzero(first)
    last = np.concatenate([begin[1:], [len(start)]]) - 1
    pos, d = anchor[begin], doc[begin]
    out = np.zeros(len(begin), SUFFIX)
    out["pos"], out["lo"], out["hi"] = pos - off[d], pos - start[last], pos - start[begin]
    to, back = np.minimum(pos + half, off[d + 1]), np.maximum(pos - half, off[d])
    out["right"] = span_hash(prefix, pos, to).view(np.int64)
    out["left"] = mix64(span_hash(prefix, back, pos) ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64)
    return d, out


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows (n, 8k) by a multikey quicksort over big-endian
    words: rows that tie on the words so far are sorted on by the next."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.concatenate([[0], np.cumsum(words[order[1:], 0] != words[order[:-1], 0])]) if len(order) else order
    for k in range(1, words.shape[1]):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        sub = order[tied]
        again = np.lexsort((words[sub, k], group[tied]))
        order[tied] = sub[again]
        w = words[order, k]
        fresh = np.zeros(len(order), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (w[1:] != w[:-1])
        group = np.cumsum(fresh)
    return order


def sorted_runs(lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their leading bytes, and where each run of equal ones begins (and the end)."""
    order = multikey_sort(lead)
    words = np.ascontiguousarray(lead[order]).view(np.uint64)
    return order, np.concatenate([[0], np.flatnonzero((words[1:] != words[:-1]).any(axis=1)) + 1, [len(order)]])


def _agreement(data: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray, side: int) -> np.ndarray:
    """How many bytes agree from the places x and y on, to the right (side 1) or before them (-1), at most room."""
    out = np.zeros(len(x), np.int64)
    for p in range(0, len(x), 4000):
        r = room[p:p + 4000]
        step = np.arange(int(r.max(initial=0)))
        move = step if side > 0 else -1 - step
        i, j = (np.clip(z[p:p + 4000, None] + move, 0, len(data) - 1) for z in (x, y))
        differ = (data[i] != data[j]) | (step >= r[:, None])
        out[p:p + 4000] = np.where(differ.any(axis=1), differ.argmax(axis=1) if len(step) else 0, r)
    return out


def repeated_windows(context: list[bytes], lo: np.ndarray, hi: np.ndarray, run: np.ndarray, length: int):
    """Which windows of the suffixes occur twice in their run. context[i]: the
    bytes from hi[i] before the suffix to length - lo[i] after its start.
    Returns (suffix, offset) of the repeated windows."""
    size = np.array([len(c) for c in context], np.int64)
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(context), np.uint8)
    count = hi - lo + 1
    who = np.repeat(np.arange(len(context)), count)
    nth = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    start = base[who] + nth
    value = span_hash(prefix_hash(data), start, start + length)
    by = np.lexsort((value, run[who]))
    who, value, off = who[by], value[by], (hi[who] - nth)[by]
    same = np.flatnonzero((value[1:] == value[:-1]) & (run[who[1:]] == run[who[:-1]]) & (off[1:] == off[:-1]))
    # confirm on bytes: how far the two suffixes agree to the left and to the right
    pair, back = np.unique(who[same] * len(context) + who[same + 1], return_inverse=True)
    a, b = pair // max(1, len(context)), pair % max(1, len(context))
    left = _agreement(data, (base + hi)[a], (base + hi)[b], np.minimum(hi[a], hi[b]), -1)
    right = _agreement(data, (base + hi)[a], (base + hi)[b], np.minimum((size - hi)[a], (size - hi)[b]), 1)
    true = same[(left[back] >= off[same]) & (right[back] >= length - off[same])]
    hit = np.zeros(len(who), bool)
    hit[true] = True
    hit[true + 1] = True
    return who[hit], off[hit]


def covered_spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) covered by windows at the (distinct or not) starts."""
    s = np.unique(starts)
    if not len(s):
        return s, s
    fresh = np.concatenate([[True], s[1:] > s[:-1] + length])
    return s[fresh], s[np.concatenate([np.flatnonzero(fresh)[1:], [len(s)]]) - 1] + length


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id_col, text (remaining bytes, binary),
    n_bytes, n_removed, n_spans, kept_sha256. ``length`` is even, from 16 to
    16,000; a remaining text may be cut inside a character, so it is binary."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark, "suffixes")
    half = length // 2
    texts = docs.select(F.col(id_col).alias("given"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    given_type, id_type = dict(texts.dtypes)["given"], "binary"
    # the key of a row: hashes skip nulls, so a null id is hashed as such
    hashes = [F.lpad(F.hex(F.xxhash64(F.lit(k), F.col("given").isNull(), "given", "text")), 16, "0") for k in (1, 2)]
    texts = texts.select(F.unhex(F.concat(*hashes)).alias("id"), "given", "text")

    def read(batches):
        for batch in batches:
            data, off = text_array(batch.column(1))
            blobs = []
            for a, b in runs(off):
                doc, rec = suffixes(data[off[a]:off[b]], off[a:b + 1] - off[a], length)
                cuts = np.searchsorted(doc, np.arange(b - a + 1))
                blobs += [rec[cuts[i]:cuts[i + 1]].tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3),
                                              pa.array(np.diff(off)), pa.array(blobs, pa.binary()), batch.column(4)],
                                             names=["id", "t1", "t2", "n", "suffixes", "sha"])

    texts.select("id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"),
                 F.sha2(F.col("text").cast("binary"), 256).alias("sha")) \
         .mapInArrow(read, f"id {id_type}, t1 long, t2 long, n long, suffixes binary, sha string").write.parquet(f"{folder}/read")
    table = spark.read.parquet(f"{folder}/read")
    same = table.groupBy("t1", "t2", "n").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    table.join(same.select("id", "copies"), "id").filter(F.length("suffixes") > 0) \
         .dropDuplicates(["id"]).select("id", "copies", "suffixes").write.parquet(f"{folder}/texts")
    one = spark.read.parquet(f"{folder}/texts")

    def halves(batches):
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), SUFFIX) for x in batch.column(1)]
            rec = np.concatenate(parts) if parts else np.zeros(0, SUFFIX)
            which = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            ids = batch.column(0)
            # windows with an offset of at most half are decided by the right half, others by the left
            for side, use in (("right", rec["lo"] <= half), ("left", rec["hi"] > half)):
                r = rec[use]
                low = r["lo"] if side == "right" else np.maximum(r["lo"], half + 1)
                high = np.minimum(r["hi"], half) if side == "right" else r["hi"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(r[side]), ids.take(pa.array(which[use])), pa.array(r["pos"].astype(np.int32)),
                    pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16))],
                    names=["half", "id", "pos", "lo", "hi"])

    half_rows = one.select("id", "suffixes").mapInArrow(halves, f"half long, id {id_type}, pos int, lo short, hi short")
    # stored, so that Spark can split the other side of the join
    often = cut(half_rows.groupBy("half").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"))
    suspect = half_rows.join(often, "half").groupBy("id").agg(
        F.collect_set(F.struct("pos", "lo", "hi", (F.col("times") > hot).alias("hot"))).alias("at"))
    suspect.join(texts, "id").select("id", "text", "at", "given").write.parquet(f"{folder}/suspects")
    suspects = spark.read.parquet(f"{folder}/suspects")

    def contexts(batches, want_hot):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                at = sorted((a["pos"], a["lo"], a["hi"]) for a in batch.column(2)[i].as_py() if a["hot"] == want_hot)
                if not at:
                    continue
                merged = [list(at[0])]              # both halves of one suffix together
                for p, lo, hi in at[1:]:
                    if p == merged[-1][0] and lo == merged[-1][2] + 1:
                        merged[-1][2] = hi
                    else:
                        merged.append([p, lo, hi])
                yield batch.column(0)[i].as_py(), raw, merged

    def cold(batches):
        for key, raw, at in contexts(batches, False):
            yield pa.RecordBatch.from_arrays([
                pa.array([raw[p:p + min(GRAM, half)] for p, _, _ in at], pa.binary()),
                pa.array([key] * len(at)), *(pa.array([a[k] for a in at], pa.int32()) for k in range(3)),
                pa.array([raw[p - hi:p - lo + length] for p, lo, hi in at], pa.binary())],
                names=["lead", "id", "pos", "lo", "hi", "context"])

    def bucket(batches):
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        gram = len(rows.column("lead")[0].as_py()) // 8 * 8
        raw = b"".join(x.as_py()[:gram] for x in rows.column("lead"))
        order, cuts = sorted_runs(np.frombuffer(raw, np.uint8).reshape(-1, gram))
        a = 0
        while a < len(cuts) - 1:                     # a few thousand suffixes at a time, whole runs
            b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + 2000, "right")) - 1)
            run = np.repeat(np.arange(b - a), np.diff(cuts[a:b + 1]))
            part = rows.take(pa.array(order[cuts[a]:cuts[b]]))
            lo, hi, pos = (part.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi", "pos"))
            who, d = repeated_windows(part.column("context").to_pylist(), lo, hi, run, length)
            yield from spans_of(part.column("id").take(pa.array(who)), pos[who] - d)
            a = b

    def spans_of(ids, starts):
        """One row per document: merged spans of the windows found here."""
        if not len(starts):
            return
        table = pa.table({"id": ids, "start": starts}).sort_by([("id", "ascending")]).combine_chunks()
        names, starts = table.column("id").chunk(0), table.column("start").to_numpy()
        code = names.dictionary_encode().indices.to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1, [len(code)]])
        out = [covered_spans(starts[a:b], length) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        number = np.repeat(cuts[:-1], [len(x) for x, _ in out])
        yield pa.RecordBatch.from_arrays([
            names.take(pa.array(number)), pa.array(np.concatenate([x for x, _ in out]).astype(np.int64)),
            pa.array(np.concatenate([y for _, y in out]).astype(np.int64))], names=["id", "begin", "end"])

    span_type = f"id {id_type}, begin long, end long"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = suspects.mapInArrow(cold, f"lead binary, id {id_type}, pos int, lo int, hi int, context binary") \
                    .repartitionByRange(parts, "lead").mapInArrow(bucket, span_type)

    def exploded(batches):
        for key, raw, at in contexts(batches, True):
            prefix = prefix_hash(np.frombuffer(raw, np.uint8))
            start = np.concatenate([np.arange(p - hi, p - lo + 1) for p, lo, hi in at])
            w = span_hash(prefix, start, start + length)
            tail = span_hash(prefix, start + 1, start + length - 1)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(mix64(tail).view(np.int64)),
                                              pa.array([key] * len(start)), pa.array(start)],
                                             names=["w1", "w2", "id", "begin"])

    window = suspects.mapInArrow(exploded, f"w1 long, w2 long, id {id_type}, begin long")
    twice = window.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("w1", "w2")
    hot_spans = window.join(twice, ["w1", "w2"], "left_semi").select("id", "begin", (F.col("begin") + length).alias("end"))
    spans = cut(found.unionByName(hot_spans).groupBy("id").agg(F.collect_set(F.struct("begin", "end")).alias("spans")))

    def erase(batches):
        for batch in batches:
            texts_, removed, count, sha = [], [], [], []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                kept, at, n = [], 0, 0
                for begin, end in sorted((s["begin"], s["end"]) for s in batch.column(2)[i].as_py() or ()):
                    if begin > at or n == 0:
                        kept.append(raw[at:begin])
                        n += 1
                    at = max(at, end)
                kept.append(raw[at:])
                rest = b"".join(kept)
                texts_.append(rest)
                removed.append(len(raw) - len(rest))
                count.append(n)
                sha.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(texts_, pa.binary()), pa.array([r + len(t) for r, t in zip(removed, texts_, strict=True)], pa.int64()),
                pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha)],
                names=["id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    # texts with spans, then all others; a text of several copies is gone as a whole
    info = table.join(same.select("t1", "t2", "n", "copies"), ["t1", "t2", "n"]) \
                .select("id", "n", "copies", "sha").dropDuplicates(["id"])
    gone = (F.col("copies") > 1) & (F.col("n") >= length)
    cut_texts = suspects.join(spans, "id").join(info.filter(~gone).select("id"), "id", "left_semi") \
                        .select(F.col("given").alias("id"), "text", "spans").mapInArrow(
        erase, f"id {given_type}, text binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    rest = texts.join(info, "id").join(spans.select("id", F.lit(True).alias("cut")), "id", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    plain = rest.filter(F.col("cut").isNull() | gone).select(
        F.col("given").alias("id"), F.when(gone, F.lit(b"")).otherwise(F.col("text").cast("binary")).alias("text"), F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        gone.cast("long").alias("n_spans"), F.when(gone, F.lit(nothing)).otherwise(F.col("sha")).alias("kept_sha256"))
    return cut_texts.unionByName(plain).withColumnRenamed("id", id_col)
