"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct 5-word shingles (A-Z lower-cased). The
shingle hashes fall into ``BUCKETS`` buckets; of each bucket's smallest hash a
16-bit register keeps the count of leading zeros (6 bits) and the next 10
mantissa bits. Empty buckets borrow the next filled one for banding only.

1. Documents with equal sets (128-bit fingerprint) collapse to one
   representative, the smallest id.
2. Bands of ``ROWS`` registers are hashed; in every band bucket each
   representative is paired with the bucket's centre, the member whose buckets
   are the fullest: the text that a group of copies was made from, if it is
   there. As many pairs as rows, whatever the bucket's size.
3. The Jaccard similarity of each pair is estimated from its registers, less
   the expected share of accidental register matches; pairs far below the
   threshold (five standard errors) stop here.
4. The rest is confirmed on full sets. Connected components follow.
5. The exact rest: members that share a centre but lie in different components
   are compared with each other, first by estimate, then (only those with a
   promising partner) on full sets. Groups are cut into blocks of at most
   ``GROUP_DOCS`` documents and ``GROUP_SHINGLES`` shingles, and every two
   blocks meet in one task, so no link of a bucket is lost and no group comes
   to one task. A task returns one link per document and other component, not
   pairs.

With 26 bands of 6 rows a pair of similarity 0.85 meets in some bucket with
probability 0.999995.

Scale: shuffles carry 16 to 24 bytes per band and document, 312 register bytes
per document, and sets only of documents in a candidate pair. The ids of these
are broadcast while they are at most ``BROADCAST_IDS``, and joined by shuffle
beyond. Hot buckets combine map-side (size, centre) and join back on the key.

Defined cases: a text without words has the empty set, is linked with nothing
and is kept. A row without an id is linked with nothing and kept, with null
counts. Rows that repeat an id share its result: one row each. Extra columns are carried along; output columns
replace input columns of the same name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import BYTE_LOWER, mix64, prefix_hash, runs, span_hash, text_array, words
from .common import cut, lean, lean_group, shared_folder, ship
from .components import components

SHINGLE = 5
ROWS, BANDS = 6, 26
BUCKETS = ROWS * BANDS
MANTISSA = 10
EMPTY = 0xFFFF
GROUP_DOCS, GROUP_SHINGLES = 2000, 1_000_000
BROADCAST_IDS = 1_000_000
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SALT = np.random.default_rng(7).integers(1, 2**63, BUCKETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, off = text_array(column)
    out: list[np.ndarray] = []
    for a, b in runs(off):
        part, o = data[off[a]:off[b]], off[a:b + 1] - off[a]
        start, end, count = words(part, o)
        w = span_hash(prefix_hash(part, BYTE_LOWER), start, end) if len(start) else np.zeros(0, np.uint64)
        s = np.zeros(max(0, len(w) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            s = s * _STEP + w[k:k + len(s)]
        s = mix64(s)
        at = np.concatenate([[0], np.cumsum(count)])
        for i in range(b - a):
            n = int(count[i])
            if n >= SHINGLE:
                out.append(np.unique(s[at[i]:at[i + 1] - SHINGLE + 1]))
            elif n:
                whole = np.array([n], np.uint64)
                for x in w[at[i]:at[i + 1]]:
                    whole = mix64(whole * _STEP + x)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, BUCKETS) uint16: leading zeros << 10 | mantissa of each bucket's smallest hash."""
    least = np.full(len(sets) * BUCKETS, np.uint64(2**64 - 1))
    if sets and (flat := np.concatenate(sets)).size:
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        bucket = ((flat >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
        np.minimum.at(least, doc * BUCKETS + bucket.astype(np.int64), mix64(flat ^ _STEP) >> np.uint64(1))
    empty = least == np.uint64(2**64 - 1)
    _, e = np.frexp((least >> np.uint64(10)).astype(np.float64))  # 53 bits: exact
    zeros = np.clip(53 - e, 0, 52)
    mantissa = (least << (zeros + 2).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out = ((zeros << MANTISSA) | mantissa.astype(np.int64)).astype(np.uint16)
    out[empty] = EMPTY
    return out.reshape(-1, BUCKETS)


def bands(reg: np.ndarray) -> np.ndarray:
    """(documents, BANDS) int64 keys of the registers, empty ones filled from the next to the right."""
    place = np.where(reg == EMPTY, 2 * BUCKETS, np.arange(BUCKETS))
    twice = np.concatenate([place, np.where(place < BUCKETS, place + BUCKETS, place)], axis=1)
    following = np.minimum.accumulate(twice[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS] % BUCKETS
    full = np.take_along_axis(reg, following, axis=1).astype(np.uint64)
    parts = mix64((full + np.uint64(1)) * _SALT).reshape(len(reg), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    return mix64(parts + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP).view(np.int64)


@lru_cache(4096)
def accidental(n_class: int, m_class: int) -> float:
    """Expected share of buckets whose registers match for disjoint sets with
    2 ** (class / 2) elements each: a match needs equal leading zeros and
    mantissa in both smallest hashes (zeros beyond 40 do not matter)."""
    n, m = 2 ** (n_class / 2) / BUCKETS, 2 ** (m_class / 2) / BUCKETS
    z = np.arange(0, 41)[:, None]
    j = np.arange(2 ** MANTISSA)[None, :]
    low = (2 ** MANTISSA + j) / 2.0 ** (MANTISSA + z + 1)
    high = (2 ** MANTISSA + j + 1) / 2.0 ** (MANTISSA + z + 1)
    # smallest of Poisson(n) uniform hashes in [low, high)
    p = (np.exp(-n * low) - np.exp(-n * high)) * (np.exp(-m * low) - np.exp(-m * high))
    return float(p.sum())


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows and its standard error at 0.85."""
    used = (a != EMPTY) | (b != EMPTY)
    total = np.maximum(used.sum(axis=1), 1)
    share = ((a == b) & used).sum(axis=1) / total
    cls = np.stack([np.round(2 * np.log2(np.maximum(x, 1))).astype(int) for x in (n, m)], axis=1)
    kinds, which = np.unique(cls, axis=0, return_inverse=True)
    by_chance = np.array([accidental(int(x), int(y)) for x, y in kinds])[which.ravel()] * BUCKETS / total
    by_chance = np.minimum(by_chance, 0.5)
    return (share - by_chance) / (1 - by_chance), np.sqrt(0.85 * 0.15 / total)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), f1 and f2 (fingerprint of the set), regs (binary)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = shingle_sets(part.column(1))
                regs = registers(sets)
                f1 = [int(s.sum(dtype=np.uint64)) for s in sets]
                f2 = [int(mix64(s + _STEP).sum(dtype=np.uint64)) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary())], names=["id", "n", "f1", "f2", "regs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
               .mapInArrow(lean(run), "id long, n long, f1 long, f2 long, regs binary")


def band_rows(sk: DataFrame) -> DataFrame:
    """(key, id): one row per band of every representative."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                raw = b"".join(x.as_py() for x in part.column(1))
                keys = bands(np.frombuffer(raw, np.uint16).reshape(-1, BUCKETS))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.ravel()),
                    pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS))], names=["key", "id"])

    return sk.select("id", "regs").mapInArrow(lean(run), "key long, id long")


def promising(pairs: DataFrame, sk: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and estimate allow the threshold."""
    left = sk.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = sk.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    both = pairs.join(left, "a").join(right, "b").filter(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = {k: batch.column(k) for k in ("a", "b", "na", "nb", "ra", "rb")}
            regs = [np.frombuffer(b"".join(x.as_py() for x in v[k]), np.uint16).reshape(-1, BUCKETS) for k in ("ra", "rb")]
            sizes = [v[k].to_numpy(zero_copy_only=False) for k in ("na", "nb")]
            j, err = estimate(*regs, *sizes)
            yield batch.select(["a", "b"]).filter(pa.array(j >= percent / 100 - 5 * err - 0.01))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(lean(run), "a long, b long")


def stored_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, set) of the documents named in ids, made from whole texts and stored once."""
    ids = cut(ids.distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    needed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")

    def make(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["id", "set"])

    needed.mapInArrow(lean(make), "id long, set binary").dropDuplicates(["id"]).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
                 .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                same = len(np.intersect1d(u, v, assume_unique=True))
                good.append(same > 0 and 100 * same >= percent * (len(u) + len(v) - same))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(lean(compare), "a long, b long")


def across(member: DataFrame, percent: int):
    """Group members with a promising partner in another component.
    member: centre, i, j (two blocks of a group), id, comp, n, regs.
    Returns (centre, i, j, id, comp)."""
    def run(key, table):
        comp, n = (table.column(c).to_numpy() for c in ("comp", "n"))
        regs = np.frombuffer(b"".join(x.as_py() for x in table.column("regs")), np.uint16).reshape(-1, BUCKETS)
        # the largest component needs no search among itself: all others look at everything
        names, size = np.unique(comp, return_counts=True)
        seekers = np.flatnonzero(comp != names[size.argmax()])
        hit = np.zeros(len(comp), bool)
        for x in seekers:
            fits = np.flatnonzero((comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])))
            if len(fits):
                j, err = estimate(np.broadcast_to(regs[x], (len(fits), BUCKETS)), regs[fits], np.full(len(fits), n[x]), n[fits])
                good = fits[j >= percent / 100 - 5 * err - 0.01]
                hit[good] = True
                hit[x] |= len(good) > 0
        return table.select(["centre", "i", "j", "id", "comp"]).filter(pa.array(hit))

    return member.groupBy("centre", "i", "j").applyInArrow(lean_group(run), "centre long, i int, j int, id long, comp long")


def links_across(member: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between components, one per document and other
    component. member: centre, i, j, id, comp, set."""
    def run(key, table):
        ids, comp = (table.column(c).to_numpy() for c in ("id", "comp"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        size = np.array([len(s) for s in sets])
        owner, flat = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        owner, flat = owner[order], flat[order]
        names, count = np.unique(comp, return_counts=True)
        a, b = [], []
        for x in np.flatnonzero(comp != names[count.argmax()]):
            lo, hi = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            same = np.bincount(owner[at], minlength=len(sets))
            good = np.flatnonzero((100 * same >= percent * (size + size[x] - same)) & (comp != comp[x]))
            _, first = np.unique(comp[good], return_index=True)
            a += [ids[x]] * len(first)
            b += ids[good[first]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return member.groupBy("centre", "i", "j").applyInArrow(lean_group(run), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    group_docs: int = GROUP_DOCS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """``docs`` without the text, plus n_shingles, component_id and kept."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark, "minhash")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    sk = stored(sketches(docs, id_col, text_col), "sketches").filter("id is not null")
    # equal sets: one representative, the smallest id
    alike = sk.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"))
    reps = stored(sk.filter("n > 0").join(alike.select(F.col("rep").alias("id")), "id", "left_semi")
                    .dropDuplicates(["id"]), "reps")
    rows = stored(band_rows(reps), "bands")

    # tables that hot keys are joined to are stored, so that Spark can split the other side
    filled = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "filled")
    shared = stored(rows.join(filled, "key"), "shared")
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    centre = stored(shared.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", "id"))["id"].alias("centre")),
                    "centres")
    member = cut(shared.join(centre, "key").select("centre", "id").distinct())
    pairs = member.filter("id <> centre").select(F.least("id", "centre").alias("a"),
                                                 F.greatest("id", "centre").alias("b")).distinct()
    pairs = cut(promising(pairs, reps, percent))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    links = cut(confirmed(pairs, stored_sets(ids, docs, id_col, text_col, f"{folder}/sets-1"), percent))
    comp = components(links)

    # the exact rest: groups of a centre that hold members outside its component
    facts = reps.select("id", "n", "regs").join(comp.withColumnRenamed("node", "id"), "id", "left") \
                .select("id", "n", "regs", F.coalesce("component", "id").alias("comp"))
    group = member.join(facts.select("id", "n", "comp"), "id")
    groups = group.groupBy("centre").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"),
                                         F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
                  .filter("lo <> hi and docs > 2")
    groups = cut(groups)
    blocks = F.greatest(F.ceil(F.col("docs") / group_docs), F.ceil(F.col("shingles") / group_shingles)).cast("int")
    group = group.select("centre", "id").join(groups.select("centre", blocks.alias("blocks")), "centre")
    mine = F.pmod(F.xxhash64("centre", "id"), F.col("blocks")).cast("int")
    # a document goes to every pair of blocks that holds its own
    group = group.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
                 .select("centre", "id", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    found = cut(across(group.join(facts, "id"), percent))
    if not found.isEmpty():
        sets = stored_sets(found.select("id"), docs, id_col, text_col, f"{folder}/sets-2")
        more = cut(links_across(found.join(sets, "id"), percent))
        comp = components(links.unionByName(more))

    made = ("n_shingles", "component_id", "kept")
    cols = [c for c in docs.columns if c not in made and c != text_col]
    of_rep = alike.join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
                  .select("f1", "f2", "n", F.coalesce("component", "rep").alias("component_id"))
    size = sk.dropDuplicates(["id"]).join(of_rep, ["f1", "f2", "n"], "left").select("id", "n", "component_id")
    out = docs.select(*cols).withColumn("__id", F.col(id_col).cast("long")).join(
        size.withColumnRenamed("id", "__id"), "__id", "left")
    comp_id = F.coalesce("component_id", "__id")
    return out.select(*cols, F.col("n").alias("n_shingles"), comp_id.alias("component_id"),
                      F.coalesce(comp_id == F.col("__id"), F.lit(True)).alias("kept"))
