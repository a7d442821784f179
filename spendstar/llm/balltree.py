"""Exact top-k inner products by ball trees, one per shard of the vectors.

Vectors are hashed into shards of about ``SHARD_ROWS`` rows; one task builds a
balanced ball tree per shard (center and radius by node). Queries travel in
blocks, each with its current k best. A block meets the shards in rounds of 1,
2, 4, ... shards; between rounds its partial results are merged, so the current
kth score of every query is shared with all later shards. Inside a shard, a
node is skipped if its upper bound (query . center + |query| x radius) is below
the kth score, and the leaves left are read by falling bound, with the kth
score tested again before each.

Scores are exact integers: products run in floating point only where every
partial sum is below 2**53, in 64-bit integers below 2**62, else in Python's
integers.

Scale: every task holds one tree and at most ``CHUNK`` blocks of queries; the
number of rounds is the logarithm of the number of shards.

Defined cases: a vector that is null, empty or holds a null or non-finite
component takes no part; vectors meet only vectors of their own length;
repeated rows (same id and vector) count once; an item with the query's id is
never its neighbour; ties go to the smaller id. A scaled component or a score
of 2**62 or more in size does not fit the result: the query stops with an error
that says so. Fewer than k candidates: all of them.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_folder, ship

SHARD_ROWS = 8192
LEAF = 128
BLOCK = 512
CHUNK = 32
NO_ID = np.iinfo(np.int64).max
LIMIT = 2**62
NO_SCORE = -LIMIT


def packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as f:
        return {k: f[k] for k in f.files}


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A balanced tree: rows in leaf order, node bounds by level (level l has
    2**l nodes), centers and radii. Splits are at the median along the line
    between two far rows."""
    n = len(ids)
    order, v = np.arange(n), vectors.astype(np.float64)
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
    cuts = [np.array([0, n])]
    for _ in range(depth):
        inner = []
        for a, b in zip(cuts[-1][:-1], cuts[-1][1:], strict=True):
            part = order[a:b]
            x = v[part]
            if len(part) > 1:
                one = x[((x - x[0]) ** 2).sum(axis=1).argmax()]
                two = x[((x - one) ** 2).sum(axis=1).argmax()]
                order[a:b] = part[np.argsort(x @ (one - two), kind="stable")]
            inner += [a, (a + b) // 2]
        cuts.append(np.array([*inner, n]))
    v = v[order]
    centers, radii = [], []
    for c in cuts:
        for a, b in zip(c[:-1], c[1:], strict=True):
            mid = v[a:b].mean(axis=0) if b > a else np.zeros(v.shape[1])
            centers.append(mid)
            radii.append(np.sqrt(((v[a:b] - mid) ** 2).sum(axis=1).max()) if b > a else 0.0)
    small = np.abs(vectors).max(initial=0) < 2**31
    return {"ids": ids[order], "vectors": vectors[order].astype(np.int32 if small else np.int64), "bounds": cuts[-1],
            "centers": np.array(centers), "radii": np.array(radii)}


def products(q: np.ndarray, v: np.ndarray, skip: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products of integer rows; pairs of no interest (``skip``) may have any value."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if top < LIMIT:
        return q.astype(np.int64) @ v.T.astype(np.int64)
    exact = q.astype(object) @ v.T.astype(object)
    if skip is not None:
        exact[skip] = 0
    if any(abs(x) >= LIMIT for x in exact.ravel()):
        raise OverflowError("an inner product does not fit 62 bits")
    return exact.astype(np.int64)


def _better(scores, ids, k):
    """The k best of one query, by falling score, then id."""
    best = np.lexsort((ids, -scores))[:k]
    return scores[best], ids[best]


def search(tree: dict, own: np.ndarray, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Improve the k best (scores, ids: one row per query, in place) with the tree's rows."""
    k = scores.shape[1]
    leaves = len(tree["bounds"]) - 1
    depth = leaves.bit_length() - 1
    length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None]
    far = np.sqrt((tree["centers"] ** 2).sum(axis=1)) + tree["radii"]
    bound = q.astype(np.float64) @ tree["centers"].T + length * tree["radii"]
    bound += 1e-12 * length * far + 1e-9 * np.abs(bound) + 1e-6        # bounds round, scores do not
    alive = np.ones((len(q), 1), bool)
    for level in range(depth + 1):              # branch and bound from the root
        nodes = slice((1 << level) - 1, (1 << (level + 1)) - 1)
        alive = (np.repeat(alive, 2, axis=1) if level else alive) & (bound[:, nodes] >= scores[:, -1:])
    leaf_bound = np.where(alive, bound[:, (1 << depth) - 1:], -np.inf)
    rank = np.argsort(-leaf_bound, axis=1, kind="stable")
    for nth in range(leaves):
        leaf = rank[:, nth]
        mine = leaf_bound[np.arange(len(q)), leaf]
        go = np.flatnonzero((mine > -np.inf) & (mine >= scores[:, -1]))
        if not len(go):
            break                               # bounds fall: no later leaf can help
        for one in np.unique(leaf[go]):
            rows = go[leaf[go] == one]
            a, b = tree["bounds"][one], tree["bounds"][one + 1]
            names = tree["ids"][a:b]
            itself = names == own[rows][:, None]
            got = products(q[rows], tree["vectors"][a:b], itself)
            last, last_id = scores[rows, -1][:, None], ids[rows, -1][:, None]
            good = ((got > last) | ((got == last) & (names < last_id))) & ~itself
            for i in np.flatnonzero(good.any(axis=1)):
                r = rows[i]
                scores[r], ids[r] = _better(np.concatenate([scores[r], got[i, good[i]]]),
                                            np.concatenate([ids[r], names[good[i]]]), k)


def _rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    return ids, flat.reshape(len(ids), -1)


def scaled(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, v (integers floor(scale x)), dim; only whole, finite vectors, repeated rows once."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    too_large = F.raise_error(F.lit("a scaled vector component does not fit 62 bits")).cast("long")

    def whole(x):
        y = F.floor(F.lit(scale) * x)
        return F.when(F.abs(F.lit(scale) * x) < F.lit(float(LIMIT)), y.cast("long")).otherwise(too_large)

    return (rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ok)
                .select(F.col(id_col).cast("long").alias("id"),
                        F.transform(v, whole).alias("v"),
                        F.size(vector_col).alias("dim"))
                .dropDuplicates(["id", "v"]))


def top_k(items: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score."""
    spark = items.sparkSession
    ship(spark)
    folder = shared_folder(spark, "balltree")
    scaled(items, id_col, vector_col, scale).write.parquet(f"{folder}/items")
    rows = spark.read.parquet(f"{folder}/items")
    asked = cut(scaled(queries, id_col, vector_col, scale))
    n_rows, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_asked // block))
    chunks = -(-blocks // CHUNK)

    def make_tree(key, table):
        return pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()], "tree": [packed(**build(*_rows_of(table)))]},
                        schema=pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("tree", pa.binary())]))

    def make_block(key, table):
        ids, q = _rows_of(table)
        order = np.argsort(ids, kind="stable")
        blob = packed(own=ids[order], q=q[order], scores=np.full((len(ids), k), NO_SCORE), ids=np.full((len(ids), k), NO_ID))
        return pa.table({"dim": [key[0].as_py()], "block": [key[1].as_py()], "state": [blob]},
                        schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("state", pa.binary())]))

    def number(n, salt):
        return F.pmod(F.xxhash64(F.lit(salt), F.col("id")), F.lit(n)).cast("long")

    rows.withColumn("shard", number(shards, 1)).groupBy("dim", "shard") \
        .applyInArrow(make_tree, "dim int, shard long, tree binary").write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    state = cut(asked.withColumn("block", number(blocks, 2)).groupBy("dim", "block")
                     .applyInArrow(make_block, "dim int, block long, state binary"))

    def visit(left, right):
        if not left.num_rows or not right.num_rows:
            return right.select(["dim", "block", "state"])
        tree = unpacked(left.column("tree")[0].as_py())
        out = []
        for blob in right.column("state"):
            s = unpacked(blob.as_py())
            search(tree, s["own"], s["q"], s["scores"], s["ids"])
            out.append(packed(**s))
        return pa.table({"dim": right.column("dim"), "block": right.column("block"), "state": pa.array(out, pa.binary())})

    def merge(key, table):
        all_ = [unpacked(x.as_py()) for x in table.column("state")]
        first = all_[0]
        for i in range(len(first["own"])):
            pairs = np.unique(np.concatenate([np.stack([-s["scores"][i], s["ids"][i]], axis=1)
                                              for s in all_ if s["scores"][i][0] != NO_SCORE] or
                                             [np.zeros((0, 2), np.int64)]), axis=0)[:k]
            pairs = pairs[pairs[:, 1] != NO_ID]
            first["scores"][i, :len(pairs)], first["ids"][i, :len(pairs)] = -pairs[:, 0], pairs[:, 1]
        return pa.table({"dim": [key[0].as_py()], "block": [key[1].as_py()], "state": [packed(**first)]},
                        schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("state", pa.binary())]))

    done, width = 0, 1
    while done < shards:
        width = min(width, shards - done)
        steps = F.sequence(F.lit(done).cast("long"), F.lit(done + width - 1).cast("long"))
        going = (state.withColumn("step", F.explode(steps))
                      .withColumn("shard", F.pmod(F.col("block") + F.col("step"), F.lit(shards)))
                      .withColumn("chunk", F.pmod(F.floor(F.col("block") / CHUNK), F.lit(chunks))))
        spread = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
        # of a round, only the shards that some block of the chunk visits
        need = going.select("dim", "shard", "chunk").distinct()
        spread = spread.join(need, ["dim", "shard", "chunk"], "left_semi")
        met = spread.groupBy("dim", "shard", "chunk").cogroup(going.groupBy("dim", "shard", "chunk")) \
                    .applyInArrow(visit, "dim int, block long, state binary")
        state = cut(met.groupBy("dim", "block").applyInArrow(merge, "dim int, block long, state binary"))
        done, width = done + width, width * 2

    def unfold(batches):
        for batch in batches:
            for blob in batch.column(0):
                s = unpacked(blob.as_py())
                n, width_ = s["scores"].shape
                found = (s["ids"] != NO_ID).ravel()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(s["own"], width_)[found]), pa.array(np.tile(np.arange(1, width_ + 1, dtype=np.int32), n)[found]),
                    pa.array(s["ids"].ravel()[found]), pa.array(s["scores"].ravel()[found])],
                    names=["query_id", "rank", "vec_id", "score"])

    return state.select("state").mapInArrow(unfold, "query_id long, rank int, vec_id long, score long")
