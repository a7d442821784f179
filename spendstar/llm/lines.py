"""Line dedup: lines that many documents share are dropped everywhere.

Each text is split at ``\\n``; a line's key (white space stripped at both ends,
A-Z lower-cased) is hashed to 128 bits, distinct documents are counted per
hash, and lines whose hash reaches the threshold are removed by position. Only
hashes and positions are shuffled for the counting; the texts move once, to
meet the positions to drop.

Scale: a hot line is counted with map-side combine (first distinct per
document, then per line). The join back of the frequent keys is a plain
equi-join whose line side Spark may split. Documents are keyed by a 128-bit
hash of (doc_id, text), so copies of one text do not meet in one group.

Defined cases: a null or empty text is one empty line; the empty key is never
frequent. A null text stays null. Rows that repeat both doc_id and text count
as one document and all get the same result. Input columns named like an
output column (``n_lines``, ``n_dropped``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, cut


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the shared lines removed from ``text_col``, plus
    ``n_lines`` (before dropping) and ``n_dropped``, both long."""
    out_cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text, doc = F.col(text_col), F.col(id_col)
    # split once: the lines travel as an array, so that a kept line is read by its position
    keyed = docs.select(*[c for c in out_cols if c != text_col], F.split(text, "\n", -1).alias("__lines"),
                        F.xxhash64(doc, text).alias("__d1"), F.xxhash64(F.lit(7), doc, text).alias("__d2"))

    # the hashes are made before the lines are exploded, not once per line
    line = keyed.select("__d1", "__d2", "__lines").select("__d1", "__d2", F.posexplode_outer("__lines").alias("__pos", "__line"))
    line = line.withColumn("__key", ascii_lower(F.btrim("__line", F.lit(SPACE)))) \
               .filter(F.char_length("__key") >= max(1, min_chars)) \
               .select("__d1", "__d2", "__pos", F.xxhash64("__key").alias("__k1"),
                       F.xxhash64(F.lit(7), "__key").alias("__k2"))
    frequent = (line.select("__k1", "__k2", "__d1", "__d2").distinct()
                    .groupBy("__k1", "__k2").agg(F.count(F.lit(1)).alias("__n"))
                    .filter(F.col("__n") >= min_docs).select("__k1", "__k2"))
    frequent = cut(frequent)  # a stored table: Spark can split the lines' side of the join
    drops = (line.join(frequent, ["__k1", "__k2"], "left_semi")
                 .groupBy("__d1", "__d2").agg(F.collect_set("__pos").alias("__drop")))

    kept = F.col("__kept")
    out = keyed.join(drops, ["__d1", "__d2"], "left") \
               .withColumn("__n", F.when(F.col("__lines").isNull(), 1).otherwise(F.size("__lines")))
    out = out.withColumn("__kept", F.when(F.col("__drop").isNotNull(), F.array_except(
        F.sequence(F.lit(0), F.col("__n") - 1), F.col("__drop"))))
    rest = F.when(kept.isNull(), F.col("__lines")).otherwise(F.transform(kept, lambda i: F.get("__lines", i)))
    gone = F.when(kept.isNull(), F.lit(0)).otherwise(F.col("__n") - F.size(kept))
    return out.select(*[F.array_join(rest, "\n").alias(c) if c == text_col else F.col(c) for c in out_cols],
                      F.col("__n").cast("long").alias("n_lines"), gone.cast("long").alias("n_dropped"))
