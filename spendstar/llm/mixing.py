"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; every document of a source is
expected target / source_size times (at most ``max_repeats``). The documents of
a source stand in one fixed order; the prefix sum of the expected copies gets
one random offset per source, and a document is emitted once for every integer
boundary that its own share crosses.

Order: by size class (three leading bits under the top bit of the size), then
by a hash slot, then by size and doc_id. Neighbours have nearly the same size,
so the words taken stay within about one document of the target.

Scale: no window spans a source. A size class with n documents is cut into
ceil(sqrt(n)) hash slots; documents are ranked inside one slot and slots are
summed per source, so neither window grows faster than the square root of a
source. All expected copies of a source are equal, so the prefix sum is rank
times rate: exact, whatever the number of tasks. The class table (sources x
about 8 classes per doubling of the size) is stored once and broadcast only if
it has at most ``BROADCAST_ROWS`` rows; beyond that it is joined by shuffle.

Defined cases: null is a source of its own, last in the order; a null text has
size 0; documents of size 0 take part in the order and give no words; if all
sizes are 0 nothing is taken. Repeated rows are separate documents. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, md5_number, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20
BROADCAST_ROWS = 100_000
MADE = ("size", "source_size", "target", "copies", "taken")


def size_class(size: Column) -> Column:
    """16 x the number of bits + the four leading bits: sizes in one class differ by an eighth at most."""
    bits = F.bin(size)
    return (F.length(bits) * 16 + F.conv(F.substring(F.rpad(bits, 4, "0"), 1, 4), 2, 10).cast("int")).cast("int")


def targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (__src, __size) with __target: the total is shared by weight;
    a target stops at max_repeats x size and its excess is reshared. Sources
    sorted by cap / weight saturate in that order, so one running sum finds the
    level. One row per distinct source."""
    w = Window.orderBy(F.col("__src").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sources.withColumn("__w", weight).withColumn("__cap", F.lit(float(max_repeats)) * F.col("__size"))
    t = t.withColumn("__ratio", F.col("__cap") / F.col("__w"))
    up = Window.orderBy("__ratio", F.col("__src").asc_nulls_last())
    everything = Window.partitionBy()
    t = t.withColumns({
        "__all": F.sum("__size").over(everything),
        "__full": F.coalesce(F.sum("__cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "__rest": F.sum("__w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    t = t.withColumn("__level", (F.col("__all") - F.col("__full")) / F.col("__rest"))
    # the level rises while sources saturate and falls after: its maximum is the true one
    t = t.withColumn("__level", F.max("__level").over(everything))
    return t.withColumn("__target", F.when(F.col("__ratio") < F.col("__level"), F.col("__cap"))
                        .otherwise(F.least(F.col("__w") * F.col("__level"), F.col("__cap")))) \
            .select("__src", F.col("__size").alias("__ssize"), "__target")


def with_copies(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` plus size, source_size, target, copies and taken (= copies x size)."""
    cols = [c for c in docs.columns if c not in MADE]
    sized = docs.select(*cols, word_count(F.col(text_col)).alias("size"), F.col(source_col).alias("__src"))
    sized = sized.withColumn("__class", size_class(F.col("size")))
    classes = sized.groupBy("__src", "__class").agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__sum"))
    classes = cut(classes)
    goal = targets(classes.groupBy("__src").agg(F.sum("__sum").cast("long").alias("__size")), weights, max_repeats)
    plan = classes.alias("c").join(goal.alias("g"), F.col("c.__src").eqNullSafe(F.col("g.__src"))).select(
        F.col("c.__src").alias("__psrc"), F.col("__class").alias("__pclass"), "__ssize", "__target",
        F.ceil(F.sqrt("__n")).cast("long").alias("__slots"))
    if classes.count() <= broadcast_rows:
        plan = F.broadcast(plan)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    placed = (sized.join(plan, F.col("__src").eqNullSafe(F.col("__psrc")) & (F.col("__class") == F.col("__pclass")))
                   .drop("__psrc", "__pclass")
                   .withColumn("__slot", F.pmod(md5_number(key), F.col("__slots"))))
    cell = ["__src", "__class", "__slot"]
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("size", id_col, F.xxhash64(F.col(text_col))))
    before = F.sum("__m").over(Window.partitionBy("__src").orderBy("__class", "__slot")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__m")
    cells = (placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("__m")).withColumn("__before", before).drop("__m")
                   .select(*[F.col(c).alias(c + "2") for c in cell], "__before"))
    out = placed.withColumn("__rank", inside).join(
        cells, F.col("__src").eqNullSafe(F.col("__src2")) & (F.col("__class") == F.col("__class2"))
        & (F.col("__slot") == F.col("__slot2")))
    rate = F.when(F.col("__ssize") > 0, F.col("__target") / F.col("__ssize")).otherwise(F.lit(0.0))
    name = F.when(F.col("__src").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("__src").cast("string")))
    offset = md5_number(F.concat(F.lit(f"{seed}|"), name)) / F.lit(4294967296.0)
    place = F.col("__before") + F.col("__rank")
    copies = (F.floor(rate * place + offset) - F.floor(rate * (place - 1) + offset)).cast("long")
    copies = F.least(copies, F.lit(max_repeats).cast("long"))  # only rounding of a rate at the limit could exceed it
    return out.withColumn("copies", copies).select(
        *cols, F.col("size"), F.col("__ssize").alias("source_size"), F.col("__target").alias("target"), "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it has copies."""
    out = with_copies(docs, **options)
    cols = [c for c in docs.columns if c not in MADE]
    return out.filter("copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*cols)
