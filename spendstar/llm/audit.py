"""Filter interaction audit: what every order of a set of filters removes, from the subset lattice.

A set of n filters has n! orders, but a document only knows which filters it
fails. So documents are first counted by part and failure mask (a bit per
filter). The states of the audit are the 2**n sets of filters already applied;
an edge (state, filter) applies one more filter. An edge removes the documents
whose mask misses the state and holds the filter.

1. ``lattice`` counts paths: forward, the orders that reach a state, and
   backward, the orders that lead on from it to all filters.
2. ``edge_counts`` gives each part's removed documents (and the measures among
   them) of every edge: a mask contributes to the edges that it makes remove.
3. ``shapley`` weighs each edge by forward(state) x backward(next state) and
   sums per filter: the removals over all n! orders.
4. ``by_order`` walks the orders over the same edges: removed here, kept so far
   (a running difference) and, by subtraction from the filter's failures, the
   ones that an earlier filter had removed.

Scale: the documents are read once; what is shuffled is one row per part, mask
and task. The lattice, at most ``MAX_FILTERS`` filters or 2,048 edges, and the
orders, at most ``MAX_ORDERED`` filters or 4,320 steps, do not depend on the
data and are the only tables that are broadcast.

Defined cases: a null mask bit passes its filter; a null part is the empty
string; a part without removals has all its rows, with zeros; an empty table
has no parts and gives no rows. Measures that are null count as 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut

MAX_FILTERS, MAX_ORDERED = 8, 6


def lattice(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state (a set of filters as bits), and orders that lead on from it."""
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def edges(spark: SparkSession, n: int) -> DataFrame:
    """(state, filter, orders): every edge and the orders that go through it."""
    if not 0 < n <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {n}")
    forward, backward = lattice(n)
    rows = [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]
    return spark.createDataFrame(rows, "state int, filter int, orders long")


def order_steps(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(filter_order, step, state, filter): the edges that every order takes."""
    if not 0 < len(names) <= MAX_ORDERED:
        raise ValueError(f"the steps of 1 to {MAX_ORDERED} filters can be listed, not of {len(names)}")
    rows = []
    for order in permutations(range(len(names))):
        state, name = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            rows.append((name, step, state, f))
            state |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")


def failure_mask(conditions: Sequence[Column]) -> Column:
    """Failure conditions as bits of one int; a null condition does not fail."""
    mask = F.lit(0)
    for f, failed in enumerate(conditions):
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << f)).otherwise(F.lit(0)))
    return mask.cast("int")


def cells(docs: DataFrame, mask: Column, part: Column, n: Column | None = None, **measures: Column) -> DataFrame:
    """(part, mask, n, measures...): documents counted by part and failure mask;
    ``n``: how many documents a row stands for, ``measures``: numbers to sum."""
    sums = {"n": F.lit(1) if n is None else n, **measures}
    return docs.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                       *[F.coalesce(c.cast("long"), F.lit(0)).alias(k) for k, c in sums.items()]) \
               .groupBy("part", "mask").agg(*[F.sum(k).alias(k) for k in sums])


def edge_counts(cells: DataFrame, n: int, measures: Sequence[str] = ()) -> DataFrame:
    """(part, state, filter, orders, removed, measures...) of every part and
    edge, and of the part: total; of the filter: failing and unique_fails."""
    spark = cells.sparkSession
    of = edges(spark, n)
    # a cell meets the edges of all states as one array, as long as the lattice
    of_all = F.expr("sequence(0, %d)" % ((1 << n) - 1))
    each = cells.select("*", F.explode(of_all).alias("state")) \
                .select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("filter")) \
                .withColumn("bit", F.expr("shiftleft(1, filter)")) \
                .filter(F.col("state").bitwiseAND(F.col("bit")) == 0)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    here = fails & (F.col("mask").bitwiseAND(F.col("state")) == 0)
    sums = [F.sum(F.when(here, F.col(k)).otherwise(0)).alias(name)
            for k, name in [("n", "removed"), *[(m, m) for m in measures]]]
    return each.groupBy("part", "state", "filter").agg(
        *sums, F.sum("n").alias("total"), F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails")) \
        .join(F.broadcast(of), ["state", "filter"])


def shapley(counts: DataFrame) -> DataFrame:
    """(part, filter, shapley): a filter's removals summed over all orders."""
    return counts.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))


def by_order(counts: DataFrame, names: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """One row per part, order and step: filter_order, step, kept, removed,
    redundant, unique_fails, measures (among the removed) and shapley."""
    spark = counts.sparkSession
    steps = counts.join(F.broadcast(order_steps(spark, names)), ["state", "filter"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")      # one row per filter
    # the value of a filter is a sum over its edges, which every part has
    weighed = shapley(counts)
    return steps.join(weighed, ["part", "filter"]).select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", *measures, "shapley")


def text_key(text: Column) -> list[Column]:
    """A 128-bit hash of a text, in columns h1 and h2; a null text is the empty one."""
    known = F.coalesce(text, F.lit(""))
    return [F.xxhash64(known).alias("h1"), F.xxhash64(F.lit(7), known).alias("h2")]


def later_copies(rows: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows with a ``text_key`` (h1, h2) counted by ``keys`` and by ``copy``:
    whether a smaller id has the same text, anywhere in the table. A row without
    an id is no copy and makes none.

    Rows are counted by id first, then by keys, both with map-side combine, so
    that neither a text nor an id that holds a third of the table meets in one
    task; the counts and the smallest id of every text that has more than one
    row are stored, so that Spark may split the join."""
    rows = rows.select(F.col(id_col).alias("__id"), *keys, "h1", "h2")
    rows = rows.groupBy("h1", "h2", "__id", *keys).agg(F.count(F.lit(1)).alias("__n"))
    # of the rows with a text and keys: all, those without an id, those of the smallest id
    rows = cut(rows.groupBy("h1", "h2", *keys).agg(
        F.sum("__n").alias("__n"), F.sum(F.when(F.col("__id").isNull(), F.col("__n")).otherwise(0)).alias("__none"),
        F.min("__id").alias("__low"), F.min_by("__n", "__id").alias("__at_low")))
    least = rows.groupBy("h1", "h2").agg(F.min("__low").alias("__first"), F.sum("__n").alias("__all")) \
                .filter("__all > 1 and __first is not null").select("h1", "h2", "__first")
    rows = rows.join(cut(least), ["h1", "h2"], "left")
    kept = F.when(F.col("__first").isNull(), F.col("__n")).otherwise(
        F.col("__none") + F.when(F.col("__low") == F.col("__first"), F.col("__at_low")).otherwise(0))
    sides = F.array(F.struct(F.lit(False).alias("copy"), kept.alias("n")),
                    F.struct(F.lit(True).alias("copy"), (F.col("__n") - kept).alias("n")))
    return rows.select(*keys, F.explode(sides).alias("__s")).select(*keys, "__s.copy", "__s.n") \
               .groupBy(*keys, "copy").agg(F.sum("n").alias("n")).filter("n > 0")


def text_conditions(text: Column) -> list[Column]:
    """Failures that a text decides: under 100 words; under 80 % distinct words;
    over 10 % capitals; a symbol."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    n, capitals = F.size(words), F.regexp_count(text, F.lit("[A-Z]"))
    return [n < 100, F.size(F.array_distinct(words)) * 100 < n * 80, capitals * 100 > F.char_length(text) * 10,
            text.rlike("[#$%&*|]")]


def with_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` plus ``good`` (a label of quality 1) and ``toxic`` (of toxic 1),
    false without a label. Rows without an id are spread, not joined in one
    task. ``docs`` is shuffled: leave texts out."""
    of = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    cols = [c for c in docs.columns if c not in ("good", "toxic")]
    spread = F.when(F.col(id_col).isNull(), 1 + F.pmod(F.xxhash64(*cols), F.lit(1000))).otherwise(F.lit(0))
    out = docs.select(*cols, F.coalesce(F.col(id_col), F.lit(0)).alias("__id"), spread.cast("int").alias("__spread"))
    out = out.join(of.withColumn("__spread", F.lit(0)), ["__id", "__spread"], "left")
    return out.select(*cols, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def audit(cells: DataFrame, names: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """``by_order`` of counted documents; names: a letter per filter, bit by bit."""
    return by_order(cut(edge_counts(cells, len(names), measures)), names, measures)
