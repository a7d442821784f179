"""One profile of a database for all declared checks, from one scan of every table.

Rules (Q9), NOT NULL columns and keys (Q10) and foreign keys (Q11) ask for
counts over the same tables. Each row becomes a few short entries:

* one with the bits of all rules it fails and of all columns it leaves NULL:
  rows are counted by that mask, a handful of groups per table;
* one per declared key with the key's value, and one per foreign key with the
  value it refers to, filed under the referenced key. So a single grouping by
  (key, value) tells both how often a key value occurs and which references
  have no row to refer to; no join is needed.

All tables' entries are grouped together: one exchange, with map-side combine
(a hot reference costs one row per task), then one more small aggregate. The
profile has one row per declared check and can be stored; the alerts (M5) read
their numbers from it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 60


class _Plan:
    """Which entry and which column of the grouped result each check reads."""

    def __init__(self):
        self.entries: dict[str, list] = {}      # table -> structs of its rows
        self.checks: list[tuple] = []           # (domain, column, table, kind, name)
        self.domains: dict[tuple, int] = {}
        self.slots: dict[int, int] = {}

    def domain(self, name: tuple) -> int:
        return self.domains.setdefault(name, len(self.domains))

    def entry(self, table: str, domain: int, slot: int, key: str, mask: str, amount: str | None = None) -> None:
        """Entries are SQL text: one expression per table, however many checks it has."""
        self.entries.setdefault(table, []).append(
            f"named_struct('domain', {domain}, 'slot', {slot}, 'key', cast({key} as string), 'mask', cast({mask} as bigint), "
            f"'amount', cast({amount or 'null'} as decimal(18,2)))")

    def masks(self, table: str, measures: Sequence[tuple[str, str, str]], amount: str | None = None) -> None:
        """Count rows by measures (kind, name, SQL predicate); ``amount``: a column to sum."""
        for at in range(0, max(len(measures), 1), BITS):
            part, domain = measures[at:at + BITS], self.domain((table, "mask", at))
            bits = [f"if(coalesce({sql}, false), {1 << i}L, 0L)" for i, (_, _, sql) in enumerate(part)]
            self.checks += [(domain, f"b{i}", table, kind, name) for i, (kind, name, _) in enumerate(part)]
            self.entry(table, domain, 0, "null", " + ".join(bits) or "0", amount if at == 0 else None)
            if at == 0:
                self.checks += [(domain, "rows", table, "rows", ""), (domain, "amount", table, "amount", amount or "")]

    def key(self, table: str, key: Sequence[str], report: bool) -> int:
        """Occurrences of a key's values; ``report``: as checks of their own."""
        name = (table, "key", *key)
        known = name in self.domains
        domain = self.domain(name)
        if not known:
            # NULLs are values here: a mark in front tells them from any text
            parts = [f"coalesce(concat('=', cast({c} as string)), '-')" for c in key]
            self.entry(table, domain, 0, f"concat_ws('\x1f', {', '.join(parts)})",
                       f"({' or '.join(f'{c} is null' for c in key)})")
        if report:
            self.checks += [(domain, c, table, c, ",".join(key)) for c in ("rows", "null_rows", "groups", "group_rows")]
        return domain

    def reference(self, table: str, column: str, parent: str, parent_column: str) -> None:
        domain = self.key(parent, (parent_column,), False)
        slot = self.slots[domain] = self.slots.get(domain, 0) + 1
        self.entry(table, domain, slot, f"concat('=', cast({column} as string))", f"if({column} is null, null, 0)")
        self.checks.append((domain, f"lost{slot}", table, "reference", f"{column}>{parent}.{parent_column}"))


def profile(T: Mapping[str, DataFrame], rules: Iterable = (), nulls: Iterable = (), keys: Iterable = (),
            references: Iterable = (), totals: Iterable = ()) -> DataFrame:
    """(table_name, kind, name, n, amount), one row per check. ``rules``:
    (table, name, SQL predicate that holds), ``nulls``: (table, columns),
    ``keys``: (table, columns), ``references``: (table, column, parent, parent
    column), ``totals``: (table, SQL predicates to count, column to sum or
    None). Everything named must exist in ``T``."""
    plan = _Plan()
    measures: dict[str, list] = {}
    amounts: dict[str, str | None] = {}
    for table, name, sql in rules:
        measures.setdefault(table, []).append(("rule", name, f"not ({sql})"))
    for table, columns in nulls:
        measures.setdefault(table, []).extend(("null", c, f"{c} is null") for c in columns)
    for table, predicates, amount in totals:
        measures.setdefault(table, []).extend(("count", p, p) for p in predicates)
        amounts[table] = amount
    for table, mine in measures.items():
        plan.masks(table, mine, amounts.get(table))
    for table, key in keys:
        plan.key(table, key, True)
    for reference in references:
        plan.reference(*reference)

    slots = max(plan.slots.values(), default=0)
    rows = None
    for table, structs in plan.entries.items():
        one = T[table].selectExpr(f"explode(array({', '.join(structs)})) as e").selectExpr("e.*").filter("slot = 0 or key is not null")
        rows = one if rows is None else rows.unionByName(one)
    grouped = rows.groupBy("domain", "key", "mask").agg(
        *[F.expr(f"count_if(slot = {k})").alias(f"n{k}") for k in range(slots + 1)], F.sum("amount").alias("amount"))
    # only the columns that some check reads
    used = {column for _, column, *_ in plan.checks}
    could = {"rows": "sum(n0)", "null_rows": "sum(if(mask > 0, n0, 0))", "groups": "count_if(n0 > 1)",
             "group_rows": "sum(if(n0 > 1, n0, 0))", **{f"b{i}": f"sum(if(mask & {1 << i}L <> 0, n0, 0))" for i in range(BITS)},
             **{f"lost{k}": f"sum(if(n0 = 0, n{k}, 0))" for k in range(1, slots + 1)}}
    sums = {k: sql for k, sql in could.items() if k in used}
    wide = grouped.groupBy("domain").agg(F.sum("amount").alias("amount"), *[F.expr(sql).alias(k) for k, sql in sums.items()])
    cells = [f"named_struct('column', '{k}', 'n', cast({k} as bigint), 'amount', cast(null as decimal(28,2)))" for k in sums]
    cells.append("named_struct('column', 'amount', 'n', cast(null as bigint), 'amount', cast(amount as decimal(28,2)))")
    long = wide.selectExpr("domain", f"explode(array({', '.join(cells)})) as c").selectExpr("domain", "c.*")
    spark = T[next(iter(T))].sparkSession
    checks = spark.createDataFrame(plan.checks, "domain int, column string, table_name string, kind string, name string")
    # ``checks`` is the list of declared checks; ``long`` has one row per check and unused column
    return checks.join(long, ["domain", "column"], "left").select(
        "table_name", "kind", "name",
        F.when(F.col("kind") != "amount", F.coalesce("n", F.lit(0))).cast("long").alias("n"), "amount")
