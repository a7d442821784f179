"""Filter audit: lattice counts, brute force over all orders, edge cases."""
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from spendstar.llm import audit


def test_lattice_counts_orders():
    for n in range(1, 7):
        forward, backward = audit.lattice(n)
        for s in range(1 << n):
            k = bin(s).count("1")
            assert (forward[s], backward[s]) == (factorial(k), factorial(n - k))
    with pytest.raises(ValueError):
        audit.edges(None, audit.MAX_FILTERS + 1)
    with pytest.raises(ValueError):
        audit.order_steps(None, "ABCDEFG")


def failures(rows, labels):
    """(part, failed letters, good, toxic) of every row, by the definitions."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for i, text, part in rows:
        t = text or ""
        w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if x]
        bad = "A" if len(w) < 100 else ""
        bad += "B" if 100 * len(set(w)) < 80 * len(w) else ""
        bad += "C" if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else ""
        bad += "D" if set(t) & set("#$%&*|") else ""
        bad += "E" if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows) else ""
        out.append((part or "", bad, i in good, i in toxic))
    return out


def brute(rows, labels, names="ABCDE"):
    docs = failures(rows, labels)
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        table, value = [], dict.fromkeys(names, 0)
        for order in permutations(names):
            left = mine
            for step, f in enumerate(order, 1):
                hit = [d for d in left if f in d[1]]
                rest = [d for d in left if f not in d[1]]
                value[f] += len(hit)
                table.append((part, "".join(order), step, len(rest), len(hit),
                              sum(f in d[1] for d in mine) - len(hit), sum(d[1] == f for d in mine),
                              sum(d[2] for d in hit), sum(d[3] for d in hit)))
                left = rest
        out += [(*r, value[r[1][r[2] - 1]]) for r in table]
    return sorted(out)


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def run(docs, labels):
    """The registered query's steps over given tables."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.col("lang").alias("part"), *audit.text_key(text),
                       audit.failure_mask(audit.text_conditions(text)).alias("mask"))
    counted = audit.later_copies(audit.with_labels(read, labels), "doc_id", ["part", "mask", "good", "toxic"])
    mask = F.col("mask").bitwiseOR(F.when(F.col("copy"), F.lit(16)).otherwise(F.lit(0)))
    cells = audit.cells(counted, mask, F.col("part"), F.col("n"), good_lost=F.col("n") * F.col("good").cast("int"),
                        toxic_lost=F.col("n") * F.col("toxic").cast("int"))
    return sorted(tuple(r[c] for c in COLS) for r in audit.audit(cells, "ABCDE", ["good_lost", "toxic_lost"]).collect())


def test_audit_against_brute_force(spark, make_docs):
    word = [f"w{k}" for k in range(130)]
    long = " ".join(word)
    rows = [(1, None, "en"), (2, "", "en"), (3, long, "en"), (4, long, "de"), (4, long, "de"), (5, long + " #", None),
            (6, "A" * 50, ""), (7, " ".join(word[:50] * 3), "de"), (8, long.upper(), "fr"), (9, long.upper() + "%", "fr"),
            (None, long, "en"), (None, None, "en"), (0, long, "xx"), (10, "x\x1cy " * 120, "en"), (11, "é \ta\x0bb", "en"),
            (12, " ".join(word[:99]), "en"), (13, " ".join(word[:100]), "en"), (14, "w " * 400_000, "en")]
    rows += [(100 + k, long, "hot") for k in range(300)]
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (7, None, 1), (None, 1, 1), (120, 1, 1), (9, 1, 0), (777, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make_docs([(i, t, p, None) for i, t, p in rows])
    assert run(docs, table) == brute(rows, labels)
    clash = docs.withColumns({"good": F.lit(True), "toxic": F.lit("x"), "mask": F.lit(5)})
    assert run(clash, table.limit(0)) == brute(rows, [])
    assert run(make_docs([]), table) == []


def test_weights_of_three_filters(spark):
    """Shapley values by their definition, and measures that are null."""
    cells = spark.createDataFrame([("p", m, 1 << m, None) for m in range(8)], "part string, mask int, n long, odd long")
    counts = audit.edge_counts(audit.cells(cells, F.col("mask"), F.col("part"), F.col("n"), odd=F.col("odd")), 3, ["odd"])
    got = {r["filter"]: r["shapley"] for r in audit.shapley(counts).collect()}
    want = dict.fromkeys(range(3), 0)
    for order in permutations(range(3)):
        seen = 0
        for f in order:
            want[f] += sum(1 << m for m in range(8) if m >> f & 1 and not m & seen)
            seen |= 1 << f
    assert got == want and counts.filter("odd <> 0").isEmpty()
