"""As-of joins against brute force: touching, open, overlapping, missing and very many versions."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from spendstar.operators import asof

D0 = dt.date(2018, 1, 1)


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def brute(pairs, versions):
    out = {}
    for k, d in pairs:
        good = [(s, v, c) for kk, v, s, e, c in versions if kk == k and s is not None and s <= d and (e is None or d <= e)]
        if good:
            out[k, d] = max(good, key=lambda g: g[:2])[1:]
    return out


def run(spark, pairs, versions, **options):
    rows = spark.createDataFrame(pairs, "member string, d date")
    table = spark.createDataFrame(versions, "member string, v long, a date, b date, tier string")
    asked = asof.asked_days(rows, "member", "d")
    got = asof.valid_versions(asked, table, "member", "d", "v", "a", "b", ["tier"], **options).collect()
    assert len(got) == len({(r["member"], r["d"]) for r in got})
    return {(r["member"], r["d"]): (r["v"], r["tier"]) for r in got}


@pytest.mark.parametrize("bucket", [1, 7, 64, 100_000])
def test_versions_against_brute_force(spark, bucket):
    versions = [("touch", 1, day(0), day(9), "a"), ("touch", 2, day(10), day(10), "b"), ("touch", 3, day(11), None, "c"),
                ("open", 4, day(50), None, "a"), ("over", 5, day(0), day(100), "a"), ("over", 6, day(40), day(60), "b"),
                ("over", 7, day(55), day(58), None), ("same", 8, day(5), day(90), "a"), ("same", 9, day(5), None, "b"),
                ("gap", 10, day(0), day(3), "a"), ("gap", 11, day(8), None, "b"), ("back", 12, day(20), day(10), "a"),
                ("nostart", 13, None, day(10), "a"), (None, 14, day(0), None, "a"),
                ("far", 15, dt.date(1900, 1, 1), dt.date(9999, 12, 31), "a")]
    pairs = [(k, day(n)) for k in ("touch", "open", "over", "same", "gap", "back", "nostart", "none", "far") for n in range(-3, 105)]
    pairs += [("touch", None), (None, day(3)), ("touch", day(3)), ("touch", day(3)), ("far", dt.date(2009, 1, 1)), ("far", dt.date(2030, 12, 31))]
    want = brute([(k, d) for k, d in set(pairs) if k and d], versions)
    assert run(spark, pairs, versions, bucket_days=bucket) == want
    assert run(spark, pairs, [], bucket_days=bucket) == {} == run(spark, [], versions, bucket_days=bucket)


def test_member_with_very_many_versions(spark):
    rng = random.Random(1)
    versions = [("hot", k, day(s := rng.randrange(3000)), day(s + rng.randrange(30)), str(k % 5)) for k in range(4000)]
    versions += [("hot", 4000 + k, day(k * 40), None, "open") for k in range(50)]
    pairs = [("hot", day(n)) for n in range(0, 3000, 3)]
    assert run(spark, pairs, versions) == brute(pairs, versions)


def test_facts_keep_their_rows(spark):
    """Unknown vendors, days outside the calendar and gaps: the fact stays, with NULLs."""
    facts = spark.createDataFrame(
        [(1, 20180105, 7, 1.0), (2, 20180105, 99, 2.0), (3, None, 7, 3.0), (4, 20180301, 7, 4.0), (5, 20190101, 8, 5.0),
         (6, 20180105, None, 6.0), (7, 99999999, 7, 7.0)], "fact_key long, time_key int, vendor_key long, spend_amount double")
    dim = spark.createDataFrame(
        [(7, "A", "Tactical", "Low", day(0), day(30)), (8, "A", "Approved", "High", day(300), None)],
        "vendor_key long, vendor_id string, vendor_tier string, risk_rating string, effective_start_date date, effective_end_date date")
    contracts = spark.createDataFrame([("K1", "A", "MSA", day(0), day(10)), ("K2", "A", "SOW", day(2), None), ("K3", None, "SOW", day(0), None)],
                                      "contract_id string, vendor_id string, contract_type string, start_date date, end_date date")
    days = spark.createDataFrame([(int(d.strftime("%Y%m%d")), d) for d in (day(n) for n in range(800))], "time_key int, date_actual date")
    got = {r["fact_key"]: r for r in asof.fact_as_of_versions(facts, dim, contracts, days).collect()}
    assert len(got) == 7
    assert (got[1]["valid_vendor_key"], got[1]["restated"], got[1]["valid_contract_id"], got[1]["contract_days_left"]) == (7, False, "K2", None)
    assert got[4]["vendor_id"] == "A" and got[4]["valid_vendor_key"] is None and got[4]["valid_contract_id"] == "K2"
    assert (got[5]["valid_vendor_key"], got[5]["valid_vendor_tier"], got[5]["restated"]) == (8, "Approved", False)
    assert all(got[k]["valid_vendor_key"] is None and got[k]["restated"] is None for k in (2, 3, 6, 7))


def test_rows_are_not_multiplied(spark):
    """The range condition meets distinct (member, day) pairs only; facts are joined by equality."""
    from spendstar.plans.catalog import PLANS
    from spendstar.sources.fixtures import FixtureTables
    T = FixtureTables(spark, "/root/testdata/sf0.001")
    out = PLANS["fact_as_of_versions"](T)
    assert out.count() == T["fact_spend_analytics"].count() + PLANS["fact_spend_backlog"](T).count()
    assert out.filter("valid_vendor_key is not null").count() > 1000 and out.filter("restated").count() > 0
    assert out.filter("valid_contract_id is not null").count() > 100


@pytest.mark.parametrize("few", [0, 2, 32])
def test_timelines_against_brute_force(spark, few):
    """One row per member answers every day, from its versions or from its listed days."""
    from pyspark.sql import functions as F
    rng = random.Random(2)
    versions = [("over", 5, day(0), day(100), "a"), ("over", 6, day(40), day(60), "b"), ("over", 7, day(55), day(58), None),
                ("same", 8, day(5), day(90), "a"), ("same", 9, day(5), None, "b"), ("gap", 10, day(0), day(3), "a"),
                ("gap", 11, day(8), None, "b"), ("back", 12, day(20), day(10), "a"), ("nostart", 13, None, day(10), "a"),
                (None, 14, day(0), None, "a"), ("far", 15, dt.date(1900, 1, 1), dt.date(9999, 12, 31), "a")]
    versions += [("hot", 100 + k, day(s := rng.randrange(300)), day(s + rng.randrange(30)), str(k % 5)) for k in range(400)]
    pairs = [(k, day(n)) for k in ("over", "same", "gap", "back", "nostart", "none", "far", "hot") for n in range(-3, 340)]
    pairs += [("far", dt.date(2009, 1, 1)), ("far", dt.date(2030, 12, 31)), ("far", dt.date(2008, 12, 31)), ("over", None), (None, day(3))]
    want = brute([(k, d) for k, d in pairs if k and d and d >= dt.date(2009, 1, 1)], versions)
    table = spark.createDataFrame(versions, "member string, v long, a date, b date, tier string")
    lines = asof.timelines(table, "member", "v", "a", "b", ["tier"], few=few)
    assert lines.count() == lines.select("member").distinct().count()
    rows = spark.createDataFrame(pairs, "member string, d date").join(lines, "member", "left")
    got = rows.select("member", "d", *asof.on_day(F.col("few"), F.col("days"), F.col("d"), "v", ["tier"])).collect()
    assert len(got) == len(pairs)
    assert {(r["member"], r["d"]): (r["v"], r["tier"]) for r in got if r["v"] is not None} == want


def test_facts_are_made_once(spark):
    """What makes the fact rows runs once, not again for the list of asked days."""
    from pyspark.sql import functions as F
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x
    facts = spark.range(50).select(F.col("id").alias("fact_key"), F.lit(20180105).alias("time_key"),
                                   F.udf(seen, "long")(F.col("id") * 0 + 7).alias("vendor_key"), F.lit(1.0).alias("spend_amount"))
    dim = spark.createDataFrame([(7, "A", "Tactical", "Low", day(0), None)],
                                "vendor_key long, vendor_id string, vendor_tier string, risk_rating string, effective_start_date date, effective_end_date date")
    contracts = spark.createDataFrame([("K1", "A", "MSA", day(0), day(10))],
                                      "contract_id string, vendor_id string, contract_type string, start_date date, end_date date")
    days = spark.createDataFrame([(20180105, day(4))], "time_key int, date_actual date")
    got = asof.fact_as_of_versions(facts, dim, contracts, days).collect()
    assert len(got) == 50 and {(r["valid_vendor_key"], r["contract_days_left"]) for r in got} == {(7, 6)}
    assert made.value < 2 * 50
