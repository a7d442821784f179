"""Distributed running sums against brute force; IO (create, conform, copy,
publish, drift); streaming fact load equals the batch load; CDC apply."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendstar.operators import facts, quality, reports
from spendstar.plans.prefix import assign_keys, ordered_running
from spendstar.sources import io, schemas
from spendstar.streaming.fact_stream import (CDC_SCHEMA, apply_cdc, latest_changes, read_stream_target,
                                             stream_fact_load)

D = dt.date


def test_ordered_running_matches_pandas_on_skewed_groups(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if i % 3 else rnd.randint(1, 20)            # group 0 holds two thirds of the rows
        rows.append((g, i, Decimal(rnd.randint(0, 500)) / 4))
    df = spark.createDataFrame(rows, "g int, k long, v decimal(18,2)")
    out = ordered_running(df, [F.desc("v"), F.col("k")], group=["g"], value="v", num_partitions=7).toPandas()
    ref = pd.DataFrame([(g, k, int(v * 4)) for g, k, v in rows], columns=["g", "k", "q"])
    ref = ref.sort_values(["g", "q", "k"], ascending=[True, False, True])
    ref["row_index"] = ref.groupby("g").cumcount() + 1
    ref["quarters"] = ref.groupby("g")["q"].cumsum()          # exact, in quarter units
    m = out.merge(ref, on=["g", "k"], suffixes=("", "_ref"))
    assert len(m) == len(rows)
    assert (m["row_index"] == m["row_index_ref"]).all()
    assert all(int(s * 4) == q for s, q in zip(m["running_sum"], m["quarters"]))


def test_assign_keys_continue_after_max(spark):
    existing = spark.createDataFrame([(5,), (9,)], "k long")
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    got = {r["name"]: r["k"] for r in assign_keys(new, existing, "k", ["name"], num_partitions=2).collect()}
    assert got == {"a": 10, "b": 11, "c": 12}


@pytest.mark.parametrize("parts", [16, 200])
def test_keys_of_a_million_rows_are_gapless_and_ordered(spark, scratch, parts):
    new = spark.range(1_000_000, numPartitions=24).select(
        F.concat(F.lit("N"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(1_000_003)).cast("string"), 7, "0")).alias("name"),
        F.xxhash64("id").alias("a"), F.md5(F.col("id").cast("string").cast("binary")).alias("b"), F.rand(3).alias("c"))
    path = os.path.join(scratch, f"keys{parts}")
    assign_keys(new, None, "k", ["name"], num_partitions=parts).write.parquet(path)
    got = spark.read.parquet(path)
    r = got.agg(F.count(F.lit(1)), F.countDistinct("k"), F.min("k"), F.max("k")).first()
    assert tuple(r) == (1_000_000, 1_000_000, 1, 1_000_000)
    # in order: the key equals the name's place, checked through the sorted names of the ends of each slice
    wrong = got.alias("x").join(got.alias("y"), F.expr("y.k = x.k + 1")).filter("y.name <= x.name").count()
    assert wrong == 0


def test_tail_spend_brute_force(T001):
    out = {r["fiscal_year"]: r for r in reports.tail_spend(T001, 0.8, num_partitions=5).collect()}
    f = (T001["fact_spend_analytics"].join(T001["dim_time"].select("time_key", "fiscal_year"), "time_key")
         .select("fiscal_year", "vendor_key", "spend_amount").toPandas())
    f["spend_amount"] = f["spend_amount"].astype(object)
    for fy, g in f.groupby("fiscal_year"):
        v = g.groupby("vendor_key")["spend_amount"].sum().reset_index()
        v = v.sort_values(["spend_amount", "vendor_key"], ascending=[False, True])
        total = v["spend_amount"].sum()
        before = v["spend_amount"].cumsum() - v["spend_amount"]
        tail = [float(b) / float(total) >= 0.8 for b in before]
        assert out[fy]["vendors"] == len(v)
        assert out[fy]["tail_vendors"] == sum(tail)


def test_fixture_tables_have_the_fixed_schemas(T001):
    for name in list(schemas.OPERATIONAL) + ["dim_vendors", "dim_commodities", "dim_time", "fact_spend_analytics"]:
        drift = quality.schema_drift(T001[name], schemas.ALL[name]).collect()
        assert drift == [], (name, drift)


def test_schema_drift_reports_changes(spark):
    df = spark.createDataFrame([(1, "x")], "vendor_id int, extra string")
    got = {(r["column_name"], r["change"]) for r in quality.schema_drift(df, schemas.ALL["vendors"]).collect()}
    assert ("vendor_id", "retyped") in got and ("extra", "added") in got and ("vendor_name", "missing") in got


def test_create_conform_copy_publish(spark, scratch):
    root = os.path.join(scratch, "analytics")
    io.create_star(spark, root, ["dim_vendors", "fact_spend_analytics"])
    assert io.read_table(spark, root, "dim_vendors").count() == 0
    rows = spark.createDataFrame([("V1", "A")], "vendor_id string, vendor_name string")
    with pytest.raises(ValueError):
        io.conform(rows.withColumn("extra", F.lit(1)), schemas.STAR["dim_vendors"])
    conformed = io.conform(rows, schemas.STAR["dim_vendors"], schemas.DEFAULTS["dim_vendors"])
    assert conformed.schema.simpleString() == schemas.STAR["dim_vendors"].simpleString()
    assert conformed.collect()[0]["is_current_record"] is True
    with pytest.raises(ValueError):
        io.copy_star({"dim_vendors": rows}, {"dim_vendors": schemas.STAR["dim_vendors"]})
    keyed = conformed.withColumn("vendor_key", F.lit(1).cast("long"))
    v1 = io.publish({"dim_vendors": keyed}, root, checks=lambda w: w["dim_vendors"].count() == 1)
    assert io.read_table(spark, root, "dim_vendors").count() == 1
    with pytest.raises(RuntimeError):
        io.publish({"dim_vendors": keyed.unionByName(keyed)}, root, checks=lambda w: w["dim_vendors"].count() == 1)
    assert io.table_path(spark, root, "dim_vendors").endswith(v1)     # failed run not published
    assert io.manifest(spark, root) == {"dim_vendors": v1, "fact_spend_analytics": "v0"}
    # a run that is run again replaces what it left unpublished and keeps what it published
    two = keyed.unionByName(keyed)
    with pytest.raises(RuntimeError):
        io.publish({"dim_vendors": two}, root, checks=lambda w: False, run_id="again")
    assert io.publish({"dim_vendors": two}, root, run_id="again") == "vagain"
    assert io.publish({"dim_vendors": keyed}, root, run_id="again") == "vagain"
    assert io.read_table(spark, root, "dim_vendors").count() == 2
    os.makedirs(os.path.join(root, "dim_time", "v7"))                 # versions, none published
    with pytest.raises(FileNotFoundError):
        io.table_path(spark, root, "dim_time")
    with pytest.raises(ValueError):
        io.read_jdbc(spark, "jdbc:none", "spend_transactions")
    T = io.read_tables(spark, root, ["dim_vendors", "fact_spend_analytics"])
    info = {r["table_name"]: r["row_count"] for r in io.table_info(T).collect()}
    assert info == {"dim_vendors": 2, "fact_spend_analytics": 0}
    assert io.table_sizes(T)["dim_vendors"] > 0


def _keyed(spark, n):
    return io.conform(spark.range(n).select(F.col("id").alias("vendor_key"), F.lit("V").alias("vendor_id")), schemas.STAR["dim_vendors"],
                      schemas.DEFAULTS["dim_vendors"])


def test_interleaved_publishers_both_survive(spark, scratch, monkeypatch):
    """A second publisher commits between the first one's reading of the manifest and its commit."""
    root = os.path.join(scratch, "db")
    io.publish({"a": _keyed(spark, 1), "b": _keyed(spark, 1)}, root, run_id="0")
    real, others = io._create_once, [({"b": _keyed(spark, 5)}, "other"), ({"c": _keyed(spark, 7)}, "third")]

    def slow(s, path, text):
        if others:
            outputs, run = others.pop()
            io.publish(outputs, root, run_id=run)
        return real(s, path, text)

    monkeypatch.setattr(io, "_create_once", slow)
    io.publish({"a": _keyed(spark, 3)}, root, run_id="mine")
    assert io.manifest(spark, root) == {"a": "vmine", "b": "vother", "c": "vthird"}
    assert io.manifest_number(spark, root) == 4
    # what was computed from a table that another publisher replaced does not undo that
    based_on = {"b": io.manifest(spark, root)["b"]}
    others = [({"b": _keyed(spark, 6)}, "newer")]
    with pytest.raises(io.PublishConflict):
        io.publish({"b": _keyed(spark, 9)}, root, run_id="late", based_on=based_on)
    assert io.read_table(spark, root, "b", schemas.STAR["dim_vendors"]).count() == 6
    assert not [f for f in os.listdir(os.path.join(root, io.MANIFEST)) if not f.lstrip(".").split(".")[0].isdigit()]


def test_tables_of_several_versions(spark, scratch, monkeypatch):
    """Added versions of a published table and of a plain directory; old manifests go."""
    monkeypatch.setattr(io, "KEPT_MANIFESTS", 3)
    root = os.path.join(scratch, "db")
    _keyed(spark, 2).write.parquet(f"{root}/dim_vendors")
    for run in ("1", "2", "2"):
        io.publish({"dim_vendors": _keyed(spark, 3)}, root, run_id=run, add=["dim_vendors"])
    assert io.table_versions(spark, root, "dim_vendors") == [".", "v1", "v2"]
    assert io.read_table(spark, root, "dim_vendors").count() == 8
    assert io.table_sizes(io.read_tables(spark, root, ["dim_vendors"]))["dim_vendors"] > 0
    for k in range(6):
        io.publish({"x": _keyed(spark, 1)}, root, run_id=f"x{k}")
    left = [f for f in os.listdir(os.path.join(root, io.MANIFEST)) if f.isdigit()]
    assert len(left) == 3 and io.manifest(spark, root)["x"] == "vx5"


def test_loaded_id_index(spark, scratch):
    """Only committed loads count, a load's own earlier ids do not, repeats do no harm; the index side is not shuffled."""
    from spendstar.sources.loaded_ids import add_ids, find_loaded, loaded_ids
    path = os.path.join(scratch, "ids")
    ids = spark.range(5000).select(F.col("id").cast("string").alias("source_transaction_id"))
    assert loaded_ids(spark, path).count() == 0
    add_ids(spark, path, ids.filter("cast(source_transaction_id as int) < 3000").unionByName(spark.createDataFrame([(None,)], "source_transaction_id string")), "v1")
    add_ids(spark, path, ids.filter("cast(source_transaction_id as int) >= 2900"), "v2")
    add_ids(spark, path, ids.filter("cast(source_transaction_id as int) >= 2900"), "v2")
    new = spark.createDataFrame([("5",), ("2950",), ("4000",), ("7000",), ("4000",), (None,)], "source_transaction_id string")

    def found(**k):
        return sorted(r[0] for r in find_loaded(loaded_ids(spark, path, **k), new).collect())

    assert found() == ["2950", "4000", "5"] and found(committed=["v1"]) == ["2950", "5"]
    assert found(without="v2") == ["2950", "5"] and found(committed=["v1", "v2"], without="v1") == ["2950", "4000"]
    assert found(committed=[]) == []
    # many new ids: both sides meet by bucket, and only the new ones move
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        import contextlib
        import io as text_io
        buf = text_io.StringIO()
        with contextlib.redirect_stdout(buf):
            loaded_ids(spark, path).join(new, "source_transaction_id", "left_semi").explain()
        lines = buf.getvalue().splitlines()
        scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x or "loaded_ids" in x)
        assert "SortMergeJoin" in buf.getvalue() and buf.getvalue().count("Exchange hashpartitioning") == 1
        assert not any("Exchange" in x for x in lines[:scan + 1] if x.strip().startswith("+- Exchange") and x.index("+") < lines[scan].index("FileScan"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_write_reports(T001, scratch):
    run = io.write_reports({"r1": reports.supplier_performance(T001)}, scratch, run_id="t")
    spark = T001.spark
    assert spark.read.parquet(os.path.join(scratch, run, "r1")).count() == reports.supplier_performance(T001).count()


def test_stream_fact_load_equals_batch_and_replay_is_idempotent(spark, T001, scratch):
    src = os.path.join(scratch, "spend")
    spend = T001["spend_transactions"]
    spend.repartition(4, "transaction_id").write.parquet(src)
    target = os.path.join(scratch, "facts")
    dims = {k: T001[k] for k in ("dim_vendors", "dim_commodities", "dim_time")}
    loaded = T001["fact_spend_analytics"]
    ckpt = os.path.join(scratch, "ckpt")
    stream_fact_load(spark, src, dims, target, ckpt, D(2023, 11, 5), max_files_per_trigger=1, loaded=loaded)
    batch = facts.fact_spend_new(spend, dims["dim_vendors"], dims["dim_commodities"], dims["dim_time"], loaded,
                                 D(2023, 11, 5))
    got = read_stream_target(spark, target)
    assert got.count() == batch.count() > 0
    assert got.subtract(batch.select(*got.columns)).count() == 0
    assert len([d for d in os.listdir(target) if d.startswith("epoch=")]) == 4
    # rerunning with the same checkpoint adds nothing
    stream_fact_load(spark, src, dims, target, ckpt, D(2023, 11, 5), max_files_per_trigger=1, loaded=loaded)
    assert read_stream_target(spark, target).count() == batch.count()
    # a fresh checkpoint replays every file: the earlier epochs count as loaded
    stream_fact_load(spark, src, dims, target, os.path.join(scratch, "ckpt2"), D(2023, 11, 5),
                     max_files_per_trigger=1, loaded=loaded)
    assert read_stream_target(spark, target).count() == batch.count()


def test_stream_reads_ids_not_facts_and_finds_redated_transactions(spark, T001, scratch, monkeypatch):
    """No micro-batch reads facts; a transaction loaded under another day is known; one stopped before its ids is run again."""
    from spendstar.streaming import fact_stream
    spend = T001["spend_transactions"].limit(400).cache()
    dims = {k: T001[k] for k in ("dim_vendors", "dim_commodities", "dim_time")}
    src, target = os.path.join(scratch, "spend"), os.path.join(scratch, "facts")
    spend.withColumn("transaction_date", F.date_add("transaction_date", 90)).repartition(3).write.parquet(src)
    batch = facts.fact_spend_new(spend, dims["dim_vendors"], dims["dim_commodities"], dims["dim_time"],
                                 T001["fact_spend_analytics"].limit(0), D(2023, 11, 5))
    some = batch.limit(50).withColumn("time_key", F.lit(20100101))
    real, plans = fact_stream.fact_spend_new, []

    def watched(*a, **k):
        out = real(*a, **k)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(fact_stream, "fact_spend_new", watched)
    stop = {"on": True}
    real_add = fact_stream.add_ids

    def add(*a, **k):
        if stop["on"] and a[3] != "before" and a[3].endswith("-1"):
            raise RuntimeError("stopped")
        return real_add(*a, **k)

    monkeypatch.setattr(fact_stream, "add_ids", add)
    some.write.parquet(os.path.join(scratch, "some"))
    some = spark.read.parquet(os.path.join(scratch, "some"))
    args = (spark, src, dims, target, os.path.join(scratch, "state"), D(2023, 11, 5))
    with pytest.raises(Exception, match="stopped"):
        stream_fact_load(*args, loaded=some, max_files_per_trigger=1)
    stop["on"] = False
    stream_fact_load(*args, loaded=some, max_files_per_trigger=1)
    got = read_stream_target(spark, target)
    redated = facts.fact_spend_new(spark.read.schema(schemas.OPERATIONAL["spend_transactions"]).parquet(src), dims["dim_vendors"],
                                   dims["dim_commodities"], dims["dim_time"], T001["fact_spend_analytics"].limit(0), D(2023, 11, 5))
    want = {r[0] for r in redated.select("fact_key").collect()} - {r[0] for r in some.select("fact_key").collect()}
    keys = [r[0] for r in got.select("fact_key").collect()]
    assert set(keys) == want and len(keys) == len(set(keys)) > 0
    assert len(plans) == 4 and all("load_run" in p and "spend_amount:" not in p for p in plans)


def test_unreadable_stream_target_raises(spark, T001, scratch):
    target = os.path.join(scratch, "facts")
    os.makedirs(os.path.join(target, "epoch=a-0"))
    with open(os.path.join(target, "epoch=a-0", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        read_stream_target(spark, target).count()
    assert read_stream_target(spark, os.path.join(scratch, "none")).count() == 0


def test_cdc_latest_change_and_apply(spark):
    vendors = spark.createDataFrame(
        [("V1", "A", "Approved", None, "C", "R", True), ("V2", "B", "Approved", None, "C", "R", True)],
        schemas.OPERATIONAL["vendors"])
    changes = spark.createDataFrame([
        ("U", "V1", "A", "Strategic", None, "C", "R", True, 1),
        ("U", "V1", "A", "Tactical", None, "C", "R", True, 2),
        ("D", "V2", None, None, None, None, None, None, 3),
        ("I", "V3", "N", "Preferred", None, "C", "R", None, 4)], CDC_SCHEMA)
    assert {r["vendor_id"]: r["vendor_tier"] for r in latest_changes(changes).collect()}["V1"] == "Tactical"
    got = {r["vendor_id"]: (r["vendor_tier"], r["is_active"]) for r in apply_cdc(vendors, changes).collect()}
    assert got == {"V1": ("Tactical", True), "V2": ("Approved", False), "V3": ("Preferred", True)}
