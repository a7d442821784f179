"""The vendor change stream: any order, repeats and cuts give the batch result; versions, keys and restarts."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from spendstar.sources import io, schemas
from spendstar.streaming import vendor_cdc as cdc
from spendstar.streaming.fact_stream import CDC_SCHEMA, cdc_to_dimension

DAY = dt.date(2023, 11, 5)
COLS = ["vendor_id", "vendor_name", "vendor_tier", "risk_rating", "country", "effective_start_date", "effective_end_date",
        "is_current_record"]


def vendors(spark):
    return spark.createDataFrame([(f"V{k}", f"N{k}", "Approved", None, "C", "R", k != 3) for k in range(8)], schemas.OPERATIONAL["vendors"])


def profiles(spark):
    return spark.createDataFrame([("V1", "High"), ("N2", "Low")], "vendor_id string, risk_rating string")


def dimension(spark):
    rows = [(k + 10, f"V{k}", f"N{k}", "Approved", None, "High" if k == 1 else "Medium", 50.0, "C", "R", dt.date(2020, 1, 1),
             None, True, None, None) for k in range(6)]
    return spark.createDataFrame(rows, schemas.STAR["dim_vendors"])


def feed(seed, n=120):
    rng = random.Random(seed)
    out = []
    for seq in range(1, n + 1):
        vid = rng.choice([f"V{k}" for k in range(8)] + ["N1", "N2", "N3"])
        op = rng.choice("IUUUD")
        attrs = (None,) * 6 if op == "D" else (f"N{vid}" if rng.random() < 0.3 else vid.replace("V", "N"), rng.choice(["Approved", "Tactical"]),
                                               None, "C", rng.choice(["R", "S"]), rng.choice([True, True, None, False]))
        out.append((op, vid, *attrs, seq))
    return out


def rows_of(dim):
    return sorted((tuple(r[c] for c in COLS) for r in dim.collect()), key=str)


def stream(spark, root, state, files, per_batch, day=DAY):
    src = os.path.join(os.path.dirname(state), f"src-{os.path.basename(state)}")
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, CDC_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    cdc.stream_vendor_cdc(spark, src, root, state, profiles(spark), day, max_files_per_trigger=per_batch)
    return io.read_table(spark, root, "dim_vendors")


@pytest.mark.parametrize("seed,per_batch", [(1, 1), (2, 3), (3, 100)])
def test_stream_equals_batch(spark, scratch, seed, per_batch):
    changes = feed(seed)
    late = changes + random.Random(seed).sample(changes, 40) + [("X", "V1", *(None,) * 6, 999), ("U", None, "a", *(None,) * 5, 998),
                                                                ("U", "V1", "a", *(None,) * 6)]
    random.Random(seed + 9).shuffle(late)
    root = os.path.join(scratch, "db")
    cdc.begin(spark, root, vendors(spark), dimension(spark))
    got = stream(spark, root, os.path.join(scratch, "s"), [late[k::6] for k in range(6)], per_batch)
    want = cdc_to_dimension(dimension(spark), vendors(spark), profiles(spark), spark.createDataFrame(changes, CDC_SCHEMA), DAY)
    assert rows_of(got) == rows_of(want)
    assert got.count() == got.select("vendor_key").distinct().count()
    # the same files again, as another stream: nothing is published
    number = io.manifest_number(spark, root)
    again = stream(spark, root, os.path.join(scratch, "t"), [late[k::6] for k in range(6)], per_batch)
    assert rows_of(again) == rows_of(want) and io.manifest_number(spark, root) == number


def test_versions_of_a_day_keep_their_keys(spark, scratch):
    """A change, another one, and the change back; then the next day."""
    root = os.path.join(scratch, "db")
    cdc.begin(spark, root, vendors(spark), dimension(spark))
    cdc.begin_day(spark, root, DAY)

    def step(rows, run, day=DAY):
        return cdc.merge_batch(spark, root, spark.createDataFrame(rows, CDC_SCHEMA), profiles(spark), day, run)

    def current(vid):
        return [(r["vendor_key"], r["vendor_tier"], r["effective_start_date"]) for r in
                io.read_table(spark, root, "dim_vendors").filter("is_current_record").collect() if r["vendor_id"] == vid]

    up = lambda vid, tier, seq: ("U", vid, vid.replace("V", "N"), tier, None, "C", "R", True, seq)
    assert step([up("V1", "Tactical", 5)], "a")
    ((key, tier, start),) = current("V1")
    assert (tier, start) == ("Tactical", DAY) and key > 15
    assert step([up("V2", "Tactical", 1), up("V1", "Strategic", 6)], "b")
    assert current("V1") == [(key, "Strategic", DAY)] and len(current("V2")) == 1
    assert not step([up("V1", "Tactical", 5), up("V1", "Preferred", 4)], "c")          # late
    assert step([up("V1", "Approved", 7)], "d")                                       # back to what the day began with
    assert current("V1") == [(11, "Approved", dt.date(2020, 1, 1))]
    assert step([up("V1", "Tactical", 8), up("Z1", "Tactical", 1)], "e")
    assert current("V1") == [(key, "Tactical", DAY)]
    keys = [r["vendor_key"] for r in io.read_table(spark, root, "dim_vendors").collect()]
    assert len(keys) == len(set(keys))
    cdc.begin_day(spark, root, DAY)                                                   # the day has begun already
    tomorrow = DAY + dt.timedelta(days=1)
    cdc.begin_day(spark, root, tomorrow)
    assert step([up("V1", "Strategic", 9)], "f", tomorrow)
    ((new, tier, start),) = current("V1")
    assert new > max(keys) and (tier, start) == ("Strategic", tomorrow)
    old = io.read_table(spark, root, "dim_vendors").filter(f"vendor_key = {key}").first()
    assert (old["effective_end_date"], old["is_current_record"]) == (DAY, False)


def test_stop_between_storing_and_publishing(spark, scratch, monkeypatch):
    root, changes = os.path.join(scratch, "db"), feed(4)
    cdc.begin(spark, root, vendors(spark), dimension(spark))
    real, calls = io.publish, []

    def stopped(*a, **k):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return real(*a, **k)

    monkeypatch.setattr(cdc.io, "publish", stopped)
    state = os.path.join(scratch, "s")
    with pytest.raises(Exception, match="stopped"):
        stream(spark, root, state, [changes[k::4] for k in range(4)], 1)
    cdc.stream_vendor_cdc(spark, os.path.join(scratch, "src-s"), root, state, profiles(spark), DAY, max_files_per_trigger=1)
    want = cdc_to_dimension(dimension(spark), vendors(spark), profiles(spark), spark.createDataFrame(changes, CDC_SCHEMA), DAY)
    assert rows_of(io.read_table(spark, root, "dim_vendors")) == rows_of(want)
