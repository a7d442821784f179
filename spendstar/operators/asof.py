"""As-of joins: which version of a dimension member was valid on a given day.

Versions carry a validity range, start to end inclusive, with a NULL end while
they are open. A join on the key with a range condition would pair every row of
a member with every version of it. Two ways avoid that:

* ``valid_versions`` answers a list of distinct (member, day) pairs. The pairs
  are cut into buckets of days and meet only the versions whose range touches
  their bucket, so a member with very many versions is spread over its buckets.
* ``timelines`` makes one row per member from the versions alone: its versions
  in the order in which they win, or, where it has more than ``FEW``, the
  winner of every calendar day. Rows of any number then need one equi-join on
  the member, which multiplies nothing, and ``on_day`` reads the answer. The
  rows are made once and moved once; Spark may broadcast the members or split
  a hot one's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import CALENDAR_END, CALENDAR_START, as_date
from ..session import ensure_checkpoint_dir
from .dims import calendar

BUCKET_DAYS = 64
#: Versions of a member that are looked through row by row; with more, its days are listed.
FEW = 32


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(days)).cast("int")


def asked_days(rows: DataFrame, key: str, day: str) -> DataFrame:
    """The distinct (key, day) pairs of ``rows``, stored once: every dimension is looked up for them."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day).distinct().checkpoint(eager=True)


def _in_calendar(versions: DataFrame, key: str, version_key: str, start: str, end: str, carry: Sequence[str],
                 low: Column, high: Column) -> DataFrame:
    """Versions that can be asked for: (_k, _from, _v, _a, _b, _carry), ``_a`` to ``_b`` being the
    part of the range between ``low`` and ``high``."""
    ranged = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_k"), F.col(start).alias("_from"), F.col(end).alias("_to"), F.col(version_key).alias("_v"),
        F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)], F.lit(0).alias("_x")).alias("_carry"))
    return ranged.withColumns({"_a": F.greatest("_from", low), "_b": F.least(F.coalesce("_to", high), high)}) \
                 .filter("_a <= _b").drop("_to")


def valid_versions(asked: DataFrame, versions: DataFrame, key: str, day: str, version_key: str, start: str, end: str,
                   carry: Sequence[str] = (), first=CALENDAR_START, last=CALENDAR_END,
                   bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """D7 for many days: (key, day, version_key, carry...) of every asked pair
    that has a valid version; where several overlap the one that started last
    wins, among equal starts the highest version key.

    ``first`` and ``last`` bound the days that can be asked for (the calendar):
    an open version is listed in the buckets up to ``last`` only. A version
    without a start is never valid, one that ends before it starts neither."""
    low, high = F.lit(as_date(first)), F.lit(as_date(last))
    ranged = _in_calendar(versions, key, version_key, start, end, carry, low, high).withColumn(
        "_bucket", F.explode(F.sequence(_bucket(F.col("_a"), bucket_days), _bucket(F.col("_b"), bucket_days))))
    pairs = asked.filter(F.col(day).between(low, high)).withColumn("_bucket", _bucket(F.col(day), bucket_days))
    met = pairs.join(ranged, (pairs[key] == ranged["_k"]) & (pairs["_bucket"] == ranged["_bucket"])
                     & (ranged["_a"] <= pairs[day]) & (ranged["_b"] >= pairs[day]))
    best = met.groupBy(key, day).agg(F.max_by(F.struct("_v", "_carry"), F.struct("_from", "_v")).alias("_best"))
    return best.select(key, day, F.col("_best._v").alias(version_key),
                       *[F.col(f"_best._carry._{i}").alias(c) for i, c in enumerate(carry)])


def timelines(versions: DataFrame, key: str, version_key: str, start: str, end: str, carry: Sequence[str] = (),
              first=CALENDAR_START, last=CALENDAR_END, few: int = FEW) -> DataFrame:
    """(key, few, days): one row per member with a version. ``few``: its usable
    versions, those that win first; or, for a member with more than ``few`` of
    them, ``days``: the winner of each day from ``first`` to ``last`` (NULL
    without one), found by ``valid_versions``. Read them with ``on_day``."""
    low, high = F.lit(as_date(first)), F.lit(as_date(last))
    usable = _in_calendar(versions, key, version_key, start, end, carry, low, high)
    large = usable.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > few).select("_k")
    short = usable.join(large, "_k", "left_anti").groupBy("_k").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_v", "_a", "_b", "_carry")), asc=False).alias("few"))
    short = short.withColumn("few", F.transform("few", lambda x: F.struct(x["_a"], x["_b"], x["_v"], x["_carry"])))
    asked = large.select(F.col("_k").alias(key), F.explode(F.sequence(low, high)).alias("_day"))
    best = valid_versions(asked, versions.join(large.withColumnRenamed("_k", key), key, "left_semi"), key, "_day",
                          version_key, start, end, carry, first, last)
    best = best.select(F.col(key).alias("_k"), "_day", F.struct(F.col(version_key).alias("_v"), F.struct(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)], F.lit(0).alias("_x")).alias("_carry")).alias("_best"))
    daily = asked.withColumnRenamed(key, "_k").join(best, ["_k", "_day"], "left").groupBy("_k").agg(
        F.sort_array(F.collect_list(F.struct("_day", "_best"))).alias("days")) \
        .withColumn("days", F.transform("days", lambda x: x["_best"]))
    return short.unionByName(daily, allowMissingColumns=True).withColumnRenamed("_k", key)


def on_day(few: Column, days: Column, day: Column, version_key: str, carry: Sequence[str] = (),
           first=CALENDAR_START, last=CALENDAR_END) -> list[Column]:
    """The version key and carried columns that a row of ``timelines`` has for ``day``."""
    low, high = F.lit(as_date(first)), F.lit(as_date(last))
    won = F.get(F.filter(few, lambda x: (x["_a"] <= day) & (x["_b"] >= day)), F.lit(0))
    listed = F.when(day.between(low, high), F.get(days, F.datediff(day, low)))
    return [F.coalesce(won["_v"], listed["_v"]).alias(version_key),
            *[F.coalesce(won["_carry"][f"_{i}"], listed["_carry"][f"_{i}"]).alias(c) for i, c in enumerate(carry)]]


def fact_as_of_versions(facts: DataFrame, dim_vendors: DataFrame, contracts: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Every spend fact with the vendor version and the vendor's contract that
    were valid on its day.

    ``valid_vendor_key`` differs from ``vendor_key`` (``restated``) where the
    fact was keyed to another version than the day's; both are NULL-safe: a
    fact whose vendor key is unknown or whose day is outside the calendar or in
    a gap between versions keeps its row with NULLs. Of several contracts the
    one that started last counts (then the highest id)."""
    of_vendor, of_contract = ["vendor_tier", "risk_rating"], ["contract_type", "end_date"]
    version = timelines(dim_vendors, "vendor_id", "vendor_key", "effective_start_date", "effective_end_date", of_vendor) \
        .withColumnsRenamed({"few": "_few_v", "days": "_days_v"})
    contract = timelines(contracts, "vendor_id", "contract_id", "start_date", "end_date", of_contract) \
        .withColumnsRenamed({"few": "_few_k", "days": "_days_k"})
    # all that is known of a vendor meets its facts in one join
    vendor = dim_vendors.select("vendor_key", "vendor_id").join(version, "vendor_id", "left").join(contract, "vendor_id", "left")
    rows = facts.select("fact_key", "time_key", "vendor_key", "spend_amount") \
                .join(calendar(dim_time, "time_key", "date_actual"), "time_key", "left").join(vendor, "vendor_key", "left")
    day = F.col("date_actual")
    valid_key, tier, rating = on_day(F.col("_few_v"), F.col("_days_v"), day, "valid_vendor_key", of_vendor)
    contract_id, contract_type, ends = on_day(F.col("_few_k"), F.col("_days_k"), day, "valid_contract_id", of_contract)
    return rows.select(
        "fact_key", "time_key", "vendor_id", "vendor_key", "spend_amount", valid_key, tier.alias("valid_vendor_tier"),
        rating.alias("valid_risk_rating"), (valid_key != F.col("vendor_key")).alias("restated"), contract_id,
        contract_type.alias("valid_contract_type"), F.datediff(ends, day).alias("contract_days_left"))
