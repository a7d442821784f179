"""Z2 as a stream: a feed of vendor changes keeps the vendor dimension up to date.

The feed is a directory of change files. Each micro-batch merges its changes
into the vendor master, derives the dimension from it and publishes both as one
version, all or nothing. The master remembers per vendor the sequence numbers
of the last insert or update and of the last change of any kind
(``fact_stream.apply_cdc``): late changes, repeats and replayed files change
nothing, and neither the order of the files nor the cuts between micro-batches
matter. A micro-batch without news publishes nothing.

Every version of a day is derived from the dimension that the day began with,
so a vendor has at most one new version a day, however often it changes, and
one that changes back has none. Its surrogate key is given once: the master
remembers it, so that facts keyed to an earlier version of the day stay right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import new_dim_vendors
from ..operators.scd2 import _as_dim_rows, scd2_changes, scd2_close
from ..params import as_date
from ..plans.prefix import assign_keys
from ..sources import io
from .fact_stream import ATTRS, CDC_SCHEMA, apply_cdc, change_registers

MASTER, DIM, BASE = "vendor_master", "dim_vendors", "dim_vendors_day_start"


def begin_day(spark: SparkSession, root: str, day) -> None:
    """Fix the dimension that the day begins with and forget the keys given on earlier days; once a day."""
    version = f"{as_date(day):%Y%m%d}"
    if f"v{version}" in io.table_versions(spark, root, BASE):
        return
    now = io.manifest(spark, root)
    master = spark.read.parquet(*io.table_paths(spark, root, MASTER))
    io.publish({BASE: io.read_table(spark, root, DIM),
                MASTER: master.withColumn("day_key", F.lit(None).cast("long"))}, root, run_id=version,
               based_on={n: now.get(n) for n in (DIM, MASTER, BASE)})


def begin(spark: SparkSession, root: str, vendors: DataFrame, dim: DataFrame) -> None:
    """Publish the first master and dimension, unless there are some."""
    if not io.table_versions(spark, root, MASTER):
        none = F.lit(None).cast("long")
        io.publish({MASTER: vendors.select("vendor_id", *ATTRS, "is_active").withColumns(
            {"row_seq": none, "change_seq": none, "day_key": none}), DIM: dim}, root, run_id="begin")


def next_dimension(base: DataFrame, master: DataFrame, profiles: DataFrame, day) -> tuple[DataFrame, DataFrame]:
    """The day's dimension, and the keys of its new rows (vendor_id, day_key)."""
    rows = new_dim_vendors(master, profiles, base, day).unionByName(scd2_changes(master, profiles, base, day)) \
        .dropDuplicates(["vendor_id"]).join(master.select("vendor_id", "day_key"), "vendor_id", "left")
    taken = base.select("vendor_key").unionByName(master.select(F.col("day_key").alias("vendor_key")))
    cols = [c for c in rows.columns if c != "day_key"]
    fresh = assign_keys(rows.filter(F.col("day_key").isNull()).select(*cols), taken, "vendor_key", ["vendor_id"])
    keyed = fresh.unionByName(rows.filter(F.col("day_key").isNotNull())
                              .select(F.col("day_key").alias("vendor_key"), *cols))
    out = scd2_close(base.unionByName(_as_dim_rows(keyed, base)), day)
    return out, keyed.select("vendor_id", F.col("vendor_key").alias("day_key"))


def merge_batch(spark: SparkSession, root: str, changes: DataFrame, profiles: DataFrame, day, run_id: str) -> bool:
    """Merge one batch of changes and publish the result; False if nothing in it was new."""
    based_on = io.manifest(spark, root)
    master = spark.read.parquet(*io.table_paths(spark, root, MASTER))
    seen = master.select("vendor_id", F.col("row_seq").alias("m_row"), F.col("change_seq").alias("m_any"))

    def newer(seq, known):
        return F.col(seq).isNotNull() & (F.col(known).isNull() | (F.col(seq) > F.col(known)))

    news = change_registers(changes).join(seen, "vendor_id", "left").filter(
        newer("row_seq", "m_row") | newer("change_seq", "m_any"))
    if news.isEmpty():
        return False
    merged = apply_cdc(master, changes).join(master.select("vendor_id", "day_key"), "vendor_id", "left")
    # stored first: the dimension and the keys are derived from what was merged, once
    path = f"{root}/_staging/{MASTER}-{run_id}"
    merged.write.mode("overwrite").parquet(path)
    merged = spark.read.parquet(path)
    dim, keys = next_dimension(io.read_table(spark, root, BASE, io.read_table(spark, root, DIM).schema), merged, profiles, day)
    kept = merged.withColumnRenamed("day_key", "_before").join(keys, "vendor_id", "left") \
                 .withColumn("day_key", F.coalesce("day_key", "_before")).drop("_before")
    io.publish({MASTER: kept.select(*master.columns), DIM: dim}, root, run_id=run_id,
               based_on={n: based_on.get(n) for n in (MASTER, DIM, BASE)})
    return True


def stream_vendor_cdc(spark: SparkSession, source_dir: str, root: str, checkpoint_dir: str, profiles: DataFrame, as_of,
                      max_bytes_per_trigger: int = 1 << 30, max_files_per_trigger: int | None = None):
    """Merge a directory of change files (``CDC_SCHEMA``, Parquet) into the
    database under ``root``, which ``begin`` has set up; returns the finished
    ``StreamingQuery``. ``as_of``: the day of the new versions."""
    bound = (("maxFilesPerTrigger", str(int(max_files_per_trigger))) if max_files_per_trigger
             else ("maxBytesPerTrigger", str(int(max_bytes_per_trigger))))
    begin_day(spark, root, as_of)
    start = f"{as_date(as_of):%Y%m%d}-{io.manifest_number(spark, root)}"

    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(spark, root, batch, profiles, as_of, f"{start}-{epoch_id}")

    q = (spark.readStream.schema(CDC_SCHEMA).option(*bound).parquet(source_dir)
         .writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def order_changes(purchase_orders: DataFrame) -> DataFrame:
    """A change feed from purchase orders: every order restates its vendor's
    tier by the order's value, some orders end a vendor, some begin one."""
    number = F.substring("po_id", 2, 30).cast("long")
    tier = F.when(F.col("total_amount") > 200000, "Strategic").when(F.col("total_amount") > 120000, "Preferred") \
        .when(F.col("total_amount") > 60000, "Approved").otherwise("Tactical")
    op = F.when(number % 13 == 5, "D").when(number % 11 == 3, "I").otherwise("U")
    vendor = F.when(number % 11 == 3, F.concat(F.lit("W"), F.lpad((number % 211).cast("string"), 6, "0"))) \
        .otherwise(F.col("vendor_id"))
    gone = op == "D"
    return purchase_orders.select(
        op.alias("op"), vendor.alias("vendor_id"), *[F.when(~gone, c).alias(n) for n, c in (
            ("vendor_name", F.concat(F.lit("Vendor "), vendor)), ("vendor_tier", tier),
            ("diversity_classification", F.when(number % 2 == 0, "Women")),
            ("country", F.concat(F.lit("Country "), (number % 7).cast("string"))),
            ("region", F.concat(F.lit("Region "), (number % 3).cast("string"))), ("is_active", number % 17 != 2))],
        number.alias("change_seq"))


def streamed_dimension(T, as_of) -> DataFrame:
    """The dimension after streaming the orders' changes over the given
    tables: the changes arrive as files in an order of their own, a third of
    them a second time. Surrogate keys are left out: they tell the order in
    which the vendors' changes came."""
    import uuid

    from ..session import ensure_checkpoint_dir
    spark = T["purchase_orders"].sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cdc-{uuid.uuid4().hex}"
    begin(spark, f"{root}/db", T["vendors"], T["dim_vendors"])
    feed = order_changes(T["purchase_orders"])
    again = feed.filter(F.col("change_seq") % 3 == 0)
    arrived = feed.unionByName(again).withColumn("_at", F.xxhash64(F.lit(3), "change_seq"))
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    arrived.repartitionByRange(files, "_at").drop("_at").write.parquet(f"{root}/feed")
    stream_vendor_cdc(spark, f"{root}/feed", f"{root}/db", f"{root}/state", T["supplier_profiles"], as_of,
                      max_files_per_trigger=max(2, -(-files // 3)))
    return io.read_table(spark, f"{root}/db", DIM, T["dim_vendors"].schema).drop("vendor_key")
