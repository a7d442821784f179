"""Streaming loads: spend transactions arriving as files, vendor CDC feed.

The fact load runs on Structured Streaming with ``foreachBatch``: each
micro-batch is turned into the same batch operator the daily load uses, and the
write is replay-safe (a micro-batch replayed after a failure adds nothing
twice: its transactions are looked up in the index of loaded ids, without its
own earlier attempt). The CDC functions are batch functions over one set of
changes; ``vendor_cdc`` runs them as a stream. No server or port is involved:
the source is a directory, ``trigger(availableNow=True)`` processes what is
there and stops.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.facts import fact_spend_new
from ..operators.scd2 import scd2_apply
from ..sources import schemas
from ..sources.io import exists
from ..sources.loaded_ids import BUCKETS, add_ids, loaded_ids
from ..sources.schemas import _st


def _read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not exists(spark, path):        # first batch: target not written yet
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


FACT_COLS = ("fact_key", "vendor_key", "commodity_key", "time_key", "spend_amount", "transaction_count", "quantity",
             "unit_price", "source_transaction_id", "load_date")


def _fact_schema() -> StructType:
    return StructType([f for f in schemas.STAR["fact_spend_analytics"].fields if f.name in FACT_COLS])


def read_stream_target(spark: SparkSession, target_dir: str) -> DataFrame:
    """Facts written by ``stream_fact_load`` (all micro-batch folders)."""
    return _read_or_empty(spark, target_dir, _fact_schema()).select(*FACT_COLS)


def stream_fact_load(spark: SparkSession, source_dir: str, dims: Mapping[str, DataFrame], target_dir: str,
                     checkpoint_dir: str, as_of, max_bytes_per_trigger: int = 10 << 30,
                     loaded: DataFrame | None = None, max_files_per_trigger: int | None = None,
                     ids_dir: str | None = None, buckets: int = BUCKETS):
    """Load new facts from a directory of spend-transaction files.

    ``dims`` holds dim_vendors, dim_commodities and dim_time; ``loaded``
    (optional) holds facts loaded before the stream started. Returns the
    finished ``StreamingQuery`` (availableNow: processes the backlog and
    stops).

    A micro-batch holds at most ``max_bytes_per_trigger`` of files
    (``max_files_per_trigger`` bounds their number instead, for tests). Its
    transaction ids are looked up in the index of loaded ids in ``ids_dir``
    (default: ``<target_dir>_ids``), which takes in ``loaded`` when it is new;
    no micro-batch reads facts. Each micro-batch overwrites its own folder,
    named after the checkpoint and its number, and counts its own earlier ids
    as not loaded, so one replayed after a failure rewrites the same output. A
    stream started anew with another checkpoint finds every transaction of the
    earlier one loaded.
    """
    bound = (("maxFilesPerTrigger", str(int(max_files_per_trigger))) if max_files_per_trigger
             else ("maxBytesPerTrigger", str(int(max_bytes_per_trigger))))
    stream = (spark.readStream.schema(schemas.OPERATIONAL["spend_transactions"])
              .option(*bound).parquet(source_dir))
    fact_schema = _fact_schema()
    ids_dir = ids_dir or f"{target_dir.rstrip('/')}_ids"
    if loaded is not None and not exists(spark, f"{ids_dir}/_SUCCESS"):
        add_ids(spark, ids_dir, loaded, "before", buckets)
    name = f"{zlib.crc32(checkpoint_dir.encode()):08x}"

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        run = f"{name}-{epoch_id}"
        new = fact_spend_new(batch, dims["dim_vendors"], dims["dim_commodities"], dims["dim_time"], None, as_of,
                             index=loaded_ids(spark, ids_dir, without=run, buckets=buckets))
        path = f"{target_dir}/epoch={run}"
        new.select(*[F.col(f.name).cast(f.dataType) for f in fact_schema.fields]).write.mode("overwrite").parquet(path)
        add_ids(spark, ids_dir, spark.read.schema(fact_schema).parquet(path), run, buckets)

    q = (stream.writeStream.foreachBatch(load_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


CDC_SCHEMA = _st(
    "op string, vendor_id string, vendor_name string, vendor_tier string, diversity_classification string, "
    "country string, region string, is_active boolean, change_seq bigint")


ATTRS = ["vendor_name", "vendor_tier", "diversity_classification", "country", "region"]


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last change per vendor (highest ``change_seq``) as a
    ``max_by`` aggregate: combined map-side, so a vendor with very many
    changes does not land whole in one task."""
    cols = [c for c in CDC_SCHEMA.fieldNames() if c not in ("vendor_id", "change_seq")]
    last = changes.groupBy("vendor_id").agg(
        F.max_by(F.struct(*cols), F.struct("change_seq", *cols)).alias("_last"), F.max("change_seq").alias("change_seq"))
    return last.select("vendor_id", "_last.*", "change_seq")


def change_registers(changes: DataFrame) -> DataFrame:
    """Per vendor the last insert or update (``row_seq`` and its attributes)
    and the last change of any kind (``change_seq``, ``active``). Each is a
    maximum, so the order in which changes arrive, repeats and the cuts between
    batches do not matter. Changes without a vendor, a sequence number or a
    known operation are left out."""
    known = changes.filter(F.col("vendor_id").isNotNull() & F.col("change_seq").isNotNull() & F.col("op").isin("I", "U", "D"))
    upsert = F.col("op") != "D"
    active = F.when(upsert, F.coalesce("is_active", F.lit(True))).otherwise(F.lit(False))
    row = F.struct("change_seq", *ATTRS)
    return known.groupBy("vendor_id").agg(
        F.max(F.when(upsert, row)).alias("_row"), F.max(F.struct("change_seq", active.alias("active"))).alias("_any")) \
        .select("vendor_id", F.col("_row.change_seq").alias("row_seq"), *[F.col(f"_row.{a}").alias(a) for a in ATTRS],
                F.col("_any.change_seq").alias("change_seq"), F.col("_any.active").alias("is_active"))


def apply_cdc(vendors: DataFrame, changes: DataFrame) -> DataFrame:
    """Vendor master after a set of inserts, updates and deletes: the
    attributes of the last insert or update, active unless the last change is a
    delete (which marks the vendor inactive: history stays in the dimension).

    ``vendors`` may carry ``row_seq`` and ``change_seq``, the sequence numbers
    that its rows already have; older changes than these are late and change
    nothing, equal ones are replays. Without the columns every change is newer."""
    seqs = ["row_seq", "change_seq"]
    have = vendors.select("vendor_id", *ATTRS, "is_active", *[
        F.col(c) if c in vendors.columns else F.lit(None).cast("long").alias(c) for c in seqs])
    new = change_registers(changes).select("vendor_id", *[F.col(c).alias("c_" + c) for c in [*ATTRS, "is_active", *seqs]])

    def newer(seq):
        return F.col("c_" + seq).isNotNull() & (F.col(seq).isNull() | (F.col("c_" + seq) > F.col(seq)))

    j = have.join(new, "vendor_id", "full_outer").filter(F.col("vendor_id").isNotNull())
    out = [F.col("vendor_id")]
    for cols, seq in ((ATTRS, "row_seq"), (["is_active"], "change_seq")):
        out += [F.when(newer(seq), F.col("c_" + c)).otherwise(F.col(c)).alias(c) for c in cols]
    if "row_seq" in vendors.columns:
        out += [F.when(newer(c), F.col("c_" + c)).otherwise(F.col(c)).alias(c) for c in seqs]
    return j.select(*out)


def cdc_to_dimension(dim: DataFrame, vendors: DataFrame, profiles: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """Apply a CDC batch to the vendor master, then the SCD2 step."""
    return scd2_apply(dim, apply_cdc(vendors, changes), profiles, as_of)


def streamed_backlog(T: Mapping[str, DataFrame], as_of, max_bytes_per_trigger: int = 10 << 30) -> DataFrame:
    """Z1 over the given tables: the transactions, as their own partitions,
    become arriving files under the shared checkpoint folder; they are
    streamed into a fresh target in micro-batches bounded by bytes (facts
    already in the star count as loaded), and the target is returned. Equal to
    the batch backlog load (F1) by construction; the test is that equality."""
    import uuid

    from ..session import ensure_checkpoint_dir
    spark = T["spend_transactions"].sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    T["spend_transactions"].write.parquet(f"{root}/source")
    dims = {k: T[k] for k in ("dim_vendors", "dim_commodities", "dim_time")}
    stream_fact_load(spark, f"{root}/source", dims, f"{root}/facts", f"{root}/state", as_of,
                     max_bytes_per_trigger=max_bytes_per_trigger, loaded=T["fact_spend_analytics"])
    return read_stream_target(spark, f"{root}/facts")
