"""Reading and writing the operational and star databases.

A "database" is a directory of Parquet tables, one sub-directory per table.
Writes never overwrite a table that is being read: every load is written to
new version directories, and a manifest for the whole database names the
version directories that make up each table (one, or several where loads were
added to it). Manifests are numbered files that are never changed; publishing
creates the next number by a rename that fails if another publisher was
faster, and then starts over from that publisher's manifest. So readers see
either the old or the new set of tables, and no publisher undoes another.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import schemas

MANIFEST = "_MANIFEST"
KEPT_MANIFESTS = 50          # older ones are removed: readers only open the newest


def _jfs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _jfs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()     # the manifest is one line
    finally:
        reader.close()
    return line.strip() if line else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jfs(spark, path)
    return fs.exists(p)


class PublishConflict(RuntimeError):
    """Another publisher changed a table that a publish was based on."""


def _manifest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; 0 and nothing before the first."""
    fs, p = _jfs(spark, f"{root}/{MANIFEST}")
    for _ in range(10):
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        number = max((int(n) for n in found if n.isdigit()), default=0)
        if not number:
            return 0, {}
        text = _read_text(spark, f"{root}/{MANIFEST}/{number:012d}")
        if text:                     # else removed meanwhile: newer ones exist
            return number, json.loads(text)
    raise RuntimeError(f"{root}: no readable manifest")


def manifest_number(spark: SparkSession, root: str) -> int:
    """How often something was published under ``root``."""
    return _manifest(spark, root)[0]


def manifest(spark: SparkSession, root: str) -> dict:
    """Current version of each published table under ``root``; a list where a table has several."""
    return _manifest(spark, root)[1]


def table_versions(spark: SparkSession, root: str, name: str, now: Mapping | None = None) -> list[str]:
    """Versions that make up table ``name``: "." for a plain Parquet directory, none if there is no table."""
    version = (manifest(spark, root) if now is None else now).get(name)
    if version:
        return [version] if isinstance(version, str) else list(version)
    fs, p = _jfs(spark, f"{root}/{name}")
    plain = fs.exists(p) and not any(s.isDirectory() and s.getPath().getName().startswith("v") for s in fs.listStatus(p))
    return ["."] if plain else []


def table_paths(spark: SparkSession, root: str, name: str) -> list[str]:
    """Current version directories of table ``name`` under ``root``; a table
    that was never published is a plain Parquet directory. Version
    directories without a manifest entry are an unfinished load: an error,
    never a read across versions."""
    versions = table_versions(spark, root, name)
    if not versions and exists(spark, f"{root}/{name}"):
        raise FileNotFoundError(f"{root}/{name} has versions but no published one")
    return [f"{root}/{name}/{v}" if v != "." else f"{root}/{name}" for v in versions or ["."]]


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """The newest version directory of table ``name``."""
    return table_paths(spark, root, name)[-1]


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    schema = schema or schemas.ALL.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*table_paths(spark, root, name))


class ParquetTables(Mapping):
    """``name -> DataFrame`` over a database directory, read with the
    fixed schemas. Tables are opened lazily and once."""

    def __init__(self, spark: SparkSession, root: str, names: Iterable[str] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.names = list(names) if names is not None else list(schemas.ALL)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.root, name)
        return self._cache[name]

    def __iter__(self):
        return iter(self.names)

    def __len__(self):
        return len(self.names)


def read_tables(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> ParquetTables:
    return ParquetTables(spark, root, names)


#: Tables that grow with the business: they are read over many connections only.
LARGE_TABLES = ("spend_transactions", "purchase_orders", "po_line_items", "fact_spend_analytics")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              schema: StructType | None = None, column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """S1 for a live relational source; the result is cast to the fixed
    schema so downstream code sees the same types. ``column`` (numeric or
    date), its bounds and the number of partitions split the read; one
    connection for a large table is refused."""
    split = (column, lower, upper, partitions)
    if any(x is None for x in split) and (any(x is not None for x in split) or table in LARGE_TABLES):
        raise ValueError(f"{table}: give column, lower, upper and partitions")
    df = (spark.read.jdbc(url, table, properties=properties or {}) if column is None else
          spark.read.jdbc(url, table, column, lower, upper, partitions, properties=properties or {}))
    schema = schema or schemas.ALL.get(table)
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform(df: DataFrame, schema: StructType, defaults: Mapping | None = None,
            drop: Iterable[str] = ()) -> DataFrame:
    """Shape ``df`` like ``schema`` by name: missing columns get their
    default (or a typed NULL), present ones are cast; a NULL in a column with
    a default takes the default. Columns that the schema does not have are an
    error unless named in ``drop``."""
    defaults = defaults or {}
    extra = set(df.columns) - set(schema.fieldNames()) - set(drop)
    if extra:
        raise ValueError(f"columns without a place in the table: {sorted(extra)}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
            if f.name in defaults:
                c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        else:
            c = F.lit(defaults.get(f.name)).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append(df: DataFrame, root: str, name: str, schema: StructType | None = None) -> None:
    """``INSERT INTO name SELECT ...``: rows are shaped like the table
    (defaults for missing columns) and appended to its current version."""
    spark = df.sparkSession
    schema = schema or schemas.ALL[name]
    conform(df, schema, schemas.DEFAULTS.get(name)).write.mode("append").parquet(table_path(spark, root, name))


def create_star(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> list[str]:
    """Empty star tables with their fixed schemas."""
    names = list(names) if names is not None else list(schemas.STAR)
    for name in names:
        spark.createDataFrame([], schemas.STAR[name]).write.mode("errorifexists").parquet(f"{root}/{name}/v0")
    _switch(spark, root, lambda now: dict.fromkeys(names, "v0"))
    return names


def copy_star(src: Mapping[str, DataFrame], target_schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """S3: positional copy (``INSERT INTO t SELECT * FROM s``): column i of the
    source goes to column i of the target. Arity must match."""
    out = {}
    for name, schema in target_schemas.items():
        df = src[name]
        if len(df.columns) != len(schema.fields):
            raise ValueError(f"{name}: source has {len(df.columns)} columns, target {len(schema.fields)}")
        out[name] = df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)])
    return out


def copy_star_counts(T: Mapping[str, DataFrame], names=("dim_vendors", "dim_commodities", "dim_time",
                                                        "fact_spend_analytics")) -> DataFrame:
    """S3 as a check: per table copied into the star schemas, its rows and a
    sum over its rows' values (one aggregate each). A column in the wrong
    place or lost in a cast changes the sum."""
    copied = copy_star(T, {n: schemas.STAR[n] for n in names})
    parts = []
    for n, df in copied.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _stable_columns(df.schema)])
        parts.append(df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                            F.coalesce(F.sum(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")),
                                       F.lit(0)).alias("value_sum")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stable_columns(schema: StructType) -> list[str]:
    """Columns whose text form is the same everywhere (integers, strings, dates)."""
    return [f.name for f in schema.fields if f.dataType.typeName() in ("integer", "long", "string", "date")]


def table_info(T: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table of ``T``, one count
    aggregate per table unioned into one result."""
    parts = [T[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in T]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_sizes(T: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes behind each table: one directory summary per table for
    stored tables (no per-file calls from the driver), else the sizes of the
    DataFrame's input files."""
    spark = next(iter(T.values())).sparkSession
    sizes = {}
    for n in T:
        if isinstance(T, ParquetTables):
            paths = [_jfs(spark, p) for p in table_paths(spark, T.root, n)]
            sizes[n] = sum(fs.getContentSummary(p).getLength() for fs, p in paths)
        else:
            sizes[n] = sum(_jfs(spark, f)[0].getFileStatus(_jfs(spark, f)[1]).getLen() for f in T[n].inputFiles())
    return sizes


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, or not at all: False if it exists."""
    fs, target = _jfs(spark, path)
    jvm = spark.sparkContext._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        fs.delete(fresh, False)
        return False


def _switch(spark: SparkSession, root: str, change, based_on: Mapping | None = None, tries: int = 100) -> None:
    """Publish ``change`` (manifest -> the tables' new entries) as the next
    manifest, over and over until no other publisher was faster. ``based_on``:
    entries that must not have changed meanwhile (``PublishConflict``)."""
    for _ in range(tries):
        number, now = _manifest(spark, root)
        moved = [n for n, v in (based_on or {}).items() if now.get(n) != v]
        if moved:
            raise PublishConflict(f"{root}: {', '.join(sorted(moved))} changed since this run read them")
        text = json.dumps({**now, **change(now)}, sort_keys=True)
        if _create_once(spark, f"{root}/{MANIFEST}/{number + 1:012d}", text):
            fs, old = _jfs(spark, f"{root}/{MANIFEST}/{number + 1 - KEPT_MANIFESTS:012d}")
            if number >= KEPT_MANIFESTS:
                fs.delete(old, False)
            return
    raise RuntimeError(f"{root}: {tries} publishers were faster")


def _written(df: DataFrame, root: str, name: str, version: str, partition_by=None) -> None:
    """Write an unpublished version; what a stopped run of that name left is replaced."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root}/{name}/{version}")


def publish(outputs: Mapping[str, DataFrame], root: str, checks=None, partition_by: Mapping | None = None,
            run_id: str | None = None, based_on: Mapping | None = None, add: Iterable[str] = ()) -> str:
    """All-or-nothing load.

    Every output is written to a new version directory ``<table>/v<run_id>``
    (never over the data being read). ``checks`` (callable receiving the
    written tables, returning True/False) runs on the written data; only when
    it passes does the manifest switch, for all outputs at once. On failure
    nothing is published and the staged versions are left for inspection.

    Tables in ``add`` get the version added to the ones they have; the others
    are replaced by it. A run that was stopped is run again under its
    ``run_id``: what it left unpublished is written anew, what it published
    stays as it is. Concurrent publishers of different tables both succeed;
    ``based_on`` (entries of ``manifest`` that the outputs were computed from)
    makes a publish fail instead of undoing another one's.
    """
    if not outputs:
        return ""
    spark = next(iter(outputs.values())).sparkSession
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4().hex[:8]}"
    version, add = f"v{run_id}", set(add)
    if all(version in table_versions(spark, root, n) for n in outputs):
        return version
    before = {n: table_versions(spark, root, n) for n in add}
    written = {}
    for name, df in outputs.items():
        _written(df, root, name, version, (partition_by or {}).get(name))
        written[name] = spark.read.schema(df.schema).parquet(f"{root}/{name}/{version}")
    if checks is not None and not checks(written):
        raise RuntimeError(f"checks failed; run {run_id} staged but not published")

    def change(now: dict) -> dict:
        out = {}
        for name in outputs:
            have = table_versions(spark, root, name, {name: before[name], **now}) if before.get(name) else []
            out[name] = [*(v for v in have if v != version), version] if have else version
        return out

    _switch(spark, root, change, based_on)
    return version


def publish_parts(df: DataFrame, root: str, name: str, part: str, values: Iterable | None, run_id: str) -> str:
    """S6 for a part of a table: the rows of ``df`` replace the published rows
    whose ``part`` is among ``values`` (None: all rows); every other part stays
    in the files that it has. The table's versions are its parts
    (``v<run_id>/part=<value>``)."""
    spark, version = df.sparkSession, f"v{run_id}"
    # the column is stored in the files as well: a part is read by its own path
    df.withColumn("part", F.col(part)).write.mode("overwrite").partitionBy("part").parquet(f"{root}/{name}/{version}")
    fs, p = _jfs(spark, f"{root}/{name}/{version}")
    new = sorted(f"{version}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.getPath().getName().startswith("part="))

    def change(now: dict) -> dict:
        if values is None:
            return {name: new}
        gone = {f"part={v}" for v in values}
        have = [now[name]] if isinstance(now.get(name), str) else now.get(name, [])
        if any("/part=" not in v for v in have):
            raise ValueError(f"{root}/{name} is published as a whole: publish all its parts first")
        return {name: [v for v in have if v.rsplit("/", 1)[-1] not in gone] + new}

    _switch(spark, root, change)
    return version


def note(spark: SparkSession, root: str, entry: str, value: str) -> None:
    """Add ``value`` to the list ``entry`` of the manifest."""
    _switch(spark, root, lambda now: {entry: sorted({*now.get(entry, []), value})})


def write_reports(reports: Mapping[str, DataFrame], root: str, run_id: str | None = None) -> str:
    """One Parquet directory per report under a run folder."""
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4().hex[:8]}"
    for name, df in reports.items():
        df.write.mode("errorifexists").parquet(f"{root}/{run_id}/{name}")
    return run_id
