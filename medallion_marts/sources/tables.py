"""Stored tables: a database of Spark's session catalog.

An entity has two tables. `<name>_versions` holds every version, in a partition for each load; a
load of the same name replaces its partition, so a night can be run again. `<name>` holds the
newest version of each key, clustered into buckets by the columns that joins use and partitioned
into slices by a hash of the key: it is read and joined without a shuffle, and a load rewrites only
the slices that its keys are in.

A mart, and an entity's versions, are views of the table written last: a replacement writes a new
table and repoints the view in one step. Readers see the old state or the new one; the table before
stays until the next replacement, for those that still read it.

All are stored with zstd. What a write shuffles goes when it ends (`without_leftovers`).

One job at a time may change a table, as the nightly job does; readers may come at any time.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.latest import conform, latest_state
from .catalog import Catalog, table_spec

#: What entities are joined by, and so clustered by.
BUCKETED_BY = {
    "property_address": ("tenant_id", "property_id"),
    "property_unit": ("tenant_id", "property_id"),
    "property_owner": ("tenant_id", "property_id"),
    "demand": ("tenant_id", "consumer_code"),
    "payment": ("tenant_id", "billid"),
    "bill": ("tenant_id", "bill_id"),
    "bill_detail": ("tenant_id", "bill_id"),
    "assessment": ("tenant_id", "propertyid"),
}
#: Rows of a load whose keys are broadcast to the newest state; larger loads are shuffled with it.
SMALL_LOAD = 100_000
#: Rows of newest state that one bucket is to hold: a task sorts and writes a bucket at a time.
ROWS_A_BUCKET = 1_000_000
#: The stored rows of `change_metrics`, in a partition for each load of snapshots.
CHANGES = "property_change_history"
CODEC = "zstd"
#: Spark's setting by which an execution deletes its shuffle files when it ends; else they stay until the driver's heap is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes, _lock = {}, threading.Lock()


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for a database whose largest entity has so many rows."""
    return max(least, -(-rows // ROWS_A_BUCKET))


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Executions started inside delete their shuffle files as they end; the session's setting is put back after the last of several writes at once."""
    key = id(spark._jsparkSession), spark.sparkContext.applicationId
    with _lock:
        n, before = _writes.get(key, (0, None))
        _writes[key] = n + 1, spark.conf.get(CLEANUP, None) if n == 0 else before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writes.pop(key)
            if n > 1:
                _writes[key] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class TableCatalog(Catalog):
    """Tables of `database`, kept below `location` if it is made here.

    buckets: as many as make about 256 MB of newest state each (`buckets_for` the largest entity's rows), the
    same for all tables, so that they join without a shuffle. slices: the more, the less a small
    load rewrites; a load with more keys than slices rewrites nearly all.
    """

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, buckets: int = 8, slices: int = 4, zone: str | None = None):
        super().__init__(spark, zone)
        self.database, self.buckets, self.slices = database, buckets, slices
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION {_quoted(location)}" if location else ""))

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    # Views of the table written last

    def _new(self, view: str) -> str:
        return f"{view}__{time.time_ns():020d}"

    def _behind(self, view: str) -> str:
        """The table that a view shows."""
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(view)}").collect()}["table"]

    def _repoint(self, view: str, table: str) -> None:
        before = self._behind(view) if self.exists(view) else None
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} TBLPROPERTIES ('table' = '{table}') AS SELECT * FROM {self.name(table)}")
        for t in self.spark.catalog.listTables(self.database, f"{view}__*"):
            if t.name not in (table, before):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(t.name)}")

    # Entities

    def _slice(self, name: str) -> Column:
        return F.pmod(F.hash(*table_spec(name).keys), F.lit(self.slices))

    def _create(self, name: str) -> None:
        spec, versions = table_spec(name), f"{name}_versions"
        if not self.exists(versions):
            table = self._new(versions)
            self._create_versions(name, table)
            self._repoint(versions, table)
        if spec.version:
            self._create_newest(name)

    def _create_newest(self, name: str) -> None:
        spec = table_spec(name)
        if not self.exists(name):
            by = ", ".join(BUCKETED_BY.get(name, spec.keys))
            self.spark.sql(
                f"CREATE TABLE {self.name(name)} ({_columns(spec.schema)}, slice int) USING parquet OPTIONS (partitionOverwriteMode 'dynamic', compression '{CODEC}') "
                f"PARTITIONED BY (slice) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS"
            )

    def _create_versions(self, name: str, table: str) -> None:
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({_columns(table_spec(name).schema)}, load string) USING parquet OPTIONS (compression '{CODEC}') PARTITIONED BY (load)")

    def _partitions(self, table: str, of: str = "") -> int:
        return len(self.spark.sql(f"SHOW PARTITIONS {self.name(table)} {of}").take(1))

    def _insert_load(self, name: str, rows: DataFrame, table: str, load: str) -> None:
        """Writes rows as the partition `load` of a table of versions, in place of what is there."""
        view = f"_load_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            names = ", ".join(f"`{c}`" for c in table_spec(name).schema.names)
            with without_leftovers(self.spark):
                self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION (load = {_quoted(load)}) SELECT {names} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def loads(self, name: str) -> DataFrame:
        """All versions with the load that each came with."""
        if not self.exists(f"{name}_versions"):
            raise KeyError(f"there is no table {name} in {self.database}")
        return self.spark.table(self.name(f"{name}_versions"))

    def versions(self, name: str) -> DataFrame:
        return self.loads(name).drop("load")

    def latest(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise KeyError(f"there is no table {name} in {self.database}")
        return self.spark.table(self.name(name)).drop("slice")

    def latest_by(self, name: str, load: str) -> DataFrame:
        """The newest state that loads up to `load`, in the order of their names, have made."""
        spec, loads = table_spec(name), self.loads(name)
        if not loads.where(F.col("load") > load).take(1):
            return self.latest(name)
        return latest_state(loads.where(F.col("load") <= load).drop("load"), spec.keys, spec.version, ["_ingested_at"] if "_ingested_at" in spec.schema.names else [])

    def upsert(self, name: str, df: DataFrame, load: str | None = None) -> None:
        """Adds a load of versions and brings the newest state up to date. A load of a name that is there replaces it."""
        spec, load = table_spec(name), load or f"{time.time_ns():020d}"
        self._create(name)
        if "_ingested_at" in spec.schema.names and "_ingested_at" not in df.columns:
            df = df.withColumn("_ingested_at", F.current_timestamp())
        table = self._behind(f"{name}_versions")
        again = self._partitions(table, f"PARTITION (load = {_quoted(load)})") > 0
        loaded = lambda: self.loads(name).where(F.col("load") == load).drop("load").withColumn("slice", self._slice(name))
        touched = self._touched(loaded()) if again and spec.version else set()
        self._insert_load(name, conform(df, spec.schema, spec.defaults), table, load)
        if spec.version:
            self._bring_up(name, loaded(), touched, again)

    def _touched(self, rows: DataFrame) -> set[int]:
        """The slices that rows are in: at most `slices` numbers."""
        return {r[0] for r in rows.select("slice").distinct().collect()}

    def _bring_up(self, name: str, loaded: DataFrame, touched: set[int], again: bool) -> None:
        spec = table_spec(name)
        keys, ties = list(spec.keys), [c for c in ("_ingested_at",) if c in spec.schema.names]
        incoming = latest_state(loaded, keys, spec.version, ties)
        if again:  # what the load held before may be gone: its slices are worked out anew
            touched = touched | self._touched(loaded)
            rows = self.versions(name).withColumn("slice", self._slice(name)).where(F.col("slice").isin(*touched))
            for k in touched - self._touched(rows):
                self.spark.sql(f"ALTER TABLE {self.name(name)} DROP IF EXISTS PARTITION (slice = {k})")
            self._write_newest(name, latest_state(rows, keys, spec.version, ties))
        else:
            self._merge(name, loaded, incoming)

    def _merge(self, name: str, loaded: DataFrame, incoming: DataFrame) -> None:
        """Puts a load (its rows, and the newest of each key) into the newest state, where it is not older than what is stored."""
        spec = table_spec(name)
        keys, ties = list(spec.keys), [c for c in ("_ingested_at",) if c in spec.schema.names]
        if not self._partitions(name):  # nothing to look through: the first load is read once
            self._write_newest(name, incoming)
            return
        touched = self._touched(loaded)
        if not touched:
            return
        stored = self.spark.table(self.name(name)).where(F.col("slice").isin(*touched))
        if loaded.limit(SMALL_LOAD + 1).count() > SMALL_LOAD:
            self._write_newest(name, latest_state(stored.unionByName(loaded), keys, spec.version, ties))
            return
        # A small load is broadcast: stored rows move only to be written.
        age = F.struct(spec.version, *ties)
        arrived = F.broadcast(incoming.select(*keys, age.alias("_arrived")))
        older = stored.join(arrived, keys).where(age > F.col("_arrived")).select(*keys)
        newer = incoming.join(F.broadcast(older), keys, "left_anti")
        self._write_newest(name, stored.join(F.broadcast(newer.select(*keys)), keys, "left_anti").unionByName(newer))

    def keep_newest(self, name: str, rows: DataFrame, anew: bool = False) -> None:
        """Brings a table that has a newest state only up to date with rows, or makes it of them."""
        spec = table_spec(name)
        self._create_newest(name)
        incoming = latest_state(rows, spec.keys, spec.version, ["_ingested_at"]).withColumn("slice", self._slice(name))
        if anew:
            self.spark.sql(f"TRUNCATE TABLE {self.name(name)}")
        self._merge(name, rows.withColumn("slice", self._slice(name)), incoming)

    def _write_newest(self, name: str, rows: DataFrame) -> None:
        """Overwrites the slices of rows. Each task writes one bucket."""
        spec = table_spec(name)
        rows = rows.repartition(self.buckets, *BUCKETED_BY.get(name, spec.keys)).select(*spec.schema.names, "slice")
        with without_leftovers(self.spark):
            rows.write.mode("overwrite").insertInto(f"{self.database}.{name}")

    def compact(self, name: str) -> None:
        """Keeps the newest version of each key only, as one load; loads that it holds can't be replaced any more."""
        versions = f"{name}_versions"
        table = self._new(versions)
        self._create_versions(name, table)
        self._insert_load(name, self.latest(name), table, f"{time.time_ns():020d}")
        self._repoint(versions, table)

    # Changes between audit snapshots

    def change_metrics(self) -> DataFrame | None:
        if not self.exists(CHANGES):
            return None
        stored, there = (self.spark.sql(f"SHOW PARTITIONS {self.name(t)}") for t in (CHANGES, self._behind("property_audit_versions")))
        return None if there.exceptAll(stored).take(1) else self.spark.table(self.name(CHANGES)).drop("load")

    def changes_before(self, load: str) -> tuple[DataFrame, DataFrame, bool]:
        """(each property's last snapshot before a load, the snapshots from it on, whether it is the last load).

        If all loads before it, and none after, are stored as changes already, last snapshots are read
        from their own table, and of the history only the load itself; else the history is read.
        """
        history = self.loads("property_audit")
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(CHANGES)}").collect()} if self.exists(CHANGES) else set()
        there = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(self._behind('property_audit_versions'))}").collect()}
        mine = f"load={load}"
        if there and max(there) == mine and known and known == there - {mine}:
            return self.latest("property_audit_last"), history.where(F.col("load") == load), True
        spec = schemas.LAST_AUDIT
        before = latest_state(history.where(F.col("load") < load).drop("load"), spec.keys, spec.version, ["_ingested_at"])
        return before, history.where(F.col("load") >= load), False

    def put_changes(self, changes: DataFrame) -> None:
        """Stores changes (with `load`) in place of those of the same loads."""
        if not self.exists(CHANGES):
            self.spark.sql(f"CREATE TABLE {self.name(CHANGES)} ({schemas.MARTS['property_change_metrics']}, load string) USING parquet OPTIONS (partitionOverwriteMode 'dynamic', compression '{CODEC}') PARTITIONED BY (load)")
        with without_leftovers(self.spark):
            changes.select(*schemas.mart_schema("property_change_metrics").names, "load").write.mode("overwrite").insertInto(f"{self.database}.{CHANGES}")

    # Marts

    def mart(self, name: str) -> DataFrame:
        return self.spark.table(self.name(f"mart_{name}")) if self.exists(f"mart_{name}") else super().mart(name)

    def replace_mart(self, name: str, df: DataFrame) -> None:
        """Writes df as the whole mart; it may read the mart itself."""
        table = self._new(f"mart_{name}")
        with without_leftovers(self.spark):
            df.write.format("parquet").option("compression", CODEC).saveAsTable(f"{self.database}.{table}")
        self._repoint(f"mart_{name}", table)

    def counts_report(self, names: list[str]) -> DataFrame:
        """(table_name, rows) of stored entities' versions and marts."""
        stored = lambda n: self.mart(n) if n in schemas.MARTS else self.versions(n)
        parts = [stored(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in names]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
