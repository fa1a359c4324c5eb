"""State on Parquet: upserts, insert-or-ignore, run log, flag queue and skipping of unchanged sources.

A table is a folder of versions with a pointer file; a write goes to a new version and swaps the pointer, so readers
see the old or the new table and a lost job leaves the old one. Merges are joins by key: no row is looped over.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Table:
    """A versioned Parquet table; `create` is idempotent."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def create(self) -> Table:
        os.makedirs(self.path, exist_ok=True)
        if not os.path.exists(self._pointer):
            self.write(self.spark.createDataFrame([], self.schema))
        return self

    @property
    def _pointer(self) -> str:
        return os.path.join(self.path, "CURRENT")

    @property
    def version(self) -> int:
        try:
            with open(self._pointer) as f:
                return json.load(f)["version"]
        except FileNotFoundError:
            return 0

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(os.path.join(self.path, f"v{self.version}"))

    def write(self, rows: DataFrame) -> None:
        v = self.version + 1
        rows.write.mode("overwrite").parquet(os.path.join(self.path, f"v{v}"))
        with open(self._pointer + ".next", "w") as f:
            json.dump({"version": v}, f)
        os.replace(self._pointer + ".next", self._pointer)


def natural_key(*columns: str) -> Column:
    """A deterministic id from key columns; null and empty differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ("created_at",), recency: Column | None = None, fill: bool = False) -> DataFrame:
    """Rows of both, one per key (null-safe): the new row wins, but `keep` columns stay those of the old row.

    Several new rows of a key are reduced to the first by `recency` (descending). With `fill`, a null in the new row does
    not erase the old value. Other columns of either side are ignored; the result has the old table's columns.
    """
    order = [recency.desc_nulls_last()] if recency is not None else [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[c for c in old.columns if c in new.columns]))
    latest = new.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    o, n = old.alias("o"), latest.select(*[c for c in old.columns if c in new.columns], F.lit(True).alias("_new")).alias("n")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    both = o.withColumn("_old", F.lit(True)).alias("o").join(n, on, "full_outer")

    def pick(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c in keep:
            return F.when(F.col("o._old"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        newer = F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) if fill else F.col(f"n.{c}")
        return F.when(F.col("n._new"), newer).otherwise(F.col(f"o.{c}"))

    return both.select(*[pick(c).alias(c) for c in old.columns])


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and new rows whose key is not there yet (the first of each key)."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}"))
    first = Window.partitionBy(*keys).orderBy(F.xxhash64(*new.columns))
    once = new.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    return old.unionByName(once.alias("n").join(old.alias("o"), on, "left_anti").select(*old.columns))


def finish_run(log: DataFrame, run_id: str, status: str, counts: dict[str, int], at: Column, error: str | None = None) -> DataFrame:
    """The run log with one run's completion."""
    mine = F.col("id") == run_id
    changes = {"status": F.lit(status), "completed_at": at, "errors": F.lit(error)} | {k: F.lit(v) for k, v in counts.items()}
    return log.withColumns({k: F.when(mine, v.cast(log.schema[k].dataType)).otherwise(F.col(k)) for k, v in changes.items()})


def latest_runs(log: DataFrame) -> DataFrame:
    """The latest run of each investor."""
    return log.groupBy("pension_fund_id").agg(F.max_by(F.struct(*[c for c in log.columns if c != "pension_fund_id"]), F.struct("started_at", "id")).alias("r")).select("pension_fund_id", "r.*")


def status_listing(sources: DataFrame, log: DataFrame) -> DataFrame:
    """Every registered source in order with its latest run, or `No runs yet`."""
    return sources.join(latest_runs(log), "pension_fund_id", "left").select("pension_fund_id", F.coalesce("status", F.lit("No runs yet")).alias("status"), "started_at", "records_extracted").orderBy("pension_fund_id")


def changed_sources(hashes: DataFrame, log: DataFrame, force: bool = False) -> DataFrame:
    """(pension_fund_id, source_hash) whose content differs from the last completed run; all of them with `force`."""
    if force:
        return hashes
    done = latest_runs(log.where("status = 'completed'")).select("pension_fund_id", "source_hash")
    return hashes.join(done, ["pension_fund_id", "source_hash"], "left_anti")


def resolve_flags(queue: DataFrame, flag_type: str | None = None, flag_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(queue with the open flags of a type or one id closed, count of those closed)."""
    hit = ~F.col("resolved")
    if flag_type:
        hit = hit & (F.col("flag_type") == flag_type)
    if flag_id:
        hit = hit & (F.col("id") == flag_id)
    return queue.withColumn("resolved", F.col("resolved") | hit), queue.agg(F.count_if(hit).alias("closed"))


def delete_open_flags(queue: DataFrame, flag_type: str) -> tuple[DataFrame, DataFrame]:
    """(queue without the open flags of a type, count of those deleted)."""
    hit = ~F.col("resolved") & (F.col("flag_type") == flag_type)
    return queue.where(~hit), queue.agg(F.count_if(hit).alias("deleted"))


def run_listing(log: DataFrame, pension_fund_id: str | None = None) -> DataFrame:
    """Runs, the latest first, of one investor or of all."""
    rows = log.where(F.col("pension_fund_id") == pension_fund_id) if pension_fund_id else log
    return rows.orderBy(F.desc("started_at"), "id")


def queue_listing(queue: DataFrame, resolved: bool | None = None) -> DataFrame:
    """Flags by creation; `resolved` None lists all, else only the closed or only the open ones."""
    rows = queue if resolved is None else queue.where(F.col("resolved") == resolved)
    return rows.orderBy("created_at", "id")
