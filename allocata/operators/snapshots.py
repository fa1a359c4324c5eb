"""What changed between full snapshots: a bucketed key-to-hash index of the last snapshot, probed with new rows.

The index holds (owner, key, snapshot number, hash of the compared fields). New rows probe it by key: a key that only
one side has is an addition or a removal, equal hashes are unchanged without looking at a value, and only for unequal
hashes are old values fetched and compared with the tolerance. `snapshot_changes` evaluates every consecutive pair of
snapshots of every owner at once (the snapshot number is part of the index key, so one probe stands for all swaps);
`SnapshotIndex` keeps the index on disk between deliveries and swaps it after each one.

Defined results: null values compare equal to null only; repeated rows of a key are reduced by the ranking before the
index is built; an owner's first snapshot is compared with nothing; an empty table has no changes; undated rows belong
to no snapshot; other columns are ignored.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allocata.operators.ranking import first_by_rank, quarter, rank_key
from allocata.session import cut

FIELDS = ("commitment_mm", "capital_called_mm")


def position_states(commitments: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(pension_fund_id, fund_id, snapshot_quarter, fields...): each field's first non-null value in the ranking."""
    k = rank_key(F.col("as_of_date"), F.col("extraction_confidence"), F.col("extracted_at"), F.col("id"))
    return (
        commitments.where(F.col("as_of_date").isNotNull())
        .groupBy("pension_fund_id", "fund_id", quarter(F.col("as_of_date")).alias("snapshot_quarter"))
        .agg(*[first_by_rank(k, F.col(f"`{f}`")).alias(f) for f in fields])
        .select("pension_fund_id", "fund_id", "snapshot_quarter", *[F.col(f"{f}.v0").alias(f) for f in fields])
    )


def value_hash(fields: tuple[str, ...]) -> Column:
    return F.xxhash64(*[F.struct(F.col(f).isNull(), F.col(f)) for f in fields])


def differs(old: Column, new: Column) -> Column:
    """One is null, or they are apart by more than one millionth of the larger."""
    apart = F.abs(old - new) > F.greatest(F.abs(old), F.abs(new)) * 1e-6
    return F.when(old.isNull() | new.isNull(), ~old.eqNullSafe(new)).otherwise(apart)


def probe(index: DataFrame, rows: DataFrame, keys: list[str], number: str = "n") -> DataFrame:
    """Keys with what became of them: added, removed, or `hash differs`. Both sides carry (keys, number, h)."""
    old, new = index.withColumn("old_h", F.col("h")).drop("h"), rows.withColumn("new_h", F.col("h")).drop("h")
    joined = old.join(new, [*keys, number], "full_outer")
    kind = F.when(F.col("old_h").isNull(), "added").when(F.col("new_h").isNull(), "removed").when(F.col("old_h") != F.col("new_h"), "hash differs")
    return joined.select(*keys, number, kind.alias("kind")).where(F.col("kind").isNotNull())


def snapshot_changes(commitments: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(pension_fund_id, fund_id, snapshot_quarter, change_type, changed_fields) of every snapshot against the one before."""
    # The compared rows are read four times below; one copy in the shared folder replaces four aggregations.
    states = cut(position_states(commitments, fields))
    w = Window.partitionBy("pension_fund_id").orderBy("snapshot_quarter")
    calendar = states.select("pension_fund_id", "snapshot_quarter").distinct().withColumn("n", F.row_number().over(w))
    numbered = states.join(calendar, ["pension_fund_id", "snapshot_quarter"])
    keys = ["pension_fund_id", "fund_id"]
    rows = numbered.where("n > 1").select(*keys, "n", value_hash(fields).alias("h"))
    last = calendar.groupBy("pension_fund_id").agg(F.max("n").alias("last_n"))
    index = numbered.join(last, "pension_fund_id").where("n < last_n").select(*keys, (F.col("n") + 1).alias("n"), value_hash(fields).alias("h"))
    hits = probe(index, rows, keys)
    moved = hits.where("kind = 'hash differs'").select(*keys, "n")
    new = numbered.select(*keys, "n", *[F.col(f).alias(f"new_{f}") for f in fields])
    old = numbered.select(*keys, (F.col("n") + 1).alias("n"), *[F.col(f).alias(f"old_{f}") for f in fields])
    fetched = moved.join(new, [*keys, "n"]).join(old, [*keys, "n"])
    which = F.concat_ws(",", *[F.when(differs(F.col(f"old_{f}"), F.col(f"new_{f}")), F.lit(f)) for f in fields])
    changed = fetched.select(*keys, "n", F.lit("changed").alias("change_type"), which.alias("changed_fields")).where("changed_fields <> ''")
    moves = hits.where("kind <> 'hash differs'").select(*keys, "n", F.col("kind").alias("change_type"), F.lit("").alias("changed_fields"))
    return changed.unionByName(moves).join(calendar, ["pension_fund_id", "n"]).select(*keys, "snapshot_quarter", "change_type", "changed_fields")


class SnapshotIndex:
    """The index of each owner's last snapshot on disk, for deliveries that arrive one at a time.

    `apply(snapshot)` returns the changes of the delivery against the index, writes the next index beside the old one
    and swaps a pointer file, so a failed delivery leaves the old index in use. Owners that do not deliver keep theirs.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], fields: tuple[str, ...], buckets: int = 64):
        self.spark, self.path, self.keys, self.fields, self.buckets = spark, path, keys, fields, buckets
        os.makedirs(path, exist_ok=True)

    def _pointer(self) -> str:
        return os.path.join(self.path, "CURRENT")

    def version(self) -> int:
        if not os.path.exists(self._pointer()):
            return 0
        with open(self._pointer()) as f:
            return json.load(f)["version"]

    def read(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(os.path.join(self.path, f"v{v}")) if v else None

    def apply(self, snapshot: DataFrame) -> DataFrame:
        """Changes (keys, change_type) of a delivery: one row per key, holding the owner (first key) and the fields."""
        keys, fields = self.keys, self.fields
        new = cut(snapshot.select(*keys, *fields, value_hash(fields).alias("h"), F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias("bucket")))
        owners = new.select(keys[0]).distinct()
        old_all = self.read()
        if old_all is None:
            old_all = new.limit(0)
        old = old_all.join(owners, keys[0], "left_semi")
        one = F.lit(1).alias("n")
        hits = probe(old.select(*keys, "bucket", one, "h"), new.join(old_all.select(keys[0]).distinct(), keys[0], "left_semi").select(*keys, "bucket", one, "h"), [*keys, "bucket"])
        moved = hits.where("kind = 'hash differs'").select(*keys)
        fetched = moved.join(old.select(*keys, *[F.col(f).alias(f"old_{f}") for f in fields]), keys).join(new.select(*keys, *[F.col(f).alias(f"new_{f}") for f in fields]), keys)
        unequal = F.lit(False)
        for f in fields:
            unequal = unequal | differs(F.col(f"old_{f}"), F.col(f"new_{f}"))
        out = cut(fetched.where(unequal).select(*keys, F.lit("changed").alias("change_type")).unionByName(hits.where("kind <> 'hash differs'").select(*keys, F.col("kind").alias("change_type"))))
        v = self.version() + 1
        kept = old_all.join(owners, keys[0], "left_anti").select(*new.columns)
        kept.unionByName(new).repartition(self.buckets, "bucket").write.mode("overwrite").parquet(os.path.join(self.path, f"v{v}"))
        with open(self._pointer() + ".next", "w") as f:
            json.dump({"version": v}, f)
        os.replace(self._pointer() + ".next", self._pointer())
        return out
