"""Implausible readings of a source relative to that source's normal behaviour.

* impossible: a multiple below 0, a loss of more than the whole (in the source's own unit);
* spike: outside the interquartile fences of the source, widened `fence` times. Quartiles come from mergeable quantile
  sketches (percentile_approx: partial sketches per partition, merged per source), so a source that holds a third of
  the rows is never gathered in one task;
* stuck: one of `run` or more exactly equal values in consecutive snapshots of a position (zero variance);
* jump (report only): the change from the position's snapshot before is outside the source's widened fences of changes.

The readings are dated by quarter, so there is no hour of day to bucket by; `context` takes such a column where one exists.

Defined results: nulls are no readings and break a run; NaN is `impossible`; undated rows are judged by range but
belong to no run; repeated rows of a snapshot count once for a run and are all reported; a source whose quartiles
coincide (more than half of its readings are one value) has the fences of its other readings, widened to hold that value; where
those coincide too, or there are none, it reports no spikes; empty tables have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allocata.operators.ranking import quarter
from allocata.session import cut

FIELDS = ("net_irr", "net_multiple")


def readings(commitments: DataFrame, rate_units: DataFrame | None = None) -> DataFrame:
    """(id, source, fund_id, snapshot, field, value, floor): all non-null readings; floor is the least possible value."""
    rows = commitments.select("id", F.col("pension_fund_id").alias("source"), "fund_id", quarter(F.col("as_of_date")).alias("snapshot"), *FIELDS)
    whole: Column = F.lit(-1.0)
    if rate_units is not None:
        rows = rows.join(rate_units.select("source", "rate_unit"), "source", "left")
        whole = F.when(F.col("rate_unit") == "percent", -100.0).when(F.col("rate_unit") == "bp", -10_000.0).otherwise(-1.0)
    item = F.array(
        F.struct(F.lit("net_irr").alias("field"), F.col("net_irr").alias("value"), whole.alias("floor")),
        F.struct(F.lit("net_multiple").alias("field"), F.col("net_multiple").alias("value"), F.lit(0.0).alias("floor")),
    )
    return rows.select("id", "source", "fund_id", "snapshot", F.inline(item)).where("value IS NOT NULL")


def fences(rows: DataFrame, value: str = "value", context: tuple[str, ...] = (), fence: float = 4.0, accuracy: int = 2000) -> DataFrame:
    """(source, field, context..., low, high): interquartile fences per source from merged quantile sketches.

    Where the quartiles coincide, the fences come from the readings that differ from that value.
    """
    group = ["source", "field", *context]
    x = F.when(~F.isnan(value), F.col(value))

    def quartiles(of: DataFrame) -> DataFrame:
        return of.groupBy(*group).agg(F.percentile_approx(x, [0.25, 0.75], accuracy).alias("q"))

    # One row a source and field from here on.
    first = cut(quartiles(rows))
    low, high = F.col("q")[0], F.col("q")[1]
    same = first.where(low == high).select(*group, low.alias("usual"))
    if same.isEmpty():
        return first.select(*group, (low - fence * (high - low)).alias("low"), (high + fence * (high - low)).alias("high"))
    other = quartiles(rows.join(same, group).where(F.col(value) != F.col("usual"))).withColumnRenamed("q", "o")
    a, b = F.coalesce(F.when(low == high, F.col("o")[0]), low), F.coalesce(F.when(low == high, F.col("o")[1]), high)
    spread = b - a
    return first.join(other, group, "left").select(
        *group, F.when(spread > 0, F.least(a - fence * spread, low)).alias("low"), F.when(spread > 0, F.greatest(b + fence * spread, high)).alias("high"),
    )


def _runs(dated: DataFrame, run: int) -> DataFrame:
    same = Window.partitionBy("source", "fund_id", "field", "value").orderBy("own")
    island = Window.partitionBy("source", "fund_id", "field", "value", "island")
    return (
        dated.withColumn("island", F.col("own") - F.row_number().over(same))
        .withColumn("n", F.count(F.lit(1)).over(island))
        .where(F.col("n") >= run)
        .select("source", "fund_id", "field", "snapshot", "value")
    )


def stuck_readings(commitments: DataFrame, run: int = 6) -> DataFrame:
    """(source, fund_id, field, snapshot, value): equal values that stand in `run` or more consecutive snapshots of the position.

    All values of a position's snapshot travel together: one grouping by (position, snapshot) numbers the snapshots and
    holds the distinct values of both fields, so the numbering needs no second join.
    """
    values = [F.collect_set(F.when(~F.isnan(f), F.col(f))).alias(f) for f in FIELDS]
    per_snapshot = commitments.where(F.col("as_of_date").isNotNull()).groupBy(
        F.col("pension_fund_id").alias("source"), "fund_id", quarter(F.col("as_of_date")).alias("snapshot")
    ).agg(*values)
    own = Window.partitionBy("source", "fund_id").orderBy("snapshot")
    numbered = per_snapshot.withColumn("own", F.row_number().over(own))

    def named(f: str) -> Column:
        return F.transform(F.col(f), lambda x: F.struct(F.lit(f).alias("field"), x.alias("value")))

    item = F.flatten(F.array(*[named(f) for f in FIELDS]))
    dated = numbered.select("source", "fund_id", "snapshot", "own", F.inline(item))
    return _runs(dated, run)


def jumps(commitments: DataFrame, fence: float = 8.0) -> DataFrame:
    """(source, fund_id, snapshot, field, change): changes between consecutive snapshots outside the source's fences of changes."""
    w = Window.partitionBy("source", "fund_id").orderBy("snapshot")
    per = commitments.where(F.col("as_of_date").isNotNull()).groupBy(
        F.col("pension_fund_id").alias("source"), "fund_id", quarter(F.col("as_of_date")).alias("snapshot")
    ).agg(*[F.max(f).alias(f) for f in FIELDS])
    item = F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f) - F.lag(f).over(w)).alias("change")) for f in FIELDS])
    changes = per.select("source", "fund_id", "snapshot", item.alias("i")).select("source", "fund_id", "snapshot", F.inline("i")).where("change IS NOT NULL")
    return changes.join(fences(changes, "change", fence=fence), ["source", "field"]).where("change < low OR change > high").select("source", "fund_id", "snapshot", "field", "change")


def implausible(commitments: DataFrame, rate_units: DataFrame | None = None, fence: float = 4.0, run: int = 6) -> DataFrame:
    """(id, source, field, value, is_impossible, is_spike, is_stuck): every reading that does not fit its source."""
    rows = readings(commitments, rate_units)
    by_range = (
        rows.join(fences(rows, fence=fence), ["source", "field"], "left")
        .select("id", "source", "field", "value", (F.isnan("value") | (F.col("value") < F.col("floor"))).alias("is_impossible"), F.coalesce(~F.isnan("value") & ((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))), F.lit(False)).alias("is_spike"))
        .where("is_impossible OR is_spike")
    )
    stuck = stuck_readings(commitments, run)
    held = rows.where("snapshot IS NOT NULL").join(stuck, ["source", "fund_id", "field", "snapshot", "value"], "left_semi")
    found = by_range.withColumn("is_stuck", F.lit(False)).unionByName(held.select("id", "source", "field", "value", F.lit(False).alias("is_impossible"), F.lit(False).alias("is_spike"), F.lit(True).alias("is_stuck")))
    return found.groupBy("id", "source", "field", "value").agg(F.max("is_impossible").alias("is_impossible"), F.max("is_spike").alias("is_spike"), F.max("is_stuck").alias("is_stuck"))
