"""The ranking of records that compete for one key, as a struct that aggregates without a sort of the group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter(date: Column) -> Column:
    """Calendar quarter as text, 2023Q3; null for a null date."""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def rank_key(as_of: Column, confidence: Column, extracted: Column, ident: Column) -> Column:
    """A struct whose minimum is the first record: later date, higher confidence, later extraction, smaller id.

    Nulls come last in every component (an undated group has only null dates, so they tie).
    min(struct) is combined map-side, so a key that holds a third of all rows never meets in one task.
    """
    return F.struct(
        F.coalesce(-F.unix_date(as_of), F.lit(2**31 - 1)).alias("d"),
        F.when(F.isnan(confidence), F.lit(float("inf"))).otherwise(F.coalesce(-confidence, F.lit(float("inf")))).alias("c"),
        F.coalesce(-_micros(extracted), F.lit(2**63 - 1)).alias("t"),
        ident.alias("id"),
    )


def first_by_rank(key: Column, *values: Column) -> Column:
    """Aggregate: the values of the record that ranks first among those where all values are non-null."""
    carried = F.struct(key.alias("k"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    for v in values:
        carried = F.when(v.isNotNull(), carried)
    return F.min(carried)
