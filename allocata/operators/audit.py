"""Audit of a delivered sheet against the store: the record that each row stands for, and in what it differs.

Every cell of a sheet is text. A row whose name is a number has its cells shifted by one column to the left: its manager
stands under the state, its name under the manager, its amount under the name.

Defined results: a row without a record of that investor and name (exact, else by the first characters) has no match
and is suspect; null cells are compared with nothing; ties in the score go to the smaller record id; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allocata.functions.parsers import loose_float
from allocata.operators.quality import tolerance_issues

# Points for a near and a nearer amount and for an equal vintage; tolerances of the compared fields; length of the fallback prefix.
NEAR, NEARER, SAME_VINTAGE = (10.0, 1), (1.0, 3), 2
TOLERANCES = {"commitment_mm": 1.0, "capital_called_mm": 1.0, "capital_distributed_mm": 1.0, "remaining_value_mm": 1.5, "net_irr": 0.5, "net_multiple": 0.05}
PREFIX = 25


def realigned(sheet: DataFrame) -> DataFrame:
    """The sheet with shifted rows put right, and whether they were."""
    # A column of its own, so that the test is not repeated for every cell that it moves.
    tested = sheet.withColumn("shifted", F.coalesce(loose_float(F.col("fund_name")).isNotNull(), F.lit(False)))
    moved = {"general_partner": "state", "fund_name": "general_partner", "commitment": "fund_name"}
    return tested.select(*[F.when(F.col("shifted"), F.col(moved[c])).otherwise(F.col(c)).alias(c) if c in moved else F.col(c) for c in sheet.columns], "shifted")


def score(stated_amount: Column, amount: Column, stated_vintage: Column, vintage: Column) -> Column:
    gap = F.abs(amount - stated_amount)
    by_amount = F.when(gap < NEARER[0], NEARER[1]).when(gap < NEAR[0], NEAR[1]).otherwise(0)
    return by_amount + F.when(stated_vintage == vintage, SAME_VINTAGE).otherwise(0)


def best_records(sheet: DataFrame, records: DataFrame) -> DataFrame:
    """sheet (row_id, pension_fund_id, fund_name, commitment_mm, vintage_year...) with its best record's columns (r_...), the score and how it was found.

    Both lookups are joins on (investor, name) and (investor, first characters of the name); a row's own group is the
    records of one investor and name.
    """
    r = records.select(*[F.col(c).alias(f"r_{c}") for c in records.columns])
    exact = sheet.join(r, (F.col("pension_fund_id") == F.col("r_pension_fund_id")) & (F.col("fund_name") == F.col("r_fund_name"))).withColumn("found", F.lit("exact"))
    rest = sheet.join(exact.select("row_id").distinct(), "row_id", "left_anti")
    head = (F.col("pension_fund_id") == F.col("r_pension_fund_id")) & (F.lower(F.substring("fund_name", 1, PREFIX)) == F.lower(F.substring("r_fund_name", 1, PREFIX)))
    # A name shorter than the prefix is a prefix of longer names.
    short = (F.col("pension_fund_id") == F.col("r_pension_fund_id")) & (F.length("fund_name") < PREFIX) & F.lower("r_fund_name").startswith(F.lower("fund_name"))
    found = rest.where(F.length("fund_name") >= PREFIX).join(r, head).unionByName(rest.where(F.length("fund_name") < PREFIX).join(r, short)).withColumn("found", F.lit("prefix"))
    both = exact.unionByName(found).withColumn("score", score(F.col("commitment_mm"), F.col("r_commitment_mm"), F.col("vintage_year"), F.col("r_vintage_year")))
    w = Window.partitionBy("row_id").orderBy(F.desc("score"), "r_id")
    return both.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def audited(sheet: DataFrame, records: DataFrame) -> DataFrame:
    """(row_id, pension_fund_id, record_id, score, issues, status): every row, confirmed or suspect.

    A row is confirmed if it has a record and no field differs by more than its tolerance; a shifted one if it has a record.
    """
    best = best_records(sheet, records)
    fields = {c: t for c, t in TOLERANCES.items() if c in sheet.columns and c in records.columns}
    vintage = F.when(F.col("vintage_year") != F.col("r_vintage_year"), F.lit("vintage_year"))
    issues = F.concat_ws(",", tolerance_issues(fields), vintage)
    found = best.select("row_id", F.col("r_id").alias("record_id"), "score", issues.alias("issues"))
    out = sheet.join(found, "row_id", "left")
    sound = F.col("record_id").isNotNull() & (F.col("shifted") | (F.col("issues") == ""))
    return out.select("row_id", "pension_fund_id", "record_id", F.col("score").cast("bigint").alias("score"), F.coalesce("issues", F.lit("no record")).alias("issues"), F.when(sound, "confirmed").otherwise("suspect").alias("status"))


def counts(audit: DataFrame) -> DataFrame:
    """(pension_fund_id, confirmed, suspect) of every investor in the sheet."""
    return audit.groupBy("pension_fund_id").agg(F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if(F.col("status") == "suspect").alias("suspect"))
