"""Engagements of consulting firms with investors: filtered joins, listings, one consultant an investor, matrix, statistics.

Firms and investors are dimensions, joined without hints. Defined results: engagements of an unknown firm or investor
drop out of joins; null scopes show as empty; an investor or firm without engagements has no row; empty tables give
empty results (statistics: zeros).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The role that names an investor's consultant before any other, and the mark of a running engagement.
GENERAL_ROLE = "general_investment_consultant"
CURRENT = " (current)"


def joined(engagements: DataFrame, firms: DataFrame, investors: DataFrame, pension_fund_id: str | None = None, consulting_firm_id: str | None = None) -> DataFrame:
    """Engagements with firm, its type, investor and state; an empty argument filters nothing."""
    for column, value in (("pension_fund_id", pension_fund_id), ("consulting_firm_id", consulting_firm_id)):
        if value:
            engagements = engagements.where(F.col(column) == value)
    f = firms.select(F.col("id").alias("consulting_firm_id"), F.col("name").alias("consulting_firm_name"), "firm_type")
    p = investors.select(F.col("id").alias("pension_fund_id"), F.col("name").alias("pension_fund_name"), F.col("state").alias("pension_fund_state"))
    return engagements.join(f, "consulting_firm_id").join(p, "pension_fund_id")


def role_label() -> Column:
    return F.concat("role", F.when(F.col("is_current"), CURRENT).otherwise(""))


def listing(rows: DataFrame) -> DataFrame:
    """(pension_fund_name, firms): each investor's engagements as `firm: role [scope] (current)`, in order of firm and role."""
    scope = F.when(F.coalesce("mandate_scope", F.lit("")) != "", F.concat(F.lit(" ["), F.col("mandate_scope"), F.lit("]"))).otherwise("")
    line = F.concat("consulting_firm_name", F.lit(": "), "role", scope, F.when(F.col("is_current"), CURRENT).otherwise(""))
    # An investor's engagements are the contracts of one organisation, so the set is small.
    return rows.groupBy("pension_fund_name").agg(F.array_join(F.sort_array(F.collect_set(line)), "; ").alias("firms"))


def primary_consultant(rows: DataFrame) -> DataFrame:
    """(pension_fund_id, consultant): the firm of the general role, else of the first role in order; among equals the first by name."""
    rank = F.struct((F.col("role") != GENERAL_ROLE).alias("other"), F.when(F.col("role") != GENERAL_ROLE, F.col("role")).alias("role"), F.col("consulting_firm_name").alias("firm"))
    return rows.groupBy("pension_fund_id").agg(F.min(rank)["firm"].alias("consultant"))


def matrix(rows: DataFrame, investors: list[str]) -> DataFrame:
    """Firm x investor matrix of role labels, empty where there is none; the last engagement in order (start, role, scope) wins."""
    order = F.struct(F.coalesce(F.col("start_date").cast("string"), F.lit("")), "role", F.coalesce("mandate_scope", F.lit("")), F.col("is_current").cast("int"))
    wide = rows.groupBy(F.col("consulting_firm_name").alias("consulting_firm"), "firm_type").pivot("pension_fund_name", investors).agg(F.max_by(role_label(), order))
    return wide.fillna("", subset=["firm_type", *investors])


def registry_stats(funds: DataFrame, fund_aliases: DataFrame, firms: DataFrame, firm_aliases: DataFrame) -> DataFrame:
    """One row: funds, distinct fund aliases, firms, distinct firm aliases; a name counts once whatever its case."""

    def counted(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.agg(F.count_distinct(F.lower(column)).alias(name))

    parts = [counted(funds, "id", "total_funds"), counted(fund_aliases, "alias", "fund_aliases"), counted(firms, "id", "total_firms"), counted(firm_aliases, "alias", "firm_aliases")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
