"""Relational queries over investors, funds and commitments: star joins, aggregates, ranks, samples and filters.

All functions take and return DataFrames. Sums and averages of amounts run over decimals, so their result does not
depend on the order of rows. Investors and funds are dimensions: joins carry no hint, so their size decides
at run time (broadcast below the session's threshold, shuffled beyond it; a hot key is split by AQE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dec(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28,7)")


def dsum(c: Column | str) -> Column:
    return F.sum(dec(c)).cast("double")


def davg(c: Column | str) -> Column:
    """Average of the non-null values, null if there is none."""
    return F.when(F.count(c) > 0, F.sum(dec(c)).cast("double") / F.count(c))


def n_rows() -> Column:
    return F.count(F.lit(1))


def star(commitments: DataFrame, funds: DataFrame, investors: DataFrame | None = None) -> DataFrame:
    """Facts with their fund (f_ columns) and investor (p_ columns); facts without a fund or investor drop out."""
    f = funds.select(*[F.col(c).alias(f"f_{c}") for c in funds.columns])
    out = commitments.join(f, commitments["fund_id"] == F.col("f_id"))
    if investors is not None:
        p = investors.select(*[F.col(c).alias(f"p_{c}") for c in investors.columns])
        out = out.join(p, out["pension_fund_id"] == F.col("p_id"))
    return out


def distinct_names(names: Column, separator: str = ",") -> Column:
    """Distinct names in order, joined; a fund's investors are few, so the set stays small."""
    return F.concat_ws(separator, F.sort_array(F.collect_set(names)))


def fund_summary(joined: DataFrame) -> DataFrame:
    """One row per fund: distinct investors, their names, total, averages."""
    return joined.groupBy("fund_id").agg(
        F.min("f_fund_name").alias("fund_name"), F.min("f_vintage_year").alias("vintage_year"),
        F.count_distinct("pension_fund_id").alias("investor_count"), distinct_names(F.col("p_name")).alias("investors"),
        dsum("commitment_mm").alias("total_commitment_mm"), davg("net_irr").alias("avg_net_irr"), davg("net_multiple").alias("avg_net_multiple"),
    )


def top_funds(joined: DataFrame, n: int = 100) -> DataFrame:
    return fund_summary(joined).where("total_commitment_mm > 0").orderBy(F.desc("total_commitment_mm"), "fund_id").limit(n)


def held_by(commitments: DataFrame, least: int) -> DataFrame:
    """(fund_id) of funds with at least so many investors."""
    return commitments.groupBy("fund_id").agg(F.count_distinct("pension_fund_id").alias("n")).where(F.col("n") >= least).select("fund_id")


def cross_link_tiers(commitments: DataFrame, tiers: tuple[int, ...] = (2, 3, 4, 5)) -> DataFrame:
    """Number of funds held by at least 2, 3, 4, 5 investors, in one pass over the per-fund counts."""
    per_fund = commitments.groupBy("fund_id").agg(F.count_distinct("pension_fund_id").alias("n"))
    return per_fund.agg(n_rows().alias("funds"), *[F.count_if(F.col("n") >= k).alias(f"held_by_{k}") for k in tiers])


def investor_pivot(joined: DataFrame, investor_ids: list[str]) -> DataFrame:
    """Fund x investor matrix of the largest commitment, for funds with two or more investors."""
    wanted = [F.max(F.when(F.col("pension_fund_id") == i, F.col("commitment_mm"))).alias(f"{i}_mm") for i in investor_ids]
    return joined.groupBy("fund_id").agg(
        F.min("f_fund_name").alias("fund_name"), *wanted, F.count_distinct("pension_fund_id").alias("investor_count"), davg("net_irr").alias("avg_irr"), davg("net_multiple").alias("avg_multiple"),
    ).where("investor_count >= 2")


def performance_by_vintage(commitments: DataFrame, least_rows: int = 1, from_year: int | None = None) -> DataFrame:
    rows = commitments.where(F.col("vintage_year").isNotNull())
    if from_year is not None:
        rows = rows.where(F.col("vintage_year") >= from_year)
    return rows.groupBy("vintage_year").agg(
        n_rows().alias("n"), davg("commitment_mm").alias("avg_commitment_mm"), dsum("commitment_mm").alias("total_commitment_mm"),
        davg("net_irr").alias("avg_irr"), davg("net_multiple").alias("avg_multiple"), F.min("net_irr").alias("min_irr"), F.max("net_irr").alias("max_irr"),
        F.min("net_multiple").alias("min_multiple"), F.max("net_multiple").alias("max_multiple"),
    ).where(F.col("n") >= least_rows)


def gp_leaderboard(joined: DataFrame, n: int = 50) -> DataFrame:
    rows = joined.where("f_general_partner IS NOT NULL AND f_general_partner <> ''")
    return rows.groupBy(F.col("f_general_partner_normalized").alias("gp")).agg(
        F.min("f_general_partner").alias("general_partner"), F.count_distinct("fund_id").alias("fund_count"), F.count_distinct("pension_fund_id").alias("investor_count"),
        dsum("commitment_mm").alias("total_commitment_mm"), davg("net_irr").alias("avg_irr"), davg("net_multiple").alias("avg_multiple"),
        F.min("f_vintage_year").alias("earliest_vintage"), F.max("f_vintage_year").alias("latest_vintage"),
    ).orderBy(F.desc_nulls_last("total_commitment_mm"), F.asc_nulls_first("gp")).limit(n)


def commitment_trends(joined: DataFrame) -> DataFrame:
    rows = joined.where("vintage_year >= 2000 AND commitment_mm IS NOT NULL AND commitment_mm < 5000")
    return rows.groupBy("vintage_year", F.coalesce("f_sub_strategy", F.lit("Unclassified")).alias("strategy")).agg(
        n_rows().alias("n"), davg("commitment_mm").alias("avg_commitment_mm"), dsum("commitment_mm").alias("total_commitment_mm"), F.count_distinct("pension_fund_id").alias("investor_count"),
    )


def gp_penetration(joined: DataFrame, gp: Column, least: int = 3) -> DataFrame:
    """Families of funds by a derived manager name that reach `least` investors."""
    return joined.where("commitment_mm IS NOT NULL").groupBy(gp.alias("gp")).agg(
        F.count_distinct("pension_fund_id").alias("investor_count"), F.count_distinct("fund_id").alias("fund_count"), dsum("commitment_mm").alias("total_commitment_mm"),
        davg("net_irr").alias("avg_irr"), davg("net_multiple").alias("avg_multiple"),
        F.min(F.when(F.col("f_vintage_year") != 0, F.col("f_vintage_year"))).alias("earliest_vintage"), F.max(F.when(F.col("f_vintage_year") != 0, F.col("f_vintage_year"))).alias("latest_vintage"),
        distinct_names(F.col("p_name"), ", ").alias("investors"),
    ).where(F.col("investor_count") >= least)


def investor_overview(joined: DataFrame) -> DataFrame:
    return joined.groupBy("pension_fund_id").agg(
        F.min("p_name").alias("investor"), n_rows().alias("n"), dsum("commitment_mm").alias("total_commitment_mm"), F.min("f_vintage_year").alias("earliest_vintage"),
        F.max("f_vintage_year").alias("latest_vintage"), F.max("as_of_date").alias("as_of_date"),
    )


def capital_flows(joined: DataFrame) -> DataFrame:
    return joined.groupBy("pension_fund_id").agg(
        dsum("capital_called_mm").alias("called_mm"), dsum("capital_distributed_mm").alias("distributed_mm"), dsum("remaining_value_mm").alias("remaining_mm"),
    )


def strategy_performance(joined: DataFrame, least_rows: int = 10) -> DataFrame:
    return joined.where("f_sub_strategy IS NOT NULL").groupBy(F.col("f_sub_strategy").alias("strategy")).agg(
        n_rows().alias("n"), davg("net_irr").alias("avg_irr"), davg("net_multiple").alias("avg_multiple"), dsum("commitment_mm").alias("total_commitment_mm"),
    ).where(F.col("n") >= least_rows)


def widely_held(joined: DataFrame, least: int = 4) -> DataFrame:
    return fund_summary(joined).where(F.col("investor_count") >= least)


def headline(joined: DataFrame) -> DataFrame:
    """One row of totals for a front page."""
    per_fund = joined.groupBy("fund_id").agg(F.count_distinct("pension_fund_id").alias("k"))
    totals = joined.agg(
        (dsum("commitment_mm") / 1000).alias("total_bn"), F.count_distinct("fund_id").alias("funds"), F.count_distinct("pension_fund_id").alias("investors"), F.count_distinct("f_general_partner").alias("managers"),
    )
    shared = per_fund.agg(F.count_if(F.col("k") >= 2).alias("shared_funds"))
    both = totals.unionByName(shared, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def global_stats(joined: DataFrame) -> DataFrame:
    return joined.agg(
        n_rows().alias("n"), F.count_distinct("fund_id").alias("funds"), F.count_distinct("f_general_partner_normalized").alias("managers"), F.min("f_vintage_year").alias("min_vintage"), F.max("f_vintage_year").alias("max_vintage"),
        distinct_names(F.col("f_sub_strategy"), ", ").alias("strategies"),
    )


def irr_quartiles(joined: DataFrame) -> DataFrame:
    """Exact quartiles with linear interpolation per investor, for plausible rates.

    Equal rates are counted map-side; a window over an investor's distinct rates (sorted, with spill) finds the two ranks
    of each quartile, so no buffer holds an investor's rates.
    """
    counts = joined.where("net_irr BETWEEN -0.5 AND 1.0").groupBy("pension_fund_id", "net_irr").agg(n_rows().alias("n"))
    totals = counts.groupBy("pension_fund_id").agg(F.sum("n").alias("total"))
    upto = Window.partitionBy("pension_fund_id").orderBy("net_irr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("upto", F.sum("n").over(upto)).join(totals, "pension_fund_id")

    def quantile(p: float, name: str) -> Column:
        place = p * (F.col("total") - 1)
        low, high = (F.min(F.when(F.col("upto") > f(place), F.col("net_irr"))) for f in (F.floor, F.ceil))
        return F.round(low + (high - low) * F.max(place - F.floor(place)), 9).alias(name)

    return ranked.groupBy("pension_fund_id").agg(F.max("total").alias("n"), quantile(0.25, "q1"), quantile(0.5, "median"), quantile(0.75, "q3"))


def performance_band(joined: DataFrame) -> DataFrame:
    return joined.where("f_vintage_year BETWEEN 2015 AND 2020 AND f_asset_class = 'Private Equity' AND net_irr IS NOT NULL").select(
        F.col("id").alias("commitment_id"), F.col("f_fund_name").alias("fund_name"), F.col("f_vintage_year").alias("vintage_year"), F.col("f_sub_strategy").alias("sub_strategy"), F.col("p_name").alias("investor"), "commitment_mm", "net_irr", "net_multiple",
    ).orderBy(F.desc("net_irr"), "fund_name")


def first_time_funds(joined: DataFrame) -> DataFrame:
    """Recent first and second funds by the pattern of their name; patterns ignore case."""
    name = F.col("f_fund_name")
    yes, no = F.lit(False), F.lit(False)
    for p in ("% I", "% I %", "% II", "% II %", "%Fund 1 %", "%Fund 2 %", "%Fund 1", "%Fund 2"):
        yes = yes | name.ilike(p)
    for p in ("% III%", "% IV%", "% V %", "% VI%"):
        no = no | name.ilike(p)
    return joined.where((F.col("f_vintage_year") >= 2020) & yes & ~no).select(F.col("id").alias("commitment_id"), name.alias("fund_name"), F.col("f_vintage_year").alias("vintage_year"), F.col("p_name").alias("investor"), F.col("p_state").alias("state"), "commitment_mm")


def commitments_where(commitments: DataFrame, pension_fund_id: str | None = None, fund_id: str | None = None) -> DataFrame:
    """Optional filters; an empty argument filters nothing."""
    for name, value in (("pension_fund_id", pension_fund_id), ("fund_id", fund_id)):
        if value:
            commitments = commitments.where(F.col(name) == value)
    return commitments


def text_search(rows: DataFrame, query: str, columns: list[str], pattern: bool = False) -> DataFrame:
    """Rows in which any column holds the text (or matches the pattern), whatever the case; a null column does not."""
    hit = F.lit(False)
    for c in columns:
        found = F.col(c).rlike(f"(?i){query}") if pattern else F.contains(F.lower(c), F.lit(query.lower()))
        hit = hit | F.coalesce(found, F.lit(False))
    return rows.where(hit)


def prefix_fallback(rows: DataFrame, column: str, wanted: DataFrame, length: int = 25) -> DataFrame:
    """For each wanted text: rows equal to it, or if there are none, rows that start with its first `length` characters."""
    w = wanted.select("wanted")
    # Both lookups are equi joins; the prefix one joins on the cut text.
    exact = w.join(rows, F.col("wanted") == F.col(column)).withColumn("how", F.lit("exact"))
    rest = w.join(exact.select("wanted").distinct(), "wanted", "left_anti")
    head = rest.join(rows, F.lower(F.substring("wanted", 1, length)) == F.lower(F.substring(column, 1, length))).withColumn("how", F.lit("prefix"))
    return exact.unionByName(head)


def linked_comparison(joined: DataFrame, commitments: DataFrame) -> DataFrame:
    return joined.join(held_by(commitments, 2), "fund_id", "left_semi").select(F.col("id").alias("commitment_id"), F.col("f_fund_name").alias("fund_name"), F.col("p_name").alias("investor"), "commitment_mm", "net_irr", "net_multiple", "as_of_date")


def unlinked_rows(commitments: DataFrame) -> DataFrame:
    return commitments.join(held_by(commitments, 2), "fund_id", "left_anti").where("commitment_mm IS NOT NULL").select(F.col("id").alias("commitment_id"), "fund_id", "pension_fund_id", "commitment_mm")


def gp_cross_count(funds: DataFrame, commitments: DataFrame) -> DataFrame:
    """Managers with the number of investors of all their funds."""
    return funds.where("general_partner_normalized IS NOT NULL").join(commitments, funds["id"] == commitments["fund_id"]).groupBy("general_partner_normalized").agg(F.count_distinct("pension_fund_id").alias("gp_cross_count"))


def latest_positions(commitments: DataFrame) -> DataFrame:
    """The latest dated record of each position, ties by confidence and id, with a default for a missing status."""
    w = Window.partitionBy("pension_fund_id", "fund_id").orderBy(F.desc("as_of_date"), F.desc_nulls_last("extraction_confidence"), "id")
    return commitments.where("as_of_date IS NOT NULL").withColumn("rn", F.row_number().over(w)).where("rn = 1").select(F.col("id").alias("commitment_id"), "pension_fund_id", "fund_id", "as_of_date", F.coalesce("status", F.lit("")).alias("status"), "commitment_mm")


def last_non_null(commitments: DataFrame, columns: list[str]) -> DataFrame:
    """Per fund and column, the last non-null value by date and id; null funds are dropped."""
    order = F.struct("as_of_date", "id")
    return commitments.where("fund_id IS NOT NULL").groupBy("fund_id").agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"].alias(c) for c in columns])


def top_per_group(joined: DataFrame, k: int = 2) -> DataFrame:
    """The k youngest funds of each manager in each investor."""
    funds = joined.where("f_general_partner_normalized IS NOT NULL AND f_vintage_year IS NOT NULL").select("pension_fund_id", "fund_id", F.col("f_general_partner_normalized").alias("gp"), F.col("f_vintage_year").alias("vintage_year")).distinct()
    w = Window.partitionBy("pension_fund_id", "gp").orderBy(F.desc("vintage_year"), "fund_id")
    return funds.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).withColumn("rn", F.col("rn").cast("bigint"))


def labelled_by_source(commitments: DataFrame, investors: DataFrame) -> DataFrame:
    """Each fund's investors as label where it has more than one, else no label."""
    names = commitments.join(investors.select(F.col("id").alias("pension_fund_id"), "name"), "pension_fund_id").groupBy("fund_id").agg(F.count_distinct("pension_fund_id").alias("n"), distinct_names(F.col("name"), ", ").alias("names"))
    return names.select("fund_id", "n", F.when(F.col("n") > 1, F.col("names")).alias("label"))


def quota_sample(commitments: DataFrame, linked_quota: int = 12, total: int = 20) -> DataFrame:
    """Per investor: up to 12 shared positions, filled with unshared ones to 20, then with further shared ones.

    Both strata are ranked by completeness and amount; the quotas are arithmetic on the ranks, so no row is looped over.
    """
    filled = [F.col(c).isNotNull().cast("int") for c in ("net_irr", "net_multiple", "capital_called_mm", "capital_distributed_mm")]
    rows = commitments.where("commitment_mm IS NOT NULL").join(held_by(commitments, 2).withColumn("linked", F.lit(True)), "fund_id", "left").withColumn("linked", F.coalesce("linked", F.lit(False)))
    score = F.when(F.col("linked"), filled[0] + filled[1] + filled[2] + filled[3]).otherwise(filled[0] + filled[1])
    w = Window.partitionBy("pension_fund_id", "linked").orderBy(F.desc("score"), F.desc("commitment_mm"), "id")
    # No rank above the total can be chosen, so Spark drops the rest before the shuffle of the window (group limit).
    ranked = rows.withColumn("score", score).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= total)
    per = Window.partitionBy("pension_fund_id")
    counted = ranked.withColumn("n_linked", F.least(F.count_if(F.col("linked")).over(per), F.lit(linked_quota))).withColumn("n_other", F.count_if(~F.col("linked")).over(per))
    others = F.least(F.col("n_other"), F.lit(total) - F.col("n_linked"))
    keep = F.when(F.col("linked"), F.col("rn") <= F.col("n_linked") + F.lit(total) - F.col("n_linked") - others).otherwise(F.col("rn") <= others)
    return counted.where(keep).select("pension_fund_id", F.col("id").alias("commitment_id"), "linked", F.col("rn").cast("bigint").alias("rank_in_stratum"))


def capped_selection(joined: DataFrame, first_cap: int = 110, cap: int = 125) -> DataFrame:
    """Greedy selection in two passes: shared positions up to 110, then any up to 125 in all, each once."""
    shared = joined.select("fund_id", "pension_fund_id").groupBy("fund_id").agg(F.count_distinct("pension_fund_id").alias("k"))
    rows = joined.where("commitment_mm IS NOT NULL").join(shared, "fund_id").select(F.col("id").alias("commitment_id"), "k", "commitment_mm")
    first = rows.where("k >= 2").orderBy(F.desc("k"), F.desc("commitment_mm"), "commitment_id").limit(first_cap).select("commitment_id", F.lit(1).alias("pass"), "k", "commitment_mm")
    second = rows.orderBy(F.desc("commitment_mm"), "commitment_id").limit(cap + first_cap).select("commitment_id", F.lit(2).alias("pass"), "k", "commitment_mm")
    once = first.unionByName(second.join(first.select("commitment_id"), "commitment_id", "left_anti"))
    return once.orderBy("pass", F.when(F.col("pass") == 1, -F.col("k")).otherwise(0), F.desc("commitment_mm"), "commitment_id").limit(cap).select("commitment_id", "pass")


def stratified_sample(commitments: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """max(1, n // strata) rows of each investor in a seeded hash order, then n of all."""
    strata = commitments.select("pension_fund_id").distinct().count() or 1
    order = F.md5(F.concat("id", F.lit(str(seed))))
    w = Window.partitionBy("pension_fund_id").orderBy(order, "id")
    return commitments.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max(1, n // strata)).orderBy(order, "id").limit(n).select("id", "pension_fund_id")


def reup_flag(joined: DataFrame) -> DataFrame:
    """Re-Up if the investor holds an earlier fund of the same manager, else New Relationship."""
    rows = joined.where("f_general_partner_normalized IS NOT NULL AND f_vintage_year IS NOT NULL")
    earliest = rows.groupBy("pension_fund_id", "f_general_partner_normalized").agg(F.min("f_vintage_year").alias("first_vintage"))
    kind = F.when(F.col("first_vintage") < F.col("f_vintage_year"), "Re-Up").otherwise("New Relationship")
    return rows.select("pension_fund_id", "fund_id", "f_general_partner_normalized", "f_vintage_year").distinct().join(earliest, ["pension_fund_id", "f_general_partner_normalized"]).select("pension_fund_id", "fund_id", F.col("f_general_partner_normalized").alias("gp"), F.col("f_vintage_year").alias("vintage_year"), kind.alias("commitment_type"))


def ranked_within(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def last_value_pivot(rows: DataFrame, row: str, column: str, value: Column, order: Column, columns: list[str]) -> DataFrame:
    """row x column matrix in which the last value in `order` wins."""
    return rows.groupBy(row).pivot(column, columns).agg(F.max_by(value, order))
