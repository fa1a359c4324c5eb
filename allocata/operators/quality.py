"""Quality rules in single passes: range flags, completeness, divergence, coverage, ingest flags and the flag queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of plausible values and thresholds of the rules.
COMMITMENT_MM = (0.1, 5000.0)
NET_IRR = (-0.50, 1.50)
NET_MULTIPLE = (0.0, 15.0)
VINTAGE_FROM = 1980
MIN_CONFIDENCE = 0.85
MIN_COMPLETENESS = 0.33
MAX_SPREAD = 0.5
# Fields of the completeness table, and those that a record's own completeness counts.
PROFILE_FIELDS = ("commitment_mm", "vintage_year", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "dpi", "as_of_date")
SCORED_FIELDS = ("commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple")


def _flag(condition: Column, kind: str, detail: Column) -> Column:
    return F.when(condition, F.struct(F.lit(kind).alias("flag_type"), detail.alias("flag_detail")))


def range_flags(commitments: DataFrame, vintage_to: int) -> DataFrame:
    """(commitment_id, flag_type, flag_detail): one row per value outside its range; all rules in one pass."""

    def outside(c: str, low: float, high: float) -> Column:
        return (F.col(c) < low) | (F.col(c) > high)

    rules = F.array(
        _flag(outside("commitment_mm", *COMMITMENT_MM), "value_range", F.concat(F.lit("Commitment "), F.col("commitment_mm").cast("string"))),
        _flag(outside("net_irr", *NET_IRR), "value_range", F.concat(F.lit("Net IRR "), F.col("net_irr").cast("string"))),
        _flag(F.col("net_multiple") < NET_MULTIPLE[0], "value_range", F.concat(F.lit("Negative net multiple "), F.col("net_multiple").cast("string"))),
        _flag(F.col("net_multiple") > NET_MULTIPLE[1], "value_range", F.concat(F.lit("Net multiple "), F.col("net_multiple").cast("string"))),
        _flag((F.col("vintage_year") < VINTAGE_FROM) | (F.col("vintage_year") > vintage_to), "value_range", F.concat(F.lit("Vintage year "), F.col("vintage_year").cast("string"))),
    )
    return commitments.select(F.col("id").alias("commitment_id"), F.inline(F.array_compact(rules)))


def populated(fields: tuple[str, ...] = SCORED_FIELDS) -> Column:
    out = F.lit(0)
    for f in fields:
        out = out + F.col(f).isNotNull().cast("int")
    return out


def low_completeness(commitments: DataFrame) -> DataFrame:
    share = populated() / F.lit(float(len(SCORED_FIELDS)))
    return commitments.withColumn("n", populated()).where(share < MIN_COMPLETENESS).select(F.col("id").alias("commitment_id"), F.lit("low_completeness").alias("flag_type"), F.concat(F.col("n").cast("string"), F.lit(f" of {len(SCORED_FIELDS)} fields")).alias("flag_detail"))


def ingest_flags(commitments: DataFrame) -> DataFrame:
    return commitments.where(F.col("extraction_confidence") < MIN_CONFIDENCE).select(F.col("id").alias("commitment_id"), F.lit("low_confidence").alias("flag_type"), F.col("extraction_confidence").cast("string").alias("flag_detail"))


def vintage_inconsistency(joined: DataFrame) -> DataFrame:
    """Funds that investors report with different vintages."""
    return joined.where("vintage_year IS NOT NULL").groupBy("fund_id").agg(
        F.count_distinct("vintage_year").alias("n_vintages"), F.concat_ws(",", F.transform(F.sort_array(F.collect_set("vintage_year")), lambda v: v.cast("string"))).alias("vintages"),
    ).where("n_vintages > 1")


def spread(joined: DataFrame, field: str, least: float = MAX_SPREAD) -> DataFrame:
    """Fund names whose investors' values of a field lie further apart than `least`."""
    return joined.where(F.col(field).isNotNull()).groupBy(F.col("f_fund_name").alias("fund_name")).agg(
        F.count_distinct("pension_fund_id").alias("investors"), F.min(field).alias("least"), F.max(field).alias("most"), (F.max(field) - F.min(field)).alias("spread"),
    ).where((F.col("investors") > 1) & (F.col("spread") > least))


def widest_spreads(joined: DataFrame, field: str, n: int = 20) -> DataFrame:
    return spread(joined, field, 0.0).orderBy(F.desc("spread"), "fund_name").limit(n)


def completeness(commitments: DataFrame, fields: tuple[str, ...] = SCORED_FIELDS) -> DataFrame:
    """(field, n_rows, n_present, percent): one pass over the table, then one row per field."""
    counts = commitments.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(f).alias(f) for f in fields])
    item = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n_present")) for f in fields])
    return counts.select("n_rows", F.inline(item)).select("field", "n_rows", "n_present", F.when(F.col("n_rows") > 0, F.col("n_present") * 100.0 / F.col("n_rows")).alias("percent"))


def coverage_gap(investors: DataFrame, engagements: DataFrame) -> DataFrame:
    """Investors without any engagement."""
    return investors.join(engagements.select(F.col("pension_fund_id").alias("id")), "id", "left_anti").select(F.col("id").alias("pension_fund_id"), F.col("name").alias("investor"))


def orphan_rows(facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str = "id") -> DataFrame:
    """Facts whose key is not in the dimension: the check that stands in for a foreign key."""
    return facts.where(F.col(key).isNotNull()).join(dimension.select(F.col(dimension_key).alias(key)), key, "left_anti")


def refresh_queue(queue: DataFrame, found: DataFrame, kinds: tuple[str, ...] = ("value_range", "low_completeness", "cross_fund_inconsistency")) -> tuple[DataFrame, DataFrame]:
    """(new queue, counts): open flags of the given kinds are replaced by `found`; flags without a record are counted, not queued."""
    kept = queue.where(F.col("resolved") | ~F.col("flag_type").isin(*kinds))
    fresh = found.where("commitment_id IS NOT NULL").select("commitment_id", "flag_type", "flag_detail", F.lit(False).alias("resolved"))
    return kept.unionByName(fresh), found.agg(F.count(F.lit(1)).alias("created"), F.count("commitment_id").alias("queued"))


def queue_counts(queue: DataFrame) -> DataFrame:
    return queue.where(~F.col("resolved")).groupBy("flag_type").agg(F.count(F.lit(1)).alias("n"))


def tolerance_issues(tolerances: dict[str, float], exact: tuple[str, ...] = (), prefix: str = "r_") -> Column:
    """Array of the fields in which a row and its counterpart (prefixed columns) differ by more than the tolerance."""
    checks = [F.when(F.abs(F.col(c) - F.col(prefix + c)) > t, F.lit(c)) for c, t in tolerances.items()]
    checks += [F.when(~F.col(c).eqNullSafe(F.col(prefix + c)), F.lit(c)) for c in exact]
    return F.array_compact(F.array(*checks))
