"""Queries p4..p7: profile per load, snapshot changes, units and spikes, with their SQL for a second engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata.operators import profile, snapshots, spikes, units
from allocata.operators.ranking import quarter
from allocata.session import cut, table

SHIFT_COLUMNS = ("net_irr", "remaining_value_mm", "capital_distributed_mm")
LOAD = ("method", "quarter")


def _loads(commitments: DataFrame) -> tuple[DataFrame, dict]:
    dated = commitments.where(F.col("as_of_date").isNotNull())
    return dated, {"method": F.col("extraction_method"), "quarter": quarter(F.col("as_of_date"))}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated, load = _loads(table(spark, sf_dir, "commitments", "extraction_method", "as_of_date", *SHIFT_COLUMNS))
    masks = profile.mask_counts(profile.value_counts(dated, load, SHIFT_COLUMNS), LOAD)
    shifts = profile.load_shifts(profile.load_measures(masks, LOAD), "method", "quarter")
    return shifts.select(F.col("method").alias("extraction_method"), F.col("quarter").alias("load_quarter"), "column_name", "measure_name")


def _all_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of every column of every row; undated rows of a method are a load of their own."""
    commitments = table(spark, sf_dir, "commitments")
    load = {"method": F.col("extraction_method"), "quarter": quarter(F.col("as_of_date"))}
    return profile.mask_counts(profile.value_counts(commitments, load, commitments.columns), LOAD)


def p4_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(_all_masks(spark, sf_dir), LOAD).withColumnsRenamed({"load_method": "extraction_method", "load_quarter": "quarter"})


def p4_rare_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masks that violate a column's dominant patterns, with an example of each."""
    return profile.rare_masks(_all_masks(spark, sf_dir))


def p4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every column between consecutive dated loads; an undated load has no place in the order."""
    commitments = table(spark, sf_dir, "commitments")
    dated, load = _loads(commitments)
    masks = profile.mask_counts(profile.value_counts(dated, load, commitments.columns), LOAD)
    return profile.mask_divergence(masks, "method", "quarter").withColumnRenamed("method", "extraction_method")


def _snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "commitments", "id", "pension_fund_id", "fund_id", "as_of_date", "extraction_confidence", "extracted_at", *snapshots.FIELDS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_changes(_snapshot_rows(spark, sf_dir)).drop("changed_fields")


def _unit_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        table(spark, sf_dir, "commitments", "id", "pension_fund_id", "fund_id", "commitment_mm", "net_irr", "net_multiple", "as_of_date"),
        table(spark, sf_dir, "funds", "id", "fund_size_mm", "vintage_year"),
        table(spark, sf_dir, "disclosures_raw", "id", "pension_fund_id", "commitment_text", "net_irr_text", "unit_note"),
    )


def p6_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.record_units(*_unit_inputs(spark, sf_dir))


def p6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.source_units(*_unit_inputs(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_units(spark, sf_dir).where(~F.col("unit").isin("million", "fraction")).select("record_id", "field", "unit")


def p7_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    commitments, funds, disclosures = _unit_inputs(spark, sf_dir)
    return spikes.implausible(commitments, cut(units.source_units(commitments, funds, disclosures)))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_readings(spark, sf_dir).select(F.col("id").alias("commitment_id"), "field")


def p7_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.jumps(table(spark, sf_dir, "commitments", "pension_fund_id", "fund_id", "as_of_date", *spikes.FIELDS))


QUERIES = {
    f.__name__: f for f in (p4_found, p4_profile, p4_rare_masks, p4_divergence, p5_found, p6_found, p6_units, p6_sources, p7_found, p7_readings, p7_jumps)
}

_QUARTER = "(year(as_of_date)::VARCHAR || 'Q' || quarter(as_of_date)::VARCHAR)"
_P4 = f"""
WITH long AS (
  SELECT extraction_method, {_QUARTER} AS q, u.column_name, u.v
  FROM commitments, LATERAL (VALUES ('net_irr', net_irr), ('remaining_value_mm', remaining_value_mm), ('capital_distributed_mm', capital_distributed_mm)) u(column_name, v)
  WHERE as_of_date IS NOT NULL),
counts AS (SELECT extraction_method, q, column_name, v, count(*) AS n FROM long GROUP BY ALL),
loads AS (
  SELECT extraction_method, q, column_name, sum(n)::BIGINT AS rows_n, coalesce(sum(n) FILTER (v IS NULL), 0)::BIGINT AS nulls, coalesce(sum(n) FILTER (v = 0), 0)::BIGINT AS zeros,
    coalesce(sum(n) FILTER (v < 0), 0)::BIGINT AS negatives, coalesce(max(n) FILTER (v IS NOT NULL), 0)::BIGINT AS modes
  FROM counts GROUP BY ALL),
m AS (SELECT extraction_method, q, column_name, rows_n, u.measure_name, u.hits FROM loads, LATERAL (VALUES ('null', nulls), ('zero', zeros), ('negative', negatives), ('mode', modes)) u(measure_name, hits)),
b AS (SELECT *, lag(hits) OVER w AS h0, lag(rows_n) OVER w AS n0 FROM m WINDOW w AS (PARTITION BY extraction_method, column_name, measure_name ORDER BY q))
SELECT extraction_method, q AS load_quarter, column_name, measure_name FROM b
WHERE n0 >= 15 AND rows_n >= 15 AND abs(hits * n0 - h0 * rows_n) * 10 > 3 * n0 * rows_n
"""
_P5 = f"""
WITH r AS (
  SELECT pension_fund_id, fund_id, {_QUARTER} AS q, commitment_mm, capital_called_mm,
    row_number() OVER (PARTITION BY pension_fund_id, fund_id, {_QUARTER} ORDER BY as_of_date DESC, extraction_confidence DESC NULLS LAST, extracted_at DESC NULLS LAST, id) AS rn
  FROM commitments WHERE as_of_date IS NOT NULL),
s AS (SELECT pension_fund_id, fund_id, q, arg_min(commitment_mm, rn) FILTER (commitment_mm IS NOT NULL) AS a, arg_min(capital_called_mm, rn) FILTER (capital_called_mm IS NOT NULL) AS c FROM r GROUP BY ALL),
cal AS (SELECT pension_fund_id, q, row_number() OVER (PARTITION BY pension_fund_id ORDER BY q) AS n FROM (SELECT DISTINCT pension_fund_id, q FROM s)),
x AS (SELECT s.*, n FROM s JOIN cal USING (pension_fund_id, q)),
pairs AS (
  SELECT coalesce(o.pension_fund_id, w.pension_fund_id) AS pension_fund_id, coalesce(o.fund_id, w.fund_id) AS fund_id, coalesce(w.n, o.n + 1) AS n,
    CASE WHEN o.n IS NULL THEN 'added' WHEN w.n IS NULL THEN 'removed'
      WHEN (o.a IS NULL) <> (w.a IS NULL) OR abs(o.a - w.a) > 1e-6 * greatest(abs(o.a), abs(w.a)) OR (o.c IS NULL) <> (w.c IS NULL) OR abs(o.c - w.c) > 1e-6 * greatest(abs(o.c), abs(w.c)) THEN 'changed' END AS change_type
  FROM x o FULL JOIN x w ON o.pension_fund_id = w.pension_fund_id AND o.fund_id = w.fund_id AND o.n + 1 = w.n)
SELECT p.pension_fund_id, p.fund_id, cal.q AS snapshot_quarter, change_type FROM pairs p JOIN cal USING (pension_fund_id, n) WHERE change_type IS NOT NULL AND n > 1
"""
ORACLE = {"p4_found": _P4, "p5_found": _P5}
