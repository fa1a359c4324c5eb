"""Queries of state maintenance: what an upsert, an insert-or-ignore and a skip of unchanged sources leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from allocata.operators import store as S
from allocata.session import table

CUT = "2024-06-30"


def _key(rows):
    return rows.select("pension_fund_id", "fund_id", "as_of_date", "id", "commitment_mm", "net_irr", "created_at", "updated_at")


def _halves(spark, sf_dir):
    c = _key(table(spark, sf_dir, "commitments"))
    order = F.struct("updated_at", "id")
    # Each side holds one row per key, as the store guarantees.
    old = c.where(F.col("updated_at") < F.lit(CUT).cast("timestamp_ntz")).groupBy("pension_fund_id", "fund_id").agg(F.max_by(F.struct("id", "commitment_mm", "net_irr", "created_at", "updated_at"), order).alias("r")).select("pension_fund_id", "fund_id", "r.*")
    new = c.where(F.col("updated_at") >= F.lit(CUT).cast("timestamp_ntz")).groupBy("pension_fund_id", "fund_id").agg(F.max_by(F.struct("id", "commitment_mm", "net_irr", "created_at", "updated_at"), order).alias("r")).select("pension_fund_id", "fund_id", "r.*")
    return old, new


def upsert_merge(spark, sf_dir):
    """Positions known before the cut, updated by those after it; id and creation time stay those of the first."""
    old, new = _halves(spark, sf_dir)
    return S.upsert(old, new, ["pension_fund_id", "fund_id"], keep=("id", "created_at"))


def upsert_fill(spark, sf_dir):
    """The same, but a missing value does not erase a known one."""
    old, new = _halves(spark, sf_dir)
    return S.upsert(old, new, ["pension_fund_id", "fund_id"], keep=("id", "created_at"), fill=True).select("pension_fund_id", "fund_id", "commitment_mm", "net_irr")


def insert_ignore(spark, sf_dir):
    """Registered aliases, and names of the raw disclosures that are not among them."""
    a = table(spark, sf_dir, "fund_aliases", "alias").distinct()
    d = table(spark, sf_dir, "disclosures_raw", "fund_name_raw").where("fund_name_raw IS NOT NULL").select(F.col("fund_name_raw").alias("alias"))
    return S.insert_ignore(a, d, ["alias"])


def _runs(spark, sf_dir):
    """A run log derived from the load dates: one run per investor and quarter."""
    c = table(spark, sf_dir, "commitments", "pension_fund_id", "as_of_date", "extracted_at", "source_document")
    return c.where("as_of_date IS NOT NULL").groupBy("pension_fund_id", F.concat_ws("Q", F.year("as_of_date"), F.quarter("as_of_date")).alias("id")).agg(
        F.max("extracted_at").alias("started_at"), F.count(F.lit(1)).alias("records_extracted"), F.lit("completed").alias("status"), F.max("source_document").alias("source_hash"),
    )


def latest_runs(spark, sf_dir):
    return S.latest_runs(_runs(spark, sf_dir)).select("pension_fund_id", "id", "records_extracted")


def status_listing(spark, sf_dir):
    sources = table(spark, sf_dir, "pension_funds", "id").withColumnRenamed("id", "pension_fund_id")
    return S.status_listing(sources, _runs(spark, sf_dir)).select("pension_fund_id", "status", "records_extracted")


def hash_skip(spark, sf_dir):
    """Investors whose latest raw document differs from their last run's."""
    d = table(spark, sf_dir, "disclosures_raw", "pension_fund_id", "source_document").where("source_document IS NOT NULL").groupBy("pension_fund_id").agg(F.max("source_document").alias("source_hash"))
    return S.changed_sources(d, _runs(spark, sf_dir))


QUERIES = {f.__name__: f for f in (upsert_merge, upsert_fill, insert_ignore, latest_runs, status_listing, hash_skip)}

_LAST = "(SELECT pension_fund_id, fund_id, unnest(max_by({{'id': id, 'commitment_mm': commitment_mm, 'net_irr': net_irr, 'created_at': created_at, 'updated_at': updated_at}}, (updated_at, id))) FROM commitments WHERE updated_at {0} TIMESTAMP '" + CUT + "' GROUP BY 1, 2)"
_HALVES = f"WITH o AS {_LAST.format('<')}, n AS {_LAST.format('>=')}"
_RUNS = "(SELECT pension_fund_id, year(as_of_date)::VARCHAR || 'Q' || quarter(as_of_date)::VARCHAR AS id, max(extracted_at) AS started_at, count(*) AS records_extracted, max(source_document) AS source_hash FROM commitments WHERE as_of_date IS NOT NULL GROUP BY 1, 2)"
_LATEST = f"(SELECT * FROM {_RUNS} QUALIFY row_number() OVER (PARTITION BY pension_fund_id ORDER BY started_at DESC, id DESC) = 1)"

ORACLE = {
    "upsert_merge": f"{_HALVES} SELECT pension_fund_id, fund_id, coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.commitment_mm ELSE o.commitment_mm END AS commitment_mm, CASE WHEN n.id IS NOT NULL THEN n.net_irr ELSE o.net_irr END AS net_irr, coalesce(o.created_at, n.created_at) AS created_at, coalesce(n.updated_at, o.updated_at) AS updated_at FROM o FULL JOIN n USING (pension_fund_id, fund_id)",
    "upsert_fill": f"{_HALVES} SELECT pension_fund_id, fund_id, coalesce(n.commitment_mm, o.commitment_mm) AS commitment_mm, coalesce(n.net_irr, o.net_irr) AS net_irr FROM o FULL JOIN n USING (pension_fund_id, fund_id)",
    "insert_ignore": "SELECT alias FROM fund_aliases UNION SELECT fund_name_raw FROM disclosures_raw WHERE fund_name_raw IS NOT NULL",
    "latest_runs": f"SELECT pension_fund_id, id, records_extracted FROM {_LATEST}",
    "status_listing": f"SELECT p.id AS pension_fund_id, CASE WHEN r.id IS NULL THEN 'No runs yet' ELSE 'completed' END AS status, r.records_extracted FROM pension_funds p LEFT JOIN {_LATEST} r ON r.pension_fund_id = p.id",
    "hash_skip": f"SELECT d.pension_fund_id, d.source_hash FROM (SELECT pension_fund_id, max(source_document) AS source_hash FROM disclosures_raw WHERE source_document IS NOT NULL GROUP BY 1) d LEFT JOIN {_LATEST} r ON r.pension_fund_id = d.pension_fund_id AND r.source_hash = d.source_hash WHERE r.id IS NULL",
}
