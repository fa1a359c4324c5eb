"""Queries of engagements, of the registries, of runs and flags, and of the audit of a delivered sheet.

The driver's tables hold no engagements; they are read from the raw disclosures: the manager stands for the consulting
firm, the asset class for its mandate, the year of the vintage for the start.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from allocata.functions import parsers as P
from allocata.functions.fund_names import normalized_firm
from allocata.operators import audit as A
from allocata.operators import engagements as G
from allocata.operators import quality as Q
from allocata.operators import store as S
from allocata.operators.relational import prefix_fallback as prefixed
from allocata.session import table

ROLES = {"html_table": G.GENERAL_ROLE, "pdf_words": "private_equity_consultant", "pdf_regex": "real_assets_consultant"}


def _engagements(spark, sf_dir):
    d = table(spark, sf_dir, "disclosures_raw", "id", "pension_fund_id", "general_partner", "asset_class", "vintage_text", "extraction_method", "unit_note").where("general_partner IS NOT NULL AND extraction_method <> 'board_book_text'")
    role = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("extraction_method")), F.lit("other"))
    year = F.regexp_extract("vintage_text", r"(\d{4})", 1)
    return d.select(
        F.col("id").alias("engagement_id"), normalized_firm(F.col("general_partner")).alias("consulting_firm_id"), "pension_fund_id", role.alias("role"), F.col("asset_class").alias("mandate_scope"),
        F.try_to_date(F.concat(year, F.lit("-01-01"))).alias("start_date"), F.col("unit_note").isNull().alias("is_current"),
    )


def _firms(spark, sf_dir):
    g = table(spark, sf_dir, "disclosures_raw", "general_partner").where("general_partner IS NOT NULL")
    return g.groupBy(normalized_firm(F.col("general_partner")).alias("id")).agg(F.min("general_partner").alias("name")).withColumn("firm_type", F.when(F.contains("id", F.lit("group")), "group"))


def _joined(spark, sf_dir, **filters):
    return G.joined(_engagements(spark, sf_dir), _firms(spark, sf_dir), table(spark, sf_dir, "pension_funds", "id", "name", "state"), **filters)


def engagement_join(spark, sf_dir):
    return _joined(spark, sf_dir).select("engagement_id", "consulting_firm_name", "pension_fund_name", "pension_fund_state", "role", "start_date", "is_current")


def engagements_of(spark, sf_dir):
    """The same for one investor."""
    return _joined(spark, sf_dir, pension_fund_id="traxyaensa_trs").select("engagement_id", "consulting_firm_name", "role").orderBy("consulting_firm_name", "engagement_id")


def engagement_listing(spark, sf_dir):
    return G.listing(_joined(spark, sf_dir))


def primary_consultant(spark, sf_dir):
    """Every investor with its consultant, empty if it has none."""
    p = table(spark, sf_dir, "pension_funds", "id").withColumnRenamed("id", "pension_fund_id")
    return p.join(G.primary_consultant(_joined(spark, sf_dir)), "pension_fund_id", "left").select("pension_fund_id", F.coalesce("consultant", F.lit("")).alias("consultant"))


def engagement_matrix(spark, sf_dir):
    """Columns are the investors with engagements, as many as the data hold; their names must be known to plan the query."""
    rows = _joined(spark, sf_dir)
    return G.matrix(rows, sorted(r[0] for r in rows.select("pension_fund_name").distinct().collect()))


def uncovered_investors(spark, sf_dir):
    """Investors without any engagement."""
    return Q.coverage_gap(table(spark, sf_dir, "pension_funds", "id", "name"), _engagements(spark, sf_dir))


def engagement_upsert(spark, sf_dir):
    """Engagements without end merged by (firm, investor, role, start), missing starts compared as equal; the newer record wins."""
    e = _engagements(spark, sf_dir)
    key = ["consulting_firm_id", "pension_fund_id", "role", "start_date"]
    old = e.where("is_current").groupBy(*key).agg(F.min(F.struct("engagement_id", "mandate_scope")).alias("r")).select(*key, "r.*")
    new = e.where("NOT is_current").groupBy(*key).agg(F.max(F.struct("engagement_id", "mandate_scope")).alias("r")).select(*key, "r.*")
    return S.upsert(old, new, key, keep=("engagement_id",))


def registry_stats(spark, sf_dir):
    a = table(spark, sf_dir, "gp_aliases", "alias", "canonical_name")
    firms = a.select(F.col("canonical_name").alias("id"))
    return G.registry_stats(table(spark, sf_dir, "funds", "id"), table(spark, sf_dir, "fund_aliases", "alias"), firms, a)


def _sheet(spark, sf_dir):
    """The raw disclosures as a delivered sheet; every tenth row (by its id's last letter) has its cells shifted."""
    d = table(spark, sf_dir, "disclosures_raw", "id", "pension_fund_id", "fund_name_raw", "general_partner", "commitment_text", "vintage_text", "net_multiple_text").where("fund_name_raw IS NOT NULL")
    off = F.substring("id", -1, 1) == "7"
    amount = F.col("amount")
    cells = d.withColumn("amount", P.amount_in_millions(F.col("commitment_text"))).select(
        F.col("id").alias("row_id"), "pension_fund_id",
        F.when(off, F.col("general_partner")).otherwise("QA").alias("state"), F.when(off, F.col("fund_name_raw")).otherwise(F.col("general_partner")).alias("general_partner"),
        F.when(off, F.coalesce(amount.cast("string"), F.lit("0"))).otherwise(F.col("fund_name_raw")).alias("fund_name"), F.when(off, "").otherwise(amount.cast("string")).alias("commitment"), "vintage_text", "net_multiple_text",
    )
    return A.realigned(cells).select(
        "row_id", "pension_fund_id", "fund_name", "shifted", P.loose_float(F.col("commitment")).alias("commitment_mm"), P.vintage_year(F.col("vintage_text")).alias("vintage_year"), P.loose_float(F.col("net_multiple_text")).alias("net_multiple"),
    )


def _records(spark, sf_dir):
    c = table(spark, sf_dir, "commitments", "id", "pension_fund_id", "fund_id", "commitment_mm", "vintage_year", "net_multiple")
    return c.join(table(spark, sf_dir, "funds", F.col("id").alias("fund_id"), "fund_name"), "fund_id")


def sheet_audit(spark, sf_dir):
    return A.audited(_sheet(spark, sf_dir), _records(spark, sf_dir))


def audit_counts(spark, sf_dir):
    return A.counts(sheet_audit(spark, sf_dir))


def best_score_match(spark, sf_dir):
    """Each raw disclosure with the record of its investor and fund name that fits best by amount and vintage."""
    return A.best_records(_sheet(spark, sf_dir), _records(spark, sf_dir)).select(F.col("row_id").alias("raw_id"), F.col("r_id").alias("commitment_id"), F.col("score").cast("bigint").alias("score"), "found")


def prefix_fallback(spark, sf_dir):
    """Names of the raw disclosures looked up among the registered funds: equal, else by their first 25 characters."""
    wanted = table(spark, sf_dir, "disclosures_raw", "fund_name_raw").where("fund_name_raw IS NOT NULL").distinct().withColumnRenamed("fund_name_raw", "wanted")
    return prefixed(table(spark, sf_dir, "funds", "id", "fund_name"), "fund_name", wanted).select("wanted", "id", "how")


def _runs(spark, sf_dir):
    """A run log: one run per investor and quarter, in error where a reading has no confidence."""
    c = table(spark, sf_dir, "commitments", "pension_fund_id", "as_of_date", "extracted_at", "extraction_confidence").where("as_of_date IS NOT NULL")
    quarter = F.concat(F.year("as_of_date").cast("string"), F.lit("Q"), F.quarter("as_of_date").cast("string"))
    return c.groupBy("pension_fund_id", F.concat("pension_fund_id", F.lit("-"), quarter).alias("id")).agg(
        F.min("extracted_at").alias("started_at"), F.lit("running").alias("status"), F.lit(None).cast("string").alias("errors"), F.count(F.lit(1)).cast("int").alias("records_extracted"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )


def run_listing(spark, sf_dir):
    return S.run_listing(_runs(spark, sf_dir), "traxyaensa_trs").select("id", "started_at", "records_extracted")


def run_completion(spark, sf_dir):
    """The run log after one run has ended with an error."""
    done = S.finish_run(_runs(spark, sf_dir), "traxyaensa_trs-2023Q1", "error", {"records_extracted": 0}, F.lit("2025-01-01").cast("timestamp_ntz"), "no table")
    return done.select("id", "status", "errors", "records_extracted", "completed_at")


def _queue(spark, sf_dir):
    c = table(spark, sf_dir, "commitments")
    flags = Q.range_flags(c, 2026).unionByName(Q.ingest_flags(c)).join(c.select(F.col("id").alias("commitment_id"), "created_at", "status"), "commitment_id")
    return flags.select(F.concat_ws("/", "commitment_id", "flag_type", "flag_detail").alias("id"), "commitment_id", "flag_type", F.coalesce(F.col("status") == "active", F.lit(False)).alias("resolved"), "created_at")


def queue_listing(spark, sf_dir):
    return S.queue_listing(_queue(spark, sf_dir), resolved=False).select("commitment_id", "flag_type")


def queue_counts(spark, sf_dir):
    return Q.queue_counts(_queue(spark, sf_dir))


def flags_closed(spark, sf_dir):
    """Flags by type and state after those of low confidence were closed and the open ones of implausible values deleted, with the counts of both."""
    q, closed = S.resolve_flags(_queue(spark, sf_dir), flag_type="low_confidence")
    q, deleted = S.delete_open_flags(q, "value_range")
    left = q.groupBy(F.concat_ws("/", "flag_type", F.when(F.col("resolved"), "resolved").otherwise("open")).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return left.unionByName(closed.select(F.lit("closed").alias("what"), F.col("closed").alias("n"))).unionByName(deleted.select(F.lit("deleted").alias("what"), F.col("deleted").alias("n")))


def refreshed_queue(spark, sf_dir):
    """Flags after the rules ran again: open ones of the recomputed kinds are replaced, others stay."""
    c = table(spark, sf_dir, "commitments")
    found = Q.range_flags(c, 2026).unionByName(Q.low_completeness(c))
    old = _queue(spark, sf_dir).select("commitment_id", "flag_type", F.lit("").alias("flag_detail"), "resolved")
    queue, _ = Q.refresh_queue(old, found)
    return queue.groupBy("flag_type", "resolved").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        engagement_join, engagements_of, engagement_listing, primary_consultant, engagement_matrix, uncovered_investors, engagement_upsert, registry_stats, sheet_audit, audit_counts, best_score_match, prefix_fallback,
        run_listing, run_completion, queue_listing, queue_counts, flags_closed, refreshed_queue,
    )
}

_FIRM = "trim(general_partner)"
for _e in (r",?\s*LLC$", r",?\s*Ltd\.?$", r",?\s*Inc\.?$", r",?\s*L\.?P\.?$"):
    _FIRM = f"regexp_replace({_FIRM}, '(?i){_e}', '')"
_FIRM = f"lower(trim(regexp_replace({_FIRM}, '\\s+', ' ', 'g')))"
_E = f"""
e AS (SELECT id AS engagement_id, {_FIRM} AS firm_id, pension_fund_id, CASE extraction_method WHEN 'html_table' THEN 'general_investment_consultant' WHEN 'pdf_words' THEN 'private_equity_consultant' WHEN 'pdf_regex' THEN 'real_assets_consultant' ELSE 'other' END AS role,
  asset_class AS mandate_scope, TRY_CAST(regexp_extract(vintage_text, '(\\d{{4}})', 1) || '-01-01' AS DATE) AS start_date, unit_note IS NULL AS is_current FROM disclosures_raw WHERE general_partner IS NOT NULL AND extraction_method <> 'board_book_text'),
f AS (SELECT {_FIRM} AS firm_id, min(general_partner) AS consulting_firm_name, CASE WHEN contains({_FIRM}, 'group') THEN 'group' END AS firm_type FROM disclosures_raw WHERE general_partner IS NOT NULL GROUP BY 1, 3),
j AS (SELECT e.*, consulting_firm_name, firm_type, p.name AS pension_fund_name, p.state AS pension_fund_state FROM e JOIN f USING (firm_id) JOIN pension_funds p ON p.id = e.pension_fund_id)"""
_EMPTY = ", ".join(f"'{x}'" for x in P.NO_DATA)
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SHEET = f"""
d AS (SELECT id AS row_id, pension_fund_id, fund_name_raw, id LIKE '%7' AS shifted, CASE WHEN regexp_matches(x, '{_NUMBER}') THEN CASE WHEN w THEN -TRY_CAST(x AS DOUBLE) ELSE TRY_CAST(x AS DOUBLE) END END AS amount, vintage_text AS v, trim(net_multiple_text) AS m
  FROM (SELECT *, s LIKE '(%)' AS w, regexp_replace(CASE WHEN s LIKE '(%)' THEN s[2:-2] ELSE s END, '[$,\\s]', '', 'g') AS x FROM (SELECT *, CASE WHEN trim(commitment_text) NOT IN ({_EMPTY}) THEN trim(commitment_text) END AS s FROM disclosures_raw WHERE fund_name_raw IS NOT NULL))),
s AS (SELECT row_id, pension_fund_id, fund_name_raw AS fund_name, shifted, CASE WHEN shifted THEN coalesce(amount, 0) ELSE amount END AS commitment_mm, CASE WHEN y BETWEEN 1980 AND 2030 THEN y END AS vintage_year, CASE WHEN regexp_matches(t, '{_NUMBER}') THEN TRY_CAST(t AS DOUBLE) END AS net_multiple
  FROM (SELECT *, CASE WHEN trim(v) NOT IN ({_EMPTY}) THEN TRY_CAST(regexp_extract(v, '(\\d{{4}})', 1) AS INT) END AS y, regexp_replace(m, '[xX,]', '', 'g') AS t FROM d)),
r AS (SELECT c.id, c.pension_fund_id, fund_name, commitment_mm, c.vintage_year, net_multiple FROM commitments c JOIN funds f ON f.id = c.fund_id),
m0 AS (SELECT s.*, 'exact' AS found, r.id AS r_id, r.commitment_mm AS rc, r.vintage_year AS rv, r.net_multiple AS rm FROM s JOIN r ON s.pension_fund_id = r.pension_fund_id AND s.fund_name = r.fund_name),
m1 AS (SELECT s.*, 'prefix' AS found, r.id AS r_id, r.commitment_mm AS rc, r.vintage_year AS rv, r.net_multiple AS rm FROM s JOIN r ON s.pension_fund_id = r.pension_fund_id AND starts_with(lower(r.fund_name), lower(left(s.fund_name, 25))) WHERE row_id NOT IN (SELECT row_id FROM m0)),
best AS (SELECT *, CASE WHEN abs(rc - commitment_mm) < 1 THEN 3 WHEN abs(rc - commitment_mm) < 10 THEN 1 ELSE 0 END + CASE WHEN vintage_year = rv THEN 2 ELSE 0 END AS score FROM (SELECT * FROM m0 UNION ALL SELECT * FROM m1)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, r_id) = 1),
a AS (SELECT s.row_id, s.pension_fund_id, r_id AS record_id, CAST(score AS BIGINT) AS score, s.shifted,
  CASE WHEN r_id IS NULL THEN 'no record' ELSE concat_ws(',', CASE WHEN abs(best.commitment_mm - rc) > 1 THEN 'commitment_mm' END, CASE WHEN abs(best.net_multiple - rm) > 0.05 THEN 'net_multiple' END, CASE WHEN best.vintage_year <> rv THEN 'vintage_year' END) END AS issues FROM s LEFT JOIN best USING (row_id)),
st AS (SELECT row_id, pension_fund_id, record_id, score, issues, CASE WHEN record_id IS NOT NULL AND (shifted OR issues = '') THEN 'confirmed' ELSE 'suspect' END AS status FROM a)"""
_RUNS = "rn AS (SELECT pension_fund_id, pension_fund_id || '-' || year(as_of_date) || 'Q' || quarter(as_of_date) AS id, min(extracted_at) AS started_at, count(*)::INT AS records_extracted FROM commitments WHERE as_of_date IS NOT NULL GROUP BY 1, 2)"
_RANGE = """SELECT id AS commitment_id, 'value_range' AS flag_type FROM commitments WHERE commitment_mm < 0.1 OR commitment_mm > 5000 UNION ALL SELECT id, 'value_range' FROM commitments WHERE net_irr < -0.5 OR net_irr > 1.5
 UNION ALL SELECT id, 'value_range' FROM commitments WHERE net_multiple < 0 UNION ALL SELECT id, 'value_range' FROM commitments WHERE net_multiple > 15 UNION ALL SELECT id, 'value_range' FROM commitments WHERE vintage_year < 1980 OR vintage_year > 2026"""
_QUEUE = f"q AS (SELECT commitment_id, flag_type, coalesce(status = 'active', false) AS resolved FROM ({_RANGE} UNION ALL SELECT id, 'low_confidence' FROM commitments WHERE extraction_confidence < 0.85) x JOIN commitments c ON c.id = x.commitment_id)"

ORACLE = {
    "engagement_join": f"WITH {_E} SELECT engagement_id, consulting_firm_name, pension_fund_name, pension_fund_state, role, start_date, is_current FROM j",
    "engagements_of": f"WITH {_E} SELECT engagement_id, consulting_firm_name, role FROM j WHERE pension_fund_id = 'traxyaensa_trs'",
    "engagement_listing": f"WITH {_E} SELECT pension_fund_name, string_agg(line, '; ' ORDER BY line) AS firms FROM (SELECT DISTINCT pension_fund_name, consulting_firm_name || ': ' || role || CASE WHEN coalesce(mandate_scope, '') <> '' THEN ' [' || mandate_scope || ']' ELSE '' END || CASE WHEN is_current THEN ' (current)' ELSE '' END AS line FROM j) GROUP BY 1",
    "primary_consultant": f"WITH {_E} SELECT p.id AS pension_fund_id, coalesce(c.firm, '') AS consultant FROM pension_funds p LEFT JOIN (SELECT pension_fund_id, coalesce(min(consulting_firm_name) FILTER (role = 'general_investment_consultant'), arg_min(consulting_firm_name, (role, consulting_firm_name))) AS firm FROM j GROUP BY 1) c ON c.pension_fund_id = p.id",
    "engagement_matrix": f"WITH {_E}, w AS (SELECT consulting_firm_name AS consulting_firm, firm_type, pension_fund_name, arg_max(role || CASE WHEN is_current THEN ' (current)' ELSE '' END, (coalesce(start_date::VARCHAR, ''), role, coalesce(mandate_scope, ''), is_current::INT)) AS label FROM j GROUP BY ALL) SELECT consulting_firm, coalesce(firm_type, '') AS firm_type, coalesce(COLUMNS(* EXCLUDE (consulting_firm, firm_type)), '') FROM (PIVOT w ON pension_fund_name USING max(label) GROUP BY consulting_firm, firm_type)",
    "uncovered_investors": f"WITH {_E} SELECT id AS pension_fund_id, name AS investor FROM pension_funds WHERE id NOT IN (SELECT pension_fund_id FROM e)",
    "engagement_upsert": f"""WITH {_E}, o AS (SELECT firm_id, pension_fund_id, role, start_date, min(engagement_id) AS engagement_id, arg_min_null(mandate_scope, engagement_id) AS mandate_scope FROM e WHERE is_current GROUP BY ALL),
n AS (SELECT firm_id, pension_fund_id, role, start_date, max(engagement_id) AS engagement_id, arg_max_null(mandate_scope, engagement_id) AS mandate_scope FROM e WHERE NOT is_current GROUP BY ALL)
SELECT coalesce(o.firm_id, n.firm_id) AS consulting_firm_id, coalesce(o.pension_fund_id, n.pension_fund_id) AS pension_fund_id, coalesce(o.role, n.role) AS role, coalesce(o.start_date, n.start_date) AS start_date, coalesce(o.engagement_id, n.engagement_id) AS engagement_id,
 CASE WHEN n.engagement_id IS NOT NULL THEN n.mandate_scope ELSE o.mandate_scope END AS mandate_scope FROM o FULL JOIN n ON o.firm_id = n.firm_id AND o.pension_fund_id = n.pension_fund_id AND o.role = n.role AND coalesce(o.start_date, DATE '0001-01-01') = coalesce(n.start_date, DATE '0001-01-01')""",
    "registry_stats": "SELECT (SELECT count(DISTINCT id) FROM funds) AS total_funds, (SELECT count(DISTINCT lower(alias)) FROM fund_aliases) AS fund_aliases, count(DISTINCT lower(canonical_name)) AS total_firms, count(DISTINCT lower(alias)) AS firm_aliases FROM gp_aliases",
    "sheet_audit": f"WITH {_SHEET} SELECT * FROM st",
    "audit_counts": f"WITH {_SHEET} SELECT pension_fund_id, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'suspect') AS suspect FROM st GROUP BY 1",
    "best_score_match": f"WITH {_SHEET} SELECT row_id AS raw_id, r_id AS commitment_id, CAST(score AS BIGINT) AS score, found FROM best",
    "prefix_fallback": "WITH w AS (SELECT DISTINCT fund_name_raw AS wanted FROM disclosures_raw WHERE fund_name_raw IS NOT NULL), x AS (SELECT wanted, f.id FROM w JOIN funds f ON f.fund_name = w.wanted) SELECT wanted, id, 'exact' AS how FROM x UNION ALL SELECT wanted, f.id, 'prefix' FROM w JOIN funds f ON lower(left(w.wanted, 25)) = lower(left(f.fund_name, 25)) WHERE wanted NOT IN (SELECT wanted FROM x)",
    "run_listing": f"WITH {_RUNS} SELECT id, started_at, records_extracted FROM rn WHERE pension_fund_id = 'traxyaensa_trs'",
    "run_completion": f"WITH {_RUNS} SELECT id, CASE WHEN id = 'traxyaensa_trs-2023Q1' THEN 'error' ELSE 'running' END AS status, CASE WHEN id = 'traxyaensa_trs-2023Q1' THEN 'no table' END AS errors, CASE WHEN id = 'traxyaensa_trs-2023Q1' THEN 0::INT ELSE records_extracted END AS records_extracted, CASE WHEN id = 'traxyaensa_trs-2023Q1' THEN TIMESTAMP '2025-01-01' END AS completed_at FROM rn",
    "queue_listing": f"WITH {_QUEUE} SELECT commitment_id, flag_type FROM q WHERE NOT resolved",
    "queue_counts": f"WITH {_QUEUE} SELECT flag_type, count(*) AS n FROM q WHERE NOT resolved GROUP BY 1",
    "flags_closed": f"WITH {_QUEUE} SELECT flag_type || '/resolved' AS what, count(*) AS n FROM q WHERE resolved OR flag_type = 'low_confidence' GROUP BY 1 UNION ALL SELECT 'closed', count(*) FILTER (NOT resolved AND flag_type = 'low_confidence') FROM q UNION ALL SELECT 'deleted', count(*) FILTER (NOT resolved AND flag_type = 'value_range') FROM q",
    "refreshed_queue": f"""WITH {_QUEUE}, fresh AS ({_RANGE} UNION ALL SELECT id, 'low_completeness' FROM commitments WHERE (commitment_mm IS NOT NULL)::INT + (capital_called_mm IS NOT NULL)::INT + (capital_distributed_mm IS NOT NULL)::INT + (remaining_value_mm IS NOT NULL)::INT + (net_irr IS NOT NULL)::INT + (net_multiple IS NOT NULL)::INT < 2)
SELECT flag_type, resolved, count(*) AS n FROM (SELECT flag_type, resolved FROM q WHERE resolved OR flag_type = 'low_confidence' UNION ALL SELECT flag_type, false FROM fresh) GROUP BY 1, 2""",
}
