"""Relational queries by name over investors, funds and commitments, with their SQL for a second engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata.functions.fund_names import family_name
from allocata.operators import quality as Q
from allocata.operators import relational as R
from allocata.session import table

VINTAGE_TO = 2026


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.star(table(spark, sf_dir, "commitments"), table(spark, sf_dir, "funds"), table(spark, sf_dir, "pension_funds"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "commitments")


def fund_summary(spark, sf_dir):
    return R.fund_summary(_star(spark, sf_dir))


def top_funds(spark, sf_dir):
    return R.top_funds(_star(spark, sf_dir))


def cross_link_tiers(spark, sf_dir):
    return R.cross_link_tiers(_facts(spark, sf_dir))


def investor_pivot(spark, sf_dir):
    """The matrix with a column for every investor that has commitments, as many as the data hold."""
    held = table(spark, sf_dir, "pension_funds", "id").join(_facts(spark, sf_dir).select(F.col("pension_fund_id").alias("id")), "id", "left_semi")
    # Column names must be known to plan the query, so the ids, one an investor, come to the driver.
    return R.investor_pivot(_star(spark, sf_dir), sorted(r["id"] for r in held.distinct().collect()))


def performance_by_vintage(spark, sf_dir):
    return R.performance_by_vintage(_facts(spark, sf_dir))


def vintage_having(spark, sf_dir):
    return R.performance_by_vintage(_facts(spark, sf_dir), least_rows=5, from_year=1995).select("vintage_year", "n", "avg_irr", "avg_multiple")


def gp_leaderboard(spark, sf_dir):
    return R.gp_leaderboard(_star(spark, sf_dir))


def commitment_trends(spark, sf_dir):
    return R.commitment_trends(_star(spark, sf_dir))


def gp_penetration(spark, sf_dir):
    return R.gp_penetration(_star(spark, sf_dir), family_name(F.col("f_fund_name")))


def investor_overview(spark, sf_dir):
    return R.investor_overview(_star(spark, sf_dir))


def capital_flows(spark, sf_dir):
    return R.capital_flows(_star(spark, sf_dir))


def strategy_having(spark, sf_dir):
    return R.strategy_performance(_star(spark, sf_dir))


def strategy_histogram(spark, sf_dir):
    return table(spark, sf_dir, "funds", "sub_strategy").groupBy(F.coalesce("sub_strategy", F.lit("Unclassified")).alias("strategy")).agg(R.n_rows().alias("n"))


def widely_held(spark, sf_dir):
    return R.widely_held(_star(spark, sf_dir))


def headline(spark, sf_dir):
    return R.headline(_star(spark, sf_dir))


def global_stats(spark, sf_dir):
    return R.global_stats(_star(spark, sf_dir))


def irr_quartiles(spark, sf_dir):
    return R.irr_quartiles(_star(spark, sf_dir))


def performance_band(spark, sf_dir):
    return R.performance_band(_star(spark, sf_dir))


def name_pattern_filter(spark, sf_dir):
    return R.first_time_funds(_star(spark, sf_dir))


def optional_filters(spark, sf_dir):
    return R.commitments_where(_facts(spark, sf_dir), pension_fund_id="traxyaensa_trs").select("id", "fund_id", "commitment_mm")


def text_search(spark, sf_dir):
    return R.text_search(table(spark, sf_dir, "funds", "id", "fund_name", "general_partner"), "asia", ["fund_name", "general_partner"]).select("id", "fund_name")


def linked_comparison(spark, sf_dir):
    return R.linked_comparison(_star(spark, sf_dir), _facts(spark, sf_dir))


def unlinked_rows(spark, sf_dir):
    return R.unlinked_rows(_facts(spark, sf_dir))


def left_join_lookup(spark, sf_dir):
    """Every fund with its manager's reach and its first alias, defaults where there is none."""
    funds = table(spark, sf_dir, "funds", "id", "general_partner_normalized")
    reach = R.gp_cross_count(funds, _facts(spark, sf_dir))
    alias = table(spark, sf_dir, "fund_aliases", "fund_id", "alias").groupBy(F.col("fund_id").alias("id")).agg(F.min("alias").alias("alias"))
    return funds.join(reach, "general_partner_normalized", "left").join(alias, "id", "left").select("id", F.coalesce("gp_cross_count", F.lit(0)).alias("gp_cross_count"), F.coalesce("alias", F.lit("")).alias("alias"))


def alias_listing(spark, sf_dir):
    """Aliases with their fund and, where the investor holds it, the latest amount: a left join on two keys."""
    a, c = table(spark, sf_dir, "fund_aliases"), R.latest_positions(_facts(spark, sf_dir)).select("pension_fund_id", "fund_id", "commitment_mm")
    f = table(spark, sf_dir, "funds", "id", "fund_name").withColumnRenamed("id", "fund_id")
    return a.withColumnRenamed("source_pension_fund_id", "pension_fund_id").join(f, "fund_id").join(c, ["fund_id", "pension_fund_id"], "left").select(F.col("id").alias("alias_id"), "alias", "fund_name", "commitment_mm")


def latest_snapshot(spark, sf_dir):
    return R.latest_positions(_facts(spark, sf_dir))


def last_non_null(spark, sf_dir):
    return R.last_non_null(_facts(spark, sf_dir), ["net_irr", "net_multiple", "dpi"])


def top2_per_group(spark, sf_dir):
    return R.top_per_group(_star(spark, sf_dir))


def distinct_label(spark, sf_dir):
    return R.labelled_by_source(_facts(spark, sf_dir), table(spark, sf_dir, "pension_funds"))


def quota_sample(spark, sf_dir):
    return R.quota_sample(_facts(spark, sf_dir))


def capped_selection(spark, sf_dir):
    return R.capped_selection(_star(spark, sf_dir))


def stratified_sample(spark, sf_dir):
    return R.stratified_sample(_facts(spark, sf_dir), 480)


def reup_flag(spark, sf_dir):
    return R.reup_flag(_star(spark, sf_dir))


def spread_report(spark, sf_dir):
    return Q.widest_spreads(_star(spark, sf_dir), "net_multiple").select("fund_name", "investors", "least", "most")


def multiple_divergence(spark, sf_dir):
    return Q.spread(_star(spark, sf_dir), "net_multiple").select("fund_name", "investors", "least", "most")


def vintage_inconsistency(spark, sf_dir):
    return Q.vintage_inconsistency(_facts(spark, sf_dir))


def range_flags(spark, sf_dir):
    return Q.range_flags(_facts(spark, sf_dir), VINTAGE_TO).select("commitment_id", F.split("flag_detail", " [0-9.-]").getItem(0).alias("what"))


def low_completeness(spark, sf_dir):
    return Q.low_completeness(_facts(spark, sf_dir)).select("commitment_id", "flag_detail")


def ingest_flags(spark, sf_dir):
    return Q.ingest_flags(_facts(spark, sf_dir)).select("commitment_id", "flag_type")


def completeness(spark, sf_dir):
    return Q.completeness(_facts(spark, sf_dir), Q.PROFILE_FIELDS)


def coverage_gap(spark, sf_dir):
    """Investors without a document in the corpus."""
    return Q.coverage_gap(table(spark, sf_dir, "pension_funds", "id", "name"), table(spark, sf_dir, "documents", "pension_fund_id"))


def orphan_commitments(spark, sf_dir):
    return Q.orphan_rows(_facts(spark, sf_dir), "fund_id", table(spark, sf_dir, "funds", "id")).select("id", "fund_id")


def status_counts(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy("pension_fund_id", F.lower(F.coalesce("status", F.lit("unknown"))).alias("status")).agg(R.n_rows().alias("n"))


def distinct_documents(spark, sf_dir):
    return _facts(spark, sf_dir).select("pension_fund_id", "source_document").distinct()


def method_matrix(spark, sf_dir):
    """Investor x method matrix of the last source document: the latest value wins."""
    methods = ["pdf_words", "pdf_regex", "html_table", "board_book_text"]
    rows = _facts(spark, sf_dir).where("source_document IS NOT NULL")
    return R.last_value_pivot(rows, "pension_fund_id", "extraction_method", F.col("source_document"), F.struct("as_of_date", "id"), methods)


QUERIES = {
    f.__name__: f
    for f in (
        fund_summary, top_funds, cross_link_tiers, investor_pivot, performance_by_vintage, vintage_having, gp_leaderboard, commitment_trends, gp_penetration, investor_overview, capital_flows,
        strategy_having, strategy_histogram, widely_held, headline, global_stats, irr_quartiles, performance_band, name_pattern_filter, optional_filters, text_search, linked_comparison, unlinked_rows,
        left_join_lookup, alias_listing, latest_snapshot, last_non_null, top2_per_group, distinct_label, quota_sample, capped_selection, stratified_sample, reup_flag, spread_report,
        multiple_divergence, vintage_inconsistency, range_flags, low_completeness, ingest_flags, completeness, coverage_gap, orphan_commitments, status_counts, distinct_documents, method_matrix,
    )
}

_J = "commitments c JOIN funds f ON c.fund_id = f.id JOIN pension_funds p ON c.pension_fund_id = p.id"


def _sum(c: str) -> str:
    return f"CAST(CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(28,7))) AS VARCHAR) AS DOUBLE)"  # through text: a direct cast of a large decimal is off by a digit


def _avg(c: str) -> str:
    return f"CASE WHEN count({c}) > 0 THEN {_sum(c)} / count({c}) END"


_SUMMARY = f"""
SELECT c.fund_id, min(f.fund_name) AS fund_name, min(f.vintage_year) AS vintage_year, count(DISTINCT c.pension_fund_id) AS investor_count,
  coalesce(string_agg(DISTINCT p.name, ',' ORDER BY p.name), '') AS investors, {_sum('c.commitment_mm')} AS total_commitment_mm, {_avg('c.net_irr')} AS avg_net_irr, {_avg('c.net_multiple')} AS avg_net_multiple
FROM {_J} GROUP BY c.fund_id"""
_HELD2 = "(SELECT fund_id FROM commitments GROUP BY fund_id HAVING count(DISTINCT pension_fund_id) >= 2)"
_LATEST = """
SELECT id AS commitment_id, pension_fund_id, fund_id, as_of_date, coalesce(status, '') AS status, commitment_mm FROM commitments WHERE as_of_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY pension_fund_id, fund_id ORDER BY as_of_date DESC, extraction_confidence DESC NULLS LAST, id) = 1"""
_SPREAD = """
SELECT f.fund_name, count(DISTINCT c.pension_fund_id) AS investors, min(c.net_multiple) AS least, max(c.net_multiple) AS most, max(c.net_multiple) - min(c.net_multiple) AS spread
FROM commitments c JOIN funds f ON c.fund_id = f.id JOIN pension_funds p ON c.pension_fund_id = p.id WHERE c.net_multiple IS NOT NULL GROUP BY f.fund_name HAVING count(DISTINCT c.pension_fund_id) > 1"""
_FAMILY = "f.fund_name"
_FAMILY = f"trim(regexp_replace({_FAMILY}, ',?\\s*(L\\.?P\\.?\\d?|LLC|Ltd|SCSp|S\\.C\\.Sp\\.?|Cooperatief U\\.A\\.?)$', '', 'i'))"
for _p in (r"\s+(Fund\s+)?[IVXLC]+(-[A-Z0-9]+)?(\s+\(.*\))?\s*$", r"\s+Fund\s*$", r"\s+\d{4}\s*$", r"\s+[A-D]\s*$"):
    _FAMILY = f"trim(regexp_replace({_FAMILY}, '{_p}', ''))"
_FIELDS = Q.SCORED_FIELDS
_FILLED = " + ".join(f"({x} IS NOT NULL)::INT" for x in _FIELDS)

ORACLE = {
    "stratified_sample": "SELECT id, pension_fund_id FROM (SELECT id, pension_fund_id, md5(id || '0') AS h, row_number() OVER (PARTITION BY pension_fund_id ORDER BY md5(id || '0'), id) AS rn, (SELECT count(DISTINCT pension_fund_id) FROM commitments) AS k FROM commitments) WHERE rn <= greatest(1, 480 // k) ORDER BY h, id LIMIT 480",
    "fund_summary": _SUMMARY,
    "top_funds": f"SELECT * FROM ({_SUMMARY}) WHERE total_commitment_mm > 0 ORDER BY total_commitment_mm DESC, fund_id LIMIT 100",
    "cross_link_tiers": "SELECT count(*) AS funds, count(*) FILTER (n >= 2) AS held_by_2, count(*) FILTER (n >= 3) AS held_by_3, count(*) FILTER (n >= 4) AS held_by_4, count(*) FILTER (n >= 5) AS held_by_5 FROM (SELECT count(DISTINCT pension_fund_id) AS n FROM commitments GROUP BY fund_id)",
    "investor_pivot": f"""
WITH s AS (SELECT c.fund_id, min(f.fund_name) AS fund_name, count(DISTINCT c.pension_fund_id) AS investor_count, {_avg('c.net_irr')} AS avg_irr, {_avg('c.net_multiple')} AS avg_multiple FROM {_J} GROUP BY c.fund_id HAVING count(DISTINCT c.pension_fund_id) >= 2),
m AS (PIVOT (SELECT c.fund_id, c.pension_fund_id || '_mm' AS investor, c.commitment_mm FROM commitments c JOIN pension_funds p ON c.pension_fund_id = p.id) ON investor USING max(commitment_mm) GROUP BY fund_id)
SELECT * FROM s JOIN m USING (fund_id)""",
    "performance_by_vintage": f"SELECT vintage_year, count(*) AS n, {_avg('commitment_mm')} AS avg_commitment_mm, {_sum('commitment_mm')} AS total_commitment_mm, {_avg('net_irr')} AS avg_irr, {_avg('net_multiple')} AS avg_multiple, min(net_irr) AS min_irr, max(net_irr) AS max_irr, min(net_multiple) AS min_multiple, max(net_multiple) AS max_multiple FROM commitments WHERE vintage_year IS NOT NULL GROUP BY vintage_year",
    "vintage_having": f"SELECT vintage_year, count(*) AS n, {_avg('net_irr')} AS avg_irr, {_avg('net_multiple')} AS avg_multiple FROM commitments WHERE vintage_year >= 1995 GROUP BY vintage_year HAVING count(*) >= 5",
    "gp_leaderboard": f"SELECT f.general_partner_normalized AS gp, min(f.general_partner) AS general_partner, count(DISTINCT f.id) AS fund_count, count(DISTINCT c.pension_fund_id) AS investor_count, {_sum('c.commitment_mm')} AS total_commitment_mm, {_avg('c.net_irr')} AS avg_irr, {_avg('c.net_multiple')} AS avg_multiple, min(f.vintage_year) AS earliest_vintage, max(f.vintage_year) AS latest_vintage FROM {_J} WHERE f.general_partner IS NOT NULL AND f.general_partner <> '' GROUP BY f.general_partner_normalized ORDER BY total_commitment_mm DESC NULLS LAST, gp NULLS FIRST LIMIT 50",
    "commitment_trends": f"SELECT c.vintage_year, coalesce(f.sub_strategy, 'Unclassified') AS strategy, count(*) AS n, {_avg('c.commitment_mm')} AS avg_commitment_mm, {_sum('c.commitment_mm')} AS total_commitment_mm, count(DISTINCT c.pension_fund_id) AS investor_count FROM {_J} WHERE c.vintage_year >= 2000 AND c.commitment_mm < 5000 GROUP BY 1, 2",
    "gp_penetration": f"SELECT CASE WHEN {_FAMILY} = '' THEN f.fund_name ELSE {_FAMILY} END AS gp, count(DISTINCT c.pension_fund_id) AS investor_count, count(DISTINCT c.fund_id) AS fund_count, {_sum('c.commitment_mm')} AS total_commitment_mm, {_avg('c.net_irr')} AS avg_irr, {_avg('c.net_multiple')} AS avg_multiple, min(f.vintage_year) FILTER (f.vintage_year <> 0) AS earliest_vintage, max(f.vintage_year) FILTER (f.vintage_year <> 0) AS latest_vintage, coalesce(string_agg(DISTINCT p.name, ', ' ORDER BY p.name), '') AS investors FROM {_J} WHERE c.commitment_mm IS NOT NULL GROUP BY 1 HAVING count(DISTINCT c.pension_fund_id) >= 3",
    "investor_overview": f"SELECT c.pension_fund_id, min(p.name) AS investor, count(*) AS n, {_sum('c.commitment_mm')} AS total_commitment_mm, min(f.vintage_year) AS earliest_vintage, max(f.vintage_year) AS latest_vintage, max(c.as_of_date) AS as_of_date FROM {_J} GROUP BY c.pension_fund_id",
    "capital_flows": f"SELECT c.pension_fund_id, {_sum('c.capital_called_mm')} AS called_mm, {_sum('c.capital_distributed_mm')} AS distributed_mm, {_sum('c.remaining_value_mm')} AS remaining_mm FROM {_J} GROUP BY c.pension_fund_id",
    "strategy_having": f"SELECT f.sub_strategy AS strategy, count(*) AS n, {_avg('c.net_irr')} AS avg_irr, {_avg('c.net_multiple')} AS avg_multiple, {_sum('c.commitment_mm')} AS total_commitment_mm FROM {_J} WHERE f.sub_strategy IS NOT NULL GROUP BY 1 HAVING count(*) >= 10",
    "strategy_histogram": "SELECT coalesce(sub_strategy, 'Unclassified') AS strategy, count(*) AS n FROM funds GROUP BY 1",
    "widely_held": f"SELECT * FROM ({_SUMMARY}) WHERE investor_count >= 4",
    "headline": f"SELECT {_sum('c.commitment_mm')} / 1000 AS total_bn, count(DISTINCT c.fund_id) AS funds, count(DISTINCT c.pension_fund_id) AS investors, count(DISTINCT f.general_partner) AS managers, (SELECT count(*) FROM {_HELD2}) AS shared_funds FROM {_J}",
    "global_stats": f"SELECT count(*) AS n, count(DISTINCT c.fund_id) AS funds, count(DISTINCT f.general_partner_normalized) AS managers, min(f.vintage_year) AS min_vintage, max(f.vintage_year) AS max_vintage, string_agg(DISTINCT f.sub_strategy, ', ' ORDER BY f.sub_strategy) AS strategies FROM {_J}",
    "irr_quartiles": f"SELECT c.pension_fund_id, count(*) AS n, round(quantile_cont(c.net_irr, 0.25), 9) AS q1, round(quantile_cont(c.net_irr, 0.5), 9) AS median, round(quantile_cont(c.net_irr, 0.75), 9) AS q3 FROM {_J} WHERE c.net_irr BETWEEN -0.5 AND 1.0 GROUP BY 1",
    "performance_band": f"SELECT c.id AS commitment_id, f.fund_name, f.vintage_year, f.sub_strategy, p.name AS investor, c.commitment_mm, c.net_irr, c.net_multiple FROM {_J} WHERE f.vintage_year BETWEEN 2015 AND 2020 AND f.asset_class = 'Private Equity' AND c.net_irr IS NOT NULL",
    "name_pattern_filter": f"SELECT c.id AS commitment_id, f.fund_name, f.vintage_year, p.name AS investor, p.state, c.commitment_mm FROM {_J} WHERE f.vintage_year >= 2020 AND (f.fund_name ILIKE '% I' OR f.fund_name ILIKE '% I %' OR f.fund_name ILIKE '% II' OR f.fund_name ILIKE '% II %' OR f.fund_name ILIKE '%Fund 1 %' OR f.fund_name ILIKE '%Fund 2 %' OR f.fund_name ILIKE '%Fund 1' OR f.fund_name ILIKE '%Fund 2') AND NOT (f.fund_name ILIKE '% III%' OR f.fund_name ILIKE '% IV%' OR f.fund_name ILIKE '% V %' OR f.fund_name ILIKE '% VI%')",
    "optional_filters": "SELECT id, fund_id, commitment_mm FROM commitments WHERE pension_fund_id = 'traxyaensa_trs'",
    "text_search": "SELECT id, fund_name FROM funds WHERE coalesce(contains(lower(fund_name), 'asia'), false) OR coalesce(contains(lower(general_partner), 'asia'), false)",
    "linked_comparison": f"SELECT c.id AS commitment_id, f.fund_name, p.name AS investor, c.commitment_mm, c.net_irr, c.net_multiple, c.as_of_date FROM {_J} WHERE c.fund_id IN {_HELD2}",
    "unlinked_rows": f"SELECT id AS commitment_id, fund_id, pension_fund_id, commitment_mm FROM commitments WHERE fund_id NOT IN {_HELD2} AND commitment_mm IS NOT NULL",
    "left_join_lookup": "SELECT f.id, coalesce(g.n, 0) AS gp_cross_count, coalesce(a.alias, '') AS alias FROM funds f LEFT JOIN (SELECT general_partner_normalized AS gp, count(DISTINCT pension_fund_id) AS n FROM funds JOIN commitments ON funds.id = fund_id WHERE general_partner_normalized IS NOT NULL GROUP BY 1) g ON f.general_partner_normalized = g.gp LEFT JOIN (SELECT fund_id, min(alias) AS alias FROM fund_aliases GROUP BY 1) a ON a.fund_id = f.id",
    "alias_listing": f"SELECT a.id AS alias_id, a.alias, f.fund_name, c.commitment_mm FROM fund_aliases a JOIN funds f ON a.fund_id = f.id LEFT JOIN ({_LATEST}) c ON c.fund_id = a.fund_id AND c.pension_fund_id = a.source_pension_fund_id",
    "latest_snapshot": _LATEST,
    "last_non_null": "SELECT fund_id, arg_max(net_irr, (as_of_date, id)) FILTER (net_irr IS NOT NULL) AS net_irr, arg_max(net_multiple, (as_of_date, id)) FILTER (net_multiple IS NOT NULL) AS net_multiple, arg_max(dpi, (as_of_date, id)) FILTER (dpi IS NOT NULL) AS dpi FROM (SELECT * REPLACE (coalesce(as_of_date, DATE '0001-01-01') AS as_of_date) FROM commitments) WHERE fund_id IS NOT NULL GROUP BY 1",
    "top2_per_group": f"SELECT pension_fund_id, fund_id, gp, vintage_year, rn FROM (SELECT *, row_number() OVER (PARTITION BY pension_fund_id, gp ORDER BY vintage_year DESC, fund_id) AS rn FROM (SELECT DISTINCT c.pension_fund_id, c.fund_id, f.general_partner_normalized AS gp, f.vintage_year FROM {_J} WHERE f.general_partner_normalized IS NOT NULL AND f.vintage_year IS NOT NULL)) WHERE rn <= 2",
    "distinct_label": "SELECT fund_id, count(DISTINCT pension_fund_id) AS n, CASE WHEN count(DISTINCT pension_fund_id) > 1 THEN coalesce(string_agg(DISTINCT p.name, ', ' ORDER BY p.name), '') END AS label FROM commitments c JOIN pension_funds p ON c.pension_fund_id = p.id GROUP BY 1",
    "quota_sample": f"""
WITH r AS (SELECT *, fund_id IN {_HELD2} AS linked, (net_irr IS NOT NULL)::INT + (net_multiple IS NOT NULL)::INT AS s2, (capital_called_mm IS NOT NULL)::INT + (capital_distributed_mm IS NOT NULL)::INT AS s4 FROM commitments WHERE commitment_mm IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY pension_fund_id, linked ORDER BY CASE WHEN linked THEN s2 + s4 ELSE s2 END DESC, commitment_mm DESC, id) AS rn FROM r),
n AS (SELECT pension_fund_id, least(count(*) FILTER (linked), 12) AS nl, count(*) FILTER (NOT linked) AS no FROM k GROUP BY 1)
SELECT pension_fund_id, id AS commitment_id, linked, rn AS rank_in_stratum FROM k JOIN n USING (pension_fund_id)
WHERE CASE WHEN linked THEN rn <= nl + (20 - nl - least(no, 20 - nl)) ELSE rn <= least(no, 20 - nl) END""",
    "capped_selection": f"""
WITH s AS (SELECT c.id AS commitment_id, c.commitment_mm, k FROM {_J} JOIN (SELECT fund_id, count(DISTINCT pension_fund_id) AS k FROM commitments GROUP BY 1) USING (fund_id) WHERE c.commitment_mm IS NOT NULL),
a AS (SELECT commitment_id, row_number() OVER (ORDER BY k DESC, commitment_mm DESC, commitment_id) AS rn FROM s WHERE k >= 2 QUALIFY rn <= 110),
b AS (SELECT commitment_id, row_number() OVER (ORDER BY commitment_mm DESC, commitment_id) AS rn FROM s WHERE commitment_id NOT IN (SELECT commitment_id FROM a))
SELECT commitment_id, 1::INT AS pass FROM a UNION ALL SELECT commitment_id, 2::INT FROM b WHERE rn <= 125 - (SELECT count(*) FROM a)""",
    "reup_flag": f"WITH r AS (SELECT DISTINCT c.pension_fund_id, c.fund_id, f.general_partner_normalized AS gp, f.vintage_year FROM {_J} WHERE f.general_partner_normalized IS NOT NULL AND f.vintage_year IS NOT NULL) SELECT *, CASE WHEN min(vintage_year) OVER (PARTITION BY pension_fund_id, gp) < vintage_year THEN 'Re-Up' ELSE 'New Relationship' END AS commitment_type FROM r",
    "spread_report": f"SELECT fund_name, investors, least, most FROM ({_SPREAD}) WHERE spread > 0 ORDER BY spread DESC, fund_name LIMIT 20",
    "multiple_divergence": f"SELECT fund_name, investors, least, most FROM ({_SPREAD}) WHERE spread > 0.5",
    "vintage_inconsistency": "SELECT fund_id, count(DISTINCT vintage_year) AS n_vintages, array_to_string(list_sort(list(DISTINCT vintage_year)), ',') AS vintages FROM commitments WHERE vintage_year IS NOT NULL GROUP BY 1 HAVING count(DISTINCT vintage_year) > 1",
    "range_flags": f"""
SELECT id AS commitment_id, 'Commitment' AS what FROM commitments WHERE commitment_mm < 0.1 OR commitment_mm > 5000 UNION ALL SELECT id, 'Net IRR' FROM commitments WHERE net_irr < -0.5 OR net_irr > 1.5
UNION ALL SELECT id, 'Negative net multiple' FROM commitments WHERE net_multiple < 0 UNION ALL SELECT id, 'Net multiple' FROM commitments WHERE net_multiple > 15
UNION ALL SELECT id, 'Vintage year' FROM commitments WHERE vintage_year < 1980 OR vintage_year > {VINTAGE_TO}""",
    "low_completeness": f"SELECT id AS commitment_id, ({_FILLED})::VARCHAR || ' of 6 fields' AS flag_detail FROM commitments WHERE ({_FILLED}) / 6.0 < 0.33",
    "ingest_flags": "SELECT id AS commitment_id, 'low_confidence' AS flag_type FROM commitments WHERE extraction_confidence < 0.85",
    "completeness": " UNION ALL ".join(f"SELECT '{x}' AS field, count(*) AS n_rows, count({x}) AS n_present, count({x}) * CAST(100.0 AS DOUBLE) / count(*) AS percent FROM commitments" for x in Q.PROFILE_FIELDS),
    "coverage_gap": "SELECT id AS pension_fund_id, name AS investor FROM pension_funds p WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.pension_fund_id = p.id)",
    "orphan_commitments": "SELECT id, fund_id FROM commitments c WHERE fund_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM funds f WHERE f.id = c.fund_id)",
    "status_counts": "SELECT pension_fund_id, lower(coalesce(status, 'unknown')) AS status, count(*) AS n FROM commitments GROUP BY 1, 2",
    "distinct_documents": "SELECT DISTINCT pension_fund_id, source_document FROM commitments",
    "method_matrix": "SELECT pension_fund_id, " + ", ".join(f"arg_max(source_document, (coalesce(as_of_date, DATE '0001-01-01'), id)) FILTER (extraction_method = '{m}') AS {m}" for m in ("pdf_words", "pdf_regex", "html_table", "board_book_text")) + " FROM commitments WHERE source_document IS NOT NULL GROUP BY 1",
}
