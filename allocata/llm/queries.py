"""Queries of the training-data operators p1, p2, p3, p8, p9, p10, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata.llm import encode, lookalikes, matching, packing, spellings, survivors
from allocata.session import table


def _name_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "funds", "id", "fund_name_raw", "general_partner"), table(spark, sf_dir, "gp_aliases", "alias")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    managers, records = spellings.link_names(*_name_inputs(spark, sf_dir))
    gp = spellings.pairs_within(managers.where("manager IS NOT NULL"), "name", "manager")
    fund = spellings.pairs_within(records.where("manager IS NOT NULL"), "id", "manager", "strategy", "number")
    return gp.select(F.lit("gp").alias("kind"), "key_a", "key_b").unionByName(fund.select(F.lit("fund").alias("kind"), "key_a", "key_b"))


def p1_managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per spelling with its manager's class and the number of spellings it is linked to."""
    managers, _ = spellings.link_names(*_name_inputs(spark, sf_dir))
    sizes = managers.where("manager IS NOT NULL").groupBy("manager").agg(F.count(F.lit(1)).alias("n"))
    return managers.join(sizes, "manager", "left").select("name", "manager", (F.coalesce("n", F.lit(1)) - 1).alias("n_links"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "commitments", "id", "pension_fund_id", "fund_id", "as_of_date", "extraction_confidence", "extracted_at", "extraction_method", *survivors.FIELDS)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.ranked_survivors(_records(spark, sf_dir)).where("n_records > 1").select("group_id", "survivor_id", "irr_id")


def p2_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.fused_fields(_records(spark, sf_dir))


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched(
        table(spark, sf_dir, "funds", "id", "fund_name", "general_partner", "vintage_year", "fund_size_mm"),
        table(spark, sf_dir, "custodian_holdings", "holding_id", "holder_name", "security_name", "vintage", "committed_usd"),
        table(spark, sf_dir, "commitments", "pension_fund_id", "fund_id", "commitment_mm", "net_irr", "net_multiple", "as_of_date"),
        table(spark, sf_dir, "pension_funds", "id", "name", "full_name"),
        table(spark, sf_dir, "disclosures_raw", "id", "pension_fund_id", "commitment_text", "net_irr_text", "unit_note"),
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_matches(spark, sf_dir).select("fund_id", "holding_id")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.token_ids(_documents(spark, sf_dir))


def p9_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(encode.token_counts(_documents(spark, sf_dir)))


def p9_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by reciprocal classes alone."""
    return packing.pack(encode.token_counts(_documents(spark, sf_dir)), method="harmonic")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.lookalike_pairs(_documents(spark, sf_dir))


def p10_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.canonical_texts(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p1_found, p1_managers, p2_found, p2_fused, p3_found, p3_matches, p8_ids, p9_bins, p9_harmonic, p10_found, p10_canonical)}

_QUARTER = "(year(as_of_date)::VARCHAR || 'Q' || quarter(as_of_date)::VARCHAR)"
_P2 = f"""
WITH r AS (
  SELECT pension_fund_id, fund_id, {_QUARTER} AS q, id, net_irr,
    row_number() OVER (PARTITION BY pension_fund_id, fund_id, {_QUARTER} ORDER BY as_of_date DESC, extraction_confidence DESC NULLS LAST, extracted_at DESC NULLS LAST, id) AS rn
  FROM commitments)
SELECT min(id) AS group_id, arg_min(id, rn) AS survivor_id, coalesce(arg_min(id, rn) FILTER (net_irr IS NOT NULL), '') AS irr_id
FROM r GROUP BY pension_fund_id, fund_id, q HAVING count(*) > 1
"""


def _p10_sql() -> str:
    """The same mapping, with canonical composition in place of the collation."""
    single = lookalikes.single_mapping()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    unseen = r"[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}\x{200e}\x{200f}\x{202a}\x{202c}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{feff}]"
    joiner = r"([^\x{1f000}-\x{1faff}])[\x{200c}\x{200d}]"
    plain = f"regexp_replace(regexp_replace(text, '{unseen}', '', 'g'), '{joiner}', '\\1', 'g')"
    form = f"translate({plain}, {quote(''.join(single))}, {quote(''.join(single.values()))})"
    for c, s in lookalikes.expansions().items():
        form = f"replace({form}, {quote(c)}, {quote(s)})"
    return f"""
WITH f AS (SELECT doc_id, text, nfc_normalize({form}) AS form FROM documents WHERE text IS NOT NULL)
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text
WHERE regexp_matches(a.form, '[^\\s\\p{{Z}}\\p{{C}}]')
"""


ORACLE: dict[str, str] = {"p2_found": _P2, "p10_found": _p10_sql()}
