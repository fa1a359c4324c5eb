"""Queries over minutes of meetings that are written from the commitments, so that what they hold is known.

Every commitment becomes the minutes of one meeting: heading, roster and one paragraph of every kind that the rules of
`textevents` look for. The SQL of a query states from the table what must be found; it never looks at a text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from allocata.operators import textevents as T
from allocata.session import table

VOTES = ("The motion carried unanimously.", "The motion carried with Cyd {x} opposed.", "The motion carried.", "The motion failed.")
HEAD = "{board}\nBoard Meeting Minutes\nMarch 5, {year}\nMembers Present:\nANN {x}, Vice Chair\nBOB {x}\n\nStaff Present:\nCYD {x}, Portfolio Manager\nDIA {x}, Attorney General's Office\nConsultants Present: Callan, Edd {x}\nLegal Counsel: none."
BODY = (
    "\nCALL TO ORDER\nAnn {x} moved that the Board invest up to ${n} {unit}, plus fees and expenses, in Alder {x} Fund IV, L.P.\nBob {x} seconded the motion.\n{vote}\nAssets under management increased to ${n} billion.\n"
    "It returned 7.5 percent for the year, net.\nDia {x} was elected Vice Chair.\nBoard appoint Edd {x} to the Audit Committee.\nFlo {x} be removed from the Risk Committee.\nGus {x}, Outgoing Chair.\n"
    "Board select Birch {x} as a global equity manager.\nBoard approve the investment policy statement as proposed.\nNovember 18th Willow {x} Fund II, L.P. $25M USD\n"
    "Many public commenters urged the board to sell the whole portfolio of bonds. Then they left.\nTreasurer Hal {x} expressed concern about risk and loss."
)
TAIL = "\nADJOURN\nThe meeting ended."
BOARDS = ("Oregon Investment Council", "Washington State Investment Board", "Board of the Plan")


def _minutes(spark, sf_dir):
    """(doc_id, text): one per commitment; x is its id in capitals, n its page plus one."""
    # Texts are made and read by many tasks, though the ids they are made of are small.
    c = table(spark, sf_dir, "commitments", "id", "source_page").repartition(spark.sparkContext.defaultParallelism)
    page = F.coalesce("source_page", F.lit(0))
    vote = F.element_at(F.array(*map(F.lit, VOTES)), (page % 4 + 1).cast("int"))
    board = F.element_at(F.array(*map(F.lit, BOARDS)), (page % 3 + 1).cast("int"))
    values = {"board": board, "year": (page % 25 + 2000).cast("string"), "vote": vote, "n": (page + 1).cast("string"), "unit": F.when(page % 5 == 0, "billion").otherwise("million"), "x": F.upper("id")}
    text = F.lit(HEAD + BODY + TAIL)
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return c.select(F.col("id").alias("doc_id"), text.alias("text"))


def minutes_events(spark, sf_dir):
    d = F.col("details")
    at = lambda k: F.try_element_at(d, F.lit(k))
    return T.events(_minutes(spark, sf_dir), columns=("section", "event_type", "summary", "details")).select(
        "doc_id", "section", "event_type", "summary", F.coalesce(at("person"), at("mover"), at("manager_name"), at("fund_name"), F.lit("")).alias("who"),
        F.coalesce(at("amount_mm"), at("aum_mm"), at("return_pct")).cast("double").alias("amount"), F.coalesce(at("outcome"), at("sentiment"), at("action"), F.lit("")).alias("how"), F.coalesce(at("seconder"), F.lit("")).alias("seconder"), F.coalesce(at("dissenter"), F.lit("")).alias("dissenter"),
    )


def minutes_totals(spark, sf_dir):
    return T.meeting_totals(T.events(_minutes(spark, sf_dir), columns=("event_type", "details"), fields=("amount_mm",)))


def minutes_sections(spark, sf_dir):
    s = T.section_spans(_minutes(spark, sf_dir))
    return s.select("doc_id", "title", (F.col("end") - F.col("start")).cast("bigint").alias("length"))


def minutes_attendance(spark, sf_dir):
    return T.attendance(_minutes(spark, sf_dir)).select("doc_id", "role", F.col("n").cast("bigint").alias("n"), "name", "title", "organisation")


def minutes_heads(spark, sf_dir):
    return _minutes(spark, sf_dir).select("doc_id", T.system_of(F.col("text")).alias("system"), T.meeting_date(F.col("text")).alias("meeting_date"))


QUERIES = {f.__name__: f for f in (minutes_events, minutes_totals, minutes_sections, minutes_attendance, minutes_heads)}

_C = "c AS (SELECT id AS doc_id, upper(id) AS x, coalesce(source_page, 0) AS page, coalesce(source_page, 0) + 1 AS n, CASE WHEN coalesce(source_page, 0) % 5 = 0 THEN (coalesce(source_page, 0) + 1) * 1000 ELSE coalesce(source_page, 0) + 1 END AS mm, CASE WHEN coalesce(source_page, 0) % 5 = 0 THEN 'billion' ELSE 'million' END AS unit FROM commitments)"
_ORDER = "'CALL TO ORDER' AS section"
_NONE = "'' AS seconder, '' AS dissenter"
_EVENTS = f"""
SELECT doc_id, {_ORDER}, 'investment_commitment' AS event_type, 'Approved investment of up to $' || mm || 'M in Alder ' || x || ' Fund IV, L.P' AS summary, 'Alder ' || x || ' Fund IV, L.P' AS who, mm::DOUBLE AS amount, '' AS how, {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'manager_selection', 'Selected Birch ' || x || ' as global equity manager', 'Birch ' || x, NULL, '', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'motion', 'Motion by Ann ' || x || ': ' || left('invest up to $' || n || ' ' || unit || ', plus fees and expenses, in Alder ' || x || ' Fund IV, L.', 100), 'Ann ' || x, NULL,
  CASE page % 4 WHEN 0 THEN 'carried_unanimously' WHEN 1 THEN 'carried_with_dissent' WHEN 2 THEN 'carried' ELSE 'unknown' END, 'Bob ' || x, CASE WHEN page % 4 = 1 THEN 'Cyd ' || x ELSE '' END FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'personnel_change', 'Dia ' || x || ' elected/appointed as Vice Chair', 'Dia ' || x, NULL, 'elected', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'committee_assignment', 'Edd ' || x || ' appointed to Audit Committee', 'Edd ' || x, NULL, 'appointed', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'committee_assignment', 'Flo ' || x || ' removed from Risk Committee', 'Flo ' || x, NULL, 'removed', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'personnel_change', 'Gus ' || x || ' — outgoing Chair', 'Gus ' || x, NULL, 'outgoing', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'performance_report', 'Return of 7.5% for year', '', 7.5, '', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'performance_report', 'AUM: $' || CASE WHEN n * 1000 >= 1000000 THEN (n // 1000) || ',' || lpad((n % 1000)::VARCHAR, 3, '0') || ',000' ELSE n || ',000' END || 'M', '', n * 1000.0, '', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'policy_approval', 'Approved: investment policy statement', '', NULL, '', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'dissent', 'Dissenting statement by Treasurer Hal ' || x, 'Treasurer Hal ' || x, NULL, 'negative', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'public_comment', 'Public comment: public commenters urged the board to sell the whole portfolio of bonds. T...', '', NULL, '', {_NONE} FROM c
UNION ALL SELECT doc_id, {_ORDER}, 'investment_commitment', 'Commitment: $25M to Willow ' || x || ' Fund II, L.P.', 'Willow ' || x || ' Fund II, L.P.', 25.0, '', {_NONE} FROM c WHERE page % 3 = 0"""
_FIXED = len(BODY) - len("{x}") * BODY.count("{x}") - len("{n}") * BODY.count("{n}") - len("{unit}") - len("{vote}")
ORACLE = {
    "minutes_events": f"WITH {_C} SELECT * FROM ({_EVENTS})",
    "minutes_totals": f"WITH {_C} SELECT doc_id, count(*) AS n_events, count(*) FILTER (event_type = 'investment_commitment') AS n_commitments, coalesce(sum(amount) FILTER (event_type = 'investment_commitment'), 0)::DOUBLE AS committed_mm FROM ({_EVENTS}) GROUP BY 1",
    "minutes_sections": f"WITH {_C} SELECT doc_id, 'CALL TO ORDER' AS title, {_FIXED} + {BODY.count('{x}')} * length(x) + {BODY.count('{n}')} * length(n::VARCHAR) + length(unit) + length(CASE page % 4 WHEN 0 THEN 'The motion carried unanimously.' WHEN 1 THEN 'The motion carried with Cyd ' || x || ' opposed.' WHEN 2 THEN 'The motion carried.' ELSE 'The motion failed.' END) AS length FROM c UNION ALL SELECT doc_id, 'ADJOURN', {len(TAIL)} FROM c",
    "minutes_attendance": f"""WITH {_C} SELECT doc_id, 'member' AS role, 0 AS n, 'ANN ' || x AS name, 'Vice Chair' AS title, '' AS organisation FROM c UNION ALL SELECT doc_id, 'member', 1, 'BOB ' || x, '', '' FROM c
UNION ALL SELECT doc_id, 'staff', 0, 'CYD ' || x, 'Portfolio Manager', '' FROM c UNION ALL SELECT doc_id, 'staff', 1, 'DIA ' || x, '', 'Attorney General''s Office' FROM c UNION ALL SELECT doc_id, 'consultant', 0, 'Callan', '', '' FROM c UNION ALL SELECT doc_id, 'consultant', 1, 'Edd ' || x, '', '' FROM c""",
    "minutes_heads": "SELECT id AS doc_id, CASE coalesce(source_page, 0) % 3 WHEN 0 THEN 'Oregon' WHEN 1 THEN 'WSIB' ELSE 'Unknown' END AS system, 'March 5, ' || (2000 + coalesce(source_page, 0) % 25) AS meeting_date FROM commitments",
}
