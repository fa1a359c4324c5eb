"""Queries over document texts, event properties and positioned words."""

from __future__ import annotations

from pyspark.sql import functions as F

from allocata.functions import parsers as P
from allocata.operators import textevents as T
from allocata.session import table
from allocata.sources import layout
from allocata.streaming import landing


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text")


def board_events(spark, sf_dir):
    return T.events(_documents(spark, sf_dir))


def section_spans(spark, sf_dir):
    return T.section_spans(_documents(spark, sf_dir))


def meeting_dates(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.meeting_date(F.col("text")).alias("meeting_date")).where("meeting_date <> ''")


COMMITMENT = r"commitment of (\$[\d.,]* ?(?:million|billion|thousand)) to"


def event_patterns(spark, sf_dir):
    """Every commitment of a stated amount that a document mentions, in millions."""
    hits = F.posexplode(F.regexp_extract_all("text", F.lit(COMMITMENT), F.lit(1))).alias("n", "said")
    said = F.col("said")
    amount = F.replace(F.regexp_extract(said, r"([\d.,]+)", 1), F.lit(","), F.lit("")).try_cast("double")
    return _documents(spark, sf_dir).select("doc_id", hits).select("doc_id", F.col("n").cast("bigint").alias("n"), P.scaled(amount, F.regexp_extract(said, "([a-z]+)$", 1)).alias("amount_mm"))


def motion_outcomes(spark, sf_dir):
    """Documents by what they say about motions."""
    t = F.col("text")
    outcome = F.when(t.rlike("(?i)motion carried unanimously"), "carried_unanimously").when(t.rlike("(?i)motion carried"), "carried").when(t.rlike("(?i)motion failed"), "failed").otherwise("none")
    return _documents(spark, sf_dir).where("text IS NOT NULL").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def sentiment(spark, sf_dir):
    minus, plus = T.tone_counts(F.col("text"))
    tone = F.when(F.col("minus") > F.col("plus"), "negative").when(F.col("plus") > F.col("minus"), "positive").otherwise("neutral")
    return _documents(spark, sf_dir).where("text IS NOT NULL").select("doc_id", minus.cast("bigint").alias("minus"), plus.cast("bigint").alias("plus")).select("*", tone.alias("tone"))


def numbered_lines(spark, sf_dir):
    """Lines of documents with where each ends: the next start, or the end of the text."""
    lines = _documents(spark, sf_dir).where("text <> ''").select("doc_id", F.length("text").alias("total"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("i")
    start = F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = lines.withColumn("start", F.coalesce(start, F.lit(0)))
    return spans.select("doc_id", F.col("i").cast("bigint").alias("i"), "start", F.coalesce(F.lead("start").over(w), F.col("total").cast("bigint")).alias("end"))


def layout_rows(spark, sf_dir):
    """Words of documents laid out on a page of fixed-width characters, put back into table rows."""
    words = _documents(spark, sf_dir).where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.filter(F.split("text", r"[ \n\t]+"), lambda x: x != "")).alias("idx", "text"))
    placed = words.select("doc_id", F.lit(1).alias("page"), F.lit(612.0).alias("page_width"), "idx", "text", (F.col("idx") % 8 * 80.0).alias("x0"), (F.floor(F.col("idx") / 8) * 12.0).alias("top"))
    return layout.fixed_layout(placed, "seven_columns")


def json_props(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events", "event_type", "props").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"), F.max(k).alias("most"))


def stream_windows(spark, sf_dir):
    """The streaming aggregate over the whole table as a batch."""
    return landing.windowed_counts(table(spark, sf_dir, "events", "ts", "event_type", "value"))


def document_systems(spark, sf_dir):
    return _documents(spark, sf_dir).where("text IS NOT NULL").groupBy(T.system_of(F.col("text")).alias("system")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (board_events, section_spans, meeting_dates, event_patterns, motion_outcomes, sentiment, numbered_lines, layout_rows, json_props, stream_windows, document_systems)}


def _tone(words: list[str]) -> str:
    return " + ".join(f"contains(lower(text), '{w}')::INT" for w in words)


# Headers are lines, so the second engine looks at lines with their places.
_LINES = "regexp_replace(regexp_replace(regexp_replace(text, '(\\w)\\n([a-z])', '\\1 \\2', 'g'), '([A-Z][a-z]+)\\n([A-Z][a-z]+)', '\\1 \\2', 'g'), '  +', ' ', 'g')"
_PATTERNS = [p.pattern.replace("'", "''") for p in T.HEADERS]
_SECTIONS = f"""
WITH j AS (SELECT doc_id, {_LINES} AS t FROM documents WHERE text <> ''), l AS (SELECT doc_id, length(t) AS total, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM j),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM l),
h AS ({" UNION ALL ".join(f"SELECT doc_id, total, place, trim(regexp_extract(line, '{p}', 1)) AS title FROM o WHERE regexp_matches(line, '{p}')" for p in _PATTERNS)}),
k AS (SELECT * FROM h WHERE length(title) >= 8 AND title <> 'APPROVED' UNION ALL SELECT doc_id, total, place - 1, trim(line) FROM o WHERE i > 0 AND regexp_matches(line, '(?i)^(?:{"|".join(T.TITLES)})')),
f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, left(upper(title), 40) ORDER BY place, title) = 1)
SELECT doc_id, title, place::INT AS "start", lead(place, 1, total) OVER (PARTITION BY doc_id ORDER BY place, title)::INT AS "end" FROM f"""

ORACLE = {
    "section_spans": _SECTIONS,
    "meeting_dates": "SELECT doc_id, d AS meeting_date FROM (SELECT doc_id, CASE WHEN regexp_extract(substring(text, 1, 2000), '(?i)(?:Board\\s+Meeting\\s+Minutes|Meeting\\s+Minutes|Board\\s+Meeting)\\s*\\n\\s*(\\w+\\s+\\d{1,2},?\\s+\\d{4})', 1) <> '' THEN regexp_extract(substring(text, 1, 2000), '(?i)(?:Board\\s+Meeting\\s+Minutes|Meeting\\s+Minutes|Board\\s+Meeting)\\s*\\n\\s*(\\w+\\s+\\d{1,2},?\\s+\\d{4})', 1) ELSE regexp_extract(substring(text, 1, 2000), '((?:" + T.MONTHS + ")\\s+\\d{1,2},?\\s+\\d{4})', 1) END AS d FROM documents) WHERE d <> ''",
    "event_patterns": f"SELECT doc_id, CAST(i - 1 AS BIGINT) AS n, TRY_CAST(replace(regexp_extract(a[i], '([\\d.,]+)', 1), ',', '') AS DOUBLE) * CASE WHEN a[i] LIKE '%billion' THEN 1000.0 WHEN a[i] LIKE '%thousand' THEN 0.001 ELSE 1.0 END::DOUBLE AS amount_mm FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{COMMITMENT}', 1) AS a FROM documents))",
    "document_systems": "SELECT CASE " + " ".join(f"WHEN regexp_matches(left(text, 3000), '{p}') THEN '{n}'" for n, p in T.SYSTEMS.items()) + " ELSE 'Unknown' END AS system, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "layout_rows": """WITH w AS (SELECT doc_id::VARCHAR AS doc_id, unnest(ws) AS t, unnest(range(len(ws))) AS i FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n\\t]+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL)),
c AS (SELECT doc_id, i // 8 * 12.0 AS "row", i, t, [0, 0, 0, 1, 2, 3, 4, 6][i % 8 + 1] AS k FROM w)
SELECT doc_id, 1 AS page, "row"::DOUBLE AS "row", """ + ", ".join(f"coalesce(string_agg(t, ' ' ORDER BY i) FILTER (k = {j}), '') AS c{j}" for j in range(7)) + """ FROM c GROUP BY doc_id, 3""",
    "motion_outcomes": "SELECT CASE WHEN regexp_matches(text, '(?i)motion carried unanimously') THEN 'carried_unanimously' WHEN regexp_matches(text, '(?i)motion carried') THEN 'carried' WHEN regexp_matches(text, '(?i)motion failed') THEN 'failed' ELSE 'none' END AS outcome, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "sentiment": f"SELECT doc_id, minus, plus, CASE WHEN minus > plus THEN 'negative' WHEN plus > minus THEN 'positive' ELSE 'neutral' END AS tone FROM (SELECT doc_id, CAST({_tone(T.NEGATIVE)} AS BIGINT) AS minus, CAST({_tone(T.POSITIVE)} AS BIGINT) AS plus FROM documents WHERE text IS NOT NULL)",
    "numbered_lines": "WITH l AS (SELECT doc_id, length(text) AS total, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text <> ''), s AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l) SELECT doc_id, i, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY i), total) AS \"end\" FROM s",
    "json_props": "SELECT event_type, count(*) AS n, sum(CAST(props->>'$.k' AS BIGINT))::BIGINT AS total, max(CAST(props->>'$.k' AS BIGINT)) AS most FROM events GROUP BY 1",
    "stream_windows": "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) AS total FROM events GROUP BY 1, 2",
}
