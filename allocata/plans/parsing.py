"""Queries of the scalar parsers and of names, over the disclosed texts and the registered names."""

from __future__ import annotations

from pyspark.sql import functions as F

from allocata.functions import fund_names as N
from allocata.functions import parsers as P
from allocata.functions.managers import DEFAULT_STRATEGY, KNOWN_MANAGERS
from allocata.operators import resolve as E
from allocata.session import table


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "disclosures_raw")


def parse_amounts(spark, sf_dir):
    c = F.col("commitment_text")
    return _raw(spark, sf_dir).select("id", P.dollar_amount(c).alias("amount_mm"), P.dollar_amount(c, in_millions=True).alias("amount_in_millions"))


def parse_percent(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", P.percentage(F.col("net_irr_text")).alias("rate"))


def parse_multiple(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", P.multiple(F.col("net_multiple_text")).alias("multiple"))


def parse_vintage(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", P.vintage_year(F.col("vintage_text")).alias("vintage_year"))


def parse_dates(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", P.date(F.col("as_of_text")).alias("as_of_date"))


def stated_dates(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", P.as_of_date(F.col("text")).alias("as_of_date")).where("as_of_date IS NOT NULL")


def source_amounts(spark, sf_dir):
    c = F.col("commitment_text")
    return _raw(spark, sf_dir).select("id", P.amount_in_millions(c).alias("in_millions"), P.amount_by_size(c).alias("by_size"), P.percent_points(F.col("net_irr_text")).alias("points"))


def normalize_names(spark, sf_dir):
    return table(spark, sf_dir, "funds", "id", "fund_name_raw", "general_partner").select("id", N.normalized_name(F.col("fund_name_raw")).alias("fund"), N.normalized_name(F.col("general_partner")).alias("gp"), N.normalized_firm(F.col("general_partner")).alias("firm"))


def fund_numerals(spark, sf_dir):
    return table(spark, sf_dir, "funds", "id", "fund_name_raw").select("id", N.fund_number(F.col("fund_name_raw")).alias("number"))


def classify_strategy(spark, sf_dir):
    return table(spark, sf_dir, "funds", "id", "fund_name_raw").select("id", N.strategy_class(F.col("fund_name_raw"), DEFAULT_STRATEGY, KNOWN_MANAGERS).alias("s")).select("id", "s.*")


def extract_gp(spark, sf_dir):
    return table(spark, sf_dir, "funds", "id", "fund_name_raw").select("id", N.manager_from_name(F.col("fund_name_raw"), KNOWN_MANAGERS).alias("gp"))


def family_names(spark, sf_dir):
    return table(spark, sf_dir, "funds", "id", "fund_name").select("id", N.family_name(F.col("fund_name")).alias("family"))


def token_jaccard(spark, sf_dir):
    """Overlap of the distinctive words of a fund's raw name and its manager."""
    a, b = N.distinctive_tokens(F.col("fund_name_raw")), N.distinctive_tokens(F.col("general_partner"))
    return table(spark, sf_dir, "funds", "id", "fund_name_raw", "general_partner").where("general_partner IS NOT NULL").select("id", F.size(F.array_intersect(a, b)).cast("bigint").alias("common"), F.size(F.array_union(a, b)).cast("bigint").alias("union_size"))


def derived_metrics(spark, sf_dir):
    """What a source does not state: remaining value, multiple with each guard, distributions to paid-in."""
    c = table(spark, sf_dir, "commitments", "id", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "dpi", "net_multiple")
    called, out, left = F.col("capital_called_mm"), F.col("capital_distributed_mm"), F.col("remaining_value_mm")
    total = out + left
    return c.select(
        "id", total.alias("total_value_mm"), P.remaining_value(total, out).alias("remaining_mm"), P.derived_multiple(total, called).alias("multiple"), P.derived_multiple(total, called, missing_as_zero=True).alias("multiple_zero"),
        P.derived_multiple(total, called, positive_total=True).alias("multiple_positive"), P.derived_dpi(F.col("dpi"), out, called).alias("dpi"), P.positive_multiple(F.col("net_multiple")).alias("positive_multiple"),
    )


def formatted_values(spark, sf_dir):
    """Values as they are shown: dollars, rates, multiples and months."""
    c = table(spark, sf_dir, "commitments", "id", "commitment_mm", "net_irr", "net_multiple", "as_of_date")
    return c.select("id", P.format_month(F.col("as_of_date").cast("string")).alias("as_of"), P.format_multiple(F.col("net_multiple")).alias("multiple"), P.format_rate(F.col("net_irr")).alias("rate"), P.format_dollars(F.col("commitment_mm")).alias("dollars"), P.format_dollars(F.col("commitment_mm"), "B").alias("billions"))


def loose_numbers(spark, sf_dir):
    """Numbers of a sheet, two-digit years, years of dates and numbers that a page broke in two."""
    text = F.col("commitment_text")
    return _raw(spark, sf_dir).select(
        "id", P.loose_float(F.col("net_multiple_text")).alias("number"), P.two_digit_year(F.regexp_extract("vintage_text", r"(\d{2})\D*$", 1)).alias("vintage"), P.year_of_date(F.col("as_of_text")).alias("year"), P.rejoin_split_number(text).alias("rejoined"),
    )


def resolve_entities(spark, sf_dir):
    """Fund names of the raw disclosures resolved in order of arrival; aliases known from the registry come first."""
    raw = _raw(spark, sf_dir).select(F.struct("ingested_at", "id").alias("arrival"), "id", "fund_name_raw", "general_partner", P.vintage_year(F.col("vintage_text")).alias("vintage_year")).where("fund_name_raw IS NOT NULL")
    ordered = raw.withColumn("arrival", F.concat_ws("|", F.date_format("arrival.ingested_at", "yyyyMMddHHmmssSSSSSS"), "arrival.id"))
    aliases = table(spark, sf_dir, "fund_aliases", "alias", "fund_id").select("alias", F.col("fund_id").alias("fund_key"))
    return E.resolve(ordered, aliases).select("id", "fund_key", "match_type", "score")


def similarity_pairs(spark, sf_dir):
    """Candidate pairs of fund names with both ratios."""
    f = table(spark, sf_dir, "funds", "id", "fund_name_raw", "general_partner", "vintage_year").withColumnRenamed("id", "arrival")
    return E.candidate_pairs(E.first_names(f))


def firm_resolution(spark, sf_dir):
    """Managers as written, resolved against the canonical names by exact form, alias and ratio."""
    names = table(spark, sf_dir, "funds", "general_partner").select(F.col("general_partner").alias("firm_name")).where("firm_name IS NOT NULL").distinct()
    a = table(spark, sf_dir, "gp_aliases", "canonical_name", "alias")
    firms = a.select(F.sha2("canonical_name", 256).alias("id"), F.col("canonical_name").alias("name")).distinct()
    return E.firm_matches(names, firms, a.select(F.sha2("canonical_name", 256).alias("firm_id"), "alias"))


def link_audit(spark, sf_dir):
    """Aliases whose name looks unlike the fund they are linked to."""
    f = table(spark, sf_dir, "funds", "id", "fund_name").withColumnRenamed("id", "fund_id")
    return E.suspect_links(table(spark, sf_dir, "fund_aliases", "id", "fund_id", "alias").join(f, "fund_id"), "alias", "fund_name").select("id", "ratio", "numbers_differ")


def auto_resolved(spark, sf_dir):
    """Aliases that are safe to accept without a look."""
    f = table(spark, sf_dir, "funds", "id", "fund_name").withColumnRenamed("id", "fund_id")
    return E.auto_resolvable(table(spark, sf_dir, "fund_aliases", "id", "fund_id", "alias").join(f, "fund_id"), "alias", "fund_name").select("id", "ratio", "token_ratio")


QUERIES = {
    f.__name__: f
    for f in (
        parse_amounts, parse_percent, parse_multiple, parse_vintage, parse_dates, stated_dates, source_amounts, normalize_names, fund_numerals, classify_strategy, extract_gp, family_names, token_jaccard,
        derived_metrics, formatted_values, loose_numbers, resolve_entities, similarity_pairs, firm_resolution, link_audit, auto_resolved,
    )
}

_EMPTY = ", ".join(f"'{x}'" for x in P.NO_DATA)
_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _present(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ({_EMPTY}) THEN trim({c}) END"


def _number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{_NUM}') THEN TRY_CAST({x} AS DOUBLE) END"


def _amount(bare: str) -> str:
    return f"""
SELECT id, CASE WHEN (starts_with(s, '(') AND ends_with(s, ')')) <> starts_with(t, '-') THEN -v ELSE v END AS v FROM (
 SELECT id, s, t, CASE WHEN k = 1e-6 THEN n / 1e6 ELSE n * k END AS v FROM (
  SELECT id, s, t, k, {_number("x")} AS n FROM (
   SELECT id, s, t, CASE WHEN regexp_matches(u, '(?i)(billion|b)$') THEN 1000.0 WHEN regexp_matches(u, '(?i)(million|mm|m)$') THEN 1.0 WHEN regexp_matches(u, '(?i)(thousand|k)$') THEN 0.001 ELSE {bare} END::DOUBLE AS k,
     replace(regexp_replace(u, '(?i)(billion|million|thousand|mm|b|m|k)$', ''), ',', '') AS x FROM (
    SELECT id, s, t, CASE WHEN starts_with(t, '-') THEN substring(t, 2) ELSE t END AS u FROM (
     SELECT id, s, trim(regexp_replace(CASE WHEN starts_with(s, '(') AND ends_with(s, ')') THEN trim(s[2:-2]) ELSE s END, '[$ ]', '', 'g')) AS t FROM (SELECT id, {_present('commitment_text')} AS s FROM disclosures_raw))))))"""


_QEND = "CASE regexp_extract({0}, '(?i)Q([1-4])\\s*(\\d{{4}})', 1) WHEN '1' THEN '-03-31' WHEN '2' THEN '-06-30' WHEN '3' THEN '-09-30' WHEN '4' THEN '-12-31' END"
_NORMAL = "trim(coalesce({0}, ''))"
for _e in N.ENDINGS:
    _NORMAL = f"regexp_replace({_NORMAL}, '(?i){_e}', '')"
for _s, _f in N.ABBREVIATIONS.items():
    _NORMAL = f"regexp_replace({_NORMAL}, '(?i)\\b{_s}\\b', '{_f}', 'g')"
_NORMAL = f"trim(regexp_replace({_NORMAL}, '\\s+', ' ', 'g'))"
_FIRM = "trim(coalesce({0}, ''))"
for _e in N.FIRM_ENDINGS:
    _FIRM = f"regexp_replace({_FIRM}, '(?i){_e}', '')"
_FIRM = f"lower(trim(regexp_replace({_FIRM}, '\\s+', ' ', 'g')))"
_FAMILY = "trim(regexp_replace(fund_name, '(?i),?\\s*(L\\.?P\\.?\\d?|LLC|Ltd|SCSp|S\\.C\\.Sp\\.?|Cooperatief U\\.A\\.?)$', ''))"
for _p in (r"\s+(Fund\s+)?[IVXLC]+(-[A-Z0-9]+)?(\s+\(.*\))?\s*$", r"\s+Fund\s*$", r"\s+\d{4}\s*$", r"\s+[A-D]\s*$"):
    _FAMILY = f"trim(regexp_replace({_FAMILY}, '{_p}', ''))"
_Q = lambda x: "'" + x.replace("'", "''") + "'"
_FIRST = {m.lower(): (i, m) for i, m in reversed(list(enumerate(KNOWN_MANAGERS)))}
_KNOWN = "CASE " + " ".join(f"WHEN contains(low, {_Q(k)}) THEN {_Q(next(m for m in reversed(KNOWN_MANAGERS) if m.lower() == k))}" for k, _ in sorted(_FIRST.items(), key=lambda e: (-len(e[0]), e[1][0]))) + " END"
_LEFT = "trim(fund_name_raw)"
for _p in (r",?\s*L\.?P\.?\s*$", r",?\s*LLC\s*$", r",?\s*Ltd\.?\s*$", r",?\s*Inc\.?\s*$", r",?\s*SCSp\s*$", r",?\s*Cooperatief\s*U\.?A\.?\s*$"):
    _LEFT = f"regexp_replace({_LEFT}, {_Q('(?i)' + _p)}, '')"
_LEFT = f"regexp_replace({_LEFT}, '\\s*\\([^)]*\\)\\s*', ' ', 'g')"
for _p in (r"\s*[-–]\s*[A-E]\s*$", r"\s+'[A-E]'\s*$", r"\s+[A-E]\s*$"):
    _LEFT = f"regexp_replace({_LEFT}, {_Q(_p)}, '')"
_LEFT = f"regexp_replace({_LEFT}, '(?i)\\b(" + "|".join(reversed(N.ROMAN)) + ")\\b', '', 'g')"
_LEFT = f"regexp_replace({_LEFT}, '\\s+\\d+\\.?\\d*\\s*$', '')"
for _e in N.FUND_ENDINGS:
    _LEFT = f"regexp_replace({_LEFT}, {_Q('(?i)' + chr(92) + 's+' + _e.replace('.', chr(92) + '.') + chr(92) + 's*$')}, '')"
_LEFT = f"trim(regexp_replace(regexp_replace({_LEFT}, '[\\s,\\-–]+$', ''), '\\s+', ' ', 'g'))"
_GP = f"SELECT id, low, coalesce({_KNOWN}, CASE WHEN length(rest) >= 2 AND NOT regexp_matches(rest, '^[\\d ]+$') THEN rest END) AS gp FROM (SELECT id, lower(fund_name_raw) AS low, {_LEFT} AS rest FROM funds)"
_CLASS = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(low, '{w}')" for w in ws) + f" THEN '{a}|{s}'" for ws, a, s in N.STRATEGY_RULES)
_CLASS += " ELSE CASE lower(gp) " + " ".join(f"WHEN {_Q(m.lower())} THEN '{a}|{s}'" for m, (a, s) in DEFAULT_STRATEGY.items()) + " ELSE 'Private Equity|' END END"
_GENERIC = ", ".join(f"'{x}'" for x in N.GENERIC_TOKENS)


def _tokens(c: str) -> str:
    return f"list_distinct(list_filter(string_split(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), ' '), lambda x: x NOT IN ({_GENERIC})))"


# Through text, since the second engine rounds the product with ten thousand, not the number as it is written.
_ROUND = lambda x: f"CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), 4) AS VARCHAR) AS DOUBLE)"
_ROMAN = ", ".join(f"'{r}'" for r in N.ROMAN)
_ONE = ", ".join(f"'{x}'" for x in N.BEFORE_ONE)



def _ratio(a: str, b: str) -> str:
    """Normalised indel similarity: the longest common subsequence by the bit-parallel recurrence on 128-bit integers."""
    one = "1::HUGEINT"
    masks = f"list_transform(string_split({b}, ''), lambda y: list_reduce(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = y THEN {one} << i::HUGEINT ELSE 0::HUGEINT END), lambda p, q: p + q))"
    full = f"(({one} << length({a})::HUGEINT) - 1)"
    state = f"list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN (length({a}) + length({b}) = 0)::INT::DOUBLE ELSE 2.0::DOUBLE * (length({a}) - bit_count({state})) / (length({a}) + length({b})) END"


def _sorted(c: str) -> str:
    return f"array_to_string(list_sort(string_split(trim(regexp_replace({c}, '\\s+', ' ', 'g')), ' ')), ' ')"


def _numbers(source: str) -> str:
    """(k, number): the largest Roman number of the names of a relation (k, name)."""
    return f"""(WITH t AS (SELECT k, regexp_split_to_array(trim(name), '[\\s,\\-\'\'"()]+') AS ts FROM {source}), u AS (SELECT k, ts, unnest(range(1, len(ts) + 1)) AS i FROM t),
v AS (SELECT k, upper(regexp_replace(ts[i], '\\.+$', '')) AS r, CASE WHEN i > 1 THEN lower(ts[i - 1]) ELSE '' END AS b FROM u),
w AS (SELECT k, list_position([{_ROMAN}], r) AS n FROM v WHERE NOT (r = 'I' AND regexp_replace(b, '[.,]+$', '') NOT IN ({_ONE})) AND NOT (r = 'V' AND ends_with(b, 'v')))
SELECT k, max(n) AS number FROM w WHERE n > 0 GROUP BY k)"""


def _low(c: str) -> str:
    return f"lower({_NORMAL.format(c)})"


_LINKS = f"""
a AS (SELECT fa.id, alias, fund_name, {_low('alias')} AS x, {_low('fund_name')} AS y FROM fund_aliases fa JOIN funds f ON f.id = fa.fund_id),
na AS (SELECT id AS k, alias AS name FROM a), nb AS (SELECT id AS k, fund_name AS name FROM a),
l AS (SELECT a.id, {_ratio('x', 'y')} AS ratio, {_ratio('sx', 'sy')} AS token_ratio, p.number AS n1, q.number AS n2 FROM (SELECT *, {_sorted('x')} AS sx, {_sorted('y')} AS sy FROM a) a LEFT JOIN {_numbers('na')} p ON p.k = a.id LEFT JOIN {_numbers('nb')} q ON q.k = a.id)"""
_STRATEGY = ", ".join(f"'{x}'" for x in N.STRATEGY_TOKENS)
_PAIR_SQL = f"""
WITH r AS (SELECT id, fund_name_raw AS raw, {_low('fund_name_raw')} AS key FROM funds WHERE fund_name_raw IS NOT NULL),
n AS (SELECT key, min(id) AS arrival, arg_min(raw, id) AS raw FROM r WHERE key <> '' GROUP BY key),
m AS (SELECT *, {_NORMAL.format('raw')} AS stored FROM n), c AS (SELECT *, {_low('stored')} AS canonical FROM m),
s1 AS (SELECT key AS k, raw AS name FROM c), s2 AS (SELECT key AS k, stored AS name FROM c),
d AS (SELECT c.*, p.number AS n1, q.number AS n2, {_tokens('c.key')} AS t1, {_tokens('c.canonical')} AS t2, list_sort(list_distinct(list_filter(string_split(c.key, ' '), lambda x: x IN ({_STRATEGY})))) AS st, {_sorted('c.key')} AS sk, {_sorted('c.canonical')} AS sc
  FROM c LEFT JOIN {_numbers('s1')} p ON p.k = c.key LEFT JOIN {_numbers('s2')} q ON q.k = c.key),
g AS (SELECT a.key AS later, b.key AS earlier, a.key AS x, b.canonical AS y, a.sk AS sx, b.sc AS sy FROM d a JOIN d b ON b.arrival < a.arrival AND a.st = b.st AND (a.n1 IS NULL OR b.n2 IS NULL OR a.n1 = b.n2)
  AND (len(a.t1) = 0 OR len(b.t2) = 0 OR len(list_intersect(a.t1, b.t2)) >= 0.3 * len(list_distinct(list_concat(a.t1, b.t2)))) AND 2.0 * least(length(a.key), length(b.canonical)) / (length(a.key) + length(b.canonical)) >= 0.65),
z AS (SELECT later, earlier, {_ratio('x', 'y')} AS ratio, {_ratio('sx', 'sy')} AS score FROM g)
SELECT * FROM z WHERE ratio >= 0.65 AND score > 0.75"""
# The sequential rule: names in order of arrival; one that has a good enough earlier fund follows it, every other becomes a fund.
_RESOLVE = f"""
WITH RECURSIVE al AS (SELECT form, min(fund_id) AS alias_key FROM (SELECT lower(alias) AS form, fund_id FROM fund_aliases UNION ALL SELECT {_low('alias')}, fund_id FROM fund_aliases) GROUP BY 1),
rec AS (SELECT d.id, strftime(ingested_at, '%Y%m%d%H%M%S%f') || '|' || d.id AS arrival, fund_name_raw AS raw, {_low('fund_name_raw')} AS key, {_low('general_partner')} AS manager, CASE WHEN y BETWEEN 1980 AND 2030 THEN y ELSE 0 END AS vintage
  FROM (SELECT *, CASE WHEN trim(vintage_text) NOT IN ({_EMPTY}) THEN TRY_CAST(regexp_extract(vintage_text, '(\\d{{4}})', 1) AS INT) END AS y FROM disclosures_raw WHERE fund_name_raw IS NOT NULL) d),
k AS (SELECT rec.*, alias_key FROM rec LEFT JOIN al ON al.form = rec.key),
n AS (SELECT key, min(arrival) AS arrival, arg_min(raw, arrival) AS raw, arg_min(manager, arrival) AS manager, arg_min(vintage, arrival) AS vintage FROM k WHERE alias_key IS NULL AND key <> '' GROUP BY key),
m AS (SELECT *, {_NORMAL.format('raw')} AS stored FROM n), c AS (SELECT *, {_low('stored')} AS canonical FROM m),
s1 AS (SELECT key AS k, raw AS name FROM c), s2 AS (SELECT key AS k, stored AS name FROM c),
d AS (SELECT c.*, p.number AS n1, q.number AS n2, {_tokens('c.key')} AS t1, {_tokens('c.canonical')} AS t2, list_sort(list_distinct(list_filter(string_split(c.key, ' '), lambda x: x IN ({_STRATEGY})))) AS st, {_sorted('c.key')} AS sk, {_sorted('c.canonical')} AS sc, row_number() OVER (ORDER BY arrival) AS rn
  FROM c LEFT JOIN {_numbers('s1')} p ON p.k = c.key LEFT JOIN {_numbers('s2')} q ON q.k = c.key),
g AS (SELECT a.key AS later, b.key AS earlier, b.arrival AS since, a.key AS x, b.canonical AS y, a.sk AS sx, b.sc AS sy, a.manager AS ma, b.manager AS mb, a.vintage AS va, b.vintage AS vb FROM d a JOIN d b ON b.arrival < a.arrival AND a.st = b.st AND (a.n1 IS NULL OR b.n2 IS NULL OR a.n1 = b.n2)
  AND (len(a.t1) = 0 OR len(b.t2) = 0 OR len(list_intersect(a.t1, b.t2)) >= 0.3 * len(list_distinct(list_concat(a.t1, b.t2)))) AND 2.0 * least(length(a.key), length(b.canonical)) / (length(a.key) + length(b.canonical)) >= 0.65),
z AS (SELECT *, {_ratio('x', 'y')} AS ratio, {_ratio('sx', 'sy')} AS score, CASE WHEN ma <> '' AND mb <> '' THEN {_ratio('ma', 'mb')} ELSE 0 END AS alike FROM g),
ok AS (SELECT later, earlier, since, score FROM z WHERE ratio >= 0.65 AND score > 0.75 AND (score > 0.85)::INT + (alike > 0.85)::INT + (va <> 0 AND va = vb)::INT >= 2),
nm AS (SELECT d.key, rn, coalesce(o.earlier, []) AS options FROM d LEFT JOIN (SELECT later, list(earlier) AS earlier FROM ok GROUP BY 1) o ON o.later = d.key),
st(i, funds) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT i + 1, CASE WHEN len(list_intersect(options, funds)) > 0 THEN funds ELSE list_append(funds, key) END FROM st JOIN nm ON rn = i + 1),
fin AS (SELECT unnest(funds) AS fund FROM (SELECT funds FROM st ORDER BY i DESC LIMIT 1)),
best AS (SELECT later, earlier, score FROM ok WHERE earlier IN (SELECT fund FROM fin) QUALIFY row_number() OVER (PARTITION BY later ORDER BY score DESC, since) = 1)
SELECT k.id, coalesce(k.alias_key, best.earlier, n.key) AS fund_key, CASE WHEN k.alias_key IS NOT NULL THEN 'alias' WHEN n.key IS NULL THEN NULL WHEN k.arrival = n.arrival THEN CASE WHEN best.later IS NULL THEN 'new' ELSE 'fuzzy' END WHEN best.later IS NOT NULL THEN 'alias' ELSE 'exact' END AS match_type, best.score
FROM k LEFT JOIN n ON n.key = k.key AND k.alias_key IS NULL LEFT JOIN best ON best.later = n.key"""
_FIRMS = f"""
WITH n AS (SELECT DISTINCT general_partner AS firm_name, {_FIRM.format('general_partner')} AS form FROM funds WHERE general_partner IS NOT NULL), f AS (SELECT DISTINCT sha256(canonical_name) AS firm_id, {_FIRM.format('canonical_name')} AS y FROM gp_aliases), al AS (SELECT sha256(canonical_name) AS firm_id, {_FIRM.format('alias')} AS y FROM gp_aliases),
e AS (SELECT firm_name, min(firm_id) AS firm_id, 'exact' AS match_type FROM n JOIN f ON form = y WHERE form <> '' GROUP BY 1), b AS (SELECT firm_name, min(firm_id) AS firm_id, 'alias' AS match_type FROM n JOIN al ON form = y WHERE form <> '' AND firm_name NOT IN (SELECT firm_name FROM e) GROUP BY 1),
p AS (SELECT firm_name, form AS x, firm_id, y FROM n, f WHERE form <> '' AND firm_name NOT IN (SELECT firm_name FROM e UNION ALL SELECT firm_name FROM b) AND 2.0 * least(length(form), length(y)) > 0.85 * (length(form) + length(y))),
z AS (SELECT firm_name, firm_id, {_ratio('x', 'y')} AS score FROM p)
SELECT * FROM e UNION ALL SELECT * FROM b UNION ALL SELECT firm_name, arg_min(firm_id, (-score, firm_id)), 'fuzzy' FROM z WHERE score > 0.85 GROUP BY 1"""

ORACLE = {
    "link_audit": f"WITH {_LINKS} SELECT id, ratio, coalesce(n1 <> n2, false) AS numbers_differ FROM l WHERE coalesce(n1 <> n2, false) OR ratio < 0.75",
    "auto_resolved": f"WITH {_LINKS} SELECT id, ratio, token_ratio FROM l WHERE token_ratio > 0.90 AND ratio > 0.75 AND n1 IS NOT DISTINCT FROM n2",
    "similarity_pairs": _PAIR_SQL,
    "resolve_entities": _RESOLVE,
    "firm_resolution": _FIRMS,
    "parse_amounts": f"WITH a AS ({_amount('1e-6')}), b AS ({_amount('1.0')}) SELECT a.id, a.v AS amount_mm, b.v AS amount_in_millions FROM a JOIN b USING (id)",
    "parse_percent": f"SELECT id, CASE WHEN contains(i, '%') OR abs(n) > 1 THEN n / 100 ELSE n END AS rate FROM (SELECT id, i, CASE WHEN w THEN -n ELSE n END AS n FROM (SELECT id, i, w, {_number('x')} AS n FROM (SELECT id, i, w, trim(regexp_replace(i, '[%,]', '', 'g')) AS x FROM (SELECT id, starts_with(s, '(') AND ends_with(s, ')') AS w, CASE WHEN starts_with(s, '(') AND ends_with(s, ')') THEN trim(s[2:-2]) ELSE s END AS i FROM (SELECT id, {_present('net_irr_text')} AS s FROM disclosures_raw)))))",
    "parse_multiple": f"SELECT id, {_number('x')} AS multiple FROM (SELECT id, replace(trim(regexp_replace(s, '[xX]$', '')), ',', '') AS x FROM (SELECT id, {_present('net_multiple_text')} AS s FROM disclosures_raw))",
    "parse_vintage": f"SELECT id, CASE WHEN y BETWEEN 1980 AND 2030 THEN y END AS vintage_year FROM (SELECT id, TRY_CAST(regexp_extract(s, '(\\d{{4}})', 1) AS INT) AS y FROM (SELECT id, {_present('vintage_text')} AS s FROM disclosures_raw))",
    "parse_dates": f"SELECT id, CASE WHEN regexp_matches(s, '^[Qq][1-4]\\s*\\d{{4}}') THEN TRY_CAST(regexp_extract(s, '(\\d{{4}})', 1) || {_QEND.format('s')} AS DATE) WHEN regexp_matches(s, '^(?i)FY\\s*\\d{{4}}') THEN TRY_CAST(regexp_extract(s, '(\\d{{4}})', 1) || '-06-30' AS DATE) WHEN regexp_matches(s, '^\\d{{4}}$') THEN TRY_CAST(s || '-12-31' AS DATE) ELSE CAST(coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%m/%d/%Y'), try_strptime(s, '%B %d, %Y')) AS DATE) END AS as_of_date FROM (SELECT id, {_present('as_of_text')} AS s FROM disclosures_raw)",
    "source_amounts": f"""
SELECT id, m AS in_millions, CASE WHEN abs(m) > 100000 THEN m / 1e6 ELSE m END AS by_size, r / 100 AS points FROM (
 SELECT id, CASE WHEN aw THEN -an ELSE an END AS m, CASE WHEN rw THEN -rn ELSE rn END AS r FROM (
  SELECT id, aw, rw, {_number("ax")} AS an, {_number("rx")} AS rn FROM (
   SELECT id, starts_with(a, '(') AND ends_with(a, ')') AS aw, regexp_replace(CASE WHEN starts_with(a, '(') AND ends_with(a, ')') THEN a[2:-2] ELSE a END, '[$,\\s]', '', 'g') AS ax,
     starts_with(r, '(') AND ends_with(r, ')') AS rw, replace(CASE WHEN starts_with(r, '(') AND ends_with(r, ')') THEN r[2:-2] ELSE r END, ',', '') AS rx FROM (
    SELECT id, a, CASE WHEN upper(p) NOT IN ('N/M', 'NM') THEN p END AS r FROM (SELECT id, {_present('commitment_text')} AS a, regexp_replace({_present('net_irr_text')}, '[*%\\s]', '', 'g') AS p FROM disclosures_raw)))))""",
    "normalize_names": f"SELECT id, {_NORMAL.format('fund_name_raw')} AS fund, {_NORMAL.format('general_partner')} AS gp, {_FIRM.format('general_partner')} AS firm FROM funds",
    "fund_numerals": f"""
WITH t AS (SELECT id, regexp_split_to_array(trim(fund_name_raw), '[\\s,\\-''"()]+') AS ts FROM funds), u AS (SELECT id, ts, unnest(range(1, len(ts) + 1)) AS i FROM t),
v AS (SELECT id, upper(regexp_replace(ts[i], '\\.+$', '')) AS r, CASE WHEN i > 1 THEN lower(ts[i - 1]) ELSE '' END AS b FROM u),
w AS (SELECT id, list_position([{_ROMAN}], r) AS n FROM v WHERE NOT (r = 'I' AND regexp_replace(b, '[.,]+$', '') NOT IN ({_ONE})) AND NOT (r = 'V' AND ends_with(b, 'v')))
SELECT f.id, [{_ROMAN}][max(w.n)] AS number FROM funds f LEFT JOIN w ON f.id = w.id AND w.n > 0 GROUP BY f.id""",
    "classify_strategy": f"SELECT id, string_split(c, '|')[1] AS asset_class, nullif(string_split(c, '|')[2], '') AS sub_strategy FROM (SELECT id, {_CLASS} AS c FROM ({_GP}))",
    "extract_gp": f"SELECT id, gp FROM ({_GP})",
    "family_names": f"SELECT id, CASE WHEN {_FAMILY} = '' THEN fund_name ELSE {_FAMILY} END AS family FROM funds",
    "token_jaccard": f"SELECT id, CAST(len(list_intersect(a, b)) AS BIGINT) AS common, CAST(len(list_distinct(list_concat(a, b))) AS BIGINT) AS union_size FROM (SELECT id, {_tokens('fund_name_raw')} AS a, {_tokens('general_partner')} AS b FROM funds WHERE general_partner IS NOT NULL)",
    "derived_metrics": f"""SELECT id, t AS total_value_mm, t - o AS remaining_mm, CASE WHEN c > 0 THEN {_ROUND('t / c')} END AS multiple, CASE WHEN c > 0 AND coalesce(t, 0) > 0 THEN {_ROUND('t / c')} END AS multiple_zero,
 CASE WHEN c > 0 AND t > 0 THEN {_ROUND('t / c')} END AS multiple_positive, coalesce(dpi, CASE WHEN c > 0 THEN {_ROUND('o / c')} END) AS dpi, abs(m) AS positive_multiple FROM (SELECT id, capital_called_mm AS c, capital_distributed_mm AS o, capital_distributed_mm + remaining_value_mm AS t, dpi, net_multiple AS m FROM commitments)""",
    "formatted_values": "SELECT id, coalesce(strftime(as_of_date, '%b %Y'), '') AS as_of, CASE WHEN net_multiple IS NULL THEN '' ELSE format('{:.2f}x', net_multiple) END AS multiple, CASE WHEN net_irr IS NULL THEN 'N/A' ELSE format('{:.1f}%', net_irr * 100) END AS rate, CASE WHEN commitment_mm IS NULL THEN '' ELSE format('${:,.1f}M', commitment_mm) END AS dollars, CASE WHEN commitment_mm IS NULL THEN '' ELSE format('${:,.1f}B', commitment_mm / 1000) END AS billions FROM commitments",
    "loose_numbers": f"""SELECT id, {_number("regexp_replace(trim(net_multiple_text), '[xX,]', '', 'g')")} AS number, CASE WHEN y > 99 THEN y WHEN y <= 30 THEN y + 2000 ELSE y + 1900 END AS vintage, TRY_CAST(regexp_extract(as_of_text, '^\\s*\\d{{1,2}}/\\d{{1,2}}/(\\d{{4}})', 1) AS INT) AS year,
 regexp_replace(commitment_text, '(\\d)\\s+(\\d)', '\\1\\2', 'g') AS rejoined FROM (SELECT *, TRY_CAST(regexp_extract(vintage_text, '(\\d{{2}})\\D*$', 1) AS INT) AS y FROM disclosures_raw)""",
    "stated_dates": "SELECT * FROM (SELECT doc_id, coalesce(" + ", ".join(
        "TRY_CAST(try_strptime(regexp_extract(text, '" + lead + "(" + "|".join(P.MONTHS) + ")\\s+(\\d{1,2}),?\\s+(\\d{4})', 1) || ' ' || regexp_extract(text, '" + lead + "(" + "|".join(P.MONTHS) + ")\\s+(\\d{1,2}),?\\s+(\\d{4})', 2) || ' ' || regexp_extract(text, '" + lead + "(" + "|".join(P.MONTHS) + ")\\s+(\\d{1,2}),?\\s+(\\d{4})', 3), '%B %d %Y') AS DATE)"
        for lead in ("[Aa]s\\s+of\\s+", "[Ff]or\\s+the\\s+period\\s+ending\\s+")
    ) + ", TRY_CAST(regexp_extract(text, '[Qq]([1-4])\\s*(\\d{4})', 2) || CASE regexp_extract(text, '[Qq]([1-4])\\s*(\\d{4})', 1) WHEN '1' THEN '-03-31' WHEN '2' THEN '-06-30' WHEN '3' THEN '-09-30' WHEN '4' THEN '-12-31' END AS DATE)) AS as_of_date FROM documents) WHERE as_of_date IS NOT NULL",
}
