"""Scalar parsers of disclosed text as column expressions; unparseable input gives null.

All parsers trim every kind of white space and treat the NO_DATA tokens as null. Numbers are checked against a numeric
pattern before try_cast, since the cast alone would also accept forms such as `1.5D` or `inf`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean `no data` (compared exactly, after trimming).
NO_DATA = ("", "N/A", "n/a", "N/a", "NA", "na", "-", "—", "–", "n.a.", "n.a", "--", "---", "None", "none")
MONTHS = "January February March April May June July August September October November December".split()
QUARTER_END = {"1": "03-31", "2": "06-30", "3": "09-30", "4": "12-31"}
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy/M/d", "M/d/yy")
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_empty(c: Column) -> Column:
    return c.isNull() | strip(c).isin(*NO_DATA)


def present(c: Column) -> Column:
    """The trimmed text, null if it means no data."""
    return F.when(~is_empty(c), strip(c))


def to_number(c: Column) -> Column:
    """The number if the whole text is one; the text stands once in the expression, so that nested parsers stay small."""
    return F.regexp_extract(c, _NUMBER, 0).try_cast("double")


def _no_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def _unwrap(c: Column) -> tuple[Column, Column]:
    """(inner text, whether it stood in parentheses)"""
    wrapped = c.startswith("(") & c.endswith(")")
    return F.when(wrapped, strip(F.regexp_replace(c, r"^\(|\)$", ""))).otherwise(c), wrapped


def dollar_amount(c: Column, in_millions: bool = False) -> Column:
    """Millions of dollars: parentheses and a leading minus each turn the sign; B, M, MM, K or the words scale; a bare
    number is dollars, or millions where the source says so."""
    inner, wrapped = _unwrap(present(c))
    s = strip(F.regexp_replace(inner, r"[$ ]", ""))
    minus = s.startswith("-")
    s = F.regexp_replace(s, "^-", "")
    low = F.lower(s)
    scale = (
        F.when(low.rlike("(billion|b)$"), 1000.0).when(low.rlike("(million|mm|m)$"), 1.0).when(low.rlike("(thousand|k)$"), 0.001)
        .otherwise(1.0 if in_millions else 1e-6)
    )
    number = to_number(_no_commas(F.regexp_replace(s, r"(?i)(billion|million|thousand|mm|b|m|k)$", "")))
    value = F.when(scale == 1e-6, number / 1e6).otherwise(number * scale)
    return F.when(wrapped != minus, -value).otherwise(value)


def percentage(c: Column) -> Column:
    """Fraction: with a percent sign always a hundredth; without, only beyond one."""
    inner, wrapped = _unwrap(present(c))
    number = to_number(strip(F.regexp_replace(inner, "[%,]", "")))
    number = F.when(wrapped, -number).otherwise(number)
    return F.when(F.contains(inner, F.lit("%")) | (F.abs(number) > 1), number / 100).otherwise(number)


def multiple(c: Column) -> Column:
    """Multiple without its trailing x."""
    return to_number(_no_commas(strip(F.regexp_replace(present(c), "[xX]$", ""))))


def vintage_year(c: Column, first: int = 1980, last: int = 2030) -> Column:
    year = F.regexp_extract(present(c), r"(\d{4})", 1).try_cast("int")
    return F.when(year.between(first, last), year)


def _quarter_end(year: Column, q: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in QUARTER_END.items():
        out = F.when(q == k, F.concat(year, F.lit(f"-{v}"))).otherwise(out)
    return F.try_to_date(out)


def date(c: Column) -> Column:
    """Quarter `Q4 2023` -> its end, fiscal year -> 30 June, bare year -> 31 December, else the listed forms."""
    s = present(c)
    q = r"^[Qq]([1-4])\s*(\d{4})"
    forms = F.coalesce(*[F.try_to_date(s, f) for f in DATE_FORMATS])
    return (
        F.when(s.rlike(q), _quarter_end(F.regexp_extract(s, q, 2), F.regexp_extract(s, q, 1)))
        .when(s.rlike(r"(?i)^FY\s*\d{4}"), F.try_to_date(F.concat(F.regexp_extract(s, r"(\d{4})", 1), F.lit("-06-30"))))
        .when(s.rlike(r"^\d{4}$"), F.try_to_date(F.concat(s, F.lit("-12-31"))))
        .otherwise(forms)
    )


def as_of_date(text: Column) -> Column:
    """The date a page states: `As of Month D, YYYY`, else `For the period ending ...`, else a quarter."""
    month = "(" + "|".join(MONTHS) + r")\s+(\d{1,2}),?\s+(\d{4})"

    def stated(lead: str) -> Column:
        p = lead + month
        return F.try_to_date(F.concat_ws(" ", *[F.regexp_extract(text, p, i) for i in (1, 2, 3)]), "MMMM d yyyy")

    q = r"[Qq]([1-4])\s*(\d{4})"
    return F.coalesce(stated(r"[Aa]s\s+of\s+"), stated(r"[Ff]or\s+the\s+period\s+ending\s+"), _quarter_end(F.regexp_extract(text, q, 2), F.regexp_extract(text, q, 1)))


def rejoin_split_number(text: Column) -> Column:
    """`7 0,000` -> `70,000`: one pass, so of `1 2 3` the last blank stays."""
    return F.regexp_replace(text, r"(\d)\s+(\d)", "$1$2")


def amount_in_millions(c: Column) -> Column:
    """Amounts of a source that states millions: currency sign, commas and blanks dropped, parentheses negative."""
    inner, wrapped = _unwrap(present(c))
    number = to_number(F.regexp_replace(inner, r"[$,\s]", ""))
    return F.when(wrapped, -number).otherwise(number)


def amount_by_size(c: Column, limit: float = 100_000.0) -> Column:
    """Amounts of a source that mixes dollars and millions: beyond the limit it is dollars."""
    number = amount_in_millions(c)
    return F.when(F.abs(number) > limit, number / 1e6).otherwise(number)


def percent_points(c: Column) -> Column:
    """Rates of a source that always states per cent: footnote stars dropped, N/M is null."""
    s = F.regexp_replace(present(c), r"[*%\s]", "")
    inner, wrapped = _unwrap(F.when(~F.upper(s).isin("N/M", "NM"), s))
    number = to_number(_no_commas(inner))
    return F.when(wrapped, -number).otherwise(number) / 100


def two_digit_year(c: Column, pivot: int = 30) -> Column:
    y = c.try_cast("int")
    return F.when(y > 99, y).when(y <= pivot, y + 2000).otherwise(y + 1900)


def year_of_date(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*\d{1,2}/\d{1,2}/(\d{4})", 1).try_cast("int")


def remaining_value(total: Column, distributed: Column) -> Column:
    return total - distributed


def derived_multiple(total: Column, called: Column, missing_as_zero: bool = False, positive_total: bool = False) -> Column:
    """total / called to four places where capital was called; sources differ in what they do with missing or zero totals."""
    t = F.coalesce(total, F.lit(0.0)) if missing_as_zero else total
    ok = called > 0
    if positive_total or missing_as_zero:
        ok = ok & (t > 0)
    return F.when(ok, F.round(t / called, 4))


def derived_dpi(dpi: Column, distributed: Column, called: Column) -> Column:
    return F.coalesce(dpi, F.when(called > 0, F.round(distributed / called, 4)))


def positive_multiple(c: Column) -> Column:
    return F.abs(c)


def _places(c: Column, places: int) -> Column:
    """A number with so many places; a tie goes to the even digit, as the double's exact value has it."""
    return F.format_number(c, places)


def format_dollars(c: Column, unit: str = "M") -> Column:
    """Millions, or with unit B billions, with one place; empty for none."""
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit("$"), _places(c / 1000 if unit == "B" else c, 1), F.lit(unit)))


def format_rate(c: Column) -> Column:
    return F.when(c.isNull(), "N/A").otherwise(F.concat(F.replace(_places(c * 100, 1), F.lit(","), F.lit("")), F.lit("%")))


def format_multiple(c: Column) -> Column:
    return F.when(c.isNull(), "").otherwise(F.concat(F.replace(_places(c, 2), F.lit(","), F.lit("")), F.lit("x")))


def format_month(c: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_date(c), "MMM yyyy"), F.lit(""))


def loose_float(c: Column) -> Column:
    return to_number(F.regexp_replace(F.trim(c), "[xX,]", ""))


def scaled(number: Column, unit: Column) -> Column:
    """Number with its stated scale in millions: billion or B, million or M, K."""
    u = F.lower(unit)
    return F.when(u.isin("billion", "b"), number * 1000).when(u.isin("thousand", "k"), number / 1000).otherwise(number)


def first_match(text: Column, patterns: dict[str, str], default: str) -> Column:
    """Name of the first pattern, in order, that the text matches."""
    return reduce(lambda out, kv: F.when(text.rlike(kv[1]), kv[0]).otherwise(out), reversed(patterns.items()), F.lit(default))
