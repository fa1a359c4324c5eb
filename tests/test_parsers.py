import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from allocata.functions import parsers as P


def run(spark, fn, values, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"), **kw)).collect()]


CASES = {
    "dollar_amount": {
        "$1.2B": 1200, "$1.2 billion": 1200, "1.5b": 1500, "$500M": 500, "$100MM": 100, "$1,200.5M": 1200.5, "$45,000,000": 45, "($500M)": -500, "-$500M": -500, "$500K": 0.5,
        "N/A": None, "-": None, "—": None, "--": None, None: None, "": None, " $2 million ": 2, "(-5M)": 5, "$(500)": None, "inf": None, "1.5D": None, "nan": None, "1_000": None, "abc": None,
    },
    "percentage": {"15.3%": 0.153, "-2.1%": -0.021, "0.153": 0.153, "15.3": 0.153, "(15.3%)": -0.153, "1": 1.0, "0.84": 0.84, "": None, None: None, "x%": None},
    "multiple": {"1.5x": 1.5, "1.50X": 1.5, "0.85": 0.85, "1,200x": 1200.0, "x": None, None: None, "n.a.": None},
    "vintage_year": {"Vintage 2015": 2015, "FY 2020": 2020, "1970": None, "2050": None, "2023.0": 2023, "'02": None, "": None, None: None},
    "date": {
        "12/31/2023": dt.date(2023, 12, 31), "December 31, 2023": dt.date(2023, 12, 31), "Q1 2023": dt.date(2023, 3, 31), "FY2023": dt.date(2023, 6, 30), "2023": dt.date(2023, 12, 31),
        "2023-12-31": dt.date(2023, 12, 31), "q4 2022": dt.date(2022, 12, 31), "02/30/2023": None, "soon": None, "": None, None: None,
    },
    "as_of_date": {
        "Report. As of June 30, 2025 net": dt.date(2025, 6, 30), "For the period ending March 31, 2025": dt.date(2025, 3, 31), "in Q4 2024 we": dt.date(2024, 12, 31), "nothing": None, None: None,
        "Q1 2020, as of May 5, 2021": dt.date(2021, 5, 5),
    },
    "rejoin_split_number": {"7 0,000,000": "70,000,000", "1 2 3": "12 3", "a 1": "a 1", None: None},
    "amount_in_millions": {"$1,234.5": 1234.5, "(3.2)": -3.2, "—": None},
    "amount_by_size": {"45,000,000": 45.0, "(250,000)": -0.25, "77.5": 77.5},
    "percent_points": {"23.51": 0.2351, "0.84": 0.0084, "(4.0)": -0.04, "N/M": None, "12.0*": 0.12},
    "two_digit_year": {"07": 2007, "30": 2030, "31": 1931, "98": 1998, "x": None},
    "year_of_date": {"3/31/2015": 2015, "2015": None},
    "loose_float": {"1.5x": 1.5, "2,000": 2000.0, "a": None},
}


@pytest.mark.parametrize("name", CASES)
def test_examples(spark, name):
    got = run(spark, getattr(P, name), list(CASES[name]))
    for (text, want), have in zip(CASES[name].items(), got, strict=True):
        assert have == (pytest.approx(want) if isinstance(want, float | int) and not isinstance(want, bool) else want), text


def test_amount_in_a_source_of_millions(spark):
    assert run(spark, P.dollar_amount, ["1,200.5", "3K"], in_millions=True) == [1200.5, 0.003]


def plain_percentage(text):
    s = text.strip()
    if s in P.NO_DATA:
        return None
    wrapped = s.startswith("(") and s.endswith(")")
    s = s[1:-1].strip() if wrapped else s
    try:
        n = float(s.replace("%", "").replace(",", "").strip())
    except ValueError:
        return None
    n = -n if wrapped else n
    return n / 100 if "%" in s or abs(n) > 1 else n


@settings(max_examples=1, deadline=None)
@given(st.lists(st.from_regex(r"\A\(?-?[0-9]{1,3}(\.[0-9]{1,2})?%?\)?\Z"), min_size=200, max_size=200))
def test_percentage_like_plain_python(spark, texts):
    for have, text in zip(run(spark, P.percentage, texts), texts, strict=True):
        want = plain_percentage(text)
        assert have == (want if want is None else pytest.approx(want)), text


def test_derived(spark):
    df = spark.createDataFrame([(None, 40.0, 80.0), (None, 20.0, 45.0), (0.3, 1.0, 2.0), (None, 5.0, 0.0), (None, None, 5.0)], "dpi double, d double, c double")
    assert [r[0] for r in df.select(P.derived_dpi(F.col("dpi"), F.col("d"), F.col("c"))).collect()] == [0.5, 0.4444, 0.3, None, None]
    total = spark.createDataFrame([(0.0, 10.0), (15.0, 10.0), (None, 10.0)], "t double, c double")
    assert [r[0] for r in total.select(P.derived_multiple(F.col("t"), F.col("c"))).collect()] == [0.0, 1.5, None]
    assert [r[0] for r in total.select(P.derived_multiple(F.col("t"), F.col("c"), positive_total=True)).collect()] == [None, 1.5, None]
    shown = spark.createDataFrame([(1234.56, 0.123, 1.5), (None, None, None)], "a double, r double, m double")
    assert [tuple(r) for r in shown.select(P.format_dollars(F.col("a")), P.format_rate(F.col("r")), P.format_multiple(F.col("m"))).collect()] == [("$1,234.6M", "12.3%", "1.50x"), ("", "N/A", "")]
