"""Every query of the core against the SQL of a second engine on the smallest data."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from allocata.plans import catalog
from tests.conftest import DATA, needs_data

SF = f"{DATA}/sf0.001"


def cell(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, datetime.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    return "~" if v is None else str(v)


def second_engine(sql):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    return sorted(columns), sorted(tuple(cell(v) for _, v in sorted(zip(columns, row, strict=True))) for row in rel.fetchall())


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    columns, want = second_engine(catalog.ORACLE[name])
    assert sorted(df.columns) == columns
    assert sorted(tuple(cell(r[c]) for c in columns) for r in df.collect()) == want


@needs_data
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() >= 0


@needs_data
def test_matrix_has_every_investor_with_commitments(spark):
    df = catalog.QUERIES["investor_pivot"](spark, SF)
    _, held = second_engine("SELECT DISTINCT p.id FROM pension_funds p JOIN commitments c ON c.pension_fund_id = p.id")
    assert {c for c in df.columns if c.endswith("_mm")} == {f"{i}_mm" for (i,) in held} and len(held) > 4
    _, cells = second_engine("SELECT c.pension_fund_id AS a, c.fund_id AS b, max(c.commitment_mm) AS c FROM commitments c JOIN funds f ON c.fund_id = f.id JOIN pension_funds p ON c.pension_fund_id = p.id GROUP BY 1, 2 HAVING max(c.commitment_mm) IS NOT NULL")
    rows = df.collect()
    kept = {r["fund_id"] for r in rows}
    got = sorted((i, r["fund_id"], cell(r[f"{i}_mm"])) for r in rows for (i,) in held if r[f"{i}_mm"] is not None)
    assert got and got == [x for x in cells if x[1] in kept]


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES) and catalog.FLAGSHIP in catalog.QUERIES


def test_core_does_not_need_the_optional_package():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "allocata")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as source:
                        assert "allocata.llm" not in source.read(), f
