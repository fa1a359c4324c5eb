import datetime as dt

from allocata.cli import main, report
from allocata.pipeline import Pipeline
from allocata.sources.adapters import registry
from allocata.sources.landing import Registry, Source
from tests.conftest import DATA, needs_data

SCHEMA = "fund_name_raw string, general_partner string, vintage_year int, commitment_mm double, capital_called_mm double, capital_distributed_mm double, remaining_value_mm double, net_irr double, net_multiple double, dpi double, as_of_date date, extraction_method string, extraction_confidence double"
DAY = dt.date(2025, 6, 30)
ROWS = [("Alpha Fund I, L.P.", "Alpha Capital", 2020, 100.0, 80.0, 40.0, 90.0, 0.15, 1.6, None, DAY, "test", 0.95), ("Beta Ventures III", "Beta", 2019, 50.0, 45.0, 20.0, 60.0, 0.25, 1.8, None, DAY, "test", 0.8)]


def test_pipeline(spark, tmp_path):
    registry = Registry()
    state = {"rows": ROWS}
    registry.add(Source("good", "Good", lambda s, _: s.createDataFrame(state["rows"], SCHEMA)))
    registry.add(Source("bad", "Bad", lambda s, _: 1 / 0))
    registry.add(Source("empty", "Empty", lambda s, _: s.createDataFrame([], SCHEMA)))
    p = Pipeline(spark, str(tmp_path), registry)
    out = p.run("nowhere")
    assert out["good"] == {"status": "completed", "records_extracted": 2, "records_updated": 0, "records_flagged": 1} and out["bad"]["status"] == "error" and out["empty"]["records_extracted"] == 0
    facts = {r["fund_name_raw"]: r for r in p.read("commitments").collect()}
    assert facts["Alpha Fund I, L.P."]["dpi"] == 0.5 and facts["Beta Ventures III"]["dpi"] == 0.4444
    assert {r["fund_key"]: r["sub_strategy"] for r in p.read("funds").collect()} == {"alpha fund i": None, "beta ventures iii": "Venture Capital"}
    assert p.run("nowhere", ["good"])["good"] == {"status": "skipped"}
    again = p.run("nowhere", ["good"], force=True)["good"]
    assert again["records_updated"] == 2 and p.read("commitments").count() == 2 and p.read("funds").count() == 2
    state["rows"] = [("Alpha Fund I LP", None, 2020, 120.0, None, None, None, None, None, None, DAY, "test", 0.95), (" ", None, None, None, None, None, None, None, None, None, None, None, None)]
    assert p.run("nowhere", ["good"])["good"]["records_extracted"] == 1
    assert {r["commitment_mm"] for r in p.read("commitments").collect()} == {120.0, 50.0} and p.read("review_queue").count() == 1


@needs_data
def test_command_line(spark, capsys, tmp_path):
    main(["--data", f"{DATA}/sf0.001", "list"])
    assert "fund_summary" in capsys.readouterr().out
    for command in (["quality"], ["summary-stats"], ["status"], ["cross-fund-report"], ["query", "headline"], ["spot-check", "--count", "5"]):
        main(["--data", f"{DATA}/sf0.001", *command])
    assert "Field Completeness" in capsys.readouterr().out


SEED = """
pension_funds: [{id: calstrs, name: CalSTRS, state: CA}]
consulting_firms: [{id: meketa, name: "Meketa Group, LLC", firm_type: general, aliases: [Meketa]}]
engagements:
  - {consulting_firm_id: meketa, pension_fund_id: calstrs, role: general_investment_consultant, mandate_scope: all, is_current: true}
  - {consulting_firm_id: meketa, pension_fund_id: calstrs, role: general_investment_consultant, mandate_scope: equity, is_current: true}
"""


def test_registered_sources_and_commands(spark, tmp_path, capsys):
    """A landed page of words is read, stored, resolved and audited from the command line; an absent source is its own error."""
    words = [("Alder", 5.0, 100.0), ("Fund", 30.0, 100.0), ("IV", 60.0, 100.0), ("2015", 242.0, 100.0), ("$7", 292.0, 100.0), ("0,000,000", 300.0, 100.0), ("$50,000,000", 362.0, 100.0), ("$20,000,000", 432.0, 100.0), ("$60,000,000", 502.0, 100.0), ("0.84", 562.0, 100.0), ("Total", 5.0, 112.0)]
    more = [("Aldr", 5.0, 124.0), *[(t if t != "2015" else "2015", x, 124.0) for t, x, _ in words[1:10]]]
    rows = [("d", 1, 612.0, i, *w) for i, w in enumerate(words + more)]
    landed = str(tmp_path / "landing")
    spark.createDataFrame(rows, "doc_id string, page int, page_width double, idx int, text string, x0 double, top double").write.parquet(f"{landed}/calstrs/words")
    spark.createDataFrame([("d", 1, "As of June 30, 2024")], "doc_id string, page int, text string").write.parquet(f"{landed}/calstrs/pages")
    (tmp_path / "landing" / "calpers").mkdir()
    (tmp_path / "landing" / "calpers" / "a.html").write_text("<p>As of March 31, 2024</p><table><tr><th>n</th></tr><tr><th>m</th></tr><tr><td>Birch Fund I</td><td>2019</td><td>$10,000,000</td><td>$5,000,000</td><td>$1,000,000</td><td>$8,000,000</td><td>12.5%</td></tr></table>")
    spark.createDataFrame([("t", 1, "Private Markets\nCedar Fund II 2018 $5.0 4.0 1.0 5.0 9.9 1.5"), ("u", 1, "Net Asset Value Unfunded Capital\nPrivate Equity $ 5,000,000 $ 1,000,000")], "doc_id string, page int, text string").write.parquet(f"{landed}/texas_trs/pages")
    (tmp_path / "seed.yaml").write_text(SEED)
    at = ["--store", str(tmp_path / "store")]
    main([*at, "run", "--landing", landed, "--all"])
    out = capsys.readouterr().out
    assert "calstrs: status completed, records_extracted 2" in out and "calpers: status completed, records_extracted 1" in out and "texas_trs: status completed, records_extracted 2" in out and "oregon: status error" in out
    pipe = Pipeline(spark, str(tmp_path / "store"), registry())
    facts = {(r["pension_fund_id"], r["fund_name_raw"]): r for r in pipe.read("commitments").collect()}
    one = facts["calstrs", "Alder Fund IV"]
    assert (one["commitment_mm"], one["net_irr"], one["net_multiple"], str(one["as_of_date"]), one["vintage_year"]) == (70.0, 0.0084, 1.6, "2024-06-30", 2015)
    assert facts["calpers", "Birch Fund I"]["remaining_value_mm"] == 7.0 and facts["texas_trs", "Cedar Fund II"]["net_irr"] == 0.099 and facts["texas_trs", "Texas TRS Private Equity Portfolio (Summary)"]["commitment_mm"] == 6.0
    main([*at, "seed-consultants", str(tmp_path / "seed.yaml")])
    main([*at, "seed-consultants", str(tmp_path / "seed.yaml")])
    assert pipe.read("consulting_engagements").count() == 1
    for command in ("resolve-fuzzy", "audit-links", "consultants"):
        main([*at, command])
    out = capsys.readouterr().out
    assert "consulting_firms: 1" in out and "Auto-resolved: " in out and "Total fuzzy aliases: " in out and "Meketa Group, LLC: general_investment_consultant" in out
    named = spark.createDataFrame([("Meketa Groupp", "calstrs", "audit", None, None, None, None, None, None, None, None), ("Nobody", "calstrs", "audit", None, None, None, None, None, None, None, None)], "firm_name string, pension_fund_id string, role string, mandate_scope string, start_date date, end_date date, is_current boolean, annual_fee_usd double, fee_basis string, contract_term_years double, source_url string")
    assert pipe.engage_named(named) == 1 and pipe.read("consulting_engagements").count() == 2 and pipe.read("consulting_firm_aliases").where("alias = 'Meketa Groupp'").count() == 1
    assert {s.ident for s in registry().all()} == {"calpers", "calstrs", "wsib", "oregon", "ny_common", "texas_trs", "florida_sba"} and len(registry().defaults()) == 5


@needs_data
def test_reports(spark):
    for kind, wanted in (("quality", "## Review Queue"), ("cross-fund-report", "## Largest IRR Divergences"), ("summary-stats", "Cross-system entity resolution:"), ("dataset", "## Pension Funds Covered")):
        assert wanted in report(spark, f"{DATA}/sf0.001", kind)


def test_irr_quartiles_equal_interpolation(spark):
    import numpy as np

    from allocata.operators.relational import irr_quartiles

    rates = [0.1, 0.1, 0.2, 0.4, 0.9, -0.3, 0.1]
    df = spark.createDataFrame([("a", r) for r in rates] + [("b", 0.5), ("b", 5.0), ("b", None)], "pension_fund_id string, net_irr double")
    got = {r["pension_fund_id"]: r for r in irr_quartiles(df).collect()}
    assert [got["a"][k] for k in ("q1", "median", "q3")] == [round(float(np.percentile(rates, p)), 9) for p in (25, 50, 75)]
    assert got["b"]["n"] == 1 and got["b"]["q1"] == got["b"]["q3"] == 0.5
