"""p4..p7 on small cases: nulls, ties, repeated rows, empty tables, clashing extra columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from allocata.operators import profile, snapshots, spikes, units
from allocata.operators.ranking import quarter
from allocata.plans import data_quality
from tests.conftest import DATA, needs_data

D = dt.date
T0 = dt.datetime(2024, 1, 1)
SNAP = "id string, pension_fund_id string, fund_id string, as_of_date date, extraction_confidence double, extracted_at timestamp_ntz, commitment_mm double, capital_called_mm double, n int, h long"


def snap(i, f, d, a, c=1.0, conf=0.9, at=T0, p="p"):
    return (i, p, f, d, conf, at, a, c, 7, 7)


def changes(spark, rows):
    return {tuple(r)[1:4] for r in snapshots.snapshot_changes(spark.createDataFrame(rows, SNAP)).drop("changed_fields").collect()}


def test_snapshots(spark):
    q1, q2, q3 = D(2023, 3, 31), D(2023, 6, 30), D(2023, 12, 31)
    rows = [
        snap("1", "same", q1, 1.0), snap("2", "same", q2, 1.0 + 1e-8), snap("3", "same", q3, 1.0),
        snap("4", "gone", q1, 1.0), snap("5", "new", q2, 1.0), snap("6", "new", q3, 2.0),
        snap("7", "null", q1, None), snap("8", "null", q2, 5.0), snap("9", "null", q3, None), snap("10", "null", q3, None),
        # Ranking: the later date wins, then confidence, then extraction, then id; a null value falls to the next record.
        snap("11", "rank", q1, 1.0), snap("12", "rank", D(2023, 4, 1), 9.0), snap("13", "rank", q2, None, conf=0.5), snap("14", "rank", q2, 1.0, conf=None), snap("15", "rank", q3, 1.0),
        snap("16", "undated", None, 3.0), snap("17", "other", q2, 1.0, p="second"),
    ]
    assert changes(spark, rows) == {
        ("gone", "2023Q2", "removed"), ("new", "2023Q2", "added"), ("new", "2023Q4", "changed"), ("null", "2023Q2", "changed"), ("null", "2023Q4", "changed"),
    }
    assert changes(spark, []) == set()


def test_snapshot_index_equals_the_batch(spark, tmp_path):
    rows = [snap(str(i), f"f{i % 7}", D(2023, 3 * (1 + i % 4), 28), float((i * i) % 3), p=f"p{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, SNAP)
    states = snapshots.position_states(df)
    index = snapshots.SnapshotIndex(spark, str(tmp_path / "index"), ["pension_fund_id", "fund_id"], snapshots.FIELDS, buckets=4)
    got = set()
    for q in ("2023Q1", "2023Q2", "2023Q3", "2023Q4"):
        for r in index.apply(states.where(F.col("snapshot_quarter") == q).drop("snapshot_quarter")).collect():
            got.add((r["pension_fund_id"], r["fund_id"], q, r["change_type"]))
    want = {tuple(r) for r in snapshots.snapshot_changes(df).drop("changed_fields").select("pension_fund_id", "fund_id", "snapshot_quarter", "change_type").collect()}
    assert got == want and want


LOADS = "method string, as_of date, v double, t string, n_rows int, mask string"


def shifts(spark, rows):
    df = spark.createDataFrame(rows, LOADS)
    load = {"method": F.col("method"), "quarter": quarter(F.col("as_of"))}
    masks = profile.mask_counts(profile.value_counts(df, load, ("v", "t")), ("method", "quarter"))
    found = profile.load_shifts(profile.load_measures(masks, ("method", "quarter")), "method", "quarter")
    return {(r["method"], r["quarter"], r["column_name"], r["measure_name"]) for r in found.collect()}, masks


def test_load_shifts(spark):
    a, b, c = D(2023, 3, 31), D(2023, 6, 30), D(2023, 9, 30)
    rows = [("m", a, float(i), f"x{i}", 1, "m") for i in range(1, 21)]
    rows += [("m", b, None if i < 7 else 0.0 if i < 14 else -float(i), "same", 1, "m") for i in range(20)]
    rows += [("m", c, float(i) if i else -0.0, None, 1, "m") for i in range(14)]  # too few rows to count
    rows += [(None, a, 1.0, "x", 1, "m")] * 15 + [(None, b, float("nan"), "x", 1, "m")] * 15
    got, masks = shifts(spark, rows)
    # The mode of v goes from 1/20 to 7/20 and the negatives from 0 to 6/20: by exactly 0.30, which is no case.
    assert got == {("m", "2023Q2", "v", "null"), ("m", "2023Q2", "v", "zero"), ("m", "2023Q2", "t", "mode")}
    assert ("v", "NaN") in {(r["column_name"], r["mask"]) for r in masks.collect()}
    assert shifts(spark, [])[0] == set()


def test_share_at_the_threshold_is_no_case(spark):
    a, b = D(2023, 3, 31), D(2023, 6, 30)
    exact = [("m", a, float(i), None, 1, "") for i in range(20)] + [("m", b, None if i < 6 else float(i), None, 1, "") for i in range(20)]
    assert ("m", "2023Q2", "v", "null") not in shifts(spark, exact)[0]


def test_profile_and_divergence(spark):
    rows = [("m", D(2023, 3, 31), 1.5, "AB-12", 1, "")] * 99 + [("m", D(2023, 3, 31), None, "oops", 1, "")] + [("m", D(2023, 6, 30), 2.5, "AB-77", 1, "")] * 50
    _, masks = shifts(spark, rows)
    p = {(r["load_quarter"], r["column_name"]): r for r in profile.column_profile(masks, ("method", "quarter")).collect()}
    t = p["2023Q1", "t"]
    assert (t["n_rows"], t["n_null"], t["n_distinct"], t["dominant_mask"], t["n_rare"]) == (100, 0, 2, "A-9", 1)
    assert (p["2023Q1", "v"]["n_null"], p["2023Q1", "v"]["min_number"], p["2023Q1", "v"]["max_number"]) == (1, 1.5, 1.5)
    js = {(r["quarter"], r["column_name"]): r["divergence"] for r in profile.mask_divergence(masks, "method", "quarter").collect()}
    assert 0 < js["2023Q2", "t"] < 0.05


FACT = "id string, pension_fund_id string, fund_id string, commitment_mm double, net_irr double, net_multiple double, as_of_date date, value double, unit string, source string"


def test_units(spark):
    funds = spark.createDataFrame([(f"f{i}", 1000.0 + i, 2010) for i in range(20)], "id string, fund_size_mm double, vintage_year int")
    rows = []
    for p, a, r in (("mm", 1.0, 1.0), ("usd", 1e6, 100.0), ("k", 1e3, 1e4), ("bn", 1e-3, 1.0)):
        for i in range(20):
            rows.append((f"{p}{i}", p, f"f{i}", 40.0 * a + i * a, 0.1 * r, 1.9, D(2023, 12, 31), 0.0, "x", "y"))
    rows += [("z", "mm", "f1", 0.0, None, None, None, None, None, None), ("n", "usd", "f1", None, float("nan"), None, None, None, None, None)]
    c = spark.createDataFrame(rows, FACT)
    raw = [
        ("r1", "mm", "$5 bn", "120 bps", None), ("r2", "mm", "41,000", "0.101", None), ("r3", "usd", "42000000", "10.3", None), ("r4", "mm", "n/m", "—", None), ("r5", "mm", None, "", None),
        ("r6", "mm", "47.5", "9.7", "$ in millions; IRR in per cent"), ("r7", "mm", "(1,500) thousand", "(4.1%)", None), ("r8", "mm", "50,000", "1010", "amounts in $000s"), ("r9", "nobody", "USD 5,000,000", "-3.5 %", None),
    ]
    raw = spark.createDataFrame([(*x, "extra") for x in raw], "id string, pension_fund_id string, commitment_text string, net_irr_text string, unit_note string, value string")
    sources = {r["source"]: (r["amount_unit"], r["rate_unit"], r["amount_unique"]) for r in units.source_units(c, funds, raw).collect()}
    assert sources == {"mm": ("million", "fraction", True), "usd": ("usd", "percent", True), "k": ("thousand", "bp", True), "bn": ("billion", "fraction", True)}
    got = {(r["record_id"], r["field"]): (r["unit"], r["value"]) for r in units.record_units(c, funds, raw).collect()}
    assert got["r1", "commitment_text"] == ("billion", 5000.0) and got["r1", "net_irr_text"] == ("bp", pytest.approx(0.012))
    assert got["r2", "commitment_text"][0] == "thousand" and got["r2", "net_irr_text"][0] == "fraction"
    assert got["r3", "commitment_text"][0] == "usd" and got["r3", "net_irr_text"][0] == "percent"
    assert got["r6", "commitment_text"][0] == "million" and got["r6", "net_irr_text"][0] == "percent"
    assert got["r7", "commitment_text"] == ("thousand", pytest.approx(-1.5)) and got["r7", "net_irr_text"][1] == pytest.approx(-0.041)
    assert got["r8", "net_irr_text"][0] == "bp" and got["r9", "commitment_text"][0] == "usd" and got["r9", "net_irr_text"][1] == pytest.approx(-0.035)
    assert not any(k[0] in ("r4", "r5", "z", "n") for k in got)
    assert units.record_units(c.limit(0), funds.limit(0), raw.limit(0)).count() == 0


def test_spikes(spark):
    rows = []
    for i in range(200):
        rows.append((f"a{i}", "p", f"f{i}", 1.0, 0.10 + (i % 20) / 1000, 1.5 + (i % 20) / 100, D(2023, 3, 31), 0.0, "", ""))
    rows += [("spike", "p", "s", 1.0, 0.9, 1.6, D(2023, 3, 31), 0.0, "", ""), ("below", "p", "s", 1.0, None, -0.2, None, 0.0, "", ""), ("lost", "p", "s", 1.0, -1.2, None, None, 0.0, "", "")]
    for k in range(6):
        rows.append((f"stuck{k}", "p", "k", 1.0, None, 1.555, D(2022 + k // 4, 3 * (1 + k % 4), 28), 0.0, "", ""))
    rows.append(("stuck_copy", "p", "k", 1.0, None, 1.555, D(2022, 3, 28), 0.0, "", ""))
    for k in range(6):  # a null breaks the run
        rows.append((f"free{k}", "p", "g", 1.0, None, None if k == 3 else 1.666, D(2022 + k // 4, 3 * (1 + k % 4), 28), 0.0, "", ""))
    rows.append(("one", "lonely", "x", 1.0, 0.5, 9.0, None, 0.0, "", ""))
    c = spark.createDataFrame(rows, FACT)
    got = {(r["id"], r["field"]) for r in spikes.implausible(c).collect()}
    assert got == {("spike", "net_irr"), ("below", "net_multiple"), ("lost", "net_irr"), ("stuck_copy", "net_multiple"), *((f"stuck{k}", "net_multiple") for k in range(6))}
    percent = spark.createDataFrame([("p", "percent")], "source string, rate_unit string")
    assert ("lost", "net_irr") in {(r["id"], r["field"]) for r in spikes.implausible(c, percent).where("is_spike AND NOT is_impossible").collect()}
    assert spikes.implausible(c.limit(0)).count() == 0 and spikes.jumps(c.limit(0)).count() == 0


def test_spikes_of_a_source_with_one_usual_value(spark):
    rows = [(f"usual{i}", "p", f"f{i}", 1.0, 0.1, None, None, 0.0, "", "") for i in range(120)]
    rows += [(f"other{i}", "p", f"g{i}", 1.0, 0.12 + i / 1000, None, None, 0.0, "", "") for i in range(30)]
    rows += [("spike", "p", "s", 1.0, 5.0, None, None, 0.0, "", "")] + [(f"flat{i}", "q", f"h{i}", 1.0, 0.2, None, None, 0.0, "", "") for i in range(9)]
    assert {r["id"] for r in spikes.implausible(spark.createDataFrame(rows, FACT)).collect()} == {"spike"}


@needs_data
def test_divergence_of_every_profiled_column(spark):
    sf = f"{DATA}/sf0.001"
    divergence, whole = (data_quality.QUERIES[q](spark, sf).select("column_name").distinct().collect() for q in ("p4_divergence", "p4_profile"))
    assert {r[0] for r in divergence} == {r[0] for r in whole} and len(whole) == 21


def test_rare_masks(spark):
    """A value of another shape is named with its mask, however few there are; nulls are none."""
    rows = [("m", "2023Q1", f"AB-{i:03d}") for i in range(300)] + [("m", "2023Q2", "x/1"), ("m", None, None), (None, None, "")]
    df = spark.createDataFrame(rows, "method string, quarter string, code string")
    masks = profile.mask_counts(profile.value_counts(df, {"method": F.col("method"), "quarter": F.col("quarter")}, ["code"]), ("method", "quarter"))
    assert {(r["mask"], r["n_rows"], r["example"]) for r in profile.rare_masks(masks).collect()} == {("a/9", 1, "x/1"), ("", 1, "")}
    assert profile.column_profile(masks, ("method", "quarter")).count() == 4
    assert profile.rare_masks(masks.limit(0)).count() == 0
