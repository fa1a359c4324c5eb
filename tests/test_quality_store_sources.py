import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from allocata import reports, sinks
from allocata.operators import quality as Q
from allocata.operators import store as S
from allocata.operators import textevents as T
from allocata.sources import html, landing, layout
from allocata.streaming import landing as stream

FACT = "id string, commitment_mm double, capital_called_mm double, capital_distributed_mm double, remaining_value_mm double, net_irr double, net_multiple double, vintage_year int, extraction_confidence double"


@pytest.fixture
def facts(spark):
    rows = [
        ("good", 100.0, 1.0, 1.0, 1.0, 0.15, 1.5, 2020, 0.95), ("multiple", 50.0, None, None, None, None, 20.0, 2021, 0.8), ("irr", 75.0, None, None, None, 2.0, None, 2019, None),
        ("huge", 6000.0, None, None, None, None, None, 2022, 0.9), ("negative", 30.0, None, None, None, None, -0.3, 2023, 0.9),
    ]
    return spark.createDataFrame(rows, FACT)


def test_rules(facts):
    flags = {r["commitment_id"]: r["flag_detail"] for r in Q.range_flags(facts, 2026).collect()}
    assert set(flags) == {"multiple", "irr", "huge", "negative"}
    assert flags["negative"].startswith("Negative net multiple") and "20.0" in flags["multiple"] and "6000" in flags["huge"]
    assert {r[0] for r in Q.low_completeness(facts).collect()} == {"huge"}
    assert {r[0] for r in Q.ingest_flags(facts).collect()} == {"multiple"}
    share = {r["field"]: r["percent"] for r in Q.completeness(facts).collect()}
    assert share["commitment_mm"] == 100.0 and share["net_irr"] == 40.0
    assert Q.completeness(facts.limit(0)).count() == 6


def test_queue(spark, facts):
    queue = spark.createDataFrame([("a", "value_range", "old", False), ("b", "value_range", "old", True), ("c", "fuzzy_match", "old", False)], "commitment_id string, flag_type string, flag_detail string, resolved boolean")
    found = Q.range_flags(facts, 2026).unionByName(spark.createDataFrame([(None, "missing_consulting_data", "x")], "commitment_id string, flag_type string, flag_detail string"))
    new, counts = Q.refresh_queue(queue, found)
    assert tuple(counts.first()) == (5, 4)
    assert {(r["commitment_id"], r["flag_type"]) for r in new.where("NOT resolved").collect()} >= {("c", "fuzzy_match"), ("huge", "value_range")}
    assert {r["flag_type"]: r["n"] for r in Q.queue_counts(new).collect()} == {"value_range": 4, "fuzzy_match": 1}
    q = queue.withColumn("id", F.col("commitment_id"))
    closed, n = S.resolve_flags(q, flag_type="value_range")
    assert n.first()[0] == 1 and closed.where("resolved").count() == 2
    left, n = S.delete_open_flags(q, "value_range")
    assert n.first()[0] == 1 and left.count() == 2


def test_tolerances(spark):
    df = spark.createDataFrame([(1.0, 1.5, 2020, 2020), (1.0, 3.0, 2020, None), (None, 1.0, 1, 1)], "a double, r_a double, v int, r_v int")
    assert [r[0] for r in df.select(Q.tolerance_issues({"a": 1.0}, ("v",))).collect()] == [[], ["a", "v"], []]


def test_upsert(spark):
    schema = "k string, d date, v double, created_at string"
    old = spark.createDataFrame([("a", None, 1.0, "t0"), ("b", None, 2.0, "t0")], schema)
    new = spark.createDataFrame([("a", None, 5.0, "t1", "x"), ("a", None, 4.0, "t2", "x"), ("c", None, None, "t1", "x"), ("b", None, None, "t1", "x")], schema + ", extra string")
    got = {r["k"]: (r["v"], r["created_at"]) for r in S.upsert(old, new, ["k", "d"], recency=F.col("created_at")).collect()}
    assert got == {"a": (4.0, "t0"), "b": (None, "t0"), "c": (None, "t1")}
    filled = {r["k"]: r["v"] for r in S.upsert(old, new, ["k", "d"], recency=F.col("created_at"), fill=True).collect()}
    assert filled["b"] == 2.0
    again = S.upsert(S.upsert(old, new, ["k", "d"], recency=F.col("created_at")), new, ["k", "d"], recency=F.col("created_at"))
    assert again.count() == 3
    assert S.upsert(old.limit(0), new, ["k", "d"]).count() == 3 and S.upsert(old, new.limit(0), ["k", "d"]).count() == 2
    assert S.insert_ignore(old.select("k"), new.select("k"), ["k"]).count() == 3


def test_table_and_log(spark, tmp_path):
    t = S.Table(spark, str(tmp_path / "runs"), "id string, pension_fund_id string, started_at string, completed_at string, status string, errors string, records_extracted int, source_hash string").create()
    assert t.read().count() == 0 and t.create().version == 1
    rows = spark.createDataFrame([("1", "p", "t1", None, "running", None, None, "h1"), ("2", "p", "t2", None, "running", None, None, "h2")], t.schema)
    t.write(rows)
    log = S.finish_run(t.read(), "1", "completed", {"records_extracted": 5}, F.lit("t9"))
    done = {r["id"]: (r["status"], r["records_extracted"], r["completed_at"]) for r in log.collect()}
    assert done == {"1": ("completed", 5, "t9"), "2": ("running", None, None)}
    hashes = spark.createDataFrame([("p", "h1"), ("q", "h1")], "pension_fund_id string, source_hash string")
    assert {r[0] for r in S.changed_sources(hashes, log).collect()} == {"q"}
    assert S.changed_sources(hashes, log, force=True).count() == 2
    listing = S.status_listing(hashes.select("pension_fund_id"), log).collect()
    assert [r["status"] for r in listing] == ["running", "No runs yet"]


HTML = """<p>As of June 30, 2025</p><table><tr><th>a</th></tr><tr><th>b</th></tr>
<tr><td>Fund &amp; One</td><td>2015</td><td>$100,000,000</td><td>$80,000,000</td><td>$40,000,000</td><td>$120,000,000</td><td>15.3%</td></tr>
<tr><td></td><td>2015</td><td>1</td><td>1</td><td>1</td><td>1</td><td>1</td></tr><tr><td>short</td></tr><tr></tr>
<tr><td>Two<td>2016<td>$1<td>$0<td>-<td>$5<td>N/M1</table>"""


def test_html(spark):
    pages = spark.createDataFrame([("x", HTML), ("y", None), ("z", "no table"), ("e", "")], "page string, html string")
    rows = html.table_rows(pages, "page", "html").collect()
    assert [r["cells"] for r in rows][:2] == [["a"], ["b"]] and len(rows) == 6
    assert html.table_rows(pages, "page", "html", table_index=3).count() == 0
    got = {r["fund_name_raw"]: r for r in html.holdings(pages, "page", "html").collect()}
    one = got["Fund & One"]
    assert set(got) == {"Fund & One", "Two"}
    assert (one["commitment_mm"], one["remaining_value_mm"], one["net_multiple"], one["net_irr"], str(one["as_of_date"])) == (100.0, 80.0, 1.5, 0.153, "2025-06-30")
    assert got["Two"]["net_irr"] is None and got["Two"]["net_multiple"] is None


def test_layout(spark):
    schema = "doc_id string, page int, page_width double, idx int, text string, x0 double, top double"
    words = spark.createDataFrame([
        ("d", 1, 612.0, 0, "Alpha", 10.0, 100.2), ("d", 1, 612.0, 1, "Fund", 60.0, 100.4), ("d", 1, 612.0, 2, "2015", 245.0, 100.0), ("d", 1, 612.0, 4, "0,000", 310.0, 100.0), ("d", 1, 612.0, 3, "7", 300.0, 100.0),
        ("d", 1, 612.0, 5, "Late", 10.0, 106.0), ("d", 1, 612.0, 6, None, 10.0, 106.0),
    ], schema)
    rows = {r["row"]: r for r in layout.fixed_layout(words, "seven_columns").collect()}
    assert (rows[99.0]["c0"], rows[99.0]["c1"], rows[99.0]["c2"]) == ("Alpha Fund", "2015", "7 0,000") and rows[105.0]["c0"] == "Late"
    wide = words.withColumn("page_width", F.lit(1224.0)).withColumn("x0", F.col("x0") * 2)
    assert layout.scaled_layout(wide, layout.BOUNDARIES["seven_columns"]).where("c1 = '2015'").count() == 1
    head = spark.createDataFrame([("d", 1, 612.0, 0, "Vintage", 200.0, 10.0), ("d", 1, 612.0, 1, "Commitment", 300.0, 10.0), ("d", 1, 612.0, 2, "IRR", 400.0, 10.0), ("d", 1, 612.0, 3, "Beta", 5.0, 50.0), ("d", 1, 612.0, 4, "2016", 201.0, 50.0), ("d", 1, 612.0, 5, "9%", 390.0, 50.0)], schema)
    got = [r for r in layout.detected_layout(head).collect() if r["fund_name"] == "Beta"]
    assert got[0]["cells"]["vintage"] == "2016" and got[0]["cells"]["irr"] == "9%"
    assert layout.fixed_layout(words.limit(0), "seven_columns").count() == 0
    pages = spark.createDataFrame([("d", 1, "intro"), ("d", 2, "PRIVATE EQUITY INVESTMENTS"), ("d", 3, "more"), ("d", 4, "Fund of Funds"), ("d", 5, "after")], "doc_id string, page int, text string")
    assert sorted(r["page"] for r in layout.page_range(pages, "PRIVATE EQUITY INVESTMENTS", "FUND OF FUNDS").collect()) == [2, 3]
    lines = spark.createDataFrame([("Gamma Fund II, 2018 $100.5 80 40 90 12.5 1.6x",), ("Total 2018 5",), ("no year",), ("X 1950 1",)], "text string")
    row = layout.name_year_amounts(lines).collect()
    assert len(row) == 1 and (row[0]["fund_name"], row[0]["vintage_year"], row[0]["commitment_text"], row[0]["multiple_text"]) == ("Gamma Fund II", 2018, "100.5", "1.6")


def test_landing(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"nope")
    files = landing.read_binary(spark, str(tmp_path), "*.pdf")
    assert {len(r["source_hash"]) for r in files.collect()} == {64}
    assert [r["path"].rsplit("/", 1)[1] for r in landing.preferred_document(files, "b.pdf", ".*", "a.pdf").collect()] == ["a.pdf"]
    with pytest.raises(FileNotFoundError):
        landing.require(files.where("false"), "missing")
    seed = tmp_path / "seed.yaml"
    seed.write_text("pension_funds: [{id: p, name: P}]\nconsulting_firms: [{id: f, name: F LLC, aliases: [FF, F2]}]\nengagements: [{consulting_firm_id: f, pension_fund_id: p, role: r, is_current: true, annual_fee_usd: 5, start_date: 2020-01-01}]\n")
    tables = landing.read_seed(spark, str(seed))
    assert landing.seed_counts(tables) == {"pension_funds": 1, "consulting_firms": 1, "consulting_firm_aliases": 2, "consulting_engagements": 1}
    assert tables["consulting_firms"].first()["name_normalized"] == "f" and tables["consulting_engagements"].first()["is_current"] is True
    (tmp_path / "m.json").write_text('{"meetings": [{"meeting_date": "2024", "pages": 3}, {"meeting_date": "2025", "pages": 4}]}')
    assert landing.read_meetings(spark, str(tmp_path / "m.json")).count() == 2
    assert landing.read_meetings(spark, str(tmp_path / "none.json")).count() == 0
    registry = landing.Registry()
    registry.add(landing.Source("s", "S", lambda spark, d: spark.range(1)))
    assert registry.get("s").name == "S" and registry.table(spark).count() == 1
    with pytest.raises(KeyError):
        registry.get("t")


MINUTES = """CALL TO ORDER
Members Present:
Jane Roe, Vice Chair
John Doe
Staff Present:
Ann Lee, Portfolio Manager

PRIVATE MARKETS COMMITTEE REPORT
Jane Roe moved that the Board invest up to $175 million, plus fees and expenses, in Menlo Ventures XVII, L.P. John Doe seconded the motion.
The motion carried unanimously. Since 2005 the Board has committed over $1.2 billion to 6 prior funds.
Assets under management increased to $150 billion. The fund returned 7.5 percent for the year, net.
Treasurer Pat Poe expressed concern about risk and loss and volatile growth.
"""


def test_events(spark):
    docs = spark.createDataFrame([(1, MINUTES), (2, None), (3, ""), (4, "x" * 100_000), (1, MINUTES)], "doc_id long, text string")
    got = T.events(docs).collect()
    one = {r["event_type"]: r["details"] for r in got if r["section"] != "full_document"}
    assert one["investment_commitment"]["fund_name"].startswith("Menlo Ventures XVII") and one["investment_commitment"]["amount_mm"] == "175.0"
    assert one["investment_commitment"]["prior_fund_count"] == "6" and one["motion"]["outcome"] == "carried_unanimously" and one["motion"]["seconder"].endswith("John Doe")
    assert one["dissent"]["sentiment"] == "negative" and {r["details"].get("aum_mm") for r in got} >= {"150000.0"}
    assert {r["title"] for r in T.section_spans(docs).where("doc_id = 1").collect()} == {"CALL TO ORDER", "PRIVATE MARKETS COMMITTEE REPORT"}
    people = {(r["name"], r["title"], r["role"]) for r in T.attendance(docs).collect()}
    assert ("Jane Roe", "Vice Chair", "member") in people and ("John Doe", "", "member") in people and ("Ann Lee", "Portfolio Manager", "staff") in people
    assert T.events(docs.limit(0)).count() == 0
    heads = docs.select("doc_id", T.system_of(F.col("text")).alias("system"), T.meeting_date(F.col("text")).alias("meeting_date"))
    text = reports.meeting_report(heads, T.attendance(docs), T.section_spans(docs), T.events(docs.distinct()), 1)
    assert "INVESTMENT COMMITMENTS (1)" in text and "History: Relationship since 2005, 6 prior funds, $1,200M" in text and "Outcome: Carried Unanimously" in text and "[sentiment: negative]" in text
    assert "Total events extracted: 0" in reports.meeting_report(heads, T.attendance(docs), T.section_spans(docs), T.events(docs), 3)


def test_event_details(spark):
    """Every rule, its windows, vetoes and bounds; the dated list counts in its own system or where none is asked for."""

    def found(text, system=""):
        return {(e[2], *(e[4].get(k) for k in ("person", "fund_name", "outcome", "dissenter", "action", "policy", "return_pct"))) for e in T.document_events("CALL TO ORDER\n" + text, system)}

    dated = "November 18th Willamette Partners II, L.P. $250M USD\nMay 3 Tiny Fund $900K"
    assert found(dated, "Oregon") == found(dated) == {("investment_commitment", None, "Willamette Partners II, L.P.", None, None, None, None, None)}
    assert found(dated, "WSIB") == found(dated, "Unknown") == set()
    vote = "Ann Lee moved that the Board approve the plan. The motion carried with Pat Poe opposed."
    assert ("motion", None, None, "carried_with_dissent", "Pat Poe", "approve the plan.", None, None) in found(vote)
    assert ("motion", None, None, "unknown", "", "approve the plan.", None, None) in found("Ann Lee moved that the Board approve the plan." + " " * 900 + "motion carried")
    people = "Ann Lee was elected Vice Chair\nBoard appoint Bob Ray to the Audit Committee\nCy Fox be removed from the Audit Committee\nDi Gow, Outgoing Chair\nEd Hay, OUTGOING CHAIR"
    assert {(p, a) for _, p, _, _, _, a, _, _ in found(people)} >= {("Ann Lee", "elected"), ("Bob Ray", "appointed"), ("Cy Fox", "removed"), ("Di Gow", "outgoing"), ("Ed Hay", "incoming")}
    assert ("dissent", "Treasurer Pat Poe", None, None, None, None, None, None) in found("Treasurer Pat Poe voted no")
    assert found("The proxy voting report. Treasurer Pat Poe voted no") == set() == found("PROXY VOTING\nx" + " y" * 300 + "\nTreasurer Pat Poe voted no")
    assert {e[-1] for e in found("The fund returned 7. percent for the year, net.")} == {"7.0"}
    cut = "Committee commit up to $2 billion in"
    assert [e[0] for e in T.document_events(f"Board {cut} Alpha Fund II\nADJOURN")] == ["full_document"]
    assert [e[0] for e in T.document_events(f"CALL TO ORDER\nBoard {cut} Alpha Fund II")] == ["CALL TO ORDER"]
    assert T.document_events("") == [] and T.sections("plain") == []


def test_no_event_is_lost_by_the_filter(spark):
    """What the JVM side lets pass is all that has events; rosters are read without Python."""
    parts = [
        "CALL TO ORDER", "Board invest up to $5 million in Alpha Fund II", "Board select Beta as a global equity manager", "Ann\u00a0moved that\u2003the Board adopt it.", "Ann was ELECTED Chair", "It returned 7. percent", "AUM of $3 B",
        "Board approve the investment policy of the year as presented", "Mr. Poe voted against", "Many public commenters urged everybody to think about it again. Then", "May 3 Gamma Fund $9M", "Board appoint Bo to the Audit Committee", "Di, Incoming Chair", "nothing",
    ]
    docs = spark.createDataFrame([(i, "CALL TO ORDER\n" + p) for i, p in enumerate(parts)] + [(99, "Consultants Present: Callan, Meketa Group, X")], "doc_id long, text string")
    plain = {i for i, p in enumerate(parts) if T.document_events("CALL TO ORDER\n" + p, "Oregon")}
    got = {r["doc_id"] for r in T.events(docs.withColumn("text", F.concat("text", F.lit("\nOPERF")))).collect()}
    assert got == plain == set(range(1, 13))
    assert [(r["n"], r["name"], r["role"]) for r in T.attendance(docs).orderBy("n").collect()] == [(0, "Callan", "consultant"), (1, "Meketa Group", "consultant")]
    totals = {r["doc_id"]: r for r in T.meeting_totals(T.events(docs)).collect()}
    assert totals[1]["committed_mm"] == 5.0 and totals[1]["n_commitments"] == 1 and totals[3]["committed_mm"] == 0.0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", 0.123, 1234.5, 1.5), ("B", None, None, None)], "fund_name string, net_irr double, commitment_mm double, net_multiple double")
    shown = sinks.formatted(df, rates=("net_irr",), amounts=("commitment_mm",), multiples=("net_multiple",))
    assert shown.columns == ["Fund Name", "Net IRR (%)", "Commitment ($M)", "Net Multiple (x)"]
    assert len(sinks.HEADERS) == 29 and sinks.HEADERS["sub_strategy"] == "Sub-Strategy" and sinks.HEADERS["capital_distributed_mm"] == "Distributions ($M)" and sinks.HEADERS["as_of_date"] == "As-Of Date"
    assert [tuple(r) for r in shown.collect()] == [("A", "12.3%", "1,234.5", "1.50x"), ("B", None, None, None)]
    sinks.write_csv(shown.limit(0), str(tmp_path / "empty"))
    part = next(p for p in os.listdir(tmp_path / "empty") if p.endswith(".csv"))
    assert (tmp_path / "empty" / part).read_text().startswith("Fund Name,Net IRR (%)")
    assert sinks.not_disclosed(df).where("net_irr = 'N/D'").count() == 1
    assert sinks.markdown_table(df, "T").count("|") == 20
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_stream(spark, tmp_path):
    schema = "k string, v double, created_at string"
    spark.createDataFrame([("a", 1.0, "t1"), ("b", 2.0, "t1")], schema).write.parquet(str(tmp_path / "in"))
    table = S.Table(spark, str(tmp_path / "table"), schema).create()
    for _ in range(2):
        q = stream.merge_stream(stream.read_landing(spark, str(tmp_path / "in"), schema), table, ["k"], "created_at", str(tmp_path / "cp"))
        q.awaitTermination()
    spark.createDataFrame([("b", 9.0, "t2")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    stream.merge_stream(stream.read_landing(spark, str(tmp_path / "in"), schema), table, ["k"], "created_at", str(tmp_path / "cp")).awaitTermination()
    assert {r["k"]: r["v"] for r in table.read().collect()} == {"a": 1.0, "b": 9.0}


def test_matches_are_looked_for_only_where_they_can_start():
    """As `finditer` gives them, from pieces that nearly match, and without walking through the names of a text for every letter."""
    pieces = (
        "Ann moved that the Board invest in it.", "moved", "x moved that the Board adopt it. ", "Bob\nseconded the motion", "The motion carried with A B opposed.", "the motion carried unanimously", "Dia\nwas\nelected Chair", "was elected as Board Chair",
        "Edd be removed from the Risk Committee", "Gus, Outgoing Chair", "returned 7.5 percent for the year,", "AUM of $3 B", "Board approve the long policy as proposed", "Board appoint Al Bo to the Audit Committee", "Mr. Bob voted no. proxy voting",
        "public commenters urged the board to do more for bonds. Then", "May 3 Ash II $7.5B", "Board invest up to $5 million, in Alder IV, L.P.", "Since 2001 the Board has committed over $3 billion to 4 prior", "Alder IV is a large buyout fund with a target size of $3 billion",
        "Board select Birch as a global manager", "\nADJOURN\n", ". ", "ſeconded the motion", "İ Ann moved that the Board adopt it.", "Kiſmé", "elected", " be ",
    )
    rng = random.Random(2)
    patterns = {(r.pattern, r.flags) for r in T.RULES} | {(p, re.IGNORECASE) for p in (T.SECONDED, T.UNANIMOUS, T.OPPOSED, T.CARRIED, T.HISTORY, T.DESCRIBED, T.NOT_DISSENT)}
    for _ in range(400):
        whole = "".join(rng.choice(pieces) + rng.choice((" ", "\n", "", ", ")) for _ in range(rng.randrange(1, 25)))
        low = T.folded(whole)
        assert len(low) == len(whole)
        for p, flags in patterns:
            assert [m.span() for m in T.every(p, flags, whole, low)] == [m.span() for m in re.finditer(p, whole, flags)], (p, whole)
    assert all(any(re.search(r.anchor, p, r.flags) for r in T.RULES) for p in T.PLAIN_ANCHORS)


def test_names_are_not_walked_for_every_letter():
    names = "Ann Bob Cyd Dia Edd Flo Gus Hal " * 400
    began = time.process_time()
    T.document_events(f"CALL TO ORDER\n{names}\nAnn moved that the Board adopt it. {names}\nDia was elected Chair")
    assert time.process_time() - began < 1
