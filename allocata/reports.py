"""Reports of bounded size: quality, differences between investors, summary, description of the dataset, a meeting.

Every table in a report is an aggregate or a top-k list; only these rows come to the driver. A report changes nothing: flags
are made by `quality` and kept by `store`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allocata.operators import quality, relational

# Fields of the completeness table, with their labels, and lengths of the listed parts.
FIELDS = {
    "commitment_mm": "Commitment Amount", "vintage_year": "Vintage Year", "capital_called_mm": "Capital Called", "capital_distributed_mm": "Distributions", "remaining_value_mm": "Remaining Value",
    "net_irr": "Net IRR", "net_multiple": "Net Multiple", "dpi": "DPI", "as_of_date": "As-Of Date",
}
LISTED, DETAIL = 20, 80


def table(head: Iterable[str], rows: Iterable[Iterable[object]], numeric: int = 0) -> list[str]:
    """Lines of a Markdown table; the columns from `numeric` on are aligned to the right."""
    head = list(head)
    rule = ["---:" if numeric and i >= numeric else "---" for i in range(len(head))]
    body = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
    return ["| " + " | ".join(head) + " |", "|" + "|".join(rule) + "|", *body, ""]


def _completeness(facts: DataFrame) -> list[tuple[str, int, float]]:
    order = {f: i for i, f in enumerate(FIELDS)}
    rows = quality.completeness(facts, tuple(FIELDS)).collect()
    return sorted(((r["field"], r["n_present"], r["percent"] or 0.0) for r in rows), key=lambda r: order[r[0]])


def _per_investor(star: DataFrame) -> list:
    rows = star.groupBy("p_name").agg(
        F.count(F.lit(1)).alias("n"), relational.dsum("commitment_mm").alias("mm"), F.min("p_state").alias("state"), F.min("p_total_aum_mm").alias("aum"), F.min("vintage_year").alias("first"), F.max("vintage_year").alias("last"), F.max("as_of_date").alias("as_of"),
    )
    return rows.orderBy("p_name").collect()


def _tiers(facts: DataFrame) -> dict[str, int]:
    return relational.cross_link_tiers(facts).first().asDict()


def quality_report(facts: DataFrame, star: DataFrame, flags: DataFrame, made: int, at: str) -> str:
    """Coverage, completeness and the open flags; `made` is the number of flags the last run made."""
    lines = ["# Data Quality Report", "", f"Generated: {at}", "", "## Overview", "", f"- **Total commitment records:** {facts.count()}", f"- **Quality flags created:** {made}", "", "## Pension Fund Coverage", ""]
    lines += table(("Pension Fund", "Records", "Total Commitment ($M)"), ((r["p_name"], r["n"], f"{r['mm'] or 0:,.1f}") for r in _per_investor(star)), 1)
    lines += ["## Field Completeness", "", *table(("Field", "Populated %"), ((f, f"{p:.1f}%") for f, _, p in sorted(_completeness(facts))), 1)]
    open_ = flags.where(~F.col("resolved"))
    n = open_.count()
    if n:
        shown = open_.orderBy("flag_type", "commitment_id").limit(LISTED).collect()
        lines += [f"## Review Queue ({n} items)", "", *table(("Type", "Detail"), ((r["flag_type"], r["flag_detail"][:DETAIL]) for r in shown))]
        lines += [f"*... and {n - LISTED} more items*"] if n > LISTED else []
    return "\n".join(lines)


def cross_fund_report(star: DataFrame, facts: DataFrame) -> str:
    """The funds whose investors report the widest spreads of multiples and of rates."""
    linked = star.join(relational.held_by(facts, 2), "fund_id", "left_semi")
    lines = ["# Cross-Fund Consistency Report", "", f"Funds appearing in 2+ pension systems: {linked.select('f_fund_name').distinct().count()}", ""]
    for field, what, show in (("net_multiple", "Multiple", lambda v: f"{v:.2f}x"), ("net_irr", "IRR", lambda v: f"{v:.1%}")):
        held = linked.groupBy(F.col("f_fund_name").alias("fund")).agg(
            F.min("f_vintage_year").alias("vintage"), relational.distinct_names(F.col("p_name"), ", ").alias("investors"), F.count(field).alias("n"), F.min(field).alias("least"), F.max(field).alias("most"),
        ).where("n >= 2").withColumn("spread", F.col("most") - F.col("least"))
        rows = held.orderBy(F.desc("spread"), "fund").limit(LISTED).collect()
        lines += [f"## Largest {what} Divergences", "", *table(("Fund", "Vintage", "Pensions", f"Min {what}", f"Max {what}", "Spread"), ((r["fund"], r["vintage"], r["investors"], show(r["least"]), show(r["most"]), show(r["spread"])) for r in rows), 1)]
    return "\n".join(lines)


def summary_text(facts: DataFrame, funds: DataFrame, investors: DataFrame, star: DataFrame) -> str:
    """Totals, tiers of shared funds, a line per investor and per strategy, as fixed-width text."""
    rule, tiers = "=" * 60, _tiers(facts)
    total = facts.agg(relational.dsum("commitment_mm")).first()[0] or 0
    lines = [rule, "PENSION FUND ALTERNATIVE INVESTMENT TRACKER - SUMMARY", rule, "", f"Total commitment records: {facts.count():,}", f"Unique funds:             {funds.count():,}", f"Pension systems covered:  {investors.count()}", f"Total commitments:        ${total:,.0f}M", "", "Cross-system entity resolution:"]
    lines += [f"  Funds in {k}+ systems:  {tiers[f'held_by_{k}']}" for k in (2, 3, 4)] + [f"  Funds in all 5:       {tiers['held_by_5']}", "", "Per pension fund:"]
    lines += [f"  {r['p_name'] or '':20s} {r['n']:5d} records  ${r['mm'] or 0:>12,.0f}M" for r in _per_investor(star)]
    strategies = funds.where("sub_strategy IS NOT NULL").groupBy("sub_strategy").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "sub_strategy").collect()
    if strategies:
        lines += ["", "Strategy classification (keyword-based):", *[f"  {r['sub_strategy']:35s} {r['n']:4d} funds" for r in strategies]]
    return "\n".join([*lines, "", rule])


def summary_report(facts: DataFrame, funds: DataFrame, investors: DataFrame, star: DataFrame, flags: DataFrame, at: str) -> str:
    lines = ["# Pension Fund Alternative Investment Tracker - Summary Report", "", f"Generated: {at}", "", "```", summary_text(facts, funds, investors, star), "```", ""]
    lines += ["## Field Completeness", "", *table(("Field", "Populated", "%"), ((f, f"{n:,}", f"{p:.1f}%") for f, n, p in _completeness(facts)), 1)]
    counts = quality.queue_counts(flags).orderBy(F.desc("n"), "flag_type").collect()
    if counts:
        lines += [f"## Review Queue ({sum(r['n'] for r in counts)} unresolved)", "", *table(("Flag Type", "Count"), ((r["flag_type"], r["n"]) for r in counts), 1)]
    return "\n".join(lines)


def dataset_report(facts: DataFrame, funds: DataFrame, star: DataFrame) -> str:
    """What the dataset holds, for readers who do not query it: investors, shared funds, completeness."""
    tiers, investors = _tiers(facts), _per_investor(star)
    lines = ["# Alternative Investment Commitment Dataset", "", f"{facts.count():,} commitment records of {funds.count():,} funds, reported by {len(investors)} investors; {tiers['held_by_2']} funds are reported by two or more of them, {tiers['held_by_3']} by three or more.", "", "## Pension Funds Covered", ""]
    money = lambda v, d, u: f"${v / d:,.0f}{u}" if v else "N/A"
    shown = sorted(investors, key=lambda r: (-r["n"], r["p_name"] or ""))
    lines += table(("Pension Fund", "State", "Total AUM", "Records", "Commitment Total", "Vintages", "Data As-Of"), ((r["p_name"], r["state"], money(r["aum"], 1000, "B"), f"{r['n']:,}", money(r["mm"], 1, "M"), f"{r['first']}-{r['last']}" if r["first"] else "N/A", r["as_of"] or "N/A") for r in shown))
    return "\n".join([*lines, "## Field Completeness", "", *table(("Field", "Populated"), ((FIELDS[f], f"{p:.0f}%") for f, _, p in _completeness(facts)), 1)])


# Headings of a meeting's events, in order.
HEADINGS = {
    "investment_commitment": "INVESTMENT COMMITMENTS", "manager_selection": "MANAGER SELECTIONS", "personnel_change": "PERSONNEL CHANGES", "committee_assignment": "COMMITTEE ASSIGNMENTS", "policy_approval": "POLICY APPROVALS",
    "motion": "FORMAL MOTIONS", "performance_report": "PERFORMANCE METRICS", "dissent": "DISSENTING STATEMENTS", "public_comment": "PUBLIC COMMENT THEMES",
}


def _event_lines(e) -> list[str]:
    d, out = e["details"], [f"  * {e['summary']}"]
    if d.get("description"):
        out.append(f"    Strategy: {d['description'][:100]}")
    if d.get("relationship_since"):
        out.append(f"    History: Relationship since {d['relationship_since']}, {d['prior_fund_count']} prior funds, ${float(d['total_committed_mm']):,.0f}M total committed")
    if d.get("outcome"):
        out.append(f"    Outcome: {d['outcome'].replace('_', ' ').title()}" + (f" (dissent: {d['dissenter']})" if d.get("dissenter") else ""))
    if "sentiment" in d:
        out[0] += f" [sentiment: {d['sentiment']}]"
        out += [f'    "{d["statement_preview"][:200]}..."'] if d.get("statement_preview") else []
    return out


def meeting_report(heads: DataFrame, people: DataFrame, spans: DataFrame, events: DataFrame, document: object) -> str:
    """The report of one meeting: who was there, its sections and all its events by kind.

    heads: (doc_id, system, meeting_date); people, spans and events as `textevents` gives them. All rows are those of one document.
    """
    of = lambda df: df.where(F.col("doc_id") == document)
    head = of(heads).first()
    rule = "=" * 70
    lines = [rule, "BOARD MEETING INTELLIGENCE REPORT", rule, f"Pension Fund:  {head['system'] if head else 'Unknown'}", f"Meeting Date:  {head['meeting_date'] if head else ''}", f"Source:        {document}", "─" * 70]
    present = of(people).orderBy("role", "n").collect()
    members, staff = ([p for p in present if p["role"] == role] for role in ("member", "staff"))
    if members:
        lines += ["", f"ATTENDANCE ({len(members)} members, {len(staff)} staff)", "  Members: " + ", ".join(p["name"] for p in members)]
        titled = [p for p in staff if p["title"]]
        lines += ["  Key Staff:", *[f"    - {p['name']}, {p['title']}" for p in titled]] if titled else []
    parts = of(spans).orderBy("start").collect()
    if parts:
        lines += ["", f"SECTIONS ({len(parts)})", *[f"  - {s['title']} ({s['end'] - s['start']:,} chars)" for s in parts]]
    found = of(events).orderBy("at").collect()
    for kind, heading in HEADINGS.items():
        mine = [e for e in found if e["event_type"] == kind]
        if mine:
            lines += ["", f"{heading} ({len(mine)})", *[line for e in mine for line in _event_lines(e)]]
    return "\n".join([*lines, "", rule, f"Total events extracted: {len(found)}", rule])
