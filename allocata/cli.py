"""Command line: ingest, queries, exports and reports. `python -m allocata.cli --help`.

`--data` is a folder of Parquet tables (queries, exports, reports); `--store` is the folder of the pipeline's own tables
(`run`, `resolve-fuzzy`, `audit-links`, `seed-consultants`, `consultants`).
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata import reports, sinks
from allocata.operators import engagements, quality, relational, resolve
from allocata.pipeline import Pipeline
from allocata.plans import catalog, metrics
from allocata.session import cut, local_session, table
from allocata.sources import landing
from allocata.sources.adapters import registry

EXPORTS = ("fund_summary", "top_funds", "investor_pivot", "performance_by_vintage", "gp_leaderboard", "linked_comparison", "commitment_trends", "gp_penetration", "name_pattern_filter", "performance_band", "quota_sample")


def _flags(facts: DataFrame) -> DataFrame:
    found = quality.range_flags(facts, metrics.VINTAGE_TO).unionByName(quality.low_completeness(facts)).unionByName(quality.ingest_flags(facts))
    return found.withColumn("resolved", F.lit(False))


def report(spark: SparkSession, data: str, kind: str) -> str:
    """Text of one report over a data folder."""
    facts, funds, investors = (table(spark, data, n) for n in ("commitments", "funds", "pension_funds"))
    star, at = relational.star(facts, funds, investors), dt.datetime.now(dt.UTC).isoformat()[:19]
    if kind == "quality":
        flags = cut(_flags(facts))
        return reports.quality_report(facts, star, flags, flags.count(), at)
    if kind == "cross-fund-report":
        return reports.cross_fund_report(star, facts)
    if kind == "dataset":
        return reports.dataset_report(facts, funds, star)
    return reports.summary_report(facts, funds, investors, star, _flags(facts), at)


def fuzzy_reviews(pipe: Pipeline) -> DataFrame:
    """Open fuzzy links with the alias and the fund's name: (commitment_id, alias, fund_name)."""
    queue = pipe.read("review_queue").where("flag_type = 'fuzzy_match' AND NOT resolved")
    facts = pipe.read("commitments").select(F.col("id").alias("commitment_id"), "fund_key")
    return queue.select("commitment_id", F.col("flag_detail").alias("alias")).join(facts, "commitment_id").join(pipe.read("funds").select("fund_key", "fund_name"), "fund_key").select("commitment_id", "alias", "fund_name")


def resolve_fuzzy(pipe: Pipeline) -> tuple[int, int]:
    """Closes the open fuzzy links that are safe; (closed, remaining)."""
    reviews = cut(fuzzy_reviews(pipe))
    safe = cut(resolve.auto_resolvable(reviews, "alias", "fund_name").select("commitment_id", F.col("alias").alias("flag_detail"), F.lit("fuzzy_match").alias("flag_type")).distinct())
    queue = pipe.read("review_queue")
    hit = safe.withColumn("_safe", F.lit(True))
    closed = queue.join(hit, ["commitment_id", "flag_type", "flag_detail"], "left").withColumn("resolved", F.col("resolved") | F.coalesce("_safe", F.lit(False))).select(*queue.columns)
    pipe.tables["review_queue"].write(cut(closed))
    n = safe.count()
    return n, reviews.count() - n


def audit_links(pipe: Pipeline) -> dict[str, object]:
    """Numbers of aliases and of suspect ones, the suspects, and the tiers of shared funds."""
    links = pipe.read("fund_aliases").join(pipe.read("funds").select("fund_key", "fund_name"), "fund_key")
    suspects = resolve.suspect_links(links, "alias", "fund_name").select("alias", "fund_name", "token_ratio", "ratio")
    tiers = relational.cross_link_tiers(pipe.read("commitments").withColumnRenamed("fund_key", "fund_id")).first().asDict()
    return {"aliases": links.count(), "suspect": suspects.count(), "suspects": suspects, "tiers": tiers}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="allocata")
    parser.add_argument("--data", help="folder with one Parquet table per name")
    parser.add_argument("--store", help="folder of the pipeline's tables")
    sub = parser.add_subparsers(dest="command", required=True)
    query = sub.add_parser("query", help="run one query of the catalogue")
    query.add_argument("name", choices=sorted(catalog.QUERIES))
    query.add_argument("--out", help="write Parquet here instead of showing rows")
    sub.add_parser("export", help="write the standard exports as CSV and the reports").add_argument("out")
    for name, text in (("quality", "flags and completeness"), ("summary-stats", "totals and tiers"), ("cross-fund-report", "widest spreads between investors"), ("dataset", "description of the dataset"), ("status", "latest load of each investor"), ("list", "names of all queries")):
        sub.add_parser(name, help=text)
    sub.add_parser("spot-check", help="a stratified sample of records").add_argument("--count", type=int, default=20)
    run = sub.add_parser("run", help="ingest landed sources")
    run.add_argument("--landing", required=True)
    run.add_argument("--fund", action="append", help="one source by id; repeatable")
    run.add_argument("--all", action="store_true", help="all registered sources, not only the default ones")
    run.add_argument("--force", action="store_true", help="read unchanged content again")
    sub.add_parser("resolve-fuzzy", help="close fuzzy links that are safe")
    sub.add_parser("audit-links", help="aliases whose names look unlike their funds")
    sub.add_parser("seed-consultants", help="load the seed of consulting firms").add_argument("seed")
    sub.add_parser("consultants", help="engagements by investor").add_argument("--fund")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return
    spark = local_session()
    q = catalog.QUERIES
    needs_store = args.command in ("run", "resolve-fuzzy", "audit-links", "seed-consultants", "consultants")
    if needs_store and not args.store or not needs_store and not args.data:
        parser.error("--store is needed" if needs_store else "--data is needed")
    pipe = Pipeline(spark, args.store, registry()) if needs_store else None
    if args.command == "query":
        df = q[args.name](spark, args.data)
        df.write.mode("overwrite").parquet(args.out) if args.out else df.show(50, truncate=60)
    elif args.command == "export":
        for n in EXPORTS:
            sinks.write_csv(q[n](spark, args.data), f"{args.out}/{n}")
        os.makedirs(args.out, exist_ok=True)
        for kind in ("quality", "cross-fund-report", "summary-stats", "dataset"):
            with open(f"{args.out}/{kind}.md", "w", encoding="utf-8") as f:
                f.write(report(spark, args.data, kind))
    elif args.command in ("quality", "summary-stats", "cross-fund-report", "dataset"):
        print(report(spark, args.data, args.command))
    elif args.command == "status":
        print(sinks.markdown_table(q["status_listing"](spark, args.data), "Status"))
    elif args.command == "spot-check":
        relational.stratified_sample(table(spark, args.data, "commitments"), args.count).show(args.count, truncate=False)
    elif args.command == "run":
        idents = args.fund or ([s.ident for s in pipe.registry.all()] if args.all else None)
        for ident, result in pipe.run(args.landing, idents, args.force).items():
            print(f"{ident}: " + ", ".join(f"{k} {v}" for k, v in result.items() if k != "trace"))
    elif args.command == "resolve-fuzzy":
        closed, remaining = resolve_fuzzy(pipe)
        print(f"Auto-resolved: {closed}\nRemaining for manual review: {remaining}")
    elif args.command == "audit-links":
        found = audit_links(pipe)
        print(f"Total fuzzy aliases: {found['aliases']}\nSuspect matches: {found['suspect']}\n" + "\n".join(f"{k}: {v}" for k, v in found["tiers"].items()))
        print(sinks.markdown_table(found["suspects"], "Suspects"))
    elif args.command == "seed-consultants":
        for name, n in pipe.seed(landing.read_seed(spark, args.seed)).items():
            print(f"{name}: {n}")
    elif args.command == "consultants":
        rows = engagements.joined(pipe.read("consulting_engagements"), pipe.read("consulting_firms"), pipe.read("pension_funds"), args.fund)
        print(sinks.markdown_table(engagements.listing(rows).orderBy("pension_fund_name"), "Consulting engagements"))


if __name__ == "__main__":
    main()
