"""Ingest from landed sources to the store: skip what is unchanged, parse, resolve, derive, upsert, flag.

Each source is one DataFrame job; a source that fails is reported and does not stop the others, and its run is logged
as an error with the hash of what it read, so the same content is tried again (only completed runs are skipped).
"""

from __future__ import annotations

import datetime as dt
import os
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata.functions.fund_names import manager_from_name, normalized_name, strategy_class
from allocata.functions.managers import DEFAULT_STRATEGY, KNOWN_MANAGERS
from allocata.functions.parsers import derived_dpi
from allocata.operators import quality, resolve, store
from allocata.session import cut
from allocata.sources.landing import Registry

SCHEMAS = {
    "commitments": "id string, pension_fund_id string, fund_key string, fund_name_raw string, vintage_year int, commitment_mm double, capital_called_mm double, capital_distributed_mm double, remaining_value_mm double, net_irr double, net_multiple double, dpi double, as_of_date date, extraction_method string, extraction_confidence double, created_at string, updated_at string",
    "funds": "fund_key string, fund_name string, fund_name_raw string, general_partner string, vintage_year int, asset_class string, sub_strategy string, created_at string, updated_at string",
    "fund_aliases": "alias string, fund_key string",
    "extraction_runs": "id string, pension_fund_id string, started_at string, completed_at string, status string, errors string, records_extracted int, records_updated int, records_flagged int, source_hash string",
    "gp_aliases": "alias string, canonical_name string",
    "pension_funds": "id string, name string, full_name string, state string",
    "consulting_firms": "id string, name string, name_normalized string, firm_type string, headquarters string, website_url string, notes string",
    "consulting_firm_aliases": "consulting_firm_id string, alias string",
    "consulting_engagements": "id string, consulting_firm_id string, pension_fund_id string, role string, mandate_scope string, start_date date, end_date date, is_current boolean, annual_fee_usd double, fee_basis string, contract_term_years double, source_url string",
    "review_queue": "commitment_id string, flag_type string, flag_detail string, resolved boolean",
}
RECORD = ("fund_name_raw", "general_partner", "vintage_year", "commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "dpi", "as_of_date", "extraction_method", "extraction_confidence")


class Pipeline:
    def __init__(self, spark: SparkSession, path: str, registry: Registry):
        self.spark, self.registry = spark, registry
        self.tables = {n: store.Table(spark, os.path.join(path, n), s).create() for n, s in SCHEMAS.items()}

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def run(self, landing: str, idents: list[str] | None = None, force: bool = False) -> dict[str, dict]:
        """Result per source: status (completed, skipped or error) with counts or the error."""
        sources = [self.registry.get(i) for i in idents] if idents else self.registry.defaults()
        out = {}
        for s in sources:
            try:
                out[s.ident] = self._one(s, landing, force)
            except Exception as e:  # one source's failure is that source's result
                out[s.ident] = {"status": "error", "error": str(e), "trace": traceback.format_exc()}
        return out

    def _one(self, source, landing: str, force: bool) -> dict:
        now = dt.datetime.now(dt.UTC).isoformat()
        records = source.read(self.spark, landing)
        # The hash of the records as a set: the order in which files were read does not matter.
        digest = records.agg(F.sha2(F.concat_ws(",", F.sum(F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in records.columns]), F.lit(2**40))).cast("string"), F.count(F.lit(1)).cast("string")), 256)).first()[0]
        last = store.latest_runs(self.read("extraction_runs").where("status = 'completed'")).where(F.col("pension_fund_id") == source.ident)
        if not force and last.where(F.col("source_hash") == digest).count():
            return {"status": "skipped"}
        run_id = f"{source.ident}-{now}"
        started = self.spark.createDataFrame([(run_id, source.ident, now, None, "running", None, 0, 0, 0, digest)], SCHEMAS["extraction_runs"])
        log = self.tables["extraction_runs"]
        log.write(cut(log.read().unionByName(started)))
        try:
            counts = self._merge(source.ident, records, now)
        except Exception as e:
            log.write(cut(store.finish_run(log.read(), run_id, "error", {}, F.lit(now), str(e)[:1000])))
            raise
        log.write(cut(store.finish_run(log.read(), run_id, "completed", counts, F.lit(dt.datetime.now(dt.UTC).isoformat()))))
        return {"status": "completed"} | counts

    def _merge(self, ident: str, records: DataFrame, now: str) -> dict[str, int]:
        missing = [c for c in RECORD if c not in records.columns]
        bronze = records.withColumns({c: F.lit(None).cast("string" if c in ("general_partner", "extraction_method") else "date" if c == "as_of_date" else "int" if c == "vintage_year" else "double") for c in missing}).select(*RECORD)
        bronze = bronze.where("trim(fund_name_raw) <> ''").withColumn("dpi", derived_dpi(F.col("dpi"), F.col("capital_distributed_mm"), F.col("capital_called_mm")))
        arrived = cut(bronze.withColumn("arrival", F.concat_ws("|", F.lit("1"), F.lit(now), F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RECORD]), 256))).dropDuplicates(["arrival"]))
        funds = self.read("funds")
        known = funds.select(F.concat_ws("|", F.lit("0"), "created_at", "fund_key").alias("arrival"), F.col("fund_name").alias("fund_name_raw"), "general_partner", "vintage_year")
        keyed = arrived.select("arrival", "fund_name_raw", "general_partner", "vintage_year").unionByName(known)
        links = cut(resolve.resolve(keyed, self.read("fund_aliases")).where("arrival LIKE '1|%'").select("arrival", "fund_key", "match_type"))
        rows = cut(arrived.join(links, "arrival").where("fund_key IS NOT NULL").select(
            F.sha2(F.concat_ws("\x1f", F.lit(ident), "fund_key", F.coalesce(F.col("as_of_date").cast("string"), F.lit("\x00"))), 256).alias("id"),
            F.lit(ident).alias("pension_fund_id"), *[c for c in arrived.columns if c not in ("arrival", "general_partner")], "general_partner", "fund_key", "match_type", F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"),
        ))
        new = rows.where("match_type = 'new'").groupBy("fund_key").agg(F.min_by(F.struct("fund_name_raw", "general_partner", "vintage_year"), "fund_name_raw").alias("f")).select("fund_key", "f.*")
        named = new.withColumn("s", strategy_class(F.col("fund_name_raw"), DEFAULT_STRATEGY, KNOWN_MANAGERS)).select(
            "fund_key", normalized_name(F.col("fund_name_raw")).alias("fund_name"), "fund_name_raw", F.coalesce("general_partner", manager_from_name(normalized_name(F.col("fund_name_raw")), KNOWN_MANAGERS)).alias("general_partner"),
            "vintage_year", "s.asset_class", "s.sub_strategy", F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"),
        )
        # A fund that a later record completes (manager, vintage) is updated; its names and its creation stay those of the first.
        seen = rows.where("match_type <> 'new'").groupBy("fund_key").agg(F.min("general_partner").alias("general_partner"), F.min("vintage_year").alias("vintage_year"))
        stated = seen.join(funds.select("fund_key", "fund_name", "fund_name_raw", "asset_class", "sub_strategy", "created_at"), "fund_key").withColumn("updated_at", F.lit(now)).select(*named.columns)
        before = self.read("commitments").select("id")
        updated = rows.select("id").distinct().join(before, "id", "left_semi").count()
        self.tables["funds"].write(cut(store.upsert(funds, named.unionByName(stated), ["fund_key"], keep=("fund_name", "fund_name_raw", "created_at"), fill=True)))
        managers = named.where("general_partner IS NOT NULL").select(F.col("general_partner").alias("alias"), normalized_name(F.col("general_partner")).alias("canonical_name"))
        self.tables["gp_aliases"].write(cut(store.insert_ignore(self.read("gp_aliases"), managers, ["alias"])))
        aliases = rows.where("match_type = 'fuzzy'").select(F.col("fund_name_raw").alias("alias"), "fund_key")
        self.tables["fund_aliases"].write(cut(store.insert_ignore(self.read("fund_aliases"), aliases, ["alias"])))
        self.tables["commitments"].write(cut(store.upsert(self.read("commitments"), rows, ["id"], keep=("created_at",), recency=F.col("extraction_confidence"))))
        flags = quality.ingest_flags(rows).unionByName(rows.where("match_type = 'fuzzy'").select(F.col("id").alias("commitment_id"), F.lit("fuzzy_match").alias("flag_type"), F.col("fund_name_raw").alias("flag_detail")))
        queue = self.read("review_queue")
        self.tables["review_queue"].write(cut(store.insert_ignore(queue, flags.withColumn("resolved", F.lit(False)), ["commitment_id", "flag_type", "flag_detail"])))
        return {"records_extracted": rows.count(), "records_updated": updated, "records_flagged": flags.count()}

    def seed(self, tables: dict[str, DataFrame]) -> dict[str, int]:
        """Loads a seed of investors, firms, aliases and engagements; known values are never erased. Rows of each after loading."""
        firms = tables["consulting_firms"].select("id", "name", "name_normalized", "firm_type", "headquarters", "website_url", "notes")
        self._merge_rows("pension_funds", tables["pension_funds"], ["id"])
        self._merge_rows("consulting_firms", firms, ["id"])
        known = self.read("consulting_firm_aliases")
        self.tables["consulting_firm_aliases"].write(cut(store.insert_ignore(known, tables["consulting_firm_aliases"], ["alias"])))
        self.engage(tables["consulting_engagements"])
        return {n: self.read(n).count() for n in ("pension_funds", "consulting_firms", "consulting_firm_aliases", "consulting_engagements")}

    def _merge_rows(self, name: str, rows: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> None:
        self.tables[name].write(cut(store.upsert(self.read(name), rows, keys, keep=keep, fill=True)))

    def engage(self, records: DataFrame) -> None:
        """Engagements merged by (firm, investor, role, start), missing starts compared as equal; the id stays that of the first."""
        keys = ["consulting_firm_id", "pension_fund_id", "role", "start_date"]
        self._merge_rows("consulting_engagements", records.withColumn("id", store.natural_key(*keys)), keys, keep=("id",))

    def engage_named(self, records: DataFrame) -> int:
        """Engagements of a source that names its firms: resolved by name, alias or likeness, fuzzy names become aliases; the number of records without a firm."""
        firms, aliases = self.read("consulting_firms"), self.read("consulting_firm_aliases")
        found = cut(resolve.firm_matches(records.select("firm_name"), firms, aliases.select(F.col("consulting_firm_id").alias("firm_id"), "alias")))
        fuzzy = found.where("match_type = 'fuzzy'").select(F.col("firm_id").alias("consulting_firm_id"), F.col("firm_name").alias("alias"))
        self.tables["consulting_firm_aliases"].write(cut(store.insert_ignore(aliases, fuzzy, ["alias"])))
        self.engage(records.join(found.select("firm_name", F.col("firm_id").alias("consulting_firm_id")), "firm_name"))
        return records.join(found, "firm_name", "left_anti").count()
