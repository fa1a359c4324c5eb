"""Landed files as tables: binary documents, text, JSON and YAML seeds, with content hashes and a registry of sources.

Fetching from the network is a separate landing job (`fetch`, gated); the engine reads what has landed, so a run can
be repeated without the network.
"""

from __future__ import annotations

import os
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allocata.functions.fund_names import normalized_firm


def content_hash(c: Column) -> Column:
    """SHA-256 of bytes, or of a text's UTF-8 bytes."""
    return F.sha2(c.cast("binary"), 256)


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content, source_hash) of landed documents."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).withColumn("source_hash", content_hash(F.col("content")))


def preferred_document(files: DataFrame, preferred: str, pattern: str, fallback: str, least_bytes: int = 10_000) -> DataFrame:
    """The one PDF to use of each folder: the preferred name, else the newest that matches the pattern and is large enough, else the fallback."""
    name = F.element_at(F.split("path", "/"), -1)
    priority = F.when(name == preferred, 1).when(name.rlike(pattern) & (F.col("length") > least_bytes), 2).when(name == fallback, 3)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    w = Window.partitionBy("folder").orderBy("priority", F.desc("modificationTime"), "path")
    pdf = F.decode(F.substring("content", 1, 5), "ISO-8859-1") == "%PDF-"
    return files.withColumn("folder", folder).withColumn("priority", priority).where(F.col("priority").isNotNull() & pdf).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn", "priority", "folder")


def require(df: DataFrame, what: str) -> DataFrame:
    """The table, or an error if it is empty: for sources that must have been landed by hand."""
    if df.isEmpty():
        raise FileNotFoundError(what)
    return df


def fetch(url: str, path: str, headers: dict[str, str] | None = None, timeout: float = 30.0, use_cache: bool = True) -> str:
    """Land one document: the cached copy if there is one, else a download written beside its final name and renamed."""
    if use_cache and os.path.exists(path):
        return path
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as r, open(path + ".part", "wb") as f:
        f.write(r.read())
    os.replace(path + ".part", path)
    return path


def pages_of(documents: DataFrame, reader: Callable[[bytes], list[str]]) -> DataFrame:
    """(path, page, text) of binary documents by a page reader (a PDF library where there is one)."""

    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame([(p, i, t) for p, c in zip(b["path"], b["content"], strict=True) for i, t in enumerate(reader(c), 1)], columns=["path", "page", "text"])

    return documents.select("path", "content").mapInPandas(run, "path string, page int, text string")


def summary_record(texts: DataFrame, patterns: dict[str, str], confidence: float = 0.70) -> DataFrame:
    """A fallback record per document when no table could be read: one number per pattern, with low confidence."""
    numbers = [F.replace(F.regexp_extract("text", p, 1), F.lit(","), F.lit("")).try_cast("double").alias(n) for n, p in patterns.items()]
    return texts.select(*[c for c in texts.columns if c != "text"], *numbers, F.lit("summary").alias("extraction_method"), F.lit(confidence).alias("extraction_confidence"))


def read_meetings(spark: SparkSession, path: str) -> DataFrame:
    """One row per meeting of a nested JSON file; an absent file is an empty table."""
    if not os.path.exists(path):
        return spark.createDataFrame([], "meeting_date string")
    return spark.read.option("multiLine", True).json(path).select(F.explode("meetings").alias("m")).select("m.*")


def read_seed(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a YAML seed: investors, firms, aliases, engagements. A missing file is an error. Curated by hand, so small."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    investors = [(p["id"], p["name"], p.get("full_name"), p.get("state")) for p in data.get("pension_funds", [])]
    firms = [tuple(x.get(k) for k in ("id", "name", "firm_type", "headquarters", "website_url", "notes")) for x in data.get("consulting_firms", [])]
    aliases = [(x["id"], a) for x in data.get("consulting_firms", []) for a in x.get("aliases", [])]
    names = ("consulting_firm_id", "pension_fund_id", "role", "mandate_scope", "start_date", "end_date", "is_current", "annual_fee_usd", "fee_basis", "contract_term_years", "source_url")
    text = [tuple(None if e.get(k) is None else str(e[k]) for k in names) for e in data.get("engagements", [])]
    engagements = spark.createDataFrame(text, ", ".join(f"{k} string" for k in names)).withColumns({
        "start_date": F.try_to_date("start_date"), "end_date": F.try_to_date("end_date"), "is_current": F.lower("is_current").try_cast("boolean"),
        "annual_fee_usd": F.col("annual_fee_usd").try_cast("double"), "contract_term_years": F.col("contract_term_years").try_cast("double"),
    })
    return {
        "pension_funds": spark.createDataFrame(investors, "id string, name string, full_name string, state string"),
        "consulting_firms": spark.createDataFrame(firms, "id string, name string, firm_type string, headquarters string, website_url string, notes string").withColumn("name_normalized", normalized_firm(F.col("name"))),
        "consulting_firm_aliases": spark.createDataFrame(aliases, "consulting_firm_id string, alias string"),
        "consulting_engagements": engagements,
    }


def seed_counts(seed: dict[str, DataFrame]) -> dict[str, int]:
    return {k: df.count() for k, df in seed.items()}


def read_excel(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """A spreadsheet as text columns; needs an Excel reader for pandas."""
    import pandas as pd

    frame = pd.read_excel(path, sheet_name=sheet, dtype=str)
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`{c}` string" for c in frame.columns))


@dataclass(frozen=True)
class Source:
    """A source of records: who it is, and how its landed documents become rows of the bronze schema."""

    ident: str
    name: str
    read: Callable[[SparkSession, str], DataFrame]
    default: bool = True


class Registry:
    """Sources by id; an unknown id is an error."""

    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}

    def add(self, source: Source) -> Source:
        self._sources[source.ident] = source
        return source

    def get(self, ident: str) -> Source:
        return self._sources[ident]

    def defaults(self) -> list[Source]:
        return [s for s in self._sources.values() if s.default]

    def all(self) -> list[Source]:
        return list(self._sources.values())

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s.ident, s.name) for s in self._sources.values()], "pension_fund_id string, name string")
