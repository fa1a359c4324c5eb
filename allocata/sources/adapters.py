"""The registered sources: how each one's landed document becomes records of one schema.

A source is data, not code: its layout names what stands in which column, how amounts, rates and vintages are written and
which rows are none. `word_records` and `text_records` read any of them; the HTML source uses `html.holdings`. Documents
land as HTML, as positioned words or as page texts (a PDF reader of the caller's, see `landing.pages_of`, makes both).

Defined results: rows without a name or an accepted vintage drop out; unreadable numbers are null; a landing folder
without the source's documents is an error of that source alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allocata.functions import parsers as P
from allocata.sources import html, landing, layout

RECORD = ("fund_name_raw", "vintage_year", "commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple")


@dataclass(frozen=True)
class Layout:
    """Column order and reading rules of a source's page; `boundaries` None means that the header names the columns."""

    ident: str
    name: str
    columns: tuple[str, ...]
    boundaries: tuple[int, ...] | None
    vintage: str  # what the vintage cell must look like
    rejected: str  # words of a name that make the row none
    amount: Callable[[Column], Column]
    confidence: float
    document: str
    rate: Callable[[Column], Column] | None = None
    multiple: str = "stated"
    scaled: bool = False
    start: str | None = None
    stop: str | None = None
    as_of: str | None = None
    default: bool = True


def _short_year(c: Column) -> Column:
    return P.two_digit_year(F.regexp_extract(c, r"/(\d{2})$", 1))


def _no_rate(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda c: P.percentage(F.when(~F.lower(c).isin(*words), c))


# The sources with their columns, boundaries, rejected rows and confidences.
LAYOUTS = (
    Layout("calstrs", "CalSTRS", ("fund_name", "vintage", "commitment", "called", "distributed", "value", "irr"), (240, 290, 360, 430, 500, 560), r"^(19|20)\d{2}$", r"(?!)", lambda c: P.dollar_amount(P.rejoin_split_number(c)), 0.95, "CalSTRS Private Equity Portfolio Performance", P.percent_points, "zero"),
    Layout(
        "wsib", "WSIB", ("fund_name", "vintage", "commitment", "called", "unfunded", "value", "distributed", "total", "multiple", "gain", "irr"), (265, 310, 355, 395, 445, 485, 525, 558, 595, 620), r"^(\d{1,2}/\d{1,2}/\d{4}|N/A)", r"subtotal|total|strategy|summary",
        P.dollar_amount, 0.90, "WSIB Private Equity IRR Report", P.percentage, "positive",
    ),
    Layout("oregon", "Oregon PERS", ("vintage", "fund_name", "commitment", "called", "distributed", "value", "multiple", "irr"), (70, 245, 305, 365, 420, 465, 510), r"^(19|20)\d{2}$", r"total|subtotal|summary", P.amount_in_millions, 0.95, "OPERF Private Equity Portfolio Q3 2025", _no_rate(("n.m.", "n.m", "n/m"))),
    Layout(
        "ny_common", "New York State Common Retirement Fund", ("fund_name", "vintage", "commitment", "called", "distributed", "value", "total"), (250, 295, 355, 415, 472, 530), r"^\d{2}/\d{2}/\d{2}$", r"total|subtotal|summary|private equity investments",
        lambda c: P.dollar_amount(P.rejoin_split_number(c)), 0.95, "NY Common Retirement Fund Asset Listing 2025", None, "total", scaled=True, start="PRIVATE EQUITY INVESTMENTS", stop="FUND OF FUNDS", as_of="2025-03-31",
    ),
    Layout(
        "florida_sba", "Florida State Board of Administration", ("vintage", "commitment", "paid_in", "distributed", "value", "tvpi", "irr"), None, r"(19|20)\d{2}", r"total|subtotal|summary|fund name|benchmark|reporting|currency|private equity|cash flow|page|as of",
        P.amount_by_size, 0.90, "FL SBA PE Performance Report", P.percentage, default=False,
    ),
)
HTML_SOURCE = ("calpers", "CalPERS")
TEXT_SOURCE = ("texas_trs", "Texas Teacher Retirement System")
#: Names of the cells that a header may call otherwise.
SAME = {"paid_in": "called", "tvpi": "multiple"}


def word_records(words: DataFrame, source: Layout, pages: DataFrame | None = None) -> DataFrame:
    """(doc_id, page, row, record columns...) of positioned words; pages (doc_id, page, text) bound the section where the source has one."""
    if source.start and pages is not None:
        words = words.join(layout.page_range(pages, source.start, source.stop).select("doc_id", "page"), ["doc_id", "page"], "left_semi")
    if source.boundaries is None:
        rows = layout.detected_layout(words)
        cell = {SAME.get(c, c): P.rejoin_split_number(F.try_element_at("cells", F.lit(c))) for c in source.columns} | {"fund_name": F.col("fund_name")}
    else:
        b = source.boundaries
        rows = layout.scaled_layout(words, b) if source.scaled else layout.rows_of(words, F.array(*[F.lit(float(x)) for x in b]), len(b) + 1)
        cell = {c: P.strip(F.col(f"c{i}")) for i, c in enumerate(source.columns)}
    said, name = F.col("vintage"), F.col("fund_name")
    year = _short_year(said) if source.scaled else F.regexp_extract(said, r"((?:19|20)\d{2})\D*$", 1).try_cast("int")
    # Cells, then numbers, then what is derived: each step is a projection of its own, so that no text is parsed twice.
    texts = rows.select("doc_id", "page", "row", *[c.alias(k) for k, c in cell.items()]).where((F.coalesce(name, F.lit("")) != "") & said.rlike(source.vintage) & ~F.lower(name).rlike(source.rejected))
    amounts = [c for c in ("commitment", "called", "distributed", "value", "total") if c in cell]
    rate = source.rate(F.col("irr")) if source.rate else F.lit(None).cast("double")
    stated = P.multiple(F.col("multiple")) if "multiple" in cell else F.lit(None).cast("double")
    numbers = texts.select("doc_id", "page", "row", "fund_name", year.alias("year"), *[source.amount(F.col(c)).alias(c) for c in amounts], rate.alias("rate"), stated.alias("stated"))
    called, out, left = F.col("called"), F.col("distributed"), F.col("value")
    multiple = {
        "stated": F.col("stated"), "positive": P.positive_multiple(F.col("stated")), "zero": P.derived_multiple(F.coalesce(out, F.lit(0.0)) + F.coalesce(left, F.lit(0.0)), called, positive_total=True),
        "total": P.derived_multiple(F.col("total"), called, positive_total=True),
    }[source.multiple]
    return numbers.select(
        "doc_id", "page", "row", F.col("fund_name").alias("fund_name_raw"), F.col("year").alias("vintage_year"), F.col("commitment").alias("commitment_mm"), called.alias("capital_called_mm"), out.alias("capital_distributed_mm"),
        left.alias("remaining_value_mm"), F.col("rate").alias("net_irr"), multiple.alias("net_multiple"), F.lit(source.document).alias("source_document"), F.lit("deterministic_pdf").alias("extraction_method"), F.lit(source.confidence).alias("extraction_confidence"),
    )


def is_fund_table(text: Column) -> Column:
    """Whether a page is about private equity or markets and holds a year with an amount behind it."""
    low = F.lower(text)
    return F.contains(low, F.lit("private")) & (F.contains(low, F.lit("equity")) | F.contains(low, F.lit("markets"))) & text.rlike(r"20[012]\d.*[$]?\d+[.,]\d+")


def text_records(pages: DataFrame) -> DataFrame:
    """(doc_id, page, row, record columns...) of pages (doc_id, page, text) whose lines are name, year and amounts in millions."""
    lines = pages.where(is_fund_table(F.col("text"))).select("doc_id", "page", F.posexplode(F.split("text", "\n")).alias("row", "text"))
    found = layout.name_year_amounts(lines)
    amount = lambda c: P.amount_in_millions(F.col(f"{c}_text"))
    return found.select(
        "doc_id", "page", "row", F.col("fund_name").alias("fund_name_raw"), "vintage_year", amount("commitment").alias("commitment_mm"), amount("called").alias("capital_called_mm"), amount("distributed").alias("capital_distributed_mm"),
        amount("remaining").alias("remaining_value_mm"), P.percentage(F.col("irr_text")).alias("net_irr"), P.multiple(F.col("multiple_text")).alias("net_multiple"), F.lit("TRS IMC Board Book").alias("source_document"),
        F.lit("deterministic_pdf").alias("extraction_method"), F.lit(0.90).alias("extraction_confidence"),
    )


def total_records(pages: DataFrame) -> DataFrame:
    """One summary record of a document that states only the total value and the unfunded capital of private equity, in dollars."""
    pattern = r"Private\s+Equity\s+[$]?\s*([\d,]+)\s+[$]?\s*([\d,]+)"
    value, open_ = (F.replace(F.regexp_extract("text", pattern, i), F.lit(","), F.lit("")).try_cast("double") / 1e6 for i in (1, 2))
    hit = F.contains("text", F.lit("Net Asset Value")) & F.contains("text", F.lit("Unfunded Capital")) & F.col("text").rlike(pattern)
    first = pages.where(hit).groupBy("doc_id").agg(F.min_by("text", "page").alias("text"), F.min("page").alias("page"))
    none = F.lit(None).cast("double")
    return first.select(
        "doc_id", "page", F.lit(0).alias("row"), F.lit("Texas TRS Private Equity Portfolio (Summary)").alias("fund_name_raw"), F.lit(None).cast("int").alias("vintage_year"), (value + open_).alias("commitment_mm"), value.alias("capital_called_mm"),
        none.alias("capital_distributed_mm"), value.alias("remaining_value_mm"), none.alias("net_irr"), none.alias("net_multiple"), F.lit("TRS ACFR 2024 - Summary Only").alias("source_document"), F.lit("deterministic_pdf").alias("extraction_method"), F.lit(0.70).alias("extraction_confidence"),
    )


def _dated(records: DataFrame, pages: DataFrame, fallback: str | None = None) -> DataFrame:
    """Records with the date that the first pages of their document state."""
    said = pages.where("page <= 5").withColumn("d", P.as_of_date(F.col("text"))).where("d IS NOT NULL").groupBy("doc_id").agg(F.min_by("d", "page").alias("as_of_date"))
    return records.join(said, "doc_id", "left").withColumn("as_of_date", F.coalesce("as_of_date", F.try_to_date(F.lit(fallback))))


def _read_words(source: Layout) -> Callable[[SparkSession, str], DataFrame]:
    def read(spark: SparkSession, path: str) -> DataFrame:
        words, pages = spark.read.parquet(f"{path}/{source.ident}/words"), spark.read.parquet(f"{path}/{source.ident}/pages")
        return _dated(word_records(landing.require(words, source.ident), source, pages), pages, source.as_of)

    return read


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    """Fund rows of board books; where a document has none, its totals."""
    pages = landing.require(spark.read.parquet(f"{path}/{TEXT_SOURCE[0]}/pages"), TEXT_SOURCE[0])
    rows = text_records(pages)
    return rows.unionByName(total_records(pages).join(rows.select("doc_id").distinct(), "doc_id", "left_anti")).withColumn("as_of_date", F.lit(None).cast("date"))


def _read_html(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.text(f"{path}/{HTML_SOURCE[0]}/*.html", wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("html"))
    return html.holdings(landing.require(pages, HTML_SOURCE[0]), "doc_id", "html")


def registry() -> landing.Registry:
    """All sources; the last two need documents landed by hand and are not in the default set."""
    r = landing.Registry()
    r.add(landing.Source(*HTML_SOURCE, _read_html))
    for source in (s for s in LAYOUTS if s.default):
        r.add(landing.Source(source.ident, source.name, _read_words(source)))
    r.add(landing.Source(*TEXT_SOURCE, _read_text, default=False))
    for source in (s for s in LAYOUTS if not s.default):
        r.add(landing.Source(source.ident, source.name, _read_words(source), default=False))
    return r
