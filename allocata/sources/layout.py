"""From positioned words of a page to table rows: one relational pipeline for all layouts.

Input words: (doc_id, page, page_width, idx, text, x0, top). Words are clustered to rows by rounding `top` to the row
height (half to even), ordered by (x0, idx), put into the column given by how many boundaries lie at or left of x0, and joined.
A row is one group, so no group holds more than the words of one line.

Defined results: null texts are skipped; a page without words has no rows; words with equal x0 keep their input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Column boundaries in points, by layout; the scaled one is for pages 612 points wide.
BOUNDARIES = {
    "seven_columns": (240, 290, 360, 430, 500, 560),
    "eleven_columns": (265, 310, 355, 395, 445, 485, 525, 558, 595, 620),
    "eight_columns": (70, 245, 305, 365, 420, 465, 510),
}
PAGE_WIDTH = 612.0
ROW_HEIGHT = 3
# Header words and the column they announce.
HEADER_WORDS = {
    "vintage": "vintage", "year": "vintage", "commitment": "commitment", "committed": "commitment", "paid": "paid_in", "paid-in": "paid_in", "contributed": "paid_in", "called": "paid_in",
    "distribution": "distributed", "distributed": "distributed", "value": "value", "valuation": "value", "market": "value", "nav": "value", "tvpi": "tvpi", "multiple": "tvpi", "irr": "irr",
}


def row_key(top: Column, height: Column | int = ROW_HEIGHT) -> Column:
    h = height if isinstance(height, Column) else F.lit(height)
    return F.bround(top / h) * h


def scaled_boundaries(boundaries: tuple[int, ...], width: Column) -> Column:
    """Boundaries scaled to the page's width, cut to whole points."""
    return F.array(*[(F.lit(b) * width / PAGE_WIDTH).cast("int").cast("double") for b in boundaries])


def rows_of(words: DataFrame, boundaries: Column, n_columns: int, height: Column | int = ROW_HEIGHT) -> DataFrame:
    """(doc_id, page, row, c0..cN): the text of every column of every row."""
    placed = words.where("text IS NOT NULL").select(
        "doc_id", "page", row_key(F.col("top"), height).alias("row"), F.col("x0"), F.col("idx"), "text",
        F.size(F.filter(boundaries, lambda b: F.col("x0") >= b)).alias("c"),
    )
    # Pre-sorted structs keep the order of words inside a column.
    cells = [F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == i, F.struct("x0", "idx", "text")))), lambda w: w["text"]), " ") for i in range(n_columns)]
    return placed.groupBy("doc_id", "page", "row").agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)])


def fixed_layout(words: DataFrame, layout: str) -> DataFrame:
    b = BOUNDARIES[layout]
    return rows_of(words, F.array(*[F.lit(float(x)) for x in b]), len(b) + 1)


def scaled_layout(words: DataFrame, boundaries: tuple[int, ...]) -> DataFrame:
    """Boundaries and row height follow the page's width."""
    height = F.greatest((F.lit(ROW_HEIGHT) * F.col("page_width") / PAGE_WIDTH).cast("int"), F.lit(1))
    return rows_of(words, scaled_boundaries(boundaries, F.col("page_width")), len(boundaries) + 1, height)


def detected_boundaries(words: DataFrame) -> DataFrame:
    """(doc_id, page, boundaries, names) of pages whose header names vintage, commitment and so on.

    The first word of each column counts; the first boundary lies 10 points before the first column, others midway.
    """
    known = F.create_map(*[F.lit(x) for kv in HEADER_WORDS.items() for x in kv])
    named = words.withColumn("name", F.try_element_at(known, F.lower(F.trim("text")))).where("name IS NOT NULL")
    first = named.groupBy("doc_id", "page", "name").agg(F.min_by("x0", "idx").alias("x0"))
    before = F.lag("x0").over(Window.partitionBy("doc_id", "page").orderBy("x0", "name"))
    edges = first.withColumn("edge", F.coalesce((before + F.col("x0")) / 2, F.col("x0") - 10))
    out = edges.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("x0", "name", "edge"))).alias("h"))
    names = F.transform("h", lambda e: e["name"])
    return out.where(F.array_contains(names, "vintage") & F.array_contains(names, "commitment")).select("doc_id", "page", F.transform("h", lambda e: e["edge"]).alias("boundaries"), names.alias("names"))


def detected_layout(words: DataFrame) -> DataFrame:
    """(doc_id, page, row, fund_name, cells): cells maps detected column names to texts; rows without a name drop out."""
    placed = words.where("text IS NOT NULL").join(detected_boundaries(words), ["doc_id", "page"])
    column = F.size(F.filter("boundaries", lambda b: F.col("x0") >= b))
    cell = placed.select("doc_id", "page", row_key(F.col("top")).alias("row"), F.when(column == 0, F.lit("")).otherwise(F.try_element_at("names", column)).alias("name"), F.struct("x0", "idx", "text").alias("w"))
    joined = cell.groupBy("doc_id", "page", "row", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["text"]), " ").alias("t"))
    rows = joined.groupBy("doc_id", "page", "row").agg(F.map_from_entries(F.collect_list(F.struct("name", "t"))).alias("cells"))
    return rows.select("doc_id", "page", "row", F.try_element_at("cells", F.lit("")).alias("fund_name"), "cells").where(F.length("fund_name") >= 3)


def page_range(pages: DataFrame, start: str, stop: str) -> DataFrame:
    """Pages from the first that holds `start` to the last before one that holds `stop` (whatever its case) at or after it."""
    w = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.max(F.contains("text", F.lit(start)).cast("int")).over(w)
    flagged = pages.withColumn("begun", begun).withColumn("ended", (F.col("begun") == 1) & F.contains(F.upper("text"), F.lit(stop.upper())))
    return flagged.withColumn("over", F.max(F.col("ended").cast("int")).over(w)).where("begun = 1 AND over = 0").select(*pages.columns)


def holds_fund_data(text: Column) -> Column:
    """Whether a page looks like rows of funds: a legal form or `partners`, and a number with a separator."""
    return text.rlike(r"(?i)l\.p\.|, lp|partners") & text.rlike(r"\d+[.,]\d+")


def name_year_amounts(lines: DataFrame, text: str = "text", first_year: int = 1990, last_year: int = 2026) -> DataFrame:
    """Rows of plain text: the name stands before the first year, amounts after it by position."""
    year = F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1)
    parsed = lines.withColumn("year", year).where("year <> ''").withColumn("fund_name", F.regexp_replace(F.trim(F.expr(f"substring(`{text}`, 1, instr(`{text}`, year) - 1)")), ",+$", ""))
    rest = F.expr(f"substring(`{text}`, instr(`{text}`, year) + 4)")
    amounts = F.regexp_extract_all(rest, F.lit(r"\$?([\d,]+\.?\d*)"), F.lit(1))
    wanted = ("commitment", "called", "distributed", "remaining", "irr", "multiple")
    ok = F.col("year").cast("int").between(first_year, last_year) & (F.length("fund_name") >= 3) & ~F.col("fund_name").rlike("(?i)total|summary|benchmark")
    return parsed.where(ok).select(*lines.columns, "fund_name", F.col("year").cast("int").alias("vintage_year"), *[F.try_element_at(amounts, F.lit(i)).alias(f"{w}_text") for i, w in enumerate(wanted, 1)])


def is_data_row(name: Column, marker: Column, pattern: str, rejected: str = r"(?i)total|subtotal|summary") -> Column:
    """Row acceptance: a name, a marker cell (year or date) of the given pattern, no total line."""
    return (F.coalesce(name, F.lit("")) != "") & marker.rlike(pattern) & ~name.rlike(rejected)
