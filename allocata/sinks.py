"""Results to files: CSV with raw or friendly headers, JSON, and small Markdown reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allocata.functions.parsers import format_multiple, format_rate

# Friendly headers of exported columns.
HEADERS = {
    "fund_name": "Fund Name",
    "general_partner": "General Partner",
    "vintage_year": "Vintage Year",
    "asset_class": "Asset Class",
    "sub_strategy": "Sub-Strategy",
    "pension_fund": "Pension Fund",
    "pension_fund_name": "Pension Fund",
    "pension_fund_state": "State",
    "commitment_mm": "Commitment ($M)",
    "capital_called_mm": "Capital Called ($M)",
    "capital_distributed_mm": "Distributions ($M)",
    "remaining_value_mm": "Remaining Value ($M)",
    "net_irr": "Net IRR (%)",
    "net_multiple": "Net Multiple (x)",
    "dpi": "DPI (x)",
    "as_of_date": "As-Of Date",
    "source_url": "Source URL",
    "source_document": "Source Document",
    "extraction_method": "Extraction Method",
    "extraction_confidence": "Confidence",
    "pension_count": "# Pension Systems",
    "pensions": "Pension Systems",
    "total_commitment_mm": "Total Commitment ($M)",
    "avg_irr": "Avg Net IRR (%)",
    "avg_multiple": "Avg Net Multiple (x)",
    "avg_commitment_mm": "Avg Commitment ($M)",
    "fund_count": "# Funds",
    "earliest_vintage": "Earliest Vintage",
    "latest_vintage": "Latest Vintage",
}
DISCLOSED_ONLY = ("capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "dpi")


def formatted(df: DataFrame, rates: tuple[str, ...] = (), amounts: tuple[str, ...] = (), multiples: tuple[str, ...] = ()) -> DataFrame:
    """Rates as 12.3%, amounts as 1,234.5, multiples as 1.50x, under friendly headers; nulls stay empty."""

    def shown(c: str) -> Column:
        if c in rates:
            return format_rate(F.col(c))
        if c in amounts:
            return F.format_number(F.col(c), 1)
        if c in multiples:
            return format_multiple(F.col(c))
        return F.col(c).cast("string")

    return df.select(*[F.when(F.col(c).isNotNull(), shown(c)).alias(HEADERS.get(c, c)) for c in df.columns])


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """CSV with a header even for no rows. `single` is for reports of bounded size; large exports keep their partitions."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def not_disclosed(df: DataFrame, columns: tuple[str, ...] = DISCLOSED_ONLY, mark: str = "N/D") -> DataFrame:
    """Columns as text with a mark where nothing was disclosed."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(mark)) for c in columns if c in df.columns})


def markdown_table(df: DataFrame, title: str, limit: int = 50) -> str:
    """A report table of at most `limit` rows (a top-k report; the rest is not sent to the driver)."""
    head = df.columns
    rows = df.limit(limit).collect()
    lines = [f"## {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"
