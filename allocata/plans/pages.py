"""Queries of the sources over pages that are written from the commitments in each source's own layout.

Every commitment becomes a row of a page of each source; the SQL states from the table what must be read. The amounts are
made of the record's page number n: committed and called n, distributed n + 1, remaining n million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allocata.session import table
from allocata.sources import adapters, html, landing, layout


def _rows(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "commitments", "id", "source_page").repartition(spark.sparkContext.defaultParallelism)
    page = F.coalesce("source_page", F.lit(0))
    return c.select("id", F.upper("id").alias("x"), (page + 1).alias("n"), (page % 25 + 2000).cast("string").alias("year"))


def _money(n: Column) -> Column:
    return F.format_string("$%,d", n * 1_000_000)


def _cells() -> dict[str, dict[str, Column]]:
    n, year = F.col("n").cast("bigint"), F.col("year")
    whole = {"vintage": year, "commitment": _money(n), "called": _money(n), "distributed": _money(n + 1), "value": _money(n), "total": _money(2 * n + 1)}
    short = {k: F.format_string("$%d.0", v) for k, v in {"commitment": n, "called": n, "distributed": n + 1, "value": n}.items()}
    plain = {k: (v * 1_000_000).cast("string") for k, v in {"commitment": n, "paid_in": n, "distributed": n + 1, "value": n}.items()}
    return {
        "calstrs": whole | {"irr": F.lit("7.50")}, "wsib": whole | {"vintage": F.concat(F.lit("3/31/"), year), "multiple": F.lit("-1.5x"), "unfunded": F.lit("-"), "gain": F.lit("1"), "irr": F.lit("7.5%")},
        "oregon": short | {"vintage": year, "multiple": F.lit("1.5x"), "irr": F.lit("7.5%")}, "ny_common": whole | {"vintage": F.concat(F.lit("03/31/"), F.substring(year, 3, 2))}, "florida_sba": plain | {"vintage": year, "tvpi": F.lit("1.5x"), "irr": F.lit("7.5%")},
    }


def _words(rows: DataFrame, source: adapters.Layout) -> DataFrame:
    """Positioned words of one page per record: a header, a data row and a total that is none."""
    cells = _cells()[source.ident]
    if source.boundaries is None:
        columns, starts = ("fund_name", *source.columns), [10.0] + [100.0 + 60 * i for i in range(len(source.columns))]
    else:
        columns, starts = source.columns, [5.0, *[b + 2.0 for b in source.boundaries]]
    items = []
    for c, x in zip(columns, starts, strict=True):
        if c == "fund_name":
            items += [(F.lit("Alder"), x, 100.2), (F.col("x"), x + 20, 100.4), (F.lit("Fund"), x + 40, 99.8), (F.lit("Total"), x, 130.0)]
        else:
            # The first source tells totals by their missing vintage, the others by their name.
            items += [(cells[c], x, 100.0), (F.lit("All") if (c, source.ident) == ("vintage", "calstrs") else cells[c], x, 130.0)]
            if source.boundaries is None:
                items.append((F.lit({"paid_in": "Contributed"}.get(c, c)), x, 50.0))
    word = F.array(*[F.struct(F.lit(i).alias("idx"), text.alias("text"), F.lit(x).alias("x0"), F.lit(top).alias("top")) for i, (text, x, top) in enumerate(items)])
    return rows.select(F.col("id").alias("doc_id"), F.lit(1).alias("page"), F.lit(612.0).alias("page_width"), F.inline(word))


COLUMNS = ("source", "doc_id", "fund_name_raw", "vintage_year", "commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "extraction_confidence")


def source_records(spark, sf_dir):
    """Records of the five word layouts."""
    rows, out = _rows(spark, sf_dir), None
    for source in adapters.LAYOUTS:
        read = adapters.word_records(_words(rows, source), source).withColumn("source", F.lit(source.ident)).select(*COLUMNS)
        out = read if out is None else out.unionByName(read)
    return out


def html_records(spark, sf_dir):
    """Records of a holdings table in HTML."""
    n = F.col("n").cast("bigint")
    cells = [F.concat(F.lit("<td> Alder "), F.col("x"), F.lit(" &amp; Co </td>")), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in (F.col("year"), _money(n), _money(n), _money(n + 1), _money(2 * n + 1))]]
    rate = F.when(F.col("n") % 3 == 0, "<td>N/M2").otherwise("<td>7.5%</td>")
    page = F.concat(F.lit("<p>As of March 31, 2024</p><table><tr><th>a</th></tr><tr><th>b</th></tr><tr>"), *cells, rate, F.lit("</tr><tr><td>short</td></tr></table>"))
    read = html.holdings(_rows(spark, sf_dir).select("id", page.alias("html")), "id", "html")
    return read.select("id", "fund_name_raw", "vintage_year", "commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "as_of_date")


def text_records(spark, sf_dir):
    """Records of board books: lines of name, year and amounts; totals and other pages are none."""
    line = F.concat(F.lit("Private Equity\nAlder "), F.translate("x", "0123456789", "GHIJKLMNOP"), F.lit(" Fund IV, "), F.col("year"), F.format_string(" $%d.5 %d.0 1,000.0 7 7.5 1.5", F.col("n"), F.col("n")), F.lit("\nTotal 2001 5.0"))
    pages = _rows(spark, sf_dir).select(F.col("id").alias("doc_id"), F.explode(F.array(F.struct(F.lit(1).alias("page"), line.alias("text")), F.struct(F.lit(2).alias("page"), F.lit("Agenda 2001 $5.0").alias("text")))).alias("p")).select("doc_id", "p.*")
    return adapters.text_records(pages).select("doc_id", "page", "fund_name_raw", "vintage_year", "commitment_mm", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple")


def total_records(spark, sf_dir):
    """Summary records of reports that state only totals."""
    text = F.concat(F.lit("Net Asset Value and Unfunded Capital\nPrivate Equity $ "), F.format_string("%,d $ %,d", F.col("n") * 1_000_000, F.col("n") * 500_000))
    return adapters.total_records(_rows(spark, sf_dir).select(F.col("id").alias("doc_id"), F.lit(1).alias("page"), text.alias("text"))).select("doc_id", "commitment_mm", "capital_called_mm", "remaining_value_mm", "extraction_confidence")


def page_ranges(spark, sf_dir):
    """Pages of each investor from the one that starts a section to the one before it ends."""
    p = table(spark, sf_dir, "commitments", "pension_fund_id", "source_page").where("source_page IS NOT NULL").distinct()
    text = F.when(F.col("source_page") == 20, "PRIVATE EQUITY INVESTMENTS").when(F.col("source_page") == 40, "Fund of Funds").otherwise("rows")
    return layout.page_range(p.select(F.col("pension_fund_id").alias("doc_id"), F.col("source_page").alias("page"), text.alias("text")), "PRIVATE EQUITY INVESTMENTS", "FUND OF FUNDS").select("doc_id", "page")


def fund_pages(spark, sf_dir):
    """Documents by whether they look like rows of funds, and whether they hold a table of funds."""
    t = F.col("text")
    d = table(spark, sf_dir, "documents", "doc_id", "text").where("text IS NOT NULL")
    return d.select("doc_id", layout.holds_fund_data(t).alias("fund_data"), adapters.is_fund_table(t).alias("fund_table"))


def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", landing.content_hash(F.col("text")).alias("source_hash"))


QUERIES = {f.__name__: f for f in (source_records, html_records, text_records, total_records, page_ranges, fund_pages, content_hashes)}

_C = "c AS (SELECT id, upper(id) AS x, coalesce(source_page, 0) + 1 AS n, CAST(2000 + coalesce(source_page, 0) % 25 AS INT) AS y FROM commitments)"
_ROUND = "CAST(CAST(round(CAST(CAST((2.0::DOUBLE * n + 1) / n AS VARCHAR) AS DECIMAL(38, 20)), 4) AS VARCHAR) AS DOUBLE)"
_ONE = "SELECT '{0}' AS source, id AS doc_id, 'Alder ' || x || ' Fund' AS fund_name_raw, y AS vintage_year, n::DOUBLE AS commitment_mm, n::DOUBLE AS capital_called_mm, (n + 1)::DOUBLE AS capital_distributed_mm, n::DOUBLE AS remaining_value_mm, {1} AS net_irr, {2} AS net_multiple, {3}::DOUBLE AS extraction_confidence FROM c"
ORACLE = {
    "source_records": f"WITH {_C} " + " UNION ALL ".join(_ONE.format(*v) for v in (("calstrs", "0.075::DOUBLE", _ROUND, 0.95), ("wsib", "0.075::DOUBLE", "1.5::DOUBLE", 0.90), ("oregon", "0.075::DOUBLE", "1.5::DOUBLE", 0.95), ("ny_common", "NULL::DOUBLE", _ROUND, 0.95), ("florida_sba", "0.075::DOUBLE", "1.5::DOUBLE", 0.90))),
    "html_records": f"WITH {_C} SELECT id, 'Alder ' || x || ' & Co' AS fund_name_raw, y AS vintage_year, n::DOUBLE AS commitment_mm, n::DOUBLE AS capital_called_mm, (n + 1)::DOUBLE AS capital_distributed_mm, n::DOUBLE AS remaining_value_mm, CASE WHEN n % 3 <> 0 THEN 0.075::DOUBLE END AS net_irr, {_ROUND} AS net_multiple, DATE '2024-03-31' AS as_of_date FROM c",
    "text_records": f"WITH {_C} SELECT id AS doc_id, 1 AS page, 'Alder ' || translate(x, '0123456789', 'GHIJKLMNOP') || ' Fund IV' AS fund_name_raw, y AS vintage_year, n + 0.5::DOUBLE AS commitment_mm, n::DOUBLE AS capital_called_mm, 1000.0::DOUBLE AS capital_distributed_mm, 7.0::DOUBLE AS remaining_value_mm, 0.075::DOUBLE AS net_irr, 1.5::DOUBLE AS net_multiple FROM c",
    "total_records": f"WITH {_C} SELECT id AS doc_id, n + n * 0.5::DOUBLE AS commitment_mm, n::DOUBLE AS capital_called_mm, n::DOUBLE AS remaining_value_mm, 0.7::DOUBLE AS extraction_confidence FROM c",
    "page_ranges": "WITH p AS (SELECT DISTINCT pension_fund_id AS doc_id, source_page AS page FROM commitments WHERE source_page IS NOT NULL), s AS (SELECT doc_id FROM p WHERE page = 20), e AS (SELECT doc_id FROM p WHERE page = 40) SELECT doc_id, page FROM p WHERE doc_id IN (SELECT doc_id FROM s) AND page >= 20 AND (page < 40 OR doc_id NOT IN (SELECT doc_id FROM e))",
    "fund_pages": "SELECT doc_id, regexp_matches(text, '(?i)l\\.p\\.|, lp|partners') AND regexp_matches(text, '\\d+[.,]\\d+') AS fund_data, contains(lower(text), 'private') AND (contains(lower(text), 'equity') OR contains(lower(text), 'markets')) AND regexp_matches(text, '20[012]\\d.*[$]?\\d+[.,]\\d+') AS fund_table FROM documents WHERE text IS NOT NULL",
    "content_hashes": "SELECT doc_id, sha256(text) AS source_hash FROM documents WHERE text IS NOT NULL",
}
