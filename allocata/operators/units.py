"""Quantities recorded in different units: every amount in millions of dollars, every rate as a fraction.

Three identities tie the columns together, each linear in logarithms:

* commitment = share of the fund * fund size        (amount unit of a source, from all its positions)
* recorded amount = amount stated with its unit      (amount and rate unit, from the source's own text records)
* (1 + rate) ** holding time = multiple              (rate unit, from all its positions)

For every source each combination of amount unit and rate unit is scored by the sum of its median log residuals; the
least wins. If the runner-up is nearer than `margin` (powers of ten), or no identity has data, the solution is not unique and
is flagged. Medians are mergeable quantile sketches over positions, so a source that holds a third of the rows is
combined map-side and no source is ever collected.

Text records carry their unit in the text (`$5 bn`, `120 bps`), in the note beside it, or not at all. For the last,
the candidate units are scored by the same log residual against what the source is known to hold, by an exact match
with one of the source's recorded values, and by how records of that written shape are labelled in all records with a note.

Defined results: null, NaN, zero and non-numeric values have no unit (null); a source without evidence keeps the
promised unit and is flagged; an empty table has no rows; repeated records are each judged by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allocata.session import cut

# Factor from a recorded unit to millions of dollars, and to a fraction.
AMOUNT_UNITS = {"usd": 1e-6, "thousand": 1e-3, "million": 1.0, "billion": 1e3}
RATE_UNITS = {"fraction": 1.0, "percent": 1e-2, "bp": 1e-4}
# Share of a fund that an investor usually holds. Amount units lie a thousand apart (dollars, thousands, millions, billions), so
# a source's usual share may be up to about thirty times smaller or larger (0.0016 to 1.6) before another unit fits better.
TYPICAL_SHARE = 0.05
NO_DATA = ("", "-", "--", "—", "–", "n/a", "na", "n/m", "nm", "not disclosed", "none", "null", "nan", "n/d")


def _units(units: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(x).alias("factor")) for u, x in units.items()])


def log10(c: Column) -> Column:
    """Logarithm of the magnitude; null for null, zero and NaN."""
    return F.when(F.isnan(c) | (c == 0), None).otherwise(F.log10(F.abs(c)))


def median(c: Column) -> Column:
    return F.percentile_approx(c, 0.5, 1000)


def clean_text(c: Column) -> Column:
    """Lower case, every kind of white space as one blank, trimmed; texts that mean `no data` become null."""
    t = F.lower(F.trim(F.regexp_replace(c, r"(?U)[\s\x{a0}\x{2007}\x{202f}\x{200b}\x{feff}]+", " ")))
    return F.when(~t.isin(*NO_DATA), t)


def number_in(t: Column) -> Column:
    """The number in a cleaned text: thousands separators dropped, parentheses or a leading minus as sign."""
    digits = F.regexp_replace(F.regexp_extract(t, r"(\d[\d,]*\.?\d*|\.\d+)", 1), ",", "").try_cast("double")
    negative = t.rlike(r"^[^\d]*[-−(]")
    return F.when(negative, -digits).otherwise(digits)


def stated_amount_unit(t: Column, note: Column) -> Column:
    return (
        F.when(t.rlike(r"\d\s*(b|bn|billions?)\.?\)?$"), "billion")
        .when(t.rlike(r"\d\s*(m|mm|mn|mln|millions?)\.?\)?$"), "million")
        .when(t.rlike(r"\d\s*(k|thousands?|'000s?|000s)\.?\)?$"), "thousand")
        .when(t.rlike(r"dollars?\.?\)?$"), "usd")
        .when(note.rlike(r"\b(billions?|bn)\b"), "billion")
        .when(note.rlike(r"\$000|'000|thousand"), "thousand")
        .when(note.rlike(r"\bmm\b|\$\s?m\b|million"), "million")
        .when(note.rlike(r"dollars|us\$"), "usd")
        .when(t.rlike(r"^\(?-?\s?(\$|usd|us\$)"), "usd")
    )


def stated_rate_unit(t: Column, note: Column) -> Column:
    return (
        F.when(t.rlike(r"%|\bpct\b|per ?cent"), "percent")
        .when(t.rlike(r"\d\s*bps?\b|basis points?"), "bp")
        .when(note.rlike(r"basis point|\bbps?\b"), "bp")
        .when(note.rlike(r"fraction|decimal"), "fraction")
        .when(note.rlike(r"(irr|returns?)[^;]*(%|per ?cent|pct)"), "percent")
    )


def shape(t: Column) -> Column:
    """How a bare number is written: with three decimals, fewer, grouped by commas, or plain."""
    return F.when(t.rlike(r"\.\d{3,}\)?$"), "decimals3").when(t.rlike(r"\.\d"), "decimals").when(t.rlike(r"\d,\d"), "grouped").otherwise("plain")


def text_values(disclosures: DataFrame) -> DataFrame:
    """(id, source, field, value, shape, stated) of every text that holds a number."""
    note = F.coalesce(F.lower("unit_note"), F.lit(""))
    amount, rate = clean_text(F.col("commitment_text")), clean_text(F.col("net_irr_text"))
    item = F.array(
        F.struct(F.lit("commitment_text").alias("field"), amount.alias("t"), stated_amount_unit(amount, note).alias("stated")),
        F.struct(F.lit("net_irr_text").alias("field"), rate.alias("t"), stated_rate_unit(rate, note).alias("stated")),
    )
    return (
        disclosures.select(F.col("id"), F.col("pension_fund_id").alias("source"), F.inline(item))
        .select("id", "source", "field", number_in(F.col("t")).alias("value"), shape(F.col("t")).alias("shape"), "stated")
        .where("value IS NOT NULL")
    )


def _factor(unit: Column, units: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for u, x in units.items():
        out = F.when(unit == u, x).otherwise(out)
    return out


def positions(commitments: DataFrame) -> DataFrame:
    """One row per position with typical values: what the identities need, far fewer rows than records."""
    return commitments.groupBy(F.col("pension_fund_id").alias("source"), "fund_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(log10(F.col("commitment_mm"))).alias("log_amount"),
        F.avg(log10(F.col("net_irr"))).alias("log_rate"),
        F.avg(F.when(F.col("net_multiple") > 0, F.abs(F.log(F.col("net_multiple"))))).alias("log_multiple"),
        F.max(F.year("as_of_date")).alias("last_year"),
    )


def source_units(commitments: DataFrame, funds: DataFrame, disclosures: DataFrame, margin: float = 0.5) -> DataFrame:
    """(source, amount_unit, rate_unit, amount_unique, rate_unique, residual, amount_mid, rate_mid): one row per source.

    amount_mid and rate_mid are the source's median commitment in millions and median rate as a fraction (as log10).
    """
    f = funds.select(F.col("id").alias("fund_id"), F.col("fund_size_mm").alias("size"), F.col("vintage_year").alias("vintage"))
    years = F.greatest(F.lit(1.0), (F.col("last_year") - F.col("vintage")) / 2.0)
    by_source = (
        positions(commitments).join(f, "fund_id", "left").groupBy("source")
        .agg(
            median(F.col("log_amount")).alias("amount"),
            median(F.col("log_rate")).alias("rate"),
            median(F.col("log_amount") - log10(F.col("size"))).alias("share"),
            median(F.col("log_rate") + log10(years) - log10(F.col("log_multiple"))).alias("growth"),
        )
    )
    stated = F.when(F.col("field") == "commitment_text", log10(F.col("value") * _factor(F.col("stated"), AMOUNT_UNITS)))
    stated_rate = F.when(F.col("field") == "net_irr_text", log10(F.col("value") * _factor(F.col("stated"), RATE_UNITS)))
    by_text = text_values(disclosures).groupBy("source").agg(median(stated).alias("text_amount"), median(stated_rate).alias("text_rate"))

    def residual(*terms: Column) -> Column:
        out = F.lit(0.0)
        for t in terms:
            out = out + F.coalesce(F.abs(t), F.lit(0.0))
        return out

    a, r = F.log10("a.factor"), F.log10("r.factor")
    scored = (
        by_source.join(by_text, "source", "left")
        .select("*", F.explode(_units(AMOUNT_UNITS)).alias("a"))
        .select("*", F.explode(_units(RATE_UNITS)).alias("r"))
        .withColumn("amount_residual", residual(F.col("share") + a - F.log10(F.lit(TYPICAL_SHARE)), F.col("amount") + a - F.col("text_amount")))
        .withColumn("rate_residual", residual(F.col("growth") + r, F.col("rate") + r - F.col("text_rate")))
        .withColumn("residual", F.col("amount_residual") + F.col("rate_residual"))
    )
    # Of 12 combinations a source: the least residual, and for each half the least with another unit. Ties go to the promised unit.
    promised_a, promised_r = (F.col("a.unit") != "million").cast("int"), (F.col("r.unit") != "fraction").cast("int")
    best = scored.groupBy("source").agg(
        F.min(F.struct("residual", (promised_a + promised_r).alias("p"), "a", "r")).alias("b"),
        F.sort_array(F.collect_set(F.struct("amount_residual", "a.unit"))).alias("as_"),
        F.sort_array(F.collect_set(F.struct("rate_residual", "r.unit"))).alias("rs_"),
        F.first("amount").alias("amount"), F.first("rate").alias("rate"),
    )
    return best.select(
        "source",
        F.col("b.a.unit").alias("amount_unit"), F.col("b.r.unit").alias("rate_unit"),
        (F.col("as_")[1]["amount_residual"] - F.col("as_")[0]["amount_residual"] >= margin).alias("amount_unique"),
        (F.col("rs_")[1]["rate_residual"] - F.col("rs_")[0]["rate_residual"] >= margin).alias("rate_unique"),
        F.col("b.residual").alias("residual"),
        (F.col("amount") + F.log10("b.a.factor")).alias("amount_mid"),
        (F.col("rate") + F.log10("b.r.factor")).alias("rate_mid"),
    )


def text_units(disclosures: DataFrame, sources: DataFrame, commitments: DataFrame) -> DataFrame:
    """(id, source, field, value, unit, stated, unique): the unit of every text value, stated or inferred."""
    values = text_values(disclosures)
    # What a written shape means, learned from all records with a stated unit and no sign of it in the number itself.
    shapes = values.where("stated IS NOT NULL").groupBy("field", "shape", F.col("stated").alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    shapes = shapes.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("field", "shape"))).drop("n")
    known = (
        commitments.where("commitment_mm <> 0").groupBy(F.col("pension_fund_id").alias("source"), "commitment_mm").agg(F.lit(1))
        .join(sources.select("source", "amount_unit"), "source")
        .select("source", F.lit("commitment_text").alias("field"), F.round(F.col("commitment_mm") * _factor(F.col("amount_unit"), AMOUNT_UNITS), 6).alias("held"))
        .distinct().withColumn("matches", F.lit(True))
    )
    candidates = (
        values.where("stated IS NULL")
        .select("*", F.explode(F.when(F.col("field") == "commitment_text", _units(AMOUNT_UNITS)).otherwise(_units(RATE_UNITS))).alias("u"))
        .withColumn("unit", F.col("u.unit"))
        .withColumn("held", F.round(F.col("value") * F.col("u.factor"), 6))
        .join(sources.select("source", "amount_mid", "rate_mid"), "source", "left")
        .join(shapes, ["field", "shape", "unit"], "left")
        .join(known, ["source", "field", "held"], "left")
    )
    mid = F.when(F.col("field") == "commitment_text", F.col("amount_mid")).otherwise(F.col("rate_mid"))
    cost = F.coalesce(F.abs(log10(F.col("held")) - mid), F.lit(0.0)) - 0.5 * F.log10(F.coalesce("p", F.lit(0.0)) + 0.001) - F.when(F.col("matches"), 0.5).otherwise(0.0)
    # One row per record and field again: at most four candidates each.
    chosen = candidates.groupBy("id", "source", "field", "value").agg(F.sort_array(F.collect_list(F.struct(cost.alias("cost"), "unit"))).alias("c"))
    inferred = chosen.select("id", "source", "field", "value", F.col("c")[0]["unit"].alias("unit"), F.lit(False).alias("stated"), (F.col("c")[1]["cost"] - F.col("c")[0]["cost"] > 0.25).alias("unique"))
    return values.where("stated IS NOT NULL").select("id", "source", "field", "value", F.col("stated").alias("unit"), F.lit(True).alias("stated"), F.lit(True).alias("unique")).unionByName(inferred)


def converted_amount(value: Column, unit: Column) -> Column:
    return value * _factor(unit, AMOUNT_UNITS)


def converted_rate(value: Column, unit: Column) -> Column:
    return value * _factor(unit, RATE_UNITS)


def record_units(commitments: DataFrame, funds: DataFrame, disclosures: DataFrame) -> DataFrame:
    """(record_id, field, recorded, unit, value, unique): every amount in millions and every rate as a fraction, with its recorded unit."""
    # A row a source, used three times below; kept, so that the records are not read again for each.
    sources = cut(source_units(commitments, funds, disclosures))
    item = F.array(
        F.struct(F.lit("commitment_mm").alias("field"), F.col("commitment_mm").alias("recorded"), F.col("amount_unit").alias("unit"), converted_amount(F.col("commitment_mm"), F.col("amount_unit")).alias("value"), F.col("amount_unique").alias("is_unique")),
        F.struct(F.lit("net_irr").alias("field"), F.col("net_irr").alias("recorded"), F.col("rate_unit").alias("unit"), converted_rate(F.col("net_irr"), F.col("rate_unit")).alias("value"), F.col("rate_unique").alias("is_unique")),
    )
    rows = commitments.select("id", "pension_fund_id", "commitment_mm", "net_irr").join(sources.withColumnRenamed("source", "pension_fund_id"), "pension_fund_id", "left")
    held = rows.select(F.col("id").alias("record_id"), F.inline(item)).where("recorded IS NOT NULL AND recorded <> 0 AND NOT isnan(recorded)")
    texts = text_units(disclosures, sources, commitments)
    unit = F.col("unit")
    said = texts.select(
        F.col("id").alias("record_id"), "field", F.col("value").alias("recorded"), "unit",
        F.when(F.col("field") == "commitment_text", converted_amount(F.col("value"), unit)).otherwise(converted_rate(F.col("value"), unit)).alias("value"),
        F.col("unique").alias("is_unique"),
    )
    return held.unionByName(said)
