"""Column-level data quality profile per load, by character-class masks.

Every value is generalised to a mask (runs of digits -> 9, of capitals -> A, of small letters -> a; sign and
punctuation stay). One pass counts distinct values per (load, column); masks are computed on that far smaller
result, so the expensive text work is done once per distinct value, and a value or load that holds a third of the
rows is combined map-side before any shuffle.

Defined results: a null is the mask NULL_MASK; NaN has the mask `NaN` and counts as neither zero nor negative; an
empty text has the mask ``; rows whose load columns are null form a load of their own; an empty table has no loads,
so every output is empty; columns of the input that are not profiled (whatever their names) are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MASK = "<null>"
ZERO_MASK = "0"


def mask(value: Column, numeric: Column) -> Column:
    """Mask of a value given as text; `numeric` says whether the column is a number (then zero has its own mask)."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\p{Lu}+", "A"), r"[\p{Ll}\p{Lo}]+", "a"), r"\p{Nd}+", "9")
    number = (
        F.when(F.isnan(value.try_cast("double")), F.lit("NaN"))
        .when(value.try_cast("double") == 0, F.lit(ZERO_MASK))
        .otherwise(F.regexp_replace(F.regexp_replace(value, r"\p{Nd}+", "9"), r"9[eE]", "9E"))
    )
    return F.when(value.isNull(), F.lit(NULL_MASK)).when(numeric, number).otherwise(text)


def value_counts(df: DataFrame, load: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """(load columns, column_name, is_number, value, n): how often each value of each column occurs in each load."""
    numeric = (T.NumericType,)
    kinds = {f.name: isinstance(f.dataType, numeric) for f in df.schema.fields}
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("is_number"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ])
    flat = df.select(*[c.alias(f"load_{k}") for k, c in load.items()], F.explode(pairs).alias("p"))
    keys = [f"load_{k}" for k in load]
    return flat.groupBy(*keys, "p.column_name", "p.is_number", "p.value").agg(F.count(F.lit(1)).alias("n"))


def mask_counts(counts: DataFrame, load: Sequence[str]) -> DataFrame:
    """Masks mined from value_counts: rows, distinct values, the most frequent value's count, smallest and largest value."""
    keys = [f"load_{k}" for k in load]
    number = F.col("value").try_cast("double")
    return (
        counts.withColumn("mask", mask(F.col("value"), F.col("is_number")))
        .groupBy(*keys, "column_name", "is_number", "mask")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count("value").alias("n_values"),
            F.max("n").alias("top_n"),
            F.min(F.when(F.col("is_number"), number)).alias("min_number"),
            F.max(F.when(F.col("is_number"), number)).alias("max_number"),
            F.min(F.when(~F.col("is_number"), F.col("value"))).alias("min_text"),
            F.max(F.when(~F.col("is_number"), F.col("value"))).alias("max_text"),
        )
    )


def rare_masks(masks: DataFrame, rare: float = 0.01) -> DataFrame:
    """(column_name, mask, n_rows, n_loads, share, example): masks that hold less than `rare` of a column's non-null rows; example is the smallest value of that mask."""
    example = F.coalesce(F.min("min_text"), F.min("min_number").cast("string"))
    found = masks.where(F.col("mask") != NULL_MASK).groupBy("column_name", "mask").agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_loads"), example.alias("example"))
    # One row a column and mask.
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("column_name"))
    return found.withColumn("share", share).where(F.col("share") < rare).select("column_name", "mask", "n_rows", "n_loads", "share", "example")


def column_profile(masks: DataFrame, load: Sequence[str], rare: float = 0.01) -> DataFrame:
    """One row per load and column: nulls, distinct values, range, masks, the dominant mask and rare-mask rows.

    A mask is rare if it holds less than `rare` of the column's non-null rows over all loads and is not dominant there.
    """
    keys = [f"load_{k}" for k in load]
    null, value = F.col("mask") == NULL_MASK, F.col("mask") != NULL_MASK
    overall = (
        masks.where(value)
        .groupBy("column_name", "mask")
        .agg(F.sum("n_rows").alias("mask_rows"))
        .withColumn("share", F.col("mask_rows") / F.sum("mask_rows").over(Window.partitionBy("column_name")))
        .where(F.col("share") < rare)
        .select("column_name", "mask", F.lit(True).alias("is_rare"))
    )
    return (
        masks.join(overall, ["column_name", "mask"], "left")
        .groupBy(*keys, "column_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.coalesce(F.sum(F.when(null, F.col("n_rows"))), F.lit(0)).alias("n_null"),
            F.coalesce(F.sum(F.when(value, F.col("n_values"))), F.lit(0)).alias("n_distinct"),
            F.min("min_number").alias("min_number"),
            F.max("max_number").alias("max_number"),
            F.min("min_text").alias("min_text"),
            F.max("max_text").alias("max_text"),
            F.count(F.when(value, F.lit(1))).alias("n_masks"),
            F.max(F.when(value, F.struct("n_rows", "mask")))["mask"].alias("dominant_mask"),
            F.coalesce(F.sum(F.when(F.col("is_rare"), F.col("n_rows"))), F.lit(0)).alias("n_rare"),
        )
    )


def load_measures(masks: DataFrame, load: Sequence[str]) -> DataFrame:
    """Shares of a load's mask distribution as counts: null, zero, negative and the most frequent value (mode)."""
    keys = [f"load_{k}" for k in load]
    null = F.col("mask") == NULL_MASK

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0))

    return (
        masks.groupBy(*keys, "column_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.array(
                F.struct(F.lit("null").alias("measure_name"), rows(null).alias("hits")),
                F.struct(F.lit("zero").alias("measure_name"), rows(F.col("is_number") & (F.col("mask") == ZERO_MASK)).alias("hits")),
                F.struct(F.lit("negative").alias("measure_name"), rows(F.col("is_number") & F.col("mask").startswith("-")).alias("hits")),
                F.struct(F.lit("mode").alias("measure_name"), F.coalesce(F.max(F.when(~null, F.col("top_n"))), F.lit(0)).alias("hits")),
            ).alias("m"),
        )
        .select(*keys, "column_name", "n_rows", F.inline("m"))
    )


def load_shifts(measures: DataFrame, series: str, position: str, threshold: tuple[int, int] = (3, 10), least_rows: int = 15) -> DataFrame:
    """Measures whose share differs by more than threshold from the load just before in the same series.

    Shares are compared as whole numbers (a/n - b/m > 3/10 as products), so no rounding decides a case.
    """
    w = Window.partitionBy(f"load_{series}", "column_name", "measure_name").orderBy(f"load_{position}")
    then = F.lag(F.struct("hits", "n_rows")).over(w)
    seen = measures.select("*", then.alias("before")).where(F.col("before").isNotNull())
    gap = F.abs(F.col("hits") * F.col("before.n_rows") - F.col("before.hits") * F.col("n_rows"))
    both = F.col("n_rows") * F.col("before.n_rows")
    return seen.where((F.col("n_rows") >= least_rows) & (F.col("before.n_rows") >= least_rows) & (gap * threshold[1] > both * threshold[0])).select(
        F.col(f"load_{series}").alias(series),
        F.col(f"load_{position}").alias(position),
        "column_name",
        "measure_name",
        (F.col("hits") / F.col("n_rows")).alias("share"),
        (F.col("before.hits") / F.col("before.n_rows")).alias("share_before"),
    )


def mask_divergence(masks: DataFrame, series: str, position: str) -> DataFrame:
    """Jensen-Shannon divergence (in bits, 0..1) of each column's mask distribution between consecutive loads of a series."""
    keys = [f"load_{series}", f"load_{position}"]
    loads = masks.select(*keys).distinct()
    w = Window.partitionBy(f"load_{series}").orderBy(f"load_{position}")
    step = loads.withColumn("next_load", F.lead(f"load_{position}").over(w))
    total = Window.partitionBy(*keys, "column_name")
    p = masks.select(*keys, "column_name", "mask", (F.col("n_rows") / F.sum("n_rows").over(total)).alias("p"))
    earlier = p.join(step, keys).where(F.col("next_load").isNotNull()).select(keys[0], F.col("next_load").alias(keys[1]), "column_name", "mask", F.lit(0.0).alias("now"), F.col("p").alias("then"))
    later = p.join(step.select(keys[0], F.col("next_load").alias(keys[1])).where(F.col(keys[1]).isNotNull()), keys).select(*keys, "column_name", "mask", F.col("p").alias("now"), F.lit(0.0).alias("then"))
    both = later.unionByName(earlier).groupBy(*keys, "column_name", "mask").agg(F.sum("now").alias("now"), F.sum("then").alias("then"))
    mean = (F.col("now") + F.col("then")) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(0.0)

    return both.groupBy(F.col(keys[0]).alias(series), F.col(keys[1]).alias(position), "column_name").agg(F.sum((part(F.col("now")) + part(F.col("then"))) / 2).alias("divergence"))
