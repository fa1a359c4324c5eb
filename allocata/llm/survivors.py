"""One surviving record for each group of competing records.

`ranked_survivors` is the survivorship that TESTDATA fixes for p2_found: later date, higher confidence, later
extraction, smaller id, and field by field the first record in which the field is present. It is an aggregation of
rank structs, combined map-side; no group is ever gathered.

`fused_fields` builds the record field by field with a latent two-sided quality model: each source (an extraction method
at one level of its confidence, in tenths) has a sensitivity (it states a true value of the field) and a specificity (it does not state a false one), inferred by
expectation-maximisation over all claims; every value whose posterior reaches `accept` is kept, so a field can retain
several values, and every group has one best value of each field that any of its records states. Claims with the same pattern (field, sources that state the value, sources that state another) have the same posterior, so
the iterations run over the distinct patterns with their counts, not over the claims.

Defined results: null fields are no claims; a group without any claim for a field has no row for it; a single record
is a group of one and its values are judged like any other; repeated rows of a source are one claim; undated records
of a position form one group; an empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allocata.operators.ranking import first_by_rank, quarter, rank_key
from allocata.session import cut

# Every column that states a value of the position; the others (source, page, method, times) belong to the record that states it.
FIELDS = ("commitment_mm", "vintage_year", "capital_called_mm", "capital_distributed_mm", "remaining_value_mm", "net_irr", "net_multiple", "dpi", "status")


def ranked_survivors(commitments: DataFrame) -> DataFrame:
    """(pension_fund_id, fund_id, quarter, n_records, group_id, survivor_id, irr_id) of every position and quarter."""
    k = rank_key(F.col("as_of_date"), F.col("extraction_confidence"), F.col("extracted_at"), F.col("id"))
    return (
        commitments.groupBy("pension_fund_id", "fund_id", quarter(F.col("as_of_date")).alias("quarter"))
        .agg(
            F.count(F.lit(1)).alias("n_records"), F.min("id").alias("group_id"),
            first_by_rank(k).alias("best"), first_by_rank(k, F.col("net_irr")).alias("best_irr"),
        )
        .select(
            "pension_fund_id", "fund_id", "quarter", "n_records", "group_id",
            F.col("best.k.id").alias("survivor_id"), F.coalesce("best_irr.k.id", F.lit("")).alias("irr_id"),
        )
    )


GROUP = ["pension_fund_id", "fund_id", "quarter"]


def source() -> Column:
    band = F.coalesce(F.round("extraction_confidence", 1).cast("string"), F.lit("-"))
    return F.concat_ws("/", F.coalesce("extraction_method", F.lit("")), band)


def is_text(commitments: DataFrame, field: str) -> bool:
    return dict(commitments.dtypes)[field] == "string"


def claims(commitments: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(group columns, field, value, text, sources, rank): each stated value with the sources that state it and its best rank.

    A text field's value is in `text`, any other's in `value`; the other of the two is null.
    """

    def claim(f: str) -> Column:
        none, text = F.lit(None), is_text(commitments, f)
        return F.struct(F.lit(f).alias("field"), (none if text else F.col(f"`{f}`")).cast("double").alias("value"), (F.col(f"`{f}`") if text else none).cast("string").alias("text"))

    rank = rank_key(F.col("as_of_date"), F.col("extraction_confidence"), F.col("extracted_at"), F.col("id"))
    item = F.array(*[claim(f) for f in fields])
    flat = commitments.select(
        "pension_fund_id", "fund_id", quarter(F.col("as_of_date")).alias("quarter"), source().alias("source"), rank.alias("rank"), F.inline(item)
    ).where("value IS NOT NULL OR text IS NOT NULL")
    return flat.groupBy("pension_fund_id", "fund_id", "quarter", "field", "value", "text").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.min("rank").alias("rank"))


def overview(commitments: DataFrame, fields: tuple[str, ...] = FIELDS, quality: DataFrame | None = None) -> DataFrame:
    """(group columns, field, value, text, disputed, sources or, with a quality table, p of an undisputed value) of every stated field of every group; value and text are those of an undisputed one.

    One aggregation that combines map-side: the least and greatest value of a field tell whether it has rivals.
    """
    mask = F.lit(0)
    for i, f in enumerate(fields):
        mask = mask + F.when(F.col(f"`{f}`").isNotNull(), 1 << i).otherwise(0)
    flat = commitments.select("pension_fund_id", "fund_id", quarter(F.col("as_of_date")).alias("quarter"), F.struct(source().alias("source"), mask.alias("mask")).alias("said"), *[F.col(f"`{f}`").cast("string" if is_text(commitments, f) else "double").alias(f"v{i}") for i, f in enumerate(fields)])
    wide = flat.groupBy(*GROUP).agg(F.collect_set("said").alias("said"), *[g(f"v{i}").alias(f"{n}{i}") for i in range(len(fields)) for n, g in (("lo", F.min), ("hi", F.max))])

    if quality is not None:
        # The odds of a source are looked up once a group, not once a field.
        odds, _ = source_odds(quality)
        wide = wide.withColumn("said", F.transform("said", lambda x: F.struct(F.struct(x["source"].alias("source"), odds(x["source"]).alias("odds")).alias("source"), x["mask"].alias("mask"))))

    def item(i: int, f: str) -> Column:
        lo, text = F.col(f"lo{i}"), is_text(commitments, f)
        several = F.array_distinct(F.transform(F.filter("said", lambda x: x["mask"].bitwiseAND(F.lit(1 << i)) != 0), lambda x: x["source"]))
        # Nearly all groups are one record; its source states all that is stated.
        one = F.size("said") == 1
        if quality is None:
            out = F.when(one, F.array(F.col("said")[0]["source"])).otherwise(F.sort_array(several)).alias("sources")
        else:
            total = F.when(one, F.col("said")[0]["source"]["odds"]).otherwise(F.aggregate(several, F.lit(0.0), lambda acc, x: acc + x["odds"]))
            out = (1 / (1 + F.exp(-total))).alias("p")
        return F.struct(
            F.lit(f).alias("field"), (F.lit(None) if text else lo).cast("double").alias("value"), (lo if text else F.lit(None)).cast("string").alias("text"),
            (lo != F.col(f"hi{i}")).alias("disputed"), out,
        )

    return wide.select(*GROUP, F.inline(F.array(*[item(i, f) for i, f in enumerate(fields)]))).where("disputed IS NOT NULL")


def source_odds(quality: DataFrame) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """Log odds that a source's statement, and its statement of another value, add to a claim, at even prior odds.

    The quality table has a row a source, methods at eleven levels, so it is small.
    """
    rows = quality.collect()

    def table(odds: dict[str, float]) -> Column:
        return F.create_map(*[F.lit(x) for kv in ({"": 0.0} | odds).items() for x in kv])

    said = table({r["source"]: math.log(r["sensitivity"]) - math.log(1 - r["specificity"]) for r in rows})
    unsaid = table({r["source"]: math.log(1 - r["sensitivity"]) - math.log(r["specificity"]) for r in rows})
    return (lambda s: F.try_element_at(said, s)), (lambda s: F.try_element_at(unsaid, s))


def judged_claims(stated: DataFrame) -> DataFrame:
    """Claims with `others`: sources that state another value of the same field of the same group, but not this one."""
    group = ["pension_fund_id", "fund_id", "quarter", "field"]
    # A group's sources are a subset of the methods at eleven levels, so the set is small however many records there are.
    everyone = stated.groupBy(*group).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("everyone"), F.count(F.lit(1)).alias("n_values"))
    on = F.lit(True)
    for c in group:
        on = on & F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}"))
    return stated.alias("s").join(everyone.alias("e"), on).select("s.*", "e.n_values", F.array_except("e.everyone", "s.sources").alias("others"))


def source_quality(judged: DataFrame, still: float = 1e-3, rounds: int = 100, prior: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(quality by source, posterior by pattern) by expectation-maximisation until no source moves by more than `still` (at the latest after `rounds`).

    judged holds all claims (or claims of a pattern with their count n), the undisputed ones too: they tell what a source states when it is right. Starting values
    are sensitivity 0.8 and specificity 0.9, and they stay in as ten pseudo-counts each. A statement is never taken as
    evidence against itself, so a source's specificity stays above 1 - sensitivity; without this a source that is
    mostly wrong would turn into an oracle of the contrary and drag the others with it.
    """
    n = F.sum("n") if "n" in judged.columns else F.count(F.lit(1))
    patterns = cut(judged.groupBy("field", "sources", "others").agg(n.alias("n")))
    votes = F.array_union(
        F.transform("sources", lambda s: F.struct(s.alias("source"), F.lit(1).alias("says"))),
        F.transform("others", lambda s: F.struct(s.alias("source"), F.lit(0).alias("says"))),
    )
    flat = cut(patterns.select("field", "sources", "others", "n", F.inline(votes)))
    quality = cut(flat.select("source").distinct().select("source", F.lit(0.8).alias("sensitivity"), F.lit(0.9).alias("specificity")))
    posterior, last = None, {}
    for _ in range(rounds):
        q = flat.join(quality, "source")
        yes = F.when(F.col("says") == 1, F.col("sensitivity")).otherwise(1 - F.col("sensitivity"))
        no = F.when(F.col("says") == 1, 1 - F.col("specificity")).otherwise(F.col("specificity"))
        odds = F.log(F.lit(prior / (1 - prior))) + F.sum(F.log(yes) - F.log(no))
        posterior = q.groupBy("field", "sources", "others", "n").agg((1 / (1 + F.exp(-odds))).alias("p"))
        held = flat.join(posterior.drop("n"), ["field", "sources", "others"])
        w, says = F.col("n") * F.col("p"), F.col("says")
        v = F.col("n") * (1 - F.col("p"))
        raw = held.groupBy("source").agg(
            ((F.sum(w * says) + 8) / (F.sum(w) + 10)).alias("sensitivity"), ((F.sum(v * (1 - says)) + 9) / (F.sum(v) + 10)).alias("specificity"),
        )
        quality = cut(raw.select("source", "sensitivity", F.greatest("specificity", F.lit(1.01) - F.col("sensitivity")).alias("specificity")))
        # A row a source, methods at eleven levels of confidence.
        now = {r["source"]: (r["sensitivity"], r["specificity"]) for r in quality.collect()}
        moved = max((abs(x - y) for s, q in now.items() for x, y in zip(q, last.get(s, (0.0, 0.0)), strict=True)), default=0.0)
        last = now
        if moved <= still:
            break
    return quality, cut(posterior)


def fused_fields(commitments: DataFrame, fields: tuple[str, ...] = FIELDS, accept: float = 0.5) -> DataFrame:
    """(group, field, value, text, p, is_best): every value judged true of each field of each group, disputed or not.

    The best value of a field is the most probable one, among equals that of the record that ranks first; it is kept even if none reaches `accept`.
    """
    # Nearly all fields are undisputed; only the records of groups with rival values are taken apart value by value.
    seen = overview(commitments, fields)
    plain = ~F.col("disputed")
    counted = cut(seen.select("field", F.when(plain, F.col("sources")).alias("sources"), F.when(~plain, F.struct(*GROUP)).alias("g")).groupBy("field", "sources", "g").agg(F.count(F.lit(1)).alias("n")))
    rivals = counted.where("g IS NOT NULL").select("g.*").distinct()
    rows = commitments.withColumn("q_", quarter(F.col("as_of_date"))).alias("c")
    on = F.col("c.q_").eqNullSafe(F.col("r.quarter")) & F.col("c.pension_fund_id").eqNullSafe(F.col("r.pension_fund_id")) & F.col("c.fund_id").eqNullSafe(F.col("r.fund_id"))
    judged = cut(judged_claims(claims(rows.join(rivals.alias("r"), on, "left_semi").drop("q_"), fields)).where("n_values > 1"))
    none = F.array().cast("array<string>").alias("others")
    alone = counted.where("g IS NULL").select("field", "sources", none, "n")
    quality, _ = source_quality(alone.unionByName(judged.select("field", "sources", "others", F.lit(1).cast("bigint").alias("n"))))
    said, unsaid = source_odds(quality)
    for_it = F.aggregate("sources", F.lit(0.0), lambda acc, x: acc + said(x))
    p = 1 / (1 + F.exp(-F.aggregate("others", for_it, lambda acc, x: acc + unsaid(x))))
    group = [*GROUP, "field"]
    scored = judged.select(*group, "value", "text", p.alias("p"), "rank")
    best = scored.groupBy(*group).agg(F.min(F.struct(-F.round("p", 9), "rank", "value", "text")).alias("b"))
    on = F.lit(True)
    for c in group:
        on = on & F.col(f"s.{c}").eqNullSafe(F.col(f"b_.{c}"))
    disputed = (
        scored.alias("s").join(best.alias("b_"), on)
        .select(*[F.col(f"s.{c}").alias(c) for c in group], "s.value", "s.text", "s.p", (F.col("s.value").eqNullSafe(F.col("b_.b.value")) & F.col("s.text").eqNullSafe(F.col("b_.b.text"))).alias("is_best"))
        .where((F.col("p") >= accept) | F.col("is_best"))
    )
    agreed = overview(commitments, fields, quality).where(plain).select(*group, "value", "text", "p", F.lit(True).alias("is_best"))
    return agreed.unionByName(disputed)
