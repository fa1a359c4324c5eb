"""Matching a custodian's holdings with our positions without a key: each holding's fund, with a confidence.

1. Blocking. A name's words are replaced by the best attested spelling in the corpus (the spelling operator) and become
   trigrams and abbreviation grams, each qualified by the strategy that the name states; two names meet if one of
   `BANDS` bands of `ROWS` MinHash minima agrees and both of their words are alike (`ALIKE`). Names are blocked as distinct
   (words, strategy), without the number of the series: a holding meets every fund of every series whose name is like its own, and the features decide.
2. Features in two views that share no attribute. The name: similarities of the words as they were typed, whether both
   follow one spelling, whether the numbers agree, differ or are not stated. The evidence: vintage, amount against any
   position and against the holder's own, whether the holder has a position in the fund.
3. A logistic classifier of each view on weak labels from the other one, so that no label is made of the features that
   learn from it: the name's from pairs whose evidence is clear, the evidence's from pairs whose names are clear. Both are
   fitted on one half of at most `SAMPLE` pairs drawn by hash and calibrated on the other (Platt); the fits lean towards the
   START weights, which few labels leave as they are. A view's score less the odds of its labels is what the view adds to the
   odds of a match; the share of matches among all pairs is the one that the sample's probabilities average to. The
   model is applied as a column expression to all pairs.
4. Each holding takes its most probable fund if that reaches `ACCEPT`; between equal log odds (to one place: ids of one
   fund) the nearer amount decides, of the holder's own position if there is one, then the smaller fund id.

Defined results: missing vintage, amount, number or holder are features of their own and never exclude a pair; a holding
without a distinctive word has no candidates; repeated holdings are matched each; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allocata.llm import names, spellings
from allocata.operators import units
from allocata.session import cut

BANDS, ROWS = 20, 2
SAMPLE = 8_000
ACCEPT = 0.5
PLATT = (100.0, 1.0)  # precision of the slope around 1 and of the offset around 0
ALIKE = 0.55  # the least similarity of the less similar words of two names that meet
#: Weights before any fitting, by view, at even odds. Each sums over what holds of a pair; "bias" holds always.
START = {
    "name": {"bias": -6.0, "better": 2.0, "worse": 3.0, "one_spelling": 2.0, "number_same": 5.0, "number_other": -12.0},
    "evidence": {
        "bias": 0.0, "vintage_same": 4.0, "vintage_near": 1.0, "vintage_far": -6.0, "amount_equal": 2.0, "amount_close": 1.0, "amount_far": -2.0,
        "own_equal": 4.0, "own_close": 3.0, "own_far": -2.0, "holder_in": 2.0, "holder_out": -3.0,
    },
}
VIEWS = {view: tuple(w for w in weights if w != "bias") for view, weights in START.items()}
FEATURES = VIEWS["name"] + VIEWS["evidence"]


def parsed(rows: DataFrame, name: str) -> DataFrame:
    """Columns of rows but the name, and (core, ta, tb, strategy, number) of those whose name has a distinctive word; ta and tb are its words as typed."""
    t = F.col("t")
    return rows.withColumn("t", names.words(F.col(name))).withColumn("c", names.core(t)).where("c IS NOT NULL").select(
        *[c for c in rows.columns if c != name], spellings.core_key(F.col("c")).alias("core"), F.col("c.a").alias("ta"), F.col("c.b").alias("tb"),
        names.strategy(t).alias("strategy"), names.stated_number(t).alias("number"),
    )


def resolved(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """core replaced by the words (a, b) of its best attested spelling; b is empty for a single word."""
    words = F.split(F.coalesce("root", "core"), " ")
    return rows.join(roots, "core", "left").withColumn("a", F.when(words[0] == "", words[1]).otherwise(words[0])).withColumn("b", F.when(words[0] == "", "").otherwise(words[1])).drop("core", "root")


def _grams(a: Column, b: Column) -> Column:
    def of(w: Column) -> Column:
        n = F.greatest(F.length(w) - 2, F.lit(1))
        return F.concat(
            F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(w, i, 3)),
            F.array(F.concat(F.lit("<"), F.substring(w, 1, 4)), F.concat(F.lit("~"), names.skeleton(w))),
        )

    # Without a second word the name may be two words run together; its ends stand for the words' beginnings.
    return F.when(b == "", F.concat(of(a), F.array(F.concat(F.lit("<"), F.substring(a, 5, 4))))).otherwise(F.concat(of(a), of(b)))


def bands(forms: DataFrame, n: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(form, band, minimum): n bands of `rows` MinHash minima of the qualified grams of (form, a, b, strategy)."""
    g = F.transform(_grams(F.col("a"), F.col("b")), lambda x: F.xxhash64(x, F.col("strategy")))
    hashed = forms.select("form", g.alias("g"))
    # One hash a gram; every minimum permutes it by hashing it again with its number.
    minima = [F.array_min(F.transform("g", _permuted(i))) for i in range(n * rows)]
    keys = F.array(*[F.xxhash64(*minima[i * rows : (i + 1) * rows]) for i in range(n)])
    return hashed.select("form", F.posexplode(keys).alias("band", "minimum"))


def _permuted(i: int):
    return lambda x: F.xxhash64(x, F.lit(i))


def word_similarity(x: Column, y: Column) -> Column:
    """1 for equal words; edit distance, cut-off words and dropped vowels count as in the spelling operator."""
    edit = 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    cut_off = F.when((F.length(short) >= 3) & (F.length(short) <= 5) & long.startswith(short), 0.8).otherwise(0.0)
    bones = F.when((F.length(short) >= 3) & (short == names.skeleton(long)), 0.85).otherwise(0.0)
    return F.greatest(edit, cut_off, bones)


def name_similarities(la: Column, lb: Column, ra: Column, rb: Column) -> Column:
    """Struct (better, worse) of the two words' similarities in the better order; joined names are compared as one word."""

    def pair(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    # One lambda over the pairs of words instead of the same expression four times: the generated code stays small.
    w = F.transform(F.array(pair(la, ra), pair(lb, rb), pair(la, rb), pair(lb, ra)), lambda p: word_similarity(p["x"], p["y"]))
    orders = F.transform(F.array(F.slice(w, 1, 2), F.slice(w, 3, 2)), lambda o: F.struct(F.array_min(o).alias("worse"), F.array_max(o).alias("better")))
    whole = F.concat(ra, rb)
    ways = [pair(f(x, y), whole) for x, y in ((la, lb), (lb, la)) for f in (
        lambda x, y: F.concat(x, y), lambda x, y: F.concat(names.skeleton(x), y), lambda x, y: F.concat(x, names.skeleton(y)),
    )]
    short = F.array_contains(F.array(*[F.concat(F.substring(x, 1, 4), F.substring(y, 1, 4)) for x, y in ((la, lb), (lb, la))]), whole)
    one = F.when(short, 0.85).otherwise(F.array_max(F.transform(F.array(*ways), lambda p: word_similarity(p["x"], p["y"]))))
    return F.when((rb == "") | (lb == ""), F.struct(one.alias("worse"), one.alias("better"))).otherwise(F.array_max(orders))


def investors_of(holdings: DataFrame, investors: DataFrame) -> DataFrame:
    """(holder_name, investor): the investor whose own (first) word a word of the holder's name spells within two edits."""
    word = names.words(F.coalesce("full_name", "name", "id"))
    own = investors.select(F.col("id").alias("investor"), F.try_element_at(word, F.lit(1)).alias("word")).where("word IS NOT NULL")
    said = holdings.select("holder_name").where("holder_name IS NOT NULL").distinct().select("holder_name", F.explode(F.array_distinct(names.words(F.col("holder_name")))).alias("typed"))
    met = said.select("holder_name", "typed", F.explode(spellings.grams(F.col("typed"))).alias("g")).join(own.select("investor", "word", F.explode(spellings.grams(F.col("word"))).alias("g")), "g")
    d = F.levenshtein("typed", "word", spellings.EDITS)
    return met.where(F.abs(F.length("typed") - F.length("word")) <= spellings.EDITS).withColumn("d", d).where("d >= 0").groupBy("holder_name").agg(F.min(F.struct("d", "investor"))["investor"].alias("investor"))


def positions(commitments: DataFrame, sources: DataFrame) -> DataFrame:
    """(fund_id, held): held is the array of (investor, log amount in millions or null) of a fund, one entry an investor."""
    stated = F.when(F.col("commitment_mm") != 0, F.struct("as_of_date", "commitment_mm"))
    last = commitments.groupBy("fund_id", "pension_fund_id").agg(F.max(stated)["commitment_mm"].alias("amount"))
    amount = units.converted_amount(F.col("amount"), F.col("amount_unit"))
    return last.join(sources.select(F.col("source").alias("pension_fund_id"), "amount_unit"), "pension_fund_id", "left").groupBy("fund_id").agg(
        F.collect_list(F.struct(F.col("pension_fund_id").alias("investor"), F.log(F.abs(amount)).alias("amount"))).alias("held")
    )


def candidate_pairs(funds: DataFrame, holdings: DataFrame, commitments: DataFrame, investors: DataFrame, sources: DataFrame) -> DataFrame:
    """(holding_id, fund_id, features..., distance) of every candidate pair."""
    said = [funds.select(F.col(c).alias("name")) for c in ("fund_name", "general_partner")] + [holdings.select(F.col("security_name").alias("name"))]
    roots = spellings.core_roots(spellings.cores_of(said[0].unionByName(said[1]).unionByName(said[2]).where("name IS NOT NULL")))
    form = F.xxhash64("a", "b", "strategy")
    f = resolved(parsed(funds.select("id", "fund_name", "vintage_year"), "fund_name"), roots)
    h = resolved(parsed(holdings.select("holding_id", "security_name", "holder_name", "vintage", "committed_usd"), "security_name"), roots).join(investors_of(holdings, investors), "holder_name", "left")
    f, h = cut(f.withColumn("form", form)), cut(h.withColumn("form", form))
    ff, hf = f.select("form", "a", "b", "strategy").distinct(), h.select("form", "a", "b", "strategy").distinct()
    met = bands(ff).withColumnRenamed("form", "f_form").join(bands(hf).withColumnRenamed("form", "h_form"), ["band", "minimum"]).select("f_form", "h_form").distinct()
    words = [[F.col(x).alias(f"{side}_{x}") for x in ("form", "a", "b")] for side in "fh"]
    alike = name_similarities(F.col("f_a"), F.col("f_b"), F.col("h_a"), F.col("h_b"))["worse"] >= ALIKE
    met = met.join(ff.select(*words[0]), "f_form").join(hf.select(*words[1]), "h_form").where(alike).select("f_form", "h_form")
    # A registered name without a number is the first fund of its series; a holding's name without one may be any.
    fund_side = f.select(F.col("id").alias("fund_id"), F.col("form").alias("f_form"), F.col("ta").alias("fa"), F.col("tb").alias("fb"), "vintage_year", F.coalesce("number", F.lit(1)).alias("f_number")).join(positions(commitments, sources), "fund_id", "left")
    holding_side = h.select("holding_id", F.col("form").alias("h_form"), F.col("ta").alias("ha"), F.col("tb").alias("hb"), F.col("number").alias("h_number"), "vintage", "committed_usd", "investor")
    pairs = holding_side.join(met, "h_form").join(fund_side, "f_form")
    amount = F.log(F.when(F.col("committed_usd") > 0, F.col("committed_usd") / 1e6))
    any_gap = F.array_min(F.transform("held", lambda x: F.abs(x["amount"] - amount)))
    own = F.filter("held", lambda x: x["investor"] == F.col("investor"))
    pairs = pairs.select(
        "holding_id", "fund_id", (F.col("f_form") == F.col("h_form")).alias("one"), (F.col("f_number") == F.col("h_number")).alias("number"), F.abs(F.col("vintage") - F.col("vintage_year")).alias("years"),
        name_similarities(F.col("fa"), F.col("fb"), F.col("ha"), F.col("hb")).alias("s"), any_gap.alias("any_gap"), F.array_min(F.transform(own, lambda x: F.abs(x["amount"] - amount))).alias("own_gap"),
        F.when(F.col("investor").isNotNull(), F.coalesce(F.size(own), F.lit(0)) > 0).alias("holder"),
    )

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")

    years, gap, own_gap, holder = F.col("years"), F.col("any_gap"), F.col("own_gap"), F.col("holder")
    values = {
        "better": F.col("s.better"), "worse": F.col("s.worse"), "one_spelling": flag(F.col("one")), "number_same": flag(F.col("number")), "number_other": flag(~F.col("number")),
        "vintage_same": flag(years == 0), "vintage_near": flag(years == 1), "vintage_far": flag(years > 1),
        "amount_equal": flag(gap < 0.005), "amount_close": flag(gap.between(0.005, 0.05)), "amount_far": flag(gap > 0.05),
        "own_equal": flag(own_gap < 0.005), "own_close": flag(own_gap.between(0.005, 0.05)), "own_far": flag(own_gap > 0.05), "holder_in": flag(holder), "holder_out": flag(~holder),
    }
    distance = F.when(holder, F.coalesce(own_gap, F.lit(5.0))).otherwise(F.coalesce(gap, F.lit(5.0)) + 10.0)
    return pairs.select("holding_id", "fund_id", *[values[x].alias(x) for x in FEATURES], distance.alias("distance"))


def weak_labels(pairs: DataFrame) -> DataFrame:
    """Pairs with (name_label, evidence_label), each from the other view, null where that is not clear.

    name_label: 1 if vintage and the holder's own amount agree, 0 if the vintage is far off and the holder has no such
    amount. evidence_label: 1 if both follow one spelling and state one number, 0 if the numbers differ.
    """
    own, any_amount = F.col("own_equal") + F.col("own_close") > 0, F.col("amount_equal") + F.col("amount_close") > 0
    name_label = F.when(own & (F.col("vintage_same") == 1), 1).when((F.col("vintage_far") == 1) & ~own & ~any_amount, 0)
    evidence_label = F.when((F.col("one_spelling") == 1) & (F.col("number_same") == 1), 1).when(F.col("number_other") == 1, 0)
    return pairs.select("holding_id", *FEATURES, name_label.alias("name_label"), evidence_label.alias("evidence_label"))


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, pull: tuple[float, ...] = (1.0,), rounds: int = 50) -> np.ndarray:
    """Weights by Newton's method under a Gaussian prior of precision `pull` around `start`; without rows they are `start`."""
    w, hold = start.astype(float), np.ones(len(start)) * pull
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(x.T @ (x * s[:, None]) + np.diag(hold), x.T @ (y - p) - hold * (w - start))
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights of all features and of `bias` from at most `sample` pairs: those whose hash falls below a share.

    The share comes from the number of pairs, so each task sends only its part of the sample to the driver.
    """
    total = labelled.count()
    h = F.xxhash64("holding_id", *FEATURES)
    share = F.pmod(h, F.lit(1 << 20)) < int((1 << 20) * min(1.0, 0.95 * sample / max(total, 1)))
    columns = [F.coalesce(c, F.lit(-1)) for c in ("name_label", "evidence_label")]
    rows = np.array(sorted(labelled.where(share).select(h, *columns, *FEATURES).limit(sample).collect()), dtype=float).reshape(-1, len(FEATURES) + 3)
    half = np.arange(len(rows)) % 2 == 0
    added, weights = np.zeros(len(rows)), {"bias": 0.0}
    for k, (view, features) in enumerate(VIEWS.items()):
        at = 3 + FEATURES.index(features[0])
        x, y = np.hstack([np.ones((len(rows), 1)), rows[:, at : at + len(features)]]), rows[:, 1 + k]
        learn, check = half & (y >= 0), ~half & (y >= 0)
        w = _logistic(x[learn], y[learn], np.array([START[view][f] for f in ("bias", *features)]))
        # Platt: a slope and an offset for the score on pairs that the fit has not seen, with his smoothed targets; a few
        # pairs whose views contradict each other do not turn the slope.
        n1, n0 = (y[check] == 1).sum(), (y[check] == 0).sum()
        target = np.where(y[check] == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        slope, offset = _logistic(np.column_stack([x[check] @ w, np.ones(check.sum())]), target, np.array([1.0, 0.0]), PLATT)
        w = w * max(float(slope), 0.1)
        w[0] += offset - np.log((n1 + 1) / (n0 + 1))
        added += x @ w
        weights |= dict(zip(features, w[1:], strict=True))
        weights["bias"] += w[0]
    prior = 0.5
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(added + np.log(prior / (1 - prior)), -30, 30)))
        prior = float((p.sum() + 1) / (len(p) + 2))
    return {f: float(v) for f, v in weights.items()} | {"bias": float(weights["bias"] + np.log(prior / (1 - prior)))}


def log_odds(weights: Mapping[str, float]) -> Column:
    z = F.lit(weights["bias"])
    for f in FEATURES:
        z = z + F.lit(weights[f]) * F.col(f)
    return z


def matched(funds: DataFrame, holdings: DataFrame, commitments: DataFrame, investors: DataFrame, disclosures: DataFrame) -> DataFrame:
    """(holding_id, fund_id, confidence): the fund of each holding that has one."""
    sources = cut(units.source_units(commitments, funds, disclosures))
    pairs = cut(candidate_pairs(funds, holdings, commitments, investors, sources))
    z = log_odds(fit(weak_labels(pairs)))
    scored = pairs.select("holding_id", "fund_id", "distance", z.alias("z")).withColumn("confidence", 1 / (1 + F.exp(-F.col("z")))).where(F.col("confidence") >= ACCEPT)
    best = scored.groupBy("holding_id").agg(F.min(F.struct(-F.round("z", 1), "distance", "fund_id", "confidence")).alias("m"))
    return best.select("holding_id", F.col("m.fund_id").alias("fund_id"), F.col("m.confidence").alias("confidence"))
