"""Resolution of fund names across sources with the semantics of a sequential registry, in parallel.

Records arrive in an order; each is matched exactly, by alias, by similarity with two of three signals, or becomes a new fund,
and every decision changes what later records can match. Two names can only influence each other if a possible match connects
them, so candidate pairs (a blocked similarity join) are closed to components and the sequential rule is replayed per
component in arrival order: the result of the sequential scan, without the scan.

Defined results: a null or blank name is resolved to nothing; repeated names follow the first; ties go to the earliest fund.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allocata.functions.fund_names import ROMAN, distinctive_tokens, fund_number, normalized_firm, normalized_name, strategy_tokens
from allocata.functions.similarity import indel_ratio, letter_bits, ratio_bound, token_sorted
from allocata.session import cut

# Gates and signals of a match.
RATIO_GATE, JACCARD_GATE, NAME_SIGNAL, MANAGER_SIGNAL, NAME_FLOOR, SIGNALS = 0.65, 0.3, 0.85, 0.85, 0.75, 2
FIRM_MATCH, AUTO_TOKEN, AUTO_RATIO, AUDIT_RATIO = 0.85, 0.90, 0.75, 0.75
# Fixed value: parts in which the forms of one length are compared.
SHARES = 8


def first_names(records: DataFrame) -> DataFrame:
    """One row per distinct normal form, as it first arrived: (key, name, manager, vintage, arrival) and what the gates need.

    records: (arrival, fund_name_raw, general_partner, vintage_year), arrival unique.
    """
    return _worded(_described(_firsts(records)))


def _firsts(records: DataFrame) -> DataFrame:
    key = F.lower(normalized_name(F.col("fund_name_raw")))
    return (
        records.withColumn("key", key).where("key <> ''").groupBy("key")
        .agg(F.min(F.struct("arrival", "fund_name_raw", "general_partner", "vintage_year")).alias("f"))
        .select("key", "f.*")
    )


def _described(firsts: DataFrame) -> DataFrame:
    return (
        firsts.withColumn("number", fund_number(F.col("fund_name_raw"))).withColumn("canonical_number", fund_number(normalized_name(F.col("fund_name_raw"))))
        # A stored name is normalised once more when it is compared.
        .withColumn("canonical", F.lower(normalized_name(normalized_name(F.col("fund_name_raw")))))
        .withColumn("manager", F.lower(normalized_name(F.col("general_partner"))))
    )


def _worded(described: DataFrame) -> DataFrame:
    return (
        described.withColumn("tokens", distinctive_tokens(F.col("key"))).withColumn("stored_tokens", distinctive_tokens(F.col("canonical")))
        .withColumn("strategies", F.array_join(strategy_tokens(F.col("key")), " "))
    )


def candidate_pairs(names: DataFrame) -> DataFrame:
    """(later, earlier, score, ratio) of names that pass every gate; `later` arrived after `earlier`."""
    return _scored(meeting_pairs(names)).select("later", "earlier", "ratio", "score")


def _scored(gated: DataFrame) -> DataFrame:
    scored = gated.withColumn("ratio", indel_ratio(F.col("later"), F.col("canonical"))).withColumn("score", indel_ratio(token_sorted(F.col("later")), token_sorted(F.col("canonical"))))
    return scored.where((F.col("ratio") >= RATIO_GATE) & (F.col("score") > NAME_FLOOR))


def matching_pairs(names: DataFrame) -> DataFrame:
    """(la, ea, later, earlier, score) of candidate pairs with enough signals: what a match can follow."""
    scored = _scored(meeting_pairs(names, signals=True)).withColumn("alike", indel_ratio("lm", "em"))
    signals = [F.col("score") > NAME_SIGNAL, (F.col("lm") != "") & (F.col("em") != "") & (F.col("alike") > MANAGER_SIGNAL), (F.col("lv") != 0) & (F.col("lv") == F.col("ev"))]
    return scored.where(sum((c.cast("int") for c in signals), F.lit(0)) >= SIGNALS).select("la", "ea", "later", "earlier", "score")


def coded_words(names: DataFrame) -> DataFrame:
    """(strategies, w, n, single, word): distinctive words by strategy words, how many names hold them, whether one holds no other, a number.

    Words of one name are left out, as they meet nothing; names without words show as a null word.
    """
    words = names.select("strategies", *_words()).groupBy("strategies", "x.w").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("single"))
    return cut(words.where("n > 1 OR w IS NULL").withColumn("word", F.monotonically_increasing_id()), clear=True)


def _words() -> list[Column]:
    """x: each word with whether the name as it arrives (l) and as it is stored (e) holds it, or null; single: whether it is the only one."""
    kinds = F.transform(F.array_union("tokens", "stored_tokens"), lambda w: F.struct(w.alias("w"), F.array_contains("tokens", w).alias("l"), F.array_contains("stored_tokens", w).alias("e")))
    empty = F.array(F.lit(None).cast("struct<w:string,l:boolean,e:boolean>"))
    blank = (F.size("tokens") == 0) | (F.size("stored_tokens") == 0)
    single = (F.size("tokens") == 1) | (F.size("stored_tokens") == 1)
    return [single.alias("single"), F.explode(F.when(blank, F.concat(kinds, empty)).otherwise(kinds)).alias("x")]


def meeting_pairs(names: DataFrame, signals: bool = False) -> DataFrame:
    """(later, earlier, canonical form of the earlier) of names that pass the gates of words and numbers and whose ratios can pass.

    Blocking: the strategy words must be equal, and a Jaccard of 0.3 needs a common word among the rarest
    n - ceil(0.3 n) + 1 of either side (prefix filter). Two names meet in the first such word only, and only if the words
    from there on, their numbers, lengths and letters let them pass; what is kept of the meetings are the pairs. A word so far
    back that only names of one word pass by it meets no others. Names without distinctive words meet within their strategy words.

    Words are numbers here, and a name whose stored form is its form stands on both sides of a join with the same row, so that
    both sides are shuffled once. signals: only pairs whose vintages are equal or whose managers and names can be alike.
    """
    coded = coded_words(names)
    has_single, has_blank = not coded.where("single").isEmpty(), not coded.where("w IS NULL").isEmpty()
    words = names.select("arrival", "strategies", *_words()).where("x IS NOT NULL").select("arrival", "strategies", "x.*")
    ordered = words.join(coded, ["strategies", "w"]).groupBy("arrival").agg(F.sort_array(F.collect_list(F.struct("n", "word", "l", "e", "single"))).alias("ordered"))
    facts = names.select("arrival", "key", "canonical", "number", "canonical_number", "strategies", F.size("tokens").alias("ls"), F.size("stored_tokens").alias("es"), *([F.coalesce("manager", F.lit("")).alias("m"), F.coalesce("vintage_year", F.lit(0)).cast("int").alias("v")] if signals else []))
    # A name that carries neither signal beside its form matches nothing.
    facts = (facts.where("v <> 0 OR m <> ''") if signals else facts).join(ordered, "arrival", "left")

    # Roles: 1 later, 2 earlier, 3 both.
    alone = F.lit(None).cast("string")
    role = lambda r, x: F.struct(F.lit(r).alias("r"), x.alias("x"))
    roles = F.when(F.col("canonical") == F.col("key"), F.array(role(3, alone))).otherwise(F.array(role(1, alone), role(2, F.col("canonical"))))
    number = lambda c: F.coalesce(F.array_position(F.array(*map(F.lit, ROMAN)), F.col(c)), F.lit(0)).cast("int")
    sides = facts.withColumn("role", F.explode(roles)).select("*", "role.*").withColumn("text", F.coalesce("x", "key")).withColumn("sorted", token_sorted(F.col("text")))
    mine = F.filter(F.coalesce("ordered", F.array().cast("array<struct<n:bigint,word:bigint,l:boolean,e:boolean,single:boolean>>")), lambda w: F.when(F.col("r") == 2, w["e"]).otherwise(w["l"]))
    columns = {
        "a": F.col("arrival"), "k": F.col("key"), "x": F.col("x"), "r": F.col("r"), "n": number("number") * 32 + number("canonical_number"), "s": F.when(F.col("r") == 2, F.col("es")).otherwise(F.col("ls")),
        "t": mine["word"], "l": F.length("text"), "y": F.length("sorted"), "b": letter_bits(F.col("sorted")),
    }
    if signals:
        columns |= {"v": F.col("v"), "m": F.col("m"), "u": F.length("m"), "c": letter_bits(F.col("m"))}
    rows = sides.select("strategies", *[c.alias(k) for k, c in columns.items()], mine["single"].alias("singles"))

    def either(side: DataFrame, mark: str) -> DataFrame:
        return side.drop("singles").withColumnsRenamed({c: mark + c for c in side.columns})

    later_number, earlier_number = F.shiftright("ln", 5), F.col("en").bitwiseAND(F.lit(31))
    bound = ratio_bound(F.col("ly"), F.col("lb"), F.col("ey"), F.col("eb"))
    passing = (
        (F.col("ea") < F.col("la")) & (F.col("lr").bitwiseAND(F.lit(1)) * F.col("er").bitwiseAND(F.lit(2)) > 0)
        & ((later_number == 0) | (earlier_number == 0) | (later_number == earlier_number))
        & (2.0 * F.least("ll", "el") / (F.col("ll") + F.col("el")) >= RATIO_GATE)
        & (bound > NAME_FLOOR)
    )
    if signals:
        alike = (F.col("lu") > 0) & (F.col("eu") > 0) & (ratio_bound(F.col("lu"), F.col("lc"), F.col("eu"), F.col("ec")) > MANAGER_SIGNAL)
        passing = passing & (((F.col("lv") == F.col("ev")) & (F.col("lv") != 0) & (F.col("ev") != 0)) | (alike & (bound > NAME_SIGNAL)))

    def at_words(side: DataFrame, words: Column) -> DataFrame:
        """Rows by word, with the place of the word; the words of one name, which come first, are not in the list."""
        return side.select("*", F.posexplode(words).alias("j", "w")).withColumn("i", F.col("s") - F.size("t") + F.col("j")).drop("j")

    def joined(later: DataFrame, earlier: DataFrame, *by: str) -> DataFrame:
        later, earlier = either(later, "l"), either(earlier, "e")
        same = [F.col("l" + c) == F.col("e" + c) for c in by]
        met = passing
        if "w" in by:
            common = F.least(F.col("ls") - F.col("li"), F.col("es") - F.col("ei"))
            shared = F.array_intersect("lt", "et")
            first = (shared[0] == F.col("lw")) & (F.size(shared) / (F.col("ls") + F.col("es") - F.size(shared)) >= JACCARD_GATE)
            met = (common / (F.col("ls") + F.col("es") - common) >= JACCARD_GATE) & passing & first
        for c in same:
            met = c & met
        return later.join(earlier, met).select(
            "la", "ea", F.coalesce("lx", "lk").alias("later"), F.col("ek").alias("earlier"), F.coalesce("ex", "ek").alias("canonical"), *(["lv", "ev", "lm", "em"] if signals else []),
        )

    n = F.col("s")
    prefix = F.slice("t", 1, F.greatest(n - F.ceil(F.lit(JACCARD_GATE) * n - 1e-9).cast("int") + 1 - (n - F.size("t")), F.lit(0)))
    many = at_words(rows.where(n > 1), prefix).where(_reach(n - F.col("i"), n, 2) >= JACCARD_GATE)
    pairs = joined(many, many, "w")
    if has_single:
        # A word of which a name is made meets all names that it is enough of.
        short = at_words(rows.where((n > 0) & (1 / n >= JACCARD_GATE)), F.transform(F.filter(F.arrays_zip("t", "singles"), lambda z: z["singles"]), lambda z: z["t"]))
        short = short.withColumn("i", F.col("s") - F.size("t") + F.array_position("t", F.col("w")).cast("int") - 1)
        pairs = pairs.unionByName(joined(short.where(n == 1), short, "w")).unionByName(joined(short.where(n > 1), short.where(n == 1), "w"))
    if has_blank:
        # A name without words meets all; of two such names the later one meets the earlier.
        pairs = pairs.unionByName(joined(rows.where(n == 0), rows, "strategies")).unionByName(joined(rows.where(n > 0), rows.where(n == 0), "strategies"))
    return pairs


def _reach(left: Column, n: Column, least: int) -> Column:
    """The highest Jaccard of n words, of which `left` can be common, with any at least `least` words."""
    best = F.greatest(F.least(left, n), F.lit(least))
    return F.least(left, best) / (n + best - F.least(left, best))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node of each connected component, by minimum labels with pointer jumping."""
    links = cut(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).unionByName(edges.select(F.col(right).alias("a"), F.col(left).alias("b"))).distinct(), clear=True)
    labels = cut(links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c")), clear=True)
    while True:
        near = links.join(labels.select(F.col("a").alias("b"), F.col("c").alias("nc")), "b").groupBy("a").agg(F.min("nc").alias("nc"))
        lower = labels.join(near, "a", "left").select("a", F.col("c").alias("was"), F.least("c", F.coalesce("nc", "c")).alias("c"))
        jump = lower.select(F.col("a").alias("c"), F.col("c").alias("cc"))
        new = cut(lower.join(jump, "c", "left").select("a", F.least("c", F.coalesce("cc", "c")).alias("c"), "was"), clear=True)
        labels = new.select("a", "c")
        if new.where("c <> was").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("c").alias("component"))


def _followed(edges: Column) -> Column:
    """The sequential rule over one component of matching pairs, in order of arrival: the places of the pairs in which a name follows an earlier one."""
    import pandas as pd  # only where it is used: a driver that plans other queries stays small

    def one(later, earlier, scores) -> list[int]:
        best: dict[int, tuple[float, int]] = {}
        # All pairs of an earlier name come before those of a later one, so what a name follows is settled when it is an option; ties go to the earliest.
        for i, (a, b, score) in enumerate(zip(later.tolist(), earlier.tolist(), scores.tolist(), strict=True)):
            if b not in best and score > best.get(a, (0.0, 0))[0]:
                best[a] = score, i
        return [i for _, i in best.values()]

    def batch(later: pd.Series, earlier: pd.Series, scores: pd.Series) -> pd.Series:
        return pd.Series([one(*c) for c in zip(later, earlier, scores, strict=True)])

    return F.pandas_udf(batch, "array<int>")(edges["la"], edges["ea"], edges["score"])


def resolve(records: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """records with (fund_key, match_type, score): match_type is exact, alias, fuzzy or new.

    aliases: optional (alias, fund_key) of earlier decisions; they are applied to raw and normal forms before anything else.
    """
    keyed = records.withColumn("key", F.lower(normalized_name(F.col("fund_name_raw"))))
    known = None
    if aliases is not None:
        one = aliases.select(F.lower("alias").alias("form"), "fund_key").unionByName(aliases.select(F.lower(normalized_name(F.col("alias"))).alias("form"), "fund_key"))
        known = one.groupBy("form").agg(F.min("fund_key").alias("alias_key"))
        keyed = keyed.join(known, F.col("key") == F.col("form"), "left").drop("form")
    else:
        keyed = keyed.withColumn("alias_key", F.lit(None).cast("string"))
    fresh = keyed.where("alias_key IS NULL AND key <> ''")
    # Names are numbered in order of arrival; what can be read from their forms again is not kept.
    firsts = _firsts(fresh.select(*records.columns)).orderBy("arrival").withColumnRenamed("arrival", "since").withColumn("arrival", F.monotonically_increasing_id())
    kept = _described(firsts).select("key", "since", "arrival", F.when(F.col("canonical") != F.col("key"), F.col("canonical")).alias("canonical"), "number", "canonical_number", "manager", "vintage_year")
    kept = cut(kept, clear=True)
    pairs = cut(matching_pairs(_worded(kept.withColumn("canonical", F.coalesce("canonical", "key")))), clear=True)
    # Only names that a possible match connects are replayed; all others are new funds.
    whole = pairs.join(components(pairs, "la", "ea"), F.col("la") == F.col("node")).groupBy("component").agg(F.sort_array(F.collect_list(F.struct(*pairs.columns))).alias("edges"))
    followed = whole.select("edges", F.explode(_followed(F.col("edges"))).alias("i")).select(F.col("edges")[F.col("i")].alias("f"))
    replayed = followed.select(F.col("f.later").alias("key"), F.col("f.earlier").alias("fund_key"), "f.score")
    decided = kept.select("key", F.col("since").alias("first_arrival")).join(replayed, "key", "left").select(
        "key", "first_arrival", F.coalesce("fund_key", "key").alias("fund_key"), F.when(F.col("fund_key").isNull(), F.lit("new")).otherwise("fuzzy").alias("first_type"), "score",
    )
    out = keyed.join(decided, "key", "left")
    kind = F.when(F.col("alias_key").isNotNull(), "alias").when(F.col("arrival") == F.col("first_arrival"), F.col("first_type")).when(F.col("first_type") == "fuzzy", "alias").when(F.col("first_type").isNotNull(), "exact")
    return out.select(*[F.col(c) for c in records.columns], F.coalesce("alias_key", "fund_key").alias("fund_key"), kind.alias("match_type"), "score")


def near_forms(forms: DataFrame, firms: DataFrame) -> DataFrame:
    """(form, firm_form, firm_id) of the pairs whose lengths and letters let the ratio exceed 0.85; one row per form and firm_form comes in."""
    stretch = (2 - FIRM_MATCH) / FIRM_MATCH
    m, n = F.col("m"), F.col("n")
    left = forms.select("form", F.length("form").alias("m"), letter_bits(F.col("form")).alias("bits"), F.pmod(F.xxhash64("form"), F.lit(SHARES)).cast("int").alias("share"))
    left = left.withColumn("n", F.explode(F.sequence(F.floor(m / stretch).cast("int"), F.ceil(m * stretch).cast("int"))))
    right = firms.select("firm_form", "firm_id", F.length("firm_form").alias("n"), letter_bits(F.col("firm_form")).alias("firm_bits"), F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
    near = (2.0 * F.least(m, n) > FIRM_MATCH * (m + n)) & (ratio_bound(m, F.col("bits"), n, F.col("firm_bits")) > FIRM_MATCH)
    return left.join(right, ["n", "share"]).where(near).select("form", "firm_form", "firm_id")


def firm_matches(names: DataFrame, firms: DataFrame, aliases: DataFrame) -> DataFrame:
    """(firm_name, firm_id, match_type) of names by canonical name, alias, or best ratio above 0.85 (lengths and letter counts block)."""
    n = names.select("firm_name").distinct().withColumn("form", normalized_firm(F.col("firm_name"))).where("form <> ''")
    f = firms.select(F.col("id").alias("firm_id"), normalized_firm(F.col("name")).alias("firm_form"))
    al = aliases.select("firm_id", normalized_firm(F.col("alias")).alias("firm_form"))
    exact = n.join(f, n["form"] == f["firm_form"]).groupBy("firm_name").agg(F.min("firm_id").alias("firm_id")).withColumn("match_type", F.lit("exact"))
    rest = n.join(exact, "firm_name", "left_anti")
    by_alias = rest.join(al, rest["form"] == al["firm_form"]).groupBy("firm_name").agg(F.min("firm_id").alias("firm_id")).withColumn("match_type", F.lit("alias"))
    rest = rest.join(by_alias, "firm_name", "left_anti")

    # Different forms are compared once; a firm stands for all with its form.
    known = f.groupBy("firm_form").agg(F.min("firm_id").alias("firm_id"))
    met = near_forms(rest.select("form").distinct(), known)
    scored = met.withColumn("score", indel_ratio(F.col("form"), F.col("firm_form"))).where(F.col("score") > FIRM_MATCH)
    best = scored.groupBy("form").agg(F.min(F.struct(-F.col("score"), "firm_id"))["firm_id"].alias("firm_id"))
    fuzzy = rest.join(best, "form").select("firm_name", "firm_id").withColumn("match_type", F.lit("fuzzy"))
    return exact.unionByName(by_alias).unionByName(fuzzy)


def link_scores(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with (ratio, token_ratio, numbers_agree, numbers_differ) of two name columns; a number that only one name has neither agrees nor differs."""
    x, y = F.lower(normalized_name(F.col(a))), F.lower(normalized_name(F.col(b)))
    na, nb = fund_number(F.col(a)), fund_number(F.col(b))
    scored = pairs.select("*", indel_ratio(x, y).alias("ratio"), indel_ratio(token_sorted(x), token_sorted(y)).alias("token_ratio"), na.alias("_na"), nb.alias("_nb"))
    return scored.select("*", F.col("_na").eqNullSafe(F.col("_nb")).alias("numbers_agree"), F.coalesce(F.col("_na") != F.col("_nb"), F.lit(False)).alias("numbers_differ")).drop("_na", "_nb")


def auto_resolvable(reviews: DataFrame, a: str, b: str) -> DataFrame:
    """Open fuzzy links that are safe: both ratios high and numbers equal or both absent."""
    return link_scores(reviews, a, b).where((F.col("token_ratio") > AUTO_TOKEN) & (F.col("ratio") > AUTO_RATIO) & F.col("numbers_agree"))


def suspect_links(links: DataFrame, a: str, b: str) -> DataFrame:
    """Links whose names state different numbers or whose ratio is low."""
    return link_scores(links, a, b).where(F.col("numbers_differ") | (F.col("ratio") < AUDIT_RATIO))
