"""Variant spellings of names typed by people: which spellings name the same manager, which records the same fund.

Two levels, both joins:

1. Words. Each distinct word is a set of padded trigrams. A prefix filter (the rarest grams first, as many as an edit
   distance of two can touch plus one) gives candidate pairs (word as typed, better attested word), verified by edit
   distance; words cut off after three or four letters and words without vowels join on exactly that.
2. Names. A name is a pair of words in any order; a joined name (one word) is read at every cut. A name is verified
   against names of the corpus that stand in more different strings: both words must be linked, and the similarity is
   the mean of the word similarities weighted by the words' rarity. Each name follows its best such name, so
   variants form stars around the best attested spelling and never chain two managers together.

Defined results: null names are ignored; a name without a distinctive word (empty, only shared words) is linked to
nothing; repeated rows count once; an empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allocata.llm import names
from allocata.session import cut

EDITS = 2  # edits a typed word may be away: one swap of neighbours, or two single letters
SHORT = (3, 4)  # letters that a cut-off word keeps


def grams(word: Column) -> Column:
    """Padded trigrams of a word."""
    padded = F.concat(F.lit("^^"), word, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, 3)))


def word_links(support: DataFrame) -> DataFrame:
    """(typed, word, sim, word_n): every typed word with the better attested words it may stand for, and itself.

    support: (word, n) with n the number of different strings the word stands in.
    """
    vowels = names.skeleton(F.col("word"))
    typed = support.select("word", "n", grams(F.col("word")).alias("g"))
    frequency = typed.select(F.explode("g").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("gram_n"))
    flat = typed.select("word", "n", F.explode("g").alias("gram")).join(frequency, "gram")
    # A group is one word here, so the window never holds more than its grams.
    rank = F.row_number().over(Window.partitionBy("word").orderBy("gram_n", "gram"))
    prefix = flat.withColumn("r", rank).where(F.col("r") <= 3 * EDITS + 1).select("word", "n", "gram")
    left = prefix.select(F.col("word").alias("typed"), F.col("n").alias("typed_n"), "gram")
    # Pieces of joined names stand in no string of their own and are nobody's better spelling.
    right = typed.where("n >= 1").select(F.col("word").alias("word"), F.col("n").alias("word_n"), F.explode("g").alias("gram"))
    # The better attested of two near words is the better spelling; of equally attested ones the longer, then the later in the alphabet.
    better = F.struct("word_n", F.length("word"), "word") > F.struct("typed_n", F.length("typed"), "typed")
    near = (
        left.join(right, "gram").where(better & (F.abs(F.length("typed") - F.length("word")) <= EDITS))
        .select("typed", "word", "word_n").distinct()
        .withColumn("d", F.levenshtein("typed", "word", EDITS))
        .where((F.col("d") >= 0) & (F.col("d") <= F.when(F.length("typed") >= 6, EDITS).otherwise(1)))
        .select("typed", "word", "word_n", (1 - F.col("d") / F.greatest(F.length("typed"), F.length("word"))).alias("sim"))
    )
    full = support.where("n >= 1").select("word", F.col("n").alias("word_n"), vowels.alias("bones"))
    cut_off = support.where(F.length("word").isin(*SHORT)).select(F.col("word").alias("typed"), F.col("word").alias("short"))
    begun = full.select("word", "word_n", F.explode(F.array_distinct(F.array(*[F.substring("word", 1, k) for k in SHORT]))).alias("short"))
    shortened = cut_off.join(begun, "short").where("length(word) > length(typed)").select("typed", "word", "word_n", F.lit(0.8).alias("sim"))
    boned = support.where(vowels == F.col("word")).select(F.col("word").alias("typed"), F.col("word").alias("bones"), "n")
    no_vowels = boned.join(full, "bones").where("word <> typed").select("typed", "word", "word_n", F.lit(0.85).alias("sim"))
    itself = support.select(F.col("word").alias("typed"), "word", F.col("n").alias("word_n"), F.lit(1.0).alias("sim"))
    return near.unionByName(shortened).unionByName(no_vowels).unionByName(itself).groupBy("typed", "word", "word_n").agg(F.max("sim").alias("sim"))


def cores_of(strings: DataFrame) -> DataFrame:
    """(core, a, b, n): distinct distinctive parts of (name) with the number of different strings they stand in."""
    parsed = strings.select("name").distinct().select(names.core(names.words(F.col("name"))).alias("c")).where("c IS NOT NULL")
    return parsed.select(core_key(F.col("c")).alias("core"), F.least("c.a", "c.b").alias("a"), F.greatest("c.a", "c.b").alias("b")).groupBy("core", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def core_key(c: Column) -> Column:
    """Key of a distinctive part, the same for both orders of its words."""
    return F.when(c.isNotNull(), F.concat_ws(" ", F.least(c["a"], c["b"]), F.greatest(c["a"], c["b"])))


def core_roots(cores: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(core, root): the best attested spelling that each distinctive part follows (itself if none)."""
    cores = cut(cores)
    pair = cores.where("a <> ''").select("core", F.col("a"), F.col("b"), "n", F.lit(False).alias("joined"))
    one = cores.where("a = ''").select("core", F.col("b").alias("w"), "n")
    # A joined name is read at every cut; the abbreviation of two words is the cut after its fourth letter.
    cuts = one.where(F.length("w") >= 6).select("core", "w", "n", F.explode(F.sequence(F.lit(3), F.length("w") - 3)).alias("i"))
    split = cuts.select("core", F.expr("substring(w, 1, i)").alias("a"), F.expr("substring(w, i + 1)").alias("b"), "n", F.lit(True).alias("joined"))
    readings = pair.unionByName(split)
    attested = pair.select(F.explode(F.array("a", "b")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    pieces = split.select(F.explode(F.array("a", "b")).alias("word")).distinct().join(attested, "word", "left_anti").select("word", F.lit(0).cast("bigint").alias("n"))
    links = cut(word_links(attested.unionByName(pieces)))
    total = attested.agg(F.sum("n")).first()[0] or 1
    rarity = F.log(1.0 + total / F.greatest("word_n", F.lit(1)))
    weighed = links.select("typed", "word", "sim", rarity.alias("weight"))
    la = weighed.select(F.col("typed").alias("a"), F.col("word").alias("wa"), F.col("sim").alias("sa"), F.col("weight").alias("ga"))
    lb = weighed.select(F.col("typed").alias("b"), F.col("word").alias("wb"), F.col("sim").alias("sb"), F.col("weight").alias("gb"))
    anchors = pair.select(F.col("core").alias("parent"), F.col("n").alias("parent_n"))
    found = (
        readings.join(la, "a").join(lb, "b")
        .withColumn("parent", F.concat_ws(" ", F.least("wa", "wb"), F.greatest("wa", "wb")))
        .withColumn("score", (F.col("sa") * F.col("ga") + F.col("sb") * F.col("gb")) / (F.col("ga") + F.col("gb")))
        .where(F.col("score") >= threshold)
        .join(anchors, "parent")
        # Parents come later in a total order (strings, length, alphabet), so an abbreviation follows the full name and there are no cycles.
        .where("parent <> core AND (joined OR struct(parent_n, length(parent), parent) > struct(n, length(core), core))")
    )
    best = found.groupBy("core").agg(F.max(F.struct("score", "parent_n", "parent"))["parent"].alias("parent"))
    follow = cut(cores.select("core").join(best, "core", "left").select("core", F.coalesce("parent", "core").alias("root")))
    # Parents come later in the order (strings, length), so following them ends; each round doubles the distance.
    while True:
        up = follow.select(F.col("core").alias("root"), F.col("root").alias("next"))
        follow = cut(follow.join(up, "root").select("core", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        if follow.where("moved").isEmpty():
            return follow.select("core", "root")
        follow = follow.drop("moved")


def manager_strings(funds: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name): distinct spellings of managers, exactly as recorded."""
    return funds.select(F.col("general_partner").alias("name")).unionByName(aliases.select(F.col("alias").alias("name"))).where("name IS NOT NULL").distinct()


def link_names(funds: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((name, manager), (id, manager, strategy, number)): each spelling's manager, each fund record's identity.

    manager is the root of the distinctive part; null where a name has none.
    """
    spellings = manager_strings(funds, aliases)
    strings = spellings.unionByName(funds.select(F.col("fund_name_raw").alias("name")).where("name IS NOT NULL"))
    roots = core_roots(cores_of(strings))
    key = core_key(names.core(names.words(F.col("name"))))
    managers = spellings.withColumn("core", key).join(roots, "core", "left").select("name", F.col("root").alias("manager"))
    tokens = F.col("tokens")
    records = funds.select("id", names.words(F.col("fund_name_raw")).alias("tokens")).select("id", core_key(names.core(tokens)).alias("core"), names.strategy(tokens).alias("strategy"), names.series_number(tokens).alias("number"))
    return managers, records.join(roots, "core", "left").select("id", F.col("root").alias("manager"), "strategy", "number")


def pairs_within(rows: DataFrame, key: str, *group: str) -> DataFrame:
    """(key_a, key_b), key_a < key_b, of rows that agree in all group columns; the pairs are the wanted result."""
    a = rows.select(F.col(key).alias("key_a"), *group)
    b = rows.select(F.col(key).alias("key_b"), *group)
    return a.join(b, list(group)).where("key_a < key_b").select("key_a", "key_b")
