"""Filling fixed-capacity containers with items: harmonic packing.

A text longer than the capacity is split into full containers and a rest; every other text stays whole. Lengths are
put into classes, and the bins of a class take a fixed count of documents, so a document's bin follows from its rank in its
class alone and workers fill bins independently. Two ways of classes:

* `harmonic`: the reciprocal classes (capacity / (k + 1), capacity / k], k documents a bin. It needs no plan, but leaves
  the room that k documents of a class do not fill (p9_harmonic; the loss is in the README).
* `topped`: every length is its own class, and the room left in a bin is filled with documents of smaller classes, again
  in fixed counts. Lengths are at most the capacity, so the corpus reduces to a histogram of at most `capacity` rows,
  whatever its size; on it the bin patterns (how many documents of each length) are laid out largest first, each repeated as
  often as its lengths last. Documents then look up (length, rank) in the table of patterns. This is p9_bins.

Ranks inside a class are taken per (class, salt) with offsets from the table of salted counts; a class has as many salts
as it takes to keep about `ROWS_A_SALT` rows each, so a length that a third of all documents share is ranked by many tasks.

Defined results: an empty or null text has size 0, takes no room and no container (null); ties in length are broken by
a hash and the id; repeated rows must differ in id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allocata.session import cut

CAPACITY = 2048
ROWS_A_SALT = 100_000


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(repetitions, [(length, count), ...])]: largest lengths first, each bin topped up with the largest that fit.

    Every round uses up one length or the room of a pattern, so there are at most a few patterns a length; the work
    depends on the capacity, not on the number of documents.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    sizes: list[int] = []
    for s in left:
        insort(sizes, s)
    out = []
    while sizes:
        room, held, fit = capacity, [], len(sizes)
        while room and fit:
            at = bisect_right(sizes, room, 0, fit) - 1
            if at < 0:
                break
            s = sizes[at]
            count = min(room // s, left[s])
            held.append((s, count))
            room -= count * s
            fit = at
        times = min(left[s] // c for s, c in held)
        for s, c in held:
            left[s] -= c * times
            if not left[s]:
                del left[s]
                sizes.pop(bisect_right(sizes, s) - 1)
        out.append((times, held))
    return out


def pattern_table(spark: SparkSession, histogram: dict[int, int], capacity: int = CAPACITY) -> DataFrame:
    """(length, first_rank, last_rank, per_bin, first_bin): where each rank of a length goes."""
    rows, bin_no, used = [], 0, dict.fromkeys(histogram, 0)
    for times, held in patterns(histogram, capacity):
        for s, c in held:
            rows.append((s, used[s], used[s] + c * times - 1, c, bin_no))
            used[s] += c * times
        bin_no += times
    return spark.createDataFrame(rows, "length long, first_rank long, last_rank long, per_bin long, first_bin long")


def reciprocal_table(spark: SparkSession, histogram: dict[int, int]) -> DataFrame:
    """The same for reciprocal classes: class k holds k documents a bin."""
    rows, bin_no = [], 0
    for k, n in sorted(histogram.items()):
        rows.append((k, 0, n - 1, k, bin_no))
        bin_no += -(-n // k)
    return spark.createDataFrame(rows, "length long, first_rank long, last_rank long, per_bin long, first_bin long")


def pack(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, method: str = "topped") -> DataFrame:
    """(key, piece, first_token, n_tokens, container_id) from (key, n_tokens)."""
    spark = sizes.sparkSession
    n = F.col("n_tokens")
    length = F.least(n - F.col("piece") * capacity, F.lit(capacity)).cast("long")
    # Sizes are costly to make (they come from the tokenizer) and are read twice.
    pieces = cut(
        sizes.select(key, n, F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / capacity) - 1, F.lit(0)))).alias("piece"))
        .select(key, F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).cast("long").alias("first_token"), length.alias("length"))
        .withColumn("class", F.when(F.col("length") > 0, F.floor(F.lit(capacity) / F.col("length"))).otherwise(0).cast("long") if method == "harmonic" else F.col("length"))
    )
    # At most capacity + 1 rows: bounded by the parameter, not by the corpus.
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = spark.createDataFrame([(c, -(-n // ROWS_A_SALT)) for c, n in histogram.items()], "class long, salts long")
    histogram.pop(0, None)
    table = (reciprocal_table(spark, histogram) if method == "harmonic" else pattern_table(spark, histogram, capacity)).withColumnRenamed("length", "class")
    salted = pieces.join(salts, "class").withColumn("salt", F.pmod(F.xxhash64(key), F.col("salts")))
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # One row a class and salt.
    start = salted.groupBy("class", "salt").agg(F.count(F.lit(1)).alias("n")).select("class", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("class", "salt").orderBy(F.xxhash64(key), F.col(key), F.col("piece"))) - 1
    ranked = salted.withColumn("r", rank).join(start, ["class", "salt"]).withColumn("rank", F.col("r") + F.col("start"))
    t = table.alias("t")
    # A length has few patterns; the range condition picks the one of the rank.
    placed = ranked.alias("x").join(t, (F.col("x.class") == F.col("t.class")) & F.col("x.rank").between(F.col("t.first_rank"), F.col("t.last_rank")), "left")
    container = F.col("t.first_bin") + F.floor((F.col("x.rank") - F.col("t.first_rank")) / F.col("t.per_bin"))
    return placed.select(F.col(f"x.{key}").alias(key), "x.piece", "x.first_token", F.col("x.length").alias("n_tokens"), container.cast("long").alias("container_id"))
