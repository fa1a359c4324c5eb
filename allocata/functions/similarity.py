"""Normalised indel similarity of two texts, 2 * LCS / (m + n), as an Arrow-batched function.

Spark's levenshtein counts a substitution as one edit and cannot stand in for it. The longest common subsequence is found
with the bit-parallel recurrence on whole integers (Crochemore et al. 2001; Hyyroe 2004): one step per character of one text.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 1.0 if total == 0 else 2.0 * lcs_length(a, b) / total


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    import pandas as pd  # only where it is used: a driver that plans other queries stays small

    def batch(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([ratio(i, j) for i, j in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(batch, "double")(a, b)


# Characters that are counted one by one; all others add nothing to a bound, so it stays a bound.
COUNTED = "abcdefghijklmnopqrstuvwxyz 123"


def letter_bits(text: Column) -> Column:
    """How often a text holds each counted character, up to four times, as bits of two numbers: an insertion or deletion flips one bit at most."""
    first, more = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for i, c in enumerate(COUNTED):
        n = F.length(text) - F.length(F.replace(text, F.lit(c)))
        seen = F.call_function("shiftright", F.lit(15), F.lit(4) - F.least(n, F.lit(4))).cast("bigint")
        first = first.bitwiseOR(F.shiftleft(seen.bitwiseAND(F.lit(3)), 2 * i))
        more = more.bitwiseOR(F.shiftleft(F.shiftright(seen, 2), 2 * i))
    return F.struct(first.alias("first"), more.alias("more"))


def ratio_bound(a_length: Column, a_bits: Column, b_length: Column, b_bits: Column) -> Column:
    """What the indel ratio of two texts with these lengths and `letter_bits` cannot exceed; null for two empty texts."""
    total = a_length + b_length
    apart = F.bit_count(a_bits["first"].bitwiseXOR(b_bits["first"])) + F.bit_count(a_bits["more"].bitwiseXOR(b_bits["more"]))
    return F.least(total - apart, 2 * F.least(a_length, b_length)).cast("double") / F.nullif(total, F.lit(0))


def token_sorted(name: Column) -> Column:
    """Words in order, joined by blanks: what the token-sort ratio compares."""
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")), " ")
