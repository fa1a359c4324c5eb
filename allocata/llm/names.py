"""Taking typed names of managers and funds apart: distinctive words, strategy, number in the series.

Everything is built-in column expressions; a name is lower-cased, cut into runs of letters and digits, and each word is
looked up among the words that many names share. What is left is the distinctive part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that many names share, each with the ways to write it. They never distinguish a manager.
SHARED_WORDS = {
    "fund": "fund fd fnd funds fds",
    "partners": "partners partner ptnrs prtrs ptrs prtnrs",
    "capital": "capital cap captl cptl",
    "management": "management mgmt mngmt mgt mgmnt",
    "group": "group grp gp",
    "investment": "investment investments inv invt invst",
    "equity": "equity eq eqty",
    "private": "private priv pvt",
    "advisors": "advisors advisers advisor adviser advs",
    "asset": "asset assets asst ast",
    "energy": "energy engy enrgy",
    "secondaries": "secondaries secondary secs",
    "infrastructure": "infrastructure infra infrastr",
    "asia": "asia asian as",
    "europe": "europe european eur euro",
    "growth": "growth grth gr",
    "ventures": "ventures venture vntrs vent",
    "opportunities": "opportunities opportunity opp opps",
    "credit": "credit cr crd",
    "real": "real rl r",
    "estate": "estate est e",
    "legal": "lp llp llc ltd inc scsp plc gmbh sa sarl l p c co the and of no number",
}
SPELLING = {w: k for k, ws in SHARED_WORDS.items() for w in ws.split()}
STRATEGIES = ("credit", "real", "asia", "europe", "growth", "energy", "infrastructure", "secondaries", "ventures", "opportunities", "capital")


def _roman(n: int) -> str:
    return "x" * (n // 10) + ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")[n % 10]


#: Roman numbers to XXXIX (beyond, the letters l, c, d and m make words); Arabic ones are numbers of up to three digits, longer ones are years.
NUMERAL = {_roman(n): n for n in range(1, 40)}


def words(name: Column) -> Column:
    return F.regexp_extract_all(F.lower(name), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def distinctive(tokens: Column) -> Column:
    """Words that are neither shared nor a number."""
    return F.filter(tokens, lambda t: ~t.isin(*SPELLING, *NUMERAL) & (F.length(t) > 1) & ~t.rlike(r"^\p{N}+$"))


def strategy(tokens: Column) -> Column:
    """The strategy a fund's name states, or `none`."""
    out = F.lit("none")
    for s in reversed(STRATEGIES):
        spellings = [w for w, k in SPELLING.items() if k == s or (s == "real" and k == "estate")]
        out = F.when(F.arrays_overlap(tokens, F.array(*map(F.lit, spellings))), s).otherwise(out)
    return out


def stated_number(tokens: Column) -> Column:
    """The largest number in the name; null if it states none."""
    m = _lookup(NUMERAL)
    return F.array_max(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(m, t), F.when(t.rlike(r"^[0-9]{1,3}$"), t.try_cast("int")))))


def series_number(tokens: Column) -> Column:
    """The number in the series; a registered name without one is the first of its series."""
    return F.coalesce(stated_number(tokens), F.lit(1))


def core(tokens: Column) -> Column:
    """The distinctive part as (a, b): first word, the rest joined; b is empty for a single word; null if there is none."""
    d = distinctive(tokens)
    return F.when(F.size(d) > 0, F.struct(d[0].alias("a"), F.array_join(F.slice(d, 2, F.size(d)), "").alias("b")))


def skeleton(word: Column) -> Column:
    """A word without its vowels."""
    return F.regexp_replace(word, "[aeiou]", "")
