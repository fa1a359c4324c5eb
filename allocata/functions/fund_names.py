"""Names of funds, managers and firms: normal form, number in the series, strategy by keyword, manager by lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from allocata.functions.parsers import strip

# Endings dropped once each in this order, then abbreviations written out.
ENDINGS = (r",?\s*L\.?P\.?$", r",?\s*LLC$", r",?\s*Ltd\.?$", r",?\s*Inc\.?$", r",?\s*Co\.?$")
ABBREVIATIONS = {"Fd": "Fund", "Prtrs": "Partners", "Ptnrs": "Partners", "Cap": "Capital", "Mgmt": "Management", "Intl": "International", "Inv": "Investment"}
FIRM_ENDINGS = (r",?\s*LLC$", r",?\s*Ltd\.?$", r",?\s*Inc\.?$", r",?\s*L\.?P\.?$")
ROMAN = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX XXI XXII XXIII XXIV XXV".split()
BEFORE_ONE = ("fund", "partners", "capital", "equity", "ventures", "opportunities", "growth", "credit", "europe", "asia", "evergreen", "springblue")
# Words that many fund names share; what is left of a name tells funds apart.
GENERIC_TOKENS = (
    "fund", "capital", "partners", "partner", "investment", "investments",
    "equity", "ventures", "venture", "credit", "group", "management",
    "global", "international", "opportunities", "special", "situations",
    "growth", "buyout", "real", "estate", "infrastructure", "the",
    "of", "and", "new", "north", "south", "east", "west",
    "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x",
    "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii", "xviii",
    "a", "b", "c", "d", "e", "lp", "llc", "ltd", "inc", "co",
    "no", "no.", "series", "coinvestment", "co-investment",
    "scsp", "te", "us", "u.s.", "europe", "asia",
    "america", "americas", "latin", "pacific",
)
STRATEGY_TOKENS = ("credit", "asia", "europe", "latin", "real", "infrastructure")
# Fixed values: (words, asset class, strategy), the first that a name holds decides.
STRATEGY_RULES = (
    (("real estate", "realty", "property", "reit"), "Real Assets", "Real Estate"),
    (("infrastructure", "infra "), "Real Assets", "Infrastructure"),
    (("natural resource", "timber", "mining", "oil ", "gas "), "Real Assets", "Natural Resources"),
    (("energy",), "Private Equity", "Energy"),
    (("fund of funds", "pathway"), "Private Equity", "Fund of Funds"),
    (("secondar", "secondary"), "Private Equity", "Secondaries"),
    (("co-invest", "coinvest", "co invest"), "Private Equity", "Co-Investment"),
    (("credit", "debt", "loan", "lending", "mezzanine", "mezz"), "Private Credit", "Credit"),
    (("distress", "special situation", "turnaround", "recovery", "rescue"), "Private Equity", "Distressed/Special Situations"),
    (("venture", "seed", "early stage", "early-stage"), "Private Equity", "Venture Capital"),
    (("growth",), "Private Equity", "Growth Equity"),
    (("buyout",), "Private Equity", "Buyout"),
    (("opportunit",), "Private Equity", "Opportunistic"),
)
# Endings of a fund's name that are no part of the manager's, in this order.
FUND_ENDINGS = (
    "Limited Partnership",
    "Capital Partners",
    "Private Equity",
    "Investment Fund",
    "Equity Partners",
    "Venture Partners",
    "Growth Equity Fund",
    "Growth Equity",
    "Growth Fund",
    "Buyout Fund",
    "Buyout Partners",
    "Strategic Partners",
    "Tactical Opportunities Fund",
    "Tactical Opportunities",
    "Special Situations",
    "Real Estate Fund",
    "Real Estate Partners",
    "Real Estate",
    "Infrastructure Partners",
    "Infrastructure Fund",
    "Infrastructure",
    "Energy Partners",
    "Energy Fund",
    "Credit Opportunities",
    "Credit Partners",
    "Credit Fund",
    "Opportunities Fund",
    "Opportunities",
    "Capital Fund",
    "Capital Appreciation Fund",
    "Global Fund",
    "Co-Investment",
    "Coinvestment",
    "Co-Invest",
    "Compounding Capital",
    "Strategic Opportunities",
    "Secondary Purchase",
    "Partners",
    "Capital",
    "Fund",
    "Investors",
    "Ventures",
    "GPE",
    "SCSp",
    "Cooperatief U.A.",
    "Cooperatief",
    "L.P.",
    "LP",
    "LLC",
    "Ltd",
    "Inc",
)


def _squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def _drop(c: Column, patterns: tuple[str, ...]) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, f"(?i){p}", "")
    return c


def normalized_name(name: Column) -> Column:
    """Legal endings dropped, abbreviations written out, blanks collapsed; keeps case. Null becomes the empty text."""
    s = _drop(strip(F.coalesce(name, F.lit(""))), ENDINGS)
    for short, full in ABBREVIATIONS.items():
        s = F.regexp_replace(s, rf"(?i)\b{short}\b", full)
    return _squeeze(s)


def normalized_firm(name: Column) -> Column:
    return F.lower(_squeeze(_drop(strip(F.coalesce(name, F.lit(""))), FIRM_ENDINGS)))


def fund_number(name: Column) -> Column:
    """The largest Roman number I..XXV in a name. `I` counts only after a word that numbers funds; `V` not after a word on v."""
    value = F.create_map(*[F.lit(x) for i, r in enumerate(ROMAN, 1) for x in (r, i)])
    tokens = F.split(strip(name), r"""[\s,\-'"()]+""")

    def ranked(t: Column, i: Column) -> Column:
        upper = F.upper(F.regexp_replace(t, r"\.+$", ""))
        before = F.lower(F.when(i > 0, F.try_element_at(tokens, i)).otherwise(""))
        one = (upper == "I") & ~F.regexp_replace(before, r"[.,]+$", "").isin(*BEFORE_ONE)
        five = (upper == "V") & (i > 0) & before.endswith("v")
        return F.when(~one & ~five, F.try_element_at(value, upper))

    return F.try_element_at(F.array(*map(F.lit, ROMAN)), F.array_max(F.transform(tokens, ranked)))


def distinctive_tokens(name: Column) -> Column:
    return F.array_except(F.split(F.lower(_squeeze(name)), " "), F.array(*map(F.lit, GENERIC_TOKENS)))


def strategy_tokens(name: Column) -> Column:
    return F.sort_array(F.array_intersect(F.split(F.lower(_squeeze(name)), " "), F.array(*map(F.lit, STRATEGY_TOKENS))))


def token_jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def known_manager(name: Column, managers: list[str]) -> Column:
    """The longest of the given managers that stands in the name, whatever the case and without word boundaries; the first among equals."""
    entries = {m.lower(): m for m in managers}
    known = F.array(*[F.struct(F.lit(len(k)).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k"), F.lit(m).alias("m")) for i, (k, m) in enumerate(entries.items())])
    return F.array_max(F.filter(known, lambda e: F.contains(F.lower(name), e["k"])))["m"]


def manager_from_name(name: Column, managers: list[str]) -> Column:
    """A known manager in the name, else what is left when endings, brackets, numbers and class letters are dropped."""
    s = strip(name)
    s = _drop(s, (*[p.replace("$", r"\s*$") for p in FIRM_ENDINGS[3:] + FIRM_ENDINGS[:3]], r",?\s*SCSp\s*$", r",?\s*Cooperatief\s*U\.?A\.?\s*$"))
    s = F.regexp_replace(s, r"\s*\([^)]*\)\s*", " ")
    for p in (r"\s*[-–]\s*[A-E]\s*$", r"\s+'[A-E]'\s*$", r"\s+[A-E]\s*$"):
        s = F.regexp_replace(s, p, "")
    s = F.regexp_replace(s, r"(?i)\b(" + "|".join(reversed(ROMAN)) + r")\b", "")
    s = F.regexp_replace(s, r"\s+\d+\.?\d*\s*$", "")
    for ending in FUND_ENDINGS:
        s = F.regexp_replace(s, r"(?i)\s+" + ending.replace(".", r"\.") + r"\s*$", "")
    s = _squeeze(F.regexp_replace(s, r"[\s,\-–]+$", ""))
    left = F.when((F.length(s) >= 2) & ~s.rlike(r"^[\d ]+$"), s)
    return F.coalesce(known_manager(name, managers), left) if managers else left


def family_name(name: Column) -> Column:
    """Family of a fund: legal ending, trailing number, `Fund`, year and class letter dropped; the name itself if nothing is left."""
    s = strip(F.regexp_replace(name, r"(?i),?\s*(L\.?P\.?\d?|LLC|Ltd|SCSp|S\.C\.Sp\.?|Cooperatief U\.A\.?)$", ""))
    for p in (r"\s+(Fund\s+)?[IVXLC]+(-[A-Z0-9]+)?(\s+\(.*\))?\s*$", r"\s+Fund\s*$", r"\s+\d{4}\s*$", r"\s+[A-D]\s*$"):
        s = strip(F.regexp_replace(s, p, ""))
    return F.when(s == "", name).otherwise(s)


def strategy_class(name: Column, defaults: dict[str, tuple[str, str]] | None = None, managers: list[str] | None = None) -> Column:
    """Struct (asset_class, sub_strategy): first keyword rule the name fulfils, else the default of its manager, else private equity.

    The manager is the one that `manager_from_name` finds among all `managers`; a longer one without a default hides a
    shorter one that has a default.
    """
    low = F.lower(name)

    def pair(asset: str, strategy: str | None) -> Column:
        return F.struct(F.lit(asset).alias("asset_class"), F.lit(strategy).cast("string").alias("sub_strategy"))

    out = pair("Private Equity", None)
    if defaults:
        manager = F.lower(manager_from_name(name, managers or list(defaults)))
        by_manager = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k.lower()), pair(*v))])
        out = F.coalesce(F.try_element_at(by_manager, manager), out)
    for ws, asset, strategy in reversed(STRATEGY_RULES):
        out = F.when(low.rlike("|".join(ws)), pair(asset, strategy)).otherwise(out)
    return out
