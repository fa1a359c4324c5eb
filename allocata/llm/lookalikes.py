"""Visually identical text with different characters, brought to one consistent form.

Each text is mapped with built-in expressions: invisible characters go, special blanks become a blank, wide and narrow
forms, ligatures, number forms and look-alike letters become the plain character. The mapped texts are grouped under
Spark's accent- and case-sensitive UNICODE collation, which also treats composed and combining accents alike; each
class has a deterministic canonical member (the smallest mapped text in binary order) that is joined back to every document.

Comparing whole texts under a collation is costly, so it is done only where it can matter. Every document travels as
hashes: of its text, of its mapped text, and of its skeleton, the mapped text without any character that combining marks,
composed letters or ignorable characters could change. Texts that the collation holds equal have equal skeletons, so only
mapped texts that share a skeleton with another one are fetched (one document each) and compared. Copies of a text never
travel, and pairs are formed between different texts only.

Combining marks are expected in canonical order, as the collation does not reorder them.

Kept apart: case, accents, raised and lowered digits, fractions, dashes longer than a hyphen, numbers of blanks, line
breaks, tabs, and joiners inside emoji and in scripts that shape by them.

Defined results: a null text has null results; an empty or blank text (no visible character) has its class but no
pairs; repeated rows are members of one class; an empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allocata.session import cut

# Letters of other scripts that look like a Latin letter, by the letter they look like.
LETTERS = {
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "јϳ", "o": "оο", "p": "р", "q": "ԛ", "s": "ѕ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уү",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "Q": "Ԛ",
    "S": "Ѕ", "T": "ТΤ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
}
# Blanks of other widths and without a break; hyphens that only differ in where a line may break.
BLANKS = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
HYPHENS = "".join(map(chr, (0x2010, 0x2011, 0xFE63)))
# Characters without any ink that do not change how their neighbours look.
INVISIBLE = r"[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}\x{200e}\x{200f}\x{202a}\x{202c}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{feff}]"
_SHAPED = r"\x{600}-\x{dff}\x{1f000}-\x{1faff}\x{2600}-\x{27bf}\x{fe0f}\x{dc00}-\x{dfff}"  # the last range: a look-behind sees half of an emoji
JOINERS = rf"(?<![{_SHAPED}])[\x{{200c}}\x{{200d}}]|[\x{{200c}}\x{{200d}}](?![{_SHAPED}])"


@lru_cache(maxsize=1)
def single_mapping() -> dict[str, str]:
    """Character to character: the letters above also with any accents, what Unicode calls wide or narrow, and characters that are another one by definition (the Kelvin sign)."""
    base = {x: latin for latin, xs in LETTERS.items() for x in xs}
    out = dict.fromkeys(BLANKS, " ") | dict.fromkeys(HYPHENS, "-") | base
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1D000, 0x1D200), *range(0x2F800, 0x2FA20)):
        c = chr(code)
        if c not in out and len(points := unicodedata.decomposition(c).split()) == 1 and len(plain := unicodedata.normalize("NFC", c)) == 1 and plain != c:
            out[c] = out.get(plain, plain)
    for code in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):
        c = chr(code)
        first, *marks = unicodedata.normalize("NFD", c)
        if marks and first in base and len(composed := unicodedata.normalize("NFC", base[first] + "".join(marks))) == 1:
            out[c] = composed
    for code in range(0xFF01, 0xFFEF):
        kind, _, points = unicodedata.decomposition(chr(code)).partition(" ")
        if kind in ("<wide>", "<narrow>"):
            c = chr(int(points, 16))
            out[chr(code)] = out.get(c, c)
    return out


def expansions() -> dict[str, str]:
    """Character to several: Latin ligatures and the Roman number forms."""
    return {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFB00, 0xFB07), *range(0x2160, 0x2180)) if unicodedata.decomposition(chr(c)).startswith("<compat>")}


def mapped(text: Column) -> Column:
    """The text with look-alikes mapped; still to be compared under the collation. Each step runs only on texts that need it."""
    single, several = single_mapping(), expansions()
    unseen = F.when(text.rlike(INVISIBLE[:-1] + r"\x{200c}\x{200d}]"), F.regexp_replace(F.regexp_replace(text, INVISIBLE, ""), JOINERS, "")).otherwise(text)
    out = F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(unseen, "".join(single), "".join(single.values()))).otherwise(text)
    wide = out
    for c, s in several.items():
        wide = F.replace(wide, F.lit(c), F.lit(s))
    return F.when(out.rlike("[" + "".join(several) + "]"), wide).otherwise(out)


def skeleton(form: Column) -> Column:
    """What two mapped texts that the collation holds equal have in common for certain: visible ASCII, Cyrillic and Han characters that carry no mark."""
    bare = F.when(form.rlike(r"\p{M}"), F.regexp_replace(form, r".\p{M}+", "")).otherwise(form)
    return F.regexp_replace(bare, r"[^\x21-\x7e\x{410}-\x{418}\x{41a}-\x{438}\x{43a}-\x{44f}\x{4e00}-\x{9fff}]+", "")


def reading(form: Column) -> Column:
    """What is compared: the mapped text under the collation. The collation ignores joiners, so those that shape their
    neighbours stand as private characters here."""
    return F.collate(F.translate(form, "\u200c\u200d", "\U0010ff01\U0010ff02"), "UNICODE")


def has_ink(mapped_text: Column) -> Column:
    return mapped_text.rlike(r"[^\s\p{Z}\p{C}]")


def _hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 32)


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((key, text_hash, form_hash, inked), (form_hash, class_id, canonical)): documents by their mapped text, mapped texts by how they read.

    class_id is the smallest key of the class; canonical is null where the class has one mapped text only.
    """
    rows = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    members = cut(rows.withColumn("form", mapped(F.col("text"))).select("key", _hash(F.col("text")).alias("text_hash"), _hash(F.col("form")).alias("form_hash"), _hash(skeleton(F.col("form"))).alias("skeleton"), has_ink(F.col("form")).alias("inked")))
    forms = cut(members.groupBy("skeleton", "form_hash").agg(F.min("key").alias("first_key")))
    shared = forms.groupBy("skeleton").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("skeleton")
    rivals = forms.join(shared, "skeleton")
    # One document stands for each mapped text; its text is fetched and mapped again rather than kept for all.
    fetched = cut(rivals.join(rows.withColumnRenamed("key", "first_key"), "first_key").withColumn("form", mapped(F.col("text"))).drop("text"))
    reads = fetched.groupBy("skeleton", reading(F.col("form")).alias("reads")).agg(F.min("first_key").alias("class_id"), F.min("form").alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1").alias("r")
    on = (F.col("f.skeleton") == F.col("r.skeleton")) & (reading(F.col("f.form")) == F.col("r.reads"))
    alike = fetched.alias("f").join(reads, on).select("f.form_hash", "r.class_id", "r.canonical")
    texts = forms.select("form_hash", "first_key").join(alike, "form_hash", "left").select("form_hash", F.coalesce("class_id", "first_key").alias("class_id"), "canonical")
    return members, texts


def canonical_texts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, canonical_text) of every document; equal canonical texts read the same, and only those."""
    _, texts = classes(documents, key, text)
    rows = documents.select(key, mapped(F.col(text)).alias("form"))
    found = rows.withColumn("form_hash", _hash(F.col("form"))).join(texts, "form_hash", "left")
    return found.select(key, "class_id", F.coalesce("canonical", "form").alias("canonical_text"))


def lookalike_pairs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: documents with different texts that read the same."""
    members, texts = classes(documents, key, text)
    members = members.where("inked").select("key", "text_hash", "form_hash")
    distinct = members.select("text_hash", "form_hash").distinct().join(texts.select("form_hash", "class_id"), "form_hash").select("text_hash", "class_id")
    several = cut(distinct.join(distinct.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class_id"), "class_id"))
    a, b = several.select("class_id", F.col("text_hash").alias("hash_a")), several.select("class_id", F.col("text_hash").alias("hash_b"))
    # Pairs of different texts first: copies of one text never meet each other.
    pairs = a.join(b, "class_id").where("hash_a < hash_b").select("hash_a", "hash_b")
    ma, mb = members.select(F.col("key").alias("a"), F.col("text_hash").alias("hash_a")), members.select(F.col("key").alias("b"), F.col("text_hash").alias("hash_b"))
    return pairs.join(ma, "hash_a").join(mb, "hash_b").select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"))
