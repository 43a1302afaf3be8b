"""Normalization of names and addresses as Column functions: regular expressions and higher-order functions, no UDF.

Functions whose lambdas use an array more than once take it as a column, and `normalized` gives each its own select:
Spark computes an expression inside a lambda anew for every element.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dictionaries as D

MOST_NAME_DIGITS = 4
_LEET_FROM, _LEET_TO = "013457", "oleast"


def lookup(table: dict[str, str]) -> Column:
    """The table as one literal to parse, which the optimizer folds to one map; a literal for each entry makes slow plans."""
    return F.str_to_map(F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in table.items())), F.lit("\x1e"), F.lit("\x1f"))


def one_of(column: Column, words: list[str]) -> Column:
    return column.isin(words)


def is_number(token: Column) -> Column:
    return token.rlike("^[0-9]+$")


@cache
def _accents() -> tuple[str, str, dict[str, str]]:
    """Characters below U+0250 that lose their marks: one to one, and to several."""
    one, several = {}, {}
    for code in range(0x80, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if plain != chr(code):
            (one if len(plain) == 1 else several)[chr(code)] = plain
    return "".join(one), "".join(one.values()), several


def strip_accents(text: Column) -> Column:
    """Latin letters without their marks; other scripts stay."""
    from_, to, several = _accents()
    out = F.translate(text, from_, to)
    for char, plain in several.items():
        out = F.replace(out, F.lit(char), F.lit(plain))
    return F.when(text.rlike("[\u0080-ɏ]"), out).otherwise(text)


@cache
def _indic() -> dict[str, tuple[str, str]]:
    """(role, letters) of each character from U+0900 to U+0DFF that has a part in romanisation, by its Unicode name."""
    out = {}
    for code in range(0x900, 0xE00):
        name = unicodedata.name(chr(code), "").partition(" ")[2]
        kind, _, rest = name.partition(" ")
        if kind == "LETTER" and rest in D.INDIC_VOWELS:
            out[chr(code)] = ("vowel", D.INDIC_VOWELS[rest])
        elif kind == "LETTER":
            out[chr(code)] = ("consonant", D.INDIC_CONSONANTS.get(rest, rest.lower().removesuffix("a")) + "a")
        elif name.startswith("VOWEL SIGN "):
            out[chr(code)] = ("sign", D.INDIC_VOWELS.get(name[11:], ""))
        elif name.startswith("SIGN VIRAMA"):
            out[chr(code)] = ("sign", "")
        elif name.startswith(("SIGN ANUSVARA", "SIGN CANDRABINDU")):
            out[chr(code)] = ("vowel", "n")
        elif name.startswith("SIGN VISARGA"):
            out[chr(code)] = ("vowel", "h")
        elif kind == "DIGIT":
            out[chr(code)] = ("vowel", str(unicodedata.digit(chr(code))))
    return out


def transliterate(text: Column) -> Column:
    """Indic scripts in Latin letters. A consonant brings an "a", which a vowel sign or virama takes away; a word's last one is silent."""
    table = _indic()
    role, letters = lookup({k: v[0] for k, v in table.items()}), lookup({k: v[1] for k, v in table.items()})
    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("open"))

    def step(state: Column, char: Column) -> Column:
        kind, own = F.try_element_at(role, char), F.coalesce(F.try_element_at(letters, char), F.lit(""))
        short = F.when((kind == "sign") & state["open"] & state["out"].endswith("a"), F.left(state["out"], F.length(state["out"]) - 1)).otherwise(state["out"])
        indic = char.rlike("[ऀ-෿]")
        out = F.when(~indic, F.concat(state["out"], char)).otherwise(F.concat(short, own))
        open_ = F.when(~indic, F.lit(False)).when(kind.isNull(), state["open"]).otherwise(kind == "consonant")
        return F.struct(out.alias("out"), open_.alias("open"))

    romanised = F.aggregate(F.split(text, ""), start, step)["out"]
    silent = F.regexp_replace(romanised, r"(?U)\b(\w{2,}?[^aeiou\s\d])a\b", "$1")
    return F.when(text.rlike("[ऀ-෿]"), silent).otherwise(text)


def base_clean(text: Column) -> Column:
    out = strip_accents(F.lower(transliterate(F.coalesce(text, F.lit("")))))
    out = F.translate(F.replace(out, F.lit("&"), F.lit(" and ")), "'’", "")
    return F.regexp_replace(out, r"(?U)\b([a-z])\.", "$1")


def only_words(text: Column) -> Column:
    """Letters, digits and Indic vowel signs; all else is a space."""
    return F.regexp_replace(text, r"(?U)[^\w\sऀ-෿]|_", " ")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"(?U)\s+"), lambda t: t != "")


def without_repeats(array: Column) -> Column:
    """Without elements equal to the one before. The array must be a column."""
    return F.filter(array, lambda x, i: (i == 0) | (x != F.get(array, i - 1)))


def strip_zeros(token: Column) -> Column:
    short = F.ltrim(token, F.lit("0"))
    return F.when(is_number(token), F.when(short == "", "0").otherwise(short)).otherwise(token)


def fix_leet(token: Column) -> Column:
    """Digits typed for letters, in tokens that begin with a letter and have three or more."""
    letters = F.length(F.regexp_replace(token, "[^a-z]", ""))
    return F.when(token.rlike("^[a-z]+[0-9][a-z0-9]*$") & (letters >= 3), F.translate(token, _LEET_FROM, _LEET_TO)).otherwise(token)


def replaced(array: Column, table: dict[str, str]) -> Column:
    """Each token by its replacement, which may be several words."""
    words = lookup(table)
    return F.flatten(F.transform(array, lambda t: F.split(F.coalesce(F.try_element_at(words, t), t), " ")))


def name_tokens(name: Column) -> Column:
    """A name's tokens, cleaned and written out, with repeats."""
    out = base_clean(name)
    out = F.regexp_replace(out, r"(?U)\b(?:https?://)?(?:www\.)?([a-z0-9-]+)\.(?:co\.in|com|in|net|org|co|biz|info|fr|us)\b", " $1 ")
    out = F.regexp_replace(out, r"(?U)\bm\s*/\s*s\b", " ")
    out = F.regexp_replace(out, r"(?U)\bid\s*[:#.\-]?\s*\d+", " ")
    kept = F.filter(tokens(only_words(out)), lambda t: ~(is_number(t) & (F.length(t) > MOST_NAME_DIGITS)))
    return replaced(F.transform(kept, fix_leet), D.NAME_ABBREVIATIONS)


def component_tokens(address: Column) -> Column:
    """An address's components (by comma, semicolon or bar) as arrays of raw tokens."""

    def cleaned(part: Column) -> Column:
        out = F.regexp_replace(part, r"(?U)\b[cs]\s*/\s*o\b", " ")
        out = F.regexp_replace(out, r"(?U)\bn\s*/\s*a\b", " ")
        out = F.regexp_replace(out, r"(?U)\b(\d+)(?:st|nd|rd|th)\b", "$1")
        out = F.regexp_replace(only_words(out), r"(?U)(?<=\d)(?=[^\W\d_])|(?<=[^\W\d_])(?=\d)", " ")
        return tokens(out)

    return F.filter(F.transform(F.split(base_clean(address), r"[,;|]"), cleaned), lambda raw: F.size(raw) > 0)


def _state_map(country: Column, of: Column) -> Column:
    out = F.lit(None).cast("string")
    for c, table in D.STATES.items():
        out = F.when(country == c, F.try_element_at(lookup(table), of)).otherwise(out)
    return out


def parsed_component(raw: Column, country: Column) -> Column:
    """struct(state, tokens, numbers, postcode) of a component's raw tokens; postcode is null where it has none."""
    last, head = F.get(raw, F.size(raw) - 1), F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0)))
    whole = _state_map(country, F.array_join(raw, " "))
    with_zip = F.when((F.size(raw) >= 2) & is_number(last), _state_map(country, F.array_join(head, " ")))
    state, zip_ = F.coalesce(whole, with_zip), F.when(whole.isNull(), last)
    as_state = F.struct(
        state.alias("state"),
        F.when(zip_.isNull(), F.array(state)).otherwise(F.array(state, strip_zeros(zip_))).alias("tokens"),
        F.when(zip_.isNull(), F.array().cast("array<string>")).otherwise(F.array(zip_)).alias("numbers"),
        F.when(F.length(zip_).isin(5, 6), zip_).alias("postcode"),
    )
    held = F.filter(raw, lambda t: ~one_of(t, D.ADDRESS_STOP))
    mapped = replaced(held, D.ADDRESS_ABBREVIATIONS[""])
    for c in ("us", "india", "france"):
        mapped = F.when(country == c, replaced(held, D.ADDRESS_ABBREVIATIONS[c])).otherwise(mapped)
    digits = F.filter(raw, is_number)
    first = F.get(raw, F.lit(0))
    lone = (F.size(digits) == 1) & ~F.exists(mapped, lambda t: one_of(t, D.STREET))
    code = F.when((country != "india") & is_number(first) & (F.length(first) == 5) & (lone | (F.size(raw) == 1)), first)
    once = F.get(F.transform(F.array(mapped), without_repeats), F.lit(0))  # a lambda's argument is computed once
    plain = F.struct(F.lit(None).cast("string").alias("state"), F.transform(once, strip_zeros).alias("tokens"), digits.alias("numbers"), code.alias("postcode"))
    return F.when(state.isNotNull(), as_state).otherwise(plain)


def normalized(records: DataFrame) -> DataFrame:
    """entity_id, country and the six normalized columns of records (entity_id, business_name, business_address, country). Null is empty."""
    step = records.select("entity_id", F.lower(F.trim(F.coalesce("country", F.lit("")))).alias("country"), name_tokens(F.col("business_name")).alias("names"), component_tokens(F.col("business_address")).alias("raw"))
    step = step.select("entity_id", "country", without_repeats(F.col("names")).alias("names"), F.transform("raw", lambda r: parsed_component(r, F.col("country"))).alias("parts"))
    numbers = F.flatten(F.transform("parts", lambda p: p["numbers"]))
    codes = F.filter(F.transform("parts", lambda p: p["postcode"]), lambda c: c.isNotNull())
    states = F.filter(F.transform("parts", lambda p: p["state"]), lambda c: c.isNotNull())
    pins = F.when(F.col("country") == "india", F.filter(numbers, lambda n: n.rlike("^[1-9][0-9]{5}$"))).otherwise(F.array().cast("array<string>"))
    last = lambda a: F.try_element_at(a, F.lit(-1))
    step = step.select(
        "entity_id",
        "country",
        "names",
        F.filter("names", lambda t: ~one_of(t, D.NAME_STOP)).alias("core"),
        F.flatten(F.transform("parts", lambda p: p["tokens"])).alias("tokens"),
        F.array_distinct(F.transform(numbers, strip_zeros)).alias("numbers"),
        F.coalesce(last(pins), last(codes), F.lit("")).alias("postcode"),
        F.coalesce(last(states), F.lit("")).alias("state"),
    )
    own = F.when(F.col("postcode") == "", F.lit("")).otherwise(strip_zeros(F.col("postcode")))
    by_size = F.array_sort(F.transform(F.filter("numbers", lambda n: n != own), lambda n: F.struct(F.length(n).alias("l"), n.alias("n"))))
    return step.select(
        "entity_id",
        "country",
        F.array_join("names", " ").alias("name_norm"),
        F.array_join(F.when(F.size("core") > 0, F.col("core")).otherwise(F.col("names")), " ").alias("name_core"),
        F.array_join(without_repeats(F.col("tokens")), " ").alias("addr_norm"),
        F.array_join(F.transform(by_size, lambda x: x["n"]), " ").alias("addr_nums"),
        "postcode",
        "state",
    )


def light(text: Column) -> Column:
    """Light normalization for profiles: lower case, punctuation as space, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}\s]", " "), r"\s+", " "))
