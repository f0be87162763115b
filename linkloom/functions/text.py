"""Text normalisation, tokens, numbers and scripts as column expressions.

Everything is a built-in expression except where Unicode normalisation, full case folding or
transliteration is needed, which Spark's SQL lacks; these are Arrow-batched and see one column each.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Token mappings, legal suffixes, and the names of scripts.
NAME_MAPPINGS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company"}
ADDRESS_MAPPINGS = {"rd": "road", "ave": "avenue", "ln": "lane", "hwy": "highway", "apt": "apartment"}
STREET_MAPPING = {"st": "street"}
SUFFIXES = ("private", "limited", "corporation", "incorporated", "company", "llc", "llp")
SCRIPTS = ("LATIN", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "ARABIC", "CYRILLIC", "GREEK", "HEBREW", "HANGUL", "HIRAGANA", "KATAKANA")
INDIC = ("DEVANAGARI", "BENGALI", "GUJARATI", "GURMUKHI", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")
# Letters that decomposition leaves as they are.
LATIN_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i", "ħ": "h", "ŋ": "ng"}


# ---------------------------------------------------------------- cleaning

@F.pandas_udf(StringType())
def _fold_compatible(values: pd.Series) -> pd.Series:
    return values.map(lambda x: x if x is None else x.lower() if x.isascii() else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(StringType())
def _fold_decomposed(values: pd.Series) -> pd.Series:
    def one(x):
        if x is None or x.isascii():
            return x if x is None else x.lower()
        return "".join(c for c in unicodedata.normalize("NFKD", x.casefold()) if not unicodedata.combining(c))

    return values.map(one)


def without_marks(text: str) -> str:
    """Decomposed, without combining marks."""
    return text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


# ---------------------------------------------------------------- Latin forms of letters

_VOWELS = frozenset("aeiou")
_DOUBLED = re.compile(r"(.)\1+")
# Letters whose Unicode name does not begin with their sound, by the name's last words.
_SPOKEN = {"cyrillic": {"ie": "e", "io": "yo", "short i": "i", "hard sign": "", "soft sign": "", "yeru": "y", "yu": "yu", "ya": "ya", "yi": "yi", "ghe": "g"}, "greek": {"phi": "f", "rho": "r", "final sigma": "s"}}
_SIGNS = {"virama": "", "nukta": "", "avagraha": "", "anusvara": "n", "candrabindu": "n", "visarga": "h", "bindi": "n", "tippi": "n", "addak": "", "halant": "", "au length mark": "", "ai length mark": ""}


def _sound(name: str, script: str = "") -> str:
    """The sound of an alphabet's letter by its name: its first consonants, or its vowel; a Cyrillic `el` is l."""
    first = next((k for k, c in enumerate(name) if c in _VOWELS), len(name))
    if first:
        return name[:first]
    return name[1:] if script == "cyrillic" and len(name) == 2 and name[1] not in _VOWELS else name[:1]


def _by_name(c: str) -> str | None:
    """The Latin form of a letter, mark or digit by its Unicode name; None where the name does not tell."""
    kind, name = unicodedata.category(c), unicodedata.name(c, "").lower()
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    if kind[0] not in "LM" or not name:
        return None
    words = name.split(" ")
    script, last = words[0], words[-1]
    if script.upper() in INDIC or script in ("oriya", "sinhala"):
        if " vowel sign " in name or (" letter " in name and last[:1] in _VOWELS):
            return _DOUBLED.sub(r"\1", last)
        if " letter " in name:
            # A consonant's name ends in its unspoken vowel.
            sound = last[:-1] if len(last) > 1 and last.endswith("a") else last
            return _DOUBLED.sub(r"\1", sound)
        rest = name.split(" sign ", 1)[-1]
        return _SIGNS.get(rest, "")
    if kind[0] == "M":
        return ""
    if script in ("hiragana", "katakana", "hangul", "ethiopic", "bopomofo") and (" letter " in name or " syllable " in name):
        return last
    if script in ("thai", "lao"):
        sign = name.split(" vowel sign ", 1)[-1].split("sara ", 1)[-1]
        return _DOUBLED.sub(r"\1", sign.split(" ")[-1]) if sign != name else _sound(name.split(" character ", 1)[-1].split(" letter ", 1)[-1].split(" ")[0])
    if " letter " in name:
        rest = name.split(" letter ", 1)[1].split(" with ")[0]
        return _SPOKEN.get(script, {}).get(rest, _sound(rest.split(" ")[-1], script))
    return None


def _letter_to_latin(c: str) -> str:
    if c in LATIN_LETTERS:
        return LATIN_LETTERS[c]
    if c.isascii():
        return c
    parts = without_marks(c)
    if parts and parts.isascii():
        return parts
    if parts in LATIN_LETTERS:
        return LATIN_LETTERS[parts]
    found = _by_name(c)
    if found is None and len(parts) == 1 and parts != c:
        found = _by_name(parts)
    return c if found is None else found


_latin: dict[str, str] = {}


def to_latin(text: str) -> str:
    """The Latin form of a text, case folded. Han characters and symbols, whose names tell no sound, stay."""
    if not text.isascii():
        for c in set(text) - _latin.keys():
            _latin[c] = _letter_to_latin(c)
        text = "".join(map(_latin.__getitem__, text))
    return text.casefold()


@F.pandas_udf(StringType())
def _to_latin(values: pd.Series) -> pd.Series:
    return values.map(lambda x: x if x is None else to_latin(x))


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _spelled_and(text: Column) -> Column:
    return F.replace(text, F.lit("&"), F.lit(" and "))


def clean(text: Column) -> Column:
    """Compatibility form, case folded, `&` spelled out, only letters, digits and marks kept."""
    return squeeze(F.regexp_replace(_spelled_and(_fold_compatible(text)), r"[^\p{L}\p{N}\p{M}\s]", " "))


def clean_ascii(text: Column) -> Column:
    """clean() for columns known to be ASCII, without leaving the JVM."""
    return squeeze(F.regexp_replace(_spelled_and(F.lower(text)), r"[^a-z0-9\s]", " "))


def normalize_legacy(text: Column) -> Column:
    """Decomposed without combining marks, word characters only (N1); marks of class 0 become blanks."""
    return squeeze(F.regexp_replace(_spelled_and(_fold_decomposed(text)), r"[^\p{L}\p{N}_\s]", " "))


def map_tokens(text: Column, mapping: dict[str, str]) -> Column:
    """Replaces whole tokens."""
    if not mapping:
        return text
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def strip_suffixes(text: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Drops legal suffixes from the end, all of them."""
    if not suffixes:
        return text
    return F.regexp_replace(text, "(?:(?:^| )(?:" + "|".join(rf"\Q{x}\E" for x in suffixes) + "))+$", "")


def transliterate(text: Column) -> Column:
    """An additional Latin form (T1), case folded: marks dropped, letters of other scripts by the sound in their Unicode names."""
    return _to_latin(text)


def normalized_record(
    name: Column, address: Column, country: Column, translit: bool = True, street: bool = False, name_mappings: dict[str, str] | None = None, address_mappings: dict[str, str] | None = None, suffixes: tuple[str, ...] = SUFFIXES
) -> dict[str, Column]:
    """The derived columns of a record (N5). The raw columns stay."""
    names = NAME_MAPPINGS if name_mappings is None else name_mappings
    addresses = (ADDRESS_MAPPINGS if address_mappings is None else address_mappings) | (STREET_MAPPING if street else {})
    name_norm, address_norm = map_tokens(clean(name), names), map_tokens(clean(address), addresses)
    latin = lambda x: clean(transliterate(x)) if translit else F.lit("")
    return {
        "name_norm": name_norm,
        "address_norm": address_norm,
        "name_core": strip_suffixes(name_norm, suffixes),
        "name_translit": latin(name_norm),
        "address_translit": latin(address_norm),
        "country_norm": clean(country),
        "script": script_label(name),
    }


# ---------------------------------------------------------------- tokens and numbers

def tokens(text: Column) -> Column:
    """Tokens of a squeezed text; none for an empty one."""
    return F.array_remove(F.split(text, " "), "")


def first_tokens(text: Column, n: int = 16) -> Column:
    """The first n distinct tokens."""
    return F.slice(F.array_distinct(tokens(text)), 1, n)


def numbers(text: Column) -> Column:
    """Distinct whole numbers, in digits of any script."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)\b\d+\b"), F.lit(0)))


def numbers_legacy(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)\d+"), F.lit(0)))


def postal_codes(text: Column) -> Column:
    """Distinct numbers of five or six digits."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)\b\d{5,6}\b"), F.lit(0)))


def house_number(text: Column) -> Column:
    """The first number with at most one letter after it, or '' (N10)."""
    return F.regexp_extract(text, r"(?U)\b\d+[a-z]?\b", 0)


# ---------------------------------------------------------------- scripts and flags

def scripts(text: Column) -> Column:
    """Sorted distinct scripts of a text's letters."""
    rest = "".join(rf"\p{{Is{s}}}" for s in (*SCRIPTS, "HAN"))
    found = [F.when(text.rlike(rf"[\p{{L}}&&\p{{Is{s}}}]"), F.lit(s)) for s in (*SCRIPTS, "HAN")]
    found.append(F.when(text.rlike(rf"[\p{{L}}&&[^{rest}]]"), F.lit("OTHER")))
    return F.array_sort(F.array_compact(F.array(*found)))


def script_label(text: Column) -> Column:
    """Scripts joined by +, NONE without letters."""
    return F.coalesce(F.nullif(F.array_join(scripts(text), "+"), F.lit("")), F.lit("NONE"))


def is_missing(text: Column) -> Column:
    """Whether nothing but white space is there."""
    return squeeze(text) == ""


def character_flags(text: Column) -> dict[str, Column]:
    """Flags of a text."""
    found = scripts(text)
    return {
        "non_ascii": text.rlike(r"[^\x00-\x7F]"),
        "accented_latin": text.rlike("[À-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ-ďĒ-ĥĨ-İĴ-ķĹ-ľŃ-ňŌ-őŔ-ťŨ-žƠơƯưǍ-ǜǞ-ǣǦ-ǰǴǵǸ-țȞȟȦ-ȳḀ-ẙẛẠ-ỹ]"),
        "indic": F.arrays_overlap(found, F.array(*map(F.lit, INDIC))),
        "devanagari": F.array_contains(found, "DEVANAGARI"),
        "mixed_script": F.size(found) > 1,
        "numeric_token": F.size(numbers(text)) > 0,
        "likely_postal": F.size(postal_codes(text)) > 0,
    }
