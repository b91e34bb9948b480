"""Text normalization, phonetic skeletons and token functions as Column expressions; no Python runs on the rows."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
LEGAL_SUFFIXES = ("private", "pvt", "limited", "ltd", "corporation", "corp", "inc", "llc", "co", "sarl", "sasu", "sas", "sa", "eurl", "sci", "snc", "gie", "cie", "association", "gmbh")
STREET_SYNONYMS = {"road": ("rd",), "avenue": ("ave",), "boulevard": ("blvd", "bd"), "route": ("rte",), "chemin": ("chem",)}
PUNCTUATION = r"[^a-z0-9\s]"
LEADING_ZEROS = r"\b0+(\d)"
SKELETON_STEPS = (("x", "ks"), ("([pbktdscg])h", "$1"), ("c(?=[eiy])", "s"), ("g(?=[eiy])", "j"), ("[cqg]", "k"), ("f", "p"), ("[vw]", "b"), ("d", "t"), ("[zj]", "s"), ("m", "n"), ("[aeiouyh]", ""), (r"([a-z])\1+", "$1"))
SKELETON_STOP = r"\b(prbt|pbt|lnt|lt|pr|l)\b"
#: Latin letters that don't decompose to a letter and marks.
# Letters by sound, in alphabetical order of each script; "." drops a sign.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяёєіїґ", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch . y . e iu ia io ie i i g".split()))
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψωάέήίόύώϊϋΐΰ", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o a e e i o u o i u i u".split()))
ARABIC = dict(zip("ءآأؤإئابةتثجحخدذرزسشصضطظعغفقكلمنهوىيپچژگ", ". a a w i y a b h t th j h kh d dh r z s sh s d t z . gh f q k l m n h w a y p ch zh g".split()))
LATIN = {"ß": "ss", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "TH", "ð": "d", "Ð": "D", "ı": "i", "ŋ": "n", "Ŋ": "N", "ħ": "h", "Ħ": "H"}
#: The Devanagari block from U+0901 on, in order; "." drops a sign or is not assigned. The other Indic blocks up to
#: Malayalam are laid out alike, 0x80 apart.
INDIC = "m m h a a a i i u u ri l e e e ai o o o au k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v s s s h . . . . a i i u u ri r e e e ai o o o au ."
INDIC_BLOCKS = range(0x0900, 0x0D80, 0x80)


@lru_cache(None)
def _tables() -> tuple[str, str, dict[str, str]]:
    """Characters that one character replaces, their replacements, and those that need more."""
    one: dict[str, str] = {}
    more: dict[str, str] = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if x.isascii())
        if len(base) == 1 and base.isalpha():
            one[chr(code)] = base
    scripts = {k: v for table in (CYRILLIC, GREEK, ARABIC) for k, v in table.items() if v != "."}
    scripts |= {k.upper(): v.capitalize() for k, v in scripts.items() if len(k.upper()) == 1 and k.upper() != k}
    for k, v in (LATIN | scripts).items():
        (one if len(v) == 1 else more)[k] = v
    one |= {chr(0x0660 + i): str(i) for i in range(10)} | {chr(0x06F0 + i): str(i) for i in range(10)}
    first = INDIC_BLOCKS[0]
    for i, sound in enumerate(INDIC.split()):
        sound = "" if sound == "." else sound
        for block in INDIC_BLOCKS:
            c = chr(block + 1 + i)
            if len(sound) == 1:
                one[c] = sound
            elif sound:
                if block == first:
                    more[c] = sound
                else:
                    one[c] = chr(first + 1 + i)
    for block in INDIC_BLOCKS:
        for digit in range(10):
            one[chr(block + 0x66 + digit)] = str(digit)
    return "".join(one), "".join(one.values()), more


def to_ascii(c: Column) -> Column:
    """Latin letters without marks, Cyrillic, Greek, Arabic and Indic scripts by sound, other characters gone. Null is empty."""
    singles, values, more = _tables()
    given = F.coalesce(c.cast("string"), F.lit(""))
    out = F.translate(given, singles, values)
    for k, v in more.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return F.when(F.length(given) == F.octet_length(given), given).otherwise(F.regexp_replace(out, r"[^\x00-\x7F]", ""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize(c: Column, legal: bool = False, streets: bool = False, ascii_input: bool = False) -> Column:
    """Transliterate, lower, & to and, punctuation to space, zero padding off, then suffixes or streets, then spaces.

    ascii_input leaves the transliteration out where the text is known to be ASCII."""
    out = F.lower(F.coalesce(c.cast("string"), F.lit("")) if ascii_input else to_ascii(c))
    out = F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), PUNCTUATION, " ")
    out = F.regexp_replace(out, LEADING_ZEROS, "$1")
    if legal:
        out = F.regexp_replace(out, rf"\b({'|'.join(LEGAL_SUFFIXES)})\b", " ")
    if streets:
        for word, short in STREET_SYNONYMS.items():
            out = F.regexp_replace(out, rf"\b({'|'.join(short)})\b", word)
    return collapse(out)


def normalize_name(c: Column, ascii_input: bool = False) -> Column:
    return normalize(c, legal=True, ascii_input=ascii_input)


def normalize_address(c: Column, ascii_input: bool = False) -> Column:
    return normalize(c, streets=True, ascii_input=ascii_input)


def skeleton(name_clean: Column) -> Column:
    out = F.coalesce(name_clean, F.lit(""))
    for pattern, to in SKELETON_STEPS:
        out = F.regexp_replace(out, pattern, to)
    return collapse(F.regexp_replace(out, SKELETON_STOP, ""))


def clean_text_v0(c: Column) -> Column:
    """The exploratory variant: suffixes go before punctuation, nothing is transliterated."""
    out = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    out = F.regexp_replace(out, rf"\b({'|'.join(LEGAL_SUFFIXES)})\b", " ")
    return collapse(F.regexp_replace(out, PUNCTUATION, " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")


def numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\d+)"), 1))


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct substrings of length n; a shorter text is one; an empty one has none."""
    size = F.length(c)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(size == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(windows))


def postal_code(c: Column) -> Column:
    """The last run of 5 or 6 digits that ends at a word's end, or null."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(r"(\d{5,6}\b)"), 1), F.lit(-1))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct elements; two empty ones give 0."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def dice(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(2 * F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)), F.lit(0.0))


def order_key(seed: int, *ids: Column) -> Column:
    """A number below 2^32 that shuffles rows the same way on every run and engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *ids)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
