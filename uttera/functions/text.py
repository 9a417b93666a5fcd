"""Column functions for text: validity, normalisation, category, similarity, names."""

from __future__ import annotations

import difflib
import os
import unicodedata
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from uttera.config import ONE_IS_I

#: Characters written as several, or whose decomposition is not a letter.
SPECIAL = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "ı": "i",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "«": "<<", "»": ">>", "‹": "<", "›": ">", "🙶": '"', "🙷": '"', "′": "'", "″": '"',
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "…": "...", "¡": "!", "¿": "?", " ": " ",
}

#: Letters of other scripts whose usual spelling does not follow from their names.
_NAMED = {
    "ALPHA": "a", "BETA": "b", "GAMMA": "g", "DELTA": "d", "EPSILON": "e", "ZETA": "z", "ETA": "e", "THETA": "th", "IOTA": "i", "KAPPA": "k", "LAMDA": "l", "MU": "m", "NU": "n", "XI": "x", "OMICRON": "o", "PI": "p", "RHO": "r", "SIGMA": "s", "FINAL SIGMA": "s", "TAU": "t", "UPSILON": "u", "PHI": "ph", "CHI": "kh", "PSI": "ps", "OMEGA": "o",
    "GHE": "g", "GHE WITH UPTURN": "g", "IE": "e", "SHORT I": "i", "BYELORUSSIAN-UKRAINIAN I": "i", "UKRAINIAN IE": "e", "HA": "kh", "HARD SIGN": '"', "SOFT SIGN": "'", "YERU": "y", "YU": "iu", "YA": "ia", "SHCHA": "shch", "SHORT U": "u", "JE": "j", "TSHE": "ch",
}

#: Confusions of letters that are put right last, in order.
FIXES = (("L'M", "I'M"), ("L'D", "I'D"), ("T'M", "I'M"), ("T'D", "I'D"), ("DONT", "DON'T"))

#: Characters that cleaned texts are made of.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 '"

_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _accents() -> tuple[str, str]:
    """Latin letters with marks and their plain letters, from their canonical decompositions."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(unicodedata.normalize("NFD", chr(c))) > 1]
    pairs = [(a, b) for a, b in pairs if b.isascii() and a not in SPECIAL]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def _letter(char: str) -> str | None:
    """Greek or Cyrillic letter in ASCII, from its name: its consonants, or the whole name of a vowel; None for other characters."""
    base = unicodedata.normalize("NFD", char)[0]
    for c in (char, base):
        script, _, rest = unicodedata.name(c, "").partition(" ")
        size, _, name = rest.partition(" LETTER ")
        if script in ("GREEK", "CYRILLIC") and size in ("CAPITAL", "SMALL") and name:
            plain = _NAMED.get(name)
            if plain is None and script == "CYRILLIC" and name.isalpha() and len(name) <= 4:
                consonants = name.strip("AEIOUY")
                plain = (consonants or name).lower()
            if plain is not None:
                return plain.capitalize() if size == "CAPITAL" else plain
    return None


def _scripts() -> dict[str, str]:
    """Greek and Cyrillic letters, with marks too, and how they are written in ASCII."""
    found = {chr(c): _letter(chr(c)) for c in [*range(0x370, 0x400), *range(0x400, 0x460), 0x490, 0x491, *range(0x1F00, 0x2000)]}
    return {k: v for k, v in found.items() if v is not None}


SCRIPTS = _scripts()
#: Texts without a character of these ranges are left alone by the longer map.
SCRIPT_RANGE = "[\\x{370}-\\x{4FF}\\x{1F00}-\\x{1FFF}]"


def transliterate(c: Column) -> Column:
    """Closest ASCII for Latin, Greek and Cyrillic letters, quotes, dashes and the like; one translate and a replace for each longer form."""
    scripts = F.when(c.rlike(SCRIPT_RANGE), _written(c, SCRIPTS)).otherwise(c)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(_written(scripts, {**dict(zip(ACCENTED, PLAIN, strict=True)), **SPECIAL}))  # ASCII stays as it is


def _written(c: Column, letters: dict[str, str]) -> Column:
    single = {k: v for k, v in letters.items() if len(v) == 1}
    c = F.translate(c, "".join(single), "".join(single.values()))
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), [(k, v) for k, v in letters.items() if len(v) > 1], c)


def has_star(c: Column) -> Column:
    return c.contains("*")


def has_stutter(c: Column) -> Column:
    """A letter, a hyphen and a letter; ordinary hyphenated words as well."""
    return c.rlike("[A-Za-z]-[A-Za-z]")


def invalid(c: Column) -> Column:
    return has_star(c) | has_stutter(c)


def collapse_repeats(c: Column, char: str = ".", most: int = 10) -> Column:
    """Runs of 2 to ``most`` of a character become one, longest first."""
    return reduce(lambda x, n: F.replace(x, F.lit(char * n), F.lit(char)), range(most, 1, -1), c)


#: All but ASCII letters and digits, white space, apostrophes and dots: as ranges, which are matched several times faster than the class negated.
_OTHER = r"[\x00-\x08\x0E-\x1F!-&(-\-/:-@\[-`{-\x{10FFFF}]"


def clean_text(c: Column, category: Column | None = None) -> Column:
    """Upper-case ASCII words, apostrophes kept, sentence marks dropped.

    A dot run is removed whole anyway, so collapsing it first would change nothing and is left out.
    """
    c = F.replace(F.replace(c, F.lit("|"), F.lit("I")), F.lit("\n"), F.lit(" "))
    c = F.regexp_replace(transliterate(c), "[,!?|]", ".")
    c = F.regexp_replace(c, _OTHER, "")
    c = F.trim(F.upper(F.regexp_replace(F.replace(c, F.lit("."), F.lit("")), _SPACE, " ")))
    if category is not None:
        c = F.when(category.isin(*ONE_IS_I), F.replace(c, F.lit("1"), F.lit("I"))).otherwise(c)
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), FIXES, c)


def first_category(name: Column, keys: Sequence[str]) -> Column:
    """The first key that the name holds, whatever its case; null if none."""
    return F.coalesce(*[F.when(F.lower(name).contains(k), F.lit(k)) for k in keys])


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 for two empty texts. JVM-side stand-in for ``matching_ratio``."""
    longest = F.greatest(F.length(a), F.length(b))
    cut = a.startswith(b) | b.startswith(a)  # the distance is what is missing, without the table
    return F.when(longest == 0, F.lit(1.0)).when(cut, F.lit(1.0) - F.abs(F.length(a) - F.length(b)) / longest).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longest)


def ratio(current: str, anchor: str) -> float:
    """Matching-blocks similarity; not symmetric."""
    return difflib.SequenceMatcher(None, current, anchor).ratio()


def common_letters(a: Column, b: Column, alphabet: str = ALPHABET) -> Column:
    """At least the size of the multiset of characters that two texts share: exact in ``alphabet``, the rest as if it were equal."""
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    rest = lambda c: F.length(F.translate(c, alphabet, ""))
    return reduce(lambda n, x: n + F.least(count(a, x), count(b, x)), alphabet, F.least(rest(a), rest(b)))


def matching_decided(current: Column, anchor: Column, threshold: float) -> Column:
    """A stand-in for ``ratio`` that falls on the same side of ``threshold`` and of 1, or null where cheap bounds don't tell.

    The matching blocks have at most the common letters of both texts. They have at least a common beginning or end of a text whose
    anchor is under 200 characters (from there on the exact one leaves frequent characters out).
    """
    n, m = F.length(current), F.length(anchor)
    total = n + m
    ratio_of = lambda c: 2.0 * c / total
    k = F.floor(total * threshold / 2).cast("int") + 1
    long = (k <= F.least(n, m)) & (m < 200) & (total < 100_000)
    shares = long & ((F.substring(current, F.lit(1), k) == F.substring(anchor, F.lit(1), k)) | (F.right(current, k) == F.right(anchor, k)))
    most = F.when(ratio_of(F.least(n, m)) <= threshold, ratio_of(F.least(n, m))).when(~shares, ratio_of(common_letters(current, anchor)))
    return F.when(current == anchor, F.lit(1.0)).when(shares, F.lit((1 + threshold) / 2)).when(most <= threshold, most)


def levenshtein_text(a: str, b: str) -> float:
    """``levenshtein_ratio`` of two Python strings: what they begin and end with alike goes, then a column of the distance table at a time as bits."""
    longest = max(len(a), len(b))
    if not a or not b:
        return 1.0 if a == b else 0.0
    first = len(os.path.commonprefix((a, b)))
    a, b = a[first:], b[first:]
    last = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - last], b[: len(b) - last]
    if not a or not b:
        return 1.0 - max(len(a), len(b)) / longest
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    every, top = (1 << len(a)) - 1, len(a) - 1
    up, down, distance = every, 0, len(a)  # where a column's value is one more, or one less, than the value above it
    for c in b:
        same = places.get(c, 0)
        x = same | down
        level = (((same & up) + up) ^ up) | same
        right, left = down | ~(level | up) & every, up & level
        distance += (right >> top & 1) - (left >> top & 1)
        right = right << 1 | 1
        up, down = (left << 1 | ~(x | right)) & every, right & x & every
    return 1.0 - distance / longest


@F.pandas_udf(DoubleType())
def matching_ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """``ratio`` of two columns, in Arrow batches; null if either is."""
    for current, anchor in pairs:
        yield pd.Series([None if a is None or b is None else ratio(a, b) for a, b in zip(current, anchor, strict=True)], dtype="float64")


def clip_name(speaker: Column, video: Column, index: Column) -> Column:
    return F.format_string("%s-%d-%04d", speaker, video, index)


def strip_suffix(name: Column, suffix: str = ".wav") -> Column:
    return F.replace(name, F.lit(suffix), F.lit(""))


def normal_path(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def last_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_part(path: Column) -> Column:
    """The directory's name, empty at the top."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise("")


def python_float(c: Column) -> Column:
    """A double as Python prints it: plainly from 1e-4 to under 1e16, else with an exponent of two digits or more (subnormals as Java prints them)."""
    text = c.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)E", 1)
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    n = F.length(digits)
    high = F.when(n > power + 1, F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, n))).otherwise(F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit(".0")))
    low = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    exponent = F.concat(F.regexp_replace(mantissa, r"\.0$", ""), F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    shown = F.when((power >= 0) & (power < 16), F.concat(sign, high)).when((power < 0) & (power >= -4), F.concat(sign, low)).otherwise(F.concat(sign, exponent))
    special = F.when(c == float("inf"), "inf").when(c == float("-inf"), "-inf").when(F.isnan(c), "nan")
    return F.coalesce(special, F.when(text.contains("E"), shown).otherwise(text))


def db_factor(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)
