"""Name, country and identifier normalisation as Column expressions (no Python per row)."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache, reduce
from itertools import zip_longest
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The long legal forms and their short forms, applied in this order.
LEGAL_FORMS = [
    ("limited liability company", "llc"),
    ("limited liability partnership", "llp"),
    ("public limited company", "plc"),
    ("incorporated", "inc"),
    ("corporation", "corp"),
    ("cooperative", "coop"),
    ("national association", "na"),
    ("federal savings bank", "fsb"),
    ("societe anonyme", "sa"),
    ("sociedad anonima", "sa"),
    ("societe en commandite", "sca"),
    ("societe a responsabilite limitee", "sarl"),
    ("sociedad de responsabilidad limitada", "srl"),
    ("sociedad limitada", "sl"),
    ("aktiengesellschaft", "ag"),
    ("gesellschaft mit beschraenkter haftung", "gmbh"),
    ("naamloze vennootschap", "nv"),
    ("besloten vennootschap", "bv"),
    ("open joint stock", "ojsc"),
    ("closed joint stock", "cjsc"),
    ("private joint stock", "pjsc"),
    ("public joint stock", "pjsc"),
    ("joint stock company", "jsc"),
    ("joint stock bank", "jsb"),
    ("private joint-stock", "pjsc"),
    ("public joint-stock", "pjsc"),
    ("commercial bank", "cb"),
]

# Country spellings, already lower-case ASCII, and the key each stands for.
COUNTRY_ALIASES = {
    "viet nam": "vietnam",
    "turkiye": "turkey",
    "dem rep congo": "democratic republic of the congo",
    "dem rep of congo": "democratic republic of the congo",
    "democratic republic of congo": "democratic republic of the congo",
    "rep of the congo": "republic of the congo",
    "rep of congo": "republic of the congo",
    "central african rep": "central african republic",
    "gambia": "the gambia",
    "eswatini": "swaziland",
    "palestine state of": "palestine",
    "state of palestine": "palestine",
    "taiwan province of china": "taiwan",
    "hong kong sar": "hong kong",
    "macau": "macao",
    "korea republic of": "south korea",
    "republic of korea": "south korea",
    "korea south": "south korea",
    "usa": "united states",
    "us": "united states",
    "united states of america": "united states",
    "holy see": "vatican city",
    "vatican": "vatican city",
    "czech republic": "czechia",
    "uk": "united kingdom",
    "great britain": "united kingdom",
    "bvi": "british virgin islands",
    "east timor": "timor leste",
}

# Quote marks that are deleted, not spaced.
QUOTES = "«»„\"‘’“”"

# Stock-exchange ticker in brackets with the white space before it.
TICKER = r"(?U)[\s\x1c-\x1f]*\([A-Z]{1,6}:[A-Z0-9.]+\)"

# A hyphen between two letters, digits or underscores of any script.  The hyphen comes first
# in the pattern, so that the search can skip to it.
_INNER_HYPHEN = r"-(?<=[\p{L}\p{N}_]-)(?=[\p{L}\p{N}_])"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NON_ASCII = r"[^\x00-\x7F]+"


@lru_cache(maxsize=1)
def ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Non-ASCII characters whose compatibility decomposition keeps ASCII characters.

    Combining marks fall away with the rest of the non-ASCII output, so the fold acts on
    each character alone.  Returns the one-to-one and the one-to-many parts.
    """
    single, several = {}, {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 0x80)
        if len(kept) == 1:
            single[char] = kept
        elif kept:
            several[char] = kept
    return single, several


def _class_of(chars) -> str:
    """Regex class matching the given characters, neighbours joined into ranges."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _table(pairs: dict[str, str]) -> Column:
    """Constant map, written as one string so that building the plan stays quick."""
    text = "\x01".join(f"{key}\x02{value}" for key, value in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def _ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def _fold_common(text: Column) -> Column:
    single, _ = ascii_folds()
    folded = F.translate(text, "".join(single), "".join(single.values()))
    return F.when(_ascii(text), text).otherwise(folded)


def _fold_rest(text: Column) -> Column:
    _, several = ascii_folds()
    table = _table(several)
    spelled = F.array_join(
        F.transform(
            F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)),
            lambda c: F.coalesce(F.try_element_at(table, c), c),
        ),
        "",
    )
    # The large character class only sees the few characters still to fold.
    foreign = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    rest = F.when(foreign.rlike(_class_of(several)), spelled).otherwise(text)
    return F.when(_ascii(text), text).otherwise(F.regexp_replace(rest, _NON_ASCII, ""))


def ascii_fold(text: Column) -> Column:
    """Compatibility-decompose and keep the ASCII characters.

    ASCII text passes through; accented letters cost one ``translate``; only text that
    still holds a character folding to several is split up.
    """
    return _fold_rest(_fold_common(text))


# Plain substring searches keep most names away from the regular expressions below.


def _drop_tickers(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("(")), F.regexp_replace(text, TICKER, "")).otherwise(text)


def _drop_quotes(text: Column) -> Column:
    quoted = F.contains(text, F.lit('"')) | ~_ascii(text)
    return F.when(quoted, F.regexp_replace(text, f"[{QUOTES}]", "")).otherwise(text)


def _split_hyphens(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("-")), F.regexp_replace(text, _INNER_HYPHEN, " ")).otherwise(text)


def _shorten_forms(text: Column) -> Column:
    """Replace the legal forms.

    One scan marks them and a lookup replaces them.  That equals applying the rules one
    after the other: the only forms that can overlap ("open joint stock" and "joint stock
    company", and the like) are also ordered so that the one starting first wins, and no
    short form is part of a long one.
    """
    any_form = r"\b(" + "|".join(phrase for phrase, _ in LEGAL_FORMS) + r")\b"
    table = _table(dict(LEGAL_FORMS))
    # The mark itself may stand in a name; there it is one more character that is no word's.
    unmarked = F.translate(text, "\x01", ".")
    pieces = F.split(F.regexp_replace(unmarked, any_form, "\x01$1\x01"), "\x01")
    shortened = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")
    # Every form holds one of these words.
    marks = dict.fromkeys(max(phrase.split(), key=len) for phrase, _ in LEGAL_FORMS)
    some = reduce(lambda x, y: x | y, [F.contains(text, F.lit(mark)) for mark in marks])
    return F.when(some, shortened).otherwise(text)


def _words_only(text: Column) -> Column:
    words = F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))
    return F.coalesce(words, F.lit(""))  # never null, so joins on it add no null checks


def _canonical(key: Column) -> Column:
    table = _table(COUNTRY_ALIASES)
    return F.coalesce(F.try_element_at(table, key), key)


# The steps of either normalisation.  As separate projections every step is computed once
# per row; nested into one expression, those used several times would be repeated.
_NAME_STEPS = [
    lambda c: _drop_tickers(F.coalesce(c.cast("string"), F.lit(""))),
    _drop_quotes,
    _split_hyphens,
    _fold_common,
    _fold_rest,
    F.lower,
    _shorten_forms,
    _words_only,
]
_COUNTRY_STEPS = [
    lambda c: F.coalesce(c.cast("string"), F.lit("")),
    _fold_common,
    _fold_rest,
    F.lower,
    lambda c: _words_only(F.replace(c, F.lit("&"), F.lit(" and "))),
    _canonical,
]


def _chain(steps, text: Column) -> Column:
    """All steps as one expression, each bound to a variable so that none is repeated."""
    for step in steps:
        text = F.element_at(F.transform(F.array(text), step), 1)
    return text


def name_key(name: Column) -> Column:
    """Comparable form of an organisation name: lower-case ASCII words, short legal forms.

    For one-off use; ``normalise`` does the same faster, in generated code.
    """
    return _chain(_NAME_STEPS, name)


def country_key(country: Column) -> Column:
    """Canonical blocking key of a country name; missing countries share the key ''."""
    return _chain(_COUNTRY_STEPS, country)


# Built step expressions per session and column: building them takes longer than small jobs.
_built: WeakKeyDictionary = WeakKeyDictionary()


def normalise(df: DataFrame, name: str | None, country: str | None) -> DataFrame:
    """Replace a name and a country column (either may be None) by their keys, step by step."""
    built = _built.setdefault(df.sparkSession, {})
    for steps in zip_longest(_NAME_STEPS, _COUNTRY_STEPS):
        pairs = [(c, step) for c, step in zip((name, country), steps) if c and step]
        if not pairs:
            break
        for pair in pairs:
            if pair not in built:
                built[pair] = pair[1](F.col(pair[0]))
        df = df.withColumns({pair[0]: built[pair] for pair in pairs})
    return df


def lei_set(value: Column) -> Column:
    """Distinct identifiers of a pipe-separated list; empty array for none."""
    parts = F.split(F.coalesce(value.cast("string"), F.lit("")), r"\|")
    trimmed = F.transform(parts, lambda x: F.regexp_replace(x, _EDGE_SPACE, ""))
    return F.array_distinct(F.filter(trimmed, lambda x: x != ""))


def lei_overlap(left: Column, right: Column) -> Column:
    """Whether two identifier lists share a member; never null."""
    return F.coalesce(F.arrays_overlap(lei_set(left), lei_set(right)), F.lit(False))
