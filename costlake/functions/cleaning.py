"""Text-to-value cleaning expressions.

All of them hold with ANSI mode on: malformed input becomes NULL, never an error.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "no value", compared in lower case.
NULL_TOKENS = ("null", "none", "nan", "n/a")

# Date layouts, tried in this order on the whole text ...
DATE_FORMATS = (
    "yyyy/MM/dd hh:mm:ss a",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyy-MM-dd",
)
# ... and then on its first ten characters.
DATE_PREFIX_FORMATS = ("yyyy/MM/dd", "MM/dd/yyyy", "yyyy-MM-dd")

# Street suffix spellings an address lookup expects.
STREET_SUFFIXES = {"Bl": "Blvd", "Tr": "Terrace", "Cr": "Circle"}
STREET_SUFFIX_BY_STREET = {"La Playa": "Street"}

# Label -> code for permit and construction types.
PERMIT_TYPE_CODES = {
    "New Construction (Reinforced concrete, Steel, etc...)": 1,
    "New Construction Wood Frame": 2,
}
CONSTRUCTION_TYPE_CODES = {
    "Fire resistive": "1",
    "Non-combustible": "2",
    "Ordinary": "3",
    "Wood-framed": "5",
}

# Spellings of yes and no.
YES_WORDS = ("y", "yes", "true", "1")
NO_WORDS = ("n", "no", "false", "0")


def snake_case(name: str) -> str:
    """``"Permit Number (old)"`` -> ``"permit_number_old"``."""
    return "_".join(re.findall(r"[a-z0-9]+", name.lower()))


def null_if_token(col: Column, tokens=NULL_TOKENS) -> Column:
    text = F.trim(col)
    return F.when((text != "") & ~F.lower(text).isin(*tokens), text)


# What a date layout's letters can look like. Wider than the parser is strict.
_LETTER_SHAPES = {"yyyy": r"[+-]?\d{4,}", "MM": r"\d{1,2}", "dd": r"\d{1,2}", "HH": r"\d{1,2}",
                  "hh": r"\d{1,2}", "mm": r"\d{1,2}", "ss": r"\d{1,2}", "a": r"\D+"}


def _layout_shape(layout: str) -> str:
    """A pattern every text of this date layout matches."""
    pieces = re.findall(r"[A-Za-z]+|[^A-Za-z]+", layout)
    return "^" + "".join(_LETTER_SHAPES.get(p, re.escape(p)) for p in pieces) + "$"


def _if_shaped(col: Column, layout: str, parse) -> Column:
    """Parse only text of the right shape: a failed parse costs far more than the look."""
    return F.when(col.rlike(_layout_shape(layout)), parse(col, layout))


def parse_date(col: Column, formats=DATE_FORMATS, prefix_formats=DATE_PREFIX_FORMATS) -> Column:
    """The date of the first layout that fits the text, else its first ten characters."""

    def first(text: Column) -> Column:
        prefix = F.substring(text, 1, 10)
        attempts = [_if_shaped(text, f, F.try_to_date) for f in formats]
        return F.coalesce(*attempts, *[_if_shaped(prefix, f, F.try_to_date) for f in prefix_formats])

    return _apart(col, first)


def parse_timestamp(col: Column, formats=DATE_FORMATS) -> Column:
    def first(text: Column) -> Column:
        attempts = [_if_shaped(text, f, lambda c, layout: F.try_to_timestamp(c, F.lit(layout))) for f in formats]
        return F.coalesce(F.try_to_timestamp(text), *attempts)

    return _apart(col, first)


def _apart(col: Column, parse) -> Column:
    """``parse(col)`` as a lambda: its code stays out of the row loop, which the JVM compiles up to a fixed size only."""
    return F.get(F.transform(F.array(col), parse), 0)


def parse_int(col: Column) -> Column:
    """Whole part of a number that may carry thousands commas and a fraction."""
    digits = F.regexp_extract(F.regexp_replace(F.trim(col), ",", ""), r"^([+-]?\d+)(?:\.\d*)?$", 1)
    return digits.try_cast("int")


def parse_money(col: Column) -> Column:
    return F.regexp_replace(col, "[$,]", "").try_cast("double")


def extract_zip(col: Column) -> Column:
    return F.nullif(F.regexp_extract(col, r"(\d{5})", 1), F.lit(""))


def legacy_zip(col: Column, missing: str = "") -> Column:
    """Zip codes that went through a float column: ``94110.0`` -> ``94110``."""
    text = F.regexp_replace(col.cast("string"), r"\.0$", "")
    return F.when(text.isNull() | text.isin("0", ""), F.lit(missing)).otherwise(text)


def street_name(col: Column) -> Column:
    return F.regexp_replace(col, "^0", "")


def mapped(col: Column, mapping: dict, default: Column | None = None) -> Column:
    """Translate a value through a small literal map; ``default`` otherwise."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    hit = F.element_at(F.create_map(*pairs), col)
    return hit if default is None else F.coalesce(hit, default)


def street_suffix(suffix: Column, street: Column | None = None) -> Column:
    out = F.coalesce(mapped(suffix, STREET_SUFFIXES, suffix), F.lit(" "))
    if street is None:
        return out
    return F.coalesce(mapped(street, STREET_SUFFIX_BY_STREET), out)


def full_address(number: Column, street: Column, suffix: Column | None, zipcode: Column,
                 city: str = ", San Francisco, CA ") -> Column:
    words = [number.cast("string"), street] + ([] if suffix is None else [suffix])
    spaced = [piece for word in words for piece in (F.lit(" "), word)][1:]
    return F.concat(*spaced, F.lit(city), zipcode)


def construction_type(col: Column, missing: str = "99") -> Column:
    roman = F.when(col == "III", F.lit("3")).otherwise(col)
    return F.coalesce(roman, F.lit(missing)).try_cast("double").try_cast("int").cast("string")


def permit_type_code(col: Column) -> Column:
    return mapped(col, PERMIT_TYPE_CODES, F.lit(2))


def construction_type_code(col: Column) -> Column:
    return mapped(col, CONSTRUCTION_TYPE_CODES, F.lit("Other"))


def code_label(col: Column, codes: dict) -> Column:
    """The inverse of a label -> code map."""
    return mapped(col, {code: label for label, code in codes.items()})


def money_text(col: Column) -> Column:
    """Whole dollars with blanks between thousands: ``1234567.8`` -> ``1 234 567``."""
    whole = col.try_cast("bigint").cast("string")
    return F.regexp_replace(whole, r"(?<=\d)(?=(\d{3})+$)", " ")


def yes_flag(col: Column) -> Column:
    """1 for yes, 0 for no, NULL for anything else."""
    word = F.lower(F.trim(col))
    return F.when(word.isin(*YES_WORDS), 1).when(word.isin(*NO_WORDS), 0)
