"""Feature expressions: targets, labels, storey text, transforms, unit conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlake.functions.cleaning import mapped

# Number words understood in free text.
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11,
}

# Storey ranges as (exclusive upper bound, label), then the open range.
STORY_RANGES = ((3, "0-2 stories"), (5, "3-4 stories"), (8, "5-7 stories"), (10, "8-9 stories"))
STORY_TOP = "More than 10 stories"
STORY_COARSE_LABEL = "5 and more stories"
STORY_COARSE_FROM = ("5-7 stories", "8-9 stories", "More than 10 stories")

# Unit factors.
SQUARE_FEET_PER_SQUARE_METRE = 10.764
REVISED_TO_ESTIMATED_RATIO = 1.6204


def first_valid(choices: list[tuple[str, Column, Column]]) -> tuple[Column, Column]:
    """(value, source label) of the first choice whose flag holds.

    ``choices`` lists (label, value, flag) from most to least preferred.
    """
    value = F.coalesce(*[F.when(flag, amount) for _, amount, flag in choices])
    label = F.coalesce(*[F.when(flag, F.lit(name)) for name, _, flag in choices])
    return value, label


def zero_filled_difference(after: Column, before: Column) -> Column:
    return F.coalesce(after, F.lit(0)) - F.coalesce(before, F.lit(0))


def interaction(first: Column, *others: Column) -> Column:
    """The product of features as a double; NULL if one of them is."""
    return reduce(lambda a, b: a * b, [c.cast("double") for c in (first, *others)])


def amount_from_log10(log_amount: Column, low: float, high: float) -> Column:
    """Back to the amount scale, held inside the model's domain; NULL stays NULL."""
    amount = F.pow(F.lit(10.0), log_amount)
    return F.when(log_amount.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), amount)))


def has_text(col: Column) -> Column:
    return F.coalesce(F.length(F.trim(col)) > 0, F.lit(False))


def is_numeric_text(col: Column) -> Column:
    return col.rlike(r"^\d+$")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def point_x(col: Column) -> Column:
    return F.regexp_extract(col, r"\(\s*(\S+)\s+\S+\s*\)", 1).try_cast("double")


def point_y(col: Column) -> Column:
    return F.regexp_extract(col, r"\(\s*\S+\s+(\S+)\s*\)", 1).try_cast("double")


def point_text(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%s %s)", x.cast("string"), y.cast("string"))


def story_word(text: Column, marker: str = "story") -> Column:
    """The word before the first ``marker``: ``"erect a two-story"`` -> ``"two"``."""
    before = F.substring_index(text, marker, 1)
    words = F.split(F.regexp_replace(before, "-", " "), " ")
    return F.try_element_at(words, F.lit(-2))


def word_to_int(word: Column, legacy: bool = False) -> Column:
    """A number word or digits as an int.

    By default the whole word must match. ``legacy`` takes the first number word
    found *inside* the text instead, so "fourteen" reads as 4.
    """
    lowered = F.lower(word)
    digits = F.trim(lowered).try_cast("int")
    if not legacy:
        return F.coalesce(mapped(lowered, NUMBER_WORDS), digits)
    found = [F.when(lowered.contains(name), F.lit(n)) for name, n in NUMBER_WORDS.items()]
    return F.coalesce(*found, digits)


def story_count(text: Column, marker: str = "story", legacy: bool = False) -> Column:
    return word_to_int(story_word(text, marker), legacy)


def repaired_story_count(value: Column, text: Column, low: float = 1, high: float = 15,
                         marker: str = "story", legacy: bool = False) -> Column:
    """Implausible or missing counts are read from the text when it mentions them."""
    doubtful = value.isNull() | (value < low) | (value > high)
    mentioned = F.coalesce(text.contains(marker), F.lit(False))
    return F.when(doubtful & mentioned, story_count(text, marker, legacy).cast("double")).otherwise(
        value.cast("double"))


def story_range(col: Column, legacy: bool = False) -> Column:
    """Labelled range of a storey count. ``legacy`` sends NULL to the top range."""
    label = F.coalesce(*[F.when(col < bound, F.lit(name)) for bound, name in STORY_RANGES],
                       F.lit(STORY_TOP))
    return label if legacy else F.when(col.isNotNull(), label)


def coarse_story_range(label: Column) -> Column:
    return F.when(label.isin(*STORY_COARSE_FROM), STORY_COARSE_LABEL).otherwise(label)


def box_cox_1p(col: Column, lam: float) -> Column:
    if lam == 0:
        return F.log1p(col)
    return (F.pow(col + 1, F.lit(float(lam))) - 1) / F.lit(float(lam))


def total_area(area: Column, storeys: Column) -> Column:
    return area * storeys


def cost_per_area(cost: Column, area: Column) -> Column:
    return F.try_divide(cost, area)


def per_square_foot(per_square_metre: Column) -> Column:
    return per_square_metre / F.lit(SQUARE_FEET_PER_SQUARE_METRE)


def uplift(col: Column, ratio: float = REVISED_TO_ESTIMATED_RATIO) -> Column:
    return col * F.lit(float(ratio))
