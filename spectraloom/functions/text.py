"""Word, similarity, attribute and retention-time functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_word(word: Column) -> Column:
    """Letters A-Z only, in upper case (other letters go first: some of them have ASCII capitals)."""
    return F.upper(F.regexp_replace(word, "[^A-Za-z]", ""))


def words_of(text: Column) -> Column:
    """Array of clean words, empty ones dropped; none for a null text."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\s+"), clean_word), lambda w: w != "")


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by letters. A column of its table is two whole numbers, whose bits are the steps up and down, so that a letter of one text costs as many operations as the other has machine words (Myers, Hyyro)."""
    if len(a) < len(b):
        a, b = b, a
    if not b or a == b:
        return 0 if a == b else len(a)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = every, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        level = ((((same & up) + up) ^ up) | same | down) & every
        right, left = down | (every ^ (level | up)), level & up
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right, left = (right << 1 | 1) & every, (left << 1) & every
        up, down = left | (every ^ (level | right)), right & level
    return distance


def _distances(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if s is None or t is None else edit_distance(s, t) for s, t in zip(x, y, strict=True)], dtype="Int32")


def distances(x: Column, y: Column) -> Column:
    """Edit distance of two texts by letters, null with a null."""
    return F.pandas_udf(_distances, "int")(x, y)


def similarity(a: Column, b: Column) -> Column:
    """(longest - edit distance) / longest of the lower-cased strings; 1 for two empty ones, null with a null."""
    x, y = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(1.0)).otherwise((longest - distances(x, y)) / longest)


def fixed_substrings(text: Column, size: int) -> Column:
    """Every substring of `size` letters of the cleaned text."""
    return F.regexp_extract_all(clean_word(text), F.lit(f"(?=(.{{{size}}}))"), 1)


def case_variations(word: Column, size: int) -> Column:
    """The 2^size upper and lower case forms of a word of `size` letters."""

    def both(forms: Column, letter: Column) -> Column:
        return F.flatten(F.transform(forms, lambda f: F.array(F.concat(f, F.upper(letter)), F.concat(f, F.lower(letter)))))

    forms = F.array(F.lit(""))
    for i in range(1, size + 1):
        forms = both(forms, F.substring(word, i, 1))
    return F.array_distinct(forms)


def attribute(row: Column, name: str) -> Column:
    """Value of an XML attribute in a row of text; null where absent."""
    return F.nullif(F.regexp_extract(row, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def tag_text(row: Column, tag: str) -> Column:
    return F.nullif(F.regexp_extract(row, rf"<{tag}[^>]*>([^<]*)</{tag}>", 1), F.lit(""))


def with_attribute(row: Column, name: str, value: str) -> Column:
    return F.regexp_replace(row, rf'\b{name}="[^"]*"', f'{name}="{value}"')


def retention_seconds(text: Column) -> Column:
    """PT5.5898S, or a bare number, as seconds; null where it is neither."""
    return F.regexp_replace(text, "^PT|S$", "").try_cast("double")


def padded_id(id_: Column, width: int = 12) -> Column:
    """Numeric ids padded with zeros so that they sort as text; others as they are."""
    return F.when(F.rlike(id_, F.lit(r"^\d+$")) & (F.length(id_) < width), F.lpad(id_, width, "0")).otherwise(id_)
