"""Regular-expression building blocks and small text helpers.

Every pattern spells its boundaries and blanks out, because `\\b`, `\\s` and `\\w` differ between
regex engines and Java versions. Digits are the ASCII digits.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# Unicode blanks: as characters and as a regex class.
BLANKS = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANK_SET = r"\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Both classes are unions, without a negation or an intersection: where many threads match, Java 17 spends most of its time in the
# calls from these to their parts.
BLANK = rf"[{BLANK_SET}]"
# Visible ASCII, most of any text, is settled by the first test.
NOT_BLANK = (
    r"[!-~[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff"
    r"\u3001-\x{10ffff}]]"
)

# Word boundaries next to a token, and the boundary in either direction.
_WORD = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = rf"(?<!{_WORD})"
BEFORE_WORD, NOT_BEFORE_WORD = rf"(?={_WORD})", rf"(?!{_WORD})"
BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def word_start(first: str) -> str:
    """Start of a word with the given first characters; these are cheaper to test than the boundary."""
    return f"(?={first}){NOT_AFTER_WORD}"


TRACKING = rf"{word_start('1Z')}1Z[0-9A-Z]{{8,18}}{NOT_BEFORE_WORD}"

# Two adjacent amounts with two decimals: a row of a cost table.
COST_ROW = rf"[0-9]+[,.][0-9]{{2}}{BLANK}+[0-9]+[,.][0-9]{{2}}"


def strip(text: Column) -> Column:
    """Remove blanks at both ends, non-breaking and other Unicode blanks included."""
    return F.btrim(text, F.lit(BLANKS))


def fold_case(text: Column) -> Column:
    """Lower case for comparisons that ignore case; the long s counts as s."""
    # A search is cheaper than a replacement, and no other letter becomes a long s in lower case.
    return F.lower(F.when(F.contains(text, F.lit("ſ")), F.replace(text, F.lit("ſ"), F.lit("s"))).otherwise(text))


def lines_of(text: Column) -> Column:
    """Trimmed lines of a text as an array, without blank ones."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def rows_of(exploded: DataFrame) -> DataFrame:
    """Rows of a `posexplode_outer`, without those of empty arrays.

    For a plain explode Catalyst adds a filter on the array size and pushes it down to the scan, where it
    computes the whole array, regexes and UDFs included, a second time.
    """
    return exploded.filter(F.col("pos").isNotNull())


def bind(value: Column, function) -> Column:
    """`function(value)` with the value computed once, also inside of lambda functions."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, or null where there is none (or an empty one)."""
    return bind(F.regexp_extract(text, pattern, group), lambda match: F.when(match != "", match))


def all_found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def first_of(array: Column) -> Column:
    return F.get(array, F.lit(0))


def last_of(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def first_contained(text: Column, keys, values) -> Column:
    """Value of the first key, in dictionary order, that is a substring of the text."""
    return F.coalesce(
        *[F.when(F.contains(text, F.lit(key)), F.lit(value)) for key, value in zip(keys, values)]
    )
