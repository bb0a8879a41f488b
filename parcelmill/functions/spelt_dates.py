"""Dates as people and programs spell them.

A time with its zone is cut off first. What is left is cut into tokens, and each token is of a class: a number by its digits, a month,
a word or sign that means nothing (weekdays, ordinal endings, separators), or unknown. The classes joined are the signature of
the spelling; a table of layouts says where day, month and year are, and the date is built once.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelmill.functions import patterns as p

# English names, as in RFC 822 and everyday writing.
MONTHS = "january february march april may june july august september october november december".split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()

_MONTH_STARTS = "".join(name[:3] for name in MONTHS)
_MONTH_WORDS = " " + " ".join([*MONTHS, *(name[:3] for name in MONTHS), "sept"]) + " "
_NO_MEANING = " " + " ".join([*WEEKDAYS, *(name[:3] for name in WEEKDAYS), "tues", "thur", "thurs", "st", "nd", "rd", "th", "of", "and", "the", "on", "at"]) + " "
_SIGNS = " .,-/'; "

_CLOCK = (
    r"(?:(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?(?: ?[ap]\.?m\.?)?"  # 10:15, 10:15:00.5, 10:15 AM
    r"|(?:1[0-2]|0?[0-9]) ?[ap]\.?m\.?)"  # 10 AM
)
_ZONE = r"(?: ?(?:utc|gmt)?[+-](?:[01]?[0-9]|2[0-3])(?::?[0-5][0-9])?| ?[a-z]{1,5})?"
# A time after the date, joined to it by a T or a blank, or before it.
_TIME = (
    rf"(?:(?<=[0-9])t|,? (?:at )?){_CLOCK}{_ZONE}$|(?<=[0-9])t(?:[01][0-9]|2[0-3])(?:[0-5][0-9](?:[0-5][0-9](?:[.,][0-9]+)?)?)?{_ZONE}$"
    rf"|^{_CLOCK}(?: ?[a-z]{{3,4}})?,? (?=[0-9a-z])"
)
_TOKEN = r"[0-9]+|\p{L}+|[^0-9\p{L}]"

# Signature -> order of day, month and year. Numbers are classed by their digits (1 for one or two), M is a month.
_LAYOUTS = {
    "114": "dmy", "411": "ymd", "111": "dmy", "1M4": "dmy", "M14": "mdy", "4M1": "ymd", "1M1": "dmy", "M11": "mdy",
}
# All in one number: signature -> (year, month, day) as (divisor, modulus).
_PACKED = {
    "8": ((10_000, 10_000), (100, 100), (1, 100)),
    "C": ((10**8, 10_000), (10**6, 100), (10**4, 100)),  # with hours and minutes
    "E": ((10**10, 10_000), (10**8, 100), (10**6, 100)),  # and seconds
    "6": ((1, 100), (100, 100), (10_000, 100)),
}


def _classed(token: Column) -> Column:
    """(class, value) of a token; the class is empty if it means nothing, and x if it is unknown."""
    digits = F.ascii(token).between(48, 57)
    size = F.length(token)
    number = F.when(size <= 2, "1").when(size == 4, "4").when(size == 6, "6").when(size == 8, "8").when(size == 12, "C").when(size == 14, "E").otherwise("x")
    spaced = F.concat(F.lit(" "), token, F.lit(" "))
    month = F.contains(F.lit(_MONTH_WORDS), spaced)
    nothing = F.contains(F.lit(_SIGNS), token) | F.contains(F.lit(_NO_MEANING), spaced)
    place = (F.instr(F.lit(_MONTH_STARTS), F.left(token, F.lit(3))) + 2) / 3
    return F.struct(
        F.when(digits, number).when(nothing, "").when(month, "M").otherwise("x").alias("kind"),
        F.when(digits, token.try_cast("bigint")).when(month, place.cast("bigint")).alias("value"),
    )


def _date(pieces: Column) -> Column:
    """The date that classed tokens make; null if they make none."""
    signature, values = F.array_join(pieces["kind"], ""), pieces["value"]
    order = F.create_map(*[F.lit(x) for item in _LAYOUTS.items() for x in item])
    number = F.get(values, F.lit(0))

    def packed(part: int) -> Column:
        out = F.lit(None).cast("bigint")
        for kind, parts in _PACKED.items():
            divisor, modulus = parts[part]
            out = F.when(signature == kind, F.floor(number / divisor) % modulus).otherwise(out)
        return out

    def of(layout: Column) -> Column:
        # two digits that can be no day are a year
        layout = F.when((layout == "dmy") & (number > 31), F.lit("ymd")).otherwise(layout)
        at = lambda c: F.get(values, F.instr(layout, F.lit(c)) - 1)
        return F.struct(F.coalesce(at("y"), packed(0)).alias("y"), F.coalesce(at("m"), packed(1)).alias("m"), F.coalesce(at("d"), packed(2)).alias("d"))

    def built(parts: Column) -> Column:
        day_first = ~F.contains(signature, F.lit("M")) & (parts["m"] > 12) & (parts["d"] <= 12)
        month, day = F.when(day_first, parts["d"]).otherwise(parts["m"]), F.when(day_first, parts["m"]).otherwise(parts["d"])
        full = F.contains(signature, F.lit("4")) | signature.isin("8", "C", "E")
        # with two digits a year lies less than 50 years from now
        near = parts["y"] + 2000
        year = F.when(full, parts["y"]).when(near >= F.year(F.current_date()) + 50, near - 100).otherwise(near)
        text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string"))
        known = year.isNotNull() & month.between(1, 12) & day.between(1, 31)
        return F.when(known, F.try_to_date(text, "yyyy-M-d"))

    return p.bind(of(F.try_element_at(order, signature)), built)


def spelt_date(text: Column) -> Column:
    """The date that a string spells, day first unless only month first fits; null if it is none, or has no day, month or year."""
    low = F.lower(p.strip(text))
    bare = F.regexp_replace(F.regexp_replace(low, F.lit(p.BLANK + "+"), F.lit(" ")), F.lit(_TIME), F.lit(""))
    pieces = F.filter(F.transform(F.regexp_extract_all(bare, F.lit(_TOKEN), F.lit(0)), _classed), lambda one: one["kind"] != "")
    plain = F.rlike(low, F.lit("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"))
    return F.coalesce(F.when(plain, F.try_to_date(low, "yyyy-M-d")), F.when(F.length(low) <= 64, p.bind(pieces, _date)))
