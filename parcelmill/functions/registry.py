"""The ISO 3166 country registry: a table of six fields for each country.

The default registry is the file of the iso-codes package (Debian and others), where the driver has it; else codes and English names
of the driver's Java runtime, with the ISO short names where they differ. Another one can be passed wherever a registry is
taken, as a list or read from a JSON or CSV file by `read_registry`.
"""

from __future__ import annotations

import csv
import json
import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from parcelmill.functions.dictionaries import COMMON_NAMES, ISO_SHORT_NAMES, NUMERIC_CODES, OFFICIAL_NAMES


class Country(NamedTuple):
    alpha_2: str
    alpha_3: str | None = None
    numeric: str | None = None
    name: str | None = None
    common_name: str | None = None
    official_name: str | None = None


#: Where the iso-codes package puts its table.
ISO_CODES = "/usr/share/iso-codes/json/iso_3166-1.json"


def iso_countries(spark: SparkSession, path: str = ISO_CODES) -> list[Country]:
    """All countries of the iso-codes file; without one, those of the Java runtime, which lacks most numeric codes and official names."""
    return read_registry(path) if os.path.exists(path) else runtime_countries(spark)


def runtime_countries(spark: SparkSession) -> list[Country]:
    locale = spark._jvm.java.util.Locale
    countries = []
    for code in locale.getISOCountries():
        entry = locale("", code)
        shown = entry.getDisplayCountry(locale.ENGLISH).replace("&", "and")
        name = ISO_SHORT_NAMES.get(code, shown)
        common, official = COMMON_NAMES.get(code), OFFICIAL_NAMES.get(code)
        countries.append(Country(code, entry.getISO3Country(), NUMERIC_CODES.get(code), name, common, official))
    return countries


def read_registry(path: str) -> list[Country]:
    """A registry from a file: a CSV with a header of the six field names, or the JSON of the iso-codes package. Empty fields are unknown."""
    with open(path, encoding="utf-8", newline="") as file:
        rows = json.load(file)["3166-1"] if path.endswith(".json") else list(csv.DictReader(file))
    return [Country(*(row.get(field) or None for field in Country._fields)) for row in rows]


def country_keys(spark: SparkSession, countries: list[Country]) -> DataFrame:
    """Lookup table (key, alpha_2): every field of every country in lower case."""
    keys: dict[str, str] = {}
    for position in range(len(Country._fields)):
        for country in countries:
            if country[position]:
                keys.setdefault(country[position].lower(), country.alpha_2)
    return spark.createDataFrame(list(keys.items()), "key string, alpha_2 string")


def one_word_names(countries: list[Country]) -> dict[str, str]:
    """Lower-case names without comma or space -> alpha-2, for lookups of single words."""
    return {
        country.name.lower(): country.alpha_2
        for country in countries
        if country.name and len(country.name) >= 3 and not set(country.name) & {",", " "}
    }
