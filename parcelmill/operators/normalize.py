"""Normalisation of shipment records: ISO dates and countries, numbers, blank strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, NumericType, StringType

from parcelmill.functions import patterns as p
from parcelmill.functions.registry import Country, country_keys, iso_countries
from parcelmill.functions.spelt_dates import spelt_date

STRINGS = [
    "origin_city", "destination_city", "shipment_type", "currency_shipment", "origin_zipcode", "destination_zipcode",
]
NUMBERS = ["gross_weight", "chargeable_weight", "loading_meter", "cubic_meter"]
COUNTRIES = ["origin_country", "destination_country"]

_FLOAT = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)$"
_INT = "^[+-]?[0-9]+$"
_LOOSE_UNDERSCORE = "(?<![0-9])_|_(?![0-9])"


def _ungrouped(text: Column) -> Column:
    """A number without the underscores between its digits; null if there are others."""
    return F.when(~F.rlike(text, F.lit(_LOOSE_UNDERSCORE)), F.replace(text, F.lit("_"), F.lit("")))


def clean_string(value: Column) -> Column:
    return F.nullif(p.strip(value.cast("string")), F.lit(""))


def clean_float(value: Column, data_type=StringType()) -> Column:
    """A number, or a string with a decimal point or comma; null where it is neither."""
    if isinstance(data_type, NumericType):
        return value.cast("double")
    text = _ungrouped(F.replace(p.strip(value), F.lit(","), F.lit(".")))
    return F.when(F.rlike(text, F.lit(_FLOAT)), text.try_cast("double"))


def clean_int(value: Column, data_type=StringType()) -> Column:
    """A number without its fraction, or a string that is a whole number."""
    if isinstance(data_type, NumericType):
        return value.try_cast("bigint")
    text = _ungrouped(p.strip(value))
    return F.when(F.rlike(text, F.lit(_INT)), text.try_cast("bigint"))


def clean_date(value: Column, data_type=StringType()) -> Column:
    """A date from the ISO form or another spelling, day first unless only month first fits; a time is cut off."""
    return spelt_date(value) if isinstance(data_type, StringType) else value.cast("date")


def clean_cost_item(item: Column, cost_type=DoubleType()) -> Column:
    cost = "total_cost_in_shipment_currency"
    return F.struct(
        clean_string(item["extracted_category"]).alias("extracted_category"),
        clean_float(item[cost], cost_type).alias(cost),
        clean_string(item["currency"]).alias("currency"),
        clean_string(item["mention"]).alias("mention"),
    )


def _with_country(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """ISO alpha-2 code by any field of the registry; what is unknown stays, in upper case."""
    code = F.upper(p.strip(F.col(column)))
    found = keys.select(F.col("key").alias("_key"), F.col("alpha_2").alias("_alpha_2"))
    joined = df.withColumn("_code", code).join(found, F.lower("_code") == F.col("_key"), "left")
    known = F.when(F.col(column) != "", F.coalesce("_alpha_2", "_code"))
    return joined.withColumn(column, known).drop("_code", "_key", "_alpha_2")


def normalize(shipments: DataFrame, registry: list[Country] | None = None) -> DataFrame:
    """Clean the fields of shipment records that are there; other columns stay as they are."""
    types = {field.name: field.dataType for field in shipments.schema}
    columns = shipments.columns
    cleaned = {name: clean_string(F.col(name)) for name in STRINGS if name in types}
    cleaned |= {name: clean_float(F.col(name), types[name]) for name in NUMBERS if name in types}
    if "pallet_amount" in types:
        cleaned["pallet_amount"] = clean_int(F.col("pallet_amount"), types["pallet_amount"])
    if "shipment_date" in types:
        cleaned["shipment_date"] = clean_date(F.col("shipment_date"), types["shipment_date"])
    if "cost_items" in types:
        cost_type = types["cost_items"].elementType["total_cost_in_shipment_currency"].dataType
        cleaned["cost_items"] = F.transform("cost_items", lambda item: clean_cost_item(item, cost_type))
    df = shipments.withColumns(cleaned) if cleaned else shipments
    countries = [name for name in COUNTRIES if name in types]
    if countries:
        known = iso_countries(df.sparkSession) if registry is None else registry
        keys = country_keys(df.sparkSession, known)
        for name in countries:
            df = _with_country(df, name, keys)
    return df.select(columns)


def rejected_values(shipments: DataFrame, keys: list[str], registry: list[Country] | None = None) -> DataFrame:
    """(keys ..., field, item, value): what `normalize` could not read, a row for each value.

    A record never fails as a whole: a date or number that cannot be read becomes null there, a country that is not in the
    registry stays raw, and here they are listed as they came, costs with their place among the cost items. Blank values are no values.
    """
    types = {field.name: field.dataType for field in shipments.schema}
    none = F.lit(None).cast("int")

    def lost(name: str, raw: Column, clean: Column, item: Column = none) -> Column:
        text = raw.cast("string")
        return F.when((p.strip(text) != "") & clean.isNull(), F.struct(F.lit(name).alias("field"), item.alias("item"), text.alias("value")))

    found = [lost(name, F.col(name), clean_float(F.col(name), types[name])) for name in NUMBERS if name in types]
    if "pallet_amount" in types:
        found.append(lost("pallet_amount", F.col("pallet_amount"), clean_int(F.col("pallet_amount"), types["pallet_amount"])))
    if "shipment_date" in types:
        found.append(lost("shipment_date", F.col("shipment_date"), clean_date(F.col("shipment_date"), types["shipment_date"])))
    df = shipments
    countries = [name for name in COUNTRIES if name in types]
    if countries:
        known = iso_countries(df.sparkSession) if registry is None else registry
        lookup = country_keys(df.sparkSession, known)
        for name in countries:
            found_key = lookup.select(F.col("key").alias(f"__{name}"))
            df = df.join(found_key, F.lower(p.strip(F.col(name))) == F.col(f"__{name}"), "left")
            found.append(lost(name, F.col(name), F.col(f"__{name}")))
    every = F.array(*found) if found else F.array().cast("array<struct<field:string,item:int,value:string>>")
    if "cost_items" in types:
        cost = "total_cost_in_shipment_currency"
        kind = types["cost_items"].elementType[cost].dataType
        costs = F.transform("cost_items", lambda one, nth: lost(cost, one[cost], clean_float(one[cost], kind), nth + 1))
        every = F.concat(every, F.coalesce(costs, F.array().cast("array<struct<field:string,item:int,value:string>>")))
    rows = df.select(*keys, F.posexplode_outer(F.filter(every, lambda one: one.isNotNull())).alias("pos", "__lost"))
    return p.rows_of(rows).select(*keys, "__lost.field", "__lost.item", "__lost.value")
