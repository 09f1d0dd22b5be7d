"""Point-in-time enrichment of the city, customer and supplier versions.

The ``*_versions`` functions give one row per source version, without an end;
``enrich_*`` closes them. Dimensions start from the former and close and number
in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.functions.scalars import with_default
from dimspark.operators.histories import measure, periods
from dimspark.operators.joins import left_join
from dimspark.operators.temporal import point_in_time_join
from dimspark.operators.versions import scd2_close
from dimspark.plans.staging import int_of, timestamp_of


def _period(df: DataFrame) -> list:
    return [timestamp_of(df, "validfrom").alias("_from"), timestamp_of(df, "validto").alias("_to")]


def _names(df: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """A versioned id-to-name table, ready for a point-in-time join."""
    return df.select(int_of(df, key).alias("_lookup"), F.col(name).alias(alias), *_period(df))


def _as_of_start(base: DataFrame, lookups: dict[str, DataFrame], how: str) -> DataFrame:
    """Join versioned lookup tables, by id column of ``base``, as of ``valid_from``."""
    histories = measure({key: periods(df, "_lookup", "_from", "_to") for key, df in lookups.items()})
    for key, df in lookups.items():
        base = point_in_time_join(base, df, (key, "_lookup"), "valid_from", "_from", "_to", how, histories[key])
    return base


def _contact(base: DataFrame, people: DataFrame, key: str) -> DataFrame:
    """Plain join: a person with several rows multiplies the base row."""
    persons = people.select(int_of(people, "personid").alias("_person"), F.col("fullname").alias("_contact"))
    return left_join(base, persons, key, "_person", ["valid_from"]).drop("_person")


def city_versions(stg_city: DataFrame, state_provinces: DataFrame, countries: DataFrame) -> DataFrame:
    """City versions with state and country as of their start; those without either drop out."""
    states = state_provinces.select(
        F.col("stateprovinceid").alias("_lookup"),
        F.col("stateprovincename").alias("state_province"),
        F.col("countryid").alias("_country"),
        F.col("salesterritory").alias("sales_territory"),
        *_period(state_provinces),
    )
    nations = countries.select(
        F.col("countryid").alias("_lookup"),
        F.col("countryname").alias("country"),
        "continent",
        "region",
        "subregion",
        *_period(countries),
    )
    placed = _as_of_start(stg_city, {"state_province_id": states, "_country": nations}, "inner")
    return placed.select(
        "wwi_city_id",
        "city",
        "state_province",
        "country",
        "continent",
        "sales_territory",
        "region",
        "subregion",
        "location",
        "latest_recorded_population",
        "valid_from",
    )


def enrich_city(stg_city: DataFrame, state_provinces: DataFrame, countries: DataFrame) -> DataFrame:
    return scd2_close(city_versions(stg_city, state_provinces, countries), "wwi_city_id")


def customer_versions(
    stg_customer: DataFrame,
    categories: DataFrame,
    buying_groups: DataFrame,
    people: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Customer versions with category, buying group, contact and bill-to name."""
    lookups = {
        "customer_category_id": _names(categories, "customercategoryid", "customercategoryname", "_category"),
        "buying_group_id": _names(buying_groups, "buyinggroupid", "buyinggroupname", "_group"),
        "bill_to_customer_id": _names(customers, "customerid", "customername", "_bill_to"),
    }
    named = _as_of_start(stg_customer, lookups, "left")
    return _contact(named, people, "primary_contact_personid").select(
        "wwi_customer_id",
        "customer",
        with_default(F.col("_bill_to"), F.col("customer")).alias("bill_to_customer"),
        with_default(F.col("_category"), "Unknown").alias("category"),
        with_default(F.col("_group"), "None").alias("buying_group"),
        with_default(F.col("_contact"), "").alias("primary_contact"),
        "postal_code",
        "valid_from",
    )


def enrich_customer(
    stg_customer: DataFrame,
    categories: DataFrame,
    buying_groups: DataFrame,
    people: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    return scd2_close(customer_versions(stg_customer, categories, buying_groups, people, customers), "wwi_customer_id")


def supplier_versions(stg_supplier: DataFrame, categories: DataFrame, people: DataFrame) -> DataFrame:
    """Supplier versions with category and contact."""
    lookups = {
        "suppliercategoryid": _names(categories, "suppliercategoryid", "suppliercategoryname", "_category")
    }
    named = _as_of_start(stg_supplier, lookups, "left")
    return _contact(named, people, "primarycontactpersonid").select(
        "wwi_supplier_id",
        "supplier",
        with_default(F.col("_category"), "Unknown").alias("category"),
        with_default(F.col("_contact"), "").alias("primary_contact"),
        "supplier_reference",
        "payment_days",
        "postal_code",
        "valid_from",
    )


def enrich_supplier(stg_supplier: DataFrame, categories: DataFrame, people: DataFrame) -> DataFrame:
    return scd2_close(supplier_versions(stg_supplier, categories, people), "wwi_supplier_id")
