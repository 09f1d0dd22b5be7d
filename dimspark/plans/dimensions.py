"""The seven versioned dimensions, and the date dimension.

Each is rebuilt in full: periods are closed and keys numbered from 1 in the
order of natural key and start. Equal starts are ordered by all other columns,
which makes the keys reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.scalars import with_default
from dimspark.operators.incremental import incremental_scd2, load_scd2
from dimspark.operators.versions import version_dimension


def _cities(versions: DataFrame) -> DataFrame:
    return versions.withColumn("latest_recorded_population", with_default(F.col("latest_recorded_population"), 0))


def dim_city(versions: DataFrame, target: DataFrame | None = None, mode: str = "append_only") -> DataFrame:
    """City dimension from ``city_versions``; with a ``target``, its content after an incremental load."""
    return incremental_scd2(target, _cities(versions), "wwi_city_id", "city_key", mode=mode)


def load_city(spark: SparkSession, path: str, versions: DataFrame) -> DataFrame:
    """Load ``city_versions`` into the city dimension at ``path``; only new rows are written."""
    return load_scd2(spark, path, _cities(versions), "wwi_city_id", "city_key")


def dim_customer(versions: DataFrame) -> DataFrame:
    return version_dimension(versions, "wwi_customer_id", "customer_key")


def dim_supplier(versions: DataFrame) -> DataFrame:
    return version_dimension(versions, "wwi_supplier_id", "supplier_key")


def dim_employee(stg_employee: DataFrame) -> DataFrame:
    people = stg_employee.select(
        "wwi_employee_id",
        "employee",
        F.col("preferredname").alias("preferred_name"),
        F.col("validfrom").alias("valid_from"),
    )
    return version_dimension(people, "wwi_employee_id", "employee_key")


def dim_payment_method(stg_payment_method: DataFrame) -> DataFrame:
    methods = stg_payment_method.select(
        "wwi_payment_method_id", "payment_method", F.col("validfrom").alias("valid_from")
    )
    return version_dimension(methods, "wwi_payment_method_id", "payment_method_key")


def dim_transaction_type(stg_transaction_type: DataFrame) -> DataFrame:
    kinds = stg_transaction_type.select(
        "wwi_transaction_type_id", "transaction_type", F.col("validfrom").alias("valid_from")
    )
    return version_dimension(kinds, "wwi_transaction_type_id", "transaction_type_key")


def dim_stock_item(stg_stock_item: DataFrame) -> DataFrame:
    items = stg_stock_item.select(
        "wwi_stock_item_id",
        "stock_item",
        "brand",
        "size",
        F.col("leadtimedays").alias("lead_time_days"),
        F.col("quantityperouter").alias("quantity_per_outer"),
        F.col("ischillerstock").alias("is_chiller_stock"),
        F.col("taxrate").alias("tax_rate"),
        F.col("unitprice").alias("unit_price"),
        F.col("typicalweightperunit").alias("typical_weight_per_unit"),
        F.col("validfrom").alias("valid_from"),
    )
    return version_dimension(items, "wwi_stock_item_id", "stock_item_key")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar columns for a DataFrame with one ``date_key`` per day."""
    day = F.col("date_key")
    return days.select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first_year: int = 2013, last_year: int = 2030) -> DataFrame:
    """One row per day of the given years. Days of the week run from Monday = 1."""
    days = F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
    return calendar(spark.range(1).select(F.explode(days).alias("date_key")))


def dim_date_for(df: DataFrame, col: str) -> DataFrame:
    """One row per day of the years that ``col`` spans."""
    first, last = F.year(F.min(col)), F.year(F.max(col))
    bounds = df.agg(F.make_date(first, F.lit(1), F.lit(1)).alias("lo"), F.make_date(last, F.lit(12), F.lit(31)).alias("hi"))
    return calendar(bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_key")))
