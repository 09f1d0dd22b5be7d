"""The whole warehouse from the source tables: dimensions first, then facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimspark.operators.quality import Rules, checked_write
from dimspark.plans import dimensions, enrichment, facts, staging
from dimspark.plans.rules import fact_rules
from dimspark.session import require_settings
from dimspark.sources.loads import append_load
from dimspark.sources.shared import scratch

Writer = Callable[[str, DataFrame], DataFrame]

# A row for each model that a run has written.
RUN_LOG = "lineage_key bigint, model string, rows bigint, started timestamp_ntz, finished timestamp_ntz"

# Models that are built at the same time; they do not depend on each other.
CONCURRENT_BUILDS = 8


def write_all(plans: Mapping[str, Callable[[], DataFrame]], write: Writer) -> dict[str, DataFrame]:
    """Build and write independent models at the same time, and return scans of them.

    One small dimension cannot keep a cluster busy; several can.
    """
    in_session = inheritable_thread_target(SparkSession.getActiveSession())

    def build(name: str) -> DataFrame:
        return in_session(lambda: write(name, plans[name]()))()

    with ThreadPoolExecutor(CONCURRENT_BUILDS) as pool:
        return dict(zip(plans, pool.map(build, plans), strict=True))


def write_one_by_one(
    spark: SparkSession, plans: Mapping[str, Callable[[], DataFrame]], write: Writer
) -> dict[str, DataFrame]:
    """Build and write large models one after the other, and return scans of them.

    Each keeps a cluster busy by itself, and what it stores on the way goes before the
    next begins: the disk holds the intermediate tables and shuffles of one model.
    """
    written = {}
    for name, plan in plans.items():
        with scratch(spark):
            written[name] = write(name, plan())
    return written


def plan_all(plans: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Build independent models at the same time without writing them.

    A dimension's sorted rows are written while it is built; what remains to do for
    a reader is a join with one row per slice.
    """
    return write_all(plans, lambda _, df: df)


def dimension_plans(
    src: Mapping[str, DataFrame], stored_city: DataFrame | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The seven dimensions by entity name, from source tables by source name.

    ``stored_city`` is the city dimension of the last run; it is loaded
    incrementally, the others are rebuilt.
    """
    return {
        "city": lambda: dimensions.dim_city(
            enrichment.city_versions(staging.stage_city(src["Cities"]), src["StateProvinces"], src["Countries"]),
            stored_city,
        ),
        "customer": lambda: dimensions.dim_customer(
            enrichment.customer_versions(
                staging.stage_customer(src["Customers"]),
                src["CustomerCategories"],
                src["BuyingGroups"],
                src["People"],
                src["Customers"],
            )
        ),
        "employee": lambda: dimensions.dim_employee(staging.stage_employee(src["People"])),
        "payment_method": lambda: dimensions.dim_payment_method(staging.stage_payment_method(src["PaymentMethods"])),
        "stock_item": lambda: dimensions.dim_stock_item(staging.stage_stock_item(src["StockItems"])),
        "supplier": lambda: dimensions.dim_supplier(
            enrichment.supplier_versions(
                staging.stage_supplier(src["Suppliers"]), src["SupplierCategories"], src["People"]
            )
        ),
        "transaction_type": lambda: dimensions.dim_transaction_type(
            staging.stage_transaction_type(src["TransactionTypes"])
        ),
    }


def fact_plans(
    src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: Column | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The six facts by name. ``dims`` should be written tables: several facts read them."""
    return {
        "order": lambda: facts.fct_order(
            staging.joined_order(src["Orders"], src["OrderLines"], src["Customers"], src["PackageTypes"]),
            dims,
            finish=staging.finished_order,
        ),
        "sale": lambda: facts.fct_sale(
            staging.joined_sale(
                src["Invoices"], src["InvoiceLines"], src["Customers"], src["StockItems"], src["PackageTypes"]
            ),
            dims,
            finish=staging.finished_sale,
        ),
        "purchase": lambda: facts.fct_purchase(
            staging.joined_purchase(src["PurchaseOrders"], src["PurchaseOrderLines"]),
            dims,
            finish=lambda rows: staging.finished_purchase(rows, src["StockItems"], src["PackageTypes"]),
        ),
        "movement": lambda: facts.fct_movement(staging.stage_movement(src["StockItemTransactions"]), dims),
        "transaction": lambda: facts.fct_transaction(
            staging.stage_transaction(src["CustomerTransactions"], src["SupplierTransactions"]), dims
        ),
        "stock_holding": lambda: facts.fct_stock_holding(
            staging.stage_stock_holding(src["StockItemHoldings"]), dims, as_of
        ),
    }


def checked(write: Writer, rules: Mapping[str, Rules], report: list[tuple]) -> Writer:
    """``write`` that checks the models which have rules, in the same pass, and adds to ``report``."""

    def write_checked(name: str, df: DataFrame) -> DataFrame:
        if name not in rules:
            return write(name, df)
        table, found = checked_write(name, df, rules[name], write)
        report.extend(found)
        return table

    return write_checked


def logged(write: Writer, run_id: int, log: list[tuple]) -> Writer:
    """``write`` that adds a row of ``RUN_LOG`` to ``log`` for each model: rows written, counted while they are, and times."""

    def write_logged(name: str, df: DataFrame) -> DataFrame:
        seen, started = Observation(), datetime.now(UTC).replace(tzinfo=None)
        table = write(name, df.observe(seen, F.count(F.lit(1)).alias("rows")))
        log.append((run_id, name, seen.get["rows"], started, datetime.now(UTC).replace(tzinfo=None)))
        return table

    return write_logged


def store_log(spark: SparkSession, path: str, log: Sequence[tuple]) -> DataFrame:
    """Add the rows of a run to the table of runs at ``path``, and return the table."""
    return append_load(spark.createDataFrame(list(log), RUN_LOG), path)


def build_warehouse(
    src: Mapping[str, DataFrame],
    write: Writer,
    as_of: Column | None = None,
    stored_city: DataFrame | None = None,
    report: list[tuple] | None = None,
) -> dict[str, DataFrame]:
    """Build and write all dimensions, then all facts; returns ``dim_*`` and ``fct_*`` tables.

    With a list ``report`` the facts are checked by their rules while they are written,
    and a row of ``dimspark.operators.quality.REPORT`` is added for each rule.

    ``write`` must not replace the table that ``stored_city`` reads. Intermediate
    tables of a fact are removed once it is written, all others at the end, also if a
    model fails. The session's settings are checked first.
    """
    spark = SparkSession.getActiveSession()
    require_settings(spark)
    with scratch(spark):
        dims = write_all(dimension_plans(src, stored_city), lambda name, df: write(f"dim_{name}", df))
        if report is not None:
            write = checked(write, {f"fct_{name}": rules for name, rules in fact_rules(dims).items()}, report)
        plans = {f"fct_{name}": plan for name, plan in fact_plans(src, dims, as_of).items()}
        facts_written = write_one_by_one(spark, plans, write)
    return {f"dim_{name}": df for name, df in dims.items()} | facts_written
