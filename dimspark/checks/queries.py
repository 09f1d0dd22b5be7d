"""One query per operator and model, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.checks.bindings import Sources, table
from dimspark.functions.scalars import (
    END_OF_TIME,
    START_OF_TIME,
    last_modified,
    safe_date,
    safe_int,
    safe_timestamp,
    ts_literal,
)
from dimspark.operators import (
    Lookup,
    cutoff_window,
    dense_key,
    incremental_filter,
    load_by_cutoff,
    lookup_key,
    lookup_keys,
    merge_table,
    merge_upsert,
    null_violations,
    orphan_keys,
    overwrite_attributes,
    point_in_time_join,
    rebuild_dimension,
    scd1_latest,
    scd2_close,
    splice_dimension,
    stored_cutoff,
    update_cutoff,
    version_dimension,
    watermark,
    with_lineage,
)
from dimspark.plans import dimensions, enrichment, facts, staging
from dimspark.operators.quality import REPORT
from dimspark.plans.rules import fact_rules
from dimspark.plans.warehouse import build_warehouse, checked, dimension_plans, fact_plans, logged, plan_all, store_log, write_one_by_one
from dimspark.sources import (
    SOURCE_SCHEMAS,
    by_cost,
    layer_path,
    month_key,
    read_parts,
    read_seed,
    read_source,
    read_table,
    register_views,
    scratch,
    shared_folder,
    store,
    whole,
    write_analyzed,
    write_bucketed,
    write_monthly,
    write_parts,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Which roles give the versioned models a history.
HISTORIES = {"Customers": "CustomersHistory", "StockItems": "StockItemsHistory"}

# The load boundary of the incremental queries, the moment of the
# holdings snapshot and the bounds of the cutoff window.
FIRST_LOAD_END = "1998-01-01 00:00:00"
SNAPSHOT = "2000-06-01 12:00:00"
CUTOFF_START, CUTOFF_END = "1996-01-01 00:00:00", "1998-06-30 00:00:00"


# Staging


def _staged(src: Sources, name: str) -> DataFrame:
    roles = {
        "city": ["Cities"],
        "customer": ["Customers"],
        "employee": ["People"],
        "payment_method": ["PaymentMethods"],
        "stock_item": ["StockItems"],
        "supplier": ["Suppliers"],
        "transaction_type": ["TransactionTypes"],
        "movement": ["StockItemTransactions"],
        "order": ["Orders", "OrderLines", "Customers", "PackageTypes"],
        "purchase": ["PurchaseOrders", "PurchaseOrderLines", "StockItems", "PackageTypes"],
        "sale": ["Invoices", "InvoiceLines", "Customers", "StockItems", "PackageTypes"],
        "stock_holding": ["StockItemHoldings"],
        "transaction": ["CustomerTransactions", "SupplierTransactions"],
    }
    return getattr(staging, f"stage_{name}")(*[src[r] for r in roles[name]])


def _versioned(spark: SparkSession, sf_dir: str, people: str = "People") -> Sources:
    return Sources(spark, sf_dir, **HISTORIES, People=people)


def _stage(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        if name in ("customer", "employee", "stock_item"):
            return _staged(_versioned(spark, sf_dir, "PeopleHistory"), name)
        return _staged(Sources(spark, sf_dir), name)

    return query


def stage_sale_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the invoices of one cutoff window; see ``session.LARGE_WINDOWS`` for what spares the other lines a shuffle."""
    src = Sources(spark, sf_dir)
    invoices = cutoff_window(src["Invoices"], "invoicedate", CUTOFF_START, CUTOFF_END)
    return staging.stage_sale(invoices, src["InvoiceLines"], src["Customers"], src["StockItems"], src["PackageTypes"])


def stage_order_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines joined with their headers, both in buckets of the order id."""
    src, folder, run = Sources(spark, sf_dir), _new_folder(spark), uuid.uuid4().hex
    headers, lines = (
        write_bucketed(src[name], f"{name.lower()}_{run}", f"{folder}/{name}", "orderid", 16) for name in ("Orders", "OrderLines")
    )
    return staging.stage_order(headers, lines, src["Customers"], src["PackageTypes"])


def stage_order_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order amounts from a price of four and a rate of six fractional digits, and with a floating quantity."""
    src = Sources(spark, sf_dir)
    exact = src["OrderLines"].select(
        "orderlineid",
        F.col("quantity").cast("int").alias("quantity"),
        F.expr("cast(orderlineid % 100000 as decimal(18,4)) + cast(0.1234 as decimal(18,4))").cast("decimal(18,4)").alias("unitprice"),
        F.expr("cast(orderlineid % 20 as decimal(9,6)) + cast(0.062525 as decimal(9,6))").cast("decimal(9,6)").alias("taxrate"),
    )
    net, tax, gross = staging._net_and_tax(exact)
    # As text, so that a digit lost anywhere shows.
    written = [c.cast("string").alias(n) for c, n in ((net, "net"), (tax, "tax"), (gross, "gross"))]
    floating = exact.select(
        "orderlineid", *written, "unitprice", "taxrate", (F.col("quantity").cast("double") / 4).alias("quantity")
    )
    f_net, f_tax, f_gross = staging._net_and_tax(floating)
    return floating.select(
        "orderlineid", "net", "tax", "gross", f_net.alias("f_net"), f_tax.alias("f_tax"), f_gross.alias("f_gross")
    )


def stage_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("wwi_customer_id"),
        F.col("c_name").alias("customer"),
        (F.col("c_acctbal") * 2).alias("credit_limit"),
    )


def stage_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number(df: DataFrame, column: str):
        return safe_int(F.col(column), df.schema[column].dataType)

    df = (
        table(spark, sf_dir, "customer")
        .withColumn("digits", F.substring("c_name", 10, 9))
        .withColumn("whole", F.floor("c_acctbal").cast("double"))
    )
    return df.select(
        "c_custkey",
        number(df, "digits").alias("from_text"),
        number(df, "c_mktsegment").alias("from_words"),
        number(df, "c_nationkey").alias("from_int"),
        number(df, "whole").alias("from_double"),
    )


def stage_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("9"))
    return table(spark, sf_dir, "events").select(
        "event_id", safe_timestamp(long_text).alias("parsed"), safe_timestamp(F.col("event_type")).alias("junk")
    )


def stage_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return df.select(
        "o_orderkey",
        safe_date(F.col("o_orderdate").cast("string")).alias("from_text"),
        safe_date(F.col("o_orderdate"), df.schema["o_orderdate"].dataType).alias("from_timestamp"),
        safe_date(F.col("o_orderpriority")).alias("junk"),
    )


def last_modified_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_edit = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    header_edit = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", last_modified(line_edit, header_edit).alias("last_modified_when")
    )


# Joins on periods


def pit_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Sources(spark, sf_dir)
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("valid_from"))
    customers = (
        table(spark, sf_dir, "customer")
        .join(first, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "valid_from")
    )
    states = src["StateProvinces"].select(
        "stateprovinceid",
        F.col("stateprovincename").alias("state_province"),
        "countryid",
        safe_timestamp(F.col("validfrom")).alias("s_from"),
        safe_timestamp(F.col("validto")).alias("s_to"),
    )
    countries = src["Countries"].select(
        F.col("countryid").alias("c_id"),
        F.col("countryname").alias("country"),
        safe_timestamp(F.col("validfrom")).alias("c_from"),
        safe_timestamp(F.col("validto")).alias("c_to"),
    )
    placed = point_in_time_join(
        customers, states, ("c_nationkey", "stateprovinceid"), "valid_from", "s_from", "s_to", "inner"
    )
    return point_in_time_join(placed, countries, ("countryid", "c_id"), "valid_from", "c_from", "c_to", "inner").select(
        "c_custkey", "valid_from", "state_province", "country"
    )


def pit_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Sources(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("valid_from"),
        safe_int(F.substring("o_orderpriority", 1, 1), T.StringType()).alias("category_id"),
        F.expr("o_custkey div 10").alias("bill_to_id"),
    )
    categories = src["CustomerCategories"].select(
        safe_int(F.col("customercategoryid"), T.StringType()).alias("id"),
        F.col("customercategoryname").alias("category"),
        safe_timestamp(F.col("validfrom")).alias("c_from"),
        safe_timestamp(F.col("validto")).alias("c_to"),
    )
    bill_to = src["Customers"].select(
        safe_int(F.col("customerid"), T.StringType()).alias("id"),
        F.col("customername").alias("bill_to_customer"),
        safe_timestamp(F.col("validfrom")).alias("b_from"),
        safe_timestamp(F.col("validto")).alias("b_to"),
    )
    named = point_in_time_join(orders, categories, ("category_id", "id"), "valid_from", "c_from", "c_to")
    return point_in_time_join(named, bill_to, ("bill_to_id", "id"), "valid_from", "b_from", "b_to").select(
        "o_orderkey", "valid_from", "category", "bill_to_customer"
    )


def _type_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions with a few ids and long histories: one id per event type, a version per event."""
    versions = table(spark, sf_dir, "events").select(
        F.length("event_type").cast("bigint").alias("type_id"), "event_id", F.col("ts").alias("valid_from")
    )
    return version_dimension(versions, "type_id", "type_key", ties=["event_id"])


def pit_long_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = store(_type_versions(spark, sf_dir)).select("type_id", "type_key", "valid_from", "valid_to")
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("wanted"), "ts")
    return point_in_time_join(events, versions, ("wanted", "type_id"), "ts", "valid_from", "valid_to", "left")


def pit_repeated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long histories in which every version occurs twice, some with a map in their row."""
    versions = _type_versions(spark, sf_dir).select(
        "type_id", F.create_map(F.lit("key"), "type_key").alias("attributes"), "valid_from", "valid_to"
    )
    versions = store(versions)
    twice = versions.unionByName(versions)
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("wanted"), "ts")
    found = point_in_time_join(events, twice, ("wanted", "type_id"), "ts", "valid_from", "valid_to", "left")
    return found.select("event_id", "wanted", "ts", F.col("attributes")["key"].alias("type_key"))


# Versions and keys


def _customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderdate").alias("valid_from")
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_dimension(_customer_versions(spark, sf_dir), "o_custkey", "version_key", ties=["o_orderkey"])


def scd2_close_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_close(_customer_versions(spark, sf_dir), "o_custkey", ties=["o_orderkey"])


def scd1_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1_latest(_customer_versions(spark, sf_dir), "o_custkey", ["valid_from", "o_orderkey"])


def dense_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_key(_customer_versions(spark, sf_dir), ["o_custkey", "valid_from", "o_orderkey"], "version_key")


# Key lookups


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("customer_id"), "l_shipdate"
    )


def _lookup(strategy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim = store(customer_dim(spark, sf_dir))
        lines = shipped_lines(spark, sf_dir)
        return lookup_key(
            lines, dim, "customer_id", "o_custkey", "l_shipdate", "version_key", "customer_key", strategy
        )

    return query


def lookup_long_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = store(_type_versions(spark, sf_dir))
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("wanted"), "ts")
    return lookup_key(events, dim, "wanted", "type_id", "ts", "type_key", "type_key")


def lookup_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns of one dimension, looked up in different ways."""
    dim = store(customer_dim(spark, sf_dir))
    lines = shipped_lines(spark, sf_dir)

    def look(key: str, alias: str, strategy: str) -> Lookup:
        return Lookup(dim, "customer_id", "o_custkey", key, alias, "l_shipdate", strategy=strategy)

    return lookup_keys(
        lines, [look("version_key", "customer_key", "auto"), look("o_orderkey", "order_key", "ranked"), look("o_orderkey", "same_key", "union_window")]
    )


def lookup_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of different lengths that start at each order, so that they nest and leave gaps."""
    dim = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderkey").alias("version_key"),
        F.col("o_orderdate").alias("valid_from"),
        (F.col("o_orderdate") + F.make_dt_interval(F.pmod("o_orderkey", F.lit(700)).cast("int"))).alias("valid_to"),
    )
    lines = shipped_lines(spark, sf_dir)
    return lookup_key(lines, dim, "customer_id", "o_custkey", "l_shipdate", "version_key", "customer_key", "ranked")


def lookup_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a dimension that was loaded twice, so that old and new versions are open at once."""
    dim = store(dim_city_incremental(spark, sf_dir))
    lines = shipped_lines(spark, sf_dir)
    return lookup_key(lines, dim, "customer_id", "wwi_city_id", "l_shipdate", "city_key", "city_key")


# Dimensions


def _city_versions(src: Sources) -> DataFrame:
    return enrichment.city_versions(_staged(src, "city"), src["StateProvinces"], src["Countries"])


def _enrich(name: str) -> Query:
    lookups = {
        "city": ["StateProvinces", "Countries"],
        "customer": ["CustomerCategories", "BuyingGroups", "People", "Customers"],
        "supplier": ["SupplierCategories", "People"],
    }

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = _versioned(spark, sf_dir)
        return getattr(enrichment, f"enrich_{name}")(_staged(src, name), *[src[r] for r in lookups[name]])

    return query


def _dimension_plans(spark: SparkSession, sf_dir: str, people: str = "EmployeeHistory") -> dict[str, Callable[[], DataFrame]]:
    """The warehouse's own plans over histories. Only employees come from a history of people, whose names others join."""
    plans = dimension_plans(_versioned(spark, sf_dir))
    return plans | {"employee": dimension_plans(_versioned(spark, sf_dir, people))["employee"]}


def _dim(name: str) -> Query:
    return lambda spark, sf_dir: _dimension_plans(spark, sf_dir, "PeopleHistory")[name]()


def dim_city_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of the versions before 1998, a second of all, and a third that finds nothing new."""
    src, path = Sources(spark, sf_dir), _new_folder(spark)
    first = cutoff_window(_city_versions(src), "valid_from", end=FIRST_LOAD_END)
    dimensions.load_city(spark, path, first)
    dimensions.load_city(spark, path, _city_versions(src))
    return dimensions.load_city(spark, path, _city_versions(src))


def dim_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("date_key")).agg(F.count("*").alias("orders"))
    days = dimensions.dim_date_for(orders, "o_orderdate").join(per_day, "date_key", "left")
    return days.withColumn("orders", F.coalesce("orders", F.lit(0)))


# Facts


def _fact(name: str, *dims: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        plans = _dimension_plans(spark, sf_dir)
        built = plan_all({dim: plans[dim] for dim in dims})
        return fact_plans(Sources(spark, sf_dir), built, ts_literal(SNAPSHOT))[name]()

    return query


fct_order = _fact("order", "city", "customer", "stock_item", "employee")


def fct_stock_holding_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings at the present moment, with items of thousands of versions: one item per event type."""
    versions = _type_versions(spark, sf_dir).withColumnsRenamed({"type_id": "wwi_stock_item_id", "type_key": "stock_item_key"})
    staged = _staged(Sources(spark, sf_dir), "stock_holding").withColumn("wwi_stock_item_id", F.col("wwi_stock_item_id") % 10)
    return facts.fct_stock_holding(staged, {"stock_item": store(versions)})


# Loading and checks


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/check-{uuid.uuid4().hex}"


def read_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source table with more columns than are declared, read as JSON and as parquet."""
    base = _new_folder(spark)
    cities = Sources(spark, sf_dir)["Cities"]
    cities.withColumn("undeclared", F.lit(1)).write.parquet(f"{base}/Cities.parquet")
    cities.write.json(f"{base}/Cities.json")
    read = [read_source(spark, base, "Cities", fmt) for fmt in ("parquet", "json")]
    return read[0].unionByName(read[1])


def read_seed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_new_folder(spark)}/nations.csv"
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nations.write.csv(path, header=True)
    return read_seed(spark, path, "n_nationkey bigint, n_name string, n_regionkey bigint")


def write_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full replacement: the second table is what stays."""
    path = f"{_new_folder(spark)}/orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    write_table(orders, path, ["o_orderpriority"])
    return write_table(orders.where("o_custkey % 2 = 0"), path, ["o_orderpriority"])


def layer_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables routed to their layer's folder, or to the default one, and read from there."""
    root = _new_folder(spark)
    cfg = {"root": root, "default": "main", "dim": "dimensions", "fct": " "}
    for layer, name in (("dim", "region"), ("fct", "nation"), ("stg", "supplier")):
        write_table(table(spark, sf_dir, name), layer_path(cfg, layer, name))
    parts = [("dimensions", "region", "r_name"), ("main", "nation", "n_name"), ("main", "supplier", "s_name")]
    found = [
        read_table(spark, f"{root}/{folder}/{name}").select(F.lit(f"{folder}/{name}").alias("place"), F.col(column).alias("name"))
        for folder, name, column in parts
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def build_warehouse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build from source tables in files to written models: rows and sums of keys of every model."""
    root = _new_folder(spark)
    src = Sources(spark, sf_dir)
    for name in SOURCE_SCHEMAS:
        write_table(src[name], f"{root}/oltp/{name}.parquet")
    read = {name: read_source(spark, f"{root}/oltp", name) for name in SOURCE_SCHEMAS}
    cfg = {"root": f"{root}/dw", "default": "main", "dim": "dimensions", "fct": "facts"}
    built = build_warehouse(read, lambda name, df: write_table(df, layer_path(cfg, name[:3], name)), ts_literal(SNAPSHOT))

    def summary(name: str, df: DataFrame) -> DataFrame:
        keys = [c for c, kind in df.dtypes if c.endswith("_key") and kind == "bigint"]
        total = reduce(lambda a, b: a + b, [F.col(c) for c in keys])
        return df.agg(F.lit(name).alias("model"), F.count("*").alias("n"), F.sum(total).alias("key_sum"))

    return reduce(DataFrame.unionByName, [summary(name, df) for name, df in built.items()])


def incremental_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped after the last order of 1999 and before."""
    loaded = cutoff_window(table(spark, sf_dir, "orders"), "o_orderdate", end="2000-01-01 00:00:00")
    target = loaded.select(F.col("o_orderdate").alias("l_shipdate"))
    return incremental_filter(table(spark, sf_dir, "lineitem"), target, "l_shipdate")


def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last_time = watermark(orders, "o_orderdate", ts_literal(START_OF_TIME)).scalar()
    last_key = watermark(orders, "o_orderkey", F.lit(0).cast("bigint")).scalar()
    nothing = watermark(orders.where("o_orderkey IS NULL"), "o_orderdate", ts_literal(START_OF_TIME)).scalar()
    return spark.range(1).select(
        last_time.alias("last_time"), last_key.alias("last_key"), nothing.alias("last_time_of_none")
    )


def merge_upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = target.where("c_acctbal < 1000").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    added = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return merge_upsert(target, changed.unionByName(added), ["c_custkey"])


def merge_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The updates of ``merge_upsert`` into a stored table, in place."""
    path = f"{_new_folder(spark)}/customers"
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_parts(target, path, ["c_custkey"])
    changed = target.where("c_acctbal < 1000").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    merge_table(spark, path, changed, ["c_custkey"])
    added = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )
    return merge_table(spark, path, added, ["c_custkey"])


_ORDER_KEYS = {"key": "o_custkey", "key_name": "version_key", "ties": ["o_orderkey"]}


def late_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dimension to which all urgent orders come late, between and before its versions."""
    path, versions = _new_folder(spark), _customer_versions(spark, sf_dir)
    splice_dimension(spark, path, versions.where("o_orderpriority <> '1-URGENT'"), **_ORDER_KEYS)
    splice_dimension(spark, path, versions, **_ORDER_KEYS)
    return splice_dimension(spark, path, versions, **_ORDER_KEYS)


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuild after two loads: every version has the key that the loads gave it."""
    path, versions = _new_folder(spark), _customer_versions(spark, sf_dir)
    rebuild_dimension(spark, path, cutoff_window(versions, "valid_from", end=FIRST_LOAD_END), **_ORDER_KEYS)
    splice_dimension(spark, path, versions, **_ORDER_KEYS)
    return rebuild_dimension(spark, path, versions, **_ORDER_KEYS)


def scd1_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of all versions of customers in debt, overwritten; with NULL for some."""
    path = _new_folder(spark)
    splice_dimension(spark, path, _customer_versions(spark, sf_dir), **_ORDER_KEYS)
    priority = F.when(F.col("c_acctbal") < -500, F.lit(None)).otherwise(F.col("c_mktsegment"))
    debtors = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    changes = debtors.select(F.col("c_custkey").alias("o_custkey"), priority.alias("o_orderpriority"))
    return overwrite_attributes(spark, path, changes, "o_custkey")


def load_by_cutoff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, and between them one that fails after it has written and before its cutoff is stored."""
    folder, orders = _new_folder(spark), table(spark, sf_dir, "orders")
    state, path = f"{folder}/cutoffs", f"{folder}/orders"

    def merge(rows: DataFrame) -> None:
        merge_table(spark, path, rows, ["o_orderkey"])

    def merge_and_fail(rows: DataFrame) -> None:
        merge(rows)
        raise InterruptedError

    load_by_cutoff(spark, state, "orders", orders, "o_orderdate", CUTOFF_START, merge)
    try:
        load_by_cutoff(spark, state, "orders", orders, "o_orderdate", FIRST_LOAD_END, merge_and_fail)
    except InterruptedError:
        pass
    load_by_cutoff(spark, state, "orders", orders, "o_orderdate", CUTOFF_END, merge)
    load_by_cutoff(spark, state, "orders", orders, "o_orderdate", CUTOFF_START, merge_and_fail)
    return whole(read_parts(spark, path)).withColumn("reached", F.lit(stored_cutoff(spark, state, "orders")))


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_violations(_staged(Sources(spark, sf_dir), "order"), "picked_date_key")


def checked_write_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order and purchase facts, checked while they are written; known are the current versions only."""
    plans = _dimension_plans(spark, sf_dir)
    with scratch(spark) as built:
        dims = plan_all({name: plans[name] for name in ("city", "customer", "stock_item", "employee", "supplier")})
        with built.suspended():
            dims = {name: store(df) for name, df in dims.items()}
    current = {name: df.where(F.col("valid_to") == ts_literal(END_OF_TIME)) for name, df in dims.items()}
    rules, facts_of = fact_rules(current), fact_plans(Sources(spark, sf_dir), dims)
    folder, report = _new_folder(spark), []
    write = checked(lambda name, df: write_table(df, f"{folder}/{name}"), rules, report)
    write_one_by_one(spark, {name: facts_of[name] for name in ("order", "purchase")}, write)
    return spark.createDataFrame(report, REPORT)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the whole build, logged by their ids; times only by their order."""
    folder, src = _new_folder(spark), Sources(spark, sf_dir)
    for run_id in (41, 42):
        log: list[tuple] = []
        build_warehouse(src, logged(lambda name, df: write_table(df, f"{folder}/{name}"), run_id, log), ts_literal(SNAPSHOT))
        table_of_runs = store_log(spark, f"{folder}/runs", log)
    return table_of_runs.select("lineage_key", "model", "rows", (F.col("started") <= F.col("finished")).alias("in_order"))


def orphan_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose customer version is no longer the current one."""
    dim = store(customer_dim(spark, sf_dir))
    keyed = lookup_key(
        shipped_lines(spark, sf_dir), dim, "customer_id", "o_custkey", "l_shipdate", "version_key", "customer_key"
    )
    current = dim.where(F.col("valid_to") == ts_literal(END_OF_TIME))
    return orphan_keys(keyed, current, "customer_key", "version_key")


def cutoff_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutoff_window(table(spark, sf_dir, "orders"), "o_orderdate", CUTOFF_START, CUTOFF_END)


def update_cutoff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    state = orders.groupBy(F.col("o_orderpriority").alias("table_name")).agg(F.max("o_orderdate").alias("cutoff_time"))
    name = F.when(F.col("o_orderstatus") == "F", "finished").otherwise(F.col("o_orderpriority"))
    reached = orders.groupBy(name.alias("table_name")).agg(
        (F.max("o_orderdate") + F.make_dt_interval(F.lit(1))).alias("cutoff_time")
    )
    return update_cutoff(state, reached.where("table_name <> '5-LOW'"))


def with_lineage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(table(spark, sf_dir, "orders"), 42)


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, {"dim_customer_versions": customer_dim(spark, sf_dir)})
    return spark.sql(
        "SELECT version_key, o_custkey, o_orderpriority, valid_from FROM dim_customer_versions "
        "WHERE o_orderpriority = '1-URGENT' ORDER BY valid_from DESC, version_key LIMIT 5"
    )


def adhoc_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, orders and a few of the customers, written in the worst order and joined by cost."""
    folder, run = _new_folder(spark), uuid.uuid4().hex
    names = {name: f"{name}_{run}" for name in ("lineitem", "orders", "customer")}
    for name, stored in names.items():
        write_analyzed(table(spark, sf_dir, name), stored, f"{folder}/{name}")
    return by_cost(
        spark,
        f"SELECT c.c_custkey, count(*) AS lines, max(l.l_shipdate) AS last_shipped FROM {names['lineitem']} l "
        f"JOIN {names['orders']} o ON l.l_orderkey = o.o_orderkey JOIN {names['customer']} c ON o.o_custkey = c.c_custkey "
        "WHERE c.c_custkey <= 20 GROUP BY c.c_custkey",
    )


def adhoc_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by month of one quarter; only the partitions of its months are read."""
    staged = _staged(Sources(spark, sf_dir), "order")
    lines = write_monthly(staged, f"{_new_folder(spark)}/orders", "order_date_key")
    days = dimensions.dim_date_for(table(spark, sf_dir, "orders"), "o_orderdate").withColumn("month_key", month_key(F.col("date_key")))
    register_views(spark, {"monthly_orders": lines, "days": store(days)})
    return spark.sql(
        "SELECT d.year, d.month, count(*) AS lines, count(DISTINCT o.wwi_order_id) AS orders, max(o.quantity) AS largest "
        "FROM monthly_orders o JOIN days d ON o.month_key = d.month_key AND o.order_date_key = d.date_key "
        "WHERE d.year = 1997 AND d.quarter = 2 GROUP BY d.year, d.month"
    )


QUERIES: dict[str, Query] = {
    "q_stage_rename": stage_rename,
    "q_stage_safe_int": stage_safe_int,
    "q_stage_timestamp": stage_timestamp,
    "q_stage_parse_date": stage_parse_date,
    "q_last_modified": last_modified_query,
    "q_stage_city": _stage("city"),
    "q_stage_customer": _stage("customer"),
    "q_stage_employee": _stage("employee"),
    "q_stage_payment_method": _stage("payment_method"),
    "q_stage_stock_item": _stage("stock_item"),
    "q_stage_supplier": _stage("supplier"),
    "q_stage_transaction_type": _stage("transaction_type"),
    "q_stage_movement": _stage("movement"),
    "q_stage_order": _stage("order"),
    "q_stage_order_bucketed": stage_order_bucketed,
    "q_stage_order_decimal": stage_order_decimal,
    "q_stage_purchase": _stage("purchase"),
    "q_stage_sale": _stage("sale"),
    "q_stage_sale_window": stage_sale_window,
    "q_stage_stock_holding": _stage("stock_holding"),
    "q_stage_transaction": _stage("transaction"),
    "q_pit_inner": pit_inner,
    "q_pit_left": pit_left,
    "q_pit_long_history": pit_long_history,
    "q_pit_repeated_versions": pit_repeated_versions,
    "q_enrich_city": _enrich("city"),
    "q_enrich_customer": _enrich("customer"),
    "q_enrich_supplier": _enrich("supplier"),
    "q_scd2_close": scd2_close_query,
    "q_scd1_latest": scd1_latest_query,
    "q_dense_key": dense_key_query,
    "q_dim_city": _dim("city"),
    "q_dim_customer": _dim("customer"),
    "q_dim_employee": _dim("employee"),
    "q_dim_payment_method": _dim("payment_method"),
    "q_dim_stock_item": _dim("stock_item"),
    "q_dim_supplier": _dim("supplier"),
    "q_dim_transaction_type": _dim("transaction_type"),
    "q_dim_city_incremental": dim_city_incremental,
    "q_dim_date": dim_date_query,
    "q_lookup_broadcast": _lookup("broadcast"),
    "q_lookup_union_window": _lookup("union_window"),
    "q_lookup_ranked": _lookup("ranked"),
    "q_lookup_long_history": lookup_long_history,
    "q_lookup_overlapping": lookup_overlapping,
    "q_lookup_append_only": lookup_append_only,
    "q_lookup_two_keys": lookup_two_keys,
    "q_fct_order": fct_order,
    "q_fct_sale": _fact("sale", "city", "customer", "stock_item", "employee"),
    "q_fct_transaction": _fact("transaction", "customer", "supplier", "transaction_type", "payment_method"),
    "q_fct_movement": _fact("movement", "stock_item", "customer", "supplier", "transaction_type"),
    "q_fct_purchase": _fact("purchase", "supplier", "stock_item"),
    "q_fct_stock_holding": _fact("stock_holding", "stock_item"),
    "q_fct_stock_holding_now": fct_stock_holding_now,
    "q_read_source": read_source_query,
    "q_read_seed": read_seed_query,
    "q_write_table": write_table_query,
    "q_layer_path": layer_path_query,
    "q_build_warehouse": build_warehouse_query,
    "q_incremental_filter": incremental_filter_query,
    "q_watermark_max": watermark_max,
    "q_merge_upsert": merge_upsert_query,
    "q_merge_table": merge_table_query,
    "q_late_versions": late_versions,
    "q_stable_keys": stable_keys,
    "q_scd1_apply": scd1_apply,
    "q_load_by_cutoff": load_by_cutoff_query,
    "q_not_null": not_null,
    "q_checked_write": checked_write_query,
    "q_run_log": run_log,
    "q_orphan_keys": orphan_keys_query,
    "q_cutoff_window": cutoff_window_query,
    "q_update_cutoff": update_cutoff_query,
    "q_with_lineage": with_lineage_query,
    "q_adhoc_sql": adhoc_sql,
    "q_adhoc_by_quarter": adhoc_by_quarter,
    "q_adhoc_join": adhoc_join,
}
