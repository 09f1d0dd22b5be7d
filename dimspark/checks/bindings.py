"""The test tables in the roles of the operational sources.

Every role is derived from whole test tables, so it grows with them. ``Customers``
and ``People`` and ``StockItems`` have one row per id, as fact staging expects;
the ``*History`` roles give their dimensions several versions per id, and take
their place where a model is to be built from them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.sources import store

# The two periods given to each state, country, category and group.
FIRST_PERIOD_START = "1990-01-01 00:00:00.0000000"
SECOND_PERIOD_START = "1998-01-01 00:00:00.0000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _ts_text(name: str) -> Column:
    """A timestamp as text with seven fractional digits, the way the sources deliver it."""
    return F.concat(F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000"))


def _never() -> Column:
    return F.lit(None).cast("string").alias("validto")


def _int_div(name: str, divisor: int) -> Column:
    return F.expr(f"{name} div {divisor}")


def _two_periods(df: DataFrame) -> DataFrame:
    """Each row as a version up to 1998 and an open one from then on."""
    periods = F.array(
        F.struct(
            F.lit(1).alias("n"), F.lit(FIRST_PERIOD_START).alias("validfrom"), F.lit(SECOND_PERIOD_START).alias("validto")
        ),
        F.struct(F.lit(2).alias("n"), F.lit(SECOND_PERIOD_START).alias("validfrom"), _never()),
    )
    return df.withColumn("period", F.explode(periods)).select(*df.columns, "period.*")


class Sources(Mapping):
    """Source roles over the tables in ``sf_dir``; ``sources["Orders"]`` builds one.

    ``replaced`` gives a role the rows of another: ``Sources(..., People="PeopleHistory")``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, **replaced: str):
        self._spark, self._sf_dir, self._replaced = spark, sf_dir, replaced
        self._tables: dict[str, DataFrame] = {}
        self._roles: dict[str, Callable[[], DataFrame]] = {
            "StateProvinces": self.state_provinces,
            "Countries": self.countries,
            "Cities": self.cities,
            "Customers": self.customers,
            "CustomersHistory": self._written(self.customers_history),
            "CustomerCategories": self.customer_categories,
            "BuyingGroups": self.buying_groups,
            "People": self.people,
            "PeopleHistory": self.people_history,
            "EmployeeHistory": self.employee_history,
            "PaymentMethods": self.payment_methods,
            "TransactionTypes": self.transaction_types,
            "StockItems": self.stock_items,
            "StockItemsHistory": self.stock_items_history,
            "PackageTypes": self.package_types,
            "Suppliers": self.suppliers,
            "SupplierCategories": self.supplier_categories,
            "Orders": self.orders,
            "OrderLines": self.order_lines,
            "Invoices": self.invoices,
            "InvoiceLines": self.invoice_lines,
            "PurchaseOrders": self.purchase_orders,
            "PurchaseOrderLines": self.purchase_order_lines,
            "StockItemTransactions": self.stock_item_transactions,
            "CustomerTransactions": self.customer_transactions,
            "SupplierTransactions": self.supplier_transactions,
            "StockItemHoldings": self.stock_item_holdings,
        }

    def __getitem__(self, role: str) -> DataFrame:
        return self._roles[self._replaced.get(role, role)]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._roles)

    def __len__(self) -> int:
        return len(self._roles)

    def _written(self, role: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        """A role that takes a window to derive: written once, as a source would be, since models read it several times."""
        return functools.cache(lambda: store(role()))

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self._spark, self._sf_dir, name)
        return self._tables[name]

    # Reference data

    def state_provinces(self) -> DataFrame:
        return _two_periods(self._table("nation")).select(
            F.col("n_nationkey").cast("bigint").alias("stateprovinceid"),
            F.concat("n_name", F.lit(" v"), "n").alias("stateprovincename"),
            F.col("n_regionkey").cast("bigint").alias("countryid"),
            F.concat(F.lit("Territory "), "n_regionkey").alias("salesterritory"),
            "validfrom",
            "validto",
        )

    def countries(self) -> DataFrame:
        return _two_periods(self._table("region")).select(
            F.col("r_regionkey").cast("bigint").alias("countryid"),
            F.concat("r_name", F.lit(" v"), "n").alias("countryname"),
            F.col("r_name").alias("continent"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("Sub "), "r_name").alias("subregion"),
            "validfrom",
            "validto",
        )

    def customer_categories(self) -> DataFrame:
        return _two_periods(self._table("region")).select(
            _text("r_regionkey").alias("customercategoryid"),
            F.concat("r_name", F.lit(" c"), "n").alias("customercategoryname"),
            "validfrom",
            "validto",
        )

    def buying_groups(self) -> DataFrame:
        return _two_periods(self._table("nation")).select(
            _text("n_nationkey").alias("buyinggroupid"),
            F.concat("n_name", F.lit(" g"), "n").alias("buyinggroupname"),
            "validfrom",
            "validto",
        )

    def supplier_categories(self) -> DataFrame:
        return _two_periods(self._table("region")).select(
            _text("r_regionkey").alias("suppliercategoryid"),
            F.concat("r_name", F.lit(" s"), "n").alias("suppliercategoryname"),
            "validfrom",
            "validto",
        )

    def package_types(self) -> DataFrame:
        return self._table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("packagetypeid"),
            F.concat(F.lit("Pack "), "n_name").alias("packagetypename"),
        )

    # Masters and their histories

    def cities(self) -> DataFrame:
        """A city version per order; ids 25 and up of the state find no state."""
        return self._table("orders").select(
            F.col("o_custkey").alias("cityid"),
            F.concat(F.lit("City "), "o_custkey", F.lit(" "), "o_orderpriority").alias("cityname"),
            F.pmod("o_custkey", F.lit(26)).alias("stateprovinceid"),
            F.col("o_orderstatus").alias("location"),
            F.when(F.col("o_orderstatus") == "P", "n/a")
            .otherwise(F.floor("o_totalprice").cast("string"))
            .alias("latestrecordedpopulation"),
            _ts_text("o_orderdate").alias("validfrom"),
            _never(),
        )

    def customers(self) -> DataFrame:
        return self._table("customer").select(
            _text("c_custkey").alias("customerid"),
            F.col("c_name").alias("customername"),
            _int_div("c_custkey", 10).cast("string").alias("billtocustomerid"),
            _text("c_nationkey").alias("customercategoryid"),
            _text("c_nationkey").alias("buyinggroupid"),
            _int_div("c_custkey", 12).cast("string").alias("primarycontactpersonid"),
            F.col("c_custkey").alias("deliverycityid"),
            F.col("c_mktsegment").alias("deliverypostalcode"),
            F.lit("1996-06-01 00:00:00.0000000").alias("validfrom"),
            _never(),
        )

    def customers_history(self) -> DataFrame:
        """A customer version per order, in force until the next one."""
        of_customer = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
        orders = self._table("orders").withColumn("_next", F.lead("o_orderdate").over(of_customer))
        return orders.select(
            _text("o_custkey").alias("customerid"),
            F.concat(F.lit("Customer "), "o_custkey").alias("customername"),
            _int_div("o_custkey", 10).cast("string").alias("billtocustomerid"),
            F.substring("o_orderpriority", 1, 1).alias("customercategoryid"),
            F.when(F.col("o_orderstatus") != "P", F.pmod("o_custkey", F.lit(25)).cast("string")).alias("buyinggroupid"),
            _int_div("o_custkey", 12).cast("string").alias("primarycontactpersonid"),
            F.col("o_custkey").alias("deliverycityid"),
            F.col("o_orderpriority").alias("deliverypostalcode"),
            _ts_text("o_orderdate").alias("validfrom"),
            _ts_text("_next").alias("validto"),
        )

    def people(self) -> DataFrame:
        started = F.expr("timestamp_ntz'1995-06-01 00:00:00' + make_dt_interval(s_nationkey * 30)")
        return self._table("supplier").select(
            F.col("s_suppkey").alias("personid"),
            F.col("s_name").alias("fullname"),
            F.substring("s_name", 10, 9).alias("preferredname"),
            F.col("s_nationkey").alias("issalesperson"),
            started.alias("validfrom"),
            F.lit(None).cast("timestamp_ntz").alias("validto"),
        )

    def people_history(self) -> DataFrame:
        """A version per user event."""
        return self._table("events").select(
            F.col("user_id").alias("personid"),
            F.concat(F.lit("User "), "user_id").alias("fullname"),
            F.col("event_type").alias("preferredname"),
            F.lit(1).alias("issalesperson"),
            F.col("ts").alias("validfrom"),
            F.lit(None).cast("timestamp_ntz").alias("validto"),
        )

    def employee_history(self) -> DataFrame:
        """A version per salesperson and year of orders; the first five are pickers too."""
        person = _int_div("o_custkey", 12)
        first = self._table("orders").groupBy(person.alias("person"), F.year("o_orderdate").alias("y")).agg(
            F.min("o_orderdate").alias("first")
        )
        return first.select(
            F.col("person").alias("personid"),
            F.concat(F.lit("Person "), "person").alias("fullname"),
            F.concat(F.lit("Year "), "y").alias("preferredname"),
            F.lit(1).alias("issalesperson"),
            F.col("first").alias("validfrom"),
            F.lit(None).cast("timestamp_ntz").alias("validto"),
        )

    def payment_methods(self) -> DataFrame:
        """A version per order priority and year."""
        first = self._table("orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(
            F.min("o_orderdate").alias("first")
        )
        return first.select(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("paymentmethodid"),
            F.concat("o_orderpriority", F.lit(" "), "y").alias("paymentmethodname"),
            _ts_text("first").alias("validfrom"),
            _never(),
        )

    def transaction_types(self) -> DataFrame:
        """A version per order status and year."""
        first = self._table("orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("y")).agg(
            F.min("o_orderdate").alias("first")
        )
        return first.select(
            _status_id().alias("transactiontypeid"),
            F.concat("o_orderstatus", F.lit(" "), "y").alias("transactiontypename"),
            _ts_text("first").alias("validfrom"),
            _never(),
        )

    def stock_items(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("stockitemid"),
            *_item_columns(),
            F.col("p_retailprice").alias("unitprice"),
            F.expr("timestamp_ntz'1993-01-01 00:00:00'").alias("validfrom"),
            F.lit(None).cast("timestamp_ntz").alias("validto"),
        )

    def stock_items_history(self) -> DataFrame:
        """A version per part and year of shipping."""
        shipped = self._table("lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(
            F.min("l_shipdate").alias("first"), F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
        )
        return shipped.join(self._table("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_partkey").alias("stockitemid"),
            *_item_columns(),
            F.col("price").alias("unitprice"),
            F.col("first").alias("validfrom"),
            F.lit(None).cast("timestamp_ntz").alias("validto"),
        )

    def suppliers(self) -> DataFrame:
        """A version per supplier and year of shipping."""
        shipped = self._table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(
            F.min("l_shipdate").alias("first")
        )
        return shipped.join(self._table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
            _text("l_suppkey").alias("supplierid"),
            F.col("s_name").alias("suppliername"),
            F.pmod("s_nationkey", F.lit(6)).cast("string").alias("suppliercategoryid"),
            F.expr("l_suppkey * 2").cast("string").alias("primarycontactpersonid"),
            F.concat(F.lit("Ref "), "y").alias("supplierreference"),
            F.col("s_nationkey").alias("paymentdays"),
            _text("s_nationkey").alias("deliverypostalcode"),
            _ts_text("first").alias("validfrom"),
            _never(),
        )

    # Transactions

    def orders(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("orderid"),
            F.col("o_custkey").alias("customerid"),
            F.col("o_orderdate").alias("orderdate"),
            _int_div("o_custkey", 12).alias("salespersonpersonid"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("pickedbypersonid"),
            F.col("o_orderdate").alias("lasteditedwhen"),
        )

    def order_lines(self) -> DataFrame:
        return self._table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("orderlineid"),
            F.col("l_orderkey").alias("orderid"),
            F.col("l_partkey").alias("stockitemid"),
            F.col("l_quantity").cast("bigint").alias("packagetypeid"),
            F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("description"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unitprice"),
            (F.col("l_tax") * 100).alias("taxrate"),
            F.when(F.col("l_returnflag") == "A", _text("l_shipdate"))
            .when(F.col("l_returnflag") == "R", F.lit("pending"))
            .alias("pickingcompletedwhen"),
            F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("lasteditedwhen"),
        )

    def invoices(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("invoiceid"),
            F.col("o_custkey").alias("customerid"),
            _int_div("o_custkey", 10).alias("billtocustomerid"),
            _int_div("o_custkey", 12).alias("salespersonpersonid"),
            F.col("o_orderdate").alias("invoicedate"),
            F.expr("o_orderdate + interval 3 days").alias("confirmeddeliverytime"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("lasteditedwhen"),
        )

    def invoice_lines(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("invoiceid"),
            F.col("l_partkey").alias("stockitemid"),
            F.col("l_quantity").cast("bigint").alias("packagetypeid"),
            F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("description"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unitprice"),
            (F.col("l_tax") * 100).alias("taxrate"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("taxamount"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("lineprofit"),
            F.col("l_extendedprice").alias("extendedprice"),
            F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("lasteditedwhen"),
        )

    def purchase_orders(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("purchaseorderid"),
            _int_div("o_custkey", 15).alias("supplierid"),
            F.col("o_orderdate").alias("orderdate"),
            F.col("o_orderdate").alias("lasteditedwhen"),
        )

    def purchase_order_lines(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("purchaseorderid"),
            F.col("l_partkey").alias("stockitemid"),
            F.col("l_quantity").cast("bigint").alias("packagetypeid"),
            F.col("l_quantity").cast("bigint").alias("orderedouters"),
            (F.col("l_quantity").cast("bigint") - F.col("l_linenumber")).alias("receivedouters"),
            (F.col("l_linestatus") == "F").alias("isorderlinefinalized"),
            F.col("l_shipdate").alias("lasteditedwhen"),
        )

    def stock_item_transactions(self) -> DataFrame:
        kind = F.col("event_type")
        number = (
            F.when(kind == "click", 1).when(kind == "view", 2).when(kind == "purchase", 3).when(kind == "signup", 4)
        )
        return self._table("events").select(
            F.col("event_id").alias("stockitemtransactionid"),
            F.col("ts").alias("transactionoccurredwhen"),
            _int_div("event_id", 5).alias("stockitemid"),
            F.when(kind.isin("purchase", "view"), F.col("user_id")).alias("customerid"),
            F.when(kind == "click", F.col("user_id")).alias("supplierid"),
            number.cast("bigint").alias("transactiontypeid"),
            F.when(kind == "purchase", F.col("event_id")).alias("invoiceid"),
            F.when(kind == "click", F.col("event_id")).alias("purchaseorderid"),
            F.when(kind == "purchase", -F.col("value")).otherwise(F.col("value")).alias("quantity"),
            F.col("ts").alias("lasteditedwhen"),
        )

    def customer_transactions(self) -> DataFrame:
        return self._table("orders").select(
            _text("o_orderkey").alias("customertransactionid"),
            F.col("o_orderdate").alias("transactiondate"),
            _text("o_custkey").alias("customerid"),
            _status_id().alias("transactiontypeid"),
            F.substring("o_orderpriority", 1, 1).alias("paymentmethodid"),
            _text("o_orderkey").alias("invoiceid"),
            F.col("o_totalprice").alias("amountexcludingtax"),
            (F.col("o_totalprice") * 0.1).alias("taxamount"),
            (F.col("o_totalprice") * 1.1).alias("transactionamount"),
            F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("outstandingbalance"),
            F.when(F.col("o_orderstatus") != "P", (F.col("o_orderstatus") == "F").cast("int")).alias("isfinalized"),
            F.expr("o_orderdate + interval 1 day").alias("lasteditedwhen"),
        )

    def supplier_transactions(self) -> DataFrame:
        return self._table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("suppliertransactionid"),
            F.col("l_shipdate").alias("transactiondate"),
            _text("l_suppkey").alias("supplierid"),
            F.col("l_linenumber").cast("bigint").alias("transactiontypeid"),
            _text("l_linenumber").alias("paymentmethodid"),
            _text("l_orderkey").alias("purchaseorderid"),
            F.concat("l_returnflag", F.lit("-"), "l_orderkey").alias("supplierinvoicenumber"),
            F.col("l_extendedprice").alias("amountexcludingtax"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("taxamount"),
            F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias(
                "transactionamount"
            ),
            F.when(F.col("l_linestatus") != "F", F.col("l_extendedprice")).alias("outstandingbalance"),
            (F.col("l_linestatus") == "F").cast("int").alias("isfinalized"),
            F.col("l_shipdate").alias("lasteditedwhen"),
        )

    def stock_item_holdings(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("stockitemid"),
            F.col("p_size").alias("quantityonhand"),
            F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("binlocation"),
            (F.col("p_size") * 2).alias("laststocktakequantity"),
            F.col("p_retailprice").alias("lastcostprice"),
            (F.col("p_size") + 5).alias("reorderlevel"),
            (F.col("p_size") + 100).alias("targetstocklevel"),
        )


def _item_columns() -> list[Column]:
    return [
        F.col("p_name").alias("stockitemname"),
        _int_div("p_size", 10).alias("colorid"),
        F.lit(1).cast("bigint").alias("unitpackageid"),
        F.lit(2).cast("bigint").alias("outerpackageid"),
        F.col("p_brand").alias("brand"),
        _text("p_size").alias("size"),
        F.col("p_size").alias("leadtimedays"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size")).alias("quantityperouter"),
        F.when(F.col("p_type") != "PROMO", (F.col("p_type") == "SMALL").cast("int")).alias("ischillerstock"),
        F.col("p_type").alias("barcode"),
        F.lit(15.0).alias("taxrate"),
        F.col("p_retailprice").alias("recommendedretailprice"),
        F.lit(0.5).alias("typicalweightperunit"),
    ]


def _status_id() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", 1).when(status == "O", 2).when(status == "P", 3).cast("bigint")
