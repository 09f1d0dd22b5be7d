"""Staging: one function per entity, from operational tables to typed, renamed rows.

Identifiers become bigint and timestamps timestamp_ntz here, once, so that later
joins compare bare columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.functions.scalars import (
    flag,
    last_modified,
    safe_date,
    safe_int,
    safe_timestamp,
    strict_date,
    typed_null,
    with_default,
)
from dimspark.operators.joins import left_join


def int_of(df: DataFrame, column: str) -> Column:
    return safe_int(df[column], df.schema[column].dataType)


def timestamp_of(df: DataFrame, column: str) -> Column:
    return safe_timestamp(df[column], df.schema[column].dataType)


def date_of(df: DataFrame, column: str) -> Column:
    return safe_date(df[column], df.schema[column].dataType)


def stage_city(cities: DataFrame) -> DataFrame:
    return cities.select(
        F.col("cityid").alias("wwi_city_id"),
        F.col("cityname").alias("city"),
        F.col("stateprovinceid").alias("state_province_id"),
        "location",
        with_default(int_of(cities, "latestrecordedpopulation"), 0).alias("latest_recorded_population"),
        timestamp_of(cities, "validfrom").alias("valid_from"),
        timestamp_of(cities, "validto").alias("valid_to"),
    )


def stage_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        int_of(customers, "customerid").alias("wwi_customer_id"),
        F.col("customername").alias("customer"),
        int_of(customers, "billtocustomerid").alias("bill_to_customer_id"),
        int_of(customers, "customercategoryid").alias("customer_category_id"),
        int_of(customers, "buyinggroupid").alias("buying_group_id"),
        int_of(customers, "primarycontactpersonid").alias("primary_contact_personid"),
        F.col("deliverypostalcode").alias("postal_code"),
        timestamp_of(customers, "validfrom").alias("valid_from"),
        timestamp_of(customers, "validto").alias("valid_to"),
    )


def stage_employee(people: DataFrame) -> DataFrame:
    """Every person, salesperson or not; periods are taken as they are."""
    return people.select(
        F.col("personid").alias("wwi_employee_id"),
        F.col("fullname").alias("employee"),
        "preferredname",
        "issalesperson",
        "validfrom",
        "validto",
    )


def stage_payment_method(payment_methods: DataFrame) -> DataFrame:
    return payment_methods.select(
        F.col("paymentmethodid").alias("wwi_payment_method_id"),
        F.col("paymentmethodname").alias("payment_method"),
        timestamp_of(payment_methods, "validfrom").alias("validfrom"),
        timestamp_of(payment_methods, "validto").alias("validto"),
    )


def stage_transaction_type(transaction_types: DataFrame) -> DataFrame:
    return transaction_types.select(
        F.col("transactiontypeid").alias("wwi_transaction_type_id"),
        F.col("transactiontypename").alias("transaction_type"),
        timestamp_of(transaction_types, "validfrom").alias("validfrom"),
        timestamp_of(transaction_types, "validto").alias("validto"),
    )


def stage_stock_item(stock_items: DataFrame) -> DataFrame:
    return stock_items.select(
        F.col("stockitemid").alias("wwi_stock_item_id"),
        F.col("stockitemname").alias("stock_item"),
        F.col("colorid").alias("wwi_color_id"),
        F.col("unitpackageid").alias("wwi_unit_package_id"),
        F.col("outerpackageid").alias("wwi_outer_package_id"),
        "brand",
        "size",
        "leadtimedays",
        "quantityperouter",
        "ischillerstock",
        "barcode",
        "taxrate",
        "unitprice",
        "recommendedretailprice",
        "typicalweightperunit",
        "validfrom",
        "validto",
    )


def stage_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        int_of(suppliers, "supplierid").alias("wwi_supplier_id"),
        F.col("suppliername").alias("supplier"),
        int_of(suppliers, "suppliercategoryid").alias("suppliercategoryid"),
        int_of(suppliers, "primarycontactpersonid").alias("primarycontactpersonid"),
        F.col("supplierreference").alias("supplier_reference"),
        F.col("paymentdays").alias("payment_days"),
        F.col("deliverypostalcode").alias("postal_code"),
        timestamp_of(suppliers, "validfrom").alias("valid_from"),
        timestamp_of(suppliers, "validto").alias("valid_to"),
    )


def stage_movement(stock_item_transactions: DataFrame) -> DataFrame:
    return stock_item_transactions.select(
        F.col("stockitemtransactionid").alias("wwi_stock_item_transaction_id"),
        strict_date(F.col("transactionoccurredwhen")).alias("date_key"),
        F.col("stockitemid").alias("wwi_stock_item_id"),
        F.col("customerid").alias("wwi_customer_id"),
        F.col("supplierid").alias("wwi_supplier_id"),
        F.col("transactiontypeid").alias("wwi_transaction_type_id"),
        F.col("invoiceid").alias("wwi_invoice_id"),
        F.col("purchaseorderid").alias("wwi_purchase_order_id"),
        "quantity",
        F.col("lasteditedwhen").alias("last_modified_when"),
    )


def stage_stock_holding(stock_item_holdings: DataFrame) -> DataFrame:
    return stock_item_holdings.select(
        F.col("stockitemid").alias("wwi_stock_item_id"),
        F.col("quantityonhand").alias("quantity_on_hand"),
        "binlocation",
        F.col("laststocktakequantity").alias("last_stocktake_quantity"),
        F.col("lastcostprice").alias("last_cost_price"),
        "reorderlevel",
        F.col("targetstocklevel").alias("target_stock_level"),
    )


def _delivery_city(customers: DataFrame) -> DataFrame:
    return customers.select(
        int_of(customers, "customerid").alias("_customer"), F.col("deliverycityid").alias("wwi_city_id")
    )


def _packages(package_types: DataFrame) -> DataFrame:
    return package_types.select(F.col("packagetypeid").alias("_package"), F.col("packagetypename").alias("_package_name"))


_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOST_DIGITS = 38


def _digits(df: DataFrame, column: str) -> tuple[int, int] | None:
    """Precision and scale of an exact number column, None for other types."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    digits = _INTEGER_DIGITS.get(type(kind))
    return (digits, 0) if digits else None


def _product(a: Column, a_digits: tuple[int, int], b: Column, b_digits: tuple[int, int]) -> tuple[Column, tuple[int, int]]:
    """The exact product of two decimals.

    Spark gives up fractional digits of a product of more than 38 digits. The first
    factor is narrowed instead, by whole digits only: a value that doesn't fit fails.
    """
    scale, room = a_digits[1] + b_digits[1], _MOST_DIGITS - 1 - b_digits[0]
    if min(a_digits[0], room) < a_digits[1] or scale > _MOST_DIGITS:
        raise ValueError(f"a product of decimals {a_digits} and {b_digits} does not fit {_MOST_DIGITS} digits")
    precision = min(a_digits[0], room)
    product = a.cast(f"decimal({precision},{a_digits[1]})") * b.cast(f"decimal({b_digits[0]},{b_digits[1]})")
    return product, (precision + b_digits[0] + 1, scale)


def _net_and_tax(lines: DataFrame) -> tuple[Column, Column, Column]:
    """Net, tax and gross amount of an order line.

    Exact for decimals and integers, with nine fractional digits or as many more as
    the factors bring; in floating point if any factor is.
    """
    names = ("quantity", "unitprice", "taxrate")
    digits = [_digits(lines, name) for name in names]
    if None in digits or not any(isinstance(lines.schema[name].dataType, T.DecimalType) for name in names):
        quantity, price, rate = (F.col(name).cast("double") if None in digits else F.col(name) for name in names)
        net = quantity * price
        return net, net * rate / 100, net * (1 + rate / 100)
    net, net_digits = _product(F.col("quantity"), digits[0], F.col("unitprice"), digits[1])
    # A hundredth of the rate has two more fractional digits.
    precision, scale = digits[2][0] + 2, digits[2][1] + 2
    if precision + 1 > _MOST_DIGITS:
        raise ValueError(f"a tax rate of {digits[2]} digits is too long")
    share = (F.col("taxrate") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},{scale})")
    tax, (_, tax_scale) = _product(net, net_digits, share, (precision, scale))
    kind = f"decimal({_MOST_DIGITS},{max(9, tax_scale)})"
    net, tax = net.cast(kind), tax.cast(kind)
    return net, tax, (net + tax).cast(kind)


def joined_order(orders: DataFrame, order_lines: DataFrame, customers: DataFrame, package_types: DataFrame) -> DataFrame:
    """One row per order line, before its amounts are found. Lines of an order without a known customer drop out."""
    # Customers are joined to the headers, so the lines are shuffled once, by order.
    headers = orders.select(
        F.col("orderid").alias("wwi_order_id"),
        F.col("customerid").alias("wwi_customer_id"),
        date_of(orders, "orderdate").alias("order_date_key"),
        F.col("salespersonpersonid").alias("wwi_salesperson_id"),
        F.col("pickedbypersonid").alias("wwi_picker_id"),
        F.col("lasteditedwhen").alias("_header_edited"),
    ).join(_delivery_city(customers), F.col("wwi_customer_id") == F.col("_customer"))
    lines = order_lines.select(
        F.col("orderid").alias("_order"),
        F.col("orderlineid").alias("wwi_backorder_id"),
        F.col("stockitemid").alias("wwi_stock_item_id"),
        date_of(order_lines, "pickingcompletedwhen").alias("picked_date_key"),
        "description",
        "packagetypeid",
        "quantity",
        "unitprice",
        "taxrate",
        F.col("lasteditedwhen").alias("_line_edited"),
    )
    return (
        lines.join(headers, F.col("_order") == F.col("wwi_order_id"))
        .transform(lambda df: left_join(df, _packages(package_types), "packagetypeid", "_package", ["wwi_order_id"]))
        .select(
            "wwi_order_id",
            "wwi_backorder_id",
            "wwi_city_id",
            "wwi_customer_id",
            "wwi_stock_item_id",
            "order_date_key",
            "picked_date_key",
            "wwi_salesperson_id",
            "wwi_picker_id",
            "description",
            with_default(F.col("_package_name"), "Unknown").alias("package"),
            "quantity",
            "unitprice",
            "taxrate",
            last_modified(F.col("_line_edited"), F.col("_header_edited")).alias("last_modified_when"),
        )
    )


def finished_order(rows: DataFrame) -> DataFrame:
    """``joined_order``, with or without keys, and its amounts.

    They follow from other columns: found after joins and lookups, they aren't shuffled or stored.
    """
    net, tax, gross = _net_and_tax(rows)
    return rows.select(
        "*", net.alias("total_excluding_tax"), tax.alias("tax_amount"), gross.alias("total_including_tax")
    )


def stage_order(orders: DataFrame, order_lines: DataFrame, customers: DataFrame, package_types: DataFrame) -> DataFrame:
    """One row per order line. Lines of an order without a known customer drop out."""
    return finished_order(joined_order(orders, order_lines, customers, package_types)).select(
        "wwi_order_id",
        "wwi_backorder_id",
        "wwi_city_id",
        "wwi_customer_id",
        "wwi_stock_item_id",
        "order_date_key",
        "picked_date_key",
        "wwi_salesperson_id",
        "wwi_picker_id",
        "description",
        "package",
        "quantity",
        "unitprice",
        "taxrate",
        "total_excluding_tax",
        "tax_amount",
        "total_including_tax",
        "last_modified_when",
    )


def joined_purchase(purchase_orders: DataFrame, purchase_order_lines: DataFrame) -> DataFrame:
    """One row per purchase order line, before its package and item are read."""
    headers = purchase_orders.select(
        F.col("purchaseorderid").alias("wwi_purchase_order_id"),
        strict_date(F.col("orderdate")).alias("date_key"),
        F.col("supplierid").alias("wwi_supplier_id"),
        F.col("lasteditedwhen").alias("_header_edited"),
    )
    lines = purchase_order_lines.withColumnsRenamed(
        {"purchaseorderid": "_order", "stockitemid": "wwi_stock_item_id", "lasteditedwhen": "_line_edited"}
    )
    return lines.join(headers, F.col("_order") == F.col("wwi_purchase_order_id")).select(
        "date_key",
        "wwi_supplier_id",
        "wwi_stock_item_id",
        "wwi_purchase_order_id",
        "packagetypeid",
        "orderedouters",
        "receivedouters",
        F.col("isorderlinefinalized").alias("is_order_finalized"),
        last_modified(F.col("_line_edited"), F.col("_header_edited")).alias("last_modified_when"),
    )


def finished_purchase(rows: DataFrame, stock_items: DataFrame, package_types: DataFrame) -> DataFrame:
    """``joined_purchase``, with or without keys, and what its item and package tell.

    Read after the lookups, they aren't shuffled with the rows.
    """
    items = stock_items.select(F.col("stockitemid").alias("_item"), F.col("quantityperouter").alias("_per_outer"))
    return (
        rows.transform(lambda df: left_join(df, items, "wwi_stock_item_id", "_item", ["wwi_purchase_order_id"]))
        .transform(lambda df: left_join(df, _packages(package_types), "packagetypeid", "_package", ["wwi_purchase_order_id"]))
        .select(
            *rows.columns,
            (F.col("orderedouters") * with_default(F.col("_per_outer"), 1)).alias("ordered_quantity"),
            with_default(F.col("_package_name"), "Unknown").alias("package"),
        )
    )


def stage_purchase(
    purchase_orders: DataFrame, purchase_order_lines: DataFrame, stock_items: DataFrame, package_types: DataFrame
) -> DataFrame:
    """One row per purchase order line."""
    rows = joined_purchase(purchase_orders, purchase_order_lines)
    return finished_purchase(rows, stock_items, package_types).select(
        "date_key",
        "wwi_supplier_id",
        "wwi_stock_item_id",
        "wwi_purchase_order_id",
        "orderedouters",
        "ordered_quantity",
        "receivedouters",
        "package",
        "is_order_finalized",
        "last_modified_when",
    )


def joined_sale(
    invoices: DataFrame,
    invoice_lines: DataFrame,
    customers: DataFrame,
    stock_items: DataFrame,
    package_types: DataFrame,
) -> DataFrame:
    """One row per invoice line, before its totals are found. Lines of an invoice without a known customer drop out."""
    headers = invoices.select(
        F.col("invoiceid").alias("wwi_invoice_id"),
        strict_date(F.col("invoicedate")).alias("invoice_date_key"),
        strict_date(F.col("confirmeddeliverytime")).alias("delivery_date_key"),
        F.col("customerid").alias("wwi_customer_id"),
        F.col("billtocustomerid").alias("wwi_bill_to_customer_id"),
        F.col("salespersonpersonid").alias("wwi_salesperson_id"),
        F.col("lasteditedwhen").alias("_header_edited"),
    ).join(_delivery_city(customers), F.col("wwi_customer_id") == F.col("_customer"))
    lines = invoice_lines.withColumnsRenamed(
        {"invoiceid": "_invoice", "stockitemid": "wwi_stock_item_id", "lasteditedwhen": "_line_edited"}
    )
    items = stock_items.select(
        F.col("stockitemid").alias("_item"), flag(F.col("ischillerstock")).alias("_chiller")
    )
    return (
        lines.join(headers, F.col("_invoice") == F.col("wwi_invoice_id"))
        .transform(lambda df: left_join(df, items, "wwi_stock_item_id", "_item", ["_invoice"]))
        .transform(lambda df: left_join(df, _packages(package_types), "packagetypeid", "_package", ["_invoice"]))
        .select(
            "invoice_date_key",
            "delivery_date_key",
            "wwi_invoice_id",
            "description",
            with_default(F.col("_package_name"), "Unknown").alias("package"),
            "quantity",
            "unitprice",
            "taxrate",
            "taxamount",
            F.col("lineprofit").alias("profit"),
            F.col("extendedprice").alias("total_including_tax"),
            (with_default(F.col("_chiller"), 0) != 0).alias("chilled"),
            "wwi_city_id",
            "wwi_customer_id",
            "wwi_bill_to_customer_id",
            "wwi_stock_item_id",
            "wwi_salesperson_id",
            last_modified(F.col("_line_edited"), F.col("_header_edited")).alias("last_modified_when"),
        )
    )


def finished_sale(rows: DataFrame) -> DataFrame:
    """``joined_sale``, with or without keys, and its totals; as ``finished_order``."""
    return rows.select(
        "*",
        (F.col("total_including_tax") - F.col("taxamount")).alias("total_excluding_tax"),
        F.when(F.col("chilled"), 0).otherwise(F.col("quantity")).alias("total_dry_items"),
        F.when(F.col("chilled"), F.col("quantity")).otherwise(0).alias("total_chiller_items"),
    )


def stage_sale(
    invoices: DataFrame,
    invoice_lines: DataFrame,
    customers: DataFrame,
    stock_items: DataFrame,
    package_types: DataFrame,
) -> DataFrame:
    """One row per invoice line. Lines of an invoice without a known customer drop out."""
    return finished_sale(joined_sale(invoices, invoice_lines, customers, stock_items, package_types)).select(
        "invoice_date_key",
        "delivery_date_key",
        "wwi_invoice_id",
        "description",
        "package",
        "quantity",
        "unitprice",
        "taxrate",
        "total_excluding_tax",
        "taxamount",
        "profit",
        "total_including_tax",
        "total_dry_items",
        "total_chiller_items",
        "wwi_city_id",
        "wwi_customer_id",
        "wwi_bill_to_customer_id",
        "wwi_stock_item_id",
        "wwi_salesperson_id",
        "last_modified_when",
    )


def stage_transaction(customer_transactions: DataFrame, supplier_transactions: DataFrame) -> DataFrame:
    """Customer and supplier transactions in one typed set of columns."""
    common = [
        F.col("transactiontypeid").alias("wwi_transaction_type_id"),
        F.col("amountexcludingtax").alias("total_excluding_tax"),
        F.col("taxamount").alias("tax_amount"),
        with_default(F.col("outstandingbalance"), 0).alias("outstanding_balance"),
        with_default(flag(F.col("isfinalized")), 0).alias("is_finalized"),
        F.col("lasteditedwhen").alias("last_modified_when"),
        strict_date(F.col("transactiondate")).alias("date_key"),
    ]
    ct, st = customer_transactions, supplier_transactions
    from_customers = ct.select(
        *common,
        int_of(ct, "customertransactionid").alias("wwi_customer_transaction_id"),
        typed_null("bigint").alias("wwi_supplier_transaction_id"),
        int_of(ct, "customerid").alias("wwi_customer_id"),
        int_of(ct, "customerid").alias("wwi_bill_to_customer_id"),
        typed_null("bigint").alias("wwi_supplier_id"),
        int_of(ct, "paymentmethodid").alias("wwi_payment_method_id"),
        int_of(ct, "invoiceid").alias("wwi_invoice_id"),
        typed_null("bigint").alias("wwi_purchase_order_id"),
        typed_null("string").alias("supplier_invoice_number"),
        F.col("transactionamount").alias("total_including_tax"),
    )
    from_suppliers = st.select(
        *common,
        typed_null("bigint").alias("wwi_customer_transaction_id"),
        F.col("suppliertransactionid").alias("wwi_supplier_transaction_id"),
        typed_null("bigint").alias("wwi_customer_id"),
        typed_null("bigint").alias("wwi_bill_to_customer_id"),
        int_of(st, "supplierid").alias("wwi_supplier_id"),
        int_of(st, "paymentmethodid").alias("wwi_payment_method_id"),
        typed_null("bigint").alias("wwi_invoice_id"),
        int_of(st, "purchaseorderid").alias("wwi_purchase_order_id"),
        F.col("supplierinvoicenumber").alias("supplier_invoice_number"),
        with_default(F.col("transactionamount"), F.col("amountexcludingtax") + F.col("taxamount")).alias(
            "total_including_tax"
        ),
    )
    return from_customers.unionByName(from_suppliers).select(
        "date_key",
        "wwi_customer_transaction_id",
        "wwi_supplier_transaction_id",
        "wwi_customer_id",
        "wwi_bill_to_customer_id",
        "wwi_supplier_id",
        "wwi_transaction_type_id",
        "wwi_payment_method_id",
        "wwi_invoice_id",
        "wwi_purchase_order_id",
        "supplier_invoice_number",
        "total_excluding_tax",
        "tax_amount",
        "total_including_tax",
        "outstanding_balance",
        "is_finalized",
        "last_modified_when",
    )
