import datetime as dt
import decimal

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimspark.functions import ts_literal
from dimspark.plans import dimensions, enrichment, facts, staging
from dimspark.plans.warehouse import build_warehouse
from dimspark.sources import SOURCE_SCHEMAS, layer_path, source_schema, write_table


def test_purchase_fact_resolves_supplier_and_stock_item(spark, ts):
    staged = spark.createDataFrame(
        [(dt.date(2024, 6, 1), 1, 1, 1, 10, 100, 0, "Box", True, ts("2024-06-01 12:00:00"))],
        "date_key date, wwi_supplier_id bigint, wwi_stock_item_id bigint, wwi_purchase_order_id bigint, "
        "orderedouters int, ordered_quantity int, receivedouters int, package string, is_order_finalized boolean, "
        "last_modified_when timestamp_ntz",
    )
    period = (ts("2020-01-01"), ts("9999-12-31 23:59:59"))
    dims = {
        name: spark.createDataFrame(
            [(1, 1, *period)],
            f"{name}_key bigint, wwi_{name}_id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz",
        )
        for name in ("supplier", "stock_item")
    }
    expected = spark.createDataFrame(
        [(dt.date(2024, 6, 1), 1, 1, 1, 10, 100, 0, "Box", True)],
        "date_key date, supplier_key bigint, stock_item_key bigint, wwi_purchase_order_id bigint, ordered_outers int, "
        "ordered_quantity int, received_outers int, package string, is_order_finalized boolean",
    )
    assertDataFrameEqual(facts.fct_purchase(staged, dims), expected)


def source(spark, name, *dicts):
    """A source table from partial rows; missing columns are NULL."""
    schema = source_schema(name)
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], schema)


def test_decimal_amounts_keep_nine_digits(spark):
    dec = decimal.Decimal
    lines = source(
        spark,
        "OrderLines",
        {"orderlineid": 1, "orderid": 1, "quantity": 3, "unitprice": dec("0.37"), "taxrate": dec("14.375"), "packagetypeid": 9},
        {"orderlineid": 2, "orderid": 1, "quantity": None, "unitprice": dec("0.37"), "taxrate": dec("14.375")},
        {"orderlineid": 3, "orderid": 2, "quantity": 1, "unitprice": dec("1.00"), "taxrate": dec("1.000")},
    )
    orders = source(spark, "Orders", {"orderid": 1, "customerid": 1}, {"orderid": 2, "customerid": 404})
    customers = source(spark, "Customers", {"customerid": "1", "deliverycityid": 5})
    staged = staging.stage_order(orders, lines, customers, source(spark, "PackageTypes"))
    # The line of the unknown customer drops out.
    first, second = staged.orderBy("wwi_backorder_id").collect()
    assert first["total_excluding_tax"] == dec("1.11")
    assert first["tax_amount"] == dec("0.159562500") and first["total_including_tax"] == dec("1.269562500")
    assert first["wwi_city_id"] == 5 and first["package"] == "Unknown"
    assert second["tax_amount"] is None


def test_purchase_defaults(spark, ts):
    orders = source(
        spark, "PurchaseOrders", {"purchaseorderid": 1, "orderdate": dt.date(2024, 1, 1), "lasteditedwhen": ts(3)}
    )
    lines = source(
        spark,
        "PurchaseOrderLines",
        {"purchaseorderid": 1, "stockitemid": 1, "orderedouters": 4, "packagetypeid": 1},
        {"purchaseorderid": 1, "stockitemid": 2, "orderedouters": 5, "lasteditedwhen": ts(9)},
    )
    items = source(spark, "StockItems", {"stockitemid": 1, "quantityperouter": 6})
    packages = source(spark, "PackageTypes", {"packagetypeid": 1, "packagetypename": "Box"})
    one, two = staging.stage_purchase(orders, lines, items, packages).orderBy("wwi_stock_item_id").collect()
    assert (one["ordered_quantity"], one["package"], one["last_modified_when"]) == (24, "Box", ts(3))
    assert (two["ordered_quantity"], two["package"], two["last_modified_when"]) == (5, "Unknown", ts(9))


def test_chiller_split(spark):
    invoices = source(spark, "Invoices", {"invoiceid": 1, "customerid": 1})
    lines = source(spark, "InvoiceLines", *({"invoiceid": 1, "stockitemid": n, "quantity": 7} for n in (1, 2, 3, 4)))
    items = source(
        spark,
        "StockItems",
        {"stockitemid": 1, "ischillerstock": 1},
        {"stockitemid": 2, "ischillerstock": 0},
        {"stockitemid": 3, "ischillerstock": None},
    )
    customers = source(spark, "Customers", {"customerid": "1"})
    args = (invoices, lines, customers, items, source(spark, "PackageTypes"))
    booleans = items.withColumn("ischillerstock", F.col("ischillerstock").cast("boolean"))
    for stock in (items, booleans):
        staged = staging.stage_sale(*args[:3], stock, args[4]).orderBy("wwi_stock_item_id")
        split = [(r["total_dry_items"], r["total_chiller_items"]) for r in staged.collect()]
        assert split == [(0, 7), (7, 0), (7, 0), (7, 0)]


def test_transaction_halves(spark):
    dec = decimal.Decimal
    ct = source(spark, "CustomerTransactions", {"customertransactionid": "1", "customerid": "x", "isfinalized": 1})
    st = source(
        spark,
        "SupplierTransactions",
        {"suppliertransactionid": 2, "supplierid": "3", "amountexcludingtax": dec("10.00"), "taxamount": dec("1.50")},
    )
    staged = staging.stage_transaction(ct, st)
    customer = staged.where("wwi_customer_transaction_id = 1").first()
    supplier = staged.where("wwi_supplier_transaction_id = 2").first()
    assert (customer["wwi_customer_id"], customer["total_including_tax"], customer["is_finalized"]) == (None, None, 1)
    assert (supplier["wwi_supplier_id"], supplier["total_including_tax"]) == (3, dec("11.50"))
    assert (supplier["outstanding_balance"], supplier["is_finalized"]) == (0, 0)


def test_customer_enrichment_defaults(spark):
    customers = source(
        spark,
        "Customers",
        {"customerid": "1", "customername": "A", "billtocustomerid": "2", "customercategoryid": "1", "validfrom": "2020-06-01 00:00:00.0000000"},
        {"customerid": "2", "customername": "B", "validfrom": "2020-01-01 00:00:00.0000000", "primarycontactpersonid": "9"},
    )
    categories = source(
        spark,
        "CustomerCategories",
        {"customercategoryid": "1", "customercategoryname": "old", "validfrom": "2019-01-01", "validto": "2020-06-01"},
        {"customercategoryid": "1", "customercategoryname": "new", "validfrom": "2020-06-01"},
    )
    people = source(spark, "People", {"personid": 9, "fullname": "P"}, {"personid": 9, "fullname": "Q"})
    found = enrichment.enrich_customer(
        staging.stage_customer(customers), categories, source(spark, "BuyingGroups"), people, customers
    )
    names = {tuple(r) for r in found.select("customer", "bill_to_customer", "category", "buying_group", "primary_contact").collect()}
    # A contact with two rows multiplies the customer.
    assert names == {("A", "B", "new", "None", ""), ("B", "B", "Unknown", "None", "P"), ("B", "B", "Unknown", "None", "Q")}


def test_holdings_use_the_given_or_current_time(spark, ts):
    staged = staging.stage_stock_holding(source(spark, "StockItemHoldings", {"stockitemid": 1, "quantityonhand": 3}))
    dim = spark.createDataFrame(
        [(1, 1, ts("2000-01-01"), ts("2010-01-01")), (2, 1, ts("2010-01-01"), ts("9999-12-31"))],
        "stock_item_key bigint, wwi_stock_item_id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    dims = {"stock_item": dim}
    assert facts.fct_stock_holding(staged, dims, ts_literal("2005-01-01")).first()["stock_item_key"] == 1
    now = facts.fct_stock_holding(staged, dims).first()
    assert (now["stock_item_key"], now["bin_location"]) == (2, "")


def test_date_dimension(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 18 * 365 + 4
    row = days.where("date_key = date'2024-06-01'").first().asDict()
    assert row == {
        "date_key": dt.date(2024, 6, 1), "year": 2024, "quarter": 2, "month": 6, "day": 1, "day_of_week": 6,
        "week_of_year": 22, "month_name": "June", "is_weekend": True,
    }


def test_whole_warehouse(spark, tmp_path, ts):
    """All models from (mostly empty) sources, written by layer."""
    start = "2020-01-01 00:00:00.0000000"
    filled = {
        "Cities": {"cityid": 5, "cityname": "C", "stateprovinceid": 1, "validfrom": start},
        "StateProvinces": {"stateprovinceid": 1, "countryid": 1, "validfrom": start},
        "Countries": {"countryid": 1, "validfrom": start},
        "Customers": {"customerid": "1", "customername": "A", "deliverycityid": 5, "validfrom": start},
        "Orders": {"orderid": 1, "customerid": 1, "lasteditedwhen": ts(100)},
        "OrderLines": {"orderid": 1, "orderlineid": 1, "stockitemid": 1},
    }
    src = {name: source(spark, name, *([filled[name]] if name in filled else [])) for name in SOURCE_SCHEMAS}
    cfg = {"root": str(tmp_path), "default": "main", "dim": "dimensions", "fct": "facts"}
    tables = build_warehouse(src, lambda name, df: write_table(df, layer_path(cfg, name[:3], name)), ts_literal("2024-01-01"))
    assert len(tables) == 13 and len(list((tmp_path / "dimensions").iterdir())) == 7
    order = tables["fct_order"].first()
    assert (order["city_key"], order["customer_key"], order["stock_item_key"]) == (1, 1, 0)
    assert tables["fct_sale"].count() == 0
