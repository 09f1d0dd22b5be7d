"""The results of the queries in SQL for DuckDB, written independently of the Spark code.

Models are named subqueries; a query takes those it needs. Key lookups have the
row-number-and-rejoin shape, which makes no assumption about the periods.
"""

from __future__ import annotations

import re

_END = "TIMESTAMP '9999-12-31 23:59:59.999999'"


def _ts(column: str) -> str:
    return f"TRY_CAST(substr(CAST({column} AS VARCHAR), 1, 26) AS TIMESTAMP)"


def _int(column: str) -> str:
    return f"TRY_CAST({column} AS BIGINT)"


def _ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') || '.0000000'"


def _first(order: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in order)


def _close(source: str, key: str, columns: list[str], ties: list[str] | None = None) -> str:
    order = _first(["valid_from", *(columns if ties is None else ties)])
    return (
        f"SELECT {', '.join([key, *columns, 'valid_from'])}, "
        f"COALESCE(lead(valid_from) OVER (PARTITION BY {key} ORDER BY {order}), {_END}) AS valid_to FROM {source}"
    )


def _number(closed: str, key: str, key_name: str, columns: list[str], ties: list[str] | None = None) -> str:
    # Of versions that are equal in every column, the one with the empty period comes
    # first; without the end in the order their numbers would be left to chance.
    order = _first([key, "valid_from", *(columns if ties is None else ties), "valid_to"])
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key_name}, "
        f"{', '.join([key, *columns, 'valid_from', 'valid_to'])} FROM {closed}"
    )


def _two_periods(table: str) -> str:
    return (
        f"(SELECT *, 1 AS n, '1990-01-01 00:00:00.0000000' AS validfrom, '1998-01-01 00:00:00.0000000' AS validto "
        f"FROM {table} UNION ALL SELECT *, 2, '1998-01-01 00:00:00.0000000', NULL FROM {table})"
    )


_STATUS_ID = "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS BIGINT)"

_CITY = [
    "city", "state_province", "country", "continent", "sales_territory", "region", "subregion", "location",
    "latest_recorded_population",
]
_CUSTOMER = ["customer", "bill_to_customer", "category", "buying_group", "primary_contact", "postal_code"]
_SUPPLIER = ["supplier", "category", "primary_contact", "supplier_reference", "payment_days", "postal_code"]
_EMPLOYEE = ["employee", "preferred_name"]
_STOCK_ITEM = [
    "stock_item", "brand", "size", "lead_time_days", "quantity_per_outer", "is_chiller_stock", "tax_rate", "unit_price",
    "typical_weight_per_unit",
]

_MODELS: dict[str, str] = {
    # Sources
    "state_provinces": f"""SELECT CAST(n_nationkey AS BIGINT) AS stateprovinceid, n_name || ' v' || n AS stateprovincename,
        CAST(n_regionkey AS BIGINT) AS countryid, 'Territory ' || n_regionkey AS salesterritory,
        {_ts("validfrom")} AS s_from, {_ts("validto")} AS s_to FROM {_two_periods("nation")}""",
    "countries": f"""SELECT CAST(r_regionkey AS BIGINT) AS countryid, r_name || ' v' || n AS countryname,
        r_name AS continent, r_name AS region, 'Sub ' || r_name AS subregion,
        {_ts("validfrom")} AS c_from, {_ts("validto")} AS c_to FROM {_two_periods("region")}""",
    "customer_categories": f"""SELECT CAST(r_regionkey AS BIGINT) AS id, r_name || ' c' || n AS name,
        {_ts("validfrom")} AS p_from, {_ts("validto")} AS p_to FROM {_two_periods("region")}""",
    "supplier_categories": f"""SELECT CAST(r_regionkey AS BIGINT) AS id, r_name || ' s' || n AS name,
        {_ts("validfrom")} AS p_from, {_ts("validto")} AS p_to FROM {_two_periods("region")}""",
    "buying_groups": f"""SELECT CAST(n_nationkey AS BIGINT) AS id, n_name || ' g' || n AS name,
        {_ts("validfrom")} AS p_from, {_ts("validto")} AS p_to FROM {_two_periods("nation")}""",
    "package_types": "SELECT CAST(n_nationkey AS BIGINT) AS packagetypeid, 'Pack ' || n_name AS packagetypename FROM nation",
    "people": """SELECT s_suppkey AS personid, s_name AS fullname, substr(s_name, 10, 9) AS preferredname,
        TIMESTAMP '1995-06-01 00:00:00' + to_days(s_nationkey * 30) AS validfrom FROM supplier""",
    "stock_items": """SELECT p_partkey AS stockitemid, CASE WHEN p_type <> 'PROMO' THEN p_size END AS quantityperouter,
        CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 1 ELSE 0 END AS ischillerstock FROM part""",
    # Staging
    "stg_city": f"""SELECT o_custkey AS wwi_city_id, 'City ' || o_custkey || ' ' || o_orderpriority AS city,
        o_custkey % 26 AS state_province_id, o_orderstatus AS location,
        COALESCE(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END, 0) AS latest_recorded_population,
        {_ts(_ts_text("o_orderdate"))} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM orders""",
    "stg_customer": f"""SELECT o_custkey AS wwi_customer_id, 'Customer ' || o_custkey AS customer,
        o_custkey // 10 AS bill_to_customer_id, {_int("substr(o_orderpriority, 1, 1)")} AS customer_category_id,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 25 END AS buying_group_id,
        o_custkey // 12 AS primary_contact_personid, o_orderpriority AS postal_code,
        o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
        FROM orders""",
    "customer_names": """SELECT o_custkey AS id, 'Customer ' || o_custkey AS name, o_orderdate AS p_from,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p_to FROM orders""",
    "stg_employee": """SELECT user_id AS wwi_employee_id, 'User ' || user_id AS employee, event_type AS preferredname,
        1 AS issalesperson, ts AS validfrom, CAST(NULL AS TIMESTAMP) AS validto FROM events""",
    "stg_payment_method": """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS wwi_payment_method_id,
        o_orderpriority || ' ' || year(o_orderdate) AS payment_method, min(o_orderdate) AS validfrom,
        CAST(NULL AS TIMESTAMP) AS validto FROM orders GROUP BY o_orderpriority, year(o_orderdate)""",
    "stg_transaction_type": f"""SELECT {_STATUS_ID} AS wwi_transaction_type_id,
        o_orderstatus || ' ' || year(o_orderdate) AS transaction_type, min(o_orderdate) AS validfrom,
        CAST(NULL AS TIMESTAMP) AS validto FROM orders GROUP BY o_orderstatus, year(o_orderdate)""",
    "stg_stock_item": """SELECT l_partkey AS wwi_stock_item_id, any_value(p_name) AS stock_item,
        CAST(any_value(p_size) // 10 AS BIGINT) AS wwi_color_id, CAST(1 AS BIGINT) AS wwi_unit_package_id,
        CAST(2 AS BIGINT) AS wwi_outer_package_id, any_value(p_brand) AS brand, CAST(any_value(p_size) AS VARCHAR) AS size,
        any_value(p_size) AS leadtimedays,
        any_value(CASE WHEN p_type <> 'PROMO' THEN p_size END) AS quantityperouter,
        any_value(CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 1 ELSE 0 END) AS ischillerstock,
        any_value(p_type) AS barcode, CAST(15.0 AS DOUBLE) AS taxrate, max(l_extendedprice / l_quantity) AS unitprice,
        any_value(p_retailprice) AS recommendedretailprice, CAST(0.5 AS DOUBLE) AS typicalweightperunit,
        min(l_shipdate) AS validfrom, CAST(NULL AS TIMESTAMP) AS validto
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, year(l_shipdate)""",
    "stg_supplier": """SELECT l_suppkey AS wwi_supplier_id, any_value(s_name) AS supplier,
        CAST(any_value(s_nationkey) % 6 AS BIGINT) AS suppliercategoryid, l_suppkey * 2 AS primarycontactpersonid,
        'Ref ' || year(l_shipdate) AS supplier_reference, any_value(s_nationkey) AS payment_days,
        CAST(any_value(s_nationkey) AS VARCHAR) AS postal_code, min(l_shipdate) AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, year(l_shipdate)""",
    "stg_movement": """SELECT event_id AS wwi_stock_item_transaction_id, CAST(ts AS DATE) AS date_key,
        event_id // 5 AS wwi_stock_item_id,
        CASE WHEN event_type IN ('purchase', 'view') THEN user_id END AS wwi_customer_id,
        CASE WHEN event_type = 'click' THEN user_id END AS wwi_supplier_id,
        CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END
            AS BIGINT) AS wwi_transaction_type_id,
        CASE WHEN event_type = 'purchase' THEN event_id END AS wwi_invoice_id,
        CASE WHEN event_type = 'click' THEN event_id END AS wwi_purchase_order_id,
        CASE WHEN event_type = 'purchase' THEN -value ELSE value END AS quantity, ts AS last_modified_when FROM events""",
    "stg_order": """SELECT o_orderkey AS wwi_order_id, l_orderkey * 10 + l_linenumber AS wwi_backorder_id,
        c_custkey AS wwi_city_id, o_custkey AS wwi_customer_id, l_partkey AS wwi_stock_item_id,
        CAST(o_orderdate AS DATE) AS order_date_key,
        CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate AS DATE) END AS picked_date_key,
        o_custkey // 12 AS wwi_salesperson_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS wwi_picker_id,
        l_returnflag || '/' || l_linestatus AS description, COALESCE(packagetypename, 'Unknown') AS package,
        l_quantity AS quantity, l_extendedprice / l_quantity AS unitprice, l_tax * 100 AS taxrate,
        l_quantity * (l_extendedprice / l_quantity) AS total_excluding_tax,
        (l_quantity * (l_extendedprice / l_quantity)) * (l_tax * 100) / 100 AS tax_amount,
        (l_quantity * (l_extendedprice / l_quantity)) * (1 + (l_tax * 100) / 100) AS total_including_tax,
        greatest(CASE WHEN l_returnflag <> 'R' THEN l_shipdate END, o_orderdate) AS last_modified_when
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        LEFT JOIN package_types ON packagetypeid = CAST(l_quantity AS BIGINT)""",
    "stg_purchase": """SELECT CAST(o_orderdate AS DATE) AS date_key, o_custkey // 15 AS wwi_supplier_id,
        l_partkey AS wwi_stock_item_id, o_orderkey AS wwi_purchase_order_id,
        CAST(l_quantity AS BIGINT) AS orderedouters,
        CAST(l_quantity AS BIGINT) * COALESCE(quantityperouter, 1) AS ordered_quantity,
        CAST(l_quantity AS BIGINT) - l_linenumber AS receivedouters, COALESCE(packagetypename, 'Unknown') AS package,
        l_linestatus = 'F' AS is_order_finalized, greatest(l_shipdate, o_orderdate) AS last_modified_when
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN stock_items ON stockitemid = l_partkey
        LEFT JOIN package_types ON packagetypeid = CAST(l_quantity AS BIGINT)""",
    "stg_sale": """SELECT CAST(o_orderdate AS DATE) AS invoice_date_key,
        CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS delivery_date_key, o_orderkey AS wwi_invoice_id,
        l_returnflag || '/' || l_linestatus AS description, COALESCE(packagetypename, 'Unknown') AS package,
        l_quantity AS quantity, l_extendedprice / l_quantity AS unitprice, l_tax * 100 AS taxrate,
        l_extendedprice - l_extendedprice * l_tax AS total_excluding_tax, l_extendedprice * l_tax AS taxamount,
        l_extendedprice * l_discount AS profit, l_extendedprice AS total_including_tax,
        CASE WHEN COALESCE(ischillerstock, 0) = 0 THEN l_quantity ELSE 0 END AS total_dry_items,
        CASE WHEN COALESCE(ischillerstock, 0) <> 0 THEN l_quantity ELSE 0 END AS total_chiller_items,
        c_custkey AS wwi_city_id, o_custkey AS wwi_customer_id, o_custkey // 10 AS wwi_bill_to_customer_id,
        l_partkey AS wwi_stock_item_id, o_custkey // 12 AS wwi_salesperson_id,
        CASE WHEN l_returnflag <> 'R' AND o_orderstatus <> 'P' THEN greatest(l_shipdate, o_orderdate)
             WHEN l_returnflag <> 'R' THEN l_shipdate WHEN o_orderstatus <> 'P' THEN o_orderdate END AS last_modified_when
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        LEFT JOIN stock_items ON stockitemid = l_partkey
        LEFT JOIN package_types ON packagetypeid = CAST(l_quantity AS BIGINT)""",
    "stg_stock_holding": """SELECT p_partkey AS wwi_stock_item_id, p_size AS quantity_on_hand,
        CASE WHEN p_type <> 'PROMO' THEN p_brand END AS binlocation, p_size * 2 AS last_stocktake_quantity,
        p_retailprice AS last_cost_price, p_size + 5 AS reorderlevel, p_size + 100 AS target_stock_level FROM part""",
    "stg_transaction": f"""SELECT CAST(o_orderdate AS DATE) AS date_key, o_orderkey AS wwi_customer_transaction_id,
        CAST(NULL AS BIGINT) AS wwi_supplier_transaction_id, o_custkey AS wwi_customer_id,
        o_custkey AS wwi_bill_to_customer_id, CAST(NULL AS BIGINT) AS wwi_supplier_id,
        {_STATUS_ID} AS wwi_transaction_type_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS wwi_payment_method_id,
        o_orderkey AS wwi_invoice_id, CAST(NULL AS BIGINT) AS wwi_purchase_order_id,
        CAST(NULL AS VARCHAR) AS supplier_invoice_number, o_totalprice AS total_excluding_tax,
        o_totalprice * CAST(0.1 AS DOUBLE) AS tax_amount, o_totalprice * CAST(1.1 AS DOUBLE) AS total_including_tax,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END AS outstanding_balance,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finalized,
        o_orderdate + INTERVAL 1 DAY AS last_modified_when FROM orders
        UNION ALL
        SELECT CAST(l_shipdate AS DATE), NULL, l_orderkey * 10 + l_linenumber, NULL, NULL, l_suppkey,
        CAST(l_linenumber AS BIGINT), CAST(l_linenumber AS BIGINT), NULL, l_orderkey, l_returnflag || '-' || l_orderkey,
        l_extendedprice, l_extendedprice * l_tax,
        CASE WHEN l_returnflag <> 'R' THEN l_extendedprice * (1 + l_tax) ELSE l_extendedprice + l_extendedprice * l_tax END,
        CASE WHEN l_linestatus <> 'F' THEN l_extendedprice ELSE 0 END, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END,
        l_shipdate FROM lineitem""",
    # Enrichment
    "city_versions": """SELECT wwi_city_id, city, stateprovincename AS state_province, countryname AS country, continent,
        salesterritory AS sales_territory, region, subregion, location, latest_recorded_population, valid_from
        FROM stg_city JOIN state_provinces s ON state_province_id = stateprovinceid
            AND s_from <= valid_from AND (s_to IS NULL OR s_to > valid_from)
        JOIN countries c ON s.countryid = c.countryid AND c_from <= valid_from AND (c_to IS NULL OR c_to > valid_from)""",
    "customer_versions": """SELECT wwi_customer_id, customer, COALESCE(b.name, customer) AS bill_to_customer,
        COALESCE(cc.name, 'Unknown') AS category, COALESCE(bg.name, 'None') AS buying_group,
        COALESCE(p.fullname, '') AS primary_contact, postal_code, valid_from FROM stg_customer
        LEFT JOIN customer_categories cc ON customer_category_id = cc.id
            AND cc.p_from <= valid_from AND (cc.p_to IS NULL OR cc.p_to > valid_from)
        LEFT JOIN buying_groups bg ON buying_group_id = bg.id
            AND bg.p_from <= valid_from AND (bg.p_to IS NULL OR bg.p_to > valid_from)
        LEFT JOIN people p ON primary_contact_personid = p.personid
        LEFT JOIN customer_names b ON bill_to_customer_id = b.id
            AND b.p_from <= valid_from AND (b.p_to IS NULL OR b.p_to > valid_from)""",
    "supplier_versions": """SELECT wwi_supplier_id, supplier, COALESCE(sc.name, 'Unknown') AS category,
        COALESCE(p.fullname, '') AS primary_contact, supplier_reference, payment_days, postal_code, valid_from
        FROM stg_supplier LEFT JOIN supplier_categories sc ON suppliercategoryid = sc.id
            AND sc.p_from <= valid_from AND (sc.p_to IS NULL OR sc.p_to > valid_from)
        LEFT JOIN people p ON primarycontactpersonid = p.personid""",
    "int_city": _close("city_versions", "wwi_city_id", _CITY),
    "int_customer": _close("customer_versions", "wwi_customer_id", _CUSTOMER),
    "int_supplier": _close("supplier_versions", "wwi_supplier_id", _SUPPLIER),
    # Dimensions
    "dim_city": _number("int_city", "wwi_city_id", "city_key", _CITY),
    "dim_customer": _number("int_customer", "wwi_customer_id", "customer_key", _CUSTOMER),
    "dim_supplier": _number("int_supplier", "wwi_supplier_id", "supplier_key", _SUPPLIER),
    "employee_versions": """SELECT o_custkey // 12 AS wwi_employee_id, 'Person ' || o_custkey // 12 AS employee,
        'Year ' || year(o_orderdate) AS preferred_name, min(o_orderdate) AS valid_from FROM orders
        GROUP BY o_custkey // 12, year(o_orderdate)""",
    "int_employee": _close("employee_versions", "wwi_employee_id", _EMPLOYEE),
    "dim_employee": _number("int_employee", "wwi_employee_id", "employee_key", _EMPLOYEE),
    "user_versions": """SELECT wwi_employee_id, employee, preferredname AS preferred_name, validfrom AS valid_from
        FROM stg_employee""",
    "int_user": _close("user_versions", "wwi_employee_id", _EMPLOYEE),
    "dim_user": _number("int_user", "wwi_employee_id", "employee_key", _EMPLOYEE),
    "payment_versions": "SELECT wwi_payment_method_id, payment_method, validfrom AS valid_from FROM stg_payment_method",
    "int_payment_method": _close("payment_versions", "wwi_payment_method_id", ["payment_method"]),
    "dim_payment_method": _number(
        "int_payment_method", "wwi_payment_method_id", "payment_method_key", ["payment_method"]
    ),
    "type_versions": "SELECT wwi_transaction_type_id, transaction_type, validfrom AS valid_from FROM stg_transaction_type",
    "int_transaction_type": _close("type_versions", "wwi_transaction_type_id", ["transaction_type"]),
    "dim_transaction_type": _number(
        "int_transaction_type", "wwi_transaction_type_id", "transaction_type_key", ["transaction_type"]
    ),
    "item_versions": """SELECT wwi_stock_item_id, stock_item, brand, size, leadtimedays AS lead_time_days,
        quantityperouter AS quantity_per_outer, ischillerstock AS is_chiller_stock, taxrate AS tax_rate,
        unitprice AS unit_price, typicalweightperunit AS typical_weight_per_unit, validfrom AS valid_from
        FROM stg_stock_item""",
    "int_stock_item": _close("item_versions", "wwi_stock_item_id", _STOCK_ITEM),
    "dim_stock_item": _number("int_stock_item", "wwi_stock_item_id", "stock_item_key", _STOCK_ITEM),
    # Dimensions from the current rows of customers and items, as the whole build has them
    "current_customer_versions": """SELECT c_custkey AS wwi_customer_id, c_name AS customer,
        TIMESTAMP '1996-06-01' AS valid_from FROM customer""",
    "current_customers": _close("current_customer_versions", "wwi_customer_id", ["customer"]),
    "dim_current_customer": _number("current_customers", "wwi_customer_id", "customer_key", ["customer"]),
    "current_employee_versions": "SELECT personid AS wwi_employee_id, fullname AS employee, validfrom AS valid_from FROM people",
    "current_employees": _close("current_employee_versions", "wwi_employee_id", ["employee"]),
    "dim_current_employee": _number("current_employees", "wwi_employee_id", "employee_key", ["employee"]),
    "current_item_versions": "SELECT p_partkey AS wwi_stock_item_id, p_name AS stock_item, TIMESTAMP '1993-01-01' AS valid_from FROM part",
    "current_items": _close("current_item_versions", "wwi_stock_item_id", ["stock_item"]),
    "dim_current_stock_item": _number("current_items", "wwi_stock_item_id", "stock_item_key", ["stock_item"]),
    # Versions for the operator queries
    "order_versions": "SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from FROM orders",
    "closed_orders": _close("order_versions", "o_custkey", ["o_orderkey", "o_orderpriority"], ["o_orderkey"]),
    "dim_order_versions": _number(
        "closed_orders", "o_custkey", "version_key", ["o_orderkey", "o_orderpriority"], ["o_orderkey"]
    ),
    "event_versions": "SELECT CAST(length(event_type) AS BIGINT) AS type_id, event_id, ts AS valid_from FROM events",
    "closed_events": _close("event_versions", "type_id", ["event_id"]),
    "dim_event_versions": _number("closed_events", "type_id", "type_key", ["event_id"]),
    "overlapping_versions": """SELECT o_custkey, o_orderkey AS version_key, o_orderdate AS valid_from,
        o_orderdate + to_days(CAST(o_orderkey % 700 AS INTEGER)) AS valid_to FROM orders""",
    "shipped_lines": """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS customer_id, l_shipdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def _with(select: str) -> str:
    """``select`` preceded by the models it uses, directly or not."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = [m for m in _MODELS if m in words and m not in needed]
        needed.update(new)
        pending += [_MODELS[m] for m in new]
    models = ",\n".join(f"{m} AS ({_MODELS[m]})" for m in _MODELS if m in needed)
    return f"WITH {models}\n{select}" if models else select


def _keyed(staged: str, columns: str, lookups: list[tuple[str, str, str, str, str]], at: str = "last_modified_when") -> str:
    """``columns`` of ``staged`` with a key per (alias, fact id, dimension, dimension id, dimension key)."""
    matches, joins, keys = [], [], []
    for alias, fact_id, dim, dim_id, key in lookups:
        matches.append(
            f"{alias}_match AS (SELECT f.row_id, d.{key} AS found, "
            f"row_number() OVER (PARTITION BY f.row_id ORDER BY d.valid_from DESC NULLS LAST, d.valid_to DESC) AS rn "
            f"FROM facts f LEFT JOIN {dim} d ON d.{dim_id} = f.{fact_id} AND {at} > d.valid_from AND {at} <= d.valid_to)"
        )
        joins.append(f"LEFT JOIN {alias}_match ON {alias}_match.row_id = facts.row_id AND {alias}_match.rn = 1")
        keys.append(f"COALESCE({alias}_match.found, 0) AS {alias}")
    text = (
        f"facts AS (SELECT *, row_number() OVER () AS row_id FROM {staged}), {', '.join(matches)} "
        f"SELECT {', '.join([*keys, columns])} FROM facts {' '.join(joins)}"
    )
    return _with(text).replace("\nfacts AS", ",\nfacts AS", 1)


def _roles(**roles: str) -> list[tuple[str, str, str, str, str]]:
    return [(f"{role}_key", f"wwi_{role}_id", f"dim_{dim}", f"wwi_{dim}_id", f"{dim}_key") for role, dim in roles.items()]


def _dim_city_incremental() -> str:
    loaded = _MODELS["city_versions"]
    columns = ", ".join(["wwi_city_id", *_CITY, "valid_from", "valid_to"])
    order = _first(["wwi_city_id", "valid_from", *_CITY, "valid_to"])
    text = f"""first_versions AS ({loaded} WHERE valid_from <= TIMESTAMP '1998-01-01'),
    first_closed AS ({_close("first_versions", "wwi_city_id", _CITY)}),
    target AS ({_number("first_closed", "wwi_city_id", "city_key", _CITY)})
    SELECT city_key, {columns} FROM target UNION ALL
    SELECT (SELECT max(city_key) FROM target) + row_number() OVER (ORDER BY {order}), {columns} FROM int_city
    WHERE valid_from > (SELECT max(valid_from) FROM target)"""
    return _with(text).replace("\nfirst_versions AS", ",\nfirst_versions AS", 1)


_MODELS["city_loads"] = _dim_city_incremental()


_ORDER_ROLES = _roles(city="city", customer="customer", stock_item="stock_item") + [
    ("salesperson_key", "wwi_salesperson_id", "dim_employee", "wwi_employee_id", "employee_key"),
    ("picker_key", "wwi_picker_id", "dim_employee", "wwi_employee_id", "employee_key"),
]
_SALE_ROLES = _roles(city="city", customer="customer", stock_item="stock_item") + [
    ("bill_to_customer_key", "wwi_bill_to_customer_id", "dim_customer", "wwi_customer_id", "customer_key"),
    ("salesperson_key", "wwi_salesperson_id", "dim_employee", "wwi_employee_id", "employee_key"),
]
_TRANSACTION_ROLES = _roles(
    customer="customer", supplier="supplier", transaction_type="transaction_type", payment_method="payment_method"
) + [("bill_to_customer_key", "wwi_bill_to_customer_id", "dim_customer", "wwi_customer_id", "customer_key")]
_MOVEMENT_ROLES = _roles(stock_item="stock_item", customer="customer", supplier="supplier", transaction_type="transaction_type")
_PURCHASE_ROLES = _roles(supplier="supplier", stock_item="stock_item")


def _build_warehouse() -> str:
    """Rows and key sums of every model, with dimensions from the current rows of customers, items and people."""
    current = ("customer", "employee", "stock_item")
    dims = ("city", "customer", "employee", "payment_method", "stock_item", "supplier", "transaction_type")
    parts = [
        f"SELECT 'dim_{d}' AS model, count(*) AS n, CAST(sum({d}_key) AS BIGINT) AS key_sum "
        f"FROM dim_{'current_' if d in current else ''}{d}"
        for d in dims
    ]
    facts = {
        "order": _ORDER_ROLES,
        "sale": _SALE_ROLES,
        "transaction": _TRANSACTION_ROLES,
        "movement": _MOVEMENT_ROLES,
        "purchase": _PURCHASE_ROLES,
        "stock_holding": _roles(stock_item="stock_item"),
    }
    text = "\nUNION ALL ".join(parts)
    for fact, roles in facts.items():
        roles = [(a, f, d.replace("dim_", "dim_current_") if d[4:] in current else d, i, k) for a, f, d, i, k in roles]
        at = "TIMESTAMP '2000-06-01 12:00:00'" if fact == "stock_holding" else "last_modified_when"
        keys = " + ".join(alias for alias, *_ in roles)
        keyed = _keyed(f"stg_{fact}", "1 AS one", roles, at)
        text += f"\nUNION ALL SELECT 'fct_{fact}', count(*), CAST(sum({keys}) AS BIGINT) FROM ({keyed})"
    return _with(text)


_LOOKUP = _keyed(
    "shipped_lines",
    "l_orderkey, l_linenumber, l_partkey, customer_id, l_shipdate",
    [("customer_key", "customer_id", "dim_order_versions", "o_custkey", "version_key")],
    "l_shipdate",
)

_MERGED = """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 1000 THEN c_acctbal + 100 ELSE c_acctbal END
    AS c_acctbal FROM customer UNION ALL SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier"""


# Columns of two facts that must have a value, beside their keys.
_REQUIRED = {
    "order": ["order_date_key", "picked_date_key", "wwi_order_id", "quantity"],
    "purchase": ["date_key", "wwi_purchase_order_id", "ordered_quantity", "is_order_finalized"],
}


def _checked() -> str:
    """Rows that break a rule: NULLs, and keys of versions that are not current."""
    models, parts = [], []
    for fact, roles in (("order", _ORDER_ROLES), ("purchase", _PURCHASE_ROLES)):
        keyed = _keyed(f"stg_{fact}", ", ".join(_REQUIRED[fact]), roles)
        models.append(f"f_{fact} AS MATERIALIZED ({keyed})")
        rules = [(c, "not_null", f"{c} IS NULL") for c in [*_REQUIRED[fact], *[r[0] for r in roles]]]
        for alias, _, dim, _, key in roles:
            rules.append((alias, "known", f"{alias} <> 0 AND {alias} NOT IN (SELECT {key} FROM {dim} WHERE valid_to = {_END})"))
        for column, rule, broken in rules:
            parts.append(
                f"SELECT '{fact}' AS model, '{column}' AS column_name, '{rule}' AS rule, (SELECT count(*) FROM f_{fact} WHERE {broken}) AS failures, "
                f"(SELECT count(*) FROM f_{fact}) AS rows"
            )
    text = ", ".join(models) + "\n" + " UNION ALL ".join(parts)
    return _with(text).replace("\nf_order AS", ",\nf_order AS", 1)


def _two_loads(first: str) -> str:
    """All order versions, closed; those of the first load are numbered first, then the others."""
    copy = "row_number() OVER (PARTITION BY o_custkey, valid_from ORDER BY o_orderkey) AS copy"
    return _with(
        f"""SELECT CAST(COALESCE(k, (SELECT count(*) FROM order_versions WHERE {first})
            + row_number() OVER (PARTITION BY k IS NULL ORDER BY o_custkey, valid_from, o_orderkey)) AS BIGINT) AS version_key,
        o_custkey, o_orderkey, o_orderpriority, valid_from, valid_to
        FROM (SELECT *, {copy} FROM closed_orders) a LEFT JOIN (
            SELECT o_custkey AS id, valid_from AS since, {copy.replace("copy", "n")},
            row_number() OVER (ORDER BY o_custkey, valid_from, o_orderkey) AS k FROM order_versions WHERE {first}) b
        ON o_custkey = id AND valid_from = since AND copy = n"""
    )


ORACLES: dict[str, str] = {
    "q_stage_rename": "SELECT c_custkey AS wwi_customer_id, c_name AS customer, c_acctbal * 2 AS credit_limit FROM customer",
    "q_stage_safe_int": """SELECT c_custkey, TRY_CAST(substr(c_name, 10, 9) AS BIGINT) AS from_text,
        TRY_CAST(c_mktsegment AS BIGINT) AS from_words, CAST(c_nationkey AS BIGINT) AS from_int,
        CAST(floor(c_acctbal) AS BIGINT) AS from_double FROM customer""",
    "q_stage_timestamp": "SELECT event_id, ts AS parsed, CAST(NULL AS TIMESTAMP) AS junk FROM events",
    "q_stage_parse_date": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_text,
        CAST(o_orderdate AS DATE) AS from_timestamp, CAST(NULL AS DATE) AS junk FROM orders""",
    "q_last_modified": """SELECT l_orderkey, l_linenumber, l_partkey,
        greatest(COALESCE(a, b), COALESCE(b, a)) AS last_modified_when FROM (
        SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS a,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    **{
        f"q_stage_{m}": _with(f"SELECT * FROM stg_{m}")
        for m in (
            "city", "customer", "employee", "payment_method", "stock_item", "supplier", "transaction_type", "movement",
            "order", "purchase", "sale", "stock_holding", "transaction",
        )
    },
    "q_stage_sale_window": _with(
        """SELECT s.* FROM stg_sale s JOIN orders ON wwi_invoice_id = o_orderkey
        WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-06-30'"""
    ),
    "q_pit_inner": _with(
        """SELECT c_custkey, valid_from, stateprovincename AS state_province, countryname AS country FROM (
        SELECT c_custkey, c_nationkey, min(o_orderdate) AS valid_from FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY c_custkey, c_nationkey)
        JOIN state_provinces s ON c_nationkey = stateprovinceid AND s_from <= valid_from
            AND (s_to IS NULL OR s_to > valid_from)
        JOIN countries c ON s.countryid = c.countryid AND c_from <= valid_from AND (c_to IS NULL OR c_to > valid_from)"""
    ),
    "q_pit_left": _with(
        """SELECT o_orderkey, o_orderdate AS valid_from, cc.name AS category, c_name AS bill_to_customer FROM orders
        LEFT JOIN customer_categories cc ON CAST(substr(o_orderpriority, 1, 1) AS BIGINT) = cc.id
            AND cc.p_from <= o_orderdate AND (cc.p_to IS NULL OR cc.p_to > o_orderdate)
        LEFT JOIN customer ON o_custkey // 10 = c_custkey AND TIMESTAMP '1996-06-01' <= o_orderdate"""
    ),
    "q_pit_long_history": _with(
        """SELECT e.event_id, e.user_id % 10 AS wanted, e.ts, d.type_key FROM events e
        LEFT JOIN dim_event_versions d ON d.type_id = e.user_id % 10 AND d.valid_from <= e.ts AND d.valid_to > e.ts"""
    ),
    **{f"q_enrich_{m}": _with(f"SELECT * FROM int_{m}") for m in ("city", "customer", "supplier")},
    "q_scd2_close": _with("SELECT * FROM closed_orders"),
    "q_scd1_latest": _with(
        """SELECT o_custkey, o_orderkey, o_orderpriority, valid_from FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY valid_from DESC, o_orderkey DESC) AS rn FROM order_versions) WHERE rn = 1"""
    ),
    "q_dense_key": _with("SELECT version_key, o_custkey, o_orderkey, o_orderpriority, valid_from FROM dim_order_versions"),
    **{
        f"q_dim_{m}": _with(f"SELECT * FROM dim_{m}")
        for m in ("city", "customer", "payment_method", "stock_item", "supplier", "transaction_type")
    },
    "q_dim_employee": _with("SELECT * FROM dim_user"),
    "q_dim_city_incremental": _dim_city_incremental(),
    "q_dim_date": """SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, monthname(d) AS month_name, isodow(d) > 5 AS is_weekend,
        COALESCE(n, 0) AS orders FROM (SELECT CAST(unnest(generate_series(
            date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
            INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY od) ON od = d""",
    "q_lookup_broadcast": _LOOKUP,
    "q_lookup_union_window": _LOOKUP,
    "q_lookup_ranked": _LOOKUP,
    "q_lookup_long_history": _keyed(
        "(SELECT event_id, user_id % 10 AS wanted, ts FROM events)",
        "event_id, wanted, ts",
        [("type_key", "wanted", "dim_event_versions", "type_id", "type_key")],
        "ts",
    ),
    "q_lookup_overlapping": _keyed(
        "shipped_lines",
        "l_orderkey, l_linenumber, l_partkey, customer_id, l_shipdate",
        [("customer_key", "customer_id", "overlapping_versions", "o_custkey", "version_key")],
        "l_shipdate",
    ).replace("d.valid_to DESC", "d.valid_to DESC, d.version_key DESC"),
    "q_lookup_append_only": _keyed(
        "shipped_lines",
        "l_orderkey, l_linenumber, l_partkey, customer_id, l_shipdate",
        [("city_key", "customer_id", "city_loads", "wwi_city_id", "city_key")],
        "l_shipdate",
    ),
    "q_fct_order": _keyed(
        "stg_order",
        "order_date_key, picked_date_key, wwi_order_id, wwi_backorder_id, description, package, quantity, "
        "unitprice AS unit_price, taxrate AS tax_rate, total_excluding_tax, tax_amount, total_including_tax",
        _ORDER_ROLES,
    ),
    "q_fct_sale": _keyed(
        "stg_sale",
        "invoice_date_key, delivery_date_key, wwi_invoice_id, description, package, quantity, unitprice AS unit_price, "
        "taxrate AS tax_rate, total_excluding_tax, taxamount AS tax_amount, profit, total_including_tax, "
        "total_dry_items, total_chiller_items",
        _SALE_ROLES,
    ),
    "q_fct_transaction": _keyed(
        "stg_transaction",
        "date_key, wwi_customer_transaction_id, wwi_supplier_transaction_id, wwi_invoice_id, wwi_purchase_order_id, "
        "supplier_invoice_number, total_excluding_tax, tax_amount, total_including_tax, outstanding_balance, is_finalized",
        _TRANSACTION_ROLES,
    ),
    "q_fct_movement": _keyed(
        "stg_movement",
        "date_key, wwi_stock_item_transaction_id, wwi_invoice_id, wwi_purchase_order_id, quantity",
        _MOVEMENT_ROLES,
    ),
    "q_fct_purchase": _keyed(
        "stg_purchase",
        "date_key, wwi_purchase_order_id, orderedouters AS ordered_outers, ordered_quantity, "
        "receivedouters AS received_outers, package, is_order_finalized",
        _PURCHASE_ROLES,
    ),
    "q_fct_stock_holding": _keyed(
        "stg_stock_holding",
        "quantity_on_hand, COALESCE(binlocation, '') AS bin_location, last_stocktake_quantity, last_cost_price, "
        "reorderlevel AS reorder_level, target_stock_level",
        _roles(stock_item="stock_item"),
        "TIMESTAMP '2000-06-01 12:00:00'",
    ),
    "q_fct_stock_holding_now": _keyed(
        "(SELECT * REPLACE (wwi_stock_item_id % 10 AS wwi_stock_item_id) FROM stg_stock_holding)",
        "quantity_on_hand, COALESCE(binlocation, '') AS bin_location, last_stocktake_quantity, last_cost_price, "
        "reorderlevel AS reorder_level, target_stock_level",
        [("stock_item_key", "wwi_stock_item_id", "dim_event_versions", "type_id", "type_key")],
        "TIMESTAMP '2200-01-01'",
    ),
    "q_stage_order_decimal": """SELECT orderlineid, CAST(CAST(quantity * unitprice AS DECIMAL(38,12)) AS VARCHAR) AS net,
        CAST(CAST(quantity * unitprice AS DECIMAL(28,4)) * CAST(taxrate / 100 AS DECIMAL(10,8)) AS VARCHAR) AS tax,
        CAST(CAST(quantity * unitprice AS DECIMAL(38,12))
            + CAST(quantity * unitprice AS DECIMAL(28,4)) * CAST(taxrate / 100 AS DECIMAL(10,8)) AS VARCHAR) AS gross,
        (quantity::DOUBLE / 4) * unitprice::DOUBLE AS f_net,
        (quantity::DOUBLE / 4) * unitprice::DOUBLE * taxrate::DOUBLE / 100 AS f_tax,
        (quantity::DOUBLE / 4) * unitprice::DOUBLE * (1 + taxrate::DOUBLE / 100) AS f_gross
        FROM (SELECT l_orderkey * 10 + l_linenumber AS orderlineid, CAST(l_quantity AS INTEGER) AS quantity,
        CAST((l_orderkey * 10 + l_linenumber) % 100000 + 0.1234 AS DECIMAL(18,4)) AS unitprice,
        CAST((l_orderkey * 10 + l_linenumber) % 20 + 0.062525 AS DECIMAL(9,6)) AS taxrate FROM lineitem)""",
    "q_pit_repeated_versions": _with(
        """SELECT e.event_id, e.user_id % 10 AS wanted, e.ts, d.type_key FROM events e
        LEFT JOIN (SELECT * FROM dim_event_versions UNION ALL SELECT * FROM dim_event_versions) d
            ON d.type_id = e.user_id % 10 AND d.valid_from <= e.ts AND d.valid_to > e.ts"""
    ),
    "q_lookup_two_keys": _keyed(
        "shipped_lines",
        "l_orderkey, l_linenumber, l_partkey, customer_id, l_shipdate",
        [
            ("customer_key", "customer_id", "dim_order_versions", "o_custkey", "version_key"),
            ("order_key", "customer_id", "dim_order_versions", "o_custkey", "o_orderkey"),
            ("same_key", "customer_id", "dim_order_versions", "o_custkey", "o_orderkey"),
        ],
        "l_shipdate",
    ),
    "q_read_source": f"""SELECT c.* FROM (SELECT o_custkey AS cityid, 'City ' || o_custkey || ' ' || o_orderpriority AS cityname,
        o_custkey % 26 AS stateprovinceid, o_orderstatus AS location,
        CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END
        AS latestrecordedpopulation, {_ts_text("o_orderdate")} AS validfrom, CAST(NULL AS VARCHAR) AS validto FROM orders) c,
        range(2)""",
    "q_read_seed": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey
        FROM nation""",
    "q_write_table": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_custkey % 2 = 0",
    "q_layer_path": """SELECT 'dimensions/region' AS place, r_name AS name FROM region UNION ALL
        SELECT 'main/nation', n_name FROM nation UNION ALL SELECT 'main/supplier', s_name FROM supplier""",
    "q_build_warehouse": _build_warehouse(),
    "q_incremental_filter": """SELECT * FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders
        WHERE o_orderdate <= TIMESTAMP '2000-01-01')""",
    "q_watermark_max": """SELECT max(o_orderdate) AS last_time, max(o_orderkey) AS last_key,
        TIMESTAMP '1900-01-01' AS last_time_of_none FROM orders""",
    "q_merge_upsert": _MERGED,
    "q_merge_table": _MERGED,
    "q_late_versions": _two_loads("o_orderpriority <> '1-URGENT'"),
    "q_stable_keys": _two_loads("valid_from <= TIMESTAMP '1998-01-01'"),
    "q_scd1_apply": _with(
        """SELECT version_key, o_custkey, o_orderkey, CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < 0 THEN c_mktsegment
        ELSE o_orderpriority END AS o_orderpriority, valid_from, valid_to FROM dim_order_versions
        LEFT JOIN customer ON o_custkey = c_custkey"""
    ),
    "q_load_by_cutoff": "SELECT *, '1998-06-30 00:00:00' AS reached FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30'",
    "q_stage_order_bucketed": _with("SELECT * FROM stg_order"),
    "q_adhoc_by_quarter": _with(
        """SELECT CAST(year(order_date_key) AS INTEGER) AS year, CAST(month(order_date_key) AS INTEGER) AS month, count(*) AS lines,
        count(DISTINCT wwi_order_id) AS orders, max(quantity) AS largest FROM stg_order
        WHERE year(order_date_key) = 1997 AND quarter(order_date_key) = 2 GROUP BY ALL"""
    ),
    "q_adhoc_join": """SELECT o_custkey AS c_custkey, count(*) AS lines, max(l_shipdate) AS last_shipped
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey <= 20 GROUP BY o_custkey""",
    "q_checked_write": _checked(),
    "q_run_log": f"SELECT lineage_key, model, n AS rows, true AS in_order FROM ({_build_warehouse()}), (VALUES (41::BIGINT), (42)) t(lineage_key)",
    "q_not_null": _with("SELECT * FROM stg_order WHERE picked_date_key IS NULL"),
    "q_orphan_keys": f"""SELECT k.* FROM ({_LOOKUP}) k WHERE customer_key <> 0 AND customer_key NOT IN (
        SELECT CAST(n AS BIGINT) FROM (SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS n,
        lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS successor FROM orders)
        WHERE successor IS NULL)""",
    "q_cutoff_window": """SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01'
        AND o_orderdate <= TIMESTAMP '1998-06-30'""",
    "q_update_cutoff": """SELECT table_name, max(cutoff_time) AS cutoff_time FROM (
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE o_orderpriority END AS table_name,
        o_orderdate + INTERVAL 1 DAY AS cutoff_time FROM orders) WHERE table_name <> '5-LOW' GROUP BY table_name
        UNION ALL SELECT '5-LOW', max(o_orderdate) FROM orders WHERE o_orderpriority = '5-LOW'""",
    "q_with_lineage": "SELECT *, CAST(42 AS BIGINT) AS lineage_key FROM orders",
    "q_adhoc_sql": _with(
        """SELECT version_key, o_custkey, o_orderpriority, valid_from FROM dim_order_versions
        WHERE o_orderpriority = '1-URGENT' ORDER BY valid_from DESC, version_key LIMIT 5"""
    ),
}
