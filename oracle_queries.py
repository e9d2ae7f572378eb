"""The same results in SQL over the given tables, for every query SQL can express."""

from __future__ import annotations

BRONZE = """
bronze_sales AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_number,
           CAST(l_linenumber AS VARCHAR) AS line_item,
           strftime(o_orderdate, '%-m/%-d/%Y') AS order_date,
           CASE WHEN l_suppkey <> 0 AND l_returnflag = 'N' THEN ''
                ELSE strftime(l_shipdate, '%-m/%-d/%Y') END AS delivery_date,
           CAST(o_custkey AS VARCHAR) AS customer_key,
           CAST(l_suppkey AS VARCHAR) AS store_key,
           CAST(l_partkey AS VARCHAR) AS product_key,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
           'USD' AS currency_code
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), bronze_products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_key,
           p_name AS product_name,
           p_brand AS brand,
           split_part(p_name, ' ', 1) AS color,
           '$' || format('{:,.2f}', CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DOUBLE)) AS unit_cost_usd,
           '$' || format('{:,.2f}', p_retailprice) AS unit_price_usd,
           CAST(p_size AS VARCHAR) AS subcategory_key,
           'size ' || p_size AS subcategory,
           p_type AS category_key,
           p_type AS category
    FROM part
), bronze_stores AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS store_key,
           CASE WHEN s_suppkey = 0 THEN 'Online' ELSE n_name END AS country,
           CASE WHEN s_suppkey = 0 THEN 'Online' ELSE s_name END AS state,
           '' AS square_meters,
           '1/1/2008' AS open_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

SILVER = (
    BRONZE
    + """, priced AS (
    SELECT CAST(product_key AS INTEGER) AS product_key, product_name, brand,
           subcategory AS product_subcategory, category AS product_category,
           CAST(replace(replace(trim(unit_cost_usd), '$', ''), ',', '') AS DECIMAL(20,6)) AS cost,
           CAST(replace(replace(trim(unit_price_usd), '$', ''), ',', '') AS DECIMAL(20,6)) AS price
    FROM bronze_products
), silver AS (
    SELECT CAST(order_number AS INTEGER) AS order_number,
           CAST(line_item AS INTEGER) AS line_item,
           CAST(strptime(order_date, '%m/%d/%Y') AS DATE) AS order_date,
           CAST(strptime(nullif(trim(delivery_date), ''), '%m/%d/%Y') AS DATE) AS delivery_date,
           CAST(customer_key AS INTEGER) AS customer_key,
           CAST(s.store_key AS INTEGER) AS store_key,
           CAST(s.product_key AS INTEGER) AS product_key,
           CAST(quantity AS INTEGER) AS quantity,
           currency_code, product_name, brand, product_subcategory, product_category,
           CAST(cost AS DECIMAL(12,2)) AS unit_cost_usd,
           CAST(price AS DECIMAL(12,2)) AS unit_price_usd,
           country AS store_country, state AS store_state,
           CASE WHEN CAST(s.store_key AS INTEGER) = 0 THEN 'Online' ELSE 'In Store' END AS sales_channel,
           CAST(CAST(quantity AS INTEGER) * price AS DECIMAL(14,2)) AS gross_sales_usd,
           CAST(CAST(quantity AS INTEGER) * (price - cost) AS DECIMAL(14,2)) AS estimated_gross_profit_usd
    FROM bronze_sales AS s
    LEFT JOIN priced AS p ON CAST(s.product_key AS INTEGER) = p.product_key
    LEFT JOIN bronze_stores AS t ON CAST(s.store_key AS INTEGER) = CAST(t.store_key AS INTEGER)
)"""
)

GOLD = (
    SILVER
    + """, gold AS (
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month, product_category, sales_channel,
           CAST(count(*) AS BIGINT) AS line_item_count,
           CAST(sum(quantity) AS BIGINT) AS units_sold,
           CAST(sum(gross_sales_usd) AS DECIMAL(16,2)) AS gross_sales_usd,
           CAST(sum(estimated_gross_profit_usd) AS DECIMAL(16,2)) AS estimated_gross_profit_usd
    FROM silver GROUP BY ALL
)"""
)

DAMAGED = (
    BRONZE
    + """, damaged_sales AS (
    SELECT order_number, line_item,
           CASE WHEN line_item = '1' AND right(store_key, 1) = '1' THEN ''
                WHEN line_item = '2' AND right(store_key, 1) = '2' THEN 'invalid'
                WHEN line_item = '3' AND right(store_key, 1) = '3' THEN '2024-01-31'
                ELSE order_date END AS order_date,
           CASE WHEN line_item = '4' AND right(store_key, 1) = '4' THEN '13/45/2024'
                ELSE delivery_date END AS delivery_date,
           customer_key, store_key,
           CASE WHEN line_item = '1' AND right(store_key, 1) = '5' THEN 'X' || product_key
                WHEN line_item = '2' AND right(store_key, 1) = '6' THEN '-9' || product_key
                ELSE product_key END AS product_key,
           CASE line_item WHEN '7' THEN '-1' WHEN '6' THEN '1.5' WHEN '5' THEN '2.0' ELSE quantity END AS quantity,
           currency_code
    FROM bronze_sales
), marked_products AS (
    SELECT * REPLACE (
        CASE WHEN subcategory_key = '10' THEN '  ' ELSE category END AS category,
        CASE WHEN subcategory_key = '11' THEN 'n/a' ELSE unit_cost_usd END AS unit_cost_usd,
        CASE WHEN subcategory_key = '12' THEN '' ELSE unit_price_usd END AS unit_price_usd)
    FROM bronze_products
), damaged_products AS (
    SELECT * FROM marked_products
    UNION ALL SELECT * FROM marked_products WHERE subcategory_key = '13'
), damaged_stores AS (
    SELECT * FROM bronze_stores WHERE right(store_key, 1) <> '7'
    UNION ALL SELECT * FROM bronze_stores WHERE right(store_key, 1) = '8'
)"""
)

FORECAST = (
    SILVER
    + """, bounds AS (
    SELECT latest,
           CAST(date_trunc('month', CASE WHEN latest = last_day(latest) THEN latest
                                         ELSE latest - INTERVAL 1 MONTH END) AS DATE) AS last_month
    FROM (SELECT max(order_date) AS latest FROM silver)
), monthly AS (
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS sales_month, product_category, sales_channel,
           CAST(sum(gross_sales_usd) AS DOUBLE) AS gross_sales_usd
    FROM silver, bounds WHERE order_date < last_month + INTERVAL 1 MONTH GROUP BY ALL
), months AS (
    SELECT CAST(unnest(generate_series((SELECT min(sales_month) FROM monthly), last_month, INTERVAL 1 MONTH)) AS DATE)
           AS sales_month
    FROM bounds
), panel AS (
    SELECT m.sales_month, s.product_category, s.sales_channel, coalesce(v.gross_sales_usd, 0.0) AS gross_sales_usd
    FROM months AS m
    CROSS JOIN (SELECT DISTINCT product_category, sales_channel FROM monthly) AS s
    LEFT JOIN monthly AS v USING (sales_month, product_category, sales_channel)
), extended AS (
    SELECT * FROM panel
    UNION ALL
    SELECT DISTINCT CAST(last_month + INTERVAL 1 MONTH AS DATE), product_category, sales_channel, CAST(NULL AS DOUBLE)
    FROM panel, bounds
), features AS (
    SELECT *, lag(gross_sales_usd, 1) OVER w AS lag_1, lag(gross_sales_usd, 12) OVER w AS lag_12,
           round((lag(gross_sales_usd, 1) OVER w + lag(gross_sales_usd, 2) OVER w
                  + lag(gross_sales_usd, 3) OVER w) / 3, 4) AS previous_3_month_average,
           CAST(month(sales_month) AS VARCHAR) AS month_number
    FROM extended
    WINDOW w AS (PARTITION BY product_category, sales_channel ORDER BY sales_month)
), usable AS (
    SELECT f.* FROM features AS f, bounds
    WHERE sales_month <= last_month AND lag_1 IS NOT NULL AND lag_12 IS NOT NULL
      AND previous_3_month_average IS NOT NULL
), upcoming AS (
    SELECT f.* FROM features AS f, bounds WHERE sales_month > last_month
), holdout AS (
    SELECT u.*, lag_12 AS seasonal_naive_usd FROM usable AS u, bounds
    WHERE sales_month >= last_month - INTERVAL 11 MONTH
)"""
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _int(text: str) -> str:
    """By the shape of the text; a fraction other than zero, however small, is no whole number."""
    digits = rf"replace(regexp_extract({text}, '[+-]?\d+'), '+', '')"
    power = rf"CAST(pow(10, CAST(regexp_extract({text}, 'e(\d)', 1) AS INTEGER)) AS HUGEINT)"
    return rf"""CASE WHEN regexp_full_match({text}, '\s*[+-]?\d+(\.0*)?\s*') THEN try_cast({digits} AS INTEGER)
                    WHEN regexp_full_match({text}, '\s*[+-]?\d+e\d\s*')
                    THEN try_cast(CAST({digits} AS HUGEINT) * {power} AS INTEGER) END"""


def _date(text: str) -> str:
    shaped = rf"regexp_full_match({text}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}')"
    return f"CASE WHEN {shaped} THEN CAST(try_strptime({text}, '%m/%d/%Y') AS DATE) END"


def _money(text: str) -> str:
    """By the shape of the text: ten whole digits, and sixteen decimals before any zeros."""
    bare = rf"regexp_replace({text}, '[$,\s]', '', 'g')"
    shaped = rf"regexp_full_match({bare}, '[+-]?\d{{1,10}}(\.\d{{0,16}}0*)?')"
    return rf"CASE WHEN {shaped} THEN CAST(regexp_extract({bare}, '[+-]?\d+(\.\d{{0,16}})?') AS DECIMAL(26,16)) END"


def _violations(sales: str, products: str, stores: str, ctes: str) -> str:
    names = ("order_number", "line_item", "customer_key", "store_key", "product_key", "quantity")
    blank = "trim(order_date) = ''"
    return _with(
        ctes
        + f""", line AS (
    SELECT {", ".join(f"{_int(name)} AS {name}" for name in names)},
           order_date, delivery_date, {_date("order_date")} AS order_day,
           {_date("trim(delivery_date)")} AS delivery_day
    FROM {sales}
), product AS (
    SELECT {_int("product_key")} AS product_key, category,
           {_money("unit_cost_usd")} AS cost, {_money("unit_price_usd")} AS price
    FROM {products}
), store AS (SELECT {_int("store_key")} AS store_key FROM {stores}),
counted AS (
    SELECT {", ".join(f"count(*) FILTER (WHERE {name} IS NULL) AS sales_{name}" for name in names)},
           (SELECT count(*) FROM product WHERE product_key IS NULL) AS products_product_key,
           (SELECT count(*) FROM store WHERE store_key IS NULL) AS stores_store_key,
           count(*) FILTER (WHERE quantity <= 0) AS quantity_not_positive,
           count(*) FILTER (WHERE (order_day IS NULL AND NOT {blank})
                               OR (delivery_day IS NULL AND trim(delivery_date) <> '')) AS sales_dates,
           count(*) FILTER (WHERE {blank}) AS order_date_missing,
           (SELECT count(*) FROM product WHERE cost IS NULL) AS unit_cost_usd,
           (SELECT count(*) FROM product WHERE price IS NULL) AS unit_price_usd,
           (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM product GROUP BY product_key)) AS product_key_repeats,
           (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM store GROUP BY store_key)) AS store_key_repeats,
           count(*) FILTER (WHERE product_key IS NULL OR product_key NOT IN (SELECT product_key FROM product WHERE product_key IS NOT NULL)) AS product_key_unmatched,
           count(*) FILTER (WHERE store_key IS NULL OR store_key NOT IN (SELECT store_key FROM store WHERE store_key IS NOT NULL)) AS store_key_unmatched,
           count(*) FILTER (WHERE product_key IN (SELECT product_key FROM product WHERE trim(category) = '')) AS category_blank
    FROM line
)""",
        """SELECT CAST(row_number() OVER () AS INTEGER) AS position, rule, CAST(violations AS BIGINT) AS violations
FROM (UNPIVOT (SELECT COLUMNS(*)::BIGINT FROM counted) ON COLUMNS(*) INTO NAME rule VALUE violations)
""",
    )


_GOLD_RULES = """
SELECT * FROM (VALUES
    (1, 'order_date', (SELECT count(*) FROM {0} WHERE order_date IS NULL)),
    (2, 'product_category', (SELECT count(*) FROM {0} WHERE product_category IS NULL OR regexp_full_match(product_category, '\\s*'))),
    (3, 'sales_channel', (SELECT count(*) FROM {0} WHERE sales_channel IS NULL OR regexp_full_match(sales_channel, '\\s*')))
) AS rules(position, rule, violations)
"""

# Layers, severities and descriptions of the recorded checks. Per check: layer, severity, description, failed rows and total rows.
_CHECKS = {
    "required_tables_not_empty": ("all", "critical", "The five core pipeline tables contain at least one row.",
        "(SELECT (count(*) = 0)::INT FROM bronze_sales) + (SELECT (count(*) = 0)::INT FROM bronze_products)"
        " + (SELECT (count(*) = 0)::INT FROM bronze_stores) + (SELECT (count(*) = 0)::INT FROM silver)"
        " + (SELECT (count(*) = 0)::INT FROM gold)", "5"),
    "sales_grain_unique": ("bronze", "critical", "Each order number and line item identifies one sales row.",
        "(SELECT count(*) FROM bronze_sales) - (SELECT count(*) FROM (SELECT DISTINCT order_number, line_item FROM bronze_sales))",
        "(SELECT count(*) FROM bronze_sales)"),
    "product_key_unique": ("bronze", "critical", "Each product key identifies one product row.",
        "(SELECT count(*) FROM bronze_products) - (SELECT count(*) FROM (SELECT DISTINCT product_key FROM bronze_products))",
        "(SELECT count(*) FROM bronze_products)"),
    "store_key_unique": ("bronze", "critical", "Each store key identifies one store row.",
        "(SELECT count(*) FROM bronze_stores) - (SELECT count(*) FROM (SELECT DISTINCT store_key FROM bronze_stores))",
        "(SELECT count(*) FROM bronze_stores)"),
    "sales_product_keys_match": ("bronze", "critical", "Every sales product key matches the product dimension.",
        "(SELECT count(*) FROM bronze_sales s LEFT JOIN bronze_products p USING (product_key) WHERE p.product_key IS NULL)",
        "(SELECT count(*) FROM bronze_sales s LEFT JOIN bronze_products p USING (product_key))"),
    "sales_store_keys_match": ("bronze", "critical", "Every sales store key matches the store dimension.",
        "(SELECT count(*) FROM bronze_sales s LEFT JOIN bronze_stores t USING (store_key) WHERE t.store_key IS NULL)",
        "(SELECT count(*) FROM bronze_sales s LEFT JOIN bronze_stores t USING (store_key))"),
    "quantity_positive_integer": ("bronze", "high", "Sales quantity is a positive integer.",
        "(SELECT count(*) FILTER (WHERE n IS NULL OR n <= 0 OR n % 1 <> 0) FROM"
        " (SELECT try_cast(quantity AS DECIMAL(38,18)) AS n FROM bronze_sales))",
        "(SELECT count(*) FROM bronze_sales)"),
    "delivery_not_before_order": ("silver", "high", "A populated delivery date is on or after the order date.",
        "(SELECT count(*) FROM silver WHERE delivery_date < order_date)", "(SELECT count(*) FROM silver)"),
    "online_orders_have_delivery_date": ("silver", "high", "Online orders have a delivery date.",
        "(SELECT count(*) FROM silver WHERE sales_channel = 'Online' AND delivery_date IS NULL)",
        "(SELECT count(*) FROM silver WHERE sales_channel = 'Online')"),
    "silver_row_count_matches_bronze": ("silver", "critical", "The Silver join neither loses nor multiplies sales rows.",
        "abs((SELECT count(*) FROM silver) - (SELECT count(*) FROM bronze_sales))",
        "greatest((SELECT count(*) FROM silver), (SELECT count(*) FROM bronze_sales))"),
    "silver_measures_complete": ("silver", "high", "Silver price, cost, sales, and estimated-profit measures are populated.",
        "(SELECT count(*) FROM silver WHERE unit_cost_usd IS NULL OR unit_price_usd IS NULL"
        " OR gross_sales_usd IS NULL OR estimated_gross_profit_usd IS NULL)", "(SELECT count(*) FROM silver)"),
    "sales_channel_allowed_values": ("silver", "high", "Sales channel is either Online or In Store.",
        "(SELECT count(*) FROM silver WHERE sales_channel IS NULL OR sales_channel NOT IN ('Online', 'In Store'))",
        "(SELECT count(*) FROM silver)"),
    "gold_grain_unique": ("gold", "critical", "Each month, product category, and channel appears once in Gold.",
        "(SELECT count(*) FROM gold) - (SELECT count(*) FROM (SELECT DISTINCT sales_month, product_category, sales_channel FROM gold))",
        "(SELECT count(*) FROM gold)"),
    "gold_totals_match_silver": ("gold", "critical", "Gold units, sales, and estimated profit reconcile to Silver.",
        "CASE WHEN (SELECT (sum(quantity), sum(gross_sales_usd), sum(estimated_gross_profit_usd)) FROM silver)"
        " = (SELECT (sum(units_sold), sum(gross_sales_usd), sum(estimated_gross_profit_usd)) FROM gold) THEN 0 ELSE 1 END", "1"),
}


def _check_rows(names: list[str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{layer}' AS layer, '{severity}' AS severity, "
        f"CAST({failed} AS BIGINT) AS failed_rows, CAST({total} AS BIGINT) AS total_rows, '{text}' AS description"
        for name, (layer, severity, text, failed, total) in ((name, _CHECKS[name]) for name in names)
    )
    return f"""
SELECT check_name, layer, severity, CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       failed_rows, total_rows,
       CASE WHEN total_rows = 0 THEN 0.0::DOUBLE ELSE failed_rows::DOUBLE / total_rows::DOUBLE END AS failure_rate,
       description
FROM ({counts})
"""


def _damaged_checks() -> str:
    names = [name for name, check in _CHECKS.items() if check[0] == "bronze"]
    rows = _check_rows(names)
    for table in ("sales", "products", "stores"):
        rows = rows.replace(f"bronze_{table}", f"damaged_{table}")
    return _with(DAMAGED, rows)


def _damaged_later_checks() -> str:
    """The checks that read Silver or Gold, over spoilt lines and a Gold with repeated and missing rows."""
    names = [name for name, check in _CHECKS.items() if check[0] != "bronze"]
    rows = _check_rows(names)
    for table in ("silver", "gold"):
        rows = rows.replace(f"FROM {table}", f"FROM spoilt_{table}")
    rows = rows.replace("bronze_stores", "no_stores")
    return _with(
        GOLD
        + """, spoilt_silver AS (
            SELECT * REPLACE (
                CASE WHEN line_item = 1 AND store_key <> 0 THEN order_date - 1 ELSE delivery_date END AS delivery_date,
                CASE WHEN line_item = 2 THEN NULL WHEN line_item = 3 THEN 'Phone' WHEN line_item = 4 THEN 'Online'
                     ELSE sales_channel END AS sales_channel,
                CASE WHEN line_item = 5 THEN NULL ELSE gross_sales_usd END AS gross_sales_usd)
            FROM silver WHERE line_item <> 6
        ), spoilt_gold AS (
            SELECT * FROM gold UNION ALL SELECT * FROM gold WHERE sales_channel = 'In Store'
        ), no_stores AS (SELECT * FROM bronze_stores WHERE false)""",
        rows,
    )


_INT_TEXTS = {
    "plain": "CAST(l_partkey AS VARCHAR)",
    "padded": "'  ' || l_partkey || ' '",
    "signed": "'+' || l_partkey",
    "zeros": "'00' || l_partkey",
    "whole_decimal": "l_linenumber || '.0'",
    "exponent": "l_linenumber || 'e2'",
    "fraction": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)",
    "word": "l_returnflag",
    "blank": "''",
    "too_large": "l_linenumber || '000000000'",
    "tiny": "l_linenumber || 'e-19'",
    "past_the_scale": "l_linenumber || '.0000000000000000001'",
    "zeros_past_the_scale": "l_linenumber || '.00000000000000000000'",
}
_MONEY_TEXTS = {
    "currency": "'$' || format('{:,.2f}', p_retailprice)",
    "padded": "' $' || format('{:,.2f}', p_retailprice) || chr(9) || ' '",
    "bare": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)",
    "negative": "'-$' || format('{:,.2f}', p_retailprice)",
    "long": "CAST(p_retailprice AS DECIMAL(12,2)) || '125'",
    "named": "'USD ' || format('{:,.2f}', p_retailprice)",
    "word": "p_name",
    "blank": "' '",
    "seven_decimals": "CAST(p_retailprice AS DECIMAL(12,2)) || '00004'",
    "past_the_scale": "CAST(p_retailprice AS DECIMAL(12,2)) || '000000000000001'",
    "zeros_past_the_scale": "CAST(p_retailprice AS DECIMAL(12,2)) || '000000000000000000'",
}
_DATE_TEXTS = {
    "plain": "strftime(o_orderdate, '%-m/%-d/%Y')",
    "zero_padded": "strftime(o_orderdate, '%m/%d/%Y')",
    "trailing_space": "strftime(o_orderdate, '%-m/%-d/%Y') || ' '",
    "three_digits": "'0' || strftime(o_orderdate, '%m/%d/%Y')",
    "day_first": "strftime(o_orderdate, '%-d/%-m/%Y')",
    "iso": "strftime(o_orderdate, '%Y-%m-%d')",
    "short_year": "strftime(o_orderdate, '%-m/%-d/%y')",
    "month_13": "'13/' || strftime(o_orderdate, '%-d/%Y')",
    "word": "o_orderpriority",
    "blank": "'  '",
}


def _renderings(texts: dict[str, str], table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rendering, {text} AS text FROM {table}" for name, text in texts.items())


# Lines that each damage of the Bronze text spoils.
_REFUSALS = {
    "order_number": "line_item = '2'",
    "line_item": "line_item = '2'",
    "customer_key": "line_item = '2'",
    "delivery_date": "line_item = '2'",
    "quantity": "line_item = '2'",
    "store_key": "line_item = '2' AND store_key <> '0'",
    "nothing": "false",
}


_MONTH_COLUMNS = "sales_month, product_category, sales_channel"
_TRAINED = "(SELECT u.* FROM usable AS u, bounds WHERE sales_month < last_month - INTERVAL 11 MONTH)"


# Which records a damage spoils, and what the preflight says of each damage otherwise.
_SPOILT = {"sales": "line_item = '7'", "products": "subcategory = 'size 13'", "stores": "store_key LIKE '%7'"}
_VERDICTS = {"intact": "accepted", "missing": "missing", "zero_bytes": "empty", "other_header": "header", "no_rows": "no rows"}


def _rejections() -> str:
    rows = []
    for table, spoilt in _SPOILT.items():
        source = f"bronze_{table}"
        for damage, verdict in _VERDICTS.items():
            count = f"(SELECT count(*) FROM {source})" if verdict == "accepted" else "NULL"
            rows.append(f"SELECT '{table.title()}.csv' AS file_name, '{damage}' AS damage, '{verdict}' AS verdict, {count} AS row_count")
        rows.append(
            f"SELECT '{table.title()}.csv', 'not_utf8', CASE WHEN bad > 0 THEN 'encoding' ELSE 'accepted' END, "
            f"CASE WHEN bad = 0 THEN n END FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {spoilt}) AS bad FROM {source})"
        )
    return _with(BRONZE, " UNION ALL ".join(rows))


# Tables by the step that publishes them, and what each stage then answers.
_STEPS = {
    "nothing": [],
    "sales": ["bronze_sales"],
    "products": ["bronze_products"],
    "bronze": ["bronze_stores"],
    "silver": ["silver"],
    "gold": ["gold"],
}
_NO_BRONZE = "bronze.sales, bronze.products, bronze.stores is not published. Run bronze first"
_NO_SILVER = "silver.sales_enriched is not published. Run silver first"
_NO_GOLD = "gold.monthly_sales_summary is not published. Run gold first"
_ANSWERS = {
    "nothing": {"silver": _NO_BRONZE, "gold": _NO_SILVER, "quality": _NO_BRONZE, "export": _NO_GOLD, "forecast": _NO_SILVER},
    "sales": {
        "silver": "bronze.products, bronze.stores is not published. Run bronze first",
        "gold": _NO_SILVER,
        "quality": "bronze.products, bronze.stores is not published. Run bronze first",
    },
    "products": {
        "silver": "bronze.stores is not published. Run bronze first",
        "quality": "bronze.stores is not published. Run bronze first",
    },
    "bronze": {"gold": _NO_SILVER, "quality": _NO_SILVER, "export": _NO_GOLD, "forecast": _NO_SILVER, "silver": "runs"},
    "silver": {"quality": _NO_GOLD, "export": _NO_GOLD, "gold": "runs"},
    "gold": {"quality": "runs", "export": "runs"},
}


def _gates() -> str:
    rows, tables = [], []
    for position, (step, more) in enumerate(_STEPS.items(), 1):
        tables += more
        count = " + ".join(f"(SELECT count(*) FROM {table})" for table in tables) or "0"
        for stage, answer in _ANSWERS[step].items():
            rows.append(
                f"SELECT {position} AS position, '{step}' AS published, '{stage}' AS stage, '{answer}' AS answer, "
                f"CAST({count} AS BIGINT) AS published_rows"
            )
    return _with(GOLD, " UNION ALL ".join(rows))


def _runs() -> str:
    """Whole sales have n lines, fewer have m; damaged sales are published as text, but go no further."""
    whole, fewer = "whole", "fewer"
    runs = [
        ("all layers", "0", whole, whole),
        ("again", "0", whole, whole),
        ("Silver dies when staged", "1", whole, whole),
        ("fewer sales delivered", "0", fewer, whole),
        ("Gold alone", "0", fewer, whole),
        ("damaged sales", "CASE WHEN bad > 0 THEN 1 ELSE 0 END", whole, whole),
        ("a folder without files", "1", whole, whole),
        ("no such layer", "1", whole, whole),
        ("fewer sales in all layers", "0", fewer, fewer),
    ]
    rows = [
        f"SELECT {position} AS position, '{name}' AS run, {status} AS status, {bronze}_lines AS bronze_sales, "
        f"{silver}_lines AS silver_sales, {silver}_groups AS gold_rows, 3 AS layer_schemas FROM counts"
        for position, (name, status, bronze, silver) in enumerate(runs, 1)
    ]
    groups = "count(DISTINCT (date_trunc('month', order_date), product_category, sales_channel))"
    counts = f"""counts AS (
        SELECT count(*) AS whole_lines, count(*) FILTER (WHERE line_item <> 1) AS fewer_lines, {groups} AS whole_groups,
               {groups} FILTER (WHERE line_item <> 1) AS fewer_groups, count(*) FILTER (WHERE line_item = 7) AS bad
        FROM silver)"""
    return _with(f"{SILVER}, {counts}", " UNION ALL ".join(rows))


def oracle_sql() -> dict[str, str]:
    return {
        "preflight_rejections": _rejections(),
        "stage_gates": _gates(),
        "failed_runs": _runs(),
        "dq_run_identity": _with(
            GOLD,
            f"""SELECT run, true AS ids_differ, true AS id_is_uuid, true AS one_time, true AS times_ascend,
                       count(*) AS results, CAST(sum(total_rows) AS BIGINT) AS total_rows
                FROM ({_check_rows(list(_CHECKS))}), range(1, 3) runs(run) GROUP BY run""",
        ),
        "gold_monthly_sales_summary": _with(GOLD, "SELECT * FROM gold"),
        "silver_sales_enriched": _with(SILVER, "SELECT * FROM silver"),
        "bronze_sales": _with(BRONZE, "SELECT *, 'Sales.csv' AS source_file FROM bronze_sales"),
        "bronze_products": _with(BRONZE, "SELECT *, 'Products.csv' AS source_file FROM bronze_products"),
        "bronze_stores": _with(BRONZE, "SELECT *, 'Stores.csv' AS source_file FROM bronze_stores"),
        "csv_quoted_products": _with(
            BRONZE,
            """SELECT * REPLACE (product_name || ', "' || brand || '"' || chr(10) || category AS product_name)
               FROM bronze_products""",
        ),
        "preflight_summary": _with(
            BRONZE,
            """SELECT 'Sales.csv' AS file_name, CAST(count(*) AS BIGINT) AS row_count, 9 AS column_count FROM bronze_sales
               UNION ALL SELECT 'Products.csv', count(*), 10 FROM bronze_products
               UNION ALL SELECT 'Stores.csv', count(*), 5 FROM bronze_stores""",
        ),
        "silver_int_parse": f"""
            SELECT rendering, count(*) AS texts, count(value) AS accepted, CAST(sum(value) AS BIGINT) AS total,
                   min(value) AS smallest, max(value) AS largest
            FROM (SELECT rendering, {_int("text")} AS value FROM ({_renderings(_INT_TEXTS, "lineitem")}))
            GROUP BY rendering""",
        "silver_money_parse": f"""
            SELECT rendering, count(*) AS texts, count(value) AS accepted, CAST(sum(value) AS DECIMAL(36,16)) AS total,
                   min(value) AS smallest, max(value) AS largest
            FROM (SELECT rendering, {_money("text")} AS value FROM ({_renderings(_MONEY_TEXTS, "part")}))
            GROUP BY rendering""",
        "silver_date_parse": f"""
            SELECT rendering, count(*) AS texts, count(required) AS order_dates,
                   min(required) AS first_order_date, max(required) AS last_order_date,
                   count(optional) AS delivery_dates, count(*) FILTER (WHERE trim(text) = '') AS no_delivery_date,
                   CAST(sum(date_diff('day', DATE '1970-01-01', optional)) AS BIGINT) AS delivery_days
            FROM (SELECT rendering, text, {_date("text")} AS required, {_date("trim(text)")} AS optional
                  FROM ({_renderings(_DATE_TEXTS, "orders")}))
            GROUP BY rendering""",
        "silver_violations": _violations("bronze_sales", "bronze_products", "bronze_stores", BRONZE),
        "silver_violations_damaged": _violations("damaged_sales", "damaged_products", "damaged_stores", DAMAGED),
        "gold_violations": _with(SILVER, _GOLD_RULES.format("silver")),
        "gold_violations_damaged": _with(
            SILVER
            + """, damaged AS (
                SELECT CASE WHEN line_item <> 1 THEN order_date END AS order_date,
                       CASE WHEN line_item = 2 THEN ' ' || chr(9) WHEN line_item <> 3 THEN product_category END
                           AS product_category,
                       CASE WHEN line_item = 4 THEN '' ELSE sales_channel END AS sales_channel
                FROM silver)""",
            _GOLD_RULES.format("damaged"),
        ),
        "gold_refusals": _with(
            BRONZE,
            " UNION ALL ".join(
                f"SELECT '{name}' AS damaged, (SELECT count(*) > 0 FROM bronze_sales WHERE {where}) AS refused"
                for name, where in _REFUSALS.items()
            ),
        ),
        "gold_reconciliation": _with(
            GOLD,
            """SELECT *, silver_line_items = gold_line_items AND silver_units = gold_units
                      AND silver_sales = gold_sales AND silver_profit = gold_profit AS reconciled
               FROM (SELECT count(*) AS silver_line_items, CAST(sum(quantity) AS BIGINT) AS silver_units,
                            CAST(sum(gross_sales_usd) AS DECIMAL(24,2)) AS silver_sales,
                            CAST(sum(estimated_gross_profit_usd) AS DECIMAL(24,2)) AS silver_profit FROM silver),
                    (SELECT CAST(sum(line_item_count) AS BIGINT) AS gold_line_items,
                            CAST(sum(units_sold) AS BIGINT) AS gold_units,
                            CAST(sum(gross_sales_usd) AS DECIMAL(26,2)) AS gold_sales,
                            CAST(sum(estimated_gross_profit_usd) AS DECIMAL(26,2)) AS gold_profit FROM gold)""",
        ),
        "published_gold": _with(GOLD, "SELECT * FROM gold"),
        "layer_row_counts": _with(
            GOLD,
            """SELECT 'Bronze sales' AS layer, count(*) AS rows FROM bronze_sales
               UNION ALL SELECT 'Silver sales', count(*) FROM silver
               UNION ALL SELECT 'Gold summary', count(*) FROM gold""",
        ),
        "gold_export_rows": _with(GOLD, "SELECT * FROM gold"),
        **{f"dq_{name}": _with(GOLD, _check_rows([name])) for name in _CHECKS},
        "dq_damaged_bronze": _damaged_checks(),
        "dq_damaged_silver_gold": _damaged_later_checks(),
        "dq_check_results": _with(GOLD, _check_rows(list(_CHECKS))),
        "dq_latest_run": _with(
            GOLD,
            f"""SELECT check_name, status, failed_rows, total_rows, true AS is_newest_run,
                       CAST(2 * count(*) OVER () AS BIGINT) AS recorded_results
                FROM ({_check_rows(list(_CHECKS))})""",
        ),
        "inspect_gold_head": _with(GOLD, f"SELECT * FROM gold ORDER BY {_MONTH_COLUMNS} LIMIT 20"),
        "inspect_bronze_head": _with(
            BRONZE,
            """SELECT order_number, order_date, product_key, store_key, quantity FROM bronze_sales
               ORDER BY order_number, line_item, order_date, product_key, store_key, quantity LIMIT 10""",
        ),
        "inspect_price_text": _with(
            BRONZE, "SELECT product_key, unit_price_usd FROM bronze_products WHERE product_key = '1'"
        ),
        "inspect_price_typed": _with(
            SILVER,
            """SELECT order_number, product_name, quantity, unit_price_usd, gross_sales_usd FROM silver
               WHERE product_key = 1
               ORDER BY order_number, line_item, product_name, quantity, unit_price_usd, gross_sales_usd LIMIT 10""",
        ),
        "inspect_price_text_vs_typed": _with(
            SILVER,
            """SELECT 'text' AS form, unit_price_usd AS price FROM bronze_products WHERE product_key = '1'
               UNION ALL SELECT * FROM (
                   SELECT 'typed', CAST(unit_price_usd AS VARCHAR) FROM silver WHERE product_key = 1
                   ORDER BY order_number, line_item, quantity LIMIT 10)""",
        ),
        "inspect_channel_totals": _with(
            GOLD,
            """SELECT sales_channel, CAST(sum(units_sold) AS BIGINT) AS units_sold,
                      CAST(sum(gross_sales_usd) AS DECIMAL(26,2)) AS gross_sales_usd,
                      CAST(sum(estimated_gross_profit_usd) AS DECIMAL(26,2)) AS estimated_gross_profit_usd
               FROM gold GROUP BY sales_channel""",
        ),
        "forecast_last_complete_month": _with(
            FORECAST,
            """SELECT latest AS latest_order_date, last_month AS last_complete_month,
                      CASE WHEN date_trunc('month', latest) > last_month
                           THEN CAST(date_trunc('month', latest) AS DATE) END AS excluded_partial_month,
                      CAST(last_month + INTERVAL 1 MONTH AS DATE) AS next_month
               FROM bounds""",
        ),
        "forecast_monthly_sales": _with(FORECAST, "SELECT * FROM monthly"),
        "forecast_panel": _with(FORECAST, "SELECT * FROM panel"),
        "forecast_features": _with(FORECAST, "SELECT * FROM usable"),
        "forecast_split": _with(
            FORECAST,
            """SELECT CASE WHEN sales_month >= last_month - INTERVAL 11 MONTH THEN 'holdout' ELSE 'train' END AS part,
                      count(*) AS rows, count(DISTINCT sales_month) AS months,
                      min(sales_month) AS first_month, max(sales_month) AS last_month,
                      CAST(sum(CAST(gross_sales_usd AS DECIMAL(20,2))) AS DECIMAL(30,2)) AS gross_sales_usd
               FROM usable, bounds GROUP BY part""",
        ),
        "forecast_holdout_naive": _with(
            FORECAST, f"SELECT {_MONTH_COLUMNS}, gross_sales_usd, seasonal_naive_usd FROM holdout"
        ),
        "forecast_naive_metrics": _with(
            FORECAST,
            """SELECT round(avg(abs(gross_sales_usd - seasonal_naive_usd)), 2) AS mae_usd,
                      CASE WHEN sum(gross_sales_usd) <> 0 THEN
                          round(100 * sum(abs(gross_sales_usd - seasonal_naive_usd)) / sum(gross_sales_usd), 2)
                      END AS wape_percent
               FROM holdout""",
        ),
        "forecast_ridge_optimality": _with(
            FORECAST,
            """SELECT unnest(['intercept', 'lag_1', 'lag_12', 'previous_3_month_average']) AS feature, 0.0::DOUBLE AS gap
               UNION ALL SELECT DISTINCT 'product_category=' || product_category, 0.0 FROM usable
               UNION ALL SELECT DISTINCT 'sales_channel=' || sales_channel, 0.0 FROM usable
               UNION ALL SELECT DISTINCT 'month_number=' || month_number, 0.0 FROM usable""",
        ),
        "forecast_holdout_optimality": _with(
            FORECAST,
            f"""SELECT unnest(['intercept', 'lag_1', 'lag_12', 'previous_3_month_average']) AS feature, 0.0::DOUBLE AS gap
                UNION ALL SELECT DISTINCT 'product_category=' || product_category, 0.0 FROM {_TRAINED}
                UNION ALL SELECT DISTINCT 'sales_channel=' || sales_channel, 0.0 FROM {_TRAINED}
                UNION ALL SELECT DISTINCT 'month_number=' || month_number, 0.0 FROM {_TRAINED}""",
        ),
        "forecast_holdout_parts": _with(
            FORECAST, f"SELECT {_MONTH_COLUMNS}, seasonal_naive_usd, true AS adds_up FROM holdout"
        ),
        "forecast_next_month_parts": _with(
            FORECAST, f"SELECT {_MONTH_COLUMNS}, lag_12 AS seasonal_naive_usd, true AS adds_up FROM upcoming"
        ),
        "forecast_summary_errors": _with(
            FORECAST,
            """SELECT (SELECT round(avg(abs(gross_sales_usd - seasonal_naive_usd)), 2) FROM holdout) AS naive_mae_usd,
                      (SELECT CASE WHEN sum(gross_sales_usd) <> 0 THEN
                           round(100 * sum(abs(gross_sales_usd - seasonal_naive_usd)) / sum(gross_sales_usd), 2)
                       END FROM holdout) AS naive_wape_percent,
                      true AS ridge_mae_agrees, true AS ridge_wape_agrees,
                      strftime(last_month - INTERVAL 11 MONTH, '%Y-%m-%d') AS holdout_start,
                      strftime(last_month, '%Y-%m-%d') AS holdout_end,
                      strftime(last_month + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_forecast_month
               FROM bounds""",
        ),
        "forecast_selection": _with(
            FORECAST,
            """SELECT product_category, sales_channel, true AS follows_the_errors, true AS named_in_the_summary,
                      true AS not_below_zero FROM upcoming""",
        ),
        "forecast_files": _with(
            FORECAST,
            """SELECT 'holdout_predictions' AS file,
                      CAST(row_number() OVER (ORDER BY sales_month, product_category, sales_channel) AS INTEGER) AS position,
                      CAST(sales_month AS VARCHAR) AS sales_month, product_category, sales_channel,
                      CAST(CAST(seasonal_naive_usd AS DECIMAL(18,2)) AS VARCHAR) AS seasonal_naive_usd FROM holdout
               UNION ALL
               SELECT 'next_month_forecast',
                      CAST(row_number() OVER (ORDER BY product_category, sales_channel) AS INTEGER),
                      CAST(sales_month AS VARCHAR), product_category, sales_channel,
                      CAST(CAST(lag_12 AS DECIMAL(18,2)) AS VARCHAR) FROM upcoming""",
        ),
        "forecast_metrics_file": _with(
            FORECAST,
            """SELECT 'monthly gross sales USD by product category and sales channel' AS target,
                      'silver.sales_enriched' AS source, CAST(last_month AS VARCHAR) AS last_complete_month,
                      CASE WHEN date_trunc('month', latest) > last_month
                           THEN strftime(date_trunc('month', latest), '%Y-%m-%d') END AS excluded_partial_month,
                      strftime(last_month - INTERVAL 11 MONTH, '%Y-%m-%d') AS holdout_start,
                      CAST(last_month AS VARCHAR) AS holdout_end,
                      'one-month-ahead predictions using actual prior months; no refit during holdout' AS holdout_method,
                      (SELECT round(avg(abs(gross_sales_usd - seasonal_naive_usd)), 2) FROM holdout) AS baseline_mae_usd,
                      (SELECT round(100 * sum(abs(gross_sales_usd - seasonal_naive_usd)) / sum(gross_sales_usd), 2)
                       FROM holdout) AS baseline_wape_percent,
                      strftime(last_month + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_forecast_month,
                      'Historical fictional data; this is a teaching experiment, not a current sales forecast.' AS note
               FROM bounds""",
        ),
        "forecast_next_month_features": _with(FORECAST, "SELECT * FROM upcoming"),
        "forecast_next_month_naive": _with(
            FORECAST, f"SELECT {_MONTH_COLUMNS}, lag_12 AS seasonal_naive_usd FROM upcoming"
        ),
    }
