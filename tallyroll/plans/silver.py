"""Silver: one typed, enriched row per Bronze sales line.

The rules are part of the plan: a join key and filters that have a value or stop the job. No column
need be read for its rule to hold, so Gold, the forecast or a plain count over Silver lines refuse a
bad line too. A good run checks everything in the one pass that writes the table, and a bad run stops at
the first bad row. Only after such a stop are the violations counted, to report the rule that
comes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.contracts import IN_STORE, ONLINE, ONLINE_STORE_KEY, SILVER_TABLE, SILVER_TYPES
from tallyroll.errors import JOB_ERRORS, StageError
from tallyroll.functions.text import (
    in_date_range,
    is_blank,
    money,
    no_date,
    or_fail,
    required,
    source_date,
    stripped,
    whole_number,
    zero_padded_day,
)
from tallyroll.operators.keys import lines_per_key, lookup, rows_and_excess
from tallyroll.operators.scalars import as_rows, side_by_side
from tallyroll.sources.layer_store import LayerStore

WHOLE_NUMBERS = ("order_number", "line_item", "customer_key", "store_key", "product_key", "quantity")

# Fixed values inside the messages: "joins failed", "sales date", "order_date is required" and
# "product_category is required".
NOT_WHOLE = "{} has text that is no whole number"
BAD_MONEY = "{} has text that is no amount of money"
REPEATED_KEY = "joins failed, since a product or store key occurs more than once"
NO_MATCH = "joins failed, since a line names a product or store that is not listed"

# Rules and what they report, in the order they are reported.
RULES = {
    **{f"sales_{name}": NOT_WHOLE.format(name) for name in WHOLE_NUMBERS},
    "products_product_key": NOT_WHOLE.format("product_key"),
    "stores_store_key": NOT_WHOLE.format("store_key"),
    "quantity_not_positive": "a quantity is zero or less",
    "sales_dates": "a sales date has an unknown form",
    "order_date_missing": "order_date is required, and a line has none",
    "unit_cost_usd": BAD_MONEY.format("unit_cost_usd"),
    "unit_price_usd": BAD_MONEY.format("unit_price_usd"),
    "product_key_repeats": REPEATED_KEY,
    "store_key_repeats": REPEATED_KEY,
    "product_key_unmatched": NO_MATCH,
    "store_key_unmatched": NO_MATCH,
    "category_blank": "product_category is required, and a sold product has none",
}


def typed_sales(sales: DataFrame) -> DataFrame:
    """Sales text as typed columns, NULL where it breaks a rule, plus two date flags."""
    texts = sales.selectExpr(
        *WHOLE_NUMBERS,
        "currency_code",
        f"{zero_padded_day('order_date')} AS order_text",
        f"{zero_padded_day(stripped('delivery_date'))} AS delivery_text",
    )
    parsed = texts.selectExpr(
        *[f"{whole_number(name)} AS {name}" for name in WHOLE_NUMBERS],
        "currency_code",
        f"{source_date('order_text')} AS order_day",
        f"{no_date('order_text')} AS order_date_absent",
        f"{source_date('delivery_text')} AS delivery_day",
        f"{no_date('delivery_text')} AS delivery_date_absent",
    )
    return parsed.selectExpr(
        *WHOLE_NUMBERS,
        "currency_code",
        f"CASE WHEN {in_date_range('order_day')} THEN order_day END AS order_date",
        f"CASE WHEN {in_date_range('delivery_day')} THEN delivery_day END AS delivery_date",
        "order_date_absent",
        f"delivery_date_absent OR coalesce({in_date_range('delivery_day')}, false) AS delivery_date_ok",
    )


def sound_sales(sales: DataFrame) -> DataFrame:
    """Typed sales, whose job fails at a line that breaks a rule of its own.

    The rules stand in the store key, which the first join always reads. So a bad line fails before
    anything is shuffled, and columns that only a rule needs are not carried through the joins.
    """
    sound = _holding(
        **{f"sales_{name}": f"{name} IS NOT NULL" for name in WHOLE_NUMBERS},
        quantity_not_positive="quantity > 0",
        sales_dates="order_date IS NOT NULL AND delivery_date_ok",
    )
    kept = [name for name in WHOLE_NUMBERS if name != "store_key"]
    return typed_sales(sales).selectExpr(
        *kept, f"CASE WHEN {sound} THEN store_key END AS store_key", "currency_code", "order_date", "delivery_date"
    )


def typed_products(products: DataFrame) -> DataFrame:
    return products.selectExpr(
        f"{whole_number('product_key')} AS product_key",
        "product_name",
        "brand",
        "subcategory AS product_subcategory",
        "category AS product_category",
        f"NOT {is_blank('category')} AS has_category",
        f"{money('unit_cost_usd')} AS unit_cost_usd",
        f"{money('unit_price_usd')} AS unit_price_usd",
    )


def typed_stores(stores: DataFrame) -> DataFrame:
    return stores.selectExpr(
        f"{whole_number('store_key')} AS store_key", "country AS store_country", "state AS store_state"
    )


def enriched_sales(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """All Silver columns, lazily; every rule holds for whatever is read of them.

    The joins are not hinted. Catalyst broadcasts a dimension it estimates as small, AQE does
    once its real size is known, and otherwise the shuffle join remains, where AQE splits the
    partition of a hot key: a hot product, or the online store, which may hold a large share
    of all lines. Stores come first, so that the wider product columns are not shuffled again.
    """
    # The joins read the keys, and the filters above them read both flags, so these rules stay too.
    known = {
        "store": lookup(_keyed(typed_stores(stores), "store_key", "stores_store_key"), "store_key", "store_found", REPEATED_KEY),
        "product": lookup(
            _keyed(typed_products(products), "product_key", "products_product_key"),
            "product_key",
            "product_found",
            REPEATED_KEY,
            _holding(unit_cost_usd="unit_cost_usd IS NOT NULL", unit_price_usd="unit_price_usd IS NOT NULL"),
        ),
    }
    # Each condition names both sides of its join, so it stays above it and no text is read twice.
    located = sound_sales(sales).join(known["store"], "store_key", "left").where(
        _holding(store_key_unmatched="store_found AND store_key IS NOT NULL")
    )
    checked = located.join(known["product"], "product_key", "left").where(
        _holding(product_key_unmatched="product_found AND product_key IS NOT NULL", category_blank="has_category")
    )
    values = {
        "sales_channel": f"CASE WHEN store_key = {ONLINE_STORE_KEY} THEN '{ONLINE}' ELSE '{IN_STORE}' END",
        # On the unrounded price, then rounded once by the cast.
        "gross_sales_usd": "quantity * unit_price_usd",
        "estimated_gross_profit_usd": "quantity * (unit_price_usd - unit_cost_usd)",
    }
    return checked.selectExpr(*[f"cast({values.get(name, name)} AS {kind}) AS {name}" for name, kind in SILVER_TYPES.items()])


def _keyed(dim: DataFrame, key: str, rule: str) -> DataFrame:
    """The dimension, whose job fails at a row without a key: a join would only pass it over."""
    return dim.selectExpr(*[f"{required(key, RULES[rule])} AS {key}" if name == key else name for name in dim.columns])


def _holding(**rules: str) -> str:
    """True where the named rules hold, by their conditions; a failed job where one does not."""
    return or_fail({condition: RULES[rule] for rule, condition in rules.items()})


def silver_violations(sales: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows per broken rule, in reporting order: (position, rule, violations)."""
    line, product, store = typed_sales(sales), typed_products(products), typed_stores(stores)
    unreadable = "(order_date IS NULL AND NOT order_date_absent) OR NOT delivery_date_ok"
    frames = [
        line.selectExpr(
            *[f"count_if({name} IS NULL) AS sales_{name}" for name in WHOLE_NUMBERS],
            "count_if(quantity <= 0) AS quantity_not_positive",
            f"count_if({unreadable}) AS sales_dates",
            "count_if(order_date_absent) AS order_date_missing",
        ),
        product.selectExpr(
            "count_if(product_key IS NULL) AS products_product_key",
            "count_if(unit_cost_usd IS NULL) AS unit_cost_usd",
            "count_if(unit_price_usd IS NULL) AS unit_price_usd",
        ),
        store.selectExpr("count_if(store_key IS NULL) AS stores_store_key"),
        rows_and_excess(product, ["product_key"], "product_rows", "product_key_repeats"),
        rows_and_excess(store, ["store_key"], "store_rows", "store_key_repeats"),
        lines_per_key(line, product, "product_key", has_category="bool_and(has_category)").selectExpr(
            "sum(CASE WHEN copies IS NULL THEN lines ELSE 0 END) AS product_key_unmatched",
            "sum(CASE WHEN NOT has_category THEN lines ELSE 0 END) AS category_blank",
        ),
        lines_per_key(line, store, "store_key").selectExpr(
            "sum(CASE WHEN copies IS NULL THEN lines ELSE 0 END) AS store_key_unmatched"
        ),
    ]
    return as_rows(side_by_side(frames), list(RULES), "rule", "violations")


def build_silver(store: LayerStore) -> int:
    """Replace Silver from published Bronze, or leave it as it is; returns its rows."""
    tables = ("sales", "products", "stores")
    store.require([("bronze", table) for table in tables], "bronze")
    sales, products, stores = (store.table("bronze", table) for table in tables)
    enriched = enriched_sales(sales, products, stores).withColumn("loaded_at", F.current_timestamp())
    try:
        version = store.stage("silver", SILVER_TABLE, enriched)
    except JOB_ERRORS as error:
        broken = silver_violations(sales, products, stores).where("violations > 0").orderBy("position").first()
        if broken is None:
            raise
        raise StageError(RULES[broken.rule]) from error
    rows = store.staged("silver", SILVER_TABLE, version).count()
    if rows == 0 or rows != sales.count():
        store.discard("silver", SILVER_TABLE, version)
        raise StageError("the lines written to Silver are not as many as the sales in Bronze, or there are none")
    store.publish("silver", {SILVER_TABLE: version})
    return rows
