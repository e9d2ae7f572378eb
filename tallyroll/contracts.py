"""Source headers, layer schemas and table names.

Everything here is a fixed value: the headers are those of the delivered files and the
types are the published shape of each layer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceContract:
    """One delivered file: its name, its Bronze table and header -> column, in order."""

    file_name: str
    table: str
    columns: dict[str, str]

    @property
    def headers(self) -> list[str]:
        return list(self.columns)

    @property
    def names(self) -> list[str]:
        return list(self.columns.values())


SALES = SourceContract(
    "Sales.csv",
    "sales",
    {
        "Order Number": "order_number",
        "Line Item": "line_item",
        "Order Date": "order_date",
        "Delivery Date": "delivery_date",
        "CustomerKey": "customer_key",
        "StoreKey": "store_key",
        "ProductKey": "product_key",
        "Quantity": "quantity",
        "Currency Code": "currency_code",
    },
)
PRODUCTS = SourceContract(
    "Products.csv",
    "products",
    {
        "ProductKey": "product_key",
        "Product Name": "product_name",
        "Brand": "brand",
        "Color": "color",
        "Unit Cost USD": "unit_cost_usd",
        "Unit Price USD": "unit_price_usd",
        "SubcategoryKey": "subcategory_key",
        "Subcategory": "subcategory",
        "CategoryKey": "category_key",
        "Category": "category",
    },
)
STORES = SourceContract(
    "Stores.csv",
    "stores",
    {
        "StoreKey": "store_key",
        "Country": "country",
        "State": "state",
        "Square Meters": "square_meters",
        "Open Date": "open_date",
    },
)
SOURCES = (SALES, PRODUCTS, STORES)

LAYERS = ("bronze", "silver", "gold")
SILVER_TABLE = "sales_enriched"
GOLD_TABLE = "monthly_sales_summary"
# The tables with a row for each sales line, by layer.
LINE_TABLES = {("bronze", "sales"), ("silver", SILVER_TABLE)}

GOLD_KEYS = ("sales_month", "product_category", "sales_channel")
GOLD_TYPES = {
    "sales_month": "date",
    "product_category": "string",
    "sales_channel": "string",
    "line_item_count": "bigint",
    "units_sold": "bigint",
    "gross_sales_usd": "decimal(16,2)",
    "estimated_gross_profit_usd": "decimal(16,2)",
}

SILVER_TYPES = {
    "order_number": "int",
    "line_item": "int",
    "order_date": "date",
    "delivery_date": "date",
    "customer_key": "int",
    "store_key": "int",
    "product_key": "int",
    "quantity": "int",
    "currency_code": "string",
    "product_name": "string",
    "brand": "string",
    "product_subcategory": "string",
    "product_category": "string",
    "unit_cost_usd": "decimal(12,2)",
    "unit_price_usd": "decimal(12,2)",
    "store_country": "string",
    "store_state": "string",
    "sales_channel": "string",
    "gross_sales_usd": "decimal(14,2)",
    "estimated_gross_profit_usd": "decimal(14,2)",
}

ONLINE_STORE_KEY = 0
ONLINE = "Online"
IN_STORE = "In Store"

CHECK_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("checked_at", T.TimestampType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("failed_rows", T.LongType(), False),
        T.StructField("total_rows", T.LongType(), False),
        T.StructField("failure_rate", T.DoubleType(), False),
        T.StructField("description", T.StringType(), False),
    ]
)
