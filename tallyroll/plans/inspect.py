"""The inspection queries offered after each layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_KEYS


def gold_head(summary: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows in key order."""
    return summary.orderBy(*GOLD_KEYS).limit(rows)


def bronze_head(sales: DataFrame, rows: int = 10) -> DataFrame:
    """The first sales lines in text order; ties are broken by the columns shown."""
    shown = ("order_number", "order_date", "product_key", "store_key", "quantity")
    return (
        sales.orderBy("order_number", "line_item", *shown[1:])
        .limit(rows)
        .select(*shown)
    )


def price_text(products: DataFrame, product_key: str = "1") -> DataFrame:
    """A product's price as delivered."""
    return products.where(F.col("product_key") == product_key).select("product_key", "unit_price_usd")


def price_typed(lines: DataFrame, product_key: int = 1, rows: int = 10) -> DataFrame:
    """The first Silver lines of a product; ties are broken by the columns shown."""
    shown = ("order_number", "product_name", "quantity", "unit_price_usd", "gross_sales_usd")
    return (
        lines.where(F.col("product_key") == product_key)
        .orderBy("order_number", "line_item", *shown[1:])
        .limit(rows)
        .select(*shown)
    )


def channel_totals(summary: DataFrame) -> DataFrame:
    sums = ("units_sold", "gross_sales_usd", "estimated_gross_profit_usd")
    return summary.groupBy("sales_channel").agg(*[F.expr(f"sum({name}) AS {name}") for name in sums]).orderBy("sales_channel")


def layer_row_counts(sales: DataFrame, lines: DataFrame, summary: DataFrame) -> DataFrame:
    labelled = {"Bronze sales": sales, "Silver sales": lines, "Gold summary": summary}
    return reduce(
        DataFrame.unionByName,
        [frame.selectExpr(f"'{label}' AS layer", "count(1) AS rows") for label, frame in labelled.items()],
    )
