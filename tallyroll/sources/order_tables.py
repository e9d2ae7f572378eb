"""Order, part and supplier tables shaped as the delivered sales, product and store text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroll.functions.text import SOURCE_DATE


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, directory: str) -> DataFrame:
    # Dates become text per order, before the join repeats them per line.
    orders = table(spark, directory, "orders").selectExpr(
        "o_orderkey AS l_orderkey",
        "cast(o_custkey AS string) AS customer_key",
        f"date_format(o_orderdate, '{SOURCE_DATE}') AS order_date",
    )
    return table(spark, directory, "lineitem").join(orders, "l_orderkey").selectExpr(
        "cast(l_orderkey AS string) AS order_number",
        "cast(l_linenumber AS string) AS line_item",
        "order_date",
        f"""CASE WHEN l_suppkey <> 0 AND l_returnflag = 'N' THEN ''
                 ELSE date_format(l_shipdate, '{SOURCE_DATE}') END AS delivery_date""",
        "customer_key",
        "cast(l_suppkey AS string) AS store_key",
        "cast(l_partkey AS string) AS product_key",
        "cast(cast(l_quantity AS bigint) AS string) AS quantity",
        "'USD' AS currency_code",
    )


def products(spark: SparkSession, directory: str) -> DataFrame:
    price = "cast(p_retailprice AS decimal(12,2))"
    return table(spark, directory, "part").selectExpr(
        "cast(p_partkey AS string) AS product_key",
        "p_name AS product_name",
        "p_brand AS brand",
        "split_part(p_name, ' ', 1) AS color",
        f"'$' || format_number({price} * 0.6, 2) AS unit_cost_usd",
        f"'$' || format_number({price}, 2) AS unit_price_usd",
        "cast(p_size AS string) AS subcategory_key",
        "'size ' || p_size AS subcategory",
        "p_type AS category_key",
        "p_type AS category",
    )


def stores(spark: SparkSession, directory: str) -> DataFrame:
    nations = table(spark, directory, "nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
    return table(spark, directory, "supplier").join(nations, "s_nationkey").selectExpr(
        "cast(s_suppkey AS string) AS store_key",
        "CASE WHEN s_suppkey = 0 THEN 'Online' ELSE n_name END AS country",
        "CASE WHEN s_suppkey = 0 THEN 'Online' ELSE s_name END AS state",
        "'' AS square_meters",
        "'1/1/2008' AS open_date",
    )


def bronze_shaped(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All three sources by Bronze table name."""
    return {
        "sales": sales(spark, directory),
        "products": products(spark, directory),
        "stores": stores(spark, directory),
    }
