"""What Silver carries through its joins, and how often queries load the sales."""

from __future__ import annotations

import pytest

from tallyroll.contracts import PRODUCTS
from tallyroll.plans import given_tables
from tallyroll.plans.gold import monthly_summary
from tallyroll.plans.silver import enriched_sales
from tallyroll.session import scratch_path
from tallyroll.sources.files import Files


def _bronze(spark, quantity="2", customer="1"):
    sales = spark.createDataFrame(
        [("1", "1", "1/31/2024", "", customer, "0", "100", quantity, "USD")],
        "order_number string, line_item string, order_date string, delivery_date string, customer_key string, "
        "store_key string, product_key string, quantity string, currency_code string",
    )
    products = spark.createDataFrame(
        [("100", "Example", "Brand", "Black", "$10.00", "$20.00", "01", "Example", "1", "Test")],
        ", ".join(f"{name} string" for name in PRODUCTS.columns.values()),
    )
    stores = spark.createDataFrame(
        [("0", "Online", "Online", "", "1/1/2020")],
        "store_key string, country string, state string, square_meters string, open_date string",
    )
    return {"sales": sales, "products": products, "stores": stores}


def test_columns_that_only_a_rule_needs_are_not_carried_through_the_joins(spark):
    bronze = {name: spark.read.parquet(_kept(spark, frame)) for name, frame in _bronze(spark).items()}
    plan = monthly_summary(enriched_sales(**bronze))._jdf.queryExecution().optimizedPlan().toString()
    above, between, below = plan.split("Join LeftOuter")
    assert "customer_key#" not in above + between and "delivery" not in above + between
    assert "customer_key#" in below


def _kept(spark, frame):
    path = scratch_path(spark, "scale")
    frame.write.parquet(path)
    return path


@pytest.mark.parametrize("spoilt", [{"quantity": "0"}, {"customer": ""}])
def test_a_plain_count_refuses_a_line_that_breaks_a_rule_of_its_own(spark, spoilt):
    assert enriched_sales(**_bronze(spark)).count() == 1
    with pytest.raises(Exception, match="zero or less|customer_key has text"):
        enriched_sales(**_bronze(spark, **spoilt)).count()


@pytest.mark.parametrize("query", ["gold_refusals", "dq_damaged_silver_gold", "dq_required_tables_not_empty"])
def test_sales_read_several_times_are_loaded_once(spark, monkeypatch, query):
    loads = []

    def load(store, sources):
        loads.append(store.root)
        return given_tables_load(store, sources)

    given_tables_load = given_tables.load_bronze
    monkeypatch.setattr(given_tables, "load_bronze", load)
    assert given_tables.queries()[query](spark, "/root/testdata/sf0.001").count() > 0
    (root,) = loads
    assert not Files(spark).exists(f"{root}/bronze")
