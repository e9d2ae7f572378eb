"""Bronze, Silver and Gold: values, replacement and failures that leave the old result."""

from __future__ import annotations

import json
from contextlib import contextmanager
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from fixtures import (
    ONLINE_SALE,
    ONLINE_STORE,
    PRODUCT,
    SALE,
    STORE,
    bronze,
    frame,
    replace_table,
    rows,
    write_files,
)
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_TABLE, GOLD_TYPES, PRODUCTS, SALES, SILVER_TABLE, SILVER_TYPES, STORES
from tallyroll.errors import MissingUpstreamError, StageError
from tallyroll.plans import given_tables
from tallyroll.plans import gold as gold_plan
from tallyroll.plans.bronze import load_bronze
from tallyroll.plans.forecast import monthly_history
from tallyroll.plans.gold import build_gold
from tallyroll.plans.silver import build_silver, enriched_sales, silver_violations
from tallyroll.sources.delimited import read_sources
from tallyroll.sources.layer_store import LayerStore

GOLD_VALUES = ("sales_month", "sales_channel", "units_sold", "gross_sales_usd", "estimated_gross_profit_usd")
EXPECTED_GOLD = [
    (date(2022, 11, 1), "In Store", 4, Decimal("11599.20"), Decimal("2357.00")),
    (date(2022, 12, 1), "Online", 7, Decimal("20298.60"), Decimal("4124.75")),
]


def build_all(store, **sources):
    load_bronze(store, bronze(store.spark, **sources))
    build_silver(store)
    build_gold(store)


def gold(store):
    return store.table("gold", GOLD_TABLE)


def silver(store):
    return store.table("silver", SILVER_TABLE)


def test_bronze_reload_replaces_rows_and_keeps_text(spark, store):
    sales, products = (SALE, SALE | {"line_item": "2", "product_key": "2"}), (PRODUCT, PRODUCT | {"product_key": "2"})
    for _ in range(2):
        counts = load_bronze(store, bronze(spark, sales, products, (ONLINE_STORE,)))
        assert counts == {"sales": 2, "products": 2, "stores": 1}
    assert store.table("bronze", "sales").count() == 2
    loaded = store.table("bronze", "products")
    assert {row.subcategory_key for row in loaded.collect()} == {"05"}
    assert {row.source_file for row in loaded.collect()} == {"Products.csv"}
    assert loaded.where("loaded_at IS NULL").count() == 0
    assert loaded.schema["loaded_at"].dataType.simpleString() == "timestamp"


def test_a_failed_bronze_load_replaces_no_table(spark, store):
    load_bronze(store, bronze(spark))
    before = {table: store.table("bronze", table).inputFiles() for table in ("sales", "products", "stores")}
    broken = bronze(spark) | {"stores": bronze(spark)["stores"].selectExpr("raise_error('lost') AS store_key", "*")}
    with pytest.raises(PySparkException):
        load_bronze(store, broken)
    assert {table: store.table("bronze", table).inputFiles() for table in before} == before


def test_values_and_types(store):
    for _ in range(2):
        build_all(store)
    assert rows(silver(store).orderBy("order_number"), "order_number", "delivery_date") == [(31, None), (32, date(2022, 12, 9))]
    assert rows(gold(store), *GOLD_VALUES) == EXPECTED_GOLD
    types = dict(silver(store).drop("loaded_at").dtypes)
    assert types == SILVER_TYPES
    assert dict(gold(store).dtypes) == GOLD_TYPES


def test_prices_are_rounded_once_after_multiplying(store):
    product = PRODUCT | {"unit_price_usd": "$0.335", "unit_cost_usd": "$0.001"}
    build_all(store, sales=(SALE | {"quantity": "3"},), products=(product,))
    assert rows(silver(store), "unit_price_usd", "gross_sales_usd", "estimated_gross_profit_usd") == [
        (Decimal("0.34"), Decimal("1.01"), Decimal("1.00"))
    ]


def test_keys_match_as_numbers(store):
    sale = SALE | {"product_key": " 017", "store_key": "6.0"}
    build_all(store, sales=(sale,))
    assert rows(silver(store), "product_key", "store_key", "sales_channel") == [(17, 6, "In Store")]


UNUSED = PRODUCT | {"product_key": "9"}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All layers, built once; a test that damages a Bronze table puts it right again."""
    store = LayerStore(spark, str(tmp_path_factory.mktemp("built")))
    build_all(store)
    return store


@pytest.mark.parametrize(
    "contract, changed, message",
    [
        (SALES, [SALE | {"product_key": "999"}, ONLINE_SALE], "joins failed, since a line names"),
        (SALES, [SALE | {"store_key": "999"}, ONLINE_SALE], "joins failed, since a line names"),
        (SALES, [SALE | {"order_date": "invalid"}], "sales date"),
        (SALES, [SALE | {"delivery_date": "2024-02-03"}], "sales date"),
        (SALES, [SALE | {"order_date": ""}, ONLINE_SALE], "order_date is required"),
        (SALES, [SALE | {"order_date": " "}], "sales date"),
        (SALES, [SALE | {"quantity": "0"}], "quantity is zero or less"),
        (SALES, [SALE | {"quantity": "1.5"}], "quantity has text that is no whole number"),
        (SALES, [SALE | {"customer_key": ""}], "customer_key has text that is no whole number"),
        (SALES, [SALE | {"order_number": "3000000000"}], "order_number has text that is no whole number"),
        (SALES, [], "or there are none"),
        (PRODUCTS, [PRODUCT | {"category": ""}], "product_category is required"),
        (PRODUCTS, [PRODUCT | {"category": " 　"}], "product_category is required"),
        (PRODUCTS, [PRODUCT, UNUSED | {"unit_cost_usd": "n/a"}], "unit_cost_usd has text that is no amount"),
        (PRODUCTS, [PRODUCT, UNUSED | {"unit_price_usd": ""}], "unit_price_usd has text that is no amount"),
        (PRODUCTS, [PRODUCT, PRODUCT | {"product_key": "017"}], "joins failed, since a product or store key"),
        (PRODUCTS, [PRODUCT, UNUSED, UNUSED], "joins failed, since a product or store key"),
        (PRODUCTS, [PRODUCT, UNUSED | {"product_key": "x"}], "product_key has text that is no whole number"),
        (STORES, [STORE, ONLINE_STORE, ONLINE_STORE], "joins failed, since a product or store key"),
        (STORES, [STORE, ONLINE_STORE, STORE | {"store_key": ""}], "store_key has text that is no whole number"),
    ],
)
def test_a_failed_silver_keeps_the_published_layers(spark, built, contract, changed, message):
    published = silver(built).inputFiles()
    replace_table(built, "bronze", contract.table, frame(spark, contract, changed))
    try:
        with pytest.raises(StageError, match=message):
            build_silver(built)
    finally:
        replace_table(built, "bronze", contract.table, bronze(spark)[contract.table])
    assert silver(built).inputFiles() == published
    assert len(list(Path(built.root, "silver", SILVER_TABLE).iterdir())) == 1


def test_after_failures_the_layers_hold_the_first_result(built):
    assert rows(silver(built), "order_number", "product_key") == [(31, 17), (32, 17)]
    assert rows(gold(built), *GOLD_VALUES) == EXPECTED_GOLD
    assert build_silver(built) == 2


def test_an_unsold_product_may_lack_a_category(store):
    build_all(store, products=(PRODUCT, UNUSED | {"category": ""}))
    assert silver(store).count() == 2


def test_the_first_broken_rule_is_reported(spark):
    sales = (SALE | {"order_date": "", "quantity": "-1", "product_key": "7"}, SALE | {"order_date": "soon"})
    broken = silver_violations(**bronze(spark, sales, (PRODUCT | {"unit_price_usd": "?"},))).where("violations > 0")
    found = [(row.rule, row.violations) for row in broken.orderBy("position").collect()]
    assert found == [
        ("quantity_not_positive", 1),
        ("sales_dates", 1),
        ("order_date_missing", 1),
        ("unit_price_usd", 1),
        ("product_key_unmatched", 1),
    ]


SILVER_ROW = "order_date date, product_category string, sales_channel string, quantity int, gross_sales_usd {0}, estimated_gross_profit_usd {0}"


def publish_silver(store, day=date(2023, 8, 14), category="Garden", gross="71.25", kind="decimal(14,2)"):
    row = (day, category, "In Store", 3, Decimal(gross), Decimal("18.90"))
    replace_table(store, "silver", SILVER_TABLE, store.spark.createDataFrame([row], SILVER_ROW.format(kind)))


@pytest.fixture(scope="module")
def with_gold(spark, tmp_path_factory):
    store = LayerStore(spark, str(tmp_path_factory.mktemp("gold")))
    publish_silver(store)
    build_gold(store)
    return store


def miscounted(lines, summary=gold_plan.monthly_summary):
    return summary(lines).withColumn("line_item_count", F.col("line_item_count") + 1)


@pytest.mark.parametrize(
    "changed, replaced, error, message",
    [
        ({"category": " \t"}, None, StageError, "product_category is required"),
        ({"category": None}, None, StageError, "product_category is required"),
        ({"day": None}, None, StageError, "order_date is required"),
        ({"gross": "3" * 15 + ".50", "kind": "decimal(20,2)"}, None, PySparkException, "NUMERIC_VALUE_OUT_OF_RANGE"),
        ({}, miscounted, StageError, "do not reconcile"),
    ],
)
def test_a_refused_gold_changes_no_layer(with_gold, monkeypatch, changed, replaced, error, message):
    store = with_gold
    publish_silver(store, **changed)
    before = (silver(store).inputFiles(), gold(store).inputFiles())
    if replaced:
        monkeypatch.setattr(gold_plan, "monthly_summary", replaced)
    with pytest.raises(error, match=message):
        build_gold(store)
    assert (silver(store).inputFiles(), gold(store).inputFiles()) == before


def test_gold_is_built_again_once_silver_is_right(store):
    for gross in ("71.25", "102.40"):
        publish_silver(store, gross=gross)
        assert build_gold(store) == 1
        assert rows(gold(store), "gross_sales_usd") == [(Decimal(gross),)]


BAD_TEXTS = [
    {"order_number": "abc"},
    {"line_item": "1.5"},
    {"customer_key": ""},
    {"delivery_date": "13/45/2024"},
    {"store_key": "77"},
    {"store_key": "1e-19"},
]


@pytest.mark.parametrize("changed", BAD_TEXTS)
def test_no_reader_of_silver_lines_passes_a_bad_line(spark, changed):
    """Each reads few columns; the rules of the others hold all the same."""
    lines = enriched_sales(**bronze(spark, (SALE | changed, ONLINE_SALE)))
    for read in (
        lambda: lines.count(),
        lambda: gold_plan.monthly_summary(lines).collect(),
        lambda: gold_plan.monthly_summary(lines).agg(F.sum("units_sold")).collect(),
        lambda: monthly_history(lines),
    ):
        with pytest.raises(PySparkException):
            read()


def test_a_gold_reader_of_totals_alone_needs_good_keys(spark):
    lines = enriched_sales(**bronze(spark)).withColumn("product_category", F.lit(" "))
    with pytest.raises(PySparkException, match="product_category is required"):
        gold_plan.monthly_summary(lines).agg(F.sum("units_sold")).collect()


def test_an_empty_silver_is_refused(spark, store):
    empty = spark.createDataFrame([], SILVER_ROW.format("decimal(14,2)"))
    replace_table(store, "silver", SILVER_TABLE, empty)
    with pytest.raises(StageError, match="Run silver first"):
        build_gold(store)
    assert not store.has("gold", GOLD_TABLE)


def test_missing_upstream_names_the_stage_and_creates_nothing(store):
    with pytest.raises(MissingUpstreamError, match="silver.sales_enriched is not published. Run silver first"):
        build_gold(store)
    with pytest.raises(MissingUpstreamError, match="bronze.sales, bronze.products, bronze.stores is not published. Run bronze first"):
        build_silver(store)
    assert not Path(store.root).exists()


def test_a_frame_read_before_a_publish_still_reads_its_version(store):
    build_all(store)
    before = silver(store)
    build_all(store, sales=(SALE,))
    assert (before.count(), silver(store).count()) == (2, 1)
    build_all(store)
    versions = json.loads(Path(store.root, "silver", "_CURRENT.json").read_text())
    kept = {path.name for path in Path(store.root, "silver", SILVER_TABLE).iterdir()}
    assert versions[SILVER_TABLE] in kept and len(kept) == 2


def test_one_row_files_end_to_end(spark, store, tmp_path):
    load_bronze(store, read_sources(spark, write_files(tmp_path / "sources")))
    assert (build_silver(store), build_gold(store)) == (1, 1)
    assert rows(gold(store), *GOLD_VALUES[2:]) == [(5, Decimal("45.75"), Decimal("13.75"))]


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def test_a_shuffled_join_gives_the_same_silver(spark, store):
    build_all(store)
    expected = rows(silver(store).drop("loaded_at").selectExpr("to_json(struct(*)) AS line"), "line")
    with settings(spark, SHUFFLED):
        assert build_silver(store) == 2
    assert rows(silver(store).drop("loaded_at").selectExpr("to_json(struct(*)) AS line"), "line") == expected


def test_a_hot_product_and_the_online_store_are_split(spark):
    """A third of all lines are of one product and half are online; neither is one task's work."""
    lines = spark.range(0, 60_000, numPartitions=6).selectExpr(
        "cast(id AS string) AS order_number",
        "'1' AS line_item",
        "'1/31/2024' AS order_date",
        "'' AS delivery_date",
        "'1' AS customer_key",
        "cast(if(id % 2 = 0, 0, id % 97) AS string) AS store_key",
        "cast(if(id % 3 = 0, 1, id % 89) AS string) AS product_key",
        "'2' AS quantity",
        "sha2(cast(id AS string), 512) AS currency_code",
    )
    products = frame(spark, PRODUCTS, [PRODUCT | {"product_key": str(key)} for key in range(90)])
    stores = frame(spark, STORES, [STORE | {"store_key": str(key)} for key in range(100)])
    skewed = SHUFFLED | {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    with settings(spark, skewed):
        enriched = enriched_sales(lines, products, stores)
        assert enriched.select("order_number").distinct().count() == 60_000
        enriched.write.format("noop").mode("overwrite").save()
        enriched.collect()
        plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_generated_methods_can_be_compiled(spark):
    """No method of Silver's or Gold's stages is larger than the JIT takes, nor near it."""
    seen = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for query in (given_tables.silver_lines, given_tables.gold_rows):
            plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
            stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
            assert max(stages.apply(place)._3().maxMethodCodeSize() for place in range(stages.size())) < 6000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", seen)
