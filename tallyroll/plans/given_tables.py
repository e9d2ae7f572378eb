"""Every operator as a query over the given order tables.

Each query takes the session and the folder of the tables and reads them whole. Queries on
files or published layers derive them from the tables in a folder of their own first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_TABLE, GOLD_TYPES, PRODUCTS, SILVER_TABLE, SOURCES, SourceContract
from tallyroll.errors import JOB_ERRORS
from tallyroll.functions.text import in_date_range, money, no_date, source_date, stripped, whole_number, zero_padded_day
from tallyroll.plans import forecast as fc
from tallyroll.plans import drills, inspect, quality
from tallyroll.plans.bronze import load_bronze, with_lineage
from tallyroll.plans.drills import write_source
from tallyroll.plans.export import export_gold
from tallyroll.plans.gold import build_gold, gold_violations, monthly_summary, reconciliation
from tallyroll.plans.quality import CHECKS, Layers
from tallyroll.plans.silver import build_silver, enriched_sales, silver_violations
from tallyroll.session import scratch_path
from tallyroll.sources import order_tables
from tallyroll.sources.delimited import read_source
from tallyroll.sources.files import Files
from tallyroll.sources.layer_store import LayerStore
from tallyroll.sources.preflight import check_sources

Query = Callable[[SparkSession, str], DataFrame]


# Inputs derived from the given tables


def silver_lines(spark: SparkSession, directory: str) -> DataFrame:
    return enriched_sales(**order_tables.bronze_shaped(spark, directory))


def gold_rows(spark: SparkSession, directory: str) -> DataFrame:
    return monthly_summary(silver_lines(spark, directory))


def all_layers(spark: SparkSession, directory: str) -> Layers:
    return _layers(order_tables.bronze_shaped(spark, directory))


def _layers(bronze: dict[str, DataFrame]) -> Layers:
    lines = enriched_sales(**bronze)
    return Layers(**bronze, silver=lines, gold=monthly_summary(lines))


def damaged_bronze(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The Bronze text with rule-breaking values in rows picked by their own content."""
    bronze = order_tables.bronze_shaped(spark, directory)
    sales = {
        "quantity": "CASE line_item WHEN '7' THEN '-1' WHEN '6' THEN '1.5' WHEN '5' THEN '2.0' ELSE quantity END",
        "order_date": """CASE WHEN line_item = '1' AND right(store_key, 1) = '1' THEN ''
                              WHEN line_item = '2' AND right(store_key, 1) = '2' THEN 'invalid'
                              WHEN line_item = '3' AND right(store_key, 1) = '3' THEN '2024-01-31'
                              ELSE order_date END""",
        "delivery_date": """CASE WHEN line_item = '4' AND right(store_key, 1) = '4' THEN '13/45/2024'
                                 ELSE delivery_date END""",
        "product_key": """CASE WHEN line_item = '1' AND right(store_key, 1) = '5' THEN 'X' || product_key
                               WHEN line_item = '2' AND right(store_key, 1) = '6' THEN '-9' || product_key
                               ELSE product_key END""",
    }
    products = {
        "category": "if(subcategory_key = '10', '  ', category)",
        "unit_cost_usd": "if(subcategory_key = '11', 'n/a', unit_cost_usd)",
        "unit_price_usd": "if(subcategory_key = '12', '', unit_price_usd)",
    }
    marked, stores = _replaced(bronze["products"], products), bronze["stores"]
    return {
        "sales": _replaced(bronze["sales"], sales),
        "products": marked.unionByName(marked.where("subcategory_key = '13'")),
        "stores": stores.where("right(store_key, 1) <> '7'").unionByName(stores.where("right(store_key, 1) = '8'")),
    }


def damaged_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Silver lines with missing months, categories and channels."""
    return _replaced(
        silver_lines(spark, directory),
        {
            "order_date": "CASE WHEN line_item <> 1 THEN order_date END",
            "product_category": "CASE WHEN line_item = 2 THEN ' \\t' WHEN line_item <> 3 THEN product_category END",
            "sales_channel": "if(line_item = 4, '', sales_channel)",
        },
    )


# Rule-breaking text by column, in lines picked by their own content.
REFUSED_TEXTS = {
    "order_number": "if(line_item = '2', 'abc', order_number)",
    "line_item": "if(line_item = '2', '2.5', line_item)",
    "customer_key": "if(line_item = '2', '', customer_key)",
    "delivery_date": "if(line_item = '2', '13/45/2024', delivery_date)",
    "quantity": "if(line_item = '2', '1e-19', quantity)",
    "store_key": "if(line_item = '2' AND store_key <> '0', '-' || store_key, store_key)",
    "nothing": None,
}


def gold_refusals(spark: SparkSession, directory: str) -> DataFrame:
    """Whether Gold refuses the sales lines with one column's text spoilt, though it reads few of the columns."""
    store, bronze = _loaded(spark, directory)
    found = []
    for name, text in REFUSED_TEXTS.items():
        sales = _replaced(bronze["sales"], {name: text} if text else {})
        gold = monthly_summary(enriched_sales(sales, bronze["products"], bronze["stores"]))
        try:
            gold.agg(F.sum("units_sold")).collect()
            found.append((name, False))
        except JOB_ERRORS:
            found.append((name, True))
    store.drop_layer("bronze")
    return spark.createDataFrame(found, "damaged string, refused boolean")


def _replaced(frame: DataFrame, values: dict[str, str]) -> DataFrame:
    return frame.selectExpr(*[f"{values.get(name, name)} AS {name}" for name in frame.columns])


def _loaded(spark: SparkSession, directory: str) -> tuple[LayerStore, dict[str, DataFrame]]:
    """Bronze loaded once in a folder of this query's own, for queries that read the sales several times."""
    store = LayerStore(spark, scratch_path(spark, "layers"))
    load_bronze(store, order_tables.bronze_shaped(spark, directory))
    return store, {
        contract.table: store.table("bronze", contract.table).drop("loaded_at", "source_file") for contract in SOURCES
    }


def published(spark: SparkSession, directory: str) -> LayerStore:
    """All three layers, built and published in a folder of this query's own."""
    store = LayerStore(spark, scratch_path(spark, "layers"))
    load_bronze(store, order_tables.bronze_shaped(spark, directory))
    build_silver(store)
    build_gold(store)
    return store


def _finished(result: DataFrame, store: LayerStore, *files: str) -> DataFrame:
    """The result on its own, with the layers and files behind it removed."""
    kept = result.checkpoint()
    for path in files:
        Files(store.spark).delete(path)
    for layer in ("bronze", "silver", "gold", "quality"):
        store.drop_layer(layer)
    return kept


# Bronze


def scanned_source(contract: SourceContract, spark: SparkSession, directory: str) -> DataFrame:
    """One source written as delivered, then scanned as Bronze reads it."""
    folder = scratch_path(spark, "delivered")
    write_source(order_tables.bronze_shaped(spark, directory)[contract.table], folder, contract)
    return with_lineage(read_source(spark, folder, contract), contract.file_name).drop("loaded_at")


def quoted_products(spark: SparkSession, directory: str) -> DataFrame:
    """Products whose names hold commas, quotes and line breaks, in a file with its columns
    reversed and one column too many."""
    folder = scratch_path(spark, "delivered")
    name = F.concat(F.col("product_name"), F.lit(', "'), F.col("brand"), F.lit('"\n'), F.col("category"))
    frame = order_tables.products(spark, directory).withColumn("product_name", name)
    delivered = frame.select(
        F.lit("n/a").alias("Remarks"),
        *[F.col(column).alias(header) for header, column in reversed(PRODUCTS.columns.items())],
    )
    delivered.write.option("header", True).option("escape", '"').csv(f"{folder}/{PRODUCTS.file_name}")
    return read_source(spark, folder, PRODUCTS)


def preflight_summary(spark: SparkSession, directory: str) -> DataFrame:
    folder = scratch_path(spark, "delivered")
    bronze = order_tables.bronze_shaped(spark, directory)
    for contract in SOURCES:
        write_source(bronze[contract.table], folder, contract)
    return check_sources(spark, folder)


# Silver


def _renderings(frame: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Every row once per way of writing it: (rendering, text)."""
    pairs = ", ".join(f"struct('{name}' AS rendering, {text} AS text)" for name, text in texts.items())
    return frame.selectExpr(f"inline(array({pairs}))")


def int_parse(spark: SparkSession, directory: str) -> DataFrame:
    texts = {
        "plain": "cast(l_partkey AS string)",
        "padded": "'  ' || l_partkey || ' '",
        "signed": "'+' || l_partkey",
        "zeros": "'00' || l_partkey",
        "whole_decimal": "l_linenumber || '.0'",
        "exponent": "l_linenumber || 'e2'",
        "fraction": "cast(cast(l_extendedprice AS decimal(12,2)) AS string)",
        "word": "l_returnflag",
        "blank": "''",
        "too_large": "l_linenumber || '000000000'",
        "tiny": "l_linenumber || 'e-19'",
        "past_the_scale": "l_linenumber || '.0000000000000000001'",
        "zeros_past_the_scale": "l_linenumber || '.00000000000000000000'",
    }
    parsed = _renderings(order_tables.table(spark, directory, "lineitem"), texts).selectExpr(
        "rendering", f"{whole_number('text')} AS value"
    )
    return parsed.groupBy("rendering").agg(
        F.expr("count(1) AS texts"),
        F.expr("count(value) AS accepted"),
        F.expr("sum(value) AS total"),
        F.expr("min(value) AS smallest"),
        F.expr("max(value) AS largest"),
    )


def money_parse(spark: SparkSession, directory: str) -> DataFrame:
    price = "cast(p_retailprice AS decimal(12,2))"
    grouped = f"format_number({price}, 2)"
    texts = {
        "currency": f"'$' || {grouped}",
        "padded": f"' $' || {grouped} || chr(9) || ' '",
        "bare": f"cast({price} AS string)",
        "negative": f"'-$' || {grouped}",
        "long": f"{price} || '125'",
        "named": f"'USD ' || {grouped}",
        "word": "p_name",
        "blank": "' '",
        "seven_decimals": f"{price} || '00004'",
        "past_the_scale": f"{price} || '000000000000001'",
        "zeros_past_the_scale": f"{price} || '000000000000000000'",
    }
    parsed = _renderings(order_tables.table(spark, directory, "part"), texts).selectExpr(
        "rendering", f"{money('text')} AS value"
    )
    return parsed.groupBy("rendering").agg(
        F.expr("count(1) AS texts"),
        F.expr("count(value) AS accepted"),
        F.expr("cast(sum(value) AS decimal(36,16)) AS total"),
        F.expr("min(value) AS smallest"),
        F.expr("max(value) AS largest"),
    )


def date_parse(spark: SparkSession, directory: str) -> DataFrame:
    def written(pattern: str) -> str:
        return f"date_format(o_orderdate, '{pattern}')"

    texts = {
        "plain": written("M/d/yyyy"),
        "zero_padded": written("MM/dd/yyyy"),
        "trailing_space": f"{written('M/d/yyyy')} || ' '",
        "three_digits": f"'0' || {written('MM/dd/yyyy')}",
        "day_first": written("d/M/yyyy"),
        "iso": written("yyyy-MM-dd"),
        "short_year": written("M/d/yy"),
        "month_13": f"'13/' || {written('d/yyyy')}",
        "word": "o_orderpriority",
        "blank": "'  '",
    }
    parsed = _renderings(order_tables.table(spark, directory, "orders"), texts).selectExpr(
        "rendering",
        f"{source_date(zero_padded_day('text'))} AS required",
        f"{source_date(zero_padded_day(stripped('text')))} AS optional",
        f"{no_date(stripped('text'))} AS absent",
    )
    required, optional = (f"CASE WHEN {in_date_range(name)} THEN {name} END" for name in ("required", "optional"))
    return parsed.groupBy("rendering").agg(
        F.expr("count(1) AS texts"),
        F.expr(f"count({required}) AS order_dates"),
        F.expr(f"min({required}) AS first_order_date"),
        F.expr(f"max({required}) AS last_order_date"),
        F.expr(f"count({optional}) AS delivery_dates"),
        F.expr("count_if(absent) AS no_delivery_date"),
        F.expr(f"sum(datediff({optional}, DATE'1970-01-01')) AS delivery_days"),
    )


# Gold, quality and exports


def reconciled(spark: SparkSession, directory: str) -> DataFrame:
    lines = silver_lines(spark, directory)
    return reconciliation(lines, monthly_summary(lines))


def published_gold(spark: SparkSession, directory: str) -> DataFrame:
    store = published(spark, directory)
    return _finished(store.table("gold", GOLD_TABLE), store)


def published_row_counts(spark: SparkSession, directory: str) -> DataFrame:
    store = published(spark, directory)
    counts = inspect.layer_row_counts(
        store.table("bronze", "sales"), store.table("silver", SILVER_TABLE), store.table("gold", GOLD_TABLE)
    )
    return _finished(counts, store)


def exported_gold(spark: SparkSession, directory: str) -> DataFrame:
    """The export as a reader of the CSV sees it."""
    store, target = published(spark, directory), f"{scratch_path(spark, 'export')}/{GOLD_TABLE}.csv"
    export_gold(store, target)
    schema = ", ".join(f"{name} {kind}" for name, kind in GOLD_TYPES.items())
    return _finished(spark.read.schema(schema).option("header", True).csv(target), store, target)


def one_check(check: quality.Check, spark: SparkSession, directory: str) -> DataFrame:
    if len(check.counts) == 1:
        return quality.check_results(all_layers(spark, directory), (check,))
    # Several layers are compared, so the sales are read more than once.
    store, bronze = _loaded(spark, directory)
    return _finished(quality.check_results(_layers(bronze), (check,)), store)


def damaged_bronze_checks(spark: SparkSession, directory: str) -> DataFrame:
    """The Bronze checks on damaged text, beside the undamaged Silver and Gold."""
    layers = replace(all_layers(spark, directory), **damaged_bronze(spark, directory))
    return quality.check_results(layers, tuple(check for check in CHECKS if check.layer == "bronze"))


def damaged_silver_gold_checks(spark: SparkSession, directory: str) -> DataFrame:
    """The other checks on spoilt Silver lines, a Gold with repeated rows, and no stores."""
    store, bronze = _loaded(spark, directory)
    layers = _layers(bronze)
    spoilt = {
        "delivery_date": "if(line_item = 1 AND store_key <> 0, date_sub(order_date, 1), delivery_date)",
        "sales_channel": "CASE line_item WHEN 2 THEN NULL WHEN 3 THEN 'Phone' WHEN 4 THEN 'Online' ELSE sales_channel END",
        "gross_sales_usd": "CASE WHEN line_item <> 5 THEN gross_sales_usd END",
    }
    layers = replace(
        layers,
        silver=_replaced(layers.silver.where("line_item <> 6"), spoilt),
        gold=layers.gold.selectExpr("*", "explode(sequence(1, if(sales_channel = 'In Store', 2, 1))) AS copy").drop("copy"),
        stores=layers.stores.where("false"),
    )
    return _finished(quality.check_results(layers, tuple(check for check in CHECKS if check.layer != "bronze")), store)


def audited_checks(spark: SparkSession, directory: str) -> DataFrame:
    """All checks as recorded in the audit table."""
    store = published(spark, directory)
    quality.run_checks(store)
    return _finished(quality.audit(store).drop("run_id", "checked_at"), store)


def latest_audit(spark: SparkSession, directory: str) -> DataFrame:
    """The newer of two recorded runs, beside how many results the audit table holds."""
    store = published(spark, directory)
    quality.run_checks(store)
    newest, _ = quality.run_checks(store)
    latest = quality.latest_results(quality.audit(store))
    recorded = quality.audit(store).agg(F.count(F.lit(1)))
    result = latest.select(
        "check_name",
        "status",
        "failed_rows",
        "total_rows",
        (F.col("run_id") == newest).alias("is_newest_run"),
        recorded.scalar().alias("recorded_results"),
    )
    return _finished(result, store)


def run_identity(spark: SparkSession, directory: str) -> DataFrame:
    store = published(spark, directory)
    return _finished(drills.run_identity(store), store)


# Inspection


def price_text_vs_typed(spark: SparkSession, directory: str) -> DataFrame:
    """A product's price as delivered beside the value its Silver lines carry."""
    text = inspect.price_text(order_tables.products(spark, directory))
    typed = inspect.price_typed(silver_lines(spark, directory))
    return text.selectExpr("'text' AS form", "unit_price_usd AS price").unionByName(
        typed.selectExpr("'typed' AS form", "cast(unit_price_usd AS string) AS price")
    )


# Forecast


def _panel(spark: SparkSession, directory: str) -> tuple[fc.History, DataFrame]:
    history = fc.monthly_history(silver_lines(spark, directory))
    return history, fc.complete_panel(history)


def _shown(features: DataFrame) -> DataFrame:
    mean = "previous_3_month_average"
    return features.withColumn(mean, F.round(mean, 4))


def panel_features(spark: SparkSession, directory: str) -> DataFrame:
    return _shown(fc.usable(fc.with_features(_panel(spark, directory)[1])))


def temporal_split(spark: SparkSession, directory: str) -> DataFrame:
    history, panel = _panel(spark, directory)
    train, test = fc.split(fc.usable(fc.with_features(panel)), history)
    parts = train.selectExpr("'train' AS part", "*").unionByName(test.selectExpr("'holdout' AS part", "*"))
    return parts.groupBy("part").agg(
        F.expr("count(1) AS rows"),
        F.expr("count(DISTINCT sales_month) AS months"),
        F.expr("min(sales_month) AS first_month"),
        F.expr("max(sales_month) AS last_month"),
        F.expr("cast(sum(cast(gross_sales_usd AS decimal(20,2))) AS decimal(30,2)) AS gross_sales_usd"),
    )


def _naive_holdout(spark: SparkSession, directory: str) -> DataFrame:
    history, panel = _panel(spark, directory)
    return fc.with_naive(fc.split(fc.usable(fc.with_features(panel)), history)[1])


def naive_holdout(spark: SparkSession, directory: str) -> DataFrame:
    return _naive_holdout(spark, directory).select(*fc.GOLD_KEYS, fc.TARGET, "seasonal_naive_usd")


def next_month_rows(spark: SparkSession, directory: str) -> DataFrame:
    history, panel = _panel(spark, directory)
    return _shown(fc.next_month_features(panel, history.next_month))


def naive_next_month(spark: SparkSession, directory: str) -> DataFrame:
    return fc.with_naive(next_month_rows(spark, directory)).select(*fc.GOLD_KEYS, "seasonal_naive_usd")


def ridge_optimality(spark: SparkSession, directory: str) -> DataFrame:
    """The features of the ridge model, and how far each one's equation is from holding."""
    return fc.Backtest(silver_lines(spark, directory)).optimality().selectExpr("feature", "round(gap, 6) AS gap")


def holdout_optimality(spark: SparkSession, directory: str) -> DataFrame:
    """The same of the model that never sees the holdout."""
    return fc.Backtest(silver_lines(spark, directory)).holdout_optimality().selectExpr("feature", "round(gap, 6) AS gap")


def _adds_up(explained: DataFrame) -> DataFrame:
    """Whether each prediction is the sum of what its features bring, and zero where that is below zero."""
    parts = " + ".join(f"{name}_usd" for name in ("intercept", *fc.NUMERIC, *fc.CATEGORICAL))
    return explained.selectExpr(
        *fc.GOLD_KEYS,
        "seasonal_naive_usd",
        f"abs(model_usd - greatest({parts}, 0)) <= 1e-9 * greatest(abs({parts}), 1) AS adds_up",
    )


def holdout_parts(spark: SparkSession, directory: str) -> DataFrame:
    return _adds_up(fc.Backtest(silver_lines(spark, directory)).explained_holdout())


def next_month_parts(spark: SparkSession, directory: str) -> DataFrame:
    return _adds_up(fc.Backtest(silver_lines(spark, directory)).explained_next_month())


def summary_errors(spark: SparkSession, directory: str) -> DataFrame:
    """Whether the reported errors of the ridge model are those of its predictions, beside last year's value's."""
    tested = fc.Backtest(silver_lines(spark, directory))
    again = tested.holdout().selectExpr(
        "round(avg(abs(gross_sales_usd - model_usd)), 2) AS mae",
        "round(try_divide(100 * sum(abs(gross_sales_usd - model_usd)), sum(gross_sales_usd)), 2) AS wape",
    ).first()
    return tested.summary().select(
        F.col("baseline.mae_usd").alias("naive_mae_usd"),
        F.col("baseline.wape_percent").alias("naive_wape_percent"),
        F.col("ridge_model.mae_usd").eqNullSafe(F.lit(again.mae)).alias("ridge_mae_agrees"),
        F.col("ridge_model.wape_percent").eqNullSafe(F.lit(again.wape)).alias("ridge_wape_agrees"),
        "holdout_start",
        "holdout_end",
        "next_forecast_month",
    )


def selection(spark: SparkSession, directory: str) -> DataFrame:
    """Whether the errors name the winner, and the next month's figure is that method's, never below zero."""
    tested = fc.Backtest(silver_lines(spark, directory))
    naive, ridge = tested.errors
    upcoming, summary = tested.next_month(), tested.summary().first()
    won = "model_usd" if ridge.mae_usd < naive.mae_usd else "seasonal_naive_usd"
    return upcoming.selectExpr(
        "product_category",
        "sales_channel",
        f"selected_forecast_usd = {won} AS follows_the_errors",
        f"'{summary.selected_method}' = '{fc.RIDGE if won == 'model_usd' else fc.NAIVE}' AS named_in_the_summary",
        "model_usd >= 0 AS not_below_zero",
    )


def _forecast_files(spark: SparkSession, directory: str) -> tuple[str, LayerStore]:
    store, target = published(spark, directory), scratch_path(spark, "forecasts")
    fc.run_forecast(store, target)
    return target, store


def forecast_files(spark: SparkSession, directory: str) -> DataFrame:
    """Keys and last year's value as a reader of both CSV files finds them, numbered in file order."""
    target, store = _forecast_files(spark, directory)
    order = Window.orderBy("part", "place")
    columns = [*fc.GOLD_KEYS, "seasonal_naive_usd"]
    files = [
        spark.read.option("header", True)
        .csv(f"{target}/{name}.csv")
        .select(F.lit(name).alias("file"), *columns, F.input_file_name().alias("part"), F.monotonically_increasing_id().alias("place"))
        .select("file", F.row_number().over(order).alias("position"), *columns)
        for name in ("holdout_predictions", "next_month_forecast")
    ]
    return _finished(files[0].unionByName(files[1]), store, target)


def forecast_metrics_file(spark: SparkSession, directory: str) -> DataFrame:
    """The fields of the metrics file that do not depend on the model."""
    target, store = _forecast_files(spark, directory)
    read = spark.read.json(f"{target}/metrics.json").selectExpr(
        "target",
        "source",
        "last_complete_month",
        "excluded_partial_month",
        "holdout_start",
        "holdout_end",
        "holdout_method",
        "baseline.mae_usd AS baseline_mae_usd",
        "baseline.wape_percent AS baseline_wape_percent",
        "next_forecast_month",
        "note",
    )
    return _finished(read, store, target)


def queries() -> dict[str, Query]:
    """All queries by name."""
    return {
        "gold_monthly_sales_summary": gold_rows,
        "silver_sales_enriched": silver_lines,
        **{f"bronze_{contract.table}": partial(scanned_source, contract) for contract in SOURCES},
        "csv_quoted_products": quoted_products,
        "preflight_summary": preflight_summary,
        "preflight_rejections": drills.preflight_rejections,
        "silver_int_parse": int_parse,
        "silver_money_parse": money_parse,
        "silver_date_parse": date_parse,
        "silver_violations": lambda spark, at: silver_violations(**order_tables.bronze_shaped(spark, at)),
        "silver_violations_damaged": lambda spark, at: silver_violations(**damaged_bronze(spark, at)),
        "gold_violations": lambda spark, at: gold_violations(silver_lines(spark, at)),
        "gold_violations_damaged": lambda spark, at: gold_violations(damaged_lines(spark, at)),
        "gold_refusals": gold_refusals,
        "gold_reconciliation": reconciled,
        "published_gold": published_gold,
        "layer_row_counts": published_row_counts,
        "gold_export_rows": exported_gold,
        **{f"dq_{check.name}": partial(one_check, check) for check in CHECKS},
        "dq_damaged_bronze": damaged_bronze_checks,
        "dq_damaged_silver_gold": damaged_silver_gold_checks,
        "dq_check_results": audited_checks,
        "dq_latest_run": latest_audit,
        "dq_run_identity": run_identity,
        "stage_gates": drills.stage_gates,
        "failed_runs": drills.failed_runs,
        "inspect_gold_head": lambda spark, at: inspect.gold_head(gold_rows(spark, at)),
        "inspect_bronze_head": lambda spark, at: inspect.bronze_head(order_tables.sales(spark, at)),
        "inspect_price_text": lambda spark, at: inspect.price_text(order_tables.products(spark, at)),
        "inspect_price_typed": lambda spark, at: inspect.price_typed(silver_lines(spark, at)),
        "inspect_price_text_vs_typed": price_text_vs_typed,
        "inspect_channel_totals": lambda spark, at: inspect.channel_totals(gold_rows(spark, at)),
        "forecast_last_complete_month": lambda spark, at: fc.latest_order(silver_lines(spark, at)),
        "forecast_monthly_sales": lambda spark, at: fc.monthly_history(silver_lines(spark, at)).monthly,
        "forecast_panel": lambda spark, at: _panel(spark, at)[1],
        "forecast_features": panel_features,
        "forecast_split": temporal_split,
        "forecast_holdout_naive": naive_holdout,
        "forecast_naive_metrics": lambda spark, at: fc.error_metrics(_naive_holdout(spark, at), "seasonal_naive_usd"),
        "forecast_next_month_features": next_month_rows,
        "forecast_next_month_naive": naive_next_month,
        "forecast_holdout_ridge": lambda spark, at: fc.Backtest(silver_lines(spark, at)).holdout(),
        "forecast_next_month": lambda spark, at: fc.Backtest(silver_lines(spark, at)).next_month(),
        "forecast_ridge_optimality": ridge_optimality,
        "forecast_holdout_optimality": holdout_optimality,
        "forecast_holdout_parts": holdout_parts,
        "forecast_next_month_parts": next_month_parts,
        "forecast_summary_errors": summary_errors,
        "forecast_selection": selection,
        "forecast_files": forecast_files,
        "forecast_metrics_file": forecast_metrics_file,
        "forecast_summary": lambda spark, at: fc.Backtest(silver_lines(spark, at)).summary(),
    }
