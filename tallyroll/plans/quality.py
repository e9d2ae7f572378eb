"""The recorded table checks over the published layers.

A check compares a few counts. Those of Bronze come from one aggregate over all its keys, those of
Silver and Gold from one each, so every table is read once for all the checks that need it. The
one-row results are put side by side and every check becomes one row, all in a single job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyroll.contracts import CHECK_RESULT_SCHEMA, GOLD_KEYS, GOLD_TABLE, IN_STORE, ONLINE, SILVER_TABLE
from tallyroll.functions.text import positive_integer
from tallyroll.operators.keys import KeySet, key_counts
from tallyroll.operators.scalars import side_by_side
from tallyroll.sources.files import Files
from tallyroll.sources.layer_store import LayerStore


@dataclass(frozen=True)
class Layers:
    """The five core tables."""

    sales: DataFrame
    products: DataFrame
    stores: DataFrame
    silver: DataFrame
    gold: DataFrame


@dataclass(frozen=True)
class Check:
    """A named rule: ``failed`` of ``total`` rows break it, as SQL over the counts it needs."""

    name: str
    layer: str
    severity: str
    description: str
    counts: tuple[str, ...]
    failed: str
    total: str


def _bronze_counts(layers: Layers, wanted: set[str]) -> DataFrame:
    """The counts of Bronze that checks want, with one reading of each table they need."""
    bad = {"bad_quantities": f"NOT {positive_integer('quantity')}"}
    # Which keys are counted, and whether that needs the sales.
    sales_wanted = wanted & {"grain", "product_matches", "store_matches"}
    keys = []
    if "grain" in wanted:
        keys.append(KeySet("grain", ("order_number", "line_item"), conditions=bad if "quantities" in wanted else {}))
    elif "quantities" in wanted:
        # No key is needed: all lines are one group, folded by the tasks that read them.
        keys.append(KeySet("grain", ("NULL",), conditions=bad))
        sales_wanted.add("quantities")
    for name, table in (("product", layers.products), ("store", layers.stores)):
        if wanted & {f"{name}s", f"{name}_matches"}:
            keys.append(KeySet(name, (f"{name}_key",), table))
    return key_counts(layers.sales if sales_wanted else None, keys)


def _silver_counts(layers: Layers) -> DataFrame:
    money = ("unit_cost_usd", "unit_price_usd", "gross_sales_usd", "estimated_gross_profit_usd")
    incomplete = " OR ".join(f"{name} IS NULL" for name in money)
    online = f"sales_channel = '{ONLINE}'"
    return layers.silver.selectExpr(
        "count(1) AS silver_rows",
        "count_if(delivery_date < order_date) AS early_deliveries",
        f"count_if({online}) AS online_rows",
        f"count_if({online} AND delivery_date IS NULL) AS online_undelivered",
        f"count_if({incomplete}) AS incomplete_measures",
        f"count_if(sales_channel IS NULL OR sales_channel NOT IN ('{ONLINE}', '{IN_STORE}')) AS unknown_channels",
        "sum(quantity) AS silver_units",
        "sum(gross_sales_usd) AS silver_sales",
        "sum(estimated_gross_profit_usd) AS silver_profit",
    )


def _gold_counts(layers: Layers) -> DataFrame:
    per_key = layers.gold.groupBy(*GOLD_KEYS).agg(
        F.expr("count(1) AS n"),
        F.expr("sum(units_sold) AS units"),
        F.expr("sum(gross_sales_usd) AS sales"),
        F.expr("sum(estimated_gross_profit_usd) AS profit"),
    )
    return per_key.selectExpr(
        "coalesce(sum(n), 0) AS gold_rows",
        "coalesce(sum(n - 1), 0) AS gold_excess",
        "sum(units) AS gold_units",
        "sum(sales) AS gold_sales",
        "sum(profit) AS gold_profit",
    )


# What a check may count: in Bronze, all in one reading, and in the later layers.
BRONZE_COUNTS = ("quantities", "grain", "products", "stores", "product_matches", "store_matches")
LATER_COUNTS: dict[str, Callable[[Layers], DataFrame]] = {"silver": _silver_counts, "gold": _gold_counts}

_EMPTY_TABLES = " + ".join(
    f"cast({rows} = 0 AS int)" for rows in ("grain_lines", "product_rows", "store_rows", "silver_rows", "gold_rows")
)
_TOTALS_DIFFER = """CASE WHEN silver_units = gold_units AND silver_sales = gold_sales
                              AND silver_profit = gold_profit THEN 0 ELSE 1 END"""

# Names, layers, severities and descriptions of the recorded checks.
CHECKS = (
    Check("required_tables_not_empty", "all", "critical",
          "The five core pipeline tables contain at least one row.",
          ("quantities", "products", "stores", "silver", "gold"), _EMPTY_TABLES, "5"),
    Check("sales_grain_unique", "bronze", "critical",
          "Each order number and line item identifies one sales row.",
          ("grain",), "grain_excess", "grain_lines"),
    Check("product_key_unique", "bronze", "critical",
          "Each product key identifies one product row.",
          ("products",), "product_repeats", "product_rows"),
    Check("store_key_unique", "bronze", "critical",
          "Each store key identifies one store row.",
          ("stores",), "store_repeats", "store_rows"),
    Check("sales_product_keys_match", "bronze", "critical",
          "Every sales product key matches the product dimension.",
          ("product_matches",), "product_unmatched", "product_joined"),
    Check("sales_store_keys_match", "bronze", "critical",
          "Every sales store key matches the store dimension.",
          ("store_matches",), "store_unmatched", "store_joined"),
    Check("quantity_positive_integer", "bronze", "high",
          "Sales quantity is a positive integer.",
          ("quantities",), "bad_quantities", "grain_lines"),
    Check("delivery_not_before_order", "silver", "high",
          "A populated delivery date is on or after the order date.",
          ("silver",), "early_deliveries", "silver_rows"),
    Check("online_orders_have_delivery_date", "silver", "high",
          "Online orders have a delivery date.",
          ("silver",), "online_undelivered", "online_rows"),
    Check("silver_row_count_matches_bronze", "silver", "critical",
          "The Silver join neither loses nor multiplies sales rows.",
          ("quantities", "silver"),
          "abs(silver_rows - grain_lines)", "greatest(silver_rows, grain_lines)"),
    Check("silver_measures_complete", "silver", "high",
          "Silver price, cost, sales, and estimated-profit measures are populated.",
          ("silver",), "incomplete_measures", "silver_rows"),
    Check("sales_channel_allowed_values", "silver", "high",
          "Sales channel is either Online or In Store.",
          ("silver",), "unknown_channels", "silver_rows"),
    Check("gold_grain_unique", "gold", "critical",
          "Each month, product category, and channel appears once in Gold.",
          ("gold",), "gold_excess", "gold_rows"),
    Check("gold_totals_match_silver", "gold", "critical",
          "Gold units, sales, and estimated profit reconcile to Silver.",
          ("silver", "gold"), _TOTALS_DIFFER, "1"),
)


def check_results(layers: Layers, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """One row per check, in the given order, without run columns."""
    wanted = {name for check in checks for name in check.counts}
    frames = [counts(layers) for name, counts in LATER_COUNTS.items() if name in wanted]
    if wanted & set(BRONZE_COUNTS):
        frames.append(_bronze_counts(layers, wanted))
    counts = side_by_side(frames)
    rows = ", ".join(
        f"""struct('{check.name}' AS check_name, '{check.layer}' AS layer, '{check.severity}' AS severity,
                   cast({check.failed} AS bigint) AS failed_rows, cast({check.total} AS bigint) AS total_rows,
                   '{check.description}' AS description)"""
        for check in checks
    )
    return counts.selectExpr(f"inline(array({rows}))").selectExpr(
        "check_name",
        "layer",
        "severity",
        "CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status",
        "failed_rows",
        "total_rows",
        "coalesce(try_divide(cast(failed_rows AS double), cast(total_rows AS double)), 0D) AS failure_rate",
        "description",
    )


def published_layers(store: LayerStore) -> Layers:
    bronze = ("sales", "products", "stores")
    store.require([("bronze", table) for table in bronze], "bronze")
    store.require([("silver", SILVER_TABLE)], "silver")
    store.require([("gold", GOLD_TABLE)], "gold")
    return Layers(
        *[store.table("bronze", table) for table in bronze],
        silver=store.table("silver", SILVER_TABLE),
        gold=store.table("gold", GOLD_TABLE),
    )


def run_checks(store: LayerStore) -> tuple[str, list[Row]]:
    """Run every check, append the results to the audit table, and return them.

    The results are one small file per run, added by one atomic rename.
    """
    layers = published_layers(store)
    run_id, checked_at = str(uuid.uuid4()), datetime.now(timezone.utc)
    results = check_results(layers).select(
        F.lit(run_id).alias("run_id"), F.lit(checked_at).alias("checked_at"), "*"
    )
    results.select(*CHECK_RESULT_SCHEMA.names).coalesce(1).write.mode("append").parquet(_results_path(store))
    return run_id, audit(store).where(F.col("run_id") == run_id).collect()


def audit(store: LayerStore) -> DataFrame:
    """Every recorded result of every run."""
    return store.spark.read.schema(CHECK_RESULT_SCHEMA).parquet(_results_path(store))


def latest_results(results: DataFrame) -> DataFrame:
    """The results of the run that was checked last."""
    newest = results.agg(F.max_by("run_id", "checked_at"))
    return results.where(F.col("run_id") == newest.scalar())


def register_views(store: LayerStore) -> None:
    """``quality.check_results`` and ``quality.latest_check_results`` for SQL users."""
    path = _results_path(store)
    if not Files(store.spark).exists(path):
        return
    store.spark.sql("CREATE SCHEMA IF NOT EXISTS quality")
    store.spark.sql(f"CREATE OR REPLACE VIEW quality.check_results AS SELECT * FROM parquet.`{path}`")
    store.spark.sql(
        "CREATE OR REPLACE VIEW quality.latest_check_results AS SELECT * FROM quality.check_results "
        "WHERE run_id = (SELECT max_by(run_id, checked_at) FROM quality.check_results)"
    )


def _results_path(store: LayerStore) -> str:
    return f"{store.root}/quality/check_results"
