"""Gold: sales and estimated gross profit by month, product category and sales channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_TABLE, GOLD_TYPES, SILVER_TABLE
from tallyroll.errors import JOB_ERRORS, StageError
from tallyroll.functions.months import month_start
from tallyroll.functions.text import is_blank, or_fail
from tallyroll.operators.scalars import as_rows, side_by_side
from tallyroll.sources.layer_store import LayerStore

# Rules and what they report, in the order they are reported. Fixed values inside the messages:
# "order_date is required", "product_category is required" and "do not reconcile".
RULES = {
    "order_date": "order_date is required, and a Silver line has none",
    "product_category": "product_category is required, and a Silver line has none",
    "sales_channel": "sales_channel is required, and a Silver line has none",
}
# When a group breaks a rule: a bad line always lands in a group with a bad key.
BROKEN = {
    "order_date": "sales_month IS NULL",
    "product_category": is_blank("product_category"),
    "sales_channel": is_blank("sales_channel"),
}


def _grouped(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.expr(f"{month_start('order_date')} AS sales_month"), "product_category", "sales_channel").agg(
        F.expr("count(1) AS line_item_count"),
        F.expr("sum(quantity) AS units_sold"),
        F.expr("sum(gross_sales_usd) AS gross_sales_usd"),
        F.expr("sum(estimated_gross_profit_usd) AS estimated_gross_profit_usd"),
    )


def monthly_summary(lines: DataFrame) -> DataFrame:
    """The Gold rows; the rules are enforced on the few groups instead of every line."""
    # Every group has lines; naming their count keeps the check above the grouping.
    holds = {f"line_item_count > 0 AND NOT ({BROKEN[rule]})": RULES[rule] for rule in RULES}
    return (
        _grouped(lines)
        .where(or_fail(holds))
        .selectExpr(*[f"cast({name} AS {kind}) AS {name}" for name, kind in GOLD_TYPES.items()])
    )


def gold_violations(lines: DataFrame) -> DataFrame:
    """Silver lines per broken rule, in reporting order: (position, rule, violations)."""
    counters = _grouped(lines).selectExpr(
        *[f"coalesce(sum(CASE WHEN {broken} THEN line_item_count END), 0) AS {rule}" for rule, broken in BROKEN.items()]
    )
    return as_rows(counters, list(RULES), "rule", "violations")


_SILVER_TOTALS = {
    "silver_line_items": "count(1)",
    "silver_units": "sum(quantity)",
    "silver_sales": "sum(gross_sales_usd)",
    "silver_profit": "sum(estimated_gross_profit_usd)",
}
_GOLD_TOTALS = {
    "gold_line_items": "sum(line_item_count)",
    "gold_units": "sum(units_sold)",
    "gold_sales": "sum(gross_sales_usd)",
    "gold_profit": "sum(estimated_gross_profit_usd)",
}


def _totals(names: dict[str, str]) -> list[Column]:
    return [F.expr(total).alias(name) for name, total in names.items()]


def reconciliation(lines: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of Silver totals, Gold totals and whether all four agree (NULL never does)."""
    both = side_by_side([lines.agg(*_totals(_SILVER_TOTALS)), summary.agg(*_totals(_GOLD_TOTALS))])
    agree = " AND ".join(f"{silver} = {gold}" for silver, gold in zip(_SILVER_TOTALS, _GOLD_TOTALS, strict=True))
    return both.selectExpr("*", f"coalesce({agree}, false) AS reconciled")


def build_gold(store: LayerStore) -> int:
    """Replace Gold from published Silver, or leave it as it is; returns its rows."""
    store.require([("silver", SILVER_TABLE)], "silver")
    # The Silver totals are taken by the tasks that read Silver for Gold.
    read = Observation()
    lines = store.table("silver", SILVER_TABLE)
    observed = lines.observe(read, *_totals(_SILVER_TOTALS))
    try:
        version = store.stage("gold", GOLD_TABLE, monthly_summary(observed))
    except JOB_ERRORS as error:
        broken = gold_violations(lines).where("violations > 0").orderBy("position").first()
        if broken is None:
            raise
        raise StageError(RULES[broken.rule]) from error
    try:
        summary = store.staged("gold", GOLD_TABLE, version)
        written = summary.agg(F.count(F.lit(1)).alias("rows"), *_totals(_GOLD_TOTALS)).first()
        rows = written.rows
        if rows == 0:
            raise StageError("there are no Silver lines to sum up. Run silver first")
        if any(read.get[silver] is None or read.get[silver] != written[gold] for silver, gold in zip(_SILVER_TOTALS, _GOLD_TOTALS)):
            raise StageError("the counts or sums of Gold and Silver do not reconcile")
    except Exception:
        store.discard("gold", GOLD_TABLE, version)
        raise
    store.publish("gold", {GOLD_TABLE: version})
    return rows
