"""Monthly forecast per product category and channel: a ridge model against last year's value.

Only the first step touches the sales lines, and it reads them once: it sums them to one row
per month and segment, kept with a checkpoint because the model passes over it many times.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_KEYS, SILVER_TABLE
from tallyroll.errors import StageError
from tallyroll.functions.months import last_complete_month, month_start
from tallyroll.operators.panel import lagged, zero_filled
from tallyroll.session import shared_folder
from tallyroll.sources.exports import replace_csv, replace_json, two_decimals
from tallyroll.sources.layer_store import LayerStore

SEGMENT = ["product_category", "sales_channel"]
MONTH = "sales_month"
TARGET = "gross_sales_usd"
NUMERIC = ["lag_1", "lag_12", "previous_3_month_average"]
CATEGORICAL = [*SEGMENT, "month_number"]

# The length of the holdout, the ridge penalty and the reported texts.
HOLDOUT_MONTHS = 12
PENALTY = 10.0
RIDGE = "ridge_model"
NAIVE = "seasonal_naive"
TARGET_TEXT = "monthly gross sales USD by product category and sales channel"
METHOD_TEXT = "one-month-ahead predictions using actual prior months; no refit during holdout"
NOTE_TEXT = "Historical fictional data; this is a teaching experiment, not a current sales forecast."

# The normal-equation solver of Spark ML takes at most this many features; the channels and
# months take sixteen of them beside the amounts.
MOST_FEATURES = 4096


@dataclass(frozen=True)
class History:
    """Monthly sales per segment over complete months, and the months they span."""

    monthly: DataFrame
    first_month: date
    last_month: date
    excluded_month: date | None
    next_month: date


def latest_order(lines: DataFrame) -> DataFrame:
    """One row: the last complete month, and the partial month left out after it, if any."""
    return lines.selectExpr("max(order_date) AS latest_order_date").selectExpr(
        "latest_order_date", *_month_bounds("latest_order_date")
    )


def _month_bounds(latest: str) -> list[str]:
    complete, current = last_complete_month(latest), month_start(latest)
    return [
        f"{complete} AS last_complete_month",
        f"CASE WHEN {current} > {complete} THEN {current} END AS excluded_partial_month",
        f"add_months({complete}, 1) AS next_month",
    ]


def monthly_history(lines: DataFrame) -> History:
    """Sum the lines by month and segment, and leave out a partial last month."""
    shared_folder(lines.sparkSession)
    by_month = (
        lines.groupBy(F.expr(f"{month_start('order_date')} AS {MONTH}"), *SEGMENT)
        .agg(F.expr(f"cast(sum({TARGET}) AS double) AS {TARGET}"), F.expr("max(order_date) AS latest"))
        .checkpoint()
    )
    bounds = (
        by_month.selectExpr("max(latest) AS latest", f"min({MONTH}) AS first_month")
        .selectExpr("latest", "first_month", *_month_bounds("latest"))
        .first()
    )
    if bounds.latest is None:
        raise StageError("there are no Silver lines to forecast from. Run silver first")
    if bounds.first_month > bounds.last_complete_month:
        raise StageError("the Silver lines hold no complete month")
    monthly = by_month.where(f"{MONTH} <= DATE'{bounds.last_complete_month}'").select(MONTH, *SEGMENT, TARGET)
    return History(
        monthly, bounds.first_month, bounds.last_complete_month, bounds.excluded_partial_month, bounds.next_month
    )


def complete_panel(history: History) -> DataFrame:
    """Every complete month of every segment; a month without sales counts as zero."""
    return zero_filled(history.monthly, SEGMENT, MONTH, TARGET, history.first_month, history.last_month)


def with_features(panel: DataFrame) -> DataFrame:
    return lagged(panel, SEGMENT, MONTH, TARGET)


def usable(features: DataFrame) -> DataFrame:
    """Rows whose lags are all known."""
    return features.na.drop(subset=NUMERIC)


def next_month_features(panel: DataFrame, next_month: date) -> DataFrame:
    """One row per segment for the month after the panel, its target unknown."""
    future = panel.select(*SEGMENT).distinct().selectExpr(
        f"DATE'{next_month}' AS {MONTH}", *SEGMENT, f"cast(NULL AS double) AS {TARGET}"
    )
    return with_features(panel.unionByName(future)).where(f"{MONTH} = DATE'{next_month}'")


def holdout_start(history: History) -> str:
    """First of the last twelve months, as SQL; the panel has no gaps."""
    return f"add_months(DATE'{history.last_month}', {1 - HOLDOUT_MONTHS})"


def split(rows: DataFrame, history: History) -> tuple[DataFrame, DataFrame]:
    start = holdout_start(history)
    return rows.where(f"{MONTH} < {start}"), rows.where(f"{MONTH} >= {start}")


def with_naive(features: DataFrame) -> DataFrame:
    return features.withColumn("seasonal_naive_usd", F.col("lag_12"))


def error_metrics(predicted: DataFrame, column: str) -> DataFrame:
    """One row: mean absolute error, and the absolute error as a percentage of actual sales."""
    error = f"abs({TARGET} - {column})"
    return predicted.selectExpr(
        f"round(avg({error}), 2) AS mae_usd",
        f"round(try_divide(100 * sum({error}), sum({TARGET})), 2) AS wape_percent",
    )


class RidgeModel:
    """Ridge regression on scaled amounts and one-hot labels, the intercept not penalised."""

    def __init__(self, train: DataFrame):
        stats = train.agg(
            F.count(F.lit(1)).alias("n"),
            F.stddev_pop(TARGET).alias("target_sd"),
            *[F.avg(name).alias(f"{name}_mean") for name in NUMERIC],
            *[F.stddev_pop(name).alias(f"{name}_sd") for name in NUMERIC],
            F.count_distinct(SEGMENT[0]).alias("categories"),
        ).first()
        self._scaled = {
            f"{name}_scaled": (F.col(name) - stats[f"{name}_mean"]) / (stats[f"{name}_sd"] or 1.0) for name in NUMERIC
        }
        if stats.categories + len(NUMERIC) + 16 > MOST_FEATURES:
            raise StageError(f"{stats.categories} product categories are more than the ridge model can hold.")
        indexed, encoded = [f"{name}_index" for name in CATEGORICAL], [f"{name}_onehot" for name in CATEGORICAL]
        self._model: PipelineModel = Pipeline(
            stages=[
                # An unseen label gets the extra index, which dropLast turns into all zeros.
                StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
                OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
                VectorAssembler(inputCols=[*self._scaled, *encoded], outputCol="features"),
                LinearRegression(
                    labelCol=TARGET,
                    predictionCol="ridge_usd",
                    elasticNetParam=0.0,
                    # Spark divides the squared error by n and the target by its deviation, so the
                    # penalty it takes is the ridge penalty scaled by both.
                    regParam=PENALTY / stats.n * (stats.target_sd or 1.0),
                    standardization=False,
                    solver="normal",
                ),
            ]
        ).fit(train.withColumns(self._scaled))

    def optimality(self, train: DataFrame) -> DataFrame:
        """Per feature of the training rows, how far the penalised normal equations are from holding.

        At the optimum a feature's sum of residuals equals the penalty times its weight, and the
        residuals themselves add up to zero. The gap is a share of the target's total.
        """
        rows = self._model.transform(train.withColumns(self._scaled)).withColumn("rest", F.col(TARGET) - F.col("ridge_usd"))
        amounts = rows.agg(
            F.sum("rest").alias("intercept"),
            *[F.sum(F.col("rest") * F.col(f"{name}_scaled")).alias(name) for name in NUMERIC],
        ).selectExpr(f"inline(array({', '.join(f'struct({name!r} AS feature, {name} AS total)' for name in ('intercept', *NUMERIC))}))")
        labels = [
            rows.groupBy(F.concat(F.lit(f"{name}="), F.col(name)).alias("feature")).agg(F.sum("rest").alias("total"))
            for name in CATEGORICAL
        ]
        weights = [("intercept", 0.0), *self._weights()]
        weighed = train.sparkSession.createDataFrame(weights, "feature string, weight double")
        scale = train.agg(F.sum(F.abs(TARGET))).first()[0] or 1.0
        gap = F.abs(F.col("total") - PENALTY * F.col("weight")) / scale
        return reduce(DataFrame.unionByName, labels, amounts).join(weighed, "feature", "full").select("feature", gap.alias("gap"))

    def _weights(self) -> list[tuple[str, float]]:
        """The weight of each feature by name; at most MOST_FEATURES of them."""
        indexer, _, _, fitted = self._model.stages
        names = [*NUMERIC, *(f"{name}={label}" for name, known in zip(CATEGORICAL, indexer.labelsArray) for label in known)]
        return list(zip(names, map(float, fitted.coefficients), strict=True))

    def explained(self, rows: DataFrame) -> DataFrame:
        """Adds what each feature brings to a row's prediction, and the intercept: ``<feature>_usd`` columns.

        The parts add up to the prediction before it is clipped at zero. A label that the training
        rows lack brings nothing.
        """
        weights = F.create_map(*[F.lit(part) for pair in self._weights() for part in pair])
        amounts = {f"{name}_usd": self._scaled[f"{name}_scaled"] * weights[name] for name in NUMERIC}
        labels = {
            f"{name}_usd": F.coalesce(F.try_element_at(weights, F.concat(F.lit(f"{name}="), F.col(name))), F.lit(0.0))
            for name in CATEGORICAL
        }
        return rows.withColumns({"intercept_usd": F.lit(float(self._model.stages[-1].intercept)), **amounts, **labels})

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``model_usd``, never below zero."""
        scored = self._model.transform(rows.withColumns(self._scaled))
        return scored.select(*rows.columns, F.greatest("ridge_usd", F.lit(0.0)).alias("model_usd"))


class Backtest:
    """Both methods on the last twelve months, and the forecast that follows.

    The holdout model never sees holdout targets, and the winner is decided on rounded errors.
    The history is read once; what a result does not need is not fitted.
    """

    def __init__(self, lines: DataFrame):
        self._lines = lines
        self.history = monthly_history(lines)
        self._panel = complete_panel(self.history)
        self._rows = with_naive(usable(with_features(self._panel))).checkpoint()
        if self._rows.select(MONTH).distinct().count() < 2 * HOLDOUT_MONTHS:
            raise StageError("the model needs 24 months whose value a year before is known")

    @cached_property
    def holdout_model(self) -> RidgeModel:
        """Fitted on the months before the holdout."""
        return RidgeModel(split(self._rows, self.history)[0])

    @cached_property
    def final_model(self) -> RidgeModel:
        """Fitted on the whole history."""
        return RidgeModel(self._rows)

    @cached_property
    def scored(self) -> DataFrame:
        return self.holdout_model.predict(split(self._rows, self.history)[1]).checkpoint()

    @cached_property
    def errors(self) -> tuple[Row, Row]:
        """Of last year's value, and of the ridge model."""
        return error_metrics(self.scored, "seasonal_naive_usd").first(), error_metrics(self.scored, "model_usd").first()

    @property
    def winner(self) -> str:
        naive, ridge = self.errors
        return RIDGE if ridge.mae_usd < naive.mae_usd else NAIVE

    def optimality(self) -> DataFrame:
        """Whether the model of the next month solves its equations: (feature, gap)."""
        return self.final_model.optimality(self._rows)

    def holdout_optimality(self) -> DataFrame:
        """Whether the model that the errors are taken of solves its equations: (feature, gap)."""
        return self.holdout_model.optimality(split(self._rows, self.history)[0])

    def explained_holdout(self) -> DataFrame:
        """The holdout's predictions beside what each feature brings to them."""
        return self.holdout_model.explained(self.scored)

    def holdout(self) -> DataFrame:
        return self.scored.select(*GOLD_KEYS, TARGET, "seasonal_naive_usd", "model_usd")

    def next_month(self) -> DataFrame:
        """The month after the history, by a ridge model fitted on all of it."""
        selected = "model_usd" if self.winner == RIDGE else "seasonal_naive_usd"
        return self._upcoming.select(
            *GOLD_KEYS, "seasonal_naive_usd", "model_usd", F.col(selected).alias("selected_forecast_usd")
        )

    @property
    def _upcoming(self) -> DataFrame:
        return self.final_model.predict(with_naive(next_month_features(self._panel, self.history.next_month)))

    def explained_next_month(self) -> DataFrame:
        """The next month's predictions beside what each feature brings to them."""
        return self.final_model.explained(self._upcoming)

    def summary(self) -> DataFrame:
        return _summary(self._lines, self.history, *self.errors, self.winner)


def _summary(lines: DataFrame, history: History, naive: Row, ridge: Row, winner: str) -> DataFrame:
    def errors(row: Row) -> Column:
        return F.struct(*[F.lit(row[name]).cast("double").alias(name) for name in ("mae_usd", "wape_percent")])

    def day(value: date | None) -> Column:
        return F.date_format(F.lit(value).cast("date"), "yyyy-MM-dd")

    return lines.sparkSession.range(1).select(
        F.lit(TARGET_TEXT).alias("target"),
        F.lit(f"silver.{SILVER_TABLE}").alias("source"),
        day(history.last_month).alias("last_complete_month"),
        day(history.excluded_month).alias("excluded_partial_month"),
        F.date_format(F.expr(holdout_start(history)), "yyyy-MM-dd").alias("holdout_start"),
        day(history.last_month).alias("holdout_end"),
        F.lit(METHOD_TEXT).alias("holdout_method"),
        errors(naive).alias("baseline"),
        errors(ridge).alias("ridge_model"),
        F.lit(winner).alias("selected_method"),
        day(history.next_month).alias("next_forecast_month"),
        F.lit(NOTE_TEXT).alias("note"),
    )


def run_forecast(store: LayerStore, output: str) -> Row:
    """Forecast from published Silver and replace the three outputs; returns the summary."""
    store.require([("silver", SILVER_TABLE)], "silver")
    result = Backtest(store.table("silver", SILVER_TABLE))
    output = output.rstrip("/")
    replace_csv(_exported(result.holdout().orderBy(*GOLD_KEYS)), f"{output}/holdout_predictions.csv")
    replace_csv(_exported(result.next_month().orderBy(*SEGMENT)), f"{output}/next_month_forecast.csv")
    summary = result.summary()
    replace_json(summary, f"{output}/metrics.json")
    return summary.first()


def _exported(frame: DataFrame) -> DataFrame:
    amounts = [name for name in frame.columns if name.endswith("_usd")]
    return frame.withColumns({name: two_decimals(F.col(name)) for name in amounts})
