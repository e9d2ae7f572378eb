"""What the pipeline refuses and how it fails, tried out on the given tables.

Each drill delivers, publishes or damages data derived from the tables, runs the stages on it as a
user would, and gives what they answered as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tallyroll.contracts import GOLD_TABLE, LAYERS, SALES, SILVER_TABLE, SOURCES, SourceContract
from tallyroll.errors import MissingUpstreamError, SourceError, StageError
from tallyroll.plans import forecast, pipeline, quality
from tallyroll.plans.bronze import with_lineage
from tallyroll.plans.export import export_gold
from tallyroll.plans.gold import build_gold
from tallyroll.plans.silver import build_silver
from tallyroll.session import scratch_path, settings_for
from tallyroll.sources import order_tables
from tallyroll.sources.files import Files
from tallyroll.sources.layer_store import LayerStore
from tallyroll.sources.preflight import check_source

# Sales lines, products and stores that a damage spoils, by the text of their delivered record.
SPOILT_RECORDS = {"sales": "value RLIKE '^[0-9]+,7,'", "products": "value LIKE '%,size 13,%'", "stores": "value RLIKE '^[0-9]*7,'"}
# What a refusal says, and the short form a drill gives.
REFUSALS = {
    "required file not found": "missing",
    "is not valid UTF-8": "encoding",
    "no columns to parse": "empty",
    "unexpected header": "header",
    "contains no data rows": "no rows",
}
# Groups of sales lines, as part files, that make up each delivery; spoilt ones are the seventh lines damaged.
DELIVERIES = {"whole": ("first", "seventh", "other"), "fewer": ("seventh", "other"), "damaged": ("first", "spoilt", "other")}
LINE_GROUPS = """CASE WHEN line_item = '7' THEN array('seventh', 'spoilt') WHEN line_item <> '1' THEN array('other')
                      ELSE array('first') END"""
# Zipped files are not split, so no file is to hold more lines.
FILE_LINES = 1_000_000
# Shuffle files go when the query that wrote them ends, not when the driver next collects its garbage,
# and a task writes the few groups side by side: below that many writers, Spark sorts nothing.
SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "8"}


def write_source(frame: DataFrame, directory: str, contract: SourceContract) -> None:
    """Bronze-shaped text as a delivered file with the contracted header."""
    _csv_writer(frame.select(*_headed(contract))).csv(f"{directory}/{contract.file_name}")


def _headed(contract: SourceContract) -> list[Column]:
    return [F.col(name).alias(header) for header, name in contract.columns.items()]


def _csv_writer(frame: DataFrame) -> DataFrameWriter:
    return frame.write.option("header", True).option("escape", '"')


# Preflight


def _deliver_damaged(frame: DataFrame, folder: str, contract: SourceContract) -> list[str]:
    """Every damage of one source, each in a folder of its own under ``folder``; returns their names."""
    spark, name = frame.sparkSession, contract.file_name
    write_source(frame, f"{folder}/intact", contract)
    lines = spark.read.text(f"{folder}/intact/{name}")
    broken = F.concat("value", F.unhex(F.lit("FF")).cast("string"))
    lines.select(F.when(F.expr(SPOILT_RECORDS[contract.table]), broken).otherwise(F.col("value"))).write.text(f"{folder}/not_utf8/{name}")
    Files(spark).replace_text(f"{folder}/zero_bytes/{name}", "", "new")
    # From the intact file, so that what the source is derived from is not read and joined again. No
    # cell is a lone NUL, so empty text stays apart from NULL.
    schema = ", ".join(f"`{header}` string" for header in contract.headers)
    intact = spark.read.schema(schema).option("header", True).option("escape", '"').option("nullValue", "\0").csv(f"{folder}/intact/{name}")
    renamed = intact.withColumnRenamed(contract.headers[-1], "Other")
    _csv_writer(renamed).csv(f"{folder}/other_header/{name}")
    write_source(frame.where("false"), f"{folder}/no_rows", contract)
    return ["intact", "missing", "not_utf8", "zero_bytes", "other_header", "no_rows"]


def _verdict(spark: SparkSession, folder: str, contract: SourceContract) -> tuple[str, int | None]:
    try:
        _, rows, _ = check_source(spark, folder, contract)
        return "accepted", rows
    except SourceError as error:
        return next((short for said, short in REFUSALS.items() if said in str(error)), str(error)), None


def preflight_rejections(spark: SparkSession, directory: str) -> DataFrame:
    """What the preflight says of each source, intact and in every damaged form."""
    bronze, found = order_tables.bronze_shaped(spark, directory), []
    folder = scratch_path(spark, "damaged")
    for contract in SOURCES:
        for damage in _deliver_damaged(bronze[contract.table], folder, contract):
            found.append((contract.file_name, damage, *_verdict(spark, f"{folder}/{damage}", contract)))
    Files(spark).delete(folder)
    return spark.createDataFrame(found, "file_name string, damage string, verdict string, row_count bigint")


# Gates


def stage_gates(spark: SparkSession, directory: str) -> DataFrame:
    """What each stage answers while more and more tables are published.

    A stage whose gate is open runs, so the tables of the next step are its own. ``published_rows``
    counts all published rows when the stage was asked.
    """
    bronze = order_tables.bronze_shaped(spark, directory)
    store, target = LayerStore(spark, scratch_path(spark, "gates")), scratch_path(spark, "gates-export")
    stages = {
        "silver": lambda: build_silver(store),
        "gold": lambda: build_gold(store),
        "quality": lambda: quality.run_checks(store),
        "export": lambda: export_gold(store, f"{target}/{GOLD_TABLE}.csv"),
        "forecast": lambda: forecast.run_forecast(store, target),
    }

    def publish(table: str, file_name: str) -> None:
        version = store.stage("bronze", table, with_lineage(bronze[table], file_name))
        store.publish("bronze", {table: version})

    steps = [
        ("nothing", lambda: None, ("silver", "gold", "quality", "export", "forecast")),
        ("sales", lambda: publish("sales", "Sales.csv"), ("silver", "gold", "quality")),
        ("products", lambda: publish("products", "Products.csv"), ("silver", "quality")),
        ("bronze", lambda: publish("stores", "Stores.csv"), ("gold", "quality", "export", "forecast", "silver")),
        ("silver", lambda: None, ("quality", "export", "gold")),
        ("gold", lambda: None, ("quality", "export")),
    ]
    tables = [("bronze", contract.table) for contract in SOURCES] + [("silver", SILVER_TABLE), ("gold", GOLD_TABLE)]
    found = []
    for position, (published, prepare, asked) in enumerate(steps, 1):
        prepare()
        rows = sum(store.table(*table).count() for table in tables if store.has(*table))
        for stage in asked:
            try:
                stages[stage]()
                answer = "runs"
            except MissingUpstreamError as error:
                answer = str(error)
            found.append((position, published, stage, answer, rows))
    for path in (store.root, target):
        Files(spark).delete(path)
    return spark.createDataFrame(found, "position int, published string, stage string, answer string, published_rows bigint")


# Runs


class DyingStore(LayerStore):
    """A store that dies when Silver has been staged and verified, just before it is published."""

    def publish(self, layer: str, versions: dict[str, str]) -> None:
        if layer == "silver":
            raise OSError("died before publishing")
        super().publish(layer, versions)


def _set_out(bronze: dict[str, DataFrame], folder: str) -> None:
    """Products, stores and no sales yet under ``folder``/delivered, and each group of sales lines beside it.

    The three deliveries of sales have most lines in common. So every line is joined and written once,
    and a delivery is made up of the part files of its groups.
    """
    for contract in SOURCES:
        # The header alone, since a delivery whose groups have no lines still is a file.
        frame = bronze[contract.table].where("false") if contract is SALES else bronze[contract.table]
        write_source(frame, f"{folder}/delivered", contract)
    lines = bronze["sales"].withColumn("line_group", F.explode(F.expr(LINE_GROUPS)))
    lines = lines.withColumn("quantity", F.expr("if(line_group = 'spoilt', '-1', quantity)"))
    writer = _csv_writer(lines.select("line_group", *_headed(SALES))).partitionBy("line_group")
    writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).csv(f"{folder}/aside")


def _deliver(spark: SparkSession, folder: str, delivery: str, later: set[str]) -> None:
    """Have the part files of one delivery, and no others, delivered; drops those no ``later`` delivery takes."""
    files, delivered = Files(spark), f"{folder}/delivered/{SALES.file_name}"
    taken = {group for each in later for group in DELIVERIES[each]}
    for group in dict.fromkeys(group for groups in DELIVERIES.values() for group in groups):
        aside = f"{folder}/aside/line_group={group}"
        if group in DELIVERIES[delivery]:
            for name in files.children(aside):
                files.move(f"{aside}/{name}", f"{delivered}/{group}-{name}")
            continue
        for name in files.children(delivered):
            if name.startswith(f"{group}-"):
                files.move(f"{delivered}/{name}", f"{aside}/{name.removeprefix(f'{group}-')}")
        if group not in taken:
            files.delete(aside)


def failed_runs(spark: SparkSession, directory: str) -> DataFrame:
    """Exit status, published rows and schemas after each of several runs, some of which fail."""
    with settings_for(spark, SPARING):
        return _runs(spark, order_tables.bronze_shaped(spark, directory))


def _runs(spark: SparkSession, bronze: dict[str, DataFrame]) -> DataFrame:
    root, folder = scratch_path(spark, "runs"), scratch_path(spark, "deliveries")
    _set_out(bronze, folder)
    runs = [
        ("all layers", "all", "whole", LayerStore),
        ("again", "all", "whole", LayerStore),
        ("Silver dies when staged", "silver", None, DyingStore),
        ("fewer sales delivered", "bronze", "fewer", LayerStore),
        ("Gold alone", "gold", None, LayerStore),
        ("damaged sales", "all", "damaged", LayerStore),
        ("a folder without files", "all", "none", LayerStore),
        ("no such layer", "platinum", None, LayerStore),
        ("fewer sales in all layers", "all", "fewer", LayerStore),
    ]
    store, found = LayerStore(spark, root), []
    for position, (name, layer, delivery, kind) in enumerate(runs, 1):
        if delivery in DELIVERIES:
            _deliver(spark, folder, delivery, {each for _, _, each, _ in runs[position:] if each in DELIVERIES})
        source = delivery and f"{folder}/{'delivered' if delivery in DELIVERIES else delivery}"
        status = pipeline.run(spark, root, layer, source, kind)
        rows = [store.table(*table).count() for table in (("bronze", "sales"), ("silver", SILVER_TABLE), ("gold", GOLD_TABLE))]
        schemas = [row.namespace for row in spark.sql("SHOW SCHEMAS").collect()]
        found.append((position, name, status, *rows, sum(schemas.count(each) for each in LAYERS)))
    for path in (root, folder):
        Files(spark).delete(path)
    columns = "position int, run string, status int, bronze_sales bigint, silver_sales bigint, gold_rows bigint, layer_schemas int"
    return spark.createDataFrame(found, columns)


def run_identity(store: LayerStore) -> DataFrame:
    """How two recorded runs of the checks are told apart, over a store whose layers are published."""
    (first, _), (second, _) = quality.run_checks(store), quality.run_checks(store)
    runs = quality.audit(store).groupBy("run_id").agg(
        F.count("*").alias("results"),
        F.count_distinct("checked_at").alias("times"),
        F.min("checked_at").alias("checked_at"),
        F.sum("total_rows").alias("total_rows"),
    )
    by_run = {row.run_id: row for row in runs.collect()}
    if by_run.keys() != {first, second}:
        raise StageError("the recorded runs are not the two that ran")
    found = [
        (
            number,
            first != second,
            len(run_id) == 36 and run_id.count("-") == 4,
            by_run[run_id].times == 1,
            by_run[first].checked_at < by_run[second].checked_at,
            by_run[run_id].results,
            by_run[run_id].total_rows,
        )
        for number, run_id in enumerate((first, second), 1)
    ]
    columns = "run int, ids_differ boolean, id_is_uuid boolean, one_time boolean, times_ascend boolean, results bigint, total_rows bigint"
    return store.spark.createDataFrame(found, columns)
