"""What the failing runs are delivered, and what lies on disk for it."""

from __future__ import annotations

import gzip
from datetime import datetime
from pathlib import Path

import pytest

from tallyroll.contracts import GOLD_TABLE, LINE_TABLES, SALES, SILVER_TABLE
from tallyroll.plans import drills
from tallyroll.session import settings_for
from tallyroll.sources import order_tables
from tallyroll.sources.layer_store import LayerStore

DAY = datetime(2020, 1, 31)


def _tables(spark, folder: Path, numbers: list[int | None]) -> str:
    """Order tables whose lines have those line numbers."""
    tables = {
        "lineitem": (
            [(1, 0, 0, number, 3.0, "A", DAY) for number in numbers],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
            "l_shipdate timestamp",
        ),
        "orders": ([(1, 5, DAY)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "part": ([(0, "red bolt", "B", "T", 1, 9.0)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(0, "S", 0)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture
def delivered(spark, monkeypatch):
    """Instead of running: what each run was delivered, the lines of all sales files then, and two settings."""
    seen = []

    def run(session, root, layer, source=None, kind=LayerStore):
        store = LayerStore(session, root)
        if not store.has("gold", GOLD_TABLE):
            for of, table in (("bronze", "sales"), ("silver", SILVER_TABLE), ("gold", GOLD_TABLE)):
                store.publish(of, {table: store.stage(of, table, session.range(1))})
            store.register_views()
        rows, on_disk = None, 0
        if source:
            if Path(source).exists():
                text = session.read.option("header", True).option("escape", '"').csv(f"{source}/{SALES.file_name}")
                rows = sorted((row["Line Item"] or "", row["Quantity"]) for row in text.collect())
            files = [path for path in Path(source).parent.rglob("*.csv*") if path.is_file() and path.suffix != ".crc"]
            texts = [gzip.open(path, "rt") if path.suffix == ".gz" else open(path) for path in files]
            lines = [line for text in texts for line in text.read().splitlines()]
            on_disk = sum(line.endswith(",USD") for line in lines)
        seen.append((rows, on_disk, {key: session.conf.get(key, None) for key in drills.SPARING}))
        return 0

    monkeypatch.setattr(drills.pipeline, "run", run)
    return seen


@pytest.mark.parametrize("numbers", [[1, 2, 7, 7, None, 1], [1, 1], [7], [3]])
def test_deliveries_hold_what_they_name_and_lines_lie_there_once(spark, tmp_path, delivered, monkeypatch, numbers):
    directory = _tables(spark, tmp_path / "given", numbers)
    monkeypatch.setattr(drills, "FILE_LINES", 1)
    drills.failed_runs(spark, directory)
    texts = ["" if number is None else str(number) for number in numbers]
    whole = sorted((text, "3") for text in texts)
    fewer = [pair for pair in whole if pair[0] not in ("", "1")]
    damaged = sorted((text, "-1" if text == "7" else "3") for text in texts)
    assert [rows for rows, *_ in delivered] == [whole, whole, None, fewer, None, damaged, None, None, fewer]
    # Every line once, and the seventh once more as damaged; in the end only what the last run takes.
    assert max(on_disk for _, on_disk, _ in delivered) <= len(numbers) + numbers.count(7)
    assert delivered[-1][1] == len(fewer)


def test_the_join_of_lines_and_orders_runs_once(spark, tmp_path, delivered, monkeypatch):
    directory, loads = _tables(spark, tmp_path / "given", [1, 2, 7]), spark.sparkContext.accumulator(0)
    sales = order_tables.sales

    def counted(session, folder):
        found = sales(session, folder)
        return session.createDataFrame(found.rdd.map(lambda row: (loads.add(1), row)[1]), found.schema)

    monkeypatch.setattr(order_tables, "sales", counted)
    drills.failed_runs(spark, directory)
    assert loads.value == 3


def test_shuffle_files_go_with_their_query_while_the_runs_last(spark, tmp_path, delivered):
    before = {key: spark.conf.get(key, None) for key in drills.SPARING}
    drills.failed_runs(spark, _tables(spark, tmp_path / "given", [1, 2, 7]))
    assert all(settings == drills.SPARING for *_, settings in delivered)
    assert {key: spark.conf.get(key, None) for key in drills.SPARING} == before

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled() -> set[Path]:
        return {path for folder in folders for path in Path(folder).rglob("shuffle_*.data")}

    there = shuffled()
    with settings_for(spark, drills.SPARING):
        spark.range(1000).repartition(4).write.parquet(str(tmp_path / "dealt"))
    assert shuffled() <= there


def test_settings_hold_again_after_a_failure(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError, match="over"), settings_for(spark, {key: "1m"}):
        assert spark.conf.get(key) == "1m"
        raise ValueError("over")
    assert spark.conf.get(key, None) == before


def test_lines_are_packed_tighter_than_dimensions(spark, store):
    for layer, table in [*LINE_TABLES, ("bronze", "products")]:
        store.publish(layer, {table: store.stage(layer, table, spark.range(1))})
        packed = store.table(layer, table).inputFiles()[0].endswith(".zstd.parquet")
        assert packed == ((layer, table) in LINE_TABLES)
