"""Refusals and failures tried out on the given tables."""

from __future__ import annotations

import pytest

from tallyroll.contracts import SILVER_TABLE
from tallyroll.plans import drills, given_tables
from tallyroll.sources.files import Files
from tallyroll.sources.layer_store import LayerStore
from tallyroll.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_every_damage_is_named(spark):
    rows = drills.preflight_rejections(spark, SF).collect()
    found = {(row.file_name, row.damage): row.verdict for row in rows}
    for name in ("Sales.csv", "Products.csv", "Stores.csv"):
        assert [found[name, damage] for damage in ("intact", "missing", "zero_bytes", "other_header", "no_rows")] == [
            "accepted", "missing", "empty", "header", "no rows",
        ]
    assert found["Sales.csv", "not_utf8"] == "encoding"
    assert all((row.row_count is None) == (row.verdict != "accepted") for row in rows)


def test_gates_open_one_after_another(spark):
    rows = drills.stage_gates(spark, SF).collect()
    assert [(row.published, row.stage) for row in rows if row.answer == "runs"] == [
        ("bronze", "silver"), ("silver", "gold"), ("gold", "quality"), ("gold", "export"),
    ]
    assert [row.published_rows for row in rows] == sorted(row.published_rows for row in rows)


def test_a_store_that_dies_leaves_the_published_version(spark):
    store = given_tables.published(spark, SF)
    before = store.table("silver", SILVER_TABLE).count()
    dying = drills.DyingStore(spark, store.root)
    version = dying.stage("silver", SILVER_TABLE, store.table("silver", SILVER_TABLE).limit(1))
    with pytest.raises(OSError, match="died before publishing"):
        dying.publish("silver", {SILVER_TABLE: version})
    assert store.table("silver", SILVER_TABLE).count() == before
    # What it left is gone with the next publish but one reader's version.
    again = LayerStore(spark, store.root)
    again.publish("silver", {SILVER_TABLE: again.stage("silver", SILVER_TABLE, again.table("silver", SILVER_TABLE))})
    assert version not in Files(spark).children(f"{store.root}/silver/{SILVER_TABLE}")


def test_a_replaced_layer_is_told_from_the_one_before(spark):
    store = LayerStore(spark, scratch_path(spark, "identity"))
    with pytest.raises(ValueError, match="not published"):
        drills.run_identity(store)
