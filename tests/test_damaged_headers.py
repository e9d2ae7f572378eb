"""What the damaged deliveries are derived from."""

from __future__ import annotations

from tallyroll.contracts import PRODUCTS
from tallyroll.plans import drills
from tallyroll.session import scratch_path


def test_another_header_stands_over_the_intact_records(spark):
    folder = scratch_path(spark, "damaged")
    names = [f"'{name}' AS {name}" for name in PRODUCTS.columns.values() if name != "product_name"]
    # Evaluated again, the frame has other names.
    frame = spark.range(3).selectExpr(*names, "if(id = 0, '', if(id = 1, NULL, concat(uuid(), ', \"x\"'))) AS product_name")
    drills._deliver_damaged(frame.select(*PRODUCTS.columns.values()), folder, PRODUCTS)
    intact, other = (
        sorted(row.value for row in spark.read.text(f"{folder}/{damage}/{PRODUCTS.file_name}").collect() if "Product Name" not in row.value)
        for damage in ("intact", "other_header")
    )
    assert intact == other and len(intact) == 3
    header = spark.read.text(f"{folder}/other_header/{PRODUCTS.file_name}").where("value LIKE 'ProductKey,%'").first().value
    assert header.split(",") == [*PRODUCTS.headers[:-1], "Other"]
