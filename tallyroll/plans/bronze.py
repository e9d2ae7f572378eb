"""Bronze: the delivered text, unchanged, with where and when it was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyroll.contracts import SOURCES
from tallyroll.errors import StageError
from tallyroll.sources.layer_store import LayerStore


def with_lineage(frame: DataFrame, file_name: str) -> DataFrame:
    return frame.selectExpr("*", "current_timestamp() AS loaded_at", f"'{file_name}' AS source_file")


def load_bronze(store: LayerStore, sources: dict[str, DataFrame]) -> dict[str, int]:
    """Replace all Bronze tables together, or none; returns rows per table."""
    versions: dict[str, str] = {}
    counts: dict[str, int] = {}
    try:
        for contract in SOURCES:
            # Counted in the tasks that write, where Spark counts each task once.
            read = Observation()
            frame = sources[contract.table].observe(read, F.count(F.lit(1)).alias("rows"))
            versions[contract.table] = store.stage("bronze", contract.table, with_lineage(frame, contract.file_name))
            written = store.staged("bronze", contract.table, versions[contract.table]).count()
            if written != read.get["rows"]:
                raise StageError(f"{read.get['rows']:,} rows were read for bronze.{contract.table}, but {written:,} written")
            counts[contract.table] = written
    except Exception:
        for table, version in versions.items():
            store.discard("bronze", table, version)
        raise
    store.publish("bronze", versions)
    return counts
