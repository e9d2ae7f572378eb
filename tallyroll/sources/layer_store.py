"""Published layers as Parquet versions behind one pointer file per layer.

Parquet tables in the session catalog cannot be replaced atomically: an overwrite that fails
loses the old table, and a table cannot be overwritten by a query that reads it. So a stage
writes a new version nobody can see, verifies it, and then renames one small pointer file.
All tables of a layer change together, and a stage that fails leaves the pointer alone.
The rename is atomic on HDFS and local disks; an object store without an atomic rename needs
a table format instead. There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyroll.contracts import LAYERS, LINE_TABLES
from tallyroll.errors import MissingUpstreamError
from tallyroll.sources.files import Files

POINTER = "_CURRENT.json"


class LayerStore:
    """Tables under ``root``, addressed as (layer, table)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Files(spark)

    # Reading

    def table(self, layer: str, table: str) -> DataFrame:
        """The published version, resolved now: a later publish does not change this frame."""
        self.require([(layer, table)], layer)
        return self.spark.read.parquet(self._version_path(layer, table, self._versions(layer)[table]))

    def has(self, layer: str, table: str) -> bool:
        return table in self._versions(layer)

    def require(self, tables: list[tuple[str, str]], stage: str) -> None:
        """Fail, creating nothing, unless every table is published."""
        missing = [f"{layer}.{table}" for layer, table in tables if not self.has(layer, table)]
        if missing:
            raise MissingUpstreamError(f"{', '.join(missing)} is not published. Run {stage} first")

    def register_views(self) -> None:
        """Schemas for all layers, and a view per published table, for SQL users."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
            for table, version in self._versions(layer).items():
                path = self._version_path(layer, table, version)
                self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT * FROM parquet.`{path}`")

    # Writing

    def stage(self, layer: str, table: str, frame: DataFrame) -> str:
        """Write a new version that readers do not see yet, and return its name.

        Sales lines, of which up to three versions lie there at a time, are packed tighter. Dimensions
        are not: Catalyst takes their file size for their size, and would broadcast large ones.
        """
        version = uuid.uuid4().hex
        packed = {"compression": "zstd"} if (layer, table) in LINE_TABLES else {}
        try:
            frame.write.options(**packed).parquet(self._version_path(layer, table, version))
        except Exception:
            self.discard(layer, table, version)
            raise
        return version

    def staged(self, layer: str, table: str, version: str) -> DataFrame:
        return self.spark.read.parquet(self._version_path(layer, table, version))

    def discard(self, layer: str, table: str, version: str) -> None:
        self._files.delete(self._version_path(layer, table, version))

    def publish(self, layer: str, versions: dict[str, str]) -> None:
        """Make staged versions current, all at once, and drop those no reader can need.

        The version just replaced stays until the next publish, for queries still on it.
        """
        before = self._versions(layer)
        after = {**before, **versions}
        self._files.replace_text(f"{self.root}/{layer}/{POINTER}", json.dumps(after, indent=2), uuid.uuid4().hex)
        for table in versions:
            for version in self._files.children(f"{self.root}/{layer}/{table}"):
                if version not in (after[table], before.get(table)):
                    self.discard(layer, table, version)

    def drop_layer(self, layer: str) -> None:
        self._files.delete(f"{self.root}/{layer}")

    def _version_path(self, layer: str, table: str, version: str) -> str:
        return f"{self.root}/{layer}/{table}/{version}"

    def _versions(self, layer: str) -> dict[str, str]:
        pointer = f"{self.root}/{layer}/{POINTER}"
        return json.loads(self._files.read_text(pointer)) if self._files.exists(pointer) else {}
