"""Large tables in partition folders, of which an upsert rewrites only those it touches.

The partition columns must be part of the key, so that a key never changes folder. Each
partition folder holds a sub-folder per rewrite; a manifest says which one is current for
every partition. Merged folders are put beside the current ones, and become visible all
at once with the next manifest (:mod:`.pointers`). Readers follow the newest manifest and
never write; a writer that is overtaken merges again. The driver handles names of folders,
never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dedupe import require_unique
from ..operators.upsert import merge
from .pointers import Conflict, Pointers
from .tables import ATTEMPTS

RUN = "__run"


class PartitionedTable:
    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str]
    ):
        if not set(by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.by = list(keys), list(by)
        self.pointers = Pointers(spark, f"{self.path}/_published")

    def exists(self) -> bool:
        return self.pointers.newest() > 0

    def _manifest(self, version: int) -> tuple[StructType | None, dict[str, str]]:
        if not version:
            return None, {}
        kept = json.loads(self.pointers.read(version))
        return StructType.fromJson(kept["schema"]), kept["parts"]

    def _load(self, schema: StructType, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        names = [f.name for f in schema if f.name not in self.by]
        reader = self.spark.read.schema(schema).option("basePath", data)
        rows = reader.parquet(*[f"{data}/{p}/{RUN}={run}" for p, run in parts.items()])
        return rows.select(*names, *self.by)

    def read(self) -> DataFrame:
        version = self.pointers.newest()
        if not version:
            raise ValueError(f"no table at {self.path}")
        return self._load(*self._manifest(version))

    def _folders(self, root: str) -> list[str]:
        """Partition folders below ``root``, as relative paths."""
        found = [""]
        for _ in self.by:
            found = [
                f"{f}/{c}".lstrip("/")
                for f in found
                for c in self.pointers.children(f"{root}/{f}")
                if "=" in c
            ]
        return found

    def upsert(self, updates: DataFrame, fill_missing: bool = False) -> DataFrame | None:
        """Replace known keys and add new ones, folder by folder."""
        staging = f"{self.path}/_staged-{uuid.uuid4().hex}"
        columns = [c for c in updates.columns if c not in self.by]
        updates.write.partitionBy(*self.by).parquet(staging)
        staged = self.spark.read.schema(updates.schema).parquet(staging)
        staged = staged.select(*columns, *self.by)
        try:
            if not staged.head(1):
                return self.read() if self.exists() else None
            require_unique(staged, self.keys)
            touched = self._folders(staging)
            for attempt in range(ATTEMPTS):
                try:
                    return self._publish(staged, touched, fill_missing)
                except Conflict:
                    if attempt + 1 == ATTEMPTS:
                        raise
        finally:
            self.pointers.remove(staging)

    def _publish(self, staged: DataFrame, touched: list[str], fill_missing: bool) -> DataFrame:
        base, run = self.pointers.newest(), uuid.uuid4().hex
        schema, parts = self._manifest(base)
        merged = staged
        if schema is not None:
            old = self._load(schema, {p: parts[p] for p in touched if p in parts})
            merged = merge(old, staged, self.keys, fill_missing)
        work = f"{self.path}/_work-{run}"
        moved = []
        try:
            merged.hint("rebalance", *self.by).write.partitionBy(*self.by).parquet(work)
            for folder in self._folders(work):
                target = f"{self.path}/data/{folder}/{RUN}={run}"
                self.pointers.rename(f"{work}/{folder}", target)
                moved.append(folder)
            content = {
                "schema": merged.schema.jsonValue(),
                "parts": {**parts, **{f: run for f in moved}},
            }
            self.pointers.publish(base + 1, json.dumps(content))
        except Conflict:
            # after any other error the version may be visible; prune() finds what is not
            for folder in moved:
                self.pointers.remove(f"{self.path}/data/{folder}/{RUN}={run}")
            raise
        finally:
            self.pointers.remove(work)
        return self._load(merged.schema, content["parts"])

    def prune(self) -> None:
        """Drop all but the newest manifest and the folders it does not name.

        Not while other sessions read or write the table.
        """
        version = self.pointers.newest()
        _, parts = self._manifest(version)
        for old in self.pointers.versions():
            if old != version:
                self.pointers.remove(f"{self.pointers.path}/v={old}")
        for folder in self._folders(f"{self.path}/data"):
            for run in self.pointers.children(f"{self.path}/data/{folder}"):
                if run != f"{RUN}={parts.get(folder)}":
                    self.pointers.remove(f"{self.path}/data/{folder}/{run}")
