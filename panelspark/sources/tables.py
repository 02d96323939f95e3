"""Named tables kept as versioned Parquet directories.

A version is written completely to folders of its own, checked, and only then made
visible by its pointer (:mod:`.pointers`). Readers take the newest version, so a lost
executor or driver never leaves a half-written table. A writer that started from a
version that is no longer the newest merges again.

A table that was overwritten is one folder. A table that rows are merged into is dealt
into buckets by a hash of some of its key columns; its pointer names the folder that is
current for every bucket, and a merge reads and writes only the buckets of its keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import require_unique
from ..operators.joins import not_matching, null_safe_join, small_side
from ..operators.upsert import align_columns
from .pointers import Conflict, Pointers

ATTEMPTS = 10
BUCKET = "__bucket"
SNAPSHOTS = "_snapshots"


class Tables:
    """Tables below ``root``; ``buckets`` is what new bucketed tables get.

    Unset, that is the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _pointers(self, name: str) -> Pointers:
        return Pointers(self.spark, f"{self.root}/{name}/_published")

    def names(self) -> list[str]:
        found = self._pointers("").children(self.root)
        return [n for n in found if n != SNAPSHOTS and self.versions(n)]

    def versions(self, name: str) -> list[int]:
        return self._pointers(name).versions()

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    # -- reading -----------------------------------------------------------------
    def _content(self, name: str, version: int) -> dict:
        """What a pointer says: a ``folder``, or ``schema``, ``by``, ``buckets``, ``parts``."""
        text = self._pointers(name).read(version) if version else "{}"
        return json.loads(text) if text.startswith("{") else {"folder": text}

    def _load(self, name: str, content: dict, only: set[str] | None = None) -> DataFrame:
        """The rows of a version, or those of some buckets."""
        where = f"{self.root}/{name}"
        if "folder" in content:
            return self.spark.read.parquet(f"{where}/{content['folder']}")
        schema = StructType.fromJson(content["schema"])
        parts = {b: f for b, f in content["parts"].items() if only is None or b in only}
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{where}/{f}/{BUCKET}={b}" for b, f in parts.items()]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        chosen = self._pointers(name).newest() if version is None else version
        if not chosen:
            raise ValueError(f"no table {name!r} under {self.root}")
        return self._load(name, self._content(name, chosen))

    def read_if_exists(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def read_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows whose key is among ``keys``, NULL compared like a value.

        If ``keys`` has the columns that the table is bucketed by, only the buckets of
        these keys are read.
        """
        content = self._content(name, self._pointers(name).newest())
        on = list(keys.columns)
        keys = small_side(keys.distinct())
        only = None
        if set(content.get("by", ["?"])) <= set(on):
            only = _numbers(keys, _bucket(content))
        return null_safe_join(self._load(name, content, only), keys, on, "left_semi")

    def before(self, name: str, version: int | None = None) -> DataFrame | None:
        """The rows that the merge which made a version replaced, if it kept them."""
        content = self._content(name, version or self._pointers(name).newest())
        folder = content.get("before")
        return self.spark.read.parquet(f"{self.root}/{name}/{folder}") if folder else None

    # -- writing -----------------------------------------------------------------
    def _publish(self, name: str, base: int, content: dict | str, folders: Sequence[str]) -> int:
        """Publish the version after ``base``; folders of a lost race are removed.

        After any other error nobody can tell whether the version is visible, so that its
        folders stay; :meth:`prune` removes them if no version names them.
        """
        pointers = self._pointers(name)
        text = content if isinstance(content, str) else json.dumps(content)
        try:
            pointers.publish(base + 1, text)
        except Conflict:
            for folder in folders:
                pointers.remove(f"{self.root}/{name}/{folder}")
            raise
        return base + 1

    def _attempt(self, write: Callable[[], int]) -> int:
        for attempt in range(ATTEMPTS):
            try:
                return write()
            except Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise
        raise AssertionError

    def _write(
        self,
        df: DataFrame,
        name: str,
        base: int,
        min_rows: int = 0,
        partition_by: Sequence[str] = (),
        unique: Sequence[str] = (),
        nullable_keys: bool = False,
        by: Sequence[str] = (),
        sort: Sequence[str] = (),
    ) -> int:
        """Write, check and publish the version after ``base``, which replaces the table."""
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{folder}"
        pointers = self._pointers(name)
        content = {
            "schema": df.schema.jsonValue(), "by": list(by), "buckets": self.buckets, "parts": {},
        }
        try:
            if by:
                self._write_buckets(df, path, content, sort)
                content["parts"] = dict.fromkeys(self._written(path), folder)
                written = self._load(name, content)
            else:
                writer = df.write.mode("errorifexists")
                if partition_by:
                    writer = writer.partitionBy(*partition_by)
                writer.parquet(path)
                written = self.spark.read.schema(df.schema).parquet(path)
            if min_rows and (found := written.count()) < min_rows:
                raise ValueError(f"{name}: {found} rows, at least {min_rows} needed")
            if unique:
                require_unique(written, unique, nullable_keys)
        except Exception:
            pointers.remove(path)
            raise
        return self._publish(name, base, content if by else folder, [folder])

    def _write_buckets(
        self, df: DataFrame, path: str, content: dict, sort: Sequence[str] = ()
    ) -> None:
        dealt = df.withColumn(BUCKET, _bucket(content)).hint("rebalance", BUCKET)
        if sort:
            dealt = dealt.sortWithinPartitions(BUCKET, *sort)
        dealt.write.partitionBy(BUCKET).parquet(path)

    def _written(self, path: str) -> list[str]:
        found = self._pointers("").children(path)
        return [f.removeprefix(f"{BUCKET}=") for f in found if f.startswith(f"{BUCKET}=")]

    def _replace(self, df: DataFrame, name: str, **options) -> DataFrame:
        def write() -> int:
            return self._write(df, name, self._pointers(name).newest(), **options)

        return self.read(name, self._attempt(write))

    def overwrite(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        unique: Sequence[str] = (),
        nullable_keys: bool = False,
        by: Sequence[str] = (),
        sort: Sequence[str] = (),
    ) -> DataFrame:
        """Replace the table; also the full refresh after a model change.

        A version in which ``unique`` columns repeat is not published. With ``by`` the
        table is bucketed by these columns from the start, each bucket in the order of
        ``sort``, so that readers skip parts of files too.
        """
        return self._replace(
            df,
            name,
            partition_by=partition_by,
            unique=unique,
            nullable_keys=nullable_keys,
            by=by,
            sort=sort,
        )

    def publish_snapshot(
        self, df: DataFrame, name: str, min_rows: int = 1
    ) -> DataFrame:
        """Replace the table only if the written copy is large enough."""
        return self._replace(df, name, min_rows=min_rows)

    def upsert(
        self,
        name: str,
        updates: DataFrame | None,
        keys: Sequence[str],
        fill_missing: bool = False,
        one_row_per_key: bool = True,
        nullable_keys: bool = False,
        by: Sequence[str] | None = None,
        changes: bool = False,
        batch: tuple[str, int] | None = None,
    ) -> DataFrame | None:
        """Insert new keys and replace known ones with the whole incoming row.

        Nothing happens without rows. The updates are written once to a staging
        folder, so the checks and the merge read the same stored rows. With
        ``one_row_per_key=False`` all rows of a key are replaced together; with
        ``nullable_keys`` a missing part of a key is a value. If another writer has
        published meanwhile, the updates are merged into its version.

        The table is bucketed by ``by``, columns of the key (all unless given). Buckets
        without a key of the updates keep their files. ``changes`` keeps the rows that were
        replaced (:meth:`before`). ``batch`` names a source and a number that grows with
        every delivery; a number that is not above the last published one is passed over.
        """
        if updates is None or self._delivered(name, batch):
            return self.read_if_exists(name)
        pointers = self._pointers(name)
        path = f"{self.root}/{name}/_staged-{uuid.uuid4().hex}"
        updates.write.parquet(path)
        staged = self.spark.read.schema(updates.schema).parquet(path)
        try:
            if not staged.head(1):
                return self.read_if_exists(name)
            if one_row_per_key:
                require_unique(staged, keys, nullable_keys)
            version = self._attempt(
                lambda: self._merge(
                    name, staged, staged.select(*keys), keys, by or keys, fill_missing, changes, batch
                )
            )
            return self.read(name, version)
        finally:
            pointers.remove(path)

    def replace(
        self,
        name: str,
        rows: DataFrame,
        touched: DataFrame,
        keys: Sequence[str],
        by: Sequence[str] | None = None,
        unique: Sequence[str] = (),
        nullable_keys: bool = False,
    ) -> DataFrame:
        """Take out all rows of the ``touched`` keys and put ``rows`` in.

        A touched key without a row is gone afterwards; every row has a touched key. Rows
        in which ``unique`` columns repeat are not published. Columns are those of the
        table.
        """
        pointers = self._pointers(name)
        staging = f"{self.root}/{name}/_staged-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(f"{staging}/rows")
            touched.select(*keys).distinct().write.parquet(f"{staging}/keys")
            staged = self.spark.read.schema(rows.schema).parquet(f"{staging}/rows")
            gone = self.spark.read.schema(touched.select(*keys).schema).parquet(f"{staging}/keys")
            if unique:
                require_unique(staged, unique, nullable_keys)
            version = self._attempt(
                lambda: self._merge(name, staged, gone, keys, by or keys, False, False, None)
            )
            return self.read(name, version)
        finally:
            pointers.remove(staging)

    def _delivered(self, name: str, batch: tuple[str, int] | None, content: dict | None = None) -> bool:
        if batch is None:
            return False
        if content is None:
            content = self._content(name, self._pointers(name).newest())
        return content.get("batches", {}).get(batch[0], -1) >= batch[1]

    def _merge(
        self,
        name: str,
        staged: DataFrame,
        touched: DataFrame,
        keys: Sequence[str],
        by: Sequence[str],
        fill_missing: bool,
        changes: bool,
        batch: tuple[str, int] | None,
    ) -> int:
        """Merge into the newest version, bucket by bucket, and publish the next one."""
        if not set(by) <= set(keys):
            raise ValueError("bucket columns must be part of the key")
        base = self._pointers(name).newest()
        old = self._content(name, base)
        if self._delivered(name, batch, old):
            return base
        kept = None
        if base:
            kept, staged = align_columns(self._load(name, old), staged, fill_missing)
        content = {
            "schema": staged.schema.jsonValue(),
            "by": list(by),
            "buckets": self.buckets,
            "parts": {},
            "batches": {**old.get("batches", {}), **dict([batch] if batch else [])},
        }
        if old.get("by") == list(by):
            content["buckets"], content["parts"] = old["buckets"], old["parts"]
            # files that lack a new column read as NULL in it, so untouched buckets stay
            numbers = _numbers(touched, _bucket(content))
            kept = self._load(name, {**old, "schema": content["schema"]}, numbers)
        else:
            numbers = set(content["parts"])
        folder = f"data-{uuid.uuid4().hex}"
        path, before = f"{self.root}/{name}/{folder}", None
        typed = touched.select(
            *[F.col(f.name).cast(f.dataType) for f in staged.schema if f.name in keys]
        )
        merged = staged if kept is None else not_matching(kept, typed, keys).unionByName(staged)
        self._write_buckets(merged, path, content)
        if changes and kept is not None:
            before = f"before-{uuid.uuid4().hex}"
            replaced = null_safe_join(kept, typed.distinct(), list(keys), "left_semi")
            replaced.write.parquet(f"{self.root}/{name}/{before}")
            content["before"] = before
        left = {b: f for b, f in content["parts"].items() if b not in numbers}
        content["parts"] = {**left, **dict.fromkeys(self._written(path), folder)}
        return self._publish(name, base, content, [folder, *([before] if before else [])])

    def drop(self, name: str) -> None:
        """Remove a table with all its versions."""
        self._pointers(name).remove(f"{self.root}/{name}")

    def prune(self, name: str, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` versions, and versions pinned by a snapshot.

        Folders that no remaining version names go too. Not while others write the table.
        """
        if keep < 1:
            raise ValueError("at least one version must be kept")
        pointers = self._pointers(name)
        versions = pointers.versions()
        pinned = {s.get(name) for s in map(self._pins, self._snapshots().versions())}
        stay = [v for v in versions if v in versions[-keep:] or v in pinned]
        used = {"_published"}
        for version in stay:
            content = self._content(name, version)
            used |= {content.get("folder"), content.get("before"), *content.get("parts", {}).values()}
        for version in set(versions) - set(stay):
            pointers.remove(f"{pointers.path}/v={version}")
        for folder in pointers.children(f"{self.root}/{name}"):
            if folder not in used:
                pointers.remove(f"{self.root}/{name}/{folder}")

    # -- all tables at once ------------------------------------------------------
    def _snapshots(self) -> Pointers:
        return Pointers(self.spark, f"{self.root}/{SNAPSHOTS}")

    def _pins(self, number: int) -> dict[str, int]:
        return json.loads(self._snapshots().read(number)) if number else {}

    def publish_all(
        self,
        names: Sequence[str] | None = None,
        min_rows: Mapping[str, int] | int = 1,
        versions: Mapping[str, int] | None = None,
    ) -> Snapshot:
        """Pin a version of every table, visible to readers of snapshots all at once.

        ``versions`` are those that a run has written; without it the newest of ``names``
        (all tables unless given) are taken, again if a table changed meanwhile. A table
        with fewer than ``min_rows`` rows, or none, stops the whole publication.
        """
        for _ in range(ATTEMPTS):
            base = self._snapshots().newest()
            wanted = list(names) if names is not None else self.names()
            pins = dict(versions) if versions else {n: self._pointers(n).newest() for n in wanted}
            for name, version in pins.items():
                least = min_rows if isinstance(min_rows, int) else min_rows.get(name, 1)
                found = self.read(name, version).count()
                if found < least:
                    raise ValueError(f"{name}: {found} rows, at least {least} needed")
            if not versions and pins != {n: self._pointers(n).newest() for n in wanted}:
                continue
            try:
                self._snapshots().publish(base + 1, json.dumps(pins))
                return Snapshot(self, pins)
            except Conflict:
                continue
        raise Conflict(f"tables under {self.root} kept changing")

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest published snapshot, or an earlier one."""
        chosen = self._snapshots().newest() if number is None else number
        if not chosen:
            raise ValueError(f"no snapshot under {self.root}")
        return Snapshot(self, self._pins(chosen))


class Snapshot:
    """One version of every table; what is published later is not seen."""

    def __init__(self, tables: Tables, pins: Mapping[str, int]):
        self.tables, self.pins = tables, dict(pins)

    def names(self) -> list[str]:
        return sorted(self.pins)

    def read(self, name: str) -> DataFrame:
        return self.tables.read(name, self.pins[name])

    def push(self, target: Tables, min_rows: Mapping[str, int] | int = 1) -> Snapshot:
        """Copy all tables to another place, where they become visible at once.

        Readers of snapshots there see the earlier one until every table is copied and
        large enough; a failed push leaves them with it.
        """
        versions = {}
        for name in self.names():
            target.overwrite(self.read(name), name)
            versions[name] = target.versions(name)[-1]
        return target.publish_all(min_rows=min_rows, versions=versions)


def _bucket(content: dict) -> Column:
    """Number of the bucket of a row, the same whatever integer type a key comes in."""
    types = {f["name"]: f["type"] for f in content["schema"]["fields"]}
    keys = [F.col(k).cast(types[k]) if isinstance(types[k], str) else F.col(k) for k in content["by"]]
    return F.pmod(F.xxhash64(*keys), F.lit(content["buckets"])).cast("int")


def _numbers(keys: DataFrame, bucket: Column) -> set[str]:
    """The buckets of keys: at most as many as the table has."""
    return {str(r[0]) for r in keys.select(bucket).distinct().collect()}


def read_path(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A Parquet table, reading only the named columns if any are given."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A live database table; filters and column choice are pushed to the database.

    With a numeric ``partition_column`` the read is split into ranges.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**(properties or {}))
    if partition_column:
        low, high = bounds or (0, partitions)
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.load()
