"""Exact duplicates by an extendible-hash index kept in shared files.

The 64-bit hash of a text is its key. A *directory* maps the leading bits of a key to a
bucket: it starts with one bucket, and as long as a bucket holds more bytes than allowed,
the directory is doubled and that bucket is split by one more bit. Every text is routed
to its bucket; the owner of a bucket compares bytes, so that texts which only share a key
become separate entries of one chain. The index keeps one entry per distinct text.

Copies are combined in the tasks that read them, so a text on a third of all rows costs
its bucket one entry per reading task. Documents find their entry by key; only where a
chain has several entries are bytes compared once more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .base import stored, words_text

#: Bytes of distinct text a bucket may hold before it is split.
BUCKET_BYTES = 32 << 20
#: Bits that one counting pass looks ahead; each is one doubling of the directory.
LOOK_AHEAD = 10
#: Up to this many entries the directory is sent to all tasks (16 bytes each).
SENT_ENTRIES = 1 << 17


def text_key(text: Column, bits: int = 64) -> Column:
    """Key of a text: its hash, of which only the leading ``bits`` differ."""
    key = F.xxhash64(text)
    if bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - bits), 64 - bits)
    return key


def leading(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


@dataclass
class Directory:
    """Buckets by their leading bits; ``depth`` is the number of bits the directory uses."""

    buckets: DataFrame  # depth, prefix, bytes, keys
    depth: int
    entries: int

    def slots(self) -> DataFrame:
        """One row per directory slot, pointing at its bucket."""
        spare = F.lit(self.depth) - F.col("depth")
        first = F.expr(f"shiftleft(prefix, {self.depth} - depth)")
        last = first + F.expr(f"shiftleft(1L, {self.depth} - depth)") - 1
        slots = self.buckets.select(
            F.explode(F.sequence(first, last)).alias("slot"),
            first.alias("bucket"),
            spare.alias("spare"),
        ).select("slot", "bucket")
        return F.broadcast(slots) if self.entries <= SENT_ENTRIES else slots


def build_directory(keys: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Directory:
    """Split buckets until none holds more than ``bucket_bytes``.

    ``keys`` has ``key`` and ``bytes``, a row per distinct key. A bucket with a single
    key is never split. One pass counts the next :data:`LOOK_AHEAD` bits of all buckets
    that are still too full and settles as many doublings.
    """
    full = (F.col("bytes") > bucket_bytes) & (F.col("keys") > 1)
    depth, done, pending = 0, [], None
    while True:
        rows = keys
        if pending is not None:
            rows = rows.withColumn("prefix", leading(F.col("key"), depth)).join(
                pending.select("prefix"), "prefix", "left_semi"
            )
        deep = min(64, depth + LOOK_AHEAD)
        cells = rows.groupBy(leading(F.col("key"), deep).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("keys")
        )
        levels = F.explode(F.sequence(F.lit(depth), F.lit(deep))).alias("depth")
        counts = stored(
            cells.select(levels, "cell", "bytes", "keys")
            .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {deep} - depth)"))
            .groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("bytes"), F.sum("keys").alias("keys")),
            "directory-counts",
        )
        split = counts.filter(full).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        settled = counts.filter(~full).withColumn(
            "parent", F.shiftrightunsigned("prefix", 1)
        )
        root = settled.filter(F.col("depth") == depth).drop("parent")
        done.append(
            settled.join(split, ["depth", "parent"], "left_semi").drop("parent").unionByName(root)
            if depth < deep
            else root
        )
        pending = counts.filter(full & (F.col("depth") == deep))
        if deep == 64 or pending.isEmpty():
            if deep == 64:  # keys are distinct, so this deep a bucket has one key
                done.append(pending)
            break
        depth = deep
    buckets = done[0]
    for more in done[1:]:
        buckets = buckets.unionByName(more)
    buckets = stored(buckets.select("depth", "prefix", "bytes", "keys"), "directory")
    deepest = buckets.agg(F.max("depth").alias("d")).first()["d"] or 0
    size = buckets.agg(
        F.sum(F.expr(f"shiftleft(1L, {deepest} - depth)")).alias("n")
    ).first()["n"]
    return Directory(buckets, deepest, size or 0)


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    key_bits: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """``(index, keys)``: an entry per distinct text, and ``id``, ``key`` of every row.

    An entry has ``bucket``, ``key``, ``chain`` (place among texts of that key),
    ``chain_length``, ``keep_id``, ``group_size`` and ``text_sha256``.
    """
    text = words_text(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn(
        "key", text_key(F.col("text"), key_bits)
    )
    keys = stored(
        rows.select("id", "key", F.octet_length("text").cast("long").alias("bytes")), "keys"
    )
    directory = build_directory(
        keys.groupBy("key").agg(F.max("bytes").alias("bytes")), bucket_bytes
    )
    entries = (
        rows.withColumn("slot", leading(F.col("key"), directory.depth))
        .join(directory.slots(), "slot")
        .groupBy("bucket", "key", "text")  # the grouping compares bytes
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "key", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))
    )
    chain = Window.partitionBy("bucket", "key")
    index = stored(
        entries.repartitionByRange("bucket")
        .withColumn("chain", F.row_number().over(chain.orderBy("keep_id", "text_sha256")))
        .withColumn("chain_length", F.count(F.lit(1)).over(chain)),
        "index",
    )
    return index, keys


def label_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    key_bits: int = 64,
) -> DataFrame:
    """A row per document: the row that stays of its group of equal texts.

    Null texts equal empty ones; of a group the row with the largest id stays
    (``kept``). A null id counts as the smallest; a group that has only null ids keeps
    its rows, and rows that repeat id and text are marked alike, as nothing tells them
    apart (:func:`deduplicate` leaves one of them). An empty table gives no rows.
    Other columns are not looked at.
    """
    index, keys = build_index(docs, id_col, text_col, bucket_bytes, key_bits)
    found = ["keep_id", "group_size", "text_sha256"]
    single = keys.select("id", "key").join(
        index.filter("chain_length = 1").select("key", *found), "key"
    )
    labels = single.select("id", *found)
    if not index.filter("chain_length > 1").isEmpty():
        labels = labels.unionByName(
            _chained(docs, index, id_col, text_col, key_bits).select("id", *found)
        )
    return labels.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _chained(docs, index, id_col, text_col, key_bits) -> DataFrame:
    """Rows whose key belongs to several texts, joined to their entry by bytes."""
    chained = index.filter("chain_length > 1").select("key").distinct()
    rows = (
        docs.select(F.col(id_col).alias("id"), words_text(text_col).alias("text"))
        .withColumn("key", text_key(F.col("text"), key_bits))
        .join(chained, "key", "left_semi")
    )
    groups = rows.groupBy("key", "text").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return rows.join(
        groups.withColumn("text_sha256", F.sha2("text", 256)), ["key", "text"]
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that stay, one of each group of equal texts, columns unchanged."""
    key_bits = options.get("key_bits", 64)
    index, keys = build_index(docs, id_col, text_col, **options)
    entries = index.select(
        F.col("key").alias("__key"),
        F.col("keep_id").alias("__keep"),
        F.col("text_sha256").alias("__sha"),
    )
    text = words_text(docs[text_col])
    rows = docs.withColumn("__key", text_key(text, key_bits)).withColumn(
        "__sha", F.sha2(text, 256)
    )
    kept = rows.join(
        entries,
        (rows["__key"] == entries["__key"])
        & (rows["__sha"] == entries["__sha"])
        & rows[id_col].eqNullSafe(entries["__keep"]),
        "left_semi",
    )
    repeated = (
        keys.join(index.select("key", "keep_id").distinct(), "key")
        .filter(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("key", "id")
        .count()
        .filter("count > 1")
    )
    if not repeated.isEmpty():  # rows that repeat id and text: one of them is enough
        kept = kept.dropDuplicates(["__key", "__sha"])
    return kept.select(*[kept[c] for c in docs.columns])
