"""Incremental file ingest in place of polling."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedupe import first_per_key
from ..sources.pointers import Pointers
from ..sources.tables import Tables


def stream_upsert(
    spark: SparkSession,
    source_dir: str,
    schema: str | StructType,
    tables: Tables,
    name: str,
    keys: Sequence[str],
    checkpoint: str,
    newest_first: Sequence[Column | str] = (),
    fmt: str = "json",
    fill_missing: bool = True,
) -> StreamingQuery:
    """Upsert every file not seen before, then stop.

    A late or corrected report replaces the stored row. Within one batch the first row
    per key in ``newest_first`` order is taken. The number of a batch is published together
    with its rows, under the id that the checkpoint gives the stream: a batch that is
    delivered again, as after a crash between publishing and the checkpoint, publishes
    nothing. Each batch rewrites only the buckets of its keys.
    """
    marks = Pointers(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = json.loads(marks.text(f"{marks.path}/metadata"))["id"]
        rows = first_per_key(batch, keys, newest_first)
        tables.upsert(name, rows, keys, fill_missing, batch=(stream_id, batch_id))

    stream = spark.readStream.format(fmt).schema(schema).load(source_dir)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
