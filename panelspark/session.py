"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC keeps month arithmetic independent of the cluster's clock; adaptive execution
# sizes shuffles, picks broadcast sides from measured sizes and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app_name: str = "panelspark",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with :data:`SETTINGS`; leave ``master`` unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    ``fallback`` is used only where the setting is absent, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not path:
        raise ValueError("spark.checkpoint.dir is not set and no fallback was given")
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables in the session's shared folder.

    Only a session that runs in one process (tests) and names no shared folder gets one
    of its own; elsewhere a missing ``spark.checkpoint.dir`` is an error. The folder is
    removed when the driver ends.
    """
    master = spark.conf.get("spark.master", "")
    alone = master == "local" or master.startswith("local[")
    own = os.path.join(tempfile.gettempdir(), "panelspark") if alone else None
    path = f"{shared_dir(spark, own).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder and read back.

    For frames that are used several times; a lost executor re-reads files instead of
    running the plan again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SCRATCH: list[tuple[SparkSession, str]] = []


def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            where.getFileSystem(conf).delete(where, True)
        except Exception:  # noqa: BLE001 - the session has ended before
            return
