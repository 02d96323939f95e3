"""CSV, raw documents, nested documents and bulk export."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .tables import Tables

NULL_TEXT = "NA"
#: Raw documents in one folder.
FOLDER_FILES = 1000
#: Names, and bytes of raw documents, that a task hands on at once.
LISTED_NAMES, READ_BYTES = 10_000, 8 << 20
#: What Spark escapes in names of files: signs that an address cannot hold, spaces, controls.
ESCAPED = re.compile(
    r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"""
)


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Headered CSV with ``NA`` for missing; the schema is given, never inferred."""
    return spark.read.csv(path, schema=schema, header=True, nullValue=NULL_TEXT)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, nullValue=NULL_TEXT, compression=compression
    )


def export_all(
    tables: Tables,
    path: str,
    names: Iterable[str] | None = None,
    parallel: int = 4,
    compression: str = "gzip",
) -> list[str]:
    """Every table as headered compressed CSV, several tables at a time."""
    chosen = sorted(names if names is not None else tables.names())

    def export(name: str) -> str:
        target = f"{path.rstrip('/')}/{name}.csv"
        write_csv(tables.read(name), target, compression)
        return target

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(export, chosen))


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("disease", "country_iso3c"),
    rows_per_file: int = 1_000_000,
) -> None:
    """One folder per key combination.

    Rows are clustered by key before writing, so that a task does not open a file for
    every key; adaptive execution splits keys too large for one task.
    """
    clustered = df.hint("rebalance", *by)
    writer = clustered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*by).parquet(path)


def file_system(path: str):
    """pyarrow's file system of a path or address, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_raw_documents(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Every row's text as a file of its own, ``part-<task>-<row>.txt``, in a new folder.

    Files are opened by ``pyarrow.fs``: Spark's writer commits, checks and sets rights per
    file, on a local disk by starting processes. They lie in partition folders of at most
    :data:`FOLDER_FILES`, so that listings are shared out, under one folder for each attempt
    of a task; folders of attempts that failed are removed. A null text gives an empty file,
    which Spark's readers skip.
    """
    from pyarrow import fs

    store, top = file_system(path)
    if store.get_file_info(top).type != fs.FileType.NotFound:
        raise ValueError(f"{path} exists")
    store.create_dir(top)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        here = TaskContext.get()
        own, files, attempt = file_system(path)[0], 0, f"task={here.taskAttemptId()}"
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                folder = f"{top}/{attempt}/folder={files // FOLDER_FILES}"
                if files % FOLDER_FILES == 0:
                    own.create_dir(folder)
                name = f"part-{here.partitionId():05d}-{files:09d}.txt"
                with own.open_output_stream(f"{folder}/{name}") as out:
                    out.write(text.as_buffer() if text.is_valid else b"")
                files += 1
        yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    kept = {r.attempt for r in df.select(text_col).mapInArrow(write, "attempt string").collect()}
    for found in store.get_file_info(fs.FileSelector(top)):
        if found.base_name not in kept:
            store.delete_dir(found.path)


def _reached(spark: SparkSession, path: str) -> str | None:
    """The whole address of a folder, if ``pyarrow.fs`` reaches it."""
    import pyarrow as pa
    from pyarrow import fs

    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        address = store.makeQualified(where).toString()
        own, folder = file_system(address)
        return address if own.get_file_info(folder).type == fs.FileType.Directory else None
    except (Py4JJavaError, pa.ArrowInvalid, NotImplementedError, OSError):
        return None


def _entries(store, top: str, folder: str) -> Iterator[tuple[str, bool]]:
    """Files to be read in a folder, and the folders in it; true for a folder.

    As in Spark's readers: names that begin with a dot or an underscore are passed over
    (``_name=value`` is not), and so are empty files. Below the top, only files in a
    partition folder ``name=value`` or further down count.
    """
    from pyarrow import fs

    counts = folder == top or "=" in folder[len(top) :]
    for found in store.get_file_info(fs.FileSelector(folder)):
        name = found.base_name
        if name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name):
            continue
        if found.type == fs.FileType.Directory:
            yield found.path, True
        elif counts and found.size:
            yield found.path, False


def _files_below(store, top: str, folder: str) -> Iterator[str]:
    ahead = [folder]
    while ahead:
        for path, is_folder in _entries(store, top, ahead.pop()):
            if is_folder:
                ahead.append(path)
            else:
                yield path


def read_raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its name, escaped as Spark does it, and whole text.

    Files are listed and opened in tasks through ``pyarrow.fs``: the driver sees no names,
    which would fill its memory. One task lists the folder itself, others what lies in its
    folders, and the names are dealt over as many tasks as the session has shuffle
    partitions. A folder's names are held by the task that lists it. Files are listed again
    whenever the result is computed; one that has gone by then is an error.

    Where ``pyarrow.fs`` does not reach, and of a pattern or a single file, Spark's reader
    lists the files on the driver.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    address = _reached(spark, path)
    if address is None:
        files = spark.read.format("binaryFile").load(path)
        named = files.select(
            F.col("_metadata.file_name").alias("file_name"), F.col("content").cast("string").alias("value")
        )
        return named.coalesce(tasks)

    def place() -> tuple:
        store, top = file_system(address)
        return store, top.rstrip("/")

    def list_top(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for _ in batches:
            found = _entries(*place(), place()[1])
            while some := list(islice(found, LISTED_NAMES)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some)], ["path", "is_folder"])

    def list_below(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, top = place()
        for batch in batches:
            paths, folders = (c.to_pylist() for c in batch.columns)
            found = (f for p, deep in zip(paths, folders) for f in (_files_below(store, top, p) if deep else [p]))
            while some := list(islice(found, LISTED_NAMES)):
                yield pa.RecordBatch.from_pydict({"path": some})

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store = place()[0]
        names, texts, held = [], [], 0
        for batch in batches:
            for found in batch.column(0).to_pylist():
                # without None, a name that ends in .gz would have the bytes unpacked
                with store.open_input_stream(found, compression=None) as file:
                    texts.append(file.read())
                names.append(ESCAPED.sub(lambda c: quote(c[0]), found.rsplit("/", 1)[-1]))
                held += len(texts[-1])
                if held >= READ_BYTES or len(names) == LISTED_NAMES:
                    yield pa.RecordBatch.from_pydict({"file_name": names, "content": texts})
                    names, texts, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_pydict({"file_name": names, "content": texts})

    top = spark.range(0, 1, 1, 1).mapInArrow(list_top, "path string, is_folder boolean")
    paths = top.repartition(tasks).mapInArrow(list_below, "path string").repartition(tasks)
    return paths.mapInArrow(read, "file_name string, content binary").select(
        "file_name", F.col("content").cast("string").alias("value")
    )


def read_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Nested documents exported as JSON lines."""
    return spark.read.json(path, schema=schema)
