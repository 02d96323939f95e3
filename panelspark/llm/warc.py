"""WARC archives: writing, normalising whole-file gzip, and reading by offset.

Spark's text writer gives one gzip stream per file, the layout in which no record can be
reached without inflating all before it. :func:`normalise` inflates such a stream once,
front to back, writes every record as a gzip member of its own, and puts a sidecar index of
offsets beside the archive; :func:`read_records` seeks to the members that it is asked for.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .base import stored, utf8, words_text

#: Smallest payload that may be replaced by a reference to an equal one.
REVISIT_BYTES = 100
#: Groups of copies joined by broadcast; any other group has a smaller share of the rows.
LARGEST = 1000
#: Bytes of an archive that one task reads.
SEGMENT = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "archive string, offset long, length long, record_id string, record_type string,"
    " target_uri string, refers_to string, payload_digest string"
)
RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string,"
    " payload_bytes long, payload_digest string, payload binary"
)


# -- which records revisit others ----------------------------------------------------------


def find_revisits(pages: DataFrame, id_col: str, payload: Column) -> DataFrame:
    """``id``, ``digest`` and ``first`` of the pages whose payload an earlier page has.

    Earlier is a smaller id. Payloads under ``REVISIT_BYTES`` refer to nothing. A group of
    copies may hold any share of the rows: groups are found by sums that combine before the
    shuffle, and the ``LARGEST`` ones reach their rows by broadcast, so that every group
    left to the shuffle join holds less than one row in ``LARGEST``.
    """
    slim = pages.select(
        F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")
    )
    slim = stored(slim.filter(F.col("n") >= REVISIT_BYTES).drop("n"), "digests")
    groups = slim.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    groups = stored(groups.filter("rows > 1"), "copies")
    large = groups.orderBy(F.desc("rows"), "digest").limit(LARGEST).select("digest", "first")
    small = groups.select("digest", "first").join(F.broadcast(large), "digest", "left_anti")
    hot = slim.join(F.broadcast(large), "digest")
    cold = slim.join(F.broadcast(large), "digest", "left_anti").join(small, "digest")
    both = hot.unionByName(cold).filter(~F.col("id").eqNullSafe(F.col("first")))
    return both.distinct()


# -- writing ------------------------------------------------------------------------------


def record_texts(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, date: str) -> DataFrame:
    """One WARC record per page as column ``record``, without its last line feed.

    Null payloads are empty, a null address gives no address line, and line breaks in an
    address are percent-encoded. Null ids are written as an empty name, repeated ids as
    records with one name; all of those with a group's smallest id keep their payload.
    """
    payload = words_text(payload_col)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(uri_col).cast("string").alias("uri"),
        payload.alias("payload"),
        F.sha2(utf8(payload), 256).alias("digest"),
    )
    revisits = find_revisits(pages, id_col, utf8(payload_col))
    same = rows["id"].eqNullSafe(revisits["id"]) & (rows["digest"] == revisits["digest"])
    rows = rows.join(revisits, same, "left").select(rows["*"], revisits["first"])
    end = "\r\n"
    uri = F.replace(F.replace("uri", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(end * 2),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))

    def line(name: str, value: Column, only: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit(end))
        return text if only is None else F.when(only, text).otherwise("")

    def name_of(c: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    head = [
        F.lit(f"WARC/1.1{end}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name_of("id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.coalesce(uri, F.lit("")), F.col("uri").isNotNull()),
        line("WARC-Profile", F.lit(PROFILE), revisit),
        line("WARC-Refers-To", name_of("first"), revisit),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
    ]
    rows = rows.withColumn("block", block)
    return rows.select(F.concat(*head, F.lit(end), "block", F.lit("\r\n\r")).alias("record"))


def write_archives(records: DataFrame, folder: str) -> None:
    """Write :func:`record_texts` as one gzip stream per partition."""
    records.write.option("compression", "gzip").option("lineSep", "\n").text(folder)


# -- normalising ----------------------------------------------------------------------------


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file that tasks reach without Spark's readers."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" and rest.startswith("/"):
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


class Parser:
    """Records of a WARC stream that arrives line by line; nothing is kept beyond a line."""

    def __init__(self, place: str):
        self.place, self.head, self.left, self.inside = place, [], 0, False

    def feed(self, line: bytes) -> Iterator[tuple[str, bytes]]:
        """``head`` once per record, then its ``block`` in pieces, then ``end``."""
        if self.inside:
            piece, line = line[: self.left], line[self.left :]
            if piece:
                self.left -= len(piece)
                yield "block", piece
            if self.left:
                return
            self.inside = False
            yield "end", b""
        if not self.head and not line.strip(b"\r\n"):
            return
        if not self.head and not line.startswith(b"WARC/"):
            raise ValueError(f"{self.place}: no record begins with {line[:40]!r}")
        self.head.append(line)
        if line.strip(b"\r\n"):
            return
        head, self.head = b"".join(self.head), []
        self.left, self.inside = int(fields(head)["content-length"]), True
        yield "head", head
        if not self.left:
            self.inside = False
            yield "end", b""

    def close(self) -> None:
        if self.inside or self.head:
            raise ValueError(f"{self.place}: the last record is cut short")


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a header, names in lower case; the first line is skipped."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\n")[1:]:
        name, mark, value = line.partition(":")
        if mark:
            out[name.strip().lower()] = value.strip()
    return out


def named(value: str | None) -> str | None:
    return None if value is None else value.strip("<>")


class Normaliser:
    """Writes the records of one archive as members, and their places beside it.

    Both files appear under their names only when complete, so that a task that ran twice
    leaves the same two files.
    """

    def __init__(self, source: str, folder: str):
        name = posixpath.basename(source)
        for ending in (".gz", ".txt", ".warc"):
            name = name.removesuffix(ending)
        self.path = f"{folder.rstrip('/')}/{name}.warc.gz"
        self.store, self.final = opened(self.path)
        self.part = f"{self.final}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.part, compression=None)
        self.index = self.store.open_output_stream(self.part + ".idx", compression=None)
        self.parser, self.at, self.records = Parser(source), 0, 0

    def take(self, line: bytes) -> None:
        for what, data in self.parser.feed(line):
            if what == "head":
                # fixed level and no time: the same record always gives the same member
                self.member, self.size, self.top = zlib.compressobj(6, wbits=31), 0, fields(data)
            elif what == "end":
                data = b"\r\n\r\n"
            made = self.member.compress(data)
            if what == "end":
                made += self.member.flush()
            self.out.write(made)
            self.size += len(made)
            if what == "end":
                self.note()

    def note(self) -> None:
        row = {
            "archive": self.path,
            "offset": self.at,
            "length": self.size,
            "record_id": named(self.top.get("warc-record-id")),
            "record_type": self.top.get("warc-type"),
            "target_uri": self.top.get("warc-target-uri"),
            "refers_to": named(self.top.get("warc-refers-to")),
            "payload_digest": (self.top.get("warc-payload-digest") or "").removeprefix("sha256:"),
        }
        self.index.write(json.dumps(row, ensure_ascii=False).encode() + b"\n")
        self.at += self.size
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.parser.close()
        self.out.close()
        self.index.close()
        self.store.move(self.part + ".idx", self.final + ".idx")
        self.store.move(self.part, self.final)
        return self.path, self.records, self.at


def normalise(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """Rewrite the gzip archives of ``source`` in ``folder``, a member per record, at once.

    Spark's reader inflates each file as a stream, in one task, because gzip cannot be
    entered in the middle; the task holds one line at a time (text without a line feed is
    one line). One row per archive: ``archive``, ``records``, ``bytes``; beside each lies
    ``<archive>.idx`` with one line per record. Empty files give empty archives or none. A
    record that is cut short or does not begin where it should raises ``ValueError``.
    The folder must be one that tasks can write, like ``spark.checkpoint.dir``.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary"))
    store, place = opened(folder)
    store.create_dir(place, recursive=True)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one, name, made = None, None, []
        for batch in batches:
            for path, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != name:
                    if open_one:
                        made.append(open_one.close())
                    open_one, name = Normaliser(path, folder), path
                open_one.take(line + b"\n")
        if open_one:
            made.append(open_one.close())
        rows = [pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.int64(), pa.int64()))]
        if rows:
            yield pa.RecordBatch.from_arrays(rows, ["archive", "records", "bytes"])

    return stored(lines.mapInArrow(rewrite, "archive string, records long, bytes long"), "archives")


# -- reading --------------------------------------------------------------------------------


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of the archives in ``folder``, one row per record."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(folder)


def _parsed(member: bytes) -> tuple:
    head, _, rest = member.partition(b"\r\n\r\n")
    top = fields(head)
    block = rest[: int(top["content-length"])]
    kind = top.get("warc-type")
    http, payload, size = b"", block, len(block)
    if top.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
    if kind == "revisit":
        payload = None
        size = int(fields(http).get("content-length", 0))
        digest = (top.get("warc-payload-digest") or "").removeprefix("sha256:")
    else:
        digest = hashlib.sha256(payload).hexdigest()
    names = (top.get("warc-record-id"), top.get("warc-refers-to"))
    return named(names[0]), kind, top.get("warc-target-uri"), named(names[1]), size, digest, payload


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of an index name, each inflated from its own member.

    ``record_id``, ``record_type``, ``target_uri``, ``refers_to`` and of the full payload
    ``payload_bytes`` and ``payload_digest``: computed from the bytes for a response, as
    stored with it for a revisit, whose ``payload`` is null. Without ``payloads`` that
    column is null throughout and no bytes leave the task. A part of an index, filtered in
    any way, reads only its records; archives are read in segments of ``SEGMENT`` bytes, so
    that a large one is shared by many tasks.
    """
    wanted = index.select("archive", "offset", "length", F.expr(f"offset div {SEGMENT}").alias("segment"))
    wanted = wanted.repartition("archive", "segment").sortWithinPartitions("archive", "offset")
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(",")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            rows, held = [], 0
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns[:3])):
                if archive != name:
                    if source:
                        source.close()
                    store, path = opened(archive)
                    name, source = archive, store.open_input_file(path)
                member = zlib.decompress(source.read_at(length, offset), wbits=31)
                row = _parsed(member)
                rows.append(row if payloads else (*row[:6], None))
                held += len(member) if payloads else 0
                if held > SEGMENT:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)
        if source:
            source.close()

    return wanted.mapInArrow(read, RECORD)
