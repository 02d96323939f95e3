"""Published versions of a table: one small file per version, created exclusively.

The file of version N holds what readers need (a folder, a list of folders). It is
written under another name and renamed without overwriting, so that it appears complete,
and of two writers that start from one version only the first can publish the next. File
systems whose rename is atomic (HDFS) give this guarantee fully.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has published this version."""


class Pointers:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return where.getFileSystem(conf), where

    def children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where))

    def remove(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    def rename(self, source: str, target: str) -> None:
        fs, where = self._fs(source)
        _, to = self._fs(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(where, to):
            raise OSError(f"cannot rename {source} to {target}")

    def touch(self, name: str) -> None:
        """Mark a name as used now."""
        fs, where = self._fs(f"{self.path}/{name}")
        fs.create(where, True).close()

    def touched(self) -> dict[str, int]:
        """When each marked name was last used, in milliseconds."""
        fs, where = self._fs(self.path)
        if not fs.exists(where):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(where)}

    def versions(self) -> list[int]:
        marks = self.children(self.path)
        return sorted(int(m.removeprefix("v=")) for m in marks if m.startswith("v="))

    def newest(self) -> int:
        return max(self.versions(), default=0)

    def read(self, version: int) -> str:
        return self.text(f"{self.path}/v={version}")

    def text(self, path: str) -> str:
        """Content of a small file."""
        fs, where = self._fs(path)
        stream = fs.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, version: int, content: str) -> None:
        """Make a version visible; :class:`Conflict` if another writer has.

        A rename may take effect and still raise. The content of the version tells whose
        it is, because writers name folders of their own in it.
        """
        jvm = self.spark._jvm
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        fs, where = self._fs(draft)
        out = fs.create(where, False)
        out.write(bytearray(content.encode("utf-8")))
        out.close()
        _, target = self._fs(f"{self.path}/v={version}")
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never[0] = kinds.NONE
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        try:
            context.rename(where, target, never)
        except Exception as e:
            if not fs.exists(target):
                raise
            if self.read(version) == content:
                return
            fs.delete(where, False)
            raise Conflict(version) from e
