"""Files of a table's folder, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MOVES = 16  # file operations under way at a time


class Folder:
    """A folder of the session's file system; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._jvm = spark, spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = root.getFileSystem(conf)
        self._root = self._fs.makeQualified(root)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), conf)
        self.path = self._root.toString()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def child(self, name: str) -> str:
        return self._at(name).toString()

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def names(self, name: str = "") -> list[str]:
        """Names of the entries of a folder, sorted; none if it does not exist."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def data_files(self, name: str = "") -> list[str]:
        """Data files below a folder (no hidden ones, none in hidden folders), relative to this folder."""
        if not self.exists(name):
            return []
        found, at = [], self._fs.listFiles(self._at(name), True)
        base = self._at(name).toUri().getPath().rstrip("/")
        while at.hasNext():
            path = at.next().getPath().toUri().getPath()
            inside = path[len(base) + 1:]
            if not any(part.startswith(("_", ".")) for part in inside.split("/")):
                found.append(f"{name}/{inside}" if name else inside)
        return sorted(found)

    def relative(self, uri: str) -> str:
        """A file's name in this folder, from the encoded address that Spark gives."""
        path = self._jvm.java.net.URI(uri).getPath()
        root = self._root.toUri().getPath().rstrip("/")
        if not path.startswith(root + "/"):
            raise ValueError(f"{uri} is not below {self.path}")
        return path[len(root) + 1:]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file, whole or not at all; False if there is one of that name.

        The text is written beside it and renamed without overwriting, which is
        atomic where the file system's rename is.
        """
        beside = self._at(f"{name.rpartition('/')[0] or '.'}/.{uuid.uuid4().hex}")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self._rename(beside, self._at(name))
            return True
        except FileExistsError:
            self._fs.delete(beside, False)
            return False

    def _rename(self, source, target) -> None:
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 0)
        try:
            self._context.rename(source, target, none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise FileExistsError(target.toString()) from error
            raise

    def move(self, source: str, target: str) -> None:
        """Move a file; nothing to do if it has been moved before."""
        if not self.exists(source) and self.exists(target):
            return
        self._fs.mkdirs(self._at(target).getParent())
        try:
            self._rename(self._at(source), self._at(target))
        except (FileExistsError, Py4JJavaError):
            if self.exists(source) or not self.exists(target):  # not another's move of the same file
                raise

    def every(self, work, items: list) -> None:
        """Run file operations side by side; the first error is raised."""
        with ThreadPoolExecutor(MOVES) as pool:
            for _ in pool.map(work, items):
                pass
