"""Small files and folders on any file system Spark can reach, read and made by the driver."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of the store; paths are given below it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._hadoop.Path(self.root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(f"{self.root}/{path}" if path else self.root)

    def make(self, path: str = "") -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it does not exist.  Hidden ones are left out."""
        if not self._fs.exists(self._path(path)):
            return []
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(path))]
        return sorted(name for name in found if name[0] not in "._")

    def modified(self, path: str) -> float:
        """Seconds since 1970 of the last change."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a whole file unless one of its name exists, and say whether it was written.

        The file appears by a rename that does not overwrite, which file systems with
        atomic renames do in one step.
        """
        folder, _, name = path.rpartition("/")
        draft = self._path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        stream.write(text.encode())
        stream.close()
        rename = getattr(self._hadoop, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            context.rename(draft, self._path(path), options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            kind = error.java_exception.getClass().getSimpleName()
            if kind != "FileAlreadyExistsException":
                raise
            return False
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
