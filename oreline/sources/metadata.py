"""Small metadata files that the driver keeps: listed, read, and created only where absent."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class MetadataFolder:
    """A folder of small files, on whatever file system the path names.

    :meth:`create` never replaces a file: locally it links a finished file to its name, elsewhere it renames one without
    overwriting, which has to be atomic there (as on HDFS).  Readers therefore see whole files only.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path
        self._folder = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._folder.getFileSystem(self._conf)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def names(self) -> list[str]:
        """Names of the finished files and folders, in order."""
        if not self._files.exists(self._folder):
            return []
        listed = (s.getPath().getName() for s in self._files.listStatus(self._folder))
        return sorted(n for n in listed if not n.startswith("."))

    def read(self, name: str) -> str:
        stream = self._files.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file unless there is one of that name; says whether it was written."""
        draft = self._child(f".{name}.{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._files.getUri().getScheme() == "file":
            return self._link(draft.toUri().getPath(), self._child(name).toUri().getPath(), draft)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, self._child(name), options)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _link(self, source: str, target: str, draft) -> bool:
        try:
            os.link(source, target)
        except FileExistsError:
            return False
        finally:
            self._files.delete(draft, False)
        return True

    def remove(self, name: str) -> None:
        self._files.delete(self._child(name), True)
