"""Small files and folder listings on whatever storage Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """Hadoop file system calls for one location: local disk, HDFS or a bucket."""

    def __init__(self, spark: SparkSession, location: str) -> None:
        self._jvm = spark._jvm
        self.location = location.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}".rstrip("/"))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """Names inside a folder, sorted; a missing folder is empty."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a small new file; of two writers of one name the store refuses the second."""
        try:
            stream = self._fs.create(self._path(name), False)
        except Py4JJavaError as exc:
            if "FileAlreadyExists" in str(exc.java_exception):
                raise FileExistsError(f"{self.location}/{name}") from exc
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str = "") -> bool:
        return self._fs.delete(self._path(name), True)
