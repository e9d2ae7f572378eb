"""The few file-system calls Spark has no DataFrame form for, on whatever store the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Existence, deletion, rename and small text files through the session's Hadoop client."""

    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._jvm = self._gateway.jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)

    def children(self, path: str) -> list[str]:
        """Names directly under a folder; none if it does not exist."""
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._system(path).listStatus(self._path(path))]

    def first_data_file(self, path: str) -> str | None:
        """A visible file with contents: the path itself, or one under it. Looks no further than the first."""
        found = self._system(path).listStatusIterator(self._path(path))
        while found.hasNext():
            status = found.next()
            if status.isFile() and status.getLen() and not status.getPath().getName().startswith(("_", ".")):
                return status.getPath().toString()
        return None

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder to a path that does not exist yet."""
        system = self._system(target)
        system.mkdirs(self._path(target).getParent())
        if not system.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def read_text(self, path: str) -> str:
        stream = self._system(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str, token: str) -> None:
        """Write a small file beside ``path`` and rename it over, so readers see old or new."""
        staged = f"{path}.{token}"
        stream = self._system(path).create(self._path(staged), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(path).toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        system = self._system(path)
        context.rename(system.makeQualified(self._path(staged)), system.makeQualified(self._path(path)), options)
