"""Directory operations on the session's file systems (any scheme Spark can open).

Thin wrappers over Hadoop's ``FileSystem``, for the few places that move or
inspect directories rather than rows: publishing staged tables and preparing
damaged or renamed inputs in the registered queries. Only names pass through
the driver, never table rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, uri: str):
        path = self._jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self._conf), path

    def exists(self, uri: str) -> bool:
        fs, path = self._open(uri)
        return fs.exists(path)

    def children(self, uri: str) -> list[tuple[str, bool]]:
        """``(name, is_directory)`` of the entries directly under ``uri``, by name."""
        fs, path = self._open(uri)
        return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path))

    def move(self, source: str, target: str) -> None:
        """Rename ``source`` to ``target``, whose parent is made if needed; ``target`` must not exist."""
        fs, src = self._open(source)
        _, dst = self._open(target)
        if fs.exists(dst):
            raise FileExistsError(target)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, uri: str) -> None:
        fs, path = self._open(uri)
        fs.delete(path, True)

    def write(self, uri: str, content: bytes) -> None:
        """A whole (small) file."""
        fs, path = self._open(uri)
        out = fs.create(path, True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
