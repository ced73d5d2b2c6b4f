"""Folders and files of any store Spark reaches, by Hadoop's FileSystem: never a machine's own disk."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

MOVES_AT_ONCE = 16


class Files:
    """The file system that holds ``base``; paths are full paths as Spark takes them."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly in a folder, in order; none where there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """A file or a folder, into a folder that is made if need be. An existing target is an error."""
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if self._fs.exists(to) or not self._fs.rename(self._path(source), to):
            raise OSError(f"cannot move {source} to {target}")

    def move_all(self, files: list[tuple[str, str]]) -> None:
        """Files, each to a name that no other file has; many at once, since a store may be far away."""
        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(self._fs.mkdirs, [self._path(p) for p in {to.rpartition("/")[0] for _, to in files}]))
            list(pool.map(lambda pair: self._rename(*pair), files))

    def _rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def mark(self, path: str) -> None:
        """An empty file."""
        self._fs.create(self._path(path), True).close()

    def delete(self, path: str) -> None:
        """A file, or a folder with all that is in it."""
        self._fs.delete(self._path(path), True)


def partition_folders(files: Files, folder: str) -> list[str]:
    """Paths of a table folder's partition folders, also where each run has a folder of its own above them."""
    found = []
    for name in files.names(folder):
        if partition_value(name, "run") is not None:
            found += partition_folders(files, f"{folder}/{name}")
        elif "=" in name:
            found.append(f"{folder}/{name}")
    return found


def partition_value(name: str, column: str) -> str | None:
    """The value in a folder name ``column=value``; None for other names and for missing values."""
    key, sep, value = name.partition("=")
    return value if sep and key == column and value != "__HIVE_DEFAULT_PARTITION__" else None
