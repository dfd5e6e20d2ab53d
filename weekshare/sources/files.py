"""Small file operations on the file system Spark writes to.

Only names travel through the driver, never data. They use the session's
Hadoop file system, so they work wherever the session can write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """File operations for paths on the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def remove(self, path: str) -> None:
        """Delete a folder this job wrote, if it is there."""
        if self.exists(path):
            self._fs.delete(self._path(path), True)

    def only_file(self, folder: str, suffix: str) -> str | None:
        """The one part file of a folder; None if there is none."""
        if not self.exists(folder):
            return None
        parts = [p for p in (s.getPath() for s in self._fs.listStatus(self._path(folder)))
                 if p.getName().startswith("part-") and p.getName().endswith(suffix)]
        if len(parts) > 1:
            raise RuntimeError(f"expected one part file in {folder}, found {len(parts)}")
        return parts[0].toString() if parts else None

    def swap(self, new: str, target: str) -> None:
        """Put ``new`` in the place of ``target``; the old one is kept under
        another name until the new one is there, and put back if that fails."""
        old = f"{target}.old-{uuid.uuid4().hex}"
        had = self.exists(target)
        if had and not self._fs.rename(self._path(target), self._path(old)):
            raise RuntimeError(f"could not set {target} aside")
        if not self._fs.rename(self._path(new), self._path(target)):
            if had:
                self._fs.rename(self._path(old), self._path(target))
            raise RuntimeError(f"could not move {new} to {target}")
        if had:
            self._fs.delete(self._path(old), True)
