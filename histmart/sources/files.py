"""Renames and deletes on the file system that holds a table, through Hadoop's API.

A rename is atomic on HDFS and local disks. On object stores it is a copy file
by file, so a crash in the middle of one can leave a folder in two places.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """One path on its file system."""

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self._jvm = sc._jvm
        self.path = self._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(sc._jsc.hadoopConfiguration())

    def _of(self, child: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path, child) if child else self.path

    def exists(self, child: str = "") -> bool:
        return self.fs.exists(self._of(child))

    def is_dir(self) -> bool:
        return self.exists() and self.fs.getFileStatus(self.path).isDirectory()

    def has_files(self) -> bool:
        """True where the folder holds a data file at any depth (or is a file itself)."""
        if not self.exists():
            return False
        files, top = self.fs.listFiles(self.path, True), self.fs.getFileStatus(self.path).getPath().toString()
        while files.hasNext():
            below = files.next().getPath().toString()[len(top):].strip("/").split("/")
            if not any(x.startswith(".") or (x.startswith("_") and "=" not in x) for x in below):
                return True
        return False

    def write_text(self, text: str) -> None:
        """Replace the file at this path by ASCII text; it is there whole or not at all."""
        beside = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}.part")
        out = self.fs.create(beside, True)
        out.writeBytes(text)
        out.close()
        if not self.fs.rename(beside, self.path):
            raise OSError(f"cannot write {self.path}")

    def read_text(self) -> str:
        stream = self.fs.open(self.path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, child: str = "") -> None:
        self.fs.delete(self._of(child), True)

    def move(self, child: str, target: "Folder", to: str) -> None:
        destination = target._of(to)
        self.fs.mkdirs(destination.getParent())
        if not self.fs.rename(self._of(child), destination):
            raise OSError(f"cannot rename {self._of(child)} to {destination}")

    def children(self) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.path)]

    def leaves(self, below: str = "") -> list[str]:
        """Relative partition folders (``a=1/b=2``) that hold files."""
        out: list[str] = []
        for status in self.fs.listStatus(self._of(below)):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                out += self.leaves(f"{below}/{name}" if below else name)
            elif below and below not in out and not name.startswith(("_", ".")):
                out.append(below)
        return out
