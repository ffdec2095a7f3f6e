"""Small metadata files and folders, on whatever file system the table root lies."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    size: int
    modified_ms: int


class Files:
    """Thin calls to Hadoop's file system. Only metadata goes through here, never table rows."""

    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self._gateway = context._gateway
        self._hadoop = context._jvm.org.apache.hadoop.fs
        conf = context._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._atomic = self._hadoop.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def listing(self, folder: str) -> list[Entry]:
        """Entries of a folder; none if it does not exist."""
        if not self.exists(folder):
            return []
        return [
            Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime())
            for s in self._fs.listStatus(self._path(folder))
        ]

    def bytes_in(self, folder: str) -> int:
        """Size of all files below a folder that exists, in one call."""
        return self._fs.getContentSummary(self._path(folder)).getLength()

    def folder_names(self, folder: str) -> list[str]:
        """Names of the folders in a folder that exists; fewer calls per entry than `listing`."""
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()]

    def read_json(self, path: str) -> dict | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, path: str, content: dict) -> None:
        """Write beside `path`, then rename over it, so readers see the old or the new file."""
        stream = self._fs.create(self._path(f"{path}.tmp"), True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        self.replace(f"{path}.tmp", path)

    def replace(self, source: str, target: str) -> None:
        """Rename over an existing file in one step. Local file systems and HDFS can; object stores cannot."""
        rename = self._hadoop.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._atomic.rename(self._path(source), self._path(target), options)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename to a name that is not taken, in one step."""
        self._atomic.rename(self._path(source), self._path(target), self._gateway.new_array(self._hadoop.Options.Rename, 0))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))
