"""The few file system calls the driver makes, through Hadoop's FileSystem: any scheme Spark can write to."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# File system calls are waits, not work: this many run at once.
PARALLEL_CALLS = 32


def at_once(call, items: Iterable) -> list:
    """``call`` for every item, several at a time; results in item order, and the first failure is raised."""
    with ThreadPoolExecutor(PARALLEL_CALLS) as pool:
        return list(pool.map(call, items))


class Store:
    """File system of one uri."""

    def __init__(self, spark: SparkSession, uri: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.java.io
        self._as_text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString
        path = self._path(uri)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        # The local file system keeps checksum files beside the data unless it is unwrapped.
        self._fs = fs.getRaw() if fs.getUri().getScheme() == "file" else fs

    def _path(self, uri: str):
        return self._hadoop.Path("s3a" + uri[2:] if uri.startswith("s3://") else uri)

    def absolute(self, uri: str) -> str:
        return self._fs.makeQualified(self._path(uri)).toString()

    def exists(self, uri: str) -> bool:
        return self._fs.exists(self._path(uri))

    def make_folder(self, uri: str) -> None:
        self._fs.mkdirs(self._path(uri))

    def delete(self, uri: str) -> None:
        self._fs.delete(self._path(uri), True)

    def names(self, uri: str) -> list[str]:
        """Names in a folder. They cross from the JVM as one text, so that a long listing costs no more calls."""
        listed = self._hadoop.FileUtil.stat2Paths(self._fs.listStatus(self._path(uri)))
        text = self._as_text(listed)[1:-1]
        return [path.rsplit("/", 1)[-1] for path in text.split(",")] if text else []

    def move(self, source: str, target: str) -> None:
        """Put source at target, in place of what is there."""
        if not self._fs.rename(self._path(source), self._path(target)):
            self.delete(target)
            if not self._fs.rename(self._path(source), self._path(target)):
                raise OSError(f"could not move {source} to {target}")

    def write_lines(self, uri: str, lines: Iterable[str]) -> None:
        """A text file, complete or absent: it is written beside its place and moved in."""
        beside = f"{uri}.writing"
        out = self._io.BufferedWriter(self._io.OutputStreamWriter(self._fs.create(self._path(beside), True), "UTF-8"))
        try:
            block: list[str] = []
            for line in lines:
                block.append(line + "\n")
                if len(block) == 10_000:
                    out.write("".join(block))
                    block.clear()
            out.write("".join(block))
        finally:
            out.close()
        self.move(beside, uri)
