"""Folders and small files in the store that a path names, by way of Hadoop's FileSystem: it knows every store that Spark reads.

Only names, sizes and files of a few bytes pass through the driver; tables don't.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, spark.checkpoint.dir; where that is unset and all runs in one process, in a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="kwloom-store-")
            atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
        root = f"file://{_LOCAL[app]}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def released(spark: SparkSession):
    """Within it, a query's shuffle files go when it has ended, as Spark's own setting for that says: for steps that each end in a checkpoint or a written table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def dealt(rows: DataFrame, key: str, parts: int, store: Store, name: str):
    """Within it, the rows as a table in `parts` buckets by key, written under a name of the store: what groups them by key, then, needs no shuffle."""
    spark, table = rows.sparkSession, f"kwloom_{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").option("path", store.at(name)).bucketBy(parts, key).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"drop table {table}")
        store.delete(name)


class Store:
    """The file system of one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(self.at(name)))

    def names(self, name: str = "") -> list[str]:
        """The names in a folder, sorted; none if it isn't there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(self.at(name))))

    def rename(self, old: str, new: str) -> bool:
        """Whether old is now new: not if new was there or old wasn't."""
        if self.exists(new) or not self.exists(old):
            return False
        target = self._path(self.at(new))
        self.fs.mkdirs(target.getParent())
        return self.fs.rename(self._path(self.at(old)), target)

    def copy(self, old: str, new: str) -> None:
        """A folder copied file by file."""
        conf, util = self.fs.getConf(), self.jvm.org.apache.hadoop.fs.FileUtil
        util.copy(self.fs, self._path(self.at(old)), self.fs, self._path(self.at(new)), False, conf)

    def delete(self, name: str) -> bool:
        return self.fs.delete(self._path(self.at(name)), True)

    def create(self, name: str, text: str) -> bool:
        """Write a small file under a name that isn't taken; False, and nothing written, if it is. The file shows whole or not at all."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        self.fs.mkdirs(self._path(self.at(name)).getParent())
        out = self.fs.create(self._path(self.at(draft)), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.rename(draft, name):
            return True
        self.delete(draft)
        return False

    def read(self, name: str) -> str:
        path = self._path(self.at(name))
        size = self.fs.getFileStatus(path).getLen()
        into = self.jvm.java.io.ByteArrayOutputStream(int(size))
        source = self.fs.open(path)
        try:
            self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, into, 4096, False)
        finally:
            source.close()
        return bytes(into.toByteArray()).decode()
