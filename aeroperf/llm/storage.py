"""Shared scratch space: written tables that cut lineage, and files that executors write.

Everything lies below ``spark.checkpoint.dir``, which a cluster shares between
the driver and the executors. Where it is unset in local mode (tests, a laptop)
a temporary folder takes its place; on a cluster that is an error.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors see."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(_LOCAL[app])
    return _LOCAL[app]


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex[:12]}"


def make_folder(spark: SparkSession, folder: str) -> str:
    """``folder``, which is there from now on, also where no task writes to it."""
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), spark.sparkContext._jsc.hadoopConfiguration()
    path.getFileSystem(conf).mkdirs(path)
    return folder


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more: Spark removes them when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI, on whichever machine this runs."""
    if uri.startswith("file:/") and not uri.startswith("file://"):  # Hadoop's spelling
        uri = uri[5:]
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else os.path.abspath(uri))


class AtomicFile:
    """A file that appears under its name only when whole, so that a retried or speculative task is harmless."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        self.fs.create_dir(root, recursive=True)
        self.final, self.part = f"{root}/{name}", f"{root}/_{name}.{uuid.uuid4().hex[:8]}"
        self.out, self.size = self.fs.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.final)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length of the whole files in ``folder``; their content is not read."""
    found = spark.read.format("binaryFile").load(folder)
    return found.select("path", "length")
