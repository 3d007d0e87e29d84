"""Folders and files on whatever file system a path names, and intermediate results there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Storage:
    """Exists, read, write, rename and delete by path, through Hadoop's file system API."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _open(self, path: str):
        name = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return name.getFileSystem(self._spark._jsc.hadoopConfiguration()), name

    def exists(self, path: str) -> bool:
        system, name = self._open(path)
        return system.exists(name)

    def rename(self, path: str, new_path: str) -> None:
        system, name = self._open(path)
        if not system.rename(name, self._open(new_path)[1]):
            raise OSError(f"could not rename {path} to {new_path}")

    def delete(self, path: str) -> None:
        system, name = self._open(path)
        if not system.delete(name, True):
            raise OSError(f"could not delete {path}")

    def names(self, path: str) -> list[str]:
        """Names of the entries directly in a folder."""
        system, name = self._open(path)
        return [entry.getPath().getName() for entry in system.listStatus(name)]

    def make_folder(self, path: str) -> None:
        system, name = self._open(path)
        system.mkdirs(name)

    def write_text(self, path: str, text: str) -> None:
        system, name = self._open(path)
        out = system.create(name, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        system, name = self._open(path)
        source = system.open(name)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder name that every executor can reach.

    The parent is ``spark.checkpoint.dir``, else the session's checkpoint folder.  Only a local
    session without either may use a folder on this machine; on a cluster that is an error,
    since each executor would write to a disk of its own.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        parent = spark.sparkContext.getCheckpointDir()
    if not parent:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        parent = tempfile.mkdtemp(prefix="tarnkeep-")
    return f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``frame`` computed once, written to the shared folder and read back; and its path.

    What reads it later does not depend on executors that computed it, and reads only the
    columns it needs.
    """
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    # The schema is known, so no job has to look into the files for it.
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path
