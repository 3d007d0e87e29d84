"""A log of runs in a folder, to which each run is appended once, as a Spark data source.

Tasks write Parquet files into a folder of this attempt whose name starts with ``_``, which Spark's readers do not
see.  When all are done the driver removes what tasks that were repeated left behind, and renames the folder to ``run=...``.
The run is in the log with that rename and not before; a run that is there already stays as it is, and an attempt
that fails is removed.  What an attempt leaves that was killed is removed by the next one of that run.

``pyarrow.fs`` opens the folder (see :func:`tarnkeep.sources.store_listing.open_store`), which must be on a store that
renames folders in one step.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from tarnkeep.sources.store_listing import open_store

NAME = "run_log"
RUN = "run"
DONE_FILE = "_rows.json"


@dataclass
class WrittenFile(WriterCommitMessage):
    """What one task has written; no name if it had no rows."""

    name: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, run: str):
        # Spark reads folders with a "=" in their name even if that starts with "_".
        self._path, self._run = path, quote(run, safe="")
        self._attempt = uuid.uuid4().hex

    def _names(self) -> tuple[fs.FileSystem, str, str, str]:
        """The store, the folder of the log, of the run, and of this attempt."""
        store, root = open_store(self._path)
        return store, root, f"{root}/{RUN}={self._run}", f"{root}/_{self._attempt}-{self._run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        store, _, _, attempt = self._names()
        name, rows, writer, out = f"{uuid.uuid4().hex}.parquet", 0, None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(attempt, recursive=True)
                    out = store.open_output_stream(f"{attempt}/{name}")
                    writer = pq.ParquetWriter(out, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return WrittenFile(name if rows else None, rows)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        store, root, place, attempt = self._names()
        store.create_dir(attempt, recursive=True)
        done = [message for message in messages if message is not None]
        wanted = {message.name for message in done}
        for entry in store.get_file_info(fs.FileSelector(attempt)):
            if entry.base_name not in wanted:
                store.delete_file(entry.path)
        with store.open_output_stream(f"{attempt}/{DONE_FILE}") as out:
            out.write(json.dumps({"rows": sum(message.rows for message in done)}).encode())
        if not self._logged(store, place):
            # Fails if another attempt is there by now; then that one counts.
            with contextlib.suppress(OSError):
                store.move(attempt, place)
            if not self._logged(store, place):
                raise OSError(f"could not rename {attempt} to {place}")
        self._clear(store, root)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        store, root, _, _ = self._names()
        self._clear(store, root)

    @staticmethod
    def _logged(store: fs.FileSystem, place: str) -> bool:
        return store.get_file_info(f"{place}/{DONE_FILE}").type == fs.FileType.File

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        """Remove all attempts of this run that are not in place."""
        for entry in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if re.fullmatch(f"_[0-9a-f]{{32}}-{re.escape(self._run)}", entry.base_name):
                store.delete_dir(entry.path)


class RunLog(DataSource):
    """Options: ``path``, the folder of the log, and ``run``, the name or time of the run."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise NotImplementedError("read the log with read_run_log")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a run log is only appended to")
        if RUN in schema.names:
            raise ValueError(f"the column {RUN} names the folders of the log")
        return _Writer(self.options["path"], self.options["run"])


def append_run(rows: DataFrame, path: str, run: str) -> None:
    """Append the rows of one run; if the log has the run already, nothing changes.

    Runs of one name must not be appended at the same time: they would remove each other's attempts.
    """
    rows.sparkSession.dataSource.register(RunLog)
    rows.write.format(NAME).mode("append").option("path", path).option("run", run).save()


def read_run_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All runs of the log, with their name as column ``run``; ``schema`` is that of the rows."""
    with_run = StructType([*schema, StructField(RUN, StringType())])
    return spark.read.schema(with_run).parquet(path)
