"""Load targets that are written beside the old data and then swapped in.

Spark overwrites a folder by deleting it first, and cannot overwrite what the same plan reads.
So new content goes to a staging folder next to the target (the same storage), is counted there,
and takes the target's place by rename.  Neither the two renames of a whole target nor those of some of its
partitions are one atomic step, so every write first puts right what an earlier one left behind:

* A staged copy that was never swapped in is deleted.
* Between the two renames the old data has the backup name: it is put back.  A backup is deleted only beside
  a folder that carries the mark of a finished swap.
* Partitions are exchanged only after a list of all of them is in place; an exchange with such a list is carried on.

One load at a time may write a target.  A format with its own transaction log overwrites and merges in one commit;
for such targets (``transactional=True``) the staged content is written over the target instead, which keeps
its history.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarnkeep.storage import Storage

# Fixed value: rows per written file.
RECORDS_PER_FILE = 500_000
# Files of a target folder that Spark's readers do not see.
SCHEMA_FILE = "_schema.json"
SWAPPED_FILE = "_swapped"
STAGED_FILE = "_staged"
EXCHANGE_FILE = "_exchange.json"


def _writer(
    frame: DataFrame,
    partition_by: Sequence[str],
    written: Observation | None = None,
    measures: Sequence[Column] = (),
) -> DataFrameWriter:
    if partition_by:
        # Rows of a partition are brought together; a hot one is still split among tasks.
        frame = frame.hint("rebalance", *partition_by)
    if written is not None:
        # Above any shuffle: a shuffle's tasks may run, and count, more than once.
        frame = frame.observe(written, F.count(F.lit(1)).alias("rows"), *measures)
    writer = frame.write.option("maxRecordsPerFile", RECORDS_PER_FILE)
    return writer.partitionBy(*partition_by) if partition_by else writer


@dataclass(frozen=True)
class PathTarget:
    """A folder of files, by default Parquet.

    Partition columns have the types that were written, which are kept beside the data; in a
    folder written by others they are text.  They are never guessed, so ``01`` stays ``01``.
    """

    path: str
    format: str = "parquet"
    partition_by: tuple[str, ...] = ()
    transactional: bool = False

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Current rows, or None if there is no such folder; any other failure is raised."""
        if not Storage(spark).exists(self._base):
            return None
        return self._load(spark, self._base)

    def partitions(self, spark: SparkSession) -> Sequence[str]:
        """The columns that name folders."""
        return self.partition_by

    def append(self, frame: DataFrame, measures: Sequence[Column] = ()) -> dict[str, object]:
        """Add all rows; returns their number as ``rows`` and the ``measures``, aggregates of them."""
        self.recover(frame.sparkSession)
        self._keep_schema(frame, self._base)
        written = Observation()
        writer = _writer(frame, self.partition_by, written, measures).format(self.format)
        writer.mode("append").save(self.path)
        return written.get

    def stage(self, frame: DataFrame, measures: Sequence[Column] = ()) -> tuple[str, dict[str, object]]:
        """A copy beside the target, and ``rows`` and the ``measures`` as they were written."""
        staged, files = self._staged, Storage(frame.sparkSession)
        if files.exists(staged):
            files.delete(staged)
        written = Observation()
        try:
            self._keep_schema(frame, staged)
            writer = _writer(frame, self.partition_by, written, measures).format(self.format)
            writer.mode("append").save(staged)
            files.write_text(f"{staged}/{STAGED_FILE}", "")
        except Exception:
            if files.exists(staged):
                files.delete(staged)
            raise
        return staged, written.get

    def staged_rows(self, spark: SparkSession, staged: str) -> int:
        return spark.read.format(self.format).load(staged).count()

    def _load(self, spark: SparkSession, path: str) -> DataFrame:
        reader = spark.read.format(self.format)
        if self.transactional or not self.partition_by:
            return reader.load(path)
        files, kept = Storage(spark), f"{path}/{SCHEMA_FILE}"
        types = {}
        if files.exists(kept):
            types = {f.name: f.dataType for f in StructType.fromJson(json.loads(files.read_text(kept)))}
        found = reader.load(path).schema
        fields = [
            StructField(field.name, types.get(field.name, StringType()))
            if field.name in self.partition_by
            else field
            for field in found
        ]
        return spark.read.format(self.format).schema(StructType(fields)).load(path)

    def _keep_schema(self, frame: DataFrame, path: str) -> None:
        """Note the types of the partition columns; the first write decides."""
        if self.transactional or not self.partition_by:
            return
        files, kept = Storage(frame.sparkSession), f"{path}/{SCHEMA_FILE}"
        if not files.exists(kept) and not files.exists(path):
            types = StructType([frame.schema[name] for name in self.partition_by])
            files.write_text(kept, types.json())

    def publish(self, spark: SparkSession, staged: str) -> None:
        files = Storage(spark)
        files.delete(f"{staged}/{STAGED_FILE}")
        if not files.exists(self._base):
            files.rename(staged, self._base)
        elif self.transactional:
            content = self._load(spark, staged)
            writer = _writer(content, self.partition_by).format(self.format)
            writer.mode("overwrite").save(self.path)
            files.delete(staged)
        else:
            files.write_text(f"{staged}/{SWAPPED_FILE}", "")
            files.rename(self._base, self._backup)
            files.rename(staged, self._base)
            files.delete(self._backup)
            files.delete(f"{self._base}/{SWAPPED_FILE}")
        spark.catalog.refreshByPath(self.path)

    def discard(self, spark: SparkSession, staged: str) -> None:
        Storage(spark).delete(staged)

    def recover(self, spark: SparkSession) -> bool:
        """Finish or undo what a write that was cut off left behind; whether there was anything.

        A target and a backup without the mark of a swap are an error.
        """
        files, found = Storage(spark), False
        if files.exists(self._backup):
            found = True
            if not files.exists(self._base):
                files.rename(self._backup, self._base)
            elif files.exists(f"{self._base}/{SWAPPED_FILE}"):
                files.delete(self._backup)
                files.delete(f"{self._base}/{SWAPPED_FILE}")
            else:
                raise RuntimeError(
                    f"{self._base} and {self._backup} both hold data that no swap put there: merge them by hand"
                )
        elif files.exists(f"{self._base}/{SWAPPED_FILE}"):
            files.delete(f"{self._base}/{SWAPPED_FILE}")
        if files.exists(f"{self._exchange}/{EXCHANGE_FILE}"):
            found = True
            self._carry_on(files)
        for left in (self._staged, self._exchange, self._replaced):
            if files.exists(left):
                found = True
                files.delete(left)
        return found

    def replace_partitions(
        self, frame: DataFrame, measures: Sequence[Column] = ()
    ) -> dict[str, object]:
        """Overwrite just the partitions that ``frame`` has rows for; it may read the target.

        All of ``frame`` is written aside first.  Then the list of its partitions is put there, and from then on
        the exchange is carried on by whoever comes next, should it be cut off.
        """
        spark = frame.sparkSession
        written = Observation()
        writer = _writer(frame, self.partition_by, written, measures).format(self.format)
        writer.mode("overwrite").save(self._exchange)
        self.exchange(spark, self._exchange)
        return written.get

    def exchange(self, spark: SparkSession, content: str) -> None:
        """Put the partition folders of ``content``, a complete copy beside the target, in the place of the old ones."""
        files = Storage(spark)
        if content != self._exchange:
            files.rename(content, self._exchange)
        folders = [""]
        for _ in self.partition_by:
            folders = [f"{at}/{name}" for at in folders for name in files.names(f"{self._exchange}{at}") if "=" in name]
        # Renamed when whole, so that a list is complete or not there.
        files.write_text(f"{self._exchange}/{EXCHANGE_FILE}.new", json.dumps(folders))
        files.rename(f"{self._exchange}/{EXCHANGE_FILE}.new", f"{self._exchange}/{EXCHANGE_FILE}")
        self._carry_on(files)
        spark.catalog.refreshByPath(self.path)

    def _carry_on(self, files: Storage) -> None:
        """Exchange what is left of a list of partitions; each step may have been the last one before."""
        for folder in json.loads(files.read_text(f"{self._exchange}/{EXCHANGE_FILE}")):
            new, old, aside = (f"{at}{folder}" for at in (self._exchange, self._base, self._replaced))
            if not files.exists(new):
                continue
            for at in (old, aside):
                files.make_folder(at.rpartition("/")[0])
            if files.exists(old):
                files.rename(old, aside)
            files.rename(new, old)
        files.delete(self._exchange)
        if files.exists(self._replaced):
            files.delete(self._replaced)

    @property
    def _base(self) -> str:
        return self.path.rstrip("/")

    @property
    def _backup(self) -> str:
        return f"{self._base}__previous"

    @property
    def _staged(self) -> str:
        return f"{self._base}__staged"

    @property
    def _exchange(self) -> str:
        return f"{self._base}__exchange"

    @property
    def _replaced(self) -> str:
        return f"{self._base}__replaced"


@dataclass(frozen=True)
class TableTarget:
    """A managed catalog table; a ``transactional`` one must support row-level MERGE.

    The folder of any other table is swapped, or some of its partitions exchanged, as for a
    :class:`PathTarget`; the table itself, with its properties, is never dropped.
    """

    name: str
    format: str = "parquet"
    partition_by: tuple[str, ...] = ()
    transactional: bool = False

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Current rows, or None if there is no such table; any other failure is raised."""
        return spark.table(self.name) if spark.catalog.tableExists(self.name) else None

    def partitions(self, spark: SparkSession) -> Sequence[str]:
        """The partition columns, as asked for or as the table already has them."""
        if self.partition_by or not spark.catalog.tableExists(self.name):
            return self.partition_by
        return tuple(c.name for c in spark.catalog.listColumns(self.name) if c.isPartition)

    def append(self, frame: DataFrame, measures: Sequence[Column] = ()) -> dict[str, object]:
        """Add all rows; returns their number as ``rows`` and the ``measures``, aggregates of them."""
        self.recover(frame.sparkSession)
        written = Observation()
        self._save(frame, self.name, "append", self.partitions(frame.sparkSession), written, measures)
        return written.get

    def stage(self, frame: DataFrame, measures: Sequence[Column] = ()) -> tuple[str, dict[str, object]]:
        """A copy beside the target, and ``rows`` and the ``measures`` as they were written."""
        spark = frame.sparkSession
        if not self.transactional:
            return self._folder(spark).stage(frame, measures)
        written = Observation()
        try:
            self._save(frame, self._staged, "error", (), written, measures)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {self._staged}")
            raise
        return self._staged, written.get

    def staged_rows(self, spark: SparkSession, staged: str) -> int:
        if not self.transactional:
            return self._folder(spark).staged_rows(spark, staged)
        return spark.table(staged).count()

    def publish(self, spark: SparkSession, staged: str) -> None:
        partition_by = self.partitions(spark)
        if self.transactional:
            self._save(spark.table(staged), self.name, "overwrite", partition_by)
            self.discard(spark, staged)
            return
        folder = self._folder(spark)
        if not spark.catalog.tableExists(self.name):
            self._save(folder._load(spark, staged).limit(0), self.name, "error", partition_by)
        folder.publish(spark, staged)
        self._follow(spark)

    def discard(self, spark: SparkSession, staged: str) -> None:
        if self.transactional:
            spark.sql(f"DROP TABLE {staged}")
        else:
            Storage(spark).delete(staged)

    def recover(self, spark: SparkSession) -> bool:
        """Finish or undo what a write that was cut off left behind; whether there was anything."""
        if self.transactional:
            left = spark.catalog.tableExists(self._staged)
            spark.sql(f"DROP TABLE IF EXISTS {self._staged}")
            return left
        folder = self._folder(spark)
        staged = f"{folder.path}__staged"
        if not spark.catalog.tableExists(self.name):
            # The first content of a new table, complete but not yet in place.
            if Storage(spark).exists(f"{staged}/{STAGED_FILE}"):
                self.publish(spark, staged)
                return True
            return False
        found = folder.recover(spark)
        if found:
            self._follow(spark)
        return found

    def replace_partitions(
        self, frame: DataFrame, measures: Sequence[Column] = ()
    ) -> dict[str, object]:
        """Overwrite just the partitions that ``frame`` has rows for; it may read the target."""
        spark = frame.sparkSession
        written = self._folder(spark).replace_partitions(frame, measures)
        self._follow(spark)
        return written

    def merge(self, source: DataFrame, key: str) -> None:
        """The table format's own MERGE: update every match, insert the rest."""
        matched = F.col(f"source.{key}") == F.col(f"{self.name}.{key}")
        merging = source.alias("source").mergeInto(self.name, matched)
        merging.whenMatched().updateAll().whenNotMatched().insertAll().merge()

    def _save(
        self,
        frame: DataFrame,
        name: str,
        mode: str,
        partition_by: Sequence[str] = (),
        written: Observation | None = None,
        measures: Sequence[Column] = (),
    ) -> None:
        writer = _writer(frame, partition_by, written, measures).format(self.format)
        writer.mode(mode).saveAsTable(name)

    def _folder(self, spark: SparkSession) -> PathTarget:
        return PathTarget(table_folder(spark, self.name), self.format, tuple(self.partitions(spark)))

    def _follow(self, spark: SparkSession) -> None:
        """Make the catalog see the folder as it is now."""
        if self.partitions(spark):
            spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {self.name}")

    @property
    def _staged(self) -> str:
        return f"{self.name}__staged"


def table_folder(spark: SparkSession, name: str) -> str:
    """Where a table of the session catalog is, or would be created."""
    state = spark._jsparkSession.sessionState()
    identifier = state.sqlParser().parseTableIdentifier(name)
    if spark.catalog.tableExists(name):
        return state.catalog().getTableMetadata(identifier).location().toString().rstrip("/")
    return state.catalog().defaultTablePath(identifier).toString().rstrip("/")
