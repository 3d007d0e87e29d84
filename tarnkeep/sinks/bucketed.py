"""A merge target that is laid out by its key, so that a merge touches few files and leaves the target where it is.

The rows of the table are in ``slots`` folders by a hash of the key, and within each in files by bucket, a
second hash of the key, which Spark's bucketed tables know.  A merge

* finds the slots that hold a key of the source, from the key column of the slots the source's keys belong to;
* writes these slots anew beside the table and exchanges them, as partitions are exchanged (see
  :mod:`tarnkeep.sinks.targets`); files of all other slots stay as they are;
* appends the source rows of the other slots.

Since the table is read by bucket, both joins shuffle the source alone, to the table's buckets, or broadcast it if it is
small.  Where a bucket has more rows than one task should sort, both sides are dealt to several tasks per bucket instead,
and writes cut a large bucket into several files, so a task's memory does not grow with the table.  Rows without a key
equal nothing: they are only ever appended, to slots of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnkeep.sinks.targets import RECORDS_PER_FILE, PathTarget, TableTarget, table_folder
from tarnkeep.storage import Storage

SLOT = "__slot"
#: Tasks that null-key rows are spread over; each has a slot below zero.
NULL_SLOTS = 16
#: Rows that one task of a merge sorts; larger buckets are joined by several tasks.
ROWS_TOGETHER = 1_000_000


@dataclass(frozen=True)
class BucketedTarget:
    """A managed table of ``slots`` folders with ``buckets`` files or more each, both by a hash of ``key``.

    A merge of ``n`` keys rewrites at most ``n`` slots, so choose so many that a slot is about what a small merge may
    rewrite.  The number of buckets is the least number of tasks that read the table in a merge.
    """

    name: str
    key: str
    slots: int = 256
    buckets: int = 32
    format: str = "parquet"

    def _slot(self) -> Column:
        spread = -1 - F.pmod(F.spark_partition_id(), F.lit(NULL_SLOTS))
        # Not the hash that deals rows to buckets, or each bucket would have some slots only.
        known = F.pmod(F.xxhash64(F.lit("slot"), F.col(self.key)), F.lit(self.slots)).cast("int")
        return F.when(F.col(self.key).isNull(), spread).otherwise(known)

    def _laid_out(self, frame: DataFrame) -> DataFrame:
        """Rows with their slot, dealt to tasks by bucket; null keys stay in the tasks they are in."""
        known = self._dealt(frame.filter(F.col(self.key).isNotNull()))
        return known.unionByName(frame.filter(F.col(self.key).isNull())).withColumn(SLOT, self._slot())

    def _dealt(self, frame: DataFrame) -> DataFrame:
        """Rows dealt to tasks by bucket, several tasks for a bucket of more than Spark's advisory size."""
        # What Spark deals the rows of a bucketed table by.
        bucket = F.pmod(F.hash(self.key), F.lit(self.buckets))
        return frame.withColumn("__bucket", bucket).hint("rebalance", F.col("__bucket")).drop("__bucket")

    def _tasks(self, rows: int) -> int:
        """Tasks to join ``rows`` with: a multiple of the buckets, so that each has rows of one bucket only."""
        return self.buckets * max(1, -(-rows // (self.buckets * ROWS_TOGETHER)))

    def _save(
        self, frame: DataFrame, name: str, mode: str, measures: Sequence[Column] = ()
    ) -> dict[str, object]:
        written = Observation()
        rows = frame.observe(written, F.count(F.lit(1)).alias("rows"), *measures)
        writer = rows.write.format(self.format).mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE)
        writer.partitionBy(SLOT).bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name)
        return written.get

    def partitions(self, spark: SparkSession) -> Sequence[str]:
        return ()

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Current rows, or None if there is no such table."""
        return spark.table(self.name).drop(SLOT) if spark.catalog.tableExists(self.name) else None

    def append(self, frame: DataFrame, measures: Sequence[Column] = ()) -> dict[str, object]:
        """Add all rows; returns their number as ``rows`` and the ``measures``, aggregates of them."""
        self.recover(frame.sparkSession)
        return self._save(self._laid_out(frame), self.name, "append", measures)

    def stage(self, frame: DataFrame, measures: Sequence[Column] = ()) -> tuple[str, dict[str, object]]:
        """A copy beside the target, and ``rows`` and the ``measures`` as they were written."""
        staged = f"{self.name}__copy"
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {staged}")
        return staged, self._save(self._laid_out(frame), staged, "error", measures)

    def staged_rows(self, spark: SparkSession, staged: str) -> int:
        return spark.table(staged).count()

    def discard(self, spark: SparkSession, staged: str) -> None:
        spark.sql(f"DROP TABLE {staged}")

    def publish(self, spark: SparkSession, staged: str) -> None:
        """Swap the staged folder in for that of the table, which is made first if there is none."""
        if not spark.catalog.tableExists(self.name):
            self._save(spark.table(staged).limit(0), self.name, "error")
        folder = self._folder(spark)
        copy = table_folder(spark, staged)
        # Moved first, so that dropping the table of the copy does not delete it.
        Storage(spark).rename(copy, f"{folder.path}__staged")
        spark.sql(f"DROP TABLE {staged}")
        Storage(spark).write_text(f"{folder.path}__staged/_staged", "")
        folder.publish(spark, f"{folder.path}__staged")
        self._follow(spark)

    def recover(self, spark: SparkSession) -> bool:
        """Finish or undo what a write that was cut off left behind; whether there was anything."""
        left = spark.catalog.tableExists(f"{self.name}__copy")
        spark.sql(f"DROP TABLE IF EXISTS {self.name}__copy")
        if not spark.catalog.tableExists(self.name):
            return left
        found = self._folder(spark).recover(spark)
        if found:
            self._follow(spark)
        return found or left

    def merge_rows(self, source: DataFrame) -> dict[str, int]:
        """Replace rows with an equal key and add the others; ``slots`` are those written anew.

        Keys of ``source``, which is read several times, are unique.  A merge that is cut off and run
        again gives the same rows: what has been exchanged is replaced by the same, and rows are appended last, in one job.
        """
        spark = source.sparkSession
        slotted = source.withColumn(SLOT, self._slot())
        present = spark.table(self.name)
        # At most one row per slot.
        arrived = slotted.filter(f"{SLOT} >= 0").groupBy(SLOT).count().collect()
        present = present.filter(F.col(SLOT).isin([r[0] for r in arrived]))
        keys = source.select(self.key)
        tasks = self._tasks(max(present.count(), sum(r["count"] for r in arrived)))
        if tasks > self.buckets:
            # Not read by bucket, since a bucket is one task then.
            present, keys = present.repartition(tasks, self.key), keys.repartition(tasks, self.key)
        near = present.select(self.key, SLOT)
        touched = [r[0] for r in near.join(keys, self.key, "left_semi").select(SLOT).distinct().collect()]
        inside = F.col(SLOT).isin(touched)
        if touched:
            staying = present.filter(inside).join(keys, self.key, "left_anti")
            arriving = slotted.filter(inside).repartition(tasks, self.key)
            staged = f"{self.name}__copy"
            spark.sql(f"DROP TABLE IF EXISTS {staged}")
            self._save(staying.unionByName(arriving), staged, "error")
            self._folder(spark).exchange(spark, table_folder(spark, staged))
            spark.sql(f"DROP TABLE {staged}")
            self._follow(spark)
        rest = slotted.filter(~inside).drop(SLOT)
        if not rest.isEmpty():
            self._save(self._laid_out(rest), self.name, "append")
        return {"slots": len(touched)}

    def _folder(self, spark: SparkSession) -> PathTarget:
        return PathTarget(table_folder(spark, self.name), self.format, (SLOT,))

    def _follow(self, spark: SparkSession) -> None:
        TableTarget(self.name)._follow(spark)
