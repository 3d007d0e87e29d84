"""Loading a source into a target: append, full load or keyed merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tarnkeep.operators.digest import added, content_digest, content_measures
from tarnkeep.operators.guards import MAX_LOSS_PCT, key_profile, row_loss_guard
from tarnkeep.operators.merge import conform, last_per_key, merge_rows
from tarnkeep.sinks.bucketed import BucketedTarget
from tarnkeep.sinks.targets import PathTarget, TableTarget
from tarnkeep.storage import Storage, kept

REPORT = (
    "strategy string, source_rows long, target_rows_before long, loss_pct double, "
    "target_rows_after long, required_rows long"
)


class LoadRejected(ValueError):
    """A guard stopped the load or its result did not pass the check."""


def load(
    source: DataFrame,
    target: PathTarget | TableTarget | BucketedTarget,
    strategy: str,
    key: str | None = None,
    on_duplicate: str = "raise",
    order_by: Sequence[str] = (),
    allow_empty: bool = False,
    max_loss_pct: float = MAX_LOSS_PCT,
    stored_source: bool = False,
    check: str = "rows",
) -> DataFrame:
    """Run one load and return its report, a single row with the columns of ``REPORT``.

    ``append`` adds all rows.  ``fullload`` replaces all rows unless more than
    ``max_loss_pct`` percent would be lost.  ``merge`` replaces rows with an equal ``key`` and
    adds the others; keys that occur more than once in the source are an error, or, with
    ``on_duplicate="last"``, the last by ``order_by`` counts.

    With ``check="rows"`` at least the required number of rows must be in the target afterwards.  With
    ``check="content"`` the target must hold exactly the rows that were written: their digest is gathered
    while they are written and compared with one of the stored rows, so that a lost, repeated or
    changed value fails the load.  This reads the target (before an append, too), but never the source again.
    Merges by a format's own MERGE and into a ``BucketedTarget`` are checked by rows alone.

    A merge reads its source several times, so it first writes it to the shared folder; say
    ``stored_source`` if it already is a columnar copy that will not change meanwhile.
    """
    spark = source.sparkSession
    if strategy not in ("append", "fullload", "merge"):
        raise ValueError(f"unknown load strategy: {strategy!r}")
    if strategy == "merge" and key is None:
        raise ValueError("a merge needs a key")
    if on_duplicate not in ("raise", "last") or (on_duplicate == "last" and not order_by):
        raise ValueError("on_duplicate is 'raise', or 'last' together with order_by")
    if strategy == "merge" and isinstance(target, BucketedTarget) and key != target.key:
        raise ValueError(f"{target.name} is laid out by {target.key}, so it is merged by that")
    if check not in ("rows", "content"):
        raise ValueError("check is 'rows' or 'content'")

    target.recover(spark)
    before = target.read(spark)
    rows_before = 0 if before is None else before.count()
    if before is not None:
        source = conform(source, before.schema)
    proof = Proof(target, check == "content")
    if strategy == "append":
        source_rows, loss, required = proof.append(source)["rows"], None, None
    elif strategy == "fullload":
        source_rows, loss, required = _full(
            source, target, proof, None if before is None else rows_before, allow_empty, max_loss_pct
        )
    else:
        source_rows, loss, required = _merge(
            source, target, proof, before, key, on_duplicate, order_by, stored_source
        )
    rows_after = target.read(spark).count()
    if required is not None and rows_after < required:
        raise LoadRejected(f"{rows_after} rows after the load, expected at least {required}")
    report = (strategy, source_rows, rows_before, loss, rows_after, required)
    return spark.createDataFrame([report], REPORT)


class Proof:
    """Writes to a target and, if wanted, compares what it then holds with what was written."""

    def __init__(self, target: PathTarget | TableTarget | BucketedTarget, wanted: bool):
        self._target, self._wanted = target, wanted

    def _measures(self, frame: DataFrame) -> list[Column]:
        return content_measures(frame) if self._wanted else []

    def _compare(self, expected: dict[str, object], held: DataFrame) -> None:
        if self._wanted and (found := content_digest(held)) != expected:
            raise LoadRejected(f"the target does not hold what was written: {found} instead of {expected}")

    def append(self, frame: DataFrame) -> dict[str, object]:
        spark = frame.sparkSession
        before = content_digest(self._target.read(spark)) if self._wanted else None
        written = self._target.append(frame, self._measures(frame))
        if self._wanted:
            self._compare(added(before, written), self._target.read(spark))
        return written

    def stage(self, frame: DataFrame) -> tuple[str, dict[str, object]]:
        return self._target.stage(frame, self._measures(frame))

    def publish(self, spark: SparkSession, staged: tuple[str, dict[str, object]]) -> None:
        self._target.publish(spark, staged[0])
        self._compare(staged[1], self._target.read(spark))

    def replace_partitions(self, frame: DataFrame, source: DataFrame) -> None:
        """Exchange the partitions that ``source`` has rows for."""
        written = self._target.replace_partitions(frame, self._measures(frame))
        if self._wanted:
            spark = frame.sparkSession
            held = self._target.read(spark)
            self._compare(written, _same_partitions(held, source, self._target.partitions(spark)))


def _full(source, target, proof, rows_before, allow_empty, max_loss_pct):
    """The staged copy is what gets counted, so the source is read only once."""
    spark = source.sparkSession
    copy = proof.stage(source)
    staged = copy[0]
    source_rows = target.staged_rows(spark, staged)
    loss = None
    if source_rows == 0 and not allow_empty:
        target.discard(spark, staged)
        raise LoadRejected("the source is empty")
    if rows_before is not None:
        counts = spark.range(1).select(
            F.lit(source_rows).alias("source_rows"), F.lit(rows_before).alias("target_rows")
        )
        verdict = row_loss_guard(counts, max_loss_pct).first()
        loss = verdict.loss_pct
        if verdict.abort:
            target.discard(spark, staged)
            raise LoadRejected(
                f"row loss: source has {source_rows:,} rows, target {rows_before:,} "
                f"({loss:.1f}% loss)"
            )
    proof.publish(spark, copy)
    return source_rows, loss, source_rows


def _merge(source, target, proof, before, key, on_duplicate, order_by, stored_source):
    spark = source.sparkSession
    if before is None:
        staged = proof.stage(source)
        source_rows = target.staged_rows(spark, staged[0])
        proof.publish(spark, staged)
        return source_rows, None, source_rows
    if stored_source:
        return _merge_stored(source, target, proof, before, key, on_duplicate, order_by)
    copy, path = kept(source, "merge-source")
    try:
        return _merge_stored(copy, target, proof, before, key, on_duplicate, order_by)
    finally:
        Storage(spark).delete(path)


def _merge_stored(source, target, proof, before, key, on_duplicate, order_by):
    spark = source.sparkSession
    keys = key_profile(source, key).first()
    if keys.source_rows == 0:
        return 0, None, 0
    if keys.max_copies > 1:
        if on_duplicate == "raise":
            raise LoadRejected(f"a value of {key} occurs {keys.max_copies} times in the source")
        source = last_per_key(source, key, order_by)
    required = keys.distinct_keys + keys.null_keys

    if isinstance(target, BucketedTarget):
        target.merge_rows(source)
        return keys.source_rows, None, required
    if isinstance(target, TableTarget) and target.transactional:
        target.merge(source, key)
        return keys.source_rows, None, required

    partition_by = target.partitions(spark)
    matches = _matches(source, before, key, partition_by)
    if matches.here + matches.elsewhere == 0:
        proof.append(source)
        return keys.source_rows, None, required
    if partition_by and matches.elsewhere == 0:
        touched = _same_partitions(before, source, partition_by)
        proof.replace_partitions(merge_rows(source, touched, key), source)
    else:
        proof.publish(spark, proof.stage(merge_rows(source, before, key)))
    return keys.source_rows, None, required


def _matches(
    source: DataFrame, before: DataFrame, key: str, partition_by: Sequence[str]
) -> Row:
    """How many target rows match ``here``, in the partition of their source row, or
    ``elsewhere``.

    This reads the key and partition columns alone and tells whether rows of the target have to
    be rewritten at all, and whether rewriting the source's partitions is enough.
    """
    moved_to = {name: f"source_{name}" for name in partition_by}
    rows = source.select(key, *[F.col(name).alias(new) for name, new in moved_to.items()])
    same = reduce(and_, [F.equal_null(*names) for names in moved_to.items()], F.lit(True))
    pairs = before.select(*dict.fromkeys([key, *partition_by])).join(rows, key)
    return pairs.agg(
        F.count_if(same).alias("here"), F.count_if(~same).alias("elsewhere")
    ).first()


def _same_partitions(
    before: DataFrame, source: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """The target rows in partitions that the source has rows for, however many these are.

    A semi join on the partition columns, which Spark turns into a pruned scan; partitions with a
    null, which equals nothing there, are compared in a branch of their own.
    """
    touched = source.select(*partition_by).distinct()
    whole = reduce(and_, [F.col(name).isNotNull() for name in partition_by])
    plain = before.join(touched.filter(whole), list(partition_by), "left_semi")
    named = touched.filter(~whole).withColumnsRenamed({n: f"touched_{n}" for n in partition_by})
    same = reduce(
        and_, [F.equal_null(F.col(n), F.col(f"touched_{n}")) for n in partition_by]
    )
    nulls = before.filter(~whole).join(named, same, "left_semi")
    return plain.select(*before.columns).unionByName(nulls)
