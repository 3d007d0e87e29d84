"""CSV records with line breaks in quotes, cut apart by all tasks, and what the columns of a file hold.

Whether a line break ends a record depends on all quotes before it.  But a stretch of lines maps the two states, outside
and inside of quotes, to two states, and these maps can be chained: every task follows both states through its
part of a file, the maps of the parts are chained in order, and then each line knows its state.  Records of one line, nearly
all, stay where they are; only lines of longer records are brought together.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkeep.storage import kept

# Separators that are tried.
SEPARATORS = [",", "|", ";", "\t"]

_LINE = "file string, block long, seq long, value string, "
_STATES = ["o_before", "i_before", "o_after", "i_after", "o_open", "i_open"]
_LINE_TYPES = _LINE + ", ".join(f"{name} long" for name in _STATES)


def _follower(separators: str):
    """A function of a line and whether it starts inside quotes, to whether it ends there."""
    opening = re.compile(f'(?:^|[{re.escape(separators)}])"')
    # Possessive, so that a doubled quote is never taken for an end.
    rest = re.compile('(?:[^"]++|"")*+"')

    def ends_inside(line: str, inside: bool) -> bool:
        at = 0
        while True:
            if not inside:
                found = opening.search(line, at) if at == 0 else opening.search(line, at - 1) if at else None
                if found is None or found.end() <= at:
                    return False
                at = found.end()
            closed = rest.match(line, at)
            if closed is None:
                return True
            at, inside = closed.end(), False
            following = min((p for p in (line.find(s, at) for s in separators) if p >= 0), default=-1)
            if following < 0:
                return False
            at = following + 1

    return ends_inside


def _scanner(separators: str):
    """The task body: each line with both states before and after it, and records opened so far, per part of a file."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_inside = _follower(separators)
        part, seq, state = None, 0, [0, 1, 0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column("value")
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            quoted = pc.match_substring(values, '"').to_numpy(zero_copy_only=False)
            parts = list(zip(files, blocks, strict=True))
            changed = np.array([parts[0] != part, *(a != b for a, b in zip(parts, parts[1:], strict=False))])
            after, before, number = np.empty((n, 4), dtype=np.int64), np.empty((n, 2), dtype=np.int64), np.arange(n) + seq
            done = 0
            for at in np.flatnonzero(changed | quoted).tolist():
                after[done:at], before[done:at] = state, state[:2]
                if changed[at]:
                    state = [0, 1, 0, 0]
                    number[at:] = np.arange(n - at)
                before[at] = state[:2]
                if quoted[at]:
                    line, new = values[at].as_py(), list(state)
                    for i in (0, 1):
                        new[i] = int(ends_inside(line, bool(state[i])))
                        new[2 + i] = state[2 + i] + int(new[i] and not state[i])
                    state = new
                after[at], done = state, at + 1
            after[done:], before[done:] = state, state[:2]
            part, seq = parts[-1], int(number[-1]) + 1
            columns = [*before.T, *after.T]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(number), values, *map(pa.array, columns)],
                names=["file", "block", "seq", "value", *_STATES],
            )

    return scan


def _chained(parts: pd.DataFrame) -> pd.DataFrame:
    """The state in which each part of one file starts, the records opened before it, and the state at its end."""
    parts = parts.sort_values("block")
    starts, opened, ends, inside, count = [], [], [], 0, 0
    for one in parts.itertuples():
        starts.append(inside)
        opened.append(count)
        count += one.i_open if inside else one.o_open
        inside = one.i_after if inside else one.o_after
        ends.append(inside)
    return pd.DataFrame(
        {"file": parts["file"], "block": parts["block"], "starts": starts, "opened": opened, "ends": ends}
    )


def csv_records(spark: SparkSession, path: str, separators: str = "".join(SEPARATORS)) -> DataFrame:
    """``file``, ``block`` and ``seq`` (where it starts) and ``record`` (without its last line break) of all records.

    A quote that starts a field opens it until the next quote that is not doubled.  Blank lines outside of quotes
    are no records.  The lines are written to the shared folder once, since another reading might be dealt to tasks
    differently.  A quote that is never closed is an error.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    lines, _ = kept(text.mapInArrow(_scanner(separators), _LINE_TYPES), "csv-lines")
    last = F.max_by(F.struct("o_after", "i_after", "o_open", "i_open"), "seq").alias("last")
    parts = lines.groupBy("file", "block").agg(last).select("file", "block", "last.*")
    kinds = "file string, block long, starts long, opened long, ends long"
    chained, _ = kept(parts.groupBy("file").applyInPandas(_chained, kinds), "csv-parts")
    open_at_end = chained.groupBy("file").agg(F.max_by("ends", "block").alias("ends")).filter("ends = 1").first()
    if open_at_end is not None:
        raise ValueError(f"a quote in {open_at_end.file} is never closed")

    def actual(name: str) -> Column:
        return F.when(F.col("starts") == 1, F.col(f"i_{name}")).otherwise(F.col(f"o_{name}"))

    placed = lines.join(chained.drop("ends"), ["file", "block"]).select(
        "file",
        "block",
        "seq",
        "value",
        ((actual("before") == 1) | (actual("after") == 1)).alias("longer"),
        (F.col("opened") + actual("open")).alias("number"),
    )
    single = placed.filter("NOT longer").select("file", "block", "seq", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    several = placed.filter("longer").groupBy("file", "number").agg(pieces.alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda piece: F.regexp_replace(piece["value"], "\r$", "")), "\n")
    several = several.select("file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["seq"].alias("seq"), whole.alias("record"))
    found = single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return found.filter(F.trim("record") != "")


def headers_of(records: DataFrame) -> DataFrame:
    """The first record of every file."""
    return records.groupBy("file").agg(F.min_by("record", F.struct("block", "seq")).alias("record"))


def fields_of(record: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=sep))


def options_of(sep: str) -> dict[str, str]:
    """How a record is read: empty fields, quoted or not, are null, and quotes are doubled."""
    return {"sep": sep, "nullValue": "", "escape": '"'}


# What a text must look like to be of a type; numbers have no leading zeros.
_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_NUMBER = r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$"

#: Types from the narrowest to the widest; a column has the first one that all its values are of.
_KINDS = ["boolean", "bigint", "double", "date", "timestamp"]


def _is(kind: str, value: Column) -> Column:
    if kind == "boolean":
        return F.lower(value).isin("true", "false")
    shape = {"bigint": _WHOLE, "double": _NUMBER, "date": _DAY, "timestamp": _TIME}[kind]
    return value.rlike(shape) & value.try_cast(kind).isNotNull()


def csv_profile(records: DataFrame, seps: list[str], header: str) -> dict[str, dict[str, str] | None]:
    """Per separator the type of each column, or None if records have other numbers of fields than ``header``.

    All separators and columns are looked at in one aggregate over all records: per column and type whether all
    values are of it, which tasks combine by ``and``, and per separator how many records do not fit.
    """
    measures, names = [], {}
    rows = records.filter(F.col("record") != header)
    for i, sep in enumerate(seps):
        names[sep] = fields_of(header, sep)
        fields = [f"f{j} string" for j in range(len(names[sep]))]
        parsed = F.from_csv(
            "record",
            ", ".join([*fields, "misfit string"]),
            {**options_of(sep), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "misfit"},
        )
        rows = rows.withColumn(f"by{i}", parsed)
        measures.append(F.count_if(F.col(f"by{i}.misfit").isNotNull()).alias(f"misfits{i}"))
        for j in range(len(fields)):
            value = F.col(f"by{i}.f{j}")
            measures.append(F.count(value).alias(f"some{i}_{j}"))
            measures += [
                F.bool_and(F.when(value.isNotNull(), _is(kind, value))).alias(f"{kind}{i}_{j}") for kind in _KINDS
            ]
    found = rows.agg(*measures).first().asDict()

    def kind_of(i: int, j: int) -> str:
        return next((kind for kind in _KINDS if found[f"some{i}_{j}"] and found[f"{kind}{i}_{j}"]), "string")

    return {
        sep: None if found[f"misfits{i}"] else {name: kind_of(i, j) for j, name in enumerate(names[sep])}
        for i, sep in enumerate(seps)
    }
