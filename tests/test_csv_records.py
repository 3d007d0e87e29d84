"""Records cut apart by all tasks against Spark's reader of whole files, and column types against DuckDB's."""

import random

import duckdb
import pytest

from tarnkeep.sources.csv_files import typed_csv
from tarnkeep.sources.csv_records import _follower, csv_records


@pytest.fixture
def small_parts(spark):
    """Files are dealt to tasks in parts of a few lines."""
    settings = {"spark.sql.files.maxPartitionBytes": "160b", "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name in settings:
        spark.conf.unset(name)


def write_csv(path, rows, sep, end):
    def field(text):
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in f'{sep}"\n\r') else text

    path.write_text("".join(sep.join(map(field, row)) + end for row in rows), newline="")


@pytest.mark.parametrize(("sep", "end"), [(",", "\n"), ("|", "\r\n")])
def test_records_equal_those_of_whole_files(small_parts, tmp_path, sep, end):
    spark, pick = small_parts, random.Random(end + sep)
    pieces = ["x", "yy ", '"', "\n", sep, "ü", "5", "\n\n", '""']
    for n in range(3):
        rows = [["id", "a", "b c"]]
        for i in range(pick.randint(1, 40)):
            rows.append([str(i), *("".join(pick.choices(pieces, k=pick.randint(0, 8))) for _ in range(2))])
        write_csv(tmp_path / f"{n}.csv", rows, sep, end)
    schema = "id bigint, a string, `b c` string"
    whole = spark.read.options(header=True, sep=sep, multiLine=True, nullValue="", escape='"', mode="FAILFAST")
    expected = sorted(map(tuple, whole.schema(schema).csv(str(tmp_path)).collect()), key=str)
    assert csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 1
    for given in ({"schema": schema, "sep": sep}, {}):
        found = typed_csv(spark, str(tmp_path), multi_line=True, **given)
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_states_of_lines():
    ends = _follower(",")
    for line, outside, inside in (
        ("a,b", False, True),
        ('"a', True, False),
        ('a"', False, False),
        ('"a"', False, False),
        ('"a""', True, False),
        ('x",y', False, False),
        ('a,"b', True, False),
        ('5" pipe,"x', True, True),
        ('"",""', False, True),
        ('""",', True, False),
        ('a","b","c', True, True),
    ):
        assert (ends(line, False), ends(line, True)) == (outside, inside), line


def test_a_quote_that_is_never_closed(small_parts, tmp_path):
    (tmp_path / "x.csv").write_text('id,a\n1,"b\n' + "2,c\n" * 30)
    with pytest.raises(ValueError, match="never closed"):
        typed_csv(small_parts, str(tmp_path), multi_line=True)


def test_headers_of_all_files_are_checked(small_parts, tmp_path):
    (tmp_path / "a.csv").write_text('"i\nd",a\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text('\n"i\nd",a\n2,z\n')
    rows = typed_csv(small_parts, str(tmp_path), multi_line=True)
    assert rows.columns == ["i\nd", "a"] and sorted(map(tuple, rows.collect())) == [(1, "x\ny"), (2, "z")]
    (tmp_path / "c.csv").write_text("id,b\n1,x\n")
    with pytest.raises(ValueError, match="header"):
        typed_csv(small_parts, str(tmp_path), "`i\nd` int, a string", sep=",", multi_line=True).collect()


def test_types_are_those_that_duckdb_finds(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(
        "id;n;d;t;b;z;q;e;m;mixed;big\n"
        '1;1.5;2024-01-02;2024-01-02 03:04:05;true;007;"12";;x;2024-01-02;1\n'
        '2;;2024-02-03;2024-01-02 03:04:06.5;false;010;"13";"";3;2024-01-02 01:02:03;2.5e10\n'
    )
    names = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}
    scan = f"SELECT * FROM read_csv('{path}', auto_detect = true, header = true, nullstr = '')"
    expected = {row[0]: names[row[1]] for row in duckdb.sql(f"DESCRIBE {scan}").fetchall()}
    assert dict(typed_csv(spark, str(path)).dtypes) == expected
    assert dict(typed_csv(spark, str(path), multi_line=True).dtypes) == expected


def test_what_all_values_say_counts(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a|b\n" + "1|2024-01-01\n" * 5_000 + "x|2024-13-01\n")
    assert dict(typed_csv(spark, str(path)).dtypes) == {"a": "string", "b": "string"}
