import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnkeep.operators.drift import (
    APPROVED_ENDING,
    approval_states,
    cast_to,
    path_drift,
    rejected_rows,
    schema_drift,
    schema_fields,
    schema_paths,
)
from tarnkeep.operators.merge import conform
from tarnkeep.plans.gated_etl import SchemaDrift, check_schema, gated_etl
from tarnkeep.sinks.targets import PathTarget
from tarnkeep.sources.csv_files import raw_csv, sniff_separator, typed_csv
from tarnkeep.sources.registry import SchemaMissing, SchemaPending, SchemaRegistry


def drift(spark, expected, actual):
    def schema(ddl):
        return schema_fields(spark, StructType.fromDDL(ddl))

    rows = schema_drift(schema(expected), schema(actual)).collect()
    return [tuple(row) for row in rows]


def test_all_differences_at_once(spark):
    found = drift(spark, "a int, b string, c array<int>", "c array<string>, b string, z date")
    assert found == [
        ("a", "missing", "IntegerType()", None),
        ("c", "type", "ArrayType(IntegerType(), True)", "ArrayType(StringType(), True)"),
        ("z", "unexpected", None, "DateType()"),
    ]


@pytest.mark.parametrize(
    "expected, actual",
    [
        ("a int, b int", "b int, a int"),
        ("a int NOT NULL", "a int"),
        ("a int COMMENT 'x'", "a int"),
        ("s struct<x:int>", "s struct<x:int>"),
    ],
)
def test_no_drift(spark, expected, actual):
    assert drift(spark, expected, actual) == []


def test_nested_changes_are_drift(spark):
    assert len(drift(spark, "s struct<x:int,y:int>", "s struct<y:int,x:int>")) == 1
    assert len(drift(spark, "s struct<x:int NOT NULL>", "s struct<x:int>")) == 1
    nullable = StructType.fromDDL("a array<int>")
    strict = StructType.fromDDL("a array<int>")
    strict["a"].dataType.containsNull = False
    sides = [schema_fields(spark, schema) for schema in (nullable, strict)]
    assert schema_drift(*sides).count() == 1


def test_names_are_case_sensitive(spark):
    assert [row[:2] for row in drift(spark, "Id int", "id int")] == [
        ("Id", "missing"),
        ("id", "unexpected"),
    ]


def test_the_last_of_repeated_names_counts(spark):
    twice = spark.sql("SELECT 1 AS a, 'x' AS a").schema
    rows = schema_fields(spark, twice).collect()
    assert [(row.position, row.column_name, row.type_text) for row in rows] == [
        (1, "a", "StringType()")
    ]


def test_check_schema_modes(spark):
    frame = spark.sql("SELECT '1' AS id, 'x' AS name")
    approved = StructType.fromDDL("name string, id int")
    check_schema(frame, approved, "names")
    with pytest.raises(SchemaDrift, match=r"type: id \(expected IntegerType\(\), actual String"):
        check_schema(frame, approved, "strict")
    with pytest.raises(SchemaDrift) as error:
        check_schema(frame, StructType.fromDDL("name string, age int"), "names")
    assert "missing: age" in str(error.value) and "unexpected: id" in str(error.value)
    with pytest.raises(ValueError, match="loose"):
        check_schema(frame, approved, "loose")


def test_cast_goes_by_name(spark):
    frame = spark.sql("SELECT 'x' AS name, '12' AS id, '2024-02-03' AS day, null AS size")
    schema = StructType.fromDDL("id bigint NOT NULL, day date, name string, size double")
    row = cast_to(frame, schema).first()
    assert (row.id, row.day.isoformat(), row.name, row.size) == (12, "2024-02-03", "x", None)
    assert cast_to(frame, schema).columns == schema.names


def test_casts_are_as_strict_without_ansi_mode(spark):
    schema = StructType.fromDDL("id int")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for cast in (cast_to, conform):
            for bad in ("big", "99999999999"):
                with pytest.raises(Exception, match="does not fit int"):
                    cast(spark.sql(f"SELECT '{bad}' AS id"), schema).collect()
            good = cast(spark.sql("SELECT * FROM VALUES ('7'), (null) AS t(id)"), schema)
            assert {row.id for row in good.collect()} == {7, None}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cast_refuses_bad_values_and_nulls(spark):
    schema = StructType.fromDDL("id int NOT NULL, size int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_to(spark.sql("SELECT '1' AS id, 'big' AS size"), schema).collect()
    with pytest.raises(Exception, match="null in non-nullable field id"):
        cast_to(spark.sql("SELECT null AS id, '1' AS size"), schema).collect()
    frame = spark.sql("SELECT * FROM VALUES ('1','2'), (null,'x'), ('y',null) AS t(id, size)")
    rows = {tuple(row.bad_columns) for row in rejected_rows(frame, schema).collect()}
    assert rows == {("id", "size"), ("id",)}


def test_approval_states(spark):
    tables = [("s", "both"), ("s", "only_boot"), ("s", "ok"), ("s", "none"), ("t", "ok")]
    files = [
        ("s", "both.json"),
        ("s", "both_InitialLoad.json"),
        ("s", "only_boot_InitialLoad.json"),
        ("s", "ok.json"),
        ("s", "none.txt"),
        ("u", "none.json"),
    ]
    got = approval_states(
        spark.createDataFrame(tables, "schema_name string, table_name string"),
        spark.createDataFrame(files, "schema_name string, file_name string"),
    )
    assert {(r.schema_name, r.table_name): r.state for r in got.collect()} == {
        ("s", "both"): "approved",
        ("s", "only_boot"): "review",
        ("s", "ok"): "approved",
        ("s", "none"): "missing",
        ("t", "ok"): "missing",
    }


@pytest.fixture
def orders_csv(tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text('name,id\nÅsa,1\n"b, c",2\n')
    return str(path)


def test_gate_from_first_run_to_append(spark, tmp_path, orders_csv):
    registry = SchemaRegistry(spark, str(tmp_path / "registry"))
    target = PathTarget(str(tmp_path / "orders"))

    def run(**how):
        return gated_etl(orders_csv, registry, "sales", "orders", target, **how)

    with pytest.raises(SchemaMissing):
        registry.approved("sales", "orders")
    with pytest.raises(SchemaPending, match="orders_InitialLoad.json"):
        run()
    with pytest.raises(SchemaPending, match="only .*orders_InitialLoad.json"):
        run()
    recorded = tmp_path / "registry/sales/orders_InitialLoad.json"
    schema = json.loads(recorded.read_text(encoding="utf-8"))
    assert [field["name"] for field in schema["fields"]] == ["name", "id"]

    os.rename(recorded, tmp_path / "registry/sales/orders.json")
    run(mode="strict")
    assert target.read(spark).count() == 2

    schema["fields"] = [
        {"name": "id", "type": "integer", "nullable": False, "metadata": {}},
        {"name": "name", "type": "string", "nullable": True, "metadata": {"å": 1}},
    ]
    (tmp_path / "registry/sales/orders.json").write_text(json.dumps(schema), encoding="utf-8")
    with pytest.raises(SchemaDrift):
        run(mode="strict")
    target = PathTarget(str(tmp_path / "typed"))
    assert {tuple(row) for row in run().collect()} == {(1, "Åsa"), (2, "b, c")}
    assert target.read(spark).dtypes == [("id", "int"), ("name", "string")]


@pytest.mark.parametrize("separator", [",", "|", ";", "\t"])
def test_typed_csv(spark, tmp_path, separator):
    path = tmp_path / "x.csv"
    lines = [["id", "note", "size", "day"], ["1", '"say ""hi"""', "", "2024-01-02"]]
    lines.append(["2", '""', "1.5", ""])
    path.write_text("".join(separator.join(line) + "\n" for line in lines))
    assert sniff_separator(spark, str(path)) == separator
    frame = typed_csv(spark, str(path))
    types = {"id": "bigint", "note": "string", "size": "double", "day": "date"}
    assert dict(frame.dtypes) == types
    rows = {row.id: row for row in frame.collect()}
    assert (rows[1].note, rows[1].size) == ('say "hi"', None)
    assert (rows[2].note, rows[2].size, rows[2].day) == (None, 1.5, None)
    given = typed_csv(spark, str(path), "id bigint, note string, size double, day date")
    assert given.count() == 2


def test_typed_csv_does_not_hide_problems(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,size\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        typed_csv(spark, str(path), "id int, size int").collect()
    with pytest.raises(Exception, match="header"):
        typed_csv(spark, str(path), "size int, id string").collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,note\n1,"two\nlines"\n')
    row = typed_csv(spark, str(path), sep=",", multi_line=True).first()
    assert (row.id, row.note) == (1, "two\nlines")


def test_separators_are_told_from_all_lines(spark, tmp_path):
    blank, quoted, unclear = (tmp_path / name for name in ("a.csv", "b.csv", "c.csv"))
    blank.write_text("\nid;name\n1;x\n")
    quoted.write_text('"a,b,c";d\n1;2\n')
    unclear.write_text("a,b;c\n1,2;3\n")
    assert sniff_separator(spark, str(blank)) == ";"
    assert typed_csv(spark, str(quoted)).columns == ["a,b,c", "d"]
    with pytest.raises(ValueError, match="cannot be told"):
        typed_csv(spark, str(unclear))


def test_raw_csv_refuses_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw_csv(spark, str(tmp_path)).collect()


def test_the_gate_refuses_a_target_of_another_type(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id\n1\n")
    registry = SchemaRegistry(spark, str(tmp_path / "registry"))
    registry.record(StructType.fromDDL("id bigint"), "s", "t", APPROVED_ENDING)
    target = PathTarget(str(tmp_path / "t"))
    target.append(spark.sql("SELECT 5 AS id"))
    with pytest.raises(SchemaDrift):
        gated_etl(str(tmp_path / "x.csv"), registry, "s", "t", target)
    assert target.read(spark).count() == 1


def test_raw_csv_is_text(spark, orders_csv):
    assert raw_csv(spark, orders_csv).dtypes == [("name", "string"), ("id", "string")]


def test_wide_schema_cast_keeps_odd_names(spark):
    frame = spark.createDataFrame([("1", "2")], "`a.b` string, `c d` string")
    row = cast_to(frame, StructType.fromDDL("`c d` int, `a.b` int")).first()
    assert tuple(row) == (2, 1)
    assert rejected_rows(frame, frame.schema).count() == 0
    assert frame.select(F.col("`a.b`")).count() == 1


def paths_between(spark, expected, actual):
    lists = [schema_paths(spark, StructType.fromDDL(ddl)) for ddl in (expected, actual)]
    return [(r.column_name, r.kind, r.expected, r.actual) for r in path_drift(*lists).collect()]


def test_drift_by_path(spark):
    nested = "a struct<b: int, c: array<struct<d: date, e: map<string, int>>>>, f int"
    assert paths_between(spark, nested, nested) == []
    renamed = nested.replace("d: date", "x: date")
    assert paths_between(spark, nested, renamed) == [
        ("a.c[].d", "missing", "DateType()", None),
        ("a.c[].x", "unexpected", None, "DateType()"),
    ]
    for changed, expected in (
        (nested.replace("map<string, int>", "map<string, string>"), [("a.c[].e{value}", "type", "IntegerType()", "StringType()")]),
        (nested.replace("array<struct<d: date, e: map<string, int>>>", "string"), [("a.c", "type", "array", "StringType()")]),
        ("f int", [("a", "missing", "struct", None)]),
        (nested.replace("b: int", "b: int not null"), [("a.b", "type", "IntegerType()", "IntegerType() not null")]),
        ("f string, a struct<b: int>", [("a.c", "missing", "array", None), ("f", "type", "IntegerType()", "StringType()")]),
    ):
        assert paths_between(spark, nested, changed) == expected


def test_the_strict_gate_names_the_inner_field(spark):
    frame = spark.sql("SELECT named_struct('x', 1) AS a")
    with pytest.raises(SchemaDrift, match=r"missing: a\.y .*\n  unexpected: a\.x"):
        check_schema(frame, StructType.fromDDL("a struct<y: int not null>"), "strict")
