"""Streams whose input gains fields: rescue, stored schemas, hints, merge."""

import json

import pytest

from weft.sources.sinks import read_table
from weft.streaming import ingest
from weft.streaming.ingest import await_all, ingest_folder, stream_table
from weft.streaming.schema_store import RESCUED, SchemaStore, rescued_fields, with_hints


def drop_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def test_unexpected_field_is_rescued_then_a_column(spark, tmp_path, monkeypatch):
    raw, out, ck = tmp_path / "raw", f"{tmp_path}/out", f"{tmp_path}/ck"

    def run(hints="id BIGINT"):
        await_all(ingest_folder(spark, str(raw), "json", out, ck, hints=hints))
        return {r.id: r for r in read_table(spark, out).collect()}

    drop_file(raw, "a.json", [{"id": 1, "name": "x"}, {"id": 2, "name": None}])
    first = run()
    assert (first[1].name, first[1][RESCUED]) == ("x", None)
    # no later run looks at the data to find the schema
    monkeypatch.setattr(ingest, "infer_schema", lambda *a, **k: pytest.fail("inferred again"))
    drop_file(raw, "b.json", [{"id": 3, "name": "y", "extra": 5, "tags": ["p", "q"], "ok": True}, {"id": 4}, "no json"])
    second = run()
    assert json.loads(second[3][RESCUED]) == {"extra": "5", "tags": '["p","q"]', "ok": "true"}
    assert second[4][RESCUED] is None and second[None][RESCUED] == "no json"
    drop_file(raw, "c.json", [{"id": 5, "name": "z", "extra": 1.5, "ok": False}, {"id": "six", "extra": "much"}])
    third = run("id BIGINT, extra DOUBLE")  # a hint overrides the type found
    assert (third[5].extra, third[5].ok, third[5].tags, third[5][RESCUED]) == (1.5, False, None, None)
    assert (third[1].extra, third[3].extra) == (None, None)  # older rows read null
    rescued = [r[RESCUED] for r in read_table(spark, out).collect() if r[RESCUED]]
    assert '{"id":"six","extra":"much"}' in rescued  # values that miss their type
    store = SchemaStore(spark, f"{ck}-schema")
    assert store.version() == 1 and dict((f.name, f.dataType.simpleString()) for f in store.latest().fields) == {
        "id": "bigint", "name": "string", "extra": "double", "ok": "boolean", "tags": "string"}


def test_a_restart_without_new_files_changes_nothing(spark, tmp_path):
    raw, out, ck = tmp_path / "raw", f"{tmp_path}/out", f"{tmp_path}/ck"
    drop_file(raw, "a.json", [{"id": i} for i in range(10)])
    for _ in range(2):
        await_all(ingest_folder(spark, str(raw), "json", out, ck))
    assert read_table(spark, out).count() == 10 and SchemaStore(spark, f"{ck}-schema").version() == 0


def test_csv_files_of_different_columns(spark, tmp_path):
    raw, out, ck = tmp_path / "raw", f"{tmp_path}/out", f"{tmp_path}/ck"

    def run():
        await_all(ingest_folder(spark, str(raw), "csv", out, ck, "id BIGINT, name STRING"))
        return {r.id: r for r in read_table(spark, out).collect()}

    drop_file(raw, "a.csv", ["id,name", '1,"x, y"', "2,", ""])
    first = run()
    assert (first[1].name, first[2].name, first[1][RESCUED]) == ("x, y", None, None)
    drop_file(raw, "b.csv", ["name,when,id", "z,2020,3", "w,,4", "v,2021,5,more"])
    second = run()
    assert (second[3].name, json.loads(second[3][RESCUED])) == ("z", {"when": "2020"})
    assert second[4][RESCUED] is None
    assert json.loads(second[5][RESCUED])["_c3"] == "more"
    drop_file(raw, "c.csv", ["id,name,when", "6,u,2022"])
    third = run()
    assert (third[6].when, third[6][RESCUED], third[3].when) == (2022, None, None)


def test_silver_stream_takes_new_columns(spark, tmp_path):
    raw, bronze, silver = tmp_path / "raw", f"{tmp_path}/bronze", f"{tmp_path}/silver"

    def run():
        await_all(ingest_folder(spark, str(raw), "json", bronze, f"{tmp_path}/ck1", "id BIGINT"))
        await_all(stream_table(spark, bronze, lambda df: df.drop(RESCUED), silver, f"{tmp_path}/ck2"))

    for i, row in enumerate([{"id": 1}, {"id": 2, "more": 7}, {"id": 3, "more": 8}]):
        drop_file(raw, f"{i}.json", [row])
        run()
    assert sorted((r.id, r.more) for r in read_table(spark, silver).collect()) == [(1, None), (2, None), (3, 8)]


def test_types_of_rescued_fields_and_hints(spark):
    from pyspark.sql.types import StructType

    rows = spark.createDataFrame([
        ('{"a":"1","b":"1.5","c":"true","d":"x","known":"y"}',), ('{"a":"2","b":"3","c":"false","d":"1","e":"5"}',),
        ("not json",), ('{"_line":"1,2,3"}',)], f"{RESCUED} string")
    assert rescued_fields(rows, ["known"]).simpleString() == (
        "struct<a:bigint,b:double,c:boolean,d:string,e:bigint>")
    schema = StructType.fromDDL("a INT, b STRING")
    assert with_hints(schema, "b DATE, z INT").simpleString() == "struct<a:int,b:date,z:int>"
    assert with_hints(schema, None) is schema


def test_casts_are_not_repeated_for_every_field(spark):
    lines = spark.createDataFrame(
        [('{"id":"1","n":"x","u":2}',), ('{"id":"1","n":"2"}',), ('{"id":1,"id":"b","n":null}',), ("no record",)], "value string")
    got = ingest.json_fields(lines, ingest.StructType.fromDDL("id BIGINT, n DOUBLE"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, '{"n":"x","u":"2"}'), (1, 2.0, None), (1, None, None), (None, None, "no record")], key=str)
    plan = got._jdf.queryExecution().analyzed().toString()
    end = start = plan.index("map_filter(") + len("map_filter")
    depth = 0
    while end == start or depth:
        depth += {"(": 1, ")": -1}.get(plan[end], 0)
        end += 1
    assert "lambda" in plan[start:end] and "cast" not in plan[start:end]
