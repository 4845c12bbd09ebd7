"""Files whose fields grow: versions of the schema, rescued values, and rows from before."""

import json
from collections import Counter

import pytest
from pyspark.sql import types as T

from millrace.scratch import scratch_path
from millrace.sources.evolving import Evolving


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_json_fields_join_the_schema(spark, tmp_path):
    src = tmp_path / "in"
    job = Evolving(spark, str(src), "json", scratch_path(spark, "ev"), "id bigint, name string")
    put(src, "a.json", '{"id": 1, "name": "x"}\n{"id": "one", "name": "bad id"}\nnot json\n')
    job.run()
    assert [s.names for _, s in job.versions()] == [["id", "name"]]  # a misfit or a broken line is no new field
    put(src, "b.json", "\n".join(json.dumps(r) for r in [{"id": 2, "size": 5, "when": "2024-01-02", "at": "2024-01-02T03:04:05", "ok": True, "tag": "t"},
                                                          {"id": 3, "size": 7, "part": 0.5, "none": None}]))
    job.run()
    put(src, "c.json", json.dumps({"id": 4, "size": "many", "tag": "u", "part": 2}))
    job.run()
    job.run()
    schema = job.schema()
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "id": "bigint", "name": "string", "size": "bigint", "when": "date", "at": "timestamp", "ok": "boolean", "tag": "string", "part": "double"}
    rows = {r.id: r for r in job.table().collect() if r.id is not None}
    assert (rows[2].size, str(rows[2].when), rows[2].ok, rows[2].tag, rows[2]._rescued_data) == (5, "2024-01-02", True, "t", None)
    assert (rows[3].size, rows[3].part, rows[3].tag, rows[3]._rescued_data) == (7, 0.5, None, None)
    assert (rows[4].size, rows[4].tag, rows[4].part, json.loads(rows[4]._rescued_data)) == (None, "u", 2.0, {"size": "many"})
    others = sorted(r._rescued_data for r in job.table().collect() if r.id is None)
    assert json.loads(others[1]) == {"id": "one"} and "not json" in others[0] and job.table().count() == 6
    stored = spark.read.parquet(f"{job.base}/rows")
    assert stored.filter("batch_id = 1 AND _rescued_data IS NOT NULL").count() == 2  # written once, filled when read


def test_csv_headers_are_read_by_name(spark, tmp_path):
    src = tmp_path / "in"
    job = Evolving(spark, str(src), "csv", scratch_path(spark, "ev"), "id bigint, price double")
    put(src, "a.csv", "id,price\n1,1.5\n2,\n")
    put(src, "b.csv", "price,id\n2.5,3\n")
    job.run()
    put(src, "c.csv", 'colour,price,id\n"red, dark",3.5,4\n')
    put(src, "d.csv", "id,price\n5,x\n")
    job.run()
    put(src, "e.csv", "id,colour\n6,blue\n")
    job.run()
    got = Counter((r.id, r.price, r.colour, r._rescued_data) for r in job.table().collect())
    assert got == Counter([(1, 1.5, None, None), (2, None, None, None), (3, 2.5, None, None), (4, 3.5, "red, dark", None),
                           (5, None, None, '{"price":"x"}'), (6, None, "blue", None)])
    assert [b for b, _ in job.versions()] == [-1, 1]


def test_a_repeated_batch_finds_the_same_version(spark, tmp_path):
    job = Evolving(spark, str(tmp_path), "json", scratch_path(spark, "ev"), "id bigint")
    lines = spark.createDataFrame([('{"id": 1, "a": 1}',)], "value string")
    for _ in range(2):
        job._lines(lines, 0)
    more = spark.createDataFrame([('{"id": 2, "a": 2, "b": 1}',)], "value string")
    for _ in range(2):
        job._lines(more, 1)
    assert [s.names for _, s in job.versions()] == [["id"], ["id", "a"], ["id", "a", "b"]]
    assert sorted(map(tuple, job.table().collect())) == [(1, 1, None, None), (2, 2, 1, None)]
    assert isinstance(job.schema()["a"].dataType, T.LongType)


def test_other_formats_are_refused(spark):
    with pytest.raises(ValueError):
        Evolving(spark, "x", "xml", "y", "id bigint")
