import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import container, event
from siltstone.functions import text as T
from siltstone.operators import files as I
from siltstone.operators.columns import require_columns, union_by_name
from siltstone.sources import files as S

JSON_TEXT = {
    "{}": True,
    ' {"a": 1}\n': True,
    '{"a":{"b":[1,2,{"c":null}]}}': True,
    "": False,
    " ": False,
    "{": False,
    '{"a":1} x': False,
    '{"a":1}]': False,
    '{"a":1}][{"b":2}': False,
    '{"a":1}, {"b":2}': False,
    '{"a":1},': False,
    '{"a":1}}': False,
    "[1]": False,
    '[{"a":1}]': False,
    "5": False,
    "null": False,
    '"s"': False,
    "{'a':1}": False,
    '{"a":NaN}': False,
    '{a:1}': False,
    '{"a":01}': False,
    '{"a":1},{"seal":"x"}': False,
    'not json': False,
}


def test_strict_json(spark):
    df = spark.createDataFrame([(t,) for t in JSON_TEXT], "value string")
    df = df.withColumn("parsed", T.sealed(F.col("value")))
    got = df.select("value", T.is_intact(F.col("parsed"), F.col("value")).alias("ok")).collect()
    assert {r.value: r.ok for r in got} == JSON_TEXT


def test_paths(spark):
    df = spark.createDataFrame(
        [("s3a://b/x/order_1.json",), ("s3://b/x/order_1.json",), ("file:///t/a",), ("file:/t/a",), ("/t/a",)],
        "p string",
    )
    got = [r[0] for r in df.select(T.plain_path(F.col("p"))).collect()]
    assert got == ["s3://b/x/order_1.json"] * 2 + ["file:/t/a"] * 3
    assert df.select(T.base_name(F.col("p"))).first()[0] == "order_1.json"


def test_routes(spark):
    names = {
        "raw/order_1.json": "order_events",
        "raw/orders/payment_1.json": "payment_events",
        "user_1.json": "user_events",
        "raw/other_1.json": "unrouted",
    }
    df = spark.createDataFrame([(n, "{}") for n in names], "file_path string, value string")
    got = I.classify_files(df).collect()
    assert {r.file_path: r.route for r in got} == names
    assert {r.status for r in got if r.route == "unrouted"} == {"REJECTED"}
    assert {r.etag for r in got} == {"99914b932bd37a50b983c5e7c90ae93b"}


def test_given_etag_wins(spark):
    df = spark.createDataFrame(
        [("user_1", "{}", "given"), ("user_2", "{", None)], "file_path string, value string, etag string"
    )
    got = {r.file_path: (r.etag, r.status, r.route) for r in I.classify_files(df).collect()}
    assert got["user_1"] == ("given", "VALIDATED", "user_events")
    assert got["user_2"][1:] == ("REJECTED", "rejected")


def test_messages(spark):
    note = {
        "Records": [
            {"s3": {"bucket": {"name": "b"}, "object": {"key": f"raw/user_{i}", "eTag": f"t{i}"}}}
            for i in range(2)
        ]
    }
    df = spark.createDataFrame([(json.dumps(note),), ('{"Records":[]}',), ("broken",)], "body string")
    got = I.unnest_notifications(df)
    paths = got.select(I.object_path().alias("p"), "etag").collect()
    assert sorted((r.p, r.etag) for r in paths) == [("s3://b/raw/user_0", "t0"), ("s3://b/raw/user_1", "t1")]
    files = spark.createDataFrame([("s3://b/x", "t")], "file_path string, etag string")
    assert I.decode_messages(I.encode_messages(files)).collect() == files.collect()


@pytest.fixture
def folder(tmp_path):
    for n in (1, 2):
        with open(tmp_path / f"order_{n}.json", "w") as out:
            json.dump(container([event(n)], n=n), out, indent=2)
    return str(tmp_path)


def test_read_containers(spark, folder):
    files = [{"file_path": f"{folder}/order_{n}.json", "etag": f"t{n}"} for n in (1, 2)]
    got = S.read_containers(spark, files).collect()
    assert sorted(r.etag for r in got) == ["t1", "t2"]
    assert all(json.loads(r.value)["file_id"] in ("f1", "f2") for r in got)
    single = S.read_containers(spark, files[0]).collect()
    assert [os.path.basename(r.file_path) for r in single] == ["order_1.json"]


def test_no_files(spark):
    with pytest.raises(ValueError):
        S.file_list(spark, [])
    assert S.no_rows(spark, "a string").count() == 0


def test_file_without_etag_fails(spark, folder):
    listed = S.file_list(spark, {"file_path": f"file:{folder}/order_1.json", "etag": "t1"})
    with pytest.raises(Exception, match="no etag for file .*order_2.json"):
        S.with_etags(S.read_texts(spark, folder), listed).collect()


def test_column_helpers(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert require_columns(a, ["a"]) is a
    with pytest.raises(ValueError, match="missing required columns: c, d"):
        require_columns(a, ["a", "c", "d"])
    assert sorted(map(tuple, union_by_name([a, b]).collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        union_by_name([])
