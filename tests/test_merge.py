from pyspark.sql import functions as F

from siltstone.operators.merge import append, insert_new, overwrite, unseen
from siltstone.operators.rank import first_by, latest_by


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def got(df):
    return sorted((r.k or "", r.v) for r in df.collect())


def test_first_and_latest(spark):
    df = frame(spark, [("a", 2), ("a", 1), ("a", None), ("b", None)])
    assert got(first_by(df.filter("k = 'a'"), ["k"], ["v"])) == [("a", 1)]
    assert got(latest_by(df.filter("k = 'a'"), ["k"], ["v"])) == [("a", 2)]
    assert latest_by(df.filter("k = 'b'"), ["k"], ["v"]).count() == 1


def test_insert_new(spark):
    target = frame(spark, [("a", 0)])
    source = frame(spark, [("a", 9), ("b", 3), ("b", 2), ("c", 1)])
    assert got(insert_new(source, target, ["k"], ["v"])) == [("b", 2), ("c", 1)]


def test_null_keys_never_match(spark):
    target = frame(spark, [(None, 0)])
    source = frame(spark, [(None, 1), (None, 2)])
    assert got(insert_new(source, target, ["k"], ["v"])) == [("", 1), ("", 2)]


def test_stable_columns_join_too(spark):
    target = frame(spark, [("a", 1)])
    rows = frame(spark, [("a", 1), ("b", 1)])
    assert got(unseen(rows, target, ["k"], ["v"])) == [("b", 1)]


def test_large_batches_give_the_same(spark):
    """Without broadcasts, the path taken beyond the size limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(4000).selectExpr("IF(id % 3 = 0, 'hot', 'k' || id) AS k", "CAST(id AS INT) AS v")
        target = df.filter("v % 5 = 1")
        keys = {r.k for r in target.collect()}
        want = sorted({r.k for r in df.collect()} - keys)
        assert [k for k, _ in got(insert_new(df, target, ["k"], ["v"]))] == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_writes_match_columns_by_name(spark, lake):
    table = lake.gold("dim_users")
    rows = spark.createDataFrame([("IN", "u1", "e1")], "country string, user_id string, email string")
    append(rows, table)
    append(rows, table)
    assert spark.table(table).count() == 2
    overwrite(rows, table)
    assert [tuple(r) for r in spark.table(table).select("user_id", "email", "country").collect()] == [
        ("u1", "e1", "IN")
    ]


def test_reset(spark, lake):
    from siltstone.schemas import create_tables

    rows = spark.createDataFrame([("u", "e", "c")], "user_id string, email string, country string")
    append(rows, lake.gold("dim_users"))
    create_tables(spark, lake)
    assert spark.table(lake.gold("dim_users")).count() == 1
    create_tables(spark, lake, reset=True)
    assert spark.table(lake.gold("dim_users")).count() == 0
    parts = {r.col_name for r in spark.sql(f"DESCRIBE {lake.gold('fact_orders')}").collect()}
    assert "order_date" in parts


def test_spread_keeps_all_rows_of_one_partition_value(spark, lake):
    table = lake.gold("fact_payments")
    rows = spark.range(5000).select(
        F.concat(F.lit("p"), "id").alias("payment_id"),
        F.lit("o").alias("order_id"),
        F.lit(1).cast("decimal(10,2)").alias("payment_amount"),
        F.lit("USD").alias("currency"),
        F.lit("payment_failed").alias("payment_status"),
        F.lit("2024-01-01").cast("date").alias("payment_date"),
    )
    append(rows, table, "payment_date")
    assert spark.table(table).count() == 5000


def test_one_hot_partition_value_is_written_by_many_tasks(spark, lake):
    """Two thirds of the rows share one date; AQE splits that slice."""
    table = lake.gold("fact_payments")
    rows = spark.range(0, 200_000, numPartitions=8).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS payment_id", "sha2(CAST(-id AS STRING), 256) AS order_id",
        "CAST(1 AS DECIMAL(10,2)) AS payment_amount", "'USD' AS currency",
        "'payment_failed' AS payment_status",
        "IF(id % 3 < 2, DATE '2024-01-01', DATE '2024-01-02') AS payment_date",
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2MB")
    try:
        append(rows, table, "payment_date")
    finally:
        spark.conf.set(key, before)
    hot = spark.table(table).filter("payment_date = DATE '2024-01-01'")
    assert hot.select("_metadata.file_path").distinct().count() > 2
    assert spark.table(table).count() == 200_000
