from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.layout import bucket_bounds, bucket_of, cluster_table, clustered, interleaved, maintain
from siltstone.schemas import PARTITION, SILVER


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 0), (0, 3), (3, 3)], "a int, b int")
    got = [r[0] for r in df.select(interleaved([F.col("a"), F.col("b")], 2)).collect()]
    assert got == [0b0000, 0b0001, 0b0010, 0b0101, 0b1010, 0b1111]


def test_bounds_split_evenly(spark):
    df = spark.range(8000).select(F.concat(F.lit("k"), F.lpad("id", 6, "0")).alias("k"))
    bounds = bucket_bounds(df, ["k"], 3)["k"]
    assert len(bounds) == 7
    sizes = df.groupBy(bucket_of(F.col("k"), bounds, "string").alias("b")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1600


def test_bounds_of_few_values(spark):
    df = spark.range(100).select(F.lit("same").alias("k"))
    assert bucket_bounds(df, ["k"], 3) == {"k": ["same"]}
    assert bucket_bounds(df.filter("false"), ["k"], 3) == {"k": []}
    nulls = spark.createDataFrame([(None,), ("a",)], "k string")
    assert {r[0] for r in nulls.select(bucket_of(F.col("k"), ["a"], "string")).collect()} == {0, 1}


def test_clustering_narrows_every_column(spark):
    """A range in either column touches few of the tasks."""
    df = spark.range(20000).selectExpr("hash(id) AS a", "hash(id, 7) AS b")
    out = clustered(df, ["a", "b"], files=16).withColumn("p", F.spark_partition_id())
    for column in ("a", "b"):
        low = df.selectExpr(f"percentile_approx({column}, 0.1)").first()[0]
        assert out.filter(F.col(column) < low).select("p").distinct().count() <= 8


def test_hot_key_is_spread(spark):
    """A third of the rows share one key; no task gets them all."""
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, 'hot', 'k' || id) AS k", "id % 7 AS v")
    out = clustered(df, ["k", "v"], files=9)
    per_task = Counter(r.p for r in out.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).collect())
    assert sum(per_task.values()) == 3000
    assert len(per_task) >= 3 and max(per_task.values()) < 2000


def test_table_rewrite(spark, lake):
    from siltstone.operators.merge import append
    from siltstone.queries import feeds

    rows = feeds.order_events(spark, "/root/testdata/sf0.001").filter("event_date < DATE '1995-06-01'")
    rows = rows.select(*SILVER["order_events"])
    table = lake.silver("order_events")
    append(rows, table, PARTITION["order_events"])
    columns = spark.table(table).columns
    before = sorted(map(tuple, spark.table(table).collect()), key=repr)
    cluster_table(spark, table, ["event_id", "order_id"], files=4, partition="event_date")
    cluster_table(
        spark, table, ["event_id"], files=2, partition="event_date",
        where="event_date >= DATE '1995-04-01'",
    )
    assert spark.table(table).columns == columns
    assert sorted(map(tuple, spark.table(table).collect()), key=repr) == before
    parts = spark.sql(f"SHOW PARTITIONS {table}").count()
    assert parts == rows.select("event_date").distinct().count()


def test_predicate_beyond_the_partition_is_refused(spark, lake):
    from siltstone.operators.merge import append
    from siltstone.queries import feeds

    table = lake.silver("order_events")
    rows = feeds.order_events(spark, "/root/testdata/sf0.001").filter("event_date < DATE '1995-03-01'")
    append(rows.select(*SILVER["order_events"]), table, PARTITION["order_events"])
    before = spark.table(table).count()
    with pytest.raises(ValueError, match="event_date alone"):
        cluster_table(spark, table, ["event_id"], 2, "event_date", "amount > 100")
    assert spark.table(table).count() == before > 0


def test_sample_does_not_grow_with_tasks(spark):
    df = spark.range(0, 400_000, 1, numPartitions=200).withColumnRenamed("id", "k")
    bounds = bucket_bounds(df, ["k"], 2, sample_rows=500)["k"]
    assert len(bounds) == 3 and all(abs(b - 100_000 * (i + 1)) < 30_000 for i, b in enumerate(bounds))


def test_broken_swap_is_undone(spark, lake):
    table = f"{lake.schema('gold')}.swapped"
    spark.range(50).withColumnRenamed("id", "k").write.format("parquet").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    cluster_table(spark, table, ["k"], files=2)
    assert spark.table(table).count() == 50
    assert not spark.catalog.tableExists(f"{table}__old")


def test_maintain_keeps_all_rows(spark, lake):
    from siltstone.operators.merge import append
    from siltstone.plans.gold import refresh_gold
    from siltstone.queries import feeds

    keep = "event_date < DATE '1995-02-01'"
    for domain in SILVER:
        rows = getattr(feeds, domain)(spark, "/root/testdata/sf0.001").filter(keep)
        append(rows.select(*SILVER[domain]), lake.silver(domain), PARTITION[domain])
    refresh_gold(spark, lake)
    tables = [lake.silver(d) for d in SILVER] + [lake.gold(t) for t in ("fact_orders", "fact_payments")]
    before = {t: sorted(map(tuple, spark.table(t).collect()), key=repr) for t in tables}
    maintain(spark, lake, files=4)
    assert not any(maintain(spark, lake, files=4).values())
    assert {t: sorted(map(tuple, spark.table(t).collect()), key=repr) for t in tables} == before


def _files(spark, table, part):
    spark.catalog.refreshTable(table)
    rows = spark.table(table).select(part, "_metadata.file_name").distinct().collect()
    return {value: {r[1] for r in rows if r[0] == value} for value in {r[0] for r in rows}}


def test_maintain_rewrites_what_changed(spark, any_lake):
    """New rows, a file rewritten elsewhere, and rows without a date; other partitions keep their files."""
    from siltstone.operators.merge import append, overwrite_partitions

    lake = any_lake
    table, part = lake.silver("order_events"), lake.partition("order_events")

    def orders(*days):
        rows = [(f"e{i}-{d}", f"o{i}", d) for d in days for i in range(20)]
        made = spark.createDataFrame(rows, "event_id string, order_id string, day string")
        columns = [F.col("day").cast("date").alias("event_date") if c == "event_date"
                   else F.col(c) if c in ("event_id", "order_id") else F.lit(None).cast(kind).alias(c)
                   for c, kind in SILVER["order_events"].items()]
        return lake.dated(made.select(*columns), "order_events")

    append(orders("2024-01-05", "2024-02-05", "2024-03-05", None), table, part)
    assert maintain(spark, lake, files=4)["order_events"] == 4
    first = _files(spark, table, part)
    assert maintain(spark, lake, files=4) == {"user_events": 0, "payment_events": 0, "order_events": 0, "fact_orders": 0, "fact_payments": 0}
    assert _files(spark, table, part) == first

    append(orders("2024-02-05"), table, part)
    append(orders(None), table, part)
    overwrite_partitions(orders("2024-03-05"), table, part)  # as many files as before, of another write
    assert maintain(spark, lake, files=4)["order_events"] == 3
    second = _files(spark, table, part)
    changed = {value for value in first if first[value] != second[value]}
    assert {str(v)[:7] for v in changed} == {"2024-02", "2024-03", "None"}
    assert maintain(spark, lake, files=4)["order_events"] == 0
    counts = {r[0]: r[1] for r in spark.table(table).groupBy("event_date").count().collect()}
    assert {str(k): v for k, v in counts.items()} == {"2024-01-05": 20, "2024-02-05": 40, "2024-03-05": 20, "None": 40}


def test_maintain_after_a_dead_call(spark, lake, monkeypatch):
    """A call that dies between the rewrite and its record is done again; no row is lost."""
    from siltstone.operators import layout
    from siltstone.operators.merge import append
    from siltstone.queries import feeds

    rows = feeds.order_events(spark, "/root/testdata/sf0.001").filter("event_date < DATE '1995-02-01'")
    table = lake.silver("order_events")
    append(rows.select(*SILVER["order_events"]), table, PARTITION["order_events"])
    before = sorted(map(tuple, spark.table(table).collect()), key=repr)

    def dies(*args, **kwargs):
        raise RuntimeError("driver gone")

    with monkeypatch.context() as patch:
        patch.setattr(layout, "publish", dies)
        with pytest.raises(RuntimeError):
            maintain(spark, lake, files=4)
    assert maintain(spark, lake, files=4)["order_events"] > 0
    assert maintain(spark, lake, files=4)["order_events"] == 0
    assert sorted(map(tuple, spark.table(table).collect()), key=repr) == before
