"""Star schema, de-duplication and insert-only merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import star
from siltstone.operators.columns import union_by_name
from siltstone.operators.merge import append, fresh, insert_new
from siltstone.operators.rank import first_by
from siltstone.operators.changes import log_changes
from siltstone.plans.gold import (
    catch_up_gold,
    changed_orders,
    changed_users,
    refresh_gold,
    touched_days,
    update_gold,
)
from siltstone.plans.silver import run_silver_batch
from siltstone.queries import feeds
from siltstone.queries.registry import query
from siltstone.queries.checks import silver_sql
from siltstone.schemas import GOLD, SILVER, Lake, create_tables
from siltstone.session import instant, scratch_path

SINCE = "2000-01-01"

# Fixed value in the SQL: the payment status that counts as paid.
_PAID = f"""WITH {feeds.SQL_SILVER},
paid AS (SELECT order_id, coalesce(bool_or(status = 'payment_success'), FALSE) AS is_paid
         FROM payment_events GROUP BY order_id)"""

_FACT_ORDERS = f"""{_PAID},
newest AS (
  SELECT order_id, arg_max(
    {{'user_id': user_id, 'amount': amount, 'currency': currency, 'status': status, 'event_ts': event_ts}},
    {{'at': event_ts, 'id': event_id}}) AS e
  FROM order_events GROUP BY order_id)
SELECT order_id, e.user_id, e.amount AS order_amount, e.currency, e.status AS order_status,
  order_id IN (SELECT order_id FROM paid WHERE is_paid) AS is_paid_flag,
  CAST(e.event_ts AS DATE) AS order_date
FROM newest"""

_DIM_USERS = f"""WITH {feeds.SQL_SILVER}
SELECT user_id, u.email, u.country FROM (
  SELECT user_id, arg_max({{'email': email, 'country': country}}, {{'at': event_ts, 'id': event_id}}) AS u
  FROM user_events GROUP BY user_id)"""

_FACT_PAYMENTS = f"""WITH {feeds.SQL_SILVER}
SELECT payment_id, order_id, amount AS payment_amount, currency, status AS payment_status,
  CAST(event_ts AS DATE) AS payment_date FROM payment_events"""


@query("fact_orders", _FACT_ORDERS)
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = star.fact_payments(feeds.payment_events(spark, sf_dir))
    return star.fact_orders(feeds.order_events(spark, sf_dir), payments)


@query("fact_payments", _FACT_PAYMENTS)
def fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_payments(feeds.payment_events(spark, sf_dir))


@query("dim_users", _DIM_USERS)
def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_users(feeds.user_events(spark, sf_dir))


@query(
    "payment_summary",
    f"{_PAID} SELECT order_id, is_paid FROM paid",
)
def payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.payment_summary(star.fact_payments(feeds.payment_events(spark, sf_dir)))


@query(
    "latest_order_row",
    f"""WITH {feeds.SQL_SILVER} SELECT order_id, e.event_id, e.status FROM (
      SELECT order_id, arg_max({{'event_id': event_id, 'status': status}}, {{'at': event_ts, 'id': event_id}}) AS e
      FROM order_events GROUP BY order_id)""",
)
def latest_order_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.operators.rank import latest_by

    narrow = feeds.order_events(spark, sf_dir).select("order_id", "event_id", "status", "event_ts")
    return latest_by(narrow, ["order_id"], ["event_ts", "event_id"]).drop("event_ts")


# --- one row per key, insert-only merge ---------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_REST = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]
_LINE_ORDER = ", ".join(f"{c} NULLS LAST" for c in _LINE_REST)


@query(
    "first_per_key",
    f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1""",
)
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_by(feeds.load(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_REST)


@query(
    "insert_new",
    f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {_LINE_ORDER}) AS rn FROM lineitem WHERE l_partkey % 2 = 1) s
    WHERE rn = 1 AND NOT EXISTS (
      SELECT 1 FROM lineitem t WHERE t.l_partkey % 2 = 0
        AND t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""",
)
def insert_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd parts arrive at a table that holds the even ones."""
    lines = feeds.load(spark, sf_dir, "lineitem")
    source, target = lines.filter("l_partkey % 2 = 1"), lines.filter("l_partkey % 2 = 0")
    return insert_new(source, target, _LINE_KEY, _LINE_REST)


# --- whole gold runs -------------------------------------------------------------


def _tables_sql(orders: str, payments: str, users: str) -> str:
    """The rows of all three gold tables, under their table's name."""
    parts = {"fact_orders": orders, "fact_payments": payments, "dim_users": users}
    return " UNION ALL BY NAME ".join(f"(SELECT '{t}' AS gold_table, * FROM ({sql}))" for t, sql in parts.items())


_GOLD = _tables_sql(_FACT_ORDERS, _FACT_PAYMENTS, _DIM_USERS)


def _gold_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    tables = [
        fresh(spark, lake.gold(t)).select(F.lit(t).alias("gold_table"), *GOLD[t])
        for t in ("fact_orders", "fact_payments", "dim_users")
    ]
    return union_by_name(tables, fill_missing=True)


def _new_lake(spark: SparkSession) -> Lake:
    """A lake by months: the given orders are few a day."""
    path = scratch_path(spark, "lake")
    lake = Lake(prefix=f"q{path[-12:]}_", grain="month")
    create_tables(spark, lake, location=path)
    return lake


def _load(spark: SparkSession, sf_dir: str, lake: Lake, keep: str = "TRUE") -> list:
    """Append the silver rows that ``keep`` picks; returns the days they touch."""
    loaded = []
    for domain in SILVER:
        rows = getattr(feeds, domain)(spark, sf_dir).filter(keep).select(*SILVER[domain])
        append(lake.dated(rows, domain), lake.silver(domain), lake.partition(domain))
        loaded.append(rows)
    return touched_days(*loaded)


@query("gold_refresh", _GOLD)
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables loaded, gold rebuilt twice: the overwrite replaces all rows."""
    lake = _new_lake(spark)
    _load(spark, sf_dir, lake)
    refresh_gold(spark, lake)
    refresh_gold(spark, lake)
    return _gold_rows(spark, lake)


@query("gold_update", _GOLD)
def gold_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold built up to a date, then brought forward by the newer dates."""
    lake = _new_lake(spark)
    _load(spark, sf_dir, lake, f"event_date < DATE '{SINCE}'")
    refresh_gold(spark, lake)
    update_gold(spark, _load(spark, sf_dir, lake, f"event_date >= DATE '{SINCE}'"), lake)
    return _gold_rows(spark, lake)


@query("gold_update_late", _GOLD)
def gold_update_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold brought forward by events that come late, of any date."""
    lake = _new_lake(spark)
    late = "pmod(xxhash64(event_id), 3) = 0"
    _load(spark, sf_dir, lake, f"NOT {late}")
    refresh_gold(spark, lake)
    update_gold(spark, _load(spark, sf_dir, lake, late), lake)
    return _gold_rows(spark, lake)


@query("gold_catch_up", _GOLD)
def gold_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold follows the log of touched dates, also those of loads after which no gold run came."""
    lake = _new_lake(spark)

    def load(keep: str) -> None:
        days = [(str(d),) for d in _load(spark, sf_dir, lake, keep)]
        dates = spark.createDataFrame(days, "d string").selectExpr("'any' AS domain", "CAST(d AS DATE) AS event_date")
        log_changes(spark, lake, dates, instant(feeds.AS_OF))

    third = "pmod(xxhash64(event_id), 3)"
    load(f"{third} = 0")
    catch_up_gold(spark, lake, feeds.AS_OF)
    load(f"{third} = 1")
    load(f"{third} = 2")
    catch_up_gold(spark, lake, feeds.AS_OF)
    assert not catch_up_gold(spark, lake, feeds.AS_OF), "all entries are taken"
    return _gold_rows(spark, lake)


_CHECKED = ", ".join(f"{d} AS ({silver_sql(d)})" for d in SILVER)


def _of_documents(sql: str) -> str:
    """A star schema query over accepted events of the documents, once each."""
    return sql.replace(f"WITH {feeds.SQL_SILVER}", f"WITH {feeds.SQL_JUDGED}, {_CHECKED}")


@query(
    "gold_from_files",
    _tables_sql(*(_of_documents(sql) for sql in (_FACT_ORDERS, _FACT_PAYMENTS, _DIM_USERS))),
)
def gold_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to silver in two runs, the first of them twice; gold catches up after each."""
    lake = _new_lake(spark)
    texts = feeds.delivered(feeds.documents(spark, sf_dir))
    # a planted second delivery stands in the next document; none stands in one of 29 * n + 1
    middle = 29 * (feeds.load(spark, sf_dir, "events").count() // 58) + 1
    for part in (f"eid < {middle}", f"eid < {middle}", f"eid >= {middle}"):
        own = texts.filter(part).drop("eid")
        run_silver_batch(spark, own, lake, feeds.AS_OF, on_unexpected="reject")
        catch_up_gold(spark, lake, feeds.AS_OF)
    return _gold_rows(spark, lake)


def _brought_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, payments = feeds.order_events(spark, sf_dir), feeds.payment_events(spark, sf_dir)
    old = f"event_date < DATE '{SINCE}'"
    before = star.fact_orders(orders.filter(old), star.fact_payments(payments.filter(old)))
    recent = [f.filter(f"NOT ({old})") for f in (orders, payments)]
    changed = changed_orders(orders, payments, before, star.fact_payments(payments), touched_days(*recent))
    kept = before.join(changed.select("order_id"), "order_id", "left_anti")
    return kept.unionByName(changed.drop("old_date"))


@query("changed_orders", _FACT_ORDERS)
def orders_brought_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brought_forward(spark, sf_dir)


@query("changed_users", _DIM_USERS)
def users_brought_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = feeds.user_events(spark, sf_dir)
    old = "event_date < DATE '2024-01-10'"
    before = star.latest_users(users.filter(old))
    after = changed_users(users, before, touched_days(users.filter(f"NOT ({old})")))
    return after.select("user_id", "email", "country")
