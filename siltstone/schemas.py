"""Table and contract definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains, payload contracts and table columns of the lakehouse.
DOMAINS = ("user_events", "payment_events", "order_events")

CONTRACT = {
    "user_events": ("user_id", "email", "country", "device"),
    "payment_events": ("payment_id", "order_id", "amount", "currency", "status"),
    "order_events": ("order_id", "user_id", "amount", "currency", "status"),
}

_COMMON = {
    "file_id": "STRING",
    "domain": "STRING",
    "source_system": "STRING",
    "created_at": "TIMESTAMP",
    "event_id": "STRING",
    "event_type": "STRING",
    "source": "STRING",
    "event_ts": "TIMESTAMP",
    "ingest_ts": "TIMESTAMP",
    "event_date": "DATE",
}

# Column to type, in table order.
SILVER = {
    domain: {**_COMMON, **{f: "DECIMAL(10,2)" if f == "amount" else "STRING" for f in fields}}
    for domain, fields in CONTRACT.items()
}

REJECTED = {
    "file_id": "STRING",
    "domain": "STRING",
    "source_system": "STRING",
    "created_at": "TIMESTAMP",
    "etag": "STRING",
    "event_id": "STRING",
    "event_type": "STRING",
    "rejection_reason": "STRING",
    "raw_event_json": "STRING",
    "rejection_ts": "TIMESTAMP",
    "rejection_date": "DATE",
    "reject_hash": "STRING",
}

GOLD = {
    "fact_orders": {
        "order_id": "STRING",
        "user_id": "STRING",
        "order_amount": "DECIMAL(10,2)",
        "currency": "STRING",
        "order_status": "STRING",
        "is_paid_flag": "BOOLEAN",
        "order_date": "DATE",
    },
    "fact_payments": {
        "payment_id": "STRING",
        "order_id": "STRING",
        "payment_amount": "DECIMAL(10,2)",
        "currency": "STRING",
        "payment_status": "STRING",
        "payment_date": "DATE",
    },
    "dim_users": {"user_id": "STRING", "email": "STRING", "country": "STRING"},
}

LEDGER = {
    "etag": "STRING",
    "file_path": "STRING",
    "status": "STRING",
    "lease_expiry": "BIGINT",
    "created_at": "TIMESTAMP",
    "updated_at": "TIMESTAMP",
    "retry_count": "INT",
    "run_id": "STRING",
    "seq": "BIGINT",
}

FILE_METRICS = {
    "etag": "STRING",
    "total_events": "BIGINT",
    "rejected_events": "BIGINT",
    "valid_events": "BIGINT",
    "file_status": "STRING",
}

# ``arrival_date`` is the day of the file's first claim, as the ledger has it.
ROUTED = {
    "file_path": "STRING",
    "etag": "STRING",
    "value": "STRING",
    "route": "STRING",
    "arrival_date": "DATE",
}

PARTITION = {
    **{domain: "event_date" for domain in DOMAINS},
    "rejected_events": "rejection_date",
    "routed_files": "arrival_date",
    "fact_orders": "order_date",
    "fact_payments": "payment_date",
    "changes": "log_date",
    "file_ledger": "log_date",
    "ledger_snapshot": "is_open",
    "event_keys": "domain",
    "clustered": "name",
}

# Tables with a partition column before that of ``PARTITION``.
OUTER = {"routed_files": "route"}

# Latest user event per user: what ``dim_users`` is taken from.
USER_LATEST = {
    "user_id": "STRING",
    "email": "STRING",
    "country": "STRING",
    "event_ts": "TIMESTAMP",
    "event_id": "STRING",
}

# Event dates that silver runs have touched, one entry id per run; and who has taken which.
CHANGES = {
    "entry": "STRING",
    "domain": "STRING",
    "event_date": "DATE",
    "logged_at": "TIMESTAMP",
    "log_date": "DATE",
}
TAKEN = {"consumer": "STRING", "entry": "STRING", "taken_at": "TIMESTAMP"}

# Hashes of silver's event ids and the partitions that may hold them.
EVENT_KEYS = {"domain": "STRING", "key": "BIGINT", "part": "DATE"}

# Partitions as clustering left them: the write that made all their files, and how many files.
CLUSTERED = {"name": "STRING", "part": "DATE", "job": "STRING", "files": "BIGINT"}

# Columns each table is clustered by on a rewrite.
CLUSTER_BY = {
    "user_events": ("event_id",),
    "payment_events": ("event_id", "order_id"),
    "order_events": ("event_id", "order_id"),
    "fact_orders": ("order_id", "user_id"),
    "fact_payments": ("payment_id", "order_id"),
}


_TRACK = "spark.sql.hive.manageFilesourcePartitions"


def ddl(columns: dict[str, str]) -> str:
    """Column list as DDL text."""
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


@dataclass(frozen=True)
class Lake:
    """Schema names of one lakehouse; ``prefix`` keeps several apart in one catalog.

    ``grain`` is a property of its tables: ``day`` partitions the dated ones by their date,
    ``month`` by the first day of the month, in a column of its own, where a day holds too
    few rows for files of its own. The date itself stays a column either way.

    The silver runs of an ``indexed`` lake keep an index of event ids and read only the
    partitions that may hold an id of the batch; ``rebuild_keys`` makes one of a lake that
    had none.
    """

    prefix: str = ""
    grain: str = "day"
    indexed: bool = False

    def __post_init__(self) -> None:
        if self.grain not in ("day", "month"):
            raise ValueError(f"grain must be 'day' or 'month', not {self.grain!r}")

    def partition(self, name: str) -> str | None:
        """The column that table ``name`` is partitioned by."""
        return partition_column(PARTITION[name], self.grain) if name in PARTITION else None

    def dated(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the column that table ``name`` is partitioned by."""
        column = self.partition(name)
        if column is None or column == PARTITION[name]:
            return df
        return df.withColumn(column, F.trunc(PARTITION[name], "month"))

    def schema(self, tier: str) -> str:
        return f"{self.prefix}{tier}"

    def silver(self, domain: str) -> str:
        return f"{self.schema('silver')}.{domain}"

    def gold(self, table: str) -> str:
        return f"{self.schema('gold')}.{table}"

    @property
    def rejected(self) -> str:
        return f"{self.schema('bronze')}.rejected_events"

    @property
    def ledger(self) -> str:
        return f"{self.schema('control')}.file_ledger"

    @property
    def ledger_snapshot(self) -> str:
        return f"{self.schema('control')}.ledger_snapshot"

    @property
    def event_keys(self) -> str:
        return f"{self.schema('control')}.event_keys"

    @property
    def clustered(self) -> str:
        return f"{self.schema('control')}.clustered"

    @property
    def metrics(self) -> str:
        return f"{self.schema('control')}.file_metrics"

    @property
    def user_latest(self) -> str:
        return f"{self.schema('control')}.user_latest"

    @property
    def changes(self) -> str:
        return f"{self.schema('control')}.changes"

    @property
    def taken(self) -> str:
        return f"{self.schema('control')}.taken"

    @property
    def routed(self) -> str:
        return f"{self.schema('bronze')}.routed_files"

    def tables(self) -> dict[str, dict[str, str]]:
        """Full table name to columns."""
        return {
            **{self.silver(domain): columns for domain, columns in SILVER.items()},
            self.rejected: REJECTED,
            self.routed: ROUTED,
            **{self.gold(table): columns for table, columns in GOLD.items()},
            self.ledger: {**LEDGER, "log_date": "DATE"},
            self.ledger_snapshot: {**LEDGER, "folded_to": "DATE", "is_open": "BOOLEAN"},
            self.event_keys: EVENT_KEYS,
            self.user_latest: USER_LATEST,
            self.metrics: FILE_METRICS,
            self.changes: CHANGES,
            self.taken: TAKEN,
            self.clustered: CLUSTERED,
        }

    def published(self) -> set[str]:
        """Tables that are replaced as a whole: their location is their version."""
        return {*(self.gold(table) for table in GOLD), self.user_latest, self.ledger_snapshot, self.clustered}


def partition_column(date: str, grain: str) -> str:
    """Partition column of a table that is dated by ``date``."""
    return date.removesuffix("_date") + "_month" if grain == "month" and date.endswith("_date") else date


def create_tables(
    spark: SparkSession, lake: Lake = Lake(), location: str | None = None, reset: bool = False
) -> None:
    """Create schemas and tables that are missing; ``reset`` drops them first.

    ``location`` is a folder that holds one sub-folder per schema.
    """
    for tier in ("bronze", "silver", "gold", "control"):
        schema = lake.schema(tier)
        if reset:
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
        place = f" LOCATION '{location.rstrip('/')}/{schema}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")
    tracked = spark.conf.get(_TRACK)
    try:
        for name, columns in lake.tables().items():
            short = name.split(".")[-1]
            part = lake.partition(short)
            by = f" PARTITIONED BY ({', '.join([*filter(None, [OUTER.get(short)]), part])})" if part else ""
            own = columns if part is None or part in columns else {**columns, part: "DATE"}
            # a published table's partitions are the folders of its location, not entries of the catalog
            spark.conf.set(_TRACK, str(name not in lake.published()).lower())
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(own)}) USING parquet{by}")
    finally:
        spark.conf.set(_TRACK, tracked)
