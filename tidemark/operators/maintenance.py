"""Table upkeep: which snapshots to expire and when, how fast they grow, what a catalog can do."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Retention and schedule of snapshot expiry.
RETAIN_LAST = 20
OLDER_THAN_HOURS = 6
SILVER_EVERY = 10
EXPIRE_EVERY = 6
PROBE_RETAIN_LAST = 999_999


def expirable_snapshots(
    history: DataFrame, cutoff: Column, retain_last: int = RETAIN_LAST, salts: int = 32
) -> DataFrame:
    """Snapshots older than the cutoff and not among a table's newest ones.

    history: table, snapshot_id, committed_at. Ranking every snapshot of a table
    would put its whole history in one task. Instead the newest retain_last are
    found, where Spark limits each group before the shuffle, and everything
    older than the last of them is expirable. That boundary is one row per table;
    the history meets it in `salts` shares of each table, so no task gets a whole
    table and no side has to be small. Snapshots without a table form one of their own.
    """
    order = ("committed_at", "snapshot_id")
    newest_first = Window.partitionBy("table").orderBy(*[F.col(c).desc() for c in order])
    kept = (
        history.select("table", *order)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= retain_last)
    )
    oldest_kept = kept.groupBy("table").agg(F.min(F.struct(*order)).alias("_oldest_kept"))
    boundary = oldest_kept.select(
        F.col("table").alias("_table"), "_oldest_kept", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_share")
    )
    old = history.where(F.col("committed_at") < cutoff).withColumn(
        "_salt", F.pmod(F.xxhash64("snapshot_id"), F.lit(salts)).cast("int")
    )
    return (
        old.join(boundary, F.col("table").eqNullSafe(F.col("_table")) & (F.col("_salt") == F.col("_share")))
        .where(F.struct(*order) < F.col("_oldest_kept"))
        .select(*history.columns)
    )


def hours_before(moment: Column, hours: int = OLDER_THAN_HOURS) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


def runs_silver(batch_id: Column, every: int = SILVER_EVERY) -> Column:
    return batch_id % every == 0


def runs_expiry(batch_id: Column, silver_every: int = SILVER_EVERY, every: int = EXPIRE_EVERY) -> Column:
    """Expiry runs in every nth silver run, never in the first."""
    run = F.floor(batch_id / silver_every)
    return runs_silver(batch_id, silver_every) & (run > 0) & (run % every == 0)


def schedule(batches: DataFrame, batch_id: str = "batch_id") -> DataFrame:
    """Which batches run silver, and which of those run expiry."""
    return batches.select(
        batch_id,
        runs_silver(F.col(batch_id)).alias("runs_silver"),
        F.when(runs_silver(F.col(batch_id)), F.floor(F.col(batch_id) / SILVER_EVERY)).alias("silver_run"),
        runs_expiry(F.col(batch_id)).alias("runs_expiry"),
    )


def snapshot_growth(history: DataFrame, retention_days: int = 5) -> DataFrame:
    """Commits per table and day, and snapshots retained under a retention in days.

    The window runs over one row per table and day.
    """
    daily = history.groupBy("table", F.to_date("committed_at").alias("day")).agg(
        F.count("*").alias("commits")
    )
    in_retention = (
        Window.partitionBy("table")
        .orderBy(F.datediff("day", F.to_date(F.lit("1970-01-01"))))
        .rangeBetween(-(retention_days - 1), 0)
    )
    return daily.withColumn("retained", F.sum("commits").over(in_retention))


def projected_retention(commits_per_day: int, retention_days: int) -> int:
    return commits_per_day * retention_days


def expire_call(
    catalog: str, table: str, older_than_hours: int, retain_last: int, now: datetime | None = None
) -> str:
    """The catalog procedure that expires snapshots of one table, with its cutoff as a UTC literal."""
    cutoff = (now or datetime.now(timezone.utc)) - timedelta(hours=older_than_hours)
    arguments = {
        "table": f"'{table}'",
        "older_than": f"TIMESTAMP '{cutoff:%Y-%m-%d %H:%M:%S}'",
        "retain_last": retain_last,
    }
    return f"CALL `{catalog}`.system.expire_snapshots({', '.join(f'{k} => {v}' for k, v in arguments.items())})"


def probe_statements(spark: SparkSession, statements: Sequence[tuple[str, str]]) -> DataFrame:
    """Run each named statement and report step, ok and error class."""
    outcomes = []
    for step, statement in statements:
        try:
            spark.sql(statement).collect()
            outcomes.append((step, True, None))
        except Exception as e:
            condition = getattr(e, "getCondition", lambda: None)()
            outcomes.append((step, False, condition or type(e).__name__))
    return spark.createDataFrame(outcomes, "step string, ok boolean, error string")


def probe_expiry(spark: SparkSession, catalog: str, namespace: str, tables: Sequence[str]) -> DataFrame:
    """Can the catalog list tables and run the expiry procedure? Expires nothing."""
    return probe_statements(
        spark,
        [("list tables", f"SHOW TABLES IN `{catalog}`.`{namespace}`")]
        + [
            (f"expire {t}", expire_call(catalog, f"{namespace}.{t}", 1, PROBE_RETAIN_LAST))
            for t in tables
        ],
    )
