"""Monitoring, workload and log operators.

All are aggregates with a partial (map-side) step; single-value results
(totals, means) enter other plans as scalar subqueries, never as cross
joins or driver round trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.values import json_text
from ledgerline.operators import merge as M

# Fixed values of the reference's sizing rules.
DEFAULT_TOTAL_WEIGHT = 2400.0   # seconds assumed when there is no history
DEFAULT_COMPANY_WEIGHT = 60.0   # seconds per company with no history
SECONDS_PER_TASK = 600
PULL_TASKS = (3, 20)
LOAD_TASKS = (4, 25)
HISTORY_DAYS = 7


def _now(now) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp_ntz")


def recent(snapshot: DataFrame, now, days: int = HISTORY_DAYS) -> DataFrame:
    return snapshot.where(F.col("updated_at") >= _now(now) - F.expr(f"INTERVAL {days} DAYS"))


def company_weights(snapshot: DataFrame, now, days: int = HISTORY_DAYS) -> DataFrame:
    """A1: summed duration per company over the last ``days``."""
    return (recent(snapshot, now, days).groupBy("company_id")
            .agg(F.sum("actual_duration").alias("total_duration")))


def total_weight(snapshot: DataFrame, now, days: int = HISTORY_DAYS) -> DataFrame:
    """A2: one row; zero or missing history falls back to 2,400 s."""
    s = recent(snapshot, now, days).agg(F.sum("actual_duration").alias("s"))
    return s.select(F.coalesce(F.nullif(F.col("s"), F.lit(0.0)),
                               F.lit(DEFAULT_TOTAL_WEIGHT)).alias("total_weight"))


def task_counts(total: DataFrame) -> DataFrame:
    """A4: ``ceil(total / 600)`` clamped to 3..20 (pull) and 4..25 (load)."""
    n = F.ceil(F.col("total_weight") / SECONDS_PER_TASK)
    return total.select(
        "total_weight",
        F.least(F.greatest(n, F.lit(PULL_TASKS[0])), F.lit(PULL_TASKS[1])).cast("bigint")
        .alias("pull_tasks"),
        F.least(F.greatest(n, F.lit(LOAD_TASKS[0])), F.lit(LOAD_TASKS[1])).cast("bigint")
        .alias("load_tasks"))


def weighted_companies(companies: DataFrame, weights: DataFrame) -> DataFrame:
    """J2 + A3: each company's weight, else the mean weight, else 60 s.

    The mean is a scalar subquery over the (per-company) weights.
    """
    mean_w = weights.agg(F.avg("total_duration")).scalar()
    w = weights.select(F.col("company_id").alias("w_company_id"), "total_duration")
    joined = companies.join(w, companies["company_id"] == w["w_company_id"], "left")
    return joined.select(*companies.columns, F.coalesce(
        F.col("total_duration"), mean_w, F.lit(DEFAULT_COMPANY_WEIGHT)).alias("weight"))


def max_synced(final: DataFrame, by: list[str], now) -> DataFrame:
    """``max(_etl_synced)`` per table and tenant, default now."""
    return final.groupBy(*by).agg(
        F.coalesce(F.max(M.SYNCED), _now(now)).alias("max_sync"))


def rows_processed(staging: DataFrame, by: list[str]) -> DataFrame:
    """Staging rows per (tenant, endpoint), not rows changed."""
    return staging.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_processed"))


def monitor_upsert(snapshot: DataFrame, run: DataFrame, now) -> DataFrame:
    """W10 on (company_id, endpoint_name).

    ``run`` has company_id, endpoint_name, max_sync, rows_processed,
    duration_sec, status.  Matched: last_* := old actual_*, actual_* := run,
    max_sync, updated_at := now.  New: last_* stay null.
    """
    t, s = M.t_col, M.s_col
    src = run.select("company_id", "endpoint_name", "max_sync",
                     F.col("rows_processed").alias("actual_rows"),
                     F.round(F.col("duration_sec"), 2).alias("actual_duration"),
                     F.col("status").alias("actual_status"))
    return M.upsert(
        snapshot, src, ["company_id", "endpoint_name"],
        set_exprs={
            "last_rows": t("actual_rows"), "last_duration": t("actual_duration"),
            "last_status": t("actual_status"),
            "actual_rows": s("actual_rows"), "actual_duration": s("actual_duration"),
            "actual_status": s("actual_status"), "max_sync": F.coalesce(s("max_sync"), t("max_sync")),
            "updated_at": _now(now)},
        insert_exprs={"updated_at": _now(now)})


def catalog_summary(catalog: DataFrame, companies: DataFrame) -> DataFrame:
    """A8 (after J1, finding 13): reports and active reports per company
    name and category."""
    j = catalog.join(companies.select("company_id", "company_name"), "company_id")
    return (j.groupBy("company_name", "report_category")
            .agg(F.count(F.lit(1)).alias("total_reports"),
                 F.count_if(F.col("is_active")).alias("active_reports")))


def run_summary(log: DataFrame, run_col: str = "run_id") -> DataFrame:
    """A10: total, ok and failed units per run."""
    failed = F.upper(F.col("event_type")) == "ERROR"
    return (log.groupBy(run_col)
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(~failed).alias("ok"),
                 F.count_if(failed).alias("failed")))


LOG_COLUMNS = ["timestamp", "company_id", "company_name", "project_id", "endpoint",
               "event_type", "event_title", "event_message", "source", "info"]


def log_events(df: DataFrame, *, timestamp: Column, company_id: Column, event_type: Column,
               event_title: Column, source: str, company_name: Column | None = None,
               project_id: Column | None = None, endpoint: Column | None = None,
               event_message: Column | None = None, info: Column | None = None) -> DataFrame:
    """Rows of the event-log table (id as text, ``info`` as JSON text,
    empty/zero ids and empty info become null)."""
    null = F.lit(None).cast("string")
    cid = company_id.cast("string")
    return df.select(
        timestamp.alias("timestamp"),
        F.when(company_id.isNotNull() & (cid != "0") & (cid != ""), cid).alias("company_id"),
        (company_name if company_name is not None else null).alias("company_name"),
        (project_id if project_id is not None else null).alias("project_id"),
        (endpoint if endpoint is not None else null).alias("endpoint"),
        event_type.alias("event_type"),
        event_title.alias("event_title"),
        (event_message if event_message is not None else null).alias("event_message"),
        F.lit(source).alias("source"),
        (F.when(info.isNotNull(), json_text(info)) if info is not None else null).alias("info"))
