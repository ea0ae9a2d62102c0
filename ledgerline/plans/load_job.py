"""One endpoint's load for all tenants at once (the load job, section 3.1).

Landed files sit under ``<landed>/<tenant_col>=<id>/``, so partition
discovery gives every record its tenant.  The job is:

1. layout of each file (S1), strict parse of every record (S2) and the
   full-scan type probe (A11, C1);
2. normalise once and write the staging table (P1-P5, N1-N4, S15);
3. read the target rows of the staged tenants only (H1), whatever the types
   of their versions (C2, C3);
4. choose the write mode (P16) and build the new rows (W1-W5, P6, P7, C3-C5);
5. publish the touched tenants as a new version (per-tenant copy-on-write);
6. per-tenant summary: rows processed (A7), operations, bad records (S4);
7. monitoring snapshot upsert per tenant (A6, A7, W10), published as the next
   version of the endpoint's table below ``_monitoring``;
8. one event per tenant in the event log below ``_events`` (S18).

A tenant whose staging holds a key twice is refused (W9): its live rows stay,
it is reported as FAILED, and the other tenants load.  Malformed records never
delete live rows.

Every step is a DataFrame plan; the driver only sees schema-sized and
tenant-sized results (probe rows, the staged tenant list).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import keys as K
from ledgerline.operators import merge as M
from ledgerline.operators import monitor as MO
from ledgerline.operators import normalize as NZ
from ledgerline.operators import publish as PUB
from ledgerline.operators import schema as SC
from ledgerline.sources import landing as LD


def run_endpoint_load(spark: SparkSession, *, landed: str, root: str, table: str, version: int, synced_at,
                      layout: str = "auto", tenant_col: str = "company_id", key: str = "id",
                      use_merge: bool = True, is_production: bool = True,
                      date_col: str = "_report_date", staging_path: str | None = None,
                      endpoint: str | None = None, now=None) -> DataFrame:
    """Load one endpoint for every tenant with files under ``landed``.

    Returns one summary row per staged tenant: write mode, rows processed,
    rows inserted / updated / deleted by this run and bad records.

    Each file is read by its own layout; a stated ``layout`` must be that of
    all files.  Tenant ids that are not all numbers are text.

    A record that is malformed says nothing about its row: a row whose key the
    malformed text still shows is not deleted, and a tenant with a malformed
    record without a readable key gets no deletes in this load.  Where the
    mode can't tell rows apart (it replaces them), a tenant that has rows and
    malformed records is refused.
    """
    started = time.monotonic()
    chunks = LD.read_landed(spark, landed, layout)
    if tenant_col not in chunks.columns:          # the folder <tenant_col>=<id>
        chunks = _with_tenant(spark, chunks, landed, tenant_col)
    parsed = LD.parse_records(chunks)
    plan = NZ.infer_plan(parsed)
    names = next((c.source_keys for c in plan.columns if c.name == key), [key])
    plan.columns = [c for c in plan.columns if c.name != tenant_col]
    staging_path = staging_path or f"{root.rstrip('/')}/_staging/{table}"
    NZ.stage_landed(parsed, plan, staging_path, keep=[tenant_col], recover=names)
    staging_all = spark.read.parquet(staging_path)
    staging, _ = LD.read_staging(spark, staging_path)
    # One aggregate tells all that the load decides by: a row per staged
    # tenant, also of those with bad records alone.
    has_key = key in staging.columns
    readable = F.col("__key").try_cast(staging.schema[key].dataType) if has_key else F.lit(None)
    facts = staging_all.groupBy(tenant_col).agg(
        F.count_if("is_bad").alias("bad_records"), F.count_if(~F.col("is_bad")).alias("good_records"),
        F.count_if(F.col("is_bad") & readable.isNull()).alias("unreadable")).collect()   # tenant-sized
    # Rows without a tenant could never be found again.
    why = {None: "no tenant"} if any(r[0] is None for r in facts) else {}
    if has_key and use_merge and is_production:
        # A key that comes twice would multiply its rows with every load.
        twice = K.duplicate_keys(staging.where(F.col(key).isNotNull() & F.col(tenant_col).isNotNull()), [tenant_col, key])
        why.update({r[0]: "duplicate keys" for r in twice.select(tenant_col).distinct().collect()})   # tenant-sized
    tenants = [r[0] for r in facts if r["good_records"] and r[0] not in why]
    live = PUB.live_tenants(spark, root, table, tenants)
    target = PUB.read_tenants(spark, root, table, tenant_col, live=live)
    has_rows = target is not None and not target.isEmpty()
    has_dates = date_col in staging.columns
    mode = M.planned_mode(spark, is_production, use_merge, has_rows, has_key, has_dates,
                          has_dates and target is not None and date_col in target.columns)
    withheld: list = []
    spared = None
    malformed = [r[0] for r in facts if r["bad_records"] and r[0] in tenants]
    if mode == "merge" and malformed:
        withheld = [r[0] for r in facts if r["unreadable"] and r[0] in tenants]
        spared = staging_all.where("is_bad").select(tenant_col, readable.alias(key)).where(F.col(key).isNotNull())
    elif mode in ("overwrite", "replace_dates", "replace_all"):
        has = {r["tenant"] for r in live}
        why.update({t: "malformed records" for t in malformed if str(t) in has})
    refused = list(why)
    dropped, tenants = [t for t in tenants if t in why], [t for t in tenants if t not in why]
    staging = staging.where(~_one_of(tenant_col, refused))
    types = T.StructType([staging.schema[tenant_col], T.StructField("bad_records", T.LongType()), T.StructField("refused", T.BooleanType()),
                          T.StructField("reason", T.StringType()), T.StructField("withheld", T.BooleanType())])
    staged = spark.createDataFrame([(r[0], r["bad_records"], r[0] in why, why.get(r[0]), r[0] in withheld) for r in facts], types)
    processed = spark.createDataFrame([(r[0], r["good_records"]) for r in facts if r[0] in tenants],
                                      T.StructType([staging.schema[tenant_col], T.StructField("rows_processed", T.LongType())]))
    operations = ("INSERT", "UPDATE", "DELETE", "OVERWRITE")
    if not tenants:   # nothing to write: the table stays as it is, and the tenants are reported
        idle = staged.select(tenant_col, *[F.lit(0).cast("bigint").alias(f"n_{op.lower()}") for op in operations],
                             F.lit(None).cast("timestamp_ntz").alias("max_sync"))
        return _report(spark, root, "none", staged, processed, idle, tenant_col,
                       endpoint or table, version, started, now if now is not None else synced_at)
    if dropped and target is not None:
        live = [r for r in live if r["tenant"] in {None if t is None else str(t) for t in tenants}]
        target = PUB.read_tenants(spark, root, table, tenant_col, live=live)
    own: dict = {}
    if mode != "overwrite":  # which takes the staged types
        staging, target, own = _aligned(staging, target, live, tenants, tenant_col)
    if mode == "merge":
        deleting = [t for t in tenants if t not in withheld]
        if isinstance(staging.schema[tenant_col].dataType, T.StringType):
            deleting = [str(t) for t in deleting]
        out = M.merge_soft_delete(target, staging, synced_at, key=key, tenant_col=tenant_col, tenants=deleting, spared=spared)
    else:
        out = M.apply_write_mode(mode, target, staging, synced_at, tenant_col=tenant_col)
    PUB.publish_tenants(out, root, table, version, tenant_col, tenants=tenants, own={
        t: T.StructType([T.StructField(f.name, own.get(t, {}).get(f.name, f.dataType)) for f in out.schema.fields]) for t in tenants})

    # one scan of the touched tenants' live rows gives this run's operation
    # counts and the newest stamp (A6); the result is tenant-sized
    live_rows = PUB.read_tenants(spark, root, table, tenant_col, tenants)
    this_run = F.col(M.SYNCED) == M._ts(synced_at)
    stats_df = live_rows.groupBy(tenant_col).agg(
        *[F.count_if(this_run & (F.col(M.OPERATION) == op)).alias(f"n_{op.lower()}")
          for op in operations],
        F.max(M.SYNCED).alias("max_sync"))
    stats = spark.createDataFrame(stats_df.collect(), stats_df.schema)
    return _report(spark, root, mode, staged, processed, stats, tenant_col, endpoint or table, version, started,
                   now if now is not None else synced_at)


def _with_tenant(spark: SparkSession, chunks: DataFrame, landed: str, tenant_col: str) -> DataFrame:
    """The tenant of each record's folder: a number if all folders' are, else
    text; the folder of null is null."""
    files = tenant_names(LD.list_landed(spark, landed).select(F.col("path").alias("file_path")), tenant_col)
    name = F.col(tenant_col)
    text = files.agg(F.bool_or(name.isNotNull() & name.try_cast("bigint").isNull())).first()[0]
    chunks = tenant_names(chunks, tenant_col)
    return chunks if text else chunks.withColumn(tenant_col, name.try_cast("bigint"))


def tenant_names(df: DataFrame, tenant_col: str) -> DataFrame:
    """``df`` with the name of the tenant's folder in ``file_path``.

    The name is encoded twice: as a folder name and as the path of a file.
    Most have nothing to decode.  Each step is a projection of its own, so
    that it is taken once a record.
    """
    def decoded(c: str) -> Column:
        return F.when(F.contains(c, F.lit("%")), F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(F.col(c))

    df = df.withColumn(tenant_col, decoded("file_path"))
    df = df.withColumn(tenant_col, F.regexp_extract(tenant_col, f"{tenant_col}=([^/]+)", 1))
    df = df.withColumn(tenant_col, decoded(tenant_col))
    return df.withColumn(tenant_col, F.when(~F.col(tenant_col).isin("", PUB._NULL_FOLDER), F.col(tenant_col)))


def _aligned(staging: DataFrame, target: DataFrame | None, live: list, tenants: list, tenant_col: str):
    """Staging and target with the same types for the columns of both, and the
    own types of each tenant's columns.

    Every tenant's columns keep their own types, as if its table stood alone:
    its staged values are safely cast to these (P6).  Where tenants differ,
    the files take the least type that holds all of them.
    """
    staged_types = {f.name: f.dataType for f in staging.schema.fields if f.name != tenant_col}
    by_name = {None if t is None else str(t): t for t in tenants}
    stored = {by_name[name]: {f.name: f.dataType for f in st.fields}
              for name, st in PUB.own_schemas(live, tenant_col).items() if name in by_name}
    if target is not None:  # pointers without schemas: the files' types
        types = {f.name: f.dataType for f in target.schema.fields}
        for r in live:
            if not r["own"]:
                stored[by_name[r["tenant"]]] = types
    own = {t: {c: stored.get(t, {}).get(c, dt) for c, dt in staged_types.items()} for t in tenants}
    cols = []
    for c, dt in staged_types.items():
        owners: dict[str, list] = {}
        for t in tenants:
            owners.setdefault(own[t][c].json(), []).append(t)
        kinds = [own[ts[0]][c] for ts in owners.values()]
        joint = kinds[0]
        for k in kinds[1:]:
            joint = SC.join_types(joint, k)
        out = None
        for kind, ts in zip(kinds, owners.values()):
            v = SC.widen(M.safe_cast(F.col(c), dt, kind), kind, joint)
            out = v if out is None else F.when(_one_of(tenant_col, ts), v).otherwise(out)
        cols.append(out.alias(c))
        if target is not None and c in target.columns:
            have = target.schema[c].dataType
            if have != joint:
                target = target.withColumn(c, SC.widen(F.col(c), have, joint))
        for t in tenants:  # a variant that meets text is text from then on
            if isinstance(own[t][c], T.VariantType):
                own[t][c] = joint
    for t, types in stored.items():
        own[t] = {**types, **own[t]}
    # Ids that are numbers in one load and among texts in another are text.
    kind = staging.schema[tenant_col].dataType
    tenant = F.col(tenant_col)
    if target is not None:
        have = target.schema[tenant_col].dataType
        both = SC.join_types(have, kind)
        target, tenant = target.withColumn(tenant_col, SC.widen(tenant, have, both)), SC.widen(tenant, kind, both).alias(tenant_col)
    return staging.select(tenant, *cols).select(*staging.columns), target, own


def _report(spark: SparkSession, root: str, mode: str, staged: DataFrame, processed: DataFrame, stats: DataFrame,
            tenant_col: str, endpoint: str, version: int, started: float, now) -> DataFrame:
    """Monitoring rows, events and the summary of one load.  A tenant that is
    refused or whose records are all bad has FAILED and writes nothing."""
    seen = staged.join(processed, tenant_col, "left").select(
        tenant_col, F.coalesce("rows_processed", F.lit(0)).alias("rows_processed"), "bad_records", "refused", "reason", "withheld")
    seen = seen.withColumn("status", F.when(F.col("rows_processed") == 0, "FAILED").otherwise("SUCCESS"))
    record_events(seen, root, tenant_col, endpoint, version, now)
    update_monitoring(spark, root, stats, seen, tenant_col, endpoint, f"load {version}",
                      round(time.monotonic() - started, 2), now)
    ops = stats.drop("max_sync")
    return (staged.join(processed, tenant_col, "left").join(ops, tenant_col, "left")
            .select(tenant_col, F.when(F.col("rows_processed").isNull(), "none").otherwise(mode).alias("write_mode"),
                    F.coalesce("rows_processed", F.lit(0)).alias("rows_processed"),
                    *[F.coalesce(F.col(f"n_{op}"), F.lit(0)).alias(f"n_{op}")
                      for op in ("insert", "update", "delete", "overwrite")],
                    F.coalesce("bad_records", F.lit(0)).alias("bad_records")))


def _one_of(col: str, values: list) -> Column:
    """Whether ``col`` is one of ``values``; null counts as a value."""
    named = [v for v in values if v is not None]
    held = F.coalesce(F.col(col).isin(named), F.lit(False)) if named else F.lit(False)
    return held | F.col(col).isNull() if None in values else held


EVENTS = "_events"


def record_events(seen: DataFrame, root: str, tenant_col: str, endpoint: str, version: int, now) -> None:
    """One event per staged tenant.  Each load has a folder of its own,
    so a rerun replaces its events and loads that end together don't meet."""
    failed = F.col("status") == "FAILED"
    rows = F.concat(F.col("rows_processed").cast("string"), F.lit(" rows"))
    message = (F.when(F.col("refused"), F.col("reason")).when(failed, "no valid record")
               .when(F.col("withheld"), F.concat(rows, F.lit(", deletes withheld"))).otherwise(rows))
    events = MO.log_events(
        seen, timestamp=MO._now(now), company_id=F.col(tenant_col), endpoint=F.lit(endpoint),
        event_type=F.when(failed, "ERROR").otherwise("SUCCESS"), event_title=F.lit(f"Load {endpoint}"),
        event_message=message, source="ledgerline_load", info=F.struct("rows_processed", "bad_records"))
    events.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{EVENTS}/table={endpoint}/load={version}")


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """The event log of all loads, with the load's version as ``load``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{EVENTS}").drop("table")


MONITORING = "_monitoring"
MONITORING_SCHEMA = ("company_id {id}, endpoint_name string, max_sync timestamp_ntz, actual_rows bigint, "
                     "actual_duration double, actual_status string, last_rows bigint, last_duration double, "
                     "last_status string, updated_at timestamp_ntz")


def update_monitoring(spark: SparkSession, root: str, live: DataFrame, processed: DataFrame,
                      tenant_col: str, endpoint: str, token: str, duration: float, now) -> None:
    """W10 after a load: max ``_etl_synced`` per tenant (A6), staging rows
    (A7), the job's duration and status; previous actual_* move to last_*.

    ``live`` is either the table's rows or per-tenant stats that already
    carry ``max_sync``; ``processed`` may carry a status (else SUCCESS).
    Each endpoint has a snapshot of its own, so endpoints that end together
    don't meet.  ``token`` names the load: one that was recorded already
    changes nothing.
    """
    if "max_sync" in live.columns:
        max_sync = live.select(tenant_col, "max_sync")
    else:
        max_sync = MO.max_synced(live, [tenant_col], now)
    status = F.col("status") if "status" in processed.columns else F.lit("SUCCESS")
    table = f"{MONITORING}/{endpoint}"
    before = read_endpoint_monitoring(spark, root, endpoint)
    # Numbers, unless a tenant's id is text.
    kind = T.LongType() if isinstance(processed.schema[tenant_col].dataType, T.IntegralType) else T.StringType()
    kind = kind if before is None else SC.join_types(kind, before.schema["company_id"].dataType)
    empty = spark.createDataFrame([], MONITORING_SCHEMA.format(id=kind.simpleString()))
    run = (processed.join(max_sync, tenant_col, "left")
           .select(F.col(tenant_col).cast(kind).alias("company_id"),
                   F.lit(endpoint).alias("endpoint_name"), "max_sync",
                   "rows_processed", F.lit(float(duration)).alias("duration_sec"), status.alias("status")))
    PUB.publish(MO.monitor_upsert(empty if before is None else PUB.conform(before, empty.schema), run, now), root, table, token=token)


def read_endpoint_monitoring(spark: SparkSession, root: str, endpoint: str) -> DataFrame | None:
    """The newest monitoring rows of one endpoint."""
    return PUB.read_published(spark, root, f"{MONITORING}/{endpoint}")


def read_monitoring(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest monitoring rows of all endpoints; ids are text if those of
    one endpoint are."""
    newest = (PUB.published_versions(spark, root).where(F.col("table_name").startswith(MONITORING + "/"))
              .groupBy("table_name").agg(F.max_by("path", "version").alias("path")).collect())   # one row an endpoint
    parts = [spark.read.parquet(r["path"]) for r in sorted(newest)]
    text = any(isinstance(p.schema["company_id"].dataType, T.StringType) for p in parts)
    like = spark.createDataFrame([], MONITORING_SCHEMA.format(id="string" if text else "bigint")).schema
    out = None
    for p in parts:
        p = PUB.conform(p, like)
        out = p if out is None else out.unionByName(p)
    return out
