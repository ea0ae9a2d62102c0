"""Derived inputs (FIXTURES.md section 4) built from the driver tables.

Each fixture is a plain DataFrame plan over the whole parquet table; the
modulo rules only decide which rows sit on which side of a merge pair.
The matching DuckDB text lives next to each one so the oracle derives the
very same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed run stamps: results must not depend on the clock.
T0 = "2024-12-31 00:00:00"   # stamp of the stored target
SYNCED_AT = "2025-01-01 00:00:00"  # stamp of this run
RUN_DATE = "2025-01-02"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


# ------------------------------------------------------------------ F-A
def orders_base(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus",
                    "o_totalprice", "o_orderdate", "o_orderpriority")


def fa_target(spark, sf_dir) -> DataFrame:
    return (orders_base(spark, sf_dir).where(F.col("id") % 13 != 0)
            .withColumns({"_etl_synced": ts(T0), "_etl_operation": F.lit("INSERT")}))


def fa_staging(spark, sf_dir) -> DataFrame:
    b = orders_base(spark, sf_dir).where(F.col("id") % 10 != 0)
    return b.withColumn("o_totalprice", F.when(F.col("id") % 7 == 1, F.col("o_totalprice") + 1)
                        .otherwise(F.col("o_totalprice")))


SQL_FA = f"""
fa_base AS (SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                   o_orderpriority FROM orders),
fa_t AS (SELECT *, TIMESTAMP '{T0}' AS _etl_synced, 'INSERT' AS _etl_operation
         FROM fa_base WHERE id % 13 <> 0),
fa_s AS (SELECT id, o_custkey, o_orderstatus,
                CASE WHEN id % 7 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                o_orderdate, o_orderpriority FROM fa_base WHERE id % 10 <> 0)
"""


# ------------------------------------------------------------------ F-F
def ff_target(spark, sf_dir) -> DataFrame:
    return fa_target(spark, sf_dir).withColumn("company_id", F.col("id") % 3)


def ff_staging(spark, sf_dir) -> DataFrame:
    """Staging lacks tenant 2 (its file is missing this run)."""
    s = fa_staging(spark, sf_dir).withColumn("company_id", F.col("id") % 3)
    return s.where(F.col("company_id") != 2)


SQL_FF = """
ff_t AS (SELECT *, id % 3 AS company_id FROM fa_t),
ff_s AS (SELECT *, id % 3 AS company_id FROM fa_s WHERE id % 3 <> 2)
"""


# ------------------------------------------------------------------ F-B
def fb_lineitem(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                     "l_returnflag", F.to_date("l_shipdate").alias("_report_date"))


# The month left out of the target and the week staged: fixed dates inside
# the lineitem ship-date range.
FB_MONTH_FROM, FB_MONTH_TO, FB_WEEK_FROM, FB_WEEK_TO = ("1995-03-01", "1995-04-01",
                                                       "1995-03-10", "1995-03-17")


def fb_target(spark, sf_dir) -> DataFrame:
    b = fb_lineitem(spark, sf_dir)
    d = F.col("_report_date")
    return (b.where(~((d >= F.lit(FB_MONTH_FROM).cast("date")) & (d < F.lit(FB_MONTH_TO).cast("date"))))
            .withColumns({"_etl_synced": ts(T0), "_etl_operation": F.lit("INSERT")}))


def fb_staging(spark, sf_dir) -> DataFrame:
    """One staged week, plus the lines of every 97th order with a null date
    (report rows that arrived without a date)."""
    b = fb_lineitem(spark, sf_dir)
    d = F.col("_report_date")
    week = (d >= F.lit(FB_WEEK_FROM).cast("date")) & (d < F.lit(FB_WEEK_TO).cast("date"))
    nulls = (F.col("l_orderkey") % 97 == 0) & ~week
    return (b.where(week | nulls)
            .withColumn("_report_date", F.when(week, d))
            .withColumn("l_quantity", F.col("l_quantity") + 1))


SQL_FB = f"""
fb_base AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
                   l_returnflag, CAST(l_shipdate AS DATE) AS _report_date FROM lineitem),
fb_t AS (SELECT *, TIMESTAMP '{T0}' AS _etl_synced, 'INSERT' AS _etl_operation FROM fb_base
         WHERE NOT (_report_date >= DATE '{FB_MONTH_FROM}' AND _report_date < DATE '{FB_MONTH_TO}')),
fb_s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 1 AS l_quantity, l_extendedprice,
                l_returnflag,
                CASE WHEN _report_date >= DATE '{FB_WEEK_FROM}' AND _report_date < DATE '{FB_WEEK_TO}'
                     THEN _report_date END AS _report_date
         FROM fb_base
         WHERE (_report_date >= DATE '{FB_WEEK_FROM}' AND _report_date < DATE '{FB_WEEK_TO}')
            OR (l_orderkey % 97 = 0))
"""


# ------------------------------------------------------------------ F-D
def fd_staging(spark, sf_dir) -> DataFrame:
    """Orders with the price landed as text: every 50th value ``N/A``, every
    51st ``3.0``; an extra column only in staging."""
    b = orders_base(spark, sf_dir)
    price = (F.when(F.col("id") % 50 == 0, F.lit("N/A"))
             .when(F.col("id") % 51 == 0, F.lit("3.0"))
             .otherwise(F.col("o_totalprice").cast("string")))
    return b.withColumn("o_totalprice", price).withColumn(
        "o_clerk", F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string")))


def fd_target(spark, sf_dir) -> DataFrame:
    """Target keeps the double price and a column only it has."""
    b = orders_base(spark, sf_dir).where(F.col("id") % 13 != 0)
    return (b.withColumn("o_comment", F.concat(F.lit("c"), F.col("id").cast("string")))
            .withColumns({"_etl_synced": ts(T0), "_etl_operation": F.lit("INSERT")}))


# ------------------------------------------------------------ tenants
def companies(spark, sf_dir) -> DataFrame:
    """Tenants from customer (credential columns never exist here)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"),
        F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit("proj-"), F.col("c_nationkey").cast("string")))
        .alias("company_project_id"),
        (F.col("c_acctbal") > 0).alias("company_load_status"),
        (F.col("c_mktsegment") != "BUILDING").alias("company_pull_status"))


SQL_COMPANIES = """
companies AS (SELECT c_custkey AS company_id, c_name AS company_name,
  CASE WHEN c_custkey % 9 <> 0 THEN 'proj-' || CAST(c_nationkey AS VARCHAR) END AS company_project_id,
  c_acctbal > 0 AS company_load_status, c_mktsegment <> 'BUILDING' AS company_pull_status
  FROM customer)
"""


# ------------------------------------------------------------ F-C
SPLIT_TS = "2024-01-20 00:00:00"


def history(spark, sf_dir) -> DataFrame:
    """Monitoring history: one snapshot row per event."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("company_id"), F.col("event_type").alias("endpoint_name"),
                    F.col("value").alias("actual_duration"), F.col("ts").alias("updated_at"))


def events_now(spark, sf_dir):
    """"now" = max(ts) of events, as a scalar subquery."""
    return table(spark, sf_dir, "events").agg(F.max("ts")).scalar()


def fc_snapshot(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("ts") < ts(SPLIT_TS))
    return (e.groupBy(F.col("user_id").alias("company_id"), F.col("event_type").alias("endpoint_name"))
            .agg(F.max("ts").alias("max_sync"), F.count(F.lit(1)).alias("actual_rows"),
                 F.round(F.sum("value"), 2).alias("actual_duration"))
            .select("company_id", "endpoint_name", "max_sync", "actual_rows", "actual_duration",
                    F.lit("SUCCESS").alias("actual_status"),
                    F.lit(None).cast("bigint").alias("last_rows"),
                    F.lit(None).cast("double").alias("last_duration"),
                    F.lit(None).cast("string").alias("last_status"),
                    F.col("max_sync").alias("updated_at")))


def fc_run(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("ts") >= ts(SPLIT_TS))
    return (e.groupBy(F.col("user_id").alias("company_id"), F.col("event_type").alias("endpoint_name"))
            .agg(F.max("ts").alias("max_sync"), F.count(F.lit(1)).alias("rows_processed"),
                 F.round(F.sum("value"), 2).alias("duration_sec"))
            .withColumn("status", F.lit("SUCCESS")))


SQL_FC = f"""
fc_t AS (SELECT user_id AS company_id, event_type AS endpoint_name, max(ts) AS max_sync,
                count(*) AS actual_rows, round(sum(value), 2) AS actual_duration
         FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}' GROUP BY 1, 2),
fc_s AS (SELECT user_id AS company_id, event_type AS endpoint_name, max(ts) AS max_sync,
                count(*) AS rows_processed, round(sum(value), 2) AS duration_sec
         FROM events WHERE ts >= TIMESTAMP '{SPLIT_TS}' GROUP BY 1, 2)
"""


# ------------------------------------------------------------ registry
def registry(spark, sf_dir) -> DataFrame:
    """Endpoint registry from part: nested endpoint struct + flags."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    endpoint = F.struct(
        F.lower("p_type").alias("module"), F.lit("v2").alias("version"),
        F.when(k % 5 == 0, F.lit("jobs")).alias("submodule"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("name"),
        F.when(k % 11 == 0, F.lit("export")).alias("endpoint_type"))
    return p.select(
        endpoint.alias("endpoint"), F.concat(F.lit("tbl_"), k.cast("string")).alias("table_name"),
        (F.col("p_size") > 5).alias("active"), (k % 4 != 0).alias("silver_use_bronze"),
        F.when(k % 3 == 0, F.lit(False)).when(k % 3 == 1, F.lit(True)).alias("use_merge"),
        F.when(k % 7 != 0, F.col("p_size") % 2 == 0).alias("is_production"))


SQL_REGISTRY = """
registry AS (SELECT lower(p_type) AS ep_module, 'v2' AS ep_version,
  CASE WHEN p_partkey % 5 = 0 THEN 'jobs' END AS ep_submodule,
  replace(p_name, ' ', '-') AS ep_name,
  CASE WHEN p_partkey % 11 = 0 THEN 'export' END AS ep_endpoint_type,
  'tbl_' || CAST(p_partkey AS VARCHAR) AS table_name, p_size > 5 AS active,
  p_partkey % 4 <> 0 AS silver_use_bronze,
  CASE WHEN p_partkey % 3 = 0 THEN false WHEN p_partkey % 3 = 1 THEN true END AS use_merge,
  CASE WHEN p_partkey % 7 <> 0 THEN p_size % 2 = 0 END AS is_production
  FROM part)
"""


# ------------------------------------------------------------ report catalog
PARAMS_JSON = ('[{"name": "From", "dataType": "Date"}, {"name": "To", "dataType": "Date"}, '
               '{"name": "BusinessUnitId", "dataType": "Number"}]')
FIELDS_JSON = '[{"name": "Id", "dataType": "Number"}, {"name": "Name", "dataType": "String"}]'


def catalog(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    active = k % 3 == 0
    return s.select(
        F.col("s_nationkey").cast("bigint").alias("company_id"),
        F.concat(F.lit("cat"), (k % 5).cast("string")).alias("report_category"),
        k.alias("report_id"), F.col("s_name").alias("report_name"),
        F.lit(None).cast("string").alias("report_description"),
        ts(T0).alias("report_modified_on"), F.lit(PARAMS_JSON).alias("parameters"),
        F.lit("[]").alias("fields"), active.alias("is_active"),
        F.when(active, F.concat(F.lit("rep_"), k.cast("string"))).alias("table_name"),
        F.when(active, F.lit("2024-06-01").cast("date")).alias("history_from"),
        ts(T0).alias("discovered_at"))


def discovered(spark, sf_dir) -> DataFrame:
    """What discovery finds: every report, some under a new id."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.col("s_nationkey").cast("bigint").alias("company_id"),
        F.concat(F.lit("cat"), (k % 5).cast("string")).alias("report_category"),
        F.when(k % 6 == 0, k + 1_000_000).otherwise(k).alias("report_id"), F.concat(F.col("s_name"), F.lit(" v2")).alias("report_name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("report_description"),
        ts(SYNCED_AT).alias("report_modified_on"), F.lit(PARAMS_JSON).alias("parameters"),
        F.lit(FIELDS_JSON).alias("fields"), ts(SYNCED_AT).alias("discovered_at"))


SQL_CATALOG = f"""
catalog AS (SELECT CAST(s_nationkey AS BIGINT) AS company_id,
  'cat' || CAST(s_suppkey % 5 AS VARCHAR) AS report_category, s_suppkey AS report_id,
  s_name AS report_name, CAST(NULL AS VARCHAR) AS report_description,
  TIMESTAMP '{T0}' AS report_modified_on, '{PARAMS_JSON}' AS parameters, '[]' AS fields,
  s_suppkey % 3 = 0 AS is_active,
  CASE WHEN s_suppkey % 3 = 0 THEN 'rep_' || CAST(s_suppkey AS VARCHAR) END AS table_name,
  CASE WHEN s_suppkey % 3 = 0 THEN DATE '2024-06-01' END AS history_from,
  TIMESTAMP '{T0}' AS discovered_at
  FROM supplier),
discovered AS (SELECT CAST(s_nationkey AS BIGINT) AS company_id,
  'cat' || CAST(s_suppkey % 5 AS VARCHAR) AS report_category,
  CASE WHEN s_suppkey % 6 = 0 THEN s_suppkey + 1000000 ELSE s_suppkey END AS report_id,
  s_name || ' v2' AS report_name, 'nation ' || CAST(s_nationkey AS VARCHAR) AS report_description,
  TIMESTAMP '{SYNCED_AT}' AS report_modified_on, '{PARAMS_JSON}' AS parameters,
  '{FIELDS_JSON}' AS fields, TIMESTAMP '{SYNCED_AT}' AS discovered_at
  FROM supplier)
"""


# Plan subset used by P10 (plan tables ending in 1, a report, a table).
SUBSET_NAMES = [f"tbl_{i}1" for i in range(10)] + ["report/Supplier#000000003", "tbl_7"]


# ------------------------------------------------------------ names from part
NAME_EXPRS = {
    "n_camel": "split_part(p_name, ' ', 1) || upper(substr(split_part(p_name, ' ', 2), 1, 1)) "
               "|| substr(split_part(p_name, ' ', 2), 2)",
    "n_pascal": "upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) "
                "|| upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) "
                "|| 'ID' || CAST(p_size AS STRING)",
    "n_acronym": "'HTTP' || upper(substr(split_part(p_name, ' ', 1), 1, 1)) "
                 "|| substr(split_part(p_name, ' ', 1), 2) || 'V' || CAST(p_size % 3 AS STRING) || 'Name'",
    "n_upper": "upper(split_part(p_name, ' ', 1)) || '_' || split_part(p_name, ' ', 2)",
    "s_long": "lower(p_type) || '_' || replace(p_name, ' ', '_') || '__' || lower(p_brand)",
    "e_slash": "'/' || p_type || '//' || replace(p_name, ' ', '-') || '/' || p_brand",
    "e_dash": "'-' || lower(p_type) || '--' || CAST(p_size AS STRING) || '/'",
    "header": "CASE p_partkey % 4 WHEN 0 THEN '﻿' || split_part(p_name, ' ', 1) || ' ID' "
              "WHEN 1 THEN '  ' || p_type || ' Date ' "
              "WHEN 2 THEN CAST(p_size AS STRING) || 'nd ' || split_part(p_name, ' ', 2) "
              "ELSE 'Año ' || split_part(p_name, ' ', 2) END",
}


def part_names(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", *[F.expr(e).alias(n) for n, e in NAME_EXPRS.items()])


SQL_NAMES = "names AS (SELECT p_partkey, " + ", ".join(
    f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in NAME_EXPRS.items()) + " FROM part)"


# ------------------------------------------------------------ log text
LOG_MSG = ("'POST https://api.example.com/' || lang || '/' || CAST(doc_id AS STRING) "
           "|| ': 400 Bad request; reason: invalid, location: query' || chr(10) || text || chr(10) "
           "|| 'Job ID: job_' || CAST(doc_id AS STRING) "
           "|| CASE doc_id % 3 WHEN 0 THEN chr(10) || chr(10) || 'Location: US' "
           "WHEN 1 THEN ' Location: EU' ELSE '' END")


# ------------------------------------------------------------ objects from events
OBJ_EXPR = ("'{\"eventId\": ' || CAST(event_id AS STRING) "
            "|| ', \"userId\": ' || CASE WHEN event_id % 10 = 0 THEN '\"' || CAST(user_id AS STRING) || '\"' "
            "ELSE CAST(user_id AS STRING) END "
            "|| ', \"eventType\": \"' || event_type || '\"' "
            "|| ', \"value\": ' || CASE WHEN event_id % 7 = 0 THEN '\"N/A\"' "
            "WHEN event_id % 11 = 0 THEN '\"' || CAST(value AS STRING) || '\"' ELSE CAST(value AS STRING) END "
            "|| ', \"props\": ' || props "
            "|| CASE WHEN event_id % 5 = 0 THEN ', \"tags\": [\"a\", \"b\"]' "
            "WHEN event_id % 5 = 1 THEN ', \"tags\": null' ELSE '' END "
            "|| ', \"isActive\": ' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE '\"yes\"' END || '}'")


# ------------------------------------------------------------ objects from orders
ORDER_OBJ_EXPR = ("'{\"id\": ' || CAST(o_orderkey AS STRING) "
                  "|| ', \"custKey\": ' || CAST(o_custkey AS STRING) "
                  "|| ', \"orderStatus\": \"' || o_orderstatus || '\"' "
                  "|| ', \"totalPrice\": ' || CASE WHEN o_orderkey % 20 = 0 THEN '\"N/A\"' "
                  "ELSE CAST(o_totalprice AS STRING) END "
                  "|| ', \"orderDate\": \"' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '\"' "
                  "|| ', \"OrderPriority\": \"' || o_orderpriority || '\"' "
                  "|| CASE WHEN o_orderkey % 3 = 0 THEN ', \"order_priority\": null' ELSE '' END "
                  "|| CASE o_orderkey % 4 WHEN 0 THEN ', \"lineItems\": null' "
                  "WHEN 1 THEN ', \"lineItems\": [{\"n\": 1}, [], [1, 2]]' "
                  "WHEN 3 THEN ', \"lineItems\": {}' ELSE '' END || '}'")


# ------------------------------------------------------------ column catalog
CATALOG_COL_EXPR = ("CASE p_partkey % 3 WHEN 0 THEN split_part(p_name, ' ', 1) || '_' || split_part(p_name, ' ', 2) "
                    "WHEN 1 THEN split_part(p_name, ' ', 1) || upper(substr(split_part(p_name, ' ', 2), 1, 1)) "
                    "|| substr(split_part(p_name, ' ', 2), 2) ELSE split_part(p_name, ' ', 1) END")
CATALOG_TABLE_EXPR = "'tbl_' || CAST(p_partkey % 50 AS STRING)"


# ------------------------------------------------------------ report parameters
REPORT_PARAMS_EXPR = (
    "CASE WHEN s_suppkey % 10 = 0 THEN 'not json' ELSE "
    "'[{\"name\": \"From\", \"dataType\": \"Date\"}, {\"name\": \"' || "
    "CASE s_suppkey % 4 WHEN 0 THEN 'StartDate' WHEN 1 THEN 'Customer' WHEN 2 THEN 'Date' ELSE 'Region' END "
    "|| '\", \"dataType\": \"' || CASE WHEN s_suppkey % 3 = 0 THEN 'DateTime' ELSE 'String' END "
    "|| '\"}, {\"name\": \"To\", \"dataType\": \"DateOnly\"}]' END")


# ------------------------------------------------------------ schema catalogs
# staging / final column catalogs of 50 tables derived from part: a column
# per part row, typed by its size; staging retypes every 7th and adds the
# rows with p_size > 45, final has an audit column per table.
CAT_COL = "lower(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey % 11 AS STRING)"
CAT_TYPE = "CASE WHEN p_size % 3 = 0 THEN 'bigint' WHEN p_size % 3 = 1 THEN 'string' ELSE 'double' END"
STAGING_TYPE = f"CASE WHEN p_partkey % 7 = 0 THEN 'string' ELSE {CAT_TYPE} END"
