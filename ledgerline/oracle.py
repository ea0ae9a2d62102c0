"""DuckDB text equal in meaning to each registered query (driver oracle)."""

from __future__ import annotations

from ledgerline import fixtures as fx

S = fx.SYNCED_AT
ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


_MERGE_COLS = """
  COALESCE(t.id, s.id) AS id,
  CASE WHEN s.id IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.id IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.id IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN s.id IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
  CASE WHEN s.id IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
"""

sql("merge_soft_delete", f"""
WITH {fx.SQL_FA}
SELECT {_MERGE_COLS},
  TIMESTAMP '{S}' AS _etl_synced,
  CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
       WHEN s.id IS NOT NULL THEN 'INSERT' ELSE 'DELETE' END AS _etl_operation
FROM fa_t t FULL OUTER JOIN fa_s s ON t.id = s.id
""")

sql("merge_no_delete", f"""
WITH {fx.SQL_FA}
SELECT {_MERGE_COLS},
  CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '{S}' ELSE t._etl_synced END AS _etl_synced,
  CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
       WHEN s.id IS NOT NULL THEN 'INSERT' ELSE t._etl_operation END AS _etl_operation
FROM fa_t t FULL OUTER JOIN fa_s s ON t.id = s.id
""")

sql("merge_counts", f"""
WITH {fx.SQL_FA}
SELECT CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
            WHEN s.id IS NOT NULL THEN 'INSERT' ELSE 'DELETE' END AS _etl_operation,
       COUNT(*) AS n_rows
FROM fa_t t FULL OUTER JOIN fa_s s ON t.id = s.id
GROUP BY 1
""")

sql("merge_tenant_scoped", f"""
WITH {fx.SQL_FA}, {fx.SQL_FF}
SELECT {_MERGE_COLS},
  COALESCE(t.company_id, s.company_id) AS company_id,
  CASE WHEN s.id IS NOT NULL OR t.company_id IN (SELECT company_id FROM ff_s)
       THEN TIMESTAMP '{S}' ELSE t._etl_synced END AS _etl_synced,
  CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
       WHEN s.id IS NOT NULL THEN 'INSERT'
       WHEN t.company_id IN (SELECT company_id FROM ff_s) THEN 'DELETE'
       ELSE t._etl_operation END AS _etl_operation
FROM ff_t t FULL OUTER JOIN ff_s s ON t.company_id = s.company_id AND t.id = s.id
""")

sql("merge_resurrect", f"""
WITH {fx.SQL_FA},
m1 AS (SELECT COALESCE(t.id, s.id) AS id FROM fa_t t FULL OUTER JOIN fa_s s ON t.id = s.id)
SELECT CASE WHEN m1.id IS NOT NULL THEN 'UPDATE' ELSE 'INSERT' END AS _etl_operation,
       COUNT(*) AS n_rows
FROM fa_base b LEFT JOIN m1 ON b.id = m1.id
GROUP BY 1
""")


sql("overwrite", f"""
WITH {fx.SQL_FA}
SELECT *, TIMESTAMP '{S}' AS _etl_synced, 'OVERWRITE' AS _etl_operation FROM fa_s
""")

sql("first_load", f"""
WITH {fx.SQL_FA}
SELECT id, CAST(NULL AS VARCHAR) AS o_clerk, o_custkey, o_orderdate, o_orderpriority, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       TIMESTAMP '{S}' AS _etl_synced, 'INSERT' AS _etl_operation
FROM fa_s
""")

sql("replace_all", f"""
SELECT p_partkey, p_name, p_brand, round(p_retailprice * 1.1, 2) AS p_retailprice,
       CAST(NULL AS VARCHAR) AS p_note, p_size,
       TIMESTAMP '{S}' AS _etl_synced, 'INSERT' AS _etl_operation
FROM part
""")

sql("replace_dates", f"""
WITH {fx.SQL_FB}
SELECT * FROM fb_t
WHERE _report_date IS NULL
   OR _report_date NOT IN (SELECT DISTINCT _report_date FROM fb_s WHERE _report_date IS NOT NULL)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, _report_date,
       TIMESTAMP '{S}' AS _etl_synced, 'INSERT' AS _etl_operation
FROM fb_s
""")

sql("semi_delete", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")

sql("merge_dup_guard", """
SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
""")

sql("safe_cast_align", f"""
WITH {fx.SQL_FA},
fd_s AS (SELECT id, o_custkey, o_orderstatus,
           CASE WHEN id % 50 = 0 THEN 'N/A' WHEN id % 51 = 0 THEN '3.0'
                ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
           o_orderdate, o_orderpriority, 'Clerk#' || CAST(o_custkey AS VARCHAR) AS o_clerk
         FROM fa_base),
fd_t AS (SELECT *, 'c' || CAST(id AS VARCHAR) AS o_comment FROM fa_base WHERE id % 13 <> 0)
SELECT s.id, s.o_custkey, s.o_orderstatus, TRY_CAST(s.o_totalprice AS DOUBLE) AS o_totalprice,
       s.o_orderdate, s.o_orderpriority, t.o_comment, s.o_clerk,
       TIMESTAMP '{S}' AS _etl_synced,
       CASE WHEN t.id IS NOT NULL THEN 'UPDATE' ELSE 'INSERT' END AS _etl_operation
FROM fd_s s LEFT JOIN fd_t t ON t.id = s.id
""")

sql("surrogate_key", """
SELECT o_orderkey,
       md5(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), ''),
                     coalesce(CAST(o_orderdate AS VARCHAR), ''),
                     coalesce(CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END, ''))) AS id
FROM orders
""")

sql("coerce_types", """
WITH r AS (
  SELECT event_id,
         CASE event_id % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN '3.0' WHEN 2 THEN 'yes' WHEN 3 THEN 'No'
              WHEN 4 THEN '-2.7' WHEN 5 THEN '0' ELSE json_extract_string(props, '$.k') END AS raw
  FROM events)
SELECT event_id, raw,
       CASE WHEN isfinite(TRY_CAST(raw AS DOUBLE))
            THEN CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS BIGINT) END AS as_int,
       TRY_CAST(raw AS DOUBLE) AS as_float,
       CASE WHEN lower(raw) IN ('true', '1', 'yes') THEN true
            WHEN lower(raw) IN ('false', '0', 'no') THEN false END AS as_bool
FROM r
""")

sql("write_mode_plan", """
WITH plan AS (
  SELECT p_partkey, 'tbl_' || CAST(p_partkey AS VARCHAR) AS table_name,
         CASE WHEN p_partkey % 4 = 0 THEN false WHEN p_partkey % 7 = 0 THEN NULL ELSE true END AS use_merge,
         CASE WHEN p_partkey % 5 = 0 THEN false WHEN p_partkey % 11 = 0 THEN NULL ELSE true END AS is_production,
         p_partkey % 3 <> 0 AS staging_has_id, p_size % 2 = 0 AS staging_has_date,
         p_size % 3 = 0 AS target_has_date
  FROM part),
facts AS (SELECT o_custkey, count(*) AS target_rows FROM orders GROUP BY 1)
SELECT table_name, coalesce(target_rows, 0) AS target_rows,
  CASE WHEN NOT coalesce(is_production, false) THEN 'overwrite'
       WHEN NOT coalesce(use_merge, true) THEN 'overwrite'
       WHEN coalesce(target_rows, 0) = 0 THEN 'first_load'
       WHEN NOT staging_has_id AND staging_has_date AND target_has_date THEN 'replace_dates'
       WHEN NOT staging_has_id THEN 'replace_all'
       ELSE 'merge' END AS write_mode
FROM plan LEFT JOIN facts ON p_partkey = o_custkey
""")

_DISC = ["report_name", "report_description", "report_modified_on", "parameters", "fields",
         "discovered_at"]
sql("catalog_merge", f"""
WITH {fx.SQL_CATALOG}
SELECT coalesce(t.company_id, s.company_id) AS company_id,
       coalesce(t.report_category, s.report_category) AS report_category,
       coalesce(t.report_id, s.report_id) AS report_id,
       {", ".join(f"CASE WHEN s.report_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _DISC)},
       CASE WHEN t.report_id IS NULL THEN false ELSE t.is_active END AS is_active,
       CASE WHEN t.report_id IS NULL THEN NULL ELSE t.table_name END AS table_name,
       CASE WHEN t.report_id IS NULL THEN NULL ELSE t.history_from END AS history_from
FROM catalog t FULL OUTER JOIN discovered s
  ON t.company_id = s.company_id AND t.report_category = s.report_category
 AND t.report_id = s.report_id
""")

sql("registry_upsert", f"""
WITH {fx.SQL_REGISTRY},
changes AS (
  SELECT lower(p_type) AS ep_module, 'v3' AS ep_version, CAST(NULL AS VARCHAR) AS ep_submodule,
         replace(p_name, ' ', '-') || '-v3' AS ep_name, 'normal' AS ep_endpoint_type,
         CASE WHEN p_partkey % 3 = 0 THEN 'tbl_' || CAST(p_partkey AS VARCHAR)
              ELSE 'tbl_new_' || CAST(p_partkey AS VARCHAR) END AS table_name,
         p_size > 25 AS active
  FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 10 = 0)
SELECT {", ".join(f"CASE WHEN s.table_name IS NOT NULL THEN s.ep_{f} ELSE t.ep_{f} END AS ep_{f}"
                  for f in ["module", "version", "submodule", "name", "endpoint_type"])},
       coalesce(t.table_name, s.table_name) AS table_name,
       CASE WHEN s.table_name IS NOT NULL THEN s.active ELSE t.active END AS active,
       t.silver_use_bronze, t.use_merge, t.is_production
FROM registry t FULL OUTER JOIN changes s ON t.table_name = s.table_name
""")

_COND = "report_name LIKE '%1%' AND is_active = false"
sql("conditional_update", f"""
WITH {fx.SQL_CATALOG}
SELECT company_id, report_category, report_id, report_name, report_description,
       report_modified_on, parameters, fields,
       CASE WHEN {_COND} THEN true ELSE is_active END AS is_active,
       CASE WHEN {_COND} THEN 'rep_' || CAST(report_id AS VARCHAR) ELSE table_name END AS table_name,
       CASE WHEN {_COND} THEN DATE '2025-01-01' ELSE history_from END AS history_from,
       discovered_at
FROM catalog
""")

sql("registry_flags", f"""
WITH {fx.SQL_REGISTRY}
SELECT ep_module, ep_version, ep_submodule, ep_name, ep_endpoint_type, table_name, active,
       CASE WHEN table_name LIKE '%7' THEN true ELSE silver_use_bronze END AS silver_use_bronze,
       use_merge, is_production
FROM registry
""")

sql("struct_rename", f"""
WITH {fx.SQL_REGISTRY}
SELECT table_name, ep_submodule AS ep_prefix, ep_name FROM registry
""")

_LOAD_PLAN = f"""
WITH {fx.SQL_REGISTRY}, {fx.SQL_CATALOG},
plan AS (
  SELECT DISTINCT ep_name AS endpoint_name, table_name, coalesce(use_merge, true) AS use_merge,
         coalesce(is_production, false) AS is_production
  FROM registry WHERE ep_name IS NOT NULL AND table_name IS NOT NULL AND active = true
   AND silver_use_bronze = true
  UNION ALL
  SELECT DISTINCT 'report/' || report_name, table_name, true, true FROM catalog WHERE is_active = true)
"""
sql("load_plan", _LOAD_PLAN + "SELECT * FROM plan")
_names = ", ".join(f"'{n}'" for n in fx.SUBSET_NAMES)
sql("endpoint_subset", _LOAD_PLAN +
    f"SELECT * FROM plan WHERE endpoint_name IN ({_names}) OR table_name IN ({_names})")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^/+|/+$', '', 'g')"


sql("request_path", f"""
WITH p AS (
  SELECT page_id, url,
         '/' || regexp_extract(url, '^https?://[^/]+/([^/]+)/', 1) || '/' AS module,
         'v2/' AS version,
         CASE page_id % 3 WHEN 0 THEN '/jobs/' WHEN 1 THEN '' END AS submodule,
         regexp_extract(url, '^https?://[^/]+/[^/]+/(.*)$', 1) AS name,
         regexp_extract(url, '^(https?://[^/]+)', 1) || '/' AS base
  FROM pages),
q AS (
  SELECT page_id, base,
         concat_ws('/', {_strip('module')}, {_strip('version')}, 'tenant') AS api_url_base,
         CASE WHEN coalesce({_strip('submodule')}, '') <> ''
              THEN concat_ws('/', {_strip('submodule')}, {_strip('name')})
              ELSE {_strip('name')} END AS api_data
  FROM p),
r AS (
  SELECT *, CASE page_id % 4 WHEN 0 THEN 'export/' || api_data
                 WHEN 1 THEN api_data || '/gross-pay-items' ELSE api_data END AS mode_arg
  FROM q)
SELECT page_id, api_url_base, api_data,
       regexp_replace(regexp_replace(concat_ws('/', regexp_replace(base, '/+$', '', 'g'),
           {_strip('api_url_base')}, {_strip('CAST(page_id AS VARCHAR)')}, {_strip('api_data')}),
           '/+', '/', 'g'), '(https?):/', '\\1://', 'g') AS request_url,
       CASE WHEN starts_with(mode_arg, 'export/') THEN 'export'
            WHEN contains(mode_arg, 'gross-pay-items') THEN 'streaming' ELSE 'normal' END AS mode
FROM r
""")

sql("active_companies", f"""
WITH {fx.SQL_COMPANIES}
SELECT company_id, company_name, company_project_id FROM companies
WHERE company_load_status = true AND company_project_id IS NOT NULL
""")

sql("lookup_table_name", """
WITH e AS (SELECT p_partkey, p_type || '/' || replace(p_name, ' ', '-') AS endpoint FROM part),
reg AS (
  SELECT lower(CASE WHEN p_partkey % 2 = 0 THEN upper(endpoint) ELSE endpoint END) AS ep_lower,
         min('tbl_' || CAST(p_partkey AS VARCHAR)) AS registry_table
  FROM e WHERE p_partkey % 4 <> 0 AND p_partkey % 3 <> 0 GROUP BY 1)
SELECT e.p_partkey, e.endpoint,
       coalesce(reg.registry_table,
                trim(regexp_replace(regexp_replace(e.endpoint, '[/-]', '_', 'g'), '_+', '_', 'g'), '_'))
         AS table_name
FROM e LEFT JOIN reg ON lower(e.endpoint) = reg.ep_lower
""")

_RECENT = "ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"
sql("company_weights", f"""
SELECT user_id AS company_id, round(sum(value), 2) AS total_duration FROM events
WHERE {_RECENT} GROUP BY 1
""")

_TOTAL = f"(SELECT coalesce(nullif(sum(value), 0), 2400.0) AS tw FROM events WHERE {_RECENT})"
sql("total_weight", f"SELECT round(tw, 2) AS total_weight FROM {_TOTAL} t")

sql("task_counts", f"""
SELECT round(tw, 2) AS total_weight,
       CAST(least(greatest(ceil(tw / 600), 3), 20) AS BIGINT) AS pull_tasks,
       CAST(least(greatest(ceil(tw / 600), 4), 25) AS BIGINT) AS load_tasks
FROM {_TOTAL} t
""")

sql("company_weight_lookup", f"""
WITH w AS (SELECT user_id AS company_id, sum(value) AS total_duration FROM events
           WHERE {_RECENT} GROUP BY 1)
SELECT c_custkey AS company_id,
       round(coalesce(w.total_duration, (SELECT avg(total_duration) FROM w), 60.0), 2) AS weight
FROM customer LEFT JOIN w ON c_custkey = w.company_id
""")

sql("monitor_upsert", f"""
WITH {fx.SQL_FC}
SELECT coalesce(t.company_id, s.company_id) AS company_id,
       coalesce(t.endpoint_name, s.endpoint_name) AS endpoint_name,
       CASE WHEN s.company_id IS NOT NULL THEN s.max_sync ELSE t.max_sync END AS max_sync,
       CASE WHEN s.company_id IS NOT NULL THEN s.rows_processed ELSE t.actual_rows END AS actual_rows,
       CASE WHEN s.company_id IS NOT NULL THEN round(s.duration_sec, 2) ELSE t.actual_duration END
         AS actual_duration,
       'SUCCESS' AS actual_status,
       CASE WHEN s.company_id IS NOT NULL AND t.company_id IS NOT NULL THEN t.actual_rows END AS last_rows,
       CASE WHEN s.company_id IS NOT NULL AND t.company_id IS NOT NULL THEN t.actual_duration END
         AS last_duration,
       CASE WHEN s.company_id IS NOT NULL AND t.company_id IS NOT NULL THEN 'SUCCESS' END AS last_status,
       CASE WHEN s.company_id IS NOT NULL THEN (SELECT max(ts) FROM events) ELSE t.max_sync END
         AS updated_at
FROM fc_t t FULL OUTER JOIN fc_s s
  ON t.company_id = s.company_id AND t.endpoint_name = s.endpoint_name
""")

sql("max_synced", f"""
WITH {fx.SQL_FA},
a AS (SELECT DISTINCT o_orderstatus, TIMESTAMP '{S}' AS max_sync FROM fa_base
      WHERE id % 13 <> 0 OR id % 10 <> 0),
b AS (SELECT o_orderstatus, count(*) AS rows_processed FROM fa_s GROUP BY 1)
SELECT coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, a.max_sync, b.rows_processed
FROM a FULL OUTER JOIN b ON a.o_orderstatus = b.o_orderstatus
""")

sql("catalog_summary", f"""
WITH {fx.SQL_CATALOG}
SELECT n_name AS company_name, report_category, count(*) AS total_reports,
       count(*) FILTER (WHERE is_active) AS active_reports
FROM catalog JOIN nation ON catalog.company_id = nation.n_nationkey
GROUP BY 1, 2
""")

sql("catalog_join", f"""
WITH {fx.SQL_CATALOG}
SELECT n_name AS company_name, report_category, report_id, report_name, is_active, table_name
FROM catalog JOIN nation ON catalog.company_id = nation.n_nationkey
""")


# ------------------------------------------------------------ names
def _snake(x: str) -> str:
    return (f"lower(regexp_replace(regexp_replace({x}, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), "
            f"'([a-z0-9])([A-Z])', '\\1_\\2', 'g'))")


def _camel(x: str) -> str:
    return (f"(string_split({x}, '_')[1] || array_to_string(list_transform(string_split({x}, '_')[2:], "
            f"lambda p: upper(p[1:1]) || lower(p[2:])), ''))")


def _nclass(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^[a-z][a-z0-9_]*$') THEN 'snake_case' "
            f"WHEN regexp_matches({x}, '^[a-z][a-zA-Z0-9]*$') THEN 'camelCase' ELSE 'other' END")


def _guess(x: str) -> str:
    inner = x
    for a, b in [("_id", "Id"), ("_on", "On"), ("_name", "Name"), ("_code", "Code"), ("_type", "Type"),
                 ("_number", "Number"), ("_date", "Date"), ("_total", "Total"), ("_tax", "Tax")]:
        inner = f"replace({inner}, '{a}', '{b}')"
    inner = f"replace({inner}, '_', '')"
    return f"CASE WHEN regexp_matches({x}, '^[a-z][a-z0-9_]*$') THEN {inner} END"


def _tnorm(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '[/-]', '_', 'g'), '_+', '_', 'g'), '_')"


_NC = ["n_camel", "n_pascal", "n_acronym", "n_upper"]
sql("snake_case", f"WITH {fx.SQL_NAMES} SELECT p_partkey, {', '.join(_NC)}, " +
    ", ".join(f"{_snake(c)} AS snake_{c[2:]}" for c in _NC) + " FROM names")

sql("camel_case", f"""WITH {fx.SQL_NAMES}
SELECT p_partkey, {_camel(_snake('n_pascal'))} AS camel_a, {_camel('s_long')} AS camel_b FROM names""")

sql("naming_class", f"""WITH {fx.SQL_NAMES}, n2 AS (SELECT *, {_snake('n_pascal')} AS snake_pascal FROM names)
SELECT p_partkey, {_nclass('n_camel')} AS class_camel, {_nclass('n_pascal')} AS class_pascal,
       {_nclass('snake_pascal')} AS class_pascal_snake, {_nclass('n_upper')} AS class_upper,
       {_guess('snake_pascal')} AS guess_snake, {_guess('n_camel')} AS guess_camel
FROM n2""")

sql("table_name_norm", f"""WITH {fx.SQL_NAMES}
SELECT p_partkey, {_tnorm('e_slash')} AS t_slash, {_tnorm('e_dash')} AS t_dash FROM names""")

sql("header_clean", f"""WITH {fx.SQL_NAMES},
h AS (SELECT p_partkey, header,
        regexp_replace(lower(regexp_replace(regexp_replace(header, '^\\s+|\\s+$', '', 'g'),
          '^﻿+|﻿+$', '', 'g')), '[^a-z0-9_]', '_', 'g') AS c FROM names)
SELECT p_partkey, header, CASE WHEN regexp_matches(c, '^[0-9]') THEN 'c_' || c ELSE c END AS clean FROM h""")

_LB = "'\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]'"
sql("log_clean", f"""
WITH m AS (SELECT doc_id, {fx.LOG_MSG.replace('AS STRING', 'AS VARCHAR')} AS msg FROM documents),
a AS (SELECT doc_id, regexp_replace(msg, '(?:GET|POST|PUT|DELETE)\\s+https?://[^\\s]+:\\s*', '', 'g') AS t FROM m),
b AS (SELECT doc_id,
        CASE WHEN contains(t, chr(10) || chr(10) || 'Location:') THEN split_part(t, chr(10) || chr(10) || 'Location:', 1)
             WHEN contains(t, chr(10) || 'Location:') THEN split_part(t, chr(10) || 'Location:', 1)
             WHEN contains(t, 'Location:') THEN split_part(t, 'Location:', 1)
             ELSE t END AS t FROM a),
c AS (SELECT doc_id, string_split_regex(t, {_LB}) AS lines FROM b)
SELECT doc_id, regexp_replace(array_to_string(
  list_filter(
    list_transform(
      list_filter(lines, lambda l: NOT starts_with(regexp_replace(l, '^\\s+', ''), 'Job ID:')
                               AND NOT starts_with(regexp_replace(l, '^\\s+', ''), 'Location:')),
      lambda l: regexp_replace(regexp_replace(l, ',\\s*location:\\s*\\w+', '', 'g'), ';\\s*reason:\\s*\\w+', '', 'g')),
    lambda l: regexp_replace(l, '\\s+', '', 'g') <> ''),
  chr(10)), '\\s+$', '') AS cleaned
FROM c
""")

sql("json_props", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN replace(props, '"k"', 'k') ELSE props END AS raw
           FROM events)
SELECT event_id, CASE WHEN json_valid(raw) THEN CAST(json_extract(raw, '$.k') AS BIGINT) END AS k,
       NOT json_valid(raw) AS is_bad
FROM r
""")

sql("mixed_type_probe", f"""
WITH o AS (SELECT {fx.OBJ_EXPR.replace('AS STRING', 'AS VARCHAR')} AS j FROM events),
kv AS (SELECT unnest(json_keys(j)) AS k, j FROM o),
t AS (SELECT k, json_type(j, '$."' || k || '"') AS ty, json_extract_string(j, '$."' || k || '"') AS s FROM kv),
f AS (SELECT {_snake('k')} AS column_name,
        bool_or(ty IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')
                OR (ty = 'VARCHAR' AND TRY_CAST(s AS DOUBLE) IS NOT NULL)) AS saw_number,
        bool_or(ty = 'VARCHAR' AND trim(s) <> '' AND TRY_CAST(s AS DOUBLE) IS NULL) AS saw_text,
        bool_or(ty = 'ARRAY') AS saw_list
      FROM t GROUP BY 1)
SELECT *, saw_number AND saw_text AS is_mixed FROM f
""")

sql("rename_fill_stringify", """
SELECT o_orderkey AS id, o_custkey AS cust_key, o_orderstatus AS order_status,
       CASE WHEN o_orderkey % 20 = 0 THEN 'N/A' ELSE CAST(o_totalprice AS VARCHAR) END AS total_price,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS order_priority,
       CAST(CASE WHEN o_orderkey % 4 = 1 THEN 2 ELSE 0 END AS BIGINT) AS line_items_n
FROM orders
""")

sql("nested_fix", """
SELECT conv_id, turn // 4 AS page_no,
       CAST(CASE conv_id % 5 WHEN 1 THEN count(*) WHEN 2 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS n_items,
       CAST(CASE WHEN conv_id % 5 = 4 THEN 1 ELSE 0 END AS BIGINT) AS n_text_items
FROM conversations GROUP BY conv_id, turn // 4
""")

sql("explode_items", """
WITH c AS (SELECT *, min(turn) OVER (PARTITION BY conv_id, turn // 4) AS first_turn FROM conversations)
SELECT conv_id, turn FROM c
WHERE (conv_id % 5 = 1 OR (conv_id % 5 = 2 AND turn = first_turn))
  AND regexp_matches(text, '[\\r\\n]')
""")

sql("unwrap_pages", """
SELECT conv_id, turn // 3 AS page_no, turn, role, text FROM conversations
""")

sql("export_cursor", """
SELECT conv_id, count(*) AS n_items,
       CASE WHEN conv_id % 3 = 0 THEN NULL
            ELSE 'tok-' || CAST(conv_id AS VARCHAR) || '-' || CAST(max(turn // 3) + 1 AS VARCHAR) END AS last_token
FROM conversations GROUP BY conv_id
""")

sql("cursor_table", """
SELECT conv_id, count(*) AS n_items, CASE WHEN conv_id % 3 <> 0 THEN 'tok-' || conv_id || '-1' END AS last_token
FROM conversations WHERE turn // 3 = 0 GROUP BY conv_id
""")


sql("snapshot_sink", """
WITH n AS (SELECT count(*) AS n_newest, CAST(sum(o_orderkey) AS BIGINT) AS sum_newest FROM orders WHERE o_orderkey % 10 <> 0),
k AS (SELECT '2025-01-01' AS stamp, count(*) AS n_rows FROM orders UNION ALL
      SELECT '2025-01-02', count(*) FROM orders WHERE o_orderkey % 10 <> 0)
SELECT k.*, n.* FROM k, n
""")


sql("report_zip", f"""
SELECT l_orderkey AS "OrderKey", CAST(l_linenumber AS BIGINT) AS "Line",
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS "Qty",
       DATE '{fx.SYNCED_AT[:10]}' AS _report_date
FROM lineitem
""")

sql("snapshot_latest", """
WITH s AS (SELECT event_id, event_type, CAST(ts AS DATE) AS snapshot_date FROM events),
m AS (SELECT event_type, max(snapshot_date) AS snapshot_date FROM s GROUP BY 1)
SELECT s.* FROM s JOIN m USING (event_type, snapshot_date)
""")


# ------------------------------------------------------------ drift
_CAT = (f"cat AS (SELECT DISTINCT {fx.CATALOG_TABLE_EXPR.replace('AS STRING', 'AS VARCHAR')} AS table_name, "
        f"{fx.CATALOG_COL_EXPR} AS column_name FROM part)")
_PAIRS = f"""{_CAT},
s AS (SELECT table_name, column_name AS snake_case, {_camel('column_name')} AS camel_twin FROM cat
      WHERE regexp_matches(column_name, '^[a-z][a-z0-9_]*$') AND NOT starts_with(column_name, '_etl_')),
pairs AS (SELECT s.table_name, s.snake_case, s.camel_twin AS camel_case FROM s
          JOIN cat c ON s.table_name = c.table_name AND s.camel_twin = c.column_name
          WHERE s.camel_twin <> s.snake_case)"""
sql("drift_pairs", f"WITH {_PAIRS} SELECT * FROM pairs")
sql("drift_summary", f"WITH {_PAIRS} SELECT table_name, count(*) AS n_pairs FROM pairs GROUP BY 1")

_TCAT = _CAT.replace("SELECT DISTINCT ", "SELECT DISTINCT p_partkey % 70 AS company_id, ")
sql("drift_totals", f"""
WITH {_TCAT},
pairs AS (SELECT s.company_id, s.table_name FROM cat s
          JOIN cat c ON s.company_id = c.company_id AND s.table_name = c.table_name
                    AND c.column_name = {_camel('s.column_name')}
          WHERE regexp_matches(s.column_name, '^[a-z][a-z0-9_]*$') AND c.column_name <> s.column_name)
SELECT count(DISTINCT company_id) AS tenants_affected,
       (SELECT count(*) FROM (SELECT DISTINCT company_id, table_name FROM pairs)) AS tables_affected,
       count(*) AS n_pairs, (SELECT count(DISTINCT company_id) FROM cat) AS n_tenants
FROM pairs
""")

sql("drop_duplicate_style", """
SELECT o_orderkey, o_orderstatus AS order_status, o_totalprice AS total_price FROM orders
""")

# ------------------------------------------------------------ quality
_SNAP = "CASE WHEN doc_id % 2 = 0 THEN 'return_1' ELSE 'return_2' END"


def _cnt(sub: str, width: int) -> str:
    return f"CAST(sum((length(text) - length(replace(text, {sub}, ''))) // {width}) AS BIGINT)"


sql("snapshot_compare", f"""
WITH d AS (SELECT {_SNAP} AS snapshot, text FROM documents),
m AS (SELECT snapshot, count(*) AS n_items, CAST(sum(length(text)) AS BIGINT) AS n_chars,
        {_cnt("'\\r\\n'", 4)} AS escaped_crlf, {_cnt("'\\r'", 2)} AS escaped_cr,
        {_cnt("'\\n'", 2)} AS escaped_lf, {_cnt("'\\t'", 2)} AS escaped_tab,
        {_cnt('chr(13)', 1)} AS real_cr, {_cnt('chr(10)', 1)} AS real_lf, {_cnt('chr(9)', 1)} AS real_tab,
        CAST(sum(strlen(text)) AS BIGINT) AS n_bytes,
        count(*) FILTER (WHERE regexp_matches(text, '[\\r\\n]')) AS multiline_items
      FROM d GROUP BY 1),
c AS (SELECT snapshot, count(DISTINCT ch) AS non_ascii_chars
      FROM (SELECT snapshot, unnest(regexp_extract_all(text, '([^\\x00-\\x7F])', 1)) AS ch FROM d) GROUP BY 1)
SELECT m.*, coalesce(c.non_ascii_chars, 0) AS non_ascii_chars FROM m LEFT JOIN c USING (snapshot)
""")

sql("append_load", """
WITH d AS (SELECT o_orderkey AS id, o_custkey AS c, CAST(o_orderkey % 2 AS BIGINT) AS drop FROM orders)
SELECT drop, count(*) FILTER (WHERE id % 100 <> drop) AS n_rows, CAST(sum(c) FILTER (WHERE id % 100 <> drop) AS BIGINT) AS sum_cust,
       nullif(count(*) FILTER (WHERE id % 100 = drop), 0) AS n_bad FROM d GROUP BY drop
""")


sql("ensure_table", """
SELECT l_returnflag AS mode, 'INSERT' AS operation, count(*) AS n_rows,
       sum(CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DOUBLE) END) AS qty, true AS created_once
FROM lineitem GROUP BY 1
""")


sql("absent_known_arrays", """
SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_tags, CAST(0 AS BIGINT) AS n_notes FROM orders
""")


sql("csv_listed_load", """
SELECT CASE l_returnflag WHEN 'N' THEN 'ship_report' WHEN 'R' THEN 'rail_report' ELSE 'air_report' END AS table_name,
       CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS priority, count(*) AS n_rows,
       sum(CAST(l_quantity AS DOUBLE)) AS qty, min(l_orderkey) AS least_key
FROM lineitem WHERE l_returnflag IN ('N', 'R', 'A') GROUP BY l_returnflag
""")


sql("mixed_list_repair", """
WITH n AS (SELECT *, CAST(CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS BIGINT) AS n FROM orders)
SELECT o_orderkey AS id, CAST(3 AS BIGINT) AS n_parts, n AS n_tags, n AS n_deep, o_orderstatus AS code, '["[1,2]",3]' AS plain FROM n
""")


sql("stringify_json", r"""
SELECT o_orderkey AS id, CASE o_orderkey % 5
  WHEN 0 THEN '{"z": 1, "a": [1, {"y": null, "b": "q, r: \"s\""}], "m": 5000.0}'
  WHEN 1 THEN '"' || o_orderstatus || ': \"x\", \n"' WHEN 2 THEN '12.5' WHEN 3 THEN NULL ELSE '[true, {}]' END AS detail
FROM orders
""")


sql("snapshot_keys", f"""
WITH o AS (SELECT o_orderkey AS k, {fx.ORDER_OBJ_EXPR.replace('AS STRING', 'AS VARCHAR')} AS j FROM orders),
f AS (SELECT unnest(list_distinct(json_keys(j))) AS key FROM o),
s AS (SELECT unnest(list_distinct(json_keys(replace(replace(j, '"custKey"', '"customerKey"'), ', "order_priority": null', '')))) AS key FROM o
      UNION ALL SELECT 'note' FROM o WHERE k % 9 = 0),
n AS (SELECT key, count(*) FILTER (WHERE snap = 1) AS n_first, count(*) FILTER (WHERE snap = 2) AS n_second
      FROM (SELECT key, 1 AS snap FROM f UNION ALL SELECT key, 2 FROM s) GROUP BY key)
SELECT *, CASE WHEN n_second = 0 THEN 'first' WHEN n_first = 0 THEN 'second' ELSE 'both' END AS found_in FROM n
""")


sql("open_keys", """
SELECT o_orderkey AS id, CAST(2 AS BIGINT) AS n_other, CAST(o_totalprice AS DOUBLE) AS total FROM orders
""")


sql("nested_known_arrays", """
SELECT o_orderkey AS id, CAST(CASE o_orderkey % 5 WHEN 1 THEN 1 WHEN 3 THEN 3 ELSE 0 END AS BIGINT) AS n_detail, o_orderstatus AS code,
       CAST(CASE o_orderkey % 5 WHEN 1 THEN 1 WHEN 3 THEN 3 ELSE 0 END AS BIGINT) AS n_first, CAST(2 AS BIGINT) AS second_no FROM orders
""")


sql("infer_schema", f"""
WITH o AS (SELECT {fx.ORDER_OBJ_EXPR.replace('AS STRING', 'AS VARCHAR')} AS j FROM orders),
kv AS (SELECT unnest(json_keys(j)) AS k, j FROM o),
t AS (SELECT k, json_type(j, '$."' || k || '"') AS ty, json_extract_string(j, '$."' || k || '"') AS s FROM kv),
c AS (SELECT k, s, CASE WHEN ty IN ('BIGINT', 'UBIGINT') THEN 'BIGINT' WHEN ty = 'VARCHAR' THEN 'STRING' WHEN ty = 'NULL' THEN NULL ELSE ty END AS ty
      FROM t)
SELECT {_snake('k')} AS column_name, k AS source_key,
       bool_or(ty IN ('BIGINT', 'DOUBLE', 'BOOLEAN') OR (ty = 'STRING' AND TRY_CAST(s AS DOUBLE) IS NOT NULL)) IS TRUE AS saw_number,
       bool_or(ty = 'STRING' AND trim(s) <> '' AND TRY_CAST(s AS DOUBLE) IS NULL) IS TRUE AS saw_text, bool_or(ty = 'ARRAY') IS TRUE AS saw_list,
       CASE count(DISTINCT ty) WHEN 0 THEN 'VOID' WHEN 1 THEN max(ty) ELSE 'VARIANT' END AS variant_type, count(*) AS n_present
FROM c GROUP BY k
""")


sql("file_report", """
WITH r AS (SELECT coalesce(event_type, 'none') AS kind, event_id,
                  CASE WHEN event_id % 100 = 0 THEN replace(props, '"k"', 'k') ELSE props END AS raw,
                  CASE WHEN event_id % 30 = 0 THEN 2 ELSE 1 END AS n FROM events),
l AS (SELECT *, sum(n) OVER (PARTITION BY kind ORDER BY event_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS line FROM r)
SELECT kind, count(*) AS n_records, count(*) FILTER (WHERE NOT json_valid(raw)) AS n_bad, 'ndjson' AS layout_seen,
       CASE WHEN bool_or(NOT json_valid(raw)) THEN 'malformed' ELSE 'ok' END AS status,
       CAST(min(line) FILTER (WHERE NOT json_valid(raw)) AS BIGINT) AS first_bad_line
FROM l GROUP BY kind
""")


sql("snapshot_difference", f"""
WITH q AS ({ORACLE["snapshot_compare"]}),
u AS (UNPIVOT (SELECT snapshot, CAST(COLUMNS(* EXCLUDE snapshot) AS BIGINT) FROM q)
      ON COLUMNS(* EXCLUDE snapshot) INTO NAME metric VALUE v),
b AS (SELECT metric, CAST(coalesce(sum(v) FILTER (WHERE snapshot = 'return_1'), 0) AS BIGINT) AS first_value,
             CAST(coalesce(sum(v) FILTER (WHERE snapshot = 'return_2'), 0) AS BIGINT) AS second_value
      FROM u GROUP BY 1)
SELECT *, second_value - first_value AS difference,
       CAST(second_value AS DOUBLE) / nullif(first_value, 0) AS ratio FROM b
""")

sql("item_counts", """
WITH n AS (SELECT lang, count(*) AS n_items FROM documents GROUP BY 1)
SELECT *, n_items - coalesce((SELECT n_items FROM n WHERE lang = 'en'), 0) AS difference FROM n
""")

sql("charset_diff", """
WITH s AS (SELECT DISTINCT lang, unnest(regexp_extract_all(text, '([^\\x00-\\x7F])', 1)) AS ch FROM documents)
SELECT lang, ch FROM s WHERE lang <> 'en' AND ch NOT IN (SELECT ch FROM s WHERE lang = 'en')
""")

# ------------------------------------------------------------ scans
sql("json_array_scan", "SELECT * FROM orders")
sql("json_streamed_scan", "SELECT * FROM customer")
sql("csv_scan", """
SELECT CAST(l_suppkey AS INTEGER) AS employee_id, CAST(l_shipdate AS DATE) AS date,
       CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS c_2nd_line,
       CAST(l_quantity AS VARCHAR) AS a_o_qty,
       'line ' || CAST(l_linenumber AS VARCHAR) || chr(10) || 'flag, ' || l_returnflag || ' "q"' AS notes
FROM lineitem
""")

sql("landed_file_resolution", f"""
WITH {fx.SQL_REGISTRY},
r AS (SELECT table_name, CAST(regexp_extract(table_name, '(\\d+)$', 1) AS BIGINT) AS k FROM registry),
l AS (
  SELECT table_name, 1 AS priority, 'export_' || table_name || '.csv' AS file_name FROM r WHERE k % 4 = 0
  UNION ALL SELECT table_name, 2, table_name || '.csv' FROM r WHERE k % 4 = 1 OR k % 8 = 0
  UNION ALL SELECT table_name, 3, upper(substr(replace(table_name, '_', ' '), 1, 1))
                                  || substr(replace(table_name, '_', ' '), 2) || '.csv' FROM r WHERE k % 4 = 2)
SELECT table_name, arg_min(file_name, priority) AS file_name, min(priority) AS priority FROM l GROUP BY 1
""")

# ------------------------------------------------------------ reports
sql("report_windows", f"""
WITH {fx.SQL_CATALOG}
SELECT company_id, report_id, 'rep_' || CAST(report_id AS VARCHAR) AS table_name, history_from,
       report_id % 2 = 0 AS table_exists,
       CASE WHEN report_id % 2 = 0 THEN DATE '{fx.RUN_DATE}' - INTERVAL 1 DAY
            ELSE coalesce(history_from, DATE '2025-01-01') END::DATE AS from_date,
       (DATE '{fx.RUN_DATE}' - INTERVAL 1 DAY)::DATE AS to_date
FROM catalog
""")

sql("param_binding", f"""
WITH r AS (SELECT s_suppkey AS report_id, {fx.REPORT_PARAMS_EXPR} AS params FROM supplier),
l AS (SELECT report_id,
        CASE WHEN json_valid(params)
             THEN from_json(params, '[{{"name": "VARCHAR", "dataType": "VARCHAR"}}]') ELSE [] END AS ps
      FROM r),
u AS (SELECT report_id, i AS param_pos, ps[i + 1].name AS param_name, ps[i + 1].dataType AS dt
      FROM l, unnest(range(len(ps))) t(i)),
v AS (SELECT report_id, CAST(param_pos AS BIGINT) AS param_pos, coalesce(param_name, '') AS param_name,
        CASE WHEN lower(coalesce(param_name, '')) LIKE '%from%' OR lower(coalesce(param_name, '')) LIKE '%start%'
                  OR lower(coalesce(param_name, '')) LIKE '%begin%' THEN '2025-01-01'
             WHEN lower(coalesce(param_name, '')) LIKE '%to%' OR lower(coalesce(param_name, '')) LIKE '%end%'
                  THEN CAST((DATE '{fx.RUN_DATE}' - INTERVAL 1 DAY)::DATE AS VARCHAR)
             WHEN lower(coalesce(param_name, '')) = 'date'
                  THEN CAST((DATE '{fx.RUN_DATE}' - INTERVAL 1 DAY)::DATE AS VARCHAR) END AS param_value,
        dt
      FROM u)
SELECT report_id, param_pos, param_name, param_value FROM v
WHERE dt IN ('Date', 'DateTime', 'DateOnly', 'System.DateTime') AND param_value IS NOT NULL
""")

_TREE = """
SELECT CAST(n_regionkey AS BIGINT) AS company_id,
       CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS report_category,
       s_suppkey AS report_id, s_name AS report_name, 'nation ' || n_name AS report_description,
       '2025-01-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') AS report_modified_on,
       CAST(2 AS BIGINT) AS n_params, CAST(1 AS BIGINT) AS n_fields
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 17 <> 0 AND s_suppkey % 19 <> 0 AND s_suppkey <> 0
"""
sql("tree_walk", _TREE)
sql("tree_walk_filtered", _TREE + " AND (lower(n_name) = 'nation_3')")

# ------------------------------------------------------------ logs
sql("run_summary", """
SELECT CAST(ts AS DATE) AS run_id, count(*) AS total,
       count(*) FILTER (WHERE upper(event_type) <> 'ERROR') AS ok,
       count(*) FILTER (WHERE upper(event_type) = 'ERROR') AS failed
FROM events GROUP BY 1
""")

sql("log_events", """
SELECT ts AS timestamp,
       CASE WHEN user_id IS NOT NULL AND CAST(user_id AS VARCHAR) NOT IN ('0', '') THEN CAST(user_id AS VARCHAR) END
         AS company_id,
       CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS project_id, event_type AS endpoint,
       upper(event_type) AS event_type, 'Load ' || event_type AS event_title,
       'value ' || format('{:,.2f}', value) AS event_message, 'ledgerline_load' AS source,
       CAST(json_object('user', user_id, 'type', event_type) AS VARCHAR) AS info
FROM events
""")

sql("stream_merge", """
SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(value, ts) AS value
FROM events GROUP BY 1, 2
""")


sql("stream_quarantine", """
SELECT event_id, CASE WHEN event_id % 100 = 0 THEN 'trailing' ELSE 'cut' END AS tail FROM events WHERE event_id % 50 = 0
""")


sql("bad_row_preview", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN replace(props, '"k"', 'k') ELSE props END
                  || CASE WHEN event_id % 37 = 0 THEN ' ' || event_type ELSE '' END AS raw FROM events)
SELECT event_id, substr(raw, 1, 200) AS preview FROM r WHERE NOT json_valid(raw)
""")

sql("registry_scan", f"""
WITH {fx.SQL_REGISTRY},
e AS (SELECT table_name, ep_module AS module, ep_version AS version, ep_submodule AS submodule,
             ep_name AS name, coalesce(nullif(ep_endpoint_type, ''), 'normal') AS endpoint_type
      FROM registry WHERE active = true AND silver_use_bronze = true),
p AS (SELECT *, concat_ws('/', {_strip('module')}, {_strip('version')}, 'tenant') AS api_url_base,
             CASE WHEN coalesce({_strip('submodule')}, '') <> ''
                  THEN concat_ws('/', {_strip('submodule')}, {_strip('name')}) ELSE {_strip('name')} END AS api_data
      FROM e)
SELECT *,
       regexp_replace(regexp_replace(concat_ws('/', 'https://api.example.com', {_strip('api_url_base')},
           '{{tenant}}', {_strip('api_data')}), '/+', '/', 'g'), '(https?):/', '\\1://', 'g') AS url_template,
       CASE WHEN starts_with(api_data, 'export/') THEN 'export'
            WHEN contains(api_data, 'gross-pay-items') THEN 'streaming' ELSE 'normal' END AS mode
FROM p
""")

sql("report_catalog_scan", f"""
WITH {fx.SQL_CATALOG}
SELECT company_id, report_category, report_id, report_name, table_name, history_from
FROM catalog WHERE is_active = true
""")

sql("publish_roundtrip", ORACLE["merge_tenant_scoped"])
sql("publish_touched_tenants", ORACLE["merge_tenant_scoped"])

sql("field_to_text", """
SELECT o_orderkey AS id, CAST(o_custkey % 5 AS VARCHAR) AS status, o_orderstatus AS info_status,
       '{"code":"' || o_orderpriority || '"}' AS detail_status,
       CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey % 7 AS VARCHAR) AS items_status
FROM orders
""")

sql("merge_add_key", f"""
WITH {fx.SQL_FA}
SELECT CAST(NULL AS BIGINT) AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       TIMESTAMP '{S}' AS _etl_synced, 'DELETE' AS _etl_operation
FROM fa_base WHERE id % 13 <> 0
UNION ALL
SELECT id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       TIMESTAMP '{S}' AS _etl_synced, 'INSERT' AS _etl_operation
FROM fa_s
""")


sql("tenant_load_cycle", """
WITH t AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders WHERE o_orderkey % 13 <> 0),
s AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders WHERE o_orderkey % 10 <> 0)
SELECT coalesce(t.company_id, s.company_id) AS company_id,
       CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
            WHEN s.id IS NOT NULL THEN 'INSERT' ELSE 'DELETE' END AS _etl_operation,
       count(*) AS n_rows
FROM t FULL OUTER JOIN s ON t.company_id = s.company_id AND t.id = s.id
GROUP BY 1, 2
""")


sql("csv_report_load", """
WITH s AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber FROM lineitem),
t AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber FROM lineitem
      WHERE l_orderkey % 13 <> 0)
SELECT CASE WHEN t.l_orderkey IS NOT NULL THEN 'UPDATE' ELSE 'INSERT' END AS _etl_operation, count(*) AS n_rows
FROM s LEFT JOIN t ON s.l_suppkey = t.l_suppkey AND s.d = t.d AND s.l_orderkey = t.l_orderkey
                  AND s.l_linenumber = t.l_linenumber
GROUP BY 1
""")


sql("endpoint_load_job", """
WITH t AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders
           WHERE o_orderkey % 13 <> 0 AND o_orderkey % 1000 <> 7),
s AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders
      WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 <> 7),
b AS (SELECT o_custkey % 30 AS company_id, count(*) AS bad_records FROM orders
      WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 = 7 GROUP BY 1),
j AS (SELECT coalesce(t.company_id, s.company_id) AS company_id,
             t.id IS NOT NULL AND s.id IS NOT NULL AS upd, t.id IS NULL AS ins, s.id IS NULL AS del,
             s.id IS NOT NULL AS staged
      FROM t FULL OUTER JOIN s ON t.company_id = s.company_id AND t.id = s.id)
SELECT j.company_id, 'merge' AS write_mode, count(*) FILTER (WHERE staged) AS rows_processed,
       count(*) FILTER (WHERE ins) AS n_insert, count(*) FILTER (WHERE upd) AS n_update,
       count(*) FILTER (WHERE del) AS n_delete, CAST(0 AS BIGINT) AS n_overwrite,
       coalesce(max(b.bad_records), 0) AS bad_records
FROM j LEFT JOIN b ON j.company_id = b.company_id
GROUP BY j.company_id
""")


sql("load_monitoring", f"""
WITH r1 AS (SELECT o_custkey % 30 AS company_id, count(*) AS n FROM orders
            WHERE o_orderkey % 13 <> 0 AND o_orderkey % 1000 <> 7 GROUP BY 1),
r2 AS (SELECT o_custkey % 30 AS company_id, count(*) AS n FROM orders
       WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 <> 7 GROUP BY 1)
SELECT coalesce(r2.company_id, r1.company_id) AS company_id, 'orders_bronze' AS endpoint_name,
       CASE WHEN r2.company_id IS NOT NULL THEN TIMESTAMP '{S}' ELSE TIMESTAMP '{fx.T0}' END AS max_sync,
       coalesce(r2.n, r1.n) AS actual_rows, 'SUCCESS' AS actual_status,
       CASE WHEN r2.company_id IS NOT NULL AND r1.company_id IS NOT NULL THEN r1.n END AS last_rows,
       CASE WHEN r2.company_id IS NOT NULL AND r1.company_id IS NOT NULL THEN 'SUCCESS' END AS last_status
FROM r1 FULL OUTER JOIN r2 ON r1.company_id = r2.company_id
""")


sql("load_duplicate_ids", """
WITH t AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders
           WHERE o_orderkey % 13 <> 0 AND o_orderkey % 1000 <> 7),
s AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders
      WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 <> 7),
refused AS (SELECT DISTINCT company_id FROM s WHERE company_id = 4 AND id % 3 = 0),
good AS (SELECT * FROM s WHERE company_id NOT IN (SELECT company_id FROM refused)),
j AS (SELECT coalesce(t.company_id, g.company_id) AS company_id,
             CASE WHEN coalesce(t.company_id, g.company_id) NOT IN (SELECT company_id FROM good) THEN 'INSERT'
                  WHEN t.id IS NULL THEN 'INSERT' WHEN g.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op
      FROM t FULL OUTER JOIN good g ON t.company_id = g.company_id AND t.id = g.id),
e AS (SELECT o_custkey % 30 AS company_id, max(n) AS n FROM orders
      LEFT JOIN (SELECT company_id, count(*) AS n FROM good GROUP BY 1) c ON c.company_id = o_custkey % 30
      WHERE o_orderkey % 10 <> 0 GROUP BY 1)
SELECT j.company_id, count(*) FILTER (WHERE op = 'INSERT') AS live_insert,
       count(*) FILTER (WHERE op = 'UPDATE') AS live_update, count(*) FILTER (WHERE op = 'DELETE') AS live_delete,
       max(CASE WHEN e.company_id IS NOT NULL THEN 'orders_bronze' END) AS endpoint,
       max(CASE WHEN e.company_id IS NULL THEN NULL WHEN e.n IS NULL THEN 'ERROR' ELSE 'SUCCESS' END) AS event_type,
       max(CASE WHEN e.company_id IS NULL THEN NULL WHEN j.company_id IN (SELECT company_id FROM refused)
                THEN 'duplicate keys' WHEN e.n IS NULL THEN 'no valid record'
                ELSE CAST(e.n AS VARCHAR) || ' rows' END) AS event_message,
       max(CASE WHEN e.company_id IS NOT NULL THEN 'ledgerline_load' END) AS source
FROM j LEFT JOIN e ON j.company_id = e.company_id
GROUP BY 1
""")


sql("load_new_column", """
WITH t AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders
           WHERE o_orderkey % 13 <> 0 AND o_orderkey % 1000 <> 7),
s AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id,
             CASE WHEN o_custkey % 30 % 3 = 1 THEN o_orderpriority END AS p FROM orders
      WHERE o_orderkey % 10 <> 0 AND o_orderkey % 1000 <> 7)
SELECT coalesce(t.company_id, s.company_id) AS company_id, count(*) AS n_live, count(p) AS n_priority,
       min(p) AS least_priority
FROM t FULL OUTER JOIN s ON t.company_id = s.company_id AND t.id = s.id
GROUP BY 1
""")


sql("load_bad_records", """
WITH d AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders),
t AS (SELECT * FROM d WHERE id % 13 <> 0),
s AS (SELECT * FROM d WHERE id % 10 <> 0),
tailed AS (SELECT * FROM s WHERE id % 50 = 7),
cut_off AS (SELECT * FROM s WHERE id % 50 = 9 AND company_id % 5 = 2),
withheld AS (SELECT DISTINCT company_id FROM cut_off),
good AS (SELECT * FROM s WHERE id NOT IN (SELECT id FROM tailed) AND id NOT IN (SELECT id FROM cut_off)),
loaded AS (SELECT company_id, count(*) AS n FROM good GROUP BY 1),
j AS (SELECT coalesce(t.company_id, g.company_id) AS company_id, coalesce(t.id, g.id) AS id,
             CASE WHEN t.id IS NULL THEN 'INSERT' WHEN g.id IS NOT NULL THEN 'UPDATE'
                  WHEN t.company_id NOT IN (SELECT company_id FROM loaded) OR t.company_id IN (SELECT company_id FROM withheld)
                       OR t.id IN (SELECT id FROM tailed) THEN 'KEPT' ELSE 'DELETE' END AS op
      FROM t FULL OUTER JOIN good g ON t.company_id = g.company_id AND t.id = g.id)
SELECT j.company_id, count(*) FILTER (WHERE op IN ('INSERT', 'KEPT')) AS live_insert,
       count(*) FILTER (WHERE op = 'UPDATE') AS live_update, count(*) FILTER (WHERE op = 'DELETE') AS live_delete,
       count(*) FILTER (WHERE op = 'KEPT') AS untouched,
       max(CASE WHEN j.company_id NOT IN (SELECT company_id FROM s) THEN NULL WHEN n IS NULL THEN 'no valid record'
                ELSE n || ' rows' || CASE WHEN j.company_id IN (SELECT company_id FROM withheld) THEN ', deletes withheld' ELSE '' END END)
         AS event_message
FROM j LEFT JOIN loaded USING (company_id) GROUP BY 1
""")


sql("load_type_change", """
WITH d AS (SELECT o_orderkey AS id, o_custkey AS c, o_custkey % 30 AS company_id FROM orders),
t AS (SELECT *, CASE WHEN company_id % 2 = 0 THEN CAST(c AS VARCHAR) ELSE 'A' || c END AS zip FROM d WHERE id % 13 <> 0),
s AS (SELECT *, CASE WHEN company_id % 2 = 1 THEN 'C' || c WHEN id % 7 <> 1 THEN CAST(c + 1 AS VARCHAR) END AS zip
      FROM d WHERE id % 10 <> 0 AND company_id % 3 = 0),
j AS (SELECT coalesce(t.company_id, s.company_id) AS company_id,
             CASE WHEN s.id IS NOT NULL THEN s.zip ELSE t.zip END AS zip,
             CASE WHEN t.id IS NULL THEN 'INSERT' WHEN s.id IS NOT NULL THEN 'UPDATE'
                  WHEN t.company_id IN (SELECT company_id FROM s) THEN 'DELETE' ELSE 'INSERT' END AS op
      FROM t FULL OUTER JOIN s ON t.company_id = s.company_id AND t.id = s.id)
SELECT company_id, count(*) FILTER (WHERE op = 'INSERT') AS live_insert, count(*) FILTER (WHERE op = 'UPDATE') AS live_update,
       count(*) FILTER (WHERE op = 'DELETE') AS live_delete, count(zip) AS n_zip, min(zip) AS least_zip, max(zip) AS most_zip
FROM j GROUP BY 1
""")


sql("load_mixed_layouts", """
WITH t AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders WHERE o_orderkey % 13 <> 0),
s AS (SELECT o_orderkey AS id, o_custkey % 30 AS company_id FROM orders WHERE o_orderkey % 10 <> 0),
j AS (SELECT coalesce(t.company_id, s.company_id) AS company_id, t.id AS old, s.id AS new
      FROM t FULL OUTER JOIN s ON t.company_id = s.company_id AND t.id = s.id)
SELECT company_id, 'merge' AS write_mode, count(new) AS rows_processed, count(*) FILTER (WHERE old IS NULL) AS n_insert,
       count(*) FILTER (WHERE old IS NOT NULL AND new IS NOT NULL) AS n_update,
       count(*) FILTER (WHERE new IS NULL) AS n_delete, CAST(0 AS BIGINT) AS n_overwrite, CAST(0 AS BIGINT) AS bad_records
FROM j GROUP BY company_id HAVING count(new) > 0
""")


sql("merge_only_changed", f"""
WITH {fx.SQL_FA}
SELECT {_MERGE_COLS},
  CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL AND t.o_totalprice IS NOT DISTINCT FROM s.o_totalprice
            AND t.o_custkey IS NOT DISTINCT FROM s.o_custkey AND t.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus
            AND t.o_orderdate IS NOT DISTINCT FROM s.o_orderdate
            AND t.o_orderpriority IS NOT DISTINCT FROM s.o_orderpriority
       THEN t._etl_synced ELSE TIMESTAMP '{S}' END AS _etl_synced,
  CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL AND t.o_totalprice IS NOT DISTINCT FROM s.o_totalprice
            AND t.o_custkey IS NOT DISTINCT FROM s.o_custkey AND t.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus
            AND t.o_orderdate IS NOT DISTINCT FROM s.o_orderdate
            AND t.o_orderpriority IS NOT DISTINCT FROM s.o_orderpriority THEN t._etl_operation
       WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATE'
       WHEN s.id IS NOT NULL THEN 'INSERT' ELSE 'DELETE' END AS _etl_operation
FROM fa_t t FULL OUTER JOIN fa_s s ON t.id = s.id
""")


def _v(x: str) -> str:
    return x.replace("AS STRING", "AS VARCHAR")


sql("schema_drift_catalog", f"""
WITH f0 AS (SELECT DISTINCT {_v(fx.CATALOG_TABLE_EXPR)} AS table_name, {_v(fx.CAT_COL)} AS column_name,
                   {fx.CAT_TYPE} AS final_type FROM part WHERE p_size <= 45),
s0 AS (SELECT DISTINCT {_v(fx.CATALOG_TABLE_EXPR)} AS table_name, {_v(fx.CAT_COL)} AS column_name,
              {fx.STAGING_TYPE} AS staging_type FROM part WHERE p_partkey % 5 <> 0),
j AS (SELECT coalesce(s0.table_name, f0.table_name) AS table_name,
             coalesce(s0.column_name, f0.column_name) AS column_name, staging_type, final_type
      FROM s0 FULL OUTER JOIN f0 ON s0.table_name = f0.table_name AND s0.column_name = f0.column_name)
SELECT *, CASE WHEN final_type IS NULL THEN 'add_column' WHEN staging_type IS NULL THEN 'keep'
               WHEN staging_type <> final_type THEN 'safe_cast' END AS action
FROM j WHERE CASE WHEN final_type IS NULL THEN 'add_column' WHEN staging_type IS NULL THEN 'keep'
                  WHEN staging_type <> final_type THEN 'safe_cast' END IS NOT NULL
""")


sql("landing_layouts", "\nUNION ALL\n".join(
    f"SELECT *, '{layout}' AS layout FROM orders" for layout in ("ndjson", "indent2", "streamed", "compact")))
