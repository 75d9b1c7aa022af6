"""DuckDB SQL for the parity check (same adaptors, same rules).

Each adaptor of ``tarn.sources.testdata`` and each mart rule is restated
here as a CTE over the pre-registered testdata views. Used only by
``__spark_entry__.oracle_sql``; never on the Spark path.
"""

NUMERIC_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

SITES = """
geo AS (
  SELECT n_nationkey, n_regionkey, lower(n_name) AS council, r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
catalog AS (
  SELECT CAST(c_custkey AS VARCHAR) AS councilsiteid,
    'site-' || CAST(c_custkey AS VARCHAR) AS siteid,
    'lawa-' || council || '-' || CAST(c_custkey AS VARCHAR) AS lawasiteid,
    CAST(c_custkey + 40000 AS VARCHAR) AS lfenzid,
    c_mktsegment AS ltype,
    CASE WHEN c_acctbal < 0 THEN 'Riverine' ELSE 'Glacial' END AS geomorphicltype,
    r_name AS region, council AS agency, c_name || CASE WHEN copy = 1 THEN ' (old)' ELSE '' END AS catchment,
    CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS lwquality,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'yes' ELSE 'no' END AS macro,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'TRUE' ELSE 'false' END AS swquality,
    '-' || CAST(n_nationkey + 35 AS VARCHAR) || '.' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS latitude,
    CAST(n_regionkey + 166 AS VARCHAR) || '.' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS longitude,
    council,
    'https://' || council || '.example.org/wfs?service=WFS&request=GetFeature' AS url,
    'success' AS status, council AS partition_key
  FROM (SELECT customer.*, geo.*, 0 AS copy FROM customer JOIN geo ON c_nationkey = n_nationkey
        UNION ALL SELECT customer.*, geo.*, 0 FROM customer JOIN geo ON (c_nationkey + 1) % 25 = n_nationkey WHERE c_custkey % 10 = 0
        UNION ALL SELECT customer.*, geo.*, 1 FROM customer JOIN geo ON c_nationkey = n_nationkey WHERE c_custkey % 15 = 0) c),
sites AS (
  SELECT *, 'yes' AS lawa_site, TIMESTAMP '2024-01-01 00:00:00' AS created_at
  FROM catalog WHERE lower(lwquality) IN ('y', 'yes', 'true')
  QUALIFY row_number() OVER (PARTITION BY siteid, councilsiteid, lawasiteid ORDER BY catchment) = 1)"""

EV_SITE = """
ev_site AS (
  SELECT e.*, lower(n.n_name) AS council
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

TRANSFER = EV_SITE + """,
transfer AS (
  SELECT DISTINCT council AS agency, event_type AS callname, upper(event_type) AS lawaname
  FROM ev_site)"""

OBS = """
obs AS (
  SELECT
    'https://' || council || '.example.org/sos?service=SOS&request=GetObservation'
      || '&From=' || strftime(ts, '%Y-%m-%d') || '&To=2030-01-01&Site='
      || CAST(user_id AS VARCHAR) || '&Measurement=' || event_type AS url,
    CASE WHEN event_type = 'error' AND NOT (value < 5) THEN 500 ELSE 200 END AS status_code,
    CASE WHEN event_type = 'error' AND value < 5 THEN 'No data found'
         WHEN event_type = 'error' THEN 'HTTP error: 500' END AS error,
    CAST(user_id AS VARCHAR) AS site, event_type AS variable, council,
    CASE WHEN event_type = 'error' THEN 'missing'
         WHEN event_id % 37 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y%m%dT%H%M%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS t,
    CASE WHEN event_type = 'error' THEN NULL
         WHEN event_id % 11 = 0 THEN '<' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
         WHEN event_id % 13 = 0 THEN '>' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
         WHEN event_id % 17 = 0 THEN 'None'
         WHEN event_id % 19 = 0 THEN 'NA'
         WHEN event_id % 23 = 0 THEN '*'
         WHEN event_id % 29 = 0 THEN ''
         ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
    event_id, props,
    strftime(ts, '%Y-%m-%d') AS date_start, '2030-01-01' AS date_end,
    date_trunc('day', ts) + INTERVAL 30 HOUR AS created_at
  FROM ev_site)"""

RECORDS = SITES + "," + TRANSFER + "," + OBS + """,
enriched AS (
  SELECT o.*, s.councilsiteid, s.lawasiteid, tr.lawaname
  FROM obs o
  LEFT JOIN sites s ON o.site = s.councilsiteid AND o.council = s.council
  LEFT JOIN transfer tr ON o.variable = tr.callname AND o.council = tr.agency),
keyed AS (
  SELECT coalesce(lawasiteid, 'unknown-' || coalesce(council, '')) || '_' || coalesce(councilsiteid, site) || '_'
      || coalesce(lawaname, variable) || '_'
      || CASE WHEN lower(coalesce(t, 'missing')) = 'missing'
              THEN 'error-' || date_start || '-' || date_end
              ELSE coalesce(t, 'missing') END AS id,
    coalesce(t, 'missing') AS t, site, lawasiteid, lawaname, variable, value, error, status_code, url,
    council, created_at, event_id, props
  FROM enriched),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY
      (error IS NOT NULL), url NULLS FIRST, t NULLS FIRST, value NULLS FIRST,
      t NULLS FIRST, site NULLS FIRST, lawasiteid NULLS FIRST, lawaname NULLS FIRST,
      variable NULLS FIRST, value NULLS FIRST, error NULLS FIRST, status_code NULLS FIRST,
      url NULLS FIRST, council NULLS FIRST, created_at NULLS FIRST) AS rn
  FROM keyed),
lwq_data AS (
  SELECT id, t, site, lawasiteid, lawaname, variable,
    CASE WHEN value LIKE '<%' THEN 'less_than_' || substr(value, 2)
         WHEN value LIKE '>%' THEN 'greater_than_' || substr(value, 2)
         ELSE value END AS value,
    error, status_code, url, council, created_at
  FROM ranked WHERE rn = 1)"""

SITE_COLS = ("councilsiteid, siteid, lawasiteid, lfenzid, ltype, geomorphicltype, region, agency, "
             "catchment, lwquality, macro, swquality, latitude, longitude, council, url, status, "
             "partition_key, lawa_site, created_at")


def value_numeric(v: str) -> str:
    return f"""CASE WHEN {v} LIKE '%than_%'
              THEN TRY_CAST(nullif(regexp_extract({v}, '[0-9]+(\\.[0-9]+)?$'), '') AS DOUBLE)
         WHEN {v} IN ('None', 'missing', 'NA', '*', '') THEN NULL
         WHEN regexp_matches({v}, '{NUMERIC_RE}') THEN TRY_CAST({v} AS DOUBLE) END"""


def obs_time(t: str) -> str:
    return f"""CASE WHEN {t} = 'missing' THEN NULL
         ELSE coalesce(try_strptime({t}, '%Y%m%dT%H%M%S'), try_strptime({t}, '%Y-%m-%dT%H:%M:%S')) END"""


def fact_records(compat: bool = False) -> str:
    site_cols = ", ".join(f"s.{c}" for c in SITE_COLS.split(", "))
    cond = "r.site = s.councilsiteid" + ("" if compat else " AND r.council = s.council")
    return RECORDS + f""",
fr0 AS (
  SELECT r.id, {obs_time('r.t')} AS datetime_var,
    r.error, r.site AS site_id, r.lawaname AS variable, r.value AS raw_value,
    {value_numeric('r.value')} AS value_numeric,
    regexp_replace(r.value, '[0-9]', '', 'g') AS censored,
    r.url AS data_url, r.created_at AS data_created_at, {site_cols}
  FROM lwq_data r LEFT JOIN sites s ON {cond}),
fr AS (
  SELECT *, CASE WHEN position('less' IN censored) > 0 THEN value_numeric * 0.5
                 WHEN position('greater' IN censored) > 0 THEN value_numeric * 1.1
                 ELSE value_numeric END AS adjusted_value
  FROM fr0)"""

EV_PAGED = EV_SITE + """,
ev AS (
  SELECT *, strftime(ts - to_days(CAST((day(ts) - 1) % 10 AS INTEGER)), '%Y-%m-%d') AS day, event_id // 65536 AS page,
    'https://' || council || '.example.org/sos?service=SOS&request=GetObservation'
      || '&From=' || strftime(ts - to_days(CAST((day(ts) - 1) % 10 AS INTEGER)), '%Y-%m-%d') || '&To=2030-01-01&Site=' || CAST(user_id AS VARCHAR)
      || '&Measurement=' || event_type || '&Page=' || CAST(event_id // 65536 AS VARCHAR) AS url
  FROM ev_site)"""

S1 = "WITH " + EV_PAGED + """
SELECT url, 200 AS status_code, CAST(NULL AS VARCHAR) AS error, CAST(user_id AS VARCHAR) AS site,
  event_type AS variable, council,
  CASE WHEN event_id % 37 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
       WHEN event_id % 2 = 0 THEN strftime(ts, '%Y%m%dT%H%M%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS t,
  CASE WHEN event_id % 11 = 0 THEN '<' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
       WHEN event_id % 13 = 0 THEN '>' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
       WHEN event_id % 17 = 0 THEN 'None'
       WHEN event_id % 19 = 0 THEN 'NA'
       WHEN event_id % 23 = 0 THEN '*'
       WHEN event_id % 29 = 0 THEN ''
       ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
  CAST(event_id AS VARCHAR) AS event_id, props
FROM ev WHERE event_type <> 'error'
UNION ALL
SELECT url, CASE WHEN min(value) < 5 THEN 200 ELSE 500 END AS status_code,
  CASE WHEN min(value) < 5 THEN 'No data found' ELSE 'HTTP error: 500' END AS error,
  CAST(user_id AS VARCHAR) AS site, event_type AS variable, council, 'missing' AS t,
  CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS props
FROM ev WHERE event_type = 'error'
GROUP BY url, council, user_id, event_type"""

S2 = "WITH " + EV_PAGED + """
SELECT url, CASE WHEN event_type = 'error' AND min(value) >= 5 THEN 500 ELSE 200 END AS status_code,
  CASE WHEN event_type = 'error' AND min(value) < 5 THEN 'No data found'
       WHEN event_type = 'error' THEN 'HTTP error: 500' END AS error,
  CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS n_rows
FROM ev GROUP BY url, event_type"""

S3 = """WITH geo AS (
  SELECT n_nationkey, n_regionkey, lower(n_name) AS council, r_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (
  SELECT s.*, geo.*,
    '-' || CAST(s_nationkey + 35 AS VARCHAR) || '.' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS lat,
    CAST(n_regionkey + 166 AS VARCHAR) || '.' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS lon,
    bool_or(s_acctbal > 0) OVER (PARTITION BY council) AS any_ltype,
    bool_or(s_acctbal >= 0) OVER (PARTITION BY council) AS any_pos
  FROM supplier s JOIN geo ON s_nationkey = n_nationkey)
SELECT CAST(s_suppkey AS VARCHAR) AS councilsiteid, s_name AS siteid,
  'lawa-' || council || '-' || CAST(s_suppkey AS VARCHAR) AS lawasiteid,
  CAST(NULL AS VARCHAR) AS lfenzid,
  CASE WHEN s_acctbal > 0 THEN 'Shallow' WHEN any_ltype THEN '-99999' END AS ltype,
  CAST(NULL AS VARCHAR) AS geomorphicltype, r_name AS region, council AS agency,
  s_name || ' & Co' AS catchment,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS lwquality,
  '-99999' AS macro, CAST(NULL AS VARCHAR) AS swquality,
  CASE WHEN s_acctbal >= 0 AND s_suppkey % 7 <> 0 THEN lat WHEN any_pos THEN '-99999' END AS latitude,
  CASE WHEN s_acctbal >= 0 AND s_suppkey % 7 <> 0 THEN lon WHEN any_pos THEN '-99999' END AS longitude,
  council,
  'https://' || council || '.example.org/wfs?service=WFS&request=GetFeature&startIndex='
    || CAST((s_suppkey // 500) * 500 AS VARCHAR) AS url,
  'success' AS status, council AS partition_key
FROM s"""

ROUTED = SITES.replace(",\nsites AS (", ",\nunused AS (") + """,
routed AS (
  SELECT * FROM (
    SELECT 'lwq' AS module, * FROM catalog WHERE lower(lwquality) IN ('y', 'yes', 'true')
    UNION ALL SELECT 'mac' AS module, * FROM catalog WHERE lower(macro) IN ('y', 'yes', 'true')
    UNION ALL SELECT 'swq' AS module, * FROM catalog WHERE lower(swquality) IN ('y', 'yes', 'true')) m
  QUALIFY row_number() OVER (PARTITION BY module, siteid, councilsiteid, lawasiteid ORDER BY catchment) = 1)"""

# The landed responses as records (T1-T3): the rules of RECORDS over the
# rows of S1, whose URLs carry a page and whose period starts the window.
STREAMED = RECORDS.replace("FROM obs o", "FROM landed o") .replace("enriched AS (", """landed AS (
  SELECT x.url, x.status_code, x.error, x.site, x.variable, x.council, x.t, x.value,
    regexp_extract(x.url, 'From=([0-9-]+)', 1) AS date_start, '2030-01-01' AS date_end,
    CAST(NULL AS TIMESTAMP) AS created_at, x.event_id, x.props
  FROM (""" + S1 + """) x),
enriched AS (""", 1)

# The raw table after a batch of new and corrected records (K8, K10):
# records loaded before the cut stay, some with a corrected value, later
# ones arrive with the batch.
def corrected(cut: str, batch_ts: str) -> str:
    return RECORDS + f""",
cur AS (
  SELECT * REPLACE (
      CASE WHEN created_at < TIMESTAMP '{cut}' AND right(id, 1) = '7' THEN '42' ELSE value END AS value,
      CASE WHEN created_at < TIMESTAMP '{cut}' THEN created_at ELSE TIMESTAMP '{batch_ts}' END AS created_at),
    CASE WHEN created_at < TIMESTAMP '{cut}' AND right(id, 1) = '7' THEN TIMESTAMP '{batch_ts}' END AS updated_at
  FROM lwq_data)"""


def corrected_facts(cut: str, batch_ts: str) -> str:
    marts = fact_records().removeprefix(RECORDS).replace("FROM lwq_data r", "FROM cur r")
    return corrected(cut, batch_ts) + marts.replace("r.created_at AS data_created_at,", "r.created_at AS data_created_at, r.updated_at AS data_updated_at,")
