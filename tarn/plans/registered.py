"""Registered queries: one per operator of the inventory, each paired with
the DuckDB SQL that states the same result over the testdata views.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole testdata tables (or tables Spark derives from them). Output columns
are named the same on both sides; averages are rounded to 6 places and
arrays are given as sorted comma-joined text for the value-hash compare;
clock columns (``current_timestamp``) are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.plans import marts
from tarn.plans import oracle as O
from tarn.sources import testdata as td

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _facts(spark, sf, compat=False):
    return marts.fact_records(td.raw_records(spark, sf), td.sites_latest(spark, sf),
                              compat=compat, with_clock=False)


# --- records pipeline (S6, J3, J3b, P6, P10, P11, F9, A6) --------------------

@register("records_lwq_data", "WITH " + O.RECORDS + " SELECT * FROM lwq_data")
def q_records(spark, sf):
    return td.build_raw_records(spark, sf)


@register("S6_sites_latest", "WITH " + O.SITES + " SELECT * FROM sites")
def q_sites(spark, sf):
    return td.build_sites_latest(spark, sf)


@register("S6_transfer_table", "WITH " + O.TRANSFER + " SELECT * FROM transfer")
def q_transfer(spark, sf):
    return td.build_transfer_table(spark, sf)


# --- marts --------------------------------------------------------------------

@register("fact_records", "WITH " + O.fact_records() + " SELECT * FROM fr")
def q_fact_records(spark, sf):
    return _facts(spark, sf)


@register("fact_records_compat", "WITH " + O.fact_records(compat=True) + " SELECT * FROM fr")
def q_fact_records_compat(spark, sf):
    return _facts(spark, sf, compat=True)


A1_SQL = "WITH " + O.fact_records() + """
SELECT siteid, lawasiteid, councilsiteid, variable, latitude, longitude, council,
  count(*) AS total_records, round(avg(value_numeric), 6) AS average_value,
  max(value_numeric) AS max_value, min(value_numeric) AS min_value,
  max(data_created_at) AS last_updated_at, min(data_created_at) AS first_updated_at
FROM fr
WHERE value_numeric IS NOT NULL
  AND EXISTS (SELECT 1 FROM sites s WHERE fr.siteid = s.siteid AND fr.lawasiteid = s.lawasiteid
              AND fr.councilsiteid = s.councilsiteid AND fr.council = s.council)
GROUP BY siteid, lawasiteid, councilsiteid, council, latitude, longitude, variable"""


def summary(spark, sf):
    sites = td.sites_latest(spark, sf)
    fs = marts.fact_summary(_facts(spark, sf), sites)
    return fs.withColumn("average_value", F.round("average_value", 6))


@register("A1_fact_summary", A1_SQL)
def q_summary(spark, sf):
    return summary(spark, sf)


A2_SQL = "WITH " + O.fact_records() + """
SELECT CAST(data_created_at AS DATE) AS created_at_date, council,
  coalesce(error, 'None') AS error, count(*) AS error_count,
  coalesce(string_agg(DISTINCT variable, ',' ORDER BY variable), '') AS variables,
  count(DISTINCT councilsiteid) AS council_count,
  min(datetime_var) AS min_datetime_var, max(datetime_var) AS max_datetime_var
FROM fr GROUP BY 1, 2, 3"""


def diagnostics(spark, sf):
    fse = marts.fact_summary_errors(_facts(spark, sf))
    return fse.withColumn("variables", F.array_join("variables", ","))


@register("A2_fact_summary_errors", A2_SQL)
def q_errors(spark, sf):
    return diagnostics(spark, sf)


@register("J4_dim_sites", "WITH " + O.RECORDS + f""", dim AS (
  SELECT r.id, r.variable, {', '.join('s.' + c for c in O.SITE_COLS.split(', '))}
  FROM lwq_data r LEFT JOIN sites s ON r.site = s.councilsiteid AND r.council = s.council)
SELECT * FROM dim""")
def q_dim_sites(spark, sf):
    return marts.dim_sites(td.raw_records(spark, sf), td.sites_latest(spark, sf))


@register("J4_dim_sites_compat", "WITH " + O.RECORDS + f""", dim AS (
  SELECT r.id, r.variable, {', '.join('s.' + c for c in O.SITE_COLS.split(', '))}
  FROM lwq_data r LEFT JOIN sites s ON r.site = s.councilsiteid)
SELECT * FROM dim""")
def q_dim_sites_compat(spark, sf):
    return marts.dim_sites(td.raw_records(spark, sf), td.sites_latest(spark, sf), compat=True)


@register("J5_dim_variables", "WITH " + O.RECORDS + """
SELECT DISTINCT r.id, r.variable, r.created_at, t.agency, t.callname
FROM lwq_data r LEFT JOIN transfer t ON r.variable = t.callname AND r.council = t.agency""")
def q_dim_variables(spark, sf):
    return marts.dim_variables(td.raw_records(spark, sf), td.transfer_table(spark, sf))


@register("J5_dim_variables_compat", "WITH " + O.RECORDS + """
SELECT DISTINCT r.id, r.variable, r.created_at, t.agency, t.callname
FROM lwq_data r LEFT JOIN transfer t ON r.variable = t.callname""")
def q_dim_variables_compat(spark, sf):
    return marts.dim_variables(td.raw_records(spark, sf), td.transfer_table(spark, sf), compat=True)


@register("A5_dim_error", "WITH " + O.RECORDS + """
SELECT DISTINCT id, site AS site_id, variable AS variable_id, error, status_code, created_at
FROM lwq_data""")
def q_dim_error(spark, sf):
    return marts.dim_error(td.raw_records(spark, sf), with_clock=False)


# --- marts in the reference's literal reading (X4: dates of the site load) ----

@register("A1_fact_summary_compat", A1_SQL.replace(O.fact_records(), O.fact_records(compat=True)).replace("max(data_created_at)", "max(created_at)").replace("min(data_created_at)", "min(created_at)"))
def q_summary_compat(spark, sf):
    fs = marts.fact_summary(_facts(spark, sf, compat=True), td.sites_latest(spark, sf), compat=True)
    return fs.withColumn("average_value", F.round("average_value", 6))


@register("A2_fact_summary_errors_compat", A2_SQL.replace(O.fact_records(), O.fact_records(compat=True)).replace("CAST(data_created_at AS DATE)", "CAST(created_at AS DATE)"))
def q_errors_compat(spark, sf):
    fse = marts.fact_summary_errors(_facts(spark, sf, compat=True), compat=True)
    return fse.withColumn("variables", F.array_join("variables", ","))


@register("J10_star", "WITH " + O.fact_records() + """
SELECT fr.*, t.agency AS dim_agency, t.callname AS dim_callname, s2.lawasiteid AS dim_lawasiteid, l.status_code AS dim_status_code
FROM fr JOIN lwq_data l ON fr.id = l.id
LEFT JOIN transfer t ON l.variable = t.callname AND l.council = t.agency
LEFT JOIN sites s2 ON l.site = s2.councilsiteid AND l.council = s2.council""")
def q_star(spark, sf):
    rec, sites, transfer = td.raw_records(spark, sf), td.sites_latest(spark, sf), td.transfer_table(spark, sf)
    return marts.star(_facts(spark, sf), marts.dim_variables(rec, transfer), marts.dim_sites(rec, sites),
                      marts.dim_error(rec, with_clock=False))


# --- store: upsert, history, insert-if-absent, keep-first, evolution ---------

LINE_SQL = f"""
li AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
    l_returnflag AS council, l_quantity, l_shipdate FROM lineitem),
tgt AS (
  SELECT id, CAST(CAST(max(l_quantity) AS DECIMAL(18,2)) AS VARCHAR) AS value,
    min(council) AS council, max(l_shipdate) AS created_at
  FROM li WHERE l_shipdate < TIMESTAMP '{td.TARGET_END}' GROUP BY id)"""


def _src_sql(bump: str) -> str:
    return f""",
src AS (
  SELECT id, CAST(CAST(min(l_quantity) + {bump} AS DECIMAL(18,2)) AS VARCHAR) AS value,
    min(council) AS council
  FROM li WHERE l_shipdate >= TIMESTAMP '{td.SOURCE_START}' GROUP BY id)"""


K4_SQL = "WITH " + LINE_SQL + _src_sql("1.0") + f"""
SELECT s.id, s.value, s.council,
  CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE TIMESTAMP '{td.UPSERT_BATCH_TS}' END AS created_at,
  CASE WHEN t.id IS NOT NULL THEN TIMESTAMP '{td.UPSERT_BATCH_TS}' END AS updated_at
FROM src s LEFT JOIN tgt t ON s.id = t.id
UNION ALL
SELECT t.id, t.value, t.council, t.created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id)"""


@register("K4_upsert", K4_SQL)
def q_upsert(spark, sf):
    from tarn.operators.store import upsert
    return upsert(td.upsert_target(spark, sf), td.upsert_source(spark, sf, bump=1.0),
                  "id", td.UPSERT_BATCH_TS)


K5_SQL = "WITH " + LINE_SQL + _src_sql("0.0") + f"""
SELECT t.id, t.value, t.council, t.created_at, TIMESTAMP '{td.UPSERT_BATCH_TS}' AS updated_at
FROM tgt t JOIN src s ON t.id = s.id WHERE t.value != s.value"""


@register("K5_history", K5_SQL)
def q_history(spark, sf):
    from tarn.operators.store import history_rows
    return history_rows(td.upsert_target(spark, sf), td.upsert_source(spark, sf),
                        "id", "value", td.UPSERT_BATCH_TS)


K6_SQL = "WITH " + LINE_SQL + _src_sql("0.0") + """
SELECT id, value, council, created_at FROM tgt
UNION ALL
SELECT s.id, s.value, s.council, CAST(NULL AS TIMESTAMP) AS created_at
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.id = s.id)"""


@register("K6_insert_if_absent", K6_SQL)
def q_insert_missing(spark, sf):
    from tarn.operators.store import insert_missing
    return insert_missing(td.upsert_target(spark, sf), td.upsert_source(spark, sf), "id")


STORED_SQL = "WITH " + LINE_SQL + _src_sql("1.0") + """, merged AS (
  SELECT s.id, s.value, lower(s.council) AS council,
    CASE WHEN t.id IS NOT NULL THEN TIMESTAMP '{first}' ELSE TIMESTAMP '{second}' END AS created_at,
    CASE WHEN t.id IS NOT NULL THEN TIMESTAMP '{second}' END AS updated_at
  FROM src s LEFT JOIN tgt t ON s.id = t.id
  UNION ALL
  SELECT t.id, t.value, lower(t.council), TIMESTAMP '{first}', CAST(NULL AS TIMESTAMP)
  FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id)) """.format(first="2001-01-01 00:00:00", second=td.UPSERT_BATCH_TS)


def _stored(spark, sf):
    """Two batches written to a table in versions, the second one twice (a replay)."""
    import uuid

    from tarn.operators.snapshots import SnapshotTable
    from tarn.session import scratch_dir
    table = SnapshotTable(spark, scratch_dir(spark, f"stored-{uuid.uuid4().hex}/table"))
    table.upsert(td.upsert_target(spark, sf).drop("created_at"), "2001-01-01 00:00:00", "first")
    source = td.upsert_source(spark, sf, bump=1.0)
    table.upsert(source, td.UPSERT_BATCH_TS, "second")
    table.upsert(source, td.UPSERT_BATCH_TS, "second")
    return table


STORED_COLUMNS = ["id", "value", "council", "created_at", "updated_at"]
STORED_HISTORY_SQL = STORED_SQL + f"""
SELECT t.id, t.value, lower(t.council) AS council, TIMESTAMP '2001-01-01 00:00:00' AS created_at,
  TIMESTAMP '{td.UPSERT_BATCH_TS}' AS updated_at
FROM tgt t JOIN src s ON t.id = s.id WHERE t.value != s.value"""


@register("K4_upsert_stored", STORED_SQL + "SELECT * FROM merged")
def q_upsert_stored(spark, sf):
    return _stored(spark, sf).read().select(*STORED_COLUMNS)


@register("K5_history_stored", STORED_HISTORY_SQL)
def q_history_stored(spark, sf):
    return _stored(spark, sf).history().select(*STORED_COLUMNS)


@register("K4_upsert_compacted", STORED_SQL + "SELECT * FROM merged")
def q_upsert_compacted(spark, sf):
    """The same rows when every bucket has been rewritten."""
    table = _stored(spark, sf)
    table.compact(every=True)
    return table.read().select(*STORED_COLUMNS)


@register("K5_history_compacted", STORED_HISTORY_SQL)
def q_history_compacted(spark, sf):
    table = _stored(spark, sf)
    table.compact(every=True)
    return table.history().select(*STORED_COLUMNS)


@register("T3_unchanged_rows", "WITH " + LINE_SQL + _src_sql("0.0") + f"""
SELECT s.id, s.value, lower(s.council) AS council,
  CASE WHEN t.id IS NULL THEN TIMESTAMP '{td.UPSERT_BATCH_TS}' ELSE TIMESTAMP '2001-01-01 00:00:00' END AS created_at,
  CASE WHEN t.id IS NOT NULL AND (t.value IS DISTINCT FROM s.value OR lower(t.council) IS DISTINCT FROM lower(s.council))
       THEN TIMESTAMP '{td.UPSERT_BATCH_TS}' END AS updated_at
FROM src s LEFT JOIN tgt t ON s.id = t.id
UNION ALL
SELECT t.id, t.value, lower(t.council), TIMESTAMP '2001-01-01 00:00:00', CAST(NULL AS TIMESTAMP)
FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id)""")
def q_unchanged(spark, sf):
    """A batch of which the stored rows are no news, then the same batch
    under another tag: unchanged rows keep their stamps."""
    import uuid

    from tarn.operators.snapshots import SnapshotTable
    from tarn.session import scratch_dir
    table = SnapshotTable(spark, scratch_dir(spark, f"unchanged-{uuid.uuid4().hex}/table"))
    table.upsert(td.upsert_target(spark, sf).drop("created_at"), "2001-01-01 00:00:00", "first")
    source = td.upsert_source(spark, sf)
    table.upsert(source, td.UPSERT_BATCH_TS, "second", skip_unchanged=True)
    table.upsert(source, "2002-01-01 00:00:00", "third", skip_unchanged=True)
    return table.read().select(*STORED_COLUMNS)


@register("K9_full_rebuild", "WITH " + LINE_SQL + _src_sql("0.0") + """
SELECT id, value, council FROM src WHERE council <> 'R'""")
def q_full_rebuild(spark, sf):
    """A partitioned table of both batches, rebuilt from the second one
    without one council: nothing of the first stays."""
    import uuid

    from tarn.operators.store import full_rebuild, read
    from tarn.session import scratch_dir
    path = scratch_dir(spark, f"rebuilt-{uuid.uuid4().hex}/table")
    full_rebuild(td.upsert_target(spark, sf).drop("created_at"), path, "council")
    full_rebuild(td.upsert_source(spark, sf).filter("council <> 'R'"), path, "council")
    return read(spark, path).select("id", "value", "council")


A6_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
    l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
    l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""


@register("A6_keep_first", A6_SQL)
def q_keep_first(spark, sf):
    from tarn.operators.dedup import keep_first
    li = td.table(spark, sf, "lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"],
                      ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


K7_SQL = """
SELECT event_id, ts, user_id, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS DOUBLE) AS value
FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'"""


@register("K7_schema_evolution", K7_SQL)
def q_evolve(spark, sf):
    """Loads before 2024-01-15 carried three columns; later ones five."""
    from tarn.operators.store import evolve
    ev = td.table(spark, sf, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    old = ev.filter(F.col("ts") < cut).select("event_id", "ts", "user_id")
    new = ev.filter(F.col("ts") >= cut).select("event_id", "ts", "user_id", "event_type", "value")
    return evolve(old, new)


# --- landing: XML measurement responses, GML site catalogs -------------------

@register("S1_xml_explode", O.S1)
def q_xml_explode(spark, sf):
    """Round trip: events -> landed XML responses -> rows equal to events."""
    from tarn.sources.landing import explode_responses
    rows = explode_responses(td.landed_responses(spark, sf))
    return rows.select("url", "status_code", "error", "site", "variable", "council", "t", "value",
                       F.col("params")["EventId"].alias("event_id"),
                       F.col("params")["Props"].alias("props"))


@register("S2_response_classes", O.S2)
def q_response_classes(spark, sf):
    from tarn.sources.landing import explode_responses
    rows = explode_responses(td.landed_responses(spark, sf))
    return rows.groupBy("url", "status_code", "error").agg(
        F.count_if(F.col("error").isNull()).alias("n_rows"))


@register("S3_gml_sites", O.S3)
def q_gml_sites(spark, sf):
    """Round trip: suppliers -> GML catalog pages -> typed site rows."""
    from tarn.sources.catalog import parse_catalog
    return parse_catalog(td.landed_catalogs(spark, sf))


@register("P3_route_modules", "WITH " + O.ROUTED + " SELECT *, 'yes' AS lawa_site FROM routed")
def q_route_modules(spark, sf):
    from tarn.operators.sites import route_all_modules
    return route_all_modules(td.site_catalog(spark, sf))


# --- dashboard views ---------------------------------------------------------

VIEW_COUNCIL = "nation_1"     # the council picked in the dashboard
VIEW_VARIABLE = "CLICK"       # the parameter picked in the dashboard


@register("V1_site_list", "WITH " + O.SITES + f" SELECT * FROM sites WHERE council = '{VIEW_COUNCIL}'")
def q_site_list(spark, sf):
    from tarn.plans.serving import site_list
    return site_list(td.sites_latest(spark, sf), VIEW_COUNCIL)


@register("V2_load_log", A2_SQL.replace("FROM fr GROUP BY", f"FROM fr WHERE council = '{VIEW_COUNCIL}' GROUP BY"))
def q_load_log(spark, sf):
    from tarn.plans.serving import load_log
    return load_log(diagnostics(spark, sf), VIEW_COUNCIL)


V3_SQL = (f"SELECT * FROM ({A1_SQL}) q WHERE council = '{VIEW_COUNCIL}' AND variable = '{VIEW_VARIABLE}'")


@register("V3_parameter_view", V3_SQL)
def q_parameter_view(spark, sf):
    from tarn.plans.serving import parameter_view
    return parameter_view(summary(spark, sf), VIEW_COUNCIL, VIEW_VARIABLE)


@register("A3_site_metrics", f"""
SELECT (SELECT count(*) FROM (SELECT DISTINCT siteid, lawasiteid, councilsiteid FROM ({"WITH " + O.SITES + " SELECT * FROM sites"}) a)) AS sites_published,
       (SELECT count(*) FROM (SELECT DISTINCT siteid, lawasiteid, councilsiteid FROM ({V3_SQL}) b)) AS sites_with_data""")
def q_site_metrics(spark, sf):
    from tarn.plans.serving import parameter_view, site_metrics
    return site_metrics(td.sites_latest(spark, sf),
                        parameter_view(summary(spark, sf), VIEW_COUNCIL, VIEW_VARIABLE))


V4_SQL = f"""
SELECT * REPLACE (
    CASE WHEN regexp_matches(latitude, '{O.NUMERIC_RE}') THEN TRY_CAST(latitude AS DOUBLE) END AS latitude,
    CASE WHEN regexp_matches(longitude, '{O.NUMERIC_RE}') THEN TRY_CAST(longitude AS DOUBLE) END AS longitude),
  average_value * 10 AS average_size
FROM ({V3_SQL}) v WHERE average_value IS NOT NULL"""


@register("V4_map_points", V4_SQL)
def q_map_points(spark, sf):
    from tarn.plans.serving import map_points, parameter_view
    return map_points(parameter_view(summary(spark, sf), VIEW_COUNCIL, VIEW_VARIABLE))


@register("O4_map_centre", f"SELECT latitude, longitude FROM ({V4_SQL}) p "
                           "ORDER BY councilsiteid, siteid, lawasiteid LIMIT 1")
def q_map_centre(spark, sf):
    from tarn.plans.serving import map_centre, map_points, parameter_view
    return map_centre(map_points(parameter_view(summary(spark, sf), VIEW_COUNCIL, VIEW_VARIABLE)))


# --- quality -----------------------------------------------------------------

Q_SQL = "WITH " + O.RECORDS + """,
dim AS (SELECT DISTINCT r.id, r.variable, r.created_at, t.agency, t.callname
        FROM lwq_data r LEFT JOIN transfer t ON r.variable = t.callname AND r.council = t.agency)
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE id IS NULL) AS id_nulls,
  count(*) FILTER (WHERE variable IS NULL) AS variable_nulls,
  count(*) FILTER (WHERE created_at IS NULL) AS created_at_nulls,
  count(*) FILTER (WHERE agency IS NULL) AS agency_nulls,
  count(*) FILTER (WHERE callname IS NULL) AS callname_nulls,
  count(*) FILTER (WHERE agency IS NOT NULL AND agency NOT IN
    ('ac', 'ecan', 'es', 'gw', 'hbrc', 'hrc', 'nrc', 'orc', 'wrc')) AS agency_rejected,
  (SELECT count(*) FROM (SELECT id FROM dim GROUP BY id HAVING count(*) > 1) d) AS id_duplicates
FROM dim"""


@register("Q1_Q3_dim_variable_checks", Q_SQL)
def q_checks(spark, sf):
    from tarn.operators.quality import check_dim_variables
    return check_dim_variables(marts.dim_variables(td.raw_records(spark, sf), td.transfer_table(spark, sf)))


DIM_SQL = Q_SQL[:Q_SQL.index("SELECT count(*) AS n_rows")]


@register("Q1_Q3_violations", DIM_SQL + """
SELECT id, variable, created_at, agency, callname, concat_ws(';',
    CASE WHEN id IS NULL THEN 'id is null' END, CASE WHEN variable IS NULL THEN 'variable is null' END,
    CASE WHEN created_at IS NULL THEN 'created_at is null' END, CASE WHEN agency IS NULL THEN 'agency is null' END,
    CASE WHEN callname IS NULL THEN 'callname is null' END,
    CASE WHEN agency IS NOT NULL AND agency NOT IN ('ac', 'ecan', 'es', 'gw', 'hbrc', 'hrc', 'nrc', 'orc', 'wrc') THEN 'agency not accepted' END,
    CASE WHEN id IN (SELECT id FROM dim WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) THEN 'id repeats' END) AS reasons
FROM dim WHERE reasons <> ''""")
def q_violations(spark, sf):
    """The rows behind the counts of the declared checks, with their reasons."""
    from tarn.operators.quality import violations
    dim = marts.dim_variables(td.raw_records(spark, sf), td.transfer_table(spark, sf))
    return violations(dim).where(F.size("reasons") > 0).withColumn("reasons", F.array_join("reasons", ";"))


CHECKED_CUT = "2024-01-20"
CHECKED_AGENCIES = [f"nation_{i}" for i in range(20)]     # the councils that the checked load accepts


@register("Q1_Q3_checked_load", DIM_SQL + f""",
parts AS (SELECT id, variable, agency, callname, created_at < TIMESTAMP '{CHECKED_CUT}' AS old, right(id, 1) = '7' AS again FROM dim),
arrived AS (SELECT 'first' AS batch_tag, id, variable, agency, callname FROM parts WHERE old
  UNION ALL SELECT 'second', id, variable, agency, callname FROM parts WHERE NOT old OR again
  UNION ALL SELECT 'second', id, variable, agency, callname FROM parts WHERE NOT old AND right(id, 1) = '3'),
ruled AS (SELECT *, count(*) OVER (PARTITION BY batch_tag, id) AS n,
    concat_ws(';', CASE WHEN agency IS NULL THEN 'agency is null' END, CASE WHEN callname IS NULL THEN 'callname is null' END,
      CASE WHEN agency NOT IN ({', '.join(f"'{a}'" for a in CHECKED_AGENCIES)}) THEN 'agency not accepted' END) AS rules FROM arrived),
kept_first AS (SELECT id FROM ruled WHERE batch_tag = 'first' AND rules = '' AND n = 1),
judged AS (SELECT batch_tag, id, variable, agency, callname, concat_ws(';', nullif(rules, ''), CASE WHEN n > 1 THEN 'id repeats' END,
    CASE WHEN batch_tag = 'second' AND id IN (SELECT id FROM kept_first) THEN 'id is stored' END) AS reasons FROM ruled)
SELECT batch_tag, id, variable, agency, callname, reasons, count(*) AS n_rows FROM judged WHERE reasons <> '' GROUP BY ALL
UNION ALL SELECT 'loaded', id, variable, agency, callname, '', 1 FROM judged WHERE reasons = ''""")
def q_checked_load(spark, sf):
    """Two loads into a checked table: the second brings stored ids again
    and repeats some of its own. What stayed out, with reasons, and what the
    table holds in the end."""
    import uuid

    from tarn.operators.snapshots import SnapshotTable
    from tarn.plans.loads import load_checked
    from tarn.session import scratch_dir
    base = scratch_dir(spark, f"checked-{uuid.uuid4().hex}")
    table, bad = SnapshotTable(spark, f"{base}/dim"), SnapshotTable(spark, f"{base}/quarantine", key="row_id")
    dim = marts.dim_variables(td.raw_records(spark, sf), td.transfer_table(spark, sf))
    old, again, twice = F.col("created_at") < F.lit(CHECKED_CUT).cast("timestamp_ntz"), F.col("id").endswith("7"), F.col("id").endswith("3")
    first = dim.where(old)
    second = dim.where(~old | again).unionByName(dim.where(~old & twice))
    rules = {"not_null": ("id", "variable", "agency", "callname"), "accepted": {"agency": CHECKED_AGENCIES}}
    load_checked(first.drop("created_at"), table, bad, "2024-01-20 00:00:00", "first", **rules)
    for _ in range(2):                                    # the second time changes nothing
        load_checked(second.drop("created_at"), table, bad, "2024-02-20 00:00:00", "second", **rules)
    held = table.read().select(F.lit("loaded").alias("batch_tag"), "id", "variable", "agency", "callname", F.lit("").alias("reasons"), F.lit(1).cast("long").alias("n_rows"))
    field = lambda c: F.get_json_object("bad_row", f"$.{c}").alias(c)
    out = bad.read().select("batch_tag", F.col("bad_key").alias("id"), field("variable"), field("agency"), field("callname"), "reasons", "n_rows")
    return out.unionByName(held)


def backfill_requests(spark, sf):
    """Each order is a backfill request: its customer's council, the order
    date to the last ship date, the return flags as parameters and the
    suppliers as sites."""
    o = td.table(spark, sf, "orders")
    li = td.table(spark, sf, "lineitem")
    c = td.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = td.table(spark, sf, "nation").select("n_nationkey", td.council_col().alias("council"))
    lines = li.groupBy("l_orderkey").agg(
        F.to_date(F.max("l_shipdate")).alias("end_date"),
        F.sort_array(F.collect_set("l_returnflag")).alias("params"),
        F.sort_array(F.collect_set(F.col("l_suppkey").cast("string"))).alias("sites"))
    cn = td.dim_join(c, n, c.c_nationkey == n.n_nationkey, "inner")
    req = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    req = td.dim_join(req, cn, req.o_custkey == cn.c_custkey, "left")
    return req.select(F.col("o_orderkey").cast("string").alias("request_id"), "council",
                      F.to_date("o_orderdate").alias("start_date"), "end_date", "params", "sites")


Q4_SQL = """
WITH lines AS (
  SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS end_date,
    count(DISTINCT l_returnflag) AS n_params, count(DISTINCT l_suppkey) AS n_sites
  FROM lineitem GROUP BY l_orderkey),
req AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS request_id, lower(n_name) AS council,
    CAST(o_orderdate AS DATE) AS start_date, end_date,
    coalesce(n_params, 0) AS n_params, coalesce(n_sites, 0) AS n_sites
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
chk AS (
  SELECT *, datediff('day', start_date, end_date) AS days,
    start_date IS NOT NULL AND end_date IS NOT NULL AND n_params > 0 AND n_sites > 0 AS present
  FROM req)
SELECT request_id, council, start_date, end_date, n_params, n_sites, days,
  concat_ws(';',
    CASE WHEN NOT present THEN 'missing field' END,
    CASE WHEN present AND n_sites > 2 THEN 'more than 2 sites' END,
    CASE WHEN present AND n_params > 2 THEN 'more than 2 parameters' END,
    CASE WHEN present AND days > 30 THEN 'more than 30 days' END,
    CASE WHEN present AND days < 0 THEN 'end before start' END) AS reasons,
  present AND n_sites <= 2 AND n_params <= 2 AND days BETWEEN 0 AND 30 AS accepted
FROM chk"""


@register("Q4_backfill_validation", Q4_SQL)
def q_backfill(spark, sf):
    from tarn.operators.quality import validate_backfill
    v = validate_backfill(backfill_requests(spark, sf))
    return v.select("request_id", "council", "start_date", "end_date",
                    F.coalesce(F.size("params"), F.lit(0)).cast("long").alias("n_params"),
                    F.coalesce(F.size("sites"), F.lit(0)).cast("long").alias("n_sites"),
                    F.col("days").cast("long").alias("days"), F.array_join("reasons", ";").alias("reasons"),
                    F.coalesce("accepted", F.lit(False)).alias("accepted"))


# --- manifest ----------------------------------------------------------------

MANIFEST_START = "2024-01-01"


@register("J1_request_manifest", "WITH " + O.SITES + "," + O.TRANSFER + f"""
SELECT s.council, s.councilsiteid AS site, t.callname AS variable,
  'https://' || s.council || '.example.org/sos?service=SOS&request=GetObservation'
    || '&From={MANIFEST_START}&To=2030-01-01&Site=' || s.councilsiteid || '&Measurement=' || t.callname AS url
FROM sites s JOIN transfer t ON s.council = t.agency""")
def q_manifest(spark, sf):
    from tarn.operators.manifest import build_manifest
    return build_manifest(td.sites_latest(spark, sf), td.transfer_table(spark, sf),
                          td.list_of_urls(spark, sf), MANIFEST_START)


# --- reshape, metadata, profiles, counts, increments ---------------------------

@register("R1_unpivot", """
SELECT p_partkey, 'p_name' AS variable, p_name AS value FROM part
UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part""")
def q_unpivot(spark, sf):
    return marts.unpivot_metadata(td.table(spark, sf, "part"), ids=["p_partkey"], exclude=())


@register("R2_P9_parameters", "WITH " + O.EV_PAGED + """
SELECT url, CASE WHEN event_id % 37 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
       WHEN event_id % 2 = 0 THEN strftime(ts, '%Y%m%dT%H%M%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS t, name, value
FROM (SELECT url, ts, event_id, event_type, 'EventId' AS name, CAST(event_id AS VARCHAR) AS value FROM ev
      UNION ALL SELECT url, ts, event_id, event_type, 'Props',
        regexp_replace(props, '[^\\w\\s]', '', 'g') FROM ev
      UNION ALL SELECT url, ts, event_id, event_type, 'Lāke_Nō', 'ō' || CAST(event_id AS VARCHAR) FROM ev WHERE event_id % 5 = 0) x
WHERE event_type <> 'error'""")
def q_parameters(spark, sf):
    """Open Parameter attributes as (name, value) rows, values cleaned."""
    from tarn.functions.values import sanitise_name_col, strip_specials
    from tarn.sources.landing import explode_responses
    rows = explode_responses(td.landed_responses(spark, sf)).filter(F.col("error").isNull())
    kv = rows.select("url", "t", F.explode("params").alias("name", "raw"))
    return kv.select("url", "t", sanitise_name_col("name").alias("name"), strip_specials("raw").alias("value"))


@register("P7_metadata", "WITH " + O.RECORDS + """
SELECT id, name, value FROM (
  SELECT id, t, 'EventId' AS name, CAST(event_id AS VARCHAR) AS value FROM ranked WHERE rn = 1 AND error IS NULL
  UNION ALL SELECT id, t, 'Props', regexp_replace(props, '[^\\w\\s]', '', 'g') FROM ranked WHERE rn = 1 AND error IS NULL) x""")
def q_metadata(spark, sf):
    """The open attributes of the kept records, in long form."""
    from tarn.operators.records import build_records, metadata
    return metadata(build_records(td.observations(spark, sf), td.sites_latest(spark, sf), td.transfer_table(spark, sf), keep_params=True))


@register("R2_K7_typed_attributes", "WITH " + O.RECORDS + """
SELECT id, event_id AS "EventId", regexp_replace(props, '[^\\w\\s]', '', 'g') AS "Props",
  CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 100 AS DOUBLE) ELSE event_id % 100 + 0.5 END AS "Depth",
  CASE WHEN event_id % 2 = 0 THEN '' ELSE 'T' END || CAST(event_id AS VARCHAR) AS "Tag"
FROM ranked WHERE rn = 1 AND error IS NULL""")
def q_typed_attributes(spark, sf):
    """The open attributes as typed columns, in two loads: the second brings
    decimals to a column of integers and words to another, and both widen."""
    import uuid

    from tarn.operators.attributes import load_attributes, profile_table
    from tarn.operators.snapshots import SnapshotTable
    from tarn.session import scratch_dir
    kv = q_metadata(spark, sf)
    event = kv.where("name = 'EventId'").select("id", F.col("value").alias("e"), (F.col("value").cast("long") % 2 == 0).alias("even"))
    number = F.col("e").cast("long")
    depth = F.concat((number % 100).cast("string"), F.when(F.col("even"), F.lit("")).otherwise(F.lit(".5")))
    label = F.concat(F.when(F.col("even"), F.lit("")).otherwise(F.lit("T")), F.col("e"))
    more = event.select("id", "even", F.explode(F.create_map(F.lit("EventId"), F.col("e"), F.lit("Depth"), depth, F.lit("Tag"), label)).alias("name", "value"))
    rest = kv.where("name <> 'EventId'").join(event.select("id", "even"), "id").select("id", "even", "name", "value")
    whole = more.unionByName(rest)
    base = scratch_dir(spark, f"attributes-{uuid.uuid4().hex}")
    table, profiles = SnapshotTable(spark, f"{base}/table"), profile_table(spark, f"{base}/profiles")
    load_attributes(whole.where("even").drop("even"), table, profiles, "2024-01-01 00:00:00", "first")
    load_attributes(whole.where("NOT even").drop("even"), table, profiles, "2024-01-02 00:00:00", "second")
    return table.read().select("id", "EventId", "Props", "Depth", "Tag")


@register("P10_truncate_compat", "SELECT doc_id, left(text, 253) AS text, CAST(length(left(text, 253)) AS INTEGER) AS width FROM documents")
def q_truncate_compat(spark, sf):
    """The reference's cell width, on texts that exceed it."""
    from tarn import schemas as S
    from tarn.functions.values import truncate_cell
    cut = td.table(spark, sf, "documents").select("doc_id", truncate_cell("text", S.CELL_WIDTH).alias("text"))
    return cut.withColumn("width", F.length("text"))


@register("X7_unmatched_counts", "WITH " + O.RECORDS + f""", v AS (
  SELECT *, CASE WHEN value LIKE '<%' THEN 'less_than_' || substr(value, 2)
                 WHEN value LIKE '>%' THEN 'greater_than_' || substr(value, 2) ELSE value END AS pv FROM enriched)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE lawasiteid IS NULL) AS unmatched_sites,
  count(*) FILTER (WHERE lawaname IS NULL) AS unmatched_variables,
  count(*) FILTER (WHERE pv IS NOT NULL AND pv NOT LIKE '%than_%' AND pv NOT IN ('None', 'missing', 'NA', '*', '')
                   AND NOT regexp_matches(pv, '{O.NUMERIC_RE}')) AS rejected_values
FROM v""")
def q_unmatched(spark, sf):
    from tarn.operators.records import enrich, unmatched_counts
    return unmatched_counts(enrich(td.observations(spark, sf), td.sites_latest(spark, sf), td.transfer_table(spark, sf)))


@register("P13_capped_sites", "WITH " + O.SITES + """
SELECT council, councilsiteid FROM sites
QUALIFY row_number() OVER (PARTITION BY council ORDER BY councilsiteid) <= 5""")
def q_capped(spark, sf):
    from tarn.operators.manifest import cap_sites
    return cap_sites(td.sites_latest(spark, sf).select("council", "councilsiteid"), 5)


A9_COLS = ["id", "t", "site", "lawasiteid", "lawaname", "variable", "value", "error", "status_code",
           "url", "council", "created_at"]
A9_SQL = "WITH " + O.RECORDS + ", w AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, max(length(CAST({c} AS VARCHAR))) AS max_length FROM lwq_data"
    for c in A9_COLS) + ") SELECT * FROM w WHERE max_length > 20"


@register("A9_column_widths", A9_SQL)
def q_widths(spark, sf):
    from tarn.operators.records import column_widths
    w = column_widths(td.raw_records(spark, sf).select(*A9_COLS), 20)
    return w.withColumn("max_length", F.col("max_length").cast("long"))


@register("A4_request_counts", "WITH " + O.RECORDS + """
SELECT count(DISTINCT url) AS n_requests, count(*) FILTER (WHERE error IS NOT NULL) AS n_failed
FROM obs""")
def q_counts(spark, sf):
    from tarn.operators.records import request_counts
    return request_counts(td.observations(spark, sf))


@register("A4_observed_load", f"SELECT count(DISTINCT url) AS n_requests, count(*) FILTER (WHERE error IS NOT NULL) AS n_failed FROM ({O.S1}) x")
def q_observed(spark, sf):
    """A4's counts as observed while the landed responses were loaded."""
    import uuid

    from tarn.operators.snapshots import SnapshotTable
    from tarn.plans.loads import load_responses
    from tarn.session import scratch_dir
    table = SnapshotTable(spark, scratch_dir(spark, f"observed-{uuid.uuid4().hex}/lwq_data"))
    counts = load_responses(td.landed_responses(spark, sf), td.sites_latest(spark, sf), td.transfer_table(spark, sf), table, "2024-02-01 00:00:00", "load")
    return spark.createDataFrame([(counts["n_requests"], counts["n_failed"])], "n_requests long, n_failed long")


K8_CUT = "2024-01-20"


K8_BATCH_TS = "2024-03-01 00:00:00"


def _corrected(spark, sf):
    """The raw table before and after a batch of new and corrected records."""
    from tarn.operators.store import upsert
    rec = td.raw_records(spark, sf)
    is_old = F.col("created_at") < F.lit(K8_CUT).cast("timestamp_ntz")
    fixed = F.substring(F.col("id"), -1, 1) == "7"
    old = rec.filter(is_old)
    batch = (rec.filter(~is_old | fixed)
             .withColumn("value", F.when(is_old & fixed, F.lit("42")).otherwise(F.col("value"))).drop("created_at"))
    return old, upsert(old, batch, "id", K8_BATCH_TS)


@register("K8_increment", "WITH " + O.corrected(K8_CUT, K8_BATCH_TS) + f"""
SELECT * FROM cur
WHERE coalesce(updated_at, created_at) >= (SELECT max(created_at) FROM lwq_data WHERE created_at < TIMESTAMP '{K8_CUT}')""")
def q_increment(spark, sf):
    """Records new or corrected since the mart's high-water mark, the mart
    having been built from the loads before K8_CUT."""
    old, current = _corrected(spark, sf)
    return marts.new_since(current, marts.fact_records(old, td.sites_latest(spark, sf), with_clock=False))


@register("K8_mart_merge", "WITH " + O.corrected_facts(K8_CUT, K8_BATCH_TS) + " SELECT * FROM fr")
def q_mart_merge(spark, sf):
    """The mart after its increment: corrected values have reached it."""
    old, current = _corrected(spark, sf)
    sites = td.sites_latest(spark, sf)
    mart = marts.fact_records(old, sites, with_clock=False)
    return marts.merge_mart(mart, marts.fact_records(marts.new_since(current, mart), sites, with_clock=False))


@register("K10_daily_diagnostics", A2_SQL.replace(O.fact_records(), O.corrected_facts(K8_CUT, K8_BATCH_TS)))
def q_daily(spark, sf):
    """Daily diagnostics of the first loads, then the days that the next
    batch touches replaced."""
    old, current = _corrected(spark, sf)
    sites = td.sites_latest(spark, sf)
    facts_old, facts_now = (marts.fact_records(r, sites, with_clock=False) for r in (old, current))
    touched = (marts.new_since(current, facts_old).select(F.to_date("created_at").alias("__d")).distinct())
    from tarn.operators.joins import few_rows
    fresh = facts_now.join(few_rows(touched), F.to_date("data_created_at") == F.col("__d"), "left_semi")
    out = marts.accumulate_daily(marts.fact_summary_errors(facts_old), marts.fact_summary_errors(fresh))
    return out.withColumn("variables", F.array_join("variables", ","))


def _versions(spark, sf):
    """The raw table in two versions: the loads before K8_CUT, then the
    batch of new and corrected records."""
    import uuid

    from tarn.operators.snapshots import SnapshotTable
    from tarn.session import scratch_dir
    rec = td.raw_records(spark, sf)
    is_old, fixed = F.col("created_at") < F.lit(K8_CUT).cast("timestamp_ntz"), F.substring(F.col("id"), -1, 1) == "7"
    table = SnapshotTable(spark, scratch_dir(spark, f"versions-{uuid.uuid4().hex}/lwq_data"))
    first = table.replace(rec.filter(is_old), K8_CUT)
    batch = (rec.filter(~is_old | fixed)
             .withColumn("value", F.when(is_old & fixed, F.lit("42")).otherwise(F.col("value"))).drop("created_at"))
    return table, first, table.upsert(batch, K8_BATCH_TS, "correction", compact=False)


@register("A1_incremental", A1_SQL.replace(O.fact_records(), O.corrected_facts(K8_CUT, K8_BATCH_TS)))
def q_summary_incremental(spark, sf):
    """A1 from its state before the batch and the batch's changes."""
    from tarn.plans import increments as inc
    table, first, last = _versions(spark, sf)
    sites = td.sites_latest(spark, sf)
    facts = lambda r: marts.fact_records(r, sites, with_clock=False)
    old, new = inc.fact_changes(table.changes(first, last), facts)
    state = inc.update_summary(inc.summary_state(facts(table.read(first)), sites), old, new, sites, facts(table.read(last)))
    return inc.summary_of(state).withColumn("average_value", F.round("average_value", 6))


@register("K10_incremental", A2_SQL.replace(O.fact_records(), O.corrected_facts(K8_CUT, K8_BATCH_TS)))
def q_daily_incremental(spark, sf):
    """A2 from its state before the batch and the batch's changes: distinct
    sites merge as bitmaps."""
    from tarn.plans import increments as inc
    table, first, last = _versions(spark, sf)
    sites = td.sites_latest(spark, sf)
    facts = lambda r: marts.fact_records(r, sites, with_clock=False)
    numbers = inc.number_sites(sites)
    old, new = inc.fact_changes(table.changes(first, last), facts)
    state = inc.update_daily(inc.daily_state(facts(table.read(first)), numbers), old, new, numbers, facts(table.read(last)))
    return inc.daily_of(state).withColumn("variables", F.array_join("variables", ","))


@register("K2_append_log", """
SELECT event_id, ts, user_id, event_type, value, TIMESTAMP '2024-01-15 00:00:00' AS created_at FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, TIMESTAMP '2024-02-15 00:00:00' FROM events""")
def q_append_log(spark, sf):
    """Two loads appended to a log, each with its time; the second brings
    the first one's rows again, and a log keeps both."""
    import uuid

    from tarn.operators.store import append, read
    from tarn.session import scratch_dir
    path = scratch_dir(spark, f"log-{uuid.uuid4().hex}/log")
    ev = td.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    append(ev.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")), path, "2024-01-15 00:00:00", partition="event_type")
    append(ev, path, "2024-02-15 00:00:00", partition="event_type")
    return read(spark, path)


@register("P1_in_councils", "WITH " + O.SITES + " SELECT * FROM sites WHERE lower(council) IN ('nation_1', 'nation_12')")
def q_in_councils(spark, sf):
    """Sites of the councils asked for, in whatever case they are written."""
    from tarn.operators.sites import in_councils
    upper = td.sites_latest(spark, sf).withColumn("__c", F.upper("council"))
    return in_councils(upper, ["Nation_1", "NATION_12"], "__c").drop("__c")


@register("P18_select_rename", """
SELECT event_id AS id, ts AS datetime, event_type AS name, value AS temperature FROM events""")
def q_select_rename(spark, sf):
    """Events as flattened records of a weather API: its fields, renamed."""
    from tarn.operators.projection import WEATHER_FIELDS, select_rename
    api = td.table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("dt"), F.col("event_type").alias("name"),
                                               F.col("value").alias("main.temp"), F.col("user_id").alias("sys.id"))
    return select_rename(api, WEATHER_FIELDS)


@register("S8_csv_column", "SELECT CAST(c_name AS VARCHAR) AS c_name FROM customer")
def q_csv_column(spark, sf):
    """One text column of customers that were landed as headed CSV."""
    import uuid

    from tarn.session import scratch_dir
    from tarn.sources.files import read_csv_column
    path = scratch_dir(spark, f"csv-{uuid.uuid4().hex}/customer")
    td.table(spark, sf, "customer").select("c_name", "c_mktsegment", "c_acctbal").write.option("header", True).csv(path)
    return read_csv_column(spark, path, "c_name")


@register("K3_replace_slice", "WITH " + O.SITES + ", gml AS (" + O.S3 + """),
batch AS (SELECT *, 'yes' AS lawa_site, TIMESTAMP '2024-01-01 00:00:00' AS created_at
          FROM gml WHERE lower(lwquality) IN ('y', 'yes', 'true'))
SELECT * FROM sites WHERE lower(council) NOT IN (SELECT DISTINCT lower(council) FROM batch)
UNION ALL SELECT * FROM batch""")
def q_replace_slice(spark, sf):
    """The lwq site table after a catalog load of the GML councils."""
    from tarn.operators.sites import route_module
    from tarn.operators.store import replace_slice
    from tarn.sources.catalog import parse_catalog
    batch = route_module(parse_catalog(td.landed_catalogs(spark, sf)), "lwq",
                         loaded_at=F.lit(td.CATALOG_TS).cast("timestamp_ntz"))
    return replace_slice(td.sites_latest(spark, sf), batch)


# --- streaming ----------------------------------------------------------------

STREAM_LATE_BEFORE = "2024-01-15"


@register("T1_T3_streaming_ingest", "WITH " + O.STREAMED + """
SELECT id, t, site, lawasiteid, lawaname, variable, value, error, status_code, url, council FROM lwq_data""")
def q_streaming(spark, sf):
    """Landed responses arrive in two waves, the older days second; the
    stream ingests each wave as it lands (no watermark) and the table
    ends with every record of both."""
    import uuid

    from tarn.session import scratch_dir
    from tarn.streaming.ingest import ingest
    base = scratch_dir(spark, f"stream-{uuid.uuid4().hex}")
    land, table, hist, ck = (f"{base}/{n}" for n in ("landing", "lwq_data", "history", "checkpoint"))
    landed = td.landed_responses(spark, sf)
    sites, transfer = td.sites_latest(spark, sf), td.transfer_table(spark, sf)
    late = F.col("date_start") < STREAM_LATE_BEFORE
    landed.filter(~late).write.mode("append").parquet(land)
    ingest(spark, land, table, hist, ck, sites, transfer, batch_ts="2024-02-01 00:00:00")
    landed.filter(late).write.mode("append").parquet(land)
    ingest(spark, land, table, hist, ck, sites, transfer, batch_ts="2024-02-02 00:00:00")
    from tarn.operators.store import read
    return read(spark, table).select("id", "t", "site", "lawasiteid", "lawaname", "variable",
                                            "value", "error", "status_code", "url", "council")


WAVES = ("2024-02-01 06:00:00", "2024-02-02 06:00:00")      # load times of the two waves


@register("T1_stream_diagnostics", A2_SQL.replace(O.RECORDS, O.STREAMED.replace("CAST(NULL AS TIMESTAMP) AS created_at", f"""
    CASE WHEN regexp_extract(x.url, 'From=([0-9-]+)', 1) < '{STREAM_LATE_BEFORE}' THEN TIMESTAMP '{WAVES[1]}' ELSE TIMESTAMP '{WAVES[0]}' END AS created_at""")))
def q_stream_diagnostics(spark, sf):
    """A2 kept by a stateful stream over two waves of landed responses, the
    older periods second, and a restart with nothing new."""
    import uuid

    from tarn.plans.increments import number_sites
    from tarn.session import scratch_dir
    from tarn.streaming.diagnostics import diagnostics_table, read_diagnostics, stream_diagnostics
    base = scratch_dir(spark, f"diagnostics-{uuid.uuid4().hex}")
    landed = td.landed_responses(spark, sf)
    sites, transfer = td.sites_latest(spark, sf), td.transfer_table(spark, sf)
    number_sites(sites).write.parquet(f"{base}/numbers")      # kept: a site's number must not change
    numbers = spark.read.parquet(f"{base}/numbers")
    table = diagnostics_table(spark, f"{base}/table")
    late = F.col("date_start") < STREAM_LATE_BEFORE
    for ts, part in ((WAVES[0], ~late), (WAVES[1], late), (WAVES[1], None)):
        if part is not None:
            landed.where(part).withColumn("created_at", F.lit(ts).cast("timestamp_ntz")).write.mode("append").parquet(f"{base}/landing")
        stream_diagnostics(spark, f"{base}/landing", table, f"{base}/checkpoint", sites, transfer, numbers, ts)
    return read_diagnostics(table).withColumn("variables", F.array_join("variables", ","))
