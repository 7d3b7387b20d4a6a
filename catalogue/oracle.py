"""The registered queries as SQL over the same tables, for comparison in another engine.

``VIEWS`` defines the adapter views in SQL; each statement names the views it needs.
"""

from __future__ import annotations

COST_DAY, UNIT_DAY, MONTH_START = "DATE '1998-05-20'", "DATE '2024-01-20'", "DATE '1998-05-01'"
NOW = "2024-01-31 12:00:00.000000"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

VIEWS = {
    "cost_days": """
        SELECT n_name AS service, CAST(l_shipdate AS DATE) AS usage_date,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(18,4)) AS cost_usd,
               CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,4)) AS usage_quantity
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY 1, 2""",
    "query_rows": f"""
        SELECT CAST(event_id AS VARCHAR) AS query_id, event_id, 'WH_' || upper(event_type) AS warehouse, ts,
               CAST(ts AS DATE) AS usage_date, CAST(value AS DECIMAL(18,4)) AS ms, {_K} AS k,
               CASE WHEN {_K} % 4 = 2 THEN 'SHOW' ELSE 'SELECT' END AS query_type,
               CASE WHEN {_K} % 16 = 0 THEN 'SELECT ' || repeat('some_column, ', 50) || 'a FROM SNOWFLAKE_SAMPLE_DATA.T' || {_K}
                    WHEN {_K} % 16 = 8 THEN 'SELECT ' || repeat('some_column, ', 50) || 'a FROM SNOWFLAKE_SAMPLE_DATA.T' || {_K} || ' WHERE x = ' || (event_id % 3)
                    WHEN {_K} % 4 = 0 THEN 'SELECT * FROM SNOWFLAKE_SAMPLE_DATA.T' || {_K}
                    WHEN {_K} % 4 = 1 THEN 'SELECT a FROM SNOWFLAKE_SAMPLE_DATA.T' || {_K} || ' where x = 1'
                    WHEN {_K} % 4 = 2 THEN 'SHOW TABLES'
                    ELSE 'SELECT CURRENT_USER() FROM dual' END AS query_text,
               CASE WHEN event_id % 10 = 0 THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
               CASE WHEN {_K} % 5 <> 0 THEN CAST((event_id % 1000) * 1024 AS DOUBLE) END AS bytes_scanned
        FROM events""",
    "metering": """
        SELECT 'WH_' || upper(event_type) AS warehouse, date_trunc('hour', ts) AS started,
               CAST(SUM(CAST(value AS DECIMAL(12,2))) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS credits
        FROM events GROUP BY 1, 2""",
    # cost in ten-thousandths of a dollar: thousandths per hour * nodes * ms / 360000
    "jobs": """
        SELECT *, CASE WHEN run_ms > 0 AND node_type IS NOT NULL THEN
                 CAST(((rate_milli + 150) * (workers + 1) * run_ms + 180000) // 360000 AS DECIMAL(18,4)) / 10000 END AS cost_number,
               CAST((run_ms + 180) // 360 AS DECIMAL(18,4)) / 10000 AS hours_number
        FROM (SELECT *, CASE node_type WHEN 'i3.xlarge' THEN 312 WHEN 'm5.large' THEN 96 WHEN 'r5.xlarge' THEN 252 ELSE 200 END AS rate_milli
              FROM (SELECT o_custkey AS job_id, o_orderkey AS run_id, 'job_' || (o_custkey % 40) AS run_name,
                           CAST(o_orderdate AS TIMESTAMP) AS started, (o_orderkey % 7200) * 1000 AS run_ms, o_orderkey % 8 AS workers,
                           substring(o_orderpriority, 1, 1) AS priority, o_orderstatus AS state,
                           CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'i3.xlarge' WHEN '2' THEN 'm5.large'
                                WHEN '3' THEN 'r5.xlarge' WHEN '4' THEN 'x9.custom' END AS node_type
                    FROM orders))""",
    "records": f"""
        SELECT 'aws' AS source, 'cost_explorer_daily_service' AS resource_type, usage_date || '::' || service AS resource_id,
               CAST(NULL AS VARCHAR) AS account_identifier, usage_date, CAST(NULL AS TIMESTAMP) AS period_start,
               CAST(NULL AS TIMESTAMP) AS period_end, service, cost_usd, 'billed' AS cost_basis, usage_quantity,
               'items' AS usage_unit, CAST(NULL AS VARCHAR) AS query_type, CAST(NULL AS VARCHAR) AS execution_status,
               CAST(NULL AS VARCHAR) AS query_text_preview, CAST(NULL AS VARCHAR) AS node_type_id, CAST(NULL AS VARCHAR) AS cluster_source,
               CAST(NULL AS VARCHAR) AS life_cycle_state, CAST(NULL AS VARCHAR) AS result_state, CAST(NULL AS DOUBLE) AS bytes_scanned,
               '{NOW}' AS ingested_at
        FROM cost_days
        UNION ALL
        SELECT 'aws', 'cost_forecast', '1998-05-21::1998-06-01', NULL, DATE '1998-05-21', TIMESTAMP '1998-05-21', TIMESTAMP '1998-06-01',
               NULL, CAST(total * age AS DECIMAL(18,4)), 'forecast', NULL, 'USD', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               CASE age WHEN 2 THEN '{NOW}' ELSE '2024-01-30 12:00:00.000000' END
        FROM (SELECT SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM lineitem
              WHERE CAST(l_shipdate AS DATE) BETWEEN {MONTH_START} AND {COST_DAY}) CROSS JOIN (VALUES (1), (2)) AS ages(age)
        UNION ALL
        SELECT 'snowflake', 'query', query_id, warehouse, usage_date, ts, ts + to_seconds(event_id % 60), warehouse, NULL, NULL, ms, 'milliseconds',
               query_type, execution_status, left(query_text, 500), NULL, NULL, NULL, NULL, bytes_scanned, '{NOW}'
        FROM query_rows
        UNION ALL
        SELECT 'snowflake', 'warehouse_metering_hour', warehouse || '::' || strftime(started, '%Y-%m-%dT%H:%M:%S') || '+00:00', warehouse,
               CAST(started AS DATE), started, started + to_hours(1), warehouse, NULL, NULL, credits, 'credits',
               NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{NOW}'
        FROM metering
        UNION ALL
        SELECT 'databricks', 'job_run', CAST(run_id AS VARCHAR), CAST(job_id AS VARCHAR), CAST(started AS DATE), started,
               CASE WHEN run_ms > 0 THEN started + to_milliseconds(run_ms) END, run_name, CAST(cost_number AS DECIMAL(18,4)),
               CASE WHEN cost_number IS NOT NULL THEN 'estimated_list_price' END, CAST(hours_number AS DECIMAL(18,4)), 'cluster_hours',
               NULL, NULL, NULL, node_type, CASE WHEN node_type IS NULL THEN 'no_cluster_info_available' ELSE 'job_new_cluster' END,
               'TERMINATED', state, NULL, '{NOW}'
        FROM jobs""",
    "events_all": """
        SELECT *, coalesce(service, account_identifier, resource_id) AS attribution_key,
               CASE WHEN source = 'aws' THEN 'service' WHEN resource_type = 'query' THEN 'query'
                    WHEN resource_type = 'warehouse_metering_hour' THEN 'warehouse' WHEN source = 'databricks' THEN 'job' ELSE 'other' END AS attribution_kind
        FROM records""",
    "flat": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS resource_id, 'SVC_' || l_suppkey AS service, CAST(l_shipdate AS DATE) AS usage_date,
               CASE WHEN l_linenumber <> 7 THEN
                    CASE WHEN l_suppkey % 3 = 0
                         THEN CAST((l_suppkey % 40 + 1) * 0.25 + CASE WHEN l_suppkey % 6 = 0 AND (l_orderkey + l_linenumber) % 499 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4))
                         ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) END END AS cost_usd
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "by_source_date": """
        SELECT source, usage_date, SUM(cost_usd) AS cost_usd_total, COUNT(*) AS record_count, COUNT(cost_usd) AS records_with_cost,
               coalesce(string_agg(DISTINCT cost_basis, ',' ORDER BY cost_basis), '') AS cost_bases_present
        FROM events_all GROUP BY 1, 2""",
    "by_attribution": """
        SELECT source, attribution_kind, attribution_key, usage_date, SUM(cost_usd) AS cost_usd_total,
               coalesce(string_agg(DISTINCT cost_basis, ',' ORDER BY cost_basis), '') AS cost_bases_present,
               SUM(usage_quantity) AS usage_quantity_total, MIN(usage_unit) AS usage_unit, COUNT(*) AS record_count
        FROM events_all GROUP BY 1, 2, 3, 4""",
    "table_names": """
        SELECT * FROM (VALUES ('aws', 'cost_and_usage', 'cost_explorer_daily_service'), ('aws', 'cost_forecast', 'cost_forecast'),
            ('aws', 'service_dimension_values', 'service_dimension_value'), ('snowflake', 'query_history', 'query'),
            ('snowflake', 'warehouse_metering_history', 'warehouse_metering_hour'), ('databricks', 'job_runs', 'job_run')) AS t(source, "table", resource_type)""",
    "counted": """
        SELECT n.source, n."table", COUNT(r.source) AS record_count
        FROM table_names n LEFT JOIN records r ON r.source = n.source AND r.resource_type = n.resource_type GROUP BY 1, 2""",
    "daily_actuals": """
        SELECT source, usage_date, SUM(cost_usd) AS cost_usd_day FROM events_all
        WHERE cost_basis IN ('billed', 'estimated_list_price') AND cost_usd IS NOT NULL GROUP BY 1, 2""",
    "service_actuals": "SELECT service AS source, usage_date, cost_usd AS cost_usd_day FROM cost_days",
}

_NEEDS = {
    "records": ("cost_days", "query_rows", "metering", "jobs"),
    "events_all": ("records",),
    "by_source_date": ("events_all",),
    "by_attribution": ("events_all",),
    "counted": ("records", "table_names"),
    "daily_actuals": ("events_all",),
    "service_actuals": ("cost_days",),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            visit(need)
        if name not in seen:
            seen.append(name)

    for name in names:
        visit(name)
    return seen


def sql(body: str, *views: str, **extra: str) -> str:
    """``body`` under the named views and further ones given as ``name="select ..."``."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in _closure(views)]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _scores(source: str, keys: str, value: str, least: int = 5, where: str = "TRUE") -> dict[str, str]:
    """Leave-one-out scores as a chain of views ending in ``scored``; x is the value.

    Wide decimals become doubles by way of text, which rounds once and correctly.
    """
    return {
        "s0": f"SELECT *, CAST({value} AS DECIMAL(19,4)) AS x FROM {source} WHERE {where}",
        "s1": f"SELECT *, COUNT(x) OVER w AS n, SUM(x) OVER w AS t, SUM(x * x) OVER w AS q FROM s0 WINDOW w AS (PARTITION BY {keys})",
        "s2": """SELECT *, CASE WHEN x IS NOT NULL THEN n - 1 END AS group_n_other,
                 CASE WHEN n > 1 THEN CAST(CAST(t - x AS VARCHAR) AS DOUBLE) / (n - 1) END AS baseline_mean,
                 CASE WHEN n > 1 THEN CAST(CAST(q - x * x AS VARCHAR) AS DOUBLE) / (n - 1) END AS e2 FROM s1""",
        "s3": "SELECT *, CASE WHEN baseline_mean IS NOT NULL THEN sqrt(greatest(e2 - baseline_mean * baseline_mean, 0e0)) END AS baseline_stddev FROM s2",
        "s4": f"""SELECT *, CASE WHEN group_n_other >= {least} THEN
                  CASE WHEN baseline_stddev > 1e-12 THEN (CAST(x AS DOUBLE) - baseline_mean) / baseline_stddev
                       WHEN CAST(x AS DOUBLE) > baseline_mean THEN CAST('Infinity' AS DOUBLE) ELSE 0e0 END END AS z_score FROM s3""",
        "s5": """SELECT *, CASE WHEN x IS NULL THEN 'no_value' WHEN z_score IS NULL THEN 'insufficient_baseline'
                 WHEN z_score > 3 THEN 'anomaly' ELSE 'normal' END AS status FROM s4""",
        "scored": "SELECT *, status = 'anomaly' AS anomaly FROM s5",
    }


_SCORE_COLUMNS = "CAST(group_n_other AS BIGINT) AS group_n_other, baseline_mean, baseline_stddev, z_score, status, anomaly"
_QUERY_SCORES = _scores("query_rows", "warehouse, usage_date", "ms")
_COST_SCORES = _scores("by_attribution", "source, attribution_key", "cost_usd_total")
# the same chain under other names, to have both in one statement
_COST_SCORES_B = {
    f"c_{k}": v.replace("FROM s", "FROM c_s") for k, v in _COST_SCORES.items()
}


def _forecast(daily: str, keys: str, day: str) -> dict[str, str]:
    """Forecast as a chain of views ending in ``fitted``; ``keys`` may be empty."""
    part = f"PARTITION BY {keys} " if keys else ""
    select = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else "HAVING COUNT(*) > 0"
    return {
        "f0": f"SELECT * FROM {daily} WHERE usage_date BETWEEN date_trunc('month', {day}) AND {day}",
        "f1": f"""SELECT *, CAST(day(usage_date) AS DECIMAL(9,0)) AS d,
                  CAST(SUM(cost_usd_day) OVER ({part}ORDER BY usage_date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(27,4)) AS cumulative FROM f0""",
        "f2": f"""SELECT {select}COUNT(DISTINCT usage_date) AS days_observed, SUM(cost_usd_day) AS total_so_far, COUNT(*) AS n,
                  CAST(SUM(d) AS BIGINT) AS sx, CAST(SUM(d * d) AS BIGINT) AS sxx, CAST(SUM(cumulative) AS DECIMAL(27,4)) AS sy,
                  CAST(SUM(CAST(cumulative AS DECIMAL(25,4)) * d) AS DECIMAL(27,4)) AS sxy,
                  CAST(day(last_day({day})) AS BIGINT) AS days_in_month FROM f1 {group}""",
        "f3": f"""SELECT *, n * sxx - sx * sx AS spread, CAST(n AS DECIMAL(9,0)) * sxy - CAST(sx AS DECIMAL(9,0)) * sy AS rise,
                  CAST(sxx AS DECIMAL(9,0)) * sy - CAST(sx AS DECIMAL(9,0)) * sxy AS base FROM f2""",
        "f4": f"""SELECT *, CASE WHEN spread > 0 THEN CAST(CAST(rise AS VARCHAR) AS DOUBLE) / spread END AS trend_slope_per_day,
                  CASE WHEN spread > 0 THEN CAST(CAST(base AS VARCHAR) AS DOUBLE) / spread END AS trend_intercept FROM f3""",
        "fitted": f"""SELECT {select}days_observed, CAST(total_so_far AS DOUBLE) AS total_so_far, trend_slope_per_day, trend_intercept, days_in_month,
                  CAST(total_so_far AS DOUBLE) / days_observed AS run_rate_per_day,
                  CAST(total_so_far AS DOUBLE) / days_observed * days_in_month AS run_rate_month_end_projection,
                  CASE WHEN days_observed >= 2 THEN trend_intercept + trend_slope_per_day * days_in_month END AS trend_month_end_projection,
                  'ok' AS status, CASE WHEN days_observed >= 7 THEN 'high' WHEN days_observed >= 3 THEN 'medium' ELSE 'low' END AS confidence FROM f4""",
    }


_FITTED = """days_observed, total_so_far, trend_slope_per_day, trend_intercept, days_in_month, run_rate_per_day,
    run_rate_month_end_projection, trend_month_end_projection, status, confidence"""
# a double rounded half up by its shortest text
_CUMULATIVE = "CAST(CAST(CAST(CAST(run_rate_per_day * d.day AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR) AS DOUBLE)"


def _native(day: str) -> str:
    return f"""SELECT source, usage_unit, COUNT(DISTINCT usage_date) AS days_observed, CAST(SUM(usage_quantity) AS DOUBLE) AS total_so_far,
        CAST(SUM(usage_quantity) AS DOUBLE) / COUNT(DISTINCT usage_date) AS run_rate_per_day, CAST(day(last_day({day})) AS BIGINT) AS days_in_month,
        CAST(SUM(usage_quantity) AS DOUBLE) / COUNT(DISTINCT usage_date) * day(last_day({day})) AS run_rate_month_end_projection
        FROM events_all WHERE cost_usd IS NULL AND usage_quantity IS NOT NULL AND usage_unit IS NOT NULL
          AND usage_date BETWEEN date_trunc('month', {day}) AND {day} GROUP BY 1, 2"""


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


_IDS = "array_to_string(list_sort(list_distinct(list(query_id)))[1:3], '{sep}')"
_WORKLOAD = """query_type = 'SELECT' AND contains(query_text, 'FROM') AND NOT (starts_with(query_text, 'SELECT CURRENT_USER')
    OR starts_with(query_text, 'SELECT is_database_role_in_session') OR starts_with(query_text, 'SELECT SYSTEM$') OR starts_with(query_text, 'SHOW '))"""
_UNFILTERED = "query_type = 'SELECT' AND contains(query_text, 'FROM') AND contains(query_text, 'SNOWFLAKE_SAMPLE_DATA') AND NOT contains(upper(query_text), 'WHERE')"
_FLAT_GROUPS = """SELECT service, COUNT(DISTINCT usage_date) AS days_observed, CAST(SUM(cost_usd) AS DOUBLE) AS cost_total,
    round(CAST(SUM(cost_usd) AS DOUBLE) / COUNT(cost_usd), 4) AS cost_avg
    FROM flat WHERE cost_usd > 0 GROUP BY service HAVING COUNT(DISTINCT usage_date) >= 7 AND MAX(cost_usd) = MIN(cost_usd)"""
_SUGGESTIONS = {
    "suggestions": f"""
        SELECT 'repeated_identical_query' AS rule_id, 'snowflake' AS source, warehouse AS attribution_key, {_IDS.format(sep=", ")} AS resource_ids_sample, 'yes' AS quantified
        FROM query_rows WHERE {_WORKLOAD} GROUP BY warehouse, query_text HAVING COUNT(*) >= 3
        UNION ALL SELECT 'unfiltered_table_scan', 'snowflake', warehouse, {_IDS.format(sep=", ")}, 'no' FROM query_rows WHERE {_UNFILTERED} GROUP BY warehouse, query_text
        UNION ALL SELECT 'idle_flat_cost_resource', 'aws', service, NULL, 'yes' FROM ({_FLAT_GROUPS})
        UNION ALL SELECT 'idle_flat_cost_resource', 'aws', service, NULL, 'yes' FROM cost_days WHERE cost_usd > 0
            GROUP BY service HAVING COUNT(DISTINCT usage_date) >= 7 AND MAX(cost_usd) = MIN(cost_usd)
        UNION ALL SELECT 'databricks_cost_visibility_gap', 'databricks', CAST(job_id AS VARCHAR), CAST(run_id AS VARCHAR), 'no' FROM jobs WHERE cost_number IS NULL"""
}

_RECORD_TAIL = """CAST(cost_usd AS DOUBLE) AS cost_usd, cost_basis, CAST(usage_quantity AS DOUBLE) AS usage_quantity, usage_unit"""

_RUNS = {
    "cluster_rows": """SELECT 'c-' || c_custkey AS cluster_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'c5.xlarge' ELSE 'm4.large' END AS node_type_id,
        CAST(c_nationkey % 8 AS BIGINT) AS num_workers FROM customer WHERE c_custkey % 5 <> 0""",
    "resolved": """SELECT j.run_id, j.job_id, j.run_name, j.run_ms, j.state, j.priority,
        CASE WHEN j.run_id % 11 <> 0 THEN j.started ELSE TIMESTAMP '2024-01-31 12:00:00' END AS began,
        CASE WHEN priority IN ('1', '2', '3') THEN node_type WHEN priority = '4' THEN c.node_type_id END AS node_type_id,
        CASE WHEN priority IN ('1', '2', '3') THEN workers WHEN priority = '4' THEN c.num_workers END AS num_workers,
        CASE WHEN priority IN ('1', '2') THEN 'job_new_cluster' WHEN priority = '3' THEN 'task_new_cluster'
             WHEN priority = '4' AND c.cluster_id IS NOT NULL THEN 'existing_cluster_lookup' WHEN priority = '4' THEN 'cluster_lookup_failed'
             ELSE 'no_cluster_info_available' END AS cluster_source,
        CASE WHEN priority = '4' THEN 'c-' || job_id END AS cluster_id
        FROM jobs j LEFT JOIN cluster_rows c ON j.priority = '4' AND c.cluster_id = 'c-' || j.job_id""",
    "priced": """SELECT *, CASE WHEN run_ms > 0 AND node_type_id IS NOT NULL THEN CAST(((CASE node_type_id WHEN 'i3.xlarge' THEN 312 WHEN 'm5.large' THEN 96
            WHEN 'r5.xlarge' THEN 252 WHEN 'c5.xlarge' THEN 170 WHEN 'm4.large' THEN 100 ELSE 200 END + 150) * (num_workers + 1) * run_ms + 180000) // 360000 AS DOUBLE) / 10000 END AS cost_usd,
        CAST((run_ms + 180) // 360 AS DOUBLE) / 10000 AS hours FROM resolved""",
}

_OPTIONS = {
    "spend": """SELECT DISTINCT source, attribution_kind,
        CASE WHEN resource_type = 'query' AND CAST(resource_id AS BIGINT) % 100 = 0 THEN resource_id ELSE attribution_key END AS attribution_key
        FROM (SELECT *, CASE WHEN resource_type = 'query' THEN resource_id END AS q FROM events_all WHERE resource_type = 'query'
              UNION ALL SELECT *, NULL FROM events_all WHERE resource_type <> 'query')""",
    "options": """SELECT s.source, attribution_kind, attribution_key,
        CASE WHEN q.query_text IS NULL THEN attribution_key WHEN length(q.query_text) > 60 THEN substring(q.query_text, 1, 60) || '...' ELSE q.query_text END AS label
        FROM spend s LEFT JOIN query_rows q ON q.query_id = s.attribution_key""",
}

_BILLING = """SELECT usage_date, CASE WHEN service LIKE 'U%' THEN 'UNKNOWN' ELSE service END AS shown, cost_usd,
    CASE WHEN service <> 'FRANCE' THEN usage_quantity END AS usage_quantity FROM cost_days"""


def _money_text(number: str) -> str:
    """Fixed-point money text from a decimal: thousands separators, two decimals."""
    return f"format('{{:,.2f}}', CAST({number} AS DOUBLE))"


ORACLE: dict[str, str] = {
    # --- rollups and enrichment
    "spend_by_source_date": sql(
        "SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_total AS DOUBLE) AS cost_usd_total, record_count, records_with_cost, cost_bases_present FROM by_source_date",
        "by_source_date",
    ),
    "spend_by_attribution": sql(
        """SELECT source, attribution_kind, attribution_key, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_total AS DOUBLE) AS cost_usd_total,
           cost_bases_present, CAST(usage_quantity_total AS DOUBLE) AS usage_quantity_total, usage_unit, record_count FROM by_attribution""",
        "by_attribution",
    ),
    "spend_actual_only": sql(
        """SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd_total, COUNT(*) AS record_count, COUNT(cost_usd) AS records_with_cost,
           coalesce(string_agg(DISTINCT cost_basis, ',' ORDER BY cost_basis), '') AS cost_bases_present FROM events_all WHERE resource_type <> 'cost_forecast' GROUP BY 1, 2""",
        "events_all",
    ),
    "enrich_metadata": sql(
        """SELECT resource_type, resource_id, ingested_at, attribution_key, attribution_kind, query_type, execution_status, query_text_preview, node_type_id,
           cluster_source, life_cycle_state, result_state, bytes_scanned FROM events_all""",
        "events_all",
    ),
    "metadata_json": sql(
        """SELECT query_id AS resource_id, CASE WHEN event_id % 50 <> 0 THEN query_type END AS query_type,
           CASE WHEN event_id % 50 <> 0 THEN bytes_scanned END AS bytes_scanned, event_id % 50 = 0 AS is_empty FROM query_rows""",
        "query_rows",
    ),
    "row_counts_by_source": sql("SELECT source, COUNT(*) AS record_count FROM records GROUP BY 1", "records"),
    "table_counts": sql('SELECT source, "table", record_count FROM counted', "counted"),
    # --- anomalies
    "anomaly_daily_cost": sql(
        f"SELECT source, attribution_kind, attribution_key, CAST(usage_date AS VARCHAR) AS usage_date, CAST(x AS DOUBLE) AS cost_usd_total, {_SCORE_COLUMNS} FROM scored",
        "by_attribution",
        **_COST_SCORES,
    ),
    "anomaly_null_and_flat": sql(
        f"SELECT resource_id, service, CAST(x AS DOUBLE) AS cost_usd, {_SCORE_COLUMNS} FROM scored",
        "flat",
        **_scores("flat", "service", "cost_usd", least=3),
    ),
    "anomaly_status_counts": sql("SELECT status, COUNT(*) AS n FROM scored GROUP BY 1", "query_rows", **_QUERY_SCORES),
    "anomaly_counts": sql(
        """SELECT COUNT(*) FILTER (WHERE anomaly) AS anomaly_count, COUNT(*) FILTER (WHERE status IN ('normal', 'anomaly')) AS scored_count
           FROM (SELECT anomaly, status FROM scored UNION ALL SELECT anomaly, status FROM c_scored)""",
        "query_rows",
        "by_attribution",
        **_QUERY_SCORES,
        **_COST_SCORES_B,
    ),
    "headline_anomaly": sql(
        "SELECT query_id AS resource_id, warehouse AS account_identifier, z_score FROM scored WHERE anomaly ORDER BY z_score DESC, query_id LIMIT 1",
        "query_rows",
        **_QUERY_SCORES,
    ),
    "anomaly_top12": sql(
        "SELECT query_id AS resource_id, CAST(usage_date AS VARCHAR) AS usage_date, z_score, status FROM scored ORDER BY z_score DESC NULLS LAST, query_id LIMIT 12",
        "query_rows",
        **_QUERY_SCORES,
    ),
    "anomaly_report": sql(
        """SELECT source_filter, COUNT(*) FILTER (WHERE anomaly) AS anomaly_count, COUNT(*) FILTER (WHERE status IN ('normal', 'anomaly')) AS scored_count
           FROM (SELECT 'snowflake' AS source, anomaly, status FROM scored UNION ALL SELECT source, anomaly, status FROM c_scored)
           JOIN (VALUES ('all'), ('aws'), ('snowflake'), ('databricks')) AS f(source_filter) ON source_filter IN ('all', source) GROUP BY 1""",
        "query_rows",
        "by_attribution",
        **_QUERY_SCORES,
        **_COST_SCORES_B,
    ),
    "notebook_loo_condensed": sql(
        """SELECT query_id AS resource_id, warehouse AS account_identifier, CAST(usage_date AS VARCHAR) AS usage_date, CAST(ms AS DOUBLE) AS usage_quantity, z_score,
           left(query_text, 500) AS query_text_preview FROM scored WHERE group_n_other >= 5 AND baseline_stddev > 1e-12 AND z_score > 3""",
        "query_rows",
        **_QUERY_SCORES,
    ),
    "what_if_score": sql(
        """SELECT query_id AS resource_id, CAST(x * 2 AS DOUBLE) AS what_if_value,
           CASE WHEN baseline_stddev <> 0 THEN (CAST(x * 2 AS DOUBLE) - baseline_mean) / baseline_stddev END AS what_if_z,
           abs(CASE WHEN baseline_stddev <> 0 THEN (CAST(x * 2 AS DOUBLE) - baseline_mean) / baseline_stddev END) >= 3 AS what_if_flagged FROM scored""",
        "query_rows",
        **_QUERY_SCORES,
    ),
    # --- forecasts
    "daily_cost_actuals": sql(
        "SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_day AS DOUBLE) AS cost_usd_day FROM daily_actuals", "daily_actuals"
    ),
    "cumulative_cost": sql(
        """SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_day AS DOUBLE) AS cost_usd_day,
           CAST(SUM(cost_usd_day) OVER (PARTITION BY source ORDER BY usage_date) AS DOUBLE) AS cumulative_cost_usd FROM daily_actuals""",
        "daily_actuals",
    ),
    "cumulative_cost_ties": sql(
        """SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_day AS DOUBLE) AS cost_usd_day,
           CAST(SUM(cost_usd_day) OVER (ORDER BY usage_date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_cost_usd
           FROM daily_actuals""",
        "daily_actuals",
    ),
    "forecast_by_source": sql(f"SELECT source, {_FITTED} FROM fitted", "daily_actuals", **_forecast("daily_actuals", "source", COST_DAY)),
    "forecast_by_group": sql(f"SELECT source, {_FITTED} FROM fitted", "service_actuals", **_forecast("service_actuals", "source", COST_DAY)),
    "forecast_combined": sql(f"SELECT {_FITTED} FROM fitted", "daily_actuals", **_forecast("daily_actuals", "", COST_DAY)),
    "forecast_native_units": sql(
        f"SELECT '2024-01-20' AS as_of, * FROM ({_native(UNIT_DAY)}) UNION ALL SELECT '1998-05-20' AS as_of, * FROM ({_native(COST_DAY)})", "events_all"
    ),
    "forecast_reconciled": sql(
        f"""SELECT source, {_FITTED}, CAST(cost_usd AS DOUBLE) AS aws_native_forecast_usd, {_stamp('period_start')} AS aws_native_forecast_period_start,
            {_stamp('period_end')} AS aws_native_forecast_period_end
            FROM (SELECT f.*, n.cost_usd, n.period_start, n.period_end FROM fitted f
                  CROSS JOIN (SELECT * FROM records WHERE resource_type = 'cost_forecast' ORDER BY ingested_at DESC LIMIT 1) n WHERE f.source = 'aws')""",
        "daily_actuals",
        **_forecast("daily_actuals", "source", COST_DAY),
    ),
    "forecast_series": sql(
        f"""SELECT source, CAST(d.day AS BIGINT) AS day, {_CUMULATIVE} AS cumulative_cost_usd, d.day <= days_observed AS observed
           FROM fitted JOIN (SELECT unnest(range(1, 32)) AS day) d ON d.day <= days_in_month""",
        "service_actuals",
        **_forecast("service_actuals", "source", COST_DAY),
    ),
    "forecast_method_compare": sql(
        """SELECT f.source, CAST(d.day AS BIGINT) AS day, CAST(o.cumulative AS DOUBLE) AS observed_cost_usd, run_rate_per_day * d.day AS run_rate_cost_usd,
           trend_intercept + trend_slope_per_day * d.day AS trend_cost_usd
           FROM fitted f JOIN (SELECT unnest(range(1, 32)) AS day) d ON d.day <= days_in_month
           LEFT JOIN (SELECT source, cumulative, row_number() OVER (PARTITION BY source ORDER BY usage_date) AS day FROM f1) o ON o.source = f.source AND o.day = d.day""",
        "service_actuals",
        **_forecast("service_actuals", "source", COST_DAY),
    ),
    "forecast_report": sql(
        f"""SELECT 'by_source' AS part, COUNT(*) AS n FROM fitted UNION ALL SELECT 'combined', 1
            UNION ALL SELECT 'native_units', COUNT(*) FROM ({_native(COST_DAY)})""",
        "daily_actuals",
        **_forecast("daily_actuals", "source", COST_DAY),
    ),
    "notebook_aws_run_rate": sql(
        f"""SELECT COUNT(DISTINCT usage_date) AS days_observed, CAST(SUM(cost_usd) AS DOUBLE) AS total_so_far, CAST(31 AS BIGINT) AS days_in_month,
            CAST(SUM(cost_usd) AS DOUBLE) / COUNT(DISTINCT usage_date) AS run_rate_per_day,
            CAST(SUM(cost_usd) AS DOUBLE) / COUNT(DISTINCT usage_date) * 31 AS run_rate_month_end_projection
            FROM cost_days WHERE usage_date BETWEEN {MONTH_START} AND {COST_DAY}""",
        "cost_days",
    ),
    # --- rules
    "rule_repeated_query": sql(
        f"""SELECT warehouse AS account_identifier, left(query_text, 500) AS query_text_preview, COUNT(*) AS run_count, CAST(SUM(ms) AS DOUBLE) AS total_ms,
            CAST((CAST(SUM(ms) * 10000 AS HUGEINT) * 20000 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 1e8 AS avg_ms, CAST((200 * (COUNT(*) - 1) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) AS redundant_pct,
            {_IDS.format(sep=",")} AS sample_ids FROM query_rows WHERE {_WORKLOAD} GROUP BY warehouse, query_text HAVING COUNT(*) >= 3""",
        "query_rows",
    ),
    "rule_unfiltered_scan": sql(
        f"""SELECT warehouse AS account_identifier, left(query_text, 500) AS query_text_preview, COUNT(*) AS run_count, SUM(coalesce(bytes_scanned, 0e0)) AS bytes_scanned_total,
            {_IDS.format(sep=",")} AS sample_ids FROM query_rows WHERE {_UNFILTERED} GROUP BY warehouse, query_text""",
        "query_rows",
    ),
    "rule_flat_cost": sql(f"SELECT service, days_observed, cost_avg, cost_total FROM ({_FLAT_GROUPS})", "flat"),
    "rule_cost_visibility_gap": sql(
        """SELECT CAST(job_id AS VARCHAR) AS account_identifier, CAST(run_id AS VARCHAR) AS resource_id, state AS result_state,
           CASE WHEN node_type IS NULL THEN 'no_cluster_info_available' ELSE 'job_new_cluster' END AS cluster_source,
           CASE WHEN run_ms > 0 THEN run_ms // 1000 END AS duration_seconds FROM jobs WHERE cost_number IS NULL""",
        "jobs",
    ),
    "all_suggestions": sql("SELECT * FROM suggestions", "query_rows", "flat", "jobs", "cost_days", **_SUGGESTIONS),
    "suggestion_report": sql(
        """SELECT source_filter, COUNT(source) AS total_count, COUNT(*) FILTER (WHERE quantified = 'yes') AS quantified_count
           FROM (VALUES ('all'), ('aws'), ('snowflake'), ('databricks')) AS f(source_filter) LEFT JOIN suggestions ON source_filter IN ('all', source) GROUP BY 1""",
        "query_rows",
        "flat",
        "jobs",
        "cost_days",
        **_SUGGESTIONS,
    ),
    "notebook_repeated_texts": sql(
        """SELECT warehouse AS account_identifier, left(query_text, 500) AS query_text_preview, COUNT(*) AS run_count, CAST(SUM(ms) AS DOUBLE) AS total_ms
           FROM query_rows WHERE query_type = 'SELECT' AND contains(query_text, 'FROM') GROUP BY warehouse, query_text HAVING COUNT(*) >= 3""",
        "query_rows",
    ),
    # --- normalizers
    "normalize_billing": sql(
        """SELECT 'aws' AS source, 'cost_explorer_daily_service' AS resource_type, usage_date || '::' || shown AS resource_id, CAST(NULL AS VARCHAR) AS account_identifier,
           CAST(usage_date AS VARCHAR) AS usage_date, CAST(NULL AS VARCHAR) AS period_start, CAST(NULL AS VARCHAR) AS period_end, shown AS service,
           CAST(cost_usd AS DOUBLE) AS cost_usd, 'billed' AS cost_basis, CAST(usage_quantity AS DOUBLE) AS usage_quantity,
           CASE WHEN usage_quantity IS NOT NULL THEN 'items' END AS usage_unit, CAST(usage_date + 1 AS VARCHAR) AS metadata_end, CAST(cost_usd AS DOUBLE) AS metadata_amount FROM billing""",
        "cost_days",
        billing=_BILLING,
    ),
    "normalize_forecast": sql(
        """SELECT t.today, 'aws' AS source, 'cost_forecast' AS resource_type, t.first || '::' || t.last AS resource_id, CAST(NULL AS VARCHAR) AS account_identifier,
           t.first AS usage_date, t.first || ' 00:00:00.000000' AS period_start, t.last || ' 00:00:00.000000' AS period_end, CAST(NULL AS VARCHAR) AS service,
           total AS cost_usd, 'forecast' AS cost_basis, CAST(NULL AS DOUBLE) AS usage_quantity, 'USD' AS usage_unit
           FROM (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM lineitem)
           CROSS JOIN (VALUES ('1998-05-20', '1998-05-21', '1998-06-01'), ('1998-05-31', '1998-06-01', '1998-07-01')) AS t(today, first, last)"""
    ),
    "normalize_dimensions": sql(
        """SELECT 'aws' AS source, 'service_dimension_value' AS resource_type, '1998-05-01::1998-05-15::' || service AS resource_id, CAST(NULL AS VARCHAR) AS account_identifier,
           '1998-05-01' AS usage_date, CAST(NULL AS VARCHAR) AS period_start, CAST(NULL AS VARCHAR) AS period_end, service, CAST(NULL AS DOUBLE) AS cost_usd,
           CAST(NULL AS VARCHAR) AS cost_basis, CAST(NULL AS DOUBLE) AS usage_quantity, CAST(NULL AS VARCHAR) AS usage_unit
           FROM (SELECT CASE WHEN service LIKE 'U%' THEN 'UNKNOWN' ELSE service END AS service FROM
                 (SELECT DISTINCT service FROM cost_days WHERE usage_date BETWEEN DATE '1998-05-01' AND DATE '1998-05-15'))""",
        "cost_days",
    ),
    "normalize_query_history": sql(
        f"""SELECT 'snowflake' AS source, 'query' AS resource_type, query_id AS resource_id, warehouse AS account_identifier, CAST(usage_date AS VARCHAR) AS usage_date,
            {_stamp('ts')} AS period_start, {_stamp('ts + to_seconds(event_id % 60)')} AS period_end, warehouse AS service, CAST(NULL AS DOUBLE) AS cost_usd,
            CAST(NULL AS VARCHAR) AS cost_basis, CAST(ms AS DOUBLE) AS usage_quantity, 'milliseconds' AS usage_unit, query_type, execution_status, 'LAKE' AS database_name,
            'PUBLIC' AS schema_name, 'X-Small' AS warehouse_size, left(query_text, 500) AS query_text_preview, bytes_scanned, CAST(event_id % 100 AS DOUBLE) AS rows_produced FROM query_rows""",
        "query_rows",
    ),
    "recent_query_history": sql(
        f"""SELECT query_id AS "QUERY_ID", warehouse AS "WAREHOUSE_NAME", {_stamp('ts')} AS "START_TIME" FROM query_rows
            WHERE ts >= TIMESTAMP '2024-01-24 12:00:00' ORDER BY ts DESC, query_id LIMIT 1000""",
        "query_rows",
    ),
    "recent_query_history_all": sql(
        f"""SELECT query_id AS "QUERY_ID", warehouse AS "WAREHOUSE_NAME", {_stamp('ts')} AS "START_TIME" FROM query_rows
            WHERE ts >= TIMESTAMP '2024-01-24 12:00:00'""",
        "query_rows",
    ),
    "anomaly_flat_double": """
        WITH levels AS (SELECT * FROM (VALUES (0, 0.1e0), (1, 123.45e0), (2, 12345.67e0), (3, 7654321.09e0)) AS t(grp, level)),
        counted AS (
            SELECT l.grp, CASE WHEN l.grp % 2 = 1 AND event_id < 4 THEN level * 1.0000001e0 ELSE level END AS val, COUNT(*) AS n
            FROM events JOIN levels AS l ON event_id % 4 = l.grp GROUP BY 1, 2),
        grouped AS (SELECT *, SUM(n) OVER (PARTITION BY grp) AS total, COUNT(*) OVER (PARTITION BY grp) AS kinds,
                    MIN(val) OVER (PARTITION BY grp) AS low FROM counted),
        judged AS (SELECT *, n = 1 AND kinds = 2 AND val > low AS above FROM grouped)
        SELECT CAST(grp AS INT) AS grp, val, CASE WHEN total <= 5 THEN 'insufficient_baseline' WHEN above THEN 'anomaly' ELSE 'normal' END AS status,
               above AS infinite, n FROM judged""",
    # leave-one-out by hand: whole thousandths give the others' exact sums
    "anomaly_extreme_double": """
        WITH v AS (
            SELECT event_id, CAST(event_id % 5 AS INT) AS grp, event_id < 5 AS is_far, event_id >= 5 AND event_id % 1000 = 0 AS odd,
                   1000 + event_id % 97 AS milli, [1e4, 1e6, 1e8, 1e10, 1e12][event_id % 5 + 1] AS far
            FROM events
        ), g AS (
            SELECT grp, COUNT(*) FILTER (NOT odd) AS n, COUNT(*) FILTER (NOT odd AND NOT is_far) AS others,
                   CAST(SUM(milli) FILTER (NOT odd AND NOT is_far) AS BIGINT) AS s,
                   CAST(SUM(milli * milli) FILTER (NOT odd AND NOT is_far) AS BIGINT) AS q
            FROM v GROUP BY grp
        ), scored AS (
            SELECT v.grp, n, is_far, odd, far, s / others / 1000e0 AS mean,
                   sqrt(CAST(others * q - s * s AS DOUBLE)) / others / 1000e0 AS stddev FROM v JOIN g USING (grp)
        ) SELECT grp, CASE WHEN odd THEN 'no_value' WHEN n <= 5 THEN 'insufficient_baseline' WHEN is_far THEN 'anomaly' ELSE 'normal' END AS status,
                 CASE WHEN NOT odd THEN n - 1 END AS group_n_other,
                 CASE WHEN is_far THEN format('{:.9e}', far) END AS far, CASE WHEN is_far AND n > 5 THEN format('{:.9e}', mean) END AS mean,
                 CASE WHEN is_far AND n > 5 THEN format('{:.9e}', stddev) END AS stddev,
                 CASE WHEN is_far AND n > 5 THEN format('{:.9e}', (far - mean) / stddev) END AS z, COUNT(*) AS n
          FROM scored GROUP BY ALL""",
    "normalize_metering": sql(
        f"""SELECT 'snowflake' AS source, 'warehouse_metering_hour' AS resource_type, warehouse || '::' || strftime(started, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS resource_id,
            warehouse AS account_identifier, CAST(CAST(started AS DATE) AS VARCHAR) AS usage_date, {_stamp('started')} AS period_start, {_stamp('started + to_hours(1)')} AS period_end,
            warehouse AS service, CAST(NULL AS DOUBLE) AS cost_usd, CAST(NULL AS VARCHAR) AS cost_basis, CAST(credits AS DOUBLE) AS usage_quantity, 'credits' AS usage_unit,
            CAST(credits AS DOUBLE) AS credits_used_compute FROM metering""",
        "metering",
    ),
    "normalize_job_runs": sql(
        f"""SELECT 'databricks' AS source, 'job_run' AS resource_type, CAST(run_id AS VARCHAR) AS resource_id, CASE WHEN p.job_id = 0 THEN '' ELSE CAST(p.job_id AS VARCHAR) END AS account_identifier,
            CAST(CAST(began AS DATE) AS VARCHAR) AS usage_date, {_stamp('began')} AS period_start, CASE WHEN run_ms > 0 THEN {_stamp('began + to_milliseconds(run_ms)')} END AS period_end,
            run_name AS service, cost_usd, CASE WHEN cost_usd IS NOT NULL THEN 'estimated_list_price' END AS cost_basis, hours AS usage_quantity, 'cluster_hours' AS usage_unit,
            CAST(p.job_id AS VARCHAR) AS job_id, state AS result_state, node_type_id, CAST(num_workers AS VARCHAR) AS num_workers, cluster_source, cluster_id FROM priced p""",
        "jobs",
        **_RUNS,
    ),
    "normalize_cluster_events": sql(
        f"""SELECT 'databricks' AS source, 'cluster_event' AS resource_type, 'c-' || user_id || '::' || coalesce(CAST(ms AS VARCHAR), 'None') AS resource_id, 'c-' || user_id AS account_identifier,
            CAST(CAST(began AS DATE) AS VARCHAR) AS usage_date, {_stamp('began')} AS period_start, CAST(NULL AS VARCHAR) AS period_end, CAST(NULL AS VARCHAR) AS service,
            CAST(NULL AS DOUBLE) AS cost_usd, CAST(NULL AS VARCHAR) AS cost_basis, CAST(NULL AS DOUBLE) AS usage_quantity, CAST(NULL AS VARCHAR) AS usage_unit, type,
            CASE WHEN type = 'STARTING' THEN CAST(k AS VARCHAR) END AS k
            FROM (SELECT *, CASE WHEN ms IS NULL THEN TIMESTAMP '2024-01-31 12:00:00' ELSE make_timestamp(ms * 1000) END AS began
                  FROM (SELECT user_id, {_K} AS k, type, CASE WHEN type = 'STARTING' THEN epoch_us(ts) // 1000 WHEN {_K} % 7 <> 0 THEN epoch_us(ts) // 1000 + 1000 END AS ms
                        FROM events CROSS JOIN (VALUES ('STARTING'), ('RUNNING')) AS t(type)))"""
    ),
    "cluster_resolution": sql(
        "SELECT run_id, node_type_id, CAST(num_workers AS BIGINT) AS num_workers, cluster_source, cluster_id FROM resolved", "jobs", **_RUNS
    ),
    "distinct_clusters": sql("SELECT DISTINCT 'c-' || job_id AS cluster_id FROM jobs WHERE priority = '4'", "jobs"),
    "job_cost_estimate": sql(
        """SELECT run_id, CAST(cost_number AS DOUBLE) AS cost_usd, CASE WHEN cost_number IS NOT NULL THEN 'estimated_list_price' END AS cost_basis,
           CAST(hours_number AS DOUBLE) AS hours FROM jobs""",
        "jobs",
    ),
    "normalize_batch": sql(
        f"""SELECT 'aws/cost_and_usage' AS raw_table, COUNT(*) AS n, COUNT(cost_usd) AS with_cost, CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd, CAST(SUM(usage_quantity) AS DOUBLE) AS usage_quantity FROM billing
            UNION ALL SELECT 'aws/cost_forecast', 1, 1, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE), NULL FROM lineitem
            UNION ALL SELECT 'aws/service_dimension_values', COUNT(DISTINCT service), 0, NULL, NULL FROM cost_days WHERE usage_date BETWEEN DATE '1998-05-01' AND DATE '1998-05-15'
            UNION ALL SELECT 'snowflake/query_history', COUNT(*), 0, NULL, CAST(SUM(ms) AS DOUBLE) FROM query_rows
            UNION ALL SELECT 'snowflake/warehouse_metering_history', COUNT(*), 0, NULL, CAST(SUM(credits) AS DOUBLE) FROM metering
            UNION ALL SELECT 'databricks/job_runs', COUNT(*), COUNT(cost_usd), CAST(SUM(CAST(cost_usd AS DECIMAL(18,4))) AS DOUBLE), CAST(SUM(CAST(hours AS DECIMAL(18,4))) AS DOUBLE) FROM priced
            UNION ALL SELECT 'databricks/cluster_events', 2 * COUNT(*), 0, NULL, NULL FROM events""",
        "cost_days",
        "query_rows",
        "metering",
        "jobs",
        billing=_BILLING,
        **_RUNS,
    ),
    # --- reports
    "spend_slice": sql(
        """SELECT source, attribution_kind, attribution_key, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_total AS DOUBLE) AS cost_usd_total, cost_bases_present,
           CAST(usage_quantity_total AS DOUBLE) AS usage_quantity_total, usage_unit, record_count FROM by_attribution
           WHERE source = 'aws' AND attribution_kind = 'service' AND usage_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'""",
        "by_attribution",
    ),
    "spend_totals": sql(
        """SELECT source, coalesce(CAST(SUM(cost_usd_total) AS DOUBLE), 0e0) AS total_cost_usd, CAST(SUM(record_count) AS BIGINT) AS total_records, COUNT(DISTINCT usage_date) AS days_observed
           FROM by_source_date GROUP BY 1""",
        "by_source_date",
    ),
    "spend_report": sql(
        """SELECT source, coalesce(CAST(SUM(cost_usd_total) AS DOUBLE), 0e0) AS total_cost_usd, CAST(SUM(record_count) AS BIGINT) AS total_records, COUNT(DISTINCT usage_date) AS days_observed
           FROM by_source_date WHERE usage_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' GROUP BY 1""",
        "by_source_date",
    ),
    "top_attribution": sql(
        """SELECT source, attribution_key, CAST(SUM(coalesce(cost_usd, 0)) AS DOUBLE) AS cost, CAST(SUM(coalesce(usage_quantity, 0)) AS DOUBLE) AS quantity,
           coalesce(arg_max(usage_unit, usage_date) FILTER (WHERE usage_unit IS NOT NULL), '') AS unit, TRUE AS uses_cost, CAST(SUM(coalesce(cost_usd, 0)) AS DOUBLE) AS value,
           CASE WHEN length(attribution_key) > 22 THEN substring(attribution_key, 1, 22) || '…' ELSE attribution_key END AS label
           FROM events_all GROUP BY source, attribution_key ORDER BY value DESC, source, attribution_key LIMIT 8""",
        "events_all",
    ),
    "top_attribution_by_quantity": sql(
        """SELECT source, attribution_key, 0e0 AS cost, CAST(SUM(usage_quantity) AS DOUBLE) AS quantity, arg_max(usage_unit, (usage_date, usage_unit)) AS unit,
           FALSE AS uses_cost, CAST(SUM(usage_quantity) AS DOUBLE) AS value,
           CASE WHEN length(attribution_key) > 22 THEN substring(attribution_key, 1, 22) || '…' ELSE attribution_key END AS label
           FROM by_attr_unit GROUP BY source, attribution_key ORDER BY value DESC, source, attribution_key LIMIT 3""",
        "events_all",
        by_attr_unit="SELECT source, attribution_kind, attribution_key, usage_date, SUM(usage_quantity) AS usage_quantity, MIN(usage_unit) AS usage_unit FROM events_all WHERE source = 'snowflake' GROUP BY 1, 2, 3, 4",
    ),
    "activity_pivot": sql(
        """SELECT CAST(usage_date AS VARCHAR) AS usage_date, CAST(coalesce(SUM(record_count) FILTER (WHERE source = 'aws'), 0) AS BIGINT) AS aws,
           CAST(coalesce(SUM(record_count) FILTER (WHERE source = 'snowflake'), 0) AS BIGINT) AS snowflake,
           CAST(coalesce(SUM(record_count) FILTER (WHERE source = 'databricks'), 0) AS BIGINT) AS databricks FROM by_source_date GROUP BY 1""",
        "by_source_date",
    ),
    "filter_options": sql("SELECT source, attribution_kind, attribution_key, label FROM options", "events_all", **_OPTIONS),
    "options_deduped": sql(
        """SELECT source, attribution_kind, attribution_key, label FROM
           (SELECT *, row_number() OVER (PARTITION BY source, attribution_key ORDER BY attribution_kind) AS r FROM options) WHERE r = 1""",
        "events_all",
        **_OPTIONS,
    ),
    "options_first_200": sql(
        """SELECT source, attribution_kind, attribution_key, label FROM
           (SELECT *, row_number() OVER (PARTITION BY source, attribution_key ORDER BY attribution_kind) AS r FROM options) WHERE r = 1
           ORDER BY source, attribution_key LIMIT 200""",
        "events_all",
        **_OPTIONS,
    ),
    "attribution_kinds": sql(
        "SELECT DISTINCT attribution_kind AS value, upper(substring(attribution_kind, 1, 1)) || substring(attribution_kind, 2) AS label FROM events_all", "events_all"
    ),
    "date_range": sql("SELECT CAST(MIN(usage_date) AS VARCHAR) AS date_min, CAST(MAX(usage_date) AS VARCHAR) AS date_max FROM events_all", "events_all"),
    "overview_headline": sql(
        """SELECT 'Snowflake' AS source_label, warehouse AS warehouse_label, substring(query_id, 1, 18) || '...' AS query_label, query_type,
           format('{:.0f} ms', CAST(x AS DOUBLE)) AS duration_label, format('z={:.2f}', z_score) AS metric_value, z_score
           FROM scored WHERE anomaly ORDER BY z_score DESC, query_id LIMIT 1""",
        "query_rows",
        **_QUERY_SCORES,
    ),
    "overview_sources": sql(
        """SELECT source, CASE source WHEN 'aws' THEN 'AWS' WHEN 'snowflake' THEN 'Snowflake' ELSE 'Databricks' END AS label, record_count
           FROM counted WHERE "table" IN ('cost_and_usage', 'query_history', 'job_runs')""",
        "counted",
    ),
    "overview_forecast": sql(
        f"""SELECT CAST(d.day AS BIGINT) AS day, {_CUMULATIVE} AS cumulative_cost_usd, d.day <= days_observed AS observed,
           (SELECT COUNT(*) FROM records) AS total_records FROM fitted JOIN (SELECT unnest(range(1, 32)) AS day) d ON d.day <= days_in_month WHERE source = 'aws'""",
        "daily_actuals",
        **_forecast("daily_actuals", "source", COST_DAY),
    ),
    "provenance": sql("""SELECT source || '/' || "table" AS "table", source, record_count FROM counted WHERE "table" <> 'service_dimension_values'""", "counted"),
    "display_formats": sql(
        f"""SELECT resource_id, CASE WHEN cost_usd IS NULL THEN '—' WHEN cost_usd >= 1 THEN '$' || {_money_text('cost_usd')} ELSE '$' || rtrim(format('{{:.10f}}', CAST(cost_usd AS DOUBLE)), '0') END AS usd,
            CASE WHEN cost_usd IS NULL THEN '—' WHEN cost_usd / 1000003 >= 1 THEN '$' || {_money_text('cost_usd / 1000003')} ELSE '$' || rtrim(format('{{:.10f}}', CAST(cost_usd AS DOUBLE) / 1000003), '0') END AS small_usd,
            CASE WHEN cost_usd IS NULL THEN '—' ELSE rtrim(rtrim(format('{{:,.3f}}', CAST(cost_usd AS DOUBLE)), '0'), '.') END AS number FROM flat""",
        "flat",
    ),
    # --- stores
    "newest_collection": sql(
        """SELECT source, resource_type, CAST(usage_date AS VARCHAR) AS usage_date, CAST(CASE WHEN again THEN DATE '2024-02-01' ELSE DATE '2024-01-31' END AS VARCHAR) AS ingested_date,
           COUNT(*) AS n, CAST(SUM(CASE WHEN again THEN 2 * cost_usd ELSE cost_usd END) AS DOUBLE) AS cost_usd, CAST(SUM(usage_quantity) AS DOUBLE) AS usage_quantity,
           MAX(CASE WHEN again THEN '2024-02-01 12:00:00.000000' ELSE ingested_at END) AS ingested_at
           FROM (SELECT *, day(usage_date) <= 10 AS again FROM records
                 QUALIFY row_number() OVER (PARTITION BY source, resource_type, resource_id ORDER BY ingested_at DESC, cost_usd DESC) = 1) GROUP BY 1, 2, 3, 4""",
        "records",
    ),
    "raw_store_roundtrip": sql(
        f"""SELECT source, resource_type, CAST(usage_date AS VARCHAR) AS usage_date, COUNT(*) AS n, CAST(SUM(cost_usd) AS DOUBLE) AS cost_usd, CAST(SUM(usage_quantity) AS DOUBLE) AS usage_quantity,
            {_stamp('MIN(period_start)')} AS first_start, MAX(ingested_at) AS ingested_at, COUNT(query_type) AS with_query_type FROM records GROUP BY 1, 2, 3""",
        "records",
    ),
    "latest_partition": sql(
        """SELECT source, CAST(usage_date AS VARCHAR) AS usage_date, CAST(cost_usd_total AS DOUBLE) AS cost_usd_total, record_count, records_with_cost, cost_bases_present,
           '2024-01-31' AS run_date FROM by_source_date WHERE source = 'snowflake'""",
        "by_source_date",
    ),
    "outputs_written": sql(
        f"""SELECT *, n AS record_count, '1998-05-20' AS run_date FROM (
            SELECT 'spend_by_source_date' AS output_table, COUNT(*) AS n FROM by_source_date
            UNION ALL SELECT 'spend_by_attribution', COUNT(*) FROM by_attribution
            UNION ALL SELECT 'anomalies_snowflake_query_duration', COUNT(*) FROM query_rows
            UNION ALL SELECT 'anomalies_daily_cost_by_attribution', COUNT(*) FROM by_attribution
            UNION ALL SELECT 'forecast_by_source', COUNT(*) FROM fitted
            UNION ALL SELECT 'forecast_combined', 1
            UNION ALL SELECT 'forecast_native_units', COUNT(*) FROM ({_native(COST_DAY)})
            UNION ALL SELECT 'forecast_aws_reconciled', COUNT(*) FROM fitted WHERE source = 'aws'
            UNION ALL SELECT 'optimization_suggestions', COUNT(*) FROM suggestions WHERE NOT starts_with(coalesce(attribution_key, ''), 'SVC_'))""",
        "by_source_date",
        "by_attribution",
        "daily_actuals",
        "flat",
        **_forecast("daily_actuals", "source", COST_DAY),
        **_SUGGESTIONS,
    ),
}

_QUERY_DURATION = sql(
    f"SELECT query_id AS resource_id, warehouse AS account_identifier, CAST(usage_date AS VARCHAR) AS usage_date, CAST(ms AS DOUBLE) AS usage_quantity, {_SCORE_COLUMNS} FROM scored",
    "query_rows",
    **_QUERY_SCORES,
)
for _name in ("anomaly_query_duration", "anomaly_query_duration_window", "anomaly_query_duration_shuffled"):
    ORACLE[_name] = _QUERY_DURATION
