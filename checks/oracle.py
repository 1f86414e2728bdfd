"""The same results in plain SQL, for a side-by-side run on another engine.

Written independently of the Spark plans: one chain of common table expressions from the order tables
to the staged rows, and one query per key on top of it.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-09-01 00:00:00'"
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _clean(column: str) -> str:
    return f"trim(coalesce({column}, ''), {BLANKS})"


def _instant(column: str) -> str:
    text = _clean(column)
    return (
        f"CASE WHEN regexp_matches({text}, '{ISO}') "
        f"THEN try_cast(rtrim({text}, 'Z') AS TIMESTAMP) END"
    )


def _int(column: str, default: int, kind: str = "INTEGER") -> str:
    text = _clean(column)
    return (
        f"coalesce(CASE WHEN regexp_matches({text}, '{NUMBER}') "
        f"THEN try_cast(trunc(try_cast({text} AS DOUBLE)) AS {kind}) END, CAST({default} AS {kind}))"
    )


def _flag(column: str) -> str:
    return f"lower({_clean(column)}) IN ('1', 'true', 't', 'yes', 'y')"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- adapter: orders as workflow events ----------------------------------------------------------

_SOURCE = r"""
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret
  FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, c_mktsegment,
         n_name, r_name, coalesce(n_lines, 0) AS n_lines, coalesce(n_ret, 0) AS n_ret
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN lines ON l_orderkey = o_orderkey
),
delivered AS (
  SELECT *, 0 AS late FROM base
  UNION ALL
  SELECT *, 1 AS late FROM base WHERE n_ret >= 1
),
state AS (
  SELECT *,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'InvoiceApproval' WHEN 'AUTOMOBILE' THEN 'RefundReview'
      WHEN 'MACHINERY' THEN 'ClaimsValidation' WHEN 'HOUSEHOLD' THEN 'VendorOnboarding'
      ELSE 'KycRefresh' END AS kind,
    CASE c_mktsegment WHEN 'BUILDING' THEN 24 WHEN 'AUTOMOBILE' THEN 12 WHEN 'MACHINERY' THEN 36
      WHEN 'HOUSEHOLD' THEN 72 ELSE 48 END AS sla,
    CASE WHEN o_orderstatus = 'F' THEN 'completed'
      WHEN o_orderstatus = 'O' THEN CASE WHEN k % 2 = 0 THEN 'queued' ELSE 'in_progress' END
      ELSE CASE k % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'cancelled' ELSE 'in_progress' END
    END AS st,
    o_orderdate + to_minutes(k % 1440) AS created
  FROM delivered
),
moved AS (
  SELECT *,
    (CASE WHEN k % 109 = 0 THEN created - INTERVAL 5 MINUTE
          ELSE created + to_minutes(2 + k % 59) END) + to_days(late) AS started,
    (CASE WHEN k % 127 = 0 THEN created - INTERVAL 1 DAY
          ELSE created + to_minutes(60 + k % 4320) END) + to_days(late) AS completed,
    CASE WHEN k % 137 = 0 THEN created - INTERVAL 1 DAY ELSE created + to_hours(sla) END AS due,
    n_ret >= 2 OR st = 'failed' AS flagged,
    least(n_ret, 4) AS errs
  FROM state
),
src AS (
  SELECT
    CASE WHEN late = 1 THEN 'orders_late.csv' ELSE 'orders.csv' END AS source_file_name,
    CAST(k + 1 AS VARCHAR) AS source_row_number,
    CASE WHEN k % 101 = 0 THEN '  ' ELSE 'WF-' || lpad(CAST(k AS VARCHAR), 8, '0') END AS workflow_id,
    kind AS workflow_type,
    CASE r_name WHEN 'AFRICA' THEN 'PaymentsOps' WHEN 'AMERICA' THEN 'CustomerCare'
      WHEN 'ASIA' THEN 'ClaimsReview' WHEN 'EUROPE' THEN 'RiskOps' ELSE 'FieldOps' END AS team_name,
    CASE WHEN k % 13 = 0 THEN '' ELSE 'USR-' || CAST(1000 + o_custkey % 500 AS VARCHAR) END AS assignee_id,
    CASE WHEN k % 103 = 0 THEN 'urgent'
      WHEN o_orderpriority = '1-URGENT' THEN ' CRITICAL ' WHEN o_orderpriority = '2-HIGH' THEN 'High'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'low' ELSE 'LOW' END AS priority,
    CASE WHEN k % 107 = 0 THEN 'unknown' WHEN st = 'completed' THEN ' Completed ' ELSE st END AS status,
    lower(n_name) || ' desk' AS queue_name,
    strftime(created, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    CASE WHEN k % 113 = 0 THEN 'half past six'
      ELSE strftime(started, '%Y-%m-%dT%H:%M:%SZ') END AS started_at,
    CASE WHEN k % 131 = 0 OR st NOT IN ('completed', 'failed', 'cancelled') THEN ''
      ELSE strftime(completed, '%Y-%m-%dT%H:%M:%SZ') END AS completed_at,
    CASE WHEN k % 149 = 0 THEN '' ELSE strftime(due, '%Y-%m-%dT%H:%M:%SZ') END AS due_at,
    CASE st WHEN 'queued' THEN 'Y' WHEN 'in_progress' THEN 'true' ELSE '0' END AS backlog_flag,
    CASE WHEN flagged THEN 'true' ELSE 'no' END AS exception_flag,
    CASE WHEN flagged THEN 'validation_error' ELSE '' END AS exception_type,
    'orders ' || lower(r_name) AS source_system,
    CASE WHEN k % 139 = 0 THEN 'abc' ELSE CAST(n_lines AS VARCHAR) END AS records_touched,
    CAST(errs AS VARCHAR) AS error_count,
    '{"records_touched": ' || n_lines || ', "error_count": ' || errs || '}' AS payload,
    n_name, r_name
  FROM moved
)"""

_NORMALISED = f"""
norm AS (
  SELECT
    {_clean('source_file_name')} AS source_file_name,
    {_int('source_row_number', -1, 'BIGINT')} AS source_row_number,
    {_clean('workflow_id')} AS workflow_id,
    {_clean('workflow_type')} AS workflow_type,
    {_clean('team_name')} AS team_name,
    nullif({_clean('assignee_id')}, '') AS assignee_id,
    lower({_clean('priority')}) AS priority,
    lower({_clean('status')}) AS status,
    {_clean('queue_name')} AS queue_name,
    {_instant('created_at')} AS created_at,
    {_instant('started_at')} AS started_at,
    {_instant('completed_at')} AS completed_at,
    {_instant('due_at')} AS due_at,
    {_flag('backlog_flag')} AS backlog_flag,
    {_flag('exception_flag')} AS exception_flag,
    nullif({_clean('exception_type')}, '') AS exception_type,
    {_clean('source_system')} AS source_system,
    {_int('records_touched', 0)} AS records_touched,
    {_int('error_count', 0)} AS error_count,
    payload,
    {_clean('created_at')} AS t_created, {_clean('started_at')} AS t_started,
    {_clean('completed_at')} AS t_completed, {_clean('due_at')} AS t_due
  FROM src
)"""

_CHECKED = """
checked AS (
  SELECT *,
    list_filter([
      CASE WHEN t_created <> '' AND created_at IS NULL THEN 'invalid_created_at' END,
      CASE WHEN t_started <> '' AND started_at IS NULL THEN 'invalid_started_at' END,
      CASE WHEN t_completed <> '' AND completed_at IS NULL THEN 'invalid_completed_at' END,
      CASE WHEN t_due <> '' AND due_at IS NULL THEN 'invalid_due_at' END,
      CASE WHEN workflow_id = '' THEN 'empty_workflow_id' END,
      CASE WHEN status NOT IN ('completed', 'in_progress', 'queued', 'failed', 'cancelled')
        THEN 'invalid_status' END,
      CASE WHEN priority NOT IN ('low', 'medium', 'high', 'critical') THEN 'invalid_priority' END,
      CASE WHEN created_at > completed_at THEN 'completed_before_created' END,
      CASE WHEN due_at < created_at THEN 'due_before_created' END
    ], lambda e: e IS NOT NULL) AS errors
  FROM norm
),
valid AS (SELECT * FROM checked WHERE len(errors) = 0),
rejected AS (SELECT * FROM checked WHERE len(errors) > 0)"""

_TIMED = f"""
timed AS (
  SELECT *,
    coalesce(completed_at, started_at, created_at) AS updated_at,
    greatest(coalesce(epoch_us(coalesce(completed_at, started_at, created_at)) - epoch_us(created_at), 0), 0)
      AS turnaround_us,
    greatest(coalesce(epoch_us(coalesce(completed_at, {AS_OF})) - epoch_us(created_at), 0), 0) AS age_us
  FROM valid
),
latest AS (
  SELECT * FROM timed
  QUALIFY row_number() OVER (
    PARTITION BY workflow_id ORDER BY updated_at DESC NULLS LAST, source_file_name, source_row_number) = 1
)"""

# Hits of the four exception rules, then the staged row.
_STAGED = f"""
ruled AS (
  SELECT *,
    coalesce(due_at IS NOT NULL AND coalesce(completed_at, {AS_OF}) > due_at, false) AS sla_breached,
    coalesce(status NOT IN ('completed', 'failed', 'cancelled') AND due_at < {AS_OF}, false) AS r1,
    coalesce(trim(assignee_id), '') = '' AS r2,
    coalesce(status = 'completed' AND completed_at IS NULL, false)
      OR coalesce(started_at < created_at, false) AS r3,
    turnaround_us > 86400000000 AS r4
  FROM latest
),
staged AS (
  SELECT * EXCLUDE (exception_flag, exception_type),
    exception_flag OR r1 OR r2 OR r3 OR r4 AS exception_flag,
    CASE WHEN r1 THEN 'overdue_workflow' WHEN r2 THEN 'missing_assignee'
      WHEN r3 THEN 'invalid_lifecycle_pattern' WHEN r4 THEN 'high_processing_time'
      ELSE nullif(trim(exception_type), '') END AS exception_type,
    CAST(created_at AS DATE) AS day,
    CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(round_even(turnaround_us / 60000000.0, 2) AS DECIMAL(12, 2)) AS processing_minutes,
    least(greatest(100 - 10 * error_count - CASE WHEN assignee_id IS NULL THEN 15 ELSE 0 END
      - CASE WHEN sla_breached THEN 5 ELSE 0 END, 0), 100) AS score
  FROM ruled
)"""

# Means from integer sums, rounded half up once: (200 * sum + n) // (2 * n) hundredths.
_DAILY = """
kpi AS (
  SELECT day, date_key, team_name, workflow_type,
    count(*) AS total_workflows,
    count(*) FILTER (WHERE status = 'completed') AS completed_workflows,
    count(*) FILTER (WHERE backlog_flag) AS backlog_workflows,
    count(*) FILTER (WHERE exception_flag) AS exception_workflows,
    count(*) FILTER (WHERE sla_breached) AS sla_breach_count,
    (2 * sum(CAST(processing_minutes * 100 AS HUGEINT)) + count(*)) // (2 * count(*)) AS c_minutes,
    (200 * sum(CAST(age_us AS HUGEINT)) + count(*) * 3600000000)
      // (2 * count(*) * 3600000000) AS c_age,
    (200 * count(*) + greatest(count(DISTINCT assignee_id), 1))
      // (2 * greatest(count(DISTINCT assignee_id), 1)) AS c_through,
    (200 * sum(score) + count(*)) // (2 * count(*)) AS c_score
  FROM staged GROUP BY day, date_key, team_name, workflow_type
),
backlog AS (
  SELECT day, date_key, team_name, workflow_type, priority,
    count(*) AS open_workflow_count,
    count(*) FILTER (WHERE sla_breached) AS overdue_workflow_count,
    (200 * sum(CAST(age_us AS HUGEINT)) + count(*) * 3600000000)
      // (2 * count(*) * 3600000000) AS c_age
  FROM staged
  WHERE backlog_flag OR status NOT IN ('completed', 'failed', 'cancelled')
  GROUP BY day, date_key, team_name, workflow_type, priority
)"""

_MEMBERS = """
teams AS (SELECT team_name, row_number() OVER (ORDER BY team_name) AS team_key
          FROM (SELECT DISTINCT team_name FROM staged)),
types AS (SELECT workflow_type, row_number() OVER (ORDER BY workflow_type) AS workflow_type_key
          FROM (SELECT DISTINCT workflow_type FROM staged)),
priorities(priority, priority_key) AS (VALUES ('low', 1), ('medium', 2), ('high', 3), ('critical', 4)),
statuses AS (SELECT status, row_number() OVER (ORDER BY status) AS status_key
             FROM (SELECT DISTINCT status FROM staged))"""

NORMALISED_COLUMNS = (
    "source_file_name source_row_number workflow_id workflow_type team_name assignee_id priority status "
    "queue_name created_at started_at completed_at due_at backlog_flag exception_flag exception_type "
    "source_system records_touched error_count payload"
).split()

_STEPS = (_SOURCE, _NORMALISED, _CHECKED, _TIMED, _STAGED, _DAILY, _MEMBERS)
SOURCE, NORMALISED, CHECKED, TIMED, STAGED, DAILY, MEMBERS = range(1, 8)


def chain(upto: int, query: str, more: str = "") -> str:
    return "WITH" + ",".join(_STEPS[:upto]) + (f",{more}" if more else "") + "\n" + query


# --- select lists -------------------------------------------------------------------------------------

_TYPED = f"""source_file_name, source_row_number, workflow_id, workflow_type, team_name, assignee_id,
  priority, status, queue_name, {_ts('created_at')} AS created_at, {_ts('started_at')} AS started_at,
  {_ts('completed_at')} AS completed_at, {_ts('due_at')} AS due_at, backlog_flag, exception_flag,
  exception_type, source_system, records_touched, error_count, payload"""

_KPI_MEASURES = """CAST(total_workflows AS BIGINT) AS total_workflows,
  CAST(completed_workflows AS BIGINT) AS completed_workflows,
  CAST(backlog_workflows AS BIGINT) AS backlog_workflows,
  CAST(exception_workflows AS BIGINT) AS exception_workflows,
  CAST(sla_breach_count AS BIGINT) AS sla_breach_count,
  CAST(c_minutes AS DOUBLE) / 100 AS avg_processing_minutes, CAST(c_age AS DOUBLE) / 100 AS avg_age_hours,
  CAST(c_through AS DOUBLE) / 100 AS throughput_per_assignee,
  CAST(c_score AS DOUBLE) / 100 AS data_quality_score"""
_DAY = "CAST(day AS VARCHAR)"
_KPI_NAMED = f"{_DAY} AS calendar_date, team_name, workflow_type, {_KPI_MEASURES}"
_BACKLOG_MEASURES = """CAST(open_workflow_count AS BIGINT) AS open_workflow_count,
  CAST(overdue_workflow_count AS BIGINT) AS overdue_workflow_count,
  CAST(c_age AS DOUBLE) / 100 AS avg_age_hours"""
_BACKLOG_NAMED = (
    f"{_DAY} AS calendar_date, team_name, workflow_type, priority AS priority_name, {_BACKLOG_MEASURES}"
)
_OPEN = "exception_flag AND status NOT IN ('completed', 'cancelled')"
_EXCEPTION_NAMED = f"""workflow_id, {_DAY} AS detected_date, team_name, workflow_type,
  priority AS priority_name, exception_type, status AS status_name, error_count, true AS open_flag"""
_AGE_STORED = "CAST((200 * CAST(age_us AS HUGEINT) + 3600000000) // 7200000000 AS DOUBLE) / 100"
_RUN = f"""queue_name, source_system, {_ts('created_at')} AS created_at, {_ts('started_at')} AS started_at,
  {_ts('completed_at')} AS completed_at, {_ts('due_at')} AS due_at,
  CAST(processing_minutes AS DOUBLE) AS processing_minutes, {_AGE_STORED} AS age_hours, records_touched,
  error_count, backlog_flag, exception_flag, sla_breached"""
_RUN_NAMED = f"""workflow_id, {_DAY} AS calendar_date, team_name, workflow_type, priority AS priority_name,
  status AS status_name, {_RUN}"""
_SUMMARY = """CAST(coalesce(sum(total_workflows), 0) AS BIGINT) AS total_workflows,
  CAST(coalesce(sum(completed_workflows), 0) AS BIGINT) AS completed_workflows,
  CAST(coalesce(sum(backlog_workflows), 0) AS BIGINT) AS backlog_workflows,
  CAST(coalesce(sum(exception_workflows), 0) AS BIGINT) AS exception_workflows,
  CAST(coalesce(sum(sla_breach_count), 0) AS BIGINT) AS sla_breach_count,
  round(coalesce(sum(c_minutes) / 100.0 / count(*), 0), 6) AS avg_processing_minutes,
  round(coalesce(sum(c_age) / 100.0 / count(*), 0), 6) AS avg_age_hours,
  round(coalesce(sum(c_through) / 100.0 / count(*), 0), 6) AS throughput_per_assignee,
  round(coalesce(sum(c_score) / 100.0 / count(*), 0), 6) AS data_quality_score"""
_STAGED_ROW = f"""workflow_id, workflow_type, team_name, assignee_id, priority, status, queue_name,
  {_ts('created_at')} AS created_at, {_ts('started_at')} AS started_at,
  {_ts('completed_at')} AS completed_at, {_ts('due_at')} AS due_at,
  CAST(processing_minutes AS DOUBLE) AS processing_minutes, {_AGE_STORED} AS age_hours, sla_breached,
  backlog_flag, exception_flag, exception_type, records_touched, error_count"""
_NEWEST = "ORDER BY day DESC NULLS FIRST, team_name, workflow_type"


def _typed_json(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%gZ')"


_REJECT_JSON = f"""CAST(to_json({{
    source_file_name: source_file_name, source_row_number: source_row_number, workflow_id: workflow_id,
    workflow_type: workflow_type, team_name: team_name, assignee_id: assignee_id, priority: priority,
    status: status, queue_name: queue_name, created_at: {_typed_json('created_at')},
    started_at: {_typed_json('started_at')}, completed_at: {_typed_json('completed_at')},
    due_at: {_typed_json('due_at')}, backlog_flag: backlog_flag, exception_flag: exception_flag,
    exception_type: exception_type, source_system: source_system, records_touched: records_touched,
    error_count: error_count, payload: payload, validation_status: 'quarantined'}}) AS VARCHAR)"""

_DIM_DATE = """date_key, CAST(day AS VARCHAR) AS calendar_date, CAST(isodow(day) AS INTEGER) AS day_of_week,
  dayname(day) AS day_name, CAST(weekofyear(day) AS INTEGER) AS week_of_year,
  CAST(month(day) AS INTEGER) AS month_number, monthname(day) AS month_name,
  CAST(quarter(day) AS INTEGER) AS quarter_number, CAST(year(day) AS INTEGER) AS year_number"""

# Two loads in a row: the main file, then the late file.
_BY_FILE = f"""
batch AS (
  SELECT * EXCLUDE (exception_flag, exception_type),
    exception_flag OR r1 OR r2 OR r3 OR r4 AS exception_flag,
    CAST(created_at AS DATE) AS day
  FROM (
    SELECT *,
      coalesce(status NOT IN ('completed', 'failed', 'cancelled') AND due_at < {AS_OF}, false) AS r1,
      assignee_id IS NULL AS r2,
      coalesce(status = 'completed' AND completed_at IS NULL, false)
        OR coalesce(started_at < created_at, false) AS r3,
      turnaround_us > 86400000000 AS r4
    FROM timed
    QUALIFY row_number() OVER (PARTITION BY source_file_name, workflow_id
      ORDER BY updated_at DESC NULLS LAST, source_row_number) = 1
  )
),
late_days AS (SELECT DISTINCT day FROM batch WHERE source_file_name = 'orders_late.csv'),
surviving AS (
  SELECT * FROM batch WHERE source_file_name = 'orders_late.csv'
  UNION ALL
  SELECT * FROM batch WHERE source_file_name = 'orders.csv' AND day NOT IN (SELECT day FROM late_days)
)"""


# What each stored table must hold, as relation -> (rows, required columns found in them). Generated
# columns (keys and load times) are not in these rows and are checked by the load itself.
_AUDITED = {
    "workflow_events_raw": "SELECT * FROM valid",
    "workflow_events_clean": "SELECT * FROM staged",
    "fact_workflow_run": "SELECT * FROM staged",
    "fact_exception": "SELECT *, status AS status_name FROM staged WHERE exception_flag",
    "fact_backlog_daily": "SELECT * FROM backlog",
    "kpi_daily_summary": "SELECT * FROM kpi",
}


def _audit() -> str:
    """Every declared constraint with its violations: nulls are counted, keys cannot break by construction."""
    from flowledger.tables import ALL_TABLES

    present = {
        "workflow_events_raw": set(NORMALISED_COLUMNS),
        "workflow_events_clean": {"workflow_id", "team_name", "priority", "status", "sla_breached"},
        "fact_workflow_run": {"workflow_id", "date_key", "queue_name", "source_system", "created_at"},
        "fact_exception": {"workflow_id", "date_key", "exception_type", "status_name"},
        "fact_backlog_daily": {"date_key", "open_workflow_count", "overdue_workflow_count"},
        "kpi_daily_summary": {"date_key", "total_workflows"},
    }
    parts = []
    for name, table in ALL_TABLES.items():
        checks = [("not_null", c) for c in table.required]
        checks += [("unique", ",".join(key)) for key in table.unique]
        checks += [("foreign_key", c) for c in table.references]
        for kind, column in checks:
            found = "0"
            if kind == "not_null" and column in present.get(name, ()):
                found = f"(SELECT count(*) FROM ({_AUDITED[name]}) WHERE {column} IS NULL)"
            parts.append(
                f"SELECT '{name}' AS table_name, '{kind}' AS constraint_type, '{column}' AS constraint_name, "
                f"CAST({found} AS BIGINT) AS violations"
            )
    return chain(MEMBERS, "\nUNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_profile"] = chain(
        SOURCE,
        f"""SELECT CASE WHEN grouping(team) = 0 THEN 'team' WHEN grouping(kind) = 0 THEN 'workflow_type'
              ELSE 'all' END AS member_kind,
            coalesce(team, kind, '') AS member_name, count(*) AS record_count,
            count(*) FILTER (WHERE exc) AS exception_rows, count(*) FILTER (WHERE bkl) AS backlog_rows
            FROM (SELECT team_name AS team, workflow_type AS kind, {_flag('exception_flag')} AS exc,
                    {_flag('backlog_flag')} AS bkl FROM src)
            GROUP BY GROUPING SETS ((), (team), (kind))""",
    )
    q["source_rows"] = chain(SOURCE, "SELECT * EXCLUDE (n_name, r_name) FROM src")
    q["normalized_source"] = chain(NORMALISED, f"SELECT {_TYPED} FROM norm")
    q["bool_int_coercion"] = chain(
        NORMALISED,
        """SELECT backlog_flag, exception_flag, records_touched, error_count, count(*) AS n,
           CAST(sum(source_row_number) AS BIGINT) AS row_sum
           FROM norm GROUP BY ALL""",
    )
    q["timestamp_parse"] = chain(
        NORMALISED,
        "SELECT source_file_name, source_row_number, "
        + ", ".join(
            f"t_{short} AS {short}_at_text, {_ts(f'{short}_at')} AS {short}_at, "
            f"t_{short} <> '' AND {short}_at IS NULL AS {short}_at_unparsed"
            for short in ("created", "started", "completed", "due")
        )
        + " FROM norm",
    )
    q["validation_errors"] = chain(
        CHECKED,
        """SELECT source_file_name, source_row_number, workflow_id,
           array_to_string(errors, ',') AS validation_errors,
           CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'quarantined' END AS validation_status
           FROM checked""",
    )
    q["validation_summary"] = chain(
        CHECKED,
        """SELECT count(*) AS input_rows, count(*) FILTER (WHERE len(errors) = 0) AS valid_rows,
           count(*) FILTER (WHERE len(errors) > 0) AS invalid_rows,
           count(*) FILTER (WHERE len(errors) > 0) AS quarantined_rows FROM checked""",
    )
    q["valid_rows"] = chain(CHECKED, f"SELECT {_TYPED} FROM valid")
    q["quarantine_rows"] = chain(
        CHECKED, f"SELECT {_TYPED}, array_to_string(errors, ',') AS validation_errors FROM rejected"
    )
    q["quarantine_json"] = chain(
        CHECKED,
        f"""SELECT source_file_name, source_row_number, workflow_id,
            array_to_string(errors, ',') AS validation_errors, {_REJECT_JSON} AS raw_payload FROM rejected""",
    )
    q["temporal_metrics"] = chain(
        TIMED,
        f"""SELECT source_file_name, source_row_number, {_ts('updated_at')} AS updated_at,
            round(turnaround_us / 3600000000.0, 6) AS turnaround_hours,
            round(age_us / 3600000000.0, 6) AS age_hours,
            CAST(round_even(turnaround_us / 60000000.0, 2) AS DOUBLE) AS processing_minutes FROM timed""",
    )
    q["dedup_latest"] = chain(
        TIMED,
        f"""SELECT workflow_id, source_file_name, source_row_number, {_ts('updated_at')} AS updated_at
            FROM latest""",
    )
    q["sla_breach"] = chain(
        STAGED, f"SELECT workflow_id, {_ts('due_at')} AS due_at, sla_breached FROM staged"
    )
    q["exception_rules"] = chain(
        STAGED, "SELECT workflow_id, status, exception_flag, exception_type FROM staged"
    )
    q["staging"] = chain(STAGED, f"SELECT {_STAGED_ROW} FROM staged")
    q["quality_score"] = chain(STAGED, "SELECT workflow_id, score AS quality_score FROM staged")
    q["backlog_rows"] = chain(
        STAGED,
        """SELECT workflow_id, status, backlog_flag FROM staged
           WHERE backlog_flag OR status NOT IN ('completed', 'failed', 'cancelled')""",
    )

    # dimensions
    q["dim_team"] = chain(
        MEMBERS,
        """SELECT CAST(team_key AS INTEGER) AS team_key, team_name,
           CASE team_name WHEN 'PaymentsOps' THEN 'Finance' WHEN 'CustomerCare' THEN 'Customer Success'
             WHEN 'ClaimsReview' THEN 'Operations' WHEN 'RiskOps' THEN 'Operations'
             WHEN 'FulfillmentOps' THEN 'Operations' ELSE 'Unknown' END AS department_name,
           CASE team_name WHEN 'PaymentsOps' THEN 'Rina Patel' WHEN 'CustomerCare' THEN 'Jordan Lee'
             WHEN 'ClaimsReview' THEN 'Maya Chen' WHEN 'RiskOps' THEN 'Daniel Kim'
             WHEN 'FulfillmentOps' THEN 'Elena Garcia' ELSE 'Unknown' END AS manager_name,
           true AS active_flag FROM teams""",
    )
    q["dim_workflow_type"] = chain(
        MEMBERS,
        """SELECT CAST(workflow_type_key AS INTEGER) AS workflow_type_key, workflow_type,
           CASE workflow_type WHEN 'InvoiceApproval' THEN 'Finance' WHEN 'RefundReview' THEN 'Customer'
             WHEN 'ClaimsValidation' THEN 'Risk' WHEN 'VendorOnboarding' THEN 'Procurement'
             WHEN 'KycRefresh' THEN 'Compliance' ELSE 'Unknown' END AS workflow_domain,
           CASE workflow_type WHEN 'InvoiceApproval' THEN 24 WHEN 'RefundReview' THEN 12
             WHEN 'ClaimsValidation' THEN 36 WHEN 'VendorOnboarding' THEN 72
             WHEN 'KycRefresh' THEN 48 ELSE 24 END AS default_sla_hours FROM types""",
    )
    q["dim_priority"] = chain(
        MEMBERS,
        """SELECT priority_key, priority AS priority_name, priority_key AS priority_rank,
           (SELECT count(*) FROM staged s WHERE s.priority = p.priority) AS n_runs
           FROM priorities p""",
    )
    q["dim_status"] = chain(
        MEMBERS,
        """SELECT CAST(status_key AS INTEGER) AS status_key, status AS status_name,
           status IN ('completed', 'failed', 'cancelled') AS terminal_flag FROM statuses""",
    )
    q["dim_date"] = chain(
        STAGED, f"SELECT {_DIM_DATE} FROM (SELECT DISTINCT day, date_key FROM staged)"
    )

    # facts and mart, by name and by key
    q["kpi_daily_summary"] = chain(DAILY, f"SELECT {_KPI_NAMED} FROM kpi")
    q["fact_backlog_daily"] = chain(DAILY, f"SELECT {_BACKLOG_NAMED} FROM backlog")
    q["fact_workflow_run"] = chain(
        MEMBERS,
        f"""SELECT workflow_id, date_key, CAST(team_key AS INTEGER) AS team_key,
            CAST(workflow_type_key AS INTEGER) AS workflow_type_key, priority_key,
            CAST(status_key AS INTEGER) AS status_key, {_RUN}
            FROM staged JOIN teams USING (team_name) JOIN types USING (workflow_type)
            JOIN priorities USING (priority) JOIN statuses USING (status)""",
    )
    q["fact_exception"] = chain(
        MEMBERS,
        f"""SELECT workflow_id, date_key, CAST(team_key AS INTEGER) AS team_key,
            CAST(workflow_type_key AS INTEGER) AS workflow_type_key, priority_key, exception_type,
            status AS status_name, error_count, {_ts('created_at')} AS detected_at,
            CAST(NULL AS VARCHAR) AS resolved_at, status NOT IN ('completed', 'cancelled') AS open_flag
            FROM staged JOIN teams USING (team_name) JOIN types USING (workflow_type)
            JOIN priorities USING (priority) WHERE exception_flag""",
    )
    q["fact_backlog_keyed"] = chain(
        MEMBERS,
        f"""SELECT date_key, CAST(team_key AS INTEGER) AS team_key,
            CAST(workflow_type_key AS INTEGER) AS workflow_type_key, priority_key, {_BACKLOG_MEASURES}
            FROM backlog JOIN teams USING (team_name) JOIN types USING (workflow_type)
            JOIN priorities USING (priority)""",
    )
    q["kpi_daily_keyed"] = chain(
        MEMBERS,
        f"""SELECT date_key, CAST(team_key AS INTEGER) AS team_key,
            CAST(workflow_type_key AS INTEGER) AS workflow_type_key, {_KPI_MEASURES}
            FROM kpi JOIN teams USING (team_name) JOIN types USING (workflow_type)""",
    )

    # reports
    q["team_performance_daily"] = q["kpi_daily_summary"]
    q["open_exceptions"] = chain(STAGED, f"SELECT {_EXCEPTION_NAMED} FROM staged WHERE {_OPEN}")
    q["kpi_summary"] = chain(DAILY, f"SELECT {_SUMMARY} FROM kpi")
    q["kpi_summary_filtered"] = chain(
        DAILY,
        f"""SELECT {_SUMMARY} FROM kpi WHERE day >= DATE '1997-01-01' AND day <= DATE '1999-06-30'
            AND team_name = 'RiskOps' AND workflow_type = 'RefundReview'""",
    )
    q["kpi_summary_empty"] = chain(
        DAILY, f"SELECT {_SUMMARY} FROM kpi WHERE team_name = 'NoSuchTeam'"
    )
    q["kpi_daily_page"] = chain(DAILY, f"SELECT {_KPI_NAMED} FROM kpi {_NEWEST} LIMIT 50 OFFSET 50")
    q["kpi_daily_total"] = chain(
        DAILY, "SELECT count(*) AS total FROM kpi WHERE workflow_type = 'KycRefresh'"
    )
    q["team_performance_page"] = chain(
        DAILY,
        f"""SELECT {_KPI_NAMED} FROM kpi WHERE team_name = 'CustomerCare'
            AND day >= DATE '1998-01-01' {_NEWEST} LIMIT 20 OFFSET 40""",
    )
    q["exceptions_page"] = chain(
        STAGED,
        f"""SELECT {_EXCEPTION_NAMED} FROM staged WHERE {_OPEN} AND team_name = 'PaymentsOps'
            ORDER BY day DESC, workflow_id LIMIT 50 OFFSET 100""",
    )
    q["exceptions_total"] = chain(
        STAGED,
        f"""SELECT count(*) AS total FROM staged WHERE {_OPEN} AND priority = 'critical'
            AND status = 'failed' AND day <= DATE '2000-12-31'""",
    )
    q["workflow_exceptions"] = chain(
        STAGED, f"SELECT {_EXCEPTION_NAMED} FROM staged WHERE {_OPEN} AND workflow_id = 'WF-00000002'"
    )
    q["backlog_page"] = chain(
        DAILY,
        f"""SELECT {_BACKLOG_NAMED} FROM backlog WHERE team_name = 'ClaimsReview'
            AND day >= DATE '1996-01-01' {_NEWEST}, priority LIMIT 50""",
    )
    q["backlog_total"] = chain(
        DAILY, "SELECT count(*) AS total FROM backlog WHERE priority = 'high'"
    )
    q["workflow_detail"] = chain(
        STAGED, f"SELECT {_RUN_NAMED} FROM staged WHERE workflow_id = 'WF-00000007'"
    )
    q["latest_per_workflow"] = chain(STAGED, f"SELECT {_RUN_NAMED} FROM staged")
    q["dashboard"] = chain(
        DAILY,
        f"""SELECT * FROM (SELECT 'daily' AS panel, {_DAY} AS day, team_name, workflow_type AS name,
              CAST(total_workflows AS BIGINT) AS n FROM kpi {_NEWEST} LIMIT 10)
            UNION ALL SELECT * FROM (SELECT 'exceptions', {_DAY}, team_name, workflow_id,
              CAST(error_count AS BIGINT) FROM staged WHERE {_OPEN} ORDER BY day DESC, workflow_id LIMIT 10)
            UNION ALL SELECT 'summary', '', '', '', CAST(sum(total_workflows) AS BIGINT) FROM kpi""",
    )

    q["team_performance_total"] = chain(
        DAILY,
        """SELECT count(*) AS total FROM kpi WHERE team_name = 'CustomerCare' AND day >= DATE '1998-01-01'""",
    )
    # the same reports over the tables that a load has stored
    for name in ("kpi_daily_page", "team_performance_page", "exceptions_page", "backlog_page", "workflow_detail"):
        q[f"stored_{name}"] = q[name]
    q["stored_kpi_summary"] = q["kpi_summary_filtered"]
    q["sql_kpi_summary"] = q["kpi_summary_filtered"]
    for name in ("team_performance", "exceptions", "backlog"):
        q[f"sql_{name}"] = q[f"{name}_page"]
    q["sql_workflow_detail"] = q["workflow_detail"]

    # loads
    q["csv_source_rows"] = q["normalized_source"]
    q["csv_lineage"] = chain(SOURCE, "SELECT count(*) AS n_rows, true AS consecutive FROM src")
    q["csv_multiline"] = chain(
        SOURCE,
        """SELECT nullif(workflow_id, '') AS workflow_id, nullif(payload, '') AS payload,
           CASE WHEN source_row_number::BIGINT % 3 = 0
             THEN 'Queue' || chr(10) || '"' || lower(source_file_name) || '",' || chr(13) || chr(10) || chr(10)
               || source_row_number || chr(10) || '"'
             ELSE nullif(queue_name, '') END AS queue_name,
           source_row_number::VARCHAR AS delivered_row, true AS consecutive FROM src""",
    )
    q["quarantine_csv"] = chain(
        CHECKED,
        """SELECT source_file_name, source_row_number, workflow_id,
           '["' || array_to_string(errors, '","') || '"]' AS validation_errors FROM rejected""",
    )
    q["append_once"] = chain(CHECKED, f"SELECT {_TYPED} FROM valid")
    q["raw_key_map"] = chain(
        CHECKED,
        """SELECT source_file_name, source_row_number, workflow_id FROM valid
           WHERE source_file_name = 'orders_late.csv'""",
    )
    q["quarantine_upsert"] = chain(
        CHECKED,
        """SELECT source_file_name, source_row_number, workflow_id,
           array_to_string(errors, ',') AS validation_errors,
           CASE WHEN source_file_name = 'orders_late.csv' THEN error_count + 1 ELSE error_count END
             AS error_count FROM rejected""",
    )
    q["staging_refresh"] = chain(
        TIMED,
        """SELECT source_file_name, source_row_number, workflow_id,
           CASE WHEN source_file_name = 'orders_late.csv' THEN 'refreshed' ELSE 'kept' END AS origin,
           status FROM valid""",
    )
    q["dimension_upsert"] = chain(
        MEMBERS,
        """SELECT CAST(row_number() OVER (ORDER BY seen, team_name) AS INTEGER) AS team_key, team_name,
           CASE WHEN fresh = 0 THEN 'Old department'
             WHEN team_name = 'ClaimsReview' THEN 'Operations' ELSE 'Unknown' END AS department_name,
           CASE WHEN fresh = 0 THEN 'Old manager'
             WHEN team_name = 'ClaimsReview' THEN 'Maya Chen' ELSE 'Unknown' END AS manager_name,
           true AS active_flag
           FROM (SELECT team_name, min(seen) AS seen, max(seen) AS fresh FROM (
             SELECT team_name, 0 AS seen FROM src
             UNION ALL SELECT CASE WHEN r_name = 'ASIA' THEN team_name ELSE n_name END, 1 FROM src)
             GROUP BY team_name)""",
    )
    q["slice_replace"] = chain(
        TIMED,
        """SELECT workflow_id, CAST(day AS VARCHAR) AS calendar_date, status AS status_name,
           exception_flag FROM surviving""",
        _BY_FILE,
    )
    q["slice_replace_exceptions"] = chain(
        TIMED,
        """SELECT workflow_id, CAST(day AS VARCHAR) AS detected_date, status AS status_name
           FROM surviving WHERE exception_flag""",
        _BY_FILE,
    )
    q["load_counts"] = chain(
        DAILY,
        """SELECT 'fact_workflow_run' AS table_name, count(*) AS loaded_rows FROM staged
           UNION ALL SELECT 'fact_exception', count(*) FROM staged WHERE exception_flag
           UNION ALL SELECT 'fact_backlog_daily', count(*) FROM backlog
           UNION ALL SELECT 'kpi_daily_summary', count(*) FROM kpi""",
    )
    q["row_account"] = chain(
        TIMED,
        """SELECT 'source_rows' AS part, count(*) AS n FROM checked
           UNION ALL SELECT 'raw_new', count(DISTINCT (source_file_name, source_row_number)) FROM valid
           UNION ALL SELECT 'raw_known', 0
           UNION ALL SELECT 'raw_repeats',
             count(*) - count(DISTINCT (source_file_name, source_row_number)) FROM valid
           UNION ALL SELECT 'rejected', count(DISTINCT (source_file_name, source_row_number)) FROM rejected
           UNION ALL SELECT 'reject_repeats',
             count(*) - count(DISTINCT (source_file_name, source_row_number)) FROM rejected
           UNION ALL SELECT 'staged', count(DISTINCT workflow_id) FROM valid
           UNION ALL SELECT 'older_versions', count(*) - count(DISTINCT workflow_id) FROM valid
           UNION ALL SELECT 'taken_rows', 0""",
    )
    q["constraint_audit"] = _audit()
    q["quality_summary"] = chain(
        DAILY,
        """SELECT 'workflow_events_raw' AS table_name, count(*) AS row_count FROM valid
           UNION ALL SELECT 'workflow_events_clean', count(*) FROM staged
           UNION ALL SELECT 'fact_workflow_run', count(*) FROM staged
           UNION ALL SELECT 'fact_exception', count(*) FROM staged WHERE exception_flag
           UNION ALL SELECT 'kpi_daily_summary', count(*) FROM kpi""",
    )

    # constraint checks on the source rows, where they find something
    q["not_null_check"] = chain(
        CHECKED,
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM checked"
            for c in NORMALISED_COLUMNS
        ),
    )
    q["unique_check"] = chain(
        CHECKED,
        "SELECT workflow_id, count(*) AS n FROM checked GROUP BY workflow_id HAVING count(*) > 1",
    )
    q["foreign_key_check"] = chain(
        CHECKED,
        """SELECT priority, count(*) AS n FROM checked
           WHERE priority NOT IN ('low', 'medium', 'high', 'critical') GROUP BY priority""",
    )

    # the deduplication and the daily aggregate on another table, with many rows per key
    q["dedup_events"] = """
      SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1"""
    q["events_daily"] = """
      SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS calendar_date, event_type, count(*) AS total_events,
        count(DISTINCT user_id) AS users,
        CAST((200 * count(*) + count(DISTINCT user_id)) // (2 * count(DISTINCT user_id)) AS DOUBLE) / 100
          AS events_per_user
      FROM events GROUP BY ALL"""
    return q
