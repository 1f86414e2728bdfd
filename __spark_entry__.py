"""Registered queries over the test tables, and the SQL they are checked against."""

from __future__ import annotations

import pathlib
import sys
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from checks import oracle  # noqa: E402
from flowledger.constants import SOURCE_COLUMNS, TIMESTAMP_COLUMNS  # noqa: E402
from flowledger.functions.numeric import ratio_half_up  # noqa: E402
from flowledger.operators import constraints, dimensions, facts, keyed, staging  # noqa: E402
from flowledger.operators.numbering import number_rows, stage  # noqa: E402
from flowledger.operators.validation import (  # noqa: E402
    normalise_source,
    quarantine_records,
    validate,
)
from flowledger.plans import loads, pipeline, reports  # noqa: E402
from flowledger.plans.sql_functions import register_functions  # noqa: E402
from flowledger.plans.star import star_of  # noqa: E402
from flowledger.session import configure, scratch_path  # noqa: E402
from flowledger.sources import orders  # noqa: E402
from flowledger.sources.profile import source_profile  # noqa: E402
from flowledger.sources.workflow_csv import read_workflow_csv  # noqa: E402
from flowledger.store import Warehouse  # noqa: E402
from flowledger.tables import ALL_TABLES, DIM_TEAM, QUARANTINE  # noqa: E402

try:  # the corpus operators are a part of their own, which may be left out
    import corpus_pipeline  # noqa: E402
    from flowledger.llm import queries as corpus  # noqa: E402
except ModuleNotFoundError as missing:  # the part itself, not something that it needs
    if missing.name not in ("corpus_pipeline", "flowledger.llm"):
        raise
    corpus_pipeline = corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]

# --- shared inputs ---------------------------------------------------------------------------------

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    """Written inputs that several queries share are built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _source(spark, sf_dir):
    return orders.all_deliveries(spark, sf_dir)


def _checked(spark, sf_dir):
    return validate(_source(spark, sf_dir)).staged()


def _staging(spark, sf_dir):
    return staging.prepare_staging(_checked(spark, sf_dir).valid, orders.AS_OF)


def _star(spark, sf_dir):
    def build():
        return star_of(stage(_staging(spark, sf_dir).drop(*loads.NOT_LOADED)))

    return _once(spark, sf_dir, "star", build)


def _warehouse(spark, sf_dir):
    """Both files loaded as one batch."""

    def build():
        store = _empty_warehouse(spark)
        run = scratch_path(spark, "run")
        result = pipeline.refresh_rows(store, _source(spark, sf_dir), run, orders.AS_OF)
        return store, run, result

    return _once(spark, sf_dir, "warehouse", build)


def _warehouse_after_two_loads(spark, sf_dir):
    """The main file, then the late file, which replaces every date it touches."""

    def build():
        store = _empty_warehouse(spark)
        for delivery in (orders.main_delivery, orders.late_delivery):
            valid = validate(delivery(spark, sf_dir)).staged().valid
            latest = staging.prepare_staging(valid, orders.AS_OF).drop(*loads.NOT_LOADED)
            loads.load_warehouse(
                store, number_rows(latest, keyed.EVENT_NUMBER, store.reserve(valid.count()))
            )
        return store

    return _once(spark, sf_dir, "two loads", build)


def _empty_warehouse(spark):
    # a day of the test data holds a handful of orders: lay the facts out by month
    return Warehouse(spark, scratch_path(spark, "warehouse"), facts_by="month_key").create()


# --- presentation: plain types that compare the same everywhere -------------------------------------


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, decimals as doubles, error lists as comma-separated text."""

    def plain(name: str, dtype: str):
        col = F.col(name)
        if dtype == "timestamp":
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        if dtype == "date":
            return col.cast("string")
        if dtype.startswith("decimal"):
            return col.cast("double")
        if dtype == "array<string>":
            return F.array_join(col, ",")
        if dtype == "smallint":
            return col.cast("int")
        return col

    return df.select(*[plain(n, t).alias(n) for n, t in df.dtypes])


def _without(df: DataFrame, *columns: str) -> DataFrame:
    return _plain(df.drop(*columns))


def _counts_as_bigint(df: DataFrame) -> DataFrame:
    counted = [c for c, t in df.dtypes if t == "int" and c.endswith(("_workflows", "_count"))]
    return df.withColumns({c: F.col(c).cast("bigint") for c in counted if c != "error_count"})


_SOURCE_KEY = list(loads.SOURCE_KEY)
_AGAIN = " again"  # marks the queue names of a redelivery

# --- source and validation ---------------------------------------------------------------------------


def _bool_int_coercion(spark, sf_dir):
    typed = normalise_source(_source(spark, sf_dir))
    flags = ["backlog_flag", "exception_flag", "records_touched", "error_count"]
    return typed.groupBy(*flags).agg(
        F.count("*").alias("n"), F.sum("source_row_number").alias("row_sum")
    )


def _timestamp_parse(spark, sf_dir):
    cells = {f"{c}_text": F.col(c) for c in TIMESTAMP_COLUMNS}
    source = _source(spark, sf_dir).withColumns(cells)
    found = [
        (
            F.col(f"{c}_text"),
            F.col(c),
            F.array_contains("_unparsed", f"invalid_{c}").alias(f"{c}_unparsed"),
        )
        for c in TIMESTAMP_COLUMNS
    ]
    typed = normalise_source(source)
    return _plain(typed.select(*_SOURCE_KEY, *[column for group in found for column in group]))


def _validation_errors(spark, sf_dir):
    return _plain(
        validate(_source(spark, sf_dir)).rows.select(
            *_SOURCE_KEY, "workflow_id", "validation_errors", "validation_status"
        )
    )


# --- staging ----------------------------------------------------------------------------------------


def _temporal_metrics(spark, sf_dir):
    timed = staging.add_temporal_metrics(_checked(spark, sf_dir).valid, orders.AS_OF)
    return _plain(
        timed.select(
            *_SOURCE_KEY,
            "updated_at",
            F.round("turnaround_hours", 6).alias("turnaround_hours"),
            F.round("age_hours", 6).alias("age_hours"),
            "processing_minutes",
        )
    )


def _dedup_latest(spark, sf_dir):
    timed = staging.add_temporal_metrics(_checked(spark, sf_dir).valid, orders.AS_OF)
    latest = staging.latest_per_workflow(timed)
    return _plain(latest.select("workflow_id", *_SOURCE_KEY, "updated_at"))


def _staging_rows(spark, sf_dir):
    stored = ALL_TABLES["workflow_events_clean"].conform(
        _staging(spark, sf_dir).withColumn("age_hours", loads.stored_hours(F.col("age_us")))
    )
    return _without(
        stored,
        "staging_event_id",
        "raw_event_id",
        "loaded_at",
        "validation_status",
        "validation_errors",
    )


# --- star ---------------------------------------------------------------------------------------------


def _dimension(name: str) -> Query:
    return lambda spark, sf_dir: _plain(_star(spark, sf_dir)[name])


def _priorities_in_use(spark, sf_dir):
    """The priority dimension with the number of runs that point to each member."""
    star = _star(spark, sf_dir)
    runs = star["fact_workflow_run"].groupBy("priority_key").agg(F.count("*").alias("n_runs"))
    members = star["dim_priority"].join(runs, "priority_key", "left")
    return _plain(members.withColumn("n_runs", F.coalesce("n_runs", F.lit(0))))


def _keyed(name: str) -> Query:
    """A fact or mart table with its dimension keys, without generated keys and load times."""

    def query(spark, sf_dir):
        table = ALL_TABLES[name]
        generated = [table.surrogate, *([table.stamped] if table.stamped else [])]
        return _counts_as_bigint(_without(_star(spark, sf_dir)[name], *generated))

    return query


def _loaded(spark, sf_dir):
    """The stored tables of a loaded warehouse."""
    return _warehouse(spark, sf_dir)[0]


def _report(build, tables=_star) -> Query:
    return lambda spark, sf_dir: _counts_as_bigint(_plain(build(tables(spark, sf_dir))))


def _summary(tables=_star, **filters) -> Query:
    def query(spark, sf_dir):
        df = reports.kpi_summary(tables(spark, sf_dir), **filters)
        means = [c for c, t in df.dtypes if t == "double"]
        return df.withColumns({c: F.round(c, 6) for c in means})

    return query


def _from_sql(call: str) -> Query:
    """A report over the loaded warehouse, asked for in SQL."""

    def query(spark, sf_dir):
        register_functions(_loaded(spark, sf_dir))
        found = spark.sql(f"SELECT * FROM {call}")
        means = [c for c, t in found.dtypes if t == "double"]
        return _counts_as_bigint(_plain(found.withColumns({c: F.round(c, 6) for c in means})))

    return query


def _workflow_exceptions(workflow_id: str, tables) -> DataFrame:
    """As in SQL: no rows where the report finds none."""
    try:
        return reports.workflow_exceptions(tables, workflow_id)
    except reports.NotFound:
        return reports.open_exceptions(tables).limit(0)


def _dashboard(tables):
    panels = reports.dashboard(tables)
    daily, exceptions, summary = panels["daily"], panels["exceptions"], panels["summary"]
    empty = F.lit("")
    return (
        daily.select(
            F.lit("daily").alias("panel"),
            F.col("calendar_date").cast("string").alias("day"),
            "team_name",
            F.col("workflow_type").alias("name"),
            F.col("total_workflows").cast("bigint").alias("n"),
        )
        .unionByName(
            exceptions.select(
                F.lit("exceptions").alias("panel"),
                F.col("detected_date").cast("string").alias("day"),
                "team_name",
                F.col("workflow_id").alias("name"),
                F.col("error_count").cast("bigint").alias("n"),
            )
        )
        .unionByName(
            summary.select(
                F.lit("summary").alias("panel"),
                empty.alias("day"),
                empty.alias("team_name"),
                empty.alias("name"),
                F.col("total_workflows").alias("n"),
            )
        )
    )


# --- loads --------------------------------------------------------------------------------------------


def _warehouse_after_redelivery(spark, sf_dir):
    """Three runs: the main file, the late file, and the late file again with other cells."""

    def build():
        store = _empty_warehouse(spark)
        late = orders.late_delivery(spark, sf_dir)
        changed = late.withColumns(
            {
                "error_count": (F.col("error_count").cast("int") + 1).cast("string"),
                "queue_name": F.concat("queue_name", F.lit(_AGAIN)),
            }
        )
        for rows in (orders.main_delivery(spark, sf_dir), late, changed):
            pipeline.refresh_rows(store, rows, scratch_path(spark, "run"), orders.AS_OF)
        return store

    return _once(spark, sf_dir, "redelivery", build)


def _append_once(spark, sf_dir):
    """Raw rows keep the content they were first stored with."""
    raw = _warehouse_after_redelivery(spark, sf_dir)["workflow_events_raw"]
    return _plain(raw.select(*SOURCE_COLUMNS))


def _raw_key_map(spark, sf_dir):
    """The stored row that each valid row of the late file refers to."""
    store = _warehouse_after_redelivery(spark, sf_dir)
    late = validate(orders.late_delivery(spark, sf_dir)).staged().valid
    keys = loads.batch_raw_keys(store, late)
    stored = store["workflow_events_raw"].select("raw_event_id", "workflow_id")
    return keys.join(stored, "raw_event_id").drop("raw_event_id")


def _quarantine_upsert(spark, sf_dir):
    """Rejects keep the content they came with last."""
    stored = _warehouse_after_redelivery(spark, sf_dir).read(QUARANTINE)
    errors = F.get_json_object("raw_payload", "$.error_count").cast("int")
    return _plain(
        stored.select(*_SOURCE_KEY, "workflow_id", "validation_errors", errors.alias("error_count"))
    )


def _staging_refresh(spark, sf_dir):
    """Staged rows take the new content under the raw id of the row they refer to."""
    store = _warehouse_after_redelivery(spark, sf_dir)
    keys = store["workflow_events_raw"].select("raw_event_id", *_SOURCE_KEY)
    again = F.col("queue_name").endswith(_AGAIN)
    staged = store["workflow_events_clean"].join(keys, "raw_event_id")
    origin = F.when(again, F.lit("refreshed")).otherwise(F.lit("kept")).alias("origin")
    return staged.select(*_SOURCE_KEY, "workflow_id", origin, "status")


# --- files --------------------------------------------------------------------------------------------


def _as_csv(spark, sf_dir, *without: str) -> str:
    """Both deliveries written as CSV files to the shared folder."""

    def build():
        path = scratch_path(spark, "csv")
        _source(spark, sf_dir).drop(*without).write.option("header", True).option("escape", '"').csv(path)
        return path

    return _once(spark, sf_dir, f"csv without {without}", build)


def _csv_source_rows(spark, sf_dir):
    return _without(normalise_source(read_workflow_csv(spark, _as_csv(spark, sf_dir))).select(
        *SOURCE_COLUMNS
    ))


def _csv_multiline(spark, sf_dir):
    """Files without lineage in which every third queue name holds line breaks, commas and quotes."""

    def build():
        path = scratch_path(spark, "csv")
        number = F.col("source_row_number")
        broken = F.concat(F.lit('Queue\n"'), F.lower("source_file_name"), F.lit('",\r\n\n'), number, F.lit('\n"'))
        cell = F.when(number.cast("bigint") % 3 == 0, broken).otherwise(F.col("queue_name"))
        rows = _source(spark, sf_dir).withColumns({"queue_name": cell, "place": number})
        rows = rows.drop(*_SOURCE_KEY).withColumnRenamed("place", "delivered_row")
        as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.options(header=True, escape='"', **as_is).csv(path)
        return path

    path = _once(spark, sf_dir, "csv with line breaks", build)
    rows = read_workflow_csv(spark, path)
    own = F.row_number().over(Window.partitionBy("source_file_name").orderBy(F.col("source_row_number").cast("bigint")))
    consecutive = (own == F.col("source_row_number").cast("bigint")).alias("consecutive")
    return rows.select("workflow_id", "queue_name", "delivered_row", "payload", consecutive)


def _csv_lineage(spark, sf_dir):
    """Files without lineage: rows in all, and whether the numbers of every file run from 1 to n."""
    rows = read_workflow_csv(spark, _as_csv(spark, sf_dir, *_SOURCE_KEY))
    number = F.col("source_row_number").cast("bigint")
    files = rows.groupBy("source_file_name").agg(
        F.count("*").alias("n"),
        F.min(number).alias("first"),
        F.max(number).alias("last"),
        F.count_distinct(number).alias("different"),
    )
    consecutive = (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("different") == F.col("n"))
    return files.agg(F.sum("n").alias("n_rows"), F.bool_and(consecutive).alias("consecutive"))


def _quarantine_csv(spark, sf_dir):
    """Rejects as they are written where there is no quarantine table."""

    def build():
        path = scratch_path(spark, "diagnostics")
        loads.write_quarantine_csv(_checked(spark, sf_dir).invalid, path)
        return path

    path = _once(spark, sf_dir, "quarantine csv", build)
    written = spark.read.option("header", True).option("escape", '"').csv(path)
    return written.select(
        "source_file_name",
        F.col("source_row_number").cast("bigint").alias("source_row_number"),
        F.coalesce("workflow_id", F.lit("")).alias("workflow_id"),
        "validation_errors",
    )


# --- members ------------------------------------------------------------------------------------------


def _dimension_upsert(spark, sf_dir):
    """Teams are known by region with outdated attributes; then all regions but one report by nation."""
    joined = orders.joined_orders(spark, sf_dir)
    by_region = joined.select(orders.team_of(F.col("r_name")).alias("team_name"))
    by_nation = joined.select(
        F.when(F.col("r_name") == "ASIA", orders.team_of(F.col("r_name")))
        .otherwise(F.col("n_name"))
        .alias("team_name")
    )
    known = dimensions.team_members(by_region).withColumns(
        {"department_name": F.lit("Old department"), "manager_name": F.lit("Old manager")}
    )
    stored = stage(dimensions.upsert_dimension(DIM_TEAM.empty(spark), known, DIM_TEAM))
    return dimensions.upsert_dimension(stored, dimensions.team_members(by_nation), DIM_TEAM)


def _slice_replace(spark, sf_dir):
    runs = reports.workflow_star(_warehouse_after_two_loads(spark, sf_dir))
    return _plain(runs.select("workflow_id", "calendar_date", "status_name", "exception_flag"))


def _slice_replace_exceptions(spark, sf_dir):
    store = _warehouse_after_two_loads(spark, sf_dir)
    named = store["fact_exception"].join(store["dim_date"], "date_key")
    return _plain(
        named.select("workflow_id", F.col("calendar_date").alias("detected_date"), "status_name")
    )


def _load_counts(spark, sf_dir):
    _, run, _ = _warehouse(spark, sf_dir)
    return spark.read.json(f"{run}/warehouse_counts").select("table_name", "loaded_rows")


def _row_account(spark, sf_dir):
    """Where every source row of the load went, part by part."""
    _, _, result = _warehouse(spark, sf_dir)
    return spark.createDataFrame(list(result["row_account"].items()), "part string, n bigint")


def _quality_summary(spark, sf_dir):
    store, _, _ = _warehouse(spark, sf_dir)
    return pipeline.quality_summary(store)


def _constraint_audit(spark, sf_dir):
    store, _, _ = _warehouse(spark, sf_dir)
    tables = {name: store[name] for name in ALL_TABLES}
    return constraints.audit(tables, ALL_TABLES)


# --- constraint checks on rows that break them --------------------------------------------------------


def _not_null_check(spark, sf_dir):
    rows = validate(_source(spark, sf_dir)).rows
    return constraints.null_counts(rows, SOURCE_COLUMNS)


def _unique_check(spark, sf_dir):
    rows = validate(_source(spark, sf_dir)).rows
    return constraints.duplicate_keys(rows, ["workflow_id"])


def _foreign_key_check(spark, sf_dir):
    rows = validate(_source(spark, sf_dir)).rows
    priorities = dimensions.priority_members(spark)
    return constraints.dangling_keys(rows, "priority", priorities, "priority_name")


# --- other tables ---------------------------------------------------------------------------------------


def _events(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _dedup_events(spark, sf_dir):
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").asc()]
    latest = keyed.pick_one(_events(spark, sf_dir), ["user_id"], order)
    return _plain(latest.select("user_id", "event_id", "event_type", "ts"))


def _events_daily(spark, sf_dir):
    daily = (
        _events(spark, sf_dir)
        .groupBy(F.to_date("ts").alias("calendar_date"), "event_type")
        .agg(F.count("*").alias("total_events"), F.count_distinct("user_id").alias("users"))
    )
    per_user = ratio_half_up(F.col("total_events"), F.col("users"))
    return _plain(daily.withColumn("events_per_user", per_user))


# --- contract -------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """KPI summary per day, team and workflow type, from the order tables."""
    return queries()["kpi_daily_summary"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "source_profile": lambda s, d: source_profile(_source(s, d)),
        "source_rows": _source,
        "normalized_source": lambda s, d: _without(normalise_source(_source(s, d)), "_unparsed"),
        "bool_int_coercion": _bool_int_coercion,
        "timestamp_parse": _timestamp_parse,
        "validation_errors": _validation_errors,
        "validation_summary": lambda s, d: validate(_source(s, d)).summary,
        "valid_rows": lambda s, d: _without(
            _checked(s, d).valid, "validation_errors", "validation_status"
        ),
        "quarantine_rows": lambda s, d: _without(_checked(s, d).invalid, "validation_status"),
        "quarantine_json": lambda s, d: _plain(quarantine_records(_checked(s, d).invalid)),
        "temporal_metrics": _temporal_metrics,
        "dedup_latest": _dedup_latest,
        "sla_breach": lambda s, d: _plain(
            _staging(s, d).select("workflow_id", "due_at", "sla_breached")
        ),
        "exception_rules": lambda s, d: _staging(s, d).select(
            "workflow_id", "status", "exception_flag", "exception_type"
        ),
        "staging": _staging_rows,
        "quality_score": lambda s, d: _staging(s, d).select(
            "workflow_id", facts.quality_score().cast("int").alias("quality_score")
        ),
        "backlog_rows": lambda s, d: facts.backlog_rows(_staging(s, d)).select(
            "workflow_id", "status", "backlog_flag"
        ),
        "dim_team": _dimension("dim_team"),
        "dim_workflow_type": _dimension("dim_workflow_type"),
        "dim_priority": _priorities_in_use,
        "dim_status": _dimension("dim_status"),
        "dim_date": _dimension("dim_date"),
        "kpi_daily_summary": lambda s, d: _plain(facts.build_kpi_daily(_staging(s, d))),
        "fact_backlog_daily": lambda s, d: _plain(
            facts.build_backlog_daily(_staging(s, d)).withColumnRenamed("priority", "priority_name")
        ),
        "fact_workflow_run": _keyed("fact_workflow_run"),
        "fact_exception": _keyed("fact_exception"),
        "fact_backlog_keyed": _keyed("fact_backlog_daily"),
        "kpi_daily_keyed": _keyed("kpi_daily_summary"),
        "team_performance_daily": _report(reports.team_performance_daily),
        "open_exceptions": _report(reports.open_exceptions),
        "kpi_summary": _summary(),
        "kpi_summary_filtered": _summary(
            start="1997-01-01", end="1999-06-30", team="RiskOps", workflow_type="RefundReview"
        ),
        "kpi_summary_empty": _summary(team="NoSuchTeam"),
        "kpi_daily_page": _report(lambda t: reports.kpi_daily(t, page=2).rows),
        "kpi_daily_total": _report(lambda t: reports.kpi_daily(t, workflow_type="KycRefresh").total),
        "team_performance_page": _report(
            lambda t: reports.team_performance(
                t, start="1998-01-01", team="CustomerCare", page=3, page_size=20
            ).rows
        ),
        "team_performance_total": _report(
            lambda t: reports.team_performance(t, start="1998-01-01", team="CustomerCare").total
        ),
        "stored_kpi_summary": _summary(
            _loaded, start="1997-01-01", end="1999-06-30", team="RiskOps", workflow_type="RefundReview"
        ),
        "stored_kpi_daily_page": _report(lambda t: reports.kpi_daily(t, page=2).rows, _loaded),
        "stored_team_performance_page": _report(
            lambda t: reports.team_performance(
                t, start="1998-01-01", team="CustomerCare", page=3, page_size=20
            ).rows,
            _loaded,
        ),
        "stored_exceptions_page": _report(
            lambda t: reports.exceptions(t, team="PaymentsOps", page=3).rows, _loaded
        ),
        "stored_backlog_page": _report(
            lambda t: reports.backlog(t, start="1996-01-01", team="ClaimsReview").rows, _loaded
        ),
        "stored_workflow_detail": _report(
            lambda t: reports.workflow_detail(t, "WF-00000007"), _loaded
        ),
        "sql_kpi_summary": _from_sql(
            "kpi_summary(DATE'1997-01-01', DATE'1999-06-30', 'RiskOps', 'RefundReview')"
        ),
        "sql_team_performance": _from_sql(
            "team_performance(team => 'CustomerCare', start_day => DATE'1998-01-01') "
            "ORDER BY calendar_date DESC, workflow_type LIMIT 20 OFFSET 40"
        ),
        "sql_exceptions": _from_sql(
            "exceptions(team => 'PaymentsOps') ORDER BY detected_date DESC, workflow_id LIMIT 50 OFFSET 100"
        ),
        "sql_backlog": _from_sql(
            "backlog(DATE'1996-01-01', team => 'ClaimsReview') "
            "ORDER BY calendar_date DESC, team_name, workflow_type, priority_name LIMIT 50"
        ),
        "sql_workflow_detail": _from_sql("workflow_detail('WF-00000007')"),
        "exceptions_page": _report(lambda t: reports.exceptions(t, team="PaymentsOps", page=3).rows),
        "exceptions_total": _report(
            lambda t: reports.exceptions(
                t, end="2000-12-31", priority="critical", status="failed"
            ).total
        ),
        "workflow_exceptions": _report(partial(_workflow_exceptions, "WF-00000002")),
        "backlog_page": _report(
            lambda t: reports.backlog(t, start="1996-01-01", team="ClaimsReview").rows
        ),
        "backlog_total": _report(lambda t: reports.backlog(t, priority="high").total),
        "workflow_detail": _report(lambda t: reports.workflow_detail(t, "WF-00000007")),
        "latest_per_workflow": _report(reports.latest_runs),
        "dashboard": _report(_dashboard),
        "csv_source_rows": _csv_source_rows,
        "csv_lineage": _csv_lineage,
        "csv_multiline": _csv_multiline,
        "quarantine_csv": _quarantine_csv,
        "append_once": _append_once,
        "raw_key_map": _raw_key_map,
        "quarantine_upsert": _quarantine_upsert,
        "staging_refresh": _staging_refresh,
        "dimension_upsert": _dimension_upsert,
        "slice_replace": _slice_replace,
        "slice_replace_exceptions": _slice_replace_exceptions,
        "load_counts": _load_counts,
        "row_account": _row_account,
        "quality_summary": _quality_summary,
        "constraint_audit": _constraint_audit,
        "not_null_check": _not_null_check,
        "unique_check": _unique_check,
        "foreign_key_check": _foreign_key_check,
        "dedup_events": _dedup_events,
        "events_daily": _events_daily,
    }
    found = {name: _with_session(query) for name, query in registered.items()}
    if corpus:
        found |= corpus.queries()
        found["pipeline"] = corpus_pipeline.run
    return found


def _with_session(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def oracle_sql() -> dict[str, str]:
    found = dict(oracle.oracle_sql())
    if corpus:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
