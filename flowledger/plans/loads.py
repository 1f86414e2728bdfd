"""How a batch enters the warehouse. Every step may be repeated with the same result."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from flowledger.constants import QUARANTINED, SOURCE_ROW_TAKEN
from flowledger.functions.timing import date_key, stored_hours
from flowledger.operators.constraints import (
    invalid_json,
    require_empty,
    require_not_null,
)
from flowledger.operators.dimensions import dimensions_of, seen_members, upsert_dimension
from flowledger.operators.facts import (
    build_backlog_daily,
    build_kpi_daily,
    fact_backlog_daily,
    fact_exception,
    fact_workflow_run,
    kpi_daily_summary,
)
from flowledger.operators.keyed import (
    EVENT_NUMBER,
    FIRST_NUMBER,
    firsts_of_repeated,
    last_per_key,
    only_firsts,
    only_new,
    replace_by_key,
    with_firsts,
)
from flowledger.operators.numbering import stage
from flowledger.operators.staging import (
    add_temporal_metrics,
    flag_exceptions,
    normalise_fields,
    prepare_staging,
)
from flowledger.operators.validation import quarantine_records
from flowledger.store import Change, Warehouse
from flowledger.tables import (
    DIMENSIONS,
    FACT_BACKLOG_DAILY,
    FACT_EXCEPTION,
    FACT_WORKFLOW_RUN,
    KPI_DAILY_SUMMARY,
    QUARANTINE,
    RAW,
    STAGING,
    Table,
)

SOURCE_KEY = ("source_file_name", "source_row_number")
# What neither staging nor facts and mart take from a prepared row; they store the age in a form of their own.
NOT_LOADED = ("payload", "updated_at", "turnaround_us", "turnaround_hours", "age_hours")


def together(*steps: Callable[[], object]) -> list:
    """Run independent Spark jobs side by side, so that the tail of one leaves no cores idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
        return [step.result() for step in running]


def check_batch(valid: DataFrame) -> None:
    """Refuse a batch that the raw table could not hold, before anything is written."""
    stored = [c for c in RAW.required if c not in (RAW.surrogate, RAW.stamped)]
    require_not_null(valid, stored, RAW.name)
    require_empty(invalid_json(valid, "payload"), f"{RAW.name}: payload is not JSON")


def check_staging(valid: DataFrame, as_of) -> None:
    """Refuse flagged rows without an exception type, which the exception fact could not hold.

    Looks at all valid rows first, which needs no shuffle; only if some are suspect does it matter
    which row of each workflow will be kept.
    """
    timed = add_temporal_metrics(normalise_fields(valid), as_of)
    untyped = flag_exceptions(timed, as_of).where("exception_flag AND exception_type IS NULL")
    if not untyped.isEmpty():
        kept = prepare_staging(valid, as_of).where("exception_flag")
        require_not_null(kept, ["exception_type"], FACT_EXCEPTION.name)


# --- raw and quarantine -----------------------------------------------------------------


def load_quarantine(
    store: Warehouse, invalid: DataFrame, diagnostics: str, csv_name: str = "workflow_events_quarantine"
) -> None:
    """Insert rejected rows, replacing earlier rejects of the same source row.

    Without a quarantine table the rows go to a CSV folder, so that they are not lost.
    """
    if invalid.isEmpty():
        return
    if not store.table_exists(QUARANTINE):
        write_quarantine_csv(invalid, f"{diagnostics}/{csv_name}.csv")
        return
    latest = quarantine_records(last_per_key(invalid, SOURCE_KEY))
    batch = QUARANTINE.conform(latest.withColumnRenamed(EVENT_NUMBER, QUARANTINE.surrogate))
    touched = store.touched(QUARANTINE, batch)
    stored = store.within(QUARANTINE, touched).select(*QUARANTINE.columns)
    store.replace(QUARANTINE, replace_by_key(stored, batch, SOURCE_KEY), touched)


def write_quarantine_csv(invalid: DataFrame, path: str) -> None:
    flat = [c for c, t in invalid.dtypes if not t.startswith(("array", "struct"))]
    rows = invalid.select(*flat, F.to_json("validation_errors").alias("validation_errors"))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


# Finds the first rows of repeated source rows. A run looks once, for all valid rows: those serve its parts, too,
# as the rows of one key are always in the same part.
FirstsOf = Callable[[DataFrame], DataFrame | None]


def source_firsts(rows: DataFrame) -> DataFrame | None:
    return firsts_of_repeated(rows, SOURCE_KEY)


def load_raw(store: Warehouse, valid: DataFrame, firsts_of: FirstsOf = source_firsts) -> DataFrame:
    """Append the rows whose source row is not stored yet; a stored row is never changed.

    Only files that were delivered before are compared with stored rows; a new file needs no look at
    history. Returns the (written) names of the batch's files that were delivered before. A file is noted
    before its rows are appended, so after a stop in between it counts as delivered and is compared.
    """
    number = F.col("source_row_number")
    files = stage(
        valid.groupBy("source_file_name").agg(
            F.count("*").alias("n_rows"), F.min(number).alias("first_row"), F.max(number).alias("last_row")
        )
    )
    names = store.delivered_files().select("source_file_name")
    seen = stage(files.select("source_file_name").join(names, "source_file_name", "left_semi"))
    store.note_files(files)
    if seen.isEmpty():
        fresh = only_firsts(valid, firsts_of(valid))
    else:
        known, new = split_by_file(valid, seen)
        stored = store.within(RAW, store.touched(RAW, known))
        fresh = only_firsts(new, firsts_of(new))
        fresh = fresh.unionByName(only_new(known, stored, SOURCE_KEY, firsts_of))
    rows = RAW.conform(fresh.withColumnRenamed(EVENT_NUMBER, RAW.surrogate))
    store.append(RAW, rows, store.sizes(RAW, fresh))
    return seen


def split_by_file(rows: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that were delivered before, and the others. `seen` has one row per file."""
    known = rows.join(seen, "source_file_name", "left_semi")
    return known, rows.join(seen, "source_file_name", "left_anti")


def raw_key_map(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """(raw_event_id, file, row) of every stored row of the files in a batch.

    For callers who want whole files. The loads use `batch_raw_keys`, which reads less.
    """
    files = batch.select("source_file_name").where("source_file_name IS NOT NULL").distinct()
    return raw.join(files, "source_file_name", "left_semi").select("raw_event_id", *SOURCE_KEY)


def batch_raw_keys(
    store: Warehouse, valid: DataFrame, seen: DataFrame | None = None, firsts_of: FirstsOf = source_firsts
) -> DataFrame:
    """(raw_event_id, file, row) of the stored rows a batch refers to.

    Rows of new files (all but those in `seen`, where that is given) were stored by this load under their
    own numbers. Other rows are matched on (file, row), within the buckets the batch touches: unlike a
    match on the file name that cannot be skewed by one large file.
    """
    if seen is None:
        return _stored_keys(store, valid)
    if seen.isEmpty():
        return _own_keys(valid, firsts_of)
    known, new = split_by_file(valid, seen)
    return _own_keys(new, firsts_of).unionByName(_stored_keys(store, known))


def _own_keys(rows: DataFrame, firsts_of: FirstsOf) -> DataFrame:
    firsts = only_firsts(rows, firsts_of(rows))
    return firsts.select(F.col(EVENT_NUMBER).alias("raw_event_id"), *SOURCE_KEY)


def _stored_keys(store: Warehouse, rows: DataFrame) -> DataFrame:
    stored = store.within(RAW, store.touched(RAW, rows)).select("raw_event_id", *SOURCE_KEY)
    return stored.join(rows.select(*SOURCE_KEY), list(SOURCE_KEY), "left_semi")


def with_raw_keys(
    kept: DataFrame,
    raw_keys: DataFrame,
    valid: DataFrame,
    seen: DataFrame,
    firsts_of: FirstsOf = source_firsts,
) -> DataFrame:
    """The kept version of each workflow with the raw_event_id of its source row.

    Rows of new files, all but those in `seen`, were stored under their own number or that of the first valid
    row with the same key. Only rows of files that were delivered before are joined with `raw_keys`.
    """
    if seen.isEmpty():
        return _with_own_keys(kept, firsts_of(valid))
    known, new = split_by_file(kept, seen)
    _, new_valid = split_by_file(valid, seen)
    return known.join(raw_keys, list(SOURCE_KEY)).unionByName(_with_own_keys(new, firsts_of(new_valid)))


def _with_own_keys(kept: DataFrame, firsts: DataFrame | None) -> DataFrame:
    if firsts is None:
        return kept.withColumn("raw_event_id", F.col(EVENT_NUMBER))
    found = with_firsts(kept, firsts).withColumn("raw_event_id", F.coalesce(FIRST_NUMBER, EVENT_NUMBER))
    return found.drop(FIRST_NUMBER)


def taken_rows(valid: DataFrame, latest: DataFrame, firsts: DataFrame | None) -> DataFrame:
    """Valid rows whose source row went to another workflow, as rejects with a code of their own.

    Where different workflows claim one source row, the first keeps it: `firsts` are those of `latest`.
    """
    if firsts is None:
        lost = latest.select(EVENT_NUMBER).limit(0)
    else:
        lost = with_firsts(latest, firsts).where(F.col(FIRST_NUMBER) != F.col(EVENT_NUMBER)).select(EVENT_NUMBER)
    return valid.join(lost, EVENT_NUMBER, "left_semi").withColumns(
        {
            "validation_errors": F.array(F.lit(SOURCE_ROW_TAKEN)),
            "validation_status": F.lit(QUARANTINED),
        }
    )


# --- staging --------------------------------------------------------------------------------


def load_staging(store: Warehouse, staging: DataFrame) -> None:
    """Replace the staged rows of the batch's raw rows."""
    if staging.isEmpty():
        return
    batch = STAGING.conform(
        staging.withColumn("age_hours", stored_hours(F.col("age_us"))).withColumnRenamed(
            EVENT_NUMBER, STAGING.surrogate
        )
    )
    sizes = store.sizes(STAGING, staging)
    stored = store.within(STAGING, sorted(sizes)).select(*STAGING.columns)
    store.replace(STAGING, replace_by_key(stored, batch, ["raw_event_id"]), sorted(sizes), sizes)


# --- dimensions, facts, mart ------------------------------------------------------------------


def load_dimensions(store: Warehouse, members: dict[str, DataFrame]) -> None:
    """Upsert the members a batch holds."""

    def load(table: Table) -> None:
        store.snapshot(table, upsert_dimension(store.read(table), members[table.name], table))

    together(*[partial(load, table) for table in DIMENSIONS])


def load_warehouse(store: Warehouse, staging: DataFrame) -> DataFrame:
    """Dimensions, then facts and mart in one commit; returns (table_name, loaded_rows).

    `staging` must be a written stage: it is read once for members and counts, and once per fact table. An
    empty batch changes nothing. A load that stops before the commit leaves facts and mart as they were.
    """
    if staging.isEmpty():
        return staging.sparkSession.range(0).selectExpr("'' AS table_name", "id AS loaded_rows")
    seen, backlog, kpi = together(
        lambda: stage(seen_members(staging)),
        lambda: stage(build_backlog_daily(staging)),
        lambda: stage(build_kpi_daily(staging)),
    )
    load_dimensions(store, dimensions_of(seen))
    days = seen.where("kind = 'calendar_date' AND calendar_date IS NOT NULL")
    dates = stage(days.select(date_key(F.col("calendar_date")).alias("date_key")))
    number = store.next_commit()

    def load(table: Table, rows: DataFrame) -> Change:
        numbered = rows.withColumnRenamed(EVENT_NUMBER, table.surrogate)
        return replace_slices(store, table, table.conform(numbered), dates, number)

    changes = together(
        lambda: load(FACT_WORKFLOW_RUN, fact_workflow_run(staging, store)),
        lambda: load(FACT_EXCEPTION, fact_exception(staging, store)),
        lambda: load(FACT_BACKLOG_DAILY, fact_backlog_daily(backlog, store)),
        lambda: load(KPI_DAILY_SUMMARY, kpi_daily_summary(kpi, store)),
    )
    store.commit(number, changes)
    whole = seen.where("kind = 'all'")
    counts = [
        (FACT_WORKFLOW_RUN, whole.select("n_rows")),
        (FACT_EXCEPTION, whole.select("n_flagged")),
        (FACT_BACKLOG_DAILY, backlog.agg(F.count("*"))),
        (KPI_DAILY_SUMMARY, kpi.agg(F.count("*"))),
    ]
    named = [df.toDF("loaded_rows").select(F.lit(t.name).alias("table_name"), "loaded_rows") for t, df in counts]
    return reduce(DataFrame.unionByName, named)


def replace_slices(
    store: Warehouse, table: Table, incoming: DataFrame, dates: DataFrame, number: int
) -> Change:
    """Write what replaces all rows of the given dates, also where nothing new comes in for a date.

    In a table laid out by date only those dates are written. In one laid out by month (the small
    aggregates) the other dates of a touched month are carried over.
    """
    touched = store.touched(table, dates)
    rows = incoming
    if store.layout(table) != "date_key":
        stored = store.within(table, touched).select(*table.columns)
        rows = stored.join(dates, "date_key", "left_anti").unionByName(incoming)
    return store.write_beside(table, rows, touched, number)
