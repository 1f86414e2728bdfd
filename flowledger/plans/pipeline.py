"""From a delivery to a refreshed warehouse.

`refresh` keeps each stage below `<runs>/<run_id>/`: a run that is started again goes on behind the
last finished stage. Stages are written files, so the loss of executors never reaches further back
than the stage at work.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.operators.keyed import (
    EVENT_NUMBER,
    first_per_key,
    only_firsts,
)
from flowledger.operators.numbering import ROW_GROUP, stage, with_place, with_row_number
from flowledger.operators.staging import prepare_staging
from flowledger.operators.validation import Validated, validate
from flowledger.plans.loads import (
    NOT_LOADED,
    SOURCE_KEY,
    batch_raw_keys,
    check_batch,
    check_staging,
    load_quarantine,
    load_raw,
    load_staging,
    load_warehouse,
    source_firsts,
    taken_rows,
    with_raw_keys,
)
from flowledger.session import configure, scratch_path
from flowledger.sources.files import exists, identity, remove
from flowledger.sources.workflow_csv import ensure_input_exists, read_workflow_csv
from flowledger.store import Warehouse

COUNTED_TABLES = (
    "workflow_events_raw",
    "workflow_events_clean",
    "fact_workflow_run",
    "fact_exception",
    "kpi_daily_summary",
)


def run_pipeline(
    store: Warehouse,
    input_path: str,
    dry_run: bool = False,
    skip_load: bool = False,
    as_of: datetime | str | None = None,
) -> dict[str, object]:
    """Validate, transform and load a delivery.

    With `dry_run` or `skip_load` nothing reaches the warehouse; the checked rows go to the scratch folder.
    """
    if dry_run or skip_load:
        return dry_run_counts(store.spark, input_path, as_of)
    run_dir = scratch_path(store.spark, "run")
    return refresh_rows(store, read_workflow_csv(store.spark, input_path), run_dir, as_of)


def dry_run_counts(
    spark: SparkSession, input_path: str, as_of: datetime | str | None = None
) -> dict[str, object]:
    configure(spark)
    checked = validate(read_workflow_csv(spark, input_path)).staged()
    return {
        "validation_summary": checked.summary.first().asDict(),
        "staging_rows": first_per_key(
            prepare_staging(checked.valid, _fixed(as_of)), SOURCE_KEY
        ).count(),
        "warehouse_load_counts": {},
    }


def refresh(
    store: Warehouse,
    input_path: str,
    runs_dir: str,
    run_id: str,
    as_of: datetime | str | None = None,
) -> dict[str, object]:
    """The daily flow: readiness, extract, validate, load raw, transform and load, quality summary.

    A run that was interrupted goes on behind its last stage if input and `as_of` are the same; with
    another input or moment the run id starts afresh.
    """
    ensure_input_exists(store.spark, input_path)
    source = read_workflow_csv(store.spark, input_path)
    run_dir = f"{runs_dir.rstrip('/')}/{run_id}"
    moment = _opened(store.spark, run_dir, identity(store.spark, input_path), as_of)
    result = refresh_rows(store, source, run_dir, moment)
    return {
        "input_path": input_path,
        **result,
        "database_row_counts": {r.table_name: r.row_count for r in quality_summary(store).collect()},
    }


def _opened(
    spark: SparkSession, run_dir: str, source_identity: str, as_of: datetime | str | None
) -> str:
    """The moment of a run: that of the run to go on with, or of a new one in an emptied folder."""
    wanted = None if as_of is None else str(as_of)
    path = f"{run_dir}/run"
    if _finished(spark, path):
        run = spark.read.schema("source string, as_of string").json(path).first()
        if run.source == source_identity and wanted in (None, run.as_of):
            return run.as_of
    if exists(spark, run_dir):
        remove(spark, run_dir)
    moment = wanted or datetime.now(tz=UTC).isoformat()
    spark.createDataFrame([(source_identity, moment)], "source string, as_of string").coalesce(
        1
    ).write.json(path)
    return moment


def refresh_rows(
    store: Warehouse, source: DataFrame, run_dir: str, as_of: datetime | str | None = None
) -> dict[str, object]:
    """Load source rows into the warehouse, stage by stage."""
    configure(store.spark)
    checked = validated_stage(store, source, run_dir)
    summary = _kept(
        store.spark, f"{run_dir}/validation_summary", lambda: checked.summary, "json"
    ).first()
    staging = load_and_stage(store, checked, run_dir, as_of)
    counts = _kept(
        store.spark,
        f"{run_dir}/warehouse_counts",
        lambda: load_warehouse(store, staging).coalesce(1),
        "json",
    )
    return {
        "validation_summary": {c: summary[c] for c in _SUMMARY},
        "staging_rows": staging.count(),
        "row_account": row_account(store.spark, checked, run_dir),
        "warehouse_load_counts": {r.table_name: r.loaded_rows for r in counts.collect()},
    }


def row_account(spark: SparkSession, checked: Validated, run_dir: str) -> dict[str, int]:
    """Where every source row of a run went.

    The parts from `raw_new` to `reject_repeats` add up to `source_rows`; `staged`, `older_versions` and
    `taken_rows` add up to the valid rows, that is to the three raw parts.
    """

    def count(name: str) -> int:
        return spark.read.parquet(f"{run_dir}/{name}").count()

    start = spark.read.parquet(f"{run_dir}/first_event_no").first()[0]
    raw_keys = spark.read.parquet(f"{run_dir}/raw_keys")
    known, stored = raw_keys.agg(
        F.count_if(F.col("raw_event_id") <= start), F.count(F.lit(1))
    ).first()
    valid, invalid = checked.valid.count(), checked.invalid.count()
    rejected = checked.invalid.select(*SOURCE_KEY).distinct().count()
    latest, staged = count("latest"), count("staging")
    return {
        "source_rows": valid + invalid,
        "raw_new": stored - known,
        "raw_known": known,
        "raw_repeats": valid - stored,
        "rejected": rejected,
        "reject_repeats": invalid - rejected,
        "staged": staged,
        "older_versions": valid - latest,
        "taken_rows": latest - staged,
    }


_SUMMARY = ("input_rows", "valid_rows", "invalid_rows", "quarantined_rows")


def validated_stage(store: Warehouse, source: DataFrame, run_dir: str) -> Validated:
    """All source rows, checked and numbered; valid and quarantined rows lie in separate folders."""
    spark = store.spark
    rows = _kept(
        spark,
        f"{run_dir}/validated",
        lambda: with_place(validate(source).rows),
        partition="validation_status",
    )
    start = _kept(
        spark,
        f"{run_dir}/first_event_no",
        lambda: spark.range(1).select(F.lit(store.reserve(rows.count())).alias("start")),
    ).first()[0]
    return Validated(with_row_number(rows, EVENT_NUMBER, start))


def load_and_stage(
    store: Warehouse, checked: Validated, run_dir: str, as_of: datetime | str | None
) -> DataFrame:
    """Write quarantine, raw and staging rows; returns the staged rows with their raw keys."""
    spark = store.spark
    path = f"{run_dir}/staging"
    if not _finished(spark, path):
        moment = _fixed(as_of)
        check_batch(checked.valid)
        check_staging(checked.valid, moment)
        latest = _kept(
            spark, f"{run_dir}/latest", lambda: prepare_staging(checked.valid, moment).drop(*NOT_LOADED)
        )
        load_quarantine(store, checked.invalid, f"{run_dir}/diagnostics")
        repeated = source_firsts(checked.valid)
        firsts = None if repeated is None else source_firsts(latest)
        taken = taken_rows(checked.valid, latest, firsts)
        load_quarantine(store, taken, f"{run_dir}/diagnostics", "workflow_events_taken_rows")
        seen = load_raw(store, checked.valid, lambda _: repeated)
        raw_keys = _kept(
            spark,
            f"{run_dir}/raw_keys",
            lambda: batch_raw_keys(store, checked.valid, seen, lambda _: repeated),
        )
        kept = only_firsts(latest, firsts)
        stage(with_raw_keys(kept, raw_keys, checked.valid, seen, lambda _: repeated), path)
    staging = spark.read.parquet(path)
    if staging.isEmpty():
        raise RuntimeError("No raw keys were resolved for staging rows")
    load_staging(store, staging)
    return staging


def quality_summary(store: Warehouse) -> DataFrame:
    """(table_name, row_count) of the main tables."""
    counts = [
        store[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in COUNTED_TABLES
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def _fixed(as_of: datetime | str | None) -> datetime | str:
    """One moment for the whole run, also if it is resumed or a task is retried."""
    return as_of if as_of is not None else datetime.now(tz=UTC)


def _finished(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def _kept(
    spark: SparkSession, path: str, build, file_format: str = "parquet", partition: str | None = None
) -> DataFrame:
    """The rows of a finished stage, or the result of building it now."""
    if not _finished(spark, path):
        writer = build().write.mode("overwrite").options(**ROW_GROUP).format(file_format)
        (writer.partitionBy(partition) if partition else writer).save(path)
    return spark.read.format(file_format).load(path)
