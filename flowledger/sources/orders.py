"""The order tables of the test data, presented as workflow event rows.

Each order becomes one workflow event with the 20 source columns as text. Some cells are spoilt on
purpose, so that every validation rule and coercion has rows to work on. Two deliveries exist: the
main file holds every order; the late file repeats the orders with returned lines, one day on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowledger.constants import SOURCE_COLUMNS

AS_OF = "2001-09-01T00:00:00Z"
MAIN_FILE = "orders.csv"
LATE_FILE = "orders_late.csv"

# fixed values of the adapter
_TYPE_OF_SEGMENT = {
    "BUILDING": ("InvoiceApproval", 24),
    "AUTOMOBILE": ("RefundReview", 12),
    "MACHINERY": ("ClaimsValidation", 36),
    "HOUSEHOLD": ("VendorOnboarding", 72),
}
_OTHER_TYPE = ("KycRefresh", 48)
_TEAM_OF_REGION = {
    "AFRICA": "PaymentsOps",
    "AMERICA": "CustomerCare",
    "ASIA": "ClaimsReview",
    "EUROPE": "RiskOps",
    "MIDDLE EAST": "FieldOps",
}
_PRIORITY_OF_ORDER = {
    "1-URGENT": " CRITICAL ",
    "2-HIGH": "High",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "low",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(value: Column, cases: dict, otherwise) -> Column:
    chosen = F.lit(otherwise)
    for key, result in cases.items():
        chosen = F.when(value == key, F.lit(result)).otherwise(chosen)
    return chosen


def team_of(region: Column) -> Column:
    return _pick(region, _TEAM_OF_REGION, "FieldOps")


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with segment, region and line counts. Only the columns in use are read."""
    lines = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count("*").alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
        )
    )
    places = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        _table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name", "r_name")
    )
    placed = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    return (
        placed.join(customers, "o_custkey")
        .join(lines, "o_orderkey", "left")
        .fillna(0, ["n_lines", "n_ret"])
    )


def _iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _plus(instant: Column, **span) -> Column:
    return instant + F.make_dt_interval(**span)


def _events(orders: DataFrame, deliveries: Column) -> DataFrame:
    """One event per order and delivery; `deliveries` is an array of 0 (main file) and 1 (late)."""
    k = F.col("o_orderkey")

    def every(n: int) -> Column:
        return k % n == 0

    segment = F.col("c_mktsegment")
    sla = _pick(segment, {s: hours for s, (_, hours) in _TYPE_OF_SEGMENT.items()}, _OTHER_TYPE[1])
    kind = _pick(segment, {s: name for s, (name, _) in _TYPE_OF_SEGMENT.items()}, _OTHER_TYPE[0])
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when((F.col("o_orderstatus") == "O") & (k % 2 == 0), F.lit("queued"))
        .when(F.col("o_orderstatus") == "O", F.lit("in_progress"))
        .when(k % 3 == 0, F.lit("failed"))
        .when(k % 3 == 1, F.lit("cancelled"))
        .otherwise(F.lit("in_progress"))
    )
    timed = orders.withColumn("_late", F.explode(deliveries)).withColumns(
        {
            "_kind": kind,
            "_sla": sla.cast("int"),
            "_status": status,
            "_created": _plus(
                F.col("o_orderdate").cast("timestamp"), mins=(k % 1440).cast("int")
            ),
        }
    )
    created, state = F.col("_created"), F.col("_status")
    shift = F.make_dt_interval(days=F.col("_late"))
    started = F.when(every(109), created - F.make_dt_interval(mins=F.lit(5))).otherwise(
        _plus(created, mins=(2 + k % 59).cast("int"))
    )
    completed = F.when(every(127), created - F.make_dt_interval(days=F.lit(1))).otherwise(
        _plus(created, mins=(60 + k % 4320).cast("int"))
    )
    due = F.when(every(137), created - F.make_dt_interval(days=F.lit(1))).otherwise(
        _plus(created, hours=F.col("_sla"))
    )
    ends = state.isin("completed", "failed", "cancelled")
    flagged = (F.col("n_ret") >= 2) | (state == "failed")
    errors = F.least(F.col("n_ret"), F.lit(4))
    columns = {
        "source_file_name": F.when(F.col("_late") == 1, F.lit(LATE_FILE)).otherwise(F.lit(MAIN_FILE)),
        "source_row_number": (k + 1).cast("string"),
        "workflow_id": F.when(every(101), F.lit("  ")).otherwise(
            F.concat(F.lit("WF-"), F.lpad(k.cast("string"), 8, "0"))
        ),
        "workflow_type": F.col("_kind"),
        "team_name": team_of(F.col("r_name")),
        "assignee_id": F.when(every(13), F.lit("")).otherwise(
            F.concat(F.lit("USR-"), (1000 + F.col("o_custkey") % 500).cast("string"))
        ),
        "priority": F.when(every(103), F.lit("urgent")).otherwise(
            _pick(F.col("o_orderpriority"), _PRIORITY_OF_ORDER, "LOW")
        ),
        "status": F.when(every(107), F.lit("unknown"))
        .when(state == "completed", F.lit(" Completed "))
        .otherwise(state),
        "queue_name": F.concat(F.lower("n_name"), F.lit(" desk")),
        "created_at": _iso(created),
        "started_at": F.when(every(113), F.lit("half past six")).otherwise(_iso(started + shift)),
        "completed_at": F.when(every(131) | ~ends, F.lit("")).otherwise(_iso(completed + shift)),
        "due_at": F.when(every(149), F.lit("")).otherwise(_iso(due)),
        "backlog_flag": F.when(state == "queued", F.lit("Y"))
        .when(state == "in_progress", F.lit("true"))
        .otherwise(F.lit("0")),
        "exception_flag": F.when(flagged, F.lit("true")).otherwise(F.lit("no")),
        "exception_type": F.when(flagged, F.lit("validation_error")).otherwise(F.lit("")),
        "source_system": F.concat(F.lit("orders "), F.lower("r_name")),
        "records_touched": F.when(every(139), F.lit("abc")).otherwise(
            F.col("n_lines").cast("string")
        ),
        "error_count": errors.cast("string"),
        "payload": F.concat(
            F.lit('{"records_touched": '),
            F.col("n_lines").cast("string"),
            F.lit(', "error_count": '),
            errors.cast("string"),
            F.lit("}"),
        ),
    }
    return timed.select(*[columns[c].alias(c) for c in SOURCE_COLUMNS])


def _resent() -> Column:
    return F.col("n_ret") >= 1


def main_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(joined_orders(spark, sf_dir), F.array(F.lit(0)))


def late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(joined_orders(spark, sf_dir).where(_resent()), F.array(F.lit(1)))


def all_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both files as one batch, in one pass: many workflows come twice."""
    both = F.when(_resent(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return _events(joined_orders(spark, sf_dir), both)
