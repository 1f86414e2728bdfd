"""Parquet tables of the warehouse and the ways a load may change them.

* Dimensions are snapshots: a load writes `v=<n+1>`, readers take the highest committed version.
* Raw rows are only ever appended.
* Quarantine, staging, facts and mart are partitioned. A load writes the partitions it touches beside the
  present ones, below `load=<n>`, and `commit` makes them current: one small pointer table per commit says
  which load each partition of each table is read from. Writing that table is the only step that changes
  what readers see, so all tables of a commit change together; a load that stops before it changes nothing,
  and the next one writes over what it left. Partitions that no kept pointer names are removed.

Every partitioned write is preceded by a rebalance on the partition column: small partitions share a
task, and a partition that holds a large share of the rows is split over many tasks and files.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowledger.functions.timing import month_key
from flowledger.operators.constraints import guarded, refusing_nulls
from flowledger.sources.files import child_names, exists, make_folder, remove
from flowledger.tables import ALL_TABLES, Table

KEY_BUCKETS = 256
_ROWS_PER_KEY_BLOCK = 16_000_000
_IDS_PER_RANGE = 16_000_000
# A batch of so many rows for each of so few partitions is written where it lies: every task fills a file of
# useful size in each, and no partition is one task's.
_FEW_PARTITIONS = 8
_ROWS_TO_STAY = 250_000
_KEPT_VERSIONS = 2
_KEPT_COMMITS = 8  # pointers whose partitions stay readable


def key_bucket() -> Column:
    """Layout bucket of a source row: a block of neighbouring rows of a file stays together, a large
    file spreads over all buckets."""
    block = F.call_function("div", F.col("source_row_number"), F.lit(_ROWS_PER_KEY_BLOCK))
    return F.pmod(F.xxhash64("source_file_name", block), F.lit(KEY_BUCKETS)).cast("int")


def id_range() -> Column:
    return F.call_function("div", F.col("raw_event_id"), F.lit(_IDS_PER_RANGE)).cast("int")


_COMMITS = "_commits"
_DELIVERED = "raw/_delivered_files"
_DELIVERED_COLUMNS = {
    "source_file_name": "string",
    "n_rows": "bigint",
    "first_row": "bigint",
    "last_row": "bigint",
}
_POINTER = "table_name string, partition int, load int"

_LAYOUT = {
    "key_bucket": key_bucket,
    "id_range": id_range,
    "date_key": lambda: F.col("date_key"),
    "month_key": lambda: month_key(F.col("date_key")),
}


def _lookup_options(table: Table) -> dict[str, object]:
    """Bloom filters, sized by the distinct ids of each row group, on the column that single rows are looked up by."""
    if (table.partition, table.sort_by) != ("date_key", "workflow_id"):
        return {}
    return {f"parquet.bloom.filter.enabled#{table.sort_by}": True, "parquet.bloom.filter.adaptive.enabled": True}


class TableNotFound(LookupError):
    pass


class Change(NamedTuple):
    """Partitions of a table that a load has written and not committed yet."""

    table: Table
    touched: list[int]  # partitions that are replaced
    filled: list[int]  # those of them that have rows


class Warehouse:
    """`facts_by` is the layout of the row-level facts: "date_key" where a day fills files of a useful
    size, "month_key" where a day holds only a few rows. Results are the same; a load rewrites whole
    partitions, so days mean less to rewrite and months mean fewer files."""

    def __init__(self, spark: SparkSession, root: str, facts_by: str = "date_key"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.facts_by = facts_by
        self._known: dict[int, dict[tuple[str, int], int]] = {}  # pointers that were read

    # --- catalog -----------------------------------------------------------------

    def create(self, tables: Iterable[Table] = tuple(ALL_TABLES.values())) -> Warehouse:
        for table in tables:
            make_folder(self.spark, self.path(table))
        return self

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.path}"

    def layout(self, table: Table) -> str | None:
        return self.facts_by if table.partition == "date_key" else table.partition

    def table_exists(self, table: Table) -> bool:
        return exists(self.spark, self.path(table))

    # --- reading -------------------------------------------------------------------

    def read(self, table: Table) -> DataFrame:
        """The stored rows, with the layout column as an extra last column where there is one."""
        if not self.table_exists(table):
            raise TableNotFound(f"{table.layer}.{table.name} does not exist in {self.root}")
        columns = {c: table.type_of(c) for c in table.columns}
        layout = self.layout(table)
        paths = self._current(table)
        if not paths:
            empty = table.empty(self.spark)
            return empty if layout in (None, *columns) else empty.withColumn(layout, F.lit(0))
        if layout:
            columns.setdefault(layout, "int")
        ddl = ", ".join(f"`{c}` {t}" for c, t in columns.items())
        reader = self.spark.read.schema(ddl)
        if table.partition:
            reader = reader.option("basePath", self.path(table))
        return reader.parquet(*paths).select(*columns)

    def __getitem__(self, name: str) -> DataFrame:
        """`read` by table name, so that a warehouse can stand where a mapping of tables is asked for."""
        return self.read(ALL_TABLES[name])

    def _current(self, table: Table) -> list[str]:
        """The folders that hold the rows of a table."""
        path = self.path(table)
        if table.versioned:
            layout = self.layout(table)
            return [
                f"{path}/load={load}/{layout}={value}"
                for (name, value), load in sorted(self._pointer().items())
                if name == table.name
            ]
        if table.partition:
            folders = child_names(self.spark, path)
            return [path] if any(n.startswith(f"{self.layout(table)}=") for n in folders) else []
        versions = self._versions(path)
        return [f"{path}/v={versions[-1]}"] if versions else []

    def _pointer(self, number: int | None = None) -> dict[tuple[str, int], int]:
        """(table, partition) -> load, of the last commit or of the given one. One entry per partition."""
        path = f"{self.root}/{_COMMITS}"
        if number is None:
            versions = self._versions(path)
            if not versions:
                return {}
            number = versions[-1]
        if number not in self._known:
            rows = self.spark.read.schema(_POINTER).parquet(f"{path}/v={number}").collect()
            self._known[number] = {(r.table_name, r.partition): r.load for r in rows}
        return self._known[number]

    def _versions(self, path: str) -> list[int]:
        """Committed snapshot numbers, oldest first."""
        if not exists(self.spark, path):
            return []
        numbers = [int(n[2:]) for n in child_names(self.spark, path) if n.startswith("v=")]
        return [n for n in sorted(numbers) if exists(self.spark, f"{path}/v={n}/_SUCCESS")]

    # --- writing --------------------------------------------------------------------

    def touched(self, table: Table, batch: DataFrame) -> list[int]:
        """Partitions the rows of a batch belong to; at most one value per bucket, range or date."""
        layout = _LAYOUT[self.layout(table)]().alias("p")
        return sorted(r.p for r in batch.select(layout).distinct().collect())

    def sizes(self, table: Table, batch: DataFrame) -> dict[int, int]:
        """`touched` with the number of rows in each."""
        layout = _LAYOUT[self.layout(table)]().alias("p")
        return {r.p: r.n for r in batch.groupBy(layout).agg(F.count("*").alias("n")).collect()}

    def within(self, table: Table, partitions: list[int]) -> DataFrame:
        return self.read(table).where(F.col(self.layout(table)).isin(partitions))

    def next_commit(self) -> int:
        versions = self._versions(f"{self.root}/{_COMMITS}")
        return versions[-1] + 1 if versions else 1

    def write_beside(
        self, table: Table, rows: DataFrame, touched: list[int], number: int, sizes: dict[int, int] | None = None
    ) -> Change:
        """Write partitions for commit `number`; until then readers go on with the present ones.

        Refuses nulls in required columns, which are met while writing: keys that no dimension
        member answers are null, so this refuses dangling keys too.
        """
        path, layout = f"{self.path(table)}/load={number}", self.layout(table)
        with refusing_nulls(rows, table.required, table.name):
            placed = self._partitioned(table, guarded(rows, table.required, table.name), sizes)
            writer = placed.write.mode("overwrite").options(**_lookup_options(table))
            writer.partitionBy(layout).parquet(path)
        names = child_names(self.spark, path)
        filled = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{layout}="))
        return Change(table, touched, filled)

    def commit(self, number: int, changes: list[Change]) -> None:
        """Make all changes current at once."""
        pointer = dict(self._pointer())
        for change in changes:
            for value in change.touched:
                pointer.pop((change.table.name, value), None)
            pointer |= {(change.table.name, value): number for value in change.filled}
        path = f"{self.root}/{_COMMITS}"
        rows = [(name, value, load) for (name, value), load in pointer.items()]
        listed = self.spark.createDataFrame(rows, _POINTER).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{path}/v={number}")
        self._known[number] = pointer
        versions = self._versions(path)
        dropped, oldest = versions[:-_KEPT_COMMITS], versions[-_KEPT_COMMITS:][0]
        for old in dropped:
            self._forget(old, oldest)
        for change in changes:
            self._sweep(change.table, oldest)

    def _sweep(self, table: Table, oldest: int) -> None:
        """Remove what loads that never reached their commit have left."""
        used = {load for (name, _), load in self._pointer(oldest).items() if name == table.name}
        for name in child_names(self.spark, self.path(table)):
            load = int(name[5:]) if name.startswith("load=") else oldest
            if load < oldest and load not in used:
                remove(self.spark, f"{self.path(table)}/{name}")

    def _forget(self, old: int, oldest: int) -> None:
        """Remove a pointer, and the partitions that it names and the oldest one that is kept does not."""
        gone = self._pointer(old).items() - self._pointer(oldest).items()
        for (name, value), load in gone:
            table = ALL_TABLES[name]
            remove(self.spark, f"{self.path(table)}/load={load}/{self.layout(table)}={value}")
        remove(self.spark, f"{self.root}/{_COMMITS}/v={old}")
        self._known.pop(old, None)

    def replace(
        self, table: Table, rows: DataFrame, touched: list[int], sizes: dict[int, int] | None = None
    ) -> None:
        """Replace the touched partitions of one table. `sizes` are the rows that a batch has for each."""
        number = self.next_commit()
        self.commit(number, [self.write_beside(table, rows, touched, number, sizes)])

    def append(self, table: Table, rows: DataFrame, sizes: dict[int, int] | None = None) -> None:
        if table.versioned:
            raise ValueError(f"{table.name}: its partitions are replaced, never appended to")
        layout = self.layout(table)
        self._partitioned(table, rows, sizes).write.mode("append").partitionBy(layout).parquet(self.path(table))

    def _partitioned(self, table: Table, rows: DataFrame, sizes: dict[int, int] | None = None) -> DataFrame:
        layout = self.layout(table)
        placed = rows.withColumn(layout, _LAYOUT[layout]())
        if not sizes or len(sizes) > _FEW_PARTITIONS or sum(sizes.values()) < _ROWS_TO_STAY * len(sizes):
            placed = placed.hint("rebalance", layout)
        return placed.sortWithinPartitions(layout, table.sort_by)

    def snapshot(self, table: Table, rows: DataFrame) -> None:
        self._write_version(self.path(table), rows)

    def _write_version(self, path: str, rows: DataFrame) -> None:
        versions = self._versions(path)
        following = versions[-1] + 1 if versions else 1
        rows.write.mode("overwrite").parquet(f"{path}/v={following}")
        for old in versions[: 1 - _KEPT_VERSIONS]:
            remove(self.spark, f"{path}/v={old}")

    # --- delivered files -----------------------------------------------------------------

    def delivered_files(self) -> DataFrame:
        """Files whose rows may be stored: a row is noted before the rows of its file are appended."""
        path = f"{self.root}/{_DELIVERED}"
        if not exists(self.spark, path):
            return self.spark.range(0).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in _DELIVERED_COLUMNS.items()])
        ddl = ", ".join(f"{c} {t}" for c, t in _DELIVERED_COLUMNS.items())
        return self.spark.read.schema(ddl).parquet(path)

    def note_files(self, files: DataFrame) -> None:
        files.select(*_DELIVERED_COLUMNS).write.mode("append").parquet(f"{self.root}/{_DELIVERED}")

    # --- surrogate keys ---------------------------------------------------------------

    def reserve(self, rows: int) -> int:
        """Take `rows` consecutive numbers and return the one before the first.

        Written before the rows are, like a database sequence: a failed load leaves a gap, never a
        number used twice. One counter serves all tables; it is why no load has to scan for a maximum.
        """
        path = f"{self.root}/warehouse/_sequence"
        versions = self._versions(path)
        last = self.spark.read.parquet(f"{path}/v={versions[-1]}").first()[0] if versions else 0
        self._write_version(path, self.spark.range(last + rows, last + rows + 1, 1, 1))
        return last
