"""Full-refresh load of report tables (OP-12, SNK-1..4) that cannot lose a table.

The source deletes all rows and inserts the query result by position.  Here new
rows are written beside the table first, checked, and then switched in:

1. **Stage.** Each target gets a stage table of its own layout in a new folder.
   The query's rows are inserted by position; their number (counted on the way
   by an ``Observation``) and the columns are checked against what was written.
2. **Commit.** When the stages of all targets of the run are checked, the run's
   journal is marked ready.  Until then every target has its old rows, and a
   failing query leaves them so.
3. **Switch.** An unpartitioned table's location is set to the new folder, one
   change in the catalog.  A partitioned table has a location for each partition,
   so it is renamed away and its stage is renamed to it.  A missing target is
   its stage renamed.  The old rows are removed when all targets have switched.

A run that died before the commit is undone, and one that died after it is
completed, by the next run that loads one of its targets (``repair``).  The journal
is a file in ``<warehouse>/_refresh``, or in the folder given.

Read targets through the catalog: the folder of a table changes with every load.
Two runs must not load one target at a time.  Tables of formats that replace their
rows in one commit of their own (not among ``FILE_FORMATS``) are overwritten
directly, as the last act before the commit.
"""

from __future__ import annotations

import dataclasses
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, shared_dir
from .files import names, qualified, read_text, write_text

# Formats of tables that are folders of files.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")
_VERSION = re.compile(r"__v[0-9a-f]{12}$")


class LoadError(RuntimeError):
    """What was staged is not what the query gave."""


@dataclasses.dataclass(frozen=True)
class Load:
    """One target of a run.  ``location`` and ``fmt`` hold where the table is created."""

    df: DataFrame
    table: str
    location: str | None = None
    fmt: str = "parquet"


@dataclasses.dataclass
class Step:
    """What a run does to one target, as the journal keeps it."""

    table: str
    kind: str  # "point", "rename", "create" or "insert"
    stage: str
    folder: str | None  # of the new rows; None: the catalog's choice
    old_folder: str | None = None
    old_name: str | None = None


def _renamed(table: str, suffix: str) -> str:
    parts = re.findall(r"`(?:[^`]|``)+`|[^.`]+", table)
    return ".".join([*parts[:-1], f"`{parts[-1].strip('`')}{suffix}`"])


def _quoted(text: str) -> str:
    """As a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """The catalog's own entries for a table (provider, location, type)."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    begin = [k for k, _ in rows].index("# Detailed Table Information")
    return dict(rows[begin + 1 :])


class Journal:
    """Small files that tell what runs have begun and committed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_refresh").rstrip("/")

    def write(self, run: str, state: str, steps: Sequence[Step]) -> None:
        write_text(self.spark, self.folder, f"{run}.{state}", json.dumps([dataclasses.asdict(x) for x in steps]))

    def drop(self, run: str, state: str) -> None:
        drop_path(self.spark, f"{self.folder}/{run}.{state}")

    def runs(self) -> dict[str, tuple[bool, list[Step]]]:
        """Run -> (committed, steps) of the runs that have not ended."""
        out = {}
        for name in names(self.spark, self.folder):
            run, _, state = name.rpartition(".")
            if run and state in ("staging", "ready"):
                ready = state == "ready" or out.get(run, (False,))[0]
                out[run] = (ready, [Step(**x) for x in json.loads(read_text(self.spark, f"{self.folder}/{name}"))])
        return out


def _plan(load: Load, run: str) -> Step:
    spark = load.df.sparkSession
    stage = _renamed(load.table, f"__stage_{run}")
    if not spark.catalog.tableExists(load.table):
        return Step(load.table, "create", stage, load.location)
    details = _details(spark, load.table)
    if details.get("Provider", "").lower() not in FILE_FORMATS:
        return Step(load.table, "insert", stage, None)
    old = details["Location"]
    folder = f"{_VERSION.sub('', old.rstrip('/'))}__v{run}"
    if any(c.isPartition for c in spark.catalog.listColumns(load.table)):
        return Step(load.table, "rename", stage, folder, old, _renamed(load.table, f"__old_{run}"))
    return Step(load.table, "point", stage, folder, old)


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _stage(load: Load, step: Step) -> None:
    spark = load.df.sparkSession
    written = Observation(f"rows of {step.stage}")
    rows = load.df.observe(written, F.count(F.lit(1)).alias("rows"))
    if step.kind == "create":
        writer = rows.write.format(load.fmt).mode("overwrite")
        if step.folder:
            writer = writer.option("path", step.folder)
        writer.saveAsTable(step.stage)
        wanted = [(n, t) for n, t in _shape(load.df)]
    else:
        spark.sql(f"CREATE TABLE {step.stage} LIKE {load.table} LOCATION {_quoted(step.folder)}")
        rows.write.insertInto(step.stage)
        wanted = _shape(spark.table(load.table))
    staged = spark.table(step.stage)
    n = staged.count()
    if n != written.get["rows"] or _shape(staged) != wanted:
        raise LoadError(f"{load.table}: {written.get['rows']} rows {wanted} were given, {n} rows {_shape(staged)} staged")


def _switch(spark: SparkSession, step: Step) -> None:
    """Let readers of the table see the staged rows.  May be done again after it was cut short."""
    exists = spark.catalog.tableExists
    if step.kind == "point":
        if exists(step.table) and exists(step.stage):
            if qualified(spark, _details(spark, step.table)["Location"]) != qualified(spark, step.folder):
                spark.sql(f"ALTER TABLE {step.table} SET LOCATION {_quoted(step.folder)}")
            spark.sql(f"DROP TABLE {step.stage}")  # it was created at a location, so its files stay
    elif step.kind in ("rename", "create") and exists(step.stage):
        if step.old_name and exists(step.table) and not exists(step.old_name):
            spark.sql(f"ALTER TABLE {step.table} RENAME TO {step.old_name}")
        spark.sql(f"ALTER TABLE {step.stage} RENAME TO {step.table}")


def _clean(spark: SparkSession, step: Step) -> None:
    """Remove the old rows of a target that has switched."""
    if step.kind not in ("point", "rename") or not spark.catalog.tableExists(step.table):
        return
    if qualified(spark, _details(spark, step.table)["Location"]) != qualified(spark, step.folder):
        return
    if step.old_name:
        spark.sql(f"DROP TABLE IF EXISTS {step.old_name}")
    drop_path(spark, step.old_folder)


def _undo(spark: SparkSession, step: Step) -> None:
    """Remove what was staged for a target that keeps its old rows."""
    spark.sql(f"DROP TABLE IF EXISTS {step.stage}")
    if step.folder:
        drop_path(spark, step.folder)


def _complete(spark: SparkSession, journal: Journal, run: str, steps: Sequence[Step]) -> None:
    for step in steps:
        _switch(spark, step)
    for step in steps:
        _clean(spark, step)
    journal.drop(run, "staging")
    journal.drop(run, "ready")


def repair(spark: SparkSession, tables: Sequence[str], journal: str | None = None) -> dict[str, str]:
    """Complete or undo earlier runs that loaded one of ``tables`` and did not end.

    Returns run -> "completed" or "undone".
    """
    log, done = Journal(spark, journal), {}
    for run, (ready, steps) in log.runs().items():
        if not {s.table for s in steps} & set(tables):
            continue
        if ready:
            _complete(spark, log, run, steps)
        else:
            for step in steps:
                _undo(spark, step)
            log.drop(run, "staging")
        done[run] = "completed" if ready else "undone"
    return done


def refresh_all(loads: Sequence[Load], journal: str | None = None) -> None:
    """Replace the contents of several tables together: all of them, or none."""
    spark = loads[0].df.sparkSession
    tables = [x.table for x in loads]
    if len(set(tables)) < len(tables):
        raise ValueError(f"a table is named twice: {tables}")
    repair(spark, tables, journal)
    log, run = Journal(spark, journal), uuid.uuid4().hex[:12]
    steps = [_plan(x, run) for x in loads]
    log.write(run, "staging", steps)
    try:
        for load, step in zip(loads, steps):
            if step.kind != "insert":
                _stage(load, step)
        for load, step in zip(loads, steps):
            if step.kind == "insert":
                load.df.write.insertInto(load.table, overwrite=True)
    except BaseException:
        for step in steps:
            _undo(spark, step)
        log.drop(run, "staging")
        raise
    log.write(run, "ready", steps)
    _complete(spark, log, run, steps)


def refresh(df: DataFrame, table: str, location: str | None = None, fmt: str = "parquet", journal: str | None = None) -> None:
    """Replace the contents of ``table`` with ``df`` by column position.

    A missing table is created from ``df`` (the source's commented-out
    drop-and-create path), at ``location`` if that is given.  A partitioned table is
    replaced as a whole, also where the session overwrites partitions
    dynamically; its columns stand in the table's order, partition columns last.
    """
    refresh_all([Load(df, table, location, fmt)], journal)


def scratch_table(spark: SparkSession, prefix: str) -> tuple[str, str]:
    """A fresh table name and a location for it, in a folder of its own under the shared folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    return name, f"{shared_dir(spark)}/tables/{name}/rows"
