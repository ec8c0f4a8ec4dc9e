"""Loads that fail or are cut short never lose a table's rows."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from storelift.sinks import refresh as R


@pytest.fixture
def box(spark, tmp_path):
    """Names of fresh tables, the journal folder and a helper that lists what is left."""
    tag = uuid.uuid4().hex[:8]

    class Box:
        journal = str(tmp_path / "journal")
        one, two = f"one_{tag}", f"two_{tag}"

        def rows(self, table):
            return sorted(tuple(r) for r in spark.table(table).collect())

        def left(self):
            """Stage and old tables, and folders beside the targets' own."""
            tables = [t.name for t in spark.catalog.listTables() if tag in t.name and "__" in t.name]
            return tables + [r for r in self.runs()]

        def runs(self):
            return R.Journal(spark, self.journal).runs()

        def folder(self, table):
            return R._details(spark, table)["Location"].removeprefix("file:")

    b = Box()
    yield b
    for t in spark.catalog.listTables():
        if tag in t.name:
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def make(spark, box, tmp_path, table, partitioned, external):
    where = f"LOCATION '{tmp_path / table}'" if external else ""
    spark.sql(f"CREATE TABLE {table} (n BIGINT, day STRING) USING parquet {'PARTITIONED BY (day)' if partitioned else ''} {where}")
    spark.sql(f"INSERT INTO {table} VALUES (1, 'a'), (2, 'b')")


LAYOUTS = pytest.mark.parametrize("partitioned, external", [(False, True), (False, False), (True, True), (True, False)])


@LAYOUTS
def test_replaces_rows_again_and_again(spark, box, tmp_path, partitioned, external):
    make(spark, box, tmp_path, box.one, partitioned, external)
    folders = {box.folder(box.one)}
    for k in range(3):
        R.refresh(spark.createDataFrame([(k, "b"), (9, "c")], "x long, y string"), box.one, journal=box.journal)
        assert box.rows(box.one) == sorted([(k, "b"), (9, "c")]) and box.left() == []
        folders.add(box.folder(box.one))
        assert [os.path.exists(f) for f in folders].count(True) == 1
    R.refresh(spark.createDataFrame([], "x long, y string"), box.one, journal=box.journal)
    assert box.rows(box.one) == []
    assert [c.name for c in spark.catalog.listColumns(box.one) if c.isPartition] == (["day"] if partitioned else [])


@LAYOUTS
def test_failing_at_the_last_row_keeps_old_rows(spark, box, tmp_path, partitioned, external):
    make(spark, box, tmp_path, box.one, partitioned, external)
    last = spark.range(5).select("id", F.when(F.col("id") == 4, F.raise_error(F.lit("last row"))).otherwise(F.lit("z")).cast("string").alias("day"))
    with pytest.raises(Exception, match="last row"):
        R.refresh(last, box.one, journal=box.journal)
    assert box.rows(box.one) == [(1, "a"), (2, "b")] and box.left() == []
    beside = os.listdir(os.path.dirname(box.folder(box.one)))
    assert not [f for f in beside if "__v" in f and box.one in f]


@LAYOUTS
def test_targets_switch_together_or_not_at_all(spark, box, tmp_path, partitioned, external):
    for t in (box.one, box.two):
        make(spark, box, tmp_path, t, partitioned, external)
    good = spark.createDataFrame([(7, "q")], "x long, y string")
    bad = spark.range(1).select("id", F.raise_error(F.lit("no")).cast("string").alias("y"))
    with pytest.raises(Exception, match="no"):
        R.refresh_all([R.Load(good, box.one), R.Load(bad, box.two)], box.journal)
    assert box.rows(box.one) == box.rows(box.two) == [(1, "a"), (2, "b")] and box.left() == []
    R.refresh_all([R.Load(good, box.one), R.Load(good, box.two)], box.journal)
    assert box.rows(box.one) == box.rows(box.two) == [(7, "q")] and box.left() == []


class Killed(BaseException):
    """Ends a run as a lost driver does: nothing after it is done."""


@LAYOUTS
@pytest.mark.parametrize("dies_at", ["staging", "ready", "first switch", "between renames", "cleaning"])
def test_next_run_repairs(spark, box, tmp_path, monkeypatch, partitioned, external, dies_at):
    if dies_at == "between renames" and not partitioned:
        pytest.skip("unpartitioned tables switch in one step")
    for t in (box.one, box.two):
        make(spark, box, tmp_path, t, partitioned, external)
    new = spark.createDataFrame([(7, "q")], "x long, y string")
    loads = [R.Load(new, box.one), R.Load(new, box.two)]

    def dead(*a, **k):
        raise Killed

    with monkeypatch.context() as m:
        if dies_at == "staging":
            m.setattr(R, "_undo", dead)
            calls = []
            real = R._stage
            m.setattr(R, "_stage", lambda load, step: dead() if calls else (calls.append(1), real(load, step)))
        elif dies_at == "ready":
            m.setattr(R, "_complete", dead)
        elif dies_at == "first switch":
            calls, real = [], R._switch
            m.setattr(R, "_switch", lambda s, step: dead() if calls else (calls.append(1), real(s, step)))
        elif dies_at == "between renames":
            m.setattr(R, "_switch", lambda s, step: (s.sql(f"ALTER TABLE {step.table} RENAME TO {step.old_name}"), dead()))
        else:
            m.setattr(R, "_clean", dead)
        with pytest.raises(Killed):
            R.refresh_all(loads, box.journal)
    assert len(box.runs()) == 1
    if dies_at in ("staging", "ready"):
        assert box.rows(box.one) == box.rows(box.two) == [(1, "a"), (2, "b")]
    done = R.repair(spark, [box.two], box.journal)
    assert list(done.values()) == ["undone" if dies_at == "staging" else "completed"]
    want = [(1, "a"), (2, "b")] if dies_at == "staging" else [(7, "q")]
    assert box.rows(box.one) == box.rows(box.two) == want and box.left() == []
    R.refresh_all(loads, box.journal)
    assert box.rows(box.one) == box.rows(box.two) == [(7, "q")] and box.left() == []


def test_repair_leaves_other_tables_runs(spark, box, tmp_path, monkeypatch):
    make(spark, box, tmp_path, box.one, False, True)
    new = spark.createDataFrame([(7, "q")], "x long, y string")
    with monkeypatch.context() as m:
        m.setattr(R, "_complete", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            R.refresh(new, box.one, journal=box.journal)
    R.refresh(new, box.two, journal=box.journal)
    assert len(box.runs()) == 1 and box.rows(box.one) == [(1, "a"), (2, "b")]


def test_lost_rows_are_noticed(spark, box, tmp_path, monkeypatch):
    make(spark, box, tmp_path, box.one, False, True)
    real = R._shape
    monkeypatch.setattr(R, "_shape", lambda df: real(df)[:1] if df.columns == ["n", "day"] and not df.isEmpty() and df.first()[0] == 7 else real(df))
    with pytest.raises(R.LoadError):
        R.refresh(spark.createDataFrame([(7, "q")], "x long, y string"), box.one, journal=box.journal)
    assert box.rows(box.one) == [(1, "a"), (2, "b")] and box.left() == []


def test_wrong_types_and_width_keep_old_rows(spark, box, tmp_path):
    make(spark, box, tmp_path, box.one, False, False)
    for df in (spark.createDataFrame([("x", "q")], "a string, b string"), spark.createDataFrame([(1,)], "a long")):
        with pytest.raises(Exception):
            R.refresh(df, box.one, journal=box.journal)
        assert box.rows(box.one) == [(1, "a"), (2, "b")] and box.left() == []


def test_creates_missing_tables_in_a_database(spark, box, tmp_path):
    db = f"db_{box.one}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / db}'")
    try:
        new = spark.createDataFrame([(7, "q")], "x long, y string")
        for _ in range(2):
            R.refresh_all([R.Load(new, f"{db}.a", str(tmp_path / "a")), R.Load(new, f"{db}.b")], box.journal)
            assert box.rows(f"{db}.a") == box.rows(f"{db}.b") == [(7, "q")]
            assert sorted(t.name for t in spark.catalog.listTables(db)) == ["a", "b"]
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_named_twice(spark, box):
    new = spark.createDataFrame([(7, "q")], "x long, y string")
    with pytest.raises(ValueError):
        R.refresh_all([R.Load(new, box.one), R.Load(new, box.one)], box.journal)
