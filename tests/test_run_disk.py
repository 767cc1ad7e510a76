"""A delivery run moves few bytes: date reports join nothing, shuffled rows leave the disk, scans of stored copies are small."""

import os
import time

import pytest

from flagstone.operators.dates import limit_columns
from flagstone.plans import delivery
from flagstone.plans.delivery import SCAN_BYTES, SCAN_KEY, run_delivery, stored
from flagstone.sources.delivery import read_delimited

LINES = "id|n|first_dt|next_dt\n1|1|2024-01-05|2024-02-01\n1|1|2024-01-20|\n2|1|2024-01-05|2024-01-06\n3|2|2024-03-01|2024-03-01\n||2024-03-01|\n9|1|2025-01-01|\n"
ENDS = "id|end_dt\n1|2024-01-10\n1|2024-06-01\n2|2024-12-31\n3|2024-02-01\n4|2024-01-01\n"
GONE = "id|gone_dt\n1|2024-01-15\n2|2024-01-05\n3|\n"
DATE = {"id_column": "id", "dt_value": "_dt", "dt_type": "datetime"}
RULES = {
    "last_dt": {**DATE, "table": "ends", "dt_column": "end_dt"},
    "death_dt": {**DATE, "table": "gone", "dt_column": "gone_dt", "ignorecols": ["next_dt"]},
    "duplication": {"lines": ["id", "n"]},
    "missing": {},
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("lines", LINES), ("ends", ENDS), ("gone", GONE)):
        (tmp_path / "in" / f"{name}.txt").write_text(text)
    return tmp_path


@pytest.fixture
def plans(monkeypatch):
    """Plans of the text outputs, and the scan size while they are written."""
    found, write = {}, delivery.write_delimited

    def kept(df, path, **kw):
        spark = df.sparkSession
        found[os.path.basename(path)] = (df._jdf.queryExecution().optimizedPlan().toString(), spark.conf.get(SCAN_KEY))
        return write(df, path, **kw)

    monkeypatch.setattr(delivery, "write_delimited", kept)
    return found


def run(spark, folder, out, **kw):
    vendor = {"rules": RULES, "rule_sequence": kw.pop("sequence", ["last_dt", "death_dt", "duplication", "missing"])}
    return run_delivery(spark, vendor, str(folder / "in"), str(folder / out), **kw)


def texts(spark, res):
    read = {k: read_delimited(spark, v, sep=",", infer_schema=False) for k, v in res.outputs.items()}
    return {k: (df.columns, sorted(map(str, df.collect()))) for k, df in read.items()}


@pytest.mark.parametrize("sequence", [["last_dt", "death_dt", "duplication", "missing"], ["last_dt", "duplication", "death_dt", "missing"]])
def test_date_reports_join_nothing(spark, folder, plans, sequence):
    """Reports of a Parquet run filter the stored copy; they hold the rows of a run whose
    tables, in a catalog, are joined to the limits again."""
    res = run(spark, folder, "out", database="", sequence=sequence)
    dated = {k: plan for k, (plan, _) in plans.items() if k.startswith(("qc_lastdt_", "qc_deathdt_"))}
    assert {"qc_lastdt_lines.csv", "qc_deathdt_lines.csv", "qc_deathdt_ends.csv"} <= set(dated)
    assert not any("Join" in plan for plan in dated.values())
    joined = run(spark, folder, "joined", database=f"kept_limits_{len(sequence)}_{sequence[1]}", sequence=sequence)
    assert texts(spark, res) == texts(spark, joined)
    late = [(r.id, r.first_dt, r.end_dt[:10]) for r in read_delimited(spark, res.outputs["qc_lastdt_lines"], sep=",", infer_schema=False).collect()]
    assert sorted(late) == [("1", "2024-01-05", "2024-01-10"), ("1", "2024-01-20", "2024-01-10"), ("3", "2024-03-01", "2024-02-01")]
    # the limits stay in the stored copy: null but for flagged rows, in no table that is handed out
    held = stored(spark, "lines", "_QC", None, str(folder / "out"))
    limits = ["__dq_limit_last_dt_flag", "__dq_limit_death_dt_flag"]
    assert sorted(limit_columns(held)) == sorted(limits)
    assert all((r[c] is not None) == r[c.removeprefix("__dq_limit_")] for r in held.collect() for c in limits)
    for name in res.flagged:
        assert res.flagged[name].columns == joined.flagged[name].columns == spark.table(f"kept_limits_{len(sequence)}_{sequence[1]}.{name}_QC").columns
        assert sorted(map(str, res.flagged[name].collect())) == sorted(map(str, joined.flagged[name].collect()))


def test_a_copy_without_limits_is_joined(spark, folder, plans, monkeypatch):
    """A restart that finds a flagged copy of an earlier version makes the same reports."""
    res = run(spark, folder, "new", database="")
    want = texts(spark, res)
    stop = {"on": True}

    def stopped(*a, **kw):
        if stop["on"]:
            raise RuntimeError("stopped")
        return write(*a, **kw)

    write = delivery.write_delimited
    with monkeypatch.context() as m:
        m.setattr(delivery, "write_delimited", stopped)
        m.setattr(delivery, "replace", lambda o, **kw: o.__class__(**{**vars(o), **kw, "keep_limits": False}))
        with pytest.raises(RuntimeError, match="stopped"):
            run(spark, folder, "old", database="")
    assert not limit_columns(stored(spark, "lines", "_QC", None, str(folder / "old")))
    plans.clear()
    res = run(spark, folder, "old", database="", resume=True)
    assert "Join" in plans["qc_lastdt_lines.csv"][0] and texts(spark, res) == want


def test_shuffled_rows_leave_the_disk(spark, folder):
    """The files of a run's shuffles are gone soon after it, with its tables still in use."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in disk.getAllFiles().mkString("\n").split("\n") if os.path.basename(name).startswith("shuffle_")}

    before = shuffled()
    res = run(spark, folder, "out", database="")
    end = time.time() + 20
    while (left := shuffled() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and res.flagged["lines"].count() == 6


def test_stored_copies_are_read_in_small_parts(spark, folder, plans):
    old = spark.conf.get(SCAN_KEY)
    for own, used in (("128MB", SCAN_BYTES), ("1m", 1 << 20)):
        spark.conf.set(SCAN_KEY, own)
        try:
            run(spark, folder, f"out{own}", database="")
            assert {size for _, size in plans.values()} == {str(used)} and spark.conf.get(SCAN_KEY) == own
        finally:
            spark.conf.set(SCAN_KEY, old)
