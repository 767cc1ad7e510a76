"""A failing vendor does not end the others; a restart makes only what is not finished."""

import os
import time

import pytest

from flagstone.__main__ import main
from flagstone.plans import delivery
from flagstone.plans.delivery import run_delivery, run_vendors
from flagstone.plans.manifest import Manifest, file_states, fingerprint
from flagstone.plans.runner import rule_registry

RULES = {"missing": {}, "duplication": {"boats": ["id"]}}
VENDOR = {"rules": RULES, "rule_sequence": ["duplication", "missing"]}


def deliver(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)


def flags(df):
    return sorted((r.id, r.missing_flag) for r in df.collect())


@pytest.fixture
def made(monkeypatch):
    """Names of the tables and outputs that are written, and of the tables that are read from files."""
    log = {"stored": [], "written": [], "read": []}
    store, write, read = delivery.store, delivery.write_delimited, delivery.read_delivery

    def read_log(*a, **kw):
        found = read(*a, **kw)
        log["read"] += sorted(found)
        return found

    monkeypatch.setattr(delivery, "store", lambda spark, df, name, suffix, *a: log["stored"].append(name + suffix) or store(spark, df, name, suffix, *a))
    monkeypatch.setattr(delivery, "write_delimited", lambda df, path, **kw: log["written"].append(os.path.basename(path)) or write(df, path, **kw))
    monkeypatch.setattr(delivery, "read_delivery", read_log)
    return log


def clear(log):
    for names in log.values():
        names.clear()


def test_a_failing_vendor_does_not_end_the_others(spark, tmp_path):
    deliver(tmp_path / "in" / "ONE", boats="id|n\n1|\n2|x\n")
    deliver(tmp_path / "in" / "THREE", boats="id|n\n3|\n")
    cfg = {"ONE": VENDOR, "TWO": VENDOR, "THREE": VENDOR}
    runs = run_vendors(spark, cfg, "one,two,three,four", input_loc=str(tmp_path / "in"), output_loc=str(tmp_path / "out"), database="")
    assert sorted(runs) == ["ONE", "THREE"] and list(runs.failed) == ["TWO"]
    assert flags(runs["THREE"].flagged["boats"]) == [(3, 1)]


def test_command_line_tells_of_a_failed_vendor(spark, tmp_path, capsys):
    deliver(tmp_path / "in" / "ONE", boats="id|n\n1|\n")
    (tmp_path / "c.json").write_text('{"ONE": {"rules": {}, "rule_sequence": []}, "TWO": {"rules": {}, "rule_sequence": []}}')
    args = ["-c", str(tmp_path / "c.json"), "-v", "one,two", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--resume"]
    assert main(args, spark) == 1
    assert "TWO\tfailed" in capsys.readouterr().err


@pytest.mark.parametrize("database", ["", "resumed_qc"])
def test_a_restart_reads_no_finished_file(spark, tmp_path, made, database):
    deliver(tmp_path / "in", boats="id|n\n1|\n1|x\n", crews="id|n\n7|y\n")
    where = (spark, VENDOR, str(tmp_path / "in"), str(tmp_path / "out"))

    def stop(dfs, cfg, opts):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        run_delivery(*where, database=database, registry=rule_registry({"missing": stop}))
    assert sorted(made["stored"]) == ["boats_RAW", "crews_RAW"]
    clear(made)
    first = run_delivery(*where, database=database, resume=True)
    assert made["read"] == [] and sorted(made["stored"]) == ["boats_QC", "cells_boats", "cells_crews", "crews_QC"]
    assert sorted(made["written"]) == ["boats.csv", "crews.csv", "qc_dup_boats.csv", "qc_missing.csv", "qc_summary.csv"]
    clear(made)
    # all is finished: nothing is read or written, the result is the same
    again = run_delivery(*where, database=database, resume=True)
    assert made == {"stored": [], "written": [], "read": []}
    assert flags(again.flagged["boats"]) == flags(first.flagged["boats"]) == [(1, 0), (1, 1)]
    assert sorted(map(tuple, again.summary.collect())) == sorted(map(tuple, first.summary.collect()))
    # a file that came anew, and a missing output
    time.sleep(1.1)
    deliver(tmp_path / "in", crews="id|n\n7|\n")
    again = run_delivery(*where, database=database, resume=True)
    assert made["read"] == ["crews"] and "boats_RAW" not in made["stored"]
    assert flags(again.flagged["crews"]) == [(7, 1)]
    clear(made)
    # another configuration: tables stay, flags and reports are made again
    other = {**VENDOR, "rule_sequence": ["missing"]}
    again = run_delivery(spark, other, *where[2:], database=database, resume=True)
    assert made["read"] == [] and sorted(made["stored"]) == ["boats_QC", "cells_boats", "cells_crews", "crews_QC"] and "dup_flag" not in again.flagged["boats"].columns
    clear(made)
    # without resume everything is made
    run_delivery(spark, other, *where[2:], database=database)
    assert made["read"] == ["boats", "crews"] and len(made["stored"]) == 6


def test_manifest(spark, tmp_path):
    m = Manifest(spark, str(tmp_path))
    assert m.finished("raw a b", "x") is None
    m.record("raw a b", "x", {"total": 3})
    m.record("raw a_b", "y")
    assert m.finished("raw a b", "x") == {"total": 3} and m.finished("raw a b", "z") is None and m.finished("raw a_b", "y") == {}
    m.forget("raw a b")
    m.forget("never")
    assert m.finished("raw a b", "x") is None
    for f in (tmp_path / "_manifest").glob("*.json"):
        f.write_text("{")  # written by a run that ended at this point
    for f in (tmp_path / "_manifest").glob(".*.crc"):
        f.unlink()
    assert m.finished("raw a_b", "y") is None
    assert fingerprint({"b": 1, "a": 2}) == fingerprint({"a": 2, "b": 1}) != fingerprint({"a": 1, "b": 2})
    (tmp_path / "f.txt").write_text("abc")
    assert [(n, size) for n, size, _ in file_states(spark, str(tmp_path / "f.txt"))] == [("f.txt", 3)]
