"""Delivery runs end to end, and the streaming entry points."""

import os
import re

import pytest
from pyspark.sql import types as T

from flagstone.plans.delivery import run_delivery, run_vendors
from flagstone.plans.runner import vendor_registry
from flagstone.session import scratch_path
from flagstone.streaming.deliveries import flag_stream, read_delivery_stream, start_delivery_checks

CARS = "CAR|SOLD_ON|SCRAP_ON|BUILT_ON\nc1|2020/05/20|2022/01/01|\nc2|2021/07/01|2021/02/02|\n"
TRIPS = (
    "CAR|TRIP_ON|TOLL_AMT\n"
    "c1|2021/03/03|12\n"
    "c1|2021/03/03|12\n"
    "c2|2021/04/UK|free\n"
    "c2|2020/01/01|-3\n"
)

SHOP = {
    "refresh_dt": "2022-02-28",
    "folder": "shops/one",
    "project": "garage",
    "rules": {
        "duplication": {"trips": ["CAR", "TRIP_ON"]},
        "missing": {},
        "string_tables": {"value": "AMT", "tables": ["trips"]},
        "last_dt": {"table": "cars", "dt_column": "SOLD_ON", "id_column": "CAR", "dt_value": "_ON",
                    "dt_type": "datetime", "ignore_value": None, "ignorecols": ["BUILT_ON", "SCRAP_ON"]},
        "death_dt": {"table": "cars", "dt_column": "SCRAP_ON", "id_column": "CAR", "dt_value": "_ON",
                     "dt_type": "datetime", "ignore_value": None, "ignorecols": ["BUILT_ON"]},
        "frequency": {"trips": {"1": ["CAR", "TOLL_AMT"]}},
    },
    "rule_sequence": ["last_dt", "death_dt", "duplication", "string_tables", "missing", "frequency"],
}


def _write_delivery(folder):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "cars.txt"), "w", encoding="latin-1") as fh:
        fh.write(CARS)
    with open(os.path.join(folder, "trips.txt"), "w", encoding="latin-1") as fh:
        fh.write(TRIPS)


def test_run_delivery(spark):
    base = scratch_path(spark, "delivery")
    inp, out = os.path.join(base, "in"), os.path.join(base, "out")
    _write_delivery(inp)
    res = run_delivery(spark, SHOP, input_loc=inp, output_loc=out)
    assert res.rules_run == SHOP["rule_sequence"]
    trips = res.flagged["trips"]
    got = sorted((r.TRIP_ON, r.TOLL_AMT, r.last_dt_flag, r.death_dt_flag, r.dup_flag, r.value_flag) for r in trips.collect())
    assert got == [
        ("2020/01/01", "-3", 0, 0, 0, 1),
        ("2021/03/03", "12", 1, 0, 1, 0),
        ("2021/03/03", "12", 1, 0, 1, 0),
        ("2021/04/UK", "free", 0, 1, 0, 1),
    ]
    # last_dt leaves cars untouched (its other dates are ignored); death_dt
    # compares SOLD_ON: c2 was sold after it was scrapped
    assert "last_dt_flag" not in res.flagged["cars"].columns
    assert {r.CAR: r.death_dt_flag for r in res.flagged["cars"].collect()} == {"c1": 0, "c2": 1}
    summ = {(r.rule, r.tbl): r["count"] for r in res.summary.collect()}
    assert summ[("duplication", "trips")] == 2 and summ[("death_dt", "trips")] == 1
    for name in ("trips", "qc_dup_trips", "qc_value", "qc_missing", "qc_lastdt_trips", "qc_deathdt_trips", "qc_summary", "qc_freq_trips_1"):
        assert name in res.outputs, name
    rep = spark.read.option("header", True).csv(res.outputs["qc_dup_trips"])
    assert rep.count() == 2
    # each date rule's anchor was stored once and reused by every table
    anchors = spark.read.parquet(os.path.join(out, "_stage", "anchor_death_dt"))
    assert anchors.count() == 2


def test_run_vendors_apart(spark):
    """Unknown vendors are skipped; two vendors with one explicit location, database
    and file names keep apart; each has its own rule flavour, layout and stamp."""
    base = scratch_path(spark, "vendors")
    inp, out = os.path.join(base, "in"), os.path.join(base, "out")
    _write_delivery(inp)
    assert list(run_vendors(spark, {"ONE": SHOP}, "one, nobody", input_loc=inp, output_loc=out)) == ["ONE"]

    two = os.path.join(base, "two")
    _write_delivery(os.path.join(two, "ONE"))
    _write_delivery(os.path.join(two, "TWO"))
    old = {k: SHOP["rules"][k] for k in ("duplication", "missing", "string_tables")}
    cfg = {"ONE": SHOP, "TWO": {"rules": old, "rule_sequence": list(old), "flavour": "spark", "stamp": True}}
    res = run_vendors(spark, cfg, ["one", "two"], input_loc=two, output_loc=out, database="apart", csv_output=True)
    assert "dup_flag" in res["ONE"].flagged["trips"].columns
    assert {"flag_duplication", "flag_missing", "flag_values"} <= set(res["TWO"].flagged["trips"].columns)
    assert not set(res["ONE"].outputs.values()) & set(res["TWO"].outputs.values())
    assert all(re.search(r"_\d{14}\.csv$", p) for p in res["TWO"].outputs.values())
    assert spark.catalog.tableExists("apart_one.trips_QC") and spark.catalog.tableExists("apart_two.trips_QC")


def test_vendor_database_and_old_layout(spark, tmp_path, monkeypatch):
    shop = {**SHOP, "folder": str(tmp_path / "old" / "shop"), "database": "shop_db"}
    del shop["project"]
    _write_delivery(str(tmp_path / "old" / "shop_20220228" / "input"))
    res = run_delivery(spark, shop)
    assert res.outputs["trips"].startswith(str(tmp_path / "old" / "shop_20220228" / "output"))
    assert spark.table("shop_db.trips_RAW").count() == 4 and spark.table("shop_db.trips_QC").count() == 4


def test_delivery_errors(spark, tmp_path):
    empty, double, near = (tmp_path / n for n in ("empty", "double", "near"))
    for d in (empty, double, near):
        d.mkdir()
    with pytest.raises(FileNotFoundError):
        run_delivery(spark, SHOP, input_loc=str(empty), output_loc=str(tmp_path / "o"))
    (double / "lab.2019.txt").write_text("a\n1\n2\n")
    (double / "lab.2020.txt").write_text("a\n3\n")
    with pytest.raises(ValueError, match="lab"):
        run_delivery(spark, SHOP, input_loc=str(double), output_loc=str(tmp_path / "o"))
    (near / "a-b.txt").write_text("a\n1\n")
    (near / "a_b.txt").write_text("a\n1\n")
    with pytest.raises(ValueError, match="one name"):
        run_delivery(spark, SHOP, input_loc=str(near), output_loc=str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()
    with pytest.raises(ValueError, match="flavour"):
        vendor_registry({"flavour": "other"})


SCHEMA = T.StructType([T.StructField("CAR", T.StringType()), T.StructField("TRIP_ON", T.StringType()), T.StructField("TOLL_AMT", T.StringType())])


def test_stream_row_rules_and_batches(spark):
    base = scratch_path(spark, "stream")
    inp = os.path.join(base, "in")
    _write_delivery(inp)
    stream = read_delivery_stream(spark, inp, SCHEMA, pattern="trips*")
    flagged = flag_stream(stream, "trips", SHOP["rules"], SHOP["rule_sequence"])
    assert flagged.isStreaming and "value_flag" in flagged.columns and "missing_flag" in flagged.columns
    mem = flagged.writeStream.format("memory").queryName("trip_flags").trigger(availableNow=True).start()
    mem.awaitTermination(120)
    got = sorted((r.TOLL_AMT, r.value_flag, r.missing_flag) for r in spark.table("trip_flags").collect())
    assert got == [("-3", 1, 0), ("12", 0, 0), ("12", 0, 0), ("free", 1, 0)]
    out = os.path.join(base, "out")
    q = start_delivery_checks(stream, "trips", {"duplication": {"trips": ["CAR", "TRIP_ON"]}}, ["duplication"], out, os.path.join(base, "checkpoint"))
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert res.count() == 4
    assert sorted(r.dup_flag for r in res.collect()) == [0, 0, 1, 1]


def test_command_line(spark, capsys, tmp_path):
    import json

    from flagstone.__main__ import main

    base = scratch_path(spark, "cli")
    inp, out = os.path.join(base, "in"), os.path.join(base, "out")
    _write_delivery(inp)
    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps({"spec_year": 2019, "ONE": SHOP}))
    assert main(["-c", str(cfg), "-v", "one", "-y", "2019", "--input", inp, "--output", out], spark=spark) == 0
    printed = capsys.readouterr().out
    assert "ONE\tqc_summary\t" in printed and "ONE\ttrips\t" in printed
    assert main(["-c", str(cfg), "-v", "nobody", "--input", inp, "--output", out], spark=spark) == 1
