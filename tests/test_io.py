"""Sources, sinks, configuration and the rule runner."""

import json

import pytest
from pyspark.sql import functions as F

from flagstone.plans.runner import RunOptions, rule_registry, run_rules
from flagstone.session import scratch_path
from flagstone.sinks.writers import ensure_database, replace_table, sanitize_table_name, write_delimited
from flagstone.sources.delivery import NA_MARKERS, delivery_paths, list_files, load_config, read_delimited, read_delivery, table_name
from flagstone.sources.jdbc import parse_db_url


def test_delivery_paths_and_names():
    assert delivery_paths("p", "in/x", "2022/07-04") == ("p/input/in/x_20220704/", "p/raw_qc/in/x_20220704/")
    assert delivery_paths(None, "in/x", "2022-07-04") == ("in/x_20220704/input/", "in/x_20220704/output/")
    assert table_name("/a/b.c/3 - Tank.levels.txt") == "3 - Tank"
    assert sanitize_table_name("3 - Tank-level") == "3___Tank_level"


def test_parse_db_url():
    url, props = parse_db_url("postgres://u%40x:p%2Fw@db.host:5432/qc")
    assert url == "jdbc:postgresql://db.host:5432/qc"
    assert props == {"user": "u@x", "password": "p/w"}
    assert parse_db_url("jdbc:derby:memory:x") == ("jdbc:derby:memory:x", {})


def test_load_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"spec_year": 2019, "V": {"rules": {}, "rule_sequence": []}}))
    assert load_config(str(p))["spec_year"] == 2019
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "nope.json"))


def test_pipe_latin1_delivery_roundtrip(spark, tmp_path):
    folder = tmp_path / "delivery"
    folder.mkdir()
    (folder / "boats.txt").write_bytes("Skipper|value_Crew|Port\nRené|6|Brest\nOlaf|N/A|\n".encode("latin-1"))
    (folder / "log.v2.txt").write_bytes("Skipper|DAY\nRené|2021/04/UK\n".encode("latin-1"))
    (folder / "notes.csv").write_text("x\n1\n")
    tables = read_delivery(spark, str(folder))
    assert sorted(tables) == ["boats", "log"]
    boats = tables["boats"].collect()
    assert boats[0].Skipper == "René" and boats[1].Port is None
    # the marker cell is missing and does not turn the number column into text
    assert dict(tables["boats"].dtypes)["value_Crew"] == "bigint" and boats[1].value_Crew is None
    assert len(list_files(spark, str(folder), "*csv")) == 1


def test_write_and_replace_table(spark):
    df = spark.range(10).withColumn("arr", F.array(F.lit("a"), F.lit("b")))
    out = scratch_path(spark, "csv")
    write_delimited(df, out, sep="|", single_file=True)
    back = spark.read.option("header", True).option("sep", "|").csv(out)
    assert back.count() == 10 and back.first().arr == "a;b"
    ensure_database(spark, "t_qc", scratch_path(spark, "wh"))
    name = replace_table(spark.range(5), "t_qc", "12_-_Lab-x", "_RAW")
    assert spark.table(name).count() == 5
    name = replace_table(spark.range(3), "t_qc", "12_-_Lab-x", "_RAW")
    assert spark.table(name).count() == 3


def test_runner_sequence_and_reports(spark):
    boats = spark.createDataFrame(
        [("zoe", "6"), ("mona", "few"), ("mona", "few"), ("ann", None)], "Boat string, value_Crew string"
    )
    rules = {
        "duplication": {"boats": ["Boat", "value_Crew"]},
        "missing": {},
        "string_tables": {"value": "value", "tables": ["boats"]},
        "frequency": {"boats": {"1": ["Boat"]}},
    }
    res = run_rules({"boats": boats}, rules, ["duplication", "nosuchrule", "string_tables", "missing", "frequency"])
    assert res.rules_run == ["duplication", "string_tables", "missing", "frequency"]
    t = res.tables["boats"]
    assert t.columns == ["Boat", "value_Crew", "dup_count", "dup_flag", "value_flag", "missing_flag"]
    assert [r.missing_flag for r in t.orderBy("Boat").collect()] == [1, 0, 0, 0]
    assert set(res.reports) == {"qc_dup_boats", "qc_value", "qc_missing", "qc_freq_boats_1"}
    assert res.reports["qc_dup_boats"].count() == 2
    summ = {(r.rule, r.tbl): (r.total, r["count"], r.percent) for r in res.summary().collect()}
    assert summ[("duplication", "boats")] == (4, 2, 50.0)
    assert summ[("string_tables", "boats")] == (4, 3, 75.0)
    assert summ[("missing", "boats")] == (4, 1, 25.0)


def test_runner_old_list_form_and_custom_rule(spark):
    df = spark.createDataFrame([("1",), ("-2",)], "value_x string")
    res = run_rules({"t": df}, {"string_tables": ["t"]}, ["string_tables"])
    assert [r.value_flag for r in res.tables["t"].collect()] == [0, 1]

    from flagstone.plans.runner import RuleOutput

    def upper(dfs, cfg, opts):
        return RuleOutput({k: v.select(*[F.upper(c).alias(c) for c in v.columns]) for k, v in dfs.items()})

    reg = rule_registry({"upper": upper})
    res = run_rules({"t": spark.createDataFrame([("a",)], "s string")}, {"upper": {}}, ["upper"], registry=reg)
    assert res.tables["t"].first().s == "A"


def test_strict_date_option_fails_on_bad_text(spark):
    anchor = spark.createDataFrame([("a", "2020/01/01")], "id string, LAST_DAY string")
    rows = spark.createDataFrame([("a", "not a date")], "id string, VISIT_DAY string")
    cfg = {"table": "anchor", "dt_column": "LAST_DAY", "id_column": "id", "dt_value": "DAY"}
    ok = run_rules({"anchor": anchor, "rows": rows}, {"last_dt": cfg}, ["last_dt"])
    assert ok.tables["rows"].first().last_dt_flag == 0
    strict = run_rules({"anchor": anchor, "rows": rows}, {"last_dt": cfg}, ["last_dt"], options=RunOptions(on_bad_date="fail"))
    with pytest.raises(Exception):
        strict.tables["rows"].collect()


def test_read_table_any_uri(spark):
    from flagstone.sources.delivery import read_table

    df = read_table(spark, "file:///root/testdata/sf0.001/region.parquet", "parquet")
    assert df.count() == 5


def test_upload_file(spark, tmp_path):
    from flagstone.plans.delivery import upload_file

    f = tmp_path / "tank.txt"
    f.write_text("tank|level\nt1|3.5\nt2|N/A\n")
    t = upload_file(spark, str(f), "up_qc", "3 - Tank-level", sep="|")
    assert t.count() == 2 and set(t.columns) == {"tank", "level"}


CELLS = [" 7", "ok ", "   ", 'say "hi" now', "two\nlines", "a|b", "café", "x,y", '"', None]


def test_csv_keeps_every_cell(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CELLS)], "rid int, c string")
    for sep, encoding in ((",", None), ("|", "ISO-8859-1")):
        out = scratch_path(spark, "cells")
        write_delimited(df, out, sep=sep, encoding=encoding)
        back = read_delimited(spark, out, sep=sep, encoding=encoding, schema=df.schema, multi_line=True)
        assert [r.c for r in back.orderBy("rid").collect()] == CELLS


def test_csv_refuses_text_the_encoding_cannot_hold(spark):
    df = spark.createDataFrame([("Łódź",)], "c string")
    with pytest.raises(Exception, match="(?i)malformed|encod"):
        write_delimited(df, scratch_path(spark, "enc"), encoding="ISO-8859-1")


def test_quotes_and_markers_as_read(spark, tmp_path):
    f = tmp_path / "q.txt"
    f.write_text('id|a|n\n1|"a ""q"" b"|1\n2|"two\nlines"|NA\n3||2.5\n4|null|-1e3\n')
    df = read_delimited(spark, str(f), na_values=NA_MARKERS, multi_line=True)
    assert df.dtypes == [("id", "bigint"), ("a", "string"), ("n", "double")]
    got = [tuple(r) for r in df.orderBy("id").collect()]
    assert got == [(1, 'a "q" b', 1.0), (2, "two\nlines", None), (3, None, 2.5), (4, None, -1000.0)]
