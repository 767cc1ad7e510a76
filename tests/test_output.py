"""Outputs are whole or as they were; batches can be tried again; reports are one file."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from flagstone.plans.delivery import run_delivery, store
from flagstone.session import scratch_path
from flagstone.sinks import writers
from flagstone.sinks.writers import ensure_database, replace_table, write_delimited
from flagstone.sources.delivery import read_delimited


@pytest.fixture
def database(spark):
    ensure_database(spark, "swap_qc", scratch_path(spark, "swap"))
    return "swap_qc"


def failing(spark, n=100):
    """Rows of which the last tasks fail, when the first have written theirs."""
    return spark.range(n).repartition(4, "id").selectExpr(f"CASE WHEN id = {n - 1} THEN raise_error('half way') ELSE id END AS id")


def names(folder):
    return sorted(os.listdir(folder))


def tables(spark, database):
    return sorted(t.name for t in spark.catalog.listTables(database))


def test_a_failed_write_leaves_the_table(spark, database):
    name = replace_table(spark.range(7), database, "kept")
    with pytest.raises(Exception, match="half way"):
        replace_table(failing(spark), database, "kept")
    assert spark.table(name).count() == 7
    assert [t for t in tables(spark, database) if t.startswith("kept")] == ["kept"]


def test_a_table_may_be_replaced_by_what_reads_it(spark, database):
    name = replace_table(spark.range(5), database, "own")
    replace_table(spark.table(name).withColumn("flag", F.lit(1)), database, "own")
    assert [r.flag for r in spark.table(name).collect()] == [1] * 5


def test_a_table_left_aside_comes_back(spark, database):
    """A run that ended between the two renames."""
    replace_table(spark.range(5), database, "aside")
    spark.sql(f"ALTER TABLE {database}.aside RENAME TO {database}.aside{writers.FORMER_SUFFIX}")
    with pytest.raises(Exception, match="half way"):
        replace_table(failing(spark), database, "aside")
    name = replace_table(spark.range(6), database, "aside")
    assert spark.table(name).count() == 6
    assert [t for t in tables(spark, database) if t.startswith("aside")] == ["aside"]


def test_a_failed_write_leaves_the_files(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_delimited(spark.range(7), path)
    with pytest.raises(Exception, match="half way"):
        write_delimited(failing(spark), path)
    assert spark.read.option("header", True).csv(path).count() == 7
    store(spark, spark.range(3), "t", "_RAW", None, str(tmp_path))
    with pytest.raises(Exception, match="half way"):
        store(spark, failing(spark), "t", "_RAW", None, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t_RAW")).count() == 3
    again = store(spark, spark.read.parquet(str(tmp_path / "t_RAW")).withColumn("x", F.lit(1)), "t", "_RAW", None, str(tmp_path))
    assert again.columns == ["id", "x"] and again.count() == 3
    assert not [n for n in names(tmp_path) if ".next-" in n or n.endswith(".former")]


def test_files_left_aside_come_back(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_delimited(spark.range(7), path)
    os.rename(path, str(tmp_path / ".out.csv.former"))
    write_delimited(spark.range(8), path)
    assert spark.read.option("header", True).csv(path).count() == 8 and names(tmp_path) == ["out.csv"]


def test_a_batch_can_be_tried_again(spark, tmp_path):
    path, read = str(tmp_path / "log.csv"), lambda: sorted(int(r.id) for r in spark.read.option("header", True).csv(path).collect())
    write_delimited(spark.range(3), path, mode="append", batch="monday")
    write_delimited(spark.range(10, 12).repartition(2), path, mode="append", batch="tuesday")
    write_delimited(spark.range(10, 13).repartition(3), path, mode="append", batch="tuesday")
    assert read() == [0, 1, 2, 10, 11, 12]
    with pytest.raises(Exception, match="half way"):
        write_delimited(failing(spark), path, mode="append", batch="monday")
    assert read() == [0, 1, 2, 10, 11, 12]
    write_delimited(spark.range(20, 21), path, mode="append")
    assert read() == [0, 1, 2, 10, 11, 12, 20]
    with pytest.raises(ValueError, match="batch"):
        write_delimited(spark.range(3), path, mode="append", batch="../x")


def test_one_file_from_many_parts(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).repartitionByRange(5, "id").selectExpr("id", "concat('a,\"', id, '\nb') AS t")
    path = str(tmp_path / "report.csv")
    for _ in range(2):
        write_delimited(rows, path, single_file=True)
    assert os.path.isfile(path)
    lines = open(path).read()
    assert lines.startswith('id,t\n0,"a,""0\nb"\n1,') and lines.count("id,t") == 1
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).collect()
    assert [(int(r.id), r.t) for r in back] == [(i, f'a,"{i}\nb') for i in range(1000)]
    write_delimited(spark.range(0), path, single_file=True)
    assert open(path).read().strip() in ("id", "")
    monkeypatch.setattr(writers, "JOIN_BYTES", 10)
    write_delimited(rows, path, single_file=True)
    assert os.path.isdir(path) and spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count() == 1000
    with pytest.raises(ValueError, match="line break"):
        write_delimited(rows.withColumnRenamed("t", "a\nb"), path, single_file=True)


def test_reports_of_a_run_are_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "boats.txt").write_text("id|value_n\n1|x\n1|2\n2|\n")
    vendor = {"rules": {"missing": {}, "duplication": {"boats": ["id"]}, "string_tables": {}}, "rule_sequence": ["duplication", "string_tables", "missing"]}
    for _ in range(2):
        res = run_delivery(spark, vendor, str(tmp_path / "in"), str(tmp_path / "out"), database="")
        reports = [n for n in res.outputs if n.startswith("qc_")]
        assert sorted(reports) == ["qc_dup_boats", "qc_missing", "qc_summary", "qc_value"]
        assert all(os.path.isfile(res.outputs[n]) for n in reports) and os.path.isdir(res.outputs["boats"])
    assert open(res.outputs["qc_missing"]).read() == "column,missing,tbl\nid,0,boats\nvalue_n,1,boats\n"


def test_compressed_text_is_whole(spark, tmp_path, monkeypatch):
    """Compressed parts and single files hold every row under one header; names tell the readers."""
    rows = spark.range(0, 500, numPartitions=5).selectExpr("id", "concat('a \"q\" ', id % 7, CASE WHEN id % 3 = 0 THEN ',' END) AS `t,\"x`")
    want = sorted(tuple(r) for r in rows.selectExpr("CAST(id AS STRING)", "`t,\"x`").collect())
    for encoding in (None, "ISO-8859-1"):
        folder, one = str(tmp_path / f"f{encoding}.txt"), str(tmp_path / f"one{encoding}.csv.gz")
        write_delimited(rows, folder, sep="|", encoding=encoding, compression="gzip")
        assert all(f.endswith(".csv.gz") for f in os.listdir(folder) if f.startswith("part-"))
        write_delimited(rows, one, encoding=encoding, compression="gzip", single_file=True)
        lines = gzip.open(one, "rt").read().splitlines()
        assert os.path.isfile(one) and len(lines) == 501 and sum(x.startswith("id,") for x in lines) == 1
        for path, sep in ((folder, "|"), (one, ",")):
            assert sorted(tuple(r) for r in read_delimited(spark, path, sep=sep, infer_schema=False).collect()) == want
    monkeypatch.setattr(writers, "JOIN_COMPRESSED_BYTES", 10)
    write_delimited(rows, one, compression="gzip", single_file=True)
    assert os.path.isdir(one) and read_delimited(spark, one, sep=",", infer_schema=False).count() == 500
    for bad in ({"compression": "zip"}, {"compression": "gzip", "single_file": True}):
        with pytest.raises(ValueError):
            write_delimited(rows, str(tmp_path / "bad.csv"), **bad)


def test_compressed_run(spark, tmp_path):
    """A run of compressed files writes compressed ones, with the rows of a plain run."""
    rows = spark.range(0, 60, numPartitions=3).selectExpr("id % 20 AS id", "id % 3 AS n", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS a_dt")
    limits = spark.range(0, 20, numPartitions=2).selectExpr("id", "DATE'2024-01-20' AS end_dt")
    rules = {
        "last_dt": {"table": "limits", "dt_column": "end_dt", "id_column": "id", "dt_value": "_dt"},
        "duplication": {"lines": ["id"]},
    }
    found = []
    for compression in (None, "gzip"):
        base = str(tmp_path / str(compression))
        for name, df in (("lines", rows), ("limits", limits)):
            write_delimited(df, f"{base}/in/{name}.txt", sep="|", compression=compression)
        vendor = {"rules": rules, "rule_sequence": list(rules), **({"compression": compression} if compression else {})}
        out = run_delivery(spark, vendor, base + "/in", base + "/out", database="").outputs
        assert {k: v.rsplit("/", 1)[1] for k, v in out.items() if k != "lines"}["qc_dup_lines"] == "qc_dup_lines.csv" + (".gz" if compression else "")
        found.append({k: sorted(map(str, read_delimited(spark, v, sep=",", infer_schema=False).collect())) for k, v in out.items()})
    assert found[0] == found[1] and len(found[0]["lines"]) == 60
    with pytest.raises(ValueError):
        run_delivery(spark, {**vendor, "compression": "zip"}, base + "/in", base + "/out2", database="")
