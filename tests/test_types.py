"""Types of delivered text columns: no cell changes its value."""

import re
from decimal import Decimal

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flagstone.operators.duplicates import flag_duplicates
from flagstone.plans.delivery import run_delivery
from flagstone.sources.delivery import read_delimited, read_delivery
from flagstone.sources.types import Facts, column_facts, in_schema, misfits, typed

CASES = {
    "small": (["1", "-2", "+3"], "bigint", [1, -2, 3]),
    "eighteen": (["999999999999999999", "1"], "bigint", [999999999999999999, 1]),
    "nineteen": (["1234567890123456781", "1234567890123456782"], "bigint", [1234567890123456781, 1234567890123456782]),
    "least_long": (["-9223372036854775808", "9223372036854775807"], "bigint", [-(2**63), 2**63 - 1]),
    "over_long": (["9223372036854775808", "1"], "decimal(38,0)", [Decimal(2**63), Decimal(1)]),
    "digits_38": (["9" * 38, "0"], "decimal(38,0)", [Decimal("9" * 38), Decimal(0)]),
    "digits_39": (["9" * 39, "1"], "string", ["9" * 39, "1"]),
    "padded": (["007", "8"], "string", ["007", "8"]),
    "padded_fraction": (["07.5", "8"], "string", ["07.5", "8"]),
    "zero": (["0", "0.5", "-0.25", ".5", "5."], "double", [0.0, 0.5, -0.25, 0.5, 5.0]),
    "printed_double": (["0.30000000000000004", "1.0E-7", "1.7976931348623157E308"], "double", [0.1 + 0.2, 1e-7, 1.7976931348623157e308]),
    "fine": (["1.00000000000000000001", "12.5"], "decimal(22,20)", [Decimal("1.00000000000000000001"), Decimal("12.50000000000000000000")]),
    "finer": (["0." + "1" * 38, "12.5"], "string", ["0." + "1" * 38, "12.5"]),
    "too_large": (["1e400", "1"], "string", ["1e400", "1"]),
    "mixed": (["1"] * 400 + ["abc"], "string", ["1"] * 400 + ["abc"]),
    "day": (["2018-02-15", "2020-02-29"], "date", None),
    "no_day": (["2018-02-30", "2020-02-29"], "string", ["2018-02-30", "2020-02-29"]),
    "day_or_number": (["2018-02-15", "7"], "string", ["2018-02-15", "7"]),
    "padding": ([" 7", "8"], "string", [" 7", "8"]),
    "nothing": ([None, None], "string", [None, None]),
    "gaps": ([None, "5", None], "bigint", [None, 5, None]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_type_holds_every_cell(spark, name):
    cells, want, values = CASES[name]
    text = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "at int, c string").repartition(3)
    facts = column_facts({"t": text.select("c")})["t"]
    assert [f.type() for f in facts] == [want]
    back = typed(text.select("c", "at"), [want, "int"]).orderBy("at")
    assert back.dtypes[0][1] == want
    if values is not None:
        assert [r.c for r in back.collect()] == values


def test_facts_of_parts_add_up(spark):
    """Facts merge: those of two halves are those of the whole."""
    cells = [c for case, _, _ in CASES.values() for c in case]
    half = len(cells) // 2
    facts = lambda part: column_facts({"t": spark.createDataFrame([(c,) for c in part], "c string")})["t"][0]
    assert facts(cells[:half]) + facts(cells[half:]) == facts(cells)
    assert Facts() + facts(cells) == facts(cells)


def test_all_tables_in_one_job(spark):
    tables = {n: spark.createDataFrame([(c, "x") for c in CASES[n][0]], "`a b` string, other string") for n in ("small", "padded", "nothing")}
    tables["wide"] = spark.createDataFrame([("1",)], "only string")
    found = column_facts(tables)
    assert {n: [f.type() for f in fs] for n, fs in found.items()} == {
        "small": ["bigint", "string"], "padded": ["string", "string"], "nothing": ["string", "string"], "wide": ["bigint"]
    }
    assert column_facts({}) == {}


def test_long_ids_are_no_duplicates(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("id|n\n1234567890123456781|1\n1234567890123456782|1\n1234567890123456782|2\n")
    ids = read_delivery(spark, str(tmp_path))["ids"]
    got = {(r.id, r.n): r.dup_count for r in flag_duplicates(ids, ["id"]).collect()}
    assert got == {(1234567890123456781, 1): 0, (1234567890123456782, 1): 2, (1234567890123456782, 2): 2}


SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_cells_that_a_schema_cannot_hold(spark, tmp_path):
    (tmp_path / "boats.txt").write_text("id|name\n1|ann\nabc|zoe\nabc|eve\n|mona\n")
    path = str(tmp_path / "boats.txt")
    with pytest.raises(Exception, match="boats, column id: no bigint: abc"):
        read_delimited(spark, path, schema=SCHEMA, on_misfit="fail").collect()
    lenient = read_delimited(spark, path, schema=SCHEMA, on_misfit="null")
    assert [r.id for r in lenient.orderBy("name").collect()] == [1, None, None, None]
    text = spark.createDataFrame([("1", "a"), ("abc", "b"), ("abc", "c"), (None, "d")], "id string, name string")
    assert [tuple(r) for r in misfits(text, SCHEMA, "t").collect()] == [("t", "id", "abc")]
    assert misfits(text, StructType([SCHEMA["name"]]), "t").count() == 0
    with pytest.raises(ValueError, match="on_misfit"):
        in_schema(text, SCHEMA, on_misfit="drop")


def test_run_reports_cells_that_a_schema_cannot_hold(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "boats.txt").write_text("id|name\n1|ann\nabc|zoe\n")
    vendor = {"rules": {"missing": {}}, "rule_sequence": ["missing"], "on_misfit": "report"}
    res = run_delivery(spark, vendor, str(tmp_path / "in"), str(tmp_path / "out"), database="", schemas={"boats": SCHEMA})
    assert {r.name: r.missing_flag for r in res.flagged["boats"].collect()} == {"ann": 0, "zoe": 1}
    rows = read_delimited(spark, res.outputs["qc_misfit"], sep=",", infer_schema=False).collect()
    assert [tuple(r) for r in rows] == [("boats", "id", "abc")]
    with pytest.raises(Exception, match="column id"):
        run_delivery(spark, {**vendor, "on_misfit": "fail"}, str(tmp_path / "in"), str(tmp_path / "out2"), database="", schemas={"boats": SCHEMA})


EDGES = {
    "9223372036854775807": 1, "9223372036854775808": 0, "-9223372036854775808": 1, "-9223372036854775809": 0, "+9223372036854775807": 1,
    "0009223372036854775807": 1, "0009223372036854775808": 0, "-0": 1, "1234567890123456789012345": 0, "9223372036854775807\n": 1, "7 ": 0,
    "1.5": 0, "abc": 0,
}
EXACT = {"1.123456789012345678": 0, "0.0012345678901234567": 1, "123456789.0123456": 0, "1.7976931348623157E308": 1, "1e400": 0, "12345678901234567": 0, "5.\n": 1}


@pytest.mark.parametrize("fact, cells", [("longs", EDGES), ("exact", EXACT)])
def test_facts_at_the_edges_without_casts_that_fail(spark, fact, cells):
    """Whole numbers are compared with the 64-bit limits as text: no cell costs an exception."""
    tables = {str(i): spark.createDataFrame([(c,)], "c string") for i, c in enumerate(cells)}
    found = column_facts(tables)
    assert {c: getattr(found[str(i)][0], fact) for i, c in enumerate(cells)} == cells


def test_facts_cast_no_long_ids(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    column_facts({"t": spark.createDataFrame([("1" * 25,)], "c string")})
    casts = re.findall(r"(.{20})try_cast\(c#\d+ as bigint\)", plans[0])
    assert casts and all(before.endswith("THEN isnotnull(") for before in casts)


def test_long_decimal_keys_are_sorted_by_a_hash(spark):
    from flagstone.operators.skew import keyed_join

    rows = spark.createDataFrame([("1" * 25, 1), ("1" * 24 + "2", 2), (None, 3)], "k string, v int").selectExpr("CAST(k AS decimal(38,0)) AS k", "v")
    side = spark.createDataFrame([("1" * 25, 7), (None, 8)], "s string, n int").selectExpr("CAST(s AS decimal(38,0)) AS s", "n")
    out = keyed_join(rows, side, ["k"], ["s"], "left", side_out=["n"])
    assert out.columns == ["k", "v", "n"]
    assert sorted((r.v, r.n) for r in out.collect()) == [(1, 7), (2, None), (3, None)]
    assert "xxhash64" in out._jdf.queryExecution().optimizedPlan().toString()
    safe = keyed_join(rows, side, ["k"], ["s"], "left", null_safe=True, side_out=["n"])
    assert sorted((r.v, r.n) for r in safe.collect()) == [(1, 7), (2, None), (3, 8)]
    anti = keyed_join(rows, side, ["k"], ["s"], "left_anti")
    assert anti.columns == ["k", "v"] and sorted(r.v for r in anti.collect()) == [2, 3]
