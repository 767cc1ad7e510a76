"""Column predicates: the non-negative decimal table and blanks."""

import pytest

from flagstone.functions.columns import (
    added_name,
    data_columns,
    is_missing,
    is_nonneg_decimal,
    mark_added,
    match_columns,
    to_time_value_sql,
    unparsed_sql,
)

CASES = [
    ("34", True),
    (".5", True),
    ("5.", True),
    ("0", True),
    ("", False),
    (".", False),
    ("-1", False),
    ("1.2.3", False),
    (" 7", False),
    ("1e5", False),
    ("Dog", False),
    (None, False),
]


def test_nonneg_decimal_strings(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "rid int, v string")
    got = [r.ok for r in df.select("rid", is_nonneg_decimal(df, "v").alias("ok")).orderBy("rid").collect()]
    assert got == [ok for _, ok in CASES]


def test_nonneg_decimal_numbers(spark):
    vals = [0.0, 3.5, -1.0, float("nan"), float("inf"), None, 1e7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "rid int, v double")
    got = [r.ok for r in df.select("rid", is_nonneg_decimal(df, "v").alias("ok")).orderBy("rid").collect()]
    assert got == [True, True, False, False, False, False, True]


def test_blank_is_unicode_aware(spark):
    df = spark.createDataFrame([(0, "\u00a0"), (1, " x "), (2, "\t\n"), (3, "")], "rid int, v string")
    got = [r.m for r in df.select("rid", is_missing(df, "v").alias("m")).orderBy("rid").collect()]
    assert got == [True, False, True, True]


@pytest.mark.parametrize(
    "contains,not_contains,exclude,expected",
    [
        ("DAT", None, [], ["LASTDAT", "VISDAT"]),
        ("DAT", "LAST", [], ["VISDAT"]),
        ("DAT", None, ["VISDAT"], ["LASTDAT"]),
        ("flag", None, [], []),
    ],
)
def test_match_columns(spark, contains, not_contains, exclude, expected):
    df = spark.createDataFrame([], "id int, LASTDAT int, VISDAT int, value_flag int, dup_flag int")
    df = mark_added(df, "value_flag", "dup_flag")
    assert match_columns(df, contains, not_contains, exclude) == expected


def test_names_of_added_columns(spark):
    df = spark.createDataFrame([], "result string, dup_count int")
    assert data_columns(df) == ["result", "dup_count"]
    assert added_name(df, "result") == "result_qc" and added_name(df, "dup_flag") == "dup_flag"
    own = mark_added(df, "dup_count")
    assert added_name(own, "dup_count") == "dup_count" and data_columns(own) == ["result"]


DATES = [
    ("2018-02-15T10:00:00", "2018-02-15 10:00:00"),
    ("2018-02-15T10:00:00Z", "2018-02-15 10:00:00"),
    ("2018-02-15 10:00:00.123", "2018-02-15 10:00:00.123"),
    ("2018/2/5", "2018-02-05 00:00:00"),
    ("2018/02/UK", "2018-02-15 00:00:00"),
    ("20180215", "2018-02-15 00:00:00"),
    ("20180215103000", "2018-02-15 10:30:00"),
    ("02/15/2018", "2018-02-15 00:00:00"),
    ("15/02/2018", "2018-02-15 00:00:00"),
    ("15-Feb-2018", "2018-02-15 00:00:00"),
    ("15 February 2018", "2018-02-15 00:00:00"),
    ("Dec 5, 2018", "2018-12-05 00:00:00"),
    ("2018.02.05", "2018-02-05 00:00:00"),
    (" 2018-02-15 ", "2018-02-15 00:00:00"),
    ("2018/11/04", "2018-11-04 00:00:00"),
    ("15-FEB-18", "2018-02-15 00:00:00"),
    ("01-jan-69", "1969-01-01 00:00:00"),
    ("31/12/68", "2068-12-31 00:00:00"),
    ("02/15/18", "2018-02-15 00:00:00"),
    ("2/5/18 7:05", "2018-02-05 07:05:00"),
    ("02/15/2018 10:05 PM", "2018-02-15 22:05:00"),
    ("02/15/2018 12:05:30 a.m.", "2018-02-15 00:05:30"),
    ("2018-02-15 12:00PM", "2018-02-15 12:00:00"),
    ("15-FEB-18 1:05 pm", "2018-02-15 13:05:00"),
    ("20180215T101500", "2018-02-15 10:15:00"),
    ("20180215T1015Z", "2018-02-15 10:15:00"),
    ("20180215 10:15", "2018-02-15 10:15:00"),
    ("Feb 2018", "2018-02-01 00:00:00"),
    ("September, 2018", "2018-09-01 00:00:00"),
    ("Thu Feb 15 2018", "2018-02-15 00:00:00"),
    ("Thursday, 15 Feb 2018 10:05:30.25 +0100", "2018-02-15 10:05:30.25"),
    ("Feb 3rd, 2018", "2018-02-03 00:00:00"),
    ("2018-Feb-15", "2018-02-15 00:00:00"),
    ("15FEB2018", "2018-02-15 00:00:00"),
    ("UK-FEB-18", "2018-02-15 00:00:00"),
    ("2018-02-15T10:00:00+05:30", "2018-02-15 10:00:00"),
    ("2018-02", "2018-02-01 00:00:00"),
    ("2018", "2018-01-01 00:00:00"),
    ("201802151", None),
    ("13/13/2018", None),
    ("20181315", None),
    ("02/15/2018 10:75 PM", None),
    ("15-FEB-1", None),
    ("Sunday", None),
    ("a.m.", None),
    ("12:30 PM", None),
    ("1/2", None),
    ("x" * 5000 + " 2018", None),
    ("2018-02-30", None),
    ("15-Foo-2018", None),
    ("not a date", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_dates_in_any_layout_and_zone(spark, zone):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "rid int, t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = df.selectExpr("rid", f"CAST({to_time_value_sql(df, 't')} AS STRING) AS v", f"{unparsed_sql(df, 't')} AS bad").orderBy("rid").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.v for r in got] == [v for _, v in DATES]
    assert [r.bad for r in got] == [v is None and bool((t or "").strip()) for t, v in DATES]


def test_number_dates(spark):
    df = spark.createDataFrame([(0, 20190101.0), (1, 20190101.5), (2, float("nan")), (3, None), (4, 1e300)], "rid int, t double")
    exprs = [f"CAST({to_time_value_sql(df, 't')} AS STRING) AS v", f"{unparsed_sql(df, 't')} AS bad", "CAST(t AS DECIMAL(12,1)) AS x"]
    got = df.where("rid < 4").selectExpr("rid", *exprs[:2]).orderBy("rid").collect()
    assert [(r.v, r.bad) for r in got] == [("2019-01-01 00:00:00", False), (None, True), (None, False), (None, False)]
    assert df.where("rid = 4").selectExpr(exprs[0]).first().v is None
    exact = df.where("rid < 2").selectExpr("rid", exprs[2])
    got = [r.v for r in exact.selectExpr("rid", f"CAST({to_time_value_sql(exact, 'x')} AS STRING) AS v").orderBy("rid").collect()]
    assert got == ["2019-01-01 00:00:00", None]
    strict = df.where("rid IN (0, 2, 3)").selectExpr(f"{to_time_value_sql(df, 't', on_bad='fail')} AS v")
    assert sum(r.v is not None for r in strict.collect()) == 1


def test_integer_dates(spark):
    df = spark.createDataFrame([(0, 20190101), (1, 20191345), (2, 7), (3, None)], "rid int, t int")
    got = [r.v for r in df.selectExpr("rid", f"CAST({to_time_value_sql(df, 't')} AS STRING) AS v").orderBy("rid").collect()]
    assert got == ["2019-01-01 00:00:00", None, None, None]
    strict = df.where("rid = 2").selectExpr(to_time_value_sql(df, "t", on_bad="fail"))
    with pytest.raises(Exception, match="bad date"):
        strict.collect()


def test_with_row_id_unique(spark):
    from flagstone.functions.columns import with_row_id

    df = with_row_id(spark.range(1000).repartition(7))
    assert df.select("columnindex").distinct().count() == 1000
