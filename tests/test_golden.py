"""Golden cases: small tables with hand-derived results."""

import pytest

from flagstone.operators import (
    DateBoundSpec,
    death_date,
    duplicate_report,
    flag_duplicates,
    flag_missing,
    flag_missing_null_only,
    flag_negative,
    flag_non_numeric,
    last_date,
    mappable_id,
    missing_by_column,
    negative_rows,
    offending_values,
    unique_key,
)
from flagstone.operators.dates import unparsed_dates
from flagstone.operators.rule import MappableIdRule, UniqueKeyRule
from flagstone.operators.summary import flag_summary

SEATS = [
    ("oslo", 4, "window"),
    ("turin", 9, "aisle"),
    ("lima", 2, "window"),
    ("turin", 9, "middle"),
    ("turin", 9, "aisle"),
    ("turin", 9, "middle"),
    ("lima", 2, "aisle"),
    ("porto", 9, "aisle"),
]


def with_id(spark, data, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "rid int, " + schema)
    return df


def by_id(df, col):
    return [r[col] for r in df.orderBy("rid").collect()]


def test_duplicates(spark):
    df = with_id(spark, SEATS, "train string, coach int, place string")
    keys = ["train", "coach", "place"]
    out = flag_duplicates(df, keys)
    assert out.count() == 8
    assert by_id(out, "dup_count") == [0, 2, 0, 2, 2, 2, 0, 0]
    assert by_id(out, "dup_flag") == [0, 1, 0, 1, 1, 1, 0, 0]
    assert out.columns == df.columns + ["dup_count", "dup_flag"]
    s = flag_summary(out, "duplication", "seats", "dup_flag").collect()[0]
    assert (s.total, s["count"], s.percent) == (8, 4, 50.0)
    rep = duplicate_report(df, keys).collect()
    assert len(rep) == 4 and {r.counts for r in rep} == {2}
    assert [r.place for r in rep] == ["aisle", "aisle", "middle", "middle"]
    assert by_id(unique_key(df, keys), "result") == [True, False, True, False, False, False, True, True]
    rule = UniqueKeyRule(df, keys)
    assert not rule.passed()
    assert rule.result_message("seats") == rule.fail_message("seats") != rule.success_message("seats")
    ev = rule.result_to_events("qc", "001").collect()
    assert len(ev) == 4 and ev[0].event_type == "Unique PK"


METERS = [
    ("north", "17", "ok"),
    (None, "4", "ok"),
    ("east", "\t ", "ok"),
    ("west", "4", ""),
    ("south", None, None),
    ("hill", "8", "late"),
]


def test_missing(spark):
    df = with_id(spark, METERS, "site string, reading string, state string")
    out = flag_missing(df, ["site", "reading", "state"])
    assert by_id(out, "missing_flag") == [0, 1, 1, 1, 1, 0]
    assert by_id(flag_missing(df, ["reading", "state"]), "missing_flag") == [0, 0, 1, 1, 1, 0]
    rep = {(r.column, r.missing, r.tbl) for r in missing_by_column(df, "meters", ["site", "reading", "state"]).collect()}
    assert rep == {("site", 1, "meters"), ("reading", 2, "meters"), ("state", 2, "meters")}
    assert by_id(flag_missing_null_only(df, ["site", "reading", "state"]), "flag_missing") == [0, 1, 0, 0, 1, 0]


def test_missing_all_columns_skip_added_flags(spark):
    df = flag_duplicates(with_id(spark, METERS, "site string, reading string, state string"), ["state"])
    rep = {r.column for r in missing_by_column(df, "meters").collect()}
    assert rep == {"rid", "site", "reading", "state"}


def test_data_columns_with_reserved_names(spark):
    """A table may have columns called result or dup_count; they are checked and kept."""
    df = spark.createDataFrame([(0, None, 5), (1, "pos", 5), (2, "neg", None)], "rid int, result string, dup_count int")
    assert by_id(flag_missing(df), "missing_flag") == [1, 0, 1]
    dup = flag_duplicates(df, ["dup_count"])
    assert dup.columns == ["rid", "result", "dup_count", "dup_count_qc", "dup_flag"]
    assert by_id(dup, "dup_count") == [5, 5, None] and by_id(dup, "dup_count_qc") == [2, 2, 0]
    key = unique_key(df, ["dup_count"])
    assert by_id(key, "result") == [None, "pos", "neg"] and by_id(key, "result_qc") == [False, False, True]
    events = [r.event_data for r in UniqueKeyRule(df, ["dup_count"]).result_to_events("qc", "1").collect()]
    assert sorted(events) == ['{"rid":0,"result":null,"dup_count":5}', '{"rid":1,"result":"pos","dup_count":5}']


GAUGES = [
    ("a", "12", "7.5"),
    ("b", "none", "3"),
    ("c", "0", "-4"),
    ("d", "-2", "1"),
    ("e", "", ".25"),
    ("f", "9", None),
]


def test_values_and_negatives(spark):
    df = with_id(spark, GAUGES, "gauge string, value_level string, value_flow string")
    out = flag_non_numeric(df, "value")
    assert by_id(out, "value_flag") == [0, 1, 1, 1, 1, 1]
    assert by_id(flag_non_numeric(df, "value", null_is_bad=False), "value_flag") == [0, 1, 1, 1, 1, 0]
    rep = {}
    for r in offending_values(df, "gauges", "value").collect():
        rep.setdefault(r.column, set()).add(r.value)
    assert rep == {"value_level": {"none", "-2", ""}, "value_flow": {"-4"}}
    assert by_id(flag_negative(df, "value"), "negative_flag") == [0, 0, 1, 1, 0, 0]
    assert sorted(r.rid for r in negative_rows(df, "value").collect()) == [2, 3]
    # a later rule must not take the flag column for a value column
    again = flag_non_numeric(out, "value")
    assert again.columns == out.columns
    with pytest.raises(ValueError, match="nowhere"):
        flag_non_numeric(df, columns=["nowhere"])


def test_table_without_value_columns_untouched(spark):
    df = with_id(spark, SEATS, "train string, coach int, place string")
    assert flag_non_numeric(df, "value") is df
    assert offending_values(df, "seats", "value") is None


LEASES = [("k1", "2021/03/31", "2021/06/30"), ("k2", "2020/12/01", "2019/12/01"), ("k3", "2022/01/15", "2023/01/15")]
VISITS = [
    ("k1", "2021/04/01", "2021/02/01"),
    ("k2", "2020/01/01", "2020/11/UK"),
    ("k2", "2020/12/UK", ""),
    ("k3", "2022/01/15", "2021/07/07"),
    ("k3", "", "2023/02/01"),
    ("k9", "2030/01/01", "2030/01/01"),
]


def _date_tables(spark):
    leases = spark.createDataFrame(LEASES, "unit string, END_DAY string, CLOSE_DAY string")
    visits = with_id(spark, VISITS, "unit string, FIRST_DAY string, NEXT_DAY string")
    return {"leases": leases, "visits": visits}


def test_last_date(spark):
    dfs = _date_tables(spark)
    spec = {"table": "leases", "dt_column": "END_DAY", "id_column": "unit", "dt_value": "DAY", "ignorecols": ["CLOSE_DAY"]}
    tables, reports = last_date(dfs, spec)
    assert by_id(tables["visits"], "last_dt_flag") == [1, 0, 1, 0, 1, 0]
    assert tables["leases"] is dfs["leases"]
    assert list(reports) == ["visits"]
    for rep in (reports["visits"](), reports["visits"](tables["visits"])):
        got = {(r.rid, str(r.END_DAY)[:10], r.last_dt_flag) for r in rep.collect()}
        assert got == {(0, "2021-03-31", 1), (2, "2020-12-01", 1), (4, "2022-01-15", 1)}


def test_death_date(spark):
    tables, _ = death_date(_date_tables(spark), DateBoundSpec("leases", "CLOSE_DAY", "unit", "DAY"))
    assert by_id(tables["visits"], "death_dt_flag") == [0, 1, 1, 0, 1, 0]
    assert {r.unit: r.death_dt_flag for r in tables["leases"].collect()} == {"k1": 0, "k2": 1, "k3": 0}


def test_dates_without_id_column_are_reported(spark, caplog):
    dfs = {**_date_tables(spark), "loose": spark.createDataFrame([("2021/01/01",)], "ANY_DAY string")}
    tables, reports = last_date(dfs, DateBoundSpec("leases", "END_DAY", "unit", "DAY"))
    assert tables["loose"] is dfs["loose"] and "loose" not in reports and "loose" in caplog.text


def test_unparsed_dates(spark):
    df = spark.createDataFrame([("k1", "soon", 20210101), ("k1", "2021/01/01", 5), ("k1", None, None)], "unit string, A_DAY string, B_DAY int")
    got = {tuple(r) for r in unparsed_dates(df, DateBoundSpec("leases", "END_DAY", "unit", "DAY"), "t").collect()}
    assert got == {("t", "A_DAY", "soon"), ("t", "B_DAY", "5")}


def test_date_float_mode_nan_is_not_a_violation(spark):
    anchor = spark.createDataFrame([("a", 10.0), ("a", float("nan")), ("b", float("nan"))], "id string, last_time double")
    rows = spark.createDataFrame([(0, "a", 5.0), (1, "a", 11.0), (2, "b", 1.0), (3, "a", float("nan"))], "rid int, id string, obs_time double")
    spec = DateBoundSpec("anchor", "last_time", "id", "time", dt_type="float")
    tables, _ = last_date({"anchor": anchor, "rows": rows}, spec)
    assert by_id(tables["rows"], "last_dt_flag") == [0, 1, 0, 0]


def test_date_outer_keeps_unmatched_anchor_ids(spark):
    anchor = spark.createDataFrame([("a", "2020/01/01"), ("z", "2020/01/01")], "id string, LASTDAT string")
    rows = spark.createDataFrame([("a", "2021/01/01")], "id string, VISDAT string")
    spec = DateBoundSpec("anchor", "LASTDAT", "id", "DAT")
    tables, _ = last_date({"anchor": anchor, "rows": rows}, spec, keep_unmatched_anchor=True)
    got = sorted((r.id, r.VISDAT, r.last_dt_flag) for r in tables["rows"].collect())
    assert got == [("a", "2021/01/01", 1), ("z", None, 0)]


def test_mappable_id(spark):
    sub = spark.createDataFrame([(0, 1), (1, 2), (2, 2), (3, 9), (4, None)], "rid int, id int")
    sup = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert by_id(mappable_id(sub, sup, "id"), "result") == [True, True, True, False, False]
    sup_null = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    assert by_id(mappable_id(sub, sup_null, "id"), "result") == [True, True, True, False, True]
    assert by_id(mappable_id(sub, sup_null, "id", null_safe=False), "result") == [True, True, True, False, False]
    rule = MappableIdRule({"subset": sub, "superset": sup}, "id")
    assert not rule.passed()
    assert rule.fail_message("t") != rule.success_message("t")


def test_awkward_column_names(spark):
    """Names with dots, spaces, hyphens, quotes and back-ticks survive every rule."""
    from flagstone.operators.dates import DateBoundSpec

    cols = ["pat.id", "value Age", "LB-ORR`x", "it's DAT"]
    df = spark.createDataFrame(
        [("p1", "34", "N/A", "2019/01/01"), ("p1", "34", "7", None), ("p2", "-1", "", "2018/01/01")],
        ", ".join(f"`{c.replace('`', '``')}` string" for c in cols),
    )
    dup = flag_duplicates(df, ["pat.id", "value Age"])
    assert [r["dup_count"] for r in dup.orderBy("dup_count").collect()] == [0, 2, 2]
    vf = flag_non_numeric(df, "value")
    assert sorted(r["value_flag"] for r in vf.collect()) == [0, 0, 1]
    rep = {(r.column, r.value) for r in offending_values(df, "t-1", "ORR").collect()}
    assert rep == {("LB-ORR`x", "N/A"), ("LB-ORR`x", "")}
    mf = flag_missing(df)
    assert sorted(r["missing_flag"] for r in mf.collect()) == [0, 1, 1]
    assert {r.column for r in missing_by_column(df, "t'1").collect()} == set(cols)
    anchor = spark.createDataFrame([("p1", "2018/06/01")], "`pat.id` string, `LAST DAT` string")
    tables, _ = last_date({"a": anchor, "r": df}, DateBoundSpec("a", "LAST DAT", "pat.id", "DAT"))
    assert sorted(r["last_dt_flag"] for r in tables["r"].collect()) == [0, 0, 1]
