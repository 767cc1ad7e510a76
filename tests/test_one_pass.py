"""Frequency tables and summaries that take one pass, or none."""

import glob
import re
from collections import Counter

import pytest

from flagstone.operators.frequency import frequencies, frequency, frequency_of, frequency_rows
from flagstone.operators.summary import observed_flags, summary_of_counts
from flagstone.plans.delivery import run_delivery
from flagstone.plans.runner import run_rules

LABELS = {"1": ["a.b", "count"], "2": ["count"], "3": ["c"], "4": ["count", "a.b"], "5": ["a.b", "count", "c"]}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [("x", 1, None), ("x", 1, "p"), (None, 1, "p"), (None, None, None), ("x", None, "p"), ("y", 2, "p")] * 3
    path = str(tmp_path_factory.mktemp("freq") / "t.parquet")
    spark.createDataFrame(rows, "`a.b` string, count int, c string").write.parquet(path)
    return spark.read.parquet(path)


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan", plan))


def test_labels_as_one_by_one(stored):
    found = frequencies(stored, LABELS)
    for label, cols in LABELS.items():
        one = frequency(stored, cols, "t", label)
        got = frequency_of(found, cols, "t", label)
        assert got.columns == one.columns
        assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in one.collect())


def test_all_labels_from_one_scan(stored):
    rows = frequency_rows(frequencies(stored, LABELS), LABELS, "t")
    assert scans(rows) == 1
    want = Counter()
    for label, cols in LABELS.items():
        for r in frequency(stored, cols).collect():
            want[(label, tuple(None if r[i] is None else str(r[i]) for i in range(len(cols))))] += r[len(cols)]
    assert Counter({(r.label, tuple(r.value)): r["count"] for r in rows.collect()}) == want
    with pytest.raises(ValueError, match="columns not in table"):
        frequencies(stored, {"1": ["nope"]})


def test_rule_counts_all_labels_at_once(spark, stored):
    staged = []
    from flagstone.plans.runner import RunOptions

    def stage(name, df):
        staged.append(name)
        return df

    res = run_rules({"t": stored}, {"frequency": {"t": LABELS}}, ["frequency"], options=RunOptions(stage=stage))
    for label in LABELS:
        assert res.reports[f"qc_freq_t_{label}"].count() > 0
    assert staged == ["frequency_t"]


def test_observed_counts(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 = 0 AS INT) AS a", "CAST(NULL AS INT) AS b").repartition(6)
    counting, counts = observed_flags(df, ["a", "b"])
    counting.write.format("noop").mode("overwrite").save()
    assert counts.get == {"total": 1000, "s0": 143, "s1": None}
    rows = summary_of_counts(spark, [("r", "t", 1000, 143), ("r", "empty", 0, 0), ("r", "u", 3, 1)]).collect()
    assert [tuple(r) for r in rows] == [("r", "t", 1000, 143, 14.3), ("r", "empty", 0, 0, 0.0), ("r", "u", 3, 1, 33.33)]


def test_summary_of_a_run_reads_no_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "boats.txt").write_text("id|value_n\n1|x\n1|2\n2|\n")
    (tmp_path / "in" / "empty.txt").write_text("id|value_n\n")
    rules = {"missing": {}, "duplication": {"boats": ["id"]}, "string_tables": {}, "frequency": {"boats": {"1": ["id"], "2": ["value_n"]}}}
    vendor = {"rules": rules, "rule_sequence": ["duplication", "string_tables", "missing", "frequency"]}
    res = run_delivery(spark, vendor, str(tmp_path / "in"), str(tmp_path / "out"), database="")
    assert scans(res.summary) == 0
    got = {(r.rule, r.tbl): (r.total, r["count"], r.percent) for r in res.summary.collect()}
    again = run_rules(res.raw, rules, vendor["rule_sequence"]).summary()
    assert got == {(r.rule, r.tbl): (r.total, r["count"], r.percent) for r in again.collect()}
    assert got[("missing", "boats")] == (3, 1, 33.33) and got[("missing", "empty")] == (0, 0, 0.0)
    assert sorted(glob.glob(str(tmp_path / "out" / "qc_freq_*"))) == [str(tmp_path / "out" / f"qc_freq_boats_{i}.csv") for i in (1, 2)]


# --- two date limits, one join ------------------------------------------------------

LAST = {"table": "ends", "dt_column": "END_DAY", "id_column": "unit", "dt_value": "DAY"}
DEATH = {"table": "deaths", "dt_column": "GONE_DAY", "id_column": "unit", "dt_value": "DAY", "ignorecols": ["NEXT_DAY"]}


def date_tables(spark):
    visits = [(1, "2020/01/UK", "2020/02/01"), (1, "2021/01/01", None), (2, "2019/05/05", "2019/05/06"), (3, "2018-01-01", "15-FEB-18"), (None, "2020/01/01", "x")]
    return {
        "visits": spark.createDataFrame(visits, "unit int, FIRST_DAY string, NEXT_DAY string"),
        "ends": spark.createDataFrame([(1, "2020/01/20"), (1, "2020/06/01"), (3, "2018/02/01"), (9, None)], "unit int, END_DAY string"),
        "deaths": spark.createDataFrame([(1, "2020/12/31"), (2, "2019/05/05"), (None, "1999/01/01")], "unit int, GONE_DAY string"),
        "other": spark.createDataFrame([(1,)], "unit int"),
    }


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_two_limits_take_one_join(spark):
    from flagstone.operators.dates import date_bound, DateBoundSpec

    tables, rules = date_tables(spark), {"last_dt": LAST, "death_dt": DEATH}
    res = run_rules(tables, rules, ["last_dt", "death_dt"])
    plan = res.tables["visits"]._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?m)^\W*Join ", plan)) == 1
    # as the rules one after the other
    first, last_reports = date_bound(tables, DateBoundSpec.from_dict(LAST), "last_dt_flag")
    second, death_reports = date_bound(first, DateBoundSpec.from_dict(DEATH), "death_dt_flag")
    for name in tables:
        assert res.tables[name].columns == second[name].columns
        assert rows_of(res.tables[name]) == rows_of(second[name])
    assert [r.last_dt_flag for r in res.tables["visits"].orderBy("unit", "FIRST_DAY").collect()] == [0, 1, 1, 0, 1]
    for fmt, makers in (("qc_lastdt_{}", last_reports), ("qc_deathdt_{}", death_reports)):
        for name, make in makers.items():
            want = rows_of(make(second[name]))
            assert rows_of(res.report(fmt.format(name), res.tables)) == want
            assert rows_of(res.reports[fmt.format(name)].select(*make(second[name]).columns)) == want or fmt.startswith("qc_lastdt")
    assert {(r, t) for r, t, _ in res.flags} == {("last_dt", "visits"), ("last_dt", "deaths"), ("death_dt", "visits"), ("death_dt", "ends")}


def test_limits_by_another_id_stay_apart(spark):
    tables = date_tables(spark)
    tables["deaths"] = tables["deaths"].selectExpr("CAST(unit AS STRING) AS unit", "GONE_DAY")
    res = run_rules(tables, {"last_dt": LAST, "death_dt": DEATH}, ["last_dt", "death_dt"])
    plan = res.tables["visits"]._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?m)^\W*Join ", plan)) == 2
    assert [r.death_dt_flag for r in res.tables["visits"].orderBy("unit", "FIRST_DAY").collect()] == [0, 0, 1, 0, 0]
