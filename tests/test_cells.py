"""Reports on single cells: one scan of a table answers all of them, as the single reports do."""

from flagstone.operators import offending_values, missing_by_column
from flagstone.operators.cells import CellTest, cell_counts, counted_report
from flagstone.operators.dates import DateBoundSpec, unparsed_dates
from flagstone.plans.runner import RunOptions, run_rules

RULES = {
    "last_dt": {"table": "leases", "dt_column": "END_DAY", "id_column": "unit", "dt_value": "DAY"},
    "death_dt": {"table": "leases", "dt_column": "END_DAY", "id_column": "unit", "dt_value": "SPAN", "dt_type": "float"},
    "string_tables": {"value": "value"},
    "missing": {},
}
SEQUENCE = ["last_dt", "string_tables", "missing", "death_dt"]


def tables(spark):
    visits = [(1, "2020-01-05", "x", "3", None), (1, "soon", "2.5", "-3", 1.0), (2, None, "", "x", float("nan")), (2, "soon", " ", None, -1.0), (None, "", "4", "x", 2.0)]
    return {
        "visits": spark.createDataFrame(visits, "unit int, IN_DAY string, SPAN_A string, `value a'b` string, value_d double"),
        "leases": spark.createDataFrame([(1, "2020-02-01"), (2, "later")], "unit int, END_DAY string"),
        "empty": spark.createDataFrame([], "unit int, OUT_DAY string, value string"),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_reports_from_one_scan_equal_the_single_ones(spark, tmp_path):
    stored = {}
    for n, df in tables(spark).items():
        df.write.parquet(str(tmp_path / n))
        stored[n] = spark.read.parquet(str(tmp_path / n))
    staged = {}

    def stage(name, df):
        staged[name] = df
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    fused = run_rules(stored, RULES, SEQUENCE, options=RunOptions(stage=stage))
    plain = run_rules(stored, RULES, SEQUENCE)
    for name in ("qc_missing", "qc_value", "qc_unparsed_last_dt", "qc_unparsed_death_dt"):
        assert fused.report(name).columns == plain.report(name).columns
        assert rows(fused.report(name)) == rows(plain.report(name)), name
    # four reports, one scan a table
    assert {n: scans(df) for n, df in staged.items() if n.startswith("cells_")} == {"cells_visits": 1, "cells_leases": 1, "cells_empty": 1}
    want = missing_by_column(stored["empty"], "empty")
    assert rows(fused.report("qc_missing").where("tbl = 'empty'")) == rows(want) and want.count() == 3


def test_cells_by_hand(spark):
    df = tables(spark)["visits"]
    spec = DateBoundSpec("leases", "END_DAY", "unit", "DAY")
    assert rows(unparsed_dates(df, spec, "visits")) == [("visits", "IN_DAY", "soon")]
    assert ("visits", "value a'b", "x") in rows(offending_values(df, "visits"))
    tests = [CellTest("none", "unit", "unit IS NULL", listed=False), CellTest("days", "IN_DAY", dt_type="datetime"), CellTest("days", "SPAN_A", "SPAN_A = ''")]
    counts = cell_counts(df, tests)
    assert rows(counts) == sorted([("none", "unit", None, 1), ("days", "IN_DAY", "soon", 2), ("days", "SPAN_A", "", 1)], key=repr)
    assert rows(counted_report(counts, "none", "visits", ["unit", "IN_DAY"])) == [("IN_DAY", 0, "visits"), ("unit", 1, "visits")]


def test_a_custom_rule_replaces_the_report(spark):
    from flagstone.plans.runner import RuleOutput, rule_registry

    def own(dfs, cfg, opts):
        return RuleOutput(dict(dfs), {"qc_missing": lambda: spark.range(7)})

    res = run_rules(tables(spark), RULES, ["missing"], registry=rule_registry({"missing": own}), options=RunOptions(stage=lambda n, df: df))
    assert res.report("qc_missing").count() == 7


def test_rows_added_for_unmatched_anchors_keep_the_single_reports(spark):
    res = run_rules(tables(spark), RULES, SEQUENCE, options=RunOptions(keep_unmatched_anchor=True, stage=lambda n, df: df))
    assert len(res.cells) == 0
    assert res.report("qc_missing").where("missing > 0").count() > 0
