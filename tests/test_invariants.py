"""Invariants on the driver's tables (sf0.001) and the registered checks."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from flagstone.operators import flag_duplicates, flag_missing, flag_non_numeric, report_from_flags, unique_key
from flagstone.plans import suite

SF001 = "/root/testdata/sf0.001"

KEYS = suite.LINE_KEYS


def test_flag_rules_keep_row_count(spark):
    li = suite.lineitem_d(spark, SF001)
    n = li.count()
    assert flag_duplicates(li, KEYS).count() == n
    assert flag_missing(li).count() == n
    ev = suite.events_d(spark, SF001)
    assert flag_non_numeric(ev, "value").count() == ev.count()
    assert suite.q_last_dt_flags(spark, SF001).count() == suite.load(spark, SF001, "lineitem").count()


def test_dup_report_matches_flags(spark):
    flagged = flag_duplicates(suite.lineitem_d(spark, SF001), KEYS)
    total = flagged.agg(F.sum("dup_flag")).collect()[0][0]
    assert report_from_flags(flagged, KEYS).count() == total


def test_unique_key_is_not_dup_flag(spark):
    li = suite.lineitem_d(spark, SF001)
    a = flag_duplicates(li, KEYS).select(*li.columns, (F.col("dup_flag") == 0).alias("result"))
    b = unique_key(li, KEYS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rules_are_idempotent(spark):
    ev = suite.events_d(spark, SF001)
    once = flag_missing(flag_non_numeric(ev, "value"))
    twice = flag_missing(flag_non_numeric(once, "value"))
    assert once.columns == twice.columns
    assert once.exceptAll(twice).count() == 0


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"last_dt_flag", "dup_count", "dup_flag", "missing_flag"} <= set(df.columns)
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck(sf):
    con = duckdb.connect()
    for t in suite.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(rows, cols):
    import math

    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(suite.oracle_sql()))
def test_check_matches_oracle_sf0001(spark, name):
    df = E.queries()[name](spark, SF001)
    res = _duck(SF001).execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)


def test_long_text_matches_direct_path(spark):
    docs = suite.load(spark, SF001, "documents")
    a = flag_duplicates(docs, ["text"], long_text=True)
    b = flag_duplicates(docs, ["text"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    li = suite.lineitem_t(spark, SF001)
    a = unique_key(li, KEYS, long_text=True)
    b = unique_key(li, KEYS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_join_for_text_keys(spark):
    def joins(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin")

    assert joins(suite.q_dup_text_keys(spark, SF001)) == 1
    assert joins(suite.q_dup_exact_documents(spark, SF001)) == 1
