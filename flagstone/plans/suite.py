"""Registered checks over the driver's tables, each with its DuckDB oracle.

The driver's tables are clean (no nulls, blanks or non-numbers), so a few
deterministic *dirty views* put values the rules must catch into whole
tables. Dirt is injected by a rule on the row key (``% n``); no row is ever
filtered out, so every check runs over every row. The same views are written
once for Spark (the view functions below) and once as SQL (``VIEWS_SQL``).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import DUP_FLAG, LAST_DT_FLAG, with_row_id
from ..operators.dates import DateBoundSpec, date_bound, death_date, last_date, unparsed_dates
from ..operators.duplicates import (
    duplicate_groups,
    duplicate_report,
    flag_duplicates,
    flag_duplicates_first_key,
    unique_key,
)
from ..operators.frequency import frequencies, frequency, frequency_rows
from ..operators.membership import mappable_id, unmapped_rows
from ..operators.missing import flag_missing, flag_missing_null_only, missing_by_column
from ..operators.numeric import flag_negative, flag_non_numeric, flag_non_numeric_spark, negative_rows, offending_values
from ..operators.rule import MappableIdRule, UniqueKeyRule
from ..operators.summary import flag_summary, union_all
from ..session import scratch_path
from ..sinks.writers import ensure_database, replace_table, write_delimited
from ..sources.delivery import read_delimited, read_delivery
from .delivery import run_delivery, upload_file
from .runner import RunOptions, rule_registry, run_rules, vendor_registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------------------
# Dirty views (Spark side)
# ---------------------------------------------------------------------------


def customer_d(spark, d):
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(k % 19 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("  "))
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )


def lineitem_d(spark, d):
    li = load(spark, d, "lineitem")
    return li.withColumn(
        "l_linenumber", F.when(F.col("l_partkey") % 13 == 0, F.lit(None).cast("int")).otherwise(F.col("l_linenumber"))
    )


def events_d(spark, d):
    e = load(spark, d, "events")
    m = F.col("event_id") % 10
    txt = (
        F.when(m == 0, F.lit("N/A"))
        .when(m == 1, F.lit("-1"))
        .when(m == 2, F.lit(""))
        .when(m == 3, F.lit(None).cast("string"))
        .otherwise(F.col("event_id").cast("string"))
    )
    return e.withColumn("value_txt", txt)


def orders_a(spark, d):
    """Orders keyed like line items: the order date is the last valid date."""
    return load(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")


def labs_d(spark, d):
    li = load(spark, d, "lineitem")
    txt = F.when(F.col("l_linenumber") == 1, F.concat(F.date_format("l_shipdate", "yyyy/MM/"), F.lit("UK"))).otherwise(
        F.date_format("l_shipdate", "yyyy/MM/dd")
    )
    return li.select("l_orderkey", "l_linenumber", txt.alias("ship_date_txt"))


def _day_time(ts):
    return F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date")) + F.hour(ts) / 24.0


def events_rel(spark, d):
    e = load(spark, d, "events")
    day = F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(_day_time(F.col("ts")))
    return e.withColumn("day_time", day.cast("double"))


def signup_rel(spark, d):
    """Every event as an anchor row; only sign-ups hold a limit."""
    limit = F.when(F.col("event_type") == "signup", F.col("day_time")).otherwise(F.lit(float("nan")))
    return events_rel(spark, d).select("user_id", limit.alias("signup_time"))


def cust_limit(spark, d):
    o = load(spark, d, "orders")
    return o.groupBy("o_custkey").agg((F.max("o_orderdate") - F.expr("INTERVAL 365 DAYS")).alias("death_date"))


def cust_anchor(spark, d):
    c = load(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").alias("cutoff_ts")
    )


def orders_s(spark, d):
    """Orders with every fifth key moved out of reach."""
    k = F.col("o_orderkey")
    return load(spark, d, "orders").withColumn("o_orderkey", F.when(k % 5 == 0, k + 1_000_000_000).otherwise(k))


def lineitem_t(spark, d):
    """Line items whose order key is text, zero-padded for every third."""
    li, text = load(spark, d, "lineitem"), F.col("l_orderkey").cast("string")
    return li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("0"), text)).otherwise(text))


def labs_x(spark, d):
    """Ship dates in many layouts; every tenth order has none that reads as a date."""
    li, t, m = load(spark, d, "lineitem"), F.col("l_shipdate"), F.col("l_orderkey") % 10
    layouts = [
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy/M/d", "yyyyMMdd", "MM/dd/yyyy",
        "dd-MMM-yyyy", "MMM d, yyyy", "yyyy-MM-dd",
    ]
    text = F.when(F.col("l_linenumber") == 1, F.lit("unknown")).otherwise(F.date_format(t, "yyyy-13-dd"))
    for i, layout in enumerate(layouts):
        text = F.when(m == i, F.date_format(t, layout)).otherwise(text)
    return li.select("l_orderkey", "l_linenumber", text.alias("ship_date_txt"), F.date_format(t, "yyyyMMdd").cast("int").alias("ship_date_int"))


def labs_y(spark, d):
    """Ship dates as clinical files write them: two-digit years, halves of the
    day, week days, months alone; every tenth order has text that is no date."""
    li, t, m = load(spark, d, "lineitem"), F.col("l_shipdate"), F.col("l_orderkey") % 10
    layouts = [
        "dd-MMM-yy", "MM/dd/yy", "MM/dd/yyyy hh:mm a", "yyyyMMdd'T'HHmmss", "MMM yyyy", "E MMM d yyyy", "yyyy-MM-dd hh:mm:ss a",
        "yyyy-MMM-dd", "d/M/yy H:mm",
    ]
    later = F.expr("l_shipdate + make_dt_interval(0, l_linenumber * 5, 7)")
    text = F.when(F.col("l_linenumber") == 1, F.lit("not done")).otherwise(F.date_format(t, "yy/MM"))
    for i, layout in enumerate(layouts):
        text = F.when(m == i, F.date_format(F.when(m == 8, F.expr("date_trunc('MONTH', l_shipdate) + INTERVAL 14 DAYS")).otherwise(later), layout)).otherwise(text)
    number = F.date_format(F.expr("l_shipdate - INTERVAL 400 DAYS"), "yyyyMMdd").cast("double")
    return li.select("l_orderkey", "l_linenumber", text.alias("ship_date_txt"), number.alias("ship_date_num"))


def events_r(spark, d):
    """Events with data columns that have names the rules use themselves."""
    e = load(spark, d, "events")
    kind = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return e.select("event_id", "user_id", kind.alias("result"), F.col("value").alias("dup_count"))


def labels_n(spark, d):
    x = load(spark, d, "labels")
    return x.withColumn("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("long")).otherwise(F.col("doc_id")))


VIEWS_SQL = {
    "customer_d": """SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_custkey % 19 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '  ' ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
    "lineitem_d": """SELECT l_orderkey, l_partkey, l_suppkey,
        CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM lineitem""",
    "events_d": """SELECT *, CASE event_id % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN '-1' WHEN 2 THEN ''
        WHEN 3 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS value_txt FROM events""",
    "orders_a": """SELECT o_orderkey AS l_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority FROM orders""",
    "labs_d": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 1 THEN strftime(l_shipdate, '%Y/%m/') || 'UK'
        ELSE strftime(l_shipdate, '%Y/%m/%d') END AS ship_date_txt FROM lineitem""",
    "events_rel": """SELECT *, CAST(CASE WHEN event_id % 17 = 0 THEN CAST('NaN' AS DOUBLE)
        ELSE date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + hour(ts) / 24.0 END AS DOUBLE) AS day_time
        FROM events""",
    "signup_rel": """SELECT user_id, CASE WHEN event_type = 'signup' THEN day_time ELSE CAST('NaN' AS DOUBLE) END
        AS signup_time FROM events_rel""",
    "cust_limit": """SELECT o_custkey, max(o_orderdate) - INTERVAL 365 DAY AS death_date FROM orders GROUP BY o_custkey""",
    "cust_anchor": """SELECT c_custkey AS user_id, TIMESTAMP '2024-01-15 00:00:00' AS cutoff_ts FROM customer""",
    "orders_s": """SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey)
        FROM orders""",
    "lineitem_t": """SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN '0' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END
        AS l_orderkey) FROM lineitem""",
    "labs_x": """SELECT l_orderkey, l_linenumber, l_shipdate, CASE l_orderkey % 10
        WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
        WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '.000' WHEN 3 THEN strftime(l_shipdate, '%Y/%-m/%-d')
        WHEN 4 THEN strftime(l_shipdate, '%Y%m%d') WHEN 5 THEN strftime(l_shipdate, '%m/%d/%Y')
        WHEN 6 THEN strftime(l_shipdate, '%d-%b-%Y') WHEN 7 THEN strftime(l_shipdate, '%b %-d, %Y')
        WHEN 8 THEN strftime(l_shipdate, '%Y-%m-%d')
        ELSE CASE WHEN l_linenumber = 1 THEN 'unknown' ELSE strftime(l_shipdate, '%Y-13-%d') END END AS ship_date_txt,
        CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_int FROM lineitem""",
    "labs_y": """SELECT l_orderkey, l_linenumber, l_shipdate, CASE l_orderkey % 10
        WHEN 0 THEN date_trunc('day', later) WHEN 1 THEN date_trunc('day', later) WHEN 2 THEN date_trunc('minute', later)
        WHEN 3 THEN later WHEN 4 THEN date_trunc('month', later) WHEN 5 THEN date_trunc('day', later) WHEN 6 THEN later
        WHEN 7 THEN date_trunc('day', later) WHEN 8 THEN middle END AS parsed,
        CASE l_orderkey % 10 WHEN 0 THEN strftime(later, '%d-%b-%y') WHEN 1 THEN strftime(later, '%m/%d/%y')
        WHEN 2 THEN strftime(later, '%m/%d/%Y %I:%M %p') WHEN 3 THEN strftime(later, '%Y%m%dT%H%M%S') WHEN 4 THEN strftime(later, '%b %Y')
        WHEN 5 THEN strftime(later, '%a %b %-d %Y') WHEN 6 THEN strftime(later, '%Y-%m-%d %I:%M:%S %p')
        WHEN 7 THEN strftime(later, '%Y-%b-%d') WHEN 8 THEN strftime(middle, '%-d/%-m/%y %-H:%M')
        ELSE CASE WHEN l_linenumber = 1 THEN 'not done' ELSE strftime(l_shipdate, '%y/%m') END END AS ship_date_txt,
        date_trunc('day', l_shipdate - INTERVAL 400 DAY) AS earlier,
        CAST(strftime(l_shipdate - INTERVAL 400 DAY, '%Y%m%d') AS DOUBLE) AS ship_date_num
        FROM (SELECT *, l_shipdate + to_hours(5 * l_linenumber) + INTERVAL 7 MINUTE AS later,
              date_trunc('month', l_shipdate) + INTERVAL 14 DAY AS middle FROM lineitem)""",
    "events_r": """SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS result,
        value AS dup_count FROM events""",
    "labels_n": """SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id END AS doc_id) FROM labels""",
}


def _with(*names: str) -> str:
    """``WITH`` clause defining the given dirty views (dependencies first)."""
    order = list(VIEWS_SQL)
    need = set(names)
    if "signup_rel" in need:
        need.add("events_rel")
    parts = [f"{n} AS ({VIEWS_SQL[n]})" for n in order if n in need]
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------------------
# SQL building blocks for the oracle
# ---------------------------------------------------------------------------

NONNEG = r"'^(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)$'"
BLANK = r"'^\s*$'"


def _dup_groups_sql(table: str, keys: list[str], n: str = "n") -> str:
    ks = ", ".join(keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"SELECT {ks}, COUNT(*) AS {n} FROM {table} WHERE {nn} GROUP BY {ks} HAVING COUNT(*) >= 2"


def _dup_flags_sql(table: str, keys: list[str]) -> str:
    on = " AND ".join(f"t.{k} = g.{k}" for k in keys)
    return f"""SELECT t.*, CAST(COALESCE(g.n, 0) AS BIGINT) AS dup_count,
        CAST(CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS dup_flag
        FROM {table} t LEFT JOIN ({_dup_groups_sql(table, keys)}) g ON {on}"""


def _summary_sql(rule: str, tbl: str, src: str, flag_col: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{tbl}' AS tbl, CAST(COUNT(*) AS BIGINT) AS total,
        CAST(COALESCE(SUM({flag_col}), 0) AS BIGINT) AS count,
        CAST(CASE WHEN COUNT(*) = 0 THEN 0.0 ELSE ROUND(COALESCE(SUM({flag_col}), 0) * 100.0 / COUNT(*), 2) END AS DOUBLE)
        AS percent FROM ({src}) s"""


def _missing_str(c: str) -> str:
    return f"({c} IS NULL OR regexp_matches({c}, {BLANK}))"


def _missing_dbl(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))"


def _bad_text(c: str) -> str:
    return f"NOT COALESCE(regexp_matches({c}, {NONNEG}), FALSE)"


def _bad_double(c: str) -> str:
    return f"NOT COALESCE({c} >= 0 AND NOT isnan({c}) AND {c} <> CAST('inf' AS DOUBLE), FALSE)"


def _value_bad_sql() -> str:
    return f"({_bad_double('value')}) OR ({_bad_text('value_txt')})"


def _flag(cond: str, name: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER) AS {name}"


LINEITEM_COLS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


# ---------------------------------------------------------------------------
# Rule configuration used by the sequence checks (the whole engine at once)
# ---------------------------------------------------------------------------

SEQUENCE = ["last_dt", "duplication", "string_tables", "missing"]


def sequence_rules() -> dict:
    return {
        "last_dt": {
            "table": "orders_a",
            "dt_column": "o_orderdate",
            "id_column": "l_orderkey",
            "dt_value": "date",
            "dt_type": "datetime",
            "ignore_value": None,
            "ignorecols": [],
        },
        "duplication": {"lineitem_d": LINE_KEYS},
        "string_tables": {"value": "value", "tables": ["events_d"]},
        "missing": {"lineitem_d": ["l_linenumber", "l_shipdate"]},
    }


def sequence_tables(spark, d) -> dict[str, DataFrame]:
    return {"lineitem_d": lineitem_d(spark, d), "orders_a": orders_a(spark, d), "events_d": events_d(spark, d)}


def run_sequence(spark, d):
    return run_rules(sequence_tables(spark, d), sequence_rules(), SEQUENCE)


# ---------------------------------------------------------------------------
# The checks
# ---------------------------------------------------------------------------

LAST_SPEC = DateBoundSpec("orders_a", "o_orderdate", "l_orderkey", "date")


def q_dup_flags(spark, d):
    return flag_duplicates(load(spark, d, "lineitem"), LINE_KEYS)


def q_dup_null_keys(spark, d):
    return flag_duplicates(lineitem_d(spark, d), LINE_KEYS)


def q_dup_first_key_variant(spark, d):
    return flag_duplicates_first_key(lineitem_d(spark, d), ["l_linenumber", "l_orderkey"])


def q_dup_report(spark, d):
    return duplicate_report(load(spark, d, "lineitem"), LINE_KEYS)


def q_dup_groups(spark, d):
    return duplicate_groups(load(spark, d, "lineitem"), LINE_KEYS)


def q_dup_exact_documents(spark, d):
    return flag_duplicates(load(spark, d, "documents"), ["text"], long_text=True)


def q_dup_text_keys(spark, d):
    return flag_duplicates(lineitem_t(spark, d), LINE_KEYS)


def q_dup_summary(spark, d):
    return flag_summary(flag_duplicates(load(spark, d, "lineitem"), LINE_KEYS), "duplication", "lineitem", DUP_FLAG)


def q_missing_flags(spark, d):
    return flag_missing(customer_d(spark, d), ["c_mktsegment", "c_acctbal"])


def q_missing_all_columns(spark, d):
    return flag_missing(customer_d(spark, d))


def q_missing_by_column(spark, d):
    return union_all(
        [
            missing_by_column(customer_d(spark, d), "customer_d"),
            missing_by_column(lineitem_d(spark, d), "lineitem_d", ["l_linenumber", "l_shipdate"]),
        ]
    )


def q_missing_null_only(spark, d):
    return flag_missing_null_only(customer_d(spark, d))


def q_nonnumeric_flags(spark, d):
    return flag_non_numeric(events_d(spark, d), "value")


def q_nonnumeric_flags_spark(spark, d):
    return flag_non_numeric_spark(events_d(spark, d), "value")


def q_nonnumeric_values(spark, d):
    return union_all(
        [
            offending_values(events_d(spark, d), "events_d", "value"),
            offending_values(customer_d(spark, d), "customer_d", "acctbal"),
        ]
    )


def q_negative_rows(spark, d):
    return negative_rows(customer_d(spark, d), "acctbal")


def q_negative_flags(spark, d):
    return flag_negative(events_d(spark, d), "value")


def _last_dt(spark, d):
    return last_date({"lineitem": load(spark, d, "lineitem"), "orders_a": orders_a(spark, d)}, LAST_SPEC)


def q_last_dt_flags(spark, d):
    return _last_dt(spark, d)[0]["lineitem"]


def q_last_dt_report(spark, d):
    return _last_dt(spark, d)[1]["lineitem"]()


def q_last_dt_partial_dates(spark, d):
    tables, _ = last_date({"labs_d": labs_d(spark, d), "orders_a": orders_a(spark, d)}, LAST_SPEC)
    return tables["labs_d"]


def q_last_dt_float(spark, d):
    spec = DateBoundSpec("signup_rel", "signup_time", "user_id", "time", dt_type="float")
    tables, _ = last_date({"events_rel": events_rel(spark, d), "signup_rel": signup_rel(spark, d)}, spec)
    return tables["events_rel"]


def q_death_dt_flags(spark, d):
    spec = DateBoundSpec("cust_limit", "death_date", "o_custkey", "date")
    tables, _ = death_date({"orders": load(spark, d, "orders"), "cust_limit": cust_limit(spark, d)}, spec)
    return tables["orders"]


def q_death_dt_report(spark, d):
    spec = DateBoundSpec("cust_limit", "death_date", "o_custkey", "date")
    flagged, reports = death_date({"orders": load(spark, d, "orders"), "cust_limit": cust_limit(spark, d)}, spec)
    return reports["orders"](flagged["orders"])


def q_last_dt_layouts(spark, d):
    tables, _ = last_date({"labs_x": labs_x(spark, d).drop("ship_date_int"), "orders_a": orders_a(spark, d)}, LAST_SPEC)
    return tables["labs_x"]


def q_last_dt_integer_dates(spark, d):
    spec = DateBoundSpec("orders_a", "o_orderdate", "l_orderkey", "date", ignore_value="txt")
    tables, _ = last_date({"labs_x": labs_x(spark, d), "orders_a": orders_a(spark, d)}, spec)
    return tables["labs_x"].select("l_orderkey", "l_linenumber", "ship_date_int", "last_dt_flag")


def q_last_dt_ignored_columns(spark, d):
    spec = DateBoundSpec("orders_a", "o_orderdate", "l_orderkey", "date", ignore_value="commit", ignorecols=("receiptdate",))
    li = load(spark, d, "lineitem")
    late = F.expr("l_shipdate + INTERVAL 9000 DAYS")
    rows = li.select("l_orderkey", "l_linenumber", F.expr("l_shipdate - INTERVAL 80 DAYS AS ship_date"), late.alias("commit_date"), late.alias("receiptdate"))
    return last_date({"rows": rows, "orders_a": orders_a(spark, d)}, spec)[0]["rows"]


def q_last_dt_short_years(spark, d):
    tables, _ = last_date({"labs_y": labs_y(spark, d), "orders_a": orders_a(spark, d)}, LAST_SPEC)
    return tables["labs_y"]


def q_last_dt_unparsed(spark, d):
    return unparsed_dates(labs_x(spark, d), LAST_SPEC, "labs_x")


def q_date_outer_anchor(spark, d):
    spec = DateBoundSpec("cust_anchor", "cutoff_ts", "user_id", "ts")
    tables, _ = date_bound(
        {"events": load(spark, d, "events"), "cust_anchor": cust_anchor(spark, d)},
        spec,
        LAST_DT_FLAG,
        keep_unmatched_anchor=True,
    )
    return tables["events"]


def q_unique_key_result(spark, d):
    return unique_key(lineitem_d(spark, d), LINE_KEYS)


def q_mappable_id_result(spark, d):
    return mappable_id(load(spark, d, "lineitem"), orders_s(spark, d), "l_orderkey", "o_orderkey")


def q_mappable_id_violations(spark, d):
    return unmapped_rows(load(spark, d, "lineitem"), orders_s(spark, d), "l_orderkey", "o_orderkey")


def q_labels_reference_documents(spark, d):
    return mappable_id(load(spark, d, "labels"), load(spark, d, "documents"), "doc_id")


def q_conversation_turns_unique(spark, d):
    return unique_key(load(spark, d, "conversations"), ["conv_id", "turn"])


def q_mappable_id_mixed_types(spark, d):
    return mappable_id(lineitem_t(spark, d), orders_s(spark, d), "l_orderkey", "o_orderkey")


def q_mappable_id_nulls_apart(spark, d):
    return mappable_id(labels_n(spark, d), labels_n(spark, d), "doc_id", null_safe=False)


def q_mappable_id_composite(spark, d):
    few = lineitem_d(spark, d).select("l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"))
    return mappable_id(lineitem_d(spark, d), few, LINE_KEYS)


def q_mapping_events_null_id(spark, d):
    rule = MappableIdRule({"subset": labels_n(spark, d), "superset": load(spark, d, "documents")}, "doc_id")
    return rule.result_to_events("qc_engine", "002")


def q_missing_result_column(spark, d):
    return flag_missing(events_r(spark, d))


def q_dup_reserved_names(spark, d):
    return flag_duplicates(events_r(spark, d), ["result", "user_id"])


def q_nonnumeric_null_ok(spark, d):
    return flag_non_numeric(events_d(spark, d), "value", null_is_bad=False)


def q_negative_in_sequence(spark, d):
    rules = {"negative": {"value": "value", "tables": ["events_d"]}, "string_tables": ["events_d"]}
    return run_rules({"events_d": events_d(spark, d)}, rules, ["negative", "string_tables"]).tables["events_d"]


def q_rule_sequence_flags(spark, d):
    return run_sequence(spark, d).tables["lineitem_d"]


def q_rule_sequence_events(spark, d):
    return run_sequence(spark, d).tables["events_d"]


def q_rule_summary(spark, d):
    return run_sequence(spark, d).summary()


def q_rule_events(spark, d):
    return UniqueKeyRule(lineitem_d(spark, d), LINE_KEYS).result_to_events("qc_engine", "001")


def q_delivery_roundtrip_dups(spark, d):
    """Write lineitem as a pipe-delimited Latin-1 delivery file, read the
    delivery back (explicit schema, no inference pass), flag duplicates."""
    li = load(spark, d, "lineitem")
    folder = scratch_path(spark, "delivery")
    write_delimited(li, folder + "/lineitem.txt", sep="|", encoding="ISO-8859-1")
    tables = read_delivery(spark, folder, schemas={"lineitem": li.schema})
    return flag_duplicates(tables["lineitem"], LINE_KEYS)


def q_delivery_text_roundtrip(spark, d):
    """Texts with line breaks, quotes, blanks and padding, written and read back;
    the texts that changed, none."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    events = events_d(spark, d).selectExpr("event_id AS doc_id", "concat('  ', value_txt, ' \"q\" ') AS text")
    rows = docs.union(events.where("text IS NOT NULL"))
    folder = scratch_path(spark, "texts")
    write_delimited(rows, folder + "/texts.txt", sep="|", encoding="UTF-8")
    back = read_delivery(spark, folder, encoding="UTF-8", schemas={"texts": rows.schema}, multi_line=True)["texts"]
    return back.groupBy(F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


def lines_wide(spark, d):
    """Line items under keys of 18, 19 and 25 digits and keys padded with zeros."""
    li, k = load(spark, d, "lineitem"), "CAST(l_orderkey AS STRING)"
    return li.selectExpr(
        f"concat('123456', lpad({k}, 12, '0')) AS key18",
        f"concat('1234567', lpad({k}, 12, '0')) AS key19",
        f"concat('9234567', lpad({k}, 12, '0')) AS key_over",
        f"concat('1234567890123', lpad({k}, 12, '0')) AS key25",
        f"lpad({k}, 12, '0') AS padded",
        "concat(CAST(l_linenumber AS STRING), '.123456789012345678') AS fine",
        "concat(CAST(l_linenumber AS STRING), '.25') AS plain",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS ship_day",
        "CASE WHEN l_orderkey % 1000 = 0 THEN 'abc' ELSE CAST(l_linenumber AS STRING) END AS value_mixed",
        "CAST(l_linenumber AS STRING) AS l_linenumber",
    )


def q_delivery_wide_ids(spark, d):
    """Keys too long for a double, read from a delivery without a schema: types
    found, every cell as written, duplicates by the longest key."""
    folder = scratch_path(spark, "wide")
    write_delimited(lines_wide(spark, d), folder + "/lines.txt", sep="|", encoding="ISO-8859-1")
    lines = read_delivery(spark, folder)["lines"]
    found = flag_duplicates(lines, ["key25", "l_linenumber"])
    types = ", ".join(f"typeof({c})" for c in lines.columns)
    return found.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in lines.columns], f"concat_ws(' ', {types}) AS types", "dup_count", "dup_flag")


def q_table_append(spark, d):
    """Line item counts of a delimited output written, then appended to."""
    path = scratch_path(spark, "append")
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    write_delimited(rows, path)
    write_delimited(rows, path, mode="append")
    return spark.read.option("header", True).csv(path).groupBy("l_returnflag").count().withColumnRenamed("count", "n")


def q_table_upload(spark, d):
    """Events as one comma-separated file, uploaded into a catalog table."""
    folder = scratch_path(spark, "upload")
    write_delimited(events_d(spark, d).select("event_id", "user_id", "event_type"), folder)
    ensure_database(spark, "flagstone_up", scratch_path(spark, "warehouse-up"))
    stored = upload_file(spark, folder, "flagstone_up", "events of the day")
    return stored.selectExpr("CAST(event_id AS BIGINT) AS event_id", "CAST(user_id AS BIGINT) AS user_id", "event_type")


def q_rule_sequence_spark_flavour(spark, d):
    """The older rule set, chosen by the vendor configuration."""
    rules = {"duplication": {"lineitem_d": LINE_KEYS}, "missing": {"lineitem_d": ["l_linenumber"]}, "string_tables": ["lineitem_d"]}
    tables = {"lineitem_d": lineitem_d(spark, d).withColumnRenamed("l_quantity", "value_quantity")}
    res = run_rules(tables, rules, list(rules), registry=vendor_registry({"flavour": "spark"}))
    return res.tables["lineitem_d"].select("l_orderkey", "l_linenumber", "value_quantity", "flag_duplication", "flag_missing", "flag_values")


def q_last_dt_strict(spark, d):
    """Text dates that all read as dates, under the strict option."""
    tables = {"labs_d": labs_d(spark, d), "orders_a": orders_a(spark, d)}
    return last_date(tables, LAST_SPEC, on_bad="fail")[0]["labs_d"]


def q_row_ids(spark, d):
    ids = with_row_id(load(spark, d, "lineitem").select("l_orderkey"))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("columnindex").alias("n_ids"))


def _delivery_run(spark, d, stopped: bool = False):
    """Line items, orders and events as pipe files, checked as a delivery (text
    compressed); with ``stopped`` a first run ends at its last rule, and a second one goes on."""
    base = scratch_path(spark, "run")
    tables = {"lines": lineitem_d(spark, d), "orders": orders_a(spark, d), "events": events_d(spark, d)}
    for name, df in tables.items():
        write_delimited(df, f"{base}/in/{name}.txt", sep="|", encoding="ISO-8859-1", compression="gzip")
    vendor = {
        "compression": "gzip",
        "rules": {
            **sequence_rules(),
            "last_dt": {**sequence_rules()["last_dt"], "table": "orders"},
            "death_dt": {**sequence_rules()["last_dt"], "table": "orders"},
            "duplication": {"lines": LINE_KEYS},
            "string_tables": {"value": "value", "tables": ["events"]},
            "missing": {"lines": ["l_linenumber", "l_shipdate"]},
        },
        "rule_sequence": ["last_dt", "death_dt", "duplication", "string_tables", "missing"],
    }
    schemas = {name: df.schema for name, df in tables.items()}
    if stopped:

        def stop(dfs, cfg, opts):
            raise RuntimeError("stopped")

        try:
            run_delivery(spark, vendor, base + "/in", base + "/out", database="", schemas=schemas, registry=rule_registry({"missing": stop}))
        except RuntimeError:
            pass
    return run_delivery(spark, vendor, base + "/in", base + "/out", database="", schemas=schemas, resume=stopped)


def q_delivery_run_flags(spark, d):
    return _delivery_run(spark, d).flagged["lines"]


def q_delivery_run_resumed(spark, d):
    return _delivery_run(spark, d, stopped=True).flagged["lines"]


def q_delivery_run_summary(spark, d):
    return _delivery_run(spark, d).summary


def q_delivery_run_reports(spark, d):
    """The written report files of one run: offending values, missing counts and
    rows after the limit date."""
    out = _delivery_run(spark, d).outputs
    read = lambda name: read_delimited(spark, out[name], sep=",", infer_schema=False)
    return union_all(
        [
            read("qc_value").selectExpr("'qc_value' AS report", "tbl", "column", "value"),
            read("qc_missing").selectExpr("'qc_missing' AS report", "tbl", "column", "missing AS value"),
            read("qc_deathdt_lines").groupBy().agg(F.count(F.lit(1)).cast("string").alias("value")).selectExpr(
                "'qc_deathdt' AS report", "'lines' AS tbl", "'rows' AS column", "value"
            ),
        ]
    )


def q_cell_reports(spark, d):
    """Missing counts, offending values and unparsed dates of a rule sequence, each
    table scanned once for all of them."""

    def stage(name, df):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    tables = {
        "labs_x": labs_x(spark, d),
        "orders_a": orders_a(spark, d).select("l_orderkey", "o_orderdate"),
        "events_d": events_d(spark, d),
        "customer_d": customer_d(spark, d),
    }
    rules = {
        "last_dt": {"table": "orders_a", "dt_column": "o_orderdate", "id_column": "l_orderkey", "dt_value": "date"},
        "string_tables": {"value": "value", "tables": ["events_d"]},
        "missing": {
            "labs_x": ["ship_date_txt"],
            "orders_a": ["l_orderkey"],
            "events_d": ["value", "value_txt"],
            "customer_d": ["c_mktsegment", "c_acctbal"],
        },
    }
    res = run_rules(tables, rules, ["last_dt", "string_tables", "missing"], options=RunOptions(stage=stage))
    value, missing, unparsed = (res.report(n) for n in ("qc_value", "qc_missing", "qc_unparsed_last_dt"))
    return union_all(
        [
            value.selectExpr("'qc_value' AS report", "tbl", "column", "value"),
            unparsed.selectExpr("'qc_unparsed_last_dt' AS report", "tbl", "column", "value"),
            missing.selectExpr("'qc_missing' AS report", "tbl", "column", "CAST(missing AS STRING) AS value"),
        ]
    )


def q_table_replace(spark, d):
    """Flagged customers saved as ``<db>.customer_d_QC`` and read back."""
    db = "flagstone_qc"
    ensure_database(spark, db, scratch_path(spark, "warehouse"))
    name = replace_table(flag_missing(customer_d(spark, d), ["c_mktsegment", "c_acctbal"]), db, "customer_d", "_QC")
    return spark.table(name)


def q_table_swap(spark, d):
    """Customers stored, then replaced by a flagged copy that reads the stored table itself."""
    db = "flagstone_swap"
    ensure_database(spark, db, scratch_path(spark, "warehouse-swap"))
    name = replace_table(customer_d(spark, d), db, "customers")
    return spark.table(replace_table(flag_missing(spark.table(name), ["c_mktsegment", "c_acctbal"]), db, "customers"))


def q_report_single_file(spark, d):
    """The duplicate report as one file of the given name, read back as text."""
    path = scratch_path(spark, "report") + "/qc_dup_lines.csv"
    write_delimited(duplicate_report(lineitem_d(spark, d), LINE_KEYS).select(*LINE_KEYS, "counts", "l_partkey"), path, single_file=True)
    rows = spark.read.text(path)
    return rows.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def q_frequency(spark, d):
    return frequency(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "lineitem", "1")


FREQUENCY_LABELS = {
    "1": ["l_returnflag", "l_linestatus"],
    "2": ["l_linenumber"],
    "3": ["l_linenumber", "l_returnflag"],
    "4": ["l_shipdate", "l_linestatus"],
    "5": ["l_suppkey"],
}


def q_frequency_labels(spark, d):
    """Five frequency tables of one table from one pass; values as text in one column."""
    rows = frequency_rows(frequencies(lineitem_d(spark, d), FREQUENCY_LABELS), FREQUENCY_LABELS, "lineitem_d")
    return rows.selectExpr("tbl", "label", "concat_ws('|', transform(value, v -> coalesce(v, 'null'))) AS value", "`count` AS n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dup_flags": q_dup_flags,
    "dup_null_keys": q_dup_null_keys,
    "dup_first_key_variant": q_dup_first_key_variant,
    "dup_report": q_dup_report,
    "dup_groups": q_dup_groups,
    "dup_exact_documents": q_dup_exact_documents,
    "dup_summary": q_dup_summary,
    "missing_flags": q_missing_flags,
    "missing_all_columns": q_missing_all_columns,
    "missing_by_column": q_missing_by_column,
    "missing_null_only": q_missing_null_only,
    "nonnumeric_flags": q_nonnumeric_flags,
    "nonnumeric_flags_spark": q_nonnumeric_flags_spark,
    "nonnumeric_values": q_nonnumeric_values,
    "negative_rows": q_negative_rows,
    "negative_flags": q_negative_flags,
    "last_dt_flags": q_last_dt_flags,
    "last_dt_report": q_last_dt_report,
    "last_dt_partial_dates": q_last_dt_partial_dates,
    "last_dt_float": q_last_dt_float,
    "death_dt_flags": q_death_dt_flags,
    "date_outer_anchor": q_date_outer_anchor,
    "unique_key_result": q_unique_key_result,
    "mappable_id_result": q_mappable_id_result,
    "mappable_id_violations": q_mappable_id_violations,
    "labels_reference_documents": q_labels_reference_documents,
    "conversation_turns_unique": q_conversation_turns_unique,
    "rule_sequence_flags": q_rule_sequence_flags,
    "rule_sequence_events": q_rule_sequence_events,
    "rule_summary": q_rule_summary,
    "rule_events": q_rule_events,
    "delivery_roundtrip_dups": q_delivery_roundtrip_dups,
    "delivery_wide_ids": q_delivery_wide_ids,
    "table_replace": q_table_replace,
    "table_swap": q_table_swap,
    "report_single_file": q_report_single_file,
    "frequency": q_frequency,
    "frequency_labels": q_frequency_labels,
    "dup_text_keys": q_dup_text_keys,
    "dup_reserved_names": q_dup_reserved_names,
    "missing_result_column": q_missing_result_column,
    "nonnumeric_null_ok": q_nonnumeric_null_ok,
    "last_dt_layouts": q_last_dt_layouts,
    "last_dt_short_years": q_last_dt_short_years,
    "last_dt_integer_dates": q_last_dt_integer_dates,
    "last_dt_ignored_columns": q_last_dt_ignored_columns,
    "last_dt_unparsed": q_last_dt_unparsed,
    "death_dt_report": q_death_dt_report,
    "mappable_id_mixed_types": q_mappable_id_mixed_types,
    "mappable_id_nulls_apart": q_mappable_id_nulls_apart,
    "mappable_id_composite": q_mappable_id_composite,
    "mapping_events_null_id": q_mapping_events_null_id,
    "negative_in_sequence": q_negative_in_sequence,
    "delivery_text_roundtrip": q_delivery_text_roundtrip,
    "table_append": q_table_append,
    "table_upload": q_table_upload,
    "rule_sequence_spark_flavour": q_rule_sequence_spark_flavour,
    "last_dt_strict": q_last_dt_strict,
    "row_ids": q_row_ids,
    "delivery_run_flags": q_delivery_run_flags,
    "delivery_run_resumed": q_delivery_run_resumed,
    "delivery_run_summary": q_delivery_run_summary,
    "delivery_run_reports": q_delivery_run_reports,
    "cell_reports": q_cell_reports,
}

# Checks that write files or tables as part of building their DataFrame.
SIDE_EFFECTS = frozenset(
    "delivery_roundtrip_dups delivery_wide_ids table_swap report_single_file table_replace table_upload delivery_text_roundtrip table_append "
    "delivery_run_flags delivery_run_resumed delivery_run_summary delivery_run_reports cell_reports".split()
)


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------


def _sql_last_dt_lineitem() -> str:
    return f"""{_with("orders_a")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
    SELECT t.*, {_flag("a.anchor < t.l_shipdate", "last_dt_flag")}
    FROM lineitem t LEFT JOIN a ON t.l_orderkey = a.aid"""


def _sql_sequence_lineitem() -> str:
    keys = LINE_KEYS
    on = " AND ".join(f"t.{k} = g.{k}" for k in keys)
    return f"""{_with("lineitem_d", "orders_a")},
    a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1),
    g AS ({_dup_groups_sql("lineitem_d", keys)})
    SELECT t.*, {_flag("a.anchor < t.l_shipdate", "last_dt_flag")},
      CAST(COALESCE(g.n, 0) AS BIGINT) AS dup_count,
      CAST(CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS dup_flag,
      {_flag("t.l_linenumber IS NULL OR t.l_shipdate IS NULL", "missing_flag")}
    FROM lineitem_d t LEFT JOIN a ON t.l_orderkey = a.aid LEFT JOIN g ON {on}"""


def _sql_sequence_events() -> str:
    miss = " OR ".join(
        [
            "event_id IS NULL",
            "ts IS NULL",
            "user_id IS NULL",
            _missing_str("event_type"),
            _missing_dbl("value"),
            _missing_str("props"),
            _missing_str("value_txt"),
        ]
    )
    return f"""{_with("events_d")}
    SELECT *, {_flag(_value_bad_sql(), "value_flag")},
      {_flag(miss, "missing_flag")} FROM events_d"""


def _sql_rule_summary() -> str:
    keys = LINE_KEYS
    on = " AND ".join(f"t.{k} = g.{k}" for k in keys)
    dup_src = f"""SELECT CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS f FROM lineitem_d t
        LEFT JOIN ({_dup_groups_sql("lineitem_d", keys)}) g ON {on}"""
    last_src = f"""SELECT CASE WHEN a.anchor < t.l_shipdate THEN 1 ELSE 0 END AS f FROM lineitem_d t
        LEFT JOIN (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1) a
        ON t.l_orderkey = a.aid"""
    value_src = f"SELECT CASE WHEN {_value_bad_sql()} THEN 1 ELSE 0 END AS f FROM events_d"
    miss_li = "SELECT CASE WHEN l_linenumber IS NULL OR l_shipdate IS NULL THEN 1 ELSE 0 END AS f FROM lineitem_d"
    all_orders = " OR ".join(
        [
            "l_orderkey IS NULL",
            "o_custkey IS NULL",
            _missing_str("o_orderstatus"),
            _missing_dbl("o_totalprice"),
            "o_orderdate IS NULL",
            _missing_str("o_orderpriority"),
        ]
    )
    miss_orders = f"SELECT CASE WHEN {all_orders} THEN 1 ELSE 0 END AS f FROM orders_a"
    ev_miss = " OR ".join(
        [
            "event_id IS NULL",
            "ts IS NULL",
            "user_id IS NULL",
            _missing_str("event_type"),
            _missing_dbl("value"),
            _missing_str("props"),
            _missing_str("value_txt"),
        ]
    )
    miss_ev = f"SELECT CASE WHEN {ev_miss} THEN 1 ELSE 0 END AS f FROM events_d"
    parts = [
        _summary_sql("last_dt", "lineitem_d", last_src, "f"),
        _summary_sql("duplication", "lineitem_d", dup_src, "f"),
        _summary_sql("string_tables", "events_d", value_src, "f"),
        _summary_sql("missing", "lineitem_d", miss_li, "f"),
        _summary_sql("missing", "orders_a", miss_orders, "f"),
        _summary_sql("missing", "events_d", miss_ev, "f"),
    ]
    return _with("lineitem_d", "orders_a", "events_d") + "\nUNION ALL\n".join(parts)


def _sql_rule_events() -> str:
    """Events of the unique-key rule: one JSON record per failing row, in the
    layout Spark's ``to_json`` writes (failing rows have no null fields)."""
    num = lambda c: f"CAST(t.{c} AS VARCHAR)"
    txt = lambda c: f"'\"' || t.{c} || '\"'"
    parts = [
        ("l_orderkey", num), ("l_partkey", num), ("l_suppkey", num), ("l_linenumber", num),
        ("l_quantity", num), ("l_extendedprice", num), ("l_discount", num), ("l_tax", num),
        ("l_returnflag", txt), ("l_linestatus", txt),
    ]
    body = " || ',' || ".join(f"'\"{c}\":' || {fmt(c)}" for c, fmt in parts)
    ship = "'\"l_shipdate\":\"' || strftime(t.l_shipdate, '%Y-%m-%dT%H:%M:%S.000') || '\"'"
    on = " AND ".join(f"t.{k} = g.{k}" for k in LINE_KEYS)
    return f"""{_with("lineitem_d")}
    SELECT 'qc_engine' AS dag_name, '001' AS dag_run_id, 'Unique PK' AS event_type,
      '{{' || {body} || ',' || {ship} || '}}' AS event_data
    FROM lineitem_d t JOIN ({_dup_groups_sql("lineitem_d", LINE_KEYS)}) g ON {on}"""


def _run_views() -> str:
    """The delivery as it is read: marker cells are null."""
    return f"""{_with("lineitem_d", "orders_a", "events_d")},
    ev AS (SELECT * REPLACE (CASE WHEN value_txt IN ('N/A', '') THEN NULL ELSE value_txt END AS value_txt) FROM events_d),
    a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1),
    g AS ({_dup_groups_sql("lineitem_d", LINE_KEYS)}),
    fl AS (SELECT t.*, {_flag("a.anchor < t.l_shipdate", "last_dt_flag")}, {_flag("a.anchor < t.l_shipdate", "death_dt_flag")},
      CAST(COALESCE(g.n, 0) AS BIGINT) AS dup_count, CAST(CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS dup_flag,
      {_flag("t.l_linenumber IS NULL OR t.l_shipdate IS NULL", "missing_flag")}
      FROM lineitem_d t LEFT JOIN a ON t.l_orderkey = a.aid LEFT JOIN g ON {" AND ".join(f"t.{k} = g.{k}" for k in LINE_KEYS)})
    """


def _sql_run_lines() -> str:
    return _run_views() + "SELECT * FROM fl"


_EVENT_CELLS = {"event_id": False, "ts": False, "user_id": False, "event_type": True, "value": None, "props": True, "value_txt": True}
_ORDER_CELLS = {"l_orderkey": False, "o_custkey": False, "o_orderstatus": True, "o_totalprice": None, "o_orderdate": False, "o_orderpriority": True}


def _cell_missing(c: str, text: bool | None) -> str:
    return _missing_str(c) if text else _missing_dbl(c) if text is None else f"{c} IS NULL"


def _sql_run_summary() -> str:
    any_missing = lambda cells: " OR ".join(_cell_missing(c, t) for c, t in cells.items())
    parts = [
        _summary_sql("last_dt", "lines", "SELECT last_dt_flag AS f FROM fl", "f"),
        _summary_sql("death_dt", "lines", "SELECT death_dt_flag AS f FROM fl", "f"),
        _summary_sql("duplication", "lines", "SELECT dup_flag AS f FROM fl", "f"),
        _summary_sql("string_tables", "events", f"SELECT CASE WHEN {_value_bad_sql()} THEN 1 ELSE 0 END AS f FROM ev", "f"),
        _summary_sql("missing", "lines", "SELECT missing_flag AS f FROM fl", "f"),
        _summary_sql("missing", "orders", f"SELECT CASE WHEN {any_missing(_ORDER_CELLS)} THEN 1 ELSE 0 END AS f FROM orders_a", "f"),
        _summary_sql("missing", "events", f"SELECT CASE WHEN {any_missing(_EVENT_CELLS)} THEN 1 ELSE 0 END AS f FROM ev", "f"),
    ]
    return _run_views() + "\nUNION ALL\n".join(parts)


def _sql_run_reports() -> str:
    missing = [
        f"SELECT 'qc_missing' AS report, '{tbl}' AS tbl, '{c}' AS column, CAST(COUNT(*) FILTER (WHERE {_cell_missing(c, t)}) AS VARCHAR) AS value FROM {src}"
        for tbl, src, cells in (("events", "ev", _EVENT_CELLS), ("orders", "orders_a", _ORDER_CELLS), ("lines", "lineitem_d", {"l_linenumber": False, "l_shipdate": False}))
        for c, t in cells.items()
    ]
    values = f"""SELECT DISTINCT 'qc_value' AS report, 'events' AS tbl, 'value_txt' AS column, value_txt AS value FROM ev
      WHERE value_txt IS NOT NULL AND {_bad_text("value_txt")}
    UNION ALL SELECT DISTINCT 'qc_value', 'events', 'value', CAST(value AS VARCHAR) FROM ev
      WHERE value IS NOT NULL AND NOT isnan(value) AND {_bad_double("value")}"""
    death = "SELECT 'qc_deathdt' AS report, 'lines' AS tbl, 'rows' AS column, CAST(count(*) AS VARCHAR) AS value FROM fl WHERE death_dt_flag = 1"
    return _run_views() + "\nUNION ALL\n".join([values, *missing, death])


def oracle_sql() -> dict[str, str]:
    li_rest = [c for c in LINEITEM_COLS if c not in LINE_KEYS]
    dup_on = " AND ".join(f"t.{k} = g.{k}" for k in LINE_KEYS)
    cust_all_missing = " OR ".join(
        ["c_custkey IS NULL", _missing_str("c_name"), "c_nationkey IS NULL", _missing_dbl("c_acctbal"), _missing_str("c_mktsegment")]
    )
    cust_null_only = " OR ".join(
        ["c_custkey IS NULL", "c_name IS NULL", "c_nationkey IS NULL", _missing_dbl("c_acctbal"), "c_mktsegment IS NULL"]
    )
    miss_col = lambda tbl, c, cond: f"SELECT '{c}' AS column, CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS missing, '{tbl}' AS tbl FROM {tbl}"
    sql = {
        "dup_flags": _dup_flags_sql("lineitem", LINE_KEYS),
        "dup_null_keys": _with("lineitem_d") + _dup_flags_sql("lineitem_d", LINE_KEYS),
        "dup_first_key_variant": _with("lineitem_d")
        + f"""SELECT *, {_flag("COUNT(l_linenumber) OVER (PARTITION BY l_linenumber, l_orderkey) > 1", "flag_duplication")}
        FROM lineitem_d""",
        "dup_report": f"""SELECT t.l_orderkey, t.l_linenumber, g.n AS counts, {", ".join("t." + c for c in li_rest)}
        FROM lineitem t JOIN ({_dup_groups_sql("lineitem", LINE_KEYS)}) g ON {dup_on}""",
        "dup_groups": _dup_groups_sql("lineitem", LINE_KEYS, "counts"),
        "dup_exact_documents": _dup_flags_sql("documents", ["text"]),
        "dup_summary": _summary_sql("duplication", "lineitem", _dup_flags_sql("lineitem", LINE_KEYS), "dup_flag"),
        "missing_flags": _with("customer_d")
        + f"""SELECT *, {_flag(_missing_str("c_mktsegment") + " OR " + _missing_dbl("c_acctbal"), "missing_flag")}
        FROM customer_d""",
        "missing_all_columns": _with("customer_d") + f"SELECT *, {_flag(cust_all_missing, 'missing_flag')} FROM customer_d",
        "missing_by_column": _with("customer_d", "lineitem_d")
        + "\nUNION ALL\n".join(
            [
                miss_col("customer_d", "c_custkey", "c_custkey IS NULL"),
                miss_col("customer_d", "c_name", _missing_str("c_name")),
                miss_col("customer_d", "c_nationkey", "c_nationkey IS NULL"),
                miss_col("customer_d", "c_acctbal", _missing_dbl("c_acctbal")),
                miss_col("customer_d", "c_mktsegment", _missing_str("c_mktsegment")),
                miss_col("lineitem_d", "l_linenumber", "l_linenumber IS NULL"),
                miss_col("lineitem_d", "l_shipdate", "l_shipdate IS NULL"),
            ]
        ),
        "missing_null_only": _with("customer_d") + f"SELECT *, {_flag(cust_null_only, 'flag_missing')} FROM customer_d",
        "nonnumeric_flags": _with("events_d")
        + f"SELECT *, {_flag(_value_bad_sql(), 'value_flag')} FROM events_d",
        "nonnumeric_flags_spark": _with("events_d") + f"SELECT *, {_flag(_value_bad_sql(), 'flag_values')} FROM events_d",
        "nonnumeric_values": _with("events_d", "customer_d")
        + f"""SELECT DISTINCT 'events_d' AS tbl, 'value' AS column, CAST(value AS VARCHAR) AS value FROM events_d
          WHERE value IS NOT NULL AND NOT isnan(value) AND {_bad_double("value")}
        UNION
        SELECT DISTINCT 'events_d', 'value_txt', value_txt FROM events_d WHERE value_txt IS NOT NULL AND {_bad_text("value_txt")}
        UNION
        SELECT DISTINCT 'customer_d', 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer_d
          WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND {_bad_double("c_acctbal")}""",
        "negative_rows": _with("customer_d") + "SELECT * FROM customer_d WHERE c_acctbal < 0 AND NOT isnan(c_acctbal)",
        "negative_flags": _with("events_d")
        + f"""SELECT *, {_flag("(value < 0 AND NOT isnan(value)) OR TRY_CAST(value_txt AS DOUBLE) < 0", "negative_flag")}
        FROM events_d""",
        "last_dt_flags": _sql_last_dt_lineitem(),
        "last_dt_report": f"""{_with("orders_a")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
        SELECT t.*, a.anchor AS o_orderdate, CAST(1 AS INTEGER) AS last_dt_flag
        FROM lineitem t JOIN a ON t.l_orderkey = a.aid WHERE a.anchor < t.l_shipdate""",
        "last_dt_partial_dates": f"""{_with("orders_a", "labs_d")},
        a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
        SELECT t.*, {_flag("a.anchor < try_strptime(replace(t.ship_date_txt, 'UK', '15'), '%Y/%m/%d')", "last_dt_flag")}
        FROM labs_d t LEFT JOIN a ON t.l_orderkey = a.aid""",
        "last_dt_float": f"""{_with("signup_rel")},
        a AS (SELECT user_id AS aid, min(CASE WHEN isnan(signup_time) THEN NULL ELSE signup_time END) AS anchor
              FROM signup_rel GROUP BY 1)
        SELECT t.*, {_flag("a.anchor < CASE WHEN isnan(t.day_time) THEN NULL ELSE t.day_time END", "last_dt_flag")}
        FROM events_rel t LEFT JOIN a ON t.user_id = a.aid""",
        "death_dt_flags": f"""{_with("cust_limit")},
        a AS (SELECT o_custkey AS aid, min(death_date) AS anchor FROM cust_limit GROUP BY 1)
        SELECT t.*, {_flag("a.anchor < t.o_orderdate", "death_dt_flag")}
        FROM orders t LEFT JOIN a ON t.o_custkey = a.aid""",
        "date_outer_anchor": f"""{_with("cust_anchor")},
        a AS (SELECT user_id AS aid, min(cutoff_ts) AS anchor FROM cust_anchor GROUP BY 1)
        SELECT t.event_id, t.ts, COALESCE(t.user_id, a.aid) AS user_id, t.event_type, t.value, t.props,
          {_flag("a.anchor < t.ts", "last_dt_flag")}
        FROM events t FULL OUTER JOIN a ON t.user_id = a.aid""",
        "unique_key_result": _with("lineitem_d")
        + f"""SELECT t.*, g.n IS NULL AS result FROM lineitem_d t
        LEFT JOIN ({_dup_groups_sql("lineitem_d", LINE_KEYS)}) g ON {dup_on}""",
        "mappable_id_result": _with("orders_s") + """SELECT t.*, EXISTS (SELECT 1 FROM orders_s o
          WHERE o.o_orderkey IS NOT DISTINCT FROM t.l_orderkey) AS result FROM lineitem t""",
        "mappable_id_violations": _with("orders_s") + """SELECT t.* FROM lineitem t WHERE NOT EXISTS (SELECT 1 FROM orders_s o
          WHERE o.o_orderkey IS NOT DISTINCT FROM t.l_orderkey)""",
        "labels_reference_documents": """SELECT t.*, EXISTS (SELECT 1 FROM documents d
          WHERE d.doc_id IS NOT DISTINCT FROM t.doc_id) AS result FROM labels t""",
        "conversation_turns_unique": f"""SELECT t.*, g.n IS NULL AS result FROM conversations t
        LEFT JOIN ({_dup_groups_sql("conversations", ["conv_id", "turn"])}) g
        ON t.conv_id = g.conv_id AND t.turn = g.turn""",
        "rule_sequence_flags": _sql_sequence_lineitem(),
        "rule_sequence_events": _sql_sequence_events(),
        "rule_summary": _sql_rule_summary(),
        "rule_events": _sql_rule_events(),
        "delivery_roundtrip_dups": _dup_flags_sql("lineitem", LINE_KEYS),
        "frequency_labels": _with("lineitem_d")
        + " UNION ALL ".join(
            f"""SELECT 'lineitem_d' AS tbl, '{label}' AS label, concat_ws('|', {", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in cols)}) AS value,
            COUNT(*) AS n
            FROM lineitem_d GROUP BY {", ".join(cols)}"""
            for label, cols in FREQUENCY_LABELS.items()
        ),
        "report_single_file": f"""{_with("lineitem_d")}, r AS (SELECT t.l_orderkey || ',' || t.l_linenumber || ',' || g.n || ',' || t.l_partkey AS line
            FROM lineitem_d t JOIN ({_dup_groups_sql("lineitem_d", LINE_KEYS)}) g ON {dup_on}
            UNION ALL SELECT 'l_orderkey,l_linenumber,counts,l_partkey')
            SELECT line, COUNT(*) AS n FROM r GROUP BY line""",
        "delivery_wide_ids": f"""WITH w AS (SELECT '123456' || lpad(k, 12, '0') AS key18, '1234567' || lpad(k, 12, '0') AS key19,
            '9234567' || lpad(k, 12, '0') AS key_over, '1234567890123' || lpad(k, 12, '0') AS key25, lpad(k, 12, '0') AS padded,
            l_linenumber || '.123456789012345678' AS fine, l_linenumber || '.25' AS plain, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
            CASE WHEN l_orderkey % 1000 = 0 THEN 'abc' ELSE CAST(l_linenumber AS VARCHAR) END AS value_mixed,
            CAST(l_linenumber AS VARCHAR) AS l_linenumber,
            'bigint bigint decimal(38,0) decimal(38,0) string decimal(19,18) double date string bigint' AS types
            FROM (SELECT *, CAST(l_orderkey AS VARCHAR) AS k FROM lineitem))
            {_dup_flags_sql("w", ["key25", "l_linenumber"])}""",
        "table_replace": _with("customer_d")
        + f"""SELECT *, {_flag(_missing_str("c_mktsegment") + " OR " + _missing_dbl("c_acctbal"), "missing_flag")}
        FROM customer_d""",
        "dup_text_keys": _with("lineitem_t") + _dup_flags_sql("lineitem_t", LINE_KEYS),
        "dup_reserved_names": _with("events_r")
        + f"""SELECT t.*, CAST(COALESCE(g.n, 0) AS BIGINT) AS dup_count_qc, CAST(CASE WHEN g.n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS dup_flag
        FROM events_r t LEFT JOIN ({_dup_groups_sql("events_r", ["result", "user_id"])}) g ON t.result = g.result AND t.user_id = g.user_id""",
        "missing_result_column": _with("events_r")
        + f"""SELECT *, {_flag("event_id IS NULL OR user_id IS NULL OR " + _missing_str("result") + " OR " + _missing_dbl("dup_count"), "missing_flag")}
        FROM events_r""",
        "nonnumeric_null_ok": _with("events_d")
        + f"""SELECT *, {_flag("(value IS NOT NULL AND " + _bad_double("value") + ") OR (value_txt IS NOT NULL AND " + _bad_text("value_txt") + ")", "value_flag")}
        FROM events_d""",
        "last_dt_layouts": f"""{_with("orders_a", "labs_x")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
        SELECT t.l_orderkey, t.l_linenumber, t.ship_date_txt, {_flag("t.l_orderkey % 10 <> 9 AND a.anchor < t.l_shipdate", "last_dt_flag")}
        FROM labs_x t LEFT JOIN a ON t.l_orderkey = a.aid""",
        "last_dt_short_years": f"""{_with("orders_a", "labs_y")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
        SELECT t.l_orderkey, t.l_linenumber, t.ship_date_txt, t.ship_date_num,
        {_flag("a.anchor < t.parsed OR a.anchor < t.earlier", "last_dt_flag")}
        FROM labs_y t LEFT JOIN a ON t.l_orderkey = a.aid""",
        "last_dt_integer_dates": f"""{_with("orders_a", "labs_x")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1)
        SELECT t.l_orderkey, t.l_linenumber, t.ship_date_int, {_flag("a.anchor < t.l_shipdate", "last_dt_flag")}
        FROM labs_x t LEFT JOIN a ON t.l_orderkey = a.aid""",
        "last_dt_ignored_columns": f"""{_with("orders_a")}, a AS (SELECT l_orderkey AS aid, min(o_orderdate) AS anchor FROM orders_a GROUP BY 1),
        t AS (SELECT l_orderkey, l_linenumber, l_shipdate - INTERVAL 80 DAY AS ship_date, l_shipdate + INTERVAL 9000 DAY AS commit_date,
              l_shipdate + INTERVAL 9000 DAY AS receiptdate FROM lineitem)
        SELECT t.*, {_flag("a.anchor < t.ship_date", "last_dt_flag")} FROM t LEFT JOIN a ON t.l_orderkey = a.aid""",
        "last_dt_unparsed": f"""{_with("labs_x")} SELECT DISTINCT 'labs_x' AS tbl, 'ship_date_txt' AS column, ship_date_txt AS value
        FROM labs_x WHERE l_orderkey % 10 = 9""",
        "death_dt_report": f"""{_with("cust_limit")}, a AS (SELECT o_custkey AS aid, min(death_date) AS anchor FROM cust_limit GROUP BY 1)
        SELECT t.*, a.anchor AS death_date, CAST(1 AS INTEGER) AS death_dt_flag
        FROM orders t JOIN a ON t.o_custkey = a.aid WHERE a.anchor < t.o_orderdate""",
        "mappable_id_mixed_types": _with("orders_s", "lineitem_t") + """SELECT t.*, EXISTS (SELECT 1 FROM orders_s o
          WHERE CAST(o.o_orderkey AS VARCHAR) = t.l_orderkey) AS result FROM lineitem_t t""",
        "mappable_id_nulls_apart": _with("labels_n") + "SELECT *, doc_id IS NOT NULL AS result FROM labels_n",
        "mappable_id_composite": _with("lineitem_d") + """SELECT t.*, EXISTS (SELECT 1 FROM lineitem_d o WHERE o.l_orderkey = t.l_orderkey
          AND o.l_linenumber + 1 IS NOT DISTINCT FROM t.l_linenumber) AS result FROM lineitem_d t""",
        "mapping_events_null_id": _with("labels_n") + """SELECT 'qc_engine' AS dag_name, '002' AS dag_run_id, 'Mapping ID' AS event_type,
          '{"doc_id":' || coalesce(CAST(t.doc_id AS VARCHAR), 'null') || ',"quality":' || t.quality || ',"toxic":' || t.toxic || '}' AS event_data
          FROM labels_n t WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id IS NOT DISTINCT FROM t.doc_id)""",
        "negative_in_sequence": _with("events_d")
        + f"""SELECT *, {_flag("(value < 0 AND NOT isnan(value)) OR TRY_CAST(value_txt AS DOUBLE) < 0", "negative_flag")},
        {_flag(_value_bad_sql(), "value_flag")} FROM events_d""",
        "delivery_text_roundtrip": _with("events_d") + """SELECT md5(text) AS digest, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first FROM (
          SELECT doc_id, text FROM documents UNION ALL
          SELECT event_id, '  ' || value_txt || ' "q" ' FROM events_d WHERE value_txt IS NOT NULL) GROUP BY 1""",
        "table_append": "SELECT l_returnflag, CAST(2 * count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1",
        "table_upload": "SELECT event_id, user_id, event_type FROM events",
        "rule_sequence_spark_flavour": _with("lineitem_d")
        + f"""SELECT l_orderkey, l_linenumber, l_quantity AS value_quantity,
        {_flag("l_orderkey IS NOT NULL AND COUNT(l_orderkey) OVER (PARTITION BY l_orderkey, l_linenumber) > 1", "flag_duplication")},
        {_flag("l_linenumber IS NULL", "flag_missing")}, {_flag(_bad_double("l_quantity"), "flag_values")} FROM lineitem_d""",
        "row_ids": "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_ids FROM lineitem",
        "delivery_run_flags": _sql_run_lines(),
        "delivery_run_summary": _sql_run_summary(),
        "delivery_run_reports": _sql_run_reports(),
        "frequency": """SELECT l_returnflag, l_linestatus, CAST(COUNT(*) AS BIGINT) AS count, '1' AS label, 'lineitem' AS tbl
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    }
    miss = [
        miss_col("labs_x", "ship_date_txt", _missing_str("ship_date_txt")),
        miss_col("orders_a", "l_orderkey", "l_orderkey IS NULL"),
        miss_col("events_d", "value", _missing_dbl("value")),
        miss_col("events_d", "value_txt", _missing_str("value_txt")),
        miss_col("customer_d", "c_mktsegment", _missing_str("c_mktsegment")),
        miss_col("customer_d", "c_acctbal", _missing_dbl("c_acctbal")),
    ]
    sql["cell_reports"] = _with("labs_x", "orders_a", "events_d", "customer_d") + f"""
      SELECT 'qc_missing' AS report, tbl, "column", CAST(missing AS VARCHAR) AS value FROM ({" UNION ALL ".join(miss)})
      UNION ALL SELECT DISTINCT 'qc_unparsed_last_dt', 'labs_x', 'ship_date_txt', ship_date_txt FROM labs_x WHERE l_orderkey % 10 = 9
      UNION ALL SELECT DISTINCT 'qc_value', 'events_d', 'value', CAST(value AS VARCHAR) FROM events_d
        WHERE value IS NOT NULL AND NOT isnan(value) AND {_bad_double("value")}
      UNION ALL SELECT DISTINCT 'qc_value', 'events_d', 'value_txt', value_txt FROM events_d
        WHERE value_txt IS NOT NULL AND {_bad_text("value_txt")}"""
    sql["last_dt_strict"] = sql["last_dt_partial_dates"]
    sql["table_swap"] = sql["table_replace"]
    sql["delivery_run_resumed"] = sql["delivery_run_flags"]
    return sql
