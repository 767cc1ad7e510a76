"""Hot keys: a key holding a third of the rows must not land in one task."""

import pytest
from pyspark.sql import functions as F

from flagstone.operators import duplicate_report, flag_duplicates, mappable_id
from flagstone.operators.dates import DateBoundSpec, last_date

N = 300_000


def _hot_table(spark):
    # key 7 holds a third of all rows; the rest are unique
    return spark.range(0, N, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )


def _max_task_rows(df):
    """Largest number of rows in one partition of the join output (each
    partition of a sort-merge join is one reduce task)."""
    rows = df.select(F.spark_partition_id().alias("p"), F.xxhash64(*df.columns).alias("h"))  # needs every column
    return rows.groupBy("p").agg(F.count("h").alias("n"), F.max("h").alias("h")).agg(F.max("n"), F.max("h")).first()[0]


def _force_shuffle_join(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_duplicates_hot_key_is_split(spark):
    old = _force_shuffle_join(spark)
    try:
        out = flag_duplicates(_hot_table(spark), ["k"])
        stats = out.agg(F.count("*"), F.sum("dup_flag"), F.max("dup_count")).first()
        assert tuple(stats) == (N, N // 3 + 1, N // 3 + 1)  # id 7 also has key 7
        assert _max_task_rows(out) < N // 6
        # control: with the split switched off the hot key is one task
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert _max_task_rows(flag_duplicates(_hot_table(spark), ["k"])) > N // 3
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        _restore(spark, old)


def test_membership_and_dates_hot_key_is_split(spark):
    old = _force_shuffle_join(spark)
    try:
        rows = _hot_table(spark)
        sup = spark.range(0, N, 2).select(F.col("id").alias("k"))
        out = mappable_id(rows, sup, "k")
        # found: even ids not divisible by 3 (the hot key 7 is odd)
        assert out.where("result").count() == N // 2 - N // 6
        assert out.count() == N
        assert _max_task_rows(out) < N // 6
        anchor = spark.range(N).select(F.col("id").alias("k"), F.lit(5).cast("double").alias("end_time"))
        rel = rows.select("k", (F.col("v") % 10).cast("double").alias("obs_time"))
        tables, _ = last_date({"a": anchor, "r": rel}, DateBoundSpec("a", "end_time", "k", "time", dt_type="float"))
        flagged = tables["r"]
        assert flagged.count() == N
        assert _max_task_rows(flagged) < N // 6
    finally:
        _restore(spark, old)


def test_null_key_rows_are_spread(spark):
    old = _force_shuffle_join(spark)
    try:
        # a third of the rows have a null key: they match nothing, but must
        # not all be shuffled to the one partition that null hashes to
        df = spark.range(0, N, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v")
        )
        out = flag_duplicates(df, ["k"])
        assert out.where("dup_flag = 1").count() == N - N // 3
        assert out.where("k IS NULL AND dup_flag = 0").count() == N // 3
        assert _max_task_rows(out) < N // 6
    finally:
        _restore(spark, old)


def test_text_key_is_exact_and_skew_safe(spark):
    old = _force_shuffle_join(spark)
    try:
        df = spark.range(0, N, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot text")).otherwise(F.concat(F.lit("t"), (F.col("id") % 50000).cast("string"))).alias("k"),
            F.col("id").alias("v"),
        )
        fast = flag_duplicates(df, ["k"])
        slow = flag_duplicates(df, ["k"], long_text=True)
        assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
        assert fast.where("k = 'hot text'").agg(F.min("dup_count")).first()[0] == N // 3
        assert _max_task_rows(fast) < N // 6
    finally:
        _restore(spark, old)


def test_identical_copies_are_spread(spark):
    old = _force_shuffle_join(spark)
    try:
        # a third of the rows are byte-identical copies of one row
        df = spark.range(0, N, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
        )
        out = flag_duplicates(df, ["k", "v"])
        assert out.where("k = -1").agg(F.min("dup_count")).first()[0] == N // 3
        # the split is by bytes, and copies compress well: pieces of the other partitions' size
        assert _max_task_rows(out) < N // 4
    finally:
        _restore(spark, old)


KEY_PAIRS = [
    ("string", "bigint", [("7", 7, True), ("007", 7, False), ("A1", 7, False), (None, None, True)]),
    ("int", "double", [(7, 7.0, True), (7, 7.5, False), (None, None, True)]),
    ("decimal(10,2)", "int", [("7.00", 7, True), ("7.10", 7, False)]),
    ("double", "string", [(7.0, "7.0", True), (7.0, "7", False)]),
    ("date", "timestamp_ntz", [("2020-01-02", "2020-01-02 00:00:00", True), ("2020-01-02", "2020-01-02 01:00:00", False)]),
]


@pytest.mark.parametrize("rows_type, side_type, cases", KEY_PAIRS)
def test_keys_of_two_types(spark, rows_type, side_type, cases):
    """One meaning whatever the size of the key, shuffled or broadcast."""
    for copies in (1, 3000):
        for shuffled in (False, True):
            old = _force_shuffle_join(spark) if shuffled else {}
            try:
                for row, side, want in cases:
                    lit = lambda v: "NULL" if v is None else f"'{v}'"
                    rows = spark.range(copies).selectExpr(f"CAST({lit(row)} AS {rows_type}) AS k")
                    sup = spark.range(2).selectExpr(f"CAST({lit(side)} AS {side_type}) AS k")
                    got = mappable_id(rows, sup, "k").groupBy("result").count().collect()
                    assert [tuple(r) for r in got] == [(want, copies)]
            finally:
                _restore(spark, old)


def test_date_bound_with_text_ids(spark):
    anchor = spark.createDataFrame([(7, 1.0)], "id bigint, end_time double")
    rel = spark.range(40).selectExpr("'7' AS id", "2.0D AS obs_time")
    tables, _ = last_date({"a": anchor, "r": rel}, DateBoundSpec("a", "end_time", "id", "time", dt_type="float"))
    assert tables["r"].where("last_dt_flag = 1").count() == 40


def test_nested_map_columns_pass(spark):
    df = spark.sql("SELECT id % 3 AS k, array(map('a', id)) AS m FROM range(9)")
    assert flag_duplicates(df, ["k"]).where("dup_count = 3").count() == 9
    assert duplicate_report(df, ["k"]).count() == 9


def test_flags_share_a_shuffle_and_a_hot_id_is_split(spark):
    """Rows joined by id are not shuffled again to be joined by id and another key, but where one id has too many."""
    from flagstone.plans.delivery import FLAG_CONF, _session_conf
    from flagstone.plans.runner import run_rules

    old = _force_shuffle_join(spark)
    try:
        rows = _hot_table(spark).selectExpr("k", "v % 1000 AS n", "v", "CAST(v % 10 AS DOUBLE) AS obs_time")
        limits = spark.range(N).selectExpr("id AS k", "5D AS end_time")
        rules = {"last_dt": {"table": "a", "dt_column": "end_time", "id_column": "k", "dt_value": "time", "dt_type": "float"}, "duplication": {"r": ["k", "n"]}}

        def flagged():
            return run_rules({"a": limits, "r": rows}, rules, list(rules)).tables["r"]

        shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        want = flagged().groupBy("last_dt_flag", "dup_flag", "dup_count").count().collect()
        apart = shuffles(flagged())
        with _session_conf(spark, FLAG_CONF):
            assert shuffles(flagged()) == apart - 1
            assert sorted(flagged().groupBy("last_dt_flag", "dup_flag", "dup_count").count().collect()) == sorted(want)
            assert _max_task_rows(flagged()) < N // 6
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        _restore(spark, old)


def test_stored_limits_are_shuffled_once(spark, tmp_path):
    """Limits read from storage need no rebalance before the join; a hot id is split all the same."""

    def stage(df):
        df.write.parquet(str(tmp_path / "limits"))
        return spark.read.parquet(str(tmp_path / "limits"))

    old = _force_shuffle_join(spark)
    try:
        anchor = spark.range(N).select(F.col("id").alias("k"), F.lit(5).cast("double").alias("end_time"))
        rel = _hot_table(spark).select("k", (F.col("v") % 10).cast("double").alias("obs_time"))
        spec = DateBoundSpec("a", "end_time", "k", "time", dt_type="float")
        plain, _ = last_date({"a": anchor, "r": rel}, spec)
        tables, reports = last_date({"a": anchor, "r": rel}, spec, stage=stage)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "REBALANCE" in plan(plain["r"]) and "REBALANCE" not in plan(tables["r"]) and "REBALANCE" not in plan(reports["r"](tables["r"]))
        sums = [t["r"].agg(F.sum("last_dt_flag"), F.count("*"), F.sum("obs_time")).first() for t in (plain, tables)]
        assert sums[0] == sums[1] and sums[1][1] == N and reports["r"](tables["r"]).count() == sums[1][0]
        assert _max_task_rows(tables["r"]) < N // 6
    finally:
        _restore(spark, old)
