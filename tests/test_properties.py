"""Random small tables vs. brute force, with broadcast and with shuffled, split joins."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flagstone.operators import flag_duplicates, flag_duplicates_first_key, mappable_id, unique_key

ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])), min_size=0, max_size=30
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.too_slow])


def _df(spark, rows):
    return spark.createDataFrame([(i, k1, k2) for i, (k1, k2) in enumerate(rows)], "rid int, k1 int, k2 string")


def _by_rid(df, *cols):
    return {r.rid: tuple(r[c] for c in cols) for r in df.collect()}


FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1",
}


def _forced(spark, hot):
    """Shuffle joins with every partition split, unless ``hot`` is large."""
    if hot < 1_000_000:
        for k, v in FORCED.items():
            spark.conf.set(k, v)


def _restore(spark):
    for k in FORCED:
        spark.conf.unset(k)


@SETTINGS
@given(rows=ROWS, hot=st.sampled_from([1, 2, 1_000_000]))
def test_duplicates_match_brute_force(spark, rows, hot):
    _forced(spark, hot)
    try:
        df = _df(spark, rows)
        sizes = Counter(r for r in rows if None not in r)
        want = {}
        for i, r in enumerate(rows):
            n = sizes[r] if None not in r and sizes[r] >= 2 else 0
            want[i] = (n, 1 if n else 0)
        assert _by_rid(flag_duplicates(df, ["k1", "k2"]), "dup_count", "dup_flag") == want
        assert _by_rid(unique_key(df, ["k1", "k2"]), "result") == {i: (w[1] == 0,) for i, w in want.items()}
        # text key
        text = flag_duplicates(df, ["k2"])
        tsizes = Counter(r[1] for r in rows if r[1] is not None)
        assert _by_rid(text, "dup_count") == {
            i: (tsizes[r[1]] if r[1] is not None and tsizes[r[1]] >= 2 else 0,) for i, r in enumerate(rows)
        }
    finally:
        _restore(spark)


@SETTINGS
@given(rows=ROWS, hot=st.sampled_from([1, 2]))
def test_first_key_variant_matches_brute_force(spark, rows, hot):
    _forced(spark, hot)
    try:
        df = _df(spark, rows)
        # key groups include null keys here; a group counts its non-null first keys
        nonnull_first = Counter(r for r in rows if r[0] is not None)
        want = {i: (1 if r[0] is not None and nonnull_first[r] > 1 else 0,) for i, r in enumerate(rows)}
        assert _by_rid(flag_duplicates_first_key(df, ["k1", "k2"]), "flag_duplication") == want
    finally:
        _restore(spark)


@SETTINGS
@given(rows=ROWS, sup=st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=6), hot=st.sampled_from([1, 1_000_000]))
def test_mappable_id_matches_brute_force(spark, rows, sup, hot):
    _forced(spark, hot)
    try:
        df = _df(spark, rows)
        superset = spark.createDataFrame([(k,) for k in sup], "k1 int")
        keys = set(sup)
        want = {i: (r[0] in keys,) for i, r in enumerate(rows)}  # None matches None (null-safe)
        assert _by_rid(mappable_id(df, superset, "k1"), "result") == want
        strict = {i: (r[0] is not None and r[0] in keys,) for i, r in enumerate(rows)}
        assert _by_rid(mappable_id(df, superset, "k1", null_safe=False), "result") == strict
    finally:
        _restore(spark)


DATE_TEXT = st.one_of(
    st.none(),
    st.just("garbage"),
    st.builds(
        lambda y, m, d: f"{y}/{m:02d}/{d}",
        st.integers(2017, 2019),
        st.integers(1, 12),
        st.one_of(st.just("UK"), st.integers(1, 28).map(lambda d: f"{d:02d}")),
    ),
)


def _parse(text):
    import datetime

    if text is None or text == "garbage":
        return None
    return datetime.datetime.strptime(text.replace("UK", "15"), "%Y/%m/%d")


@SETTINGS
@given(
    anchors=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), DATE_TEXT), max_size=8),
    rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), DATE_TEXT, DATE_TEXT), max_size=20),
    hot=st.sampled_from([1, 1_000_000]),
)
def test_date_bound_matches_brute_force(spark, anchors, rows, hot):
    from flagstone.operators.dates import DateBoundSpec, last_date

    _forced(spark, hot)
    try:
        a = spark.createDataFrame(anchors, "pid int, LASTDAT string")
        r = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "rid int, pid int, VISDAT string, LABDAT string")
        tables, _ = last_date({"a": a, "r": r}, DateBoundSpec("a", "LASTDAT", "pid", "DAT"))
        limit = {}
        for pid, text in anchors:
            d = _parse(text)
            if pid is not None and d is not None:
                limit[pid] = min(limit.get(pid, d), d)
        want = {}
        for i, (pid, v1, v2) in enumerate(rows):
            lim = limit.get(pid) if pid is not None else None
            dates = [d for d in (_parse(v1), _parse(v2)) if d is not None]
            want[i] = (1 if lim is not None and any(lim < d for d in dates) else 0,)
        assert _by_rid(tables["r"], "last_dt_flag") == want
    finally:
        _restore(spark)
