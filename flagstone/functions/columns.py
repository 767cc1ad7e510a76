"""Column-level building blocks shared by all rules.

Everything here returns a Spark ``Column`` (or works on a schema only), so the
rules built from it stay inside whole-stage codegen: no Python runs per row
and nothing is pulled to the driver except column names.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay as they are for results to match the rule contract)
# ---------------------------------------------------------------------------
# Flag / count columns appended by the rules.
DUP_COUNT = "dup_count"
DUP_FLAG = "dup_flag"
MISSING_FLAG = "missing_flag"
VALUE_FLAG = "value_flag"
NEGATIVE_FLAG = "negative_flag"
LAST_DT_FLAG = "last_dt_flag"
DEATH_DT_FLAG = "death_dt_flag"
# Names used by the older Spark flavour of the rules.
FLAG_DUPLICATION = "flag_duplication"
FLAG_MISSING = "flag_missing"
FLAG_VALUES = "flag_values"
# Column that carries the pass/fail result of a rule object.
RESULT = "result"
# A cell that holds only white space counts as missing (Unicode-aware \s).
BLANK_PATTERN = r"(?U)^\s*$"
# Non-negative decimal: digits with at most one dot, not a lone dot.
NONNEG_DECIMAL_PATTERN = r"^(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)$"
# Partial dates write an unknown day as UK; it is read as the 15th.
UNKNOWN_DAY_TOKEN = "UK"
UNKNOWN_DAY_VALUE = "15"
# Month names (three letters) in order, for dates such as 15-Feb-2018.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

# Two-digit years below this are of the years from 2000, the others of those from 1900.
PIVOT_YEAR = 69
# Longer text is no date.
LONGEST_DATE = 64

# Metadata key of the columns the engine itself appended. Names do not tell: a
# data column may well be called ``result`` or ``dup_count``.
ADDED = "flagstone_added"
# Suffix of an appended column whose name the data already uses.
CLASH_SUFFIX = "_qc"

_FLOATS = (T.FloatType, T.DoubleType)
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def col(name: str) -> Column:
    """Reference a column by its exact name (dots, spaces, hyphens allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_added(field: T.StructField) -> bool:
    """Whether the engine appended this column."""
    return bool((field.metadata or {}).get(ADDED))


def mark_added(df: DataFrame, *names: str) -> DataFrame:
    """Mark columns as appended by the engine (kept through later rules and in
    stored tables)."""
    for name in names:
        df = df.withMetadata(name, {ADDED: name})
    return df


def added_name(df: DataFrame, name: str) -> str:
    """Name under which the engine appends ``name`` to ``df``: an own earlier
    column is replaced, a data column is left and ``_qc`` put behind."""
    fields = {f.name: f for f in df.schema.fields}
    while name in fields and not is_added(fields[name]):
        name += CLASH_SUFFIX
    return name


def match_columns(
    df: DataFrame,
    contains: str | None = None,
    not_contains: str | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """Data columns whose name holds ``contains`` (case-sensitive), minus names
    holding ``not_contains``, minus ``exclude``; columns appended by earlier
    rules are skipped so that ``value_flag`` is not checked as a value."""
    drop = set(exclude or ())
    out = []
    for c in data_columns(df):
        if contains is not None and contains not in c:
            continue
        if (not_contains and not_contains in c) or c in drop:
            continue
        out.append(c)
    return out


def data_columns(df: DataFrame) -> list[str]:
    """All columns except those the engine appended."""
    return [f.name for f in df.schema.fields if not is_added(f)]


# Each test is built as SQL text and turned into a Column with one
# ``F.expr`` call: building it from ``F.col``/``&``/``cast`` pieces would
# cost one driver-to-JVM round trip per piece, which adds up to seconds of
# plan-building time for wide tables and rule sequences.


def ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(text: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_nan_sql(df: DataFrame, name: str) -> str:
    if isinstance(dtype_of(df, name), _FLOATS):
        return f"coalesce(isnan({ident(name)}), false)"
    return "false"


def is_missing_sql(df: DataFrame, name: str, blank_is_missing: bool = True) -> str:
    c = ident(name)
    dt = dtype_of(df, name)
    cond = f"{c} IS NULL"
    if isinstance(dt, _FLOATS):
        cond += f" OR isnan({c})"
    elif isinstance(dt, T.StringType) and blank_is_missing:
        cond += f" OR {c} RLIKE {sql_str(BLANK_PATTERN)}"
    return f"coalesce({cond}, true)"


def is_nonneg_decimal_sql(df: DataFrame, name: str) -> str:
    c = ident(name)
    dt = dtype_of(df, name)
    if isinstance(dt, T.StringType):
        test = f"{c} RLIKE {sql_str(NONNEG_DECIMAL_PATTERN)}"
    elif isinstance(dt, _FLOATS):
        test = f"{c} >= 0 AND NOT isnan({c}) AND {c} != CAST('Infinity' AS DOUBLE)"
    elif isinstance(dt, _NUMBERS):
        test = f"{c} >= 0"
    else:
        test = "false"
    return f"coalesce({test}, false)"


def to_number_sql(df: DataFrame, name: str) -> str:
    c = ident(name)
    dt = dtype_of(df, name)
    if isinstance(dt, T.StringType):
        v = f"try_cast({c} AS DOUBLE)"
    elif isinstance(dt, _NUMBERS):
        v = f"CAST({c} AS DOUBLE)"
    else:
        return "CAST(NULL AS DOUBLE)"
    return f"nanvl({v}, CAST(NULL AS DOUBLE))"


def _fail_if_unparsed(c: str, v: str, what: str, name: str, sql_type: str) -> str:
    """``v``, evaluated once; an error where the cell holds something and ``v`` is null."""
    blank = f"CAST({c} AS STRING) RLIKE {sql_str(BLANK_PATTERN)}"
    error = f"CAST(raise_error(concat({sql_str(f'bad {what} in {name}: ')}, CAST({c} AS STRING))) AS {sql_type})"
    return f"coalesce({v}, CASE WHEN {c} IS NOT NULL AND NOT {blank} THEN {error} END)"


_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)"
_ZONE = r"(?: ?(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?"
# 10:05 PM: what comes before, hour, rest of the time, half of the day
_HALF_DAY = r"^(.*?)(\d{1,2})(:\d{2}(?::\d{2}(?:\.\d+)?)?) ?([AaPp])\.?[Mm]\.?$"
# 20180215, with a time behind it or none; other text gives empty groups
_COMPACT = rf"^(?:(\d{{4}})(\d{{2}})(\d{{2}})(?:[T ]?(\d{{2}}):?(\d{{2}})(?::?(\d{{2}}(?:\.\d+)?))?)?{_ZONE}|.*)$"
_NAME = r"([a-z]{3})[a-z]{0,6}\.?"
_NTH = r"(\d{1,2})(?:st|nd|rd|th)?"
# Layouts that do not begin with the year, and those with month names
_NAMED = (
    r"(?i)^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*[.,]? +)?(?:"
    r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})"  # month 1, day 2, year 3
    rf"|{_NTH}[- /]?{_NAME}[-/, ]*(\d{{4}}|\d{{2}})"  # day 4, month 5, year 6
    rf"|{_NAME}[- ]+{_NTH},?[- ]+(\d{{4}})"  # month 7, day 8, year 9
    rf"|{_NAME}[-, ]+(\d{{4}})"  # month 10, year 11
    rf"|(\d{{4}})[- /]{_NAME}[- /](\d{{1,2}})"  # year 12, month 13, day 14
    rf")(?:[T ,]+{_CLOCK})?{_ZONE}$"  # time 15
)
# A control character parts them: split needs no pattern for it, and no cell holds it
_NAMED_PARTS = "$3$6$9$11$12\x01$1$5$7$10$13\x01$2$4$8$14\x01$15"


def clean_date_sql(text: str) -> str:
    """Text of a date without padding, its time (``10:05 PM``) by 24 hours."""
    t, half = f"trim({text})", sql_str(_HALF_DAY)
    hour, pm = f"CAST(regexp_extract({t}, {half}, 2) AS INT)", f"lower(regexp_extract({t}, {half}, 4)) = 'p'"
    hour = f"CASE WHEN {hour} > 12 THEN {hour} ELSE {hour} % 12 + CASE WHEN {pm} THEN 12 ELSE 0 END END"
    return (
        f"CASE WHEN right({t}, 1) IN ('m', 'M', '.') AND {t} RLIKE {half} "
        f"THEN concat(regexp_extract({t}, {half}, 1), {hour}, regexp_extract({t}, {half}, 3)) ELSE {t} END"
    )


def date_text_sql(text: str) -> str:
    """Text of a date, in any of the layouts a general date parser takes, as a
    timestamp without zone; null when it is none.

    Year first (``2018/2/5``, ``2018.02.05``, ``2018-02``, ``2018``, ``20180205``,
    ``20180205T101500``), ISO with ``T``, fraction and zone (the wall clock
    counts, the zone is dropped), month first (``02/15/2018``; day first where
    the month would be above 12), month names (``15-Feb-2018``, ``Feb 15, 2018``,
    ``Thu Feb 15 2018``; ``Feb 2018`` is its first day), two-digit years after a
    month (``15-FEB-18``, ``02/15/18``; below :data:`PIVOT_YEAR` of this century,
    else of the last), each with a time (``10:05``, ``10:05:30.5``, ``10:05 PM``)
    or none.

    The shape of a cell, its first characters with every digit as ``9``, says
    which layout it may have. A cell is brought to ISO by at most one pattern and
    parsed once."""
    return _parse_clean_sql(clean_date_sql(text))


def _parse_clean_sql(u: str) -> str:
    """What :func:`clean_date_sql` gives, as a timestamp without zone."""
    shape = f"translate(substr({u}, 1, 8), '012345678', '999999999')"
    year_first = f"concat(translate(substr({u}, 1, 10), '/.', '--'), substr({u}, 11))"
    compact = f"rtrim(': ', regexp_replace({u}, {sql_str(_COMPACT)}, '$1-$2-$3 $4:$5:$6'))"
    year = f"concat(CASE WHEN length(r[0]) > 2 THEN '' WHEN r[0] < '{PIVOT_YEAR}' THEN '20' ELSE '19' END, r[0])"
    place = f"locate(lower(r[1]), {sql_str(MONTHS)})"
    other = (
        f"transform(array(split(regexp_replace({u}, {sql_str(_NAMED)}, {sql_str(_NAMED_PARTS)}), '\x01')), r -> CASE "
        "WHEN size(r) != 4 THEN NULL "
        # compared as text: a failing cast costs more than all the rest
        f"WHEN r[1] < 'A' AND length(r[1]) = 2 AND r[1] > '12' THEN concat_ws('-', {year}, r[2], concat(r[1], ' ', r[3])) "
        f"WHEN r[1] < 'A' THEN concat_ws('-', {year}, r[1], concat(r[2], ' ', r[3])) "
        f"WHEN {place} % 3 = 1 THEN concat_ws('-', {year}, CAST(({place} + 2) DIV 3 AS STRING), "
        "concat(CASE WHEN r[2] = '' THEN '1' ELSE r[2] END, ' ', r[3])) END)[0]"
    )
    return (
        f"try_cast(CASE WHEN {shape} RLIKE '^9999[-/.]9' OR {shape} = '9999' THEN {year_first} "
        f"WHEN {shape} = '99999999' THEN {compact} WHEN length({u}) <= {LONGEST_DATE} THEN {other} END AS TIMESTAMP_NTZ)"
    )


def date_number_sql(c: str) -> str:
    """A number that is written like a date (``20180215``, ``20180215.0``) as a timestamp."""
    n = f"CAST({c} AS BIGINT)"
    parts = f"CAST({n} DIV 10000 AS INT), CAST({n} DIV 100 % 100 AS INT), CAST({n} % 100 AS INT), 0, 0, 0"
    return f"CASE WHEN {c} BETWEEN 10000101 AND 99991231 AND {c} = floor({c}) THEN try_make_timestamp_ntz({parts}) END"


def _known_day_sql(c: str) -> str:
    return f"replace({c}, {sql_str(UNKNOWN_DAY_TOKEN)}, {sql_str(UNKNOWN_DAY_VALUE)})"


def with_clean_dates(df: DataFrame, names: Sequence[str], dt_type: str = "datetime") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with a column of cleaned text for every text column of ``names``, and
    their names: :func:`to_time_value_sql` then reads each cell once."""
    clean = {n: f"__dq_clean{i}" for i, n in enumerate(names) if dt_type != "float" and isinstance(dtype_of(df, n), T.StringType)}
    if not clean:
        return df, clean
    added = [f"{clean_date_sql(_known_day_sql(ident(n)))} AS {c}" for n, c in clean.items()]
    return df.selectExpr(*[ident(c) for c in df.columns], *added), clean


def to_time_value_sql(
    df: DataFrame, name: str, dt_type: str = "datetime", on_bad: str = "null", clean: Mapping[str, str] | None = None
) -> str:
    """A cell as a timestamp without zone (or a double) in SQL; ``clean`` as
    :func:`with_clean_dates` gives it."""
    c = ident(name)
    dt = dtype_of(df, name)
    text = _known_day_sql(c)
    what, v = "date", "CAST(NULL AS TIMESTAMP_NTZ)"
    if dt_type == "float":
        what, v = "number", "CAST(NULL AS DOUBLE)"
        if isinstance(dt, T.StringType):
            v = f"try_cast({text} AS DOUBLE)"
        elif isinstance(dt, _NUMBERS):
            return f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))"
    elif isinstance(dt, T.TimestampNTZType):
        return c
    elif isinstance(dt, (T.DateType, T.TimestampType)):
        return f"CAST({c} AS TIMESTAMP_NTZ)"
    elif isinstance(dt, T.StringType):
        v = _parse_clean_sql(clean[name]) if clean and name in clean else date_text_sql(text)
    elif isinstance(dt, _NUMBERS):
        # what type inference makes of yyyyMMdd
        v = date_number_sql(c)
        if on_bad == "fail" and isinstance(dt, _FLOATS):
            c = f"nanvl({c}, NULL)"
    if on_bad == "fail":
        v = _fail_if_unparsed(c, v, what, name, "DOUBLE" if dt_type == "float" else "TIMESTAMP_NTZ")
    return f"nanvl({v}, CAST(NULL AS DOUBLE))" if dt_type == "float" else v


def unparsed_sql(df: DataFrame, name: str, dt_type: str = "datetime", clean: Mapping[str, str] | None = None) -> str:
    """True where the cell holds something that does not read as a date (or number)."""
    c = ident(name)
    blank = f"CAST({c} AS STRING) RLIKE {sql_str(BLANK_PATTERN)}"
    return f"({c} IS NOT NULL AND NOT {is_nan_sql(df, name)} AND NOT {blank} AND ({to_time_value_sql(df, name, dt_type, clean=clean)}) IS NULL)"


def any_sql(conditions: Sequence[str]) -> str:
    """Row-wise OR of SQL conditions; null counts as false; empty → false."""
    if not conditions:
        return "false"
    return " OR ".join(f"coalesce({c}, false)" for c in conditions)


def flag_sql(condition: str) -> str:
    """0/1 integer flag from a SQL condition (null → 0)."""
    return f"CAST(CASE WHEN coalesce({condition}, false) THEN 1 ELSE 0 END AS INT)"


def is_missing(df: DataFrame, name: str, blank_is_missing: bool = True) -> Column:
    """True when the cell is null, NaN (floats) or, for strings and if
    ``blank_is_missing``, only white space. Never null itself."""
    return F.expr(is_missing_sql(df, name, blank_is_missing))


def is_nonneg_decimal(df: DataFrame, name: str) -> Column:
    """The non-negative decimal test, never null (a null cell is False).

    Strings must be digits with at most one dot and no sign, exponent or
    blanks. Numbers pass when they are >= 0, finite and not NaN; other types
    fail because their text form is not a plain number.
    """
    return F.expr(is_nonneg_decimal_sql(df, name))


def with_row_id(df: DataFrame, name: str = "columnindex") -> DataFrame:
    """Append a unique (not consecutive) 64-bit row id, computed inside each
    task with no shuffle. Ids depend on the input partitioning, so they are
    stable for a given file layout, not across differently split reads."""
    return df.withColumn(name, F.monotonically_increasing_id())
