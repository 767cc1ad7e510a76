"""Date-bound rules: no date of an entity may come after its limit date
(last contact, death).

The limit ("anchor") comes from one table: ``min`` of the limit date per
entity id, computed with a partially aggregated group-by. Taking the minimum
is exactly "any anchor of this id is before the date", so several anchors per
id flag the same rows without multiplying them. Every checked table is then
left-joined to that per-id anchor on the id alone, and the inequality is a
plain expression over the joined row. The anchor side has one row per id;
adaptive execution can split the partition of an id that holds a third of the
rows (see :mod:`flagstone.operators.skew`) and still broadcasts the anchor
when its measured size is small.

Text that reads as no date makes no flag; :func:`unparsed_dates` lists it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    DEATH_DT_FLAG,
    LAST_DT_FLAG,
    added_name,
    any_sql,
    flag_sql,
    ident,
    is_added,
    mark_added,
    match_columns,
    sql_str,
    to_time_value_sql,
    unparsed_sql,
    with_clean_dates,
)
from .cells import CellTest
from .skew import key_counts, keyed_join

log = logging.getLogger(__name__)

ANCHOR = "__dq_anchor"
ANCHOR_ID = "__dq_anchor_id"
# Followed by the name of a flag: the limit that the flagged rows were compared with.
LIMIT = "__dq_limit_"


@dataclass(frozen=True)
class DateBoundSpec:
    """Which table/column holds the limit date, the entity id, which columns
    are dates (name holds ``dt_value``, not ``ignore_value``, not in
    ``ignorecols``), and whether dates are calendar (``datetime``) or
    relative numbers (``float``)."""

    table: str
    dt_column: str
    id_column: str
    dt_value: str
    dt_type: str = "datetime"
    ignore_value: str | None = None
    ignorecols: tuple[str, ...] = field(default_factory=tuple)

    @classmethod
    def from_dict(cls, d: Mapping) -> DateBoundSpec:
        for k in ("table", "dt_column", "id_column", "dt_value"):
            if k not in d:
                raise ValueError(f"date rule config needs '{k}'")
        dt_type = d.get("dt_type") or "datetime"
        if dt_type not in ("datetime", "float"):
            raise ValueError(f"dt_type must be 'datetime' or 'float', got {dt_type!r}")
        return cls(
            table=d["table"],
            dt_column=d["dt_column"],
            id_column=d["id_column"],
            dt_value=d["dt_value"],
            dt_type=dt_type,
            ignore_value=d.get("ignore_value") or None,
            ignorecols=tuple(d.get("ignorecols") or ()),
        )


def compared_columns(df: DataFrame, spec: DateBoundSpec) -> list[str]:
    """Date columns of ``df`` compared with the anchor (schema only)."""
    return match_columns(
        df,
        contains=spec.dt_value,
        not_contains=spec.ignore_value,
        exclude=[spec.dt_column, *spec.ignorecols],
    )


def anchor_dates(anchor_table: DataFrame, spec: DateBoundSpec, on_bad: str = "null") -> DataFrame:
    """``(id, limit)`` with one row per id: the earliest limit date."""
    for c in (spec.id_column, spec.dt_column):
        if c not in anchor_table.columns:
            raise ValueError(f"anchor table {spec.table!r} has no column {c!r}")
    rows, clean = with_clean_dates(anchor_table, [spec.dt_column], spec.dt_type)
    value = to_time_value_sql(anchor_table, spec.dt_column, spec.dt_type, on_bad, clean)
    return (
        rows.selectExpr(f"{ident(spec.id_column)} AS {ANCHOR_ID}", f"{value} AS {ANCHOR}")
        .groupBy(ANCHOR_ID)
        .agg(F.expr(f"min({ANCHOR}) AS {ANCHOR}"))
    )


def _untouched(df: DataFrame, spec: DateBoundSpec, name: str) -> bool:
    """Whether the rule does not apply to ``df``; date columns without the id
    column are worth a warning."""
    cols = compared_columns(df, spec)
    if cols and spec.id_column not in df.columns:
        log.warning("table %s has date columns %s but no id column %r: not checked", name, cols, spec.id_column)
        return True
    return not cols


def limit_columns(df: DataFrame) -> list[str]:
    """The limits that a date rule has left beside its flag."""
    return [f.name for f in df.schema.fields if is_added(f) and f.name.startswith(LIMIT)]


def without_limits(df: DataFrame) -> DataFrame:
    """``df`` without them."""
    held = limit_columns(df)
    return df.drop(*held) if held else df


def _with_limits(joined: DataFrame, limits: Mapping[str, str]) -> DataFrame:
    """``joined``, and for each ``{limit: flag}`` the limit of the rows that the flag
    marks, null in all others, in place of the limit; reports on the flagged rows
    need no other join then."""
    found = {LIMIT + flag: f"CASE WHEN {ident(flag)} = 1 THEN {ident(limit)} END" for limit, flag in limits.items()}
    own = [c for c in joined.columns if c not in limits and c not in found]
    return mark_added(joined.selectExpr(*[ident(c) for c in own], *[f"{e} AS {ident(c)}" for c, e in found.items()]), *found)


def join_anchor(
    df: DataFrame,
    anchor: DataFrame,
    spec: DateBoundSpec,
    flag_col: str,
    keep_unmatched_anchor: bool = False,
    on_bad: str = "null",
    source: DataFrame | None = None,
    name: str = "",
    stored_anchor: bool = False,
) -> DataFrame | None:
    """Rows of ``df`` with the anchor (column ``__dq_anchor``) and the flag.

    None when ``df`` has no compared date column or no id column: such a
    table is left untouched. With ``keep_unmatched_anchor`` one row (nulls,
    id set, flag 0) is added per anchor id that the table lacks, as a full
    outer join would.
    """
    if _untouched(df, spec, name):
        return None
    cols = compared_columns(df, spec)
    flag = added_name(df, flag_col)
    base = [c for c in df.columns if c != flag]
    joined = keyed_join(df.select(*[ident(c) for c in base]), anchor, [spec.id_column], [ANCHOR_ID], "left", side_out=[ANCHOR], side_stored=stored_anchor)
    joined, clean = with_clean_dates(joined, cols, spec.dt_type)
    values = [to_time_value_sql(df, c, spec.dt_type, on_bad, clean) for c in cols]
    cond = any_sql([f"{ANCHOR} < ({v})" for v in values])
    out = mark_added(joined.selectExpr(*[ident(c) for c in base], ANCHOR, f"{flag_sql(cond)} AS {ident(flag)}"), flag)
    if not keep_unmatched_anchor:
        return out
    # Anchor ids the table lacks, as extra rows. Written as an anti-join
    # against the table's distinct ids (pre-aggregated, so a hot id is one
    # row per task) instead of a full outer join, whose skewed partitions
    # adaptive execution cannot split.
    stats = df if source is None else source
    ids = key_counts(stats, [spec.id_column], "__dq_rows", null_keys=False).selectExpr(
        f"{ident(spec.id_column)} AS __dq_seen"
    )
    extra = keyed_join(anchor, ids, [ANCHOR_ID], ["__dq_seen"], "left_anti")
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    extra_rows = extra.selectExpr(
        *[f"CAST({ANCHOR_ID if c == spec.id_column else 'NULL'} AS {fields[c]}) AS {ident(c)}" for c in base],
        ANCHOR,
        f"CAST(0 AS INT) AS {ident(flag)}",
    )
    return mark_added(out.unionByName(extra_rows), flag)


def anchored_report(flagged: DataFrame, anchor: DataFrame, spec: DateBoundSpec, flag_col: str, stored_anchor: bool = False) -> DataFrame:
    """The violating rows of a flagged table with the limit date under the name
    of the limit column (replacing the table's own column of that name) and the
    flag. A table that has kept its limits is only filtered. Else rows with flag 1 are
    joined; on a stored table nothing else is computed again."""
    flag = added_name(flagged, flag_col)
    held = limit_columns(flagged)
    own = [c for c in flagged.columns if c not in (spec.dt_column, flag, *held)]
    rows = flagged.where(f"{ident(flag)} = 1")
    if LIMIT + flag in held:
        return rows.selectExpr(*[ident(c) for c in own], f"{ident(LIMIT + flag)} AS {ident(spec.dt_column)}", ident(flag))
    joined = keyed_join(rows, anchor, [spec.id_column], [ANCHOR_ID], "left", side_out=[ANCHOR], side_stored=stored_anchor)
    return joined.selectExpr(*[ident(c) for c in own], f"{ANCHOR} AS {ident(spec.dt_column)}", ident(flag))


def _read_columns(df: DataFrame, spec: DateBoundSpec, table: str) -> list[str]:
    """Compared columns, and the limit column of its table."""
    limit = [spec.dt_column] if table == spec.table and spec.dt_column in df.columns else []
    return [*compared_columns(df, spec), *limit]


def unparsed_tests(df: DataFrame, report: str, spec: DateBoundSpec, table: str) -> list[CellTest]:
    """The cells that :func:`unparsed_dates` lists."""
    return [CellTest(report, c, dt_type=spec.dt_type) for c in dict.fromkeys(_read_columns(df, spec, table))]


def unparsed_dates(df: DataFrame, spec: DateBoundSpec, table: str) -> DataFrame | None:
    """Report ``(tbl, column, value)``: the distinct cells of compared columns
    (and of the limit column) that hold something but read as no date, as
    text. None when the table has no such column."""
    cols = _read_columns(df, spec, table)
    if not cols:
        return None
    # parsed in a projection of their own, which is compiled; a generator's input is not
    rows, clean = with_clean_dates(df, cols, spec.dt_type)
    found = rows.selectExpr(
        *[f"CASE WHEN {unparsed_sql(df, c, spec.dt_type, clean)} THEN CAST({ident(c)} AS STRING) END AS __dq_v{i}" for i, c in enumerate(cols)]
    )
    cells = ", ".join(f"struct({sql_str(c)} AS column, __dq_v{i} AS value)" for i, c in enumerate(cols))
    found = found.selectExpr(f"inline(array({cells}))").where("value IS NOT NULL")
    return found.selectExpr(f"{sql_str(table)} AS tbl", "column", "value").distinct()


def flag_date_bound(
    df: DataFrame,
    anchor: DataFrame,
    spec: DateBoundSpec,
    flag_col: str = LAST_DT_FLAG,
    keep_unmatched_anchor: bool = False,
    on_bad: str = "null",
    source: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``(flagged, report)`` for one table: all columns of ``df`` (unchanged) +
    flag, and the rows of :func:`anchored_report`."""
    joined = join_anchor(df, anchor, spec, flag_col, keep_unmatched_anchor, on_bad, source)
    if joined is None:
        return df, None
    return joined.drop(ANCHOR), _report_of(joined, spec, flag_col)


def _report_of(joined: DataFrame, spec: DateBoundSpec, flag_col: str) -> DataFrame:
    flag = added_name(joined, flag_col)
    own = [c for c in joined.columns if c not in (spec.dt_column, flag, ANCHOR, *limit_columns(joined))]
    return joined.where(f"{ident(flag)} = 1").selectExpr(*[ident(c) for c in own], f"{ANCHOR} AS {ident(spec.dt_column)}", ident(flag))


def date_bound(
    dfs: Mapping[str, DataFrame],
    spec: DateBoundSpec | Mapping,
    flag_col: str = LAST_DT_FLAG,
    keep_unmatched_anchor: bool = False,
    on_bad: str = "null",
    tables: Sequence[str] | None = None,
    sources: Mapping[str, DataFrame] | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    keep_limits: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, Callable[..., DataFrame]]]:
    """Apply the rule to every table of ``dfs`` (or ``tables``).

    ``sources`` may hold, per table, a copy with the same rows and data
    columns (the input before earlier rules added flags); the anchor is then
    computed from it. ``stage`` stores the anchor and returns the stored copy. ``keep_limits``
    leaves the limits of flagged rows in the tables (:func:`without_limits` takes them out). Returns the new table dict and ``{table: make_report}``
    for tables that have compared columns; ``make_report(stored)`` reads a
    stored copy of the flagged table instead of joining the whole table again.
    """
    sources = sources or {}
    if not isinstance(spec, DateBoundSpec):
        spec = DateBoundSpec.from_dict(spec)
    if spec.table not in dfs:
        raise ValueError(f"anchor table {spec.table!r} not in the delivery")
    anchor = anchor_dates(sources.get(spec.table, dfs[spec.table]), spec, on_bad)
    if stage is not None:
        anchor = stage(anchor)
    out = dict(dfs)
    makers = {}

    def maker(joined: DataFrame) -> Callable[..., DataFrame]:
        def make(stored: DataFrame | None = None) -> DataFrame:
            return _report_of(joined, spec, flag_col) if stored is None else anchored_report(stored, anchor, spec, flag_col, stage is not None)

        return make

    for name in tables or list(dfs):
        joined = join_anchor(dfs[name], anchor, spec, flag_col, keep_unmatched_anchor, on_bad, sources.get(name), name, stage is not None)
        if joined is not None:
            out[name] = _with_limits(joined, {ANCHOR: added_name(joined, flag_col)}) if keep_limits else joined.drop(ANCHOR)
            makers[name] = maker(joined)
    return out, makers


def merged_anchors(parts: Sequence[tuple[DataFrame, DateBoundSpec]], on_bad: str = "null") -> DataFrame:
    """``(id, limit 0, limit 1, …)`` with one row per id that any anchor table
    holds: the earliest limit of each, from one aggregate over all of them."""
    rows = []
    for i, (table, spec) in enumerate(parts):
        limits = anchor_dates(table, spec, on_bad)
        type_ = limits.schema[ANCHOR].dataType.simpleString()
        rows.append((limits, i, type_))
    types = [t for _, _, t in rows]
    wide = [
        limits.selectExpr(ANCHOR_ID, *[f"{ANCHOR} AS {ANCHOR}{j}" if j == i else f"CAST(NULL AS {t}) AS {ANCHOR}{j}" for j, t in enumerate(types)])
        for limits, i, _ in rows
    ]
    return reduce(DataFrame.unionAll, wide).groupBy(ANCHOR_ID).agg(*[F.expr(f"min({ANCHOR}{j}) AS {ANCHOR}{j}") for j in range(len(types))])


def can_merge(dfs: Mapping[str, DataFrame], specs: Sequence[DateBoundSpec]) -> bool:
    """Whether one side table can serve all limits: they share the name and the type of the id."""
    tables = [(dfs.get(s.table), s) for s in specs]
    if len(specs) < 2 or any(t is None or s.id_column not in t.columns for t, s in tables):
        return False
    return len({(s.id_column, t.schema[s.id_column].dataType.simpleString()) for t, s in tables}) == 1


def date_bounds(
    dfs: Mapping[str, DataFrame],
    bounds: Sequence[tuple[DateBoundSpec, str]],
    on_bad: str = "null",
    sources: Mapping[str, DataFrame] | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    keep_limits: bool = False,
) -> tuple[dict[str, DataFrame], list[dict[str, Callable[..., DataFrame]]]]:
    """Several ``(spec, flag)`` at once (see :func:`can_merge`): every table is
    joined once, to the merged limits, instead of once per rule. Flags and
    reports are those of :func:`date_bound`, applied one after the other."""
    sources = sources or {}
    side = merged_anchors([(sources.get(s.table, dfs[s.table]), s) for s, _ in bounds], on_bad)
    if stage is not None:
        side = stage(side)
    out, makers = dict(dfs), [{} for _ in bounds]

    def maker(joined: DataFrame, i: int) -> Callable[..., DataFrame]:
        spec, flag_col = bounds[i]
        others = [f"{ANCHOR}{j}" for j in range(len(bounds))]

        def make(stored: DataFrame | None = None) -> DataFrame:
            if stored is None:
                return _report_of(joined.withColumn(ANCHOR, F.col(f"{ANCHOR}{i}")).drop(*others), spec, flag_col)
            return anchored_report(stored, side.selectExpr(ANCHOR_ID, f"{ANCHOR}{i} AS {ANCHOR}"), spec, flag_col, stage is not None)

        return make

    for name, df in dfs.items():
        used = [i for i, (spec, _) in enumerate(bounds) if not _untouched(df, spec, name)]
        if not used:
            continue
        joined = keyed_join(df, side, [bounds[0][0].id_column], [ANCHOR_ID], "left", side_out=[f"{ANCHOR}{i}" for i in used], side_stored=stage is not None)
        for i in used:
            spec, flag_col = bounds[i]
            cols, flag = compared_columns(df, spec), added_name(joined, flag_col)
            base = [c for c in joined.columns if c != flag]
            parsed, clean = with_clean_dates(joined, cols, spec.dt_type)
            cond = any_sql([f"{ANCHOR}{i} < ({to_time_value_sql(df, c, spec.dt_type, on_bad, clean)})" for c in cols])
            joined = mark_added(parsed.selectExpr(*[ident(c) for c in base], f"{flag_sql(cond)} AS {ident(flag)}"), flag)
        limits = [f"{ANCHOR}{i}" for i in used]
        own = [c for c in joined.columns if c not in limits]
        # the limits follow the columns, as reports take them from there
        joined = joined.select(*[F.col(ident(c)) for c in own], *limits)
        out[name] = _with_limits(joined, {f"{ANCHOR}{i}": added_name(joined, bounds[i][1]) for i in used}) if keep_limits else joined.drop(*limits)
        for i in used:
            makers[i][name] = maker(joined, i)
    return out, makers


def last_date(dfs, spec, **kw):
    """Dates after the last-contact date: flag ``last_dt_flag``."""
    return date_bound(dfs, spec, LAST_DT_FLAG, **kw)


def death_date(dfs, spec, **kw):
    """Dates after the death date: flag ``death_dt_flag``."""
    return date_bound(dfs, spec, DEATH_DT_FLAG, **kw)
