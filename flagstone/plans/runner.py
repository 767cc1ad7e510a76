"""Run configured rules, in order, over a delivery (a dict of tables).

Each rule is a function ``(tables, rule_config, options) -> RuleOutput``; the
tables it returns feed the next rule. Everything stays lazy: the result holds
DataFrames (flagged tables, reports, summaries) whose plans Catalyst optimises
as a whole when a sink finally runs them. A rule named in the sequence but
absent from the registry or the rules config is skipped, with a warning.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cache, partial
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from ..functions.columns import (
    DEATH_DT_FLAG,
    DUP_FLAG,
    FLAG_DUPLICATION,
    FLAG_MISSING,
    FLAG_VALUES,
    LAST_DT_FLAG,
    MISSING_FLAG,
    NEGATIVE_FLAG,
    VALUE_FLAG,
    added_name,
)
from ..operators.cells import CellTest, cell_counts, counted_report, listed_report
from ..operators.dates import DateBoundSpec, can_merge, date_bound, date_bounds, unparsed_dates, unparsed_tests, without_limits
from ..operators.duplicates import flag_duplicates, flag_duplicates_first_key, report_from_flags
from ..operators.frequency import frequencies, frequency_of
from ..operators.missing import flag_missing, flag_missing_null_only, missing_by_column, missing_tests
from ..operators.numeric import (
    flag_negative,
    flag_non_numeric,
    flag_non_numeric_spark,
    negative_rows,
    offending_tests,
    offending_values,
    value_columns,
)
from ..operators.summary import flags_summary, observed_flags, summary_of_counts, union_all

log = logging.getLogger(__name__)

# Report names per rule.
DUP_REPORT = "qc_dup_{}"
MISSING_REPORT = "qc_missing"
VALUE_REPORT = "qc_value"
NEGATIVE_REPORT = "qc_negative_{}"
LAST_DT_REPORT = "qc_lastdt_{}"
DEATH_DT_REPORT = "qc_deathdt_{}"
UNPARSED_REPORT = "qc_unparsed_{}"
FREQUENCY_REPORT = "qc_freq_{}_{}"


@dataclass
class RunOptions:
    """Switches for the behaviours where the rule contract leaves a choice."""

    order_reports: bool = True  # sort duplicate reports by key
    blank_is_missing: bool = True  # white-space-only text counts as missing
    null_is_bad: bool = True  # a null numeric cell fails the numeric test
    keep_unmatched_anchor: bool = False  # date rules: add rows for anchor-only ids
    on_bad_date: str = "null"  # or "fail"
    # Set by run_rules: the input tables. Rules never change data columns
    # and keep the row count, so per-key statistics, anchors and data-column
    # reports are computed from these instead of re-running earlier rules.
    sources: Mapping[str, DataFrame] = field(default_factory=dict)
    # Optional: store an intermediate every table of a rule reuses (the date
    # rules' per-id anchor) and return the stored copy, so it is computed
    # once instead of once per table. Set by run_delivery.
    stage: Callable[[str, DataFrame], DataFrame] | None = None
    # Date rules leave the limits of flagged rows in the tables (marked as
    # appended), so that their reports join nothing. Set by run_delivery.
    keep_limits: bool = False


def _source(opts: RunOptions, name: str, current: DataFrame) -> DataFrame:
    return opts.sources.get(name, current)


class LazyFrames(Mapping):
    """Read-only mapping whose DataFrames are built on first access.

    Building a DataFrame costs driver round trips (analysis) but no data
    work; reports nobody reads are therefore never built at all.
    """

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame | None]] | None = None):
        self._makers = dict(makers or {})
        self._built: dict[str, DataFrame | None] = {}

    def __getitem__(self, key: str) -> DataFrame | None:
        if key not in self._built:
            self._built[key] = self._makers[key]()
        return self._built[key]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass
class RuleOutput:
    tables: dict[str, DataFrame]
    reports: dict[str, Callable[[], DataFrame | None]] = field(default_factory=dict)
    # (rule, table, flag column) for every flag a rule appended
    flags: list[tuple[str, str, str]] = field(default_factory=list)
    # reports that can be derived from the final flagged tables alone
    stored_reports: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = field(default_factory=dict)
    # reports on single cells: per table their tests, which one scan answers for all of them
    cell_tests: dict[str, dict[str, list[CellTest]]] = field(default_factory=dict)


@dataclass
class QcResult:
    tables: dict[str, DataFrame]
    reports: LazyFrames
    flags: list[tuple[str, str, str]]
    rules_run: list[str]
    stored_reports: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = field(default_factory=dict)
    # hit cells per table, staged, for all reports on single cells; empty without a stage
    cells: LazyFrames = field(default_factory=LazyFrames)

    def report(self, name: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame | None:
        """Report ``name``; with ``tables`` (stored copies of the flagged
        tables) reports that only need the flags read them instead of
        recomputing the rule."""
        if tables is not None and name in self.stored_reports:
            return self.stored_reports[name](tables)
        return self.reports[name]

    def summary(self, tables: Mapping[str, DataFrame] | None = None) -> DataFrame | None:
        """Summary rows ``(rule, tbl, total, count, percent)`` for every flag.

        Flags are never dropped and rules keep the row count, so each
        table's final flagged version answers for all its rules: one
        aggregate per table (reading only its flag columns when the table
        is stored), not one per rule. Pass ``tables`` to summarise stored
        copies of the flagged tables instead of recomputing them.
        """
        tables = self.tables if tables is None else tables
        return union_all(flags_summary(tables[name], name, pairs) for name, pairs in self._by_table().items())

    def _by_table(self) -> dict[str, list[tuple[str, str]]]:
        by_table: dict[str, list[tuple[str, str]]] = {}
        for rule, name, flag_col in self.flags:
            by_table.setdefault(name, []).append((rule, flag_col))
        return by_table

    def observed(self) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
        """The flagged tables, each counting its rows and flags while it is
        written, and the counts; :meth:`observed_summary` reads them afterwards.

        The counts are taken by the tasks that write, and of each partition only
        those of the task that counts as done: a task that is tried again, or
        twice at a time, counts once."""
        tables, counts = dict(self.tables), {}
        for name, pairs in self._by_table().items():
            tables[name], counts[name] = observed_flags(tables[name], [flag for _, flag in pairs])
        return tables, counts

    def observed_summary(self, spark: SparkSession, counts: Mapping[str, Mapping[str, int | None]]) -> DataFrame | None:
        """The summary from the counts of the written tables: no table is read again."""
        rows = []
        for name, pairs in self._by_table().items():
            found = counts[name]
            rows += [(rule, name, found["total"], found[f"s{i}"] or 0) for i, (rule, _) in enumerate(pairs)]
        return summary_of_counts(spark, rows) if rows else None


RuleFn = Callable[[dict[str, DataFrame], Any, RunOptions], RuleOutput]


def _duplication(dfs, cfg: Mapping[str, Sequence[str]], opts: RunOptions) -> RuleOutput:
    out = RuleOutput(dict(dfs))
    for name, keys in cfg.items():
        if name not in dfs:
            log.warning("duplication: table %s not in delivery, skipped", name)
            continue
        flagged = flag_duplicates(dfs[name], keys, source=opts.sources.get(name))
        out.tables[name] = flagged
        out.reports[DUP_REPORT.format(name)] = partial(_dup_report_from, name, keys, opts.order_reports, {name: flagged})
        out.stored_reports[DUP_REPORT.format(name)] = partial(_dup_report_from, name, keys, opts.order_reports)
        out.flags.append(("duplication", name, added_name(flagged, DUP_FLAG)))
    return out


def _dup_report_from(name: str, keys: Sequence[str], order: bool, tables: Mapping[str, DataFrame]) -> DataFrame:
    return report_from_flags(without_limits(tables[name]), keys, order=order)


def _missing(dfs, cfg: Mapping[str, Sequence[str]] | None, opts: RunOptions) -> RuleOutput:
    cfg = cfg or {}
    out = RuleOutput(dict(dfs))
    reports, tests = [], {}
    for name, df in dfs.items():
        cols = cfg.get(name) or None
        out.tables[name] = flag_missing(df, cols, opts.blank_is_missing)
        reports.append(partial(missing_by_column, _source(opts, name, df), name, cols, opts.blank_is_missing))
        out.flags.append(("missing", name, added_name(out.tables[name], MISSING_FLAG)))
        tests[name] = missing_tests(_source(opts, name, df), MISSING_REPORT, cols, opts.blank_is_missing)
    if reports:
        out.cell_tests[MISSING_REPORT] = tests
        out.reports[MISSING_REPORT] = lambda: union_all(make() for make in reports)
    return out


def _value_config(cfg) -> tuple[str, list[str] | None]:
    """``{"value": token, "tables": [...]}``, or the older plain table list
    (token fixed to ``value``). No ``tables`` means every table."""
    if isinstance(cfg, (list, tuple)):
        return "value", list(cfg)
    return cfg.get("value", "value"), (list(cfg["tables"]) if cfg.get("tables") else None)


def _string_tables(dfs, cfg, opts: RunOptions) -> RuleOutput:
    token, tables = _value_config(cfg)
    out = RuleOutput(dict(dfs))
    reports, tests = [], {}
    for name in tables or list(dfs):
        if name not in dfs:
            log.warning("string_tables: table %s not in delivery, skipped", name)
            continue
        df = dfs[name]
        if not value_columns(df, token):
            continue
        out.tables[name] = flag_non_numeric(df, token, null_is_bad=opts.null_is_bad)
        reports.append(partial(offending_values, _source(opts, name, df), name, token))
        out.flags.append(("string_tables", name, added_name(out.tables[name], VALUE_FLAG)))
        tests[name] = offending_tests(_source(opts, name, df), VALUE_REPORT, token)
    if reports:
        out.cell_tests[VALUE_REPORT] = tests
        out.reports[VALUE_REPORT] = lambda: union_all(make() for make in reports)
    return out


def _negative(dfs, cfg, opts: RunOptions) -> RuleOutput:
    token, tables = _value_config(cfg)
    out = RuleOutput(dict(dfs))
    for name in tables or list(dfs):
        if name not in dfs or not value_columns(dfs[name], token):
            continue
        out.reports[NEGATIVE_REPORT.format(name)] = partial(negative_rows, _source(opts, name, dfs[name]), token)
        out.tables[name] = flag_negative(dfs[name], token)
        out.flags.append(("negative", name, added_name(out.tables[name], NEGATIVE_FLAG)))
    return out


@dataclass(frozen=True)
class DateRule:
    """A rule that compares the dates of every table with a limit per id."""

    rule: str
    flag_col: str
    report_fmt: str

    def __call__(self, dfs, cfg, opts: RunOptions) -> RuleOutput:
        spec = DateBoundSpec.from_dict(cfg)
        tables, reports = date_bound(
            dfs,
            spec,
            self.flag_col,
            keep_unmatched_anchor=opts.keep_unmatched_anchor,
            on_bad=opts.on_bad_date,
            sources=opts.sources,
            stage=(lambda df: opts.stage(f"anchor_{self.rule}", df)) if opts.stage else None,
            keep_limits=opts.keep_limits,
        )
        return self.output(dfs, tables, reports, spec, opts)

    def output(self, dfs, tables, reports: Mapping[str, Callable[..., DataFrame]], spec: DateBoundSpec, opts: RunOptions) -> RuleOutput:
        out = RuleOutput(tables)
        for name, make in reports.items():
            out.reports[self.report_fmt.format(name)] = make
            out.stored_reports[self.report_fmt.format(name)] = partial(_date_report_from, name, make)
            out.flags.append((self.rule, name, added_name(tables[name], self.flag_col)))
        unparsed = {n: _source(opts, n, dfs[n]) for n in dict.fromkeys([*reports, spec.table])}
        report = UNPARSED_REPORT.format(self.rule)
        out.reports[report] = lambda: union_all(unparsed_dates(df, spec, n) for n, df in unparsed.items())
        out.cell_tests[report] = {n: unparsed_tests(df, report, spec, n) for n, df in unparsed.items()}
        return out


def merge_date_rules(steps: Sequence[tuple[str, RuleFn]], rules: Mapping[str, Any], dfs: Mapping[str, DataFrame], opts: RunOptions) -> list[list]:
    """The steps of a sequence, date rules that follow each other and share the id
    in one group: such a group needs one join per table."""
    groups: list[list] = []
    for rule, fn in steps:
        last = groups[-1] if groups else []
        if isinstance(fn, DateRule) and last and all(isinstance(f, DateRule) for _, f in last) and not opts.keep_unmatched_anchor:
            specs = [DateBoundSpec.from_dict(rules[r]) for r, _ in [*last, (rule, fn)]]
            if len({f.flag_col for _, f in [*last, (rule, fn)]}) > len(last) and can_merge(dfs, specs):
                last.append((rule, fn))
                continue
        groups.append([(rule, fn)])
    return groups


def _run_date_rules(group: Sequence[tuple[str, DateRule]], tables, rules: Mapping[str, Any], opts: RunOptions) -> list[RuleOutput]:
    specs = [DateBoundSpec.from_dict(rules[rule]) for rule, _ in group]
    name = f"anchor_{group[-1][0]}"  # holds the limits of the whole group
    out, makers = date_bounds(
        tables,
        [(spec, fn.flag_col) for spec, (_, fn) in zip(specs, group, strict=True)],
        on_bad=opts.on_bad_date,
        sources=opts.sources,
        stage=(lambda df: opts.stage(name, df)) if opts.stage else None,
        keep_limits=opts.keep_limits,
    )
    return [fn.output(tables, out, made, spec, opts) for (_, fn), made, spec in zip(group, makers, specs, strict=True)]


def _date_report_from(name: str, make: Callable[..., DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    return make(tables[name])


def _frequencies(name: str, source: DataFrame, groups: Mapping[str, Sequence[str]], opts: RunOptions) -> DataFrame:
    found = frequencies(source, groups)
    return opts.stage(f"frequency_{name}", found) if opts.stage else found


def _frequency(dfs, cfg: Mapping[str, Mapping[str, Sequence[str]]], opts: RunOptions) -> RuleOutput:
    """All labels of a table come from one pass over it (stored, in a delivery run)."""
    out = RuleOutput(dict(dfs))
    for name, groups in cfg.items():
        if name not in dfs or not groups:
            continue
        counted = cache(partial(_frequencies, name, _source(opts, name, dfs[name]), groups, opts))
        for label, cols in groups.items():
            out.reports[FREQUENCY_REPORT.format(name, label)] = (
                lambda counted=counted, cols=cols, name=name, label=label: frequency_of(counted(), cols, name, label)
            )
    return out


DEFAULT_RULES: dict[str, RuleFn] = {
    "duplication": _duplication,
    "missing": _missing,
    "string_tables": _string_tables,
    "negative": _negative,
    "last_dt": DateRule("last_dt", LAST_DT_FLAG, LAST_DT_REPORT),
    "death_dt": DateRule("death_dt", DEATH_DT_FLAG, DEATH_DT_REPORT),
    "frequency": _frequency,
}


def _spark_duplication(dfs, cfg: Mapping[str, Sequence[str]], opts: RunOptions) -> RuleOutput:
    out = RuleOutput(dict(dfs))
    for name, keys in cfg.items():
        if name in dfs:
            out.tables[name] = flag_duplicates_first_key(dfs[name], keys)
            out.flags.append(("duplication", name, added_name(out.tables[name], FLAG_DUPLICATION)))
    return out


def _spark_missing(dfs, cfg: Mapping[str, Sequence[str]] | None, opts: RunOptions) -> RuleOutput:
    out = RuleOutput(dict(dfs))
    for name, df in dfs.items():
        out.tables[name] = flag_missing_null_only(df, (cfg or {}).get(name) or None)
        out.flags.append(("missing", name, added_name(out.tables[name], FLAG_MISSING)))
    return out


def _spark_string_tables(dfs, cfg, opts: RunOptions) -> RuleOutput:
    token, tables = _value_config(cfg)
    out = RuleOutput(dict(dfs))
    for name in tables or list(dfs):
        if name in dfs and value_columns(dfs[name], token):
            out.tables[name] = flag_non_numeric_spark(dfs[name], token)
            out.flags.append(("string_tables", name, added_name(out.tables[name], FLAG_VALUES)))
    return out


# The older flavour of three rules; a vendor chooses it by ``"flavour": "spark"``.
SPARK_RULES: dict[str, RuleFn] = {
    "duplication": _spark_duplication,
    "missing": _spark_missing,
    "string_tables": _spark_string_tables,
}


def vendor_registry(vendor: Mapping[str, Any]) -> dict[str, RuleFn]:
    """The rules a vendor's configuration chooses (``flavour``: absent or ``spark``)."""
    flavour = vendor.get("flavour")
    if flavour not in (None, "", "default", "spark"):
        raise ValueError(f"unknown rule flavour {flavour!r}")
    return rule_registry(SPARK_RULES if flavour == "spark" else None)


def rule_registry(overrides: Mapping[str, RuleFn] | None = None) -> dict[str, RuleFn]:
    """The default rules, with per-run additions or replacements (the
    extension point for vendor-specific behaviour)."""
    reg = dict(DEFAULT_RULES)
    reg.update(overrides or {})
    return reg


def register_rule(name: str, fn: RuleFn) -> None:
    """Add or replace a rule for every later run in this process."""
    DEFAULT_RULES[name] = fn


def run_rules(
    dfs: Mapping[str, DataFrame],
    rules: Mapping[str, Any],
    sequence: Sequence[str],
    registry: Mapping[str, RuleFn] | None = None,
    options: RunOptions | None = None,
) -> QcResult:
    """Apply ``sequence`` of rules (configs in ``rules``) to ``dfs``."""
    reg = rule_registry() if registry is None else dict(registry)
    opts = replace(options or RunOptions())
    # Unmatched anchor ids add rows, after which inputs no longer stand in
    # for the current tables.
    opts.sources = {} if opts.keep_unmatched_anchor else dict(dfs)
    tables = dict(dfs)
    reports: dict[str, Callable[[], DataFrame | None]] = {}
    flags: list[tuple[str, str, str]] = []
    stored: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {}
    tests: dict[str, dict[str, list[CellTest]]] = {}
    steps = []
    for rule in sequence:
        fn = reg.get(rule)
        if fn is None:
            log.warning("unknown rule %s skipped", rule)
        elif rule not in rules:
            log.warning("rule %s has no configuration, skipped", rule)
        else:
            steps.append((rule, fn))
    for group in merge_date_rules(steps, rules, tables, opts):
        if len(group) > 1:
            results = _run_date_rules(group, tables, rules, opts)
        else:
            results = [fn(tables, rules[rule], opts) for rule, fn in group]
        for res in results:
            tables = res.tables
            reports.update(res.reports)
            tests = {k: v for k, v in tests.items() if k not in res.reports} | res.cell_tests
            flags.extend(res.flags)
            stored.update(res.stored_reports)
    ran = [rule for rule, _ in steps]
    cells = LazyFrames()
    if opts.stage and opts.sources:
        cells = _cells(opts, tests)
        reports.update({name: partial(_cell_report, cells, name, by_table) for name, by_table in tests.items()})
    return QcResult(tables, LazyFrames(reports), flags, ran, stored, cells)


def _cells(opts: RunOptions, tests: Mapping[str, Mapping[str, Sequence[CellTest]]]) -> LazyFrames:
    """Per table the hit cells of all its tests, staged when they are first read."""
    by_table: dict[str, list[CellTest]] = {}
    for of_report in tests.values():
        for name, found in of_report.items():
            by_table.setdefault(name, []).extend(found)
    return LazyFrames(
        {
            name: (lambda name=name, found=found: opts.stage(f"cells_{name}", cell_counts(opts.sources[name], found)))
            for name, found in by_table.items()
            if found
        }
    )


def _cell_report(cells: LazyFrames, report: str, by_table: Mapping[str, Sequence[CellTest]]) -> DataFrame | None:
    """One report of all its tables from their hit cells."""
    parts = []
    for name, tests in by_table.items():
        if tests and tests[0].listed:
            parts.append(listed_report(cells[name], report, name))
        elif tests:
            parts.append(counted_report(cells[name], report, name, [t.column for t in tests]))
    return union_all(parts)
