"""The rules and their reports, as lazy DataFrame transformations."""

from .cells import CellTest, cell_counts, counted_report, listed_report  # noqa: F401
from .dates import DateBoundSpec, anchor_dates, date_bound, death_date, flag_date_bound, last_date  # noqa: F401
from .duplicates import (  # noqa: F401
    duplicate_groups,
    duplicate_report,
    flag_duplicates,
    flag_duplicates_first_key,
    report_from_flags,
    unique_key,
)
from .frequency import frequency  # noqa: F401
from .membership import mappable_id, unmapped_rows  # noqa: F401
from .missing import flag_missing, flag_missing_null_only, missing_by_column  # noqa: F401
from .numeric import flag_negative, flag_non_numeric, flag_non_numeric_spark, negative_rows, offending_values  # noqa: F401
from .rule import MappableIdRule, Rule, UniqueKeyRule  # noqa: F401
from .summary import flag_summary, flags_summary, result_events, union_all  # noqa: F401
