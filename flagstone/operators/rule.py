"""Rule objects: a named check whose result is the input rows plus a boolean
``result`` column (True = the record passes), with messages and events.

``result`` is a lazy DataFrame; :meth:`Rule.passed` is the only method that
runs a job, and it stops at the first failing row.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions.columns import ident
from .duplicates import unique_key
from .membership import mappable_id
from .summary import result_column, result_events


class Rule(ABC):
    """Base of all rule objects. Subclasses set :attr:`rule_name` and
    implement :meth:`validate`."""

    rule_name: str = "rule"

    def __init__(self, data, config):
        self.data = data
        self.config = config
        self.validation_result: DataFrame = self.validate()

    @abstractmethod
    def validate(self) -> DataFrame:
        """Input rows plus boolean ``result``."""

    def success_message(self, record_name: str) -> str:
        return f"{record_name}: {self.rule_name} holds"

    def fail_message(self, record_name: str) -> str:
        return f"{record_name}: {self.rule_name} is violated"

    def failures(self) -> DataFrame:
        return self.validation_result.where(f"NOT {ident(result_column(self.validation_result))}")

    def passed(self) -> bool:
        """True when no record fails (one short job)."""
        return self.failures().isEmpty()

    def result_message(self, record_name: str) -> str:
        return self.success_message(record_name) if self.passed() else self.fail_message(record_name)

    def result_to_events(self, dag_name: str, dag_run_id: str) -> DataFrame:
        """Event rows ``(dag_name, dag_run_id, event_type, event_data)``,
        one per failing record."""
        return result_events(self.validation_result, self.rule_name, dag_name, dag_run_id)


class UniqueKeyRule(Rule):
    """Every key (list of columns) occurs at most once. ``data`` is the
    table, ``config`` the key column list."""

    # Fixed value: event type written for this rule.
    rule_name = "Unique PK"

    def validate(self) -> DataFrame:
        keys: Sequence[str] = [self.config] if isinstance(self.config, str) else list(self.config)
        return unique_key(self.data, keys)

    def success_message(self, record_name: str) -> str:
        return f"{record_name}: every key occurs once"

    def fail_message(self, record_name: str) -> str:
        return f"{record_name}: some keys occur more than once"


class MappableIdRule(Rule):
    """Every id of ``data['subset']`` exists in ``data['superset']``;
    ``config`` is the id column (or list of columns)."""

    # Fixed value: event type written for this rule.
    rule_name = "Mapping ID"

    def __init__(self, data: Mapping[str, DataFrame], config, null_safe: bool = True):
        self.null_safe = null_safe
        super().__init__(data, config)

    def validate(self) -> DataFrame:
        return mappable_id(self.data["subset"], self.data["superset"], self.config, null_safe=self.null_safe)

    def success_message(self, record_name: str) -> str:
        return f"{record_name}: every id is known"

    def fail_message(self, record_name: str) -> str:
        return f"{record_name}: some ids are unknown"
