"""Column expressions used by the rules (selection, tests, parsing)."""

from .columns import *  # noqa: F401,F403
from .columns import col, is_missing, is_nonneg_decimal, match_columns  # noqa: F401
