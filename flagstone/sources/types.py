"""Types of text columns, chosen so that no cell changes its value.

What is known of a column is a few counts and widths (:class:`Facts`) that
merge by sum and maximum, so the facts of every column of every file of a
delivery come from one partially aggregated pass. The type is then the first of

* ``date``, if every cell is a date written ``yyyy-MM-dd``,
* text, if a number begins with a needless zero (``007`` is a name, not seven),
* ``bigint``, or ``decimal(38,0)`` for whole numbers beyond 64 bits,
* ``double``, if every number is exact in double precision or printed from one,
* ``decimal(p,s)`` for longer fractions, as far as 38 digits hold them,
* text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import ident, sql_str

_INTEGER = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
# The largest whole number within 64 bits, and the digits of the least.
_LONG, _LEAST = str(2**63 - 1), str(2**63)
# Significant digits that a double holds whatever they are, and the digits of a decimal.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38


@dataclass(frozen=True)
class Facts:
    """Counts of cells, and the widest whole part and fraction of the numbers."""

    cells: int = 0
    whole_numbers: int = 0
    numbers: int = 0
    dates: int = 0
    longs: int = 0  # whole numbers within 64 bits
    padded: int = 0  # numbers with a needless leading zero
    powers: int = 0  # numbers with an exponent
    exact: int = 0  # numbers that are the same as a double
    whole: int = 0
    scale: int = 0

    def __add__(self, other: Facts) -> Facts:
        wide = ("whole", "scale")
        return Facts(**{f.name: (max if f.name in wide else int.__add__)(getattr(self, f.name), getattr(other, f.name)) for f in fields(self)})

    def type(self) -> str:
        """The type that holds every cell."""
        if self.cells and self.dates == self.cells:
            return "date"
        if not self.cells or self.padded or self.numbers < self.cells:
            return "string"
        if self.whole_numbers == self.cells:
            if self.longs == self.cells:
                return "bigint"
            return f"decimal({DECIMAL_DIGITS},0)" if self.whole <= DECIMAL_DIGITS else "string"
        if self.exact == self.cells:
            return "double"
        digits = self.whole + self.scale
        return f"decimal({digits},{self.scale})" if not self.powers and digits <= DECIMAL_DIGITS else "string"


def column_facts(tables: Mapping[str, DataFrame]) -> dict[str, list[Facts]]:
    """Facts of every (text) column of every table, in the order of the columns, from one job.

    Each task sums up its cells by table and column; the driver gets one row per
    column of the delivery."""
    cells = []
    for name, df in tables.items():
        if df.columns:
            each = ", ".join(f"struct({i} AS at, {ident(c)} AS c)" for i, c in enumerate(df.columns))
            cells.append(df.selectExpr(f"{sql_str(name)} AS tbl", f"inline(array({each}))"))
    if not cells:
        return {name: [] for name in tables}
    rows = reduce(DataFrame.unionAll, cells).where("c IS NOT NULL")
    rows = rows.selectExpr(
        "tbl",
        "at",
        "c",
        f"CASE WHEN c RLIKE {sql_str(_INTEGER)} THEN 2 WHEN c RLIKE {sql_str(_NUMBER)} THEN 1 ELSE 0 END AS number",
    )
    rows = rows.selectExpr(
        "tbl",
        "at",
        "c",
        "number",
        "CASE WHEN number = 2 THEN ltrim('+-', c) WHEN number = 1 THEN ltrim('+-', substring_index(lower(c), 'e', 1)) END AS plain",
    )
    rows = rows.selectExpr("tbl", "at", "c", "number", "plain", "CASE WHEN number = 2 THEN plain ELSE substring_index(plain, '.', 1) END AS head")
    rows = rows.selectExpr(
        "tbl",
        "at",
        "c",
        "number",
        "ltrim('0', head) AS digits",
        "coalesce(length(ltrim('0', head)), 0) AS whole",
        "coalesce(greatest(length(plain) - length(head) - 1, 0), 0) AS scale",
        "coalesce(length(head) > 1 AND head LIKE '0%', false) AS padded",
    )
    # compared as text: a cast that fails throws, which costs more than all the rest of a cell;
    # only a line break behind the digits, which the patterns allow, is left to the cast
    long = (
        f"CASE WHEN right(c, 1) NOT BETWEEN '0' AND '9' THEN try_cast(c AS BIGINT) IS NOT NULL WHEN whole < {len(_LONG)} THEN true "
        f"ELSE whole = {len(_LONG)} AND digits <= CASE WHEN c LIKE '-%' THEN '{_LEAST}' ELSE '{_LONG}' END END"
    )
    # a double is printed with a point and at most 17 digits: longer numbers are never the same
    few = f"whole + scale <= {DOUBLE_DIGITS}"
    power = "lower(c) LIKE '%e%'"
    same = (
        f"CASE WHEN number = 2 THEN {few} WHEN NOT {power} AND {few} THEN true WHEN NOT {power} AND whole > 0 AND whole + scale > 17 THEN false "
        f"ELSE abs(try_cast(c AS DOUBLE)) < double('infinity') AND ({few} OR CAST(try_cast(c AS DOUBLE) AS STRING) = c) END"
    )
    found = rows.groupBy("tbl", "at").agg(
        F.expr("count(1) AS cells"),
        F.expr("count_if(number = 2) AS whole_numbers"),
        F.expr("count_if(number > 0) AS numbers"),
        F.expr(f"count_if(number = 0 AND c RLIKE {sql_str(_DATE)} AND try_cast(c AS DATE) IS NOT NULL) AS dates"),
        F.expr(f"count_if(number = 2 AND ({long})) AS longs"),
        F.expr("count_if(padded) AS padded"),
        F.expr(f"count_if(number = 1 AND {power}) AS powers"),
        F.expr(f"count_if(number > 0 AND {same}) AS exact"),
        F.expr("max(whole) AS whole"),
        F.expr("max(scale) AS scale"),
    )
    out = {name: [Facts()] * len(df.columns) for name, df in tables.items()}
    for r in found.collect():
        out[r["tbl"]][r["at"]] = Facts(**{f.name: r[f.name] for f in fields(Facts)})
    return out


def typed(text: DataFrame, types: Sequence[str]) -> DataFrame:
    """Text columns cast to ``types``, which hold every cell."""
    return text.selectExpr(
        *[ident(c) if t == "string" else f"CAST({ident(c)} AS {t}) AS {ident(c)}" for c, t in zip(text.columns, types, strict=True)]
    )


def _types_of(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def in_schema(text: DataFrame, schema: StructType, table: str = "", on_misfit: str = "fail") -> DataFrame:
    """Text columns in the types of ``schema``. A cell that its type cannot hold
    is an error that names table, column and value, or null (``on_misfit="null"``;
    :func:`misfits` lists them)."""
    if on_misfit not in ("fail", "null"):
        raise ValueError(f"on_misfit must be 'fail' or 'null', got {on_misfit!r}")
    out = []
    for name, t in _types_of(schema):
        c = ident(name)
        value = f"try_cast({c} AS {t})"
        if t != "string" and on_misfit == "fail":
            message = f"concat({sql_str(f'{table}, column {name}: no {t}: ')}, {c})"
            value = f"coalesce({value}, CASE WHEN {c} IS NOT NULL THEN CAST(raise_error({message}) AS {t}) END)"
        out.append(c if t == "string" else f"{value} AS {c}")
    return text.selectExpr(*out)


def misfits(text: DataFrame, schema: StructType, table: str) -> DataFrame:
    """``(tbl, column, value)``: the distinct cells that the types of ``schema`` cannot hold."""
    each = [
        f"struct({sql_str(name)} AS column, CASE WHEN try_cast({ident(name)} AS {t}) IS NULL THEN {ident(name)} END AS value)"
        for name, t in _types_of(schema)
        if t != "string"
    ]
    if not each:
        return text.where("false").selectExpr(f"{sql_str(table)} AS tbl", "'' AS column", "'' AS value")
    found = text.selectExpr(f"inline(array({', '.join(each)}))").where("value IS NOT NULL")
    return found.selectExpr(f"{sql_str(table)} AS tbl", "column", "value").distinct()
