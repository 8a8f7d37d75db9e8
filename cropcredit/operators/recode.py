"""Ordered recode rules: the first rule whose predicate holds gives the class.

A rule is (result, clauses): clauses are OR-ed, each clause is an AND of
``column IN values`` (or ``NOT IN`` via :class:`Not`). ``result`` is a literal class or
``Keep(column)`` (pass the column's own value). An optional null-guard column yields
NULL first when it is NULL. SQL three-valued logic applies: a NULL comparison never
matches, so the row falls through to later rules / the default.

Rules compile to one nested ``CASE WHEN`` Column (JVM-side, codegen'd). They are
meant to run on the small domain table (one row per code), not per operation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Keep:
    column: str


@dataclass(frozen=True)
class Not:
    values: tuple


@dataclass(frozen=True)
class Recode:
    rules: tuple  # ((result, (clause, ...)), ...)
    default: object = None  # literal, Keep(column) or None
    null_guard: str | None = None

    def columns(self) -> set:
        cols = set()
        if self.null_guard:
            cols.add(self.null_guard)
        for result, clauses in self.rules:
            if isinstance(result, Keep):
                cols.add(result.column)
            for clause in clauses:
                cols.update(clause)
        if isinstance(self.default, Keep):
            cols.add(self.default.column)
        return cols


def _value(v, col) -> Column:
    if isinstance(v, Keep):
        return col(v.column)
    return F.lit(v).cast("string")


def _predicate(clauses, col) -> Column:
    ors = []
    for clause in clauses:
        ands = []
        for c, vals in clause.items():
            if isinstance(vals, Not):
                ands.append(~col(c).isin(list(vals.values)))
            else:
                ands.append(col(c).isin(list(vals)))
        ors.append(reduce(lambda a, b: a & b, ands))
    return reduce(lambda a, b: a | b, ors)


def _spark_lit(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_column(recode: Recode) -> Column:
    """The rules as one SQL CASE expression (one parser call, not one JVM round-trip per literal)."""
    return F.expr(to_sql(recode, lambda c: f"`{c}`", lit=_spark_lit))


def _sql_lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def to_sql(recode: Recode, qualify, lit=_sql_lit) -> str:
    """Render as a ``CASE`` expression (ANSI quoting by default, as the SQL oracle uses)."""
    _sql_lit = lit  # noqa: N806 - literal renderer for this dialect

    def val(v):
        return qualify(v.column) if isinstance(v, Keep) else _sql_lit(v)

    parts = ["CASE"]
    if recode.null_guard:
        parts.append(f"WHEN {qualify(recode.null_guard)} IS NULL THEN NULL")
    for result, clauses in recode.rules:
        ors = []
        for clause in clauses:
            ands = []
            for c, vals in clause.items():
                if isinstance(vals, Not):
                    lst = ", ".join(_sql_lit(x) for x in vals.values)
                    ands.append(f"{qualify(c)} NOT IN ({lst})")
                else:
                    lst = ", ".join(_sql_lit(x) for x in vals)
                    ands.append(f"{qualify(c)} IN ({lst})")
            ors.append("(" + " AND ".join(ands) + ")")
        parts.append(f"WHEN {' OR '.join(ors)} THEN {val(result)}")
    if not recode.rules and recode.default is None:
        parts.append("WHEN false THEN NULL")
    if recode.default is not None:
        parts.append(f"ELSE {val(recode.default)}")
    parts.append("END")
    return " ".join(parts)
