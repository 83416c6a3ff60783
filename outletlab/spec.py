"""Declarative feature specifications and predicate lists.

A feature spec is ``{name, inputs, expr}`` where ``expr`` is a Spark SQL
expression template whose ``{field01}``, ``{field02}`` ... placeholders are the
input columns in order. Predicates are SQL strings AND-ed together; run-time
parameters are rendered as SQL literals from typed Python values (never from
data), so a parameter cannot change the shape of the predicate.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    inputs: tuple = field(default_factory=tuple)
    expr: str = ""


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (list, tuple, set, frozenset)):
        return ", ".join(sql_literal(v) for v in value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def render_predicate(template: str, params: dict | None = None) -> str:
    params = params or {}
    return template.format(**{k: sql_literal(v) for k, v in params.items()})


def conjunction(predicates, params: dict | None = None) -> Column:
    """AND of SQL predicate strings (and/or ready Columns)."""
    cols = [F.expr(render_predicate(p, params)) if isinstance(p, str) else p for p in predicates]
    if not cols:
        return F.lit(True)
    return reduce(lambda a, b: a & b, cols)


def apply_specs(df: DataFrame, specs, base: dict | None = None) -> DataFrame:
    """Add every spec as a column, in order, in ONE projection.

    ``base`` optionally maps existing columns to SQL expressions (e.g. typed
    casts). A spec may use a column made by an earlier spec: its expression
    is inlined (whole-stage codegen's common-subexpression elimination
    evaluates it once). One projection instead of a chain of ``withColumn``
    keeps analysis time flat however many features a source has.
    """
    exprs = {c: f"`{c}`" for c in df.columns}
    exprs.update(base or {})
    for spec in specs:
        missing = [c for c in spec.inputs if c not in exprs]
        if missing:
            raise ValueError(f"feature {spec.name!r}: unknown input columns {missing}")
        fields = {f"field{i + 1:02d}": f"({exprs[c]})" for i, c in enumerate(spec.inputs)}
        exprs[spec.name] = spec.expr.format(**fields)
    return df.selectExpr(*[f"{e} AS `{n}`" for n, e in exprs.items()])
