"""SQL text for a query spec, and running that text through ``spark.sql``.

The generated SQL has the same meaning as :func:`sparkloom.plans.spec.apply_spec`
(group keys are part of the SELECT list), so both paths give equal results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sparkloom.operators.aggregates import aggregate_column, normalise_name
from sparkloom.plans.spec import QuerySpec

TABLE_PLACEHOLDER = "${table}"


def _ident(name: str) -> str:
    if name == "*":
        return name
    return ".".join(f"`{p.strip('`')}`" for p in name.split("."))


def _agg_sql(function: str, column: str) -> str:
    name = normalise_name(function)
    aggregate_column(function, column)  # validates the name
    col = "*" if column == "*" else _ident(column)
    if name == "count_distinct":
        return f"count(DISTINCT {col})"
    if name == "sum_distinct":
        return f"sum(DISTINCT {col})"
    if name == "mode":
        return f"mode({col}, true)"  # ties: the smallest value, as in the planner
    return f"{name}({col})"


def preview_sql(spec: QuerySpec) -> str:
    select: list[str]
    if spec.aggregations:
        select = [_ident(k) for k in spec.group_by]
        select += [f"{_agg_sql(a.function, a.column)} AS `{a.alias}`" for a in spec.aggregations]
    elif spec.group_by:
        select = ["DISTINCT " + ", ".join(_ident(k) for k in spec.group_by)]
    else:
        select = [_ident(c) for c in spec.select] or ["*"]
    parts = ["SELECT " + ", ".join(select), f"FROM {TABLE_PLACEHOLDER}"]
    if spec.where:
        parts.append("WHERE " + " AND ".join(f"({w})" for w in spec.where))
    if spec.aggregations and spec.group_by:
        parts.append("GROUP BY " + ", ".join(_ident(k) for k in spec.group_by))
    if spec.order_by:
        parts.append("ORDER BY " + ", ".join(f"{_ident(o.column)} {o.direction}" for o in spec.order_by))
    if spec.limit > 0:
        parts.append(f"LIMIT {spec.limit}")
    return "\n".join(parts)


def run_preview_sql(df: DataFrame, sql: str) -> DataFrame:
    """Bind ``${table}`` to ``df`` through a uniquely named temp view and run the SQL."""
    view = f"sparkloom_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql.replace(TABLE_PLACEHOLDER, f"`{view}`"))
