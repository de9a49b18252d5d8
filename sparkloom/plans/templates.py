"""Named, parameterised SQL templates.

Templates use Spark's named parameter markers (``:name``) and
``IDENTIFIER(:table)`` for the table; values are bound by ``spark.sql(args=...)``,
never by string formatting.  Parameters are checked against the template's
declared names, and column-valued parameters against the table schema.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession

from sparkloom.errors import ValidationError

_MARKER = re.compile(r"(?<![:\w]):([A-Za-z_][A-Za-z0-9_]*)")


@dataclass(frozen=True)
class QueryTemplate:
    name: str
    sql: str
    column_params: tuple[str, ...] = ()  # parameters whose value must name a column
    defaults: Mapping[str, Any] = field(default_factory=dict)

    @property
    def parameters(self) -> tuple[str, ...]:
        seen: list[str] = []
        for m in _MARKER.findall(self.sql):
            if m not in seen:
                seen.append(m)
        return tuple(seen)


_TEMPLATES: dict[str, QueryTemplate] = {}


def register_template(t: QueryTemplate) -> QueryTemplate:
    _TEMPLATES[t.name] = t
    return t


def get_template(name: str) -> QueryTemplate:
    try:
        return _TEMPLATES[name]
    except KeyError:
        raise ValidationError(f"Unknown template {name!r}; known: {sorted(_TEMPLATES)}") from None


def list_templates() -> list[str]:
    return sorted(_TEMPLATES)


# Built-in templates.
register_template(QueryTemplate("select_all", "SELECT * FROM IDENTIFIER(:table)"))
register_template(
    QueryTemplate(
        "filter_range",
        "SELECT * FROM IDENTIFIER(:table) WHERE IDENTIFIER(:column) BETWEEN :low AND :high",
        column_params=("column",),
    )
)
register_template(
    QueryTemplate(
        "group_count",
        "SELECT IDENTIFIER(:key) AS key, count(*) AS n FROM IDENTIFIER(:table) GROUP BY IDENTIFIER(:key)",
        column_params=("key",),
    )
)
register_template(
    QueryTemplate(
        "group_sum_above",
        "SELECT IDENTIFIER(:key) AS key, count(*) AS n, round(sum(IDENTIFIER(:value)), 2) AS total "
        "FROM IDENTIFIER(:table) WHERE IDENTIFIER(:value) > :threshold GROUP BY IDENTIFIER(:key)",
        column_params=("key", "value"),
    )
)


def validate_template(t: QueryTemplate, params: Mapping[str, Any], columns: list[str] | None) -> dict[str, Any]:
    merged = {**t.defaults, **params}
    expected = set(t.parameters) - {"table"}
    missing = sorted(expected - set(merged))
    extra = sorted(set(merged) - expected)
    if missing:
        raise ValidationError(f"Template {t.name!r} is missing parameters {missing}")
    if extra:
        raise ValidationError(f"Template {t.name!r} got unknown parameters {extra}")
    if columns is not None:
        bad = sorted(p for p in t.column_params if merged[p] not in columns)
        if bad:
            raise ValidationError(f"Template {t.name!r}: parameters {bad} do not name columns of the table")
    return merged


def template_info(t: QueryTemplate, params: Mapping[str, Any]) -> dict[str, Any]:
    return {"name": t.name, "parameter_count": len(params), "validation_status": "valid", "sql": t.sql}


def run_template(df: DataFrame, name: str, params: Mapping[str, Any]) -> DataFrame:
    """Run template ``name`` over ``df`` (bound as ``:table`` through a temp view)."""
    t = get_template(name)
    merged = validate_template(t, params, df.columns)
    view = f"sparkloom_tpl_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(t.sql, args={**merged, "table": view})


def run_template_on_table(spark: SparkSession, table_name: str, name: str, params: Mapping[str, Any]) -> DataFrame:
    return run_template(spark.table(table_name), name, params)
