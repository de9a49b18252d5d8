"""Declarative query specs: select / where / aggregate / group / order / limit.

A spec is planned as one lazy DataFrame chain in SQL order::

    where* (on base columns)
      -> aggregations ? groupBy(keys).agg(...)   (output: keys ++ aliases)
       : group_by     ? select(keys).distinct()  (output: keys)
       :                select(columns or *)
      -> orderBy -> limit

Filters run before the projection so Catalyst can push them into the scan;
the projection then prunes the columns the scan reads.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators.aggregates import aggregate_column, normalise_name


@dataclass(frozen=True)
class Aggregation:
    function: str
    column: str
    alias: str

    @classmethod
    def of(cls, item: "Aggregation | Mapping[str, Any]") -> "Aggregation":
        if isinstance(item, Aggregation):
            return item
        fn, col = item["function"], item["column"]
        return cls(fn, col, item.get("alias") or f"{normalise_name(fn)}_{col}".replace("*", "star"))


@dataclass(frozen=True)
class Ordering:
    column: str
    direction: str = "ASC"

    @classmethod
    def of(cls, item: "Ordering | Mapping[str, Any] | str") -> "Ordering":
        if isinstance(item, Ordering):
            return item
        if isinstance(item, str):
            return cls(item)
        direction = str(item.get("direction", "ASC")).upper()
        if direction not in ("ASC", "DESC"):
            raise ValidationError(f"Bad sort direction {item.get('direction')!r}")
        return cls(item["column"], direction)

    def to_column(self) -> Column:
        # Spark's defaults: ASC puts nulls first, DESC puts them last.
        return F.col(self.column).desc() if self.direction == "DESC" else F.col(self.column).asc()


@dataclass(frozen=True)
class QuerySpec:
    select: tuple[str, ...] = ()
    where: tuple[str, ...] = ()
    aggregations: tuple[Aggregation, ...] = ()
    group_by: tuple[str, ...] = ()
    order_by: tuple[Ordering, ...] = ()
    limit: int = 0  # <= 0 means unlimited

    @classmethod
    def build(
        cls,
        select: Iterable[str] = (),
        where: Iterable[str] | str = (),
        aggregations: Iterable[Any] = (),
        group_by: Iterable[str] = (),
        order_by: Iterable[Any] = (),
        limit: int = 0,
    ) -> "QuerySpec":
        if isinstance(where, str):
            where = (where,)
        return cls(
            tuple(select),
            tuple(where),
            tuple(Aggregation.of(a) for a in aggregations),
            tuple(group_by),
            tuple(Ordering.of(o) for o in order_by),
            int(limit or 0),
        )

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> "QuerySpec":
        return cls.build(
            spec.get("select", ()),
            spec.get("where", ()),
            spec.get("aggregations", ()),
            spec.get("group_by", ()),
            spec.get("order_by", ()),
            spec.get("limit", 0),
        )

    def to_dict(self) -> dict[str, Any]:
        return {
            "select": list(self.select),
            "where": list(self.where),
            "aggregations": [a.__dict__.copy() for a in self.aggregations],
            "group_by": list(self.group_by),
            "order_by": [o.__dict__.copy() for o in self.order_by],
            "limit": self.limit,
        }

    def output_columns(self, input_columns: list[str]) -> list[str]:
        if self.aggregations:
            return list(self.group_by) + [a.alias for a in self.aggregations]
        if self.group_by:
            return list(self.group_by)
        return list(self.select) or list(input_columns)


def _top_level(name: str) -> str:
    return name.split(".", 1)[0].strip("`")


def validate_spec(spec: QuerySpec, columns: list[str]) -> None:
    """Every column a spec names must exist (case-sensitive, like the schema)."""
    known = set(columns)
    named = [c for c in spec.select if c != "*"] + list(spec.group_by)
    named += [a.column for a in spec.aggregations if a.column != "*"]
    bad = sorted({c for c in named if _top_level(c) not in known})
    if bad:
        raise ValidationError(f"Invalid columns: {bad}")
    aliases = [a.alias for a in spec.aggregations]
    if len(set(aliases)) != len(aliases):
        raise ValidationError(f"Duplicate aggregate aliases: {aliases}")
    outputs = set(spec.output_columns(columns))
    for o in spec.order_by:
        plain = not spec.aggregations and not spec.group_by
        if _top_level(o.column) not in outputs and not (plain and _top_level(o.column) in known):
            raise ValidationError(f"Cannot order by {o.column!r}: not an output column")


def apply_spec(df: DataFrame, spec: QuerySpec | Mapping[str, Any]) -> DataFrame:
    """Plan a spec over ``df`` as one lazy DataFrame chain (no action)."""
    if not isinstance(spec, QuerySpec):
        spec = QuerySpec.from_dict(spec)
    validate_spec(spec, df.columns)
    out = df
    for cond in spec.where:
        out = out.filter(cond)
    if spec.aggregations:
        aggs = [aggregate_column(a.function, a.column, a.alias) for a in spec.aggregations]
        out = out.groupBy(*spec.group_by).agg(*aggs) if spec.group_by else out.agg(*aggs)
    elif spec.group_by:
        out = out.select(*spec.group_by).distinct()
    elif spec.select:
        if spec.order_by:
            # sorting by a column that is not projected: sort first, then project
            missing = [o.column for o in spec.order_by if o.column not in spec.select]
            if missing:
                out = out.orderBy(*[o.to_column() for o in spec.order_by])
                out = out.select(*spec.select)
                return out.limit(spec.limit) if spec.limit > 0 else out
        out = out.select(*spec.select)
    if spec.order_by:
        out = out.orderBy(*[o.to_column() for o in spec.order_by])
    if spec.limit > 0:
        out = out.limit(spec.limit)
    return out


def dynamic_query(
    df: DataFrame,
    selected_columns: Iterable[str] = (),
    conditions: Iterable[str] = (),
    group_by: Iterable[str] = (),
    order_by: Iterable[Any] = (),
    limit: int = 0,
    aggregations: Iterable[Any] = (),
) -> DataFrame:
    """Direct-parameter form of :func:`apply_spec`; ``limit`` <= 0, the default, means all rows."""
    return apply_spec(df, QuerySpec.build(selected_columns, conditions, aggregations, group_by, order_by, limit))
