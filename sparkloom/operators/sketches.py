"""Mergeable sketches kept as binary state: distinct counts, sets, quantiles, and exact bitmaps.

``sketch`` summarises groups, ``union`` merges states over fewer keys, and
``estimate`` reads them, so states may be stored and merged later, or over data that
came in parts.  All aggregates are Spark's own and partial before the shuffle;
a state's size is bounded by its kind, whatever the group's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError

#: kind: (state of a column, merged states, reading of a state)
KINDS = {
    "HLL": (lambda c: F.hll_sketch_agg(c), lambda s: F.hll_union_agg(s), lambda s, _: F.hll_sketch_estimate(s)),
    "THETA": (lambda c: F.theta_sketch_agg(c), lambda s: F.theta_union_agg(s), lambda s, _: F.theta_sketch_estimate(s)),
    "QUANTILES": (lambda c: F.kll_sketch_agg_double(c.cast("double")), lambda s: F.kll_merge_agg_double(s), lambda s, q: F.kll_sketch_get_quantile_double(s, F.lit(q))),
    "BITMAP": (lambda c: F.bitmap_construct_agg(F.bitmap_bit_position(c.cast("bigint"))), lambda s: F.bitmap_or_agg(s), None),
}
BUCKET = "bucket"


def _kind(kind: str) -> str:
    if kind.upper() not in KINDS:
        raise ValidationError(f"Unknown sketch {kind!r}; expected one of {tuple(KINDS)}")
    return kind.upper()


def _keys(kind: str, group_by: Sequence[str]) -> list[str]:
    return [*group_by, BUCKET] if kind == "BITMAP" else list(group_by)


def sketch(df: DataFrame, kind: str, column: str, group_by: Sequence[str] = (), state: str = "state") -> DataFrame:
    """``(*group_by, state)``; a BITMAP (integers from 0, nulls passed over) has a row and a ``bucket`` for each 32,768 values in use."""
    kind = _kind(kind)
    value: Column = F.col(column)
    if kind == "BITMAP":
        df = df.where(value.isNotNull()).withColumn(BUCKET, F.bitmap_bucket_number(value.cast("bigint")))
    return df.groupBy(*_keys(kind, group_by)).agg(KINDS[kind][0](value).alias(state))


def union(sketches: DataFrame, kind: str, group_by: Sequence[str] = (), state: str = "state") -> DataFrame:
    """``sketches`` merged over all keys but ``group_by``."""
    kind = _kind(kind)
    return sketches.groupBy(*_keys(kind, group_by)).agg(KINDS[kind][1](F.col(state)).alias(state))


def estimate(sketches: DataFrame, kind: str, group_by: Sequence[str] = (), state: str = "state", name: str = "estimate", quantile: float = 0.5) -> DataFrame:
    """``(*group_by, name)``: distinct values (HLL, THETA: estimated; BITMAP: exact) or the ``quantile`` (QUANTILES) of each group."""
    kind = _kind(kind)
    if kind == "BITMAP":
        return sketches.groupBy(*group_by).agg(F.sum(F.bitmap_count(state)).alias(name))
    return sketches.select(*group_by, KINDS[kind][2](F.col(state), quantile).alias(name))
