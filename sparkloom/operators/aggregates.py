"""Aggregate functions reachable from a query spec ``{function, column, alias}``.

Names are matched case-insensitively against an allow-list of one-argument
Spark aggregate functions; every one of them runs as a partial (map-side)
plus final aggregate, except the exact ``collect_*`` / ``mode`` / ``median``
families which Spark evaluates with an object-hash or sort based buffer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError

# The aggregate names a query spec may use, by family.
AGGREGATE_FAMILIES: dict[str, tuple[str, ...]] = {
    "basic": ("count", "sum", "avg", "mean", "min", "max"),
    "distinct": ("count_distinct", "sum_distinct"),
    "stats": ("stddev", "std", "stddev_samp", "stddev_pop", "variance", "var_samp", "var_pop", "skewness", "kurtosis"),
    "median_mode": ("median", "mode", "product"),
    "boolean_bit": ("bool_and", "bool_or", "every", "some", "count_if", "bit_and", "bit_or", "bit_xor"),
    "approx": ("approx_count_distinct",),
    "collect": ("collect_list", "collect_set", "array_agg", "listagg", "string_agg"),
    "pick": ("any_value", "first", "last", "first_value", "last_value"),
    "try": ("try_sum", "try_avg"),
}

# Make and merge binary states, each from columns of some types alone; ``sketches`` merges and reads them.
SKETCH_AGGREGATES = frozenset(
    {"hll_sketch_agg", "hll_union_agg", "theta_sketch_agg", "theta_union_agg", "kll_sketch_agg_double", "bitmap_construct_agg", "bitmap_or_agg"}
)

ALLOWED_AGGREGATES: frozenset[str] = frozenset(n for names in AGGREGATE_FAMILIES.values() for n in names)

# Aggregates whose buffer holds every input value of the group; they are only
# safe on groups with a bounded number of rows.
UNBOUNDED_BUFFER = frozenset({"collect_list", "collect_set", "array_agg", "listagg", "string_agg", "median", "mode"})


def normalise_name(function: str) -> str:
    name = function.strip().lower()
    if name == "countdistinct":
        name = "count_distinct"
    if name == "sumdistinct":
        name = "sum_distinct"
    return name


def aggregate_column(function: str, column: str, alias: str | None = None) -> Column:
    """Build ``function(column) AS alias`` from an allow-listed name."""
    name = normalise_name(function)
    if name not in ALLOWED_AGGREGATES | SKETCH_AGGREGATES:
        raise ValidationError(f"Unsupported aggregate function: {function!r}")
    if column == "*":
        if name != "count":
            raise ValidationError(f"'*' is only valid with count, not {function!r}")
        expr = F.count(F.lit(1))
    elif name == "mode":
        # ties resolve to the smallest value, so results are reproducible
        expr = F.mode(F.col(column), deterministic=True)
    else:
        expr = getattr(F, name)(F.col(column))
    return expr.alias(alias or f"{name}_{column}")
