"""Execution statistics collected alongside the caller's own action.

``observe`` attaches a named metric to the plan; it is filled in by the first
action that runs it, so the output row count costs no extra job.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkloom.dataset import Dataset
from sparkloom.plans.spec import QuerySpec, apply_spec

CACHE_LEVELS = ("NONE", "MEMORY", "DISK", "MEMORY_AND_DISK")


@dataclass
class ObservedQuery:
    result: DataFrame
    source: DataFrame
    output_obs: Observation
    started: float = field(default_factory=time.time)

    def stats(self) -> dict[str, Any]:
        """Call after an action on ``result``; blocks until the metrics are in.

        The input is counted apart (for Parquet from the footers alone): a metric
        inside the plan would miss the rows a limit never reads, and keep
        filters out of the scan.
        """
        n_out = self.output_obs.get.get("output_rows")
        seconds = time.time() - self.started
        return {
            "input_rows": self.source.count(),
            "output_rows": n_out,
            "affected_rows": n_out,
            "execution_time": seconds,
        }


def observed_query(df: DataFrame, spec: QuerySpec, cache: str = "NONE") -> ObservedQuery:
    from pyspark import StorageLevel

    cache = cache.upper()
    if cache not in CACHE_LEVELS:
        raise ValueError(f"cache must be one of {CACHE_LEVELS}")
    obs_out = Observation("output")
    out = apply_spec(df, spec).observe(obs_out, F.count(F.lit(1)).alias("output_rows"))
    if cache == "MEMORY":
        out = out.persist(StorageLevel.MEMORY_ONLY)
    elif cache == "DISK":
        out = out.persist(StorageLevel.DISK_ONLY)
    elif cache == "MEMORY_AND_DISK":
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    return ObservedQuery(out, df, obs_out)


def run_query(dataset: Dataset, spec: QuerySpec, source: str = "", cache: str = "NONE") -> tuple[Dataset, ObservedQuery]:
    """The executor: result dataset named after its source, with the spec as metadata."""
    q = observed_query(dataset.df, spec, cache)
    name = f"query_result_{source or dataset.name}".replace(".", "_")
    return Dataset(q.result, name, {"query_spec": spec.to_dict(), "source_table": source or dataset.name}), q


def row_count_frame(source: DataFrame, result: DataFrame) -> DataFrame:
    """Input/output row counts as a two-row frame ``(metric, value)``; two small aggregates."""
    n_in = source.agg(F.count(F.lit(1)).alias("value")).select(F.lit("input_rows").alias("metric"), "value")
    n_out = result.agg(F.count(F.lit(1)).alias("value")).select(F.lit("output_rows").alias("metric"), "value")
    return n_in.unionByName(n_out)
