"""A DataFrame plus a name and free-form metadata (lineage notes, query spec)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dataset:
    df: DataFrame
    name: str
    metadata: dict[str, Any] = field(default_factory=dict)

    def with_metadata(self, **items: Any) -> "Dataset":
        return replace(self, metadata={**self.metadata, **items})

    def renamed(self, name: str) -> "Dataset":
        return replace(self, name=name)

    def transform(self, fn, *args, **kwargs) -> "Dataset":
        """Apply a ``DataFrame -> DataFrame`` function, keeping name and metadata."""
        return replace(self, df=fn(self.df, *args, **kwargs))

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Dataset":
        return replace(self, df=self.df.persist(level))

    def unpersist(self) -> "Dataset":
        self.df.unpersist()
        return self
