"""Deterministic sample text dataset: one description and JSON metadata per id.

Choices are md5 hash buckets of ``(seed, field, id)`` instead of a random
generator, so the output is reproducible, identical in any engine that has
md5, and computed row-locally (no shuffle).  The ids come from any frame
(typically a table's key column), so the sample grows with its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scene and style phrases and the tag vocabulary of the sample dataset.
SCENES = (
    "A serene mountain landscape at sunset",
    "A bustling cityscape at night",
    "A peaceful garden with blooming flowers",
    "A mysterious forest in the fog",
    "A cozy cabin by a lake",
)
STYLES = (
    "in the style of Van Gogh",
    "with a cyberpunk aesthetic",
    "in watercolor",
    "as an oil painting",
    "with a minimalist design",
)
TAGS = ("nature", "urban", "abstract", "landscape", "artistic", "modern", "traditional", "minimal")
N_TAGS = 3


def hash_unit(seed: int, field: str, key: Column) -> Column:
    """First 32 bits of md5(seed|field|key) as an integer in [0, 2^32)."""
    s = F.concat_ws("|", F.lit(str(seed)), F.lit(field), key.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def _uniform(seed: int, field: str, key: Column, low: float, high: float) -> Column:
    # 100,000 steps: every value has at most 6 decimals, far from rounding boundaries
    u = (hash_unit(seed, field, key) % 100000).cast("double") / 100000.0
    return F.lit(low) + u * F.lit(high - low)


def generate_sample(ids: DataFrame, id_col: str, seed: int = 0, timestamp: str = "1970-01-01T00:00:00") -> DataFrame:
    """``(id, description, metadata)`` with metadata JSON ``{timestamp, style_params{strength,
    noise, contrast}, tags[3]}``; strength in [0.5, 1), noise in [0.1, 0.5), contrast in [0.8, 1.2)."""
    key = F.col(id_col)
    scene = F.element_at(F.array(*[F.lit(s) for s in SCENES]), (hash_unit(seed, "scene", key) % len(SCENES) + 1).cast("int"))
    style = F.element_at(F.array(*[F.lit(s) for s in STYLES]), (hash_unit(seed, "style", key) % len(STYLES) + 1).cast("int"))
    ranked = F.array_sort(F.array(*[F.struct(hash_unit(seed, f"tag:{t}", key).alias("h"), F.lit(t).alias("t")) for t in TAGS]))
    tags = F.transform(F.slice(ranked, 1, N_TAGS), lambda e: e["t"])
    params = F.struct(
        _uniform(seed, "strength", key, 0.5, 1.0).alias("strength"),
        _uniform(seed, "noise", key, 0.1, 0.5).alias("noise"),
        _uniform(seed, "contrast", key, 0.8, 1.2).alias("contrast"),
    )
    meta = F.struct(F.lit(timestamp).alias("timestamp"), params.alias("style_params"), tags.alias("tags"))
    return ids.select(
        key.alias("id"),
        F.concat_ws(" ", scene, style).alias("description"),
        F.to_json(meta).alias("metadata"),
    )


SAMPLE_METADATA_SCHEMA = "timestamp string, style_params struct<strength:double,noise:double,contrast:double>, tags array<string>"
