"""Batch model inference and user-registered extractors as Arrow UDFs.

``batch_model_inference`` wraps ``pyspark.ml.functions.predict_batch_udf``:
the model factory runs once per Python worker, and rows reach it in Arrow
batches of ``batch_size``.  The model itself (sentence encoder, detector,
tagger) is the caller's; nothing is downloaded here.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType, LongType

from sparkloom.errors import ValidationError


def batch_model_inference(
    df: DataFrame,
    input_col: str,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    output_col: str = "vector",
    return_type: DataType = ArrayType(FloatType()),
    batch_size: int = 32,
    input_tensor_shapes=None,
) -> DataFrame:
    """Append ``output_col`` = model(input) computed in Arrow batches."""
    if input_col not in df.columns:
        raise ValidationError(f"Column '{input_col}' not found in dataset")
    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size,
                            input_tensor_shapes=input_tensor_shapes)
    return df.withColumn(output_col, udf(F.col(input_col)))


def text_stats_model() -> Callable[[np.ndarray], np.ndarray]:
    """Stub encoder for tests: ``[length, blanks]`` per text (no weights)."""

    def predict(texts: np.ndarray) -> np.ndarray:
        s = pd.Series(texts).fillna("")
        return np.stack([s.str.len().to_numpy(dtype=np.float32), s.str.count(" ").to_numpy(dtype=np.float32)], axis=1)

    return predict


# ---------------------------------------------------------------- custom extractors

_EXTRACTORS: dict[str, Callable[[Column], Column]] = {}


def register_extractor(name: str, fn: Callable[[Column], Column]) -> None:
    """Register ``name`` -> a function mapping a column to a feature column (e.g. a pandas UDF)."""
    _EXTRACTORS[name.upper()] = fn


def get_extractor(name: str) -> Callable[[Column], Column]:
    try:
        return _EXTRACTORS[name.upper()]
    except KeyError:
        raise ValidationError(f"Unknown extractor {name!r}; registered: {sorted(_EXTRACTORS)}") from None


def apply_extractor(df: DataFrame, name: str, input_col: str, output_col: str | None = None) -> DataFrame:
    if input_col not in df.columns:
        raise ValidationError(f"Column '{input_col}' not found in dataset")
    return df.withColumn(output_col or name.lower(), get_extractor(name)(F.col(input_col)))


@F.pandas_udf(LongType())
def _text_length(s: pd.Series) -> pd.Series:
    return s.fillna("").str.len().astype("int64")


register_extractor("TEXT_LENGTH", _text_length)
