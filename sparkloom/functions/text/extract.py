"""Dispatcher over the text extraction types, plus a run summary."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.functions.text import entities, keywords, semantic, sentiment, tagger, topics, vectors
from sparkloom.functions.text.tokens import require_text_column

# Names of the extraction types.
EXTRACTION_TYPES = ("SEMANTIC_VECTORS", "KEYWORDS", "ENTITIES", "SENTIMENT", "TOPICS")


def extract_text_features(df: DataFrame, id_col: str, text_col: str, extraction_type: str = "SEMANTIC_VECTORS",
                          **options) -> DataFrame:
    """Run one extraction type; every result is keyed by ``id_col``.

    SEMANTIC_VECTORS uses ``options['model']`` (a ``make_predict_fn`` for
    ``batch_model_inference``) when given, learnt vectors of that many dimensions
    with ``options['learnt']``, else hashed TF-IDF vectors.  ENTITIES uses ``options['tagger']``
    (a fitted ``tagger.Tagger``) when given, else rules and ``options['gazetteer']``.
    SENTIMENT needs ``options['lexicon']`` (and optionally ``negators``).
    """
    require_text_column(df, text_col)
    kind = extraction_type.upper()
    if kind not in EXTRACTION_TYPES:
        raise ValidationError(f"Unsupported extraction type: {extraction_type}")
    if kind == "SEMANTIC_VECTORS":
        model = options.get("model")
        if model is not None:
            from sparkloom.functions.inference import batch_model_inference

            return batch_model_inference(df.select(id_col, text_col), text_col, model, "vector",
                                         batch_size=options.get("batch_size", 32)).select(id_col, "vector")
        if options.get("learnt"):
            return semantic.semantic_vectors(df, id_col, text_col, k=options["learnt"])
        n = options.get("n_features", vectors.DEFAULT_FEATURES)
        return vectors.dense_tfidf(df, id_col, text_col, n)
    if kind == "KEYWORDS":
        return keywords.keywords(df, id_col, text_col, top=options.get("top", keywords.TOP))
    if kind == "ENTITIES" and options.get("tagger") is not None:
        return tagger.tagged(df, id_col, text_col, options["tagger"])
    if kind == "ENTITIES":
        return entities.extract_entities(df, id_col, text_col, gazetteer=options.get("gazetteer"))
    if kind == "SENTIMENT":
        if "lexicon" not in options:
            raise ValidationError("SENTIMENT needs a lexicon frame (token, polarity, subjectivity)")
        return sentiment.sentiment(df, id_col, text_col, options["lexicon"], options.get("negators"))
    return topics.describe_topics(df, id_col, text_col, k=options.get("k", 5), terms=options.get("terms", 10))


def text_feature_summary(df: DataFrame, text_col: str, extraction_type: str, started: float | None = None, *,
                         features: DataFrame | None = None, model: str | None = None) -> DataFrame:
    """One row about a run: extraction type, number of texts, non-empty texts, max keywords and elapsed time; with the
    run's ``features``, the rows and columns of its vectors (and the ``model``'s name) or its number of topics."""
    kind = extraction_type.upper()
    elapsed = None if started is None else time.time() - started
    n_rows = n_columns = n_topics = F.lit(None)
    if features is not None and kind == "SEMANTIC_VECTORS":
        # one subquery for both, so the vectors are made once
        shape = features.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("columns"))).scalar()
        n_rows, n_columns = shape["rows"], shape["columns"]
    if features is not None and kind == "TOPICS":
        n_topics = features.agg(F.count_distinct("topic_id")).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("num_texts"),
        F.count_if(F.length(F.coalesce(F.col(text_col), F.lit(""))) > 0).alias("non_empty_texts"),
    ).select(
        F.lit(kind).alias("extraction_type"), "num_texts", "non_empty_texts",
        F.lit(keywords.TOP if kind == "KEYWORDS" else None).cast("int").alias("max_keywords"),
        n_rows.cast("bigint").alias("shape_rows"), n_columns.cast("int").alias("shape_columns"),
        F.lit(model if kind == "SEMANTIC_VECTORS" else None).cast("string").alias("model"), n_topics.cast("bigint").alias("num_topics"),
        F.lit(elapsed).cast("double").alias("processing_time"),
    )
