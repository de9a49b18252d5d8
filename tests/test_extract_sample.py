import json

import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.functions import inference
from sparkloom.functions.text.extract import extract_text_features, text_feature_summary
from sparkloom.sources import sample

from conftest import SF_SMALL


def test_dispatcher(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(F.col("lang") == "en").select("doc_id", "text")
    vec = extract_text_features(docs, "doc_id", "text", "SEMANTIC_VECTORS", n_features=32)
    assert {len(r["vector"]) for r in vec.collect()} == {32}
    stub = extract_text_features(docs, "doc_id", "text", "semantic_vectors", model=inference.text_stats_model)
    assert stub.count() == docs.count()
    ents = extract_text_features(docs, "doc_id", "text", "ENTITIES")
    assert set(ents.columns) == {"doc_id", "start", "end", "label", "text"}
    lex = spark.createDataFrame([("the", 0.5, 0.5)], "token string, polarity double, subjectivity double")
    assert extract_text_features(docs, "doc_id", "text", "SENTIMENT", lexicon=lex).count() == docs.count()
    with pytest.raises(ValidationError, match="lexicon"):
        extract_text_features(docs, "doc_id", "text", "SENTIMENT")
    with pytest.raises(ValidationError, match="Unsupported extraction type"):
        extract_text_features(docs, "doc_id", "text", "SUMMARY")
    s = text_feature_summary(docs, "text", "KEYWORDS").first()
    assert s["num_texts"] == docs.count() and s["max_keywords"] == 10 and s["extraction_type"] == "KEYWORDS"


def test_sample_is_deterministic_and_in_range(spark):
    ids = spark.range(50).withColumnRenamed("id", "k")
    a = sorted(map(tuple, sample.generate_sample(ids, "k", seed=3).collect()))
    b = sorted(map(tuple, sample.generate_sample(ids, "k", seed=3).collect()))
    c = sorted(map(tuple, sample.generate_sample(ids, "k", seed=4).collect()))
    assert a == b and a != c
    for _, desc, meta in a:
        m = json.loads(meta)
        assert any(desc.startswith(s) for s in sample.SCENES) and any(desc.endswith(s) for s in sample.STYLES)
        p = m["style_params"]
        assert 0.5 <= p["strength"] < 1.0 and 0.1 <= p["noise"] < 0.5 and 0.8 <= p["contrast"] < 1.2
        assert len(m["tags"]) == 3 and len(set(m["tags"])) == 3 and set(m["tags"]) <= set(sample.TAGS)


def test_summary_makes_the_vectors_once(spark):
    df = spark.createDataFrame([(i, "aa bb") for i in range(20)], "id long, t string")
    made = spark.sparkContext.accumulator(0)

    def vectors(batches):
        for batch in batches:
            made.add(len(batch))
            batch["vector"] = [[0.0, 1.0]] * len(batch)
            yield batch[["id", "vector"]]

    s = text_feature_summary(df, "t", "SEMANTIC_VECTORS", features=df.mapInPandas(vectors, "id long, vector array<double>")).first()
    assert (s["shape_rows"], s["shape_columns"], made.value) == (20, 2, 20)


def test_hashed_vectors_exchange_no_row(spark):
    from sparkloom.functions.text import vectors

    df = spark.createDataFrame([(1, "Aa aa b"), (1, "c"), (None, None), (None, "b 1 É")], "id long, t string")
    long = vectors.hashed_tfidf(df, "id", "t", 8)
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
    dense = vectors.dense_tfidf(df, "id", "t", 8).collect()
    assert sorted((r["id"] or 0) for r in dense) == [0, 1, 1] and all(abs(sum(x * x for x in r["vector"]) - 1) < 1e-9 for r in dense)
    assert vectors.dense_tfidf(df.limit(0), "id", "t", 8).count() == 0
