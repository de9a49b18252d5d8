import os

from pyspark.sql import functions as F

from sparkloom.functions.text import sentiment
from sparkloom.streaming.incremental import incremental_features

from conftest import SF_SMALL


def test_incremental_sentiment_equals_batch(spark, tmp_out):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    src = os.path.join(tmp_out, "incoming")
    # two arrivals of files
    docs.filter(F.col("doc_id") % 2 == 0).write.parquet(os.path.join(src, "a"))
    docs.filter(F.col("doc_id") % 2 == 1).write.parquet(os.path.join(src, "b"))
    lex = spark.createDataFrame([("the", 0.2, 0.1), ("of", -0.4, 0.3)], "token string, polarity double, subjectivity double")
    neg = spark.createDataFrame([("and",)], "token string")

    def features(batch):
        return sentiment.sentiment(batch, "doc_id", "text", lex, neg)

    sink = os.path.join(tmp_out, "out")
    q = incremental_features(spark, src + "/*", docs.schema, features, sink,
                             checkpoint_location=os.path.join(tmp_out, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(sink).drop("batch_id")
    expect = features(docs)
    assert got.count() == docs.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.select(got.columns).collect()))
