"""The registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import arcwarc, editmatch, langid, licenses, minhash, periodic, quality, ranked, sharding, simple8b, surrogates, wfst, winnow


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=16)


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arcwarc.round_trip(table(spark, sf_dir, "pages"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), count_col="n_entities")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.neighbour_prints(table(spark, sf_dir, "documents"))


def op9_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editmatch.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_matches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.transform("matches", lambda h: h["label"])))
    best = F.coalesce(F.array_max(F.transform("matches", lambda h: h["containment"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id ends in 0, the words from a place on repeat the words from there."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0)
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    # evaluated once: a generator's output isn't merged with the projections that read it
    rows = rows.select("doc_id", "text", "h", F.explode(F.array(F.when(F.col("h") % 10 == 0, words))).alias("w")).withColumn("n", F.size("w").cast("long"))
    g = F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int"))), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    # runs come by start, then period: only a greater exponent takes the place of an earlier run
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_sharding, op3_arc_to_warc, op4_sentencepiece, op5_surrogates,
        op6_minhash, op7_langid, op8_winnowing, op9_simple8b, op10_decontaminate, op11_licenses, op12_periodic_runs, op13_ranked_search,
    )
}
#: op3: a digest is SHA-1; of equal payloads of at least 1000 bytes the largest page id is the response.
ORACLE_SQL: dict[str, str] = {
    "op3_arc_to_warc": """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h, n) ELSE page_id END AS lead FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM r""",
    "op11_licenses": licenses.oracle_sql(),
}
