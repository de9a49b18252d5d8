"""Lexicon sentiment: polarity in [-1, 1] and subjectivity in [0, 1] per text.

Tokens meet a broadcast lexicon ``(token, polarity, subjectivity)`` in the task
that read their text; a hit whose previous token is a negator has its polarity
multiplied by -0.5.  The text's scores are the means over its hits, 0.0 / 0.0
when there are none; the sums are decimals, so no order of adding changes them.
The lexicon is the caller's (no pretrained lexicon ships with Spark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import prompts
from sparkloom.functions.text.tokens import require_text_column, tokens_with_previous
from sparkloom.operators.broadcast import broadcast_if_few

NEGATION_FACTOR = -0.5
EXACT = "decimal(18,9)"


def sentiment(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, negators: DataFrame | None = None) -> DataFrame:
    """``(id, polarity, subjectivity, n_hits)`` for every input row."""
    require_text_column(df, text_col)
    spark = df.sparkSession
    # of several entries for a token the smallest counts
    lex = lexicon.select(F.lower("token").alias("token"), F.struct(F.col("polarity").cast(EXACT).alias("p"), F.col("subjectivity").cast(EXACT).alias("s")).alias("e"))
    lex = lex.groupBy("token").agg(F.min("e").alias("e")).select("token", F.col("e.p").alias("polarity"), F.col("e.s").alias("subjectivity"))
    if negators is None:
        negators = spark.createDataFrame([], "token string")
    neg = negators.select(F.lower("token").alias("prev_token")).distinct().withColumn("_neg", F.lit(True))
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    toks = tokens_with_previous(rows, "_row", "_text", keep=("_id",))
    hits = toks.join(broadcast_if_few(lex), "token", "left").join(broadcast_if_few(neg), "prev_token", "left")
    pol = F.when(F.col("_neg"), (F.col("polarity") * F.lit(NEGATION_FACTOR).cast("decimal(2,1)"))).otherwise(F.col("polarity")).cast("decimal(20,10)")
    # a text's tokens are in one task, so the shuffle carries one partial row a text
    per_row = hits.groupBy("_row", "_id").agg(F.sum(pol).alias("p"), F.sum("subjectivity").alias("s"), F.count("polarity").alias("n_hits"))
    mean = lambda c: F.when(F.col("n_hits") > 0, F.col(c).cast("double") / F.col("n_hits")).otherwise(F.lit(0.0))
    return per_row.select(
        F.col("_id").alias(id_col), mean("p").alias("polarity"), mean("s").alias("subjectivity"), F.col("n_hits").cast("bigint").alias("n_hits")
    )


def sentiment_prompt(scores: DataFrame, positive: float = prompts.TONE_THRESHOLDS[0],
                     negative: float = prompts.TONE_THRESHOLDS[1]) -> DataFrame:
    """Corpus-level tone suggestion from the mean polarity (zero or one row)."""
    mean = scores.agg(F.avg("polarity").alias("mean_polarity"))
    tone = (
        F.when(F.col("mean_polarity") > positive, F.lit(prompts.POSITIVE_TONE))
        .when(F.col("mean_polarity") < negative, F.lit(prompts.SERIOUS_TONE))
    )
    return mean.select(tone.alias("suggestion")).filter(F.col("suggestion").isNotNull())
