"""Tokens, sentences and match offsets as DataFrame columns.

All work is per document row and runs inside whole-stage codegen (regex
extraction, array functions); nothing here shuffles except the optional
window used to turn match lengths into character offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkloom.errors import ValidationError

# Token and sentence patterns (RE2- and Java-compatible).
LETTER_TOKEN = r"\p{L}+"
SENTENCE_SPLIT = r"[.!?\n]+"


def require_text_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValidationError(f"Column '{column}' not found in dataset")
    if not isinstance(df.schema[column].dataType, StringType):
        raise ValidationError(f"Column '{column}' must contain text data, found {df.schema[column].dataType.simpleString()}")


def by_document(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_doc, text, copies)``: each distinct (id, text) once, hash-partitioned by ``_doc``.

    ``_doc`` (id and hash of the text) is never null, so documents without an id
    stay, and documents that share an id (or have none) stay apart.  It follows
    from the rows alone: jobs that read the input in several branches find the
    same key in each, which a row number doesn't promise.  Copies are counted
    map-side; ``rows_of`` gives each its rows again.

    Every later aggregate or join in the text features is keyed by
    ``(_doc, ...)``, which this partitioning already satisfies, so the whole
    feature job needs this one shuffle of the raw text instead of several
    shuffles of exploded tokens (which are larger than the text).
    Documents are bounded in length, so one document never overloads a task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).alias("id"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("hash"))
    return df.select(key.alias("_doc"), text.alias("text")).groupBy("_doc").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def rows_of(out: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """``out`` keyed by the ``_doc`` of ``docs`` (see ``by_document``) as rows of the id, once for every copy."""
    rest = [c for c in out.columns if c != "_doc"]
    copies = out.join(docs.select("_doc", "copies").hint("shuffle_hash"), "_doc")
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return copies.select(F.col("_doc.id").alias(id_col), *rest)


def token_array(text: Column, pattern: str = LETTER_TOKEN, lower: bool = True) -> Column:
    """Tokens of ``text``; with ``lower`` the text is lower-cased first (same tokens as
    lower-casing each token, without an interpreted per-element lambda)."""
    t = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(F.lower(t) if lower else t, F.lit(pattern), 0)


def tokens(df: DataFrame, id_col: str, text_col: str, pattern: str = LETTER_TOKEN, lower: bool = True,
           min_len: int = 1, max_len: int | None = None) -> DataFrame:
    """``(id, pos, token)``, one row per token in text order."""
    require_text_column(df, text_col)
    out = df.select(F.col(id_col), F.posexplode(token_array(F.col(text_col), pattern, lower)).alias("pos", "token"))
    if min_len > 1:
        out = out.filter(F.length("token") >= min_len)
    if max_len is not None:
        out = out.filter(F.length("token") <= max_len)
    return out


def tokens_with_previous(df: DataFrame, id_col: str, text_col: str, pattern: str = LETTER_TOKEN, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, pos, token, prev_token)`` without a window: the previous token comes from
    the same array shifted by one, zipped before exploding (no per-row array copies).  A text
    without tokens has one row with a null token."""
    toks = token_array(F.col(text_col), pattern)
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0))))
    zipped = F.arrays_zip(toks.alias("token"), prev.alias("prev_token"))
    return df.select(F.col(id_col), *keep, F.posexplode_outer(zipped).alias("pos", "z")).select(
        id_col, *keep, "pos", F.col("z.token").alias("token"), F.col("z.prev_token").alias("prev_token")
    )


def sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, sent_idx, sentence)`` for non-blank sentences."""
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), SENTENCE_SPLIT, -1)
    out = df.select(F.col(id_col), F.posexplode(parts).alias("sent_idx", "sentence"))
    return out.filter(F.length(F.trim("sentence")) > 0)


def rule_steps(df: DataFrame, rules: list, keep: tuple[str, ...], text_col: str = "_text") -> DataFrame:
    """``(*keep, priority, label, idx, match, step)`` of all ``rules`` (priority, label, pattern, guard) in one scan of the
    text: ``step`` = gap before the match + match length; texts that fail a rule's guard skip it."""
    text = F.col(text_col)
    found = df.select(
        *keep,
        *(F.when(guard, F.regexp_extract_all(text, F.lit(pattern), 0)).alias(f"_m{n}") for n, (_, _, pattern, guard) in enumerate(rules)),
        *(F.when(guard, F.split(text, pattern, -1)).alias(f"_g{n}") for n, (_, _, pattern, guard) in enumerate(rules)),
    )

    def steps(n: int, priority: int, label: str | None) -> Column:
        matches = F.coalesce(F.col(f"_m{n}"), F.array().cast("array<string>"))
        gaps = F.coalesce(F.col(f"_g{n}"), F.array().cast("array<string>"))
        pairs = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"))
        return F.transform(pairs, lambda p, i: F.struct(
            F.lit(priority).alias("priority"), F.lit(label).cast("string").alias("label"), i.alias("idx"), p["match"].alias("match"),
            (F.length(p["gap"]) + F.length(p["match"])).alias("step"),
        ))

    every = F.concat(*(steps(n, priority, label) for n, (priority, label, _, _) in enumerate(rules)))
    return found.select(*keep, F.explode(every).alias("_s")).select(*keep, "_s.*")


def offsets_from_steps(steps: DataFrame, id_col: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Running sum of steps per ``(id, *keys)`` ordered by match index -> ``start``/``end``."""
    w = Window.partitionBy(id_col, *keys).orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = steps.withColumn("end", F.sum("step").over(w).cast("int"))
    out = out.withColumn("start", (F.col("end") - F.length("match")).cast("int"))
    return out.filter(F.length("match") > 0)


def match_offsets(df: DataFrame, id_col: str, text_col: str, pattern: str) -> DataFrame:
    """``(id, idx, start, end, match)`` for every non-empty match of ``pattern``.

    Spark has no all-matches position function, so offsets are rebuilt from
    the matches and the gaps between them: with ``m = regexp_extract_all``
    and ``g = split`` on the same pattern, ``start_i = sum(len g_k, k <= i) +
    sum(len m_k, k < i)``.  The running sum is a window per row (ordered
    by match index), whatever its id; a row's matches are bounded by its length.
    """
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    steps = rule_steps(rows, [(0, None, pattern, F.lit(True))], ("_row", "_id"))
    return offsets_from_steps(steps, "_row").select(F.col("_id").alias(id_col), "idx", "start", "end", "match")
