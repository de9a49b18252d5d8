"""Rule-based entities with character offsets, plus a gazetteer.

Each rule is a regex; every match becomes ``(id, start, end, label, text)``
with end-exclusive character offsets.  Overlaps are resolved by rule
priority: a match is dropped when it overlaps a kept match of a higher-priority
rule.  That test is a sweep over the matches of one document ordered by
start offset (two running window aggregates per priority level, one in each
direction), linear in the matches.  All rules read a text in one scan.

Matches belong to a row, numbered in the scan, not to an id: rows that share
an id, or have none, keep their own offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import prompts
from sparkloom.functions.text.tokens import (
    LETTER_TOKEN, offsets_from_steps, require_text_column, rule_steps,
)
from sparkloom.operators.broadcast import broadcast_if_small

# Entity rules in priority order (first wins on overlap; the
# more specific DATE pattern outranks the looser PHONE one).
# Repeated groups are bounded (a host has at most ten labels of 63 characters): the
# regex engine recurses for each repeat.
# No \b: word boundaries differ between Java and RE2 next to non-ASCII letters.
ENTITY_RULES: tuple[tuple[str, str], ...] = (
    ("EMAIL", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,63}"),
    ("URL", r"https?://[A-Za-z0-9._~:/?#@!$&'*+,;=%-]+"),
    ("IP", r"(?:\d{1,3}\.){3}\d{1,3}"),
    ("DATE", r"\d{4}-\d{2}-\d{2}"),
    ("PHONE", r"\+?\d[\d -]{6,}\d"),
    ("MONEY", r"[$€£]\d+(?:[.,]\d+)?"),
    ("PERCENT", r"\d+(?:\.\d+)?%"),
    ("CARDINAL", r"\d+"),
)

# A character class every match of the rule must contain; texts
# without it skip the rule's two regex passes (results are unchanged).
RULE_REQUIRES: dict[str, str] = {
    "EMAIL": "@",
    "URL": "://",
    "IP": "[0-9]",
    "DATE": "[0-9]",
    "PHONE": "[0-9]",
    "MONEY": "[$€£]",
    "PERCENT": "%",
    "CARDINAL": "[0-9]",
}

GAZETTEER_LABEL_PRIORITY = len(ENTITY_RULES)


def _may_match(text: Column, label: str) -> Column:
    need = RULE_REQUIRES.get(label)
    if need is None:
        return F.lit(True)
    return text.rlike(need) if need.startswith("[") else F.instr(text, need) > 0


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_row, _id, _text)``: every input row with a number of its own."""
    return df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def rule_matches(rows: DataFrame, rules=ENTITY_RULES, tokens_as: int | None = None) -> DataFrame:
    """All matches of all rules in ``numbered`` rows: ``(_row, _id, start, end, label, text, priority)`` (overlaps kept).

    One scan finds the matches of every rule, and of letter tokens as
    priority ``tokens_as``; the offset window ``(_row, priority)`` and the overlap
    window ``(_row)`` both run on one shuffle of matches by row.
    """
    labelled = [(prio, label, pattern) for prio, (label, pattern) in enumerate(rules)]
    if tokens_as is not None:
        labelled.append((tokens_as, None, LETTER_TOKEN))
    text = F.col("_text")
    steps = rule_steps(rows, [(prio, label, pattern, _may_match(text, label)) for prio, label, pattern in labelled], ("_row", "_id"))
    m = offsets_from_steps(steps.repartition("_row"), "_row", ("priority",))
    return m.select("_row", "_id", "start", "end", "label", F.col("match").alias("text"), "priority")


def _in_gazetteer(matches: DataFrame, gazetteer: DataFrame, priority: int) -> DataFrame:
    """``matches`` without the letter tokens (of ``priority``) that ``gazetteer(token, label)`` lacks, the others labelled by it
    (broadcast, size-checked).  A join, not a union of two scans: row numbers hold within one scan."""
    gz = gazetteer.select(F.lower("token").alias("_token"), F.col("label").alias("_label")).dropDuplicates(["_token"])
    token = F.when(F.col("priority") == priority, F.lower("text"))
    joined = matches.withColumn("_word", token).join(broadcast_if_small(gz), F.col("_word") == F.col("_token"), "left")
    kept = joined.where((F.col("priority") != priority) | F.col("_label").isNotNull())
    return kept.withColumn("label", F.coalesce("label", "_label")).select(matches.columns)


def resolve_overlaps(matches: DataFrame, id_col: str, n_levels: int) -> DataFrame:
    """Keep a match unless a kept match of strictly higher priority (lower number) overlaps it.

    Level by level, over the document's matches ordered by start: ``max end`` of the
    kept matches that start at or before this one, and ``min start`` of those that start
    after it, as running aggregates.  [s, e) and [s', e') overlap if s < e' and s' < e.
    """
    before = Window.partitionBy(id_col).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(id_col).orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, -1)
    out = matches.withColumn("_kept", F.col("priority") == 0)
    for p in range(1, n_levels):
        out = out.withColumn("_e", F.max(F.when(F.col("_kept"), F.col("end"))).over(before))
        out = out.withColumn("_s", F.min(F.when(F.col("_kept"), F.col("start"))).over(after))
        free = (F.coalesce("_e", F.lit(-1)) <= F.col("start")) & (F.coalesce("_s", F.lit(2**31 - 1)) >= F.col("end"))
        out = out.withColumn("_kept", F.when(F.col("priority") == p, free).otherwise(F.col("_kept")))
    return out.filter("_kept").drop("_e", "_s", "_kept")


def extract_entities(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame | None = None,
                     rules=ENTITY_RULES) -> DataFrame:
    """``(id, start, end, label, text)`` for every kept entity of every row; ids may be null or repeat."""
    require_text_column(df, text_col)
    levels = len(rules)
    rows = numbered(df, id_col, text_col)
    if gazetteer is None:
        m = rule_matches(rows, rules)
    else:
        m = _in_gazetteer(rule_matches(rows, rules, tokens_as=levels), gazetteer, levels)
        levels += 1
    return resolve_overlaps(m, "_row", levels).select(F.col("_id").alias(id_col), "start", "end", "label", "text")


def entity_prompts(entities: DataFrame) -> DataFrame:
    """One suggestion per distinct label: ``Include <label> elements in the generation``."""
    labels = entities.select(F.lower("label").alias("label")).distinct()
    head, tail = prompts.ENTITY_TEMPLATE
    return labels.select(F.concat(F.lit(head), F.col("label"), F.lit(tail)).alias("suggestion"))
