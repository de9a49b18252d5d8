"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to k edits (k grows with the
item's length).  Cut the item into k + 1 pieces: k edits can't touch them all,
so every occurrence holds at least one piece unchanged.  An Aho-Corasick
automaton over all pieces finds the exact hits in one pass over a text; each
hit says where the item would lie, and Myers' bit-parallel distance verifies
the region around it.

Scale.  The test items are the stated query set: they're taken in blocks of at
most ``BLOCK_CHARS`` characters, and each block's items are broadcast (that
bound is their size) and matched against all documents in a narrow pass; the
documents are never shuffled.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_rows, arrow_schema, bounded_batches, free_name, held, staged

CHARS_PER_EDIT = 20
BLOCK_CHARS = 8_000_000


def normalised(text: str | None) -> str:
    """Lower case, every run of white space one space; matching and offsets use this form."""
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 pieces (offset, text) of nearly equal length that together are the item."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, budget: int) -> list[tuple[int, int]]:
    """Ends (exclusive) and distances at which ``pattern`` matches some substring of ``text`` within ``budget`` edits.

    Bit-vector form of the dynamic programme: vertical differences of a
    column are two words; a Python integer is a word of any length.
    """
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, found = full, 0, m, []
    for at, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(zero | plus) & full
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(zero | up) & full
        minus = up & zero
        if score <= budget:
            found.append((at, score))
    return found


def best_match(item: str, text: str, budget: int) -> tuple[int, int, int] | None:
    """(start, end, distance) of the nearest occurrence of ``item`` in ``text``: fewest edits, then the first end, then the longest span."""
    ends = myers(item, text, budget)
    if not ends:
        return None
    end, distance = min(ends, key=lambda x: (x[1], x[0]))
    back = [e for e, d in myers(item[::-1], text[:end][::-1][: len(item) + budget], budget) if d == distance]
    return end - max(back), end, distance


class Matcher:
    """The automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, t, len(t) // CHARS_PER_EDIT) for i, t in items]
        holders: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                holders.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in holders.items():
            self.automaton.add_word(piece, (len(piece), where))
        if holders:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, distance) of every region of ``text`` that holds an item."""
        regions: dict[int, list[list[int]]] = {}
        if not self.items or not text:
            return []
        for last, (length, where) in self.automaton.iter(text):
            for n, offset in where:
                _, item, budget = self.items[n]
                begin = last + 1 - length - offset  # the item's start if nothing before the piece was edited
                low, high = max(0, begin - budget), min(len(text), begin + len(item) + budget)
                spans = regions.setdefault(n, [])
                if spans and low <= spans[-1][1] - len(item) + budget:  # the same occurrence, seen by another piece
                    spans[-1][0], spans[-1][1] = min(low, spans[-1][0]), max(high, spans[-1][1])
                else:
                    spans.append([low, high])
        out = []
        for n, spans in regions.items():
            item_id, item, budget = self.items[n]
            for low, high in spans:
                if hit := best_match(item, text[low:high], budget):
                    out.append((item_id, low + hit[0], low + hit[1], hit[2]))
        return sorted(set(out))


def _matched(items, token: str, schema: pa.Schema):
    def run(rows: list[dict]) -> list[dict]:
        matcher = held(token, lambda: Matcher(items.value))  # a worker holds one block's automaton
        return [
            {"id": r["id"], "item_id": i, "match_start": a, "match_end": b, "distance": d}
            for r in rows
            for i, a, b, d in matcher.matches(normalised(r["text"]))
        ]

    return arrow_rows(run, schema)


def _normalised_items(items: DataFrame) -> DataFrame:
    """``items(i, t)`` with distinct normalised texts that aren't empty, computed in the tasks."""
    of_id = items.schema["i"].dataType.simpleString()
    schema = f"i {of_id}, t string"

    def run(batches):
        for batch in batches:
            ids, texts = batch.columns
            yield pa.RecordBatch.from_arrays([ids, pa.array([normalised(t.as_py()) for t in texts], pa.string())], names=["i", "t"])

    return items.mapInArrow(run, schema).where("t <> ''").distinct()


def item_blocks(benchmark: DataFrame, id_col: str | None, text_col: str):
    """The distinct normalised test items with any text, in blocks of at most ``BLOCK_CHARS`` characters (or one item).

    With ``id_col`` items are pairs of an id (not null) and a text; without,
    distinct texts.  Rows are numbered by a hash of id and text, and blocks cut
    by the characters that lie before; a block's size is checked before it is handed on.
    """
    chosen = F.col(id_col) if id_col else F.lit(0)
    items = benchmark.select(chosen.alias("i"), F.col(text_col).cast("string").alias("t")).where("i is not null and t is not null")
    items = staged(_normalised_items(items).withColumn("h", F.xxhash64("i", "t")), "items")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = 2 * (total // BLOCK_CHARS) + 1  # so that a part is seldom over the bound

    def cut(rows):
        block, chars = [], 0
        for r in rows:
            if block and chars + len(r["t"]) > BLOCK_CHARS:
                yield sorted(block)
                block, chars = [], 0
            block.append((r["i"], r["t"]))
            chars += len(r["t"])
        if block:
            yield sorted(block)

    for p in range(parts if total else 0):
        yield from cut(items.where(F.pmod("h", F.lit(parts)) == p).toLocalIterator())
    if not total:
        yield []


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per region of a document that holds a test item: id, item_id, match_start, match_end (code points of the
    normalised text), distance (edits, at most one per ``CHARS_PER_EDIT`` characters of the item).

    Nulls and empty texts match nothing; equal rows give equal rows; items
    without an id or without any text are passed over; an item of under
    ``CHARS_PER_EDIT`` characters must occur exactly.  Other columns aren't read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    of_id, of_item = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_col)))
    ddl = f"id {of_id}, item_id {of_item}, match_start long, match_end long, distance int"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    out = None
    for items in item_blocks(benchmark, item_col, item_text):
        shared = spark.sparkContext.broadcast(items)
        token = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
        part = rows.mapInArrow(_matched(shared, token, arrow_schema(ddl)), ddl)
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("id", id_col)


def without_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a test item, with an id or not; columns as before.

    The decision is made in the documents' own pass, so nothing is shuffled.
    """
    spark, leak = docs.sparkSession, free_name(docs, "leak")
    bounded_batches(spark)
    out = docs.withColumn(leak, F.lit(False))
    for items in item_blocks(benchmark, None, "text"):
        shared = spark.sparkContext.broadcast(items)
        token = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
        out = out.mapInArrow(_flagged(shared, token, text_col), out.schema)
    return out.where(~F.col(leak)).drop(leak)


def _flagged(items, token: str, text_col: str):
    def run(batches):
        for batch in batches:
            matcher = held(token, lambda: Matcher(items.value))
            *rest, leak = batch.columns
            texts = batch.column(batch.schema.get_field_index(text_col))
            found = [old or bool(matcher.matches(normalised(t.as_py()))) for t, old in zip(texts, leak.to_pylist())]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.bool_())], names=batch.schema.names)

    return run
