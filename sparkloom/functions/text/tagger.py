"""Statistical entities: a sequence tagger learnt from labelled spans.

Tokens carry hashed features (word, shape, beginning and end, each of the token
itself and of its neighbours); a label is O, or the beginning or inside of an
entity type.  A structured averaged perceptron weighs features and pairs of
neighbouring labels; Viterbi finds the best labels of a sentence.

Training is distributed by iterative parameter mixing: in each round every
part of the training rows starts from the shared weights, goes through its sentences and
returns what it changed, in its weights and in their average over its steps; the mean over the
parts that changed a feature, taken by feature in Spark, makes the next start.  The training rows are a bounded
sample (``TRAINING_DOCS`` texts; of sentences without an entity one in ``PLAIN_SENTENCES``), dealt into a fixed number of parts, and the weights are a
fixed table (``BINS`` x labels), so neither follows the corpus.  Tagging is
narrow: a text is tagged where it is read, whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkloom.functions.text import entities
from sparkloom.functions.text.tokens import require_text_column
from sparkloom.session import staging_path

BINS = 1 << 15
TRAINING_DOCS = 4000
PARTS = 4
ROUNDS = 12
PLAIN_SENTENCES = 4  # of sentences without an entity, one in so many is learnt from
MINIBATCH = 16
WORDS_AT_ONCE = 4096  # scored together; a longer sentence alone
SLACK = 1e-3  # far above what rounding changes in a path's score
MEMO_WORDS = 200_000
WORD_FEATURES = 4
NEIGHBOURS = (-2, -1, 0, 1, 2)
SPREAD = np.cumsum(np.full(len(NEIGHBOURS) + 1, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

TOKEN = re.compile(r"\d+|[^\W\d_]+|[^\w\s]|_")


def shape(word: str) -> str:
    """Letters as X (capital or uncased) and x, digits as their number; other characters as they are."""
    if word.isdigit():
        return f"d{min(len(word), 9)}"
    out = "".join("X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    return re.sub(r"(.)\1+", r"\1+", out)


def _word_hashes(word: str) -> list[int]:
    low = word.lower()
    return [zlib.crc32(x.encode("utf-8", "replace")) for x in ("w" + low, "s" + shape(word), "b" + low[:3], "e" + low[-3:])]


_memo: dict[str | None, int] = {}  # a word's row in ``_bins``; None stands for what lies beyond a sentence's ends
_bins = np.empty((0, len(NEIGHBOURS) * WORD_FEATURES), np.int64)


def _rows_of(words: list[str | None]) -> np.ndarray:
    """Rows of ``_bins``: for each neighbour's place, the bins of the word's features there.  A full memo starts anew."""
    global _bins
    new = [w for w in dict.fromkeys(words) if w not in _memo]
    if new and len(_memo) + len(new) > MEMO_WORDS:
        _memo.clear()
        new = list(dict.fromkeys(words))
    if new:
        edge = np.arange(1, WORD_FEATURES + 1, dtype=np.uint64)
        own = np.array([edge if w is None else _word_hashes(w) for w in new], np.uint64)
        h = [(own + edge * SPREAD[0] + SPREAD[n + 1]) * SPREAD[0] for n in range(len(NEIGHBOURS))]
        first, last = len(_memo), len(_memo) + len(new)
        if last > len(_bins):
            _bins = np.vstack([_bins[:first], np.empty((2 * last - first, _bins.shape[1]), np.int64)])
        _bins[first:last] = (np.hstack(h) >> np.uint64(32)) % np.uint64(BINS)
        _memo.update(zip(new, range(first, last)))
    return np.fromiter(map(_memo.__getitem__, words), np.int64, len(words))


def features(words: list[str], sizes: np.ndarray | None = None) -> np.ndarray:
    """A row of feature bins for each word of a sentence, or of sentences of ``sizes`` words; beyond a sentence's ends lies an edge mark."""
    sizes = np.array([len(words)]) if sizes is None else sizes
    reach = max(map(abs, NEIGHBOURS))
    rows = _rows_of([None, *words])
    padded = np.full(len(words) + 2 * reach * len(sizes), rows[0])
    at = np.arange(len(words)) + reach + 2 * reach * np.repeat(np.arange(len(sizes)), sizes)
    padded[at] = rows[1:]
    return np.hstack([_bins[padded[at + shift], n * WORD_FEATURES : (n + 1) * WORD_FEATURES] for n, shift in enumerate(NEIGHBOURS)])


def tokens_of(text: str) -> list[list[tuple[str, int, int]]]:
    """Sentences of (word, start, end); one ends at a line feed and behind a full stop, ! or ? that a blank follows."""
    out: list[list[tuple[str, int, int]]] = []
    current: list[tuple[str, int, int]] = []
    last = 0
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if start > last and current and (current[-1][0] in ".!?" or text.find("\n", last, start) >= 0):
            out.append(current)
            current = []
        current.append((m[0], start, end))
        last = end
    return [*out, current] if current else out


def viterbi(emissions: list[np.ndarray], transitions: np.ndarray) -> list[np.ndarray]:
    """The labels of greatest total score for each sentence (words x labels), all sentences a word at a time; ties go to the first label."""
    if not emissions:
        return []
    size = np.array([len(e) for e in emissions])
    order = np.argsort(-size, kind="stable")
    ordered = size[order]
    width, labels = int(ordered[0]), len(transitions)
    table = np.zeros((len(order), width, labels))
    for row, i in enumerate(order):
        table[row, : size[i]] = emissions[i]
    back = np.zeros((len(order), width, labels), np.int16)
    score = table[:, 0].copy()
    for t in range(1, width):
        live = int(np.searchsorted(-ordered, -t, side="left"))  # sentences of more than t words come first
        through = score[:live, :, None] + transitions[None]
        back[:live, t] = through.argmax(axis=1)
        score[:live] = through.max(axis=1) + table[:live, t]
    rows = np.arange(len(order))
    best = np.zeros((len(order), width), np.int64)
    at = score.argmax(axis=1)
    for t in range(width - 1, -1, -1):
        here = ordered > t
        best[here, t] = at[here]
        at = np.where(here, back[rows, t, at], at)
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(emissions)
    for row, i in enumerate(order):
        out[i] = best[row, : size[i]]
    return out


@dataclass(frozen=True)
class Tagger:
    labels: list[str]  # O, then B-type and I-type in turn
    weights: np.ndarray  # BINS x labels
    transitions: np.ndarray  # labels x labels

    def emissions(self, words: list[str], sizes: np.ndarray | None = None) -> np.ndarray:
        bins = features(words, sizes)
        out = self.weights[bins[:, 0]]
        for column in bins.T[1:]:
            out += self.weights[column]
        return out

    def _entity_possible(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """False for sentences (of ``sizes`` words) whose best path is surely O throughout.

        What a path gains over it is a sum over its words beyond O: the label's score over that of O,
        and what the steps around the word gain over O to O (half of a step between two such words).
        If that is negative for each word and label, no path gains.
        """
        if len(self.labels) == 1:
            return np.zeros(len(sizes), bool)
        steps = self.transitions - self.transitions[0, 0]
        into = np.maximum(steps[0, 1:], steps[1:, 1:].max(axis=0) / 2)
        out_of = np.maximum(steps[1:, 0], steps[1:, 1:].max(axis=1) / 2)
        gain = scores[:, 1:] - scores[:, :1]
        inner = np.ones((2, len(scores), 1))
        first = np.cumsum(sizes) - sizes
        inner[0, first] = inner[1, first + sizes - 1] = 0
        gain += inner[0] * into + inner[1] * out_of
        return np.maximum.reduceat(gain.max(axis=1), first) > -SLACK

    def _found(self, sentences: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, int, str]]]:
        """The entities of each sentence."""
        sizes = np.array([len(s) for s in sentences])
        scores = self.emissions([w for s in sentences for w, _, _ in s], sizes)
        out: list[list[tuple[int, int, str]]] = [[] for _ in sentences]
        open_ = np.flatnonzero(self._entity_possible(scores, sizes))
        ends = np.cumsum(sizes)
        for i, best in zip(open_, viterbi([scores[ends[i] - sizes[i] : ends[i]] for i in open_], self.transitions)):
            out[i] = _spans(sentences[i], [self.labels[x] for x in best])
        return out

    def spans_of(self, texts: Iterable[str]) -> list[list[tuple[int, int, str]]]:
        """(start, end, type) of the entities in each of the whole texts; sentences of several texts are scored together."""
        out: list[list[tuple[int, int, str]]] = []
        some: list[list[tuple[str, int, int]]] = []
        owners: list[int] = []
        words = 0

        def flush() -> None:
            for owner, found in zip(owners, self._found(some) if some else []):
                out[owner] += found
            some.clear()
            owners.clear()

        for n, text in enumerate(texts):
            out.append([])
            for sentence in tokens_of(text):
                if words + len(sentence) > WORDS_AT_ONCE:
                    flush()
                    words = 0
                some.append(sentence)
                owners.append(n)
                words += len(sentence)
        flush()
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, type) of the entities in a whole text."""
        return self.spans_of([text])[0]


def _spans(sentence: list[tuple[str, int, int]], labels: Iterable[str]) -> list[tuple[int, int, str]]:
    out: list[list] = []
    kind = None
    for (_, start, end), label in zip(sentence, labels):
        if label == "O":
            kind = None
        elif label[0] == "B" or kind != label[2:]:
            kind = label[2:]
            out.append([start, end, kind])
        else:
            out[-1][1] = end
    return [tuple(x) for x in out]


def bio(sentence: list[tuple[str, int, int]], spans: list[tuple[int, int, str]], number: dict[str, int]) -> np.ndarray:
    """Labels of a sentence's words; a word that a span covers in part stays O."""
    out = np.zeros(len(sentence), np.int64)
    for i, (_, start, end) in enumerate(sentence):
        for a, b, kind in spans:
            if a <= start and end <= b:
                out[i] = number["B-" + kind] if start == a or not i or not out[i - 1] else number["I-" + kind]
    return out


def _part(rows: pd.DataFrame, weights: np.ndarray, transitions: np.ndarray, labels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The part's weights (transitions below) after one pass, and their mean over the steps."""
    number = {x: i for i, x in enumerate(labels)}
    examples = []
    for text, spans in zip(rows["text"], rows["spans"]):
        spans = sorted((s["start"], s["end"], s["label"]) for s in spans)
        at = 0
        for sentence in tokens_of(text):
            while at < len(spans) and spans[at][1] <= sentence[0][1]:
                at += 1
            own = [s for s in spans[at : at + len(sentence) + 1] if s[0] < sentence[-1][2]]
            words = [w for w, _, _ in sentence]
            if own or zlib.crc32(" ".join(words).encode("utf-8", "replace")) % PLAIN_SENTENCES == 0:
                examples.append((words, bio(sentence, own, number)))
    sizes = np.array([len(words) for words, _ in examples], np.int64)
    bins = features([w for words, _ in examples for w in words], sizes)
    examples = [(bins[end - size : end], y) for (_, y), size, end in zip(examples, sizes, np.cumsum(sizes))]
    table = np.vstack([weights, transitions])
    late = np.zeros_like(table)  # each change times the step it came at
    step = 1
    for at in range(0, len(examples), MINIBATCH):
        some = examples[at : at + MINIBATCH]
        guessed = viterbi([table[x].sum(axis=1) for x, _ in some], table[BINS:])
        for guess, (x, y) in zip(guessed, some):
            wrong = np.flatnonzero(guess != y)
            if not len(wrong):
                continue
            for sign, side in ((1.0, y), (-1.0, guess)):
                at_word = x[wrong], side[wrong][:, None]
                np.add.at(table, at_word, sign)
                np.add.at(late, at_word, sign * step)
                if len(y) > 1:
                    np.add.at(table, (BINS + side[:-1], side[1:]), sign)
                    np.add.at(late, (BINS + side[:-1], side[1:]), sign * step)
        step += 1
    return table, table - late / step


def _mixed(sample: DataFrame, table: np.ndarray, labels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One round: the weights (transitions below) and the averaged weights, from the parts' mean changes of each feature."""
    shared = sample.sparkSession.sparkContext.broadcast((table, labels))
    n_labels = len(labels)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        base, labels = shared.value
        new, mean = _part(rows.sort_values("key"), base[:BINS], base[BINS:], labels)
        changes = np.hstack([new - base, mean - base])
        used = np.flatnonzero(changes.any(axis=1))
        return pd.DataFrame({"bin": used, "changes": pd.Series(list(changes[used]), dtype=object)})

    # parts are as many tasks, however small
    dealt = sample.repartition(sample.select("part").distinct().count() or 1, "part")
    each = dealt.groupBy("part").applyInPandas(run, "bin int, changes array<double>").groupBy("bin").agg(F.sort_array(F.collect_list("changes")).alias("each"))
    zero = F.array_repeat(F.lit(0.0), 2 * n_labels)
    total = F.aggregate("each", zero, lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    out = np.hstack([table, table])
    for r in each.select("bin", F.size("each").alias("n"), total.alias("total")).collect():  # at most a row for each bin: the weights' own size
        out[r["bin"]] += np.array(r["total"]) / r["n"]
    return out[:, :n_labels], out[:, n_labels:]


def fit(labelled: DataFrame, rounds: int = ROUNDS, parts: int = PARTS) -> Tagger:
    """Learn from ``labelled(key, text, spans)``: spans are structs (start, end, label) in code points, keys unique."""
    spark = labelled.sparkSession
    path = staging_path(spark, "tagger")
    labelled.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")).write.parquet(path)
    sample = spark.read.parquet(path)
    kinds = [r["label"] for r in sample.select(F.explode("spans").alias("s")).select("s.label").distinct().orderBy("label").collect()]
    labels = ["O", *(f"{x}-{k}" for k in kinds for x in "BI")]
    table = mean = np.zeros((BINS + len(labels), len(labels)))
    for _ in range(rounds if kinds else 0):
        table, mean = _mixed(sample, table, labels)
    return Tagger(labels, mean[:BINS], mean[BINS:])


def labelled_by_rules(df: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame | None = None, docs: int = TRAINING_DOCS) -> DataFrame:
    """(key, text, spans): a sample of about ``docs`` distinct texts, chosen by hash, with the spans that rules and gazetteer find."""
    require_text_column(df, text_col)
    texts = df.select(F.xxhash64(F.col(id_col).cast("string"), text_col).alias("key"), F.col(text_col).alias("text")).where("text <> ''")
    count = df.agg(F.count(F.lit(1))).first()[0]
    share = int(min(1.0, docs / max(count, 1)) * (1 << 30))
    spark, path = df.sparkSession, staging_path(df.sparkSession, "tagger-texts")
    texts.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) < share).dropDuplicates(["key"]).write.parquet(path)
    chosen = spark.read.parquet(path)
    found = entities.extract_entities(chosen, "key", "text", gazetteer)
    spans = found.groupBy("key").agg(F.collect_list(F.struct("start", "end", "label")).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    return chosen.join(spans, "key", "left").select("key", "text", F.coalesce("spans", none).alias("spans"))


def tagged(df: DataFrame, id_col: str, text_col: str, tagger: Tagger) -> DataFrame:
    """``(id, start, end, label, text)`` of every entity that the tagger finds in every row; null texts have none, ids may be null or repeat."""
    require_text_column(df, text_col)
    shared = df.sparkSession.sparkContext.broadcast(tagger)
    of_id = df.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(of_id)), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                keys, texts = (c.to_pylist() for c in batch.slice(at, 128).columns)
                found = shared.value.spans_of(t or "" for t in texts)
                rows = [(key, a, b, kind, text[a:b]) for key, text, spans in zip(keys, texts, found) for a, b, kind in spans]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = f"id {of_id.simpleString()}, start int, end int, label string, text string"
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ddl).withColumnRenamed("id", id_col)
