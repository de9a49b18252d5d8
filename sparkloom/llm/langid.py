"""Language identification by hierarchical discrimination.

A text is a vector of hashed counts of its letters' 1- to 3-grams, of length 1.
Linear support vector machines (squared hinge) first choose the language
family, one against the rest; inside a family, one machine for each pair of
its languages votes.  All machines are trained together by accelerated
gradient descent, whose gradients are sums over partitions.

The training sample is bounded: at most about ``PER_LANGUAGE`` documents of each
language, chosen by a hash of the id; every document is predicted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import free_name, staged
from sparkloom.llm.quality import fold_of

PER_LANGUAGE = 1500
SAMPLE_PARTS = 8
BINS = 4096
ROUNDS = 40
RIDGE = 1e-4
SEGMENT = 1 << 20
UNDETERMINED = "und"

# Languages of a family; another language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr sl bs".split(),
    "uralic": "fi et hu".split(),
    "indic": "hi bn mr ne gu pa ur si".split(),
}


def family(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), f"only-{lang}")


def grams(text: str | None) -> np.ndarray | None:
    """The vector of a whole text, or None if it has no letter; long texts are read in segments."""
    if not text or not any(map(str.isalpha, text)):
        return None
    out = np.zeros(BINS)
    for at in range(0, len(text), SEGMENT):
        # two code points more, for grams across the cut; letters as they are in lower case, all else a blank
        part = text[at : at + SEGMENT + 2].lower()
        if not part.isascii():
            part = "".join([c if c.isalpha() else " " for c in part])
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        else:
            codes = np.frombuffer(part.encode(), np.uint8).astype(np.uint32)
            codes = np.where((codes >= 97) & (codes <= 122), codes, 32).astype(np.uint32)
        codes = codes * np.uint32(2654435761)
        key = np.zeros(len(codes), np.uint32)
        for n in (1, 2, 3):
            if len(codes) < n:
                break
            key = (key[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint32(2246822519) + np.uint32(n)
            hashed = key ^ key >> np.uint32(15)
            # grams that begin in the next segment are counted there
            out += np.bincount(hashed[:SEGMENT] % np.uint32(BINS), minlength=BINS)
    out = np.sqrt(out)
    return out / np.linalg.norm(out)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    families: list[str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray  # families, then pairs; the last column is the constant

    def predict(self, x: np.ndarray | None) -> tuple[str, float]:
        if x is None or not self.languages:
            return UNDETERMINED, 0.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        n = len(self.families)
        best = max(range(n), key=lambda i: (margins[i], self.families[i]))
        least = margins[best] if n > 1 else math.inf
        members = [x for x in self.languages if family(x) == self.families[best]]
        votes, total = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for (a, b), m in zip(self.pairs, margins[n:]):
            if a in votes:
                votes[a if m >= 0 else b] += 1
                total[a] += m
                total[b] -= m
        lang = max(members, key=lambda x: (votes[x], total[x], x))  # ties: larger margins, then the name
        for (a, b), m in zip(self.pairs, margins[n:]):
            if lang in (a, b):
                least = min(least, m if lang == a else -m)
        return lang, 1.0 if least == math.inf else 1 / (1 + math.exp(-4 * max(-50.0, min(50.0, least))))


def _vectors(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            x = [grams(t) for t in part.column(0).to_pylist()]
            keep = [i for i, v in enumerate(x) if v is not None]
            places = [np.flatnonzero(x[i]).astype(np.int32) for i in keep]
            values = [x[i][p].astype(np.float32) for i, p in zip(keep, places)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), part.column(1).take(pa.array(keep, pa.int64()))],
                names=["at", "value", "lang"],
            )


def _gradient(weights: np.ndarray, targets: dict[str, np.ndarray]):
    """Sums over a partition: the gradient of each machine's loss and the number of its rows (the last column)."""

    def run(batches):
        total = np.zeros((len(weights), BINS + 2))
        for batch in batches:
            at, value = batch.column(0), batch.column(1)
            y = np.stack([targets[x] for x in batch.column(2).to_pylist()]) if batch.num_rows else np.empty((0, len(weights)))
            for first in range(0, batch.num_rows, 512):
                rows = range(first, min(first + 512, batch.num_rows))
                x = np.zeros((len(rows), BINS + 1))
                x[:, -1] = 1
                for k, r in enumerate(rows):
                    x[k, at[r].values.to_numpy()] = value[r].values.to_numpy()
                t = y[rows.start : rows.stop]
                slack = np.maximum(1 - t * (x @ weights.T), 0) * (t != 0)
                total[:, :-1] -= 2 * (slack * t).T @ x
                total[:, -1] += (t != 0).sum(0)
        yield pa.RecordBatch.from_pylist([{"k": k, "values": v.tolist()} for k, v in enumerate(total)], schema=pa.schema([("k", pa.int32()), ("values", pa.list_(pa.float64()))]))

    return run


def fit(rows: DataFrame, text_col: str, lang_col: str, key: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Train on ``rows`` with a language; ``key`` is hashed to choose about ``per_language`` rows of each language."""
    known = rows.select(F.col(text_col).cast("string").alias("t"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("h")).where("lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    languages = sorted(counts)
    if not languages:
        return Model([], [], [], np.zeros((0, BINS + 1)))
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(int(min(1.0, per_language / n) * (1 << 30)))).otherwise(share)
    sample = staged(known.where(F.col("h") < share).select("t", "lang").mapInArrow(_vectors, "at array<int>, value array<float>, lang string"), "lang-sample")
    # the sample's size doesn't follow the corpus, so neither do its parts: a round brings a fixed number of matrices to the driver
    sample = staged(sample.coalesce(SAMPLE_PARTS), "lang-sample")
    families = sorted({family(x) for x in languages})
    pairs = [(a, b) for a in languages for b in languages if a < b and family(a) == family(b)]
    targets = {
        lang: np.array([1.0 if family(lang) == f else -1.0 for f in families] + [1.0 if lang == a else -1.0 if lang == b else 0.0 for a, b in pairs])
        for lang in languages
    }
    weights = np.zeros((len(families) + len(pairs), BINS + 1))
    ahead, momentum = weights, 1.0
    for _ in range(ROUNDS):
        parts = sample.mapInArrow(_gradient(ahead, targets), "k int, values array<double>").collect()  # a matrix for each of SAMPLE_PARTS parts
        sums = np.zeros((len(weights), BINS + 2))
        for r in parts:
            sums[r["k"]] += r["values"]
        step = 0.25 * (sums[:, :-1] / np.maximum(sums[:, -1:], 1) + RIDGE * ahead)
        new, before = ahead - step, momentum
        momentum = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, weights = new + (before - 1) / momentum * (new - weights), new
    return Model(languages, families, pairs, weights)


def predicted(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; `und` and 0 for null texts and texts without a letter.

    Rows are treated one by one, so ids, null or repeated, don't matter.
    Columns of the two names are replaced, all others stay.
    """

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(grams(t)) for t in texts], columns=["lang", "score"])

    found = free_name(docs, "found")
    cols = [F.col(f"`{c}`") for c in docs.columns if c not in (lang_name, score_name)]
    out = docs.select(*docs.columns, predict(F.col(f"`{text_col}`").cast("string")).alias(found))
    return out.select(*cols, F.col(f"{found}.lang").alias(lang_name), F.col(f"{found}.score").alias(score_name))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out (crc32 of the id modulo 4 is 2: never learnt from), lang_pred, score.

    Rows without an id aren't held out and are learnt from; equal rows get equal results; rows
    without a language are only predicted; other columns aren't read.
    """
    held = F.coalesce(fold_of(id_col, 4) == 2, F.lit(False))
    model = fit(docs.where(~held), text_col, lang_col, F.col(id_col))
    return predicted(docs.select(F.col(id_col), F.col(text_col), held.alias("held_out")), model, text_col).select(id_col, "held_out", "lang_pred", "score")
