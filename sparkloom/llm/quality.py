"""Quality classifier: ridge regression on random Fourier features of document statistics, with isotonic calibration.

The statistics of a text (lengths, character classes, repetition, entropy) are
standardised; ``cos(w x + b)`` for random w and b approximates a Gaussian
kernel; each partition sums its rows' part of the normal equations and the
sums are added by coordinate.  The driver sees matrices of the features' number
alone, never rows.  A second fold of the labelled rows, summed in bins of the
raw score, gives the isotonic (non-decreasing) map to probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from sparkloom.llm.common import bounded_batches, free_name, let_go, staged

FEATURES = 256
RIDGE = 1e-2
WIDTH = 1.5  # of the kernel, in units of the square root of the number of statistics
BINS = 1000  # of raw scores, for calibration
SEED = 20240229
PARTS = pa.schema([("part", pa.int32()), ("k", pa.int32()), ("values", pa.list_(pa.float64()))])
THRESHOLD = 0.3

_classes = np.zeros((256, 8))
for _b in range(256):
    _c = chr(_b)
    _classes[_b] = (
        _b < 128 and _c.isupper(), _b < 128 and _c.islower(), _b < 128 and _c.isdigit(), _c in ".,;:?'\"-()", _c in "!|#$%&*@<>{}[]\\/^~=+_`",
        _c == " ", _c in "\n\r", _b >= 128,
    )
_end_mark = re.compile(r"[.?](?:\s|$)")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; null is read as empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    size = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts[counts > 0] / size
    words = text.split()
    n = max(len(words), 1)
    often = Counter(words)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = [x for x in text.split("\n") if x]
    window = words[: len(words) // 2 * 2]
    pairs = Counter(zip(words, words[1:]))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), float(lengths.mean()), float(lengths.std()), math.log1p(float(lengths.max())),
        *(counts @ _classes / size).tolist(), float(-(share * np.log2(share)).sum()),
        len(often) / n, max(often.values(), default=0) / n, sum(map(eq, words, words[1:])) / n,
        len(pairs) / n, max(pairs.values(), default=0) / n, len(set(lines)) / max(len(lines), 1), len(lines) / n,
        len(_end_mark.findall(text)) / n, sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n, sum(w.isalpha() for w in window) / n,
    ]


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score; a few hundred kB, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores
    levels: np.ndarray  # probabilities, non-decreasing

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.omega + self.phase) * math.sqrt(2 / self.omega.shape[1]), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.edges, self.levels), 0, 1)


def isotonic(x: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: weighted means of ``ones / total`` along ``x``, merged until none falls."""
    pools: list[list[float]] = []  # weight, ones, first x, last x
    for at, w, y in zip(x, total, ones):
        if not w:
            continue
        pools.append([w, y, at, at])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, y2, _, last = pools.pop()
            pools[-1][0] += w2
            pools[-1][1] += y2
            pools[-1][3] = last
    if not pools:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    # one row of each label more keeps small pools from 0 and 1
    level = [(y + 0.5) / (w + 1) for w, y, _, _ in pools]
    level = np.maximum.accumulate(level)
    edges = [e for _, _, a, b in pools for e in (a, b + 1e-9)]
    return np.array(edges), np.repeat(level, 2)


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Rows (k, values) added by k: one short row for each coordinate comes back."""
    add = parts.groupBy("k").applyInPandas(lambda f: pd.DataFrame({"k": f["k"][:1], "values": [np.sum(np.stack(f.sort_values("part")["values"].to_list()), axis=0)]}), "k int, values array<double>")
    return {r["k"]: np.array(r["values"]) for r in add.collect()}


def _stacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, -1)
    return x, np.array(batch.column("y").to_pylist(), float)


def _per_partition(make):
    """A ``mapInArrow`` function: one matrix per partition, as rows (part, k, values)."""

    def run(batches):
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                m = make(*_stacked(batch))
                total = m if total is None else total + m
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "k": k, "values": row.tolist()} for k, row in enumerate(total)], schema=PARTS
            )

    return run


def _sums(rows: DataFrame, make) -> dict[int, np.ndarray]:
    return _summed(rows.mapInArrow(_per_partition(make), "part int, k int, values array<double>"))


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    let_go()
    return texts.map(statistics)


def described(docs: DataFrame, text_col: str = "text", name: str = "statistics") -> DataFrame:
    """``docs`` with the statistics of every whole text (null: of the empty one) in a column ``name``; all columns stay."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(name, statistics_of(F.col(f"`{text_col}`").cast("string")))


def fit(rows: DataFrame, x_col: str, label_col: str, fold: Column) -> Model:
    """Fit on ``rows`` with statistics and a label; rows whose ``fold`` is 0 are for calibration, the others for the regression.

    Rows without a label aren't used.  With no labelled row the model scores 0.5.
    """
    rows = rows.select(F.col(x_col).alias("x"), F.col(label_col).cast("double").alias("y"), fold.cast("int").alias("fold")).where("y is not null")
    rows = staged(rows, "labelled")
    d = len(statistics(""))
    main, held = rows.where("fold <> 0 or fold is null"), rows.where("fold = 0")
    s = _sums(main, lambda x, y: np.vstack([np.hstack([[len(x)], np.zeros(d - 1)]), x.sum(0), (x * x).sum(0)]))
    rng = np.random.default_rng(SEED)
    omega = rng.standard_normal((d, FEATURES)) / (WIDTH * math.sqrt(d))
    phase = rng.uniform(0, 2 * math.pi, FEATURES)
    if not s:
        zeros = np.zeros(d)
        return Model(zeros, zeros + 1, omega, phase, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    n = s[0][0]
    mean = s[1] / n
    scale = np.sqrt(np.maximum(s[2] / n - mean**2, 1e-8))
    model = Model(mean, scale, omega, phase, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))

    def normal(x, y):
        z = model.fourier(x)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    eqs = np.stack([v for _, v in sorted(_sums(main, normal).items())])
    weights = np.linalg.solve(eqs[:, :-1] + RIDGE * n / FEATURES * np.eye(FEATURES + 1), eqs[:, -1])
    raw = Model(mean, scale, omega, phase, weights, np.zeros(1), np.zeros(1))
    low, high = -0.5, 1.5

    def binned(x, y):
        at = np.clip((raw.raw(x) - low) / (high - low) * BINS, 0, BINS - 1).astype(int)
        return np.vstack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)]).astype(float)

    bins = _sums(held, binned) or _sums(main, binned)
    edges, levels = isotonic(low + (np.arange(BINS) + 0.5) * (high - low) / BINS, bins[0], bins[1])
    return Model(mean, scale, omega, phase, weights, edges, levels)


def quality_of(model: Model) -> object:
    """An Arrow UDF: the score of a text, 0 to 1 (higher: label 1 likelier); null is scored as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [model.score(np.array([statistics(t) for t in texts[i : i + 512]])) for i in range(0, len(texts), 512)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return score


def score_of(model: Model) -> object:
    """An Arrow UDF: the score of a column of statistics (see ``described``)."""

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_list())) if len(x) else [], dtype=float)

    return score


def fold_of(column: str, modulus: int, salt: str = "") -> Column:
    """crc32 of a column as text, modulo ``modulus``; null for null."""
    return F.pmod(F.crc32(F.concat(F.lit(salt), F.col(column).cast("string")).cast("binary")), F.lit(modulus))


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, x_col: str | None = None) -> Model:
    """The model of ``labels``, learnt from rows whose crc32 of the id modulo 5 isn't 0; a quarter of these calibrates.

    With ``x_col`` the statistics are read from that column of ``docs`` (see ``described``); else they are computed
    here, for all rows.  Only statistics are joined with labels: no text is shuffled.  A document with
    several labels counts once, with the smallest; rows without an id or label, and ids without a
    row, aren't learnt from; rows that share an id are learnt from one by one.  Other columns aren't read.
    """
    y = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where("i is not null and y is not null").groupBy("i").agg(F.min("y").alias("y"))
    x = docs if x_col else described(docs.select(id_col, text_col), text_col, x_col := free_name(docs.select(id_col, text_col), "statistics"))
    rows = x.select(F.col(id_col).alias("i"), F.col(x_col).alias("x")).where(fold_of("i", 5) != 0)
    return fit(rows.join(y, "i"), "x", "y", fold_of("i", 4, "calibrate"))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every row: statistics are computed once, in the scan, and staged with the id."""
    own = docs.select(id_col, text_col)
    name = free_name(own, "statistics")
    x = staged(described(own, text_col, name).select(id_col, name), "statistics")
    model = fit_on_labels(x, labels, id_col, x_col=name)
    held = F.coalesce(fold_of(id_col, 5) == 0, F.lit(False))
    out = x.select(F.col(id_col), held.alias("held_out"), score_of(model)(name).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the classifier rejects (score under ``THRESHOLD``); columns as before.

    Documents are staged once with their statistics, which serve for learning and for scoring.
    """
    name = free_name(docs, "statistics")
    x = staged(described(docs, text_col, name), "statistics")
    model = fit_on_labels(x, labels, id_col, x_col=name)
    return x.where(score_of(model)(name) >= THRESHOLD).drop(name)
