"""Unsupervised keywords after YAKE (Campos et al., 2020), as DataFrame jobs.

Per document and lower-cased non-stop term t:

* ``TF`` occurrences, ``TF_A`` all-upper occurrences (acronyms, 2+ letters),
  ``TF_U`` capitalised occurrences not at a sentence start;
* ``Case = max(TF_A, TF_U) / (1 + ln TF)``
* ``Pos  = ln(ln(3 + median sentence index))``
* ``Freq = TF / (mean TF + std TF)`` over the document's non-stop terms
* ``Rel  = 1 + (DL + DR) * TF / max TF`` with DL/DR = distinct / total left/right neighbours
* ``Sent = sentences containing t / sentences``
* ``S(t) = Rel * Pos / (Case + Freq / Rel + Sent / Rel)``

Candidates are 1- to 3-grams inside one sentence that neither start nor
end with a stop word.  ``S(c) = prod S(t) / (KF * (1 + sum S(t)))`` with KF
the candidate's frequency; an interior stop word w between a and b adds the
factor ``1 + (1 - P(w|a) P(b|w))`` to the product and subtracts
``1 - P(w|a) P(b|w)`` from the sum.  Lower is better.  Keywords are taken
best-first, skipping any whose Levenshtein similarity
``1 - lev / max(len)`` to an already kept one exceeds ``dedup_lim``.

A document is a row, whatever its id.  Spark cuts it into sentences and words and
marks how they are written; the counts by (document, term) and (document,
candidate) are taken with numpy in the task that holds the rows, some
``CHUNK_WORDS`` words at a time, so nothing is shuffled or spilled.  The
greedy choice runs over an array of the document's candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from sparkloom.functions import prompts
from sparkloom.functions.text.tokens import LETTER_TOKEN, SENTENCE_SPLIT, require_text_column

# English stop words for candidate boundaries.
STOP_WORDS = (
    "a an and are as at be been but by can could did do does for from had has have he her him his how i if in into "
    "is it its me my no not of on or our she so such than that the their them then there these they this those to "
    "too us was we were what when where which while who whom why will with would you your"
).split()

MAX_NGRAM = 3
TOP = 10
DEDUP_LIM = 0.3
RANK_DIGITS = 10  # of a score; equal ones are ranked by the keyword
CHUNK_WORDS = 200_000  # counted at a time, or one document


def sentence_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, words, kinds, sizes)`` of every row: its lower-cased words, how each is written (2: acronym, 1: capitalised
    inside a sentence, else 0) and the number of words of each sentence."""
    require_text_column(df, text_col)
    sentences = df.select(F.col(id_col).alias("_id"), F.split(F.coalesce(F.col(text_col), F.lit("")), SENTENCE_SPLIT, -1).alias("sents"))
    found = sentences.select(
        "_id",
        F.transform("sents", lambda s: F.regexp_extract_all(s, F.lit(LETTER_TOKEN), 0)).alias("ws"),
        F.transform("sents", lambda s: F.regexp_extract_all(F.lower(s), F.lit(LETTER_TOKEN), 0)).alias("lw"),  # aligned with ws
    )

    def kind(w: Column, i: Column) -> Column:
        first = F.substring(w, 1, 1)
        acronym = (w == F.upper(w)) & (F.length(w) > 1)
        capital = (first == F.upper(first)) & (first != F.lower(first))
        return F.when(w == F.lower(w), 0).when(acronym, 2).when(capital & (i > 0), 1).otherwise(0)

    kinds = F.zip_with("ws", "lw", lambda ws, lw: F.zip_with(F.transform(ws, kind), lw, lambda k, _: F.coalesce(k, F.lit(0))))
    return found.select("_id", F.flatten("lw").alias("words"), F.flatten(kinds).alias("kinds"), F.transform("lw", F.size).alias("sizes"))


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of ``sentence_words`` with ``CHUNK_WORDS`` words at most, or one row."""
    words = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(words, (words[at - 1] if at else 0) + CHUNK_WORDS, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _distinct(key: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (key, *more), numbers below 2^31: (place of the first, number of its group, rows of the group) as ``np.unique``."""
    for m in more:
        key = np.unique(key, return_inverse=True)[1].astype(np.int64) << 32 | m
    return np.unique(key, return_index=True, return_inverse=True, return_counts=True)[1:]


class _Chunk:
    """Words of some documents as numbers, with the scores of their terms."""

    def __init__(self, chunk: pa.RecordBatch):
        words = chunk.column(1).flatten().dictionary_encode()
        self.names, self.word = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, sizes = (chunk.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
        self.documents = chunk.num_rows
        self.doc = np.repeat(np.arange(chunk.num_rows), chunk.column(1).value_lengths().to_numpy(zero_copy_only=False))
        per_doc = chunk.column(3).value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(per_doc) - per_doc  # a document's first sentence
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        s = sentence - first[self.doc]
        self.left = np.arange(len(self.word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # words before and after it in its sentence
        self.right = np.repeat(sizes, sizes) - 1 - self.left
        self.stop = pc.is_in(self.names, pa.array(STOP_WORDS)).to_numpy(zero_copy_only=False)[self.word] if len(self.word) else np.zeros(0, bool)

        t = np.flatnonzero(~self.stop)
        at, of, self.tf = _distinct(self.doc[t], self.word[t])
        self.at, n = t[at], len(at)
        self.term = np.full(len(self.word), -1)  # the term at each word that isn't a stop word
        self.term[t] = of
        count = lambda here: np.bincount(of[here], minlength=n)
        n_left, n_right = count(self.left[t] > 0), count(self.right[t] > 0)

        def kinds_of(here: np.ndarray, other: np.ndarray) -> np.ndarray:
            first_of = _distinct(of[here], other)[0]
            return np.bincount(of[here][first_of], minlength=n)

        left, right = np.flatnonzero(self.left[t] > 0), np.flatnonzero(self.right[t] > 0)
        d_left, d_right = kinds_of(left, self.word[t[left] - 1]), kinds_of(right, self.word[t[right] + 1])
        n_sent_t = kinds_of(np.arange(len(t)), s[t])
        ordered, start = s[t][np.lexsort((s[t], of))], np.cumsum(self.tf) - self.tf
        med = (ordered[start + (self.tf - 1) // 2] + ordered[start + self.tf // 2]) / 2.0

        doc = self.doc[self.at]
        n_t, s1, s2 = (np.bincount(doc, x, self.documents) for x in (None, self.tf, self.tf * self.tf))
        most = np.zeros(self.documents, np.int64)
        np.maximum.at(most, doc, self.tf)
        n_sent = np.bincount(np.repeat(np.arange(self.documents), per_doc), sizes > 0, self.documents)
        tf, mean = self.tf, (s1 / np.maximum(n_t, 1))[doc]
        std = np.sqrt(np.maximum(s2 / np.maximum(n_t, 1) - (s1 / np.maximum(n_t, 1)) ** 2, 0.0))[doc]
        case = np.maximum(count(kinds[t] == 2), count(kinds[t] == 1)) / (1.0 + np.log(tf))
        pos, freq = np.log(np.log(3.0 + med)), tf / (mean + std)
        rel = 1.0 + (d_left / np.maximum(n_left, 1) + d_right / np.maximum(n_right, 1)) * tf / most[doc]
        self.score = rel * pos / (case + freq / rel + n_sent_t / n_sent[doc] / rel)

    def terms(self) -> tuple[np.ndarray, list[pa.Array]]:
        return self.doc[self.at], [self.names.take(pa.array(self.word[self.at])), pa.array(self.tf), pa.array(self.score)]

    def candidates(self, max_ngram: int) -> tuple[np.ndarray, list[pa.Array]]:
        """Each candidate's document, and its keyword, number of words, frequency and score."""
        found: list[list] = [[], [], [], [], []]
        used = _distinct(self.doc, self.word)
        n_word = used[2][used[1]] if len(self.word) else np.zeros(0, np.int64)  # how often its document holds the word
        pair = np.flatnonzero(self.right > 0)
        _, of, times = _distinct(self.doc[pair], self.word[pair], self.word[pair + 1]) if len(pair) else (None, pair, pair)
        n_pair = np.zeros(len(self.word), np.int64)  # and the pair that starts at it
        n_pair[pair] = times[of]
        for n in range(1, max_ngram + 1):
            at = np.flatnonzero(self.right >= n - 1)
            at = at[~self.stop[at] & ~self.stop[at + n - 1]]
            if not len(at):
                continue
            first, _, kf = _distinct(self.doc[at], *(self.word[at + j] for j in range(n)))
            at = at[first]
            log_prod, sum_s = np.zeros(len(at)), np.zeros(len(at))
            for j in range(n):
                w = at + j
                own = self.score[self.term[w]]
                if 0 < j < n - 1:
                    # an interior stop word; next to another one it counts nothing
                    a_plain = ~self.stop[w - 1]
                    pp = np.where(a_plain, (n_pair[w - 1] / n_word[w - 1]) * (n_pair[w] / n_word[w]), 1.0)
                    log_prod += np.where(self.stop[w], np.log(2.0 - pp), np.log(own))
                    sum_s += np.where(self.stop[w], pp - 1.0, own)
                else:
                    log_prod, sum_s = log_prod + np.log(own), sum_s + own
            parts = [self.names.take(pa.array(self.word[at + j])) for j in range(n)]
            values = [pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0], np.full(len(at), n), kf, np.exp(log_prod) / (kf * (1.0 + sum_s))]
            for column, x in zip(found, [self.doc[at], *values]):
                column.append(x)
        if not found[0]:
            return np.zeros(0, np.int64), [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.float64())]
        doc, n, kf, score = (np.concatenate(found[i]) for i in (0, 2, 3, 4))
        return doc, [pa.concat_arrays(found[1]), pa.array(n), pa.array(kf), pa.array(score)]


def _per_row(df: DataFrame, id_col: str, text_col: str, find: Callable[[_Chunk], tuple[np.ndarray, list[pa.Array]]], ddl: str) -> DataFrame:
    """``(id, found ARRAY<STRUCT<ddl>>)`` of every row, from what ``find`` gives for some of them."""
    words = sentence_words(df, id_col, text_col)
    item = StructType.fromDDL(ddl)
    schema = StructType([words.schema["_id"], *StructType.fromDDL(f"found array<{item.simpleString()}>").fields])
    arrow = to_arrow_schema(schema)
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in item.fields]

    def run(batches):
        for batch in batches:
            for chunk in _chunks(batch):
                doc, columns = find(_Chunk(chunk))
                order = pa.array(np.argsort(doc, kind="stable"))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=chunk.num_rows))]).astype(np.int32)
                items = pa.StructArray.from_arrays([c.take(order).cast(f.type) for c, f in zip(columns, fields)], fields=fields)
                lists = pa.ListArray.from_arrays(pa.array(offsets), items)
                yield pa.RecordBatch.from_arrays([chunk.column(0).cast(arrow.field(0).type), lists.cast(arrow.field(1).type)], schema=arrow)

    return words.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def term_scores(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf, score)`` for every non-stop term of every document."""
    found = _per_row(df, id_col, text_col, lambda c: c.terms(), "term string, tf long, score double")
    return found.select(id_col, F.explode("found").alias("_f")).select(id_col, "_f.*")


def _candidates(df: DataFrame, id_col: str, text_col: str, max_ngram: int) -> DataFrame:
    return _per_row(df, id_col, text_col, lambda c: c.candidates(max_ngram), "keyword string, n long, kf long, score double")


def candidate_scores(df: DataFrame, id_col: str, text_col: str, max_ngram: int = MAX_NGRAM) -> DataFrame:
    """``(id, keyword, n, kf, score)`` for every candidate n-gram (before dedup)."""
    return _candidates(df, id_col, text_col, max_ngram).select(id_col, F.explode("found").alias("_f")).select(id_col, "_f.*")


def similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length (in code points)."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def _chosen(df: DataFrame, id_col: str, text_col: str, top: int, dedup_lim: float, max_ngram: int) -> DataFrame:
    """``(id, kept)`` of every row: its deduplicated keywords, best first."""
    found = _candidates(df, id_col, text_col, max_ngram)
    # a document's candidates, best first, bounded by its length; the chosen ones are an array of at most ``top``
    ranked = F.sort_array(F.transform("found", lambda c: F.struct(F.round(c["score"], RANK_DIGITS).alias("score"), c["keyword"].alias("keyword"))))
    none = F.array().cast("array<struct<score:double,keyword:string>>")
    fits = lambda kept, x: (F.size(kept) < top) & F.forall(kept, lambda k: similarity(x["keyword"], k["keyword"]) <= dedup_lim)
    kept = F.aggregate(ranked, none, lambda acc, x: F.when(fits(acc, x), F.concat(acc, F.array(x))).otherwise(acc))
    return found.select(id_col, kept.alias("kept"))


def keywords(df: DataFrame, id_col: str, text_col: str, top: int = TOP, dedup_lim: float = DEDUP_LIM,
             max_ngram: int = MAX_NGRAM) -> DataFrame:
    """``(id, rank, keyword, score)``: up to ``top`` deduplicated keywords per document."""
    kept = _chosen(df, id_col, text_col, top, dedup_lim, max_ngram)
    return kept.select(id_col, F.posexplode("kept").alias("rank", "_k")).select(id_col, "rank", "_k.keyword", "_k.score")


def _suggestion(best: Column) -> Column:
    return F.concat(F.lit(prompts.KEYWORDS_PREFIX), F.array_join(F.transform(best, lambda e: e["keyword"]), ", ")).alias("suggestion")


def prompts_of(df: DataFrame, id_col: str, text_col: str, n: int = 3) -> DataFrame:
    """``keyword_prompts`` of each document of ``df``, ids null or repeated or not."""
    kept = _chosen(df, id_col, text_col, TOP, DEDUP_LIM, MAX_NGRAM).where(F.size("kept") > 0)
    return kept.select(id_col, _suggestion(F.slice("kept", 1, n)))


def keyword_prompts(kw: DataFrame, id_col: str, n: int = 3) -> DataFrame:
    """``Create content focusing on: k1, k2, k3`` per id (its best ``n`` keywords; documents without an id of their own: ``prompts_of``)."""
    best = kw.filter(F.col("rank") < n).groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("rank", "keyword"))).alias("ks"))
    return best.select(id_col, _suggestion(F.col("ks")))
