"""Topics: bag of words, then latent Dirichlet allocation by online variational Bayes.

Preprocessing keeps lower-cased letter tokens of 2 to 15 characters (longer
tokens are dropped, not split).  ``describe_topics`` gives the top terms of
each topic with their weights, in long form.

Scale.  Vocabularies of real texts grow with them, so neither the terms nor the
topics-by-terms matrix is whole anywhere.  Documents are packed into blocks of about
``BLOCK_TOKENS`` tokens, terms dealt into buckets by ranges of their hash.  A round is two
exchanges: a block gets its terms' weights and learns its documents' topics (E step),
a bucket gets its blocks' shares and makes the next weights (M step).  An exchange
moves a block's distinct terms, not its tokens; the driver sees a few numbers a topic.

Disk.  A block's terms stand in the order of their hashes, so a bucket's are a stretch of
them, whatever the number of buckets, and places are rising numbers, stored as
compressed differences.  A round leaves one row a bucket and one a block; what it
exchanged is deleted with its job (``session.lean_jobs``), not when the driver collects garbage.
``fit_topics`` gives models of ``pyspark.ml``, which keep all terms on the driver:
for bounded vocabularies.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import prompts
from sparkloom.functions.text.tokens import require_text_column, token_array
from sparkloom.session import staging_path, lean_jobs

MIN_TOKEN, MAX_TOKEN = 2, 15
BLOCK_TOKENS = 1 << 21
BUCKET_TERMS = 100_000  # terms of blocks in a bucket, about
PASS_PAIRS = 1 << 16  # (document, term) pairs that the E step holds at a time, or one document's

# Fixed values, as in ``pyspark.ml``: the shape of the first weights, the learning rate's offset and decay, the change at which a document has settled.
SHAPE, TAU, KAPPA, SETTLED = 100.0, 1024.0, 0.51, 1e-3


def preprocess(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, words ARRAY<STRING>)`` of kept tokens, in text order."""
    require_text_column(df, text_col)
    toks = token_array(F.col(text_col))
    kept = F.filter(toks, lambda t: (F.length(t) >= MIN_TOKEN) & (F.length(t) <= MAX_TOKEN))
    return df.select(F.col(id_col), kept.alias("words"))


def bag_of_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, count)``: the sparse document-term matrix in long form, a row's terms each once; ids may be null or repeat."""
    require_text_column(df, text_col)
    # numbered before the explode, in a projection of its own
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    toks = rows.select("_row", "_id", F.explode(token_array(F.col("_text"))).alias("term"))
    kept = toks.filter((F.length("term") >= MIN_TOKEN) & (F.length("term") <= MAX_TOKEN))
    return kept.groupBy("_row", "_id", "term").agg(F.count(F.lit(1)).alias("count")).select(F.col("_id").alias(id_col), "term", "count")


def fit_topics(df: DataFrame, id_col: str, text_col: str, k: int = 5, max_iter: int = 20, seed: int = 7,
               vocab_size: int = 2**31 - 1, min_df: float = 1.0, optimizer: str = "online"):
    """Fit CountVectorizer + LDA; returns ``(cv_model, lda_model, vectors)``.

    Every iteration reads every document (the library's default is a twentieth
    of them), and every term counts unless ``vocab_size`` or ``min_df`` says otherwise.
    """
    words = preprocess(df, id_col, text_col)
    cv = CountVectorizer(inputCol="words", outputCol="features", vocabSize=vocab_size, minDF=min_df).fit(words)
    vectors = cv.transform(words).select(id_col, "features")
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer=optimizer, subsamplingRate=1.0, featuresCol="features").fit(vectors)
    return cv, lda, vectors


def _digamma(x: np.ndarray) -> np.ndarray:
    x, low = np.array(x, float), 0.0
    for _ in range(6):
        small = x < 6
        low = low - np.where(small, 1 / x, 0)
        x = x + small
    f = 1 / (x * x)
    return low + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def _trigamma(x: np.ndarray) -> np.ndarray:
    x, low = np.array(x, float), 0.0
    for _ in range(6):
        small = x < 6
        low = low + np.where(small, 1 / (x * x), 0)
        x = x + small
    f = 1 / (x * x)
    return low + 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))


def _hashes(terms) -> np.ndarray:
    return pd.util.hash_array(np.array(terms, dtype=object), categorize=False)


def _places(terms: pa.Array) -> np.ndarray:
    """Each term's place in the order of hashes, and of terms where hashes are equal."""
    order = pc.sort_indices(pa.table({"hash": _hashes(terms), "term": terms}), sort_keys=[("hash", "ascending"), ("term", "ascending")])
    places = np.empty(len(terms), np.int32)
    places[order.to_numpy()] = np.arange(len(terms), dtype=np.int32)
    return places


def _bytes(numbers: np.ndarray) -> bytes:
    """Whole numbers, compressed: bytes of one significance together."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _rising(raw: bytes) -> np.ndarray:
    """The numbers whose differences are in ``raw``."""
    return np.cumsum(_numbers(raw), dtype=np.int32)


def first_weights(terms: list[str], k: int, seed: int) -> np.ndarray:
    """Terms x k, about Gamma(100, 1/100), from the term and the seed alone: Wilson and Hilferty's cube of a normal."""
    key = _hashes(terms)[:, None] + np.arange(2 * k, dtype=np.uint64)
    with np.errstate(over="ignore"):
        key = key + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            key = (key ^ (key >> np.uint64(shift))) * np.uint64(factor)
    u = ((key >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
    z = np.sqrt(-2 * np.log(u[:, :k])) * np.cos(2 * np.pi * u[:, k:])
    return (1 - 1 / (9 * SHAPE) + z / (3 * np.sqrt(SHAPE))) ** 3


def _blocks(words: DataFrame) -> DataFrame:
    """``(block, docs, terms, size, code, count)``: documents with words, packed; their number, the distinct terms in the order of ``_places``, then each document's number of distinct terms, their places in ``terms`` (differences) and counts, see ``_bytes``."""

    def packed(block: int, docs: list[pa.Array]) -> pa.RecordBatch:
        lengths = np.concatenate([d.value_lengths().to_numpy(zero_copy_only=False) for d in docs])
        flat = pa.concat_arrays([d.flatten() for d in docs]).dictionary_encode()
        terms = flat.dictionary
        places = _places(terms)
        pairs, count = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(terms) + places[flat.indices.to_numpy()], return_counts=True)
        sizes = np.bincount(pairs // len(terms), minlength=len(lengths))
        columns = [_bytes(c) for c in (sizes, np.diff(pairs % len(terms), prepend=0), count)]
        sorted_terms = terms.take(pa.array(np.argsort(places)))
        arrays = [pa.array([block]), pa.array([len(sizes)]), pa.ListArray.from_arrays([0, len(terms)], sorted_terms)] + [pa.array([c], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "docs", "terms", "size", "code", "count"])

    def run(batches):
        from pyspark import TaskContext

        block, docs, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            rows = batch.column(0)
            ends = np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))
            at = 0
            while at < len(rows):
                before = int(ends[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + BLOCK_TOKENS - held, side="right")))
                docs.append(rows.slice(at, end - at))
                held += int(ends[end - 1]) - before
                at = end
                if held >= BLOCK_TOKENS:
                    yield packed(block, docs)
                    block, docs, held = block + 1, [], 0
        if docs:
            yield packed(block, docs)

    return words.where(F.size("words") > 0).select("words").mapInArrow(run, "block long, docs long, terms array<string>, size binary, code binary, count binary")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, label)
    with lean_jobs(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _dropped(frame: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = frame.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(file)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _topics_of(size: np.ndarray, code: np.ndarray, count: np.ndarray, beta: np.ndarray, alpha: np.ndarray, gamma: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """E step of some documents, from ``gamma`` (k x documents) on: (terms x k expected counts before the factor beta, sum over documents of E[log topic share], gamma).

    Every third step goes on along the last two (squared extrapolation); a document has settled when a plain step changes little.
    """
    k, stats, shares = len(alpha), np.zeros_like(beta), np.zeros(len(alpha))
    final = np.ones((k, len(size))) if gamma is None else gamma.copy()
    bounds = np.concatenate([[0], np.cumsum(size)])
    first = 0
    while first < len(size):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PASS_PAIRS, side="right")) - 1)
        own = slice(int(bounds[first]), int(bounds[last]))
        terms, n, lengths = code[own], count[own].astype(float), size[first:last]
        local = np.ascontiguousarray(beta[terms].T)  # k x pairs
        gamma, live, here, times, past = final[:, first:last], np.arange(len(lengths)), local, n, []
        while len(live):
            starts = np.concatenate([[0], np.cumsum(lengths[live])[:-1]])
            theta = np.exp(_digamma(gamma) - _digamma(gamma.sum(0)))
            wide = np.repeat(theta, lengths[live], axis=1)
            ratio = times / (np.einsum("kp,kp->p", wide, here) + 1e-100)
            new = theta * np.add.reduceat(here * ratio, starts, axis=1) + alpha[:, None]
            more = np.abs(new - gamma).mean(0) > SETTLED
            past = [*past, gamma]
            if not more.all():
                final[:, first + live[~more]] = new[:, ~more]
                keep = np.repeat(more, lengths[live])
                here, times, live, new, past = here[:, keep], times[keep], live[more], new[:, more], [p[:, more] for p in past]
            if len(past) == 2:
                step, turn = past[1] - past[0], new - 2 * past[1] + past[0]
                far = np.maximum(np.sqrt((step**2).sum(0) / np.maximum((turn**2).sum(0), 1e-300)), 1.0)
                new, past = np.maximum(past[0] + 2 * far * step + far**2 * turn, alpha[:, None]), []
            gamma = new
        log_theta = _digamma(final[:, first:last]) - _digamma(final[:, first:last].sum(0))
        shares += log_theta.sum(1)
        wide = np.repeat(np.exp(log_theta), lengths, axis=1)
        ratio = n / (np.einsum("kp,kp->p", wide, local) + 1e-100)
        for j in range(k):
            stats[:, j] += np.bincount(terms, wide[j] * ratio, len(beta))
        first = last
    return stats, shares, final


_STATE = "bucket long, block long, pos binary, weights binary, total array<double>"


@dataclass(frozen=True)
class Topics:
    """Learnt topics: ``weights`` has a row a bucket of terms, ``terms`` their names in the same order."""

    terms: DataFrame  # (bucket, terms array<string>)
    weights: DataFrame  # (bucket, weights binary: float64, terms x k)
    totals: np.ndarray  # the sum of each topic's weights
    alpha: np.ndarray


def learn(df: DataFrame, id_col: str, text_col: str, k: int = 5, max_iter: int = 20, seed: int = 7) -> Topics:
    """Online variational Bayes over all documents in each round, with every term; document concentration is learnt as well."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = _staged(_blocks(preprocess(df, id_col, text_col)), "topics-blocks")
    seen = packed.agg(F.count(F.lit(1)), F.sum(F.size("terms")), F.sum("docs")).first()
    buckets, docs = max(1, -(-(seen[1] or 0) // BUCKET_TERMS)), seen[2] or 0
    by_block, by_bucket = (min(max(tasks, n), 3 * n) for n in (max(1, seen[0]), buckets))

    def stretches(batches):
        for batch in batches:
            for block, own in zip(batch.column("block"), batch.column("terms")):
                of = (_hashes(own.values) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                bucket, first = np.unique(of, return_index=True)
                lists = pa.ListArray.from_arrays([*first.tolist(), len(of)], own.values)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array([block.as_py()] * len(bucket)), lists], names=["bucket", "block", "terms"])

    # terms are numbered within their bucket, once; a link says where a block's terms stand in the bucket
    def numbered(rows: pa.Table) -> pa.Table:
        lists = pa.concat_arrays(rows["terms"].chunks)
        flat = lists.flatten().dictionary_encode()
        places = _places(flat.dictionary)
        pos, ends = places[flat.indices.to_numpy()], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        links = [_bytes(np.diff(p, prepend=0)) for p in np.split(pos, ends[:-1])]
        names = pa.ListArray.from_arrays([0] * len(links) + [0, len(places)], flat.dictionary.take(pa.array(np.argsort(places))), mask=pa.array([True] * len(links) + [False]))
        arrays = [pa.array(rows["bucket"].to_pylist()[:1] * len(names)), pa.array([*rows["block"].to_pylist(), None], pa.int64()), pa.array([*links, None], pa.binary()), names]
        return pa.Table.from_arrays(arrays, names=["bucket", "block", "pos", "terms"])

    parts = packed.select("block", "terms").mapInArrow(stretches, "bucket long, block long, terms array<string>").repartition(by_bucket, "bucket")
    links = _staged(parts.groupBy("bucket").applyInArrow(numbered, "bucket long, block long, pos binary, terms array<string>"), "topics-links")
    names = links.where("block is null").select("bucket", "terms")
    blocks = _staged(packed.select("block", "size", "code", "count"), "topics-documents")
    _dropped(packed)

    def state(bucket: int, weights: np.ndarray) -> pd.DataFrame:
        out = pd.DataFrame([(bucket, None, None, weights.tobytes(), weights.sum(axis=0))], columns=["bucket", "block", "pos", "weights", "total"])
        return out.assign(block=out["block"].astype("Int64"))

    def started(batches):
        for rows in batches:
            for bucket, terms in zip(rows["bucket"], rows["terms"]):
                yield state(int(bucket), first_weights(list(terms), k, seed))

    now = _staged(names.mapInPandas(started, _STATE), "topics-weights")
    sums = [F.sum(F.get("total", F.lit(j))) for j in range(k)]
    totals = lambda frame, which: np.array(frame.where(which).agg(*sums).first(), float)
    total, alpha = totals(now, "block is null"), np.full(k, 1.0 / k)
    for step in range(1, max_iter + 1 if docs else 1):
        rate = (TAU + step) ** -KAPPA

        def give(old: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            """For each of a bucket's blocks the weights of that block's terms; a block's own state as it is."""
            if not len(own):
                return old.assign(total=None)
            short = np.frombuffer(old["weights"].iloc[0], float).reshape(-1, k).astype(np.float32)
            rows = [(b, n, p, short[_rising(p)].tobytes(), None) for b, n, p in zip(own["bucket"], own["block"], own["pos"])]
            return pd.DataFrame(rows, columns=["bucket", "block", "pos", "weights", "total"])

        def expect(block: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values("bucket")
            before = [np.frombuffer(w, float).reshape(k, -1) for w in own["weights"][own["bucket"] < 0]]
            own = own[own["bucket"] >= 0]
            raw = [np.frombuffer(w, np.float32).reshape(-1, k) for w in own["weights"]]
            beta = np.exp(_digamma(np.concatenate(raw)) - _digamma(total))
            size, code, count = _numbers(block["size"].iloc[0]), _rising(block["code"].iloc[0]), _numbers(block["count"].iloc[0])
            stats, shares, gamma = _topics_of(size, code, count, beta, alpha, *before)
            stats = np.split((stats * beta).astype(np.float32), np.cumsum([len(r) for r in raw])[:-1])
            number = int(block["block"].iloc[0])
            rows = [(b, number, p, s.tobytes(), None) for b, p, s in zip(own["bucket"], own["pos"], stats)]
            return pd.DataFrame([*rows, (-1 - number, number, None, gamma.tobytes(), shares)], columns=["bucket", "block", "pos", "weights", "total"])

        def maximise(old: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if own["bucket"].iloc[0] < 0:  # a block's own state and its sums for the concentration
                return own
            own = own.sort_values("block")
            weights = np.frombuffer(old["weights"].iloc[0], float).reshape(-1, k)
            new = np.zeros_like(weights)
            for pos, stats in zip(own["pos"], own["weights"]):
                new[_rising(pos)] += np.frombuffer(stats, np.float32).reshape(-1, k)
            return state(int(old["bucket"].iloc[0]), (1 - rate) * weights + rate * (new + 1.0 / k))

        dealt = lambda frame, n, key: frame.repartition(n, key).groupBy(key)
        own = links.where("block is not null").select("bucket", "block", "pos")
        given = dealt(now, by_bucket, "bucket").cogroup(dealt(own, by_bucket, "bucket")).applyInPandas(give, _STATE)
        given = given.select("block", "bucket", "pos", "weights")
        found = dealt(blocks, by_block, "block").cogroup(dealt(given, by_block, "block")).applyInPandas(expect, _STATE)
        old = now.where("block is null").select("bucket", "weights")
        before, now = now, _staged(dealt(old, by_bucket, "bucket").cogroup(dealt(found, by_bucket, "bucket")).applyInPandas(maximise, _STATE), "topics-weights")
        _dropped(before)
        total, alpha = totals(now, "block is null"), _concentration(alpha, totals(now, "bucket < 0") / docs, docs, rate)
    return Topics(names, now.where("block is null").select("bucket", "weights"), total, alpha)


def _concentration(alpha: np.ndarray, mean: np.ndarray, docs: int, rate: float) -> np.ndarray:
    """One Newton step of the documents' Dirichlet parameter; the old one, if the step would leave the positive."""
    slope = docs * (_digamma(alpha.sum()) - _digamma(alpha) + mean)
    c, q = docs * _trigamma(alpha.sum()), -docs * _trigamma(alpha)
    new = alpha - rate * (slope - (slope / q).sum() / (1 / c + (1 / q).sum())) / q
    return new if (new > 0).all() else alpha


def describe_topics(df: DataFrame, id_col: str, text_col: str, k: int = 5, terms: int = 10, seed: int = 7,
                    max_iter: int = 20) -> DataFrame:
    """``(topic_id, rank, term, weight)`` for the top ``terms`` terms of each topic."""
    model = learn(df, id_col, text_col, k=k, max_iter=max_iter, seed=seed)
    totals = model.totals

    def top(names: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(names["terms"].iloc[0])  # of equal weights the first terms
        share = (np.frombuffer(weights["weights"].iloc[0], float).reshape(-1, k) / totals)[order]
        own = names["terms"].iloc[0][order]
        best = np.argsort(-share, axis=0, kind="stable")[:terms]
        return pd.DataFrame([(j, own[i], share[i, j]) for j in range(k) for i in best[:, j]], columns=["topic_id", "term", "weight"])

    each = model.terms.groupBy("bucket").cogroup(model.weights.groupBy("bucket")).applyInPandas(top, "topic_id int, term string, weight double")
    by_weight = Window.partitionBy("topic_id").orderBy(F.desc("weight"), "term")
    ranked = each.withColumn("rank", F.row_number().over(by_weight) - 1).where(F.col("rank") < terms)  # at most ``terms`` of a bucket and topic
    return ranked.select("topic_id", "rank", "term", "weight")


def topic_prompts(topics: DataFrame) -> DataFrame:
    """One ``Incorporate theme: ...`` line per topic, terms with weights in rank order."""
    item = F.format_string('%.3f*"%s"', F.col("weight"), F.col("term"))
    per_topic = topics.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", item.alias("s")))).alias("items"))
    text = F.array_join(F.transform("items", lambda e: e["s"]), " + ")
    return per_topic.select("topic_id", F.concat(F.lit(prompts.THEME_PREFIX), text).alias("suggestion"))
