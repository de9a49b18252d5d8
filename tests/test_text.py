import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.functions import inference
from sparkloom.functions.text import entities, keywords, sentiment, tokens, topics, vectors

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_match_offsets_equal_python_finditer(spark, docs):
    pattern = r"\d+"
    got = sorted((r["doc_id"], r["start"], r["end"], r["match"]) for r in tokens.match_offsets(docs, "doc_id", "text", pattern).collect())
    expect = sorted(
        (r["doc_id"], m.start(), m.end(), m.group(0))
        for r in docs.select("doc_id", "text").collect()
        for m in re.finditer(pattern, r["text"] or "")
    )
    assert got == expect and len(expect) > 0


def test_entities_overlap_resolution(spark):
    text = "Mail bob@mail.example.com or call +1 555 0100 99, host 10.0.0.12 at 45% for $30 on 2024-01-02 and 7."
    df = spark.createDataFrame([(1, text)], "id long, t string")
    ents = [(r["label"], r["text"], r["start"], r["end"]) for r in entities.extract_entities(df, "id", "t").orderBy("start").collect()]
    labels = [e[0] for e in ents]
    assert ("EMAIL", "bob@mail.example.com") in [(e[0], e[1]) for e in ents]
    assert ("IP", "10.0.0.12") in [(e[0], e[1]) for e in ents]
    assert "PERCENT" in labels and "MONEY" in labels and "DATE" in labels
    for lab, s, a, b in ents:
        assert text[a:b] == s
    # kept entities never overlap
    for (l1, _, a1, b1), (l2, _, a2, b2) in zip(ents, ents[1:]):
        assert b1 <= a2
    assert ("CARDINAL", "7") in [(e[0], e[1]) for e in ents]


def test_gazetteer(spark):
    df = spark.createDataFrame([(1, "We flew to France, then FRANCE again; not Francesca.")], "id long, t string")
    gz = spark.createDataFrame([("france", "GPE")], "token string, label string")
    ents = entities.extract_entities(df, "id", "t", gazetteer=gz).collect()
    assert sorted((e["start"], e["text"]) for e in ents) == [(11, "France"), (24, "FRANCE")]
    assert [r[0] for r in entities.entity_prompts(entities.extract_entities(df, "id", "t", gz)).collect()] == [
        "Include gpe elements in the generation"
    ]


def test_sentiment_with_negator(spark):
    df = spark.createDataFrame([(1, "Good day, not good; bad."), (2, "nothing here"), (3, None)], "id long, t string")
    lex = spark.createDataFrame([("good", 0.7, 0.6), ("bad", -0.7, 0.67)], "token string, polarity double, subjectivity double")
    neg = spark.createDataFrame([("not",)], "token string")
    got = {r["id"]: (round(r["polarity"], 6), round(r["subjectivity"], 6), r["n_hits"]) for r in sentiment.sentiment(df, "id", "t", lex, neg).collect()}
    assert got[1] == (round((0.7 - 0.35 - 0.7) / 3, 6), round((0.6 + 0.6 + 0.67) / 3, 6), 3)
    assert got[2] == (0.0, 0.0, 0) and got[3] == (0.0, 0.0, 0)
    prompt = sentiment.sentiment_prompt(spark.createDataFrame([(0.5,), (0.2,)], "polarity double")).collect()
    assert [r[0] for r in prompt] == ["Maintain a positive and uplifting tone"]


def test_hashed_tfidf_brute_force(spark):
    texts = {1: "Apple apple banana", 2: "banana cherry", 3: "cherry cherry date apple"}
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    got = {(r["id"], r["bucket"]): r["value"] for r in vectors.hashed_tfidf(df, "id", "t", 16).collect()}
    import hashlib

    def bucket(w):
        return int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16

    tf = {d: {} for d in texts}
    for d, t in texts.items():
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            tf[d][bucket(w)] = tf[d].get(bucket(w), 0) + 1
    dfreq = {}
    for d in tf:
        for b in tf[d]:
            dfreq[b] = dfreq.get(b, 0) + 1
    for d in tf:
        w = {b: c * (math.log((1 + 3) / (1 + dfreq[b])) + 1) for b, c in tf[d].items()}
        n = math.sqrt(sum(v * v for v in w.values()))
        for b, v in w.items():
            assert math.isclose(got[(d, b)], v / n, rel_tol=1e-9)
    dense = vectors.dense(vectors.hashed_tfidf(df, "id", "t", 16), "id", 16).collect()
    assert all(len(r["vector"]) == 16 and math.isclose(np.linalg.norm(r["vector"]), 1.0) for r in dense)


def similar(a, b):
    """1 less the edit distance over the longer length, by the plain table."""
    table = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (x != y))
    return 1.0 - table[-1][-1] / max(len(a), len(b), 1)


def test_keywords_are_the_greedy_choice(spark, docs):
    some = docs.orderBy("doc_id").limit(12)
    cands = {}
    for r in keywords.candidate_scores(some, "doc_id", "text").collect():
        cands.setdefault(r["doc_id"], []).append((round(r["score"], keywords.RANK_DIGITS), r["keyword"]))
    got = {}
    for r in keywords.keywords(some, "doc_id", "text").orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append((r["score"], r["keyword"]))
    for i, found in cands.items():
        kept = []
        for score, word in sorted(found):
            if len(kept) < keywords.TOP and all(similar(word, k) <= keywords.DEDUP_LIM for _, k in kept):
                kept.append((score, word))
        assert [k for _, k in got[i]] == [k for _, k in kept]


def test_keywords_invariants(spark, docs):
    en = docs.filter(F.col("lang") == "en")
    kw = keywords.keywords(en, "doc_id", "text").collect()
    by_doc = {}
    for r in kw:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert by_doc
    for rows in by_doc.values():
        rows.sort(key=lambda r: r["rank"])
        assert len(rows) <= 10
        scores = [r["score"] for r in rows]
        assert scores == sorted(scores)
        words = [r["keyword"] for r in rows]
        for i, a in enumerate(words):
            for b in words[:i]:
                assert similar(a, b) <= 0.3
            assert a.split()[0] not in keywords.STOP_WORDS and a.split()[-1] not in keywords.STOP_WORDS


def test_keyword_candidates_on_literal_text(spark):
    df = spark.createDataFrame([(1, "Spark jobs run fast. The Spark engine runs jobs of the cluster.")], "id long, t string")
    c = {r["keyword"]: r for r in keywords.candidate_scores(df, "id", "t").collect()}
    assert "spark" in c and c["spark"]["kf"] == 2
    assert "jobs of the cluster" not in c  # longer than 3 tokens
    assert "the spark" not in c  # starts with a stop word
    assert all(v["score"] > 0 for v in c.values())
    prompts = keywords.keyword_prompts(keywords.keywords(df, "id", "t"), "id").first()["suggestion"]
    assert prompts.startswith("Create content focusing on: ")


def test_keywords_of_null_and_repeated_ids(spark):
    texts = ["Spark jobs run fast. The Spark engine runs jobs of the cluster.", "Rivers carry water to the sea. Water is life.", "Old castles stand on hills."]
    alone = {t: spark.createDataFrame([(1, t)], "id long, t string") for t in texts}
    df = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (None, texts[1]), (2, texts[2]), (2, texts[0]), (3, None)], "id long, t string")
    jobs = [
        lambda d: keywords.term_scores(d, "id", "t"), lambda d: keywords.candidate_scores(d, "id", "t"),
        lambda d: keywords.keywords(d, "id", "t"), lambda d: keywords.prompts_of(d, "id", "t"),
    ]
    for job in jobs:
        one = {t: [tuple(r)[1:] for r in job(d).collect()] for t, d in alone.items()}
        expect = [(i, *r) for i, t in ((None, 0), (None, 1), (None, 1), (2, 2), (2, 0)) for r in one[texts[t]]]
        assert sorted(map(str, map(tuple, job(df).collect()))) == sorted(map(str, expect))


def test_topics(spark, docs):
    en = docs.filter(F.col("lang") == "en")
    bow = topics.bag_of_words(en, "doc_id", "text")
    assert bow.filter((F.length("term") < 2) | (F.length("term") > 15)).count() == 0
    t = topics.describe_topics(en, "doc_id", "text", k=3, terms=5, max_iter=5).collect()
    assert len(t) == 15 and all(0.0 <= r["weight"] <= 1.0 for r in t)
    p = topics.topic_prompts(topics.describe_topics(en, "doc_id", "text", k=2, terms=3, max_iter=3)).collect()
    assert len(p) == 2 and all(r["suggestion"].startswith("Incorporate theme: ") for r in p)


def test_batch_inference_and_extractors(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "id long, t string")
    out = {r["id"]: list(r["vector"]) for r in inference.batch_model_inference(df, "t", inference.text_stats_model, batch_size=1).collect()}
    assert out == {1: [5.0, 2.0], 2: [0.0, 0.0]}
    assert [r["text_length"] for r in inference.apply_extractor(df, "text_length", "t", "text_length").orderBy("id").collect()] == [5, 0]
    with pytest.raises(ValidationError):
        inference.apply_extractor(df, "nope", "t")
    with pytest.raises(ValidationError):
        tokens.tokens(df.withColumn("n", F.lit(1)), "id", "n")


def test_only_kept_matches_suppress(spark):
    from sparkloom.functions.text import entities

    df = spark.createDataFrame([(1, "host 10.0.0.12 3456 789 end"), (None, "5%")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["label"], r["text"]) for r in entities.extract_entities(df, "doc_id", "text").collect())
    assert got == [(0, "PERCENT", "5%"), (1, "CARDINAL", "3456"), (1, "CARDINAL", "789"), (1, "IP", "10.0.0.12")]


def test_topics_read_every_document(spark):
    from sparkloom.functions.text import topics

    df = spark.createDataFrame([(i, f"aaa{chr(97 + i)} bbb ccc") for i in range(20)], "doc_id long, text string")
    cv, lda, _ = topics.fit_topics(df, "doc_id", "text", k=2, max_iter=2)
    assert lda.getSubsamplingRate() == 1.0 and len(cv.vocabulary) == 22


def test_entities_of_long_hosts_and_numbers(spark):
    n = 100_000
    texts = [
        "a@" + "b." * n + "b", "a@" + "bb." * n + "com", "a" * n + "@b.com", "a.b" * n, "https://" + "a/" * n, "1." * n, "1.2.3." * n, "1 " * n + "2",
        "2024-01-02" * n, "$1,2" * n, "1.1%" * (n // 10), "@" * n, "-" * n + "@",
    ]
    df = spark.createDataFrame([(i, t[:300_000]) for i, t in enumerate(texts)], "id long, t string")
    got = entities.extract_entities(df, "id", "t")
    assert got.where("id in (1, 2)").where("label = 'EMAIL'").count() == 2
    bad = got.join(df, "id").where(F.expr("substring(t, start + 1, end - start)") != F.col("text"))
    assert bad.count() == 0


def test_entities_of_null_and_repeated_ids(spark):
    rows = [(1, "a 12 b"), (1, "xxxxxxxx 345"), (None, "12 a"), (None, "zzz 9"), (1, "a 12 b"), (2, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted((r["id"] or 0, r["start"], r["end"], r["text"]) for r in entities.extract_entities(df, "id", "t").collect())
    assert got == [(0, 0, 2, "12"), (0, 4, 5, "9"), (1, 2, 4, "12"), (1, 2, 4, "12"), (1, 9, 12, "345")]
    gz = spark.createDataFrame([("zzz", "GPE")], "token string, label string")
    assert [(r["id"], r["start"]) for r in entities.extract_entities(df, "id", "t", gz).where("label = 'GPE'").collect()] == [(None, 0)]


def test_vectors_and_bags_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "aa bb"), (1, "cc"), (1, "aa bb"), (None, "aa"), (None, "dd ee")], "id long, t string")
    dense = vectors.dense_tfidf(df, "id", "t", 16).collect()
    assert len(dense) == 5 and all(math.isclose(np.linalg.norm(r["vector"]), 1.0) for r in dense)
    bags = sorted((r["id"] or 0, r["term"], r["count"]) for r in topics.bag_of_words(df, "id", "t").collect())
    assert bags == sorted([(0, "aa", 1), (0, "dd", 1), (0, "ee", 1), (1, "aa", 1), (1, "aa", 1), (1, "bb", 1), (1, "bb", 1), (1, "cc", 1)])


def test_keywords_shuffle_nothing_and_count_any_chunk_alike(spark, monkeypatch):
    texts = ["Big cats of the world. NASA and big cats; the cats of Rome!", "", None, "and the of", "One\nOne two. one TWO three", "x " * 50 + "Yes."] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").coalesce(1)
    ways = [lambda: keywords.term_scores(df, "id", "t"), lambda: keywords.candidate_scores(df, "id", "t"), lambda: keywords.keywords(df, "id", "t"), lambda: keywords.prompts_of(df, "id", "t")]
    for way in ways:
        plan = way()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    batch = keywords.sentence_words(df, "id", "t").toArrow().combine_chunks().to_batches()[0]

    def found(size):
        monkeypatch.setattr(keywords, "CHUNK_WORDS", size)
        chunks = list(keywords._chunks(batch))
        rows = []
        for first, chunk in zip(np.cumsum([0, *(c.num_rows for c in chunks)]), chunks):
            doc, columns = keywords._Chunk(chunk).candidates(3)
            rows += list(zip((doc + first).tolist(), *(c.to_pylist() for c in columns)))
        return len(chunks), sorted(rows)

    one, many = found(10**6), found(5)
    assert one[0] == 1 and many[0] > 3 and one[1] == many[1] and {r[0] for r in one[1]} == {0, 4, 5, 6, 10, 11}
    assert ("big cats", 2, 2) in {(k, n, kf) for d, k, n, kf, _ in one[1] if d == 0} and ("world", 1, 1) in {(k, n, kf) for d, k, n, kf, _ in one[1] if d == 0}


def test_topics_of_any_blocks_and_buckets(spark, monkeypatch):
    import numpy as np

    sides = [["apple", "pear", "plum", "fig"], ["bolt", "nut", "screw", "nail"]]
    texts = [" ".join(sides[i % 2][(i + j * j) % 4] for j in range(30)) + f" rare{chr(97 + i % 26)}" for i in range(60)] + [None, "", "7 a"]
    found = []
    for parts, terms in ((1, 100), (5, 3)):
        monkeypatch.setattr(topics, "BUCKET_TERMS", terms)
        df = spark.createDataFrame([(None if i % 9 == 0 else i % 7, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(parts)
        model = topics.learn(df, "doc_id", "text", k=2, max_iter=4)
        assert (model.terms.count() > 1) == (terms == 3)
        names = [t for r in model.terms.collect() for t in r["terms"]]
        assert sorted(names) == sorted({w for t in texts for w in (t or "").split() if len(w) > 1})
        weights = {r["bucket"]: np.frombuffer(r["weights"], float).reshape(-1, 2) for r in model.weights.collect()}
        assert np.allclose(sum(w.sum(axis=0) for w in weights.values()), model.totals)
        # a round moves the weights towards the documents' counts, all of them
        rate, total = [(topics.TAU + s) ** -topics.KAPPA for s in range(1, 5)], topics.first_weights(names, 2, 7).sum()
        for r in rate:
            total = (1 - r) * total + r * (60 * 31 + len(names))
        assert abs(model.totals.sum() - total) < 1e-3
        rows = topics.describe_topics(df, "doc_id", "text", k=2, terms=4, max_iter=4).collect()
        assert [(r["topic_id"], r["rank"]) for r in sorted(rows)] == [(t, n) for t in range(2) for n in range(4)]
        found.append({(r["topic_id"], r["term"]): r["weight"] for r in rows})
    assert found[0].keys() == found[1].keys() and all(abs(found[0][x] - found[1][x]) < 1e-4 for x in found[0])


def test_topics_without_terms(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert topics.describe_topics(df, "doc_id", "text", k=2, max_iter=2).collect() == []


def test_topics_leave_no_shuffles_behind(spark):
    import glob
    import time

    from sparkloom.session import ensure_checkpoint_dir

    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in row) for row in rng.integers(0, 26, (20_000, 6))]
    df = spark.createDataFrame([(i, " ".join(words[w] for w in rng.integers(0, len(words), 300))) for i in range(200)], "doc_id int, text string").repartition(4).cache()
    df.count()
    manager, staged = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/sparkloom-staging"

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(i).getPath(): files.apply(i).length() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, dirs, setting = shuffled(), set(glob.glob(f"{staged}/*")), spark.conf.get(key)
    model = topics.learn(df, "doc_id", "text", k=2, max_iter=4)
    for _ in range(20):
        left = sum(n for f, n in shuffled().items() if f not in kept)
        if left < 100_000:
            break
        time.sleep(0.5)
    assert left < 100_000  # a round exchanges some 40,000 terms of blocks, 8 bytes each, both ways
    # the documents, packed, and the last round's weights are all that is staged; a term takes 16 bytes there
    new = sorted(d.rsplit("/", 1)[1].rsplit("-", 1)[0] for d in set(glob.glob(f"{staged}/*")) - dirs if glob.glob(f"{d}/*"))
    assert new == ["topics-documents", "topics-links", "topics-weights"] and model.weights.count() >= 1
    assert spark.conf.get(key) == setting and not spark.sparkContext._jsc.getPersistentRDDs().size() > 1
    df.unpersist()
    rising = np.array([0, 3, 4, 70_000, 2, 2_000_000_000])
    assert topics._rising(topics._bytes(np.diff(rising, prepend=0))).tolist() == rising.tolist() and len(topics._numbers(topics._bytes(rising[:0]))) == 0
    assert len(topics._bytes(np.diff(np.arange(0, 300_000, 3), prepend=0))) < 2_000
