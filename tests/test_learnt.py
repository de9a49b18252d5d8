import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.text import entities, extract, semantic, tagger

from conftest import SF_ORACLE, SF_SMALL


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(30):
        labels = int(rng.integers(2, 5))
        transitions = rng.normal(size=(labels, labels))
        sentences = [rng.normal(size=(int(rng.integers(1, 6)), labels)) for _ in range(int(rng.integers(1, 6)))]
        for e, best in zip(sentences, tagger.viterbi(sentences, transitions)):
            score = lambda p: sum(e[i, x] for i, x in enumerate(p)) + sum(transitions[a, b] for a, b in zip(p, p[1:]))
            assert score(tuple(best)) == pytest.approx(max(map(score, itertools.product(range(labels), repeat=len(e)))))
    assert tagger.viterbi([], np.zeros((2, 2))) == []


def f1(got, expect):
    got, expect = set(got), set(expect)
    return 2 * len(got & expect) / max(len(got) + len(expect), 1)


def test_tagger_finds_names_it_never_saw(spark):
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 3))).capitalize()
    rows = []
    for i in range(400):
        text, spans = "", []
        for _ in range(4):
            before, kind, after = rng.choice([("we met ", "PERSON", " at noon. "), ("a train to ", "GPE", " left. "), ("she works for ", "ORG", " now. "), ("the red house of stone. ", None, "")])
            text += before
            if kind:
                words = " ".join(name() for _ in range(rng.randint(1, 2)))
                spans.append((len(text), len(text) + len(words), kind))
                text += words
            text += after
        rows.append((i, text, spans))
    schema = "key long, text string, spans array<struct<start:int,end:int,label:string>>"
    model = tagger.fit(spark.createDataFrame(rows[:200], schema), rounds=4)
    held = spark.createDataFrame([(i, t) for i, t, _ in rows[200:]], "id long, text string")
    got = [(r["id"], r["start"], r["end"], r["label"]) for r in tagger.tagged(held, "id", "text", model).collect()]
    assert f1(got, [(i, *s) for i, _, spans in rows[200:] for s in spans]) > 0.9
    odd = spark.createDataFrame([(None, "we met Baba at noon."), (1, None), (1, ""), (1, "we met Baba at noon.")], "id long, text string")
    assert sorted(((r["id"] or 0, r["text"]) for r in extract.extract_text_features(odd, "id", "text", "ENTITIES", tagger=model).collect())) == [(0, "Baba"), (1, "Baba")]


def test_tagger_learns_the_rules_labels(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    model = tagger.fit(tagger.labelled_by_rules(docs.where("doc_id % 3 <> 0"), "doc_id", "text"))
    held = docs.where("doc_id % 3 = 0")
    key = lambda df: [(r["doc_id"], r["start"], r["end"], r["label"]) for r in df.collect()]
    assert f1(key(tagger.tagged(held, "doc_id", "text", model)), key(entities.extract_entities(held, "doc_id", "text"))) > 0.6


def test_tagger_without_labels(spark):
    none = spark.createDataFrame([], "key long, text string, spans array<struct<start:int,end:int,label:string>>")
    model = tagger.fit(none)
    assert model.labels == ["O"] and tagger.tagged(spark.createDataFrame([(1, "a b")], "id long, text string"), "id", "text", model).count() == 0


def test_singular_values_and_subspace_equal_numpy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = semantic._staged(semantic.sparse_rows(docs, "doc_id", "text", bins=512).repartition(20))
    dense = np.zeros((docs.count(), 512))
    for i, r in enumerate(rows.collect()):
        dense[i, r["at"]] = r["value"]
    k = 4
    _, singular, right = np.linalg.svd(dense)
    model = semantic.fit(rows, k=k, rounds=30, more=28, bins=512)
    assert np.abs(model.singular - singular[:k]).max() < 1e-6
    assert np.abs(np.linalg.svd(right[:k] @ model.directions)[1] - 1).max() < 1e-6
    assert np.allclose(model.directions.T @ model.directions, np.eye(k))


def test_nearest_neighbours_of_edited_copies(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) > 300").select("doc_id", "text").dropDuplicates(["text"])
    words = F.split("text", " ")
    edited = docs.select((-F.col("doc_id") - 1).alias("doc_id"), F.array_join(F.filter(words, lambda w, i: i % 8 != 3), " ").alias("text"))
    got = {r["doc_id"]: np.array(r["vector"]) for r in semantic.semantic_vectors(docs.union(edited), "doc_id", "text", k=32).collect()}
    ids = [i for i in got if i >= 0]
    table = np.stack([got[i] for i in ids])
    near = [ids.index(i) in np.argsort(-(table @ got[-i - 1]))[:5] for i in ids]
    assert np.mean(near) >= 0.9


def test_learnt_vectors_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "aa bb"), (1, "cc"), (None, "aa bb"), (2, None), (3, "1 2")], "id long, t string")
    got = extract.extract_text_features(df, "id", "t", learnt=2).collect()
    assert len(got) == 5 and sorted(round(float(np.linalg.norm(r["vector"])), 6) for r in got) == [0, 0, 1, 1, 1]
    assert semantic.semantic_vectors(df.limit(0), "id", "t", k=2).count() == 0


def test_sentences_of_many_texts_at_once_equal_each_alone(spark, monkeypatch):
    rng = np.random.default_rng(5)
    labels = ["O", "B-P", "I-P", "B-Q", "I-Q"]
    texts = [" ".join(rng.choice(["aa", "Bb", "c7", "12", ".", "!", "\n"], int(rng.integers(0, 40)))) for _ in range(60)]
    for lead in (0, 2, 6):  # of O: no sentence, some, nearly all have the best path O throughout
        weights = rng.normal(size=(tagger.BINS, len(labels)))
        weights[:, 0] += lead / 4
        model = tagger.Tagger(labels, weights, rng.normal(size=(len(labels), len(labels))))
        alone = []
        for text in texts:
            alone.append([])
            for s in tagger.tokens_of(text):
                best = tagger.viterbi([weights[tagger.features([w for w, _, _ in s])].sum(axis=1)], model.transitions)[0]
                alone[-1] += tagger._spans(s, [labels[i] for i in best])
        assert model.spans_of(texts) == alone == [model.spans(t) for t in texts]
        monkeypatch.setattr(tagger, "WORDS_AT_ONCE", 7)
        monkeypatch.setattr(tagger, "MEMO_WORDS", 3)
        assert model.spans_of(texts) == alone
        monkeypatch.undo()


def test_products_of_tiles_equal_dense(monkeypatch):
    import pyarrow as pa

    rows = [semantic.sparse_row(t, 64) for t in ("a b c a", "", "b", "c d e f g", None, "é a")]
    batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows]) for i in (0, 1)], names=["at", "value"])
    dense = np.zeros((len(rows), 64))
    for i, (at, value) in enumerate(rows):
        dense[i, at] = value
    table = np.random.default_rng(3).normal(size=(64, 5))
    monkeypatch.setattr(semantic, "TILE_ROWS", 4)
    total = np.ones((64, 5))
    semantic._add_back(total, batch, table)
    assert np.allclose(total, 1 + dense.T @ dense @ table) and np.allclose(semantic._product(batch, table), dense @ table)
