"""License scans, periodic runs and ranked search against brute force, and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import licenses, periodic, queries, ranked

from odd_tables import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# 11 licenses


def scanned(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places = sorted((i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    found = {}
    for label, template in templates:
        tokens, window = set(template.split()), licenses.window_of(len(template.split()))
        for i in range(0, max(len(words), 1), window // 2):
            held = len(tokens & set(words[i : i + window]))
            if held >= licenses.needed(len(tokens), threshold):
                found[label] = max(found.get(label, 0), held / len(tokens))
    return len(words), places, sorted(found.items())


def matched(df, **params):
    return [
        (r["n_words"], sorted((p["start"], p["label"]) for p in r["places"]), [(m["label"], m["containment"]) for m in r["matches"]])
        for r in licenses.license_matches(df, **params).orderBy("doc_id").collect()
    ]


def test_license_matches_equal_brute_force(spark):
    rng = random.Random(1)
    texts = []
    for i in range(80):
        label, template = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = template.split()
        for _ in range(rng.randrange(4)):  # edits: some leave the containment, some don't
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["zzz"], [words[at].upper()], [words[at], "Ünter"]])
        before = ["w%d" % rng.randrange(50) for _ in range(rng.randrange(90))]
        texts.append(" ".join(before) + rng.choice(["\n", " - ", "? "]) + rng.choice(["\n", " ", ", "]).join(words) + " ".join(["", *before[:7]]))
    texts += ["All Rights\n\nRESERVED; all rights reserved", "CC BY cc-by ccby CC BY", "cc by" * 3, "general public license general public license"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    for threshold in (0.6, licenses.THRESHOLD, 1.0):
        assert matched(df, threshold=threshold) == [scanned(t, threshold=threshold) for t in texts]
    assert any(m for _, _, m in map(scanned, texts))


def test_license_matches_of_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    assert matched(docs) == [scanned(t) for t in texts]
    got = {r["doc_id"]: r for r in queries.op11_licenses(spark, SF).collect()}
    assert len(got) == len(texts) and all((r["n_base"] > 0) == (r["first_word"] is not None) and 0 <= r["score"] <= 1 for r in got.values())


def test_licenses_odd(spark, odd_docs, no_docs):
    got = licenses.license_matches(odd_docs)
    assert set(odd_docs.columns) <= set(got.columns) and got.count() == odd_docs.count()
    assert {(r["n_words"], len(r["places"]), len(r["matches"])) for r in got.where("doc_id in (2, 3, 4)").collect()} == {(0, 0, 0)}
    assert got.where("doc_id = 6").first()["n_words"] == 60_000
    assert licenses.license_matches(no_docs).count() == 0
    assert [r["matches"] for r in licenses.license_matches(odd_docs, templates=(), phrases=()).collect()] == [[]] * odd_docs.count()


def test_windows_hold_every_passage():
    for n in range(1, 70):
        w = licenses.window_of(n)
        for at in range(3 * w):
            assert any(s <= at and at + n <= s + w for s in range(0, at + 1, w // 2))


# 12 periodic runs


def brute_runs(words, least=6, exponent=4):
    seen = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                seen.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_wavelet_tree_equals_scans():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 200):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values)
        left = rng.integers(0, n, 50)
        right = np.minimum(left + 1 + rng.integers(0, n, 50), n)
        v = rng.integers(0, n + 1, 50)
        assert (tree.below(left, right, v) == [(values[a:b] < x).sum() for a, b, x in zip(left, right, v)]).all()
        k = rng.integers(0, right - left)
        assert (tree.smallest(left, right, k) == [sorted(values[a:b])[x] for a, b, x in zip(left, right, k)]).all()


def test_suffixes_are_sorted():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30, 300):
        codes = np.append(rng.integers(0, 3, n), 99)
        sa, ranks = periodic.sorted_suffixes(codes)
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: codes[i:].tolist())
        for k, rank in enumerate(ranks):
            blocks = [tuple(codes[i : i + 2**k]) for i in range(n + 1)]
            assert all((rank[i] == rank[j]) == (blocks[i] == blocks[j]) for i in range(0, n, 3) for j in range(0, n, 5))


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for trial in range(400):
        words = []
        while len(words) < rng.randrange(1, 90):
            piece = [rng.choice("ab" if trial % 2 else "abcdef") for _ in range(rng.randrange(1, 9))]
            words += (piece * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        assert [tuple(r) for r in periodic.runs_of(np.array([*map(ord, words), 999])).tolist()] == brute_runs(words), words
    with pytest.raises(ValueError):
        periodic.runs_of(np.array([1, 2]), min_exponent=3)


def test_runs_of_documents_together(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a b c d", "e f", "g", "h i j"]) for _ in range(rng.randrange(40))) for _ in range(120)] + ["x " * 3000, "p q r " * 700, " a a " * 9]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, runs string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(df).collect()}
    for i, t in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0d]+", t)
        runs = brute_runs(words) if len(words) < 1000 else [tuple(x) for x in got[i]["runs"]]
        assert [(r["start"], r["length"], r["period"]) for r in got[i]["runs"]] == runs and got[i]["collapsed"] == collapsed(words, runs)
    assert [tuple(x) for x in got[120]["runs"]] == [(0, 3000, 1)] and [tuple(x) for x in got[121]["runs"]] == [(0, 2100, 3)]


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for i, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        runs = brute_runs([number[w] for w in words])
        some += len(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        }
    assert some > 10


def test_runs_odd(spark, odd_docs, no_docs):
    got = periodic.periodic_runs(odd_docs)
    assert set(odd_docs.columns) <= set(got.columns) and got.count() == odd_docs.count()
    assert {(len(r["runs"]), r["collapsed"]) for r in got.where("doc_id in (2, 3, 4)").collect()} == {(0, "")}
    assert [tuple(r) for r in got.where("doc_id = 6").first()["runs"]] == [(0, 60_000, 977)]
    assert periodic.periodic_runs(no_docs).count() == 0
    assert queries.with_planted_repeats(odd_docs.select("doc_id", "text")).count() == odd_docs.count()


# 13 ranked search


def brute_ranking(docs, items, k):
    find = lambda t: [x.translate(LOWER) for x in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    counted = [(i, Counter(find(t))) for i, t in docs]
    documents, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        hits = []
        for i, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * documents // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(find(text)) if t in c
            )
            if score > 0:
                hits.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def ranking(docs, items, k):
    return sorted(map(tuple, ranked.top_documents(docs, items, k=k).collect()), key=str)


@pytest.mark.parametrize("bucket", [3, 1024])
def test_ranking_equals_brute_force(spark, monkeypatch, bucket):
    rng = random.Random(5)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 300}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(200)] + [(None, docs[8][1]), (None, docs[8][1]), (3, docs[9][1]), (5000, None), (5001, " .. "), (5002, "Ünter ÜNTER w1 W1")]
    items = [(i, " ".join(word().upper() for _ in range(rng.randrange(12)))) for i in range(25)] + [(50, None), (51, "Ünter, w2"), (51, "w3"), (None, "w4 w4")]
    left = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(7)
    right = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    monkeypatch.setattr(ranked, "FOCUS", 3)
    assert ranking(left, right, 20) == brute_ranking(docs, items, 20)


def test_ranking_in_blocks_of_items(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    expect = brute_ranking(docs, items, 50)
    assert sorted(map(tuple, queries.op13_ranked_search(spark, SF).collect()), key=str) == expect
    monkeypatch.setattr(ranked, "BLOCK_CHARS", 3000)
    some = spark.createDataFrame(items, "item_id long, text string")
    assert ranking(spark.createDataFrame(docs, "doc_id long, text string"), some, 50) == expect


def test_bounds_prune_without_loss(spark):
    """Scores are never above the bounds that prune."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    held = [np.unique(rng.integers(0, 40, 12)).astype(np.int32) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50)), pa.array([60] * 50), pa.array(held, pa.list_(pa.int32())), pa.array([rng.integers(1, 9, len(h)) for h in held], pa.list_(pa.int64()))],
        names=["id", "n", "terms", "tfs"],
    )
    b = ranked._Bucket(batch, 50, 3000)
    ts, ws = np.arange(0, 20), np.sort(rng.integers(1, 5000, 20))[::-1]
    weight_of = np.zeros(40, np.int64)
    weight_of[ts] = ws
    exact = b.scores(np.arange(50), weight_of)
    assert (exact <= b.bounds(ts[:5], ws[:5], math.sqrt((ws[5:].astype(float) ** 2).sum()))).all()
    assert exact.max() <= b.longest() * math.sqrt((ws.astype(float) ** 2).sum())


def test_ranking_odd(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    got = ranking(odd_docs, items, 50)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [1, 5, 5, None] and {r[0] for r in got} == {1}
    assert ranked.top_documents(no_docs, items).count() == 0
    assert ranked.top_documents(odd_docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked.top_documents(odd_docs, items.limit(0)).count() == 0
