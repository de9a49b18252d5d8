import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators import combine


def frames(spark, n=7, m=None, d=4, seed=0):
    rng = np.random.default_rng(seed)
    m = n if m is None else m
    T = rng.normal(size=(n, d))
    I = rng.normal(size=(m, d))
    t = spark.createDataFrame([(i, [float(v) for v in T[i]]) for i in range(n)], "id long, vector array<double>")
    im = spark.createDataFrame([(i, [float(v) for v in I[i]]) for i in range(m)], "id long, vector array<double>")
    return T, I, t, im


def as_matrix(df, col="combined", key="id"):
    rows = sorted(df.select(key, col).collect())
    return np.array([r[1] for r in rows])


def test_concat_and_weighted(spark):
    T, I, t, im = frames(spark)
    c = as_matrix(combine.combine_features(t, im, "CONCAT"))
    assert np.allclose(c, np.concatenate([T, I], axis=1))
    w = as_matrix(combine.combine_features(t, im, "WEIGHTED", weights={"text": 0.7, "image": 0.3}))
    expect = 0.7 * T / np.linalg.norm(T, axis=1, keepdims=True) + 0.3 * I / np.linalg.norm(I, axis=1, keepdims=True)
    assert np.allclose(w, expect)


def test_weighted_zero_vector_and_dim_mismatch(spark):
    t = spark.createDataFrame([(1, [0.0, 0.0])], "id long, vector array<double>")
    i = spark.createDataFrame([(1, [3.0, 4.0])], "id long, vector array<double>")
    out = combine.combine_features(t, i, "WEIGHTED").first()["combined"]
    assert np.allclose(out, [0.3, 0.4])
    bad = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id long, vector array<double>")
    with pytest.raises(Exception, match="equal length"):
        combine.combine_features(t, bad, "WEIGHTED").collect()


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_cross_attention_matches_dense_softmax(spark, block_rows):
    T, I, t, im = frames(spark, n=9, m=11, d=5, seed=block_rows)
    out = as_matrix(combine.cross_attention(t, im, block_rows=block_rows))
    S = T @ I.T
    P = np.exp(S - S.max(axis=1, keepdims=True))
    P /= P.sum(axis=1, keepdims=True)
    assert np.allclose(out, P @ I)


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_cross_attention_keeps_every_text_row(spark, block_rows):
    T, I, _, _ = frames(spark, n=9, m=11, d=5, seed=7)
    keys = ["a", "a", None, None, "b", "a", None, "c", "c"]
    schema = "id string, vector array<double>"
    t = spark.createDataFrame([*((k, v.tolist()) for k, v in zip(keys, T)), ("d", None)], schema)
    im = spark.createDataFrame([(None if i % 2 else "x", v.tolist()) for i, v in enumerate(I)], schema)
    out = [(r["id"], r["combined"]) for r in combine.cross_attention(t, im, block_rows=block_rows).collect()]
    P = np.exp(T @ I.T)
    expect = (P / P.sum(axis=1, keepdims=True)) @ I
    rounded = lambda rows: sorted((str(k), [] if v is None else [round(x, 9) + 0.0 for x in v]) for k, v in rows)
    assert rounded(out) == rounded([*zip(keys, expect.tolist()), ("d", None)])


def test_cross_attention_spreads_text(spark):
    _, _, t, im = frames(spark, n=64, m=3)
    left = combine.cross_attention(t.repartition(4), im, block_rows=2)._jdf.queryExecution().analyzed().toString()
    assert "(tgrp#" in left and "(igrp#" in left and "text_id" in left


def test_pairing_checks(spark):
    _, _, t, im = frames(spark, n=5, m=4)
    with pytest.raises(ValidationError, match="pair 1:1"):
        combine.combine_features(t, im, "CONCAT")
    with pytest.raises(ValidationError, match="Unknown combination"):
        combine.combine_features(t, t, "MAGIC")
    r = combine.pairing_report(t, im).first()
    assert (r["text_only"], r["image_only"], r["duplicated"]) == (1, 0, 0)


def test_vector_summary(spark):
    _, _, t, im = frames(spark, n=4, d=3)
    c = combine.combine_features(t, im, "CONCAT")
    rows = {r["side"]: (r["n_rows"], r["dim"]) for r in combine.vector_summary(t, im, c, "concat").collect()}
    assert rows == {"text": (4, 3), "image": (4, 3), "combined": (4, 6)}


def test_cross_attention_groups_stay_small(spark, monkeypatch):
    monkeypatch.setattr(combine, "GROUP_ROWS", 4)
    T, I, t, im = frames(spark, n=30, m=41, d=3, seed=5)
    made = combine.cross_attention(t, im, block_rows=2)
    P = np.exp(T @ I.T)
    assert np.allclose(as_matrix(made), (P / P.sum(axis=1, keepdims=True)) @ I)
    # no row holds a block: text and image rows meet in groups of about GROUP_ROWS rows, 8 x 11 of them
    plan = made._jdf.queryExecution().analyzed().toString()
    assert "collect_list(_iv" not in plan and "sequence(0, 10" in plan.replace("Some(Etc/UTC)", "")
