import os
import shutil

import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators import refresh


def full(spark, path):
    """The profile of all rows, without any state."""
    df = spark.read.parquet(path)
    return sorted((c, df.count(), df.where(F.col(c).isNull()).count(), df.agg(F.min(c)).first()[0], df.agg(F.max(c)).first()[0]) for c in df.columns)


def profile(state):
    number = lambda t, v: v if v is None or t == "string" else float(v)
    return sorted((r["column"], r["rows"], r["nulls"], number(r["type"], r["least"]), number(r["type"], r["greatest"])) for r in refresh.merged_profile(state).collect())


def test_profile_follows_the_files(spark, tmp_out, monkeypatch):
    data, state = os.path.join(tmp_out, "data"), os.path.join(tmp_out, "state")
    part = lambda a, b: spark.range(a, b).selectExpr("id", "cast(id % 7 as double) AS v", "if(id % 3 = 0, null, concat('n', id % 50)) AS name").coalesce(1)
    for a in (0, 100, 200):
        part(a, a + 100).write.mode("append").parquet(data)
    read = []
    inner = refresh.file_profiles
    monkeypatch.setattr(refresh, "file_profiles", lambda df: read.append(len(df.inputFiles())) or inner(df))
    assert profile(refresh.refresh(spark, data, state)) == full(spark, data)
    assert profile(refresh.refresh(spark, data, state)) == full(spark, data)  # nothing changed: nothing read
    part(1000, 1300).write.mode("append").parquet(data)  # added
    assert profile(refresh.refresh(spark, data, state)) == full(spark, data)
    names = sorted(f for f in os.listdir(data) if f.endswith(".parquet"))
    os.remove(os.path.join(data, names[0]))  # removed
    part(5000, 5010).write.parquet(os.path.join(tmp_out, "other"))
    new = [f for f in os.listdir(os.path.join(tmp_out, "other")) if f.endswith(".parquet")][0]
    shutil.copy(os.path.join(tmp_out, "other", new), os.path.join(data, names[1]))  # replaced
    for f in os.listdir(data):
        if f.endswith(".crc"):
            os.remove(os.path.join(data, f))
    last = refresh.refresh(spark, data, state)
    assert profile(last) == full(spark, data) and read == [3, 1, 1]
    n = spark.read.parquet(data).agg(F.count_distinct("id")).first()[0]
    assert {r["column"]: r["approx_distinct"] for r in refresh.merged_profile(last).collect()}["id"] == pytest.approx(n, rel=0.1)


def test_clashing_types_are_refused(spark):
    rows = [("f1", None, 1, "a", t, 1, 0, None, None, None, None, None) for t in ("int", "string")]
    with pytest.raises(ValidationError):
        refresh.merged_profile(spark.createDataFrame(rows, refresh.STATE))
