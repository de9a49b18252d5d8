import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators import numbering, sketches
from sparkloom.sources import files


def test_versions_of_a_dataset_as_one(spark, tmp_out):
    one = spark.createDataFrame([(1, "a", 1.5, (1, "x")), (2, None, None, None)], "id int, name string, v float, s struct<a:int,b:string>")
    two = spark.createDataFrame([((2**40, None), 2**40, True)], "s struct<a:bigint,c:date>, id bigint, flag boolean")
    one.write.parquet(f"{tmp_out}/1")
    two.write.parquet(f"{tmp_out}/2")
    got = files.load_merged(spark, [f"{tmp_out}/1", f"{tmp_out}/2"])
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("id", "bigint"), ("name", "string"), ("v", "float"), ("s", "struct<a:bigint,b:string,c:date>"), ("flag", "boolean"),
    ]
    rows = {r["id"]: r for r in got.collect()}
    assert rows[1]["s"].asDict() == {"a": 1, "b": "x", "c": None} and rows[2**40]["s"].asDict() == {"a": 2**40, "b": None, "c": None}
    assert rows[2]["s"] is None and rows[2**40]["name"] is None and rows[1]["flag"] is None
    plan = got.where("id = 2")._sc._jvm.PythonSQLUtils.explainString(got.where("id = 2").select("name")._jdf.queryExecution(), "formatted")
    assert plan.count("PushedFilters: [IsNotNull(id)") == 2


def test_clashes_are_refused(spark, tmp_out):
    spark.range(1).selectExpr("id", "'x' AS v").write.parquet(f"{tmp_out}/1")
    spark.range(1).selectExpr("id", "1 AS v").write.parquet(f"{tmp_out}/2")
    with pytest.raises(ValidationError, match="'v' is string"):
        files.load_merged(spark, [f"{tmp_out}/1", f"{tmp_out}/2"])
    with pytest.raises(ValidationError):
        files.load_merged(spark, [])


def test_row_numbers_with_hot_ties(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id") % 700).alias("k"), F.col("id").alias("tie"))
    got = numbering.numbered(df, ["k", "tie"]).orderBy("row_number").collect()
    expect = df.orderBy("k", "tie").collect()
    assert [r["row_number"] for r in got] == list(range(9000)) and [(r["k"], r["tie"]) for r in got] == [tuple(r) for r in expect]
    # equal keys alone: a third of the rows, cut by the hash of the row
    loose = numbering.numbered(df, ["k"], ranges=12)
    keys = [r["k"] for r in loose.orderBy("row_number").collect()]
    assert keys == [r["k"] for r in expect]
    path = loose.inputFiles()
    sizes = [spark.read.parquet(p).count() for p in path]
    assert max(sizes) <= 2 * 9000 / 12 and len(sizes) >= 10


def test_pairs_by_position(spark):
    a = spark.createDataFrame([(x,) for x in "dbac"], "t string")
    b = spark.createDataFrame([(3,), (1,), (2,)], "i int")
    got = sorted(map(tuple, numbering.pair_by_position(a, b, ["t"], [F.desc("i")]).collect()))
    assert got == [(0, "a", 3), (1, "b", 2), (2, "c", 1)]
    assert numbering.pair_by_position(a.limit(0), b, ["t"], ["i"]).count() == 0


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"), F.when(F.col("id") % 7 > 0, F.col("id") % 40_000).alias("v"))
    exact = {r["a"]: r for r in df.groupBy("a").agg(F.count_distinct("v").alias("n"), F.median("v").alias("m")).collect()}
    for kind in sketches.KINDS:
        merged = sketches.union(sketches.sketch(df, kind, "v", ["a", "b"]), kind, ["a"])
        for r in sketches.estimate(merged, kind, ["a"]).collect():
            e = exact[r["a"]]
            if kind == "BITMAP":
                assert r["estimate"] == e["n"]
            else:
                assert r["estimate"] == pytest.approx(e["m"] if kind == "QUANTILES" else e["n"], rel=0.1)
        whole = sketches.estimate(sketches.union(merged, kind), kind).first()["estimate"]
        assert whole == pytest.approx(df.select(F.median("v")).first()[0] if kind == "QUANTILES" else df.select("v").distinct().where("v is not null").count(), rel=0.1)
    with pytest.raises(ValidationError):
        sketches.sketch(df, "nope", "v")
