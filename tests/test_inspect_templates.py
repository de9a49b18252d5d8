import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators import inspect
from sparkloom.plans import templates

from conftest import SF_SMALL


def test_profile_one_job_with_nulls_and_maps(spark):
    df = spark.createDataFrame(
        [(1, "a", None, {"k": 1}), (2, "b", 2.5, {"k": 2}), (2, None, 1.5, None)],
        "i int, s string, d double, m map<string,int>",
    )
    prof = {r["column_name"]: r for r in inspect.profile_columns(df).collect()}
    assert prof["i"]["total_count"] == 3 and prof["i"]["distinct_count"] == 2
    assert prof["s"]["total_count"] == 2 and prof["s"]["min_value"] == "a" and prof["s"]["max_value"] == "b"
    assert prof["d"]["min_value"] == "1.5" and prof["d"]["max_value"] == "2.5"
    assert prof["m"]["min_value"] is None and prof["m"]["total_count"] == 2
    approx = {r["column_name"]: r for r in inspect.profile_columns(df, approximate=True).collect()}
    assert approx["i"]["distinct_count"] == 2


def test_profile_samples_and_odd_names(spark):
    df = spark.createDataFrame([(i % 7, None) for i in range(20)], "`it's` int, `a``b.c` string")
    prof = {r["column_name"]: r for r in inspect.profile_columns(df).collect()}
    assert prof["it's"]["sample_values"] == ["0", "1", "2", "3", "4"] and prof["it's"]["distinct_count"] == 7
    assert prof["a`b.c"]["sample_values"] == [] and prof["a`b.c"]["total_count"] == 0
    assert inspect.profile_columns(df, approximate=True).count() == 2


def test_schema_hash_of_names_outside_ascii(spark):
    df = spark.createDataFrame([(1, "x")], "`größe` int, `名` string")
    assert inspect.schema_hash(df) == inspect.schema_hash_frame(inspect.schema_frame(df)).first()[0]


def test_schema_drift_all_kinds(spark):
    old = spark.createDataFrame([(1, "x", 1.0)], "a int, b string, c double")
    new = spark.createDataFrame([(1, 2.0, 3)], "a bigint, c double, d int")
    new = new.select(F.when(F.col("a") > 0, F.col("a")).alias("a"), "c", "d")
    nn = spark.createDataFrame([], "column_name string, data_type string, nullable boolean")
    o = inspect.schema_frame(old)
    n = inspect.schema_frame(new)
    # force one nullability change
    n = n.withColumn("nullable", F.when(F.col("column_name") == "c", F.lit(False)).otherwise(F.col("nullable")))
    drift = {r["column_name"]: r["change"] for r in inspect.schema_drift(o, n).collect()}
    assert drift == {"a": "type_changed", "b": "removed", "c": "nullability_changed", "d": "added"}
    assert inspect.schema_drift(o, o).count() == 0
    assert nn.count() == 0


def test_schema_hash_python_equals_spark(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert inspect.schema_hash(df) == inspect.schema_hash_frame(inspect.schema_frame(df)).first()[0]


def test_templates(spark):
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    out = templates.run_template(cust, "group_count", {"key": "c_mktsegment"})
    assert out.agg(F.sum("n")).first()[0] == cust.count()
    rng = templates.run_template(cust, "filter_range", {"column": "c_acctbal", "low": 0.0, "high": 100.0})
    assert rng.count() == cust.filter("c_acctbal BETWEEN 0 AND 100").count()
    with pytest.raises(ValidationError, match="missing"):
        templates.run_template(cust, "group_count", {})
    with pytest.raises(ValidationError, match="unknown parameters"):
        templates.run_template(cust, "group_count", {"key": "c_mktsegment", "extra": 1})
    with pytest.raises(ValidationError, match="do not name columns"):
        templates.run_template(cust, "group_count", {"key": "nope"})
    with pytest.raises(ValidationError, match="Unknown template"):
        templates.get_template("nope")
    # values are bound as parameters, never spliced into the SQL text
    # the string is bound as a value: Spark rejects it as a number instead of running it
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        templates.run_template(cust, "filter_range", {"column": "c_acctbal", "low": "0 OR 1=1", "high": 1.0}).count()
    info = templates.template_info(templates.get_template("group_count"), {"key": "c_mktsegment"})
    assert info["parameter_count"] == 1 and info["validation_status"] == "valid"


def test_sample_rows(spark):
    reg = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    assert [r[0] for r in inspect.sample_rows(reg, 3, ["r_regionkey"]).collect()] == [0, 1, 2]
    assert inspect.sample_rows(reg).count() == 5
