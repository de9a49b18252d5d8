import pytest
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError
from sparkloom.operators.aggregates import ALLOWED_AGGREGATES, aggregate_column
from sparkloom.plans.preview import preview_sql, run_preview_sql
from sparkloom.plans.spec import QuerySpec, apply_spec, dynamic_query
from sparkloom.plans.stats import observed_query, run_query
from sparkloom.dataset import Dataset

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_grouped_spec_matches_sql(spark, lineitem):
    spec = QuerySpec.build(
        where=["l_quantity > 25"],
        aggregations=[{"function": "SUM", "column": "l_quantity", "alias": "q"}, {"function": "count", "column": "*", "alias": "n"}],
        group_by=["l_returnflag"],
        order_by=[{"column": "q", "direction": "desc"}],
    )
    out = apply_spec(lineitem, spec)
    assert out.columns == ["l_returnflag", "q", "n"]
    lineitem.createOrReplaceTempView("li_spec")
    expect = spark.sql("SELECT l_returnflag, sum(l_quantity) q, count(*) n FROM li_spec WHERE l_quantity > 25 GROUP BY 1")
    assert rows(out) == rows(expect)
    # ordered by q descending
    qs = [r["q"] for r in out.collect()]
    assert qs == sorted(qs, reverse=True)


def test_preview_sql_is_equivalent(spark, lineitem):
    spec = QuerySpec.build(
        where=["l_discount > 0.03", "l_linestatus = 'O'"],
        aggregations=[{"function": "avg", "column": "l_tax", "alias": "t"}, {"function": "count_distinct", "column": "l_partkey", "alias": "p"}],
        group_by=["l_returnflag"],
        order_by=["l_returnflag"],
        limit=2,
    )
    sql = preview_sql(spec)
    assert "${table}" in sql and "GROUP BY" in sql and "LIMIT 2" in sql
    assert rows(run_preview_sql(lineitem, sql)) == rows(apply_spec(lineitem, spec))


def test_filters_before_projection_and_pushdown(lineitem):
    spec = QuerySpec.build(select=["l_orderkey"], where=["l_quantity < 5"])
    out = apply_spec(lineitem, spec)
    assert out.columns == ["l_orderkey"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(l_quantity" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_validation_errors(lineitem):
    with pytest.raises(ValidationError, match="Invalid columns"):
        apply_spec(lineitem, QuerySpec.build(select=["nope"]))
    with pytest.raises(ValidationError, match="Unsupported aggregate"):
        apply_spec(lineitem, QuerySpec.build(aggregations=[{"function": "explode", "column": "l_tax", "alias": "x"}]))
    with pytest.raises(ValidationError, match="direction"):
        QuerySpec.build(order_by=[{"column": "l_tax", "direction": "sideways"}])
    with pytest.raises(ValidationError, match="order by"):
        apply_spec(lineitem, QuerySpec.build(aggregations=[{"function": "sum", "column": "l_tax", "alias": "s"}],
                                             group_by=["l_returnflag"], order_by=["l_tax"]))
    with pytest.raises(ValidationError):
        aggregate_column("sum", "*")


def test_every_allowed_aggregate_resolves(spark):
    df = spark.createDataFrame([(1, 2.0, True, "a"), (2, 3.0, False, "b")], "i long, d double, b boolean, s string")
    for name in sorted(ALLOWED_AGGREGATES):
        col = {"bool_and": "b", "bool_or": "b", "every": "b", "some": "b", "count_if": "b",
               "bit_and": "i", "bit_or": "i", "bit_xor": "i", "listagg": "s", "string_agg": "s"}.get(name, "d")
        df.agg(aggregate_column(name, col, "x")).collect()


def test_sketch_aggregates_take_states(spark):
    states = spark.createDataFrame([(1,), (2,)], "i long").groupBy("i").agg(aggregate_column("bitmap_construct_agg", "i", "state"))
    assert states.agg(aggregate_column("bitmap_or_agg", "state", "x")).first()["x"][0] == 0b110


def test_group_keys_only_and_default_limit(lineitem):
    keys = dynamic_query(lineitem, group_by=["l_returnflag", "l_linestatus"], limit=0)
    assert keys.count() == lineitem.select("l_returnflag", "l_linestatus").distinct().count()
    assert dynamic_query(lineitem).count() == lineitem.count()  # no limit that nobody asked for
    assert dynamic_query(lineitem, limit=1000).count() == min(1000, lineitem.count())
    assert dynamic_query(lineitem, limit=-1).count() == lineitem.count()


def test_null_ordering(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "k int, v double")
    asc = [r["k"] for r in apply_spec(df, QuerySpec.build(order_by=["v"])).collect()]
    desc = [r["k"] for r in apply_spec(df, QuerySpec.build(order_by=[{"column": "v", "direction": "DESC"}])).collect()]
    assert asc == [1, 3, 2] and desc == [2, 3, 1]


def test_sort_by_unprojected_column(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 2.0)], "k int, v double")
    out = apply_spec(df, QuerySpec.build(select=["k"], order_by=["v"]))
    assert [r["k"] for r in out.collect()] == [2, 3, 1]


def test_observed_stats_and_cache(lineitem):
    spec = QuerySpec.build(where=["l_quantity > 40"])
    ds, q = run_query(Dataset(lineitem, "lineitem"), spec, "db.lineitem", cache="DISK")
    n = ds.df.count()
    st = q.stats()
    assert st["input_rows"] == lineitem.count() and st["output_rows"] == n == st["affected_rows"]
    assert ds.name == "query_result_db_lineitem" and ds.metadata["query_spec"]["where"] == ["l_quantity > 40"]
    ds.unpersist()
    with pytest.raises(ValueError):
        observed_query(lineitem, spec, cache="SOMETIMES")


def test_observed_input_under_a_limit(lineitem):
    _, q = run_query(Dataset(lineitem, "lineitem"), QuerySpec.build(where=["l_quantity > 40"], limit=5), "lineitem")
    assert len(q.result.collect()) == 5
    st = q.stats()
    assert st["input_rows"] == lineitem.count() and st["output_rows"] == 5 and st["execution_time"] > 0


def test_preview_mode_on_ties(spark):
    from sparkloom.plans.preview import preview_sql, run_preview_sql

    df = spark.createDataFrame([(1, 9), (1, 9), (1, 2), (1, 2), (1, 5)], "k int, v int")
    spec = QuerySpec.build(aggregations=[{"function": "mode", "column": "v", "alias": "m"}], group_by=["k"])
    assert run_preview_sql(df, preview_sql(spec)).first()["m"] == apply_spec(df, spec).first()["m"] == 2


def test_approximate_distinct_within_bound(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    spec = QuerySpec.build(aggregations=[{"function": "approx_count_distinct", "column": "l_partkey", "alias": "a"},
                                         {"function": "count_distinct", "column": "l_partkey", "alias": "e"}],
                           group_by=["l_returnflag"])
    for r in apply_spec(li, spec).collect():
        assert abs(r["a"] - r["e"]) <= 0.15 * r["e"]  # default rsd 0.05; 3 sigma
    from sparkloom.operators import inspect as insp

    exact = {r["column_name"]: r["distinct_count"] for r in insp.profile_columns(li.select("l_partkey", "l_suppkey")).collect()}
    approx = {r["column_name"]: r["distinct_count"] for r in insp.profile_columns(li.select("l_partkey", "l_suppkey"), approximate=True).collect()}
    assert all(abs(approx[k] - exact[k]) <= 0.15 * exact[k] for k in exact)
