"""Registered table queries: query specs, predicates, aggregates, sort/limit,
sources and sinks, inspection and templates (each with its DuckDB oracle)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sparkloom.dataset import Dataset
from sparkloom.operators import inspect, refresh, sketches
from sparkloom.plans.preview import preview_sql, run_preview_sql
from sparkloom.plans.registry import register, table
from sparkloom.plans.spec import QuerySpec, apply_spec, dynamic_query
from sparkloom.plans.stats import row_count_frame
from sparkloom.plans.templates import run_template
from sparkloom.session import staging_path
from sparkloom.sources import files


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (presentation for oracle comparison)."""
    cols = [
        F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _parquet_ref(sf_dir: str, name: str) -> str:
    return f"parquet.`{sf_dir.rstrip('/')}/{name}.parquet`"


# ---------------------------------------------------------------- query spec

FLAGSHIP = QuerySpec.build(
    where=["l_quantity > 25"],
    aggregations=[
        {"function": "sum", "column": "l_quantity", "alias": "sum_qty"},
        {"function": "sum", "column": "l_extendedprice", "alias": "sum_base_price"},
        {"function": "avg", "column": "l_discount", "alias": "avg_disc"},
        {"function": "count", "column": "*", "alias": "count_order"},
    ],
    group_by=["l_returnflag", "l_linestatus"],
    order_by=[{"column": "l_returnflag"}, {"column": "l_linestatus", "direction": "desc"}],
)


@register(
    "run_query_spec",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price, round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order
FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag, l_linestatus""",
)
def q_run_query_spec(spark: SparkSession, sf: str) -> DataFrame:
    out = apply_spec(table(spark, sf, "lineitem"), FLAGSHIP)
    return out.withColumn("sum_base_price", F.round("sum_base_price", 2)).withColumn("avg_disc", F.round("avg_disc", 6))


@register(
    "dynamic_query",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 100000
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 1000""",
)
def q_dynamic_query(spark: SparkSession, sf: str) -> DataFrame:
    return dynamic_query(
        table(spark, sf, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice"],
        ["o_orderstatus = 'O'", "o_totalprice > 100000"],
        order_by=[{"column": "o_totalprice", "direction": "DESC"}, {"column": "o_orderkey"}],
        limit=1000,
    )


@register("select_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_select_columns(spark: SparkSession, sf: str) -> DataFrame:
    return apply_spec(table(spark, sf, "customer"), QuerySpec.build(select=["c_custkey", "c_name", "c_mktsegment"]))


@register("filter_dataset", "SELECT * FROM nation WHERE n_regionkey IN (1, 3)")
def q_filter_dataset(spark: SparkSession, sf: str) -> DataFrame:
    ds = Dataset(table(spark, sf, "nation"), "nation")
    return files.filter_dataset(ds, "n_regionkey IN (1, 3)").df


@register(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'N' AND l_discount > 0.05 AND l_quantity < 10""",
)
def q_filter_conjunction(spark: SparkSession, sf: str) -> DataFrame:
    # the last filter names a column that the projection drops
    spec = QuerySpec.build(
        select=["l_orderkey", "l_linenumber", "l_quantity"],
        where=["l_returnflag = 'N'", "l_discount > 0.05", "l_quantity < 10"],
    )
    return apply_spec(table(spark, sf, "lineitem"), spec)


# ---------------------------------------------------------------- predicates

def _pred(name: str, tbl: str, cols: list[str], spark_cond, duck_cond: str):
    sql = f"SELECT {', '.join(cols)} FROM {tbl} WHERE {duck_cond}"

    @register(name, sql)
    def q(spark: SparkSession, sf: str) -> DataFrame:
        cond = spark_cond(sf) if callable(spark_cond) else spark_cond
        return round_doubles(apply_spec(table(spark, sf, tbl), QuerySpec.build(select=cols, where=[cond])))

    q.__name__ = f"q_{name}"
    return q


_pred(
    "pred_compare",
    "lineitem",
    ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"],
    "(l_quantity > 25 AND l_returnflag = 'R') OR NOT (l_linestatus = 'O' OR l_quantity >= 2)",
    "(l_quantity > 25 AND l_returnflag = 'R') OR NOT (l_linestatus = 'O' OR l_quantity >= 2)",
)
_pred(
    "pred_range_in_null",
    "lineitem",
    ["l_orderkey", "l_linenumber", "l_discount", "l_tax"],
    "l_discount BETWEEN 0.02 AND 0.05 AND l_linenumber IN (1, 3, 5) AND l_tax IS NOT NULL AND (l_returnflag <=> 'A')",
    "l_discount BETWEEN 0.02 AND 0.05 AND l_linenumber IN (1, 3, 5) AND l_tax IS NOT NULL AND (l_returnflag IS NOT DISTINCT FROM 'A')",
)
_pred(
    "pred_string",
    "part",
    ["p_partkey", "p_name", "p_brand"],
    "(lower(p_name) LIKE '%ring%' OR p_type RLIKE '^(PROMO|STANDARD) ') AND length(trim(p_brand)) = 8 "
    "AND substring(concat(p_brand, '#'), 7, 1) <> '5'",
    "(lower(p_name) LIKE '%ring%' OR regexp_matches(p_type, '^(PROMO|STANDARD) ')) AND length(trim(p_brand)) = 8 "
    "AND substring(concat(p_brand, '#'), 7, 1) <> '5'",
)
_pred(
    "pred_date",
    "orders",
    ["o_orderkey", "o_custkey", "o_orderstatus"],
    "o_orderdate >= TIMESTAMP_NTZ'1995-01-01 00:00:00' AND year(o_orderdate) < 1998 AND month(o_orderdate) IN (3, 4) "
    "AND date_trunc('MONTH', o_orderdate) + INTERVAL 10 DAYS > o_orderdate",
    "o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND year(o_orderdate) < 1998 AND month(o_orderdate) IN (3, 4) "
    "AND date_trunc('month', o_orderdate) + INTERVAL 10 DAYS > o_orderdate",
)
_pred(
    "pred_math",
    "orders",
    ["o_orderkey", "o_totalprice"],
    "sqrt(o_totalprice) > 300 AND abs(o_totalprice - round(o_totalprice, -3)) < 250 "
    "AND power(o_totalprice, 0.5) < 500 AND floor(log10(o_totalprice)) = 5",
    "sqrt(o_totalprice) > 300 AND abs(o_totalprice - round(o_totalprice, -3)) < 250 "
    "AND power(o_totalprice, 0.5) < 500 AND floor(log10(o_totalprice)) = 5",
)
_pred(
    "pred_conditional",
    "orders",
    ["o_orderkey", "o_orderpriority", "o_orderstatus"],
    "CASE WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderpriority LIKE '2%' THEN 2 ELSE 0 END = 1 "
    "AND coalesce(nullif(o_orderstatus, 'F'), 'X') = 'X' AND try_cast(o_orderkey AS string) IS NOT NULL "
    "AND cast(o_totalprice AS bigint) > 1000",
    "CASE WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderpriority LIKE '2%' THEN 2 ELSE 0 END = 1 "
    "AND coalesce(nullif(o_orderstatus, 'F'), 'X') = 'X' AND try_cast(o_orderkey AS varchar) IS NOT NULL "
    "AND cast(trunc(o_totalprice) AS bigint) > 1000",
)
_pred(
    "pred_array",
    "embeddings",
    ["vec_id", "label"],
    "exists(embedding, v -> v > 0.4) AND size(embedding) = 64 AND element_at(embedding, 1) < 0.3 "
    "AND array_contains(transform(embedding, v -> v > 0.45), true)",
    "len(list_filter(embedding, lambda v: v > 0.4)) > 0 AND len(embedding) = 64 AND embedding[1] < 0.3 "
    "AND list_contains(list_transform(embedding, lambda v: v > 0.45), true)",
)
_pred(
    "pred_json",
    "events",
    ["event_id", "user_id", "event_type", "value"],
    "cast(get_json_object(props, '$.k') AS int) > 50",
    "cast(json_extract_string(props, '$.k') AS int) > 50",
)
_pred(
    "pred_map",
    "events",
    ["event_id", "event_type"],
    "from_json(props, 'map<string,int>')['k'] > 60 AND array_contains(map_keys(from_json(props, 'map<string,int>')), 'k')",
    "cast(json_extract(props, '$.k') AS int) > 60 AND json_exists(props, '$.k')",
)
_pred(
    "pred_in_subquery",
    "orders",
    ["o_orderkey", "o_custkey"],
    lambda sf: f"o_custkey IN (SELECT c_custkey FROM {_parquet_ref(sf, 'customer')} WHERE c_acctbal > 5000)",
    "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)",
)
_pred(
    "pred_exists",
    "customer",
    ["c_custkey", "c_name"],
    lambda sf: f"EXISTS (SELECT 1 FROM {_parquet_ref(sf, 'orders')} o WHERE o.o_custkey = c_custkey AND o.o_totalprice > 300000)",
    "EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o.o_totalprice > 300000)",
)
_pred(
    "pred_not_in",
    "customer",
    ["c_custkey", "c_nationkey"],
    lambda sf: f"NOT EXISTS (SELECT 1 FROM {_parquet_ref(sf, 'orders')} o WHERE o.o_custkey = c_custkey AND o.o_orderstatus = 'F')",
    "NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o.o_orderstatus = 'F')",
)
_pred(
    "pred_not_in_nulls",
    "customer",
    ["c_custkey", "c_nationkey"],
    # NOT IN itself: a null on the left is never true, nor is any row once the subquery gives a null
    lambda sf: f"nullif(c_nationkey, 3) NOT IN (SELECT n_nationkey FROM {_parquet_ref(sf, 'nation')} WHERE n_regionkey = 1) "
    f"OR c_nationkey NOT IN (SELECT nullif(n_nationkey, 7) FROM {_parquet_ref(sf, 'nation')})",
    "nullif(c_nationkey, 3) NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) "
    "OR c_nationkey NOT IN (SELECT nullif(n_nationkey, 7) FROM nation)",
)
_pred(
    "pred_not_in_subquery",
    "customer",
    ["c_custkey", "c_nationkey"],
    # NOT IN on its own is planned as a null-aware anti join
    lambda sf: f"nullif(c_nationkey, 3) NOT IN (SELECT n_nationkey FROM {_parquet_ref(sf, 'nation')} WHERE n_regionkey = 1)",
    "nullif(c_nationkey, 3) NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
)
_pred(
    "pred_scalar_subquery",
    "orders",
    ["o_orderkey", "o_totalprice"],
    lambda sf: f"o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM {_parquet_ref(sf, 'orders')})",
    "o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders)",
)


def register_is_high_value(spark: SparkSession) -> None:
    """A vectorised (Arrow) UDF that filter strings can call by name."""

    @F.pandas_udf("boolean")
    def is_high_value(v: pd.Series) -> pd.Series:
        return v > 50.0

    spark.udf.register("sparkloom_is_high_value", is_high_value)


@register("pred_udf", "SELECT event_id, value FROM events WHERE value > 50.0")
def q_pred_udf(spark: SparkSession, sf: str) -> DataFrame:
    register_is_high_value(spark)
    spec = QuerySpec.build(select=["event_id", "value"], where=["sparkloom_is_high_value(value)"])
    return round_doubles(apply_spec(table(spark, sf, "events"), spec))


# ---------------------------------------------------------------- aggregates

_GROUP = ["l_returnflag", "l_linestatus"]


def _within_bound(approx: str, exact: str, rsd: float = 0.05):
    """An approximate distinct count within three standard deviations (at least 1) of the exact one."""
    return F.abs(F.col(approx) - F.col(exact)) <= F.greatest(F.lit(1.0), F.lit(3 * rsd) * F.col(exact))


def _agg(name: str, aggs: list[tuple[str, str, str]], duck_select: str | None, *, group=_GROUP, tbl="lineitem",
         digits: int = 6, prepare=None, post=None, duck_from: str | None = None, sql_full: str | None = None):
    keys = ", ".join(group)
    sql = sql_full
    if duck_select is not None:
        sql = f"SELECT {keys + ', ' if keys else ''}{duck_select} FROM {duck_from or tbl}" + (f" GROUP BY {keys}" if keys else "")

    @register(name, sql)
    def q(spark: SparkSession, sf: str) -> DataFrame:
        df = table(spark, sf, tbl)
        if prepare is not None:
            df = prepare(df)
        spec = QuerySpec.build(aggregations=[{"function": f, "column": c, "alias": a} for f, c, a in aggs], group_by=group)
        out = apply_spec(df, spec)
        if post is not None:
            return post(out)
        return round_doubles(out, digits)

    q.__name__ = f"q_{name}"
    return q


_agg(
    "agg_global",
    [("count", "*", "n"), ("sum", "l_quantity", "sum_qty"), ("max", "l_extendedprice", "max_price"), ("min", "l_discount", "min_disc")],
    "count(*) AS n, sum(l_quantity) AS sum_qty, round(max(l_extendedprice), 6) AS max_price, round(min(l_discount), 6) AS min_disc",
    group=[],
)
_agg(
    "agg_grouped",
    [("sum", "l_quantity", "sum_qty"), ("avg", "l_extendedprice", "avg_price"), ("count", "l_orderkey", "n")],
    "sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price, count(l_orderkey) AS n",
)
_agg(
    "agg_basic",
    [("count", "l_orderkey", "cnt"), ("sum", "l_quantity", "sum_qty"), ("avg", "l_extendedprice", "avg_price"),
     ("mean", "l_discount", "mean_disc"), ("min", "l_tax", "min_tax"), ("max", "l_quantity", "max_qty")],
    "count(l_orderkey) AS cnt, sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price, "
    "round(avg(l_discount), 6) AS mean_disc, round(min(l_tax), 6) AS min_tax, max(l_quantity) AS max_qty",
)
_agg(
    "agg_distinct",
    [("count_distinct", "l_partkey", "n_parts"), ("COUNTDISTINCT", "l_suppkey", "n_supps"), ("sum_distinct", "l_quantity", "sum_dist_qty")],
    "count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_supps, sum(DISTINCT l_quantity) AS sum_dist_qty",
)
_agg(
    "count_distinct",
    [("COUNT_DISTINCT", "l_orderkey", "n_orders")],
    "count(DISTINCT l_orderkey) AS n_orders",
)
_agg(
    "count_star",
    [("count", "*", "n_rows"), ("count", "l_tax", "n_tax")],
    "count(*) AS n_rows, count(l_tax) AS n_tax",
)
_agg(
    "agg_stats",
    [("stddev", "l_extendedprice", "sd"), ("std", "l_extendedprice", "sd2"), ("stddev_samp", "l_quantity", "sd_samp"),
     ("stddev_pop", "l_quantity", "sd_pop"), ("variance", "l_discount", "var"), ("var_samp", "l_tax", "var_samp"),
     ("var_pop", "l_tax", "var_pop"), ("skewness", "l_quantity", "skew"), ("kurtosis", "l_quantity", "kurt")],
    "round(stddev(l_extendedprice), 4) AS sd, round(stddev(l_extendedprice), 4) AS sd2, round(stddev_samp(l_quantity), 6) AS sd_samp, "
    "round(stddev_pop(l_quantity), 6) AS sd_pop, round(variance(l_discount), 9) AS var, round(var_samp(l_tax), 9) AS var_samp, "
    "round(var_pop(l_tax), 9) AS var_pop, "
    "round((avg(l_quantity*l_quantity*l_quantity) - 3*avg(l_quantity)*avg(l_quantity*l_quantity) + 2*pow(avg(l_quantity),3)) / pow(var_pop(l_quantity), 1.5), 6) AS skew, "
    "round(kurtosis_pop(l_quantity), 6) AS kurt",
    post=lambda d: d.select(
        *_GROUP, F.round("sd", 4).alias("sd"), F.round("sd2", 4).alias("sd2"), F.round("sd_samp", 6).alias("sd_samp"),
        F.round("sd_pop", 6).alias("sd_pop"), F.round("var", 9).alias("var"), F.round("var_samp", 9).alias("var_samp"),
        F.round("var_pop", 9).alias("var_pop"), F.round("skew", 6).alias("skew"), F.round("kurt", 6).alias("kurt"),
    ),
)
_agg(
    "agg_median_mode",
    [("median", "l_extendedprice", "med_price"), ("mode", "l_quantity", "mode_qty"), ("product", "l_quantity", "prod_qty")],
    None,
    group=["l_orderkey"],
    sql_full="""SELECT a.l_orderkey, a.med_price, m.mode_qty, a.prod_qty
FROM (SELECT l_orderkey, round(median(l_extendedprice), 6) AS med_price, product(l_quantity) AS prod_qty
      FROM lineitem GROUP BY l_orderkey) a
JOIN (SELECT l_orderkey, first(l_quantity ORDER BY n DESC, l_quantity ASC) AS mode_qty
      FROM (SELECT l_orderkey, l_quantity, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_quantity)
      GROUP BY l_orderkey) m USING (l_orderkey)""",
)
_agg(
    "agg_boolean_bit",
    [("bool_and", "is_big", "all_big"), ("bool_or", "is_big", "any_big"), ("every", "is_big", "every_big"),
     ("some", "is_big", "some_big"), ("count_if", "is_big", "n_big"), ("bit_and", "l_orderkey", "band"),
     ("bit_or", "l_linenumber", "bor"), ("bit_xor", "l_partkey", "bxor")],
    "bool_and(l_quantity > 25) AS all_big, bool_or(l_quantity > 25) AS any_big, bool_and(l_quantity > 25) AS every_big, "
    "bool_or(l_quantity > 25) AS some_big, count_if(l_quantity > 25) AS n_big, bit_and(l_orderkey) AS band, "
    "bit_or(l_linenumber) AS bor, bit_xor(l_partkey) AS bxor",
    group=["l_orderkey"],
    prepare=lambda d: d.withColumn("is_big", F.col("l_quantity") > 25),
)
_agg(
    "agg_approx",
    [("approx_count_distinct", "l_partkey", "approx_parts"), ("count_distinct", "l_partkey", "n_parts"), ("count", "*", "n")],
    "count(DISTINCT l_partkey) AS n_parts, true AS within_bound, count(*) AS n",
    post=lambda d: d.select(*_GROUP, "n_parts", _within_bound("approx_parts", "n_parts").alias("within_bound"), "n"),
)
_agg(
    "agg_collect",
    [("collect_list", "l_linenumber", "lines"), ("collect_set", "l_returnflag", "flags"), ("array_agg", "l_quantity", "qtys")],
    "list_sort(list(l_linenumber)) AS lines, list_sort(list(DISTINCT l_returnflag)) AS flags, list_sort(list(l_quantity)) AS qtys",
    group=["l_orderkey"],
    post=lambda d: d.select("l_orderkey", F.sort_array("lines").alias("lines"), F.sort_array("flags").alias("flags"),
                            F.sort_array("qtys").alias("qtys")),
)
_agg(
    "agg_collect_string",
    [("listagg", "l_returnflag", "flags_text"), ("string_agg", "l_linestatus", "status_text")],
    "string_agg(l_returnflag, '' ORDER BY l_returnflag) AS flags_text, string_agg(l_linestatus, '' ORDER BY l_linestatus) AS status_text",
    group=["l_orderkey"],
    # a group's rows come in any order; its values are single letters, shown in order
    post=lambda d: d.select("l_orderkey", *[F.array_join(F.sort_array(F.split(c, "")), "").alias(c) for c in ("flags_text", "status_text")]),
)
_agg(
    "agg_pick",
    [("any_value", "k7", "any_k"), ("first", "k11", "first_k"), ("last", "k13", "last_k"),
     ("first_value", "odd_key", "first_odd"), ("last_value", "odd_key", "last_odd")],
    "any_value(l_orderkey % 7) AS any_k, any_value(l_orderkey % 11) AS first_k, any_value(l_orderkey % 13) AS last_k, "
    "CASE WHEN l_orderkey % 2 = 1 THEN l_orderkey END AS first_odd, CASE WHEN l_orderkey % 2 = 1 THEN l_orderkey END AS last_odd",
    group=["l_orderkey"],
    # columns constant within a group (one of them null in every other group): whichever row is picked, the result is one
    prepare=lambda d: d.select("l_orderkey", *[(F.col("l_orderkey") % k).alias(f"k{k}") for k in (7, 11, 13)],
                               F.when(F.col("l_orderkey") % 2 == 1, F.col("l_orderkey")).alias("odd_key")),
)
_agg(
    "agg_try",
    [("try_sum", "l_quantity", "tsum"), ("try_avg", "l_extendedprice", "tavg")],
    "sum(l_quantity) AS tsum, round(avg(l_extendedprice), 6) AS tavg",
)


@register("group_keys_only", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_group_keys_only(spark: SparkSession, sf: str) -> DataFrame:
    return dynamic_query(table(spark, sf, "lineitem"), ["l_returnflag"], group_by=["l_returnflag", "l_linestatus"], limit=0)


# ---------------------------------------------------------------- sort / limit

@register(
    "order_by",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment ASC, c_acctbal DESC NULLS LAST",
)
def q_order_by(spark: SparkSession, sf: str) -> DataFrame:
    spec = QuerySpec.build(
        select=["c_custkey", "c_mktsegment", "c_acctbal"],
        order_by=[{"column": "c_mktsegment", "direction": "asc"}, {"column": "c_acctbal", "direction": "DESC"}],
    )
    return round_doubles(apply_spec(table(spark, sf, "customer"), spec))


@register(
    "limit",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000",
)
def q_limit(spark: SparkSession, sf: str) -> DataFrame:
    # a limit over a total order
    return dynamic_query(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_quantity"],
        order_by=["l_orderkey", "l_linenumber"],
        limit=1000,
    )


@register(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10",
)
def q_top_k(spark: SparkSession, sf: str) -> DataFrame:
    spec = QuerySpec.build(
        select=["o_orderkey", "o_totalprice"],
        order_by=[{"column": "o_totalprice", "direction": "DESC"}, {"column": "o_orderkey"}],
        limit=10,
    )
    return round_doubles(apply_spec(table(spark, sf, "orders"), spec))


@register("sample_rows", "SELECT r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 5")
def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.sample_rows(table(spark, sf, "region"), 5, order_by=["r_regionkey"])


# ---------------------------------------------------------------- composite

@register(
    "execution_stats",
    """SELECT 'input_rows' AS metric, count(*) AS value FROM lineitem
UNION ALL SELECT 'output_rows', count(*) FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'""",
)
def q_execution_stats(spark: SparkSession, sf: str) -> DataFrame:
    src = table(spark, sf, "lineitem")
    out = apply_spec(src, QuerySpec.build(where=["l_quantity > 25", "l_returnflag = 'R'"]))
    return row_count_frame(src, out)


@register(
    "preview_sql",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem WHERE l_discount > 0.03 GROUP BY l_returnflag""",
)
def q_preview_sql(spark: SparkSession, sf: str) -> DataFrame:
    spec = QuerySpec.build(
        where=["l_discount > 0.03"],
        aggregations=[{"function": "count", "column": "*", "alias": "n"}, {"function": "sum", "column": "l_extendedprice", "alias": "revenue"}],
        group_by=["l_returnflag"],
        order_by=[{"column": "revenue", "direction": "DESC"}],
    )
    out = run_preview_sql(table(spark, sf, "lineitem"), preview_sql(spec))
    return out.withColumn("revenue", F.round("revenue", 2))


@register(
    "query_template",
    """SELECT c_mktsegment AS key, count(*) AS n, round(sum(c_acctbal), 2) AS total
FROM customer WHERE c_acctbal > 1000.0 GROUP BY c_mktsegment""",
)
def q_query_template(spark: SparkSession, sf: str) -> DataFrame:
    return run_template(table(spark, sf, "customer"), "group_sum_above", {"key": "c_mktsegment", "value": "c_acctbal", "threshold": 1000.0})


@register(
    "agg_sketches",
    """SELECT l_returnflag, TRUE AS hll_near, TRUE AS theta_near, TRUE AS median_near, count(DISTINCT l_partkey) AS parts
FROM lineitem GROUP BY l_returnflag""",
)
def q_agg_sketches(spark: SparkSession, sf: str) -> DataFrame:
    # states of small groups are stored, merged over one key and read; estimates are held against exact values
    li, keys, few = table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_returnflag"]
    exact = li.groupBy(*few).agg(F.count_distinct("l_partkey").alias("n"))
    for kind, column in (("HLL", "l_partkey"), ("THETA", "l_partkey"), ("QUANTILES", "l_extendedprice"), ("BITMAP", "l_partkey")):
        path = staging_path(spark, kind.lower())
        sketches.sketch(li, kind, column, keys).write.parquet(path)
        merged = sketches.union(spark.read.parquet(path), kind, few)
        exact = exact.join(sketches.estimate(merged, kind, few, name=kind), "l_returnflag")
    below = li.join(exact, "l_returnflag").groupBy(*few).agg(F.avg((F.col("l_extendedprice") <= F.col("QUANTILES")).cast("double")).alias("share"))
    near = lambda c: F.abs(F.col(c) - F.col("n")) <= 0.1 * F.col("n")
    return exact.join(below, "l_returnflag").select(
        "l_returnflag", near("HLL").alias("hll_near"), near("THETA").alias("theta_near"), (F.abs(F.col("share") - 0.5) < 0.04).alias("median_near"),
        F.col("BITMAP").alias("parts"),
    )


# ---------------------------------------------------------------- sources / sinks

@register("load_parquet", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def q_load_parquet(spark: SparkSession, sf: str) -> DataFrame:
    ds = files.load_dataset(spark, f"{sf.rstrip('/')}/supplier.parquet", "parquet", {"mergeSchema": "false"})
    return ds.df.select("s_suppkey", "s_name", "s_nationkey")


@register(
    "refreshed_profile",
    "SELECT 's_suppkey' AS column_name, 2 AS files, count(*) AS n_rows, count(*) - count(s_suppkey) AS nulls, CAST(CAST(min(s_suppkey) AS DOUBLE) AS VARCHAR) AS least, "
    "CAST(CAST(max(s_suppkey) AS DOUBLE) AS VARCHAR) AS greatest, TRUE AS near FROM supplier WHERE s_suppkey % 3 > 0 "
    "UNION ALL SELECT 's_name', 2, count(*), count(*) - count(s_name), min(s_name), max(s_name), TRUE FROM supplier WHERE s_suppkey % 3 > 0",
)
def q_refreshed_profile(spark: SparkSession, sf: str) -> DataFrame:
    # a dataset of two files is inspected; one is replaced and one added; the refreshed profile is that of what is there
    src, base = table(spark, sf, "supplier").select("s_suppkey", "s_name"), staging_path(spark, "inspected")
    part = lambda n: src.where(F.col("s_suppkey") % 3 == n).coalesce(1)
    files.save_dataset(part(0), f"{base}/data/a")
    files.save_dataset(part(1), f"{base}/data/b")
    refresh.refresh(spark, f"{base}/data", f"{base}/state")
    files.save_dataset(part(2), f"{base}/data/a")  # overwritten
    state = refresh.refresh(spark, f"{base}/data", f"{base}/state")
    p = refresh.merged_profile(state)
    n = F.col("rows") - F.col("nulls")
    return p.select(
        F.col("column").alias("column_name"), "files", F.col("rows").alias("n_rows"), "nulls", "least", "greatest", (F.abs(F.col("approx_distinct") - n) <= 0.1 * n).alias("near")
    )


@register(
    "load_merged",
    """SELECT s_suppkey, s_name, CAST(CAST(s_acctbal AS FLOAT) AS DOUBLE) AS s_acctbal, CAST(NULL AS INTEGER) AS s_nationkey FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL BY NAME SELECT s_nationkey, s_suppkey, s_acctbal, s_name FROM supplier WHERE s_suppkey % 2 = 1""",
)
def q_load_merged(spark: SparkSession, sf: str) -> DataFrame:
    # an old version of supplier (narrow types, no nation) and a new one, read as one dataset
    src, base = table(spark, sf, "supplier"), staging_path(spark, "versions")
    old = src.where("s_suppkey % 2 = 0").selectExpr("cast(s_suppkey AS int) AS s_suppkey", "s_name", "cast(s_acctbal AS float) AS s_acctbal")
    files.save_dataset(old, f"{base}/v1")
    files.save_dataset(src.where("s_suppkey % 2 = 1").select("s_nationkey", "s_suppkey", "s_acctbal", "s_name"), f"{base}/v2")
    return files.load_merged(spark, [f"{base}/v1", f"{base}/v2"])


@register("read_table", "SELECT n_nationkey, n_name FROM nation")
def q_read_table(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_table(spark, _parquet_ref(sf, "nation")).select("n_nationkey", "n_name")


@register("load_csv", "SELECT p_partkey, p_name, p_size, round(p_retailprice, 6) AS p_retailprice FROM part")
def q_load_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "csv")
    src = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    files.save_dataset(src, path, "csv", "overwrite", {"header": "true"})
    back = files.load_csv(spark, path, schema="p_partkey bigint, p_name string, p_size int, p_retailprice double")
    return round_doubles(back)


@register("save_dataset", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def q_save_dataset(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "save")
    ds = Dataset(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "orders", {"note": "status F"})
    files.save_dataset(files.filter_dataset(ds, "o_orderstatus = 'F'"), path, "parquet", "overwrite")
    back = files.load_dataset(spark, path)
    assert back.metadata.get("note") == "status F", "metadata sidecar lost"
    return back.df


@register(
    "save_modes",
    """SELECT r_regionkey, count(*) AS copies FROM (
  SELECT r_regionkey FROM region UNION ALL SELECT r_regionkey FROM region
) GROUP BY r_regionkey""",
)
def q_save_modes(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "modes")
    src = table(spark, sf, "region")
    files.save_dataset(src, path, mode="error")  # fresh path: succeeds
    files.save_dataset(src, path, mode="ignore")  # exists: no-op
    files.save_dataset(src, path, mode="overwrite")
    files.save_dataset(src, path, mode="append")  # now two copies
    back = spark.read.parquet(path)
    return back.groupBy("r_regionkey").agg(F.count(F.lit(1)).alias("copies"))


@register(
    "parse_metadata",
    "SELECT event_id, cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_parse_metadata(spark: SparkSession, sf: str) -> DataFrame:
    df = files.parse_json_column(table(spark, sf, "events"), "props", "k int", into="meta")
    return df.select("event_id", F.col("meta.k").alias("k"))


# ---------------------------------------------------------------- inspection

def _profile_sql(tbl: str, columns: dict[str, str], last: str) -> str:
    """One row per column of ``tbl`` (name -> type): counts, extremes and ``last``, where {c} stands for the column."""
    return "\nUNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS total_count, count(DISTINCT {c}) AS distinct_count, "
        f"cast(min({c}) AS VARCHAR) AS min_value, cast(max({c}) AS VARCHAR) AS max_value, {last.format(c=c)} FROM {tbl}"
        for i, (c, t) in enumerate(columns.items())
    )


@register(
    "profile_columns",
    _profile_sql(
        "supplier", {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
        "list_sort(list(DISTINCT cast({c} AS VARCHAR)))[1:5] AS sample_values",
    ),
)
def q_profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.profile_columns(table(spark, sf, "supplier"))


@register(
    "profile_approx",
    _profile_sql(
        "orders",
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
         "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
        "true AS within_bound",
    ),
)
def q_profile_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate profile, its distinct counts held against the exact ones."""
    orders = table(spark, sf, "orders")
    approx = inspect.profile_columns(orders, approximate=True).withColumnRenamed("distinct_count", "approx_distinct")
    exact = inspect.profile_columns(orders).select("ordinal", "distinct_count")
    return approx.join(exact, "ordinal").select(
        "ordinal", "column_name", "data_type", "total_count", "distinct_count", "min_value", "max_value",
        _within_bound("approx_distinct", "distinct_count").alias("within_bound"),
    )


def _drifted_supplier(df: DataFrame) -> DataFrame:
    return (
        df.drop("s_acctbal")
        .withColumn("s_comment", F.concat(F.lit("supplier "), F.col("s_name")))
        .withColumn("s_nationkey", F.col("s_nationkey").cast("bigint"))
        .withColumn("s_suppkey", F.when(F.col("s_suppkey") > 0, F.col("s_suppkey")))
    )


_DUCK_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' ELSE lower(column_type) END"""


@register(
    "schema_drift",
    f"""WITH o AS (SELECT column_name, {_DUCK_TYPE} AS old_type, "null" = 'YES' AS old_nullable
           FROM (DESCRIBE SELECT * FROM supplier)),
n AS (SELECT column_name, {_DUCK_TYPE} AS new_type, "null" = 'YES' AS new_nullable
      FROM (DESCRIBE SELECT s_suppkey, s_name, cast(s_nationkey AS BIGINT) AS s_nationkey,
                            'supplier ' || s_name AS s_comment FROM supplier)),
j AS (SELECT coalesce(o.column_name, n.column_name) AS column_name, old_type, new_type, old_nullable, new_nullable,
             CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed'
                  WHEN old_type <> new_type THEN 'type_changed'
                  WHEN old_nullable <> new_nullable THEN 'nullability_changed' END AS change
      FROM o FULL OUTER JOIN n ON o.column_name = n.column_name)
SELECT column_name, change, old_type, new_type, old_nullable, new_nullable FROM j WHERE change IS NOT NULL""",
)
def q_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier")
    return inspect.schema_drift(inspect.schema_frame(sup), inspect.schema_frame(_drifted_supplier(sup)))


@register(
    "schema_hash",
    f"""SELECT sha256('{{' || string_agg(entry, ', ' ORDER BY entry) || '}}') AS schema_hash FROM (
  SELECT to_json(column_name) || ': {{"metadata": {{}}, "nullable": ' || CASE WHEN "null" = 'YES' THEN 'true' ELSE 'false' END
         || ', "type": ' || to_json({_DUCK_TYPE}) || '}}' AS entry
  FROM (DESCRIBE SELECT * FROM customer))""",
)
def q_schema_hash(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    out = inspect.schema_hash_frame(inspect.schema_frame(cust))
    return out
