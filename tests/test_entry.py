import duckdb
import pytest

import __spark_entry__ as E
from sparkloom.plans.registry import TABLES

from conftest import SF_SMALL


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["l_returnflag", "l_linestatus", "sum_qty", "sum_base_price", "avg_disc", "count_order"]


def test_registry_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80
    assert all(callable(f) for f in qs.values())


def test_core_queries_without_the_training_data_operators(monkeypatch):
    import sys

    every = set(E.queries())
    monkeypatch.setitem(sys.modules, "sparkloom.llm.queries", None)  # importing it raises ImportError
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    core = E.queries()
    assert {n for n in every if not n.startswith("op") and n != "pipeline"} == {n for n in core if n != "pipeline"} and set(E.oracle_sql()) <= set(core)


def test_not_in_is_a_null_aware_anti_join(spark):
    df = E.queries()["pred_not_in_subquery"](spark, SF_SMALL)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["run_query_spec", "pred_exists", "agg_median_mode", "schema_drift", "combine_weighted",
                                  "text_entities", "text_sentiment", "image_texture", "generate_sample"])
def test_oracle_on_small_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(str(list(r[i]) if isinstance(r[i], list) else r[i]).replace("'", "") if isinstance(r[i], list) else str(r[i]) for i in idx) for r in cur.fetchall())
    got = [tuple(v.replace("'", "") for v in row) for row in got]
    assert got == want
