import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUICK = ["eval_train_validate_test", "feat_page_pipeline", "split_80_10_10", "topk_per_key",
         "fmt_description", "src_pages_train_tsv", "fit_logistic_sgd", "tune_grid_nb",
         "join_category_index", "agg_rating_stats"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "n", "auc_hard"]
    assert {r.split for r in rows} <= {"validation", "test"}


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def _norm(r):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in r)


@pytest.mark.parametrize("key", QUICK)
def test_query_matches_oracle_small(spark, key):
    con = duckdb.connect()
    for t in ["part", "orders", "lineitem", "events", "documents", "embeddings", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[key](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(sdf.columns)
    drows = [dict(zip(cols, r)) for r in res.fetchall()]
    srows = sorted(_norm(tuple(r[c] for c in sdf.columns)) for r in sdf.collect())
    drows = sorted(_norm(tuple(r[c] for c in sdf.columns)) for r in drows)
    assert srows == drows
