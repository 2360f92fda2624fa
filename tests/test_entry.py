import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.audit_plans import audit
from tools.compare_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    rows = entry_mod.entry(spark).collect()
    # sf 0.001: 200 files, 24 removed as near duplicates
    assert len(rows) == 176


def test_oracle_keys_subset_of_queries():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k not in entry_mod.LLM_QUERIES}
    assert own == set(o) - set(entry_mod.LLM_ORACLE_SQL)


@pytest.mark.parametrize("name", ["near_dup_pairs", "line_completion_tasks", "split_by_repo", "padded_windows"])
def test_headline_plans(spark, name):
    bad, schemas = audit(entry_mod.queries()[name](spark, SF))
    assert not bad
    assert all("html" not in s and "embedding" not in s for s in schemas)


@pytest.mark.parametrize("name", ["near_dup_pairs", "clone_clusters", "leader_pairs", "sample_lines",
                                  "train_windows", "running_totals"])
def test_oracle_parity_small(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry_mod.oracle_sql()[name])
    drows = res.fetchall()
    dcols = [d[0].lower() for d in res.description]
    scols = [c.lower() for c in df.columns]
    assert sorted(scols) == sorted(dcols)
    assert digest(srows, scols) == digest(drows, dcols)
