"""The driver contract: entry, queries, oracle_sql."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "customer" and len(df.columns) == 83
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = {q for q in set(E.queries()) - set(E.oracle_sql()) if not q.startswith("op") and q != "pipeline"}
    assert rows_only == {"elbow", "clusters", "cluster_roundtrip"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["customer_features", "norm_keys", "floor_days", "parse_dates", "csv_scan",
                                  "daily_snapshot", "daily_pull", "union_chunks", "drop_missing", "key_forms",
                                  "rowwise_max_date", "cluster_nearest"])
def test_query_matches_oracle(spark, duck, name):
    import scripts.check_oracles as C

    sdf = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    orows = [tuple(r[ocols.index(c)] for c in sdf.columns) for r in res.fetchall()]
    msg, ok = C.compare([tuple(r) for r in sdf.collect()], orows)
    assert ok, msg
