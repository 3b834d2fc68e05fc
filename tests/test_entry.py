import __spark_entry__ as E
from govframe.plans.oracle import ORACLE
from govframe.plans.recipes import RECIPES
from tools.check_oracle import digest
from tests.conftest import SF_SMALL


def test_contract_keys_match():
    assert set(RECIPES) == set(ORACLE)
    assert set(RECIPES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(RECIPES) >= 72


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["usuario", "subject", "full_name", "started_at", "minutes_open", "expires_at"]


def test_every_query_matches_oracle_small(spark):
    import duckdb

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = []
    for name, fn in RECIPES.items():
        df = fn(spark, SF_SMALL)
        s = [tuple(r) for r in df.collect()]
        cur = con.execute(ORACLE[name])
        o = cur.fetchall()
        ocols = [d[0] for d in cur.description]
        if sorted(df.columns) != sorted(ocols) or digest(s, df.columns)[0] != digest(o, ocols)[0]:
            bad.append(name)
    assert bad == []
