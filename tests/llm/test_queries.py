"""The registered queries against their SQL, and what they promise about the repository."""

import ast
import pathlib

import pytest

import __spark_entry__ as E
from govframe.llm.oracle import ORACLE
from govframe.llm.queries import QUERIES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[2]


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    rows, columns = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(rows, columns)


def test_nothing_outside_imports_the_subpackage():
    for path in ROOT.glob("govframe/**/*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n or n == "corpus_pipeline" for n in names), path
