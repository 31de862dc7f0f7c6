"""Every registered query with SQL against DuckDB on the smallest tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from sylvaframe.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(rows, columns):
    rounded = lambda v: round(v, 9) if isinstance(v, float) else v
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(rounded(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted({**ORACLES, **{k: v for k, v in entry.oracle_sql().items() if k.startswith("op")}}))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_entry_without_the_training_data_operators(tmp_path):
    """With those files gone the rest imports and lists its queries; any other missing module is an error."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/sylvaframe", tmp_path / "sylvaframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    run = lambda: subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, timeout=120)
    assert run().stdout.strip() == f"{len(QUERIES)} []"
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    assert "no_such_module_at_all" in run().stderr
