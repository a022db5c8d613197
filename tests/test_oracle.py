"""Every registered query against its SQL twin in DuckDB, over the whole small tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SMALL, plan

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as driver  # noqa: E402
from pulsetide.plans.oracles import ORACLES  # noqa: E402
from pulsetide.plans.queries import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def sorted_rows(table, columns):
    values = zip(*[table.column(name).to_pylist() for name in columns])
    return sorted(repr(row) for row in values)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_and_types(spark, sql, name):
    frame = driver.queries()[name](spark, SMALL)
    # Footers of files are read by Python tasks; all else is Spark's own.
    if name != "layer_codecs" and not name.startswith(("gold_batch", "gold_hourly_stream")):
        text = plan(frame)
        assert "Python" not in text and "CartesianProduct" not in text
    got = frame.toArrow()
    relation = sql.execute(driver.oracle_sql()[name])
    expected = relation.to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(got.column_names) == columns
    for column in columns:
        ours, theirs = got.schema.field(column).type, expected.schema.field(column).type
        assert ours == theirs, column
    assert sorted_rows(got, columns) == sorted_rows(expected, columns)


def test_flagship_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns[0] == "user_id" and frame.count() == 875


@pytest.mark.parametrize("absent", ["tokenizers", "public_tokenizers", "zstandard", "numpy", "pulsetide.llm", "corpus_pipeline"])
def test_queries_load_without_optional_packages(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as d; print(*sorted(d.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == sorted(QUERIES)


def test_other_missing_modules_are_errors():
    code = "import sys; sys.modules['pulsetide.session'] = None; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode != 0 and "pulsetide.session" in done.stderr
