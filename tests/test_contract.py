from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from riskweave.session import materialize, work_folder


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[0] == "SK_ID_CURR"


def test_every_statement_belongs_to_a_query():
    queries, statements = contract.queries(), contract.oracle_sql()
    assert set(statements) <= set(queries)
    assert len(queries) > 90


@pytest.mark.parametrize("name", ["c1_applicant_features", "j8_metric_bundle", "r11_corrective_answers", "h5_iv_ranking"])
def test_some_queries_equal_their_statement(spark, tables, name):
    connection = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "documents", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    df = contract.queries()[name](spark, tables)
    columns = sorted(df.columns)
    relation = connection.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = connection.sql(f"SELECT {quoted} FROM relation").fetchall()
    mine = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(str, mine)) == sorted(map(str, theirs))


class _Session:
    """Just the settings a working folder depends on."""

    def __init__(self, master: str, folder: str | None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_working_folder_follows_the_session():
    assert work_folder(_Session("spark://host:7077", "hdfs://shared/tmp/"), "x").startswith("hdfs://shared/tmp/x-")
    with pytest.raises(RuntimeError):
        work_folder(_Session("spark://host:7077", None), "x")
    assert work_folder(_Session("local[2]", None), "x") != work_folder(_Session("local[2]", None), "x")


def test_materialize_reads_back_what_it_wrote(spark):
    stored = materialize(spark.range(5), "numbers")
    assert stored.count() == 5 and "numbers-" in stored.inputFiles()[0]
