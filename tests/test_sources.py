from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from riskweave.sources.accounting import observed, rows_processed
from riskweave.sources.corpus import read_chunk_store, read_corpus, read_golden
from riskweave.sources.runlog import append_run, read_runs
from riskweave.sources.tables import read_optional, read_table, spread, write_report, write_table


def test_csv_needs_a_schema_and_turns_nan_into_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,name\n1,NaN,a\n2,3.5,\n")
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "csv")
    rows = read_table(spark, str(tmp_path), "csv", "id long, amount double, name string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, "a"), (2, 3.5, None)]


def test_absent_table_is_none_but_other_errors_stay(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "nowhere")) is None
    assert read_optional(spark, str(tmp_path / "nowhere"), fmt="csv", schema="a int") is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_optional(spark, str(tmp_path / "empty"))


def test_sink_overwrites_and_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    write_table(spark.range(10), path)
    write_table(spark.range(3).selectExpr("id", "id % 2 AS part"), path, ["part"])
    assert read_table(spark, path).count() == 3
    assert (tmp_path / "out" / "part=1").exists()


def test_report_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.5), ("b", None)], "feature string, iv double")
    back = read_table(spark, write_report(df, str(tmp_path / "csv")), "csv", "feature string, iv double")
    assert sorted(map(tuple, back.collect())) == [("a", 0.5), ("b", None)]
    write_report(df, str(tmp_path / "json"), "json")
    assert spark.read.json(str(tmp_path / "json")).columns == ["feature", "iv"]
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path / "x"), "xlsx")


def test_row_counts_and_observation(spark):
    counts = rows_processed({"a": spark.range(3), "b": spark.range(4)})
    assert dict(map(tuple, counts.collect())) == {"a": 3, "b": 4, "total": 7}
    df, seen = observed(spark.range(11), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == 11


def test_corpus_reads_whole_markdown_then_text_files(spark, tmp_path):
    (tmp_path / "b+c d.md").write_text("# One\n\nTwo")
    (tmp_path / "a.txt").write_text("three\n")
    (tmp_path / "skip.pdf").write_text("no")
    rows = read_corpus(spark, str(tmp_path)).orderBy("corpus_order").collect()
    assert [(r["source"], r["text"]) for r in rows] == [("b+c d.md", "# One\n\nTwo"), ("a.txt", "three\n")]


def test_golden_set_is_a_json_array_and_must_exist(spark, tmp_path):
    path = tmp_path / "golden.json"
    path.write_text(json.dumps([{"question": "q", "ground_truth": "g", "source": "s"}] * 2, indent=1))
    assert read_golden(spark, str(path)).count() == 2
    with pytest.raises(AnalysisException):
        read_golden(spark, str(tmp_path / "missing.json"))


def test_chunk_store_round_trip(spark, tmp_path):
    chunks = spark.createDataFrame([("d::0", "line\n\"two\"", "d")], "id string, text string, source string")
    write_report(chunks, str(tmp_path / "store"), "json")
    assert read_chunk_store(spark, str(tmp_path / "store")).collect() == chunks.collect()


def test_run_log_appends_with_prefix(spark, tmp_path):
    path = str(tmp_path / "runs")
    append_run(spark, path, "credit", "card", {"iv_floor": 0.02}, {"auc": 0.8})
    append_run(spark, path, "credit", "gbm", metrics={"auc": 0.9, "gap": None}, prefix="test_")
    rows = {(r["run"], r["kind"], r["key"]): r["value"] for r in read_runs(spark, path).collect()}
    assert rows == {("card", "param", "iv_floor"): "0.02", ("card", "metric", "auc"): "0.8",
                    ("gbm", "metric", "test_auc"): "0.9", ("gbm", "metric", "test_gap"): None}


def test_spread_leaves_wide_tables_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide, "id") is wide
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8
