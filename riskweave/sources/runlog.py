"""Parameters and metrics of runs: a log of entries that are created once, and snapshots that join them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.commits import commit, read_entry, update, versions

RUN_SCHEMA = "experiment string, run string, kind string, key string, value string"


def append_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    run: str,
    params: dict | None = None,
    metrics: dict | None = None,
    prefix: str = "",
) -> int:
    """Add one row per parameter and per metric, all or none; ``prefix`` goes before metric names.

    Returns the entry's version. Of runs logged at once each gets a version of its own.
    """
    rows = [{"kind": "param", "key": key, "value": str(value)} for key, value in (params or {}).items()]
    rows += [
        {"kind": "metric", "key": f"{prefix}{key}", "value": None if value is None else repr(float(value))}
        for key, value in (metrics or {}).items()
    ]
    return commit(spark, f"{path}/log", {"experiment": experiment, "run": run, "rows": rows})


def _entries(spark: SparkSession, path: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """The rows of the entries with versions behind ``after`` and up to ``upto``."""
    places = [place for version, place in sorted(versions(spark, f"{path}/log").items()) if version > after and (upto is None or version <= upto)]
    if not places:
        return spark.createDataFrame([], RUN_SCHEMA)
    entries = spark.read.schema("experiment string, run string, rows array<struct<kind:string,key:string,value:string>>").json(places)
    return entries.select("experiment", "run", F.inline("rows"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All rows logged: those of the latest snapshot and of the entries behind it."""
    snapshot = read_entry(spark, f"{path}/snapshots")
    if snapshot is None:
        return _entries(spark, path)
    joined = spark.read.schema(RUN_SCHEMA).parquet(snapshot[1]["uri"])
    return joined.unionByName(_entries(spark, path, snapshot[1]["upto"]))


def compact_runs(spark: SparkSession, path: str) -> int:
    """Join all entries so far into one table, so that reading doesn't open a file per run; returns the last version in it.

    Entries that are added meanwhile stay behind the snapshot, and of two compactions the one that has seen more counts.
    """
    upto = max(versions(spark, f"{path}/log"), default=0)
    uri = f"{path}/joined/{uuid.uuid4().hex[:12]}"
    _entries(spark, path, upto=upto).coalesce(1).write.parquet(uri)
    return update(spark, f"{path}/snapshots", lambda version, entry: entry if entry and entry["upto"] >= upto else {"uri": uri, "upto": upto})[1]["upto"]

