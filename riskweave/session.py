"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: list[str] = []


def build_session(name: str = "riskweave", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one you are given."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under the cluster's shared checkpoint folder.

    Only a local master may fall back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _OWN_FOLDER:
            _OWN_FOLDER.append(tempfile.mkdtemp(prefix="riskweave-"))
        base = _OWN_FOLDER[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if it has none: iterative fits cut their lineage there."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_folder(spark, "checkpoints"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the working folder and read it back.

    Cuts the lineage and saves recomputing it, and unlike cached blocks the result
    outlives the executors that made it.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of text that a Python task gets at once.
BATCH_ROWS = 1000


def bounded(df: DataFrame) -> DataFrame:
    """Have the session send texts to Python in smaller batches than its default of 10,000 rows, so that the tasks of an
    executor hold megabytes of them, not hundreds."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df
