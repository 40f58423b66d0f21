"""How the given tables stand in for applicants, histories, transactions and questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.risk import key_uniform, sigmoid
from riskweave.functions.text import tokens
from riskweave.operators.features import applicant_features
from riskweave.session import materialize
from riskweave.sources.tables import spread

DIGITS = 6


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    """Sums depend on the order of addition in their last bits: compare rounded values."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def days(date: Column, since: str) -> Column:
    return F.datediff(date, F.to_date(F.lit(since)))


# --------------------------------------------------------------------------- credit tables
def applicants(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_totalprice").alias("AMT_CREDIT"),
        F.avg("o_totalprice").alias("AMT_ANNUITY"),
        days(F.min("o_orderdate"), "2001-08-02").alias("DAYS_BIRTH"),
        days(F.min("o_orderdate"), "2001-01-01").alias("DAYS_EMPLOYED"),
    )
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("AMT_INCOME_TOTAL"),
        F.col("c_mktsegment").alias("NAME_INCOME_TYPE"),
    )
    return customer.join(orders, F.col("SK_ID_CURR") == F.col("o_custkey"), "left").drop("o_custkey")


def history(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Closed").alias("CREDIT_ACTIVE"),
        F.col("l_extendedprice").alias("AMT_CREDIT_SUM_DEBT"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") * F.col("l_tax")).otherwise(0.0)
        .alias("AMT_CREDIT_SUM_OVERDUE"),
        F.col("l_quantity").alias("CREDIT_DAY_OVERDUE"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("SK_ID_CURR"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def prior(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.when(status == "F", "Refused").when(status == "O", "Approved").alias("NAME_CONTRACT_STATUS"),
        F.col("o_totalprice").alias("AMT_CREDIT"),
        days(F.col("o_orderdate"), "2001-01-01").alias("DAYS_DECISION"),
    )


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return applicant_features(applicants(spark, sf), history(spark, sf), prior(spark, sf))


def credit_table(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table with a default flag that follows its features, for the models.

    Stored, because fitting reads it many times.
    """
    strain = (
        3.0 * F.col("PREV_REFUSED_RATE") + 0.1 * F.col("PREV_CNT") + 0.04 * F.col("BUREAU_MAX_DAYS_OVERDUE")
        + 0.15 * F.col("BUREAU_ACTIVE_CNT") - 9.5
    )
    flagged = feature_table(spark, sf).withColumn(
        "TARGET", (key_uniform("default", "SK_ID_CURR") < sigmoid(strain)).cast("int")
    )
    return materialize(flagged, "credit-table")


# --------------------------------------------------------------------------- transactions
TRANSACTION_FEATURES = ["amount", "old_balance", "hour", "is_error", "is_purchase"]


def prepare_transactions(events: DataFrame) -> DataFrame:
    """Columns the fraud models read; also applied to arriving events."""
    return events.select(
        F.col("event_id").alias("tx_id"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("double").alias("old_balance"),
        F.hour("ts").alias("hour"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
        (F.col("event_type") == "purchase").cast("int").alias("is_purchase"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a rare fraud flag that follows their columns, for the models."""
    odds = 0.03 * F.col("amount") + 1.5 * F.col("is_error") + 0.01 * F.col("old_balance") - 7.0
    return prepare_transactions(table(spark, sf, "events")).withColumn(
        "is_fraud", (key_uniform("fraud", "tx_id") < sigmoid(odds)).cast("int")
    )


# --------------------------------------------------------------------------- scored rows
def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a score that has ties on purpose."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    score = F.round(sigmoid(F.col("n_chars") / 2000.0 - 1), 3)
    return docs.join(table(spark, sf, "labels"), "doc_id").withColumn("score", score)


def returned_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))


# --------------------------------------------------------------------------- documents
def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source"), "text")


def turn_key(conversation: Column, turn: Column) -> Column:
    """One number for a turn of a conversation."""
    return conversation * 1_000_000 + turn


def user_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every user turn: ``query_id, question``."""
    return table(spark, sf, "conversations").where("role = 'user'").select(
        turn_key(F.col("conv_id"), F.col("turn")).alias("query_id"), F.col("text").alias("question"))


def passages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


SHINGLE = 6


def gold_sources(spark: SparkSession, sf: str) -> DataFrame:
    """``query_id, source``: documents that contain a whole passage.

    The second to seventh token of a passage are whole tokens wherever it occurs,
    so documents and passages meet in an equi-join on such runs of tokens, and only
    those pairs are compared as text. Passages of fewer than eight tokens meet on their
    second token; those of fewer than three hold no token that is surely whole, so blocks of them travel to the texts.
    """
    asked = passages(spark, sf)
    anchors = asked.withColumn("_t", tokens("question")).select(
        "query_id", "question", F.array_join(F.slice("_t", 2, SHINGLE), " ").alias("anchor"),
        F.get("_t", F.lit(1)).alias("second"), F.size("_t").alias("n"),
    )
    words = spread(corpus(spark, sf), "doc_id").withColumn("_t", tokens("text"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_t") - SHINGLE, F.lit(0)))
    runs = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get("_t", i + j) for j in range(SHINGLE)]))
    # the anchor joins doc ids only; texts come back for the matching documents
    whole, brief = anchors.where(F.col("n") > SHINGLE + 1), anchors.where(F.col("n").between(3, SHINGLE + 1))
    found = words.select("doc_id", F.explode(runs).alias("anchor")).join(whole.select("query_id", "question", "anchor"), "anchor")
    found = found.drop("anchor").distinct()
    if not brief.isEmpty():
        by_token = words.select("doc_id", F.explode(F.array_distinct("_t")).alias("second")).join(
            brief.select("query_id", "question", "second"), "second")
        found = found.unionByName(by_token.drop("second"))
    pairs = found.join(corpus(spark, sf), "doc_id").where(F.contains("text", "question")).select("query_id", "source")
    return reduce(DataFrame.unionByName, [pairs, *_tiny_passages(anchors.where("n < 3 and question is not null"), corpus(spark, sf))])


#: Passages of fewer than three tokens that one pass over the texts looks for.
TINY_BLOCK = 500


def _tiny_passages(tiny: DataFrame, texts: DataFrame) -> list[DataFrame]:
    """``query_id, source`` of passages found as they stand, a pass over the texts for each block of them."""
    count = tiny.count()
    found = []
    for block in range(-(-count // TINY_BLOCK)):
        own = tiny if count <= TINY_BLOCK else tiny.where(F.pmod(F.xxhash64("query_id"), F.lit(-(-count // TINY_BLOCK))) == block)
        asked = [F.struct(F.lit(r["query_id"]).alias("query_id"), F.lit(r["question"]).alias("question")) for r in own.collect()]
        if asked:
            inside = F.filter(F.array(*asked), lambda p: F.contains("text", p["question"]))
            found.append(texts.select("source", F.explode(inside).alias("p")).select("p.query_id", "source"))
    return found
