"""Sources, profiles, windows and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalogue import sql
from riskweave.catalogue.inputs import (
    applicants, feature_table, prior, returned_lines, rounded, scored_documents, table,
)
from riskweave.functions.time import clock_micros, clock_seconds
from riskweave.operators import features as ft
from riskweave.operators import profile as pf
from riskweave.operators import sketches as sk
from riskweave.operators.ordered import exact_quantiles
from riskweave.operators.split import stable_split
from riskweave.session import materialize, work_folder
from riskweave.sources.accounting import rows_processed
from riskweave.sources.runlog import append_run, read_runs
from riskweave.streaming import history as hs
from riskweave.sources.tables import read_optional, read_table, write_report, write_table

PROFILED = ("orders", "o_orderpriority", "o_orderstatus", "o_custkey")
REQUIRED = {"SK_ID_CURR": "bigint", "TARGET": "int", "AMT_INCOME_TOTAL": "double", "DTI": "double", "BUREAU_CNT": "bigint",
            "PREV_LAST_AMT_CREDIT": "double"}
SOME_DAYS = 3 * 86_400


def a1_scan_csv(spark, sf):
    source = table(spark, sf, "customer")
    path = write_report(source, work_folder(spark, "customer-csv"))
    return read_table(spark, path, "csv", source.schema)


def a2_optional_tables(spark, sf):
    absent = read_optional(spark, work_folder(spark, "no-such-table"))
    out = ft.applicant_features(applicants(spark, sf), absent, prior(spark, sf))
    return rounded(out.select("SK_ID_CURR", "DTI", *ft.PRIOR_FEATURES), "DTI", "PREV_REFUSED_RATE")


def a3_feature_sink(spark, sf):
    path = write_table(feature_table(spark, sf), work_folder(spark, "features"))
    out = read_table(spark, path).select("SK_ID_CURR", "DTI", *ft.HISTORY_FEATURES, *ft.PRIOR_FEATURES)
    return rounded(rounded(out, "DTI", "PREV_REFUSED_RATE"), "BUREAU_DEBT_MEAN", "BUREAU_OVERDUE_SUM", digits=8)


def a7_rows_processed(spark, sf):
    return rows_processed({name: table(spark, sf, name) for name in ("customer", "orders", "lineitem")})


def a8_run_log(spark, sf):
    path = work_folder(spark, "runs")
    for name in ("customer", "orders"):
        append_run(spark, path, "profile", name, {"table": name}, {"rows": table(spark, sf, name).count()}, "n_")
    return read_runs(spark, path)


def d4_positive_weight(spark, sf):
    weights = pf.class_weights(applicants(spark, sf), "TARGET")
    return rounded(weights.select("n_pos", "n_neg", "pos_weight"), "pos_weight")


def d5_class_weights(spark, sf):
    weights = pf.class_weights(returned_lines(spark, sf), "returned")
    return rounded(weights.select("weight_0", "weight_1"), "weight_0", "weight_1")


def d6_class_rates(spark, sf):
    train, test = stable_split(applicants(spark, sf), "SK_ID_CURR")
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return rounded(pf.class_rates(sides, "TARGET", ["side"]), "positive_rate")


def d7_distinct_counts(spark, sf):
    return pf.distinct_counts(table(spark, sf, PROFILED[0]), list(PROFILED[1:]))


SKETCHED, SKETCHED_RANGE, DECILES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipmode_status"), (9, 20), [i / 10 for i in range(1, 10)]
#: So many standard errors a distinct count may be off.
ERRORS = 4


def _line_months(spark, sf):
    """Lines with the number of the month they were shipped in, and their stored sketches by month."""
    lines = table(spark, sf, "lineitem").withColumns({
        "l_shipmode_status": F.concat_ws("-", "l_returnflag", "l_linestatus"), "month": F.month("l_shipdate") + F.year("l_shipdate") % 2 * 12})
    path = work_folder(spark, "sketches")
    sk.table_sketches(lines, F.col("month"), list(SKETCHED)).write.partitionBy("part").parquet(path)
    within = lambda c: F.col(c).between(*SKETCHED_RANGE)
    return lines.where(within("month")), spark.read.parquet(path).where(within("part"))


def d7_sketched_distinct(spark, sf):
    """Distinct values of a range of months from stored sketches, against the exact counts."""
    lines, sketches = _line_months(spark, sf)
    exact = pf.distinct_counts(lines, list(SKETCHED)).withColumnRenamed("n_distinct", "exact")
    off = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return sk.distinct_counts(sketches).join(exact, "column").select(
        "column", "n", F.col("exact").alias("n_distinct"), (off <= ERRORS * sk.distinct_error()).alias("within_error"))


def h1_sketched_quantiles(spark, sf):
    """Deciles of a range of months from stored sketches: the share of rows below and up to each must enclose it."""
    lines, sketches = _line_months(spark, sf)
    found = materialize(sk.sketched_quantiles(sketches, DECILES), "deciles")
    values = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in SKETCHED[:4]])))
    # nine deciles of four columns: a small table
    ranks = values.join(F.broadcast(found), "column").groupBy("column", "probability").agg(
        F.avg((F.col("x") < F.col("value")).cast("double")).alias("below"), F.avg((F.col("x") <= F.col("value")).cast("double")).alias("upto"))
    error = 2 * sk.rank_error()
    return ranks.select("column", "probability", F.lit(True).eqNullSafe(
        (F.col("below") - error <= F.col("probability")) & (F.col("probability") <= F.col("upto") + error)).alias("within_error"))


def d8_exact_median(spark, sf):
    lines = table(spark, sf, "lineitem")
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    found = exact_quantiles(lines, cols, [0.5])
    rows = [(c, found[c][0]) for c in cols]
    return rounded(spark.createDataFrame(rows, "column string, median double"), "median")


def d9_null_rates(spark, sf):
    return rounded(pf.null_rates(feature_table(spark, sf)), "null_rate")


def d10_target_correlations(spark, sf):
    cols = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "BUREAU_CNT", "BUREAU_ACTIVE_CNT",
            "BUREAU_DEBT_MEAN", "BUREAU_OVERDUE_SUM", "PREV_CNT", "PREV_REFUSED_RATE"]
    return rounded(pf.target_correlations(feature_table(spark, sf), "TARGET", cols), "abs_corr")


def d11_table_profile(spark, sf):
    return rounded(pf.table_profile(feature_table(spark, sf), "TARGET"), "positive_rate")


def e1_recency_rank(spark, sf):
    return ft.recency_ranks(prior(spark, sf)).select("SK_ID_CURR", "SK_ID_PREV", "recency_rank")


def e2_rolling_count(spark, sf):
    return ft.rolling_count(table(spark, sf, "events"), "user_id", clock_seconds("ts"), SOME_DAYS)


def e3_transition_matrix(spark, sf):
    moves = ft.transition_matrix(table(spark, sf, "events"), "user_id", clock_micros("ts"), "event_id", "event_type")
    return rounded(moves, "share")


def _followed(spark, sf):
    """All events through the stream: a run over them, then one that a row of a later time lets finish them."""
    arrivals, out, checkpoint = (work_folder(spark, name) for name in ("event-arrivals", "followed", "follow-checkpoint"))
    events = table(spark, sf, "events").select("user_id", F.timestamp_micros(clock_micros("ts")).alias("ts"), "event_id", "event_type")
    end = events.agg((F.max("ts") + F.expr("interval 1 day")).alias("ts")).select(
        *[F.col("ts") if c == "ts" else F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns])
    before = spark.conf.get(hs.STATE_STORE[0], None)
    spark.conf.set(*hs.STATE_STORE)
    try:
        for rows in (events.where("user_id is not null"), end):
            rows.write.mode("append").parquet(arrivals)
            stream = spark.readStream.schema(events.schema).parquet(arrivals)
            hs.follow(stream, "user_id", "ts", "event_id", "event_type", SOME_DAYS, out, checkpoint).awaitTermination()
    finally:
        spark.conf.set(hs.STATE_STORE[0], before) if before else spark.conf.unset(hs.STATE_STORE[0])
    return spark.read.parquet(out)


def e2_rolling_stream(spark, sf):
    return hs.counts_of(_followed(spark, sf), "user_id")


def e3_transition_stream(spark, sf):
    return rounded(hs.transitions_of(_followed(spark, sf)), "share")


def q1_required_columns(spark, sf):
    return pf.required_columns(feature_table(spark, sf), list(REQUIRED))


def q2_class_rate_bounds(spark, sf):
    return rounded(pf.class_rate_bounds(applicants(spark, sf), "TARGET", 0.04, 0.14), "positive_rate")


def q3_leakage_check(spark, sf):
    lines = returned_lines(spark, sf)
    return rounded(pf.leakage_check(lines, "returned", ["l_quantity", "l_discount", "l_extendedprice"]), "abs_corr")


def q4_split_integrity(spark, sf):
    whole = applicants(spark, sf)
    train, test = stable_split(whole, "SK_ID_CURR")
    return pf.split_integrity(whole, train, test, "SK_ID_CURR", "TARGET")


QUERIES = {f.__name__: f for f in (
    a1_scan_csv, a2_optional_tables, a3_feature_sink, a7_rows_processed, a8_run_log, d4_positive_weight,
    d5_class_weights, d6_class_rates, d7_distinct_counts, d7_sketched_distinct, h1_sketched_quantiles, d8_exact_median, d9_null_rates, d10_target_correlations,
    d11_table_profile, e1_recency_rank, e2_rolling_count, e2_rolling_stream, e3_transition_matrix, e3_transition_stream, q1_required_columns,
    q2_class_rate_bounds, q3_leakage_check, q4_split_integrity,
)}

_NULLABLE = (
    "SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "NAME_INCOME_TYPE", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "DTI", "CREDIT_INCOME_RATIO", "AGE_YEARS", "EMPLOYED_YEARS", *ft.HISTORY_FEATURES, *ft.PRIOR_FEATURES,
)

ORACLES = {
    "a1_scan_csv": "SELECT * FROM customer",
    "a2_optional_tables": f"""
        {sql.FEATURES} SELECT SK_ID_CURR, round(DTI, 6) AS DTI, PREV_CNT,
               round(PREV_REFUSED_RATE, 6) AS PREV_REFUSED_RATE, PREV_LAST_AMT_CREDIT FROM features""",
    "a3_feature_sink": f"""
        {sql.FEATURES} SELECT SK_ID_CURR, round(DTI, 6) AS DTI, BUREAU_CNT, BUREAU_ACTIVE_CNT,
               round(BUREAU_DEBT_MEAN, 8) AS BUREAU_DEBT_MEAN, round(BUREAU_OVERDUE_SUM, 8) AS BUREAU_OVERDUE_SUM,
               BUREAU_MAX_DAYS_OVERDUE, PREV_CNT, round(PREV_REFUSED_RATE, 6) AS PREV_REFUSED_RATE,
               PREV_LAST_AMT_CREDIT FROM features""",
    "a7_rows_processed": """
        WITH c AS (SELECT 'customer' AS source, count(*) AS n_rows FROM customer
                   UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
        SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(n_rows) AS BIGINT) FROM c""",
    "a8_run_log": """
        SELECT 'profile' AS experiment, run, kind, key, value FROM (
            SELECT 'customer' AS run, 'param' AS kind, 'table' AS key, 'customer' AS value
            UNION ALL SELECT 'orders', 'param', 'table', 'orders'
            UNION ALL SELECT 'customer', 'metric', 'n_rows', CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) FROM customer
            UNION ALL SELECT 'orders', 'metric', 'n_rows', CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) FROM orders)""",
    "d4_positive_weight": f"""
        {sql.APPLICANTS} SELECT CAST(sum(TARGET) AS BIGINT) AS n_pos, CAST(sum(1 - TARGET) AS BIGINT) AS n_neg,
               round(sum(1 - TARGET) / greatest(sum(TARGET), 1), 6) AS pos_weight FROM applicants""",
    "d5_class_weights": """
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS p FROM lineitem)
        SELECT round(n / (2 * greatest(n - p, 1)), 6) AS weight_0, round(n / (2 * greatest(p, 1)), 6) AS weight_1 FROM c""",
    "d6_class_rates": f"""
        {sql.APPLICANTS} SELECT CASE WHEN {sql.is_test('SK_ID_CURR')} THEN 'test' ELSE 'train' END AS side,
               count(*) AS n_rows, round(avg(TARGET), 6) AS positive_rate FROM applicants GROUP BY 1""",
    "d7_distinct_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM {PROFILED[0]}" for c in PROFILED[1:]),
    "d8_exact_median": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.5), 6) AS median FROM lineitem"
        for c in ("l_extendedprice", "l_quantity", "l_discount")),
    "d9_null_rates": f"""
        {sql.FEATURES}, rates AS ({" UNION ALL ".join(
            f"SELECT '{c}' AS c, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM features" for c in _NULLABLE)})
        SELECT c AS "column", round(r, 6) AS null_rate FROM rates ORDER BY r DESC, c LIMIT 10""",
    "d10_target_correlations": f"""
        {sql.FEATURES} {" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(abs(corr({c}, TARGET)), 6) AS abs_corr FROM features"
            for c in ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "BUREAU_CNT", "BUREAU_ACTIVE_CNT",
                      "BUREAU_DEBT_MEAN", "BUREAU_OVERDUE_SUM", "PREV_CNT", "PREV_REFUSED_RATE"))}""",
    "d11_table_profile": f"""
        {sql.FEATURES} SELECT count(*) AS n_rows, {len(_NULLABLE)} AS n_columns,
               round(avg(TARGET), 6) AS positive_rate FROM features""",
    "e1_recency_rank": f"""
        {sql.PRIOR} SELECT SK_ID_CURR, SK_ID_PREV, CAST(row_number() OVER (
            PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC NULLS LAST, SK_ID_PREV) AS INTEGER) AS recency_rank
        FROM prior""",
    "e2_rolling_count": f"""
        WITH s AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS n FROM events GROUP BY 1, 2)
        SELECT user_id, second, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY second
               RANGE BETWEEN {SOME_DAYS} PRECEDING AND CURRENT ROW) AS BIGINT) AS n_recent FROM s""",
    "e3_transition_matrix": """
        WITH p AS (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous,
                          event_type AS current FROM events),
             n AS (SELECT previous, current, count(*) AS n FROM p WHERE previous IS NOT NULL GROUP BY 1, 2)
        SELECT previous, current, n, round(n / sum(n) OVER (PARTITION BY previous), 6) AS share FROM n""",
    "q1_required_columns": f"""
        {sql.FEATURES} {" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", true AS present, '{t}' AS type, count({c}) AS n_filled FROM features"
            for c, t in REQUIRED.items())}""",
    "q2_class_rate_bounds": f"""
        {sql.APPLICANTS} SELECT round(avg(TARGET), 6) AS positive_rate,
               avg(TARGET) > 0.04 AND avg(TARGET) < 0.14 AS ok FROM applicants""",
    "q3_leakage_check": """
        WITH r AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem), c AS (
            SELECT 'l_quantity' AS "column", abs(corr(l_quantity, y)) AS v FROM r
            UNION ALL SELECT 'l_discount', abs(corr(l_discount, y)) FROM r
            UNION ALL SELECT 'l_extendedprice', abs(corr(l_extendedprice, y)) FROM r)
        SELECT "column", round(v, 6) AS abs_corr, v < 0.1 AS ok FROM c""",
    "q4_split_integrity": f"""
        {sql.APPLICANTS} SELECT count(*) AS n_whole, count(*) FILTER (NOT {sql.is_test('SK_ID_CURR')}) AS n_train,
               count(*) FILTER ({sql.is_test('SK_ID_CURR')}) AS n_test, CAST(0 AS BIGINT) AS n_shared,
               CAST(0 AS BIGINT) AS n_lost,
               count(*) FILTER (TARGET = 1 AND {sql.is_test('SK_ID_CURR')}) AS n_test_pos FROM applicants""",
}
ORACLES |= {"e2_rolling_stream": ORACLES["e2_rolling_count"], "e3_transition_stream": ORACLES["e3_transition_matrix"]}
_MONTHS = f"""WITH l AS (SELECT *, l_returnflag || '-' || l_linestatus AS l_shipmode_status FROM lineitem
    WHERE month(l_shipdate) + year(l_shipdate) % 2 * 12 BETWEEN {SKETCHED_RANGE[0]} AND {SKETCHED_RANGE[1]})"""
ORACLES |= {
    "d7_sketched_distinct": _MONTHS + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", count({c}) AS n, count(DISTINCT {c}) AS n_distinct, TRUE AS within_error FROM l" for c in SKETCHED),
    "h1_sketched_quantiles": "SELECT c AS \"column\", CAST(p AS DOUBLE) AS probability, TRUE AS within_error FROM "
        f"(SELECT unnest({list(SKETCHED[:4])}) AS c), (SELECT unnest({DECILES}) AS p)",
}
