"""Applicant features, weight of evidence, scorecard and reason queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalogue import sql
from riskweave.catalogue.inputs import (
    applicants, credit_table, feature_table, history, prior, returned_lines, rounded, scored_documents, table,
)
from riskweave.functions import risk
from riskweave.operators import features as ft
from riskweave.operators import profile as pf
from riskweave.operators import reasons as rs
from riskweave.operators import scorecard as sc
from riskweave.operators import woe
from riskweave.operators.split import stable_split
from riskweave.session import materialize, work_folder
from riskweave.sources.tables import read_table, write_report

MODEL_COLUMNS = ["DTI", "AMT_ANNUITY", "CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AGE_YEARS",
                 "EMPLOYED_YEARS", "BUREAU_OVERDUE_SUM", "BUREAU_MAX_DAYS_OVERDUE", "BUREAU_DEBT_MEAN",
                 "BUREAU_ACTIVE_CNT", "BUREAU_CNT", "PREV_REFUSED_RATE", "PREV_CNT", "PREV_LAST_AMT_CREDIT"]
# means of cents over 2^k rows end on a 5 in decimal k + 3: round them further out
MONEY = ("BUREAU_DEBT_MEAN", "BUREAU_OVERDUE_SUM", "AMT_ANNUITY")
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]
RANKED = [*LINE_NUMBERS, "l_tax", "l_linestatus"]


def _ratio_query(column):
    def query(spark, sf):
        return rounded(ft.applicant_ratios(applicants(spark, sf)).select("SK_ID_CURR", column), column)

    return query


def b5_zero_fill(spark, sf):
    out = feature_table(spark, sf).select("SK_ID_CURR", *ft.HISTORY_FEATURES, *ft.PRIOR_FEATURES)
    return rounded(rounded(out, "PREV_REFUSED_RATE"), *MONEY[:2], digits=8)


def b6_ratios_in_sql(spark, sf):
    out = ft.applicant_ratios_sql(applicants(spark, sf))
    return rounded(out.select("SK_ID_CURR", "DTI", "CREDIT_INCOME_RATIO", "AGE_YEARS"),
                   "DTI", "CREDIT_INCOME_RATIO", "AGE_YEARS")


def b7_model_features(spark, sf):
    table_ = feature_table(spark, sf)
    names = ft.model_features(table_)
    return rounded(rounded(table_.select("SK_ID_CURR", *names), *[c for c in names if c not in MONEY]), *MONEY, digits=8)


def b8_median_imputation(spark, sf):
    whole = ft.applicant_ratios(applicants(spark, sf))
    train, _ = stable_split(whole, "SK_ID_CURR")
    medians = ft.fit_medians(train, ["DTI", "EMPLOYED_YEARS", "AMT_CREDIT"])
    out = ft.impute(whole, medians).select("SK_ID_CURR", "DTI", "EMPLOYED_YEARS", "AMT_CREDIT")
    return rounded(out, "DTI", "EMPLOYED_YEARS", "AMT_CREDIT")


def b9_standardize(spark, sf):
    whole = applicants(spark, sf).select("SK_ID_CURR", "AMT_CREDIT", "AMT_ANNUITY")
    train, _ = stable_split(whole, "SK_ID_CURR")
    stats = ft.fit_standardizer(train, ["AMT_CREDIT", "AMT_ANNUITY"])
    return rounded(ft.standardize(whole, stats), "AMT_CREDIT", "AMT_ANNUITY")


def b10_transaction_rules(spark, sf):
    old = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf, "events").select(
        "event_id",
        risk.is_risky_type("event_type", ("purchase", "error")).alias("risky"),
        risk.drains_account("value", old).alias("drained"),
        (risk.is_large("value", 200.0) & risk.is_risky_type("event_type", ("purchase", "error"))).alias("large_risky"),
    )


def b12_clip_probability(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        F.round(risk.clip_probability(F.col("l_discount") * 10), 6).alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))


def c1_applicant_features(spark, sf):
    """Flagship: ratios, credit-history and prior-application aggregates per applicant."""
    ratios = ("DTI", "CREDIT_INCOME_RATIO", "AGE_YEARS", "EMPLOYED_YEARS", "PREV_REFUSED_RATE")
    return rounded(rounded(feature_table(spark, sf), *ratios), *MONEY, digits=8)


def d1_history_aggregates(spark, sf):
    return rounded(ft.history_aggregates(history(spark, sf)), *MONEY[:2], digits=8)


def d2_prior_aggregates(spark, sf):
    return rounded(ft.prior_aggregates(prior(spark, sf)).drop("PREV_LAST_AMT_CREDIT"), "PREV_REFUSED_RATE")


def d3_latest_amount(spark, sf):
    return ft.prior_aggregates(prior(spark, sf)).select("SK_ID_CURR", "PREV_LAST_AMT_CREDIT")


# --------------------------------------------------------------------------- weight of evidence
def _edges(spark, sf):
    return woe.quantile_edges(table(spark, sf, "lineitem"), LINE_NUMBERS, decimals=6)


def h1_quantile_bins(spark, sf):
    bins = woe.woe_tables(returned_lines(spark, sf), "returned", _edges(spark, sf))
    return bins.select("feature", "bin_index", "lo", "hi", "n")


def _rounded_bins(bins):
    return rounded(bins, "woe", "iv_contribution")


def h2_woe_numeric(spark, sf):
    return _rounded_bins(woe.woe_numeric(returned_lines(spark, sf), "l_extendedprice", "returned", decimals=6))


def h3_woe_categorical(spark, sf):
    docs = scored_documents(spark, sf).withColumn("source", F.when(F.col("lang") != "es", F.col("source")))
    return _rounded_bins(woe.woe_categorical(docs, "source", "quality"))


def h4_woe_from_counts(spark, sf):
    customers = applicants(spark, sf)
    counts = customers.groupBy("NAME_INCOME_TYPE").agg(F.count(F.lit(1)).alias("n"), F.sum("TARGET").alias("n_bad"))
    return _rounded_bins(woe.woe_from_counts(counts, woe.class_totals(customers, "TARGET")))


def _line_ranking(spark, sf):
    return woe.iv_ranking(returned_lines(spark, sf), "returned", RANKED, decimals=6)


def h5_iv_ranking(spark, sf):
    return rounded(_line_ranking(spark, sf), "iv")


def a4_ranking_csv(spark, sf):
    path = write_report(rounded(_line_ranking(spark, sf), "iv"), work_folder(spark, "iv-csv"))
    return read_table(spark, path, "csv", "feature string, iv double, selected boolean")


def e6_ranking_head(spark, sf):
    docs = scored_documents(spark, sf)
    return rounded(woe.iv_ranking(docs, "quality", ["n_chars", "lang", "source"], decimals=6).limit(2), "iv")


def h6_iv_strength(spark, sf):
    docs = scored_documents(spark, sf)
    ranking = woe.iv_ranking(docs, "toxic", ["n_chars", "lang", "source", "quality"], decimals=6)
    return ranking.select("feature", risk.iv_strength("iv").alias("strength"))


def h7_feature_selection(spark, sf):
    train, _ = stable_split(credit_table(spark, sf), "SK_ID_CURR")
    chosen = woe.selected_features(woe.iv_ranking(train, "TARGET", MODEL_COLUMNS), MODEL_COLUMNS)
    return rounded(train.select("SK_ID_CURR", *chosen), *chosen, digits=4)


def h8_monotonic_bins(spark, sf):
    train, _ = stable_split(credit_table(spark, sf), "SK_ID_CURR")
    return _rounded_bins(woe.monotonic_bins(train, "TARGET", MODEL_COLUMNS))


#: Pre-bins of the optimal bins; SQL tries all ways to join them.
PREBINS = 12


def h8_optimal_bins(spark, sf):
    return _rounded_bins(woe.optimal_bins(returned_lines(spark, sf), "returned", LINE_NUMBERS, PREBINS, decimals=6))


def h9_woe_transform(spark, sf):
    lines = returned_lines(spark, sf)
    bins = materialize(woe.woe_tables(lines, "returned", _edges(spark, sf), ["l_linestatus"]), "bins")
    coded = woe.woe_transform(lines, bins, LINE_NUMBERS, ["l_linestatus"])
    added = [f"{c}_woe" for c in (*LINE_NUMBERS, "l_linestatus")]
    return rounded(coded.select("l_orderkey", "l_linenumber", "l_suppkey", *added), *added)


def c2_bin_lookup(spark, sf):
    docs = scored_documents(spark, sf)
    train, _ = stable_split(docs, "doc_id")
    bins = materialize(woe.woe_categorical(train, "source", "quality"), "bins")
    coded = woe.woe_transform(docs, bins, [], ["source"])
    return rounded(coded.select("doc_id", "source_woe"), "source_woe")


def q5_monotone_share(spark, sf):
    return rounded(woe.monotone_share(woe.woe_tables(returned_lines(spark, sf), "returned", _edges(spark, sf))),
                   "falling_share")


# --------------------------------------------------------------------------- scorecard
CARD_FEATURES = ["PREV_REFUSED_RATE", "PREV_CNT", "BUREAU_MAX_DAYS_OVERDUE", "BUREAU_ACTIVE_CNT", "EMPLOYED_YEARS"]


def _card(spark, sf):
    train, test = stable_split(credit_table(spark, sf), "SK_ID_CURR")
    return sc.fit_scorecard(train, "TARGET", CARD_FEATURES), test


def h10_scorecard_fit(spark, sf):
    card, _ = _card(spark, sf)
    rows = [("(intercept)", card.intercept), *card.coefficients.items()]
    return rounded(spark.createDataFrame(rows, "term string, coefficient double"), "coefficient")


def h11_scorecard_proba(spark, sf):
    card, test = _card(spark, sf)
    return rounded(sc.scorecard_proba(test, card).select("SK_ID_CURR", "probability"), "probability")


def h12_pdo_scale(spark, sf):
    factor, offset = sc.pdo_params()
    rate = table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.avg((F.col("c_acctbal") < 0).cast("double")).alias("p"))
    points = sc.score_points("p")
    return rate.select("c_mktsegment", F.round(F.lit(factor), 6).alias("factor"),
                       F.round(F.lit(offset), 6).alias("offset"), F.round(points, 6).alias("points"))


def h13_score_points(spark, sf):
    scored = scored_documents(spark, sf)
    return scored.select("doc_id", F.round(sc.score_points("score"), 6).alias("points"))


def h14_points_table(spark, sf):
    card, _ = _card(spark, sf)
    return rounded(sc.points_table(card), "woe", "points")


# --------------------------------------------------------------------------- reasons
IMPORTANCES = {"AMT_CREDIT": 0.5, "AMT_ANNUITY": 0.25, "AMT_INCOME_TOTAL": -1.0, "DAYS_BIRTH": 0.75}
REASON_GROUPS = {
    "Debt-to-income": ["AMT_CREDIT", "AMT_ANNUITY", "DTI"], "Income": ["AMT_INCOME_TOTAL"], "Age & employment": ["DAYS_BIRTH"],
}


def _zscores(spark, sf):
    return rs.zscore_contributions(applicants(spark, sf), "SK_ID_CURR", IMPORTANCES)


def k1_zscore_contributions(spark, sf):
    return rounded(_zscores(spark, sf), *IMPORTANCES)


def k2_linear_contributions(spark, sf):
    lines = returned_lines(spark, sf)
    bins = woe.collect_bins(woe.woe_tables(lines, "returned", _edges(spark, sf)))
    means = lines.agg(*[F.avg(bins.column(c)).alias(c) for c in LINE_NUMBERS]).first().asDict()
    card = sc.ScorecardModel(LINE_NUMBERS, bins, lines, dict.fromkeys(LINE_NUMBERS, -1.0), 0.0, means, sc.ScorecardConfig())
    keyed = lines.withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    return rounded(rs.linear_contributions(keyed, "line", card), *LINE_NUMBERS)


def k4_group_contributions(spark, sf):
    return rounded(rs.group_contributions(_zscores(spark, sf), "SK_ID_CURR", REASON_GROUPS), "contribution")


def k5_reason_codes(spark, sf):
    codes = rs.reason_codes(_zscores(spark, sf), "SK_ID_CURR", REASON_GROUPS)
    return rounded(codes, "contribution")


def k6_notices(spark, sf):
    return rs.notices(_zscores(spark, sf), "SK_ID_CURR", groups=REASON_GROUPS)


QUERIES = {
    "b1_dti": _ratio_query("DTI"),
    "b2_credit_income_ratio": _ratio_query("CREDIT_INCOME_RATIO"),
    "b3_age_years": _ratio_query("AGE_YEARS"),
    "b4_employed_years": _ratio_query("EMPLOYED_YEARS"),
} | {f.__name__: f for f in (
    b5_zero_fill, b6_ratios_in_sql, b7_model_features, b8_median_imputation, b9_standardize, b10_transaction_rules,
    b12_clip_probability, c1_applicant_features, d1_history_aggregates, d2_prior_aggregates, d3_latest_amount,
    h1_quantile_bins, h2_woe_numeric, h3_woe_categorical, h4_woe_from_counts, h5_iv_ranking, a4_ranking_csv,
    e6_ranking_head, h6_iv_strength, h7_feature_selection, h8_monotonic_bins, h8_optimal_bins, h9_woe_transform,
    c2_bin_lookup,
    q5_monotone_share, h10_scorecard_fit, h11_scorecard_proba, h12_pdo_scale, h13_score_points, h14_points_table,
    k1_zscore_contributions, k2_linear_contributions, k4_group_contributions, k5_reason_codes, k6_notices,
)}

# --------------------------------------------------------------------------- comparison SQL
_HISTORY_OUT = """BUREAU_CNT, BUREAU_ACTIVE_CNT, round(BUREAU_DEBT_MEAN, 8) AS BUREAU_DEBT_MEAN,
    round(BUREAU_OVERDUE_SUM, 8) AS BUREAU_OVERDUE_SUM, BUREAU_MAX_DAYS_OVERDUE"""
_PRIOR_OUT = "PREV_CNT, round(PREV_REFUSED_RATE, 6) AS PREV_REFUSED_RATE, PREV_LAST_AMT_CREDIT"
_LINES = "WITH lines AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem),"
_DOCS = """WITH docs AS (SELECT doc_id, lang, source, n_chars, quality, toxic,
    round(1 / (1 + exp(-(n_chars / 2000.0 - 1))), 3) AS score FROM documents JOIN labels USING (doc_id))"""
_BINS_OUT = """feature, bin_index, lo, hi, category, n, n_bad, round(woe, 6) AS woe,
    round(iv_contribution, 6) AS iv_contribution FROM woe_rows"""
_LINE_IV = f"""{_LINES} {sql.woe_ctes('lines', 'returned', LINE_NUMBERS, ['l_tax', 'l_linestatus'])}
    SELECT feature, round(sum(iv_contribution), 6) AS iv, sum(iv_contribution) >= 0.02 AS selected
    FROM woe_rows GROUP BY 1"""


def _ratio_sql(column: str) -> str:
    return f"{sql.FEATURES} SELECT SK_ID_CURR, round({column}, 6) AS {column} FROM features"


def _line_woe(column: str) -> str:
    """WOE of one line column for every line."""
    return f"""(SELECT woe FROM woe_rows w WHERE w.feature = '{column}' AND w.bin_index = {column}_bin)"""


_LINE_BINS = ", ".join(
    f"len(list_filter(e_{c}[2:len(e_{c}) - 1], lambda x: x < {c})) AS {c}_bin" for c in LINE_NUMBERS)
_LINE_EDGES = ", ".join(
    f"(SELECT list_sort(list_distinct(list_transform(quantile_cont({c}, [{', '.join(str(i / 10) for i in range(11))}]),"
    f" lambda x: round(x, 6)))) AS e_{c} FROM lines)" for c in LINE_NUMBERS)
_LINE_CODED = f"""{_LINES} {sql.woe_ctes('lines', 'returned', LINE_NUMBERS, ['l_linestatus'])},
    placed AS (SELECT lines.*, {_LINE_BINS} FROM lines, {_LINE_EDGES}),
    coded AS (
        SELECT p.*, {", ".join(f"w_{c}.woe AS {c}_woe" for c in (*LINE_NUMBERS, "l_linestatus"))} FROM placed p
        {" ".join(f"LEFT JOIN woe_rows w_{c} ON w_{c}.feature = '{c}' AND w_{c}.bin_index = p.{c}_bin" for c in LINE_NUMBERS)}
        LEFT JOIN woe_rows w_l_linestatus ON w_l_linestatus.feature = 'l_linestatus'
             AND w_l_linestatus.category = p.l_linestatus)"""
_ZSCORES = f"""{sql.APPLICANTS}, z AS (SELECT SK_ID_CURR, {", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) * {w} AS {c}" for c, w in IMPORTANCES.items())}
    FROM applicants)"""
_GROUPED = f"""{_ZSCORES}, g AS (
    SELECT SK_ID_CURR, 0 AS position, 'Debt-to-income' AS "group", AMT_CREDIT + AMT_ANNUITY AS contribution FROM z
    UNION ALL SELECT SK_ID_CURR, 1, 'Income', AMT_INCOME_TOTAL FROM z
    UNION ALL SELECT SK_ID_CURR, 2, 'Age & employment', DAYS_BIRTH FROM z)"""
_TEXTS = "CASE \"group\" " + " ".join(
    f"WHEN '{name}' THEN '{rs.DEFAULT_REASONS[name]}'" for name in REASON_GROUPS) + " END"
_REASONS = f"""{_GROUPED}, ranked AS (
    SELECT SK_ID_CURR, "group", {_TEXTS} AS reason, contribution, CAST(row_number() OVER (
        PARTITION BY SK_ID_CURR ORDER BY contribution DESC, position) AS INTEGER) AS rank
    FROM g WHERE contribution > 0)"""

ORACLES = {
    "b1_dti": _ratio_sql("DTI"),
    "b2_credit_income_ratio": _ratio_sql("CREDIT_INCOME_RATIO"),
    "b3_age_years": _ratio_sql("AGE_YEARS"),
    "b4_employed_years": _ratio_sql("EMPLOYED_YEARS"),
    "b5_zero_fill": f"{sql.FEATURES} SELECT SK_ID_CURR, {_HISTORY_OUT}, {_PRIOR_OUT} FROM features",
    "b6_ratios_in_sql": f"""{sql.FEATURES} SELECT SK_ID_CURR, round(DTI, 6) AS DTI,
        round(CREDIT_INCOME_RATIO, 6) AS CREDIT_INCOME_RATIO, round(AGE_YEARS, 6) AS AGE_YEARS FROM features""",
    "b7_model_features": f"""{sql.FEATURES} SELECT SK_ID_CURR, {", ".join(
        f"round({c}, {8 if c in MONEY else 6}) AS {c}" for c in MODEL_COLUMNS)} FROM features""",
    "b8_median_imputation": f"""{sql.FEATURES}, m AS (
            SELECT median(DTI) AS d, median(EMPLOYED_YEARS) AS e, median(AMT_CREDIT) AS c
            FROM features WHERE NOT {sql.is_test('SK_ID_CURR')})
        SELECT SK_ID_CURR, round(coalesce(DTI, d), 6) AS DTI, round(coalesce(EMPLOYED_YEARS, e), 6) AS EMPLOYED_YEARS,
               round(coalesce(AMT_CREDIT, c), 6) AS AMT_CREDIT FROM features, m""",
    "b9_standardize": f"""{sql.APPLICANTS}, s AS (
            SELECT avg(AMT_CREDIT) AS mc, stddev_pop(AMT_CREDIT) AS sc, avg(AMT_ANNUITY) AS ma, stddev_pop(AMT_ANNUITY) AS sa
            FROM applicants WHERE NOT {sql.is_test('SK_ID_CURR')})
        SELECT SK_ID_CURR, round((AMT_CREDIT - mc) / (sc + 1e-8), 6) AS AMT_CREDIT,
               round((AMT_ANNUITY - ma) / (sa + 1e-8), 6) AS AMT_ANNUITY FROM applicants, s""",
    "b10_transaction_rules": """
        SELECT event_id, event_type IN ('purchase', 'error') AS risky,
               value > CAST(json_extract_string(props, '$.k') AS DOUBLE) * CAST(0.95 AS DOUBLE) AS drained,
               value > 200 AND event_type IN ('purchase', 'error') AS large_risky FROM events""",
    "b12_clip_probability": """
        SELECT round(least(greatest(l_discount * 10, 1e-6), 1 - 1e-6), 6) AS p, count(*) AS n FROM lineitem GROUP BY 1""",
    "c1_applicant_features": f"""{sql.FEATURES} SELECT SK_ID_CURR, TARGET, AMT_INCOME_TOTAL, NAME_INCOME_TYPE, AMT_CREDIT,
        round(AMT_ANNUITY, 8) AS AMT_ANNUITY, DAYS_BIRTH, DAYS_EMPLOYED, round(DTI, 6) AS DTI,
        round(CREDIT_INCOME_RATIO, 6) AS CREDIT_INCOME_RATIO, round(AGE_YEARS, 6) AS AGE_YEARS,
        round(EMPLOYED_YEARS, 6) AS EMPLOYED_YEARS, {_HISTORY_OUT}, {_PRIOR_OUT} FROM features""",
    "d1_history_aggregates": f"{sql.AGGREGATES} SELECT SK_ID_CURR, {_HISTORY_OUT} FROM history_agg",
    "d2_prior_aggregates": f"""{sql.AGGREGATES} SELECT SK_ID_CURR, PREV_CNT,
        round(PREV_REFUSED_RATE, 6) AS PREV_REFUSED_RATE FROM prior_agg""",
    "d3_latest_amount": f"{sql.AGGREGATES} SELECT SK_ID_CURR, PREV_LAST_AMT_CREDIT FROM latest",
    "h1_quantile_bins": f"""{_LINES} {sql.woe_ctes('lines', 'returned', LINE_NUMBERS, [])}
        SELECT feature, bin_index, lo, hi, n FROM woe_rows""",
    "h2_woe_numeric": f"{_LINES} {sql.woe_ctes('lines', 'returned', ['l_extendedprice'], [])} SELECT {_BINS_OUT}",
    "h3_woe_categorical": f"""{_DOCS}, part_known AS (
            SELECT CASE WHEN lang <> 'es' THEN source END AS source, quality FROM docs),
        {sql.woe_ctes('part_known', 'quality', [], ['source'])} SELECT feature, CAST(bin_index AS INTEGER) AS bin_index,
        CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, category, n, n_bad, round(woe, 6) AS woe,
        round(iv_contribution, 6) AS iv_contribution FROM woe_rows""",
    "h8_optimal_bins": f"""{_LINES.replace("WITH ", "WITH RECURSIVE ", 1)} {sql.woe_ctes('lines', 'returned', LINE_NUMBERS, [], PREBINS)},
        pre AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY bin_index) - 1 AS r,
                       sum(n) OVER (PARTITION BY feature) AS whole FROM woe_rows WHERE bin_index >= 0),
        joined AS (SELECT a.feature, a.r AS first, b.r AS last, a.lo, b.hi, sum(c.n) AS n, sum(c.n_bad) AS n_bad
                   FROM pre a JOIN pre b ON a.feature = b.feature AND a.r <= b.r
                   JOIN pre c ON c.feature = a.feature AND c.r BETWEEN a.r AND b.r
                   GROUP BY ALL HAVING sum(c.n) >= 0.05 * max(c.whole) OR count(*) = max((SELECT count(*) FROM pre p WHERE p.feature = a.feature))),
        segment AS (SELECT j.*, ln(((n - n_bad + 0.5) / (g + 0.5)) / ((n_bad + 0.5) / (p + 0.5))) AS woe,
                           ((n - n_bad + 0.5) / (g + 0.5) - (n_bad + 0.5) / (p + 0.5))
                           * ln(((n - n_bad + 0.5) / (g + 0.5)) / ((n_bad + 0.5) / (p + 0.5))) AS iv FROM joined j, totals),
        way AS (SELECT feature, last, n, n_bad, iv, d, [first] AS firsts FROM segment, (VALUES (1), (-1)) v(d) WHERE first = 0
                UNION ALL
                SELECT w.feature, s.last, s.n, s.n_bad, w.iv + s.iv, d, list_append(firsts, s.first) FROM way w
                JOIN segment s ON s.feature = w.feature AND s.first = w.last + 1 AND d * (s.n_bad * w.n - w.n_bad * s.n) > 0),
        chosen AS (SELECT feature, list_append(firsts, last + 1) AS cuts FROM (SELECT *, row_number() OVER (
                       PARTITION BY feature ORDER BY iv DESC, len(firsts)) AS place FROM way
                       WHERE last = (SELECT max(r) FROM pre p WHERE p.feature = way.feature)) WHERE place = 1),
        placed AS (SELECT feature, cuts, unnest(range(1, len(cuts))) AS i FROM chosen)
        SELECT feature, CAST(i - 1 AS INTEGER) AS bin_index, lo, hi, CAST(NULL AS VARCHAR) AS category, CAST(n AS BIGINT) AS n,
               CAST(n_bad AS BIGINT) AS n_bad, round(woe, 6) AS woe, round(iv, 6) AS iv_contribution
        FROM placed JOIN segment s USING (feature) WHERE s.first = cuts[i] AND s.last = cuts[i + 1] - 1
        UNION ALL SELECT {_BINS_OUT.replace("FROM woe_rows", "FROM woe_rows WHERE bin_index = -1")}""",
    "h4_woe_from_counts": f"""{sql.APPLICANTS}, {sql.woe_ctes('applicants', 'TARGET', [], ['NAME_INCOME_TYPE']).lstrip()}
        SELECT category AS NAME_INCOME_TYPE, n, n_bad, round(woe, 6) AS woe,
               round(iv_contribution, 6) AS iv_contribution FROM woe_rows""",
    "h5_iv_ranking": _LINE_IV,
    "a4_ranking_csv": _LINE_IV,
    "e6_ranking_head": f"""{_DOCS}, {sql.woe_ctes('docs', 'quality', ['n_chars'], ['lang', 'source'])}
        SELECT feature, round(sum(iv_contribution), 6) AS iv, sum(iv_contribution) >= 0.02 AS selected
        FROM woe_rows GROUP BY 1 ORDER BY sum(iv_contribution) DESC, feature LIMIT 2""",
    "h6_iv_strength": f"""{_DOCS}, {sql.woe_ctes('docs', 'toxic', ['n_chars'], ['lang', 'source', 'quality'])},
        iv AS (SELECT feature, sum(iv_contribution) AS iv FROM woe_rows GROUP BY 1)
        SELECT feature, CASE WHEN iv < 0.02 THEN 'not predictive' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium'
               WHEN iv < 0.5 THEN 'strong' ELSE 'suspiciously strong' END AS strength FROM iv""",
    "h9_woe_transform": f"""{_LINE_CODED} SELECT l_orderkey, l_linenumber, l_suppkey, {", ".join(
        f"round({c}_woe, 6) AS {c}_woe" for c in (*LINE_NUMBERS, "l_linestatus"))} FROM coded""",
    "c2_bin_lookup": f"""{_DOCS}, known AS (SELECT * FROM docs WHERE NOT {sql.is_test('doc_id')}),
        {sql.woe_ctes('known', 'quality', [], ['source'])}
        SELECT doc_id, round(coalesce(woe, 0.0), 6) AS source_woe FROM docs LEFT JOIN woe_rows ON docs.source = category""",
    "q5_monotone_share": f"""{_LINES} {sql.woe_ctes('lines', 'returned', LINE_NUMBERS, [])},
        steps AS (SELECT feature, woe - lag(woe) OVER (PARTITION BY feature ORDER BY bin_index) AS step FROM woe_rows)
        SELECT feature, round(avg(CASE WHEN step <= 0 THEN 1.0 ELSE 0.0 END), 6) AS falling_share
        FROM steps WHERE step IS NOT NULL GROUP BY 1""",
    "h12_pdo_scale": """
        WITH r AS (SELECT c_mktsegment, avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END) AS p FROM customer GROUP BY 1)
        SELECT c_mktsegment, round(20 / ln(2), 6) AS factor, round(600 - 20 / ln(2) * ln(50), 6) AS "offset",
               round(600 - 20 / ln(2) * ln(50) + 20 / ln(2) * ln((1 - p) / p), 6) AS points
        FROM (SELECT c_mktsegment, least(greatest(p, 1e-6), 1 - 1e-6) AS p FROM r)""",
    "h13_score_points": f"""{_DOCS} SELECT doc_id, round(600 - 20 / ln(2) * ln(50) + 20 / ln(2) * ln((1 - p) / p), 6) AS points
        FROM (SELECT doc_id, least(greatest(score, 1e-6), 1 - 1e-6) AS p FROM docs)""",
    "k1_zscore_contributions": f"""{_ZSCORES} SELECT SK_ID_CURR, {", ".join(
        f"round({c}, 6) AS {c}" for c in IMPORTANCES)} FROM z""",
    "k2_linear_contributions": f"""{_LINE_CODED} SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS line,
        {", ".join(f"round(-({c}_woe - avg({c}_woe) OVER ()), 6) AS {c}" for c in LINE_NUMBERS)} FROM coded""",
    "k4_group_contributions": f'{_GROUPED} SELECT SK_ID_CURR, "group", round(contribution, 6) AS contribution FROM g',
    "k5_reason_codes": f"""{_REASONS} SELECT SK_ID_CURR, rank, "group", reason, round(contribution, 6) AS contribution
        FROM ranked WHERE rank <= 4""",
    "k6_notices": f"""{_REASONS}, listed AS (
            SELECT SK_ID_CURR, string_agg('  ' || rank || '. ' || reason, chr(10) ORDER BY rank) AS lines
            FROM ranked WHERE rank <= 4 GROUP BY 1)
        SELECT SK_ID_CURR, array_to_string(['Decision on a credit application', 'Reference: ' || SK_ID_CURR,
            'Decision: denied', 'Reasons:', coalesce(lines, '  (no group has a positive contribution)'),
            'Listed by contribution to the score, largest first.'], chr(10)) AS notice
        FROM applicants LEFT JOIN listed USING (SK_ID_CURR)""",
}
