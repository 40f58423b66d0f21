"""Shared pieces of the comparison SQL."""

from __future__ import annotations

APPLICANTS = """
WITH agg AS (
    SELECT o_custkey, max(o_totalprice) AS AMT_CREDIT, avg(o_totalprice) AS AMT_ANNUITY,
           CAST(date_diff('day', DATE '2001-08-02', CAST(min(o_orderdate) AS DATE)) AS INTEGER) AS DAYS_BIRTH,
           CAST(date_diff('day', DATE '2001-01-01', CAST(min(o_orderdate) AS DATE))
                AS INTEGER) AS DAYS_EMPLOYED
    FROM orders GROUP BY o_custkey),
applicants AS (
    SELECT c_custkey AS SK_ID_CURR, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS TARGET,
           greatest(c_acctbal, 0.0) AS AMT_INCOME_TOTAL, c_mktsegment AS NAME_INCOME_TYPE,
           AMT_CREDIT, AMT_ANNUITY, DAYS_BIRTH, DAYS_EMPLOYED
    FROM customer LEFT JOIN agg ON c_custkey = o_custkey)"""

_PRIOR_BODY = """prior AS (
    SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
           CASE o_orderstatus WHEN 'F' THEN 'Refused' WHEN 'O' THEN 'Approved' END AS NAME_CONTRACT_STATUS,
           o_totalprice AS AMT_CREDIT,
           CAST(date_diff('day', DATE '2001-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS DAYS_DECISION
    FROM orders)"""

_HISTORY_BODY = """history AS (
    SELECT o_custkey AS SK_ID_CURR, CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE,
           l_extendedprice AS AMT_CREDIT_SUM_DEBT,
           CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_tax ELSE 0.0 END AS AMT_CREDIT_SUM_OVERDUE,
           l_quantity AS CREDIT_DAY_OVERDUE
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_AGGREGATES = """
history_agg AS (
    SELECT SK_ID_CURR, count(*) AS BUREAU_CNT,
           CAST(count(*) FILTER (CREDIT_ACTIVE = 'Active') AS BIGINT) AS BUREAU_ACTIVE_CNT,
           avg(AMT_CREDIT_SUM_DEBT) AS BUREAU_DEBT_MEAN, sum(AMT_CREDIT_SUM_OVERDUE) AS BUREAU_OVERDUE_SUM,
           max(CREDIT_DAY_OVERDUE) AS BUREAU_MAX_DAYS_OVERDUE
    FROM history GROUP BY 1),
latest AS (
    SELECT SK_ID_CURR, AMT_CREDIT AS PREV_LAST_AMT_CREDIT FROM (
        SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC NULLS LAST, SK_ID_PREV) AS r
        FROM prior) WHERE r = 1),
prior_agg AS (
    SELECT SK_ID_CURR, count(*) AS PREV_CNT,
           avg(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1.0 ELSE 0.0 END) AS PREV_REFUSED_RATE
    FROM prior GROUP BY 1)"""

PRIOR = f"WITH {_PRIOR_BODY}"
HISTORY = f"WITH {_HISTORY_BODY}"
AGGREGATES = f"WITH {_HISTORY_BODY}, {_PRIOR_BODY}, {_AGGREGATES}"

FEATURES = f"""{APPLICANTS}, {_PRIOR_BODY}, {_HISTORY_BODY}, {_AGGREGATES},
features AS (
    SELECT a.*, AMT_ANNUITY / nullif(AMT_INCOME_TOTAL / 12.0, 0) AS DTI,
           AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS CREDIT_INCOME_RATIO,
           -DAYS_BIRTH / 365.25 AS AGE_YEARS,
           CASE WHEN -DAYS_EMPLOYED / 365.25 < 0 THEN 0.0 ELSE -DAYS_EMPLOYED / 365.25 END AS EMPLOYED_YEARS,
           coalesce(BUREAU_CNT, 0) AS BUREAU_CNT, coalesce(BUREAU_ACTIVE_CNT, 0) AS BUREAU_ACTIVE_CNT, BUREAU_DEBT_MEAN,
           coalesce(BUREAU_OVERDUE_SUM, 0.0) AS BUREAU_OVERDUE_SUM,
           coalesce(BUREAU_MAX_DAYS_OVERDUE, 0.0) AS BUREAU_MAX_DAYS_OVERDUE,
           coalesce(PREV_CNT, 0) AS PREV_CNT, coalesce(PREV_REFUSED_RATE, 0.0) AS PREV_REFUSED_RATE, PREV_LAST_AMT_CREDIT
    FROM applicants a LEFT JOIN history_agg USING (SK_ID_CURR) LEFT JOIN prior_agg USING (SK_ID_CURR)
    LEFT JOIN latest USING (SK_ID_CURR))"""


def is_test(key: str, seed: int = 42) -> str:
    """Membership in the 25 % test side."""
    return f"(substr(md5('{seed}:' || {key}), 1, 8) < '40000000')"


def uniform(seed: str, key: str) -> str:
    """The hash value of a key in [0, 1)."""
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0)"


# --------------------------------------------------------------------------- weight of evidence
def woe_ctes(source: str, target: str, numeric: list[str], categorical: list[str], n_bins: int = 10) -> str:
    """CTEs ending in ``woe_rows``: (feature, bin_index, lo, hi, category, n, n_bad, woe, iv_contribution).

    ``source`` is a CTE or table name; edges are rounded to 6 decimals before binning.
    """
    grid = ", ".join(str(i / n_bins) for i in range(n_bins + 1))
    parts = []
    for c in numeric:
        parts.append(f"""
        SELECT '{c}' AS feature, CASE WHEN {c} IS NULL OR len(e) < 2 THEN -1
                   ELSE len(list_filter(e[2:len(e) - 1], lambda x: x < {c})) END AS bin_index,
               CAST(NULL AS VARCHAR) AS category, {target} AS y
        FROM {source}, (SELECT list_sort(list_distinct(list_transform(
            quantile_cont({c}, [{grid}]), lambda x: round(x, 6)))) AS e FROM {source})""")
    for c in categorical:
        parts.append(f"""
        SELECT '{c}' AS feature, CAST(NULL AS INTEGER) AS bin_index,
               coalesce(CAST({c} AS VARCHAR), 'MISSING') AS category, {target} AS y FROM {source}""")
    edges = [f"""
        SELECT '{c}' AS feature, i - 1 AS bin_index, e[i] AS lo, e[i + 1] AS hi FROM (
            SELECT e, unnest(range(1, len(e))) AS i FROM (SELECT list_sort(list_distinct(list_transform(
                quantile_cont({c}, [{grid}]), lambda x: round(x, 6)))) AS e FROM {source}))""" for c in numeric]
    edge_rows = " UNION ALL ".join(edges) if edges else (
        "SELECT '' AS feature, 0 AS bin_index, 0.0 AS lo, 0.0 AS hi WHERE false")
    return f"""
    binned AS ({" UNION ALL ".join(parts)}),
    edge_rows AS ({edge_rows}),
    totals AS (SELECT greatest(sum({target}), 1) AS p, greatest(sum(1 - {target}), 1) AS g FROM {source}),
    counted AS (SELECT feature, bin_index, category, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_bad
                FROM binned GROUP BY 1, 2, 3),
    shares AS (SELECT c.*, (n_bad + 0.5) / (p + 0.5) AS db, (n - n_bad + 0.5) / (g + 0.5) AS dg FROM counted c, totals),
    woe_rows AS (
        SELECT s.feature, CAST(s.bin_index AS INTEGER) AS bin_index, lo, hi,
               CASE WHEN s.bin_index = -1 THEN 'MISSING' ELSE category END AS category, n, n_bad,
               ln(dg / db) AS woe, (dg - db) * ln(dg / db) AS iv_contribution
        FROM shares s LEFT JOIN edge_rows e ON s.feature = e.feature AND s.bin_index = e.bin_index)"""


# --------------------------------------------------------------------------- metrics
def metric_ctes(source: str, label: str, score: str, by: str | None = None, threshold: float = 0.5) -> str:
    """CTEs ending in ``bundle`` (and ``hist``, ``cum``, ``confusion`` on the way), grouped by ``grp``."""
    group = by or "0"
    return f"""
    rows_ AS (SELECT {group} AS grp, {label} AS y, CAST({score} AS DOUBLE) AS score FROM {source}),
    hist AS (SELECT grp, score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM rows_ GROUP BY 1, 2),
    cum AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
                   CAST(sum(pos) OVER (PARTITION BY grp) AS BIGINT) AS tot_pos,
                   CAST(sum(neg) OVER (PARTITION BY grp) AS BIGINT) AS tot_neg
            FROM hist WINDOW w AS (PARTITION BY grp ORDER BY score ROWS UNBOUNDED PRECEDING)),
    shares AS (SELECT *, cum_pos / greatest(tot_pos, 1) AS bad_share, cum_neg / greatest(tot_neg, 1) AS good_share FROM cum),
    ranked AS (
        SELECT grp, max(tot_pos) AS p, max(tot_neg) AS n, sum(pos * (cum_neg - neg + neg / 2.0)) AS pairs,
               sum(pos * ((tot_pos - cum_pos + pos) / (tot_pos - cum_pos + pos + tot_neg - cum_neg + neg))) AS steps,
               max(abs(bad_share - good_share)) AS ks FROM shares GROUP BY 1),
    confusion AS (
        SELECT grp, count(*) FILTER (score >= {threshold} AND y = 1) AS tp, count(*) FILTER (score >= {threshold} AND y = 0) AS fp,
               count(*) FILTER (score < {threshold} AND y = 1) AS fn, count(*) FILTER (score < {threshold} AND y = 0) AS tn
        FROM rows_ GROUP BY 1),
    at_threshold AS (
        SELECT *, tp / greatest(tp + fn, 1) AS recall, tp / greatest(tp + fp, 1) AS precision,
               coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
               coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
                   / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0.0) AS mcc
        FROM confusion),
    bundle AS (
        SELECT grp, CASE WHEN p > 0 AND n > 0 THEN pairs / (CAST(p AS DOUBLE) * n) END AS auc,
               CASE WHEN p > 0 AND n > 0 THEN steps / p END AS auprc, ks,
               CASE WHEN p > 0 AND n > 0 THEN 2 * pairs / (CAST(p AS DOUBLE) * n) - 1 END AS gini,
               p / (p + n) AS positive_rate, tp, fp, fn, tn, recall, precision, f1, mcc
        FROM ranked JOIN at_threshold USING (grp))"""


# --------------------------------------------------------------------------- documents
def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


def bucket(token: str) -> str:
    return f"CAST('0x' || substr(md5({token}), 1, 2) AS INTEGER)"


USER_TURNS = """
    user_turns AS (SELECT conv_id * 1000000 + turn AS query_id, text AS question
                    FROM conversations WHERE role = 'user')"""

PASSAGES = "passages AS (SELECT item_id AS query_id, text AS question FROM benchmark)"

GOLD = """gold AS (SELECT DISTINCT item_id AS query_id, CAST(doc_id AS VARCHAR) AS source
             FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

WHOLE_DOCUMENTS = """
    corpus AS (SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) AS source, doc_id AS corpus_order,
                      0 AS ordinal, text FROM documents)"""


def chunks(crawl: bool = False) -> str:
    """CTEs ending in ``corpus`` with the chunks; the statement must start WITH RECURSIVE."""
    # end of the last boundary in the window: the window without what follows that boundary
    tail = r"string_split_regex(substr(t, b + 1, 800), '[.!?]\s|\n\n')"
    at = f"(800 - length(list_last({tail})))"
    accept = f"len({tail}) > 1" + ("" if crawl else f" AND {at} > 150")
    return rf"""
    cleaned AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\n{{3,}}', chr(10) || chr(10), 'g'),
                       '^\s+|\s+$', '', 'g') AS t FROM documents),
    begins AS (
        SELECT doc_id, t, 0 AS step, CAST(0 AS BIGINT) AS b FROM cleaned WHERE length(t) > 0
        UNION ALL
        SELECT doc_id, t, step + 1, greatest(e - 150, b + 1) FROM (
            SELECT *, CASE WHEN b + 800 >= length(t) THEN length(t) WHEN {accept} THEN b + {at} ELSE b + 800 END AS e
            FROM begins) WHERE e < length(t)),
    spans AS (
        SELECT doc_id, step, t, b,
               CASE WHEN b + 800 >= length(t) THEN length(t) WHEN {accept} THEN b + {at} ELSE b + 800 END AS e FROM begins),
    pieces AS (SELECT doc_id, step, regexp_replace(substr(t, b + 1, e - b), '^\s+|\s+$', '', 'g') AS text FROM spans),
    numbered AS (SELECT doc_id, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY step) - 1 AS INTEGER) AS ordinal
                 FROM pieces WHERE text <> ''),
    corpus AS (SELECT doc_id || '::' || ordinal AS id, CAST(doc_id AS VARCHAR) AS source, doc_id AS corpus_order,
                      ordinal, text FROM numbered)"""


def sparse_hits(asked: str, query: str, name: str = "hits", k: int = 4) -> str:
    """CTEs ending in ``name``: (query_id, rank, score, id, source, text), cosine over hash buckets."""
    return f"""
    {name}_qb AS (SELECT query_id, {bucket('w')} AS bucket, count(*) AS n FROM (
                      SELECT query_id, unnest({tokens(query)}) AS w FROM {asked}) GROUP BY 1, 2),
    {name}_cb AS (SELECT corpus_order, ordinal, {bucket('w')} AS bucket, count(*) AS n FROM (
                      SELECT corpus_order, ordinal, unnest({tokens('text')}) AS w FROM corpus) GROUP BY 1, 2, 3),
    {name}_qn AS (SELECT query_id, sum(n * n) AS s FROM {name}_qb GROUP BY 1),
    {name}_cn AS (SELECT corpus_order, ordinal, sum(n * n) AS s FROM {name}_cb GROUP BY 1, 2),
    {name}_dot AS (SELECT query_id, corpus_order, ordinal, sum(q.n * c.n) AS dot
                   FROM {name}_qb q JOIN {name}_cb c USING (bucket) GROUP BY 1, 2, 3),
    {name}_scored AS (
        SELECT a.query_id, c.corpus_order, c.ordinal, c.id, c.source, c.text,
               coalesce(round(dot / sqrt(CAST(qn.s * cn.s AS DOUBLE)), 9), 0.0) AS score
        FROM {asked} a CROSS JOIN corpus c
        LEFT JOIN {name}_dot d ON d.query_id = a.query_id AND d.corpus_order = c.corpus_order AND d.ordinal = c.ordinal
        LEFT JOIN {name}_qn qn ON qn.query_id = a.query_id
        LEFT JOIN {name}_cn cn ON cn.corpus_order = c.corpus_order AND cn.ordinal = c.ordinal),
    {name} AS (
        SELECT query_id, CAST(r AS INTEGER) AS rank, score, id, source, corpus_order, ordinal, text FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_order, ordinal) AS r
            FROM {name}_scored) WHERE r <= {k})"""


def lexical_hits(asked: str, query: str, name: str = "hits", k: int = 4) -> str:
    return f"""
    {name}_q AS (SELECT query_id, w, count(*) AS times FROM (
                     SELECT query_id, unnest({tokens(query)}) AS w FROM {asked}) GROUP BY 1, 2),
    {name}_c AS (SELECT corpus_order, ordinal, w, count(*) AS tf FROM (
                     SELECT corpus_order, ordinal, unnest({tokens('text')}) AS w FROM corpus) GROUP BY 1, 2, 3),
    {name}_idf AS (SELECT w, ln((max(n) + 1) / (count(*) + 1)) + 1 AS idf
                   FROM {name}_c, (SELECT count(*) AS n FROM corpus) GROUP BY w),
    {name}_sum AS (SELECT query_id, corpus_order, ordinal, round(sum(tf * times * idf), 9) AS score
                   FROM {name}_q JOIN {name}_c USING (w) JOIN {name}_idf USING (w) GROUP BY 1, 2, 3),
    {name} AS (
        SELECT query_id, CAST(r AS INTEGER) AS rank, score, id, source, corpus_order, ordinal, text FROM (
            SELECT a.query_id, c.*, coalesce(s.score, 0.0) AS score, row_number() OVER (
                PARTITION BY a.query_id ORDER BY coalesce(s.score, 0.0) DESC, c.corpus_order, c.ordinal) AS r
            FROM {asked} a CROSS JOIN corpus c
            LEFT JOIN {name}_sum s ON s.query_id = a.query_id AND s.corpus_order = c.corpus_order
                                  AND s.ordinal = c.ordinal) WHERE r <= {k})"""


def attempt(asked: str, hits: str, name: str) -> str:
    """CTEs ``<name>_kept``, ``<name>_answers`` and ``<name>``: one grade-answer-grade pass over ``hits``."""
    return rf"""
    {name}_graded AS (
        SELECT h.*, a.question, len(list_intersect({tokens('a.question')}, {tokens('h.text')})) AS overlap
        FROM {hits} h JOIN {asked} a USING (query_id)),
    {name}_kept AS (
        SELECT *, n_relevant = 0 AS weak FROM (
            SELECT *, CAST(count(*) FILTER (overlap >= 2) OVER (PARTITION BY query_id) AS INTEGER) AS n_relevant
            FROM {name}_graded) WHERE overlap >= 2 OR n_relevant = 0),
    {name}_sent AS (
        SELECT query_id, rank, question, text, unnest(parts) AS sentence, unnest(range(len(parts))) AS pos FROM (
            SELECT *, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts
            FROM {name}_kept)),
    {name}_best AS (
        SELECT query_id, sentence, row_number() OVER (PARTITION BY query_id ORDER BY
               len(list_intersect({tokens('question')}, {tokens('sentence')}))
               / (len(list_distinct({tokens('sentence')})) + 1) DESC, rank, pos) AS r FROM {name}_sent),
    {name}_context AS (
        SELECT query_id, list_distinct(flatten(list({tokens('text')}))) AS words, arg_min(substr(text, 1, 300), rank) AS head,
               string_agg(source, ',' ORDER BY rank) AS sources, bool_or(weak) AS weak, max(n_relevant) AS n_relevant
        FROM {name}_kept GROUP BY 1),
    {name}_answers AS (
        SELECT query_id, words, sources, weak, n_relevant,
               CASE WHEN regexp_replace(sentence, '^\s+|\s+$', '', 'g') <> ''
                    THEN regexp_replace(sentence, '^\s+|\s+$', '', 'g') ELSE head END AS answer
        FROM {name}_best JOIN {name}_context USING (query_id) WHERE r = 1),
    {name} AS (
        SELECT query_id, answer, sources, weak, n_relevant,
               CASE WHEN len({tokens('answer')}) = 0 THEN 0.0
                    ELSE len(list_intersect({tokens('answer')}, words)) / len(list_distinct({tokens('answer')})) END AS support,
               support >= 0.5 AND NOT contains(lower(answer), 'cannot find') AS grounded
        FROM {name}_answers)"""
