"""The same queries in DuckDB SQL: shared views as CTEs, one final select per query."""

from __future__ import annotations

from paywatch.settings import FEATURE_COLUMNS

# name -> (CTEs it reads, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {}
ORACLES: dict[str, str] = {}


def view(name: str, needs: list[str], sql: str) -> None:
    VIEWS[name] = (needs, sql)


def oracle(name: str, needs: list[str], select: str) -> None:
    ordered: list[str] = []

    def add(part: str) -> None:
        for inner in VIEWS[part][0]:
            add(inner)
        if part not in ordered:
            ordered.append(part)

    for need in needs:
        add(need)
    ctes = ",\n".join(f"{part} AS ({VIEWS[part][1]})" for part in ordered)
    ORACLES[name] = f"WITH RECURSIVE {ctes}\n{select}" if ordered else select


PROPS_K = "regexp_extract(props, '([0-9]+)', 1)"

view(
    "txn",
    [],
    f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 289 <> 0 THEN 'A' || CAST(user_id AS VARCHAR) END AS account_id,
    CASE WHEN event_id % 23 <> 0 THEN 'M' || {PROPS_K} END AS merchant_id,
    value AS amount, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    CAST(event_type = 'error' AS INTEGER) AS is_fraud, ts FROM events""",
)
view(
    "keyed",
    ["txn"],
    """SELECT *, coalesce(nullif(trim(user_id), ''), nullif(trim(account_id), '')) AS uk,
    nullif(trim(merchant_id), '') AS mk, CAST(timestamp AS TIMESTAMP) AS et,
    CAST(hour(CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS transaction_hour,
    CAST(dayofweek(CAST(timestamp AS TIMESTAMP)) + 1 AS INTEGER) AS transaction_day_of_week,
    CASE WHEN amount >= 100 THEN 1 ELSE 0 END AS is_high_amount FROM txn""",
)
view(
    "win",
    ["keyed"],
    """SELECT k.*, time_bucket(INTERVAL 5 MINUTE, et) - o * INTERVAL 5 MINUTE AS window_start,
    time_bucket(INTERVAL 5 MINUTE, et) - o * INTERVAL 5 MINUTE + INTERVAL 10 MINUTE AS window_end
    FROM keyed k, (VALUES (0), (1)) v(o) WHERE et IS NOT NULL""",
)
view(
    "uagg",
    ["win"],
    """SELECT window_start, window_end, uk, count(*) AS transaction_count_per_user, sum(amount) AS total_amount_per_user,
    avg(amount) AS avg_amount_per_user FROM win WHERE uk IS NOT NULL GROUP BY ALL""",
)
view(
    "magg",
    ["win"],
    "SELECT window_start, window_end, mk, count(*) AS transaction_count_per_merchant FROM win WHERE mk IS NOT NULL GROUP BY ALL",
)
view(
    "wenr",
    ["win", "uagg", "magg"],
    """SELECT w.*, u.transaction_count_per_user, u.total_amount_per_user, u.avg_amount_per_user, m.transaction_count_per_merchant
    FROM win w LEFT JOIN uagg u ON w.window_start = u.window_start AND w.uk = u.uk
    LEFT JOIN magg m ON w.window_start = m.window_start AND w.mk = m.mk""",
)
view(
    "hist",
    ["keyed"],
    """SELECT uk, count(amount) AS historical_transaction_count, avg(amount) AS historical_avg_amount,
    sum(amount) AS historical_total_amount, max(amount) AS historical_max_amount FROM keyed WHERE uk IS NOT NULL GROUP BY uk""",
)
view("enr", ["wenr", "hist"], "SELECT w.*, h.* EXCLUDE (uk) FROM wenr w LEFT JOIN hist h ON w.uk = h.uk")
view(
    "rated",
    ["enr"],
    """SELECT *, -3.0 + 0.02 * amount + 0.5 * (coalesce(transaction_count_per_user, 0) - 1) + 0.3 * is_high_amount AS odds,
    coalesce(amount / nullif(historical_avg_amount, 0.0) - 1.0, 0.0) AS above FROM enr""",
)
view(
    "scored0",
    ["rated"],
    """SELECT * EXCLUDE (odds, above), round(1.0 / (1.0 + exp(-odds)), 6) AS fraud_probability,
    round(above / (1.0 + abs(above)), 6) AS anomaly_score FROM rated""",
)
view(
    "scored",
    ["scored0"],
    """SELECT *, CASE WHEN fraud_probability >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction,
    CASE WHEN anomaly_score >= 0.7 THEN 1 ELSE 0 END AS is_anomaly, 'customer:' || uk AS src, 'merchant:' || mk AS dst FROM scored0""",
)
view(
    "edge",
    ["scored"],
    """SELECT * FROM (SELECT src, dst, transaction_id, amount, timestamp, fraud_probability, anomaly_score,
    row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp, src, dst, amount, fraud_probability, anomaly_score) AS rn
    FROM scored WHERE src IS NOT NULL AND dst IS NOT NULL) WHERE rn = 1""",
)
view("pair", ["edge"], "SELECT src, dst, count(*) AS n FROM edge GROUP BY ALL")
view(
    "node",
    ["scored"],
    """SELECT DISTINCT src AS node_id, 'customer' AS node_type, substring(src, 10) AS entity_id FROM scored WHERE dst IS NOT NULL AND src IS NOT NULL
    UNION ALL SELECT DISTINCT dst, 'merchant', substring(dst, 10) FROM scored WHERE src IS NOT NULL AND dst IS NOT NULL""",
)
view(
    "rankbase",
    ["pair", "node"],
    "SELECT 1.0 / ((SELECT count(*) FROM node) + 0.85 * (SELECT count(DISTINCT src) FROM pair)) AS b",
)
view(
    "rank",
    ["pair", "rankbase", "node"],
    """SELECT node_id, b AS pagerank_score FROM node, rankbase WHERE node_id NOT IN (SELECT dst FROM pair)
    UNION ALL SELECT dst, min(b) * (1.0 + 0.85 * sum(n / w)) FROM pair
    JOIN (SELECT src AS s, sum(n) AS w FROM pair GROUP BY src) ON src = s, rankbase GROUP BY dst""",
)
view(
    "reach",
    ["pair"],
    """SELECT DISTINCT src AS a, src AS b FROM pair UNION
    SELECT r.a, q.src FROM reach r JOIN pair p ON r.b = p.src JOIN pair q ON p.dst = q.dst""",
)
view(
    "comp",
    ["pair", "reach", "node"],
    """SELECT node_id, node_id AS component_id FROM node WHERE node_id NOT IN (SELECT src FROM pair UNION SELECT dst FROM pair)
    UNION ALL SELECT a AS node_id, min(b) AS component_id FROM reach GROUP BY a
    UNION ALL SELECT dst, min(c) FROM pair JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON src = a GROUP BY dst""",
)
view("compsize", ["comp"], "SELECT component_id, count(*) AS component_size FROM comp GROUP BY component_id")
view(
    "erisk",
    ["edge"],
    """SELECT *, least(1.0, greatest(0.0, 0.7 * least(1.0, greatest(0.0, coalesce(fraud_probability, 0.0)))
    + 0.3 * least(1.0, greatest(0.0, coalesce(anomaly_score, 0.0) / (1.0 + abs(coalesce(anomaly_score, 0.0))))))) AS edge_risk FROM edge""",
)
view(
    "expo",
    ["erisk"],
    """SELECT node_id, least(1.0, greatest(0.0, avg(edge_risk))) AS exposure FROM
    (SELECT src AS node_id, edge_risk FROM erisk UNION ALL SELECT dst, edge_risk FROM erisk) GROUP BY node_id""",
)
view(
    "own",
    ["node", "expo", "rank", "comp", "compsize"],
    """SELECT n.node_id, pagerank_score, component_id, component_size, least(1.0, greatest(0.0, 0.55 * coalesce(exposure, 0.0)
    + 0.20 * pagerank_score / (1.0 + pagerank_score) + 0.10 * component_size / (1.0 + component_size))) AS base_risk
    FROM node n LEFT JOIN expo USING (node_id) LEFT JOIN rank USING (node_id) LEFT JOIN comp USING (node_id) LEFT JOIN compsize USING (component_id)""",
)
view(
    "spread",
    ["own", "pair"],
    """SELECT o.node_id, least(1.0, greatest(0.0, coalesce(0.7 * o.base_risk + 0.3 * avg(m.base_risk), o.base_risk))) AS propagated_risk_score
    FROM own o LEFT JOIN (SELECT src AS a, dst AS b FROM pair UNION ALL SELECT dst, src FROM pair) ON o.node_id = a
    LEFT JOIN own m ON m.node_id = b GROUP BY o.node_id, o.base_risk""",
)
view("signal", ["own", "spread"], "SELECT * FROM own JOIN spread USING (node_id)")
view(
    "attached",
    ["scored", "signal"],
    """SELECT s.*, coalesce(c.pagerank_score, 0.0) AS pagerank_score, coalesce(c.component_id, m.component_id) AS component_id,
    coalesce(greatest(c.component_size, m.component_size), 0) AS component_size,
    coalesce(greatest(c.propagated_risk_score, m.propagated_risk_score), 0.0) AS propagated_risk_score
    FROM scored s LEFT JOIN signal c ON s.src = c.node_id LEFT JOIN signal m ON s.dst = m.node_id""",
)
view(
    "ruled",
    ["attached"],
    """SELECT *, nullif(concat_ws(', ', CASE WHEN fraud_probability >= 0.8 THEN 'fraud_probability' END,
    CASE WHEN anomaly_score >= 0.7 THEN 'anomaly_score' END,
    CASE WHEN propagated_risk_score >= 0.22 THEN 'propagated_risk_score' END), '') AS alert_reason,
    CAST(fraud_probability >= 0.8 AS INTEGER) + CAST(anomaly_score >= 0.7 AS INTEGER) + CAST(propagated_risk_score >= 0.22 AS INTEGER) AS hits
    FROM attached""",
)
view(
    "judged",
    ["ruled"],
    """SELECT *, alert_reason IS NOT NULL AS alert_triggered, CASE WHEN hits = 0 THEN NULL WHEN hits >= 2 THEN 'High'
    WHEN fraud_probability >= 0.8 OR propagated_risk_score >= 0.22 THEN 'Medium' ELSE 'Low' END AS alert_severity FROM ruled""",
)
BATCH = "CASE WHEN timestamp < '2024-01-11' THEN 1 WHEN timestamp < '2024-01-21' THEN 2 ELSE 3 END"
FIRST = "row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp, fraud_probability, anomaly_score, propagated_risk_score) AS rn"
view("audit", ["judged"], f"SELECT *, {BATCH} AS batch FROM (SELECT *, {FIRST} FROM judged) WHERE rn = 1")
view(
    "raised",
    ["judged"],
    f"""SELECT *, '2024-02-0' || {BATCH} || 'T00:00:00+00:00' AS received_at FROM
    (SELECT *, {FIRST} FROM judged WHERE alert_triggered) WHERE rn = 1""",
)
view(
    "board",
    ["audit"],
    """SELECT * EXCLUDE (alert_severity, alert_reason), CASE WHEN fraud_prediction = 1 THEN 'High' ELSE 'Low' END AS alert_severity,
    CASE WHEN fraud_prediction = 1 THEN 'High anomaly score' ELSE 'Normal activity' END AS alert_reason FROM audit""",
)
view(
    "orders_txn",
    [],
    """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(l_suppkey AS VARCHAR) AS merchant_id, l_extendedprice AS amount, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS timestamp,
    l_shipdate AS et FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
SPACES = "' ' || chr(9) || chr(10) || chr(13)"
view(
    "raw",
    [],
    f"""SELECT CASE WHEN event_id % 101 = 0 THEN '   ' ELSE ' ' || CAST(event_id AS VARCHAR) || chr(9) END AS transaction_id,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN ' ' || chr(10) ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 289 <> 0 THEN 'A' || CAST(user_id AS VARCHAR) || ' ' END AS account_id,
    'M' || {PROPS_K} AS merchant_id,
    CASE WHEN event_id % 29 = 0 THEN 'abc' WHEN event_id % 31 = 0 THEN '-' || CAST(value AS VARCHAR) WHEN event_id % 37 <> 0 THEN CAST(value AS VARCHAR) END AS amount,
    CASE WHEN event_id % 41 = 0 THEN 'not a date' WHEN event_id % 43 = 0 THEN strftime(ts, '%-m/%-d/%Y') WHEN event_id % 47 = 0 THEN ''
    WHEN event_id % 53 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN event_id % 59 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
    WHEN event_id % 61 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
    CASE WHEN event_id % 67 = 0 THEN 'soon' WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS settle_date FROM events""",
)


def parsed(column: str) -> str:
    bare = f"regexp_replace({column}, '[+]02:00$', '')"
    return f"coalesce(try_cast({bare} AS TIMESTAMP), try_strptime({bare}, '%m/%d/%Y'))"


def iso(column: str) -> str:
    suffix = f"CASE WHEN {column} LIKE '%+02:00' THEN '+02:00' ELSE '' END"
    return f"replace(strftime({parsed(column)}, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || {suffix}"


view(
    "checked",
    ["raw"],
    f"""SELECT nullif(trim(transaction_id, {SPACES}), '') AS transaction_id, nullif(trim(user_id, {SPACES}), '') AS user_id,
    nullif(trim(account_id, {SPACES}), '') AS account_id, nullif(trim(merchant_id, {SPACES}), '') AS merchant_id,
    amount AS raw_amount, try_cast(amount AS DOUBLE) AS amount, timestamp AS raw_timestamp, {iso('timestamp')} AS timestamp,
    settle_date AS raw_settle_date, {iso('settle_date')} AS settle_date FROM raw""",
)
view(
    "reasoned",
    ["checked"],
    """SELECT *, CASE WHEN raw_amount IS NOT NULL AND amount IS NULL THEN 'amount must be numeric'
    WHEN amount < 0 THEN 'amount must be greater than or equal to 0' END AS amount_error,
    CASE WHEN raw_timestamp IS NOT NULL AND timestamp IS NULL THEN 'timestamp must be parseable' END AS t_error,
    CASE WHEN raw_settle_date IS NOT NULL AND settle_date IS NULL THEN 'settle_date must be parseable' END AS s_error,
    CASE WHEN transaction_id IS NULL THEN 'transaction_id cannot be null or empty' WHEN raw_amount IS NULL THEN 'amount is required' END AS early,
    CASE WHEN user_id IS NULL AND account_id IS NULL THEN 'user_id or account_id is required' END AS late FROM checked""",
)
view(
    "verdict",
    ["reasoned"],
    """SELECT *, coalesce('amount: Value error, ' || amount_error, 'timestamp: Value error, ' || t_error, s_error, early, amount_error, late)
    AS reject_reason FROM reasoned""",
)

# --- sources and sinks
oracle(
    "scan_transactions",
    ["txn"],
    "SELECT transaction_id, user_id, account_id, merchant_id, amount, timestamp, is_fraud FROM txn",
)
KEY = "coalesce(nullif(user_id, ''), nullif(account_id, ''), nullif(transaction_id, ''), 'unknown-key')"
oracle(
    "parse_json_payload",
    ["txn"],
    f"""SELECT {KEY} AS kafka_key, TIMESTAMP '2024-02-01 00:00:00' AS kafka_timestamp, transaction_id, user_id, account_id, merchant_id,
    amount, timestamp, CAST(is_fraud AS VARCHAR) AS payload_is_fraud FROM txn""",
)
oracle(
    "alert_messages",
    ["judged"],
    """SELECT transaction_id AS key, transaction_id, user_id, account_id, merchant_id, amount, timestamp, fraud_probability, anomaly_score,
    round(propagated_risk_score, 6) AS propagated_risk_score, alert_reason, alert_severity,
    '2024-02-01T00:00:00+00:00' AS alert_timestamp, true AS alert_triggered FROM judged WHERE alert_triggered""",
)
TRUTHY = "event_id % 11 <> 0 AND event_id % 7 IN (0, 1, 2)"
oracle(
    "decode_alerts",
    [],
    f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS account_id,
    CAST(NULL AS VARCHAR) AS merchant_id, CASE WHEN event_id % 5 IN (0, 1) THEN value END AS amount, CAST(NULL AS VARCHAR) AS timestamp,
    CAST(NULL AS DOUBLE) AS fraud_probability, CAST(NULL AS DOUBLE) AS anomaly_score, CAST(NULL AS DOUBLE) AS propagated_risk_score,
    'fraud_probability' AS alert_reason, CAST(NULL AS VARCHAR) AS alert_severity FROM events WHERE {TRUTHY}""",
)
OVERLAP = "CASE WHEN timestamp < '2024-01-21' THEN 1 ELSE 2 END"
oracle(
    "upsert_scored",
    ["audit"],
    f"""SELECT transaction_id, amount, fraud_probability, fraud_prediction, is_anomaly, CAST(alert_triggered AS INTEGER) AS alert_triggered,
    CAST({OVERLAP} AS BIGINT) AS batch_id, '2024-02-0' || {OVERLAP} || 'T00:00:00+00:00' AS processed_at FROM audit""",
)
oracle(
    "upsert_alerts",
    ["raised"],
    f"""SELECT transaction_id, amount, fraud_probability, alert_reason, alert_severity, CAST({OVERLAP} AS BIGINT) AS batch_id,
    '2024-02-0' || {OVERLAP} || 'T00:00:00+00:00' AS received_at FROM raised""",
)
oracle(
    "ingest_alert_messages",
    [],
    f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS merchant_id,
    CASE WHEN event_id % 5 IN (0, 1) THEN value END AS amount, 'fraud_probability' AS alert_reason, CAST(NULL AS VARCHAR) AS community_id,
    CAST(NULL AS BIGINT) AS batch_id, '2024-02-01T00:00:00+00:00' AS received_at FROM events WHERE {TRUTHY}""",
)

# --- validation and scalar rules
oracle(
    "normalize_values",
    [],
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ship_date, CAST(l_quantity AS DOUBLE) AS quantity,
    CASE WHEN l_discount <> 0 THEN l_discount END AS discount, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ship_time_text FROM lineitem""",
)
oracle("normalize_identifiers", ["checked"], "SELECT transaction_id, user_id, account_id, merchant_id FROM checked")
oracle(
    "validate_amount",
    ["raw", "reasoned"],
    f"""SELECT CASE WHEN transaction_id IS NULL THEN '   ' ELSE ' ' || transaction_id || chr(9) END AS transaction_id, amount, amount_error FROM reasoned""",
)
oracle(
    "normalize_timestamps",
    ["reasoned"],
    """SELECT CASE WHEN transaction_id IS NULL THEN '   ' ELSE ' ' || transaction_id || chr(9) END AS transaction_id, timestamp, settle_date,
    coalesce(t_error, s_error) AS time_error FROM reasoned""",
)
oracle(
    "validate_core_rules",
    ["reasoned"],
    """SELECT CASE WHEN transaction_id IS NULL THEN '   ' ELSE ' ' || transaction_id || chr(9) END AS transaction_id,
    coalesce(early, amount_error, late) AS rule_error FROM reasoned""",
)
oracle(
    "validation_split",
    ["verdict"],
    """SELECT transaction_id, user_id, account_id, merchant_id, amount, coalesce(timestamp, raw_timestamp) AS timestamp,
    coalesce(settle_date, raw_settle_date) AS settle_date, reject_reason FROM verdict""",
)
oracle(
    "validation_counts",
    ["verdict"],
    """SELECT count(*) AS total_records_read, count(*) FILTER (reject_reason IS NULL) AS valid_records,
    count(*) FILTER (reject_reason IS NOT NULL) AS invalid_records FROM verdict""",
)
oracle("partition_key", ["txn"], f"SELECT transaction_id, {KEY} AS partition_key FROM txn")
oracle("user_key", ["keyed"], "SELECT transaction_id, uk AS user_key FROM keyed")
oracle("merchant_key", ["keyed"], "SELECT transaction_id, mk AS merchant_key FROM keyed")
oracle("event_time", ["keyed"], "SELECT transaction_id, et AS event_time FROM keyed")
oracle(
    "calendar_features",
    ["keyed"],
    "SELECT transaction_id, transaction_hour, transaction_day_of_week FROM keyed",
)
oracle(
    "high_amount_flag",
    ["orders_txn"],
    "SELECT transaction_id, amount, CASE WHEN amount >= 1000 THEN 1 ELSE 0 END AS is_high_amount FROM orders_txn",
)
feature_list = ", ".join(
    "0.0::DOUBLE AS historical_max_amount"
    if c == "historical_max_amount"
    else f"round(coalesce(CAST({c} AS DOUBLE), 0.0), {9 if 'avg' in c else 6}) AS {c}"
    for c in FEATURE_COLUMNS
)
oracle("feature_matrix", ["enr"], f"SELECT transaction_id, window_start, {feature_list} FROM enr")
oracle(
    "binary_target",
    [],
    """SELECT event_id, CASE event_type WHEN 'click' THEN ' Fraud ' WHEN 'error' THEN 'legit' WHEN 'purchase' THEN 'YES' WHEN 'signup' THEN '2'
    WHEN 'view' THEN '0' ELSE 'maybe' END AS fraud_label,
    CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 1 WHEN event_type IN ('error', 'view') THEN 0 END AS label FROM events""",
)

# --- windows
oracle("sliding_assign", ["win"], "SELECT transaction_id, window_start, window_end FROM win")
oracle(
    "user_window_agg",
    ["uagg"],
    """SELECT window_start, window_end, uk AS user_agg_key, transaction_count_per_user, round(total_amount_per_user, 6) AS total_amount_per_user,
    round(avg_amount_per_user, 6) AS avg_amount_per_user FROM uagg""",
)
view(
    "uneven",
    ["keyed"],
    """SELECT uk, amount, time_bucket(INTERVAL 3 MINUTE, et) - o * INTERVAL 3 MINUTE AS window_start, et
    FROM keyed, (VALUES (0), (1), (2), (3)) v(o) WHERE et IS NOT NULL AND uk IS NOT NULL""",
)
oracle(
    "user_window_agg_uneven",
    ["uneven"],
    """SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, uk AS user_agg_key, count(*) AS transaction_count_per_user,
    round(sum(amount), 6) AS total_amount_per_user FROM uneven WHERE et < window_start + INTERVAL 10 MINUTE GROUP BY ALL""",
)
view(
    "long_slots",
    ["keyed"],
    """SELECT k.*, time_bucket(INTERVAL 5 MINUTE, et) - o * INTERVAL 5 MINUTE AS window_start FROM keyed k, range(60) v(o) WHERE et IS NOT NULL""",
)
view(
    "long_users",
    ["long_slots"],
    """SELECT window_start, uk, count(*) AS n, round(sum(amount), 6) AS total FROM long_slots WHERE uk IS NOT NULL GROUP BY ALL""",
)
oracle(
    "user_window_agg_long",
    ["long_users"],
    """SELECT window_start, window_start + INTERVAL 5 HOUR AS window_end, uk AS user_agg_key, n AS transaction_count_per_user,
    total AS total_amount_per_user FROM long_users""",
)
view(
    "long_merchants",
    ["long_slots"],
    "SELECT window_start, mk, count(*) AS n FROM long_slots WHERE mk IS NOT NULL GROUP BY ALL",
)
oracle(
    "window_enrich_long",
    ["long_users", "long_merchants"],
    """SELECT s.transaction_id, s.window_start, s.window_start + INTERVAL 5 HOUR AS window_end, u.n AS transaction_count_per_user,
    u.total AS total_amount_per_user, m.n AS transaction_count_per_merchant
    FROM long_slots s LEFT JOIN long_users u ON s.window_start = u.window_start AND s.uk = u.uk
    LEFT JOIN long_merchants m ON s.window_start = m.window_start AND s.mk = m.mk""",
)
oracle("anomaly_share", ["win"], "SELECT count(*) AS n_rows, true AS share_kept FROM win")
view(
    "star",
    [],
    """SELECT DISTINCT 'O' || CAST(l_orderkey AS VARCHAR) AS hub, 'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS leaf
    FROM lineitem""",
)
oracle(
    "communities_stars",
    ["star"],
    """SELECT leaf AS node_id, min(leaf) OVER (PARTITION BY hub) AS community_id FROM star
    UNION ALL SELECT hub, min(leaf) FROM star GROUP BY hub""",
)
oracle(
    "merchant_window_agg",
    ["magg"],
    "SELECT window_start, window_end, mk AS merchant_agg_key, transaction_count_per_merchant FROM magg",
)
WINDOWED = """SELECT transaction_id, uk AS user_agg_key, mk AS merchant_agg_key, amount, transaction_hour, transaction_day_of_week, is_high_amount,
    window_start, window_end, transaction_count_per_user, round(total_amount_per_user, 6) AS total_amount_per_user,
    round(avg_amount_per_user, 6) AS avg_amount_per_user, transaction_count_per_merchant FROM wenr"""
oracle("window_enrich", ["wenr"], WINDOWED)
oracle(
    "stream_window_enrich",
    ["wenr"],
    f"{WINDOWED} WHERE window_end <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 30 MINUTE FROM events)",
)
oracle(
    "velocity",
    ["uagg"],
    "SELECT window_start, window_end, uk AS user_agg_key, transaction_count_per_user AS velocity FROM uagg",
)
oracle(
    "batch_summary",
    ["scored"],
    """SELECT count(*) AS records_processed, CAST(sum(is_anomaly) AS BIGINT) AS anomalies_detected,
    CAST(sum(fraud_prediction) AS BIGINT) AS fraud_predictions FROM scored""",
)

# --- history
HISTORY = """historical_transaction_count, round(historical_avg_amount, 9) AS historical_avg_amount,
    round(historical_total_amount, 6) AS historical_total_amount, historical_max_amount"""
oracle("historical_profile", ["hist"], f"SELECT uk AS historical_user_join_key, {HISTORY} FROM hist")
oracle(
    "historical_enrich",
    ["keyed", "hist"],
    f"SELECT transaction_id, k.uk AS historical_user_join_key, {HISTORY} FROM keyed k LEFT JOIN hist h ON k.uk = h.uk",
)
oracle(
    "training_features",
    ["orders_txn"],
    """SELECT transaction_id, amount, CAST(hour(et) AS INTEGER) AS transaction_hour, CAST(dayofweek(et) + 1 AS INTEGER) AS transaction_day_of_week,
    CAST(amount >= 1000 AS INTEGER)::DOUBLE AS is_high_amount, u.n AS transaction_count_per_user, u.m AS historical_max_amount,
    v.n AS transaction_count_per_merchant, u.n AS historical_transaction_count, round(u.s, 2) AS total_amount_per_user,
    round(u.a, 4) AS avg_amount_per_user FROM orders_txn t
    JOIN (SELECT user_id, count(amount) AS n, sum(amount) AS s, avg(amount) AS a, max(amount) AS m FROM orders_txn GROUP BY user_id) u USING (user_id)
    JOIN (SELECT merchant_id, count(*) AS n FROM orders_txn GROUP BY merchant_id) v USING (merchant_id)""",
)
oracle(
    "class_balance",
    ["txn"],
    """SELECT count(*) AS total_samples, count(*) FILTER (is_fraud = 1) AS positive_samples, count(*) FILTER (is_fraud = 0) AS negative_samples,
    CAST(0 AS BIGINT) AS unknown_labels,
    round(greatest(1.0, count(*) FILTER (is_fraud = 0) / count(*) FILTER (is_fraud = 1)), 6) AS scale_pos_weight FROM txn""",
)
view(
    "zscore",
    ["keyed"],
    """SELECT transaction_id, least(amount / 500.0, 1.0) AS model_score, coalesce(CASE WHEN sd > 0 THEN (amount - mean) / sd END, 0.0) AS z FROM keyed
    LEFT JOIN (SELECT uk AS u, avg(amount) AS mean, stddev_samp(amount) AS sd FROM keyed WHERE uk IS NOT NULL GROUP BY uk) ON uk = u""",
)
oracle(
    "zscore_score",
    ["zscore"],
    "SELECT transaction_id, round(z, 6) AS z_score, round(0.7 * model_score + 0.3 * least(abs(z), 3.0) / 3.0, 6) AS final_score FROM zscore",
)

# --- graph
oracle(
    "graph_edges",
    ["orders_txn"],
    """SELECT 'customer:' || user_id AS src, 'merchant:' || merchant_id AS dst, transaction_id AS edge_key, transaction_id, amount, timestamp,
    CAST(0.5 AS DOUBLE) AS fraud_probability, CAST(NULL AS DOUBLE) AS anomaly_score FROM
    (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp, 'customer:' || user_id, 'merchant:' || merchant_id, amount) AS rn
    FROM orders_txn) WHERE rn = 1""",
)
oracle("graph_nodes", ["node"], "SELECT node_id, node_type, entity_id FROM node")
view(
    "batches",
    ["scored"],
    """SELECT 1 AS batch_id, * FROM scored WHERE timestamp < '2024-01-21'
    UNION ALL SELECT 2, * FROM scored WHERE timestamp >= '2024-01-11'""",
)
view(
    "growth",
    ["batches"],
    """SELECT b AS batch_id,
    (SELECT count(DISTINCT n) FROM (SELECT src AS n, dst, batch_id FROM batches UNION ALL SELECT dst, src, batch_id FROM batches)
     WHERE batch_id <= b AND n IS NOT NULL AND dst IS NOT NULL) AS total_nodes,
    (SELECT count(DISTINCT transaction_id) FROM batches WHERE batch_id <= b AND src IS NOT NULL AND dst IS NOT NULL) AS total_edges
    FROM (VALUES (1), (2)) v(b)""",
)
oracle(
    "graph_update_stats",
    ["batches", "growth"],
    """SELECT batch_id, processed_rows, skipped_rows, total_nodes - coalesce(lag(total_nodes) OVER (ORDER BY batch_id), 0) AS new_nodes,
    total_edges - coalesce(lag(total_edges) OVER (ORDER BY batch_id), 0) AS new_edges, total_nodes, total_edges FROM growth
    JOIN (SELECT batch_id, count(*) AS processed_rows, count(*) FILTER (src IS NULL OR dst IS NULL) AS skipped_rows FROM batches GROUP BY batch_id)
    USING (batch_id)""",
)
oracle("pagerank", ["rank"], "SELECT node_id, round(pagerank_score, 9) AS pagerank_score FROM rank")
oracle("pagerank_power", ["rank"], "SELECT node_id, round(pagerank_score, 8) AS pagerank_score FROM rank")
oracle(
    "weighted_projection",
    ["edge"],
    """SELECT least(src, dst) AS node_a, greatest(src, dst) AS node_b, round(sum(coalesce(nullif(amount, 0.0), 1.0)), 6) AS weight
    FROM edge GROUP BY ALL""",
)
view(
    "link",
    [],
    """SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS c, 'S' || CAST(l_suppkey AS VARCHAR) AS s, 'P' || CAST(l_partkey AS VARCHAR) AS p
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
view(
    "closed",
    ["link"],
    """SELECT cs.c, cs.s, cp.p FROM (SELECT DISTINCT c, s FROM link) cs JOIN (SELECT DISTINCT c, p FROM link) cp ON cs.c = cp.c
    JOIN (SELECT DISTINCT s, p FROM link) sp ON sp.s = cs.s AND sp.p = cp.p""",
)
oracle(
    "triangles",
    ["link", "closed"],
    """SELECT node_id, count(t) AS triangle_count FROM (
    SELECT c AS node_id, 1 AS t FROM closed UNION ALL SELECT s, 1 FROM closed UNION ALL SELECT p, 1 FROM closed
    UNION ALL SELECT DISTINCT c, NULL FROM link UNION ALL SELECT DISTINCT s, NULL FROM link UNION ALL SELECT DISTINCT p, NULL FROM link)
    GROUP BY node_id""",
)
view(
    "visit",
    [],
    f"""SELECT DISTINCT 'customer:' || CAST(user_id AS VARCHAR) AS c,
    'merchant:M' || {PROPS_K} || '@' || CAST(epoch_us(ts) // 600000000 AS VARCHAR) AS m FROM events""",
)
view(
    "meet",
    ["visit"],
    """SELECT DISTINCT c AS a, c AS b FROM visit UNION
    SELECT r.a, q.c FROM meet r JOIN visit p ON r.b = p.c JOIN visit q ON p.m = q.m""",
)
view(
    "vcomp",
    ["visit", "meet"],
    """SELECT a AS node_id, min(b) AS component_id FROM meet GROUP BY a
    UNION ALL SELECT m, min(k) FROM visit JOIN (SELECT a, min(b) AS k FROM meet GROUP BY a) ON c = a GROUP BY m""",
)
oracle("connected_components", ["vcomp"], "SELECT node_id, component_id FROM vcomp")
oracle("component_sizes", ["vcomp"], "SELECT component_id, count(*) AS component_size FROM vcomp GROUP BY component_id")
oracle("edge_risk", ["erisk"], "SELECT transaction_id AS edge_key, round(edge_risk, 9) AS edge_risk FROM erisk")
oracle("node_exposure", ["expo"], "SELECT node_id, round(exposure, 6) AS exposure FROM expo")
oracle("base_risk", ["own"], "SELECT node_id, round(base_risk, 6) AS base_risk FROM own")
oracle(
    "risk_propagation",
    ["spread"],
    "SELECT node_id, round(propagated_risk_score, 6) AS propagated_risk_score FROM spread",
)
oracle(
    "attach_graph_signals",
    ["attached"],
    """SELECT transaction_id, window_start, round(pagerank_score, 9) AS pagerank_score, component_id AS community_id,
    CAST(0 AS BIGINT) AS triangle_count, component_id, component_size, round(propagated_risk_score, 6) AS propagated_risk_score FROM attached""",
)
oracle(
    "top_nodes",
    ["signal"],
    """SELECT * FROM (SELECT 'pagerank' AS ranking, node_id AS name, round(pagerank_score, 6) AS value FROM signal ORDER BY pagerank_score DESC, name LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'triangles', node_id, 0.0::DOUBLE FROM signal ORDER BY node_id LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'propagated_risk', node_id, round(propagated_risk_score, 6) FROM signal ORDER BY propagated_risk_score DESC, node_id LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'communities', component_id, count(*)::DOUBLE FROM signal GROUP BY component_id ORDER BY count(*) DESC, component_id LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'components', component_id, count(*)::DOUBLE FROM signal GROUP BY component_id ORDER BY count(*) DESC, component_id LIMIT 5)""",
)

# --- alerts
oracle("alert_rules", ["judged"], "SELECT transaction_id, window_start, alert_triggered, alert_reason FROM judged")
oracle("alert_severity", ["judged"], "SELECT transaction_id, window_start, alert_severity FROM judged")
oracle(
    "alert_batch_counts",
    ["judged"],
    """SELECT count(*) AS total_records, count(*) FILTER (alert_triggered) AS total_alerts, count(*) FILTER (alert_severity = 'Low') AS low_alerts,
    count(*) FILTER (alert_severity = 'Medium') AS medium_alerts, count(*) FILTER (alert_severity = 'High') AS high_alerts FROM judged""",
)

# --- investigation
oracle(
    "alerts_page",
    ["raised"],
    """SELECT transaction_id, amount, alert_reason, received_at, count(*) OVER () AS total FROM raised WHERE alert_severity = 'Medium'
    ORDER BY received_at DESC, transaction_id LIMIT 25 OFFSET 10""",
)
oracle(
    "alerts_next_page",
    ["raised"],
    """SELECT transaction_id, amount, alert_reason, received_at, count(*) OVER () AS total FROM raised WHERE alert_severity = 'Medium'
    ORDER BY received_at DESC, transaction_id LIMIT 25 OFFSET 10""",
)
oracle(
    "alert_by_id",
    ["raised"],
    "SELECT transaction_id, amount, fraud_probability, alert_severity FROM raised WHERE transaction_id = (SELECT min(transaction_id) FROM raised)",
)
oracle(
    "alert_metrics",
    ["raised"],
    """SELECT count(*) AS total_alerts, round(avg(fraud_probability), 6) AS avg_fraud_probability, round(avg(anomaly_score), 6) AS avg_anomaly_score,
    round(avg(propagated_risk_score), 6) AS avg_propagated_risk_score, count(*) FILTER (alert_severity = 'High') AS high_count,
    count(*) FILTER (alert_severity = 'Medium') AS medium_count, count(*) FILTER (alert_severity = 'Low') AS low_count,
    count(*) FILTER (alert_severity IS NULL) AS unknown_count FROM raised""",
)
oracle(
    "top_merchants",
    ["raised"],
    """SELECT merchant_id, count(*) AS alert_count FROM raised WHERE merchant_id IS NOT NULL GROUP BY merchant_id
    ORDER BY alert_count DESC, merchant_id LIMIT 5""",
)
oracle("scored_count", ["audit"], "SELECT count(*) AS total_scored_transactions FROM audit")
oracle(
    "dashboard_defaults",
    ["board"],
    """SELECT transaction_id, alert_severity, fraud_probability, anomaly_score, round(propagated_risk_score, 6) AS propagated_risk, alert_reason
    FROM board""",
)
oracle(
    "dashboard_filter",
    ["board"],
    """SELECT transaction_id, user_id, merchant_id, alert_severity, timestamp FROM board WHERE alert_severity = 'Low'
    AND regexp_matches(user_id, '[13]') AND merchant_id ILIKE '%m4%' AND et BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 12:00:00'""",
)
oracle(
    "kpis",
    ["board"],
    """SELECT count(*) AS total_alerts, CAST(0 AS BIGINT) AS critical_alerts, round(avg(fraud_probability), 3) AS mean_fraud_probability,
    round(avg(anomaly_score), 3) AS mean_anomaly_score, count(*) FILTER (alert_severity = 'High') AS high_risk_transactions,
    count(DISTINCT user_id) AS active_users FROM board""",
)
oracle(
    "severity_trend",
    ["board"],
    """SELECT strftime(et, '%b %d') AS day, count(*) AS "all", CAST(0 AS BIGINT) AS critical, count(*) FILTER (alert_severity = 'High') AS high,
    CAST(0 AS BIGINT) AS medium, count(*) FILTER (alert_severity = 'Low') AS low FROM board GROUP BY day ORDER BY day LIMIT 10""",
)
oracle(
    "severity_distribution",
    ["audit"],
    """SELECT name, count(transaction_id) AS value FROM (VALUES ('Critical'), ('High'), ('Medium'), ('Low')) v(name)
    LEFT JOIN audit ON alert_severity = name GROUP BY name""",
)
oracle(
    "top_reasons",
    ["raised"],
    "SELECT alert_reason AS reason, count(*) AS count FROM raised GROUP BY alert_reason ORDER BY count DESC, reason LIMIT 5",
)
oracle(
    "top_alerts",
    ["board"],
    """SELECT replace(strftime(et, '%Y-%m-%d %H:%M:%S.%f'), '.000000', '') AS time, transaction_id, user_id, merchant_id,
    '$' || printf('%,.2f', amount) AS amount, fraud_probability, anomaly_score, round(propagated_risk_score, 6) AS propagated_risk,
    alert_severity AS severity, alert_reason AS reason FROM board ORDER BY fraud_probability DESC, transaction_id LIMIT 50""",
)
oracle(
    "cluster_risk",
    ["signal"],
    "SELECT component_id, count(*) AS size, round(max(propagated_risk_score), 6) AS risk FROM signal GROUP BY component_id",
)
oracle(
    "risk_trend",
    ["audit"],
    "SELECT time_bucket(INTERVAL 5 MINUTE, et) AS window_start, round(avg(propagated_risk_score), 6) AS risk FROM audit GROUP BY 1",
)
oracle(
    "entity_risk_table",
    ["node", "signal"],
    """SELECT entity_id AS entity, CASE node_type WHEN 'customer' THEN 'User' ELSE 'Merchant' END AS type, round(propagated_risk_score, 6) AS risk,
    component_size, CAST(0 AS BIGINT) AS triangle_count, CASE WHEN propagated_risk_score >= 0.9 THEN 'Critical' WHEN propagated_risk_score >= 0.8 THEN 'High'
    WHEN propagated_risk_score >= 0.6 THEN 'Medium' ELSE 'Low' END AS severity
    FROM node JOIN signal USING (node_id) ORDER BY propagated_risk_score DESC, node_id LIMIT 6""",
)
oracle(
    "pipeline_latency",
    [],
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, round(avg(CAST({PROPS_K} AS DOUBLE)), 6) AS ingest_ms,
    round(avg(CAST(event_id % 37 AS DOUBLE)), 6) AS scoring_ms, round(avg(CAST(event_id % 53 AS DOUBLE)), 6) AS alerting_ms FROM events GROUP BY 1""",
)
view("dated", ["board"], "SELECT *, CAST(et AS DATE) AS d FROM board")
view("days", ["dated"], "SELECT DISTINCT d AS day FROM dated")


def _span(expression: str, low: int, high: int) -> str:
    return f"coalesce((SELECT {expression} FROM dated WHERE d BETWEEN day - {high} AND day - {low}), 0)"


def _delta(expression: str) -> str:
    return f"{_span(expression, 0, 6)} - {_span(expression, 7, 13)}"


oracle(
    "kpi_delta_7d",
    ["dated", "days"],
    f"""SELECT CAST(day AS VARCHAR) AS day, {_span('count(*)', 0, 6)} AS total_alerts, {_delta('count(*)')} AS total_alerts_delta, CAST(0 AS BIGINT) AS critical_alerts_delta,
    {_delta("count(*) FILTER (alert_severity = 'High')")} AS high_risk_delta, round({_delta('avg(fraud_probability)')}, 6) AS fraud_probability_delta,
    round({_delta('avg(anomaly_score)')}, 6) AS anomaly_score_delta, {_delta('count(DISTINCT user_id)')} AS active_users_delta FROM days""",
)
