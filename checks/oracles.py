"""SQL for DuckDB that computes each registered query another way.

The roll-ups number each customer's purchase days with windows and filter aggregates by that number,
and the purchase model has its hypergeometric form, so that both differ from the jobs.
"""

from __future__ import annotations

from checks.queries import (
    BAND,
    BASELINE,
    DURATION,
    EVENT_DURATION,
    LABEL_CUTOFF,
    PURCHASES,
    RATE,
    SPEND,
    SUFFIXES,
)

ORACLES: dict[str, str] = {}

VALID = """
    SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS day,
           CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount, o.o_orderkey AS txn_id,
           c.c_custkey AS consumer_id, n.n_nationkey AS brand_id,
           o.o_orderstatus AS currency, c.c_mktsegment AS channel
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name = 'AMERICA' AND c.c_acctbal > 0 AND o.o_totalprice > 0
      AND o.o_orderstatus IN ('F', 'O') AND o.o_orderpriority <> '5-LOW'
"""
ALL = """
    SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders WHERE o_totalprice > 0
"""
EVENTS = """
    SELECT user_id AS customer_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS amount
    FROM events WHERE event_type = 'purchase'
"""
JULY = ("1995-01-01", "2001-07-31", "2001-07-01")
JUNE = ("1995-01-01", "2001-06-30", "2001-06-01")
JANUARY = ("2024-01-01", "2024-01-31", "2024-01-01")


def purchases(source: str, months: tuple[str, str, str], name: str = "purchases") -> str:
    """A CTE with one row per customer and day: what was spent, the customer's how-manieth purchase
    day it is, and the latest day of anyone."""
    return f"""
    {name} AS (
        SELECT customer_id, day, SUM(amount) AS spent,
               ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY day) AS visit,
               MAX(MAX(day)) OVER () AS today
        FROM ({source}) WHERE day BETWEEN DATE '{months[0]}' AND DATE '{months[1]}'
        GROUP BY customer_id, day
        QUALIFY customer_id IS NOT NULL)
    """


def rollup(until: str) -> str:
    """Columns of one customer's purchase days before ``until``, which is a day."""
    kept = f"FILTER (WHERE day < {until})"
    again = f"FILTER (WHERE visit > 1 AND day < {until})"
    return f"""
        CAST(COUNT(*) {again} AS FLOAT) AS frequency,
        CAST(MAX(day) {kept} - MIN(day) AS FLOAT) AS recency,
        CAST(MAX({until}) - MIN(day) AS FLOAT) AS T,
        COALESCE(CAST(SUM(spent) {again} AS DOUBLE) / NULLIF(COUNT(*) {again}, 0), 0.0)
            AS monetary_value
    """


def later(duration: int) -> str:
    """Columns of one customer's purchase days in the holdout."""
    held = f"FILTER (WHERE day >= today - {duration})"
    return f"""
        CAST(COUNT(*) {held} AS FLOAT) AS frequency_holdout,
        CAST(SUM(spent) {held} AS DOUBLE) / NULLIF(COUNT(*) {held}, 0) AS monetary_value_holdout
    """


def training(source: str, months=JULY, duration: int = DURATION) -> str:
    """CTEs ending in ``train``, the training snapshot."""
    return f"""
    {purchases(source, months)},
    customers AS (SELECT customer_id, {rollup(f'(today - {duration})')}, {later(duration)}
                  FROM purchases GROUP BY customer_id
                  HAVING MIN(day) < MAX(today) - {duration}),
    train AS (SELECT DATE '{months[2]}' AS snapshot_dt, CAST(customer_id AS VARCHAR) AS CustomerID,
                     frequency AS frequency_cal, recency AS recency_cal, T AS T_cal,
                     monetary_value AS monetary_value_cal,
                     CAST(frequency_holdout AS DOUBLE) AS frequency_holdout,
                     COALESCE(monetary_value_holdout, 0.0) AS monetary_value_holdout,
                     CAST({duration} AS FLOAT) AS duration_holdout
              FROM customers)
    """


def full(months=JULY, name: str = "full_snap", prefix: str = "") -> str:
    """CTEs ending in ``name``, the full snapshot of all orders."""
    # "Before tomorrow" is the whole history; the tenure ends today.
    return f"""
    {purchases(ALL, months, prefix + 'purchases')},
    {name} AS (SELECT DATE '{months[2]}' AS snapshot_dt, CAST(customer_id AS VARCHAR) AS CustomerID,
                      * EXCLUDE (customer_id, T), CAST(T - 1 AS FLOAT) AS T
               FROM (SELECT customer_id, {rollup('(today + 1)')}
                     FROM {prefix}purchases GROUP BY customer_id))
    """


ORDERS = """
    SELECT o_orderkey AS txn_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS sale_dt,
           CAST(o_totalprice AS DOUBLE) AS amount, o_orderstatus AS currency,
           o_orderpriority AS change_code
    FROM orders
"""
PROFILES = """
    SELECT c_custkey AS consumer_id, r_name AS region, c_mktsegment AS model
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
TWO_FULL = f"WITH {full(JUNE, 'june', 'e_')}, {full(JULY, 'july')}"

# --- sources and sinks ------------------------------------------------------------------------

ORACLES["scan_transactions"] = ORDERS
ORACLES["clean_transactions"] = f"""
    SELECT customer_id, consumer_id, brand_id, day AS sale_dt, txn_id,
           CAST(amount AS DOUBLE) AS amount, currency, channel FROM ({VALID})
"""
ORACLES["snapshot_schema"] = f"""
    WITH {training(VALID)}
    SELECT unnest(['snapshot_dt', 'CustomerID', 'frequency_cal', 'recency_cal', 'T_cal',
                   'monetary_value_cal', 'frequency_holdout', 'monetary_value_holdout',
                   'duration_holdout']) AS column_name,
           unnest(['date', 'string', 'float', 'float', 'float', 'double', 'double', 'double',
                   'float']) AS data_type,
           unnest([COUNT(snapshot_dt), COUNT(CustomerID), COUNT(frequency_cal), COUNT(recency_cal),
                   COUNT(T_cal), COUNT(monetary_value_cal), COUNT(frequency_holdout),
                   COUNT(monetary_value_holdout), COUNT(duration_holdout)]) AS filled
    FROM train
"""
ORACLES["replace_snapshot"] = f"""
    {TWO_FULL} SELECT * FROM june UNION ALL SELECT * FROM july WHERE frequency > 0
"""
ORACLES["period_slice"] = f"""
    SELECT txn_id, customer_id, sale_dt FROM ({ORDERS})
    WHERE sale_dt > DATE '1999-12-31' AND sale_dt <= DATE '2000-12-31'
"""
ORACLES["period_view"] = f"""
    SELECT currency, COUNT(*) AS n FROM ({ORDERS})
    WHERE sale_dt > DATE '1999-12-31' AND sale_dt <= DATE '2000-12-31' GROUP BY currency
"""
ORACLES["feature_table_write"] = f"WITH {full()} SELECT * FROM full_snap"
ORACLES["csv_export"] = ORACLES["feature_table_write"]
ORACLES["run_metadata"] = f"""
    SELECT 'AMERICA' AS region, 'frequency' AS model, 'models:/clv_freq_final/1' AS model_uri,
           '1' AS model_version, 'plans/score' AS code_path,
           strftime(MAX(day), '%Y-%m-%d %H:%M:%S') AS inference_input_dt, 'c1' AS commit_id,
           '2001-08-01 10:30:00' AS written_at
    FROM ({ALL})
"""
ORACLES["lineage_gap"] = f"""
    SELECT region, model || '/' || strftime(sale_dt, '%Y-%m') AS model
    FROM ({ORDERS}) JOIN ({PROFILES}) ON customer_id = consumer_id
    GROUP BY ALL HAVING COUNT(*) FILTER (WHERE change_code = '1-URGENT') = 0
"""
ORACLES["model_latest"] = """
    WITH yearly AS (
        SELECT c_mktsegment AS name, year(o_orderdate) AS year, COUNT(*) AS orders,
               SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2)
    SELECT name, CAST(year - 1994 AS INTEGER) AS version,
           CAST(make_date(year, 12, 31) AS TIMESTAMP) AS trained_at,
           CAST(orders AS DOUBLE) AS orders, CAST(spend AS DOUBLE) AS spend
    FROM yearly WHERE year = (SELECT MAX(year) FROM yearly y WHERE y.name = yearly.name)
"""

FORECAST = f"""
    {training(ALL)},
    forecast AS (SELECT CustomerID, frequency_holdout, monetary_value_cal, monetary_value_holdout,
                        CAST(frequency_cal AS DOUBLE) / CAST(T_cal AS DOUBLE) * {DURATION} AS predicted,
                        CAST(recency_cal AS DOUBLE) / CAST(T_cal AS DOUBLE) AS score,
                        CAST(frequency_holdout > 0 AS INTEGER) AS alive,
                        CAST(CAST(recency_cal AS DOUBLE) / CAST(T_cal AS DOUBLE) > {LABEL_CUTOFF}
                             AS INTEGER) AS pred_alive
                 FROM train)
"""
ORACLES["metrics_log"] = f"""
    WITH {FORECAST}
    SELECT CASE WHEN alive = 1 THEN 'buyers' ELSE 'others' END AS run_name,
           ROUND(AVG(ABS(frequency_holdout - predicted)), 6) AS mae,
           ROUND(AVG((frequency_holdout - predicted) * (frequency_holdout - predicted)), 6) AS mse,
           CAST(COUNT(*) AS DOUBLE) AS rows
    FROM forecast GROUP BY 1
"""

# --- selection --------------------------------------------------------------------------------

ORACLES["txn_in_period"] = f"""
    SELECT txn_id, customer_id, sale_dt FROM ({ORDERS})
    WHERE sale_dt >= DATE '1995-01-01' AND sale_dt < DATE '2001-08-01'
"""
ORACLES["snapshot_slice"] = f"{TWO_FULL} SELECT * FROM june"
_suffixes = ", ".join(f"'{s}'" for s in SUFFIXES)
ORACLES["suffix_sample"] = f"""
    WITH {full()} SELECT * FROM full_snap WHERE right(CustomerID, 2) IN ({_suffixes})
"""
ORACLES["training_set"] = f"""
    WITH {training(ALL)} SELECT * FROM train
    WHERE snapshot_dt = DATE '2001-07-01' AND right(CustomerID, 2) IN ({_suffixes})
      AND frequency_cal < 12
"""
ORACLES["repeat_buyers"] = f"WITH {training(VALID)} SELECT * FROM train WHERE frequency_cal > 0"
ORACLES["dev_sample"] = f"""
    WITH {training(ALL)} SELECT * FROM train WHERE frequency_cal < 50 ORDER BY CustomerID LIMIT 100
"""
ORACLES["clamp_nonneg"] = """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS balance FROM customer
"""
ORACLES["spend_band"] = f"""
    WITH {training(ALL)} SELECT CustomerID, monetary_value_holdout FROM train
    WHERE monetary_value_holdout > 0 AND monetary_value_holdout <= {BAND}
"""
ORACLES["inference_input"] = f"{TWO_FULL} SELECT CustomerID, snapshot_dt FROM july"

# --- joins ------------------------------------------------------------------------------------

ORACLES["attach_current_dt"] = f"""
    WITH {purchases(VALID, JULY)}
    SELECT customer_id, day, CAST(spent AS DOUBLE) AS amount, today AS current_dt FROM purchases
"""
ORACLES["first_purchase_join"] = f"""
    WITH {purchases(ALL, JULY)}
    SELECT customer_id, day, CAST(spent AS DOUBLE) AS amount,
           MIN(day) OVER (PARTITION BY customer_id) AS first_at
    FROM purchases
"""
ORACLES["calibration_holdout"] = f"""
    WITH {training(VALID)}
    SELECT customer_id, frequency, recency, T, monetary_value,
           CAST(frequency_holdout AS DOUBLE) AS frequency_holdout,
           COALESCE(monetary_value_holdout, 0.0) AS monetary_value_holdout
    FROM customers
"""
ORACLES["feature_lookup"] = f"""
    WITH {full()}
    SELECT CAST(c_custkey AS VARCHAR) AS CustomerID, DATE '2001-07-01' AS snapshot_dt,
           frequency, recency, T, monetary_value
    FROM customer LEFT JOIN full_snap ON CustomerID = CAST(c_custkey AS VARCHAR)
"""
ORACLES["feature_loop"] = f"""
    SELECT *, TRUE AS cold_before, FALSE AS cold_after, TRUE AS exists FROM ({ORACLES["feature_lookup"]})
"""

# --- aggregates -------------------------------------------------------------------------------

ORACLES["daily_spend"] = f"""
    WITH {purchases(VALID, JULY)} SELECT customer_id, day, CAST(spent AS DOUBLE) AS amount FROM purchases
"""
ORACLES["daily_spend_events"] = f"""
    SELECT customer_id, day, CAST(SUM(amount) AS DOUBLE) AS amount FROM ({EVENTS})
    GROUP BY customer_id, day
"""
ORACLES["current_dt"] = f"""
    SELECT MAX(day) AS current_dt FROM ({VALID}) WHERE day BETWEEN DATE '{JULY[0]}' AND DATE '{JULY[1]}'
"""
ORACLES["first_purchase"] = f"""
    WITH {purchases(ALL, JULY)} SELECT customer_id, day AS first_at FROM purchases WHERE visit = 1
"""
ORACLES["rfm_calibration"] = f"""
    WITH {training(VALID)}
    SELECT customer_id, frequency, recency, T, monetary_value FROM customers
"""
ORACLES["rfm_holdout"] = f"""
    WITH {purchases(VALID, JULY)}
    SELECT customer_id, {later(DURATION)} FROM purchases GROUP BY customer_id
    HAVING COUNT(*) FILTER (WHERE day >= today - {DURATION}) > 0
"""
ORACLES["training_snapshot"] = f"WITH {training(VALID)} SELECT * FROM train"
ORACLES["training_snapshot_all"] = f"WITH {training(ALL)} SELECT * FROM train"
ORACLES["training_snapshot_events"] = (
    f"WITH {training(EVENTS, JANUARY, EVENT_DURATION)} SELECT * FROM train"
)
ORACLES["full_snapshot"] = ORACLES["feature_table_write"]
ORACLES["repeat_spend"] = f"""
    WITH {purchases(VALID, JULY)}
    SELECT customer_id, COALESCE(CAST(SUM(spent) FILTER (WHERE visit > 1) AS DOUBLE), 0.0)
           AS repeat_spend
    FROM purchases GROUP BY customer_id
"""
ORACLES["agg_col"] = "SELECT MAX(l_quantity) AS agg_col FROM lineitem"
ORACLES["latest_ts"] = "SELECT MAX(ts) AS agg_col FROM events"
ORACLES["duplicate_ratio"] = """
    SELECT COUNT(*) AS total_rows, COUNT(DISTINCT l_orderkey) AS unique_ids,
           ROUND(1 - COUNT(DISTINCT l_orderkey) / COUNT(*), 9) AS duplicate_ratio
    FROM lineitem
"""
ORACLES["dedup_guarded"] = f"""
    SELECT customer_id, sale_dt, txn_id, amount FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY sale_dt, txn_id, amount) AS rn
        FROM ({ORDERS}))
    WHERE rn = 1
"""
ORACLES["regression_metrics"] = f"""
    WITH {FORECAST}, e AS (SELECT frequency_holdout - predicted AS e FROM forecast)
    SELECT ROUND(AVG(ABS(e)), 6) AS mae, ROUND(AVG(e * e), 6) AS mse,
           ROUND(SQRT(AVG(e * e)), 6) AS rmse FROM e
"""
ORACLES["mape_spenders"] = f"""
    WITH {FORECAST}
    SELECT ROUND(AVG(ABS(monetary_value_holdout - monetary_value_cal)
                     / ABS(monetary_value_holdout)), 6) AS mape
    FROM forecast WHERE monetary_value_holdout > 0
"""
ORACLES["r2_band"] = f"""
    WITH {FORECAST},
    banded AS (SELECT monetary_value_holdout AS y, monetary_value_cal AS p,
                      AVG(monetary_value_holdout) OVER () AS mean
               FROM forecast WHERE monetary_value_holdout > 0 AND monetary_value_holdout <= {BAND})
    SELECT ROUND(1 - SUM((y - p) * (y - p)) / SUM((y - mean) * (y - mean)), 6) AS r2 FROM banded
"""


def auc(source: str, alive: str, score: str) -> str:
    """AUC from average ranks."""
    return f"""
    (SELECT (SUM(rnk) FILTER (WHERE y = 1) - SUM(y) * (SUM(y) + 1) / 2.0)
            / (SUM(y) * CAST(COUNT(*) - SUM(y) AS DOUBLE))
     FROM (SELECT {alive} AS y, RANK() OVER (ORDER BY {score})
                  + (COUNT(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS rnk
           FROM {source}))
    """


def youden(source: str, alive: str, score: str) -> str:
    return f"""
    (SELECT CASE WHEN MAX(j) > 0 THEN arg_max(s, (j, s)) ELSE CAST('inf' AS DOUBLE) END
     FROM (SELECT s, SUM(pos) OVER w * SUM(neg) OVER () - SUM(neg) OVER w * SUM(pos) OVER () AS j
           FROM (SELECT {score} AS s, SUM({alive}) AS pos, SUM(1 - {alive}) AS neg
                 FROM {source} GROUP BY 1)
           WINDOW w AS (ORDER BY s DESC)))
    """


ORACLES["roc_auc"] = (
    f"WITH {FORECAST} SELECT ROUND({auc('forecast', 'alive', 'score')}, 9) AS roc_auc"
)
ORACLES["youden_cutoff"] = (
    f"WITH {FORECAST} SELECT ROUND({youden('forecast', 'alive', 'score')}, 9) AS cutoff"
)


def report(source: str) -> str:
    """CTEs ending in ``lines``, one row per class, and ``cells``."""
    return f"""
    cells AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE alive = 1 AND pred_alive = 1) AS tp,
                     COUNT(*) FILTER (WHERE alive = 0 AND pred_alive = 1) AS fp,
                     COUNT(*) FILTER (WHERE alive = 1 AND pred_alive = 0) AS fn,
                     COUNT(*) FILTER (WHERE alive = 0 AND pred_alive = 0) AS tn FROM {source}),
    parts AS (SELECT '0' AS label, tn AS hit, tn + fn AS called, tn + fp AS support FROM cells
              UNION ALL SELECT '1', tp, tp + fp, tp + fn FROM cells),
    lines AS (SELECT label, COALESCE(hit / NULLIF(called, 0), 0.0) AS precision,
                     COALESCE(hit / NULLIF(support, 0), 0.0) AS recall,
                     COALESCE(2.0 * hit / NULLIF(called + support, 0), 0.0) AS f1_score, support
              FROM parts)
    """


ORACLES["classification_report"] = f"""
    WITH {FORECAST}, {report('forecast')}
    SELECT label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
           ROUND(CAST(f1_score AS DOUBLE), 9) AS f1_score, support FROM lines
    UNION ALL SELECT 'accuracy', NULL, NULL, ROUND((tp + tn) / n, 9), n FROM cells
    UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 9), ROUND(AVG(recall), 9),
                     ROUND(AVG(f1_score), 9), CAST(SUM(support) AS BIGINT) FROM lines
    UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 9),
                     ROUND(SUM(recall * support) / SUM(support), 9),
                     ROUND(SUM(f1_score * support) / SUM(support), 9),
                     CAST(SUM(support) AS BIGINT) FROM lines
"""
ORACLES["f1_score"] = f"""
    WITH {FORECAST}, {report('forecast')}
    SELECT ROUND(CAST(f1_score AS DOUBLE), 9) AS f1_score FROM lines WHERE label = '1'
"""
ORACLES["confusion_matrix"] = f"""
    WITH {FORECAST}
    SELECT COALESCE(CAST(alive AS VARCHAR), 'All') AS alive,
           COALESCE(CAST(pred_alive AS VARCHAR), 'All') AS pred_alive, COUNT(*) AS n
    FROM forecast GROUP BY CUBE (alive, pred_alive)
"""


def qcut(source: str, value: str, keep: str) -> str:
    """CTE ``cut``: columns ``keep`` and the decile of ``value``."""
    return f"""
    edges AS (SELECT list_distinct(quantile_cont({value},
                  [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM {source}),
    cut AS (SELECT {keep}, CAST(10 - GREATEST(len(list_filter(e, lambda v: v < {value})) - 1, 0)
                                AS INTEGER) AS decile
            FROM {source} CROSS JOIN edges)
    """


def capture(actual: str) -> str:
    return f"""
    capture AS (SELECT decile, SUM(SUM({actual})) OVER (ORDER BY decile) / SUM(SUM({actual})) OVER ()
                AS ratio FROM cut GROUP BY decile)
    """


ORACLES["qcut_decile"] = f"""
    WITH {FORECAST}, {qcut('forecast', 'predicted', 'CustomerID')}
    SELECT CustomerID, decile FROM cut
"""
ORACLES["decile_capture"] = f"""
    WITH {FORECAST}, {qcut('forecast', 'predicted', 'frequency_holdout')},
    {capture('frequency_holdout')}
    SELECT decile, ROUND(ratio, 9) AS ratio_cum_actual_to_total FROM capture
"""
ORACLES["quality_gates"] = f"""
    WITH {FORECAST}, {report('forecast')},
    m AS (SELECT AVG(ABS(frequency_holdout - predicted)) AS mae, CAST(COUNT(*) AS DOUBLE) AS n,
                 SQRT(AVG(POWER(monetary_value_holdout - monetary_value_cal, 2))) AS rmse
          FROM forecast),
    gates AS (
        SELECT 'row_count' AS gate, n AS value, 300000.0 AS threshold, n > 300000 AS passed FROM m
        UNION ALL SELECT 'frequency_mae', mae, 0.5, mae < 0.5 FROM m
        UNION ALL SELECT 'roc_auc', v, 0.8, v > 0.8
                  FROM (SELECT {auc('forecast', 'alive', 'score')} AS v)
        UNION ALL SELECT 'f1_score', f1_score, 0.4, f1_score > 0.4 FROM lines WHERE label = '1'
        UNION ALL SELECT 'spend_rmse', rmse, 20.0, rmse < 20 FROM m)
    SELECT gate, ROUND(CAST(value AS DOUBLE), 4) AS value, CAST(threshold AS DOUBLE) AS threshold,
           passed FROM gates
"""

# --- ranking ----------------------------------------------------------------------------------

ORACLES["clv_decile"] = f"""
    WITH {full()}
    SELECT CustomerID, CAST(NTILE(10) OVER (ORDER BY monetary_value * CAST(frequency AS DOUBLE) DESC,
                                            CustomerID) AS INTEGER) AS clv_1y_decile
    FROM full_snap
"""
ORACLES["alive_decile"] = f"""
    WITH {full()},
    s AS (SELECT CustomerID,
                 ROUND(CAST(recency AS DOUBLE) / NULLIF(CAST(T AS DOUBLE), 0), 1) AS share
          FROM full_snap)
    SELECT CustomerID, CAST(NTILE(10) OVER (ORDER BY share DESC NULLS LAST, CustomerID) AS INTEGER)
           AS prob_alive_decile
    FROM s
"""

# --- scalar functions and encoding ------------------------------------------------------------

ORACLES["scalar_suite"] = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, last_day(o_orderdate) AS month_end,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), last_day(o_orderdate)) AS INTEGER)
               AS days_left,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(o_orderkey AS FLOAT) AS as_float, right(o_orderpriority, 2) AS suffix,
           o_totalprice / NULLIF(o_orderkey % 3, 0) AS guarded,
           ROUND(POWER(1 + (o_orderkey % 20) / 100.0, CAST(1 AS DOUBLE) / 12) - 1, 6)
               AS monthly_rate,
           o_totalprice AS first_item,
           CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE 0.0 END AS filled,
           CAST(o_totalprice > 100000 AS INTEGER) AS large,
           o_orderdate - INTERVAL 13 MONTH AS earlier,
           CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS midnight,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
           CASE WHEN strpos(o_orderpriority, '-') > 0
                THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1)
                ELSE o_orderpriority END AS stripped
    FROM orders
"""
ORACLES["named_parameters"] = f"""
    SELECT o_custkey AS customer_id, COUNT(*) AS n FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-31' - {DURATION} AND DATE '2001-07-31'
    GROUP BY o_custkey
"""
ORACLES["one_hot_fit"] = """
    SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
    WHERE o_orderpriority <> '5-LOW' AND o_orderstatus IS NOT NULL
    UNION ALL
    SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
"""
_status = ", ".join(
    f"CAST(COALESCE(o_orderstatus = '{v}', FALSE) AS INTEGER) AS \"o_orderstatus_{v}\"" for v in "FOP"
)
_priority = ", ".join(
    f"CAST(COALESCE(o_orderpriority = '{v}', FALSE) AS INTEGER) AS \"o_orderpriority_{v}\""
    for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
)
ORACLES["one_hot"] = f"SELECT o_orderkey, {_status}, {_priority} FROM orders"

# --- models -----------------------------------------------------------------------------------

_R, _ALPHA, _A, _B = (PURCHASES[k] for k in ("r", "alpha", "a", "b"))
_P, _Q, _V = (SPEND[k] for k in ("p", "q", "v"))


def alive(x: str, t_x: str, T: str) -> str:
    return (
        f"1 / (1 + {_A} / ({_B} + {x}) * POWER(CAST({_ALPHA} + {T} AS DOUBLE) / ({_ALPHA} + {t_x}),"
        f" {_R} + {x}))"
    )


def spend(x: str, m: str) -> str:
    return f"CAST({_P} AS DOUBLE) * ({_V} + {x} * {m}) / ({_P} * {x} + {_Q} - 1)"


def outlook(source: str, days: list[int], x: str, T: str, terms: int = 500) -> str:
    """CTE ``outlook``: purchases if alive per (x, T, days), from the hypergeometric series."""
    A, B, C = f"({_R} + x)", f"({_B} + x + 1)", f"({_A + _B} + x)"
    return f"""
    pairs AS (SELECT DISTINCT CAST({x} AS DOUBLE) AS x, CAST({T} AS DOUBLE) AS T FROM {source}),
    series AS (SELECT x, list_transform(range(0, {terms}), lambda n:
                   lgamma({A} + n) - lgamma({A}) + lgamma({B} + n) - lgamma({B})
                   - lgamma({C} + n) + lgamma({C}) - lgamma(n + 1)) AS c
               FROM (SELECT DISTINCT x FROM pairs)),
    ahead AS (SELECT CAST(unnest({days}) AS DOUBLE) AS days),
    outlook AS (SELECT x, T, days, {C} / ({_A} - 1) * (1 - POWER(1 - z, {A}) * list_sum(
                    list_transform(c, lambda v, i: exp(v + (i - 1) * ln(z))))) AS h
                FROM (SELECT *, days / ({_ALPHA} + T + days) AS z
                      FROM pairs JOIN series USING (x) CROSS JOIN ahead))
    """


_MONTHS = [30 * i for i in range(1, 37)]
_DISCOUNTED = f"""
    monthly AS (SELECT x, T, days / 30 AS i,
                       h - LAG(h, 1, 0) OVER (PARTITION BY x, T ORDER BY days) AS e
                FROM outlook WHERE days % 30 = 0),
    value AS (SELECT x, T, SUM(e / POWER(1 + {RATE}, i)) FILTER (WHERE i <= 12) AS d_1y,
                     SUM(e / POWER(1 + {RATE}, i)) AS d_3y
              FROM monthly GROUP BY x, T)
"""
_AT = "CAST(frequency AS DOUBLE) = o.x AND CAST(T AS DOUBLE) = o.T"
_ALIVE = alive("CAST(frequency AS DOUBLE)", "CAST(recency AS DOUBLE)", "CAST(s.T AS DOUBLE)")
_SPEND = spend("CAST(frequency AS DOUBLE)", "monetary_value")

ORACLES["prob_alive"] = f"""
    WITH {full()} SELECT CustomerID, ROUND({_ALIVE}, 6) AS prob_alive FROM full_snap s
"""


def _horizon(days: int, digits: int, name: str, factor: str = "alive") -> str:
    return f"ROUND({factor} * MAX(h) FILTER (WHERE days = {days}), {digits}) AS {name}"


_SCORED = f"""
    WITH {full()}, {outlook('full_snap', [30, 365, 730], 'frequency', 'T')},
    scored AS (SELECT CustomerID, {_ALIVE} AS alive, o.days, o.h
               FROM full_snap s JOIN outlook o ON CAST(s.frequency AS DOUBLE) = o.x
                                              AND CAST(s.T AS DOUBLE) = o.T)
"""
ORACLES["expected_purchases"] = f"""
    {_SCORED}
    SELECT CustomerID, {_horizon(30, 6, 'purch_30day')}, {_horizon(365, 6, 'purch_365day')},
           {_horizon(730, 6, 'purch_730day')}
    FROM scored GROUP BY CustomerID, alive
"""
ORACLES["frequency_scores"] = f"""
    {_SCORED}
    SELECT CustomerID, ROUND(CAST(CAST(alive AS FLOAT) AS DOUBLE), 4) AS alive,
           ROUND(CAST(CAST(alive * MAX(h) FILTER (WHERE days = 30) AS FLOAT) AS DOUBLE), 4) AS purch_30day,
           ROUND(CAST(CAST(alive * MAX(h) FILTER (WHERE days = 365) AS FLOAT) AS DOUBLE), 4) AS purch_365day,
           ROUND(CAST(CAST(alive * MAX(h) FILTER (WHERE days = 730) AS FLOAT) AS DOUBLE), 4) AS purch_730day
    FROM scored GROUP BY CustomerID, scored.alive
"""
ORACLES["udf_probability_alive"] = f"""
    SELECT CustomerID, alive AS prob_alive, purch_365day AS purch_1y, purch_730day AS purch_2y
    FROM ({ORACLES['frequency_scores']})
"""
_PREDICTED = f"""
    WITH {training(ALL)}, {outlook('train', [365], 'frequency_cal', 'T_cal')},
    predicted AS (SELECT s.*, {alive('CAST(frequency_cal AS DOUBLE)', 'CAST(recency_cal AS DOUBLE)', 'CAST(T_cal AS DOUBLE)')}
                         AS prob_alive, o.h
                  FROM train s JOIN outlook o ON CAST(frequency_cal AS DOUBLE) = o.x
                                             AND CAST(T_cal AS DOUBLE) = o.T)
"""
ORACLES["holdout_prediction"] = f"""
    {_PREDICTED} SELECT CustomerID, ROUND(prob_alive * h, 6) AS predicted FROM predicted
"""
ORACLES["frequency_evaluation"] = f"""
    {_PREDICTED},
    s AS (SELECT frequency_holdout, prob_alive, prob_alive * h AS predicted,
                 ROUND(prob_alive * h, 2) AS next_year,
                 CAST(frequency_holdout > 0 AS INTEGER) AS alive FROM predicted),
    {qcut('s', 'next_year', 'frequency_holdout')}, {capture('frequency_holdout')},
    c AS (SELECT {youden('s', 'alive', 'prob_alive')} AS cutoff),
    labelled AS (SELECT alive, CAST(prob_alive > cutoff AS INTEGER) AS pred_alive FROM s, c),
    {report('labelled')}
    SELECT ROUND((SELECT AVG(ABS(frequency_holdout - predicted)) FROM s), 6) AS frequency_mae,
           ROUND((SELECT SQRT(AVG(POWER(frequency_holdout - predicted, 2))) FROM s), 6)
               AS frequency_rmse,
           ROUND((SELECT ratio FROM capture ORDER BY decile LIMIT 1 OFFSET 2), 6)
               AS captured_by_third_decile,
           ROUND({auc('s', 'alive', 'prob_alive')}, 6) AS roc_auc,
           ROUND((SELECT cutoff FROM c), 6) AS cutoff,
           ROUND((SELECT CAST(f1_score AS DOUBLE) FROM lines WHERE label = '1'), 6) AS f1_score
"""

_PR, _PALPHA, _PS, _PBETA = (BASELINE[k] for k in ("r", "alpha", "s", "beta"))


def _pareto_series(y: str) -> str:
    """2F1(k, r+x; k+1; (beta-alpha)/(beta+y)) / (beta+y)^k for alpha < beta, k = r+s+x."""
    k, B = f"({_PR + _PS} + x)", f"({_PR} + x)"
    w = f"(CAST({_PBETA - _PALPHA} AS DOUBLE) / ({_PBETA} + {y}))"
    # Scaled by (beta + T)^k so that large powers stay in range.
    return f"""
        list_sum(list_transform(range(0, 300), lambda n:
            exp(lgamma({B} + n) - lgamma({B}) - lgamma(n + 1) + n * ln({w})
                + {k} * ln(({_PBETA} + T) / ({_PBETA} + {y}))) * {k} / ({k} + n)))
    """


ORACLES["pareto_predict"] = f"""
    WITH {training(ALL)},
    p AS (SELECT CustomerID, CAST(frequency_cal AS DOUBLE) AS x, CAST(recency_cal AS DOUBLE) AS tx,
                 CAST(T_cal AS DOUBLE) AS T FROM train),
    q AS (SELECT *, 1 / (1 + {_PS} / ({_PR + _PS} + x)
                         * POWER((CAST({_PALPHA} AS DOUBLE) + T) / ({_PBETA} + T), {_PR} + x)
                         * ({_pareto_series('tx')} - {_pareto_series('T')})) AS alive
          FROM p)
    SELECT CustomerID, ROUND(alive, 6) AS prob_alive,
           ROUND(({_PR} + x) * ({_PBETA} + T) / (({_PALPHA} + T) * ({_PS} - 1))
                 * (1 - POWER(CAST({_PBETA} + T AS DOUBLE) / ({_PBETA} + T + {DURATION}), {_PS} - 1))
                 * alive, 6) AS predicted
    FROM q
"""


def _likelihood(values: dict[str, float], where: str, text: str) -> str:
    """Mean of ``text`` over training customers, with the parameters at full and half size."""
    columns = ", ".join(f"{value} * factor AS {name}" for name, value in values.items())
    return f"""
    WITH {training(ALL)},
    points AS (SELECT factor, {columns} FROM (SELECT unnest([1.0, 0.5]::DOUBLE[]) AS factor)),
    bought AS (SELECT CAST(frequency_cal AS DOUBLE) AS x, CAST(recency_cal AS DOUBLE) AS tx,
                 CAST(T_cal AS DOUBLE) AS age, monetary_value_cal AS m FROM train)
    SELECT factor, ROUND(AVG({text}), 8) AS log_likelihood FROM bought CROSS JOIN points {where}
    GROUP BY factor
    """


ORACLES["likelihood_mbg"] = _likelihood(
    {"r": _R, "al": _ALPHA, "a": _A, "b": _B},
    "",
    """lgamma(r + x) - lgamma(r) + r * ln(al) + lgamma(a + b) - lgamma(b) + lgamma(b + x + 1)
       - lgamma(a + b + x + 1) - (r + x) * ln(al + age)
       + ln(1 + a / (b + x) * POWER((al + age) / (al + tx), r + x))""",
)


def _pareto_integral(y: str) -> str:
    """2F1(k, r+x; k+1; (be-al)/(be+y)) ((be+age)/(be+y))^k for al < be, k = r+s+x."""
    return f"""
        list_sum(list_transform(range(0, 300), lambda n:
            exp(lgamma(r + x + n) - lgamma(r + x) - lgamma(n + 1) + n * ln((be - al) / (be + {y}))
                + (r + s + x) * ln((be + age) / (be + {y}))) * (r + s + x) / (r + s + x + n)))
    """


ORACLES["likelihood_pareto_nbd"] = _likelihood(
    {"r": _PR, "al": _PALPHA, "s": _PS, "be": _PBETA},
    "",
    f"""lgamma(r + x) - lgamma(r) + r * ln(al) + s * ln(be) - (r + x) * ln(al + age)
        - s * ln(be + age)
        + ln(1 + s / (r + s + x) * POWER((al + age) / (be + age), r + x)
               * ({_pareto_integral('tx')} - {_pareto_integral('age')}))""",
)
ORACLES["likelihood_gamma_gamma"] = _likelihood(
    {"p": _P, "q": _Q, "v": _V},
    "WHERE x > 0 AND m > 0",
    """lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(v) + (p * x - 1) * ln(m)
       + p * x * ln(x) - (p * x + q) * ln(x * m + v)""",
)
def _pooled(text: str) -> str:
    return f"SUM(w * ({text})) / SUM(w)"


# The limits of the fits, solved from their score equations: a Newton search on (ln r, ln alpha) with
# analytic derivatives for customers who never leave, bisection on ln p for those who spend alike. The
# limit holds where the mean slope on leaving it (a or s from 0, 1/q from 0) is not positive.
_DIGAMMA = """(ln(z + 8) - 1 / (2 * (z + 8)) - 1 / (12 * POWER(z + 8, 2)) + 1 / (120 * POWER(z + 8, 4))
    - 1 / (252 * POWER(z + 8, 6))
    - (1 / z + 1 / (z + 1) + 1 / (z + 2) + 1 / (z + 3) + 1 / (z + 4) + 1 / (z + 5) + 1 / (z + 6) + 1 / (z + 7)))"""


def _harmonic(start: str, power: int, terms: str = "x") -> str:
    """The sum of (start + j)^-power over 0 <= j < terms."""
    return (
        f"coalesce(list_sum(list_transform(range(0, CAST({terms} AS BIGINT)),"
        f" lambda j: POWER({start} + j, -{power}))), 0)"
    )


ORACLES["limit_fits"] = f"""
    WITH RECURSIVE {training(ALL)},
    raw AS (SELECT CAST(frequency_cal AS DOUBLE) AS x, CAST(recency_cal AS DOUBLE) AS tx,
                   CAST(T_cal AS DOUBLE) AS age, CAST(monetary_value_cal AS DOUBLE) AS m FROM train),
    unit AS (SELECT 10.0 / MAX(age) AS scale FROM raw),
    bought AS MATERIALIZED (
        SELECT x, tx * scale AS tx, age * scale AS age, CAST(COUNT(*) AS DOUBLE) AS w
        FROM raw CROSS JOIN unit GROUP BY ALL),
    ages AS MATERIALIZED (SELECT x, age, SUM(w) AS w FROM bought GROUP BY ALL),
    newton AS (
        SELECT 0 AS step, CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS v
        UNION ALL
        SELECT step + 1,
               u + greatest(-0.5, least(0.5, -(hvv * gu - huv * gv) / (huu * hvv - huv * huv))),
               v + greatest(-0.5, least(0.5, -(huu * gv - huv * gu) / (huu * hvv - huv * huv)))
        FROM (SELECT step, u, v, r * gr AS gu, al * ga AS gv, r * r * hrr + r * gr AS huu,
                     r * al * hra AS huv, al * al * haa + al * ga AS hvv
              FROM (SELECT step, u, v, r, al,
                           {_pooled(_harmonic("r", 1) + " + ln(al) - ln(al + age)")} - 0.02 * r AS gr,
                           {_pooled("r / al - (r + x) / (al + age)")} - 0.02 * al AS ga,
                           -({_pooled(_harmonic("r", 2))}) - 0.02 AS hrr,
                           {_pooled("1 / al - 1 / (al + age)")} AS hra,
                           {_pooled("(r + x) / POWER(al + age, 2) - r / (al * al)")} - 0.02 AS haa
                    FROM (SELECT step, u, v, exp(u) AS r, exp(v) AS al FROM newton WHERE step < 40)
                    CROSS JOIN ages GROUP BY step, u, v, r, al))),
    stay AS (SELECT exp(u) AS r, exp(v) AS al FROM newton WHERE step = 40),
    staying AS (
        SELECT r, al, {_pooled("lgamma(r + x) - lgamma(r) + r * ln(al) - (r + x) * ln(al + age)")} AS ll,
               {_pooled("POWER((al + age) / (al + tx), r + x) / (1 + x) - " + _harmonic("1", 1, "x + 1"))} AS by_a,
               -- Simpson over the time since the last purchase, beta = 10
               {_pooled("""list_sum(list_transform(range(0, 201), lambda i:
                   (CASE WHEN i IN (0, 200) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (age - tx) / 600
                   * POWER((al + age) / (al + tx + (age - tx) * i / 200), r + x)
                   / (10 + tx + (age - tx) * i / 200))) - ln((10 + age) / 10)""")} AS by_s
        FROM bought CROSS JOIN stay GROUP BY r, al),
    spent AS MATERIALIZED (
        SELECT x, CAST(COUNT(*) AS DOUBLE) AS w, SUM(x * m) AS total, SUM(ln(x * m)) AS logs,
               SUM(POWER(x * m, 2)) AS squares
        FROM raw WHERE x > 0 AND m > 0 GROUP BY x),
    halving AS (
        SELECT 0 AS step, CAST(-7 AS DOUBLE) AS lo, CAST(10 AS DOUBLE) AS hi
        UNION ALL
        SELECT step + 1, CASE WHEN score > 0 THEN mid ELSE lo END, CASE WHEN score > 0 THEN hi ELSE mid END
        FROM (SELECT step, lo, hi, mid,
                     SUM(x * (logs - w * {_DIGAMMA.replace("z", "(p * x)")}))
                     - SUM(w * x) * ln(SUM(total) / (p * SUM(w * x))) AS score
              FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid, exp((lo + hi) / 2) AS p FROM halving WHERE step < 50)
              CROSS JOIN spent GROUP BY step, lo, hi, mid, p)),
    one AS (
        SELECT p, SUM(total) / (p * SUM(w * x)) AS mu
        FROM (SELECT exp(lo) AS p FROM halving WHERE step = 50) CROSS JOIN spent GROUP BY p),
    alike AS (
        SELECT p, mu,
               SUM(p * x * (logs - w * ln(mu)) - w * lgamma(p * x) - total / mu) / SUM(w) AS ll,
               SUM((squares / (mu * mu) - 2 * p * x * total / mu + w * p * x * (p * x - 1)) / 2) / SUM(w) AS by_q
        FROM spent CROSS JOIN one GROUP BY p, mu),
    logs_of AS (SELECT SUM(ln(m)) / COUNT(*) AS ln_m FROM raw WHERE x > 0 AND m > 0),
    ends AS (
        SELECT 'mbg' AS model, unnest(['r', 'alpha']) AS parameter, by_a <= 0 AS at_limit,
               unnest([r, al / scale]) AS value, ll FROM staying CROSS JOIN unit
        UNION ALL
        SELECT 'pareto_nbd', unnest(['r', 'alpha']), by_s <= 0, unnest([r, al / scale]), ll
        FROM staying CROSS JOIN unit
        UNION ALL
        SELECT 'gamma_gamma', unnest(['p', 'v']), by_q <= 0, unnest([p, mu]), ll - ln_m FROM alike CROSS JOIN logs_of)
    SELECT model, parameter, at_limit, CASE WHEN at_limit THEN ROUND(ln(value), 2) END AS ln_value,
           CASE WHEN at_limit THEN ROUND(ll, 4) END AS log_likelihood
    FROM ends
"""
ORACLES["expected_spend"] = f"""
    WITH {full()} SELECT CustomerID, {_SPEND} AS expected_spend FROM full_snap
"""


def _lifetime(column: str) -> str:
    return f"""
    WITH {full()}, {outlook('full_snap', _MONTHS, 'frequency', 'T')}, {_DISCOUNTED}
    SELECT CustomerID, ROUND({_SPEND} * {_ALIVE} * o.{column}, 0) AS clv
    FROM full_snap s JOIN value o ON CAST(s.frequency AS DOUBLE) = o.x
                                 AND CAST(s.T AS DOUBLE) = o.T
    """


ORACLES["clv_12m"] = _lifetime("d_1y")
ORACLES["clv_36m"] = _lifetime("d_3y")
ORACLES["udf_clv"] = ORACLES["clv_12m"]


def _spend_metrics(x: str, m: str) -> str:
    return f"""
    WITH {training(ALL)},
    p AS (SELECT monetary_value_holdout AS y, {spend(f'CAST({x} AS DOUBLE)', m)} AS p
          FROM train WHERE frequency_cal > 0),
    banded AS (SELECT *, AVG(y) OVER () AS mean FROM p WHERE y > 0 AND y <= {BAND})
    SELECT ROUND((SELECT AVG(ABS(y - p)) FROM p), 4) AS spend_mae,
           ROUND((SELECT SQRT(AVG((y - p) * (y - p))) FROM p), 4) AS spend_rmse,
           ROUND((SELECT AVG(ABS(y - p) / y) FROM p WHERE y > 0), 4) AS spend_mape,
           ROUND((SELECT 1 - SUM((y - p) * (y - p)) / SUM((y - mean) * (y - mean)) FROM banded), 4)
               AS spend_r2
    """


ORACLES["monetary_evaluation"] = _spend_metrics("frequency_cal", "monetary_value_cal")
ORACLES["monetary_evaluation_on_actuals"] = _spend_metrics(
    "frequency_holdout", "monetary_value_holdout"
)

# --- scoring ----------------------------------------------------------------------------------

ORACLES["udf_smoke"] = f"""
    WITH {full()}, {outlook('full_snap', _MONTHS, 'frequency', 'T')}, {_DISCOUNTED}
    SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE v >= 0) AS usable_values,
           COUNT(*) FILTER (WHERE alive > 0 AND alive <= 1) AS usable_scores,
           ROUND(AVG(v), 4) AS mean_value, ROUND(AVG(CAST(alive AS DOUBLE)), 4) AS mean_alive
    FROM (SELECT {_SPEND} * {_ALIVE} * d_1y AS v, CAST({_ALIVE} AS FLOAT) AS alive
          FROM full_snap s
          JOIN value o ON CAST(s.frequency AS DOUBLE) = o.x AND CAST(s.T AS DOUBLE) = o.T)
"""
ORACLES["score_snapshot"] = f"""
    WITH {full()}, {outlook('full_snap', _MONTHS + [365, 730], 'frequency', 'T')}, {_DISCOUNTED},
    years AS (SELECT x, T, MAX(h) FILTER (WHERE days = 365) AS h_1y,
                     MAX(h) FILTER (WHERE days = 730) AS h_2y FROM outlook GROUP BY x, T),
    scored AS (SELECT s.*, CAST({_ALIVE} AS FLOAT) AS prob_alive,
                      CAST({_ALIVE} * h_1y AS FLOAT) AS purch_1y,
                      CAST({_ALIVE} * h_2y AS FLOAT) AS purch_2y,
                      GREATEST({_SPEND} * {_ALIVE} * d_1y, 0) AS clv_1y,
                      GREATEST({_SPEND} * {_ALIVE} * d_3y, 0) AS clv_3y
               FROM full_snap s
               JOIN value o ON CAST(s.frequency AS DOUBLE) = o.x AND CAST(s.T AS DOUBLE) = o.T
               JOIN years y ON o.x = y.x AND o.T = y.T)
    SELECT snapshot_dt, CustomerID, frequency, recency, T, monetary_value,
           ROUND(CAST(prob_alive AS DOUBLE), 4) AS prob_alive,
           ROUND(CAST(purch_1y AS DOUBLE), 4) AS purch_1y,
           ROUND(CAST(purch_2y AS DOUBLE), 4) AS purch_2y,
           ROUND(clv_1y, 0) AS clv_1y, ROUND(clv_3y, 0) AS clv_3y,
           CAST(NTILE(10) OVER (ORDER BY clv_1y DESC, CustomerID) AS INTEGER) AS clv_1y_decile,
           CAST(NTILE(10) OVER (ORDER BY prob_alive DESC, CustomerID) AS INTEGER)
               AS prob_alive_decile
    FROM scored
"""

# --- timeline ---------------------------------------------------------------------------------

ORACLES["timeline_of_orders"] = """
    SELECT l AS latest_txn_ts, l - INTERVAL 12 MONTH AS training_end_ts,
           l - INTERVAL 12 MONTH - INTERVAL 24 MONTH AS training_start_ts
    FROM (SELECT CAST(CAST(MAX(o_orderdate) AS DATE) AS TIMESTAMP) AS l FROM orders)
"""
ORACLES["timeline_of_events"] = """
    SELECT l AS latest_txn_ts, l - INTERVAL 1 MONTH AS training_end_ts,
           l - INTERVAL 1 MONTH - INTERVAL 11 MONTH AS training_start_ts
    FROM (SELECT MAX(ts) AS l FROM events)
"""
ORACLES["features_ready"] = """
    SELECT COALESCE(MIN(o_orderdate) <= TIMESTAMP '1995-02-01', FALSE) AS features_ready FROM orders
"""
ORACLES["cold_start"] = """
    WITH first AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS d FROM orders)
    SELECT 'order_features' AS feature_table, DATE '1990-01-01' AS target_ts,
           d > DATE '1990-01-01' AS cold_start FROM first
    UNION ALL SELECT 'order_features', DATE '1999-01-01', d > DATE '1999-01-01' FROM first
    UNION ALL SELECT 'no_such_table', DATE '1999-01-01', TRUE FROM first
"""
ORACLES["feature_window"] = """
    WITH l AS (SELECT CAST(CAST(MAX(o_orderdate) AS DATE) AS TIMESTAMP) AS l FROM orders),
    e AS (SELECT 'training' AS run, l - INTERVAL 12 MONTH AS e FROM l
          UNION ALL SELECT 'first interactive', l - INTERVAL 12 MONTH FROM l
          UNION ALL SELECT 'update', l FROM l)
    SELECT run, e AS eval_period_end, e - INTERVAL 24 MONTH AS eval_period_start FROM e
"""

# --- the jobs ---------------------------------------------------------------------------------

ORACLES["prepare_job"] = ORACLES["training_snapshot"]
ORACLES["scoring_job"] = ORACLES["score_snapshot"]
ORACLES["training_snapshot_monthly"] = ORACLES["training_snapshot_all"]
ORACLES["full_snapshot_monthly"] = ORACLES["full_snapshot"]
ORACLES["training_job"] = f"""
    WITH {training(ALL)}, {full(prefix='f_')}
    SELECT name, 1::BIGINT AS version, rows FROM (
      SELECT 'clv_freq_best' AS name, COUNT(*) AS rows FROM train WHERE frequency_cal < 12
      UNION ALL SELECT 'clv_monetary_best', COUNT(*) FROM train WHERE frequency_cal BETWEEN 1 AND 11
      UNION ALL SELECT 'clv_freq_final', COUNT(*) FROM full_snap WHERE frequency < 12
      UNION ALL SELECT 'clv_monetary_final', COUNT(*) FROM full_snap WHERE frequency BETWEEN 1 AND 11)
"""
