"""Reference SQL for every registered query, runnable by DuckDB over the
driver's tables.  Written independently of the Spark code so it can catch
mistakes in it; shared building blocks are CTEs.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def _raw_select(where: str = "") -> str:
    return f"""
  SELECT
    'TXN-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE 'U' || CAST(o.o_custkey AS VARCHAR) END AS user_id,
    'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
         WHEN l.l_orderkey % 103 = 0 THEN 'ERROR_VAL'
         WHEN l.l_orderkey % 1501 = 0 THEN '1e20'
         WHEN l.l_orderkey % 2003 = 0 THEN 'inf'
         WHEN l.l_orderkey % 131 = 0 THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '4'
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN l.l_orderkey % 107 = 0 THEN NULL
         WHEN l.l_orderkey % 109 = 0 THEN '99'
         WHEN l.l_orderkey % 127 = 0 THEN 'n/a'
         WHEN l.l_orderkey % 113 = 0 THEN CAST(CAST(trunc(l.l_quantity) AS INTEGER) % 7 AS VARCHAR) || '.5'
         ELSE CAST(CAST(trunc(l.l_quantity) AS INTEGER) % 7 AS VARCHAR) END AS rating,
    CASE WHEN l.l_orderkey % 137 = 0 THEN strftime(l.l_shipdate, '%m/%d/%Y %H:%M')
         WHEN l.l_orderkey % 139 = 0 THEN strftime(l.l_shipdate, '%b %-d, %Y %H:%M:%S')
         WHEN l.l_orderkey % 149 = 0 THEN strftime(l.l_shipdate, '%Y%m%d')
         WHEN l.l_orderkey % 1511 = 0 THEN 'yesterday'
         ELSE strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') END AS timestamp,
    l.l_partkey AS l_partkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey {where}"""


RAW_CTE = f"""raw_keyed AS ({_raw_select()}
  UNION ALL {_raw_select("WHERE l.l_orderkey % 50 = 0")}
),
raw_tx AS (SELECT transaction_id, user_id, product_id, amount, rating, timestamp FROM raw_keyed)"""

EVENTS_CTE = """click_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'U' || CAST(user_id AS VARCHAR) AS user_id,
         'P' || json_extract_string(props, '$.k') AS product_id,
         CASE WHEN event_type = 'purchase' THEN 'add_to_cart' ELSE event_type END AS action,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp
  FROM events
),
speed AS (SELECT event_id, user_id, product_id, action, timestamp AS ts FROM click_events)"""

STREAM_CTE = """stream_rows AS (
  SELECT 'STREAM_' || CAST(row_number() OVER (
            ORDER BY TRY_CAST(ts AS TIMESTAMP) DESC NULLS LAST, ts DESC NULLS LAST,
                     user_id ASC NULLS FIRST, product_id ASC NULLS FIRST,
                     action ASC NULLS FIRST, event_id ASC NULLS FIRST) - 1 AS VARCHAR) AS transaction_id,
         user_id, product_id, '0.0' AS amount,
         CASE action WHEN 'view' THEN '2' WHEN 'click' THEN '3' WHEN 'add_to_cart' THEN '4' END AS rating,
         ts AS timestamp
  FROM speed WHERE action IN ('view', 'click', 'add_to_cart')
)"""

COMBINED_CTE = """stream_keyed AS (
  SELECT 'STREAM_' || event_id AS transaction_id, user_id, product_id, '0.0' AS amount,
         CASE action WHEN 'view' THEN '2' WHEN 'click' THEN '3' WHEN 'add_to_cart' THEN '4' END AS rating,
         ts AS timestamp
  FROM speed WHERE action IN ('view', 'click', 'add_to_cart')
),
combined AS (
  SELECT transaction_id, user_id, product_id, amount, rating, timestamp FROM raw_tx
  UNION ALL
  SELECT transaction_id, user_id, product_id, amount, rating, timestamp FROM stream_keyed
)"""


def parsed_ts(c: str) -> str:
    formats = ", ".join(f"'{f}'" for f in ("%m/%d/%Y %H:%M", "%b %d, %Y %H:%M:%S", "%Y%m%d"))
    # the list comes first: DuckDB's cast would also take some of these texts
    return f"COALESCE(TRY_STRPTIME({c}, [{formats}]), TRY_CAST({c} AS TIMESTAMP))"


def prepared_cte(source: str = "combined") -> str:
    return f"""coerced AS (
  SELECT transaction_id, user_id, product_id,
         TRY_CAST(trim(amount) AS DOUBLE) AS amount,
         TRY_CAST(rating AS DOUBLE) AS rating, timestamp
  FROM {source}
),
imputed AS (
  SELECT transaction_id, user_id, product_id, amount,
         COALESCE(rating, (SELECT avg(rating) FROM coerced)) AS rating, timestamp
  FROM coerced
),
prepared AS (
  SELECT DISTINCT transaction_id, user_id, product_id, amount,
         CASE WHEN rating IS NULL THEN NULL ELSE least(greatest(rating, 1.0), 5.0) END AS rating,
         timestamp
  FROM imputed WHERE user_id IS NOT NULL AND product_id IS NOT NULL
),
parsed AS (SELECT *, {parsed_ts('timestamp')} AS ts FROM prepared)"""


BASE_CTES = ",\n".join([RAW_CTE, EVENTS_CTE, STREAM_CTE, COMBINED_CTE, prepared_cte()])


def with_base(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {BASE_CTES}{extra}\n{body}"


def days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


USER_FEATURES_CTE = f"""uf_agg AS (
  SELECT user_id,
         count(transaction_id) AS total,
         avg(rating) AS avg_rating,
         COALESCE(sum(amount), 0.0) AS total_spent,
         avg(amount) AS avg_spent,
         stddev_samp(rating) AS rating_std,
         count(DISTINCT product_id) AS uniq,
         min(ts) AS first_ts, max(ts) AS last_ts
  FROM parsed WHERE user_id IS NOT NULL GROUP BY user_id
),
uf_days AS (
  SELECT *, {days(AS_OF_SQL, 'first_ts')} AS tenure, {days(AS_OF_SQL, 'last_ts')} AS recency FROM uf_agg
),
user_feat AS (
  SELECT user_id,
         total AS user_total_interactions,
         COALESCE(avg_rating, 0) AS user_avg_rating,
         total_spent AS user_total_spent,
         COALESCE(avg_spent, 0) AS user_avg_spent,
         COALESCE(rating_std, 0) AS user_rating_std,
         uniq AS user_unique_products,
         first_ts AS user_first_interaction,
         last_ts AS user_last_interaction,
         COALESCE(tenure, 0) AS user_tenure_days,
         COALESCE(recency, 0) AS user_recency_days,
         COALESCE(CAST(total AS DOUBLE) / NULLIF(tenure + 1, 0), 0) AS user_activity_rate,
         COALESCE(avg_rating * 0.4 + ln(1 + total) * 0.3
                  + (5.0 - CASE WHEN recency IS NULL THEN NULL ELSE least(greatest(recency, 0), 30) END / 6.0) * 0.3,
                  0) AS user_engagement_score
  FROM uf_days
)"""

ITEM_FEATURES_CTE = f"""if_agg AS (
  SELECT product_id,
         avg(rating) AS avg_rating,
         count(transaction_id) AS pop,
         COALESCE(sum(amount), 0.0) AS revenue,
         avg(CASE WHEN amount > 0 THEN amount END) AS avg_price,
         stddev_samp(rating) AS rating_std,
         count(DISTINCT user_id) AS uniq,
         min(ts) AS first_ts, max(ts) AS last_ts
  FROM parsed WHERE product_id IS NOT NULL GROUP BY product_id
),
if_days AS (
  SELECT *, {days(AS_OF_SQL, 'first_ts')} AS age, {days(AS_OF_SQL, 'last_ts')} AS recency FROM if_agg
),
item_feat AS (
  SELECT product_id,
         COALESCE(avg_rating, 0) AS item_avg_rating,
         pop AS item_popularity_score,
         revenue AS item_total_revenue,
         COALESCE(avg_price, 0) AS item_avg_price,
         COALESCE(rating_std, 0) AS item_rating_std,
         uniq AS item_unique_users,
         first_ts AS item_first_interaction,
         last_ts AS item_last_interaction,
         COALESCE(age, 0) AS item_age_days,
         COALESCE(recency, 0) AS item_recency_days,
         COALESCE(CAST(pop AS DOUBLE) / NULLIF(age + 1, 0), 0) AS item_velocity,
         COALESCE(avg_rating * 0.5 + ln(1 + pop) * 0.3
                  + (CAST(uniq AS DOUBLE) / NULLIF(pop, 0)) * 0.2, 0) AS item_quality_score
  FROM if_days
)"""

INTERACTION_FEATURES_CTE = f"""xf_agg AS (
  SELECT user_id, product_id,
         count(transaction_id) AS cnt,
         avg(rating) AS avg_rating,
         COALESCE(sum(amount), 0.0) AS spent,
         min(ts) AS first_ts, max(ts) AS last_ts
  FROM parsed WHERE user_id IS NOT NULL AND product_id IS NOT NULL
  GROUP BY user_id, product_id
),
inter_feat AS (
  SELECT user_id, product_id,
         cnt AS interaction_count,
         COALESCE(avg_rating, 0) AS interaction_avg_rating,
         spent AS interaction_total_spent,
         first_ts AS interaction_first,
         last_ts AS interaction_last,
         COALESCE({days(AS_OF_SQL, 'last_ts')}, 0) AS interaction_recency_days,
         COALESCE({days('last_ts', 'first_ts')}, 0) AS interaction_span_days
  FROM xf_agg
)"""


def round6(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"(CASE WHEN abs({x}) < 1e9 THEN floor({x} * 1000000.0 + 0.5001220703125) / 1000000.0 "
            f"WHEN abs({x}) < 1e15 THEN floor({x} * 100.0 + 0.5001220703125) / 100.0 "
            f"WHEN abs({x}) < 1e18 THEN floor({x} / 1e6 + 0.5001220703125) * 1e6 "
            f"WHEN abs({x}) < 1e30 THEN floor({x} / 1e12 + 0.5001220703125) * 1e12 ELSE {x} END)")


def portable_select(cols: list[tuple[str, str]]) -> str:
    """Mirror of ``functions.portable``: round doubles to 6, timestamps as text."""
    out = []
    for name, kind in cols:
        if kind == "d":
            out.append(f"{round6(name)} AS {name}")
        elif kind == "t":
            out.append(f"{ts_text(name)} AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


USER_FEATURE_COLS = [
    ("user_id", "s"), ("user_total_interactions", "i"), ("user_avg_rating", "d"),
    ("user_total_spent", "d"), ("user_avg_spent", "d"), ("user_rating_std", "d"),
    ("user_unique_products", "i"), ("user_first_interaction", "t"), ("user_last_interaction", "t"),
    ("user_tenure_days", "i"), ("user_recency_days", "i"), ("user_activity_rate", "d"),
    ("user_engagement_score", "d"),
]
ITEM_FEATURE_COLS = [
    ("product_id", "s"), ("item_avg_rating", "d"), ("item_popularity_score", "i"),
    ("item_total_revenue", "d"), ("item_avg_price", "d"), ("item_rating_std", "d"),
    ("item_unique_users", "i"), ("item_first_interaction", "t"), ("item_last_interaction", "t"),
    ("item_age_days", "i"), ("item_recency_days", "i"), ("item_velocity", "d"),
    ("item_quality_score", "d"),
]
INTERACTION_FEATURE_COLS = [
    ("user_id", "s"), ("product_id", "s"), ("interaction_count", "i"),
    ("interaction_avg_rating", "d"), ("interaction_total_spent", "d"),
    ("interaction_first", "t"), ("interaction_last", "t"),
    ("interaction_recency_days", "i"), ("interaction_span_days", "i"),
]


def q(body: str, *ctes: str) -> str:
    return with_base(body, ",\n".join(c for c in ctes if c))


COMBINED_COLS = [("transaction_id", "s"), ("user_id", "s"), ("product_id", "s"),
                 ("amount", "s"), ("rating", "s"), ("timestamp", "s")]
PREPARED_COLS = [("transaction_id", "s"), ("user_id", "s"), ("product_id", "s"),
                 ("amount", "d"), ("rating", "d"), ("timestamp", "s")]


def nulls_in_row(cols: list[str]) -> str:
    return " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)


TX_NAMES = [c for c, _ in COMBINED_COLS]

DQ_METRICS_SQL = q(f"""SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS total_rows,
       CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicates,
       CAST(COALESCE(sum(n * nulls), 0) AS BIGINT) AS missing_values
FROM (SELECT count(*) AS n, {nulls_in_row(TX_NAMES)} AS nulls
      FROM combined GROUP BY {", ".join(TX_NAMES)}) g""")

DQ_MISSING_SQL = q(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing FROM combined"
    for c in TX_NAMES))

DQ_FAILURES_BODY = f"""
SELECT 'user_id' AS "column", 'not_null' AS "check", CAST(user_id AS VARCHAR) AS failure_case, transaction_id AS row_key
  FROM combined WHERE user_id IS NULL
UNION ALL
SELECT 'product_id', 'not_null', CAST(product_id AS VARCHAR), transaction_id FROM combined WHERE product_id IS NULL
UNION ALL
SELECT 'rating', 'castable(double)', CAST(rating AS VARCHAR), transaction_id
  FROM combined WHERE rating IS NOT NULL AND TRY_CAST(rating AS DOUBLE) IS NULL
UNION ALL
SELECT 'rating', 'in_range(1, 5)', CAST(rating AS VARCHAR), transaction_id
  FROM combined WHERE TRY_CAST(rating AS DOUBLE) < 1 OR TRY_CAST(rating AS DOUBLE) > 5
UNION ALL
SELECT 'timestamp', 'not_null', timestamp, transaction_id FROM combined WHERE timestamp IS NULL
UNION ALL
SELECT 'timestamp', 'castable(timestamp)', timestamp, transaction_id
  FROM combined WHERE timestamp IS NOT NULL AND {parsed_ts('timestamp')} IS NULL"""

DQ_FAILURES_CTE = f"dq_fail AS ({DQ_FAILURES_BODY})"

DQ_FAILURES_SQL = q("SELECT * FROM dq_fail", DQ_FAILURES_CTE)

DQ_SUMMARY_SQL = q(f"""SELECT m.*, f.failure_count,
       CASE WHEN f.failure_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
FROM (SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS total_rows,
             CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicates,
             CAST(COALESCE(sum(n * nulls), 0) AS BIGINT) AS missing_values
      FROM (SELECT count(*) AS n, {nulls_in_row(TX_NAMES)} AS nulls
            FROM combined GROUP BY {", ".join(TX_NAMES)}) g) m,
     (SELECT CAST(count(*) AS BIGINT) AS failure_count FROM dq_fail) f""", DQ_FAILURES_CTE)

RATING_DIST_SQL = q(f"SELECT {round6('rating')} AS rating, count(*) AS count FROM prepared GROUP BY rating")

TOP_ITEMS_SQL = q("""SELECT product_id, count(*) AS count FROM prepared WHERE product_id IS NOT NULL
GROUP BY product_id ORDER BY count DESC, product_id ASC LIMIT 10""")

LATEST_EVENTS_SQL = q("""SELECT event_id, user_id, product_id, action, ts FROM speed
ORDER BY CAST(event_id AS BIGINT) DESC LIMIT 10""")

DEAD_LETTERS_SQL = q("""SELECT CASE WHEN n % 11 = 0 THEN substr(line, 1, 20) WHEN n % 13 = 0 THEN line || ' trailing' ELSE lacking END AS value,
       CASE WHEN n % 11 = 0 OR n % 13 = 0 THEN 'malformed_json' ELSE 'missing_key:product_id' END AS reason
FROM (SELECT CAST(event_id AS BIGINT) AS n,
             '{"event_id":"' || event_id || '","user_id":"' || user_id || '"' || COALESCE(',"product_id":"' || product_id || '"', '')
               || ',"action":"' || action || '","timestamp":"' || timestamp || '"}' AS line,
             '{"event_id":"' || event_id || '","user_id":"' || user_id || '","action":"' || action || '","timestamp":"' || timestamp || '"}' AS lacking
      FROM click_events) e
WHERE n % 11 = 0 OR n % 13 = 0 OR n % 17 = 0""")

EVENT_COUNT_SQL = q("SELECT count(*) AS total FROM speed")

SPEED_TABLE_SQL = q("SELECT event_id, user_id, product_id, action, ts FROM speed")

def fingerprint_sql(source: str, cols: list[str]) -> str:
    text = " || ".join(f"COALESCE(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)

    def half(start: int) -> str:
        return f"CAST(COALESCE(sum(CAST(CAST('0x' || substr(md5({text}), {start}, 16) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR)"

    return f"""SELECT rows, content_sum, md5(CAST(rows AS VARCHAR) || ':' || content_sum) AS fingerprint
FROM (SELECT count(*) AS rows, {half(1)} || ':' || {half(17)} AS content_sum FROM {source}) f"""


def _hash_of(source: str) -> str:
    return f"(SELECT fingerprint FROM ({fingerprint_sql(source, TX_NAMES)}) x)"


LINEAGE_RECORD_SQL = q(f"""SELECT 'merge' AS step, {_hash_of('raw_tx')} AS input_hash, {_hash_of('combined')} AS output_hash,
       CASE WHEN s THEN 'combined_streaming_batch' ELSE 'batch_only' END AS data_source,
       CASE WHEN s THEN 'true' ELSE 'false' END AS includes_streaming
FROM (SELECT count(*) > 0 AS s FROM combined WHERE transaction_id LIKE 'STREAM\\_%' ESCAPE '\\') f""")

LINEAGE_SQL = q(fingerprint_sql("combined", TX_NAMES))

STAMP_SQL = "strftime(TIMESTAMP '2024-02-01 00:00:00', '%Y-%m-%dT%H:%M:%S.%f')"


# -- recommender ----------------------------------------------------------------

CELLS_CTE = f"""brand_raw AS (
  SELECT r.transaction_id, r.user_id, p.p_brand AS product_id, r.amount, r.rating, r.timestamp
  FROM combined r JOIN part p ON r.product_id = 'P' || p.p_partkey
),
brand_cells AS (
  SELECT user_id, product_id, avg(TRY_CAST(rating AS DOUBLE)) AS rating
  FROM brand_raw WHERE user_id IS NOT NULL AND product_id IS NOT NULL
  GROUP BY user_id, product_id HAVING avg(TRY_CAST(rating AS DOUBLE)) IS NOT NULL
),
cells AS (
  SELECT user_id, product_id, avg(TRY_CAST(rating AS DOUBLE)) AS rating
  FROM combined WHERE user_id IS NOT NULL AND product_id IS NOT NULL
  GROUP BY user_id, product_id HAVING avg(TRY_CAST(rating AS DOUBLE)) IS NOT NULL
),
obs AS (SELECT * FROM cells WHERE rating > 0),
item_mean AS (SELECT product_id, {round6('avg(rating)')} AS m, count(*) / 64.0::DOUBLE AS p FROM obs GROUP BY product_id),
cell_users AS (SELECT user_id, CAST(CAST(substr(user_id, 2) AS BIGINT) % 3 - 1 AS DOUBLE) AS s FROM (SELECT DISTINCT user_id FROM cells) u),
pairs AS (
  SELECT o.user_id, o.product_id, o.rating AS actual, i.m + u.s * i.p AS prediction
  FROM obs o JOIN item_mean i ON o.product_id = i.product_id JOIN cell_users u ON o.user_id = u.user_id
),
topk AS (
  SELECT * FROM (SELECT t.s, product_id, m + t.s * p AS m, row_number() OVER (PARTITION BY t.s ORDER BY m + t.s * p DESC, product_id ASC) AS rank
                 FROM item_mean, (SELECT CAST(range AS DOUBLE) AS s FROM range(-1, 2)) t) r
  WHERE rank <= 5)"""

CELLS_SQL = q(f"SELECT user_id, product_id, {round6('rating')} AS rating FROM cells", CELLS_CTE)

OBSERVED_SQL = q(f"SELECT user_id, product_id, {round6('rating')} AS rating FROM obs", CELLS_CTE)

BRANDS = [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]
MATRIX_SQL = q("SELECT user_id, " + ", ".join(
    f"{round6(f'COALESCE(max(CASE WHEN product_id = {chr(39)}{b}{chr(39)} THEN rating END), 0.0)')} AS {chr(34)}{b}{chr(34)}" for b in BRANDS)
    + " FROM brand_cells GROUP BY user_id", CELLS_CTE)

USER_VECTORS_SQL = q(f"""SELECT user_id, dense_rank() OVER (ORDER BY product_id) - 1 AS position, {round6('rating')} AS rating FROM cells""", CELLS_CTE)

ITEM_VECTORS_SQL = q(f"""SELECT product_id, place // 1024 AS segment, count(*) AS n, min(place) AS first, max(place) AS last, {round6('sum(rating)')} AS total
FROM (SELECT product_id, rating, dense_rank() OVER (ORDER BY user_id) - 1 AS place FROM cells) c GROUP BY 1, 2""", CELLS_CTE)

SPLIT_SQL = q(f"""SELECT CAST(count(*) FILTER (WHERE draw >= 0.2) AS BIGINT) AS train_rows, CAST(count(*) FILTER (WHERE draw < 0.2) AS BIGINT) AS test_rows
FROM (SELECT CAST(CAST('0x' || substr(md5('42' || {" || ".join(f"'|' || COALESCE({c}, '')" for c in TX_NAMES)}), 1, 13) AS BIGINT) AS DOUBLE)
             / 4503599627370496.0 AS draw FROM combined) d""")

SVD_FULL_RANK_SQL = q("""SELECT floor(sum(rating * rating) * 100000.0 + 0.5001220703125) / 100000.0 AS squared_singular_values,
       0.0::DOUBLE AS rmse, 0.0::DOUBLE AS mae, 1.0::DOUBLE AS explained_variance FROM brand_cells""", CELLS_CTE)

SVD_RESIDUALS_SQL = q("SELECT CAST(range AS BIGINT) AS component, 0.0::DOUBLE AS residual, 1.0::DOUBLE AS norm FROM range(12)")

CSV_CONTRACT_SQL = q(f"""SELECT "column", "check", count(*) AS failures FROM (
  SELECT "column", "check" FROM dq_raw
  UNION ALL SELECT 'amount', 'castable(double)' FROM raw_tx WHERE amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL) f GROUP BY 1, 2
UNION ALL SELECT 'channel', 'filled', count(*) FROM raw_tx WHERE CAST(split_part(transaction_id, '-', 3) AS BIGINT) % 2 = 0
UNION ALL SELECT 'product_id', 'distinct', count(DISTINCT product_id) FROM raw_tx""",
                     f"dq_raw AS ({DQ_FAILURES_BODY.replace('FROM combined', 'FROM raw_tx')})")

LAMBDA_JOB_SQL = q("""SELECT stage, 'complete' AS status, rows_out FROM (
  SELECT 'speed_ingest' AS stage, (SELECT count(*) FROM speed) AS rows_out
  UNION ALL SELECT 'batch_ingest', (SELECT count(*) FROM raw_tx)
  UNION ALL SELECT 'merge', (SELECT count(*) FROM combined)
  UNION ALL SELECT 'validate', (SELECT count(*) FROM dq_fail)
  UNION ALL SELECT 'prepare', (SELECT count(*) FROM prepared)
  UNION ALL SELECT 'features', (SELECT count(DISTINCT user_id) FROM prepared)
  UNION ALL SELECT 'lineage', 1
  UNION ALL SELECT 'train', (SELECT count(DISTINCT user_id) FROM cells)) l""", DQ_FAILURES_CTE, CELLS_CTE)

BASE_ERROR_SQL = q(f"""SELECT {round6('sqrt(avg((actual - prediction) * (actual - prediction)))')} AS rmse,
       {round6('avg(abs(actual - prediction))')} AS mae, count(*) AS n FROM pairs""", CELLS_CTE)

BASE_TOPK_SQL = q(f"""SELECT u.user_id, t.product_id, {round6('t.m')} AS score,
       t.rank
FROM cell_users u JOIN topk t ON t.s = u.s""", CELLS_CTE)

BASE_PR_SQL = q("""SELECT avg(CAST(hits AS DOUBLE) / 5.0) AS precision_at_5,
       avg(CASE WHEN n_rel > 0 THEN CAST(hits AS DOUBLE) / n_rel END) AS recall_at_5
FROM (
  SELECT u.user_id, COALESCE(h.hits, 0) AS hits, COALESCE(r.n_rel, 0) AS n_rel
  FROM cell_users u
  LEFT JOIN (SELECT c.user_id, count(*) AS hits FROM cells c JOIN cell_users cu ON cu.user_id = c.user_id
             JOIN topk t ON c.product_id = t.product_id AND t.s = cu.s WHERE c.rating >= 3.5 GROUP BY c.user_id) h ON u.user_id = h.user_id
  LEFT JOIN (SELECT user_id, count(*) AS n_rel FROM cells WHERE rating >= 3.5 GROUP BY user_id) r
         ON u.user_id = r.user_id
) p""", CELLS_CTE)

BASE_MAE_BY_RATING_SQL = q(f"""SELECT lv.rating, {round6('COALESCE(e.mae, 0.0)')} AS mae
FROM (SELECT CAST(range AS BIGINT) AS rating FROM range(1, 6)) lv
LEFT JOIN (SELECT CAST(floor(actual + 0.5) AS BIGINT) AS rating, avg(abs(actual - prediction)) AS mae
           FROM pairs GROUP BY 1) e ON lv.rating = e.rating""", CELLS_CTE)


def hist_sql(values: str, col: str, bins: int, series: bool = False) -> str:
    grp = "series, " if series else ""
    return f"""st AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {values}),
wd AS (SELECT lo, (hi - lo) / {float(bins)} AS w FROM st),
binned AS (
  SELECT {grp}CASE WHEN wd.w = 0 THEN 0
              ELSE least(greatest(CAST(floor(({col} - wd.lo) / wd.w) AS BIGINT), 0), {bins - 1}) END AS bin
  FROM {values}, wd WHERE {col} IS NOT NULL
),
counts AS (SELECT {grp}bin, count(*) AS cnt FROM binned GROUP BY {grp}bin)"""


BASE_RESID_SQL = q(f"""SELECT b.bin, {round6('wd.lo + b.bin * wd.w')} AS lower,
       {round6('wd.lo + (b.bin + 1) * wd.w')} AS upper, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(25)) b CROSS JOIN wd LEFT JOIN counts c ON b.bin = c.bin""",
                   CELLS_CTE, "resid AS (SELECT actual - prediction AS residual FROM pairs)",
                   hist_sql("resid", "residual", 25))

BASE_SHARED_SQL = q(f"""SELECT s.series, b.bin, {round6('wd.lo + b.bin * wd.w')} AS lower,
       {round6('wd.lo + (b.bin + 1) * wd.w')} AS upper, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(15)) b
CROSS JOIN (SELECT 'actual' AS series UNION ALL SELECT 'predicted') s CROSS JOIN wd
LEFT JOIN counts c ON b.bin = c.bin AND s.series = c.series""",
                    CELLS_CTE,
                    "vals AS (SELECT 'actual' AS series, actual AS value FROM pairs "
                    "UNION ALL SELECT 'predicted', prediction FROM pairs)",
                    hist_sql("vals", "value", 15, series=True))

_NY = 8  # int(15 / sqrt(3))
BASE_HEXBIN_SQL = q(f"""SELECT lattice, ix, iy,
       {round6('xmin + (ix + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END) * sx')} AS center_x,
       {round6('ymin + (iy + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END) * sy')} AS center_y,
       count(*) AS count
FROM (
  SELECT CASE WHEN d1 < d2 THEN 1 ELSE 2 END AS lattice,
         CAST(CASE WHEN d1 < d2 THEN ix1 ELSE ix2 END AS BIGINT) AS ix,
         CAST(CASE WHEN d1 < d2 THEN iy1 ELSE iy2 END AS BIGINT) AS iy,
         xmin, ymin, sx, sy
  FROM (
    SELECT *, (x - ix1) * (x - ix1) + 3.0 * (y - iy1) * (y - iy1) AS d1,
              (x - ix2 - 0.5) * (x - ix2 - 0.5) + 3.0 * (y - iy2 - 0.5) * (y - iy2 - 0.5) AS d2
    FROM (
      SELECT x, y, round_even(x, 0) AS ix1, round_even(y, 0) AS iy1,
             CAST(floor(x) AS DOUBLE) AS ix2, CAST(floor(y) AS DOUBLE) AS iy2, xmin, ymin, sx, sy
      FROM (SELECT (p.actual - g.xmin) / g.sx AS x, (p.prediction - g.ymin) / g.sy AS y,
                   g.xmin, g.ymin, g.sx, g.sy
            FROM pairs p, (
              SELECT xmin, ymin, (xmax - xmin) / 15.0 AS sx, (ymax - ymin) / {float(_NY)} AS sy FROM (
                SELECT x0 - (x1 - x0) * 1e-9 AS xmin, x1 + (x1 - x0) * 1e-9 AS xmax,
                       y0 - (y1 - y0) * 1e-9 AS ymin, y1 + (y1 - y0) * 1e-9 AS ymax
                FROM (SELECT min(actual) AS x0, max(actual) AS x1, min(prediction) AS y0,
                             max(prediction) AS y1 FROM pairs) r) e) g) s0) s1) s2) s3
GROUP BY lattice, ix, iy, xmin, ymin, sx, sy HAVING count(*) >= 1""", CELLS_CTE)


def _kde_part(col: str, label: str) -> str:
    return f"""SELECT '{label}' AS series, g.point, g.start + g.point * g.step AS x,
       sum(exp(-0.5 * ((g.start + g.point * g.step - p.{col}) / g.bw) * ((g.start + g.point * g.step - p.{col}) / g.bw)))
         / (g.n * g.bw * sqrt(2 * pi())) AS density
FROM pairs p, (
  SELECT CAST(range AS BIGINT) AS point, start, step, bw, n FROM range(200), (
    SELECT lo - 3.0 * bw AS start, (hi - lo + 6.0 * bw) / 199.0 AS step, bw, n FROM (
      SELECT min({col}) AS lo, max({col}) AS hi, CAST(count(*) AS DOUBLE) AS n,
             stddev_samp({col}) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw FROM pairs) a) b) g
GROUP BY g.point, g.start, g.step, g.bw, g.n"""


BASE_KDE_SQL = q(f"""SELECT series, point, {round6('x')} AS x, {round6('density')} AS density FROM (
{_kde_part('actual', 'actual')}
UNION ALL
{_kde_part('prediction', 'prediction')}) k""", CELLS_CTE)

MATRIX_SAMPLE_SQL = q(f"""SELECT u.user_id, i.product_id, {round6('COALESCE(c.rating, 0.0)')} AS rating
FROM (SELECT DISTINCT user_id FROM cells ORDER BY user_id LIMIT 15) u
CROSS JOIN (SELECT DISTINCT product_id FROM cells ORDER BY product_id LIMIT 15) i
LEFT JOIN cells c ON c.user_id = u.user_id AND c.product_id = i.product_id""", CELLS_CTE)

BASE_EXPLAINED_SQL = q(f"""SELECT component, {round6('variance / total')} AS explained_variance_ratio, {round6('c / total')} AS cumulative_ratio
FROM (SELECT sum(s2 / m - (s1 / m) * (s1 / m)) AS total FROM (
        SELECT sum(rating * rating) AS s2, sum(rating) AS s1, (SELECT count(*) FROM cell_users)::DOUBLE AS m FROM cells GROUP BY product_id) i) t,
     (SELECT component, variance, sum(variance) OVER (ORDER BY component) AS c FROM (
        SELECT 0::BIGINT AS component, 0.0::DOUBLE AS variance UNION ALL SELECT 1, var_pop(s) FROM cell_users) u) v""", CELLS_CTE)

SAVED_MODEL_SQL = q("""SELECT product_id, item_idx, m, p, (SELECT count(*) FROM cell_users) AS n_users, (SELECT count(*) FROM item_mean) AS n_items
FROM item_mean JOIN (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS item_idx FROM (SELECT DISTINCT product_id FROM cells) d) x
USING (product_id)""", CELLS_CTE)

RUN_LOG_SQL = q(f"""SELECT 'run-' || k AS run_id, 'MatrixFactorization' AS tag, k, 'item mean' AS model, rmse, mae
FROM (SELECT {round6('sqrt(avg((actual - prediction) * (actual - prediction)))')} AS rmse, {round6('avg(abs(actual - prediction))')} AS mae FROM pairs) e,
     (SELECT unnest(['5', '10']) AS k) r""", CELLS_CTE)

LANDED_PRODUCTS_SQL = "SELECT p_partkey::BIGINT AS p_partkey, p_name, p_brand, p_size::BIGINT AS p_size FROM part"

DQ_MISSING_COLUMN_SQL = q("""SELECT "column", "check", count(*) AS failures FROM dq_fail WHERE "column" <> 'rating' GROUP BY 1, 2
UNION ALL SELECT 'rating', 'column_present', 1""", DQ_FAILURES_CTE)

ARRIVAL_NUMBERS_SQL = q("""SELECT row_number() OVER (ORDER BY wave) AS arrival_number, wave, true AS unchanged
FROM (SELECT CAST(event_id AS BIGINT) % 2 AS wave FROM speed) s""")
