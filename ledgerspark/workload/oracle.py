"""Independent SQL for the registered queries, on the given tables.

Money is integer cents throughout and rounded half up by integer arithmetic; timestamps are text.
"""

from __future__ import annotations

PARTS: dict[str, str] = {}

PARTS["raw_transactions"] = """
SELECT 'T' || k AS transaction_id,
       'C' || o_custkey AS customer_id,
       'B' || l_suppkey AS branch_id,
       CASE WHEN k % 89 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'ATM'
            WHEN l_returnflag = 'N' THEN ' web' WHEN l_returnflag = 'R' THEN 'mobile '
            ELSE l_returnflag END AS channel,
       CASE o_orderstatus WHEN 'F' THEN 'withdrawal' WHEN 'O' THEN 'deposit'
            WHEN 'P' THEN 'transfer' ELSE o_orderstatus END AS transaction_type,
       CASE WHEN k % 101 <> 0 THEN l_extendedprice END AS amount,
       CASE WHEN k % 97 <> 0 THEN
            CASE (l_suppkey + CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 0 END) % 4
                 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'AUD' END
       END AS currency,
       strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
           AS "timestamp",
       CASE l_linestatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
            ELSE l_linestatus END AS status
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey
"""

PARTS["raw_customers"] = """
SELECT 'C' || k AS customer_id,
       CASE WHEN k % 3 = 0 THEN '  ' || c_name ELSE c_name END AS name,
       CASE WHEN k % 11 = 0 THEN 'no-at-sign'
            ELSE 'user' || k || '@bank' || (k % 5) || '.example' END AS email,
       CASE WHEN k % 13 = 0 THEN 'n/a'
            ELSE '(555) ' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '-'
                 || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS phone,
       CASE WHEN k % 71 = 0 THEN NULL WHEN k % 17 = 0 THEN 'Main St'
            WHEN k % 19 = 0 THEN 'Main St 99999999999'
            ELSE k || ' Main St, ' || lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END AS address,
       CAST(500 + k % 351 - age AS INTEGER) AS credit_score,
       CASE WHEN k % 53 <> 0
            THEN DATE '1995-01-01' + CAST((k * 37) % 2500 AS INTEGER) END AS join_date,
       TIMESTAMP '2001-01-02 00:00:00' - to_days(CAST(age AS INTEGER))
           - to_minutes(CAST(k % 1440 AS INTEGER)) AS last_update,
       lower(c_mktsegment) AS customer_type
FROM (SELECT *, c_custkey AS k FROM customer)
JOIN (VALUES (0), (1)) AS ages(age) ON age = 0 OR k % 29 = 0
"""

PARTS["raw_branches"] = """
SELECT 'B' || s_suppkey AS branch_id,
       s_name AS branch_name,
       CASE WHEN s_suppkey % 23 = 5 THEN NULL WHEN s_suppkey % 4 = 1 THEN n_name || '  '
            ELSE n_name END AS location,
       CASE WHEN s_suppkey % 31 <> 7 THEN lower(r_name) END AS timezone,
       CASE s_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'AUD' END
           AS currency
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

PARTS["rates"] = """
SELECT * FROM (VALUES ('USD', 10000), ('EUR', 9200), ('GBP', 7900), ('AUD', 15200))
    AS t(currency, r)
"""

PARTS["gazetteer"] = """
SELECT upper(trim(n_name)) AS place, n_nationkey * 3125 - 40000 AS thousandths,
       n_nationkey * 7 - 90 AS lon
FROM nation WHERE n_nationkey % 9 <> 4
"""

PARTS["latest_transactions"] = """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp" DESC NULLS LAST,
        customer_id DESC NULLS LAST, branch_id DESC NULLS LAST, channel DESC NULLS LAST,
        transaction_type DESC NULLS LAST, amount DESC NULLS LAST, currency DESC NULLS LAST,
        status DESC NULLS LAST) AS rn
    FROM raw_transactions)
WHERE rn = 1
"""

PARTS["cleaned_transactions"] = """
SELECT transaction_id, customer_id, branch_id, trim(coalesce(channel, 'web')) AS channel,
       trim(transaction_type) AS transaction_type, amount,
       trim(coalesce(currency, 'USD')) AS currency, "timestamp", trim(status) AS status
FROM latest_transactions WHERE amount BETWEEN 0 AND 100000
"""

PARTS["txn"] = """
SELECT transaction_id, customer_id, branch_id, upper(channel) AS channel,
       upper(transaction_type) AS transaction_type, amount, t.currency, "timestamp",
       upper(status) AS status,
       CAST(substr("timestamp", 1, 4) AS INTEGER) AS "year",
       CAST(substr("timestamp", 6, 2) AS INTEGER) AS "month",
       CAST(round(amount * 100) AS BIGINT) AS cents,
       (2 * CAST(round(amount * 100) AS BIGINT) * 10000 + coalesce(r, 10000))
           // (2 * coalesce(r, 10000)) AS usd
FROM cleaned_transactions t LEFT JOIN rates ON t.currency = rates.currency
"""

PARTS["silver_transactions"] = """
SELECT * EXCLUDE (cents, usd), usd / CAST(100 AS DOUBLE) AS "Amount_USD" FROM txn
"""

PARTS["cleaned_customers"] = """
SELECT customer_id, upper(trim(name)) AS name, upper(trim(email)) AS email,
       upper(trim(phone)) AS phone, upper(trim(address)) AS address, credit_score,
       coalesce(join_date, DATE '2000-01-01') AS join_date, last_update,
       upper(trim(customer_type)) AS customer_type
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY last_update DESC) AS rn
      FROM raw_customers)
WHERE rn = 1 AND address IS NOT NULL
  AND coalesce(join_date, DATE '2000-01-01') BETWEEN DATE '1995-06-01' AND DATE '2001-12-31'
"""

PARTS["cust"] = """
SELECT customer_id, name, email,
       TRY_CAST(regexp_replace(phone, '[^0-9]', '', 'g') AS BIGINT) AS phone, address,
       credit_score, join_date, strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update,
       customer_type, CAST(year(join_date) AS INTEGER) AS "year",
       CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END AS domain,
       TRY_CAST(regexp_extract(address, '([0-9]+)$', 1) AS INTEGER) AS postal_code
FROM cleaned_customers
"""

PARTS["cleaned_branches"] = """
SELECT branch_id, upper(trim(branch_name)) AS branch_name,
       upper(trim(coalesce(location, 'Unknown'))) AS location, upper(trim(timezone)) AS timezone,
       upper(trim(currency)) AS currency
FROM raw_branches WHERE timezone IS NOT NULL
"""

PARTS["branch"] = """
SELECT b.*, CAST(sign(thousandths) * ((abs(thousandths) + 5) // 10) AS DOUBLE)
           / CAST(100 AS DOUBLE) AS latitude,
       CAST(lon AS DOUBLE) AS longitude
FROM cleaned_branches b LEFT JOIN gazetteer ON b.location = place
"""

PARTS["event_txn"] = """
SELECT 'T' || event_id AS transaction_id,
       'C' || user_id AS customer_id,
       event_type AS channel, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
       value, CAST(round(value * 100) AS BIGINT) AS usd
FROM events
"""

PARTS["velocity"] = """
SELECT customer_id, "year", "month" FROM txn GROUP BY ALL HAVING count(*) > 2
"""

PARTS["flags"] = """
SELECT transaction_id, customer_id, "month", "year",
       CASE WHEN usd > 10000000 THEN 'pattern_anomaly' WHEN usd > 5000000 THEN 'unusual_amount'
            WHEN usd > 3000000 THEN 'watchlist_match' ELSE 'velocity_check' END AS flag_type,
       CAST(CASE WHEN usd > 10000000 THEN 0.85 WHEN usd > 5000000 THEN 0.75
            WHEN usd > 3000000 THEN 0.90 ELSE 0.60 END AS DOUBLE) AS confidence_score,
       "timestamp" AS transaction_datetime
FROM txn LEFT JOIN (SELECT *, TRUE AS busy FROM velocity) v
     USING (customer_id, "year", "month")
WHERE usd > 3000000 OR busy
"""

PARTS["members"] = """
SELECT customer_id, 'High_Value' AS segment_name,
       'Customers with high transaction volume' AS segment_description,
       TIMESTAMP '2001-11-01 00:00:00' AS last_update
FROM txn GROUP BY customer_id HAVING sum(cents) > 150000000
UNION ALL
SELECT customer_id, 'New_User', 'Customers who joined in last 30 days',
       TIMESTAMP '2001-11-01 00:00:00'
FROM cust WHERE join_date > DATE '2001-11-01' - 90
UNION ALL
SELECT customer_id, 'Inactive', 'No transactions in last 90 days', TIMESTAMP '2001-11-01 00:00:00'
FROM cust WHERE customer_id NOT IN (
    SELECT customer_id FROM txn WHERE "timestamp" > '2001-10-22 00:00:00')
UNION ALL
SELECT customer_id, 'Credit_Risk', 'Customers with low credit scores',
       TIMESTAMP '2001-11-01 00:00:00'
FROM cust WHERE credit_score < 600
UNION ALL
SELECT customer_id, 'Loyal', 'Consistent activity for over 5 years',
       TIMESTAMP '2001-11-01 00:00:00'
FROM cust WHERE join_date < DATE '2001-11-01' - 1825
"""

PARTS["last_txn"] = """
SELECT customer_id, max("timestamp") AS last_transaction_date,
       (SELECT max("timestamp") FROM txn) AS "current_date"
FROM txn GROUP BY customer_id
"""

PARTS["churn"] = """
SELECT *, datediff('day', CAST(substr(last_transaction_date, 1, 10) AS DATE),
                   CAST(substr("current_date", 1, 10) AS DATE)) AS days
FROM last_txn
"""


def with_parts(query: str) -> str:
    """Prefix ``query`` with the parts it needs, in their order of definition."""
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in PARTS.items())
    return f"WITH {ctes}\n{query}"


def dollars(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / CAST(100 AS DOUBLE)"


def mean_dollars(total: str, count: str) -> str:
    """Half-up mean of integer cents."""
    return dollars(f"((2 * {total} + {count}) // (2 * {count}))")


T5 = f"""{dollars('sum(usd)')} AS total_amount, {mean_dollars('sum(usd)', 'count(usd)')} AS average_amount,
    {dollars('min(usd)')} AS min_amount, {dollars('max(usd)')} AS max_amount,
    count(usd) AS transaction_count"""


def rollup(keys: str, source: str = "txn") -> str:
    return f"SELECT {keys}, {T5} FROM {source} GROUP BY ALL"


def profile(table: str, numeric: list[str], other: list[str], distinct: bool = True) -> str:
    rows = []
    for column in [*numeric, *other]:
        moments = (
            f'round(avg("{column}"), 4), round(stddev("{column}"), 4), '
            f'CAST(min("{column}") AS DOUBLE), CAST(max("{column}") AS DOUBLE)'
            if column in numeric
            else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
            "CAST(NULL AS DOUBLE)"
        )
        unique = f'count(DISTINCT "{column}"), ' if distinct else ""
        rows.append(
            f"SELECT '{column}', count(*), count(\"{column}\"), count(*) - count(\"{column}\"), "
            f"{unique}{moments} FROM {table}"
        )
    unique = "unique_count, " if distinct else ""
    return (
        "SELECT * FROM (" + " UNION ALL ".join(rows) + ") AS p(column_name, total_count, "
        f"non_null_count, null_count, {unique}mean, stddev, min, max)"
    )


def detector(limit_cents: int, score: str) -> str:
    return (
        "SELECT transaction_id, customer_id, \"year\", \"month\", "
        f"CAST({score} AS DOUBLE) AS score FROM txn WHERE usd > {limit_cents}"
    )


FLAG_IDENTITY = 'transaction_id, customer_id, "year", "month", "timestamp"'
OUTER_FLAGS = f"""
SELECT transaction_id, customer_id, "month", "year",
       CASE WHEN p IS NOT NULL THEN 'pattern_anomaly' WHEN u IS NOT NULL THEN 'unusual_amount'
            WHEN w IS NOT NULL THEN 'watchlist_match' ELSE 'velocity_check' END AS flag_type,
       coalesce(p, u, w, v) AS confidence_score, "timestamp" AS transaction_datetime
FROM (SELECT {FLAG_IDENTITY}, CAST(CASE WHEN usd > 10000000 THEN 0.85 END AS DOUBLE) AS p FROM txn)
FULL JOIN (SELECT {FLAG_IDENTITY}, CAST(CASE WHEN usd > 5000000 THEN 0.75 END AS DOUBLE) AS u FROM txn)
    USING ({FLAG_IDENTITY})
FULL JOIN (SELECT {FLAG_IDENTITY}, CAST(CASE WHEN usd > 3000000 THEN 0.90 END AS DOUBLE) AS w FROM txn)
    USING ({FLAG_IDENTITY})
FULL JOIN (SELECT {FLAG_IDENTITY}, CAST(CASE WHEN busy THEN 0.60 END AS DOUBLE) AS v
           FROM txn LEFT JOIN (SELECT *, TRUE AS busy FROM velocity) USING (customer_id, "year", "month"))
    USING ({FLAG_IDENTITY})
WHERE coalesce(p, u, w, v) IS NOT NULL
"""


def numbered(prefix: str, order: str) -> str:
    number = f"CAST(row_number() OVER (ORDER BY {order}) + 1000 AS VARCHAR)"
    return f"'{prefix}' || lpad({number}, CAST(greatest(4, length({number})) AS INTEGER), '0')"


CHANNEL_ORDER = 'PARTITION BY channel ORDER BY "timestamp", transaction_id'
ROLLING = f"{CHANNEL_ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
DAILY = "PARTITION BY channel ORDER BY \"date\" RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"

TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "branch_id", "channel", "transaction_type", "amount",
    "currency", "timestamp", "status",
]
NULLS = ", ".join(
    f'CAST(count(*) - count("{c}") AS BIGINT) AS "{c}"' for c in TRANSACTION_COLUMNS
)

PROFILE = profile(
    "raw_transactions", ["amount"], [c for c in TRANSACTION_COLUMNS if c != "amount"], distinct=False
)

QUERIES = {
    # sources and sinks: what is read back equals what was written
    "scan_csv": "SELECT * FROM raw_customers",
    "scan_table": "SELECT * FROM raw_branches",
    "sink_overwrite": "SELECT * FROM raw_transactions",
    "sink_csv": "SELECT * FROM raw_transactions",
    "stream_ingest": "SELECT * FROM raw_transactions",
    # cleaning
    "dedup_any": "SELECT DISTINCT transaction_id FROM raw_transactions",
    "fill_then_drop": """SELECT * REPLACE (coalesce(channel, 'web') AS channel,
        coalesce(currency, 'USD') AS currency) FROM raw_transactions WHERE amount IS NOT NULL""",
    "cast_columns": """SELECT customer_id, TRY_CAST(phone AS BIGINT) AS phone,
        CAST(credit_score AS DOUBLE) AS credit_score, CAST(join_date AS VARCHAR) AS join_date
        FROM raw_customers""",
    "trim_strings": """SELECT * REPLACE (trim(name) AS name, trim(email) AS email,
        trim(phone) AS phone, trim(address) AS address, trim(customer_type) AS customer_type)
        FROM raw_customers""",
    "range_filter": "SELECT * FROM raw_transactions WHERE amount BETWEEN 0 AND 100000",
    "uniqueness_violations": """SELECT transaction_id, count(*) AS row_count
        FROM raw_transactions GROUP BY 1 HAVING count(*) > 1""",
    "upper_strings": """SELECT * REPLACE (upper(transaction_id) AS transaction_id,
        upper(channel) AS channel, upper(transaction_type) AS transaction_type,
        upper(status) AS status) FROM raw_transactions""",
    "flag_anomalies": """SELECT transaction_id, amount, currency,
        coalesce(amount > 100000, FALSE) OR currency IS NULL AS anomaly_flag
        FROM raw_transactions""",
    "dedup_latest": "SELECT * FROM latest_transactions",
    "clean_customers": "SELECT * FROM cleaned_customers",
    "clean_branches": "SELECT * FROM cleaned_branches",
    "clean_transactions": """SELECT * REPLACE (CAST("timestamp" AS TIMESTAMP) AS "timestamp")
        FROM cleaned_transactions""",
    # profiling
    "profile_exact": profile(
        "raw_transactions",
        ["amount"],
        [c for c in TRANSACTION_COLUMNS if c != "amount"],
    ),
    "profile_approx": f"SELECT *, TRUE AS unique_within_bound FROM ({PROFILE})",
    "null_counts": f"SELECT {NULLS} FROM raw_transactions",
    # enrichment
    "format_dates": """SELECT customer_id, join_date,
        strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update FROM raw_customers""",
    "date_parts": """SELECT transaction_id, CAST(substr("timestamp", 1, 4) AS INTEGER) AS "year",
        CAST(substr("timestamp", 6, 2) AS INTEGER) AS "month",
        CAST(substr("timestamp", 9, 2) AS INTEGER) AS "day" FROM raw_transactions""",
    "phone_digits": """SELECT customer_id,
        TRY_CAST(regexp_replace(phone, '[^0-9]', '', 'g') AS BIGINT) AS phone
        FROM raw_customers""",
    "email_domain": """SELECT customer_id,
        CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) END AS domain
        FROM raw_customers""",
    "postal_code": """SELECT customer_id,
        TRY_CAST(regexp_extract(address, '([0-9]+)$', 1) AS INTEGER) AS postal_code
        FROM raw_customers""",
    "geo_lookup": "SELECT branch_id, location, latitude, longitude FROM branch",
    "currency_to_usd": 'SELECT transaction_id, currency, amount, "Amount_USD" FROM silver_transactions',
    "silver_customers": "SELECT * FROM cust",
    "silver_branches": "SELECT * FROM branch",
    "silver_transactions": "SELECT * FROM silver_transactions",
    # joins
    "txn_with_location": """SELECT t.*, location, timezone
        FROM silver_transactions t LEFT JOIN branch b ON t.branch_id = b.branch_id""",
    "join_three": """SELECT t.* FROM silver_transactions t JOIN cust USING (customer_id)
        JOIN branch ON t.branch_id = branch.branch_id""",
    "full_outer_flags": OUTER_FLAGS,
    "monthly_counts": """SELECT "year", "month", customer_id, count(*) AS monthly_count
        FROM txn GROUP BY ALL""",
    # rollups
    "customer_type_agg": f"""SELECT customer_type, count(DISTINCT customer_id) AS total_customers,
        {dollars('sum(cents)')} / count(cents) AS avg_transaction_amount,
        {dollars('sum(cents)')} AS total_spend
        FROM txn JOIN cust USING (customer_id) GROUP BY customer_type""",
    "active_churned": """SELECT count(*) FILTER (days <= 180) AS active_customers,
        count(*) FILTER (days > 180) AS churned_customers FROM churn""",
    "agg_customer": rollup("customer_id"),
    "currency_analysis": f"""SELECT currency, {dollars('sum(usd)')} AS total_amount_by_currency,
        {dollars('sum(usd)')} / count(usd) AS avg_amount_by_currency FROM txn GROUP BY currency""",
    "agg_branch": rollup("branch_id"),
    "agg_location": rollup("location", "txn LEFT JOIN branch USING (branch_id)"),
    "agg_timezone": rollup("timezone", "txn LEFT JOIN branch USING (branch_id)"),
    "agg_currency": rollup("currency"),
    "agg_channel": rollup("channel"),
    "agg_txn_type": rollup("transaction_type"),
    "agg_year_month": rollup('"year", "month"'),
    "agg_date": rollup('CAST(substr("timestamp", 1, 10) AS DATE) AS "date"'),
    "agg_status": rollup("status"),
    "agg_channel_type": rollup("channel, transaction_type"),
    "segment_counts": 'SELECT segment_name, count(*) AS "count" FROM members GROUP BY 1',
    "value_tiers": f"""SELECT customer_id, {dollars('sum(usd)')} AS total_amount_usd,
        CASE WHEN sum(usd) <= 250000 THEN 'Low Value' WHEN sum(usd) <= 350000 THEN 'Medium Value'
             ELSE 'High Value' END AS segment
        FROM event_txn GROUP BY customer_id""",
    "last_transaction": "SELECT * FROM last_txn",
    "churn_status": """SELECT customer_id, last_transaction_date, "current_date",
        CAST(days AS INTEGER) AS days_since_last_transaction,
        CASE WHEN days > 180 THEN 'Churned' ELSE 'Active' END AS churn_status FROM churn""",
    "peak_offpeak": f"""SELECT CASE WHEN CAST(substr("timestamp", 12, 2) AS INTEGER)
            BETWEEN 8 AND 18 THEN 'Peak' ELSE 'Off-Peak' END AS time_period,
        {dollars('sum(usd)')} AS total_amount_usd,
        {mean_dollars('sum(usd)', 'count(usd)')} AS average_amount_usd,
        count(usd) AS transaction_count FROM txn GROUP BY 1""",
    "amount_histogram": """SELECT CASE WHEN usd <= 5000 THEN '0-50' WHEN usd <= 10000 THEN '50-100'
            WHEN usd <= 50000 THEN '100-500' WHEN usd <= 100000 THEN '500-1000'
            WHEN usd <= 500000 THEN '1000-5000' WHEN usd <= 1000000 THEN '5000-10000'
            ELSE '10000+' END AS amount_range, count(*) AS transaction_count
        FROM (SELECT usd FROM txn UNION ALL SELECT usd FROM event_txn) GROUP BY 1""",
    "median_exact": f"""SELECT channel, {dollars('quantile_disc(usd, 0.5)')} AS median_amount_usd
        FROM txn GROUP BY channel""",
    "median_approx": """SELECT channel, count(usd) AS transaction_count, TRUE AS median_within_bound
        FROM txn GROUP BY channel""",
    "percent_of_total": f"""SELECT channel, {dollars('sum(usd)')} AS total_amount_usd,
        {dollars('(2 * sum(usd) * 10000 + any_value(g)) // (2 * any_value(g))')}
            AS percentage_of_total
        FROM txn, (SELECT sum(usd) AS g FROM txn) GROUP BY channel""",
    "recent_customers": """SELECT DISTINCT customer_id FROM txn
        WHERE "timestamp" > '2001-10-22 00:00:00'""",
    # segments
    **{
        f"segment_{name.lower()}": f"SELECT * FROM members WHERE segment_name = '{name}'"
        for name in ("High_Value", "New_User", "Inactive", "Credit_Risk", "Loyal")
    },
    "customer_segmentation": f"""SELECT {numbered('S', 'customer_id, segment_name')} AS segment_id,
        * FROM members""",
    # fraud flags
    "fraud_pattern": """SELECT transaction_id, CAST(0.85 AS DOUBLE) AS pattern_anomaly FROM txn
        WHERE usd > 10000000""",
    "fraud_unusual": """SELECT transaction_id, CAST(0.75 AS DOUBLE) AS unusual_amount FROM txn
        WHERE usd > 5000000""",
    "fraud_watchlist": """SELECT transaction_id, CAST(0.90 AS DOUBLE) AS watchlist_match FROM txn
        WHERE usd > 3000000""",
    "fraud_velocity": """SELECT transaction_id, CAST(0.60 AS DOUBLE) AS velocity_check
        FROM txn JOIN velocity USING (customer_id, "year", "month")""",
    "fraud_flags": f"SELECT *, {numbered('F', 'transaction_id')} AS flag_id FROM flags",
    # windows
    "last_txn_window": """SELECT transaction_id, customer_id, "timestamp",
        max("timestamp") OVER (PARTITION BY customer_id) AS last_transaction_date FROM txn""",
    "cumulative_sum": f"""SELECT transaction_id, channel, "timestamp",
        {dollars('usd')} AS "Amount_USD",
        {dollars(f'sum(usd) OVER ({CHANNEL_ORDER} ROWS UNBOUNDED PRECEDING)')} AS cumulative_sum
        FROM txn""",
    "rolling_avg_rows": f"""SELECT transaction_id, channel, "timestamp",
        {dollars('usd')} AS "Amount_USD",
        {dollars(f'((2 * sum(usd) OVER ({ROLLING}) + count(usd) OVER ({ROLLING}))'
                 f' // (2 * count(usd) OVER ({ROLLING})))')} AS rolling_avg_amount_usd
        FROM txn""",
    "rolling_avg_days": f"""SELECT channel, "date",
        {dollars(f'((2 * sum(s) OVER ({DAILY}) + sum(n) OVER ({DAILY}))'
                 f' // (2 * sum(n) OVER ({DAILY})))')} AS rolling_avg_amount_usd
        FROM (SELECT channel, CAST(substr("timestamp", 1, 10) AS DATE) AS "date",
                     sum(usd) AS s, count(usd) AS n FROM txn GROUP BY ALL)""",
    "sequential_ids": f"""SELECT transaction_id, {numbered('N', '"timestamp", transaction_id')}
        AS sequence_id FROM txn""",
    # streams
    "stream_profile": f"SELECT *, TRUE AS unique_within_bound FROM ({PROFILE})",
    "stream_customers": "SELECT * FROM raw_customers",
    "stream_silver": f"""SELECT transaction_id, customer_id, 'B0' AS branch_id,
        upper(channel) AS channel, 'PAYMENT' AS transaction_type, amount, currency, "timestamp",
        'COMPLETED' AS status, CAST(substr("timestamp", 1, 4) AS INTEGER) AS "year",
        CAST(substr("timestamp", 6, 2) AS INTEGER) AS "month",
        {dollars('((2 * cents * 10000 + r) // (2 * r))')} AS "Amount_USD"
        FROM (SELECT e.transaction_id, e.customer_id, e.channel, e."timestamp", e.value AS amount,
                     e.usd AS cents, CASE WHEN event_id % 97 = 0 THEN 'USD'
                         WHEN event_id % 4 = 0 THEN 'USD' WHEN event_id % 4 = 1 THEN 'EUR'
                         WHEN event_id % 4 = 2 THEN 'GBP' ELSE 'AUD' END AS currency
              FROM event_txn e JOIN events
                   ON e.transaction_id = 'T' || event_id
              WHERE event_id % 101 <> 0 AND e.value BETWEEN 0 AND 100000)
        JOIN rates USING (currency)""",
    # audits
    "audit_integrity": """SELECT violation, count(*) AS transaction_count FROM (
        SELECT CASE WHEN c.customer_id IS NULL THEN 'unknown_customer'
                    WHEN t."timestamp" < CAST(join_date AS VARCHAR) || ' 00:00:00'
                        THEN 'before_join_date' END AS violation
        FROM txn t LEFT JOIN cust c ON t.customer_id = c.customer_id
        UNION ALL
        SELECT 'unknown_branch' FROM txn WHERE branch_id NOT IN (SELECT branch_id FROM branch))
        WHERE violation IS NOT NULL GROUP BY 1""",
    "audit_currency": """SELECT transaction_id, t.branch_id, t.currency,
        b.currency AS branch_currency
        FROM txn t JOIN branch b ON t.branch_id = b.branch_id AND t.currency <> b.currency""",
    "audit_status_conflicts": """SELECT transaction_id, count(DISTINCT status) AS status_count
        FROM raw_transactions GROUP BY 1 HAVING count(DISTINCT status) > 1""",
    "missing_rates": """SELECT t.currency, count(*) AS rate_missing FROM cleaned_transactions t
        WHERE t.currency NOT IN ('USD', 'EUR') GROUP BY 1""",
}


# The columns of the bootstrapped tables.
LAYER_COLUMNS = {
    ("bronze", "customers_raw", "raw_customers"): "customer_id string, name string, email string, "
    "phone string, address string, credit_score int, join_date date, last_update timestamp, "
    "customer_type string",
    ("bronze", "branches_raw", "raw_branches"): "branch_id string, branch_name string, "
    "location string, timezone string, currency string",
    ("bronze", "transactions_raw", "raw_transactions"): "transaction_id string, "
    "customer_id string, branch_id string, channel string, transaction_type string, "
    "amount double, currency string, timestamp string, status string",
    ("silver", "cat_customers", "cust"): "customer_id string, name string, email string, "
    "phone bigint, address string, credit_score int, join_date date, last_update string, "
    "customer_type string, year int, domain string, postal_code int",
    ("silver", "cat_branches", "branch"): "branch_id string, branch_name string, "
    "location string, timezone string, currency string, latitude double, longitude double",
    ("silver", "cat_transactions", "txn"): "transaction_id string, customer_id string, "
    "branch_id string, channel string, transaction_type string, amount double, currency string, "
    "timestamp string, status string, year int, month int, Amount_USD double",
}


def catalog_bootstrap() -> str:
    parts = []
    for (layer, table, source), columns in LAYER_COLUMNS.items():
        pairs = [column.split(" ") for column in columns.split(", ")]
        values = ", ".join(f"('{name}', '{kind}')" for name, kind in pairs)
        parts.append(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, column_name, data_type, row_count "
            f"FROM (VALUES {values}) AS c(column_name, data_type), "
            f"(SELECT count(*) AS row_count FROM {source})"
        )
    return " UNION ALL ".join(parts)


SILVER_COLUMNS = f"{' '.join(TRANSACTION_COLUMNS)} year month Amount_USD"
T5_COLUMNS = "total_amount average_amount min_amount max_amount transaction_count"
DOUBLES = set(
    "confidence_score total_amount average_amount min_amount max_amount total_spend avg_transaction_amount "
    "total_amount_by_currency avg_amount_by_currency amount Amount_USD total_amount_usd average_amount_usd "
    "percentage_of_total rolling_avg_amount_usd".split()
)

# The published tables: the query each one equals, and its columns.
GOLD = {
    "customer_segmentation_table": (
        "customer_segmentation", "segment_id customer_id segment_name segment_description last_update"),
    "fraud_flags_table": (
        "fraud_flags", "transaction_id customer_id month year flag_type confidence_score "
        "transaction_datetime flag_id"),
    "segment_count_table": ("segment_counts", "segment_name count"),
    "customer_segmentation": (
        "customer_type_agg", "customer_type total_customers avg_transaction_amount total_spend"),
    "customer_aggregations_table": ("agg_customer", f"customer_id {T5_COLUMNS}"),
    "currency_analysis": (
        "currency_analysis", "currency total_amount_by_currency avg_amount_by_currency"),
    "branch_aggregations_table": ("agg_branch", f"branch_id {T5_COLUMNS}"),
    "transaction_with_location_table": ("txn_with_location", f"{SILVER_COLUMNS} location timezone"),
    "location_aggregations_table": ("agg_location", f"location {T5_COLUMNS}"),
    "timezone_aggregations_table": ("agg_timezone", f"timezone {T5_COLUMNS}"),
    "currency_aggregations_table": ("agg_currency", f"currency {T5_COLUMNS}"),
    "channel_aggregations_table": ("agg_channel", f"channel {T5_COLUMNS}"),
    "transaction_type_aggregations_table": ("agg_txn_type", f"transaction_type {T5_COLUMNS}"),
    "year_month_aggregations_table": ("agg_year_month", f"year month {T5_COLUMNS}"),
    "date_aggregations_table": ("agg_date", f"date {T5_COLUMNS}"),
    "status_aggregations_table": ("agg_status", f"status {T5_COLUMNS}"),
    "channel_type_aggregations_table": ("agg_channel_type", f"channel transaction_type {T5_COLUMNS}"),
    "customer_segments_table": ("value_tiers", "customer_id total_amount_usd segment"),
    "last_transaction_table": ("last_transaction", "customer_id last_transaction_date current_date"),
    "churn_table": (
        "churn_status", "customer_id last_transaction_date current_date days_since_last_transaction "
        "churn_status"),
    "peak_off_peak_table": (
        "peak_offpeak", "time_period total_amount_usd average_amount_usd transaction_count"),
    "transaction_frequency_table": ("amount_histogram", "amount_range transaction_count"),
    "median_table": ("median_exact", "channel"),
    "percentage_table": ("percent_of_total", "channel total_amount_usd percentage_of_total"),
    "rolling_avg_table": ("rolling_avg_rows", f"{SILVER_COLUMNS} rolling_avg_amount_usd"),
}


def published(name: str) -> str:
    """The query a published table equals, over the silver transactions alone."""
    query = QUERIES[name]
    if name == "value_tiers":
        return query.replace("event_txn", "txn")
    if name == "amount_histogram":
        return query.replace("UNION ALL SELECT usd FROM event_txn", "")
    if name == "rolling_avg_rows":
        return f"SELECT * FROM silver_transactions JOIN ({query}) USING (transaction_id, channel, \"timestamp\", \"Amount_USD\")"
    return query


def content_of(query: str, columns: str) -> str:
    """Rows, and an order-free sum of a hash of every row's values, columns by name."""
    texts = []
    for name in sorted(columns.split()):
        value = f'floor("{name}" * 10000 + CAST(0.5 AS DOUBLE))' if name in DOUBLES else f'"{name}"'
        value = f"CAST({value} AS BIGINT)" if name in DOUBLES else value
        texts.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    row = f"md5(concat_ws('|', {', '.join(texts)}))"
    number = f"CAST('0x' || substr({row}, 1, 8) AS BIGINT)"
    return f"count(*) AS row_count, CAST(coalesce(sum({number}), 0) AS BIGINT) AS content_hash FROM ({query})"


def publish_gold(without: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {content_of(published(name), columns)}"
        for table, (name, columns) in GOLD.items()
        if table not in without
    )


QUERIES["full_outer_skewed"] = f"""
SELECT transaction_id, {dollars('usd')} AS "Amount_USD", customer_id, name
FROM (SELECT transaction_id, usd, CASE WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0 THEN 'C1'
          WHEN customer_id LIKE '%9' THEN 'C0' ELSE customer_id END AS customer_id FROM txn)
FULL JOIN (SELECT customer_id, name FROM cust) USING (customer_id)"""
QUERIES["rescued_rows"] = QUERIES["stream_rescued"] = """
SELECT transaction_id, CASE WHEN NOT quarantined THEN amount END AS amount, quarantined
FROM (SELECT *, CAST(substr(transaction_id, 2) AS BIGINT) AS k,
             k % 50 = 0 OR k % 70 = 0 OR k % 90 = 0 AS quarantined FROM raw_transactions)"""
QUERIES["stream_widening"] = """
SELECT * REPLACE (CASE WHEN "timestamp" >= '1995' THEN channel END AS channel,
                  CASE WHEN "timestamp" >= '1995' THEN status END AS status) FROM raw_transactions"""
CHECKS = {
    "channel required": ("channel IS NULL", 0.02),
    "amount within 1000 and 50000": ("amount NOT BETWEEN 1000 AND 50000", 0.0),
    "currency one of USD, EUR, GBP": ("currency NOT IN ('USD', 'EUR', 'GBP')", 0.3),
    "channel matching ^[A-Za-z]+$": ("NOT regexp_matches(channel, '^[A-Za-z]+$')", 0.5),
}
QUERIES["rule_report"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS rule, count(*) AS row_count, count(*) FILTER ({broken}) AS violations,
        min(transaction_id) FILTER ({broken}) AS first_offender,
        max(transaction_id) FILTER ({broken}) AS last_offender, CAST({allowed} AS DOUBLE) AS allowed,
        count(*) FILTER ({broken}) <= CAST({allowed} AS DOUBLE) * count(*) AS passed FROM raw_transactions"""
    for name, (broken, allowed) in CHECKS.items()
)
BROKEN = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, (broken, _) in CHECKS.items())
QUERIES["broken_rules"] = f"SELECT transaction_id, concat_ws('; ', {BROKEN}) AS broken_rules FROM raw_transactions"
QUERIES["stream_latest"] = QUERIES["dedup_latest"]
QUERIES["stream_rollup"] = rollup('CAST(substr("timestamp", 1, 10) AS DATE) AS "date", channel')
QUERIES["catalog_bootstrap"] = catalog_bootstrap()
QUERIES["publish_gold"] = publish_gold()
QUERIES["incremental_gold"] = publish_gold(
    without=("fraud_flags_table", "transaction_with_location_table", "rolling_avg_table")
)
QUERIES["sketched_medians"] = QUERIES["median_approx"]
QUERIES["sketched_uniques"] = " UNION ALL ".join(
    f"SELECT '{column}' AS column_name, count(*) AS total_count, count(\"{column}\") AS non_null_count, "
    "TRUE AS unique_within_bound FROM silver_transactions"
    for column in "transaction_id customer_id branch_id channel transaction_type currency status Amount_USD".split()
)


def oracle_sql() -> dict[str, str]:
    return {name: with_parts(query) for name, query in QUERIES.items()}
