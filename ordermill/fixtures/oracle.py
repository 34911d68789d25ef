"""The registered queries as SQL for the check engine, written independently of the Spark plans.

EUR values are computed in whole units of 1e-13 EUR, each division rounded half up, so that sums
are exact and equal to decimal arithmetic to the last cent.
"""

from __future__ import annotations

from .orders import TODAY

# Fixed values of the landed pages (FIXTURES.md): mean lines of a page, distance of page offsets, modulus and steps of
# the number that deals lines to pages.
LINES_PER_PAGE = 500
PAGE_GAP = 4294967296
_MODULUS, _FACTOR, _STEP = 2147483647, 1103515245, 12345

EARLIER_TODAY = "2000-06-30"

RAW = """
numbered AS (
  SELECT *, l_orderkey * 8 + l_linenumber + l_partkey * 3 + l_suppkey AS n FROM lineitem),
base AS (
  SELECT numbered.*, o_custkey, CAST(o_orderdate AS DATE) AS od,
    ['BK', 'EL', 'BE', 'FA', 'HK', 'SP'][l_partkey % 6 + 1] AS code,
    lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS num,
    l_orderkey % 24 AS hh, l_orderkey % 60 AS mi,
    lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS hhmm,
    (o_custkey + CASE WHEN l_orderkey % 13 = 0 THEN 1 ELSE 0 END) % 4 AS cc
  FROM numbered JOIN orders ON l_orderkey = o_orderkey),
raw_once AS (
  SELECT n, [l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_quantity * 100) AS BIGINT),
      CAST(round(l_extendedprice * 100) AS BIGINT)] AS place,
    'ORD' || l_orderkey AS order_id,
    CASE WHEN l_orderkey % 89 <> 0 THEN o_custkey END AS customer_id,
    CASE WHEN l_orderkey % 97 = 0 THEN 'qa' || o_custkey || '@internal.example'
      ELSE 'c' || o_custkey || '@shop.example' END AS customer_email,
    CASE WHEN l_orderkey % 701 = 0 THEN 'not-a-date'
      WHEN l_orderkey % 5 = 3
        THEN CAST(datediff('day', DATE '1970-01-01', od) * 86400 + hh * 3600 + mi * 60 AS VARCHAR)
      WHEN l_orderkey % 5 = 4 THEN strftime(od, '%d/%m/%Y') || ' ' || hhmm
      WHEN l_orderkey % 5 = 2 THEN od || ' ' || hhmm || ':00'
      ELSE od || 'T' || hhmm || ':00' END AS order_ts,
    CASE WHEN l_orderkey % 97 = 0 THEN 'test' WHEN l_orderkey % 23 = 0 THEN 'refunded' ELSE 'completed' END AS status,
    CASE l_suppkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS channel,
    CASE WHEN n % 503 = 0 THEN 'ABC-' || code || '-9999'
      WHEN n % 11 = 0 THEN 'SKU' || code || num
      WHEN n % 11 = 1 THEN ' sku-' || lower(code) || num || ' '
      ELSE 'SKU-' || code || '-' || num END AS sku,
    'Product ' || l_partkey AS product_name,
    CASE WHEN n % 53 = 0 THEN NULL ELSE CASE code WHEN 'BK' THEN 'Books' WHEN 'EL' THEN 'Electronics'
      WHEN 'BE' THEN 'Beauty' WHEN 'FA' THEN 'Fashion' WHEN 'HK' THEN 'Home & Kitchen' ELSE 'Sports' END END AS category,
    CASE WHEN n % 59 = 0 THEN -1 ELSE CAST(l_quantity AS INTEGER) END AS qty,
    CAST(CASE WHEN n % 401 = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(12, 4)) AS unit_price,
    CASE WHEN cc = 0 AND l_orderkey % 2 = 0 THEN 'RON' ELSE 'EUR' END AS currency,
    CASE cc WHEN 0 THEN 'RO' WHEN 1 THEN 'DE' WHEN 2 THEN 'BG' ELSE 'HU' END AS country,
    od AS fx_reference_date
  FROM base),
raw_orders AS (
  SELECT list_append(place, copy) AS src_ord, * EXCLUDE (n, place, copy)
  FROM (SELECT *, unnest(CASE WHEN n % 49 = 0 THEN [0::BIGINT, 1::BIGINT] ELSE [0::BIGINT] END) AS copy FROM raw_once))"""

# Positions leave as text.
PLACE = "array_to_string(src_ord, ':') AS src_ord"

# One row per raw line with the cleaned columns next to the raw ones.
TYPED = """
stripped AS (SELECT *, trim(order_ts) AS ts_text, upper(trim(sku)) AS sku_text FROM raw_orders),
canonical AS (
  SELECT *, regexp_replace(sku_text, '^SKU-?([A-Z]{2})-?([0-9]{3})$', 'SKU-\\1-\\2') AS clean_sku,
    CASE WHEN regexp_full_match(ts_text, '[0-9]+') THEN make_timestamp(CAST(ts_text AS BIGINT) * 1000000)
      ELSE coalesce(try_strptime(ts_text, '%Y-%m-%dT%H:%M:%S'), try_strptime(ts_text, '%d/%m/%Y %H:%M'),
        try_strptime(ts_text, '%Y-%m-%d %H:%M:%S')) END AS clean_ts,
    CASE WHEN status = 'test' THEN 'test' WHEN qty < 0 THEN 'negative_qty' END AS reject_reason
  FROM stripped),
parted AS (
  SELECT *, CASE WHEN len(string_split(clean_sku, '-')) = 3 THEN CASE string_split(clean_sku, '-')[2]
      WHEN 'BK' THEN 'Books' WHEN 'EL' THEN 'Electronics' WHEN 'BE' THEN 'Beauty' WHEN 'FA' THEN 'Fashion'
      WHEN 'HK' THEN 'Home & Kitchen' WHEN 'SP' THEN 'Sports' END END AS inferred
  FROM canonical),
typed AS (
  SELECT *, coalesce(category, inferred) AS clean_category,
    customer_id IS NULL AS had_null_customer,
    category IS NULL AND inferred IS NOT NULL AS had_null_category,
    coalesce(unit_price = 0, FALSE) AS had_zero_price
  FROM parted)"""

CLEAN = """
first_lines AS (
  SELECT * FROM typed WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY order_id, clean_sku ORDER BY src_ord) = 1),
clean AS (
  SELECT src_ord, order_id, customer_id, customer_email, clean_ts AS order_ts, status, channel, clean_sku AS sku,
    product_name, clean_category AS category, qty, unit_price, currency, country, fx_reference_date,
    had_null_customer, had_null_category, had_zero_price
  FROM first_lines)"""


PAIRS = """
pair_lines AS (
  SELECT order_id, sku, CASE WHEN country = 'HU' THEN 'HUF' ELSE currency END AS currency, fx_reference_date FROM clean),
pairs AS (
  SELECT DISTINCT fx_reference_date AS rate_date, currency AS target_currency FROM pair_lines
  WHERE fx_reference_date IS NOT NULL AND currency <> 'EUR'),
pair_days AS (
  SELECT *, CASE WHEN rate_date > DATE '2001-06-30' THEN NULL
      WHEN target_currency = 'RON' AND isodow(rate_date) < 6
        THEN CAST((49000 + (day(rate_date) * 31 + month(rate_date)) % 97 * 10) * 100 AS HUGEINT)
      WHEN target_currency = 'HUF' AND isodow(rate_date) IN (1, 4)
        THEN CAST((300 + day(rate_date) % 13) * 1000000 AS HUGEINT) END AS own
  FROM pairs),
pair_rates AS (
  SELECT * FROM (
    SELECT rate_date, 'EUR' AS base_currency, target_currency, own IS NULL AND rate_date > DATE '2001-06-30' AS is_estimated,
      CAST(last_value(own IGNORE NULLS) OVER (PARTITION BY target_currency ORDER BY rate_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 1000000 AS rate
    FROM pair_days)
  WHERE rate IS NOT NULL)"""

APPENDED = """
web_lines AS (
  SELECT * FROM typed WHERE reject_reason IS NULL AND channel = 'web'
  QUALIFY row_number() OVER (PARTITION BY order_id, clean_sku ORDER BY src_ord) = 1),
both_lines AS (
  SELECT * FROM web_lines
  UNION ALL SELECT * FROM first_lines WHERE (order_id, clean_sku) NOT IN (SELECT (order_id, clean_sku) FROM web_lines)),
appended AS (
  SELECT order_id, customer_id, customer_email, clean_ts AS order_ts, status, channel, clean_sku AS sku,
    product_name, clean_category AS category, qty, CAST(unit_price AS DOUBLE) AS unit_price, currency, country,
    fx_reference_date, had_null_customer, had_null_category, had_zero_price
  FROM both_lines)"""


def _paged(source: str) -> str:
    """CTE `paged`: the lines with the position they have in landed pages."""
    number = f"(((src_ord[1] * 31 + src_ord[3] * 7 + src_ord[2] * 13) % {_MODULUS} * {_FACTOR} + {_STEP}) % {_MODULUS})"
    return f"""
paged AS (
  SELECT * EXCLUDE (page_no) REPLACE (
    page_no * {PAGE_GAP} - 1 + row_number() OVER (PARTITION BY page_no ORDER BY src_ord) AS src_ord)
  FROM (SELECT *, {number} * {number} % {_MODULUS}
    % (SELECT greatest(1, (count(*) + {LINES_PER_PAGE} - 1) // {LINES_PER_PAGE}) FROM lineitem) AS page_no
    FROM {source}))"""


# The raw lines as they come out of landed pages: what is first there decides between duplicates.
LANDED = RAW.replace("raw_orders AS (", "listed AS (") + "," + _paged("listed") + ",\nraw_orders AS (SELECT * FROM paged)"


def _rates(name: str, today: str, where: str = "TRUE", seed: str = "required") -> str:
    """CTEs `<name>_dates`, `<name>_source` and `<name>`: required dates, source rates, filled rates."""
    join = "LEFT JOIN" if seed == "required" else "FULL JOIN"
    return f"""
{name}_dates AS (
  SELECT DISTINCT fx_reference_date AS rate_date FROM clean WHERE fx_reference_date IS NOT NULL AND {where}),
{name}_source AS (
  SELECT rate_date, CAST((49000 + (day(rate_date) * 31 + month(rate_date)) % 97 * 10) * 100 AS HUGEINT) AS rate_e6
  FROM all_dates
  WHERE isodow(rate_date) < 6 AND rate_date <= DATE '{today}'),
{name}_days AS (
  SELECT coalesce(d.rate_date, s.rate_date) AS rate_date, d.rate_date IS NOT NULL AS is_required, s.rate_e6 AS own
  FROM {name}_dates d {join} {name}_source s ON d.rate_date = s.rate_date),
{name} AS (
  SELECT * FROM (
    SELECT rate_date, is_required, own, own IS NULL AND rate_date > DATE '{today}' AS is_estimated,
      last_value(own IGNORE NULLS) OVER (
        ORDER BY rate_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate_e6
    FROM {name}_days)
  WHERE is_required AND rate_e6 IS NOT NULL)"""


ALL_DATES = """
all_dates AS (SELECT DISTINCT fx_reference_date AS rate_date FROM clean WHERE fx_reference_date IS NOT NULL)"""
RATES = ALL_DATES + "," + _rates("rates", TODAY.isoformat())

EUR = """
lines AS (
  SELECT clean.*, rate_e6, CAST(qty AS HUGEINT) * CAST(unit_price * 10000 AS BIGINT) AS amount_e4
  FROM clean LEFT JOIN rates ON fx_reference_date = rate_date),
eur_lines AS (
  SELECT *, CASE WHEN currency = 'EUR' THEN amount_e4 * 1000000000
    ELSE (2 * amount_e4 * CAST(1000000000000000 AS HUGEINT) + rate_e6) // (2 * rate_e6) END AS eur_e13
  FROM lines)"""

_CENTS = "(sum(eur_e13) + 50000000000) // 100000000000"

SPEND = f"""
country_lines AS (
  SELECT customer_id, country, count(*) AS n FROM clean
  WHERE status = 'completed' AND customer_id IS NOT NULL GROUP BY customer_id, country),
main_country AS (
  SELECT customer_id, country FROM country_lines
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country ASC NULLS LAST) = 1),
country_number AS (
  SELECT customer_id, count(country) > 1 AS multiple_countries_bought FROM country_lines GROUP BY customer_id),
spend AS (
  SELECT customer_id, customer_email, count(DISTINCT order_id) AS total_orders,
    CAST(sum(qty) AS BIGINT) AS total_items, CAST({_CENTS} AS DOUBLE) / 100 AS total_spent_eur,
    max(CAST(order_ts AS DATE)) AS last_order_date
  FROM eur_lines WHERE status = 'completed' AND customer_id IS NOT NULL AND rate_e6 IS NOT NULL
  GROUP BY customer_id, customer_email),
customer_spend AS (
  SELECT customer_id, customer_email, country, total_orders, total_items, total_spent_eur, last_order_date,
    multiple_countries_bought
  FROM spend JOIN main_country USING (customer_id) JOIN country_number USING (customer_id))"""


def _revenue(threshold: int | None) -> str:
    having = "" if threshold is None else f" HAVING {_CENTS} > {threshold} * CAST(100 AS HUGEINT)"
    return f"""
SELECT country, CAST({_CENTS} AS DOUBLE) / 100 AS total_revenue_eur, count(DISTINCT order_id) AS order_count
FROM eur_lines WHERE status = 'completed' AND category IN ('Books', 'Electronics') AND rate_e6 IS NOT NULL
GROUP BY country{having}"""


def _value_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {name} AS column_value, count(*) AS line_count FROM raw_orders GROUP BY {name}"
        for name in ("status", "channel", "category", "currency", "country")
    )


def _nulls(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count FROM {table}"
        for name in columns
    )


def _repeats(table: str, keys: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS repeated_keys"
        f" FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _with(*parts: str) -> str:
    *tables, select = parts
    return "WITH" + ",".join(tables) + "\n" + select.strip()


_TO_CLEAN = (RAW, TYPED, CLEAN)
_TO_RATES = (*_TO_CLEAN, RATES)
_TO_EUR = (*_TO_RATES, EUR)
_TO_SPEND = (*_TO_EUR, SPEND)

_RATE_COLUMNS = (
    "rate_date, 'EUR' AS base_currency, 'RON' AS target_currency, CAST(rate_e6 AS DOUBLE) / 1000000 AS rate"
)


COUNTRY_REVENUE = f"\ncountry_revenue AS ({_revenue(None)})"

_PAGES = _with(LANDED, "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM raw_orders")
_STEPS = ("ingest", "clean", "fx_rates", "customer_spend_eur", "country_category_revenue")


def _run_log() -> str:
    """One row per step: what it wrote and what it left out."""
    counters = {
        "raw": ("clean", "SELECT count(*) FROM raw_orders"),
        "test": ("clean", "SELECT count(*) FROM typed WHERE reject_reason = 'test'"),
        "negative_qty": ("clean", "SELECT count(*) FROM typed WHERE reject_reason = 'negative_qty'"),
        "duplicates": (
            "clean",
            "SELECT (SELECT count(*) FROM typed WHERE reject_reason IS NULL) - (SELECT count(*) FROM clean)",
        ),
        "unparseable_times": ("clean", "SELECT count(*) FROM clean WHERE order_ts IS NULL"),
        "required_dates": ("fx_rates", "SELECT count(*) FROM all_dates"),
        "estimated": ("fx_rates", "SELECT count(*) FROM rates WHERE is_estimated"),
        "dates_without_rate": ("fx_rates", "SELECT (SELECT count(*) FROM all_dates) - (SELECT count(*) FROM rates)"),
    }
    rows = {
        "ingest": "raw_orders",
        "clean": "clean",
        "fx_rates": "rates",
        "customer_spend_eur": "customer_spend",
        "country_category_revenue": "country_revenue",
    }
    unrated = {
        "customer_spend_eur": "customer_id IS NOT NULL",
        "country_category_revenue": "category IN ('Books', 'Electronics')",
    }
    selects = []
    for step in _STEPS:
        found = [f"({sql}) AS {name}" if of == step else f"NULL::BIGINT AS {name}" for name, (of, sql) in counters.items()]
        lost = (
            f"(SELECT count(*) FROM eur_lines WHERE status = 'completed' AND rate_e6 IS NULL AND {unrated[step]})"
            if step in unrated
            else "NULL::BIGINT"
        )
        selects.append(
            f"SELECT '{step}' AS step_name, 'success' AS status, (SELECT count(*) FROM {rows[step]}) AS rows_processed,"
            f" NULL::VARCHAR AS error_message, {', '.join(found)}, {lost} AS lines_without_rate"
        )
    return _with(LANDED, *_TO_SPEND[1:], f"\ncountry_revenue AS ({_revenue(40_000)})", " UNION ALL ".join(selects))


def _catalog_counts() -> str:
    tables = {
        "orders_raw": "raw_orders",
        "orders_clean": "clean",
        "fx_rates": "rates",
        "customer_spend_eur": "customer_spend",
        "country_category_revenue": "country_revenue",
    }
    selects = [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in tables.items()]
    selects.append(f"SELECT 'pipeline_runs', {len(_STEPS)}")
    return _with(LANDED, *_TO_SPEND[1:], f"\ncountry_revenue AS ({_revenue(40_000)})", " UNION ALL ".join(selects))


def oracle_sql() -> dict[str, str]:
    today = TODAY.isoformat()
    return {
        "order_pages": _with(
            RAW,
            _paged("raw_orders"),
            "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM paged",
        ),
        "landed_pages": _PAGES,
        "landed_packed_pages": _PAGES,
        "landed_documents": _with(*_TO_RATES, f"SELECT {_RATE_COLUMNS} FROM rates_source"),
        "published_orders": _with(
            LANDED,
            *_TO_CLEAN[1:],
            "SELECT * EXCLUDE (src_ord) REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM clean",
        ),
        "published_rates": _with(LANDED, *_TO_RATES[1:], f"SELECT {_RATE_COLUMNS}, is_estimated FROM rates"),
        "monthly_rates": _with(LANDED, *_TO_RATES[1:], f"SELECT {_RATE_COLUMNS}, is_estimated FROM rates"),
        "monthly_revenue": _with(
            LANDED,
            *_TO_EUR[1:],
            _revenue(None).replace("WHERE", "WHERE fx_reference_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND"),
        ),
        "appended_orders": _with(LANDED, *_TO_CLEAN[1:], APPENDED, "SELECT * FROM appended"),
        "rejected_orders": _with(
            LANDED, TYPED, "SELECT src_ord, order_id, sku, status, qty, reject_reason FROM typed WHERE reject_reason IS NOT NULL"
        ),
        "failed_step": _with(
            LANDED,
            *_TO_CLEAN[1:],
            """SELECT 'clean' AS step_name, CAST(0 AS BIGINT) AS rows_processed,
  count(*) FILTER (channel IS DISTINCT FROM 'web') AS null_keys, count(*) AS stored_rows,
  CAST(0 AS BIGINT) AS null_skus FROM clean""",
        ),
        "fx_pairs_filled": _with(*_TO_CLEAN, PAIRS, "SELECT * FROM pair_rates"),
        "order_lines_by_pair": _with(
            *_TO_CLEAN,
            PAIRS,
            """SELECT order_id, sku, currency, fx_reference_date, CASE WHEN currency = 'EUR' THEN 1.0::DOUBLE ELSE rate END AS rate
FROM pair_lines LEFT JOIN pair_rates ON fx_reference_date = rate_date AND currency = target_currency
WHERE currency = 'EUR' OR rate IS NOT NULL""",
        ),
        "published_spend": _with(LANDED, *_TO_SPEND[1:], "SELECT * FROM customer_spend"),
        "published_revenue": _with(LANDED, *_TO_EUR[1:], _revenue(40_000)),
        "run_log": _run_log(),
        "catalog_counts": _catalog_counts(),
        "raw_orders_profile": _with(
            RAW,
            """SELECT count(*) AS line_count, count(DISTINCT customer_id) AS customers,
  count(*) FILTER (status = 'test') AS test_lines, count(*) FILTER (qty < 0) AS negative_qty_lines,
  count(*) FILTER (customer_id IS NULL) AS null_customer_lines,
  count(*) FILTER (category IS NULL) AS null_category_lines,
  count(*) FILTER (unit_price = 0) AS zero_price_lines,
  min(fx_reference_date) AS first_fx_date, max(fx_reference_date) AS last_fx_date FROM raw_orders""",
        ),
        "raw_value_counts": _with(RAW, _value_counts()),
        "ts_format_classes": _with(
            RAW,
            """SELECT CASE WHEN regexp_full_match(order_ts, '[0-9]+') THEN 'epoch'
    WHEN order_ts LIKE '____-__-__T__:__:__' THEN 'iso' WHEN order_ts LIKE '____-__-__ __:__:__' THEN 'iso_blank'
    WHEN order_ts LIKE '__/__/____ __:__' THEN 'day_first' ELSE 'other' END AS format, count(*) AS line_count
FROM raw_orders GROUP BY 1""",
        ),
        "clean_order_ts": _with(RAW, TYPED, f"SELECT {PLACE}, order_ts AS raw_ts, clean_ts AS order_ts FROM typed"),
        "clean_sku": _with(RAW, TYPED, f"SELECT {PLACE}, sku AS raw_sku, clean_sku AS sku FROM typed"),
        "clean_category": _with(
            RAW,
            TYPED,
            f"SELECT {PLACE}, clean_sku AS sku, category AS raw_category, clean_category AS category, had_null_category"
            " FROM typed",
        ),
        "quality_flags": _with(
            RAW,
            TYPED,
            """SELECT had_null_customer, had_null_category, had_zero_price, count(*) AS line_count
FROM typed GROUP BY ALL""",
        ),
        "reject_reasons": _with(
            RAW, TYPED, "SELECT reject_reason, count(*) AS line_count FROM typed GROUP BY reject_reason"
        ),
        "quarantine": _with(
            RAW, TYPED, f"SELECT {PLACE}, order_id, sku, status, qty, reject_reason FROM typed WHERE reject_reason IS NOT NULL"
        ),
        "cleaning_funnel": _with(
            *_TO_CLEAN,
            """SELECT stage_no, stage, row_count, coalesce(lag(row_count) OVER (ORDER BY stage_no) - row_count, 0) AS removed
FROM (SELECT 1 AS stage_no, 'raw' AS stage, count(*) AS row_count FROM raw_orders
  UNION ALL SELECT 2, 'without_test', count(*) FROM raw_orders WHERE status IS DISTINCT FROM 'test'
  UNION ALL SELECT 3, 'without_negative_qty', count(*) FROM raw_orders
    WHERE status IS DISTINCT FROM 'test' AND (qty >= 0 OR qty IS NULL)
  UNION ALL SELECT 4, 'without_duplicates', count(*) FROM clean)""",
        ),
        "dedup_orders": _with(*_TO_CLEAN, f"SELECT order_id, sku, {PLACE} FROM clean"),
        "clean_orders": _with(
            *_TO_CLEAN,
            "SELECT * EXCLUDE (src_ord) REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM clean",
        ),
        "duplicate_pairs": _with(
            RAW, "SELECT order_id, sku, count(*) AS row_count FROM raw_orders GROUP BY order_id, sku HAVING count(*) > 1"
        ),
        "multi_item_orders": _with(
            RAW,
            "SELECT order_id, count(DISTINCT sku) AS skus FROM raw_orders GROUP BY order_id HAVING count(DISTINCT sku) > 1",
        ),
        "insert_ignore": _with(
            *_TO_CLEAN,
            """SELECT order_id, clean_sku AS sku, array_to_string(min(src_ord), ':') AS src_ord FROM typed
WHERE reject_reason IS NULL AND (order_id, clean_sku) NOT IN
  (SELECT (order_id, clean_sku) FROM typed WHERE reject_reason IS NULL AND channel = 'web')
GROUP BY order_id, clean_sku""",
        ),
        "required_fx_dates": _with(*_TO_CLEAN, ALL_DATES, "SELECT rate_date FROM all_dates"),
        "fx_request_range": _with(
            *_TO_CLEAN,
            ALL_DATES,
            f"""SELECT min(rate_date) AS first_date, least(max(rate_date), DATE '{today}') AS last_date FROM all_dates""",
        ),
        "fx_documents": _with(*_TO_RATES, f"SELECT {_RATE_COLUMNS} FROM rates_source"),
        "fx_gap_filled": _with(*_TO_RATES, f"SELECT {_RATE_COLUMNS}, is_estimated FROM rates"),
        "fx_gap_filled_asof": _with(
            *_TO_CLEAN,
            ALL_DATES,
            _rates("refunds", today, "status = 'refunded'", seed="asof"),
            f"SELECT {_RATE_COLUMNS}, is_estimated FROM refunds",
        ),
        "fx_upsert": _with(
            *_TO_CLEAN,
            ALL_DATES,
            _rates("old_rates", EARLIER_TODAY),
            _rates("new_rates", today, "status = 'refunded'"),
            f"""SELECT {_RATE_COLUMNS}, is_estimated FROM old_rates ANTI JOIN new_rates USING (rate_date)
UNION ALL SELECT {_RATE_COLUMNS}, is_estimated FROM new_rates""",
        ),
        "fx_coverage_gaps": _with(
            *_TO_RATES,
            """SELECT fx_reference_date, count(*) AS lines FROM clean
WHERE fx_reference_date IS NULL OR fx_reference_date NOT IN (SELECT rate_date FROM rates)
GROUP BY fx_reference_date""",
        ),
        "fx_coverage_labels": _with(
            *_TO_RATES,
            """SELECT d.rate_date, CAST(r.rate_e6 AS DOUBLE) / 1000000 AS rate,
  CASE WHEN r.rate_e6 IS NULL THEN 'missing' WHEN r.is_estimated THEN 'estimated'
    WHEN r.own IS NOT NULL THEN 'real' ELSE 'carried' END AS label
FROM rates_dates d LEFT JOIN rates r ON d.rate_date = r.rate_date""",
        ),
        "order_lines_eur": _with(
            *_TO_EUR,
            """SELECT order_id, sku, currency, CAST(amount_e4 AS DOUBLE) / 10000 AS amount,
  CAST(rate_e6 AS DOUBLE) / 1000000 AS rate, CAST((eur_e13 + 5000000) // 10000000 AS DOUBLE) / 1000000 AS eur
FROM eur_lines WHERE status = 'completed' AND rate_e6 IS NOT NULL""",
        ),
        "primary_country": _with(*_TO_SPEND, "SELECT customer_id, country FROM main_country"),
        "multi_country_customers": _with(
            *_TO_SPEND, "SELECT customer_id FROM country_number WHERE multiple_countries_bought"
        ),
        "latest_order_date": _with(
            *_TO_CLEAN,
            """SELECT customer_id, max(CAST(order_ts AS DATE)) AS last_order_date FROM clean
WHERE status = 'completed' AND customer_id IS NOT NULL GROUP BY customer_id""",
        ),
        "customer_spend": _with(*_TO_SPEND, "SELECT * FROM customer_spend"),
        "top_customers": _with(
            *_TO_SPEND,
            "SELECT * FROM customer_spend ORDER BY total_spent_eur DESC NULLS FIRST, customer_id, customer_email LIMIT 5",
        ),
        "country_revenue": _with(*_TO_EUR, _revenue(40_000)),
        "country_revenue_threshold": _with(*_TO_EUR, _revenue(6_300_000_000)),
        "country_revenue_all": _with(*_TO_EUR, _revenue(None)),
        "price_anomalies": _with(
            *_TO_EUR,
            """SELECT order_id, sku, CAST(unit_price AS DOUBLE) AS unit_price, qty, currency,
  CAST((eur_e13 + 5000000) // 10000000 AS DOUBLE) / 1000000 AS eur
FROM eur_lines WHERE eur_e13 > CAST(4000000 AS HUGEINT) * 10000000000000""",
        ),
        "key_violations": _with(
            *_TO_SPEND,
            COUNTRY_REVENUE,
            " UNION ALL ".join(
                [
                    _repeats("raw_orders", "order_id, sku"),
                    _repeats("clean", "order_id, sku"),
                    _repeats("rates", "rate_date"),
                    _repeats("customer_spend", "customer_id"),
                    _repeats("country_revenue", "country"),
                ]
            ),
        ),
        "null_violations": _with(
            *_TO_SPEND,
            COUNTRY_REVENUE,
            f"\nrate_rows AS (SELECT {_RATE_COLUMNS} FROM rates)",
            " UNION ALL ".join(
                _nulls(source, columns).replace(f"SELECT '{source}'", f"SELECT '{table}'")
                for table, source, columns in (
                    ("orders_raw", "raw_orders", ["order_id", "customer_id", "sku", "category", "fx_reference_date"]),
                    ("orders_clean", "clean", ["order_id", "sku", "order_ts", "category"]),
                    ("fx_rates", "rate_rows", ["rate_date", "base_currency", "target_currency", "rate"]),
                    ("customer_spend_eur", "customer_spend", ["customer_id", "country", "total_spent_eur"]),
                    ("country_category_revenue", "country_revenue", ["country", "total_revenue_eur"]),
                )
            ),
        ),
    }
