"""The registered queries as SQL over the provided tables."""

from __future__ import annotations

PRICES = """prices AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close,
         o_orderkey AS seq
  FROM orders)"""

GAPPY = """prices AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS close, o_orderkey AS seq
  FROM orders)"""

LAST_ONE = """prices AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close,
         o_orderkey AS seq
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)"""

CLOSES = """closes AS (
  SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date, seq) AS prev_close FROM prices)"""

RETURNS = f"""{CLOSES}, returns AS (
  SELECT ticker, date, close, prev_close, close - prev_close AS daily_return,
         (close - prev_close) / prev_close * 100 AS return_pct, seq
  FROM closes WHERE prev_close IS NOT NULL)"""

UNIVERSE = "universe AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_custkey AS position FROM customer)"

WIDE = """universe AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_custkey AS position FROM customer
  UNION ALL SELECT 'part-' || p_partkey, p_partkey FROM part)"""

FAILED = f"""{WIDE}, failed AS (
  SELECT row_number() OVER (ORDER BY position, ticker) - 1 AS number, ticker FROM universe u
  WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE p.ticker = u.ticker)), lines AS (
  SELECT CAST(number // 100 AS BIGINT) AS line_no, string_agg(ticker, ', ' ORDER BY number) AS failed_tickers
  FROM failed GROUP BY 1 UNION ALL SELECT 0, 'None' WHERE NOT EXISTS (SELECT 1 FROM failed))"""

NEWS = """news AS (
  SELECT source AS ticker, text AS title, lang AS publisher,
         CASE WHEN lang = 'en' THEN 'day ' || CAST(n_chars AS VARCHAR) ELSE 'N/A' END AS published_date,
         CASE WHEN lang = 'fr' THEN '' ELSE CAST(doc_id AS VARCHAR) END AS link, doc_id AS seq
  FROM documents)"""

FED_NEWS = f"""{NEWS}, fed AS (SELECT * FROM news WHERE ticker <> 'src3')"""

KEPT_NEWS = f"""{FED_NEWS}, kept AS (
  SELECT * FROM fed QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq) <= 3)"""

BARS = """bars AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS open,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0.0::DOUBLE END AS high, 0.0::DOUBLE AS low,
         o_totalprice AS close, CAST(trunc(o_totalprice / 7) AS BIGINT) AS volume, o_orderkey
  FROM orders WHERE o_orderkey % 37 <> 0 AND o_custkey % 50 NOT IN (7, 11, 13, 17))"""

LABELS = """'$' || printf('%.2f', close) AS close_label, '$' || printf('%.2f', daily_return) AS daily_return_label,
         printf('%.2f', return_pct) || '%' AS return_pct_label"""

BEST_FIRST = "return_pct DESC NULLS LAST, ticker, date, seq"


def csv_field(name: str) -> str:
    return (
        f"CASE WHEN regexp_matches({name}, '[,\"\\r\\n]') THEN '\"' || replace({name}, '\"', '\"\"') || '\"' "
        f"ELSE {name} END"
    )


def csv(columns: list[str], source: str, order: str, n: int, texts: tuple[str, ...] = ()) -> str:
    fields = [csv_field(c) if c in texts else f"CAST({c} AS VARCHAR)" for c in columns]
    line = " || ',' || ".join(fields)
    return (
        f"(SELECT '{','.join(columns)}' || chr(10) || string_agg(line || chr(10), '' ORDER BY position) FROM "
        f"(SELECT row_number() OVER (ORDER BY {order}) AS position, {line} AS line FROM {source}) "
        f"WHERE position <= {n})"
    )


def checks(source: str, low: float, high: float, largest: float, completeness: float, universe: str = UNIVERSE) -> str:
    """The five checks over the CTEs prices, returns and universe, as a CTE named checks."""
    return f"""{source}, {RETURNS}, {universe}, stats AS (
  SELECT (SELECT count(DISTINCT ticker) FROM prices) / CAST((SELECT count(*) FROM universe) AS DOUBLE) AS ratio,
         (SELECT count(*) FROM prices WHERE close < {low} OR close > {high}) AS invalid,
         (SELECT count(*) FROM prices WHERE close IS NULL) AS missing_prices,
         (SELECT 3 * count(*) FROM returns WHERE close IS NULL) AS missing_returns,
         (SELECT count(*) FROM returns WHERE abs(return_pct) > {largest}) AS outliers,
         (SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY ticker, date) AS n FROM prices) WHERE n > 1)
           AS duplicates), checks AS (
  SELECT 1 AS check_id, 'completeness' AS name, CASE WHEN ratio >= {completeness} THEN 'passed' ELSE 'failed' END
           AS status, ratio AS observed, {completeness}::DOUBLE AS threshold,
         'Data completeness: ' || printf('%.1f', ratio * 100) || '% (' ||
           CASE WHEN ratio >= {completeness} THEN '>=' ELSE '<' END || ' {completeness:.1%})' AS message FROM stats
  UNION ALL
  SELECT 2, 'price_range', CASE WHEN invalid = 0 THEN 'passed' ELSE 'failed' END, invalid, 0,
         CASE WHEN invalid = 0 THEN 'All prices within valid range'
              ELSE 'Found ' || invalid || ' prices outside valid range' END FROM stats
  UNION ALL
  SELECT 3, 'missing_values', CASE WHEN missing_prices + missing_returns = 0 THEN 'passed' ELSE 'warned' END,
         missing_prices + missing_returns, 0,
         CASE WHEN missing_prices + missing_returns = 0 THEN 'No missing values detected'
              ELSE 'Missing values: ' || missing_prices || ' in prices, ' || missing_returns || ' in returns' END
  FROM stats
  UNION ALL
  SELECT 4, 'outliers', CASE WHEN outliers = 0 THEN 'passed' ELSE 'warned' END, outliers, 0,
         CASE WHEN outliers = 0 THEN 'No extreme return outliers detected'
              ELSE 'Found ' || outliers || ' extreme returns (>{largest}%)' END FROM stats
  UNION ALL
  SELECT 5, 'duplicates', CASE WHEN duplicates = 0 THEN 'passed' ELSE 'failed' END, duplicates, 0,
         CASE WHEN duplicates = 0 THEN 'No duplicate records found'
              ELSE 'Found ' || duplicates || ' duplicate records' END FROM stats)"""


NARROW = checks(PRICES, 2000.0, 499000.0, 50.0, 0.8)

SCORE = """(SELECT count(*) FILTER (status = 'passed') / CAST(count(*) FILTER (status IN ('passed', 'failed')) AS DOUBLE)
   FROM checks)"""

WARNING_ROWS = """warning_rows AS (
  SELECT check_id, CAST(NULL AS VARCHAR) AS ticker, CAST(NULL AS DOUBLE) AS value, message FROM checks
  WHERE status = 'warned'
  UNION ALL SELECT 2, ticker, close, NULL FROM prices WHERE close < 2000.0 OR close > 499000.0
  UNION ALL SELECT 4, ticker, return_pct, ticker || ': ' || printf('%.2f', return_pct) || '%' FROM returns
  WHERE abs(return_pct) > 50.0)"""

QUALITY_LINES = f"""lines AS (
  SELECT 0 AS part, 0 AS check_id, 'Quality Score: ' || printf('%.1f', {SCORE} * 100) || '%' AS line
  UNION ALL SELECT 1, 0, 'Checks Passed (' || count(*) || '):' FROM checks WHERE status = 'passed'
  UNION ALL SELECT 1, check_id, '✓ ' || message FROM checks WHERE status = 'passed'
  UNION ALL SELECT 2, 0, 'Checks Failed (' || count(*) || '):' FROM checks WHERE status = 'failed' HAVING count(*) > 0
  UNION ALL SELECT 2, check_id, '✗ ' || message FROM checks WHERE status = 'failed')"""

RETURN_COLUMNS = ["ticker", "date", "close", "prev_close", "daily_return", "return_pct"]

PRICE_TABLE = f"SELECT ticker, date, seq, close, daily_return, return_pct, {LABELS} FROM returns"

SYMBOL = "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '-USD' ELSE c_name END"
RUN_SECONDS = 996667200

# The exact sum in units of 2 to the -80, rounded once: no partial result depends on the order of the rows.
EXACT_MEAN = "sum((return_pct * power(2.0, 80))::HUGEINT)::VARCHAR::DOUBLE / power(2.0, 80) / count(return_pct)"

ORACLE: dict[str, str] = {
    "returns": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns",
    "returns_split": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns",
    "returns_summary": f"""WITH {PRICES}, {RETURNS}
SELECT count(*) AS total_assets, count(DISTINCT ticker) AS distinct_tickers, {EXACT_MEAN} AS avg_return_pct,
       count(*) FILTER (return_pct > 0) AS gainers, count(*) FILTER (return_pct < 0) AS losers FROM returns""",
    "top_performers": f"""WITH {PRICES}, {RETURNS}
SELECT ticker, date, seq, return_pct, CASE WHEN return_pct > 0 THEN 'green' ELSE 'red' END AS direction
FROM returns ORDER BY {BEST_FIRST} LIMIT 5""",
    "price_table": f"WITH {PRICES}, {RETURNS} {PRICE_TABLE} ORDER BY {BEST_FIRST}",
    "recap_summary": f"""WITH {NARROW}
SELECT 'Daily Market Recap - ' || strftime(DATE '2001-08-01', '%B %d, %Y') AS title, count(*) AS total_assets,
       count(DISTINCT ticker) AS distinct_tickers, {EXACT_MEAN} AS avg_return_pct,
       count(*) FILTER (return_pct > 0) AS gainers, count(*) FILTER (return_pct < 0) AS losers,
       {SCORE} AS quality_score, printf('%.2f', avg(return_pct)) || '%' AS avg_return_label,
       printf('%.1f', {SCORE} * 100) || '%' AS quality_score_label FROM returns""",
    "summary_lines": f"""WITH {NARROW}, lines AS (
  SELECT count(*) AS total, printf('%.2f', avg(return_pct)) AS mean, count(*) FILTER (return_pct > 0) AS gainers,
         count(*) FILTER (return_pct < 0) AS losers, printf('%.1f', {SCORE} * 100) AS score FROM returns)
SELECT 0::INTEGER AS line_no, 'Daily Market Recap - ' || strftime(DATE '2001-08-01', '%B %d, %Y') AS line FROM lines
UNION ALL SELECT 1, 'Market Overview:' FROM lines
UNION ALL SELECT 2, '• Total Assets Tracked: ' || total FROM lines
UNION ALL SELECT 3, '• Average Return: ' || mean || '%' FROM lines
UNION ALL SELECT 4, '• Gainers: ' || gainers || ' | Losers: ' || losers FROM lines
UNION ALL SELECT 5, '• Data Quality Score: ' || score || '%' FROM lines""",
    "quality_lines": f"""WITH {NARROW}, {QUALITY_LINES}
SELECT CAST(row_number() OVER (ORDER BY part, check_id) - 1 AS INTEGER) AS line_no, line FROM lines""",
    "rejected_payloads": """WITH documents_of AS (
  SELECT o_custkey, CAST(floor(o_orderkey / 50000) AS BIGINT) AS part, o_custkey % 50 AS kind, arg_min(o_orderkey, o_orderkey) % 37 <> 0 AS first_close,
         count(*) FILTER (o_orderkey % 37 <> 0) AS closes FROM orders GROUP BY ALL), judged AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, part,
         CASE WHEN kind = 7 THEN 'unanswered' WHEN kind IN (11, 23) THEN 'unreadable' WHEN kind = 29 THEN 'no_result'
              WHEN kind = 13 THEN 'short' WHEN closes = 0 THEN 'no_close' WHEN kind = 17 THEN 'short'
              WHEN kind = 19 AND first_close THEN 'no_number' END AS reason FROM documents_of)
SELECT ticker, part, reason,
       CASE reason WHEN 'unanswered' THEN 'the request was not answered' WHEN 'unreadable' THEN 'the body is no single JSON document'
         WHEN 'no_result' THEN 'the document holds no result' WHEN 'short' THEN 'a series ends before the last bar'
         WHEN 'no_close' THEN 'no bar has a close' ELSE 'a kept bar holds something that is no number' END AS message
FROM judged WHERE reason IS NOT NULL""",
    "prices_from_json": f"WITH {BARS} SELECT * EXCLUDE (o_orderkey) FROM bars",
    "build_prices": f"""WITH {BARS} SELECT * EXCLUDE (o_orderkey) FROM bars
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY o_orderkey DESC) <= 2""",
    "build_prices_in_window": f"""WITH {BARS} SELECT * EXCLUDE (o_orderkey) FROM bars
WHERE date BETWEEN DATE '2001-07-26' AND DATE '2001-08-01'""",
    "landed_batches": f"""WITH {BARS}
SELECT ticker, date, close, CAST(row_number() OVER (PARTITION BY ticker ORDER BY o_orderkey % 4 >= 2, o_orderkey) AS INTEGER)
         AS place FROM bars""",
    "price_gate": f"""WITH {BARS}
SELECT 'as landed' AS "case", CASE WHEN count(*) > 0 THEN 'passed' ELSE 'No price data retrieved' END AS outcome FROM bars
UNION ALL SELECT 'unanswered', 'No price data retrieved'""",
    "quality_gate": f"""WITH {NARROW}
SELECT least, CASE WHEN least IS NULL OR {SCORE} >= least THEN 'passed' ELSE 'refused' END AS outcome
FROM (SELECT unnest([NULL, 0.2, 0.9])::DOUBLE AS least)""",
    "coerced_dates": """SELECT 'text' AS kind, o_orderkey AS seq,
       CASE WHEN o_orderkey % 10 <> 3 THEN CAST(o_orderdate AS DATE) END AS date FROM orders
UNION ALL SELECT 'moment', o_orderkey, CAST(o_orderdate + INTERVAL 23 HOURS AS DATE) FROM orders""",
    "news_of_silent_feeds": "SELECT 0 AS num_news, 0 AS num_tickers_with_news, 'No news' AS preview",
    "last_bars": f"""WITH {PRICES} SELECT * FROM prices
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq DESC) <= 2""",
    "feed_items": f"WITH {FED_NEWS} SELECT * EXCLUDE (seq) FROM fed",
    "feed_file_items": f"""WITH {NEWS}
SELECT * EXCLUDE (seq), row_number() OVER (ORDER BY ticker, seq) AS position FROM news WHERE ticker IS NOT NULL""",
    "news_from_xml": f"WITH {KEPT_NEWS} SELECT * EXCLUDE (seq) FROM kept",
    "first_articles": f"""WITH {NEWS} SELECT * FROM news
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq) = 1""",
    "news_digest": f"""WITH {NEWS}, firsts AS (
  SELECT * FROM news QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq) = 1),
numbered AS (SELECT row_number() OVER (ORDER BY ticker) AS position, * EXCLUDE (seq) FROM firsts)
SELECT *, position || '. [' || ticker || '] ' || title AS headline, publisher || ' - ' || published_date AS byline,
       CASE WHEN link <> '' THEN ' <link href="' || link || '">Read more</link>' ELSE '' END AS read_more
FROM numbered""",
    "news_first_nonnull": f"""WITH {NEWS}
SELECT ticker, arg_min(title, seq) FILTER (publisher = 'en') AS title, arg_min(publisher, seq) AS publisher,
       arg_min(published_date, seq) FILTER (published_date <> 'N/A') AS published_date,
       arg_min(link, seq) FILTER (link <> '') AS link
FROM news GROUP BY ticker""",
    "search_phrases": f"""WITH phrases AS (
  SELECT {SYMBOL} AS ticker, CASE WHEN {SYMBOL} LIKE '%-USD' THEN replace({SYMBOL}, '-USD', ' crypto')
         ELSE {SYMBOL} || ' stock' END AS phrase FROM customer)
SELECT ticker, phrase, CAST({RUN_SECONDS} - 7 * 86400 AS BIGINT) AS from_ts, CAST({RUN_SECONDS} AS BIGINT) AS to_ts,
       'https://query1.finance.yahoo.com/v8/finance/chart/' || url_encode(ticker) || '?period1=' ||
         ({RUN_SECONDS} - 7 * 86400) || '&period2=' || {RUN_SECONDS} || '&interval=1d' AS price_url,
       'https://news.google.com/rss/search?q=' || url_encode(phrase) || '&hl=en-US&gl=US&ceid=US:en' AS news_url
FROM phrases""",
    "epoch_to_day": """SELECT CAST(ts AS DATE) AS day, count(*) AS events,
       count(*) FILTER (date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-27')
         AS events_in_window,
       min(CAST(floor(epoch(ts)) AS BIGINT)) AS first_second
FROM events GROUP BY 1""",
    "date_range": f"""WITH {PRICES}
SELECT min(date) AS first_date, max(date) AS last_date,
       min(date) || ' 00:00:00 to ' || max(date) || ' 00:00:00' AS date_range FROM prices""",
    "completeness": f"""WITH {PRICES}, {WIDE}
SELECT (SELECT count(DISTINCT ticker) FROM prices) AS price_tickers, (SELECT count(*) FROM universe) AS universe_size,
       (SELECT count(DISTINCT ticker) FROM prices) / CAST((SELECT count(*) FROM universe) AS DOUBLE)
         AS data_completeness""",
    "failed_lines": f"WITH {PRICES}, {FAILED} SELECT * FROM lines",
    "failed_tickers": f"""WITH {PRICES}, {WIDE}
SELECT position, ticker FROM universe u WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE p.ticker = u.ticker)""",
    "invalid_prices": f"""WITH {PRICES}
SELECT ticker, date, seq, close FROM prices WHERE close < 2000.0 OR close > 499000.0""",
    "missing_cells": f"""WITH {GAPPY}, {RETURNS}
SELECT (SELECT count(*) FROM prices WHERE close IS NULL) AS missing_prices,
       (SELECT count(*) FILTER (prev_close IS NULL) + 2 * count(*) FILTER (close IS NULL OR prev_close IS NULL)
        FROM closes) AS missing_changes,
       (SELECT 3 * count(*) FROM returns WHERE close IS NULL) AS missing_returns""",
    "outliers": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns WHERE abs(return_pct) > 50.0",
    "duplicate_rows": f"""WITH {PRICES} SELECT * FROM prices
QUALIFY count(*) OVER (PARTITION BY ticker, date) > 1""",
    "duplicate_count": f"""WITH {PRICES}, sizes AS (SELECT count(*) AS n FROM prices GROUP BY ticker, date)
SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicates FROM sizes""",
    "quality_checks": f"WITH {NARROW} SELECT * FROM checks",
    "quality_checks_wide": f"WITH {checks(PRICES, 0.01, 1000000.0, 50.0, 0.8, WIDE)} SELECT * FROM checks",
    "quality_checks_gappy": f"WITH {checks(GAPPY, 0.01, 1000000.0, 50.0, 0.8)} SELECT * FROM checks",
    "quality_checks_clean": f"WITH {checks(LAST_ONE, 0.01, 1000000.0, 50.0, 0.8)} SELECT * FROM checks",
    "quality_score": f"""WITH {NARROW}, {WARNING_ROWS}
SELECT (SELECT ratio FROM stats) AS data_completeness, {SCORE} AS quality_score,
       (SELECT count(*) FROM warning_rows) AS warnings""",
    "warnings": f"WITH {NARROW}, {WARNING_ROWS} SELECT * FROM warning_rows",
    "price_metrics": f"""WITH {PRICES}, {FAILED}, facts AS (
  SELECT 0 AS line_no, count(*) AS num_records, count(DISTINCT ticker) AS num_tickers,
         (SELECT count(*) FROM failed) AS num_failed, min(date) AS first_date, max(date) AS last_date,
         min(date) || ' 00:00:00 to ' || max(date) || ' 00:00:00' AS date_range,
         {csv(["ticker", "date", "close"], "prices", "ticker, date, seq", 10)} AS preview
  FROM prices)
SELECT lines.line_no, facts.* EXCLUDE (line_no), lines.failed_tickers FROM lines LEFT JOIN facts USING (line_no)""",
    "news_metrics": f"""WITH {KEPT_NEWS}
SELECT count(*) AS num_news, count(DISTINCT ticker) AS num_tickers_with_news,
       {csv(["ticker", "title", "publisher", "published_date", "link"], "kept", "ticker, seq", 5, ("title",))} AS preview
FROM kept""",
    "returns_metrics": f"""WITH {PRICES}, {RETURNS}
SELECT count(*) AS num_records, round_even(avg(return_pct) * 100, 0)::DOUBLE / 100 AS avg_return_pct,
       {csv(["ticker", "return_pct"], "returns", BEST_FIRST, 5)} AS top_gainers,
       {csv(RETURN_COLUMNS, "returns", "ticker, date, seq", 5)} AS preview
FROM returns""",
    "quality_metrics": f"""WITH {NARROW}, {WARNING_ROWS}
SELECT {SCORE} AS quality_score, CAST(count(*) FILTER (status = 'passed') AS INTEGER) AS checks_passed,
       CAST(count(*) FILTER (status = 'failed') AS INTEGER) AS checks_failed,
       (SELECT count(*) FROM warning_rows) AS warnings,
       string_agg('✅ ' || message, chr(10) ORDER BY check_id) FILTER (status = 'passed') AS passed_checks,
       coalesce(string_agg('❌ ' || message, chr(10) ORDER BY check_id) FILTER (status = 'failed'), 'None')
         AS failed_checks
FROM checks""",
    "csv_preview": f"""WITH {PRICES}, {RETURNS}
SELECT least((SELECT count(*) FROM returns), 5) AS rows, {csv(RETURN_COLUMNS, "returns", "ticker, date, seq", 5)} AS csv""",
    "price_labels": f"""WITH {PRICES}, {RETURNS}
SELECT ticker, seq, {LABELS}, CAST(return_pct AS VARCHAR) AS return_pct_text,
       round_even(return_pct * 100, 0)::DOUBLE / 100 AS return_pct_rounded,
       CASE WHEN return_pct > 0 THEN 'green' ELSE 'red' END AS direction, '20010801' AS run_date,
       strftime(DATE '2001-08-01', '%B %d, %Y') AS run_title FROM returns""",
    "materialise_roundtrip": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns",
    "stored_window": f"WITH {PRICES} SELECT * FROM prices WHERE date BETWEEN DATE '2001-07-26' AND DATE '2001-08-01'",
    "distinct_sketches": f"""WITH {PRICES}, {RETURNS}
SELECT (SELECT count(DISTINCT year(date)) FROM prices) AS batches, (SELECT count(*) FROM returns) AS total_assets,
       (SELECT count(DISTINCT ticker) FROM prices) AS distinct_tickers,
       (SELECT count(DISTINCT ticker) FROM returns) AS tickers_with_returns,
       true AS merged_is_near, true AS summarised_is_near""",
    "replaced_dataset": f"WITH {PRICES}, {RETURNS} SELECT * FROM returns",
    "recap_roundtrip": f"WITH {PRICES}, {RETURNS} SELECT *, '20010801' AS run_date FROM ({PRICE_TABLE})",
    "recap_metrics": f"""WITH {NARROW}, {QUALITY_LINES}, sizes AS (
  SELECT 'summary' AS section, 1::BIGINT AS rows
  UNION ALL SELECT 'summary_lines', 6
  UNION ALL SELECT 'top_performers', least((SELECT count(*) FROM returns), 5)
  UNION ALL SELECT 'price_table', count(*) FROM returns
  UNION ALL SELECT 'news_digest', count(DISTINCT source) FROM documents
  UNION ALL SELECT 'quality_lines', count(*) FROM lines)
SELECT *, 'sections/' || section || '/run_date=20010801' AS place, true AS has_size FROM sizes""",
}

ORACLE["observed_metrics"] = ORACLE["price_metrics"]
ORACLE["observed_counts"] = f"""SELECT news.* RENAME (preview AS news_preview), returns.*
FROM ({ORACLE["news_metrics"]}) news, ({ORACLE["returns_metrics"]}) returns"""
