"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables ``events`` and ``documents`` (and the other test tables) are views in
DuckDB. The CTE prefix rebuilds the same ``ticks`` / ``headlines`` views,
the lexicon score by a token ⋈ lexicon join, and the windowed metrics with
``date_trunc``; the Spark side computes them with its own operators.
"""

from __future__ import annotations

from ..functions.sentiment import TEST_LEXICON
from ..sources.tables import HEADLINE_EPOCH, HEADLINE_MINUTE_SPAN, HEADLINE_MINUTE_STEP, TICKERS

ORACLE: dict[str, str] = {}


def _lexicon_values() -> str:
    return ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in TEST_LEXICON.items())


def _tickers_list() -> str:
    return "[" + ", ".join(f"'{t}'" for t in TICKERS) + "]"


BASE_CTES = f"""
ticks AS (
  SELECT event_type AS ticker, value AS price, ts AS "timestamp" FROM events
),
headlines AS (
  SELECT doc_id,
         ({_tickers_list()})[doc_id % {len(TICKERS)} + 1] AS ticker,
         text AS headline, source,
         TIMESTAMP '{HEADLINE_EPOCH}'
           + to_minutes(CAST((doc_id * {HEADLINE_MINUTE_STEP}) % {HEADLINE_MINUTE_SPAN} AS BIGINT)) AS "timestamp"
  FROM documents
),
lexicon(token, valence) AS (VALUES {_lexicon_values()}),
cleaned AS (
  SELECT *, regexp_replace(lower(headline), '\\s+', ' ', 'g') AS cleaned_headline FROM headlines
),
token_sums AS (
  SELECT t.doc_id, sum(coalesce(l.valence, 0.0)) AS m
  FROM (SELECT doc_id,
               unnest(string_split_regex(coalesce(cleaned_headline, 'none'), '[^a-z]+')) AS token
        FROM cleaned) t
  LEFT JOIN lexicon l ON l.token = t.token
  GROUP BY t.doc_id
),
scored AS (
  SELECT c.*, round(coalesce(s.m, 0.0) / sqrt(coalesce(s.m, 0.0) * coalesce(s.m, 0.0) + 15), 4) AS sentiment_score
  FROM cleaned c LEFT JOIN token_sums s ON s.doc_id = c.doc_id
)"""


def metrics_ctes(unit: str, name: str = "metrics") -> str:
    """price_w_<unit>, sent_w_<unit> and the joined, shaped ``name`` CTE."""
    return f"""
price_w_{unit} AS (
  SELECT ticker, date_trunc('{unit}', "timestamp") AS window_start,
         avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
         count(price) AS price_count
  FROM ticks WHERE "timestamp" IS NOT NULL GROUP BY ALL
),
sent_w_{unit} AS (
  SELECT ticker, date_trunc('{unit}', "timestamp") AS window_start,
         avg(sentiment_score) AS avg_sentiment, count(headline) AS headline_count
  FROM scored WHERE "timestamp" IS NOT NULL GROUP BY ALL
),
{name} AS (
  SELECT p.ticker, p.window_start, p.window_start + INTERVAL 1 {unit} AS window_end,
         p.avg_price, p.min_price, p.max_price, CAST(p.price_count AS INTEGER) AS price_count,
         coalesce(s.avg_sentiment, 0.0) AS avg_sentiment, CAST(s.headline_count AS INTEGER) AS headline_count
  FROM price_w_{unit} p JOIN sent_w_{unit} s ON p.ticker = s.ticker AND p.window_start = s.window_start
)"""


def with_ctes(body: str, *units: str, extra: str = "") -> str:
    parts = [BASE_CTES]
    for u in units:
        parts.append(metrics_ctes(u, "metrics" if u == units[0] else f"metrics_{u}"))
    if extra:
        parts.append("\n" + extra)
    return "WITH " + ",".join(parts) + "\n" + body


METRICS_OUT = """
SELECT ticker, window_start, window_end,
       round(avg_price, 6) AS avg_price, round(min_price, 6) AS min_price, round(max_price, 6) AS max_price,
       price_count, round(avg_sentiment, 6) AS avg_sentiment, headline_count
FROM metrics"""

ORACLE["join_price_sentiment"] = with_ctes(METRICS_OUT, "day")
ORACLE["join_price_sentiment_hourly"] = with_ctes(METRICS_OUT, "hour")
ORACLE["join_price_sentiment_minute"] = with_ctes(METRICS_OUT, "minute")


def safe_corr(x: str, y: str) -> str:
    """Pearson correlation over complete pairs, NULL when a side is constant."""
    xp = f"CASE WHEN {y} IS NOT NULL THEN {x} END"
    yp = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return f"(covar_pop({xp}, {yp}) / NULLIF(stddev_pop({xp}) * stddev_pop({yp}), 0))"


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


WIRE_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
LATEST50 = "latest50 AS (SELECT * FROM metrics ORDER BY window_start DESC, ticker ASC LIMIT 50)"
ROUNDED_METRICS_COLS = """ticker, window_start, window_end,
       round(avg_price, 6) AS avg_price, round(min_price, 6) AS min_price, round(max_price, 6) AS max_price,
       price_count, round(avg_sentiment, 6) AS avg_sentiment, headline_count"""

S5 = """CASE WHEN {c} > 0.1 THEN 'Very Positive' WHEN {c} > 0.05 THEN 'Positive'
            WHEN {c} < -0.1 THEN 'Very Negative' WHEN {c} < -0.05 THEN 'Negative' ELSE 'Neutral' END"""
S3 = "CASE WHEN {c} > 0.05 THEN 'positive' WHEN {c} < -0.05 THEN 'negative' ELSE 'neutral' END"
CL = "CASE WHEN {c} > 0.5 THEN 'Strong positive' WHEN {c} < -0.5 THEN 'Strong negative' ELSE 'Weak' END"

# ---------------------------------------------------------------- envelopes, parsing

ORACLE["src_price_envelope"] = with_ctes(
    """SELECT ticker AS key, 'stock_prices' AS topic, "timestamp" AS broker_time, ticker, round(price, 2) AS price
FROM ticks""")
ORACLE["src_text_envelope"] = with_ctes(
    """SELECT ticker AS key, 'stock_texts' AS topic, "timestamp" AS broker_time, ticker, source FROM headlines""")
ORACLE["enc_price_event"] = with_ctes(
    f"""SELECT ticker AS key, ticker, round(price, 2) AS price, {WIRE_TS.format(c='"timestamp"')} AS wire_timestamp
FROM ticks""")
ORACLE["enc_text_event"] = with_ctes(
    f"""SELECT doc_id, ticker AS key, source, {WIRE_TS.format(c='"timestamp"')} AS wire_timestamp,
       (headline IS NOT NULL) AS headline_roundtrip
FROM headlines""")
ORACLE["parse_prices"] = with_ctes("""SELECT ticker, round(price, 2) AS price, "timestamp" FROM ticks""")
ORACLE["parse_texts"] = with_ctes("""SELECT ticker, headline, source, "timestamp" FROM headlines""")
ORACLE["parse_timestamps"] = """
SELECT event_id, ts AS t_offset, ts AS t_zulu, date_trunc('second', ts) AS t_seconds,
       CAST(NULL AS TIMESTAMP) AS t_junk
FROM events"""
ORACLE["parse_rejects"] = """
SELECT 'stock_prices' AS topic, props AS raw_value FROM events
UNION ALL
SELECT 'stock_prices' AS topic, text AS raw_value FROM documents"""
ORACLE["parse_valid_count"] = with_ctes(
    """SELECT ticker, count(*) AS n_rows, count(price) AS n_prices FROM ticks GROUP BY ticker""")

# ---------------------------------------------------------------- cleaning, scoring

ORACLE["clean_headlines"] = with_ctes("SELECT doc_id, ticker, cleaned_headline FROM cleaned")
ORACLE["score_lexicon"] = with_ctes("SELECT doc_id, ticker, sentiment_score FROM scored")
ORACLE["score_lexicon_join"] = with_ctes("SELECT doc_id, sentiment_score FROM scored")

RULE_LEXICON_CTES = """
rule_lexicon AS (
  SELECT chr(CAST(a AS INTEGER)) || chr(CAST(b AS INTEGER)) AS token,
         CAST((31 * a + b) % 9 - 4 AS DOUBLE) / 2 AS valence
  FROM range(97, 123) t1(a) JOIN range(97, 123) t2(b) ON TRUE
),
rule_sums AS (
  SELECT t.doc_id, sum(coalesce(l.valence, 0.0)) AS m
  FROM (SELECT doc_id,
               unnest(string_split_regex(coalesce(cleaned_headline, 'none'), '[^a-z]+')) AS token
        FROM cleaned) t
  LEFT JOIN rule_lexicon l ON l.token = t.token
  GROUP BY t.doc_id
)"""
_RULE_SCORE = "round(coalesce(s.m, 0.0) / sqrt(coalesce(s.m, 0.0) * coalesce(s.m, 0.0) + 15), 4)"
ORACLE["score_lexicon_vectorised"] = with_ctes(
    f"""SELECT c.doc_id, c.ticker, {_RULE_SCORE} AS sentiment_score
FROM cleaned c LEFT JOIN rule_sums s ON s.doc_id = c.doc_id""", extra=RULE_LEXICON_CTES.strip())
ORACLE["score_lexicon_join_large"] = with_ctes(
    f"""SELECT c.doc_id, {_RULE_SCORE} AS sentiment_score
FROM cleaned c LEFT JOIN rule_sums s ON s.doc_id = c.doc_id""", extra=RULE_LEXICON_CTES.strip())

# Position rules: a scored word looks at the three tokens before it; a contrast word splits the text.
ORACLE["score_rules"] = with_ctes(
    """SELECT h.doc_id, round(x / sqrt(x * x + 15), 4) AS sentiment_score
FROM (SELECT doc_id, coalesce(m, 0.0) + sign(coalesce(m, 0.0)) * (
               least(length(t) - length(replace(t, '!', '')), 4) * 0.292
               + CASE WHEN length(t) - length(replace(t, '?', '')) <= 1 THEN 0
                      WHEN length(t) - length(replace(t, '?', '')) <= 3 THEN (length(t) - length(replace(t, '?', ''))) * 0.18
                      ELSE 0.96 END) AS x
      FROM rule_text LEFT JOIN (
        SELECT doc_id, sum((v + sign(v) * (p1 + p2 * 0.95 + p3 * 0.9)) * CASE WHEN negated THEN -0.74 ELSE 1 END
                           * CASE WHEN turn IS NULL OR i = turn THEN 1 WHEN i < turn THEN 0.5 ELSE 1.5 END) AS m
        FROM (SELECT *, coalesce(lag(b, 1) OVER w, 0) AS p1, coalesce(lag(b, 2) OVER w, 0) AS p2, coalesce(lag(b, 3) OVER w, 0) AS p3,
                     coalesce(lag(n, 1) OVER w, false) OR coalesce(lag(n, 2) OVER w, false) OR coalesce(lag(n, 3) OVER w, false) AS negated,
                     min(i) FILTER (c) OVER (PARTITION BY doc_id) AS turn
              FROM rule_marked WINDOW w AS (PARTITION BY doc_id ORDER BY i)) r
        WHERE v <> 0 GROUP BY doc_id) s USING (doc_id)) h""", extra="""rule_text AS (
  SELECT doc_id, coalesce(lower(headline), 'none') AS t,
         list_filter(string_split_regex(coalesce(lower(headline), 'none'), '[^a-z]+'), lambda z: z <> '') AS words FROM headlines),
rule_marked AS (
  SELECT doc_id, i, coalesce(valence, 0.0) AS v, CASE WHEN coalesce(valence, 0.0) <> 0 THEN 0
           WHEN k.token IN ('and', 'que') THEN 0.293 WHEN k.token = 'of' THEN -0.293 ELSE 0 END AS b,
         k.token IN ('the', 'les') AS n, k.token IN ('was', 'une') AS c
  FROM (SELECT doc_id, unnest(words) AS token, unnest(range(1, len(words) + 1)) AS i FROM rule_text) k
  LEFT JOIN lexicon ON lexicon.token = k.token)""")

# ---------------------------------------------------------------- windowed aggregates

ORACLE["agg_price_window"] = with_ctes(
    """SELECT ticker, date_trunc('minute', "timestamp") AS window_start,
       date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end,
       round(avg(price), 6) AS avg_price, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price,
       count(price) AS price_count
FROM ticks WHERE "timestamp" IS NOT NULL GROUP BY ALL""")
ORACLE["agg_sentiment_window"] = with_ctes(
    """SELECT ticker, date_trunc('minute', "timestamp") AS window_start,
       date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end,
       round(avg(sentiment_score), 6) AS avg_sentiment, count(headline) AS headline_count
FROM scored WHERE "timestamp" IS NOT NULL GROUP BY ALL""")

# ---------------------------------------------------------------- sink shaping, checks, merges

ORACLE["snk_row_shape"] = with_ctes(
    """SELECT ticker, window_start, window_end,
       CAST(epoch(window_end) - epoch(window_start) AS BIGINT) AS window_seconds,
       price_count, headline_count, round(avg_sentiment, 6) AS avg_sentiment
FROM metrics""", "hour")
ORACLE["chk_target_key"] = with_ctes(
    """SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE ticker IS NULL OR window_start IS NULL) AS null_keys,
       count(*) FILTER (WHERE length(ticker) > 10) AS long_tickers,
       (SELECT count(*) FROM (
           SELECT ticker, window_start FROM metrics GROUP BY ALL
           HAVING count(*) > 1 OR ticker IS NULL OR window_start IS NULL OR max(length(ticker)) > 10
               OR max(CAST(window_end IS NULL AS INTEGER)) > 0)) AS violations
FROM metrics""", "hour")
ORACLE["chk_key_violations"] = with_ctes(
    """SELECT ticker, window_start, count(*) AS n_rows, max(CAST(window_end IS NULL AS INTEGER)) AS null_end
FROM (SELECT CASE hour(window_start) WHEN 1 THEN NULL WHEN 2 THEN repeat(ticker, 3) ELSE ticker END AS ticker,
             CASE WHEN hour(window_start) <> 3 THEN window_start END AS window_start,
             CASE WHEN hour(window_start) <> 4 THEN window_end END AS window_end
      FROM (SELECT * FROM metrics UNION ALL SELECT * FROM metrics WHERE hour(window_start) = 0) m) b
GROUP BY ticker, window_start
HAVING count(*) > 1 OR ticker IS NULL OR window_start IS NULL OR length(ticker) > 10 OR max(CAST(window_end IS NULL AS INTEGER)) > 0""", "hour")
ORACLE["snk_upsert_merge"] = with_ctes(METRICS_OUT, "hour")
ORACLE["snk_upsert_replay"] = with_ctes(METRICS_OUT, "hour")
ORACLE["src_metrics_read"] = with_ctes(METRICS_OUT, "hour")
ORACLE["src_metrics_range"] = with_ctes(
    METRICS_OUT + "\nWHERE window_start >= TIMESTAMP '2024-01-10 00:00:00' AND window_start < TIMESTAMP '2024-01-11 06:00:00'", "hour")
ORACLE["dash_latest50_stored"] = with_ctes(f"SELECT {ROUNDED_METRICS_COLS} FROM latest50", "hour", extra=LATEST50)
ORACLE["src_topic_files"] = with_ctes(
    """SELECT 'stock_prices' AS topic, ticker, round(price, 2) AS price, CAST(NULL AS VARCHAR) AS source, "timestamp" FROM ticks
UNION ALL
SELECT 'stock_texts', ticker, CAST(NULL AS DOUBLE), source, "timestamp" FROM headlines""")

# ---------------------------------------------------------------- dashboard

ORACLE["dash_latest50"] = with_ctes(f"SELECT {ROUNDED_METRICS_COLS} FROM latest50", "hour", extra=LATEST50)
ORACLE["dash_latest50_per_ticker"] = with_ctes(
    f"""SELECT {ROUNDED_METRICS_COLS} FROM metrics
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY window_start DESC) <= 50""", "hour")
ORACLE["dash_distinct_tickers"] = with_ctes("SELECT DISTINCT ticker FROM latest50", "hour", extra=LATEST50)
ORACLE["dash_filter_ticker"] = with_ctes(
    f"SELECT {ROUNDED_METRICS_COLS} FROM latest50 WHERE ticker = 'click'", "hour", extra=LATEST50)

KPI_AGG = f"""SELECT ticker,
         arg_max(avg_price, window_start) AS latest_price,
         arg_min(avg_price, window_start) AS first_price,
         arg_max(avg_sentiment, window_start) AS latest_sentiment,
         count(*) AS total_windows,
         avg(headline_count) AS avg_volume,
         {safe_corr('avg_price', 'avg_sentiment')} AS c
  FROM {{src}} GROUP BY ticker"""

ORACLE["dash_kpis"] = with_ctes(
    f"""SELECT ticker, round(latest_price, 2) AS latest_price,
       round(CASE WHEN total_windows > 1 THEN latest_price - first_price ELSE 0.0 END, 2) AS price_delta,
       round(latest_sentiment, 3) AS latest_sentiment,
       {S5.format(c='latest_sentiment')} AS sentiment_label,
       total_windows, round(avg_volume, 1) AS avg_volume,
       round(CASE WHEN total_windows > 2 THEN c END, 3) AS correlation,
       CASE WHEN total_windows > 2 THEN {CL.format(c='(CASE WHEN total_windows > 2 THEN c END)')} END
         AS correlation_label
FROM ({KPI_AGG.format(src='latest50')}) k""", "hour", extra=LATEST50)
ORACLE["dash_kpis_all"] = with_ctes(
    f"""SELECT ticker, {r6('latest_price', 'latest_price')}, {r6('first_price', 'first_price')},
       {r6('CASE WHEN total_windows > 1 THEN latest_price - first_price ELSE 0.0 END', 'price_delta')},
       {r6('latest_sentiment', 'latest_sentiment')},
       {S5.format(c='latest_sentiment')} AS sentiment_label,
       total_windows, {r6('avg_volume', 'avg_volume')},
       {r6('CASE WHEN total_windows > 2 THEN c END', 'correlation')},
       CASE WHEN total_windows > 2 THEN {CL.format(c='(CASE WHEN total_windows > 2 THEN c END)')} END
         AS correlation_label
FROM ({KPI_AGG.format(src='metrics')}) k""", "hour")
ORACLE["dash_kpis_empty"] = with_ctes(
    """SELECT 'no_such_ticker' AS ticker,
       round(coalesce(arg_max(avg_price, window_start), 0.0), 6) AS latest_price,
       round(coalesce(arg_max(avg_sentiment, window_start), 0.0), 6) AS latest_sentiment,
       round(CASE WHEN count(*) > 1 THEN arg_max(avg_price, window_start) - arg_min(avg_price, window_start)
                  ELSE 0.0 END, 6) AS price_delta,
       count(*) AS total_windows, round(avg(headline_count), 6) AS avg_volume
FROM latest50 WHERE ticker = 'no_such_ticker'""", "hour", extra=LATEST50)
ORACLE["dash_series"] = with_ctes(
    """SELECT ticker, window_start, round(avg_price, 6) AS avg_price, round(avg_sentiment, 6) AS avg_sentiment
FROM latest50""", "hour", extra=LATEST50)
ORACLE["dash_recent10"] = with_ctes(
    """SELECT ticker, window_start, round(avg_price, 6) AS avg_price, round(min_price, 6) AS min_price,
       round(max_price, 6) AS max_price, round(avg_sentiment, 6) AS avg_sentiment, headline_count
FROM metrics QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY window_start DESC) <= 10""", "hour")
ORACLE["dash_recent10_of_latest50"] = with_ctes(
    """SELECT ticker, window_start, round(avg_price, 6) AS avg_price, round(min_price, 6) AS min_price,
       round(max_price, 6) AS max_price, round(avg_sentiment, 6) AS avg_sentiment, headline_count
FROM latest50 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY window_start DESC) <= 10""", "hour", extra=LATEST50)
ORACLE["dash_latest"] = with_ctes(
    """SELECT ticker, max(window_start) AS latest_window,
       round(arg_max(avg_price, window_start), 6) AS latest_price,
       round(arg_max(avg_sentiment, window_start), 6) AS latest_sentiment
FROM metrics GROUP BY ticker""", "hour")
ORACLE["dash_delta"] = with_ctes(
    f"""SELECT ticker, round(first_price, 6) AS first_price, round(latest_price, 6) AS latest_price,
       round(CASE WHEN total_windows > 1 THEN latest_price - first_price ELSE 0.0 END, 6) AS price_delta,
       total_windows
FROM ({KPI_AGG.format(src='metrics')}) k""", "day")
ORACLE["overlay_scaled"] = with_ctes(
    """SELECT m.ticker, m.window_start, round(m.avg_price, 6) AS avg_price, round(m.avg_sentiment, 6) AS avg_sentiment,
       round(r.hi - r.lo, 6) AS price_range,
       round(m.avg_sentiment * (r.hi - r.lo) / 2 + (r.hi + r.lo) / 2, 6) AS sentiment_scaled
FROM metrics m JOIN (SELECT ticker, min(avg_price) AS lo, max(avg_price) AS hi FROM metrics GROUP BY ticker) r
  ON r.ticker = m.ticker""", "hour")
ORACLE["label_sentiment3"] = with_ctes(
    f"""SELECT ticker, window_start, round(avg_sentiment, 6) AS avg_sentiment, {S3.format(c='avg_sentiment')} AS label
FROM metrics""", "hour")
ORACLE["label_sentiment5"] = with_ctes(
    f"""SELECT ticker, window_start, round(avg_sentiment, 6) AS avg_sentiment, {S5.format(c='avg_sentiment')} AS label
FROM metrics""", "hour")
CORR_Q = f"""SELECT ticker, n_windows, round(cc, 6) AS correlation, CASE WHEN n_windows > 2 THEN {CL.format(c='cc')} END AS correlation_label
FROM (SELECT ticker, count(*) AS n_windows,
             CASE WHEN count(*) > 2 THEN {safe_corr('avg_price', 'avg_sentiment')} END AS cc
      FROM metrics GROUP BY ticker) c"""
ORACLE["label_correlation"] = with_ctes(CORR_Q, "day")
ORACLE["label_correlation_small"] = with_ctes(
    " UNION ALL ".join(
        f"""SELECT {k} AS selected, c.* FROM ({CORR_Q.replace('FROM metrics GROUP BY', f'FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY window_start DESC) AS rn FROM metrics) m WHERE rn <= {k} GROUP BY')}) c"""
        for k in (1, 2, 3)), "day")
ORACLE["corr_price_sentiment"] = with_ctes(CORR_Q, "hour")

# ---------------------------------------------------------------- analyses

ORACLE["an_direction_agreement"] = with_ctes(
    """SELECT ticker, n_pairs, n_signal, n_agree, round(CAST(n_agree AS DOUBLE) / NULLIF(n_signal, 0), 6) AS agreement_rate
FROM (SELECT m.ticker, count(*) AS n_pairs,
             count(CASE WHEN m.avg_sentiment > 0.05 THEN 1 WHEN m.avg_sentiment < -0.05 THEN -1 END) AS n_signal,
             CAST(sum(CASE WHEN (CASE WHEN m.avg_sentiment > 0.05 THEN 1.0 WHEN m.avg_sentiment < -0.05 THEN -1.0 END)
                                = sign(m.avg_price - p.avg_price) THEN 1 ELSE 0 END) AS BIGINT) AS n_agree
      FROM metrics m JOIN metrics p ON p.ticker = m.ticker AND p.window_start = m.window_start - INTERVAL 1 day
      GROUP BY m.ticker) a""", "day")
ORACLE["an_negative_spikes"] = with_ctes(
    """SELECT sp.ticker, sp.window_start, round(sp.avg_sentiment, 6) AS avg_sentiment, round(sp.z, 6) AS z,
       round(sp.avg_price, 6) AS avg_price, round(n.avg_price, 6) AS next_price,
       round(n.avg_price - sp.avg_price, 6) AS price_change, (n.avg_price < sp.avg_price) AS declined
FROM (SELECT m.*, (m.avg_sentiment - st.mean) / NULLIF(st.sd, 0) AS z
      FROM metrics m JOIN (SELECT ticker, avg(avg_sentiment) AS mean, stddev_samp(avg_sentiment) AS sd
                           FROM metrics GROUP BY ticker) st ON st.ticker = m.ticker) sp
LEFT JOIN metrics n ON n.ticker = sp.ticker AND n.window_start = sp.window_start + INTERVAL 1 hour
WHERE sp.z < -2.0""", "hour")
ORACLE["an_lag_correlation"] = with_ctes(
    f"""SELECT s.ticker, CAST(l.lag AS INTEGER) AS lag, count(*) AS n_pairs,
       round({safe_corr('s.avg_sentiment', 'p.avg_price')}, 6) AS correlation
FROM metrics s
JOIN (SELECT unnest(range(0, 4)) AS lag) l ON TRUE
JOIN metrics p ON p.ticker = s.ticker AND p.window_start = s.window_start + to_days(CAST(l.lag AS INTEGER))
GROUP BY s.ticker, l.lag""", "day")
ORACLE["an_largest_changes"] = with_ctes(
    """SELECT m.ticker, m.window_start, round(p.avg_sentiment, 6) AS prev_avg_sentiment,
       round(m.avg_sentiment, 6) AS avg_sentiment, round(m.avg_sentiment - p.avg_sentiment, 6) AS change,
       round(abs(m.avg_sentiment - p.avg_sentiment), 6) AS abs_change
FROM metrics m JOIN metrics p ON p.ticker = m.ticker AND p.window_start = m.window_start - INTERVAL 1 day
ORDER BY abs(m.avg_sentiment - p.avg_sentiment) DESC, m.ticker, m.window_start
LIMIT 10""", "day")
ORACLE["an_sentiment_by_hour"] = with_ctes(
    """SELECT CAST(hour(window_start) AS INTEGER) AS hour_of_day, count(*) AS n_windows,
       round(avg(avg_sentiment), 6) AS avg_sentiment,
       round(sum(avg_sentiment * headline_count) / NULLIF(sum(headline_count), 0), 6) AS weighted_sentiment,
       CAST(sum(headline_count) AS BIGINT) AS headlines
FROM metrics GROUP BY ALL""", "hour")
ORACLE["an_volatility"] = with_ctes(
    f"""SELECT ticker, count(*) AS n_buckets, round(avg(pv), 6) AS mean_price_vol,
       round(avg(sv), 6) AS mean_sentiment_vol, round({safe_corr('pv', 'sv')}, 6) AS vol_correlation
FROM (SELECT ticker, date_trunc('day', window_start) AS d,
             stddev_samp(avg_price) AS pv, stddev_samp(avg_sentiment) AS sv
      FROM metrics GROUP BY ALL) b
GROUP BY ticker""", "hour")
ORACLE["an_watchlist_compare"] = with_ctes(
    f"""SELECT ticker, count(*) AS n_windows, round(avg(avg_price), 6) AS mean_price,
       round(avg(avg_sentiment), 6) AS mean_sentiment, CAST(sum(headline_count) AS BIGINT) AS headlines,
       round((arg_max(avg_price, window_start) - arg_min(avg_price, window_start))
             / NULLIF(arg_min(avg_price, window_start), 0), 6) AS price_return,
       round({safe_corr('avg_price', 'avg_sentiment')}, 6) AS correlation
FROM metrics WHERE ticker IN ('click', 'purchase', 'view') GROUP BY ticker""", "hour")

# ---------------------------------------------------------------- lake layers, quality

ORACLE["lake_layers"] = with_ctes(
    """SELECT 'bronze' AS layer, CAST("timestamp" AS DATE) AS event_date, count(*) AS n_rows
FROM (SELECT "timestamp" FROM ticks UNION ALL SELECT "timestamp" FROM headlines) b GROUP BY ALL
UNION ALL
SELECT 'silver_prices', CAST("timestamp" AS DATE), count(*) FROM ticks GROUP BY ALL
UNION ALL
SELECT 'silver_texts', CAST("timestamp" AS DATE), count(*) FROM headlines GROUP BY ALL
UNION ALL
SELECT 'gold', CAST(window_start AS DATE), count(*) FROM metrics GROUP BY ALL""", "hour")

_DQ = """SELECT '{name}' AS stream, count(*) AS n_rows,
       count(*) FILTER (WHERE ticker IS NULL) AS null_ticker,
       count(*) FILTER (WHERE "timestamp" IS NULL) AS null_time,
       count(*) FILTER (WHERE {value} IS NULL) AS null_value,
       count(*) FILTER (WHERE "timestamp" < hw - INTERVAL 1 minute) AS late_rows
FROM (SELECT *, max("timestamp") OVER (ORDER BY {seq} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hw
      FROM {src}) x"""
ORACLE["dq_report"] = with_ctes(
    _DQ.format(name="prices", value="price", seq="event_id",
               src='(SELECT event_id, event_type AS ticker, value AS price, ts AS "timestamp" FROM events)')
    + "\nUNION ALL\n"
    + _DQ.format(name="headlines", value="headline", seq="doc_id", src="headlines"))
ORACLE["dq_envelope"] = with_ctes(
    """SELECT 'stock_prices' AS topic,
       (SELECT count(*) FROM events) * 2 + (SELECT count(*) FROM documents) AS messages,
       (SELECT count(*) FROM events) + (SELECT count(*) FROM documents) AS rejects,
       (SELECT count(*) FILTER (WHERE ticker IS NULL) FROM ticks) AS null_ticker,
       (SELECT count(*) FILTER (WHERE price IS NULL) FROM ticks) AS null_value,
       (SELECT count(*) FILTER (WHERE "timestamp" IS NULL) FROM ticks) AS null_time""")
ORACLE["dq_metrics"] = with_ctes(
    """SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE avg_price IS NULL) AS null_price_windows,
       count(*) FILTER (WHERE headline_count = 0) AS no_headline_windows,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM metrics GROUP BY ticker, window_start) k) AS duplicate_keys
FROM metrics""", "hour")


ORACLE["lake_gold"] = with_ctes(METRICS_OUT, "hour")

# ---------------------------------------------------------------- tie-stable output rounding

TIE_GUARD = "1.000000000001"


def guard_round6(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` to ``round((<expr>) * TIE_GUARD, 6)``,
    the same tie-stable output rounding the Spark side applies."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k, depth = j + len("round("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = guard_round6(sql[j + len("round("): k - 1])
        head, sep, digits = inner.rpartition(",")
        if sep and digits.strip() == "6":
            out.append(sql[i:j] + f"round(({head}) * {TIE_GUARD}, 6)")
        else:
            out.append(sql[i:j] + f"round({inner})")
        i = k


for _k in list(ORACLE):
    ORACLE[_k] = guard_round6(ORACLE[_k])


# ---------------------------------------------------------------- streaming: closed windows only

_CLOSED = """(SELECT least((SELECT max("timestamp") FROM ticks), (SELECT max("timestamp") FROM headlines))
        - INTERVAL 1 minute)"""
ORACLE["join_price_sentiment_stream"] = guard_round6(with_ctes(
    METRICS_OUT + f"\nWHERE window_end <= {_CLOSED}", "minute"))
ORACLE["join_price_sentiment_stream_rocksdb"] = ORACLE["join_price_sentiment_stream"]
ORACLE["join_price_sentiment_stream_steps"] = ORACLE["join_price_sentiment_stream"]
ORACLE["stream_rejects"] = with_ctes(
    """SELECT 'accepted' AS output, ticker, round(price, 2) AS price, "timestamp", CAST(NULL AS VARCHAR) AS raw_value,
       CAST(NULL AS VARCHAR) AS reason FROM ticks
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, raw, CASE WHEN raw IS NULL THEN 'null value' ELSE 'not an event' END
FROM (SELECT props AS raw FROM events UNION ALL SELECT text FROM documents) r""")
ORACLE["score_stream_lexicon"] = with_ctes(
    """SELECT ticker, source, "timestamp",
       CASE WHEN "timestamp" < TIMESTAMP '2024-01-15 00:00:00' THEN round(m / sqrt(m * m + 15), 4) ELSE sentiment_score END AS sentiment_score,
       CASE WHEN "timestamp" < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS lexicon_version
FROM scored JOIN (
  SELECT doc_id, 1.5 * len(list_filter(string_split_regex(coalesce(cleaned_headline, 'none'), '[^a-z]+'), lambda z: z = 'that')) AS m
  FROM cleaned) f USING (doc_id)""")
ORACLE["str_state_rows"] = with_ctes(
    f"""SELECT * FROM (
  SELECT DISTINCT 'price' AS side, ticker, date_trunc('minute', "timestamp") AS window_start,
         date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end FROM ticks WHERE "timestamp" IS NOT NULL
  UNION ALL
  SELECT DISTINCT 'sentiment', ticker, date_trunc('minute', "timestamp"), date_trunc('minute', "timestamp") + INTERVAL 1 minute
  FROM headlines WHERE "timestamp" IS NOT NULL) w
WHERE window_end > {_CLOSED}""")
ORACLE["stream_price_window"] = guard_round6(with_ctes(
    """SELECT * FROM (
  SELECT ticker, date_trunc('minute', "timestamp") AS window_start,
         date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end,
         round(avg(price), 6) AS avg_price, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price,
       count(price) AS price_count
  FROM ticks WHERE "timestamp" IS NOT NULL GROUP BY ALL) w
WHERE window_end <= (SELECT max("timestamp") FROM ticks) - INTERVAL 1 minute"""))
ORACLE["stream_sentiment_window"] = guard_round6(with_ctes(
    """SELECT * FROM (
  SELECT ticker, date_trunc('minute', "timestamp") AS window_start,
         date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end,
         round(avg(sentiment_score), 6) AS avg_sentiment, count(headline) AS headline_count
  FROM scored WHERE "timestamp" IS NOT NULL GROUP BY ALL) w
WHERE window_end <= (SELECT max("timestamp") FROM headlines) - INTERVAL 1 minute"""))


# Late data: batch b = the ticker's position; W_k = (max event time over batches <= k) - 1 minute;
# a row of batch b is kept iff its window end > W_(b-2); closed windows: end <= W_final.
ORACLE["stream_late_data"] = guard_round6(with_ctes(
    f"""SELECT * FROM (
  SELECT ticker, window_start, window_end,
         round(avg(sentiment_score), 6) AS avg_sentiment, count(headline) AS headline_count
  FROM (
    SELECT b.*
    FROM (SELECT s.*, date_trunc('minute', "timestamp") AS window_start,
                 date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end,
                 list_position({_tickers_list()}, ticker) - 1 AS batch
          FROM scored s WHERE "timestamp" IS NOT NULL) b
    LEFT JOIN (SELECT batch, max(max("timestamp")) OVER (ORDER BY batch) - INTERVAL 1 minute AS w
               FROM (SELECT list_position({_tickers_list()}, ticker) - 1 AS batch, "timestamp" FROM headlines) x
               GROUP BY batch) wm
      ON wm.batch = b.batch - 2
    WHERE wm.w IS NULL OR b.window_end > wm.w) kept
  GROUP BY ticker, window_start, window_end) w
WHERE window_end <= (SELECT max("timestamp") FROM headlines) - INTERVAL 1 minute"""))


# Late data on both inputs of the join: batch = ticker position in both topics;
# W_k = min(max price time, max headline time over batches <= k) - 1 minute;
# each side keeps rows with window end > W_(b-2); closed windows: end <= W_last.
_BATCH = f"list_position({_tickers_list()}, ticker) - 1"
def _join_late_sql(combine: str) -> str:
    return guard_round6(with_ctes(
    f"""SELECT p.ticker, p.window_start, p.window_end,
       round(p.avg_price, 6) AS avg_price, round(p.min_price, 6) AS min_price, round(p.max_price, 6) AS max_price,
       CAST(p.price_count AS INTEGER) AS price_count, round(coalesce(s.avg_sentiment, 0.0), 6) AS avg_sentiment,
       CAST(s.headline_count AS INTEGER) AS headline_count
FROM (SELECT ticker, window_start, window_end, avg(price) AS avg_price, min(price) AS min_price,
             max(price) AS max_price, count(price) AS price_count
      FROM (SELECT t.*, date_trunc('minute', "timestamp") AS window_start,
                   date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end, {_BATCH} AS batch
            FROM ticks t WHERE "timestamp" IS NOT NULL) x
      LEFT JOIN wm ON wm.batch = x.batch - 2
      WHERE wm.w IS NULL OR x.window_end > wm.w
      GROUP BY ticker, window_start, window_end) p
JOIN (SELECT ticker, window_start, window_end, avg(sentiment_score) AS avg_sentiment, count(headline) AS headline_count
      FROM (SELECT s.*, date_trunc('minute', "timestamp") AS window_start,
                   date_trunc('minute', "timestamp") + INTERVAL 1 minute AS window_end, {_BATCH} AS batch
            FROM scored s WHERE "timestamp" IS NOT NULL) y
      LEFT JOIN wm ON wm.batch = y.batch - 2
      WHERE wm.w IS NULL OR y.window_end > wm.w
      GROUP BY ticker, window_start, window_end) s
  ON s.ticker = p.ticker AND s.window_start = p.window_start
WHERE p.window_end <= (SELECT max(w) FROM wm)""", extra=f"""wm AS (
  SELECT pb.batch, {combine}(pb.m, tb.m) - INTERVAL 1 minute AS w
  FROM (SELECT batch, max(max("timestamp")) OVER (ORDER BY batch) AS m
        FROM (SELECT {_BATCH} AS batch, "timestamp" FROM ticks) a GROUP BY batch) pb
  JOIN (SELECT batch, max(max("timestamp")) OVER (ORDER BY batch) AS m
        FROM (SELECT {_BATCH} AS batch, "timestamp" FROM headlines) b GROUP BY batch) tb
    ON tb.batch = pb.batch
)"""))


ORACLE["join_stream_late_data"] = _join_late_sql("least")
ORACLE["join_stream_late_data_max_policy"] = _join_late_sql("greatest")
