"""DuckDB SQL for the registered queries (the correctness oracle).

Only the base tables are registered on the DuckDB side, so each statement inlines the
media fact and the cleaning chain as CTEs. Spark computes the same results through the
DataFrame operators in ``mixlens.operators``; these texts are the independent check.
"""

from __future__ import annotations

WEEK_IX = "CAST(ceil(datediff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) / 7.0) AS INT)"

MEDIA_RAW = f"""
SELECT
  CAST(l.l_shipdate AS DATE) AS activity_date,
  r.r_name AS tab,
  p.p_type AS media_type,
  n.n_name AS channel,
  CASE l.l_returnflag WHEN 'R' THEN ' VIdeo ' WHEN 'A' THEN 'Video' ELSE 'Display ' END AS sub_channel,
  CASE WHEN l.l_suppkey % 7 = 0 THEN NULL ELSE s.s_name END AS site,
  CASE WHEN l.l_partkey % 3 = 0 THEN NULL ELSE l.l_linestatus END AS device,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE c.c_mktsegment END AS platform_type,
  CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderpriority END AS partner_type,
  CASE WHEN l.l_orderkey % 5 < 3 THEN NULL ELSE c.c_mktsegment END AS audience,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE p.p_name END AS creative,
  CAST(CASE WHEN l.l_partkey % 11 = 0 THEN NULL
       WHEN l.l_linenumber = 7 THEN -CAST(l.l_extendedprice AS DECIMAL(18,2))
       WHEN l.l_returnflag = 'N' THEN 0
       ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS spend,
  CAST(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity * 1000 ELSE NULL END AS BIGINT) AS impressions,
  CAST(CASE WHEN l.l_linestatus = 'O' THEN l.l_partkey % 50 ELSE NULL END AS BIGINT) AS clicks,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity * 10 ELSE 0 END AS BIGINT) AS video_starts,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity * 4 ELSE 0 END AS BIGINT) AS video_completes,
  CAST(CASE WHEN l.l_linenumber = 1 THEN l.l_quantity ELSE NULL END AS BIGINT) AS hh_grps_tv,
  CAST(l.l_suppkey % 20 AS BIGINT) AS engagements,
  CAST(CASE WHEN {WEEK_IX} >= 340 OR l.l_suppkey % 5 = 0 THEN NULL
       ELSE (7000000 + (({WEEK_IX} * 7919) % 100) * 10000) * l.l_linenumber END AS DECIMAL(18,2)) AS base_amount,
  l.l_linenumber AS _lnum
FROM lineitem l
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p     ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n   ON s.s_nationkey = n.n_nationkey
JOIN region r   ON n.n_regionkey = r.r_regionkey
"""

RAW_COLS = ("activity_date, tab, media_type, channel, sub_channel, site, device, platform_type, "
            "partner_type, audience, creative, spend, impressions, clicks, video_starts, "
            "video_completes, hh_grps_tv, engagements, base_amount")

TEXT = ["tab", "media_type", "channel", "sub_channel", "site", "device", "platform_type",
        "partner_type", "audience", "creative"]
FILLS = {"site": "Unknown", "device": "Not Tracked", "platform_type": "Unknown",
         "partner_type": "Not Applicable", "audience": "Not Applicable",
         "creative": "Unspecified Creative"}
METRICS = ["spend", "impressions", "clicks", "video_starts", "video_completes", "hh_grps_tv",
           "engagements", "base_amount"]
ADDITIVE = [m for m in METRICS if m != "base_amount"]


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _clean_select() -> str:
    parts = ["CAST(activity_date + CAST((7 - dayofweek(activity_date)) % 7 AS INTEGER) AS DATE) AS week"]
    for c in TEXT:
        e = _trim(c)
        if c == "sub_channel":
            e = f"CASE WHEN {e} = 'VIdeo' THEN 'Video' ELSE {e} END"
        if c in FILLS:
            e = f"COALESCE({e}, '{FILLS[c]}')"
        parts.append(f"{e} AS {c}")
    parts += [f"{m}" for m in METRICS]
    parts.append("COALESCE(spend < 0, false) AS spend_is_credit")
    return ",\n    ".join(parts)


def _coerce_select() -> str:
    keep = ["week", *TEXT, "spend_is_credit"]
    return ", ".join(keep + [f"GREATEST(COALESCE({m}, 0), 0) AS {m}" for m in METRICS])


def ctes(copies: bool = False) -> str:
    """media_raw, clean, weekly and allocation CTEs (each used only when referenced)."""
    raw = (f"SELECT {RAW_COLS} FROM ({MEDIA_RAW}) x"
           if not copies else
           f"SELECT {RAW_COLS} FROM ({MEDIA_RAW}) x UNION ALL SELECT {RAW_COLS} FROM ({MEDIA_RAW}) y WHERE _lnum = 2")
    wcands = ["spend", "impressions", "hh_grps_tv", "engagements"]
    mx = ", ".join(f"MAX(GREATEST(CAST({c} AS DOUBLE), 0)) AS m_{c}" for c in wcands)
    w = ",\n      ".join(
        f"CASE WHEN mx.m_{c} > 0 AND GREATEST(CAST(c.{c} AS DOUBLE), 0) / mx.m_{c} > 0 "
        f"THEN GREATEST(CAST(c.{c} AS DOUBLE), 0) / mx.m_{c} END" for c in wcands)
    return f"""WITH media_raw AS ({raw}),
clean AS (
  SELECT {_coerce_select()}
  FROM (SELECT DISTINCT * FROM (SELECT
    {_clean_select()}
  FROM media_raw) d) dd),
weekly_sales AS (
  SELECT week, MIN(CASE WHEN base_amount > 0 THEN base_amount END) AS total_sales
  FROM clean WHERE week IS NOT NULL GROUP BY week),
mx AS (SELECT {mx} FROM clean),
weighted AS (
  SELECT c.*, COALESCE(
      {w},
      1.0) AS activity_weight
  FROM clean c CROSS JOIN mx),
week_weight AS (
  SELECT week, SUM(activity_weight) AS ww,
         MIN(CASE WHEN base_amount > 0 THEN base_amount END) AS ts
  FROM weighted GROUP BY week),
alloc AS (
  SELECT w.*, COALESCE(w.activity_weight / NULLIF(k.ww, 0) * CAST(k.ts AS DOUBLE), 0.0) AS estimated_sales
  FROM weighted w LEFT JOIN week_weight k ON w.week = k.week),
rows AS (
  SELECT *, CAST(year(week) AS INTEGER) AS year, CAST(quarter(week) AS INTEGER) AS quarter,
         CAST(month(week) AS INTEGER) AS month,
         strftime(week, '%b') AS month_name, CAST(weekofyear(week) AS INTEGER) AS week_number
  FROM alloc),
weekly AS (
  SELECT week, {_weekly_sums()},
         MIN(CASE WHEN base_amount > 0 THEN base_amount END) AS total_sales
  FROM clean WHERE week IS NOT NULL GROUP BY week),
weekly_f AS (
  SELECT *, CAST(year(week) AS INTEGER) AS year, CAST(quarter(week) AS INTEGER) AS quarter,
         CAST(month(week) AS INTEGER) AS month, strftime(week, '%b') AS month_name,
         CAST(weekofyear(week) AS INTEGER) AS week_number,
         {div('clicks', 'impressions')} AS ctr,
         {div('engagements', 'impressions')} AS engagement_rate,
         {div('video_completes', 'video_starts')} AS video_completion_rate,
         {div('spend', 'engagements')} AS cost_per_engagement,
         {div('spend', 'total_sales')} AS cost_per_sale
  FROM weekly)
"""


def div(a: str, b: str) -> str:
    """Double division, NULL on a zero denominator."""
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _weekly_sums() -> str:
    return ", ".join(f"SUM({m}) AS {m}" if m == "spend" else f"CAST(SUM({m}) AS BIGINT) AS {m}"
                     for m in ADDITIVE)


def corr(x: str, y: str, src: str | None = None) -> str:
    """Pairwise-complete Pearson r, NULL for a constant column (mirrors ``safe_corr``)."""
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    xm, ym = f"CASE WHEN {both} THEN CAST({x} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({y} AS DOUBLE) END"
    return f"covar_samp({xm}, {ym}) / NULLIF(stddev_samp({xm}) * stddev_samp({ym}), 0)"


def label(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR {v} IN ('None', 'nan', 'NaN') THEN 'Unknown' ELSE {v} END"


def d(c: str) -> str:
    """Date column as ISO text (the registered queries' presentation)."""
    return f"strftime({c}, '%Y-%m-%d')"


def q(body: str, copies: bool = False) -> str:
    return ctes(copies) + body


SALES_FEATS = ["sales_lag_%d" % i for i in range(1, 9)]
ROLL = ["sales_rolling_mean_4", "sales_rolling_mean_8", "sales_rolling_std_8", "sales_rolling_min_8",
        "sales_rolling_max_8"]
PRESENT_BASE = ["spend", "impressions", "clicks", "video_starts", "video_completes", "hh_grps_tv",
                "engagements", "ctr", "engagement_rate", "video_completion_rate", "month", "quarter",
                "week_of_year_sin", "week_of_year_cos"]
PRESENT_ROLL = ROLL + ["sales_ewm_4", "sales_diff_1", "sales_ratio_to_mean_8", "spend_lag_1",
                       "impressions_lag_1", "clicks_lag_1"]
FEATURES = PRESENT_BASE + SALES_FEATS + PRESENT_ROLL


def feature_ctes(ts_sql: str | None = None) -> str:
    """Feature CTEs over ``weekly_f`` (one series named 'all') or over ``ts_sql`` (a panel);
    EWM by a bounded self-join."""
    lags = ", ".join(f"LAG(total_sales, {i}) OVER w AS sales_lag_{i}" for i in range(1, 9))
    roll = []
    for name, fn, n in [("sales_rolling_mean_4", "AVG", 4), ("sales_rolling_mean_8", "AVG", 8),
                        ("sales_rolling_std_8", "STDDEV_SAMP", 8), ("sales_rolling_min_8", "MIN", 8),
                        ("sales_rolling_max_8", "MAX", 8)]:
        roll.append(f"CASE WHEN COUNT(total_sales) OVER w{n} >= 2 THEN {fn}(total_sales) OVER w{n} END AS {name}")
    media = ", ".join(f"LAG({c}, 1) OVER w AS {c}_lag_1" for c in ["spend", "impressions", "clicks"])
    ts = ts_sql or """
  SELECT 'all' AS series, week, CAST(total_sales AS DOUBLE) AS total_sales, CAST(spend AS DOUBLE) AS spend,
         impressions, clicks, video_starts, video_completes, hh_grps_tv, engagements, ctr, engagement_rate,
         video_completion_rate, month, quarter, week_number
  FROM weekly_f"""
    return f""", ts AS ({ts}),
feat AS (
  SELECT *, {lags}, {", ".join(roll)}, {media}, row_number() OVER w AS _i
  FROM ts
  WINDOW w AS (PARTITION BY series ORDER BY week),
         w4 AS (PARTITION BY series ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
         w8 AS (PARTITION BY series ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
ewm AS (
  SELECT a.series, a.week,
         SUM(b.total_sales * pow(0.6, a._i - 1 - b._i)) / SUM(pow(0.6, a._i - 1 - b._i)) AS sales_ewm_4
  FROM feat a JOIN feat b ON a.series = b.series AND b._i < a._i
       AND b.total_sales IS NOT NULL
  GROUP BY a.series, a.week),
feat2 AS (
  SELECT f.* EXCLUDE (_i), e.sales_ewm_4, f.sales_lag_1 - f.sales_lag_2 AS sales_diff_1,
         CASE WHEN f.sales_rolling_mean_8 IS NOT NULL
              THEN f.sales_lag_1 / GREATEST(f.sales_rolling_mean_8, 1.0) END AS sales_ratio_to_mean_8,
         sin(2 * pi() * CAST(f.week_number AS DOUBLE) / 52.0) AS week_of_year_sin,
         cos(2 * pi() * CAST(f.week_number AS DOUBLE) / 52.0) AS week_of_year_cos
  FROM feat f LEFT JOIN ewm e ON f.series = e.series AND f.week = e.week),
kept AS (
  SELECT * FROM feat2 WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SALES_FEATS + PRESENT_ROLL)}),
caps AS (
  SELECT quantile_cont(ctr, 0.99) AS cap_ctr, quantile_cont(engagement_rate, 0.99) AS cap_er,
         quantile_cont(video_completion_rate, 0.99) AS cap_vcr FROM kept),
model AS (
  SELECT k.* REPLACE (
      COALESCE(CASE WHEN k.ctr IS NOT NULL THEN LEAST(k.ctr, c.cap_ctr) END, 0.0) AS ctr,
      COALESCE(CASE WHEN k.engagement_rate IS NOT NULL THEN LEAST(k.engagement_rate, c.cap_er) END, 0.0)
        AS engagement_rate,
      COALESCE(CASE WHEN k.video_completion_rate IS NOT NULL THEN LEAST(k.video_completion_rate, c.cap_vcr) END,
               0.0) AS video_completion_rate)
  FROM kept k CROSS JOIN caps c),
split AS (
  SELECT *, CASE WHEN total_sales IS NULL THEN 'forecast'
                 WHEN row_number() OVER (PARTITION BY series, total_sales IS NOT NULL ORDER BY week DESC)
                      <= LEAST(12, GREATEST(1, FLOOR(COUNT(*) OVER (PARTITION BY series, total_sales IS NOT NULL) / 4)))
                 THEN 'test' ELSE 'train' END AS split
  FROM model)
"""


# rounding of the feature columns in the registered outputs
SALES_SCALE = set(SALES_FEATS + ROLL + ["sales_ewm_4", "sales_diff_1", "total_sales"])
UNIT_SCALE = {"sales_ratio_to_mean_8", "week_of_year_sin", "week_of_year_cos", "ctr", "engagement_rate",
              "video_completion_rate"}


def feat_digits(c: str):
    if c in SALES_SCALE:
        return 4
    if c in UNIT_SCALE:
        return 9
    return None


def feat_select(cols, src: str = "") -> str:
    out = []
    for c in cols:
        e = f"CAST({src}{c} AS DOUBLE)"
        dg = feat_digits(c)
        # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's rounding does
        out.append(f"ROUND({e}, {dg}) + 0.0 AS {c}" if dg is not None else f"{e} AS {c}")
    return ", ".join(out)


def fq(body: str) -> str:
    return ctes() + feature_ctes() + body


PANEL = """, pw AS (
  SELECT channel AS series, week, SUM(spend) AS spend, CAST(SUM(impressions) AS BIGINT) AS impressions,
         CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(video_starts) AS BIGINT) AS video_starts,
         CAST(SUM(video_completes) AS BIGINT) AS video_completes, CAST(SUM(hh_grps_tv) AS BIGINT) AS hh_grps_tv,
         CAST(SUM(engagements) AS BIGINT) AS engagements, SUM(estimated_sales) AS est
  FROM rows WHERE week IS NOT NULL GROUP BY channel, week),
sp AS (SELECT DISTINCT channel AS series FROM rows),
pd AS (
  SELECT sp.series, ws.week, COALESCE(pw.spend, 0) AS spend, COALESCE(pw.impressions, 0) AS impressions,
         COALESCE(pw.clicks, 0) AS clicks, COALESCE(pw.video_starts, 0) AS video_starts,
         COALESCE(pw.video_completes, 0) AS video_completes, COALESCE(pw.hh_grps_tv, 0) AS hh_grps_tv,
         COALESCE(pw.engagements, 0) AS engagements,
         CASE WHEN ws.total_sales IS NOT NULL THEN COALESCE(pw.est, 0.0) END AS total_sales
  FROM sp CROSS JOIN weekly_sales ws LEFT JOIN pw ON pw.series = sp.series AND pw.week = ws.week),
pdf AS (
  SELECT *, CAST(month(week) AS INTEGER) AS month, CAST(quarter(week) AS INTEGER) AS quarter,
         CAST(weekofyear(week) AS INTEGER) AS week_number,
         CAST(clicks AS DOUBLE) / NULLIF(CAST(impressions AS DOUBLE), 0) AS ctr,
         CAST(engagements AS DOUBLE) / NULLIF(CAST(impressions AS DOUBLE), 0) AS engagement_rate,
         CAST(video_completes AS DOUBLE) / NULLIF(CAST(video_starts AS DOUBLE), 0) AS video_completion_rate,
         CAST(spend AS DOUBLE) / NULLIF(CAST(total_sales AS DOUBLE), 0) AS cost_per_sale
  FROM pd)
"""

PANEL_TS = """
  SELECT series, week, total_sales, CAST(spend AS DOUBLE) AS spend, impressions, clicks, video_starts,
         video_completes, hh_grps_tv, engagements, ctr, engagement_rate, video_completion_rate, month, quarter,
         week_number
  FROM pdf"""


def pq(body: str) -> str:
    return ctes() + PANEL + body


def pfq(body: str) -> str:
    return ctes() + PANEL + feature_ctes(PANEL_TS) + body


def linear(weights: dict) -> str:
    """Weighted sum of feature columns."""
    return " + ".join(f"CAST({c} AS DOUBLE) * {w!r}" for c, w in weights.items())


def _candidates(start: str, horizon: int) -> str:
    """``start``'s CTEs and those of the candidate rows: anchor, cand (series, step, week and features)."""
    return start.replace("WITH", "WITH RECURSIVE", 1) + f""", anchor AS (
  SELECT series, MAX(CASE WHEN total_sales IS NOT NULL THEN week END) AS a, MAX(week) AS l FROM ts GROUP BY series),
after AS (
  SELECT t.series, t.week, row_number() OVER (PARTITION BY t.series ORDER BY t.week) AS k
  FROM ts t JOIN anchor n ON t.series = n.series AND t.week > n.a),
fut AS (
  SELECT series, week FROM after WHERE k <= {horizon}
  UNION ALL
  SELECT n.series, CAST(n.l + INTERVAL (7 * p.i) DAY AS DATE)
  FROM (SELECT n.series, n.l, COUNT(f.week) AS have FROM anchor n LEFT JOIN after f ON n.series = f.series
        WHERE n.a IS NOT NULL GROUP BY n.series, n.l) n, range(1, {horizon} + 1) p(i)
  WHERE p.i <= {horizon} - least(n.have, {horizon})),
seq AS (
  SELECT f.series, f.week, true AS ahead FROM fut f
  UNION ALL SELECT series, a, false FROM anchor WHERE a IS NOT NULL),
cand AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY week) AS step FROM (
    SELECT s.series, s.week, s.ahead, t.spend, t.clicks, t.month,
           sin(2 * pi() * CAST(t.week_number AS DOUBLE) / 52.0) AS week_of_year_sin,
           LAG(t.spend) OVER w AS spend_lag_1, LAG(t.clicks) OVER w AS clicks_lag_1
    FROM seq s LEFT JOIN ts t ON s.series = t.series AND s.week = t.week
    WINDOW w AS (PARTITION BY s.series ORDER BY s.week)) x WHERE ahead)"""


def linear_forecast(start: str, weights: dict, horizon: int) -> str:
    """Recursive forecast by fixed weights, as a recursive query carrying a list of the last 8
    values; ``start`` holds the feature CTEs (``ts`` among them)."""
    def lag(i):
        return f"CASE WHEN len(hist) >= {i} THEN hist[len(hist) - {i} + 1] ELSE 0.0 END"

    mean8 = "list_aggregate(hist, 'avg')"
    state = {f"sales_lag_{i}": lag(i) for i in range(1, 9)}
    state.update({
        "sales_rolling_mean_4": "list_aggregate(hist[greatest(len(hist) - 3, 1):], 'avg')",
        "sales_rolling_mean_8": mean8,
        "sales_rolling_std_8": "list_aggregate(hist, 'stddev_samp')",
        "sales_rolling_min_8": "list_aggregate(hist, 'min')",
        "sales_rolling_max_8": "list_aggregate(hist, 'max')",
        "sales_ewm_4": mean8,
        "sales_diff_1": f"CASE WHEN ({lag(2)}) <> 0 THEN ({lag(1)}) - ({lag(2)}) ELSE 0.0 END",
        "sales_ratio_to_mean_8": f"({lag(1)}) / greatest({mean8}, 1.0)",
    })
    total = " + ".join(f"COALESCE(CAST({state.get(c, 'c.' + c)} AS DOUBLE), 0.0) * {w!r}" for c, w in weights.items())
    return _candidates(start, horizon) + f""",
past AS (
  SELECT t.series, list(t.total_sales ORDER BY t.week) AS h FROM ts t JOIN anchor n ON t.series = n.series
  AND t.week <= n.a GROUP BY t.series),
walk(series, step, week, hist, y) AS (
  SELECT series, CAST(0 AS BIGINT), CAST(NULL AS DATE), h[greatest(len(h) - 7, 1):], CAST(NULL AS DOUBLE) FROM past
  UNION ALL
  SELECT series, step, week, list_append(hist, y)[greatest(len(hist) - 6, 1):], y FROM (
    SELECT r.series, c.step, c.week, r.hist, greatest({total}, 0.0) AS y
    FROM walk r JOIN cand c ON c.series = r.series AND c.step = r.step + 1) z)
SELECT series, strftime(week, '%Y-%m-%d') AS week, ROUND(y, 2) AS forecasted_sales FROM walk WHERE step > 0"""


_ARX_FIT = """, tr AS (
  SELECT series, ln(1 + sales_lag_1) AS z, CAST({0} AS DOUBLE) AS a, CAST({1} AS DOUBLE) AS b, ln(1 + total_sales) AS y
  FROM split WHERE split = 'train'),
st AS (
  SELECT series, COUNT(*) AS n, AVG(z) AS mz, AVG(a) AS ma, AVG(b) AS mb, AVG(y) AS my,
         CASE WHEN var_pop(z) > 0 THEN stddev_pop(z) ELSE 1 END AS sz, CASE WHEN var_pop(a) > 0 THEN stddev_pop(a) ELSE 1 END AS sa,
         CASE WHEN var_pop(b) > 0 THEN stddev_pop(b) ELSE 1 END AS sb, var_pop(z) AS zz, var_pop(a) AS aa, var_pop(b) AS bb,
         covar_pop(z, a) AS za, covar_pop(z, b) AS zb, covar_pop(a, b) AS ab, covar_pop(z, y) AS zy, covar_pop(a, y) AS ay,
         covar_pop(b, y) AS by_ FROM tr GROUP BY series),
eq AS (
  SELECT *, n * zz / sz / sz + {2} AS p, n * za / sz / sa AS q, n * zb / sz / sb AS r, n * aa / sa / sa + {2} AS s,
         n * ab / sa / sb AS t, n * bb / sb / sb + {2} AS u, n * zy / sz AS d, n * ay / sa AS e, n * by_ / sb AS f FROM st),
w AS (
  SELECT *, p * (s * u - t * t) - q * (q * u - t * r) + r * (q * t - s * r) AS det FROM eq),
co AS (
  SELECT series, (d * (s * u - t * t) - q * (e * u - t * f) + r * (e * t - s * f)) / det / sz AS cz,
         (p * (e * u - t * f) - d * (q * u - t * r) + r * (q * f - e * r)) / det / sa AS ca,
         (p * (s * f - e * t) - q * (q * f - e * r) + d * (q * t - s * r)) / det / sb AS cb, mz, ma, mb, my FROM w),
fit AS (SELECT series, cz, ca, cb, my - cz * mz - ca * ma - cb * mb AS c0 FROM co)"""


def arx_holdout(start: str, exog, penalty: float) -> str:
    """AR-X of one lag and two columns a series by its normal equations; the holdout follows its own predictions."""
    return start.replace("WITH", "WITH RECURSIVE", 1) + _ARX_FIT.format(*exog, penalty) + f""",
te AS (
  SELECT s.series, s.week, total_sales AS y, ln(1 + sales_lag_1) AS z, c0 + ca * CAST({exog[0]} AS DOUBLE) + cb * CAST({exog[1]} AS DOUBLE) AS rest,
         cz, row_number() OVER (PARTITION BY s.series ORDER BY s.week) AS k FROM split s JOIN fit USING (series) WHERE split = 'test'),
walk(series, k, p) AS (
  SELECT series, k, least(greatest(rest + cz * z, 0.0), 20.0) FROM te WHERE k = 1
  UNION ALL SELECT te.series, te.k, least(greatest(rest + cz * p, 0.0), 20.0) FROM walk JOIN te ON te.series = walk.series AND te.k = walk.k + 1)
SELECT series, strftime(week, '%Y-%m-%d') AS week, ROUND(y, 2) AS y, ROUND(exp(p) - 1, 2) AS yhat FROM te JOIN walk USING (series, k)"""


def arx_forecast(start: str, exog, penalty: float, horizon: int) -> str:
    """The same regressions rolled forward over the candidate rows."""
    return _candidates(start, horizon) + _ARX_FIT.format(*exog, penalty) + f""",
walk(series, step, week, p) AS (
  SELECT t.series, CAST(0 AS BIGINT), CAST(NULL AS DATE), ln(1 + t.total_sales) FROM ts t JOIN anchor n ON t.series = n.series AND t.week = n.a
  UNION ALL
  SELECT c.series, c.step, c.week, least(greatest(c0 + cz * p + ca * COALESCE(CAST(c.{exog[0]} AS DOUBLE), 0.0)
         + cb * COALESCE(CAST(c.{exog[1]} AS DOUBLE), 0.0), 0.0), 20.0)
  FROM walk r JOIN cand c ON c.series = r.series AND c.step = r.step + 1 JOIN fit f ON f.series = c.series)
SELECT series, strftime(week, '%Y-%m-%d') AS week, ROUND(exp(p) - 1, 2) AS forecasted_sales FROM walk WHERE step > 0"""


def stump(start: str, features, huber_alpha: float, l1: float, l2: float, least: int) -> str:
    """One boosting round of depth 1 for both losses, up to the split's sides (side) and leaf values (leaf)."""
    x = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(features))
    xs = ", ".join(f"x{i}" for i in range(len(features)))
    long = " UNION ALL ".join(f"SELECT model, {i} AS f, x{i} AS x, g FROM g" for i in range(len(features)))
    at = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(features))) + " END"

    def worth(g, n):
        return f"power(greatest(abs({g}) - l1, 0), 2) / ({n} + l2)"

    return start + f""", al AS (SELECT series, week, split, {x}, total_sales, ln(1 + total_sales) AS y FROM split WHERE split <> 'forecast'),
tr AS (SELECT * FROM al WHERE split = 'train'),
c AS (SELECT AVG(y) AS m, quantile_cont(y, 0.5) AS med FROM tr),
dl AS (SELECT quantile_cont(ABS(y - med), {huber_alpha}) AS delta FROM tr, c),
par AS (SELECT 'squared' AS model, m AS init, {l1} AS l1, {l2} AS l2, 1 AS least FROM c
        UNION ALL SELECT 'huber', med, 0.0, 0.0, {least} FROM c),
g AS (SELECT model, {xs}, y, y - init AS r, CASE WHEN model = 'squared' THEN y - init ELSE greatest(least(y - init, delta), -delta) END AS g
      FROM tr, par, dl),
cell AS (SELECT model, f, x, SUM(g) AS s, COUNT(*) AS n FROM ({long}) z GROUP BY model, f, x),
cum AS (SELECT model, f, x, LEAD(x) OVER w AS nx, SUM(s) OVER w AS gl, SUM(n) OVER w AS nl,
               SUM(s) OVER (PARTITION BY model, f) AS gs, SUM(n) OVER (PARTITION BY model, f) AS ns
        FROM cell WINDOW w AS (PARTITION BY model, f ORDER BY x)),
best AS (SELECT model, f, (x + nx) / 2 AS cut FROM cum JOIN par USING (model)
         WHERE nx IS NOT NULL AND nl >= least AND ns - nl >= least
         QUALIFY row_number() OVER (PARTITION BY model ORDER BY
           ROUND({worth('gl', 'nl')} + {worth('gs - gl', 'ns - nl')} - {worth('gs', 'ns')}, 9) DESC, f, x) = 1),
sd AS (SELECT model, r, g, {at} <= cut AS lo FROM g JOIN best USING (model)),
med AS (SELECT model, lo, quantile_cont(r, 0.5) AS md, SUM(g) AS s, COUNT(*) AS n FROM sd GROUP BY model, lo),
off AS (SELECT model, lo, AVG(sign(r - md) * least(abs(r - md), delta)) AS o FROM sd JOIN med USING (model, lo), dl GROUP BY model, lo),
leaf AS (SELECT model, lo, n, CASE WHEN model = 'squared' THEN sign(s) * greatest(abs(s) - l1, 0) / (n + l2) ELSE md + o END AS v
         FROM med JOIN off USING (model, lo) JOIN par USING (model)),
side AS (SELECT model, series, week, split, total_sales, f, {at} <= cut AS lo FROM al, best)
"""
