"""DuckDB SQL for every registered query, written independently of the Spark code.

Sums of money are exact decimals. Means of ratios add each ratio to eighteen decimals, so that no sum
depends on row order; the sum is turned into a double by way of its text, which rounds once.
"""

EVENTS = """
b AS (
  SELECT CAST(l_suppkey AS BIGINT) AS k, l_partkey % 4 AS h, CAST(l_shipdate AS DATE) AS d,
         CAST(l_quantity AS BIGINT) - 1 AS q, l_returnflag AS rf, l_linenumber,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS disc
  FROM lineitem),
g AS (
  SELECT k, h, d,
         SUM(q * (15 + 10 * l_linenumber)) AS impressions,
         SUM(q) AS clicks,
         SUM(CASE WHEN rf = 'N' THEN (q - q % 2) / 2 ELSE 0 END) AS conversions,
         SUM(CAST(p * disc AS DECIMAL(18,2))) AS spend,
         SUM(CASE WHEN rf = 'R' THEN CAST(0 AS DECIMAL(18,2))
                  ELSE CAST(p * CAST(0.25 AS DECIMAL(4,2)) AS DECIMAL(18,2)) END) AS revenue
  FROM b GROUP BY k, h, d),
n AS (
  SELECT 'C' || lpad(CAST(k + 1 AS STRING), 12, '0') AS campaign_id,
         'Campaign ' || CAST(k + 1 AS STRING) AS campaign_name,
         CASE k % 3 WHEN 0 THEN 'awareness' WHEN 1 THEN 'conversion' ELSE 'retargeting' END AS campaign_type,
         'Advertiser ' || CAST(k % 4 AS STRING) AS advertiser,
         CASE WHEN h < 2 THEN 'Google' ELSE 'Meta' END AS platform,
         CASE h WHEN 0 THEN 'Google Search' WHEN 1 THEN 'Google Display'
                WHEN 2 THEN 'Meta Feed' ELSE 'Meta Stories' END AS channel,
         d AS date,
         CAST(impressions AS INT) AS impressions, CAST(clicks AS INT) AS clicks,
         CAST(conversions AS INT) AS conversions,
         CAST(spend AS DOUBLE) AS spend_usd, CAST(revenue AS DOUBLE) AS revenue_usd
  FROM g),
ev AS (
  SELECT campaign_id || '|' || channel || '|' || CAST(date AS STRING) AS event_id,
         CAST(date AS STRING) || 'T00:00:00Z' AS timestamp, * FROM n)"""

METRICS = """
m AS (
  SELECT *,
         CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0.0::DOUBLE END AS ctr,
         CASE WHEN clicks > 0 THEN spend_usd / clicks ELSE 0.0::DOUBLE END AS cpc,
         CASE WHEN spend_usd > 0 THEN revenue_usd / spend_usd ELSE 0.0::DOUBLE END AS roas,
         CASE WHEN clicks > 0 THEN conversions / clicks ELSE 0.0::DOUBLE END AS conversion_rate
  FROM ev)"""

SILVER = """
s AS (
  SELECT *,
         SUM(impressions) OVER w7 / COUNT(impressions) OVER w7 AS rolling_7d_impressions,
         SUM(clicks) OVER w7 / COUNT(clicks) OVER w7 AS rolling_7d_clicks,
         CAST(SUM(CAST(spend_usd AS DECIMAL(18,6))) OVER w7 AS DOUBLE)
           / COUNT(spend_usd) OVER w7 AS rolling_7d_spend,
         CAST(SUM(CAST(spend_usd AS DECIMAL(18,6))) OVER wrun AS DOUBLE) AS running_total_spend,
         CAST(RANK() OVER (PARTITION BY channel, week(date) ORDER BY roas DESC) AS BIGINT)
           AS roas_rank_in_channel
  FROM m
  WINDOW w7 AS (PARTITION BY campaign_id ORDER BY date
                RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
         wrun AS (PARTITION BY campaign_id ORDER BY date, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def money(x, over=""):
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) {over} AS DOUBLE)"


def mean(x):
    """Ratios are cut into units, millionths and so on down to 1e-18, and the pieces are added."""
    pieces, rest = [], x
    for place in range(18, -1, -6):
        pieces.append(f"SUM(CAST(floor({rest}{' + 0.5' if place == 0 else ''}) AS HUGEINT)) * {10 ** place}")
        rest = f"(({rest}) - floor({rest})) * 1000000"
    return f"(CAST(CAST({' + '.join(pieces)} AS VARCHAR) || 'e-18' AS DOUBLE) / COUNT({x}))"


def rounded(x, places):
    """Half-up on the shortest decimal form of the double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


DAILY = f"""
daily AS (
  SELECT campaign_id, campaign_name, campaign_type, advertiser, date,
         CAST(SUM(impressions) AS BIGINT) AS total_impressions,
         CAST(SUM(clicks) AS BIGINT) AS total_clicks,
         CAST(SUM(conversions) AS BIGINT) AS total_conversions,
         {money('spend_usd')} AS total_spend, {money('revenue_usd')} AS total_revenue,
         {mean('ctr')} AS avg_ctr, {mean('roas')} AS avg_roas
  FROM m GROUP BY ALL)"""


def weekly(year):
    return f"""
weekly AS (
  SELECT channel, platform, CAST({year} AS INT) AS year, CAST(week(date) AS INT) AS week,
         CAST(SUM(impressions) AS BIGINT) AS total_impressions,
         CAST(SUM(clicks) AS BIGINT) AS total_clicks,
         {money('spend_usd')} AS total_spend, {money('revenue_usd')} AS total_revenue,
         {mean('roas')} AS avg_roas, {mean('ctr')} AS avg_ctr
  FROM m GROUP BY ALL)"""


WEEKLY = weekly("year(date)")

_CAMPAIGN = "campaign_id, campaign_name, campaign_type, advertiser"
_CAMPAIGN_KEY = f"substr(md5(concat_ws('|', {_CAMPAIGN})), 1, 3), {_CAMPAIGN}"
_CHANNEL_KEY = "substr(md5(concat_ws('|', channel_name, platform)), 1, 3), channel_name, platform"

DIMS = f"""
dca AS (
  SELECT {_CAMPAIGN}, CAST(row_number() OVER (ORDER BY {_CAMPAIGN_KEY}) - 1 AS BIGINT) AS campaign_key
  FROM (SELECT DISTINCT {_CAMPAIGN} FROM ev)),
dch AS (
  SELECT channel_name, platform,
         CASE channel_name WHEN 'Google Search' THEN 'search' WHEN 'Google Display' THEN 'display'
              WHEN 'Meta Feed' THEN 'social_feed' ELSE 'social_story' END AS channel_type,
         CAST(row_number() OVER (ORDER BY {_CHANNEL_KEY}) - 1 AS BIGINT) AS channel_key
  FROM (SELECT DISTINCT channel AS channel_name, platform FROM ev)),
dda AS (
  SELECT date AS full_date, CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter,
         CAST(month(date) AS INT) AS month, CAST(week(date) AS INT) AS week,
         CAST(day(date) AS INT) AS day, dayname(date) AS day_of_week,
         dayofweek(date) IN (0, 6) AS is_weekend,
         CAST(strftime(date, '%Y%m%d') AS INT) AS date_key
  FROM (SELECT DISTINCT date FROM ev))"""

FACT = f"""
fact AS (
  SELECT event_id, campaign_key, date_key, channel_key, impressions, clicks, conversions,
         spend_usd, revenue_usd, {rounded('ctr', 4)} AS ctr, {rounded('cpc', 4)} AS cpc,
         {rounded('roas', 4)} AS roas, {rounded('rolling_7d_impressions', 1)} AS rolling_7d_impressions,
         {rounded('rolling_7d_spend', 2)} AS rolling_7d_spend, running_total_spend, roas_rank_in_channel
  FROM s JOIN dca USING (campaign_id) JOIN dch ON s.channel = dch.channel_name
         JOIN dda ON s.date = dda.full_date)"""

RENAMED = f"""
re AS (
  SELECT * REPLACE (campaign_name || ' v' || CAST((year(date) * 4 + quarter(date)) % 3 AS STRING) AS campaign_name,
                    CASE WHEN channel = 'Meta Feed' AND quarter(date) = 2 THEN 'Third party' ELSE advertiser END AS advertiser)
  FROM s)"""

VERSIONS = f"""
rd AS (
  SELECT {_CAMPAIGN}, date FROM re
  QUALIFY row_number() OVER (PARTITION BY campaign_id, date
    ORDER BY timestamp DESC, campaign_name DESC, campaign_type DESC, advertiser DESC) = 1),
rs AS (
  SELECT * FROM rd
  QUALIFY lag(concat_ws('|', campaign_name, campaign_type, advertiser)) OVER (PARTITION BY campaign_id ORDER BY date)
    IS DISTINCT FROM concat_ws('|', campaign_name, campaign_type, advertiser)),
rv AS (
  SELECT {_CAMPAIGN}, date AS valid_from,
         CAST(lead(date) OVER (PARTITION BY campaign_id ORDER BY date) AS DATE) AS valid_to,
         CAST(row_number() OVER (ORDER BY substr(md5(concat_ws('|', campaign_id, CAST(date AS VARCHAR))), 1, 3), campaign_id, date) - 1
           AS BIGINT) AS campaign_key
  FROM rs)"""

GROWN = f"""
r1 AS (SELECT DISTINCT {_CAMPAIGN} FROM re WHERE date < DATE '1995-07-01'),
r2 AS (SELECT DISTINCT {_CAMPAIGN} FROM re EXCEPT SELECT * FROM r1),
rg AS (
  SELECT {_CAMPAIGN}, CAST(row_number() OVER (ORDER BY {_CAMPAIGN_KEY}) - 1 AS BIGINT) AS campaign_key FROM r1
  UNION ALL
  SELECT {_CAMPAIGN}, CAST(row_number() OVER (ORDER BY {_CAMPAIGN_KEY}) - 1 + (SELECT count(*) FROM r1) AS BIGINT) FROM r2)"""

_RAW = (
    "event_id, timestamp, campaign_id, campaign_name, campaign_type, advertiser, platform, channel, "
    "CAST(date AS VARCHAR) AS date, impressions, clicks, conversions, spend_usd, revenue_usd"
)

FLAWED = f"""
wire AS (SELECT {_RAW} FROM ev),
flawed AS (
  SELECT * REPLACE (
    CASE WHEN conversions % 13 = 6 THEN NULL ELSE campaign_id END AS campaign_id,
    CASE WHEN clicks % 10 = 9 THEN 'other' ELSE campaign_type END AS campaign_type,
    CASE WHEN impressions % 11 = 5 THEN 'bad' ELSE date END AS date,
    CASE WHEN clicks % 7 = 3 THEN -1 - spend_usd ELSE spend_usd END AS spend_usd)
  FROM wire)"""


def _with(*parts):
    return lambda select: "WITH " + ",".join(parts) + "\n" + select


_ev = _with(EVENTS)
_m = _with(EVENTS, METRICS)
_s = _with(EVENTS, METRICS, SILVER)
_daily = _with(EVENTS, METRICS, DAILY)
_weekly = _with(EVENTS, METRICS, WEEKLY)
_dims = _with(EVENTS, DIMS)
_fact = _with(EVENTS, METRICS, SILVER, DIMS, FACT)
_flawed = _with(EVENTS, FLAWED)
_versions = _with(EVENTS, METRICS, SILVER, DIMS, RENAMED, VERSIONS)


def _kpis(select, source, group):
    def ratio(num, den):
        return f"COALESCE({num} / NULLIF({den}, 0), 0.0::DOUBLE)"

    i, c, v = (f"SUM({x})" for x in ("impressions", "clicks", "conversions"))
    spend, revenue = money("spend_usd"), money("revenue_usd")
    return f"""SELECT {select} CAST({i} AS BIGINT) AS total_impressions,
      CAST({c} AS BIGINT) AS total_clicks, CAST({v} AS BIGINT) AS total_conversions,
      {spend} AS total_spend, {revenue} AS total_revenue,
      {ratio(c, i)} AS ctr, {ratio(spend, c)} AS cpc, {ratio(v, c)} AS conversion_rate,
      {ratio(revenue, spend)} AS roas, {ratio(spend, v)} AS cost_per_conversion,
      {ratio(revenue, c)} AS revenue_per_click
      FROM {source} {group}"""


def _mom(by):
    """The measure in every cell of groups x months of the calendar, where it or its month has a value."""
    keys, groups = (f"{by}, ", f"(SELECT DISTINCT {by} FROM ev)") if by else ("", "(SELECT 1)")
    same = f"AND p.{by} = g.{by}" if by else ""
    own = f"AND c.{by} = g.{by}" if by else ""
    return _ev(f"""
      , monthly AS (
        SELECT {keys} CAST(date_trunc('month', date) AS DATE) AS month, {money('spend_usd')} AS total_spend
        FROM ev GROUP BY ALL),
      grid AS (SELECT * FROM {groups}, (SELECT DISTINCT month FROM monthly))
      SELECT {f'g.{by},' if by else ''} g.month, c.total_spend, p.total_spend AS previous_spend,
             (COALESCE(c.total_spend, 0) - p.total_spend) / NULLIF(p.total_spend, 0) AS spend_mom
      FROM grid g LEFT JOIN monthly c ON c.month = g.month {own}
        LEFT JOIN monthly p ON p.month = CAST(g.month - INTERVAL 1 MONTH AS DATE) {same}
      WHERE c.month IS NOT NULL OR p.month IS NOT NULL""")


def _seven_days(by):
    """The measure in every cell of groups x days of the calendar that has data in its seven days."""
    keys, groups = (f"{by}, ", f"(SELECT DISTINCT {by} FROM d)") if by else ("", "(SELECT 1)")
    same = f"AND x.{by} = g.{by}" if by else ""
    own = f"AND o.{by} = g.{by}" if by else ""
    return _ev(f"""
      , e AS (SELECT *, channel AS channel_name, date AS full_date FROM ev),
      d AS (SELECT {keys} full_date, CAST(SUM(impressions) AS BIGINT) AS total_impressions
            FROM e GROUP BY ALL),
      grid AS (SELECT * FROM {groups}, (SELECT DISTINCT full_date FROM d)),
      w AS (SELECT {f'g.{by},' if by else ''} g.full_date, SUM(x.total_impressions) / COUNT(*) AS impressions_7d_avg
            FROM grid g JOIN d x ON x.full_date BETWEEN g.full_date - INTERVAL 6 DAYS AND g.full_date {same} GROUP BY ALL)
      SELECT g.*, o.total_impressions FROM w g LEFT JOIN d o ON o.full_date = g.full_date {own}""")


_NEGATIVE = " OR ".join(
    f"{x} < 0" for x in ("impressions", "clicks", "conversions", "spend_usd", "revenue_usd")
)
_ROAS = f"{money('total_revenue')} / greatest({money('total_spend')}, 1e-9)"
_TIER = "CASE WHEN roas >= 2 THEN 'good' WHEN roas >= 1.5 THEN 'fair' ELSE 'poor' END"
_ROLLING = "rolling_7d_impressions, rolling_7d_clicks, rolling_7d_spend"


def _band(value, low, high):
    cases = " ".join(
        f"WHEN '{channel}' THEN {value} BETWEEN {lo} AND {hi}" for channel, lo, hi in zip(_BANDS, low, high)
    )
    return f"COUNT(*) FILTER (WHERE CASE channel {cases} END) / COUNT(*)"


_BANDS = ["Google Search", "Google Display", "Meta Feed", "Meta Stories"]

_REPORT = _ev(f"""
  SELECT campaign_name, channel AS channel_name, CAST(SUM(impressions) AS BIGINT) AS impressions,
         {rounded('100.0::DOUBLE * SUM(clicks) / NULLIF(SUM(impressions), 0)', 2)} AS ctr_pct,
         {rounded(f"{money('revenue_usd')} / NULLIF({money('spend_usd')}, 0)", 2)} AS roas,
         {money('spend_usd')} AS total_spend
  FROM ev GROUP BY campaign_name, channel ORDER BY total_spend DESC""")

ORACLES = {
    "ctr_cpc_roas_cvr": _m("SELECT event_id, ctr, cpc, roas, conversion_rate FROM m"),
    "safe_ratios": _ev(f"""
      SELECT event_id, revenue_usd / greatest(spend_usd, 1e-9) AS floor_roas,
             spend_usd / NULLIF(clicks, 0) AS null_cpc,
             {rounded('100.0::DOUBLE * clicks / NULLIF(impressions, 0)', 2)} AS ctr_pct FROM ev"""),
    "channel_type": _ev("""
      SELECT event_id, CASE WHEN channel LIKE '%Search%' THEN 'search'
        WHEN channel LIKE '%Display%' THEN 'display' WHEN channel LIKE '%Feed%' THEN 'social_feed'
        ELSE 'social_story' END AS channel_type FROM ev"""),
    "channel_type_lookup": _dims("""
      SELECT event_id, channel_name, channel_type FROM ev JOIN dch ON ev.channel = dch.channel_name"""),
    "calendar_attributes": _dims("""
      SELECT event_id, date, dda.* EXCLUDE (full_date), strftime(date, '%Y-%m') AS month_label,
             CAST(date - DATE '1970-01-01' AS INT) AS day_ordinal
      FROM ev JOIN dda ON date = full_date"""),
    "rolling_7d": _s(f"SELECT event_id, {_ROLLING} FROM s"),
    "rolling_7d_daily_grain": _s(f"SELECT DISTINCT campaign_id, date, {_ROLLING} FROM s"),
    "running_spend": _s("SELECT event_id, running_total_spend FROM s"),
    "roas_rank": _s("SELECT event_id, roas_rank_in_channel FROM s"),
    "roas_rank_by_values": _s("SELECT event_id, roas_rank_in_channel FROM s"),
    "roas_rank_iso_year": _m("""
      SELECT event_id, CAST(RANK() OVER (PARTITION BY channel, isoyear(date), week(date)
        ORDER BY roas DESC) AS BIGINT) AS roas_rank_in_channel FROM m"""),
    "silver": _s("SELECT * FROM s"),
    "silver_in_ranges": _s("SELECT * FROM s"),
    "dim_campaign": _dims("SELECT * FROM dca"),
    "dim_channel": _dims("SELECT * FROM dch"),
    "dim_date": _dims("SELECT * FROM dda"),
    "fact": _fact("SELECT * FROM fact"),
    "dim_campaign_versions": _versions("SELECT * FROM rv"),
    "fact_as_of": _versions("""
      SELECT event_id, campaign_id, rv.campaign_name, rv.campaign_type, rv.advertiser, valid_from, campaign_key,
             CAST(strftime(re.date, '%Y%m%d') AS INT) AS date_key, channel_key, spend_usd
      FROM re JOIN rv USING (campaign_id) JOIN dch ON re.channel = dch.channel_name
      WHERE re.date >= valid_from AND (valid_to IS NULL OR re.date < valid_to)"""),
    "dim_campaign_grown": _with(EVENTS, METRICS, SILVER, RENAMED, GROWN)("SELECT * FROM rg"),
    "month_of_advertiser": _ev(_kpis(
        "campaign_id, channel AS channel_name,", "ev",
        "WHERE year(date) = 1995 AND month(date) = 3 AND advertiser = 'Advertiser 1' GROUP BY campaign_id, channel",
    )),
    "star_report": _fact("""
      SELECT 'fact rows' AS check, COUNT(*) AS n FROM fact
      UNION ALL SELECT 'facts without campaign', COUNT(*) FROM fact ANTI JOIN dca USING (campaign_key)
      UNION ALL SELECT 'facts without channel', COUNT(*) FROM fact ANTI JOIN dch USING (channel_key)
      UNION ALL SELECT 'facts without date', COUNT(*) FROM fact ANTI JOIN dda USING (date_key)
      UNION ALL SELECT 'repeated campaign_id', COUNT(*) FROM
        (SELECT campaign_id FROM dca GROUP BY 1 HAVING COUNT(*) > 1)
      UNION ALL SELECT 'repeated channel_name', COUNT(*) FROM
        (SELECT channel_name FROM dch GROUP BY 1 HAVING COUNT(*) > 1)
      UNION ALL SELECT 'repeated full_date', COUNT(*) FROM
        (SELECT full_date FROM dda GROUP BY 1 HAVING COUNT(*) > 1)"""),
    "campaign_channel_report": _REPORT,
    "campaign_daily_summary": _daily("SELECT * FROM daily ORDER BY campaign_id, date"),
    "channel_weekly_summary": _weekly("SELECT * FROM weekly ORDER BY year, week, channel"),
    "channel_weekly_iso_year": _with(EVENTS, METRICS, weekly("isoyear(date)"))("SELECT * FROM weekly"),
    "kpi_totals": _ev(f"""
      SELECT CAST(SUM(impressions) AS BIGINT) AS total_impressions,
             CAST(SUM(clicks) AS BIGINT) AS total_clicks,
             {money('spend_usd')} AS total_spend, {money('revenue_usd')} AS total_revenue,
             {money('revenue_usd')} / NULLIF({money('spend_usd')}, 0) AS overall_roas,
             SUM(clicks) / NULLIF(SUM(impressions), 0) * 100 AS overall_ctr_pct FROM ev"""),
    "roas_by_campaign": _daily(f"""
      SELECT *, {_TIER} AS tier FROM (
        SELECT campaign_id, MIN(campaign_name) AS campaign_name, {_ROAS} AS roas
        FROM daily GROUP BY campaign_id) ORDER BY roas"""),
    "roas_by_campaign_name": _daily(f"""
      SELECT *, {_TIER} AS tier FROM (
        SELECT campaign_name, {_ROAS} AS roas FROM daily GROUP BY campaign_name) ORDER BY roas"""),
    "monthly_roas": _daily(f"""
      SELECT campaign_id, CAST(date_trunc('month', date) AS DATE) AS month, {_ROAS} AS roas,
             MIN(campaign_name) AS campaign_name, strftime(MIN(date), '%Y-%m') AS month_label
      FROM daily GROUP BY campaign_id, CAST(date_trunc('month', date) AS DATE)"""),
    "months": _ev("SELECT DISTINCT strftime(date, '%Y-%m') AS month_label FROM ev"),
    "funnel": _ev("""
      , t AS (SELECT CAST(SUM(impressions) AS BIGINT) AS i, CAST(SUM(clicks) AS BIGINT) AS c,
                     CAST(SUM(conversions) AS BIGINT) AS v FROM ev)
      SELECT 1 AS step, 'Impressions' AS stage, i AS value, CAST(NULL AS DOUBLE) AS step_rate FROM t
      UNION ALL SELECT 2, 'Clicks', c, c / NULLIF(i, 0) FROM t
      UNION ALL SELECT 3, 'Conversions', v, v / NULLIF(c, 0) FROM t"""),
    "daily_spend": _ev(f"""
      SELECT campaign_id, date, {money('spend_usd')} AS total_spend FROM ev GROUP BY ALL"""),
    "rolling_7row_spend": _ev(f"""
      , d AS (SELECT campaign_id, date, {money('spend_usd')} AS total_spend FROM ev GROUP BY ALL)
      SELECT *, CASE WHEN COUNT(total_spend) OVER w = 7
                     THEN {money('total_spend', 'OVER w')} / 7 END AS rolling_7row_spend
      FROM d WINDOW w AS (PARTITION BY campaign_id ORDER BY date ROWS 6 PRECEDING)"""),
    "channel_efficiency": _weekly(f"""
      , c AS (SELECT channel, {mean('avg_ctr')} AS avg_ctr, {money('total_spend')} AS total_spend,
                     CAST(SUM(total_clicks) AS BIGINT) AS total_clicks FROM weekly GROUP BY channel)
      SELECT *, total_spend / NULLIF(total_clicks, 0) AS avg_cpc,
             total_spend / NULLIF(MAX(total_spend) OVER (), 0) * 600.0::DOUBLE + 80.0::DOUBLE AS size FROM c"""),
    "platform_share": _ev(f"""
      , p AS (SELECT platform, {money('spend_usd')} AS total_spend FROM ev GROUP BY platform)
      SELECT *, total_spend / NULLIF({money('total_spend', 'OVER ()')}, 0) * 100 AS share_pct FROM p"""),
    "weekly_pivot": _ev("SELECT CAST(week(date) AS INT) AS week, " + ", ".join(
        f"CAST(COALESCE(SUM(impressions) FILTER (WHERE channel = '{c}'), 0) AS BIGINT) AS \"{c}\""
        for c in _BANDS) + " FROM ev GROUP BY 1"),
    "weekly_stacked": _ev("""
      , w AS (SELECT CAST(week(date) AS INT) AS week, channel,
                     CAST(SUM(impressions) AS BIGINT) AS impressions FROM ev GROUP BY ALL),
      t AS (SELECT *, CAST(SUM(impressions) OVER (PARTITION BY week ORDER BY channel) AS BIGINT) AS top FROM w)
      SELECT week, channel, impressions, top - impressions AS base, top FROM t"""),
    "fact_preview": _fact("SELECT event_id, date_key, spend_usd FROM fact ORDER BY event_id LIMIT 5"),
    "kpis_overall": _ev(_kpis("", "ev", "")),
    "kpis_by_channel": _ev(_kpis("channel AS channel_name,", "ev", "GROUP BY channel")),
    "kpis_by_month": _ev(_kpis(
        "CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,", "ev",
        "GROUP BY year(date), month(date)")),
    "kpis_all_contexts": _ev(_kpis(
        """campaign_id, channel_name, month,
        CAST(4 * GROUPING(campaign_id) + 2 * GROUPING(channel_name) + GROUPING(month) AS INT) AS context,""",
        "(SELECT *, channel AS channel_name, strftime(date, '%Y-%m') AS month FROM ev)",
        "GROUP BY CUBE (campaign_id, channel_name, month)")),
    "kpi_spend_mom": _mom(""),
    "kpi_spend_mom_by_campaign": _mom("campaign_id"),
    "kpi_impressions_7d": _seven_days(""),
    "kpi_impressions_7d_by_channel": _seven_days("channel_name"),
    "valid_events": _flawed(f"""
      SELECT * FROM flawed WHERE campaign_id IS NOT NULL AND NOT ({_NEGATIVE})
        AND TRY_CAST(date AS DATE) IS NOT NULL"""),
    "quarantine": _flawed("""
      SELECT * FROM (SELECT event_id, concat_ws('; ',
        CASE WHEN campaign_id IS NULL THEN 'campaign_id is missing' END,
        CASE WHEN spend_usd < 0 THEN 'spend_usd is negative' END,
        CASE WHEN TRY_CAST(date AS DATE) IS NULL THEN 'date is unreadable' END,
        CASE WHEN campaign_type = 'other' THEN 'campaign_type is unknown' END) AS reasons
      FROM flawed) WHERE reasons <> ''"""),
    "benchmark_bands": _m(f"""
      SELECT channel, COUNT(*) AS row_count,
        {_band('ctr', (0.02, 0.001, 0.009, 0.005), (0.05, 0.005, 0.015, 0.01))} AS ctr_in_band,
        {_band('cpc', (1.0, 0.5, 0.5, 0.3), (4.0, 2.0, 1.5, 1.0))} AS cpc_in_band,
        {_band('conversion_rate', (0.02, 0.005, 0.01, 0.008), (0.08, 0.02, 0.04, 0.03))} AS cvr_in_band,
        {_band('roas', (2.0, 1.0, 1.5, 1.2), (5.0, 3.0, 4.0, 3.5))} AS roas_in_band
      FROM m GROUP BY channel"""),
    "kafka_messages": _ev(f"""
      SELECT campaign_id || '#' || CAST(date AS VARCHAR) AS key, {_RAW} FROM ev"""),
    "kafka_roundtrip": _ev(f"SELECT {_RAW} FROM ev"),
    "json_roundtrip": _ev(f"SELECT {_RAW} FROM ev"),
    "csv_roundtrip": _daily("SELECT * FROM daily"),
    "table_roundtrip": _s("SELECT * FROM s"),
    "partitioned_silver": _s("SELECT * FROM s"),
    "partitioned_fact": _fact("SELECT * FROM fact"),
    "sql_path_table": _REPORT,
    "registered_table": _ev("""
      SELECT platform, channel, COUNT(*) AS row_count, CAST(SUM(impressions) AS BIGINT) AS impressions
      FROM ev GROUP BY platform, channel"""),
    "clustered_rewrite": _fact("SELECT * FROM fact"),
    "stream_silver": _m("SELECT * EXCLUDE (conversion_rate) FROM m"),
    "stream_bronze_then_silver": _s("SELECT * FROM s"),
    "bronze_batch_and_stream": _ev(f"SELECT {_RAW} FROM ev"),
    "bronze_replayed": _ev(f"SELECT {_RAW} FROM ev"),
    "silver_updated": _s("SELECT * FROM s"),
    "repeated_events": _ev("""
      SELECT event_id, CAST(CASE WHEN clicks % 15 = 1 THEN 2 ELSE 1 END AS BIGINT) AS copies, 'event_id is repeated' AS reasons
      FROM ev WHERE clicks % 5 = 1"""),
    "unique_events": _ev("""
      SELECT * REPLACE (CASE WHEN clicks % 15 = 1 AND timestamp > '2001-01-01T00:00:00Z' THEN '2001-01-01T00:00:00Z' ELSE timestamp END AS timestamp)
      FROM ev"""),
}
