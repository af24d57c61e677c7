"""The same results in SQL, written independently of the operators."""

from __future__ import annotations

from gridtide.schemas import CITIES, ENERGY_SERIES, FUELS, MEASURES, NEIGHBOURS, sanitize
from gridtide.workloads.feeds import BANDS, CARBON_MIN, FUEL_WIDTH, PLACES

SQL: dict[str, str] = {}

BATCH = 12 * 3600
WEATHER_SERIES = [f"{m}_{sanitize(c)}" for c in CITIES for m in MEASURES]
SERIES = list(ENERGY_SERIES) + WEATHER_SERIES
SPLIT_NAMES = ENERGY_SERIES[1:]


def _band(low, high) -> str:
    parts = [f"value >= {low}"] * (low is not None) + [f"value < {high}"] * (high is not None)
    return " AND ".join(parts)


def _hourly() -> str:
    cols = []
    for i, f in enumerate(FUELS):
        cols.append(f"nullif(count(*) FILTER (k // {FUEL_WIDTH} = {i}), 0) AS consumption_{f}")
        cols.append(f"(sum(k) FILTER (k // {FUEL_WIDTH} = {i}))::BIGINT AS production_{f}")
    for nb, b in zip(NEIGHBOURS, BANDS):
        cols.append(f"nullif(count(*) FILTER ({_band(*b)}), 0) AS import_{nb}")
        cols.append(f"(sum(k) FILTER ({_band(*b)}))::BIGINT AS export_{nb}")
    return f"""
      ev AS (SELECT event_type AS zone, date_trunc('hour', ts) AS h, value, round(value * 100)::BIGINT AS c,
                    json_extract(props, '$.k')::BIGINT AS k FROM events),
      agg AS (SELECT zone, h, count(*) AS n, sum(k)::BIGINT AS sk, max(k) AS mx, min(k) AS mn, sum(c)::BIGINT AS cents,
                     count(*) FILTER (value < 20) AS lo, count(*) FILTER (value >= 20) AS hi, {', '.join(cols)}
              FROM ev GROUP BY zone, h),
      hourly AS (SELECT *, TIMESTAMP '1970-01-01' + to_seconds((ceil(epoch(h) / {BATCH}) * {BATCH})::BIGINT) AS v1
                 FROM agg)"""


def _delivered(lags: str) -> str:
    return f"(SELECT *, v1 + to_hours(12 * lag) AS v FROM hourly CROSS JOIN (SELECT unnest({lags}) AS lag))"


def _power_columns(total: str) -> str:
    special = {
        "consumption_total": total, "production_total": "sk", "import_total": "hi", "export_total": "lo",
    }
    return ", ".join(f"{special[c]} AS {c}" if c in special else c for c in SPLIT_NAMES)


_PLACE = "CASE zone " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PLACES.items()) + " END"
_ENERGY = f"""
      energy AS (SELECT zone, h AS datetime, v1 + INTERVAL 12 HOUR AS vintage,
                        v1 + INTERVAL 12 HOUR + INTERVAL 10 MINUTE AS ingested_at,
                        v1 + INTERVAL 12 HOUR + INTERVAL 11 MINUTE AS ingested_at_carbon,
                        false AS "isEstimated_power", false AS "isEstimated_carbon", {_power_columns('n')},
                        cents // n AS carbon_intensity
                 FROM hourly WHERE sk >= {CARBON_MIN})"""
_WEATHER = f"""
      weather AS (SELECT {_PLACE} AS name, 37.5::DOUBLE AS latitude, 23.75::DOUBLE AS longitude, h AS datetime,
                         (cents // n + lag) / 100.0::DOUBLE AS temp, n::DOUBLE AS humidity,
                         CASE WHEN n > 1 THEN mx END::DOUBLE AS precip, mn::DOUBLE AS windspeed,
                         (sk % 360)::DOUBLE AS winddir, lo::DOUBLE AS cloudcover, cents / 100.0::DOUBLE AS solarenergy,
                         'S1,' || zone AS stations, v + INTERVAL 10 MINUTE AS ingested_at, v AS vintage
                  FROM {_delivered('[-2, -1, 0, 1]')})"""
_WEATHER_OUT = (
    "name, latitude, longitude, datetime, temp, humidity, precip, windspeed, winddir, cloudcover, solarenergy, "
    "stations, ingested_at"
)
_WIDE = "wide AS (SELECT vintage, datetime, " + ", ".join(
    f"max({m}) FILTER (name = '{c}') AS {m}_{sanitize(c)}" for c in CITIES for m in MEASURES
) + " FROM weather GROUP BY vintage, datetime)"
_CALENDAR = (
    "hour({0})::INT AS hour_of_day, (dayofweek({0}) + 1)::INT AS day_of_week, month({0})::INT AS month, "
    "dayofyear({0})::INT AS day_of_year, weekofyear({0})::INT AS week_of_year"
)


def _feature_columns(partition: str) -> str:
    cols = []
    for s in SERIES:
        cols.append(f"coalesce({s}, 0) AS lag_{s}_0h")
        cols.append(f"coalesce(lag({s}, 1) OVER w, 0) AS lag_{s}_1h")
        cols.append(
            f"coalesce(round(avg({s}) OVER (PARTITION BY {partition} ORDER BY datetime "
            f"ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6), 0) AS rolling_avg_{s}_24h"
        )
    return ", ".join(cols)


def _historic(partition: str = "zone") -> str:
    filled = ", ".join(f"coalesce({s}, 0) AS {s}" for s in [*SPLIT_NAMES, "carbon_intensity", *WEATHER_SERIES])
    return f"""
      joined AS (SELECT e.*, {', '.join('p.' + s for s in WEATHER_SERIES)}
                 FROM energy e JOIN wide p ON e.vintage = p.vintage AND e.datetime = p.datetime
                 WHERE e.datetime <= e.vintage),
      historic AS (SELECT zone, datetime, vintage AS ingested_hour_utc, ingested_at_carbon, "isEstimated_power",
                          "isEstimated_carbon", {filled}, {_CALENDAR.format('datetime')}, {_feature_columns(partition)}
                   FROM joined WINDOW w AS (PARTITION BY {partition} ORDER BY datetime))"""


_FORECASTS = f"""
      forecasts AS (SELECT vintage AS ingested_hour_utc, datetime, {', '.join(WEATHER_SERIES)},
                           floor((epoch(datetime) - epoch(vintage)) / 3600)::BIGINT AS forecast_offset_h
                    FROM wide WHERE datetime > vintage AND vintage IN (SELECT vintage FROM energy))"""
_SNAPSHOT = ", ".join(f"s.{p}" for s in SERIES for p in (f"lag_{s}_0h", f"lag_{s}_1h", f"rolling_avg_{s}_24h"))
_COMPLETE = " AND ".join(f"{s} IS NOT NULL" for s in WEATHER_SERIES)
_AHEAD = f"""
      ahead AS (SELECT * FROM forecasts WHERE forecast_offset_h > 0 AND forecast_offset_h <= 24 AND {_COMPLETE})"""
_F_COLS = ", ".join(f"f.{s}" for s in WEATHER_SERIES)


def _base(*parts: str) -> str:
    return "WITH " + ",".join([_hourly(), *parts])


def _training(hours: str) -> str:
    return f"""
      pairs AS (SELECT s.zone, f.ingested_hour_utc, f.datetime, {_F_COLS}, f.forecast_offset_h,
                       {_CALENDAR.format('f.datetime')}, {_SNAPSHOT}, t.carbon_intensity AS target_val,
                       count(*) OVER (PARTITION BY s.zone, f.ingested_hour_utc) AS n_ahead,
                       count(t.zone) OVER (PARTITION BY s.zone, f.ingested_hour_utc) AS n_found
                FROM historic s JOIN ahead f ON f.ingested_hour_utc = s.datetime
                LEFT JOIN historic t ON t.zone = s.zone AND t.datetime = f.datetime
                WHERE s.datetime IN ({hours}))"""


_ALL_HOURS = "SELECT ingested_hour_utc FROM historic"
_CHAIN = (_ENERGY, _WEATHER, _WIDE)

# --- payloads --------------------------------------------------------------------------
SQL["json_flatten"] = """
    SELECT event_id, json_extract(props, '$.k')::BIGINT AS prop_k, json_extract(props, '$.absent')::BIGINT AS prop_absent
    FROM events"""
SQL["power_revisions"] = f"""{_base()}
    SELECT v + INTERVAL 10 MINUTE AS ingested_at, zone, h AS datetime, lag = 0 AS "isEstimated",
           {_power_columns('n + (lag = 0)::INT')}
    FROM {_delivered('[0, 1]')}"""
SQL["carbon_revisions"] = f"""{_base()}
    SELECT v + INTERVAL 11 MINUTE AS ingested_at, zone, h AS datetime, lag = 0 AS "isEstimated",
           cents // n AS carbon_intensity
    FROM {_delivered('[0, 1]')} WHERE sk >= {CARBON_MIN}"""
SQL["csv_flatten"] = f"{_base(_WEATHER)} SELECT {_WEATHER_OUT} FROM weather"

# --- landed files and tables --------------------------------------------------------------
SQL["land_json_files"] = SQL["power_revisions"]
SQL["land_csv_files"] = SQL["csv_flatten"]
SQL["ingest_twice"] = SQL["power_revisions"]
SQL["ingest_streamed"] = SQL["power_revisions"]
SQL["table_append"] = SQL["power_revisions"]
SQL["table_upsert"] = f"""{_base(_ENERGY)}
    SELECT * EXCLUDE (vintage, again)
           REPLACE (CASE WHEN again THEN ingested_at ELSE ingested_at - INTERVAL 12 HOUR END AS ingested_at,
                    CASE WHEN again THEN ingested_at_carbon ELSE ingested_at_carbon - INTERVAL 12 HOUR END AS ingested_at_carbon,
                    NOT again AS "isEstimated_power", NOT again AS "isEstimated_carbon",
                    consumption_total + (NOT again)::INT AS consumption_total)
    FROM (SELECT *, zone IN ('click', 'view') AS again FROM energy)"""
SQL["table_insert_new"] = SQL["csv_flatten"]

# --- clean tables ------------------------------------------------------------------------
SQL["silver_energy"] = f"{_base(_ENERGY)} SELECT * EXCLUDE (vintage) FROM energy"
SQL["silver_after_a_pause"] = SQL["silver_energy"]
# Both feeds of the streamed files are stamped ten minutes past.
SQL["energy_streamed"] = f"""{_base(_ENERGY)}
    SELECT * EXCLUDE (vintage) REPLACE (ingested_at_carbon - INTERVAL 1 MINUTE AS ingested_at_carbon) FROM energy"""
SQL["silver_weather_latest"] = f"""{_base(_WEATHER)}
    SELECT {_WEATHER_OUT} FROM weather
    QUALIFY row_number() OVER (PARTITION BY name, datetime ORDER BY ingested_at DESC) = 1"""
SQL["dedup_latest"] = """
    SELECT *, date_trunc('hour', ts) AS hour FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1"""
SQL["join_feeds"] = """
    WITH latest AS (
      SELECT user_id, date_trunc('hour', ts) AS hour, event_type, event_id, value FROM events
      QUALIFY row_number() OVER (PARTITION BY event_type, user_id, date_trunc('hour', ts)
                                 ORDER BY ts DESC, event_id DESC) = 1)
    SELECT c.user_id, c.hour, c.event_id AS click_id, c.value AS click_value, v.event_id AS view_id, v.value AS view_value
    FROM latest c JOIN latest v ON c.user_id = v.user_id AND c.hour = v.hour
    WHERE c.event_type = 'click' AND v.event_type = 'view'"""

# --- merges ------------------------------------------------------------------------------
SQL["upsert_orders"] = """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice
    FROM orders"""
SQL["insert_only_orders"] = """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
    FROM orders"""

# --- ranges ------------------------------------------------------------------------------
SQL["lookback_events"] = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 48 HOUR"
SQL["lookback_now"] = """
    SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR GROUP BY 1"""
SQL["anchored_lookback"] = """
    SELECT * FROM events WHERE ts >= (SELECT max(date_trunc('hour', ts)) FROM events) - INTERVAL 36 HOUR"""
SQL["observed_forecast_split"] = f"""{_base(_WEATHER)}
    SELECT vintage, CASE WHEN datetime <= vintage THEN 'observed' ELSE 'forecast' END AS part,
           count(*) AS n, max(datetime) AS last
    FROM weather GROUP BY ALL"""
SQL["forecast_offset_horizon"] = f"""{_base(_WEATHER)},
    o AS (SELECT name, datetime, ingested_at,
                 floor((epoch(datetime) - epoch(ingested_at)) / 3600)::BIGINT AS forecast_offset_h FROM weather)
    SELECT * FROM o WHERE forecast_offset_h > 0 AND forecast_offset_h <= 18"""

# --- time --------------------------------------------------------------------------------
SQL["parse_utc_text"] = """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) END AS parsed FROM events"""
# Summer time ran to the last Sunday of September in 1995, of October from 1996 on.
SQL["local_to_utc"] = """
    WITH l AS (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS t FROM orders),
    d AS (SELECT o_orderkey, t, last_day(make_date(year(t), 3, 1)) AS m,
                 last_day(make_date(year(t), CASE WHEN year(t) = 1995 THEN 9 ELSE 10 END, 1)) AS o FROM l)
    SELECT o_orderkey, t - CASE WHEN t >= (m - dayofweek(m)::INT)::TIMESTAMP + INTERVAL 4 HOUR
                                 AND t < (o - dayofweek(o)::INT)::TIMESTAMP + INTERVAL 4 HOUR
                                THEN INTERVAL 3 HOUR ELSE INTERVAL 2 HOUR END AS utc
    FROM d"""
SQL["round_hour"] = """
    SELECT event_id,
           TIMESTAMP '1970-01-01' + to_hours(floor((floor(epoch(ts)) + 1800) / 3600)::BIGINT) AS nearest,
           date_trunc('hour', ts) AS truncated
    FROM events"""
SQL["calendar"] = f"SELECT o_orderkey, o_orderdate, {_CALENDAR.format('o_orderdate')} FROM orders"
SQL["distinct_hours"] = """
    SELECT DISTINCT TIMESTAMP '1970-01-01' + to_hours(floor((floor(epoch(ts)) + 1800) / 3600)::BIGINT) AS ingested_hour_utc
    FROM events"""

# --- columns and missing values ---------------------------------------------------------------
SQL["numeric_features"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem"
SQL["null_fill"] = """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END AS urgent_price,
           CASE WHEN o_orderpriority = '1-URGENT' THEN true END AS is_urgent
    FROM orders"""
SQL["null_drop"] = """
    SELECT o_orderkey, o_custkey, o_totalprice AS urgent_price, true AS is_urgent
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 7 <> 0"""

# --- pivot, windows, set operations -------------------------------------------------------------
SQL["pivot_measures"] = """
    WITH e AS (SELECT date_trunc('hour', ts) AS hour, event_type, value, json_extract(props, '$.k')::BIGINT AS k, ts FROM events)
    SELECT hour, """ + ", ".join(
    f"arg_max({m}, ts) FILTER (event_type = '{t}') AS {m}_{t}" for t in ("click", "error", "purchase") for m in ("value", "k")
) + " FROM e GROUP BY hour"
SQL["lag_rolling"] = """
    WITH e AS (SELECT user_id, ts, event_id, value, json_extract(props, '$.k')::BIGINT AS k FROM events)
    SELECT *, """ + ", ".join(
    f"""{c} AS lag_{c}_0h, lag({c}, 1) OVER w AS lag_{c}_1h,
        round(avg({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6)
          AS rolling_avg_{c}_24h"""
    for c in ("value", "k")
) + " FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
SQL["lag_rolling_sliced"] = SQL["lag_rolling"]
SQL["lag_rolling_by_time"] = f"""{_base(_ENERGY)}
    SELECT e.zone, e.datetime, """ + ", ".join(
    f"""any_value(e.{c}) AS {c}, max(p.{c}) FILTER (p.datetime = e.datetime - INTERVAL 1 HOUR) AS lag_{c}_exact_1h,
        max(p.{c}) FILTER (p.datetime = e.datetime - INTERVAL 24 HOUR) AS lag_{c}_exact_24h,
        round(avg(p.{c}) FILTER (p.datetime > e.datetime - INTERVAL 24 HOUR), 6) AS rolling_avg_{c}_range_24h"""
    for c in ("carbon_intensity", "production_total")
) + """
    FROM energy e JOIN energy p
      ON p.zone = e.zone AND p.datetime BETWEEN e.datetime - INTERVAL 24 HOUR AND e.datetime
    GROUP BY e.zone, e.datetime"""
SQL["lag_rolling_by_time_sliced"] = SQL["lag_rolling_by_time"]
SQL["latest_snapshot"] = "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"
SQL["union_by_name"] = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders"

# --- feature tables ---------------------------------------------------------------------------------
SQL["historic_gold"] = f"{_base(*_CHAIN, _historic())} SELECT * FROM historic"
SQL["historic_gold_batch"] = f"{_base(*_CHAIN, _historic('zone, vintage'))} SELECT * FROM historic"
SQL["bronze_to_gold"] = SQL["historic_gold"]
SQL["gold_incremental"] = SQL["historic_gold"]
_LATE = _WEATHER.replace("weather AS (", "given AS (", 1) + """,
      weather AS (SELECT * FROM given WHERE ingested_at::DATE <> DATE '2024-01-28')"""
SQL["gold_incremental_missing_weather"] = f"{_base(_ENERGY, _LATE, _WIDE, _historic())} SELECT * FROM historic"
SQL["forecast_gold"] = f"{_base(*_CHAIN, _FORECASTS)} SELECT * FROM forecasts"
SQL["training_rows"] = f"""{_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _training(_ALL_HOURS))}
    SELECT * EXCLUDE (n_ahead, n_found) FROM pairs WHERE n_ahead = n_found"""
SQL["training_after_corrections"] = SQL["training_rows"]
_RECENT = f"""
      recent AS (SELECT ingested_hour_utc FROM historic
                 WHERE ingested_hour_utc >= (SELECT max(ingested_hour_utc) FROM historic) - INTERVAL 96 HOUR)"""
SQL["training_rows_lookback"] = f"""
    {_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _RECENT, _training('SELECT ingested_hour_utc FROM recent'))}
    SELECT zone, ingested_hour_utc, datetime, target_val FROM pairs WHERE n_ahead = n_found"""
SQL["chrono_split"] = """
    WITH e AS (SELECT date_trunc('hour', ts) AS hour FROM events),
    s AS (SELECT quantile_disc(hour, 0.8) AS cut FROM e)
    SELECT hour <= cut AS is_train, count(*) AS n, min(hour) AS first, max(hour) AS last FROM e, s GROUP BY 1"""

# --- models ----------------------------------------------------------------------------------------
_BACKTEST = f"""
      back AS (SELECT * FROM historic
               WHERE datetime <= (SELECT max(datetime) FROM historic WHERE datetime IN ({_ALL_HOURS})))"""
SQL["scoring_rows"] = f"""{_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _BACKTEST)}
    SELECT s.zone, f.ingested_hour_utc, f.datetime, {_F_COLS}, f.forecast_offset_h, {_CALENDAR.format('f.datetime')},
           {_SNAPSHOT}
    FROM back s JOIN ahead f ON f.ingested_hour_utc = s.datetime
    WHERE s.datetime = (SELECT max(datetime) FROM back)"""
SQL["scoring_rows_per_group"] = f"""{_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _BACKTEST)},
    newest AS (SELECT zone, max(datetime) AS datetime FROM back GROUP BY zone)
    SELECT s.zone, f.ingested_hour_utc, f.datetime, f.forecast_offset_h, s.lag_carbon_intensity_0h
    FROM back s JOIN newest n ON n.zone = s.zone AND n.datetime = s.datetime
    JOIN ahead f ON f.ingested_hour_utc = s.datetime"""
_NAIVE = f"""{_base(_ENERGY)},
    m AS (SELECT a.zone, a.datetime, a.carbon_intensity::DOUBLE AS y, p.carbon_intensity::DOUBLE AS p,
                 p.carbon_intensity::DOUBLE - a.carbon_intensity AS e
          FROM energy a JOIN energy p ON p.zone = a.zone AND p.datetime + INTERVAL 1 HOUR = a.datetime)"""
SQL["evaluate_rmse_r2"] = f"""{_NAIVE}
    SELECT zone, count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse,
           round(1 - sum(e * e) / (sum(y * y) - count(*) * avg(y) * avg(y)), 6) AS r2
    FROM m GROUP BY zone"""


def _monitor(hours: int, keys: str) -> str:
    return f"""{_base(_ENERGY)},
    m AS (SELECT a.datetime, a.carbon_intensity::DOUBLE AS y, p.carbon_intensity::DOUBLE - a.carbon_intensity AS e,
                 p.ahead AS forecast_offset_h
          FROM energy a JOIN (SELECT *, unnest(range(1, {hours + 1})) AS ahead FROM energy) p
          ON p.zone = a.zone AND p.datetime + to_hours(p.ahead) = a.datetime),
    d AS (SELECT 'naive' AS model_version, datetime::DATE AS day, {keys} count(*) AS n, sqrt(avg(e * e)) AS rmse,
                 avg(abs(e)) AS mae, avg(e) AS bias FROM m GROUP BY ALL),
    t AS (SELECT *, avg(rmse) OVER (PARTITION BY {keys} 1 ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                    AS rmse_trailing FROM d)
    SELECT * REPLACE (round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(bias, 6) AS bias,
                      round(rmse_trailing, 6) AS rmse_trailing),
           coalesce(rmse > rmse_trailing * 1.2, false) AS drift
    FROM t"""


SQL["monitor_rmse"] = _monitor(1, "")
SQL["monitor_by_offset"] = _monitor(24, "forecast_offset_h,")
SQL["monitor_incremental"] = SQL["monitor_by_offset"]
# The recursion itself, day by day.
SQL["monitor_alarms"] = f"""{_base(_ENERGY).replace("WITH", "WITH RECURSIVE", 1)},
    d AS (SELECT p.ahead AS forecast_offset_h, a.datetime::DATE AS day, count(*) AS n,
                 sqrt(avg((p.carbon_intensity - a.carbon_intensity)::DOUBLE ** 2)) AS rmse
          FROM energy a JOIN (SELECT *, unnest(range(1, 25)) AS ahead FROM energy) p
          ON p.zone = a.zone AND p.datetime + to_hours(p.ahead) = a.datetime GROUP BY ALL),
    i AS (SELECT *, row_number() OVER (PARTITION BY forecast_offset_h ORDER BY day) AS i FROM d),
    base AS (SELECT forecast_offset_h, avg(rmse) AS mean, stddev_samp(rmse) AS dev FROM i WHERE i <= 7 GROUP BY ALL),
    z AS (SELECT i.*, CASE WHEN i > 7 AND dev > 0 THEN (rmse - mean) / dev END AS z FROM i JOIN base USING (forecast_offset_h)),
    s AS (SELECT *, 0::DOUBLE AS cusum FROM z WHERE i = 1
          UNION ALL SELECT z.*, CASE WHEN z.i <= 7 THEN 0 ELSE greatest(0, s.cusum + coalesce(z.z, 0) - 0.5) END
          FROM s JOIN z ON z.forecast_offset_h = s.forecast_offset_h AND z.i = s.i + 1)
    SELECT 'naive' AS model_version, forecast_offset_h, day, n, round(rmse, 6) AS rmse, round(z, 6) AS z,
           round(cusum, 6) AS cusum, cusum > 2.0 AS alarm
    FROM s"""
# Features: three for each series, the forecasts, the calendar and the offset.
SQL["gbt_fit_score"] = f"""
    {_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _training(_ALL_HOURS))},
    kept AS (SELECT ingested_hour_utc AS v FROM pairs WHERE n_ahead = n_found),
    cut AS (SELECT quantile_disc(v, 0.8) AS edge FROM kept)
    SELECT count(*) FILTER (v <= edge) AS n_train, count(*) FILTER (v > edge) AS n_test,
           {3 * len(SERIES) + len(WEATHER_SERIES) + 6} AS n_features, 100 AS n_trees, true AS has_rmse
    FROM kept, cut"""
SQL["gbt_best_split"] = """
    WITH e AS (SELECT hour(ts) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week, value AS y FROM events),
    s AS (SELECT 'h' AS f, hour_of_day AS edge, count(*) AS n, sum(y) AS y FROM e GROUP BY ALL
          UNION ALL SELECT 'd', day_of_week, count(*), sum(y) FROM e GROUP BY ALL),
    c AS (SELECT f, sum(n) OVER w AS n1, sum(y) OVER w AS y1, sum(n) OVER (PARTITION BY f) AS n,
                 sum(y) OVER (PARTITION BY f) AS y FROM s WINDOW w AS (PARTITION BY f ORDER BY edge)),
    best AS (SELECT * FROM c WHERE n1 < n ORDER BY y1 * y1 / n1 + (y - y1) * (y - y1) / (n - n1) DESC LIMIT 1)
    SELECT round(y1 / n1, 6) AS prediction, n1::BIGINT AS n FROM best
    UNION ALL SELECT round((y - y1) / (n - n1), 6), (n - n1)::BIGINT FROM best"""
SQL["score_latest"] = f"""{_base(*_CHAIN, _historic(), _FORECASTS, _AHEAD, _BACKTEST)}
    SELECT f.ingested_hour_utc, f.datetime, true AS prediction, TIMESTAMP '2024-01-31' AS prediction_ingested_at,
           '1' AS model_version, s.zone
    FROM back s JOIN ahead f ON f.ingested_hour_utc = s.datetime
    WHERE s.datetime = (SELECT max(datetime) FROM back)"""
SQL["model_versions"] = "SELECT 2 AS version, 2::BIGINT AS n_versions, 3 AS n_trees, count(*) AS n_same FROM events"
