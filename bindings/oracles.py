"""DuckDB SQL with the results that bindings/queries.py must give.

Written against the definitions, not against the Spark code: hours come from a
grid of 24 instead of arrays, peaks from row_number, holidays from literals.
"""

_STEPS = {
    # Sums of whole numbers per meter, day and hour, the days moved as in the binding.
    "per_hour": """
        SELECT user_id // 10 AS meter,
               CAST(ts AS DATE) + (CASE (user_id // 10) % 4 WHEN 0 THEN 70 WHEN 1 THEN 160
                                   WHEN 2 THEN 280 ELSE 340 END) AS d,
               CAST(hour(ts) AS INTEGER) AS h,
               CAST(sum(CAST(round(value) AS BIGINT)) AS DOUBLE) AS kwh
        FROM events GROUP BY ALL""",
    "meter_days": """
        SELECT DISTINCT 'client_' || (meter // 10) AS client_id, 'dev_' || meter AS ext_dev_ref, meter, d,
               (day(d) = 13 AND meter % 5 = 0) AS short,
               timezone('UTC', timezone('Europe/Vilnius', CAST(d AS TIMESTAMP))) AS utc0
        FROM per_hour""",
    "raw_hours": """
        SELECT m.client_id, m.ext_dev_ref, m.d, CAST(g.h AS INTEGER) AS idx, p.kwh,
               CAST(m.d AS TIMESTAMP) + to_hours(g.h) AS wall, m.utc0 + to_hours(g.h) AS utc,
               date_diff('minute', m.utc0, CAST(m.d AS TIMESTAMP)) AS off
        FROM meter_days m CROSS JOIN (SELECT unnest(range(24)) AS h) g
        LEFT JOIN per_hour p ON p.meter = m.meter AND p.d = m.d AND p.h = g.h
        WHERE NOT m.short""",
    "hours": """
        SELECT client_id, ext_dev_ref, 'PT1H' AS resolution, kwh AS consumption_kwh, d, idx, utc, wall, off,
               strftime(wall, '%Y-%m-%dT%H:%M:%S') || printf('+%02d:%02d', off // 60, off % 60) AS timestamp_local,
               strftime(utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp_utc,
               CAST(utc AS DATE) AS date_local, CAST(hour(utc) AS INTEGER) AS hour
        FROM raw_hours""",
    "lookback": """
        SELECT *, lag(consumption_kwh, 1) OVER w AS lag_1h, lag(consumption_kwh, 24) OVER w AS lag_24h,
               round(avg(consumption_kwh) OVER f, 6) AS rolling_mean_24h,
               round(coalesce(stddev_samp(consumption_kwh) OVER f, 0), 6) AS rolling_std_24h
        FROM hours
        WINDOW w AS (PARTITION BY ext_dev_ref ORDER BY utc, timestamp_local),
               f AS (PARTITION BY ext_dev_ref ORDER BY utc, timestamp_local
                     ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    "peaks": """
        SELECT client_id, ext_dev_ref, date_local, hour AS peak_hour, consumption_kwh AS peak_kwh
        FROM hours WHERE consumption_kwh IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY client_id, ext_dev_ref, date_local
                                   ORDER BY consumption_kwh DESC, utc, timestamp_local) = 1""",
    "sums": """
        SELECT client_id, ext_dev_ref, date_local,
               coalesce(sum(consumption_kwh), 0) AS total_kwh, avg(consumption_kwh) AS mean_kwh,
               max(consumption_kwh) AS max_kwh, stddev_samp(consumption_kwh) AS std_kwh,
               count(consumption_kwh) AS hourly_count,
               coalesce(sum(consumption_kwh) FILTER (WHERE hour <= 6), 0) AS night_kwh,
               coalesce(sum(consumption_kwh) FILTER (WHERE hour >= 18), 0) AS day_kwh
        FROM hours GROUP BY ALL""",
    "measures": """
        SELECT s.*, p.peak_hour, p.peak_kwh,
               CASE WHEN s.mean_kwh = 0 THEN 0 ELSE coalesce(p.peak_kwh / s.mean_kwh, 0) END AS peak_to_mean_ratio
        FROM sums s LEFT JOIN peaks p USING (client_id, ext_dev_ref, date_local)""",
    "daily": """
        SELECT client_id, ext_dev_ref, date_local, total_kwh, round(mean_kwh, 6) AS mean_kwh, max_kwh,
               round(std_kwh, 6) AS std_kwh, hourly_count, peak_hour, peak_kwh,
               peak_to_mean_ratio AS exact_ratio, round(peak_to_mean_ratio, 6) AS peak_to_mean_ratio,
               night_kwh, day_kwh,
               sum(total_kwh) OVER (PARTITION BY client_id, ext_dev_ref ORDER BY date_local
                                    ROWS UNBOUNDED PRECEDING) AS cumulative_total_kwh,
               round(total_kwh / (avg(total_kwh) OVER (PARTITION BY client_id, ext_dev_ref) + 0.000001), 6)
                   AS weekend_vs_weekday,
               CAST(month(date_local) AS INTEGER) AS month,
               CASE WHEN month(date_local) IN (12, 1, 2) THEN 'winter' WHEN month(date_local) <= 5 THEN 'spring'
                    WHEN month(date_local) <= 8 THEN 'summer' ELSE 'fall' END AS season,
               CAST(date_local IN (
                   DATE '2024-01-01', DATE '2024-02-16', DATE '2024-03-11', DATE '2024-03-31', DATE '2024-04-01',
                   DATE '2024-05-01', DATE '2024-05-05', DATE '2024-06-02', DATE '2024-06-24', DATE '2024-07-06',
                   DATE '2024-08-15', DATE '2024-11-01', DATE '2024-11-02', DATE '2024-12-24', DATE '2024-12-25',
                   DATE '2024-12-26', DATE '2025-01-01') AS INTEGER) AS is_holiday,
               CAST(month(date_local) IN (7, 8) AS INTEGER) AS is_summer_vacation,
               round_even(avg(total_kwh) OVER (PARTITION BY client_id, ext_dev_ref ORDER BY date_local
                          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_7d_total_kwh,
               round_even(avg(total_kwh) OVER (PARTITION BY client_id, ext_dev_ref ORDER BY date_local
                          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS rolling_30d_total_kwh,
               CASE WHEN total_kwh <= -1 THEN NULL WHEN total_kwh <= 600 THEN 'very_low'
                    WHEN total_kwh <= 1000 THEN 'low' WHEN total_kwh <= 1500 THEN 'medium'
                    WHEN total_kwh <= 999999 THEN 'high' END AS consumption_category
        FROM measures""",
    "monthly": """
        SELECT client_id, ext_dev_ref, CAST(year(date_local) AS INTEGER) AS year,
               CAST(month(date_local) AS INTEGER) AS month,
               round_even(sum(total_kwh), 6) AS monthly_total_kwh,
               round_even(avg(total_kwh), 6) AS monthly_mean_kwh,
               round_even(max(total_kwh), 6) AS monthly_max_kwh,
               count(total_kwh) AS days_with_data
        FROM daily GROUP BY ALL""",
    "vectors": """
        SELECT ext_dev_ref, date_local, list(kwh ORDER BY h) AS load
        FROM (SELECT s.ext_dev_ref, s.date_local, g.h, coalesce(avg(x.consumption_kwh), 0) AS kwh
              FROM (SELECT ext_dev_ref, date_local FROM sums WHERE hourly_count > 0) s
              CROSS JOIN (SELECT unnest(range(24)) AS h) g
              LEFT JOIN hours x ON x.ext_dev_ref = s.ext_dev_ref AND x.date_local = s.date_local AND x.hour = g.h
              GROUP BY ALL)
        GROUP BY ALL""",
    "alike": """
        SELECT ext_dev_ref, date_local,
               CASE WHEN before IS NULL THEN NULL
                    WHEN list_dot_product(load, load) = 0 OR list_dot_product(before, before) = 0 THEN 0
                    ELSE list_dot_product(before, load)
                         / (sqrt(list_dot_product(before, before)) * sqrt(list_dot_product(load, load)))
               END AS similarity
        FROM (SELECT *, lag(load) OVER (PARTITION BY ext_dev_ref ORDER BY date_local) AS before FROM vectors)""",
}

_NEEDS = {
    "per_hour": [],
    "meter_days": ["per_hour"],
    "raw_hours": ["meter_days"],
    "hours": ["raw_hours"],
    "lookback": ["hours"],
    "peaks": ["hours"],
    "sums": ["hours"],
    "measures": ["sums", "peaks"],
    "daily": ["measures"],
    "monthly": ["daily"],
    "vectors": ["sums"],
    "alike": ["vectors"],
}


def _with(select: str, *steps: str) -> str:
    """``select`` behind a WITH clause of the steps it needs, in order."""
    needed: set[str] = set()

    def add(step: str) -> None:
        for earlier in _NEEDS[step]:
            add(earlier)
        needed.add(step)

    for step in steps:
        add(step)
    clauses = ",\n".join(f"{name} AS ({sql})" for name, sql in _STEPS.items() if name in needed)
    return f"WITH {clauses}\n{select}"


_DAILY_COLUMNS = """client_id, ext_dev_ref, date_local, total_kwh, mean_kwh, max_kwh, std_kwh, hourly_count,
    peak_hour, peak_kwh, peak_to_mean_ratio, night_kwh, day_kwh, cumulative_total_kwh, weekend_vs_weekday,
    month, season, is_holiday, is_summer_vacation, rolling_7d_total_kwh, rolling_30d_total_kwh,
    consumption_category"""

# A naive local time exists once if exactly one UTC time near it maps to it.
_NAIVE = "(idx % 4 = 3 OR idx IN (2, 18))"
_MIXED = f"""
    SELECT ext_dev_ref, text, timestamp FROM (
        SELECT ext_dev_ref,
               CASE WHEN idx % 4 = 0 THEN timestamp_local
                    WHEN idx % 4 = 1 THEN strftime(utc, '%Y-%m-%dT%H:%M:%S') || 'Z'
                    WHEN idx % 4 = 3 OR idx = 2 THEN strftime(wall, '%Y-%m-%dT%H:%M:%S')
                    WHEN idx = 6 THEN strftime(utc, '%Y-%m-%dT%H:%M') || 'z'
                    WHEN idx = 10 THEN strftime(utc, '%Y-%m-%d %H:%M:%S') || ' UTC'
                    WHEN idx = 14 THEN strftime(wall, '%Y-%m-%dT%H:%M:%S') || printf('+%02d', off // 60)
                    WHEN idx = 18 THEN strftime(wall, '%Y%m%dT%H%M%S')
                    ELSE 'day ' || CAST(d AS VARCHAR) END AS text,
               CASE WHEN idx % 4 IN (0, 1) OR idx IN (6, 10, 14) THEN utc
                    WHEN {_NAIVE}
                         AND (CAST(timezone('Europe/Vilnius', timezone('UTC', wall - to_hours(2))) = wall AS INTEGER)
                            + CAST(timezone('Europe/Vilnius', timezone('UTC', wall - to_hours(3))) = wall AS INTEGER)) = 1
                    THEN CASE WHEN timezone('Europe/Vilnius', timezone('UTC', wall - to_hours(2))) = wall
                              THEN wall - to_hours(2) ELSE wall - to_hours(3) END
               END AS timestamp
        FROM hours)"""

_LOCAL_WALL = "timezone('Europe/Vilnius', timezone('UTC', utc))"


def _time_features(ts: str) -> str:
    return f"""
        SELECT ext_dev_ref, timestamp_local, {ts} AS timestamp, CAST(hour({ts}) AS INTEGER) AS hour,
               CAST({ts} AS DATE) AS date_local, CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
               CAST(isodow({ts}) >= 6 AS INTEGER) AS is_weekend, CAST(month({ts}) AS INTEGER) AS month,
               CAST(year({ts}) AS INTEGER) AS year
        FROM hours"""


def _mean_day(flag: str, count: str) -> str:
    return f"""SELECT {flag}, count(*) AS {count}, round(avg(total_kwh), 6) AS avg_daily_kwh
               FROM daily GROUP BY {flag}"""


def _similar(target: str) -> str:
    return f"""
        SELECT a.ext_dev_ref, round(a.v, 6) AS avg_daily_kwh
        FROM (SELECT ext_dev_ref, avg(total_kwh) AS v FROM daily GROUP BY ext_dev_ref) a,
             (SELECT avg(total_kwh) AS t FROM daily WHERE ext_dev_ref = ({target})) b
        WHERE a.v >= b.t * 0.9 AND a.v <= b.t * 1.1
        ORDER BY abs(a.v - b.t), a.ext_dev_ref LIMIT 50"""


_REPORTS = {
    "yearly_consumption": (
        "SELECT CAST(year(date_local) AS INTEGER) AS year, sum(total_kwh) AS yearly_kwh FROM daily GROUP BY 1",
        "daily"),
    "top_meters_by_year": (
        """SELECT ext_dev_ref, CAST(year(date_local) AS INTEGER) AS year, sum(total_kwh) AS yearly_kwh
           FROM daily GROUP BY 1, 2 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 100""", "daily"),
    "hourly_profile_avg": (
        """SELECT hour, round(avg(consumption_kwh), 6) AS avg_kwh, count(*) AS samples
           FROM hours GROUP BY hour""", "hours"),
    "peak_hours_distribution": (
        """SELECT peak_hour, count(*) AS occurrences, round(avg(peak_kwh), 6) AS avg_peak_kwh
           FROM daily WHERE peak_hour IS NOT NULL GROUP BY peak_hour""", "daily"),
    "holiday_vs_nonholiday": (_mean_day("is_holiday", "days"), "daily"),
    "vacation_effect": (_mean_day("is_summer_vacation", "days"), "daily"),
    "monthly_trends": (
        "SELECT year, month, sum(monthly_total_kwh) AS total_kwh FROM monthly GROUP BY 1, 2", "monthly"),
    "consumption_categories": (_mean_day("consumption_category", "cnt"), "daily"),
    "similar_meters": (_similar("SELECT min(ext_dev_ref) FROM daily"), "daily"),
    "night_day_consumption": (
        "SELECT sum(night_kwh) AS night_kwh, sum(day_kwh) AS day_kwh FROM daily", "daily"),
    "peak_to_mean_outliers": (f"SELECT {_DAILY_COLUMNS} FROM daily WHERE exact_ratio > 2.5", "daily"),
}

_RUN_STATUS = " UNION ALL ".join(
    f"SELECT '{name}' AS report, 'ok' AS status, (SELECT count(*) FROM ({sql})) AS n_rows, NULL AS error"
    for name, (sql, _) in _REPORTS.items()) + " UNION ALL SELECT 'broken_report', 'failed', NULL, 'ValueError'"

ORACLES: dict[str, str] = {
    "expand_hourly": _with(
        """SELECT client_id, ext_dev_ref, resolution, CAST(d AS VARCHAR) AS date_local, idx AS hour,
                  timestamp_utc, consumption_kwh FROM hours""", "hours"),
    "rejected_rows": _with(
        """SELECT client_id, ext_dev_ref, CAST(d AS VARCHAR) AS date, CAST(23 AS INTEGER) AS array_size,
                  'wrong array size' AS reason FROM meter_days WHERE short""", "meter_days"),
    "local_timestamp_text": _with(
        "SELECT ext_dev_ref, idx AS array_index, timestamp_local, utc AS timestamp FROM hours", "hours"),
    "parse_timestamps": _with(f"SELECT * FROM ({_MIXED}) WHERE timestamp IS NOT NULL", "hours"),
    "parse_rejects": _with(f"SELECT ext_dev_ref, text FROM ({_MIXED}) WHERE timestamp IS NULL", "hours"),
    "hourly_time_features": _with(_time_features("utc"), "hours"),
    "hourly_time_features_local": _with(_time_features(_LOCAL_WALL), "hours"),
    "hourly_lags": _with(
        "SELECT ext_dev_ref, timestamp_local, consumption_kwh, lag_1h, lag_24h FROM lookback", "lookback"),
    "hourly_rolling_24h": _with(
        "SELECT ext_dev_ref, timestamp_local, rolling_mean_24h, rolling_std_24h FROM lookback", "lookback"),
    "hourly_lookback_sliced": _with(
        """SELECT ext_dev_ref, timestamp_local, lag_1h, lag_24h, rolling_mean_24h, rolling_std_24h
           FROM lookback""", "lookback"),
    "hourly_all_columns": _with(
        """SELECT client_id, ext_dev_ref, resolution, date_local, hour, timestamp_local, timestamp_utc,
                  consumption_kwh, utc AS timestamp, CAST(isodow(utc) - 1 AS INTEGER) AS day_of_week,
                  CAST(isodow(utc) >= 6 AS INTEGER) AS is_weekend, CAST(month(utc) AS INTEGER) AS month,
                  CAST(year(utc) AS INTEGER) AS year, lag_1h, lag_24h, rolling_mean_24h, rolling_std_24h
           FROM lookback""", "lookback"),
    "daily_aggregate": _with(
        """SELECT client_id, ext_dev_ref, date_local, total_kwh, max_kwh, hourly_count, mean_kwh, std_kwh,
                  peak_to_mean_ratio FROM daily""", "daily"),
    "daily_peak_hour": _with(
        "SELECT client_id, ext_dev_ref, date_local, peak_hour, peak_kwh FROM measures", "measures"),
    "daily_night_evening": _with(
        "SELECT client_id, ext_dev_ref, date_local, night_kwh, day_kwh FROM sums", "sums"),
    "daily_cumulative_and_ratio": _with(
        """SELECT client_id, ext_dev_ref, date_local, cumulative_total_kwh, weekend_vs_weekday
           FROM daily""", "daily"),
    "daily_rolling": _with(
        """SELECT client_id, ext_dev_ref, date_local, rolling_7d_total_kwh, rolling_30d_total_kwh
           FROM daily""", "daily"),
    "daily_calendar_flags": _with(
        """SELECT client_id, ext_dev_ref, date_local, month, season, is_holiday, is_summer_vacation
           FROM daily""", "daily"),
    "daily_category": _with(
        "SELECT client_id, ext_dev_ref, date_local, total_kwh, consumption_category FROM daily", "daily"),
    "daily_all_columns": _with(f"SELECT {_DAILY_COLUMNS} FROM daily", "daily"),
    "monthly_aggregate": _with("SELECT * FROM monthly", "monthly"),
    "load_shape_similarity": _with(
        """SELECT s.client_id, s.ext_dev_ref, s.date_local, round(a.similarity, 9) AS daily_load_similarity
           FROM sums s LEFT JOIN alike a USING (ext_dev_ref, date_local)""", "sums", "alike"),
    "repeated_meter_days": _with(
        """SELECT client_id, ext_dev_ref, date_local, total_kwh * 2 AS total_twice, total_kwh FROM sums""", "sums"),
    **{name: _with(sql, step) for name, (sql, step) in _REPORTS.items()},
    "similar_meters_of": _with(_similar("'dev_3'"), "daily"),
    "parquet_scan_by_glob": _with(
        """SELECT client_id, d AS date, ext_dev_ref, CAST(CASE WHEN short THEN 23 ELSE 24 END AS INTEGER) AS n_readings,
                  CASE WHEN month(d) < 8 THEN 'PT1H' END AS resolution FROM meter_days""", "meter_days"),
    "hourly_csv_roundtrip": _with(
        """SELECT client_id, ext_dev_ref, CAST(d AS VARCHAR) AS date_local, idx AS hour, timestamp_local,
                  consumption_kwh FROM hours""", "hours"),
    "hourly_store_roundtrip": _with(
        """SELECT CAST(year(utc) AS INTEGER) AS year, CAST(month(utc) AS INTEGER) AS month,
                  count(*) * 2 AS n_rows, sum(consumption_kwh) * 2 AS total_kwh FROM hours GROUP BY 1, 2""", "hours"),
    "daily_store_roundtrip": _with(f"SELECT {_DAILY_COLUMNS} FROM daily", "daily"),
    "sql_over_tables": _with(
        """SELECT m.ext_dev_ref, m.year, m.month, m.monthly_total_kwh, sum(d.hourly_count)::BIGINT AS hours,
                  count(*) AS days
           FROM monthly m JOIN daily d ON d.ext_dev_ref = m.ext_dev_ref AND year(d.date_local) = m.year
                                      AND d.month = m.month
           GROUP BY ALL""", "monthly"),
    "run_status": _with(_RUN_STATUS, "daily", "monthly", "hours"),
    "run_metrics": _with(
        """SELECT 'meter_days_read' AS step, (SELECT count(*) FROM meter_days) AS n_rows
           UNION ALL SELECT 'meter_days_rejected', (SELECT count(*) FROM meter_days WHERE short)
           UNION ALL SELECT 'meter_days_unparsed', 0
           UNION ALL SELECT 'hours_expanded', (SELECT count(*) FROM hours)
           UNION ALL SELECT 'meter_hourly_written', (SELECT count(*) FROM hours)
           UNION ALL SELECT 'meter_daily_written', (SELECT count(*) FROM daily)
           UNION ALL SELECT 'meter_monthly_written', (SELECT count(*) FROM monthly)""", "monthly", "hours"),
    "raw_csv_order": _with(
        """SELECT ext_dev_ref, timestamp_local, row_number() OVER (ORDER BY ext_dev_ref, timestamp_local) AS place
           FROM hours""", "hours"),
    "top_meters_first_rows": _with(
        """SELECT *, row_number() OVER (ORDER BY year DESC, yearly_kwh DESC, ext_dev_ref) AS place
           FROM (SELECT ext_dev_ref, CAST(year(date_local) AS INTEGER) AS year, sum(total_kwh) AS yearly_kwh
                 FROM daily GROUP BY 1, 2) QUALIFY place <= 5""", "daily"),
    "similar_meters_first_rows": _with(
        """SELECT a.ext_dev_ref, row_number() OVER (ORDER BY abs(a.v - b.t), a.ext_dev_ref) AS place
           FROM (SELECT ext_dev_ref, avg(total_kwh) AS v FROM daily GROUP BY ext_dev_ref) a,
                (SELECT avg(total_kwh) AS t FROM daily WHERE ext_dev_ref = (SELECT min(ext_dev_ref) FROM daily)) b
           WHERE a.v >= b.t * 0.9 AND a.v <= b.t * 1.1 QUALIFY place <= 3""", "daily"),
    "mixed_file_types": _with("SELECT ext_dev_ref, timestamp_utc, consumption_kwh FROM hours", "hours"),
    "incremental_hourly": _with(
        """SELECT client_id, ext_dev_ref, resolution, date_local, hour, timestamp_local, timestamp_utc,
                  consumption_kwh, utc AS timestamp, CAST(isodow(utc) - 1 AS INTEGER) AS day_of_week,
                  CAST(isodow(utc) >= 6 AS INTEGER) AS is_weekend, CAST(month(utc) AS INTEGER) AS month,
                  CAST(year(utc) AS INTEGER) AS year, lag_1h, lag_24h, rolling_mean_24h, rolling_std_24h
           FROM lookback""", "lookback"),
    "incremental_daily": _with(f"SELECT {_DAILY_COLUMNS} FROM daily", "daily"),
    "incremental_monthly": _with("SELECT * FROM monthly", "monthly"),
    "meter_lookup": _with(
        """SELECT CAST(year(utc) AS INTEGER) AS year, CAST(month(utc) AS INTEGER) AS month, count(*) AS hours,
                  sum(consumption_kwh) AS total_kwh, max(utc) AS last_hour
           FROM hours WHERE ext_dev_ref = 'dev_3' GROUP BY 1, 2""", "hours"),
    "shared_day_reports": _with(" UNION ALL ".join(
        f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS value, {n} AS days, {kwh} AS kwh FROM ({_REPORTS[name][0]})"
        for name, key, n, kwh in (
            ("yearly_consumption", "year", "NULL", "round(yearly_kwh, 6)"),
            ("peak_hours_distribution", "peak_hour", "occurrences", "avg_peak_kwh"),
            ("holiday_vs_nonholiday", "is_holiday", "days", "avg_daily_kwh"),
            ("vacation_effect", "is_summer_vacation", "days", "avg_daily_kwh"),
            ("consumption_categories", "consumption_category", "cnt", "avg_daily_kwh"),
            ("night_day_consumption", "NULL", "NULL", "round(night_kwh + day_kwh, 6)"))), "daily"),
    "repeated_run": _with(
        """SELECT m.ext_dev_ref, m.months, m.days, m.total_kwh, d.day_rows, d.running_total
           FROM (SELECT ext_dev_ref, count(*) AS months, CAST(sum(days_with_data) AS BIGINT) AS days,
                        sum(monthly_total_kwh) AS total_kwh FROM monthly GROUP BY 1) m
           JOIN (SELECT ext_dev_ref, count(*) AS day_rows, max(cumulative_total_kwh) AS running_total
                 FROM daily GROUP BY 1) d USING (ext_dev_ref)""", "monthly"),
}
