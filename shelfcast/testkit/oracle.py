"""The same queries as SQL for DuckDB, written apart from the Spark plans."""

from __future__ import annotations

import re

# Tables the oracles share, each over the driver's tables or those above it.
TABLES = {
    "items_raw": """
        SELECT p_partkey AS item_nbr, p_type AS family, p_size AS class,
               CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 1 ELSE 0 END AS perishable
        FROM part""",
    "stores_raw": """
        SELECT s_suppkey AS store_nbr, '  ' || replace(n_name, '_', '%20') || ' ' AS city,
               r_name AS state, r_name AS type, s_nationkey AS cluster
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
                      JOIN region ON r_regionkey = n_regionkey""",
    "train_raw": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr,
               l_partkey AS item_nbr,
               CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS unit_sales,
               CASE WHEN l_discount = 0 THEN NULL
                    WHEN l_discount >= 0.05 THEN 'True' ELSE 'False' END AS onpromotion
        FROM lineitem""",
    "oil_raw": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE WHEN day(CAST(o_orderdate AS DATE)) = 1 THEN NULL
                    ELSE max(o_totalprice) END AS dcoilwtico
        FROM orders
        GROUP BY CAST(o_orderdate AS DATE)""",
    "transactions_raw": """
        SELECT CAST(o_orderdate AS DATE) AS date, l_suppkey AS store_nbr,
               CAST(count(DISTINCT l_orderkey) AS INTEGER) AS transactions
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY CAST(o_orderdate AS DATE), l_suppkey""",
    "holidays_raw": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_orderstatus AS type,
               c_mktsegment AS locale, n_name AS locale_name
        FROM orders JOIN customer ON c_custkey = o_custkey
                    JOIN nation ON n_nationkey = c_nationkey""",
    "weather_raw": """
        SELECT CAST(o_orderdate AS DATE) AS date, lower(replace(n_name, '_', ' ')) AS city_norm,
               CAST(o_custkey % 40 AS DOUBLE) AS temp_c, CAST(o_orderkey % 7 AS DOUBLE) AS precip_mm,
               CAST(o_orderkey % 3 AS DOUBLE) AS rain_mm, CAST(o_custkey % 100 AS DOUBLE) AS rh_pct,
               CAST(o_custkey % 45 AS DOUBLE) AS apparent_c
        FROM orders JOIN customer ON c_custkey = o_custkey
                    JOIN nation ON n_nationkey = c_nationkey""",
    "weather_hourly_raw": """
        SELECT ts, 'port ' || event_type AS city_norm, value AS temp_c,
               CAST(event_id % 7 AS DOUBLE) AS precip_mm, CAST(event_id % 3 AS DOUBLE) AS rain_mm,
               CAST(user_id % 100 AS DOUBLE) AS rh_pct, value AS apparent_c
        FROM events""",
    "dim_item": """
        SELECT DISTINCT item_nbr AS item_id, family, class, perishable = 1 AS perishable
        FROM items_raw WHERE perishable = 1""",
    "dim_store": """
        SELECT DISTINCT store_nbr AS store_id, city, state, type AS store_type, cluster
        FROM stores_raw""",
    "store_city": """
        SELECT store_id,
               lower(trim(regexp_replace(replace(city, '%20', ' '), '\\s+', ' ', 'g'))) AS city_norm
        FROM dim_store""",
    "fact_sales": """
        SELECT date, store_nbr AS store_id, item_nbr AS item_id, unit_sales,
               CAST(onpromotion AS BOOLEAN) AS onpromotion
        FROM train_raw JOIN (SELECT item_nbr FROM items_raw WHERE perishable = 1) USING (item_nbr)
        WHERE unit_sales >= 0 AND date IS NOT NULL""",
    "daily_fact": """
        SELECT date, store_id, family, family AS item_id, sum(unit_sales) AS unit_sales,
               bool_or(onpromotion) AS onpromotion
        FROM fact_sales JOIN items_raw ON item_nbr = item_id
        GROUP BY date, store_id, family""",
    "oil": "SELECT date, dcoilwtico AS oil_price FROM oil_raw",
    "trx": "SELECT date, store_nbr AS store_id, transactions FROM transactions_raw",
    "holiday_dates": """
        SELECT DISTINCT date, CAST(date IS NOT NULL AS INTEGER) AS is_holiday FROM holidays_raw""",
    "holidays": """
        SELECT date, type AS holiday_type, locale, locale_name
        FROM holidays_raw
        QUALIFY row_number() OVER (
            PARTITION BY date ORDER BY type NULLS FIRST, locale NULLS FIRST,
                                       locale_name NULLS FIRST) = 1""",
    "weather": """
        SELECT date, city_norm, avg(temp_c) AS temp_avg_c, min(temp_c) AS temp_min_c,
               max(temp_c) AS temp_max_c, sum(precip_mm) AS precip_total_mm,
               sum(rain_mm) AS rain_total_mm, avg(rh_pct) AS humidity_avg_pct,
               avg(apparent_c) AS apparent_avg_c
        FROM weather_raw GROUP BY date, city_norm""",
    "weather_month": """
        SELECT CAST(ts AS DATE) AS date, city_norm, round(avg(temp_c), 6) AS temp_avg_c,
               min(temp_c) AS temp_min_c, max(temp_c) AS temp_max_c,
               sum(precip_mm) AS precip_total_mm, sum(rain_mm) AS rain_total_mm,
               round(avg(rh_pct), 6) AS humidity_avg_pct, round(avg(apparent_c), 6) AS apparent_avg_c
        FROM weather_hourly_raw GROUP BY CAST(ts AS DATE), city_norm""",
    "history": """
        SELECT *, lag(unit_sales, 1) OVER w AS lag_1, lag(unit_sales, 7) OVER w AS lag_7,
               lag(unit_sales, 14) OVER w AS lag_14, lag(unit_sales, 28) OVER w AS lag_28,
               avg(unit_sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll_mean_7,
               avg(unit_sales) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS roll_mean_14,
               avg(unit_sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS roll_mean_28
        FROM joined
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)""",
    "joined": """
        SELECT f.*, s.city_norm, o.oil_price, t.transactions, h.is_holiday,
               w.* EXCLUDE (date, city_norm)
        FROM daily_fact f
        LEFT JOIN oil o ON o.date = f.date
        LEFT JOIN trx t ON t.date = f.date AND t.store_id = f.store_id
        LEFT JOIN holiday_dates h ON h.date = f.date
        LEFT JOIN store_city s ON s.store_id = f.store_id
        LEFT JOIN weather w ON w.date = f.date AND w.city_norm = s.city_norm""",
    "model_train": """
        SELECT date, store_id, item_id, unit_sales AS y, onpromotion, family,
               coalesce(oil_price, 0.0) AS oil_price, coalesce(transactions, 0) AS transactions,
               coalesce(is_holiday, 0) AS is_holiday,
               temp_avg_c, temp_min_c, temp_max_c, precip_total_mm, rain_total_mm,
               humidity_avg_pct, apparent_avg_c,
               CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(weekofyear(date) AS INTEGER) AS weekofyear,
               CAST(dayofweek(date) + 1 AS INTEGER) AS dow,
               CAST(dayofweek(date) IN (0, 6) AS INTEGER) AS is_weekend,
               CAST(day(date) = 1 AS INTEGER) AS is_month_start,
               CAST(day(date) >= 28 AS INTEGER) AS is_month_end,
               lag_1, lag_7, lag_14, lag_28, roll_mean_7, roll_mean_14, roll_mean_28
        FROM history WHERE lag_28 IS NOT NULL""",
    "errors": """
        SELECT model, family, yhat - y AS error
        FROM (SELECT family, y, 'naive' AS model, lag_1 AS yhat FROM model_train
              UNION ALL SELECT family, y, 'seasonal_naive', lag_7 FROM model_train
              UNION ALL SELECT family, y, 'moving_average', roll_mean_7 FROM model_train)""",
    "late": """
        SELECT * FROM model_train
        WHERE date > (SELECT min(date) + CAST(floor((max(date) - min(date)) * 0.8) AS INTEGER)
                      FROM model_train)""",
    "late_errors": """
        SELECT model, family, yhat - y AS error
        FROM (SELECT family, y, 'naive' AS model, lag_1 AS yhat FROM late
              UNION ALL SELECT family, y, 'seasonal_naive', lag_7 FROM late
              UNION ALL SELECT family, y, 'moving_average', roll_mean_7 FROM late)""",
    "spoilt": """
        SELECT CAST(store_nbr % 3 AS INTEGER) AS file,
               CASE WHEN item_nbr % 10 = 0 THEN 'no ' || item_nbr
                    ELSE CAST(item_nbr AS VARCHAR) END AS item,
               CASE WHEN store_nbr % 4 = 0 THEN 'maybe' ELSE coalesce(onpromotion, '') END AS promoted,
               item_nbr % 15 = 0 AS split, CAST(date AS VARCHAR) AS day, store_nbr
        FROM train_raw""",
    "folds": """
        SELECT (SELECT max(date) FROM history) - CAST(28 + 14 * k AS INTEGER) AS origin
        FROM range(4) AS r(k)""",
    "ahead": """
        SELECT h.*, f.origin, row_number() OVER w AS step, first_value(lag_1) OVER w AS naive,
               first_value(roll_mean_7) OVER w AS moving_average, first_value(lag_28) OVER w AS ready
        FROM history h JOIN folds f ON h.date > f.origin AND h.date <= f.origin + 28
        WINDOW w AS (PARTITION BY store_id, item_id, origin ORDER BY date)""",
    "made": """
        SELECT a.origin, CAST(ceil((a.date - a.origin) / 7.0) AS INTEGER) AS weeks_ahead,
               a.unit_sales AS y, a.naive, a.moving_average, b.lag_7 AS seasonal_naive
        FROM ahead a JOIN ahead b ON b.store_id = a.store_id AND b.item_id = a.item_id
             AND b.origin = a.origin AND b.step = (a.step - 1) % 7 + 1
        WHERE a.ready IS NOT NULL""",
    "gains": """
        SELECT date, 'seasonal_naive' AS model, sum(abs(lag_1 - y) - abs(lag_7 - y)) AS gain,
               count(y) AS n
        FROM model_train GROUP BY date
        UNION ALL
        SELECT date, 'moving_average', sum(abs(lag_1 - y) - abs(roll_mean_7 - y)), count(y)
        FROM model_train GROUP BY date""",
    "draws": """
        SELECT date, r AS replicate, CASE WHEN r = 0 THEN 1 ELSE len(list_filter(
                   [0.367879, 0.735759, 0.919699, 0.981012, 0.99634, 0.999406, 0.999917, 0.99999, 0.999999],
                   lambda cut: ('0x' || substr(md5(r || '|' || date), 1, 8))::BIGINT / 4294967296.0 >= cut))
               END AS w
        FROM (SELECT DISTINCT date FROM model_train), range(201) AS t(r)""",
    "samples": """
        SELECT model, replicate, round(sum(gain * w) / sum(n * w), 6) AS gain
        FROM gains JOIN draws USING (date) GROUP BY model, replicate""",
    "deviations": """
        SELECT y - avg(y) OVER w AS y, h - avg(h) OVER w AS h, e - avg(e) OVER w AS e,
               p - avg(p) OVER w AS p
        FROM (SELECT store_id, item_id, y, is_holiday AS h, is_weekend AS e,
                     coalesce(CAST(onpromotion AS INTEGER), 0) AS p FROM model_train)
        WINDOW w AS (PARTITION BY store_id, item_id)""",
    "gram": """
        SELECT sum(h * h) AS hh, sum(h * e) AS he, sum(h * p) AS hp, sum(e * e) AS ee,
               sum(e * p) AS ep, sum(p * p) AS pp, sum(h * y) AS hy, sum(e * y) AS ey,
               sum(p * y) AS py, count(*) AS n
        FROM deviations""",
    "determinant": """
        SELECT *, hh * (ee * pp - ep * ep) - he * (he * pp - ep * hp) + hp * (he * ep - ee * hp) AS det
        FROM gram""",
    "demands": """
        SELECT store_id, item_id, unit_sales, date - lag(date) OVER w AS days,
               row_number() OVER w AS k
        FROM daily_fact WHERE unit_sales > 0
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)""",
    "smoothed": """
        SELECT store_id, item_id, k, unit_sales AS size, 1.0::DOUBLE AS gap FROM demands WHERE k = 1
        UNION ALL
        SELECT d.store_id, d.item_id, d.k, s.size + 0.1::DOUBLE * (d.unit_sales - s.size),
               s.gap + 0.1::DOUBLE * (d.days - s.gap)
        FROM smoothed s JOIN demands d
             ON d.store_id = s.store_id AND d.item_id = s.item_id AND d.k = s.k + 1""",
    "fact_print": """
        SELECT count(*) AS row_count, CAST(coalesce(sum(('0x' || substr(md5(concat_ws(chr(31),
                   CAST(date AS VARCHAR), CAST(item_id AS VARCHAR),
                   coalesce(CAST(onpromotion AS VARCHAR), chr(0)), CAST(store_id AS VARCHAR),
                   CAST(CAST(unit_sales AS DECIMAL(38, 6)) AS VARCHAR))), 1, 15))::BIGINT), 0)
               AS VARCHAR) AS fingerprint
        FROM fact_sales""",
    "series_print": """
        SELECT count(*) AS row_count, CAST(coalesce(sum(('0x' || substr(md5(concat_ws(chr(31),
                   CAST(date AS VARCHAR), family, item_id,
                   coalesce(CAST(onpromotion AS VARCHAR), chr(0)), CAST(store_id AS VARCHAR),
                   CAST(CAST(unit_sales AS DECIMAL(38, 6)) AS VARCHAR))), 1, 15))::BIGINT), 0)
               AS VARCHAR) AS fingerprint
        FROM daily_fact""",
    "blocks": """
        SELECT store_id, item_id, date, y, lag_1, lag_7, roll_mean_28,
               concat_ws('|', date, store_id, item_id) AS key,
               ('0x' || substr(md5(concat_ws('|', date, store_id, item_id)), 1, 8))::BIGINT
                   % CAST(ceil((SELECT count(*) FROM model_train) / 3000.0) AS BIGINT) AS block
        FROM model_train""",
    "places": """
        SELECT *, row_number() OVER (PARTITION BY block ORDER BY md5(key)) AS place,
               row_number() OVER (PARTITION BY block ORDER BY md5('lag_1|' || key)) AS place_1,
               row_number() OVER (PARTITION BY block ORDER BY md5('lag_7|' || key)) AS place_7,
               row_number() OVER (PARTITION BY block ORDER BY md5('roll_mean_28|' || key)) AS place_28
        FROM blocks""",
    "swaps": """
        SELECT p.y, p.lag_1, p.lag_7, p.roll_mean_28, a.lag_1 AS x_1, b.lag_7 AS x_7,
               c.roll_mean_28 AS x_28
        FROM places p JOIN places a ON a.block = p.block AND a.place_1 = p.place
                      JOIN places b ON b.block = p.block AND b.place_7 = p.place
                      JOIN places c ON c.block = p.block AND c.place_28 = p.place""",
    "swap_errors": """
        SELECT avg(abs((lag_1 + 2 * lag_7 + 5 * roll_mean_28) / 8 - y)) AS base,
               avg(abs((x_1 + 2 * lag_7 + 5 * roll_mean_28) / 8 - y)) AS e_1,
               avg(abs((lag_1 + 2 * x_7 + 5 * roll_mean_28) / 8 - y)) AS e_7,
               avg(abs((lag_1 + 2 * lag_7 + 5 * x_28) / 8 - y)) AS e_28
        FROM swaps""",
    "levels": """
        SELECT 'is_holiday' AS factor, is_holiday AS level, y FROM model_train
        UNION ALL SELECT 'is_weekend', is_weekend, y FROM model_train
        UNION ALL SELECT 'onpromotion', CAST(onpromotion AS INTEGER), y FROM model_train""",
}

# Oracle per query; a bare table name stands for all of that table.
ORACLES = {
    "csv_scan": """
        SELECT date, CAST(store_nbr AS INTEGER) AS store_nbr, CAST(item_nbr AS INTEGER) AS item_nbr,
               unit_sales, CAST(onpromotion AS BOOLEAN) AS onpromotion
        FROM train_raw""",
    "csv_glob_scan": "SELECT * FROM oil_raw",
    "parquet_roundtrip": "SELECT * FROM train_raw",
    "partitioned_parquet": """
        SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
        FROM daily_fact""",
    "weather_preamble_strip": """
        SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts, * EXCLUDE (ts)
        FROM weather_hourly_raw""",
    "file_city_key": "SELECT DISTINCT city_norm FROM weather_hourly_raw",
    "project_rename_cast": """
        SELECT date, CAST(store_nbr AS INTEGER) AS store_id, CAST(item_nbr AS INTEGER) AS item_id,
               unit_sales, CAST(onpromotion AS BOOLEAN) AS onpromotion
        FROM train_raw""",
    "normalize_city": """
        SELECT store_nbr AS store_id,
               lower(trim(regexp_replace(replace(city, '%20', ' '), '\\s+', ' ', 'g'))) AS city_norm
        FROM stores_raw""",
    "filter_returns": "SELECT * FROM train_raw WHERE unit_sales >= 0",
    "filter_perishable": "SELECT * FROM items_raw WHERE perishable = 1",
    "filter_perishable_any": """
        SELECT 'number' AS kind, item_nbr FROM items_raw WHERE perishable = 1
        UNION ALL SELECT 'boolean', item_nbr FROM items_raw WHERE perishable = 1
        UNION ALL SELECT 'text', item_nbr FROM items_raw WHERE perishable = 1""",
    "dim_item": "SELECT * FROM dim_item",
    "dim_store": "SELECT * FROM dim_store",
    "join_fact_perishable": """
        SELECT t.* FROM train_raw t JOIN items_raw i ON i.item_nbr = t.item_nbr
        WHERE i.perishable = 1""",
    "fact_sales": "SELECT * FROM fact_sales",
    "join_dim_item": "SELECT * FROM fact_sales JOIN dim_item USING (item_id)",
    "join_store_city": "SELECT * FROM daily_fact LEFT JOIN store_city USING (store_id)",
    "join_date_signals": """
        SELECT * FROM daily_fact LEFT JOIN oil USING (date)
                                 LEFT JOIN holiday_dates USING (date)""",
    "join_store_day": "SELECT * FROM daily_fact LEFT JOIN trx USING (date, store_id)",
    "join_city_day": """
        SELECT * FROM daily_fact LEFT JOIN store_city USING (store_id)
                                 LEFT JOIN weather USING (date, city_norm)""",
    "null_fill": """
        SELECT f.*, coalesce(oil_price, 0.0) AS oil_price,
               coalesce(transactions, 0) AS transactions, coalesce(is_holiday, 0) AS is_holiday
        FROM daily_fact f LEFT JOIN oil USING (date) LEFT JOIN holiday_dates USING (date)
                          LEFT JOIN trx USING (date, store_id)""",
    "holiday_flag": "SELECT * FROM holiday_dates",
    "holidays_daily": "SELECT * FROM holidays",
    "feat_oil_daily": "SELECT * FROM oil",
    "feat_transactions_daily": "SELECT * FROM trx",
    "feat_weather_daily_city": "SELECT * FROM weather",
    "weather_daily": "SELECT * FROM weather_month",
    "weather_files_daily": "SELECT * FROM weather_month",
    "weather_time_shapes": """
        SELECT shape, CAST(CASE shape WHEN 'seconds' THEN date_trunc('second', ts)
                                      ELSE date_trunc('minute', ts) END AS TIMESTAMP) AS ts,
               * EXCLUDE (ts, shape)
        FROM (SELECT unnest(['blank', 'letter', 'seconds']) AS shape, * FROM weather_hourly_raw)""",
    "csv_perishable_spellings": """
        SELECT spelling, dim_item.*
        FROM dim_item, (SELECT unnest(['number', 'fraction', 'word']) AS spelling)""",
    "csv_rejects": """
        SELECT 'sales' AS input, column_name AS "column", rejected,
               (SELECT count(*) FROM train_raw) AS rows
        FROM (SELECT unnest(['date', 'store_nbr', 'item_nbr', 'unit_sales', 'onpromotion']) AS column_name,
                     unnest([0, 0, (SELECT count(*) FROM train_raw WHERE item_nbr % 10 = 0),
                             0, (SELECT count(*) FROM train_raw WHERE store_nbr % 4 = 0)]) AS rejected)""",
    "csv_quarantine": """
        SELECT 'sales' AS input, file, 'item_nbr' AS "column", item AS text
        FROM spoilt WHERE item LIKE 'no %'
        UNION ALL SELECT 'sales', file, 'onpromotion', CASE WHEN split THEN '5' ELSE promoted END
        FROM spoilt WHERE split OR promoted = 'maybe'
        UNION ALL SELECT 'sales', file, '(line)',
                         concat_ws(',', day, store_nbr, item, '1', '5', promoted)
        FROM spoilt WHERE split""",
    "holdout_errors": """
        SELECT model, family, round(avg(abs(error)), 6) AS mae,
               round(sqrt(avg(error * error)), 6) AS rmse, round(avg(error), 6) AS bias,
               count(error) AS n
        FROM (SELECT * FROM late_errors UNION ALL SELECT model, '(all)', error FROM late_errors)
        GROUP BY model, family""",
    "weather_profile": """
        SELECT min(date) AS min_date, max(date) AS max_date,
               count(DISTINCT city_norm) AS num_cities
        FROM weather_month""",
    "rows_per_city": """
        SELECT city_norm, count(*) AS count FROM weather_month GROUP BY city_norm
        ORDER BY city_norm""",
    "sample_rows": "SELECT * FROM weather_month ORDER BY date, city_norm LIMIT 5",
    "distinct_stores": "SELECT count(DISTINCT store_id) AS num_stores FROM fact_sales",
    "stage_row_counts": """
        SELECT 'dim_item' AS stage, count(*) AS row_count FROM dim_item
        UNION ALL SELECT 'dim_store', count(*) FROM dim_store
        UNION ALL SELECT 'fact_sales', count(*) FROM fact_sales
        UNION ALL SELECT 'oil', count(*) FROM oil
        UNION ALL SELECT 'transactions', count(*) FROM trx
        UNION ALL SELECT 'holidays', count(*) FROM holidays
        UNION ALL SELECT 'weather', count(*) FROM weather""",
    "fan_out": """
        SELECT 'dim_item' AS stage, count(*) AS repeated_keys
        FROM (SELECT item_id FROM dim_item GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'dim_store', count(*)
        FROM (SELECT store_id FROM dim_store GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'oil', count(*)
        FROM (SELECT date FROM oil GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'transactions', count(*)
        FROM (SELECT date, store_id FROM trx GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'holidays', count(*)
        FROM (SELECT date FROM holidays GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'weather', count(*)
        FROM (SELECT date, city_norm FROM weather GROUP BY ALL HAVING count(*) > 1)""",
    "null_rates": """
        SELECT avg(CAST(date IS NULL AS INTEGER)) AS date,
               avg(CAST(store_nbr IS NULL AS INTEGER)) AS store_nbr,
               avg(CAST(item_nbr IS NULL AS INTEGER)) AS item_nbr,
               avg(CAST(unit_sales IS NULL AS INTEGER)) AS unit_sales,
               avg(CAST(onpromotion IS NULL AS INTEGER)) AS onpromotion
        FROM train_raw""",
    "sales_rejects": """
        SELECT count(*) FILTER (WHERE unit_sales < 0) AS returns,
               count(*) FILTER (WHERE unit_sales IS NULL) AS unknown,
               count(*) FILTER (WHERE isnan(unit_sales)) AS not_a_number,
               count(*) FILTER (WHERE date IS NULL) AS undated
        FROM train_raw""",
    "daily_fact": "SELECT * FROM daily_fact",
    "calendar_features": """
        SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(day(date) AS INTEGER) AS day, CAST(weekofyear(date) AS INTEGER) AS weekofyear,
               CAST(dayofweek(date) + 1 AS INTEGER) AS dow,
               CAST(dayofweek(date) IN (0, 6) AS INTEGER) AS is_weekend,
               CAST(day(date) = 1 AS INTEGER) AS is_month_start,
               CAST(day(date) >= 28 AS INTEGER) AS is_month_end
        FROM daily_fact""",
    "lag_features": """
        SELECT * FROM (
            SELECT *, lag(unit_sales, 1) OVER w AS lag_1, lag(unit_sales, 7) OVER w AS lag_7,
                   lag(unit_sales, 14) OVER w AS lag_14, lag(unit_sales, 28) OVER w AS lag_28
            FROM daily_fact WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date))
        WHERE lag_28 IS NOT NULL""",
    "rolling_means": """
        SELECT * REPLACE (round(unit_sales, 6) AS unit_sales),
               round(avg(unit_sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS roll_mean_7,
               round(avg(unit_sales) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 6) AS roll_mean_14,
               round(avg(unit_sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6) AS roll_mean_28
        FROM (SELECT * REPLACE (
                  unit_sales * (day(date) / 31.0::DOUBLE + (store_id % 7) / 7.0::DOUBLE) AS unit_sales)
              FROM daily_fact)
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)""",
    "enrich_sales": """
        SELECT date, city_norm, store_id, item_id, unit_sales, onpromotion,
               coalesce(oil_price, 0.0) AS oil_price, coalesce(transactions, 0) AS transactions,
               coalesce(is_holiday, 0) AS is_holiday, temp_avg_c, temp_min_c, temp_max_c,
               precip_total_mm, rain_total_mm, humidity_avg_pct, apparent_avg_c
        FROM joined""",
    "model_base": """
        SELECT f.date, s.city_norm, f.store_id, f.item_id, f.unit_sales, f.onpromotion,
               i.family, i.class, i.perishable, o.oil_price, t.transactions,
               h.holiday_type, h.locale, h.locale_name, w.* EXCLUDE (date, city_norm)
        FROM fact_sales f
        JOIN dim_item i ON i.item_id = f.item_id
        LEFT JOIN store_city s ON s.store_id = f.store_id
        LEFT JOIN oil o ON o.date = f.date
        LEFT JOIN trx t ON t.date = f.date AND t.store_id = f.store_id
        LEFT JOIN holidays h ON h.date = f.date
        LEFT JOIN weather w ON w.date = f.date AND w.city_norm = s.city_norm
        WHERE i.perishable""",
    "model_train": "SELECT * FROM model_train",
    "model_train_incremental": "SELECT * FROM model_train",
    "baseline_forecast": """
        SELECT date, store_id, item_id, family, y, lag_1 AS naive, lag_7 AS seasonal_naive,
               roll_mean_7 AS moving_average
        FROM model_train""",
    "forecast_error": """
        SELECT model, family, round(avg(abs(error)), 6) AS mae,
               round(sqrt(avg(error * error)), 6) AS rmse, round(avg(error), 6) AS bias,
               count(error) AS n
        FROM (SELECT * FROM errors UNION ALL SELECT model, '(all)', error FROM errors)
        GROUP BY model, family""",
    "factor_effect": """
        SELECT factor, CAST(level AS VARCHAR) AS level, count(y) AS n, avg(y) AS mean_y
        FROM levels GROUP BY factor, level""",
    "factor_correlation": """
        SELECT 'oil_price' AS signal, round(corr(y, oil_price), 6) AS correlation FROM model_train
        UNION ALL SELECT 'transactions', round(corr(y, transactions), 6) FROM model_train
        UNION ALL SELECT 'temp_avg_c', round(corr(y, temp_avg_c), 6) FROM model_train
        UNION ALL SELECT 'precip_total_mm', round(corr(y, precip_total_mm), 6) FROM model_train""",
    "target_encoding": """
        SELECT date, family, store_id, y,
               round((coalesce(sum(y) OVER f, 0) + 20 * prior) / (count(y) OVER f + 20), 6) AS te_family,
               round((coalesce(sum(y) OVER s, 0) + 20 * prior) / (count(y) OVER s + 20), 6) AS te_store_id
        FROM (SELECT *, coalesce(avg(y) OVER (ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING
                                              AND CURRENT ROW EXCLUDE GROUP), 0) AS prior
              FROM model_train)
        WINDOW f AS (PARTITION BY family ORDER BY date
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP),
               s AS (PARTITION BY store_id ORDER BY date
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)""",
    "backtest_errors": """
        SELECT origin, weeks_ahead, model, round(avg(abs(yhat - y)), 6) AS mae,
               round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
               round(avg(yhat - y), 6) AS bias, count(yhat - y) AS n
        FROM (SELECT origin, weeks_ahead, y, 'naive' AS model, naive AS yhat FROM made
              UNION ALL SELECT origin, weeks_ahead, y, 'seasonal_naive', seasonal_naive FROM made
              UNION ALL SELECT origin, weeks_ahead, y, 'moving_average', moving_average FROM made)
        GROUP BY origin, weeks_ahead, model""",
    "error_interval": """
        SELECT model, max(gain) FILTER (replicate = 0) AS improvement,
               list_sort(list(gain) FILTER (replicate > 0))[6] AS low,
               list_sort(list(gain) FILTER (replicate > 0))[195] AS high,
               CAST(count(gain) FILTER (replicate > 0) AS INTEGER) AS replicates
        FROM samples GROUP BY model""",
    "adjusted_effect": """
        SELECT 'is_holiday' AS factor, round((hy * (ee * pp - ep * ep) - he * (ey * pp - ep * py)
                   + hp * (ey * ep - ee * py)) / det, 6) AS effect, n FROM determinant
        UNION ALL
        SELECT 'is_weekend', round((hh * (ey * pp - ep * py) - hy * (he * pp - ep * hp)
                   + hp * (he * py - ey * hp)) / det, 6), n FROM determinant
        UNION ALL
        SELECT 'onpromotion', round((hh * (ee * py - ey * ep) - he * (he * py - ey * hp)
                   + hy * (he * ep - ee * hp)) / det, 6), n FROM determinant""",
    "smoothed_forecast": """
        SELECT store_id, item_id, round(arg_max(size, k), 6) AS demand_size,
               round(arg_max(gap, k), 6) AS demand_interval,
               round(arg_max(size, k) / arg_max(gap, k), 6) AS forecast
        FROM (SELECT DISTINCT store_id, item_id FROM daily_fact) LEFT JOIN smoothed USING (store_id, item_id)
        GROUP BY store_id, item_id""",
    "permutation_importance": """
        SELECT 'lag_1' AS feature, round(e_1, 6) AS mae, round(e_1 - base, 6) AS importance
        FROM swap_errors
        UNION ALL SELECT 'lag_7', round(e_7, 6), round(e_7 - base, 6) FROM swap_errors
        UNION ALL SELECT 'roll_mean_28', round(e_28, 6), round(e_28 - base, 6) FROM swap_errors""",
    "merged_summaries": """
        SELECT family, count(*) AS records, sum(unit_sales) AS units, true AS stores_sound,
               true AS sound
        FROM daily_fact GROUP BY family""",
    "table_fingerprint": """
        SELECT unnest(['fact', 'stored fact']) AS stage, * FROM fact_print
        UNION ALL SELECT unnest(['series', 'stored series']), * FROM series_print""",
    "sales_by_family_month": """
        SELECT family, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               sum(unit_sales) AS units, count(*) AS records,
               count(DISTINCT store_id) AS stores
        FROM daily_fact GROUP BY ALL""",
    "daily_totals": """
        SELECT date, sum(unit_sales) AS units, count(*) AS records FROM daily_fact GROUP BY date""",
    "store_totals": """
        SELECT store_id, sum(unit_sales) AS units, count(*) AS records
        FROM daily_fact GROUP BY store_id""",
}


def _needed(sql: str) -> list[str]:
    """Shared tables a text uses, each after the ones it uses itself."""
    found: list[str] = []
    for name, body in TABLES.items():
        # one that goes on from its own rows is not looked into again
        if body != sql and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            found += [*_needed(body), name]
    return list(dict.fromkeys(found))


def oracle(name: str) -> str:
    tables = ",\n".join(f"{table} AS ({TABLES[table]})" for table in _needed(ORACLES[name]))
    return f"WITH RECURSIVE {tables}\n{ORACLES[name]}" if tables else ORACLES[name]
