"""SQL side of the energy layers."""

import math

from tidegrain.plans.registry import half_even_sql as he
from tidegrain.plans.registry import view

view("v_raw_client", """
SELECT CASE WHEN k % 97 <> 5 THEN 'C' || lpad(CAST(k AS VARCHAR),6,'0') END AS client_id, CASE WHEN k % 53 = 7 THEN NULL ELSE upper(c_name) END AS name,
CASE WHEN k % 2 = 0 THEN c_mktsegment END AS description, CASE WHEN k % 101 = 3 THEN 91.5 ELSE 30.0 + (k * 37 % 1500) / 100.0::DOUBLE END AS latitude,
-10.0 + (k * 53 % 1400) / 100.0::DOUBLE AS longitude, CASE WHEN k % 8 <> 0 THEN 'Europe/Madrid' END AS timezone,
CAST(CASE WHEN k % 5 <> 0 THEN 20 + k % 30 END AS DOUBLE) AS nominal_load_kw, CAST((CASE WHEN k % 89 = 4 THEN 0 ELSE 5 + k % 40 END) + again AS DOUBLE) AS pv_peak_power_kw,
CAST(CASE WHEN k % 71 = 1 THEN -5 ELSE 10 + k % 90 END AS DOUBLE) AS panel_area_m2,
CASE WHEN k % 6 = 0 THEN NULL WHEN k % 13 = 1 THEN 1.7::DOUBLE ELSE 0.15::DOUBLE + (k % 8) / 100.0::DOUBLE END AS efficiency,
CASE WHEN k % 4 = 1 THEN NULL WHEN k % 4 = 2 THEN 'mono' ELSE 'poly' END AS panel_type,
CAST(CASE WHEN k % 17 = 2 THEN 95 WHEN k % 11 = 3 THEN NULL ELSE 10 + k % 8 END AS DOUBLE) AS loss_pct,
CAST(CASE WHEN k % 19 = 3 THEN 150 ELSE 10 + k % 50 END AS DOUBLE) AS angle, CAST(k * 29 % 361 AS DOUBLE) AS aspect, CASE WHEN k % 3 = 1 THEN 'roof' END AS mounting,
CAST(CASE WHEN k % 3 = 0 THEN 0 WHEN k % 31 = 2 THEN -1 ELSE k % 50 END AS DOUBLE) AS battery_capacity_kwh, CAST(CASE WHEN k % 7 <> 0 THEN k % 95 END AS DOUBLE) AS soc_min_pct,
CAST(8000 + k * 3 % 20000 AS DOUBLE) AS installation_cost_eur, again, k
FROM (SELECT *, c_custkey AS k, 0 AS again FROM customer UNION ALL SELECT *, c_custkey AS k, 1 AS again FROM customer WHERE c_custkey % 10 = 0)""")
view("v_clean_client", f"""
SELECT client_id, name, coalesce(description,'unknown') AS description, {he('latitude', 6)} AS latitude, {he('longitude', 6)} AS longitude, coalesce(timezone,'UTC') AS timezone,
coalesce(nominal_load_kw, pv_peak_power_kw * 1.3::DOUBLE) AS nominal_load_kw, pv_peak_power_kw, greatest(panel_area_m2, 0) AS panel_area_m2,
CASE WHEN efficiency IS NULL OR efficiency NOT BETWEEN 0 AND 1 THEN 0.15::DOUBLE ELSE efficiency END AS efficiency, coalesce(panel_type,'unknown') AS panel_type,
CASE WHEN loss_pct BETWEEN 0 AND 90 THEN loss_pct ELSE 14 END AS loss_pct, CASE WHEN angle BETWEEN 0 AND 90 THEN angle ELSE 30 END AS angle,
CASE WHEN aspect BETWEEN 1 AND 360 THEN aspect ELSE 180 END AS aspect, coalesce(mounting,'unknown') AS mounting, greatest(battery_capacity_kwh, 0) AS battery_capacity_kwh,
CASE WHEN soc_min_pct BETWEEN 0 AND 90 THEN soc_min_pct ELSE 20 END AS soc_min_pct, greatest(installation_cost_eur, 0) AS installation_cost_eur
FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY again DESC) AS rn FROM v_raw_client
WHERE client_id IS NOT NULL AND name IS NOT NULL AND latitude BETWEEN -90 AND 90 AND pv_peak_power_kw > 0) WHERE rn = 1""")

view("v_clean_price", f"""
SELECT price_type, CAST(epoch(dt) AS BIGINT) AS unix_time, {he('CASE WHEN v IS NOT NULL THEN v WHEN a IS NOT NULL AND b IS NOT NULL THEN a.v + (b.v - a.v) * (CAST(pos - a.p AS DOUBLE) / (b.p - a.p)) ELSE coalesce(a.v, b.v) END', 4)} AS price_euro_mwh
FROM (SELECT *, last_value(kn IGNORE NULLS) OVER (PARTITION BY price_type ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a,
first_value(kn IGNORE NULLS) OVER (PARTITION BY price_type ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b
FROM (SELECT *, CASE WHEN v IS NOT NULL THEN {{'p': pos, 'v': v}} END AS kn FROM (SELECT price_type, dt, v, row_number() OVER (PARTITION BY price_type ORDER BY dt) AS pos FROM (
SELECT *, row_number() OVER (PARTITION BY price_type, dt ORDER BY ts DESC) AS rn FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'PVPC' ELSE 'SPOT' END AS price_type, date_trunc('hour', ts) AS dt, ts,
CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 50 = 7 THEN 2500.0 ELSE 20.0 + (event_id * 37 % 2000) / 10.0::DOUBLE END::DOUBLE AS v FROM events WHERE event_id % 60 <> 11)
WHERE v IS NULL OR v BETWEEN -100 AND 2000) WHERE rn = 1)))""")

_COND_ID = "CASE event_type WHEN 'click' THEN 800 WHEN 'view' THEN 802 WHEN 'purchase' THEN 500 WHEN 'error' THEN 211 ELSE 804 END"
_COND_MAIN = "CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds' WHEN 'purchase' THEN 'Rain' WHEN 'error' THEN 'Thunderstorm' ELSE 'Clouds' END"
_COND_DESC = "CASE event_type WHEN 'click' THEN 'clear sky' WHEN 'view' THEN 'scattered clouds' WHEN 'purchase' THEN 'light rain' WHEN 'error' THEN 'thunderstorm' ELSE 'overcast clouds' END"


def _entry(pos: int, hours: int, temp: str, pop: str, where: str = "TRUE") -> str:
    return f"""SELECT event_id, ts AS ing, 'C' || lpad(CAST(user_id AS VARCHAR),6,'0') AS client_id, {pos} AS pos, date_trunc('hour', ts) + INTERVAL {hours} HOUR AS t, {temp} AS temp_celsius,
CAST(event_id * 17 % 101 AS DOUBLE) AS humidity_pct, CAST(event_id * 13 % 101 AS DOUBLE) AS clouds_pct, {pop} AS rain_prob_norm, (event_id * 7 % 200) / 10.0::DOUBLE AS wind_speed_mps,
CAST({_COND_ID} AS BIGINT) AS weather_id, {_COND_MAIN} AS weather_main, CASE WHEN event_id % 7 = 0 THEN upper({_COND_DESC}) ELSE {_COND_DESC} END AS weather_description FROM events WHERE {where}"""


_T = "(-5.0::DOUBLE + (event_id * 31 % 450) / 10.0::DOUBLE)"
_P = "(event_id % 101) / 100.0::DOUBLE"
view("v_weather_point", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, t ORDER BY pos DESC) AS rn FROM (" + " UNION ALL ".join([
    _entry(0, 0, f"CASE WHEN event_id % 11 <> 0 THEN {_T} END", _P),
    _entry(1, 3, f"{_T} + 1.0::DOUBLE", f"CASE WHEN event_id % 9 <> 0 THEN {_P} END"),
    _entry(2, 6, f"{_T} + 2.5::DOUBLE", f"CASE WHEN event_id % 13 <> 0 THEN {_P} END"),
    _entry(3, 3, f"{_T} + 4.0::DOUBLE", _P, "event_id % 5 = 0"),
]) + ")) WHERE rn = 1")
_NUM = ["temp_celsius", "humidity_pct", "clouds_pct", "rain_prob_norm", "wind_speed_mps"]


def _line(c: str) -> str:
    hrs = "(epoch({0}) / 3600.0::DOUBLE)"
    share = f"(({hrs.format('slot')} - {hrs.format(c + '_a.t')}) / ({hrs.format(c + '_b.t')} - {hrs.format(c + '_a.t')}))"
    return he(f"CASE WHEN {c}_b IS NULL THEN {c}_a.v ELSE {c}_a.v + ({c}_b.v - {c}_a.v) * {share} END", 3)


view("v_clean_weather", "SELECT client_id, unix_time, " + ", ".join(c if c != "rain_prob_norm" else "coalesce(rain_prob_norm, 0.0) AS rain_prob_norm" for c in _NUM) +
     ", weather_id, weather_main, weather_description, is_daylight, ing FROM (SELECT *, row_number() OVER (PARTITION BY client_id, unix_time ORDER BY ing DESC) AS rn FROM (SELECT client_id, ing, CAST(epoch(slot) AS BIGINT) AS unix_time, "
     + ", ".join(f"{_line(c)} AS {c}" for c in _NUM)
     + ", weather_id, weather_main, weather_description, CAST(CASE WHEN hour(t) BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS BIGINT) AS is_daylight FROM (SELECT *, unnest(generate_series(t, coalesce(nxt - INTERVAL 1 HOUR, t), INTERVAL 1 HOUR)) AS slot FROM (SELECT *, lead(t) OVER (PARTITION BY event_id ORDER BY t) AS nxt, "
     + ", ".join(f"last_value(CASE WHEN {c} IS NOT NULL THEN {{'t': t, 'v': {c}}} END IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}_a, "
                 f"first_value(CASE WHEN {c} IS NOT NULL THEN {{'t': t, 'v': {c}}} END IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS {c}_b" for c in _NUM)
     + " FROM v_weather_point)))) WHERE rn = 1")

_n = "(unix_time / 86400.0::DOUBLE - 10957.5::DOUBLE)"


# Fixed values, stated apart from the library's: share of light by weather condition, weekday base load by hour.
_WEATHER = ("CASE WHEN weather_id < 300 THEN 0.40 WHEN weather_id < 500 THEN 0.85 WHEN weather_id < 600 THEN 0.70 WHEN weather_id < 700 THEN 0.75 "
            "WHEN weather_id < 800 THEN 0.60 WHEN weather_id < 801 THEN 1.00 WHEN weather_id < 803 THEN 0.95 ELSE 0.80 END::DOUBLE")
_LOAD = ("CASE WHEN hour(ft) < 5 THEN 0.10 WHEN hour(ft) < 6 THEN 0.40 WHEN hour(ft) < 9 THEN 0.95 WHEN hour(ft) < 13 THEN 0.85 WHEN hour(ft) < 15 THEN 0.60 "
         "WHEN hour(ft) < 18 THEN 0.90 WHEN hour(ft) < 22 THEN 0.60 ELSE 0.12 END::DOUBLE")


def _s(c: str) -> str:
    return f"sin(radians({c}))"


def _c(c: str) -> str:
    return f"cos(radians({c}))"


view("v_sun", f"""
WITH a AS (SELECT w.*, c.latitude, c.longitude, c.angle, c.aspect, c.loss_pct, c.pv_peak_power_kw, c.nominal_load_kw, {_n} AS n, 357.528::DOUBLE + 0.9856003::DOUBLE * {_n} AS g, (unix_time % 86400) / 3600.0::DOUBLE AS ut
FROM v_clean_weather w JOIN v_clean_client c ON w.client_id = c.client_id),
b AS (SELECT *, 280.460::DOUBLE + 0.9856474::DOUBLE * n + 1.915::DOUBLE * {_s('g')} + 0.020::DOUBLE * {_s('2.0::DOUBLE * g')} AS l, 23.439::DOUBLE - 0.0000004::DOUBLE * n AS e FROM a),
d AS (SELECT *, degrees(asin({_s('e')} * {_s('l')})) AS de, (6.697375::DOUBLE + 0.0657098242::DOUBLE * n + ut) * 15.0::DOUBLE + longitude - degrees(atan2({_c('e')} * {_s('l')}, {_c('l')})) AS ha FROM b)
SELECT *, degrees(asin(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {_s('latitude')} * {_s('de')} + {_c('latitude')} * {_c('de')} * {_c('ha')})))) AS elevation,
(degrees(atan2(-{_s('ha')}, tan(radians(de)) * {_c('latitude')} - {_s('latitude')} * {_c('ha')})) + 360.0::DOUBLE) % 360.0::DOUBLE AS azimuth FROM d""")
_B = f"({2.0 * math.pi / 365.0!r}::DOUBLE * (dayofyear(make_timestamp(unix_time * 1000000)) - 1))"
view("v_irradiance", f"""
WITH g AS (SELECT *, CASE WHEN elevation <= 0 OR weather_id IS NULL THEN 0 ELSE greatest(0.0::DOUBLE, 1098.0::DOUBLE * {_s('elevation')} * exp(-0.057::DOUBLE / greatest(0.001::DOUBLE, {_s('elevation')}))
* (1.0::DOUBLE - 0.75::DOUBLE * ((clouds_pct / 100.0::DOUBLE) * (clouds_pct / 100.0::DOUBLE) * (clouds_pct / 100.0::DOUBLE))) * {_WEATHER}) END AS ghi,
{_s('elevation')} AS s, 1366.1::DOUBLE * (1.00011::DOUBLE + 0.034221::DOUBLE * cos({_B}) + 0.00128::DOUBLE * sin({_B}) + 0.000719::DOUBLE * cos(2.0::DOUBLE * {_B}) + 0.000077::DOUBLE * sin(2.0::DOUBLE * {_B})) AS x FROM v_sun),
k AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ghi / (x * s))) AS k FROM g),
h AS (SELECT *, CASE WHEN ghi <= 0 OR elevation < 2 THEN 0 ELSE greatest(0.0::DOUBLE, ghi * CASE WHEN k <= 0.22 THEN 1.0::DOUBLE - 0.09::DOUBLE * k
WHEN k <= 0.80 THEN 0.9511::DOUBLE - 0.1604::DOUBLE * k + 4.388::DOUBLE * k * k - 16.638::DOUBLE * k * k * k + 12.336::DOUBLE * k * k * k * k ELSE 0.165::DOUBLE END) END AS dhi FROM k),
i AS (SELECT *, CASE WHEN ghi <= 0 OR elevation < 2 THEN 0 ELSE greatest(0.0::DOUBLE, least((ghi - dhi) / s, x)) END AS dni FROM h)
SELECT *, CASE WHEN ghi <= 0 OR elevation < 2 THEN 0 ELSE greatest(0.0::DOUBLE, greatest(0.0::DOUBLE, dni * ({_c('angle')} * {_c('(90.0::DOUBLE - elevation)')} + {_s('angle')} * {_s('(90.0::DOUBLE - elevation)')} * {_c('(azimuth - aspect)')}))
+ dhi * (1.0::DOUBLE + {_c('angle')}) / 2.0::DOUBLE + ghi * 0.2::DOUBLE * (1.0::DOUBLE - {_c('angle')}) / 2.0::DOUBLE) END AS poa FROM i""")
_WD = "((dayofweek(ft) + 6) % 7)"
view("v_calc", f"""
WITH t AS (SELECT *, make_timestamp(unix_time * 1000000) AS ft, CASE WHEN poa <= 0 THEN temp_celsius ELSE temp_celsius + poa / (24.9::DOUBLE + 6.1::DOUBLE * greatest(0.0::DOUBLE, wind_speed_mps)) END AS tc FROM v_irradiance),
r AS (SELECT *, CASE WHEN poa <= 0 THEN 0 ELSE (1.0::DOUBLE + -0.004::DOUBLE * (tc - 25.0::DOUBLE)) * (1.0::DOUBLE - loss_pct / 100.0::DOUBLE) END AS pr FROM t)
SELECT client_id, unix_time, {he('tc', 3)} AS t_cell_celsius, {he('poa', 3)} AS poa_wm2, {he('CASE WHEN poa <= 0 THEN 0 WHEN pr IS NULL THEN 0 ELSE greatest(0.0::DOUBLE, poa / 1000.0::DOUBLE * pv_peak_power_kw * pr) END', 3)} AS pv_power_gen_kw,
{he('pr', 3)} AS pv_performance_ratio, {he(f"CASE WHEN nominal_load_kw * temp_celsius IS NULL AND FALSE THEN NULL ELSE greatest(0.0::DOUBLE, nominal_load_kw * ((CASE WHEN {_WD} < 5 THEN {_LOAD} WHEN {_WD} = 6 THEN 0.10 ELSE 0.20 END)::DOUBLE + (CASE WHEN temp_celsius > 25 THEN (temp_celsius - 25.0::DOUBLE) * 0.02::DOUBLE WHEN temp_celsius < 15 THEN (15.0::DOUBLE - temp_celsius) * 0.01::DOUBLE ELSE 0 END)::DOUBLE)) END", 3)} AS power_con_kw FROM r""")
view("v_dim_client", "SELECT *, CAST(CASE WHEN pv_peak_power_kw > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_solar, CAST(CASE WHEN battery_capacity_kwh > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_battery FROM v_clean_client")
view("v_dim_datetime", """
WITH s AS (SELECT unix_time, max(is_daylight) AS is_daylight, make_timestamp(unix_time * 1000000) AS u, make_timestamp(unix_time * 1000000) + INTERVAL 1 HOUR AS l FROM v_clean_weather GROUP BY 1),
p AS (SELECT *, CASE WHEN dayofweek(l) IN (0, 6) OR strftime(l, '%m-%d') IN ('01-01','01-06','05-01','08-15','10-12','11-01','12-06','12-08','12-25') THEN 'P6'
WHEN hour(l) BETWEEN 10 AND 13 OR hour(l) BETWEEN 18 AND 21 THEN 'P1' WHEN hour(l) BETWEEN 8 AND 9 OR hour(l) BETWEEN 14 AND 17 OR hour(l) BETWEEN 22 AND 23 THEN 'P2' ELSE 'P3' END AS tariff_period FROM s)
SELECT unix_time, strftime(u, '%Y-%m-%d %H:%M:%S') AS datetime_utc, strftime(l, '%Y-%m-%d %H:%M:%S') AS datetime_local, CAST(u AS DATE) AS date, hour(u) AS hour_utc, hour(l) AS hour_local, lower(dayname(l)) AS day_of_week, is_daylight,
CAST(dayofweek(l) IN (0, 6) AS BIGINT) AS is_weekend, CAST(strftime(l, '%m-%d') IN ('01-01','01-06','05-01','08-15','10-12','11-01','12-06','12-08','12-25') AS BIGINT) AS is_festivo, month(l) AS month, year(l) AS year,
tariff_period, CASE tariff_period WHEN 'P1' THEN 'punta' WHEN 'P2' THEN 'llano' WHEN 'P3' THEN 'valle' ELSE 'super-valle' END AS tariff_label FROM p""")
view("v_dim_weather", """
SELECT weather_id, weather_main, weather_description FROM (SELECT weather_id, weather_main, weather_description, row_number() OVER (PARTITION BY weather_id ORDER BY count(*) DESC, weather_main, weather_description) AS rn
FROM v_clean_weather GROUP BY 1, 2, 3) WHERE rn = 1""")
view("v_fact", """
SELECT c.client_id, c.unix_time, c.pv_power_gen_kw, c.pv_performance_ratio, c.poa_wm2, c.t_cell_celsius, c.power_con_kw AS power_consumption_kw, w.temp_celsius, w.humidity_pct, w.clouds_pct, w.rain_prob_norm, w.wind_speed_mps,
w.weather_id, p.price_euro_mwh AS price_pvpc_eur_mwh, CAST(epoch(date_trunc('minute', w.ing + INTERVAL 10 MINUTE)) AS BIGINT) AS _loaded_at_utc
FROM v_calc c LEFT JOIN v_clean_weather w ON w.client_id = c.client_id AND w.unix_time = c.unix_time LEFT JOIN v_clean_price p ON p.unix_time = c.unix_time AND p.price_type = 'PVPC'""")

view("v_star", """
SELECT f.client_id, f.unix_time, f.weather_id, f._loaded_at_utc, d.date, d.datetime_local, d.hour_local, d.tariff_period, d.tariff_label, d.is_daylight, d.month, d.year,
CAST(f.pv_power_gen_kw AS DECIMAL(12,3)) AS gen, CAST(f.power_consumption_kw AS DECIMAL(12,3)) AS con, CAST(f.price_pvpc_eur_mwh AS DECIMAL(12,4)) AS price,
CAST(f.pv_performance_ratio AS DECIMAL(12,3)) AS pr, CAST(f.poa_wm2 AS DECIMAL(12,3)) AS poa, CAST(f.t_cell_celsius AS DECIMAL(12,3)) AS tc, CAST(f.clouds_pct AS DECIMAL(12,3)) AS clouds,
least(CAST(f.pv_power_gen_kw AS DECIMAL(12,3)), CAST(f.power_consumption_kw AS DECIMAL(12,3))) AS own,
greatest(CAST(0 AS DECIMAL(12,3)), CAST(f.power_consumption_kw AS DECIMAL(12,3)) - CAST(f.pv_power_gen_kw AS DECIMAL(12,3))) AS grid,
greatest(CAST(0 AS DECIMAL(12,3)), CAST(f.pv_power_gen_kw AS DECIMAL(12,3)) - CAST(f.power_consumption_kw AS DECIMAL(12,3))) AS spare
FROM v_fact f JOIN v_dim_datetime d ON f.unix_time = d.unix_time""")
