"""Reports on the energy star: balances, best hours, costs, performance, freshness.

Measures are stored with three (prices four) decimals and summed as decimals. Client-level reports
aggregate the fact per client before the client dimension is joined. Reports on a day or month filter the
partition column of the fact, so only those partitions are read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions.numbers import dbl, half_up, max2, mean, mean_of, min2
from tidegrain.plans import energy as E
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job
from tidegrain.sources.tables import Tables

TOMORROW, TODAY, NOW_UNIX = "2024-01-17", "2024-01-16", 1705363200
ONE = "C000001"


def star(t: Tables, slots: Column | None = None) -> DataFrame:
    """Fact with calendar and exact measures; ``slots`` is a predicate on the partition column ``slot_date``."""
    f = E.gold_fact(t)
    if slots is not None:
        f = f.where(slots)
    d = E.gold_dim_datetime(t).select("unix_time", "date", "datetime_local", "hour_local", "tariff_period", "tariff_label", "is_daylight", "month", "year")

    def dec(c: str, scale: int = 3) -> Column:
        return F.col(c).cast(f"decimal(12,{scale})")

    gen, con, zero = dec("pv_power_gen_kw"), dec("power_consumption_kw"), F.lit(0).cast("decimal(12,3)")
    return f.join(d, "unix_time").select(
        "client_id", "unix_time", "weather_id", "_loaded_at_utc", "date", "datetime_local", "hour_local", "tariff_period", "tariff_label", "is_daylight", "month", "year",
        gen.alias("gen"), con.alias("con"), dec("price_pvpc_eur_mwh", 4).alias("price"), dec("pv_performance_ratio").alias("pr"), dec("poa_wm2").alias("poa"),
        dec("t_cell_celsius").alias("tc"), dec("clouds_pct").alias("clouds"), min2(gen, con).alias("own"), max2(zero, con - gen).alias("grid"), max2(zero, gen - con).alias("spare"))


def on_day(day: str) -> Column:
    return F.col("slot_date") == F.lit(day).cast("date")


def last_days(today: str, days: int) -> Column:
    d = F.lit(today).cast("date")
    return F.col("slot_date").between(F.date_sub(d, days), d)


def eur(energy: str) -> Column:
    """Exact sum of kW x EUR/MWh, in EUR (rows without price do not count)."""
    return F.sum(F.col(energy) * F.col("price")).cast("double") / F.lit(1000.0)




def _r(c: Column | str, n: int = 2) -> Column:
    return half_up(F.col(c) if isinstance(c, str) else c, n)


def _clients(t: Tables, *cols: str) -> DataFrame:
    return E.gold_dim_client(t).select("client_id", *cols)


def _eur_sql(e: str) -> str:
    return f"CAST(sum({e} * price) AS DOUBLE) / 1000.0"


_MON = "CAST(sum({0}) AS DOUBLE)"


@job("balance_by_tariff", """SELECT s.tariff_label, c.has_battery, CAST(sum(gen) AS DOUBLE) / count(*) AS mean_gen_kw, CAST(sum(con) AS DOUBLE) / count(*) AS mean_con_kw,
CAST(sum(gen - con) AS DOUBLE) / count(*) AS mean_balance_kw FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id GROUP BY 1, 2""")
def balance_by_tariff(t: Tables) -> DataFrame:
    per = star(t).groupBy("client_id", "tariff_label").agg(F.sum("gen").alias("g"), F.sum("con").alias("c"), F.sum(F.col("gen") - F.col("con")).alias("b"), F.count(F.lit(1)).alias("n"))
    n = F.sum("n")
    return per.join(_clients(t, "has_battery"), "client_id").groupBy("tariff_label", "has_battery").agg(
        mean(F.sum("g"), n).alias("mean_gen_kw"), mean(F.sum("c"), n).alias("mean_con_kw"), mean(F.sum("b"), n).alias("mean_balance_kw"))


@job("hourly_balance", f"""SELECT c.name AS installation, s.datetime_local AS local_time, s.hour_local AS hour, s.tariff_label AS tariff, {h('gen')} AS gen_kw, {h('con')} AS con_kw, {h('gen - con')} AS balance_kw,
CASE WHEN gen > con THEN '⚡ Excedente' WHEN gen < con THEN '🔌 Déficit' ELSE '⚖️ Equilibrio' END AS state, {h('price')} AS price_eur_mwh
FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id WHERE s.date = DATE '2024-01-17'""")
def hourly_balance(t: Tables) -> DataFrame:
    """Hour by hour balance of the next day, every installation."""
    gen, con = F.col("gen"), F.col("con")
    return star(t, on_day(TOMORROW)).join(_clients(t, "name"), "client_id").select(
        F.col("name").alias("installation"), F.col("datetime_local").alias("local_time"), F.col("hour_local").alias("hour"), F.col("tariff_label").alias("tariff"),
        _r("gen").alias("gen_kw"), _r("con").alias("con_kw"), _r(gen - con).alias("balance_kw"),
        F.when(gen > con, "⚡ Excedente").when(gen < con, "🔌 Déficit").otherwise("⚖️ Equilibrio").alias("state"), _r("price").alias("price_eur_mwh"))


@job("best_hours", f"""SELECT datetime_local AS local_time, tariff_label AS tariff, {h('gen')} AS gen_kw, {h('con')} AS base_con_kw, {h('price')} AS price_eur_mwh, {h('CAST(grid * price AS DOUBLE) / 1000.0', 4)} AS net_cost_eur_h,
CASE WHEN gen > con AND tariff_period IN ('P3','P6') THEN '🟢 Óptimo' WHEN gen > con THEN '🟡 Bueno' WHEN tariff_period IN ('P3','P6') THEN '🟡 Bueno (tarifa baja)' ELSE '🔴 Evitar' END AS recommendation
FROM v_star WHERE unix_time BETWEEN 1705363200 AND 1705449600 AND price IS NOT NULL AND client_id = 'C000001' ORDER BY net_cost_eur_h, gen DESC, unix_time LIMIT 10""")
def best_hours(t: Tables, client: str = ONE) -> DataFrame:
    """Ten cheapest hours of the next day to start machines."""
    gen, con, low = F.col("gen"), F.col("con"), F.col("tariff_period").isin("P3", "P6")
    rows = star(t, F.col("slot_date").between(TODAY, TOMORROW)).where(F.col("unix_time").between(NOW_UNIX, NOW_UNIX + 86400) & F.col("price").isNotNull() & (F.col("client_id") == client))
    advice = F.when((gen > con) & low, "🟢 Óptimo").when(gen > con, "🟡 Bueno").when(low, "🟡 Bueno (tarifa baja)").otherwise("🔴 Evitar")
    out = rows.select(F.col("datetime_local").alias("local_time"), F.col("tariff_label").alias("tariff"), _r("gen").alias("gen_kw"), _r("con").alias("base_con_kw"), _r("price").alias("price_eur_mwh"),
                      _r(dbl(F.col("grid") * F.col("price")) / F.lit(1000.0), 4).alias("net_cost_eur_h"), advice.alias("recommendation"), "gen", "unix_time")
    return out.orderBy("net_cost_eur_h", F.col("gen").desc(), "unix_time").limit(10).drop("gen", "unix_time")


@job("charge_windows", f"""SELECT s.client_id, date, datetime_local AS local_time, tariff_label AS tariff, {h('gen')} AS gen_kw, {h('con')} AS con_kw, {h('gen - con')} AS spare_kw, {h('price')} AS price_eur_mwh,
{h('CAST(spare * price AS DOUBLE) / 1000.0', 4)} AS spare_value_eur FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id
WHERE unix_time >= 1705363200 AND gen > con AND tariff_period IN ('P3','P6') AND has_battery = 1""")
def charge_windows(t: Tables) -> DataFrame:
    """Surplus hours in cheap periods for installations with a battery."""
    rows = star(t, F.col("slot_date") >= TODAY).where(F.col("gen") > F.col("con")).where(F.col("tariff_period").isin("P3", "P6"))
    return rows.join(_clients(t, "has_battery").where("has_battery = 1"), "client_id", "left_semi").select(
        "client_id", "date", F.col("datetime_local").alias("local_time"), F.col("tariff_label").alias("tariff"), _r("gen").alias("gen_kw"), _r("con").alias("con_kw"),
        _r(F.col("gen") - F.col("con")).alias("spare_kw"), _r("price").alias("price_eur_mwh"), _r(dbl(F.col("spare") * F.col("price")) / F.lit(1000.0), 4).alias("spare_value_eur"))


_PR = "CAST(sum(CASE WHEN gen > 0 THEN pr END) AS DOUBLE) / nullif(count(CASE WHEN gen > 0 THEN pr END), 0)"


def _pr_mean() -> Column:
    return F.try_divide(dbl(F.sum(F.when(F.col("gen") > 0, F.col("pr")))), dbl(F.count(F.when(F.col("gen") > 0, F.col("pr")))))


def _pct(a: Column, b: Column, n: int = 1) -> Column:
    return half_up(F.lit(100.0) * dbl(a) / F.nullif(dbl(b), F.lit(0.0)), n)


def _pct_sql(a: str, b: str, n: int = 1) -> str:
    return h(f"100.0 * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", n)


@job("daily_kpis", f"""SELECT s.date, c.client_id, c.name AS installation, c.pv_peak_power_kw AS peak_kwp, {h('sum(gen)')} AS kwh_generated, {h(_PR, 3)} AS mean_pr,
{h('CAST(sum(gen) AS DOUBLE) / c.pv_peak_power_kw')} AS sun_hours, {h('sum(con)')} AS kwh_consumed, {h('sum(gen) - sum(con)')} AS balance_kwh, {_pct_sql('sum(own)', 'sum(con)')} AS self_supply_pct,
{h(_eur_sql('con'), 4)} AS cost_without_pv_eur, {h(_eur_sql('grid'), 4)} AS real_cost_eur, {h(_eur_sql('own'), 4)} AS pv_saving_eur
FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id WHERE s.date = DATE '2024-01-17' GROUP BY 1, 2, 3, 4""")
def daily_kpis(t: Tables) -> DataFrame:
    """Indicators per installation for the next day; sums before ratios."""
    per = star(t, on_day(TOMORROW)).groupBy("date", "client_id").agg(
        F.sum("gen").alias("g"), F.sum("con").alias("c"), F.sum("own").alias("o"), _pr_mean().alias("pr"), eur("con").alias("e0"), eur("grid").alias("e1"), eur("own").alias("e2"))
    return per.join(_clients(t, "name", "pv_peak_power_kw"), "client_id").select(
        "date", "client_id", F.col("name").alias("installation"), F.col("pv_peak_power_kw").alias("peak_kwp"), _r("g").alias("kwh_generated"), _r("pr", 3).alias("mean_pr"),
        _r(dbl("g") / F.col("pv_peak_power_kw")).alias("sun_hours"), _r("c").alias("kwh_consumed"), _r(F.col("g") - F.col("c")).alias("balance_kwh"), _pct(F.col("o"), F.col("c")).alias("self_supply_pct"),
        _r("e0", 4).alias("cost_without_pv_eur"), _r("e1", 4).alias("real_cost_eur"), _r("e2", 4).alias("pv_saving_eur"))


@job("yield_by_weather", f"""SELECT w.weather_main AS condition, w.weather_description AS description, count(*) AS slots, {h('CAST(sum(clouds) AS DOUBLE) / count(clouds)', 1)} AS mean_clouds_pct,
{h('CAST(sum(poa) AS DOUBLE) / count(poa)', 1)} AS mean_poa, {h('CAST(sum(gen) AS DOUBLE) / count(gen)', 3)} AS mean_gen_kw, {h('max(gen)', 3)} AS max_gen_kw, {h(_PR, 3)} AS mean_pr
FROM v_star s JOIN v_dim_weather w ON s.weather_id = w.weather_id WHERE s.is_daylight = 1 GROUP BY 1, 2""")
def yield_by_weather(t: Tables) -> DataFrame:
    """Output by weather condition in daylight; the fact is reduced to weather ids before the labels are joined."""
    day = star(t).where("is_daylight = 1").groupBy("weather_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("clouds").alias("cs"), F.count("clouds").alias("cn"), F.sum("poa").alias("ps"), F.count("poa").alias("pn"), F.sum("gen").alias("gs"), F.count("gen").alias("gn"),
        F.max("gen").alias("gm"), F.sum(F.when(F.col("gen") > 0, F.col("pr"))).alias("rs"), F.count(F.when(F.col("gen") > 0, F.col("pr"))).alias("rn"))
    g = day.join(E.gold_dim_weather(t), "weather_id").groupBy(F.col("weather_main").alias("condition"), F.col("weather_description").alias("description"))
    return g.agg(F.sum("n").alias("slots"), _r(mean(F.sum("cs"), F.sum("cn")), 1).alias("mean_clouds_pct"), _r(mean(F.sum("ps"), F.sum("pn")), 1).alias("mean_poa"),
                 _r(mean(F.sum("gs"), F.sum("gn")), 3).alias("mean_gen_kw"), _r(F.max("gm"), 3).alias("max_gen_kw"),
                 _r(F.try_divide(dbl(F.sum("rs")), dbl(F.sum("rn"))), 3).alias("mean_pr"))


@job("cost_by_tariff", f"""SELECT tariff_period, tariff_label, count(*) AS slots, {h('CAST(sum(price) AS DOUBLE) / count(price)')} AS mean_price_eur_mwh, {h('sum(con)')} AS kwh_consumed, {h('sum(gen)')} AS kwh_generated,
{h(_eur_sql('con'), 4)} AS gross_cost_eur, {h(_eur_sql('grid'), 4)} AS net_cost_eur, {_pct_sql('sum(grid * price)', 'sum(con * price)')} AS share_of_gross_pct
FROM v_star WHERE price IS NOT NULL AND date = DATE '2024-01-17' GROUP BY 1, 2""")
def cost_by_tariff(t: Tables) -> DataFrame:
    """Cost of the next day by tariff period."""
    grid, con = F.sum(F.col("grid") * F.col("price")), F.sum(F.col("con") * F.col("price"))
    return star(t, on_day(TOMORROW)).where("price IS NOT NULL").groupBy("tariff_period", "tariff_label").agg(
        F.count(F.lit(1)).alias("slots"), _r(mean_of("price")).alias("mean_price_eur_mwh"), _r(F.sum("con")).alias("kwh_consumed"), _r(F.sum("gen")).alias("kwh_generated"),
        _r(eur("con"), 4).alias("gross_cost_eur"), _r(eur("grid"), 4).alias("net_cost_eur"), _pct(grid, con).alias("share_of_gross_pct"))


@job("period_summary", f"""WITH p AS (SELECT s.client_id, c.name, tariff_period, tariff_label, sum(gen) AS g, sum(con) AS k, CAST(sum(price) AS DOUBLE) / count(price) AS pm FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id
WHERE s.date = DATE '2024-01-17' GROUP BY 1, 2, 3, 4)
SELECT client_id, name, tariff_period, tariff_label, CAST(g AS DOUBLE) AS gen_kwh, CAST(k AS DOUBLE) AS con_kwh, pm AS mean_price, {h('g - k')} AS balance_kwh, {h('CAST(k AS DOUBLE) / 1000.0 * pm', 4)} AS gross_cost_eur,
{h('CAST(CASE WHEN k > g THEN k - g ELSE 0 END AS DOUBLE) / 1000.0 * pm', 4)} AS net_cost_eur FROM p""")
def period_summary(t: Tables) -> DataFrame:
    """Per client and tariff period of the next day."""
    p = star(t, on_day(TOMORROW)).groupBy("client_id", "tariff_period", "tariff_label").agg(F.sum("gen").alias("g"), F.sum("con").alias("k"), mean(F.sum("price"), F.nullif(F.count("price"), F.lit(0))).alias("pm"))
    g, k, pm = F.col("g"), F.col("k"), F.col("pm")
    zero = F.lit(0).cast("decimal(12,3)")
    return p.join(_clients(t, "name"), "client_id").select(
        "client_id", "name", "tariff_period", "tariff_label", dbl(g).alias("gen_kwh"), dbl(k).alias("con_kwh"), pm.alias("mean_price"), _r(g - k).alias("balance_kwh"),
        _r(dbl(k) / F.lit(1000.0) * pm, 4).alias("gross_cost_eur"), _r(dbl(max2(zero, k - g)) / F.lit(1000.0) * pm, 4).alias("net_cost_eur"))


@job("kpis", f"""WITH d AS (SELECT client_id, date, sum(gen) AS g, sum(con) AS k, sum(own) AS o, {_PR} AS pr, CAST(sum(CASE WHEN gen > 0 THEN tc END) AS DOUBLE) / nullif(count(CASE WHEN gen > 0 THEN tc END), 0) AS tc,
sum(con * price) AS e0, sum(grid * price) AS e1, sum(own * price) AS e2 FROM v_star GROUP BY 1, 2)
SELECT d.client_id, d.date, {h('g - k')} AS net_balance_kwh, {_pct_sql('o', 'g')} AS self_use_pct, {_pct_sql('o', 'k')} AS self_supply_pct, {h('pr', 3)} AS mean_pr, {h('100.0 * CAST(g AS DOUBLE) / (c.pv_peak_power_kw * 24.0)')} AS capacity_factor_pct,
{h('CAST(g AS DOUBLE) / c.pv_peak_power_kw')} AS sun_hours, {h('tc', 1)} AS mean_cell_temp, {h('CAST(e0 AS DOUBLE) / 1000.0', 4)} AS cost_without_pv_eur, {h('CAST(e1 AS DOUBLE) / 1000.0', 4)} AS real_cost_eur,
{h('CAST(e0 - e1 AS DOUBLE) / 1000.0', 4)} AS daily_saving_eur FROM d JOIN v_dim_client c ON d.client_id = c.client_id""")
def kpis(t: Tables) -> DataFrame:
    """Derived indicators per installation and day."""
    hot = F.when(F.col("gen") > 0, F.col("tc"))
    d = star(t).groupBy("client_id", "date").agg(
        F.sum("gen").alias("g"), F.sum("con").alias("k"), F.sum("own").alias("o"), _pr_mean().alias("pr"), F.try_divide(dbl(F.sum(hot)), dbl(F.count(hot))).alias("tcm"),
        F.sum(F.col("con") * F.col("price")).alias("e0"), F.sum(F.col("grid") * F.col("price")).alias("e1"))
    peak, k1 = F.col("pv_peak_power_kw"), F.lit(1000.0)
    return d.join(_clients(t, "pv_peak_power_kw"), "client_id").select(
        "client_id", "date", _r(F.col("g") - F.col("k")).alias("net_balance_kwh"), _pct(F.col("o"), F.col("g")).alias("self_use_pct"), _pct(F.col("o"), F.col("k")).alias("self_supply_pct"), _r("pr", 3).alias("mean_pr"),
        _r(F.lit(100.0) * dbl("g") / (peak * F.lit(24.0))).alias("capacity_factor_pct"), _r(dbl("g") / peak).alias("sun_hours"), _r("tcm", 1).alias("mean_cell_temp"),
        _r(dbl("e0") / k1, 4).alias("cost_without_pv_eur"), _r(dbl("e1") / k1, 4).alias("real_cost_eur"), _r(dbl(F.col("e0") - F.col("e1")) / k1, 4).alias("daily_saving_eur"))


@job("payback", f"""WITH d AS (SELECT client_id, date, sum(own * price) AS e FROM v_star GROUP BY 1, 2), y AS (SELECT client_id, CAST(sum(e) AS DOUBLE) / 1000.0 / count(e) * 365.0 AS a FROM d GROUP BY 1)
SELECT y.client_id, {h('a')} AS annual_saving_eur, {h('c.installation_cost_eur / nullif(a, 0)', 1)} AS payback_years FROM y JOIN v_dim_client c ON y.client_id = c.client_id""")
def payback(t: Tables) -> DataFrame:
    """Projected annual saving and payback from the mean day."""
    d = star(t).groupBy("client_id", "date").agg(F.sum(F.col("own") * F.col("price")).alias("e"))
    y = d.groupBy("client_id").agg((dbl(F.sum("e")) / F.lit(1000.0) / F.nullif(dbl(F.count("e")), F.lit(0.0)) * F.lit(365.0)).alias("a"))
    return y.join(_clients(t, "installation_cost_eur"), "client_id").select(
        "client_id", _r("a").alias("annual_saving_eur"), _r(F.col("installation_cost_eur") / F.nullif(F.col("a"), F.lit(0.0)), 1).alias("payback_years"))


@job("weekly_performance", f"""WITH g AS (SELECT s.year, CAST(strftime(s.date, '%W') AS BIGINT) AS week, client_id, sum(gen) AS g, {_PR} AS pr, min(CASE WHEN gen > 0 THEN pr END) AS prmin,
CAST(sum(CASE WHEN gen > 0 THEN poa END) AS DOUBLE) / nullif(count(CASE WHEN gen > 0 THEN poa END), 0) AS poa, CAST(sum(CASE WHEN gen > 0 THEN tc END) AS DOUBLE) / nullif(count(CASE WHEN gen > 0 THEN tc END), 0) AS tc,
CAST(sum(clouds) AS DOUBLE) / count(clouds) AS cl FROM v_star s WHERE date BETWEEN DATE '2023-12-19' AND DATE '2024-01-16' AND is_daylight = 1 GROUP BY 1, 2, 3)
SELECT g.year, week, g.client_id, c.name AS installation, c.pv_peak_power_kw AS peak_kwp, c.panel_type, {h('g', 1)} AS kwh_generated, {h('CAST(g AS DOUBLE) / c.pv_peak_power_kw')} AS sun_hours, {h('pr', 3)} AS mean_pr, {h('prmin', 3)} AS min_pr,
{h('poa', 1)} AS mean_poa, {h('tc', 1)} AS mean_cell_temp, {h('cl', 1)} AS mean_clouds_pct, CASE WHEN pr >= 0.80 THEN '🟢 Óptimo' WHEN pr >= 0.70 THEN '🟡 Aceptable' ELSE '🔴 Revisar' END AS state FROM g JOIN v_dim_client c ON g.client_id = c.client_id""")
def weekly_performance(t: Tables) -> DataFrame:
    """Weekly output and efficiency of the last 28 days with a traffic light."""
    on = F.col("gen") > 0

    def avg_on(c: str) -> Column:
        return F.try_divide(dbl(F.sum(F.when(on, F.col(c)))), dbl(F.count(F.when(on, F.col(c)))))

    g = star(t, last_days(TODAY, 28)).where("is_daylight = 1").groupBy("year", D.week_monday(F.col("date")).alias("week"), "client_id").agg(
        F.sum("gen").alias("g"), _pr_mean().alias("p"), F.min(F.when(on, F.col("pr"))).alias("pmin"), avg_on("poa").alias("po"), avg_on("tc").alias("ce"), mean_of("clouds").alias("cl"))
    light = F.when(F.col("p") >= 0.80, "🟢 Óptimo").when(F.col("p") >= 0.70, "🟡 Aceptable").otherwise("🔴 Revisar")
    return g.join(_clients(t, "name", "pv_peak_power_kw", "panel_type"), "client_id").select(
        "year", "week", "client_id", F.col("name").alias("installation"), F.col("pv_peak_power_kw").alias("peak_kwp"), "panel_type", _r("g", 1).alias("kwh_generated"),
        _r(dbl("g") / F.col("pv_peak_power_kw")).alias("sun_hours"), _r("p", 3).alias("mean_pr"), _r("pmin", 3).alias("min_pr"), _r("po", 1).alias("mean_poa"), _r("ce", 1).alias("mean_cell_temp"),
        _r("cl", 1).alias("mean_clouds_pct"), light.alias("state"))


_MONTH = "sum(gen) AS g, sum(con) AS k, sum(own) AS o, sum(spare) AS sp, sum(con * price) AS e0, sum(grid * price) AS e1, sum(own * price) AS e2, sum(CASE WHEN price IS NOT NULL THEN grid END) AS gp"


def _month_sums():
    p = F.col("price")
    return [F.sum("gen").alias("g"), F.sum("con").alias("k"), F.sum("own").alias("o"), F.sum("spare").alias("sp"), F.sum(F.col("con") * p).alias("e0"), F.sum(F.col("grid") * p).alias("e1"),
            F.sum(F.col("own") * p).alias("e2"), F.sum(F.when(p.isNotNull(), F.col("grid"))).alias("gp"), _pr_mean().alias("p")]


@job("monthly_economics", f"""WITH m AS (SELECT year, month, client_id, {_MONTH} FROM v_star WHERE date BETWEEN DATE '2023-10-18' AND DATE '2024-01-16' GROUP BY 1, 2, 3)
SELECT year, month, m.client_id, c.name AS installation, c.pv_peak_power_kw, c.installation_cost_eur, {h('g', 1)} AS kwh_generated, {h('k', 1)} AS kwh_consumed, {h('o', 1)} AS kwh_self_used, {h('sp', 1)} AS kwh_spare,
{_pct_sql('o', 'k')} AS self_supply_pct, {_pct_sql('o', 'g')} AS self_use_pct, {h('CAST(e0 AS DOUBLE) / 1000.0')} AS cost_without_pv_eur, {h('CAST(e1 AS DOUBLE) / 1000.0')} AS real_cost_eur, {h('CAST(e2 AS DOUBLE) / 1000.0')} AS pv_saving_eur,
{h('CAST(e1 AS DOUBLE) / nullif(CAST(gp AS DOUBLE), 0) / 1000', 2)} AS weighted_price FROM m JOIN v_dim_client c ON m.client_id = c.client_id""")
def monthly_economics(t: Tables) -> DataFrame:
    """Energy, rates, cost and saving per client and month of the last 90 days."""
    m = star(t, last_days(TODAY, 90)).groupBy("year", "month", "client_id").agg(*_month_sums())
    k1 = F.lit(1000.0)
    return m.join(_clients(t, "name", "pv_peak_power_kw", "installation_cost_eur"), "client_id").select(
        "year", "month", "client_id", F.col("name").alias("installation"), "pv_peak_power_kw", "installation_cost_eur", _r("g", 1).alias("kwh_generated"), _r("k", 1).alias("kwh_consumed"),
        _r("o", 1).alias("kwh_self_used"), _r("sp", 1).alias("kwh_spare"), _pct(F.col("o"), F.col("k")).alias("self_supply_pct"), _pct(F.col("o"), F.col("g")).alias("self_use_pct"),
        _r(dbl("e0") / k1).alias("cost_without_pv_eur"), _r(dbl("e1") / k1).alias("real_cost_eur"), _r(dbl("e2") / k1).alias("pv_saving_eur"),
        _r(dbl("e1") / F.nullif(dbl("gp"), F.lit(0.0)) / F.lit(1000)).alias("weighted_price"))


@job("vs_clear_sky", f"""SELECT w.weather_main AS condition, w.weather_description AS description, count(*) AS day_slots, {h('CAST(sum(poa) AS DOUBLE) / count(poa)', 0)} AS mean_poa, {h('CAST(sum(gen) AS DOUBLE) / count(*)')} AS mean_gen_kw,
{h('CAST(sum(clouds) AS DOUBLE) / count(clouds)', 0)} AS mean_clouds_pct, {h('CAST(sum(gen - con) AS DOUBLE) / count(*)')} AS mean_balance_kw, {h('CAST(sum(grid * price) AS DOUBLE) / 1000.0 / count(price)', 4)} AS mean_net_cost_eur_h,
{h("100.0 * (CAST(sum(gen) AS DOUBLE) / count(*)) / nullif((SELECT CAST(sum(gen) AS DOUBLE) / count(*) FROM v_star s2 JOIN v_dim_weather w2 ON s2.weather_id = w2.weather_id WHERE s2.is_daylight = 1 AND w2.weather_main = 'Clear'), 0)", 0)} AS pct_of_clear_sky
FROM v_star s JOIN v_dim_weather w ON s.weather_id = w.weather_id WHERE s.is_daylight = 1 AND s.client_id = 'C000001' GROUP BY 1, 2""")
def vs_clear_sky(t: Tables, client: str = ONE) -> DataFrame:
    """One installation's output by condition against the fleet under a clear sky (scalar over three tables)."""
    day = star(t).where("is_daylight = 1")
    clear_ids = E.gold_dim_weather(t).where("weather_main = 'Clear'").select("weather_id")
    clear = day.join(clear_ids, "weather_id", "left_semi").agg(mean_of("gen")).scalar()
    g = day.where(F.col("client_id") == client).join(E.gold_dim_weather(t), "weather_id").groupBy(F.col("weather_main").alias("condition"), F.col("weather_description").alias("description")).agg(
        F.count(F.lit(1)).alias("day_slots"), _r(mean_of("poa"), 0).alias("mean_poa"), mean_of("gen").alias("mg"), _r(mean_of("clouds"), 0).alias("mean_clouds_pct"),
        _r(mean(F.sum(F.col("gen") - F.col("con")), F.count(F.lit(1)))).alias("mean_balance_kw"),
        _r(eur("grid") / F.nullif(dbl(F.count("price")), F.lit(0.0)), 4).alias("mean_net_cost_eur_h"))
    return g.select("condition", "description", "day_slots", "mean_poa", _r("mg").alias("mean_gen_kw"), "mean_clouds_pct", "mean_balance_kw", "mean_net_cost_eur_h",
                    _r(F.lit(100.0) * F.col("mg") / F.nullif(clear, F.lit(0.0)), 0).alias("pct_of_clear_sky"))


@job("executive_month", f"""WITH m AS (SELECT client_id, {_MONTH}, {_PR} AS p FROM v_star WHERE year = 2024 AND month = 1 GROUP BY 1)
SELECT c.name AS installation, {h('g', 0)} AS kwh_generated, {h('k', 0)} AS kwh_consumed, {_pct_sql('o', 'k')} AS self_supply_pct, {h('CAST(e2 AS DOUBLE) / 1000.0', 0)} AS pv_saving_eur, {h('CAST(e1 AS DOUBLE) / 1000.0', 0)} AS grid_cost_eur,
{h('p', 3)} AS performance_ratio, {h('CAST(g AS DOUBLE) / c.pv_peak_power_kw / 30.0')} AS sun_hours_day, {h('c.installation_cost_eur / nullif(CAST(e2 AS DOUBLE) / 1000.0 * 12, 0)', 1)} AS payback_years,
CASE WHEN c.has_battery = 1 THEN '🔋 Con batería' ELSE '— Sin batería' END AS storage FROM m JOIN v_dim_client c ON m.client_id = c.client_id""")
def executive_month(t: Tables) -> DataFrame:
    """Month report for management (``executive_ranking`` adds the rank of saving)."""
    m = star(t, F.col("slot_date").between("2023-12-31", "2024-02-01")).where("year = 2024 AND month = 1").groupBy("client_id").agg(*_month_sums())
    k1 = F.lit(1000.0)
    return m.join(_clients(t, "name", "pv_peak_power_kw", "installation_cost_eur", "has_battery"), "client_id").select(
        F.col("name").alias("installation"), _r("g", 0).alias("kwh_generated"), _r("k", 0).alias("kwh_consumed"), _pct(F.col("o"), F.col("k")).alias("self_supply_pct"), _r(dbl("e2") / k1, 0).alias("pv_saving_eur"),
        _r(dbl("e1") / k1, 0).alias("grid_cost_eur"), _r("p", 3).alias("performance_ratio"), _r(dbl("g") / F.col("pv_peak_power_kw") / F.lit(30.0)).alias("sun_hours_day"),
        _r(F.col("installation_cost_eur") / F.nullif(dbl("e2") / k1 * F.lit(12), F.lit(0.0)), 1).alias("payback_years"),
        F.when(F.col("has_battery") == 1, "🔋 Con batería").otherwise("— Sin batería").alias("storage"))


@job("executive_ranking", f"""WITH m AS (SELECT client_id, sum(own * price) AS e FROM v_star WHERE year = 2024 AND month = 1 GROUP BY 1), r AS (SELECT *, rank() OVER (ORDER BY e DESC) AS saving_rank FROM m)
SELECT client_id, {h('CAST(e AS DOUBLE) / 1000.0')} AS pv_saving_eur, saving_rank FROM r WHERE e IS NOT NULL""")
def executive_ranking(t: Tables) -> DataFrame:
    """Rank of every installation by saving, ties sharing a rank.

    The fleet is numbered by a range-partitioned sort; the rank of a value is its smallest number.
    """
    from tidegrain.operators.ranking import global_row_number, with_group_stats

    m = star(t, F.col("slot_date").between("2023-12-31", "2024-02-01")).where("year = 2024 AND month = 1").groupBy("client_id").agg(F.sum(F.col("own") * F.col("price")).alias("e"))
    numbered = global_row_number(m.where("e IS NOT NULL"), [F.col("e").desc(), F.col("client_id")], "no")
    return with_group_stats(numbered, ["e"], saving_rank=F.min("no")).select("client_id", _r(dbl("e") / F.lit(1000.0)).alias("pv_saving_eur"), "saving_rank")


@job("month_report", f"""SELECT s.date, c.name AS installation, s.tariff_label, CAST(sum(gen) AS DOUBLE) AS kwh_gen, CAST(sum(con) AS DOUBLE) AS kwh_con, CAST(sum(price) AS DOUBLE) / nullif(count(price), 0) AS mean_price_eur_mwh
FROM v_star s JOIN v_dim_client c ON s.client_id = c.client_id WHERE s.date >= DATE '2024-01-01' GROUP BY 1, 2, 3""")
def month_report(t: Tables) -> DataFrame:
    per = star(t, F.col("slot_date") >= "2024-01-01").groupBy("date", "client_id", "tariff_label").agg(F.sum("gen").alias("g"), F.sum("con").alias("k"), F.sum("price").alias("ps"), F.count("price").alias("pn"))
    g = per.join(_clients(t, "name"), "client_id").groupBy("date", F.col("name").alias("installation"), "tariff_label")
    return g.agg(dbl(F.sum("g")).alias("kwh_gen"), dbl(F.sum("k")).alias("kwh_con"), F.try_divide(dbl(F.sum("ps")), dbl(F.sum("pn"))).alias("mean_price_eur_mwh"))


FRESH_NOW = 1706745600  # 2024-02-01 00:00 UTC


def _freshness(seconds: Column, good: int, labels: tuple[str, str, str]) -> Column:
    return F.when(seconds < good, labels[0]).when(seconds < 86400, labels[1]).otherwise(labels[2])


@job("freshness", f"""SELECT c.name AS installation, max(_loaded_at_utc) AS last_load_unix, {h('(1706745600 - max(_loaded_at_utc)) / 3600.0', 1)} AS hours_since_load,
CASE WHEN 1706745600 - max(_loaded_at_utc) < 3600 THEN '🟢 Muy fresco (< 1h)' WHEN 1706745600 - max(_loaded_at_utc) < 86400 THEN '🟡 Fresco (< 24h)' ELSE '🔴 Desactualizado' END AS state
FROM v_fact f JOIN v_dim_client c ON f.client_id = c.client_id GROUP BY c.name""")
def freshness(t: Tables) -> DataFrame:
    per = E.gold_fact(t).groupBy("client_id").agg(F.max("_loaded_at_utc").alias("m"))
    g = per.join(_clients(t, "name"), "client_id").groupBy(F.col("name").alias("installation")).agg(D.epoch(F.max("m")).alias("last_load_unix"))
    age = F.lit(FRESH_NOW) - F.col("last_load_unix")
    return g.select("installation", "last_load_unix", _r(age / F.lit(3600.0), 1).alias("hours_since_load"), _freshness(age, 3600, ("🟢 Muy fresco (< 1h)", "🟡 Fresco (< 24h)", "🔴 Desactualizado")).alias("state"))


@job("cycle_cost", f"""SELECT hour_local, tariff_label, CAST(price AS DOUBLE) AS price_eur_mwh, {h('gen', 1)} AS gen_kw, {h('CAST(greatest(CAST(0 AS DECIMAL(12,3)), CAST(18 AS DECIMAL(12,3)) - gen) * price AS DOUBLE) / 1000.0 * 2')} AS cycle_cost_eur
FROM v_star WHERE date = DATE '2024-01-17' AND client_id = 'C000001' ORDER BY cycle_cost_eur NULLS FIRST, unix_time LIMIT 8""")
def cycle_cost(t: Tables, client: str = ONE, load_kw: int = 18) -> DataFrame:
    """Eight cheapest hours for a two-hour cycle of a deferrable load."""
    zero = F.lit(0).cast("decimal(12,3)")
    need = max2(zero, F.lit(load_kw).cast("decimal(12,3)") - F.col("gen"))
    rows = star(t, on_day(TOMORROW)).where(F.col("client_id") == client)
    return rows.select("hour_local", "tariff_label", dbl("price").alias("price_eur_mwh"), _r("gen", 1).alias("gen_kw"), _r(dbl(need * F.col("price")) / F.lit(1000.0) * F.lit(2)).alias("cycle_cost_eur"), "unix_time").orderBy(
        F.col("cycle_cost_eur").asc_nulls_first(), "unix_time").limit(8).drop("unix_time")


@job("agg_daily", f"""SELECT client_id, date, CAST(sum(gen) AS DOUBLE) AS kwh_generated, CAST(sum(con) AS DOUBLE) AS kwh_consumed, {h(_eur_sql('con'), 4)} AS cost_eur, count(CASE WHEN tariff_period = 'P1' THEN 1 END) AS hours_p1,
count(CASE WHEN tariff_period = 'P2' THEN 1 END) AS hours_p2, count(CASE WHEN tariff_period = 'P3' THEN 1 END) AS hours_p3, count(CASE WHEN tariff_period = 'P6' THEN 1 END) AS hours_p6, {h(_PR, 3)} AS mean_pr FROM v_star GROUP BY 1, 2""")
def agg_daily(t: Tables) -> DataFrame:
    """Daily summary per client, the pre-aggregate for dashboards."""
    hours = [F.count(F.when(F.col("tariff_period") == p, 1)).alias(f"hours_{p.lower()}") for p in ("P1", "P2", "P3", "P6")]
    return star(t).groupBy("client_id", "date").agg(dbl(F.sum("gen")).alias("kwh_generated"), dbl(F.sum("con")).alias("kwh_consumed"), _r(eur("con"), 4).alias("cost_eur"), *hours, _r(_pr_mean(), 3).alias("mean_pr"))


@job("date_windows", """SELECT count(CASE WHEN date = DATE '2024-01-17' THEN 1 END) AS tomorrow, count(CASE WHEN unix_time BETWEEN 1705363200 AND 1705449600 THEN 1 END) AS next_24h, count(CASE WHEN unix_time >= 1705363200 THEN 1 END) AS whole_forecast,
count(CASE WHEN unix_time BETWEEN 1705363200 AND 1705370400 THEN 1 END) AS next_2h, count(CASE WHEN is_daylight = 1 AND gen > 0 THEN 1 END) AS sun_hours, count(CASE WHEN date = DATE '2024-01-17' AND tariff_period = 'P1' THEN 1 END) AS tomorrow_peak,
count(CASE WHEN unix_time >= 1705363200 AND tariff_period <> 'P6' THEN 1 END) AS workdays, count(CASE WHEN hour_local = 14 THEN 1 END) AS same_hour FROM v_star""")
def date_windows(t: Tables) -> DataFrame:
    """Row counts of the usual relative-date filters, in one pass."""
    u = F.col("unix_time")
    tomorrow = F.col("date") == F.lit(TOMORROW).cast("date")
    preds = {"tomorrow": tomorrow, "next_24h": u.between(NOW_UNIX, NOW_UNIX + 86400), "whole_forecast": u >= NOW_UNIX, "next_2h": u.between(NOW_UNIX, NOW_UNIX + 7200),
             "sun_hours": (F.col("is_daylight") == 1) & (F.col("gen") > 0), "tomorrow_peak": tomorrow & (F.col("tariff_period") == "P1"), "workdays": (u >= NOW_UNIX) & (F.col("tariff_period") != "P6"),
             "same_hour": F.col("hour_local") == 14}
    return star(t).agg(*[F.count(F.when(p, 1)).alias(n) for n, p in preds.items()])
