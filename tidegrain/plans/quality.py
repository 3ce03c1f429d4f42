"""Data-quality and run-monitoring jobs on the energy tables and the run log."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions.numbers import count_if, dbl, half_up, mean, mean_of
from tidegrain.operators import quality as Q
from tidegrain.operators.joins import asof_lookup
from tidegrain.operators.quality import Rule
from tidegrain.plans import energy as E
from tidegrain.plans.energy_reports import FRESH_NOW, NOW_UNIX, TOMORROW, _clients, _freshness, _pr_mean, on_day, star
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job, view
from tidegrain.sources.tables import Tables

RUN_NOW = "2001-07-31"

# Rule ids, predicates, dimensions, severities and tolerances; three tolerances are shares of the daytime rows.
DAYTIME = "coalesce(poa_wm2, 0) > 0"
CLIENT_RULES = [
    Rule("DQ-S001", "clean_clients", "client_id IS NOT NULL AND client_id <> '' AND client_id NOT IN ('None','nan','null')", "Completeness", "CRITICAL"),
    Rule("DQ-S002", "clean_clients", "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180", "Accuracy", "CRITICAL"),
    Rule("DQ-S003", "clean_clients", "pv_peak_power_kw > 0", "Validity", "CRITICAL"),
    Rule("DQ-S004", "clean_clients", "angle BETWEEN 0 AND 90", "Validity", "MEDIUM", 0.10),
    Rule("DQ-S005", "clean_clients", "efficiency BETWEEN 0 AND 1", "Validity", "MEDIUM", 0.10),
]
WEATHER_RULES = [
    Rule("DQ-S007", "clean_weather", "temp_celsius BETWEEN -30 AND 55", "Accuracy", "HIGH", 0.01),
    Rule("DQ-S008", "clean_weather", "clouds_pct BETWEEN 0 AND 100", "Validity", "HIGH"),
    Rule("DQ-S009", "clean_weather", "rain_prob_norm BETWEEN 0 AND 1", "Validity", "MEDIUM", 0.02),
]
PRICE_RULES = [Rule("DQ-S012", "clean_prices", "price_euro_mwh BETWEEN -100 AND 2000", "Validity", "HIGH")]
CALC_RULES = [
    Rule("DQ-S015", "clean_calculations", "pv_power_gen_kw >= 0", "Accuracy", "CRITICAL"),
    Rule("DQ-S016", "clean_calculations", "pv_power_gen_kw <= pv_peak_power_kw * 1.1", "Accuracy", "HIGH", 0.005, DAYTIME),
    Rule("DQ-S017", "clean_calculations", "pv_performance_ratio BETWEEN 0.3 AND 1.0 OR pv_performance_ratio = 0", "Accuracy", "MEDIUM", 0.02, DAYTIME),
    Rule("DQ-S018", "clean_calculations", "power_con_kw >= 0", "Accuracy", "HIGH"),
]
TARIFF_RULES = [Rule("DQ-G004", "gold_dim_datetime", "tariff_period IN ('P1','P2','P3','P6')", "Validity", "CRITICAL")]
FACT_RULES = [Rule("DQ-G005", "gold_fact_energy_forecast", "pv_power_gen_kw <= pv_peak_power_kw * 1.1 OR pv_power_gen_kw = 0", "Consistency", "HIGH", 0.005, DAYTIME)]
RAW_RULES = [Rule(r.id + "-RAW", "raw_clients", r.predicate, r.dimension, r.severity, r.tolerance) for r in CLIENT_RULES]
UNIQUE = [Rule("DQ-S006", "clean_clients", "", "Uniqueness", "HIGH"), Rule("DQ-S011", "clean_weather", "", "Uniqueness", "CRITICAL"), Rule("DQ-S014", "clean_prices", "", "Uniqueness", "CRITICAL")]
COVER = [Rule("DQ-S010", "clean_weather", "", "Completeness", "MEDIUM"), Rule("DQ-S013", "clean_prices", "", "Completeness", "HIGH"), Rule("DQ-G003", "gold_fact_energy_forecast", "", "Completeness", "HIGH")]
REFER = [Rule("DQ-G001", "gold_fact_energy_forecast", "", "Consistency", "CRITICAL"), Rule("DQ-G002", "gold_fact_energy_forecast", "", "Consistency", "CRITICAL"),
         Rule("DQ-G001-W", "clean_weather", "", "Consistency", "CRITICAL")]


# Fixed values, stated apart from the rules above: what a good row is, and the rows judged, in the other engine's SQL.
GOOD = {
    "DQ-S001": "client_id NOT IN ('', 'None', 'nan', 'null')", "DQ-S002": "abs(latitude) <= 90 AND abs(longitude) <= 180", "DQ-S003": "pv_peak_power_kw > 0", "DQ-S004": "angle >= 0 AND angle <= 90",
    "DQ-S005": "efficiency >= 0 AND efficiency <= 1", "DQ-S007": "temp_celsius >= -30 AND temp_celsius <= 55", "DQ-S008": "clouds_pct >= 0 AND clouds_pct <= 100",
    "DQ-S009": "rain_prob_norm >= 0 AND rain_prob_norm <= 1", "DQ-S012": "price_euro_mwh >= -100 AND price_euro_mwh <= 2000", "DQ-S015": "pv_power_gen_kw >= 0",
    "DQ-S016": "pv_power_gen_kw <= pv_peak_power_kw * 1.1", "DQ-S017": "(pv_performance_ratio >= 0.3 AND pv_performance_ratio <= 1) OR pv_performance_ratio = 0", "DQ-S018": "power_con_kw >= 0",
    "DQ-G004": "tariff_period IN ('P1', 'P2', 'P3', 'P6')", "DQ-G005": "pv_power_gen_kw = 0 OR pv_power_gen_kw <= pv_peak_power_kw * 1.1"}
BY_DAY = ("DQ-S016", "DQ-S017", "DQ-G005")


def _row_sql(rules: list[Rule], source: str) -> str:
    def rows(rule: Rule) -> str:
        return f"(SELECT * FROM {source} WHERE poa_wm2 > 0)" if rule.id in BY_DAY else source

    return " UNION ALL ".join(
        f"SELECT '{r.id}' AS rule_id, '{r.table}' AS table_name, '{r.dimension}' AS dimension, '{r.severity}' AS severity, CAST({r.tolerance} AS DOUBLE) AS tolerance, count(*) AS total, "
        f"count(CASE WHEN NOT coalesce({GOOD[r.id.removesuffix('-RAW')]}, FALSE) THEN 1 END) AS failed FROM {rows(r)}" for r in rules)


def _group_sql(r: Rule, source: str, keys: str, failed: str, total: str = "CAST(coalesce(sum(n), 0) AS BIGINT)") -> str:
    return (f"SELECT '{r.id}' AS rule_id, '{r.table}' AS table_name, '{r.dimension}' AS dimension, '{r.severity}' AS severity, CAST({r.tolerance} AS DOUBLE) AS tolerance, {total} AS total, "
            f"CAST(coalesce({failed}, 0) AS BIGINT) AS failed FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY ALL)")


_CALC_SRC = "(SELECT k.*, c.pv_peak_power_kw FROM v_calc k JOIN v_clean_client c ON k.client_id = c.client_id)"
_FACT_SRC = "(SELECT f.*, c.pv_peak_power_kw FROM v_fact f JOIN v_dim_client c ON f.client_id = c.client_id)"
view("v_rules_row", " UNION ALL ".join([
    _row_sql(CLIENT_RULES, "v_clean_client"), _row_sql(RAW_RULES, "v_raw_client"), _row_sql(WEATHER_RULES, "v_clean_weather"), _row_sql(PRICE_RULES, "v_clean_price"),
    _row_sql(CALC_RULES, _CALC_SRC), _row_sql(TARIFF_RULES, "v_dim_datetime"), _row_sql(FACT_RULES, _FACT_SRC)]))
view("v_rules_unique", " UNION ALL ".join([
    _group_sql(UNIQUE[0], "v_clean_client", "client_id", "sum(n - 1)"), _group_sql(UNIQUE[1], "v_clean_weather", "client_id, unix_time", "sum(n - 1)"),
    _group_sql(UNIQUE[2], "v_clean_price", "unix_time, price_type", "sum(n - 1)")]))
view("v_rules_cover", " UNION ALL ".join([
    _group_sql(COVER[0], "v_clean_weather", "client_id, unix_time // 86400 AS d", "count(CASE WHEN n < 22 THEN 1 END)", "count(*)"),
    _group_sql(COVER[1], "v_clean_price", "price_type, unix_time // 86400 AS d", "count(CASE WHEN n < 22 THEN 1 END)", "count(*)"),
    _group_sql(COVER[2], "(SELECT client_id FROM v_fact WHERE unix_time > 1705363200)", "client_id", "count(CASE WHEN n < 24 THEN 1 END)", "count(*)")]))


def _ref_sql(r: Rule, fact: str, dim: str, key: str) -> str:
    return (f"SELECT '{r.id}' AS rule_id, '{r.table}' AS table_name, '{r.dimension}' AS dimension, '{r.severity}' AS severity, CAST({r.tolerance} AS DOUBLE) AS tolerance, count(*) AS total, "
            f"count(CASE WHEN d.{key} IS NULL THEN 1 END) AS failed FROM {fact} f LEFT JOIN (SELECT DISTINCT {key} FROM {dim}) d ON f.{key} = d.{key}")


view("v_rules_refer", " UNION ALL ".join([
    _ref_sql(REFER[0], "v_fact", "v_dim_client", "client_id"), _ref_sql(REFER[1], "v_fact", "v_dim_datetime", "unix_time"), _ref_sql(REFER[2], "v_clean_weather", "v_dim_client", "client_id")]))
view("v_rules", "SELECT * FROM v_rules_row UNION ALL SELECT * FROM v_rules_unique UNION ALL SELECT * FROM v_rules_cover UNION ALL SELECT * FROM v_rules_refer")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@job("row_rules", "SELECT * FROM v_rules_row")
def row_rules(t: Tables) -> DataFrame:
    """Range and not-null rules of every layer, one aggregate pass per table."""
    peak = E.clean_clients(t).select("client_id", "pv_peak_power_kw")
    raw = E.raw_clients(t)
    typed = raw.withColumns({c: F.col(c).try_cast("double") for c in E.CLIENT_NUMBERS})
    return _union([
        Q.run_rules(E.clean_clients(t), CLIENT_RULES), Q.run_rules(typed, RAW_RULES), Q.run_rules(E.clean_weather(t), WEATHER_RULES), Q.run_rules(E.clean_prices(t), PRICE_RULES),
        Q.run_rules(E.clean_calculations(t).join(peak, "client_id"), CALC_RULES), Q.run_rules(E.gold_dim_datetime(t), TARIFF_RULES),
        Q.run_rules(E.gold_fact(t).join(_clients(t, "pv_peak_power_kw"), "client_id"), FACT_RULES)])


@job("unique_rules", "SELECT * FROM v_rules_unique")
def unique_rules(t: Tables) -> DataFrame:
    return _union([Q.unique_rule(E.clean_clients(t), ["client_id"], UNIQUE[0]), Q.unique_rule(E.clean_weather(t), ["client_id", "unix_time"], UNIQUE[1]),
                   Q.unique_rule(E.clean_prices(t), ["unix_time", "price_type"], UNIQUE[2])])


@job("coverage_rules", "SELECT * FROM v_rules_cover")
def coverage_rules(t: Tables) -> DataFrame:
    """Hours per client and day, per price series and day, and future hours per client (two missing hours are tolerated per day)."""
    day = F.expr("unix_time div 86400").alias("d")
    w = E.clean_weather(t).select("client_id", day)
    p = E.clean_prices(t).select("price_type", day)
    future = E.gold_fact(t).where(F.col("unix_time") > NOW_UNIX).select("client_id")
    return _union([Q.coverage_rule(w, ["client_id", "d"], 22, COVER[0]), Q.coverage_rule(p, ["price_type", "d"], 22, COVER[1]), Q.coverage_rule(future, ["client_id"], 24, COVER[2])])


@job("reference_rules", "SELECT * FROM v_rules_refer")
def reference_rules(t: Tables) -> DataFrame:
    return _union([Q.reference_rule(E.gold_fact(t), E.gold_dim_client(t), "client_id", REFER[0]), Q.reference_rule(E.gold_fact(t), E.gold_dim_datetime(t), "unix_time", REFER[1]),
                   Q.reference_rule(E.clean_weather(t), E.gold_dim_client(t), "client_id", REFER[2])])


def all_results(t: Tables) -> DataFrame:
    """Results of all rules, written once: actions, table scores and run score read them."""
    return t.staged("rule_results", lambda: _union([row_rules(t), unique_rules(t), coverage_rules(t), reference_rules(t)]))


@job("orphan_weather", "SELECT client_id, unix_time FROM v_clean_weather w WHERE NOT EXISTS (SELECT 1 FROM v_dim_client c WHERE c.client_id = w.client_id)")
def orphan_weather(t: Tables) -> DataFrame:
    from tidegrain.operators.joins import orphans

    return orphans(E.clean_weather(t), E.gold_dim_client(t), "client_id").select("client_id", "unix_time")


@job("landing_rules", """SELECT 'DQ-B001' AS rule_id, count(*) AS documents, count(CASE WHEN event_id % 60 = 11 THEN 1 END) AS failed FROM events
UNION ALL SELECT 'DQ-B002', count(*), count(CASE WHEN event_id % 37 = 5 THEN 1 END) FROM events""")
def landing_rules(t: Tables) -> DataFrame:
    """Raw payloads that carry no usable value (prices) or an empty list (weather)."""
    p = F.from_json("raw_data", E.PRICE_SCHEMA)["included"]
    good = F.exists(F.flatten(F.transform(p, lambda s: s["attributes"]["values"])), lambda v: F.try_to_timestamp(v["datetime"]).isNotNull())
    prices = E.raw_prices(t).agg(F.count(F.lit(1)).alias("documents"), count_if(~F.coalesce(good, F.lit(False))).alias("failed"))
    emptied = F.when(F.col("event_id") % 37 == 5, F.lit('{"list":[]}')).otherwise(F.lit('{"list":[{"dt_txt":"2024-01-01 00:00:00"}]}'))
    size = F.coalesce(F.size(F.from_json("raw", E.WEATHER_SCHEMA)["list"]), F.lit(0))
    weather = t.raw("events").select(emptied.alias("raw")).agg(F.count(F.lit(1)).alias("documents"), count_if(size <= 0).alias("failed"))
    return _union([prices.select(F.lit("DQ-B001").alias("rule_id"), "documents", "failed"), weather.select(F.lit("DQ-B002").alias("rule_id"), "documents", "failed")])


_SHARE = "(CASE WHEN total > 0 THEN CAST(failed AS DOUBLE) / total ELSE 0 END)"


@job("dq_action", f"""SELECT *, {h(_SHARE + ' * 100.0', 4)} AS failed_pct, CAST({_SHARE} <= tolerance AS BIGINT) AS within_tolerance, CASE WHEN failed = 0 THEN 'PASS'
WHEN severity = 'CRITICAL' OR (severity = 'HIGH' AND {_SHARE} > 0.05) THEN 'BLOCK' WHEN severity = 'HIGH' OR (severity = 'MEDIUM' AND {_SHARE} > 0.20) THEN 'ALERT' ELSE 'RECORD' END AS action FROM v_rules""")
def dq_action(t: Tables) -> DataFrame:
    return Q.dq_action(all_results(t))


_W = "CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END"
view("v_scores", f"SELECT table_name, {h(f'100.0 * sum({_W} * (1.0 - {_SHARE})) / sum({_W})', 2)} AS quality_score, count(*) AS rules FROM v_rules GROUP BY 1")


@job("quality_score", "SELECT * FROM v_scores")
def quality_score(t: Tables) -> DataFrame:
    return Q.quality_score(all_results(t))


def _case(values: dict, default: float) -> str:
    return "CASE table_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END::DOUBLE"


@job("run_score", f"""WITH s AS (SELECT {h(f'sum({_case(Q.TABLE_WEIGHTS, 1.0)} * quality_score) / sum({_case(Q.TABLE_WEIGHTS, 1.0)})', 2)} AS q, count(CASE WHEN quality_score < {_case(Q.TABLE_THRESHOLDS, 90.0)} THEN 1 END) AS n FROM v_scores)
SELECT q AS run_quality_score, n AS tables_below_threshold, CASE WHEN q >= 97 THEN '✅ EXCELENTE' WHEN q >= 90 THEN '✅ BUENO' WHEN q >= 80 THEN '⚠️ DEGRADADO' ELSE '🔴 CRÍTICO' END AS quality_class FROM s""")
def run_score(t: Tables) -> DataFrame:
    return Q.run_score(Q.quality_score(all_results(t)))


@job("client_quality", f"""SELECT 'raw_clients' AS table_name, {h('100.0 * count(CASE WHEN client_id IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND pv_peak_power_kw > 0 AND angle BETWEEN 0 AND 90 AND efficiency BETWEEN 0 AND 1 THEN 1 END) / count(*)')} AS quality_score_pct,
count(*) AS total_rows, count(*) - count(client_id) AS null_client_id, count(CASE WHEN pv_peak_power_kw <= 0 THEN 1 END) AS bad_power, count(CASE WHEN angle NOT BETWEEN 0 AND 90 THEN 1 END) AS bad_angle FROM v_raw_client""")
def client_quality(t: Tables) -> DataFrame:
    """Score of the client master before cleaning, with the counts behind it."""
    raw = E.raw_clients(t).withColumns({c: F.col(c).try_cast("double") for c in E.CLIENT_NUMBERS})
    good = F.expr(" AND ".join(f"({r.predicate})" for r in CLIENT_RULES[1:])) & F.col("client_id").isNotNull()
    n = F.count(F.lit(1))
    return raw.agg(half_up(F.lit(100.0) * count_if(good) / n).alias("quality_score_pct"), n.alias("total_rows"), count_if(F.col("client_id").isNull()).alias("null_client_id"),
                   count_if(F.col("pv_peak_power_kw") <= 0).alias("bad_power"), count_if(~F.col("angle").between(0, 90)).alias("bad_angle")).withColumn("table_name", F.lit("raw_clients"))


@job("quality_trend", f"""SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS table_name, CAST(sum(CAST(100 - l_discount * 100 - l_tax * 10 AS DECIMAL(9,1))) AS DOUBLE) / count(*) AS mean_score, CAST(min(CAST(100 - l_discount * 100 - l_tax * 10 AS DECIMAL(9,1))) AS DOUBLE) AS min_score,
count(*) AS runs FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-07-01' GROUP BY 1, 2""")
def quality_trend(t: Tables) -> DataFrame:
    """Score history of the last 30 days by day and table (line rows stand for measurements)."""
    score = (F.lit(100) - F.col("l_discount") * 100 - F.col("l_tax") * 10).cast("decimal(9,1)")
    rows = t.raw("lineitem").where(F.col("l_shipdate") >= F.date_sub(F.lit(RUN_NOW).cast("date"), 30).cast("timestamp_ntz")).select(
        F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("table_name"), score.alias("s"))
    return rows.groupBy("day", "table_name").agg(mean_of("s").alias("mean_score"), dbl(F.min("s")).alias("min_score"), F.count(F.lit(1)).alias("runs"))


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


@job("reconcile_layers", """WITH c AS (SELECT (SELECT count(*) FROM v_clean_client) AS silver_clients, (SELECT count(*) FROM v_clean_weather WHERE unix_time >= 1705363200) AS silver_weather_active, (SELECT count(*) FROM v_clean_price WHERE unix_time >= 1705363200) AS silver_prices_ahead,
(SELECT count(*) FROM v_calc WHERE unix_time >= 1705363200) AS silver_calculations, (SELECT count(*) FROM v_dim_client) AS gold_dim_client, (SELECT count(*) FROM v_dim_datetime) AS gold_dim_datetime, (SELECT count(*) FROM v_fact WHERE unix_time >= 1705363200) AS gold_fact_active)
SELECT *, CASE WHEN gold_dim_client = silver_clients THEN '✅ OK' ELSE '❌ DIVERGENCIA' END AS check_clients, CASE WHEN gold_fact_active >= silver_calculations * 0.95 THEN '✅ OK' ELSE '⚠️ POSIBLE PÉRDIDA' END AS check_fact_vs_calc FROM c""")
def reconcile_layers(t: Tables) -> DataFrame:
    """Row counts of the layers side by side (scalar subqueries over one row)."""
    ahead = F.col("unix_time") >= NOW_UNIX
    base = E.clean_clients(t).agg(F.count(F.lit(1)).alias("silver_clients")).select(
        "silver_clients", _count(E.clean_weather(t).where(ahead)).alias("silver_weather_active"), _count(E.clean_prices(t).where(ahead)).alias("silver_prices_ahead"),
        _count(E.clean_calculations(t).where(ahead)).alias("silver_calculations"), _count(E.gold_dim_client(t)).alias("gold_dim_client"),
        _count(E.gold_dim_datetime(t)).alias("gold_dim_datetime"), _count(E.gold_fact(t).where(ahead)).alias("gold_fact_active"))
    return base.select("*", F.when(F.col("gold_dim_client") == F.col("silver_clients"), "✅ OK").otherwise("❌ DIVERGENCIA").alias("check_clients"),
                       F.when(F.col("gold_fact_active") >= F.col("silver_calculations") * F.lit(0.95), "✅ OK").otherwise("⚠️ POSIBLE PÉRDIDA").alias("check_fact_vs_calc"))


_PRM = "CAST(sum(CASE WHEN gen > 0 THEN pr END) AS DOUBLE) / nullif(count(CASE WHEN gen > 0 THEN pr END), 0)"


@job("sum_checks", f"""WITH g AS (SELECT client_id, sum(gen) AS g, sum(con) AS k, coalesce(sum(con * price), 0) AS e0, coalesce(sum(gen * price), 0) AS e1, {_PRM} AS p FROM v_star WHERE date = DATE '2024-01-17' GROUP BY 1)
SELECT c.client_id, c.name, c.pv_peak_power_kw, {h('g')} AS kwh_generated, {h('c.pv_peak_power_kw * 8')} AS kwh_physical_max, CASE WHEN CAST(g AS DOUBLE) > c.pv_peak_power_kw * 8 THEN '❌ SUPERA MÁXIMO FÍSICO' ELSE '✅ OK' END AS check_generation,
{h('k')} AS kwh_consumed, {h('CAST(e0 AS DOUBLE) / 1000.0', 4)} AS grid_cost_eur, {h('CAST(e1 AS DOUBLE) / 1000.0', 4)} AS pv_saving_eur, {h('p', 4)} AS mean_pr_day, CASE WHEN p BETWEEN 0.5 AND 0.95 THEN '✅ OK' ELSE '⚠️ PR ANÓMALO' END AS check_pr FROM g JOIN v_dim_client c ON g.client_id = c.client_id""")
def sum_checks(t: Tables) -> DataFrame:
    """Daily sums against physical limits."""
    g = star(t, on_day(TOMORROW)).groupBy("client_id").agg(F.sum("gen").alias("g"), F.sum("con").alias("k"), F.coalesce(F.sum(F.col("con") * F.col("price")), F.lit(0)).alias("e0"),
                                                          F.coalesce(F.sum(F.col("gen") * F.col("price")), F.lit(0)).alias("e1"), _pr_mean().alias("p"))
    peak, k1 = F.col("pv_peak_power_kw"), F.lit(1000.0)
    return g.join(_clients(t, "name", "pv_peak_power_kw"), "client_id").select(
        "client_id", "name", "pv_peak_power_kw", half_up(F.col("g")).alias("kwh_generated"), half_up(peak * 8).alias("kwh_physical_max"),
        F.when(dbl("g") > peak * 8, "❌ SUPERA MÁXIMO FÍSICO").otherwise("✅ OK").alias("check_generation"), half_up(F.col("k")).alias("kwh_consumed"), half_up(dbl("e0") / k1, 4).alias("grid_cost_eur"),
        half_up(dbl("e1") / k1, 4).alias("pv_saving_eur"), half_up(F.col("p"), 4).alias("mean_pr_day"), F.when(F.col("p").between(0.5, 0.95), "✅ OK").otherwise("⚠️ PR ANÓMALO").alias("check_pr"))


# -- run log --------------------------------------------------------------------------------------

view("v_run", """
SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'PARTIAL SUCCESS' ELSE 'FAILED AT STAGE ' || CAST(1 + o_orderkey % 6 AS VARCHAR) END AS status, o_orderkey % 601 AS duration_seconds,
o_orderkey * 7 % 5000 AS rows_affected, CASE WHEN o_orderstatus <> 'O' THEN 'Fallos en: step ' || CAST(o_orderkey % 10 AS VARCHAR) END AS error_message, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS executed_at FROM orders""")


def runs(t: Tables) -> DataFrame:
    """Run log: one audit row per order."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    return t.raw("orders").select(
        k.alias("id"), F.when(s == "O", "SUCCESS").when(s == "F", "PARTIAL SUCCESS").otherwise(F.concat(F.lit("FAILED AT STAGE "), (k % 6 + 1).cast("string"))).alias("status"),
        (k % 601).alias("duration_seconds"), (k * 7 % 5000).alias("rows_affected"), F.when(s != "O", F.concat(F.lit("Fallos en: step "), (k % 10).cast("string"))).alias("error_message"),
        F.timestamp_seconds(D.epoch(F.col("o_orderdate")) + k * 7919 % 86400).cast("timestamp_ntz").alias("executed_at"))


def _since(days: int):
    return F.col("executed_at") >= F.date_sub(F.lit(RUN_NOW).cast("date"), days).cast("timestamp_ntz")


@job("audit_list", """SELECT id, executed_at, status, duration_seconds, rows_affected, error_message, CASE WHEN status = 'SUCCESS' THEN '✅' WHEN status = 'PARTIAL SUCCESS' THEN '⚠️' WHEN status LIKE 'FAILED%' THEN '❌' ELSE '🔴' END AS icon
FROM v_run ORDER BY executed_at DESC, id DESC LIMIT 30""")
def audit_list(t: Tables) -> DataFrame:
    s = F.col("status")
    icon = F.when(s == "SUCCESS", "✅").when(s == "PARTIAL SUCCESS", "⚠️").when(s.like("FAILED%"), "❌").otherwise("🔴")
    return runs(t).withColumn("icon", icon).orderBy(F.col("executed_at").desc(), F.col("id").desc()).limit(30)


@job("health", f"""WITH u AS (SELECT * FROM v_run ORDER BY id DESC LIMIT 1), f AS (SELECT * FROM v_fact WHERE unix_time >= 1705363200)
SELECT u.status AS last_status, u.executed_at AS last_run, u.duration_seconds, u.rows_affected AS rows_processed, u.error_message AS errors, count(DISTINCT client_id) AS active_clients, count(*) AS future_rows, min(unix_time) AS first_slot, max(unix_time) AS last_slot,
count(*) - count(price_pvpc_eur_mwh) AS rows_without_price, {h('100.0 * count(CASE WHEN pv_power_gen_kw >= 0 THEN 1 END) / count(*)', 1)} AS generation_quality_pct, {h('100.0 * count(price_pvpc_eur_mwh) / count(*)', 1)} AS price_quality_pct FROM f, u GROUP BY ALL""")
def health(t: Tables) -> DataFrame:
    """Last run, coverage and quality in one row."""
    last = runs(t).agg(F.max_by(F.struct("status", "executed_at", "duration_seconds", "rows_affected", "error_message"), "id").alias("u")).scalar()
    f, n, priced = E.gold_fact(t).where(F.col("unix_time") >= NOW_UNIX), F.count(F.lit(1)), F.count("price_pvpc_eur_mwh")
    one = f.agg(F.countDistinct("client_id").alias("active_clients"), n.alias("future_rows"), F.min("unix_time").alias("first_slot"), F.max("unix_time").alias("last_slot"), (n - priced).alias("rows_without_price"),
                half_up(F.lit(100.0) * count_if(F.col("pv_power_gen_kw") >= 0) / n, 1).alias("generation_quality_pct"), half_up(F.lit(100.0) * priced / n, 1).alias("price_quality_pct"))
    return one.withColumn("_u", last).select(
        F.col("_u.status").alias("last_status"), F.col("_u.executed_at").alias("last_run"), F.col("_u.duration_seconds").alias("duration_seconds"), F.col("_u.rows_affected").alias("rows_processed"),
        F.col("_u.error_message").alias("errors"), *[c for c in one.columns])


@job("throughput", f"SELECT id, CAST(executed_at AS DATE) AS day, status, rows_affected, duration_seconds, {h('CAST(rows_affected AS DOUBLE) / nullif(duration_seconds, 0)', 1)} AS rows_per_second FROM v_run WHERE executed_at >= TIMESTAMP '2001-07-17'")
def throughput(t: Tables) -> DataFrame:
    return runs(t).where(_since(14)).select("id", F.to_date("executed_at").alias("day"), "status", "rows_affected", "duration_seconds",
                                            half_up(dbl("rows_affected") / F.nullif(dbl("duration_seconds"), F.lit(0.0)), 1).alias("rows_per_second"))


@job("invalid_counts", """SELECT 'clean_clients' AS table_name, count(*) AS total, count(CASE WHEN pv_peak_power_kw IS NULL OR pv_peak_power_kw <= 0 THEN 1 END) AS invalid FROM v_clean_client
UNION ALL SELECT 'clean_weather', count(*), count(*) - count(temp_celsius) FROM v_clean_weather WHERE unix_time >= 1705363200 UNION ALL SELECT 'clean_prices', count(*), count(*) - count(price_euro_mwh) FROM v_clean_price WHERE unix_time >= 1705363200""")
def invalid_counts(t: Tables) -> DataFrame:
    def part(df: DataFrame, name: str, bad) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total"), count_if(bad).alias("invalid")).select(F.lit(name).alias("table_name"), "total", "invalid")

    ahead, p = F.col("unix_time") >= NOW_UNIX, F.col("pv_peak_power_kw")
    return _union([part(E.clean_clients(t), "clean_clients", p.isNull() | (p <= 0)), part(E.clean_weather(t).where(ahead), "clean_weather", F.col("temp_celsius").isNull()),
                   part(E.clean_prices(t).where(ahead), "clean_prices", F.col("price_euro_mwh").isNull())])


@job("coverage", f"""SELECT f.client_id, c.name, count(*) AS future_slots, min(unix_time) AS first_slot, max(unix_time) AS last_slot, {h('(max(unix_time) - 1705363200) / 3600.0', 1)} AS hours_covered,
CASE WHEN count(*) >= 100 THEN '✅ OK' WHEN count(*) >= 24 THEN '⚠️ Degradado' ELSE '❌ Crítico' END AS state FROM v_fact f JOIN v_dim_client c ON f.client_id = c.client_id WHERE unix_time >= 1705363200 GROUP BY 1, 2""")
def coverage(t: Tables) -> DataFrame:
    n = F.col("future_slots")
    per = E.gold_fact(t).where(F.col("unix_time") >= NOW_UNIX).groupBy("client_id").agg(F.count(F.lit(1)).alias("future_slots"), F.min("unix_time").alias("first_slot"), F.max("unix_time").alias("last_slot"))
    return per.join(_clients(t, "name"), "client_id").select("client_id", "name", "future_slots", "first_slot", "last_slot", half_up((F.col("last_slot") - NOW_UNIX) / F.lit(3600.0), 1).alias("hours_covered"),
                                                             F.when(n >= 100, "✅ OK").when(n >= 24, "⚠️ Degradado").otherwise("❌ Crítico").alias("state"))


@job("row_lineage", """WITH r AS (SELECT id, status, CAST(epoch(executed_at) AS BIGINT) + 708588000 AS at FROM (SELECT *, row_number() OVER (PARTITION BY executed_at ORDER BY id DESC) AS rn FROM v_run) WHERE rn = 1)
SELECT f.client_id, f.unix_time, f.pv_power_gen_kw, f._loaded_at_utc AS loaded_at, CAST(r.id AS VARCHAR) || ' (' || r.status || ')' AS pipeline_run FROM v_fact f ASOF LEFT JOIN r ON f._loaded_at_utc >= r.at""")
def row_lineage(t: Tables) -> DataFrame:
    """Fact rows with the run that produced them (latest run at or before the load time).

    The run log is shifted to the fact's years; the as-of lookup runs on the distinct load times only.
    """
    log = runs(t).groupBy("executed_at").agg(F.max(F.struct("id", "status")).alias("r")).select(
        F.timestamp_seconds(D.epoch(F.col("executed_at")) + F.lit(708588000)).alias("at"), F.col("r.id").alias("id"), F.col("r.status").alias("status"))
    f = E.gold_fact(t)
    found = asof_lookup(f, log, "_loaded_at_utc", "at", ["id", "status"])
    return f.join(found, "_loaded_at_utc", "left").select(
        "client_id", "unix_time", "pv_power_gen_kw", D.epoch(F.col("_loaded_at_utc")).alias("loaded_at"), F.concat(F.col("id").cast("string"), F.lit(" ("), "status", F.lit(")")).alias("pipeline_run"))


@job("lineage", """SELECT f.client_id, f.unix_time, f.pv_power_gen_kw, k.poa_wm2, c.name AS client_name, CAST(epoch(w.ing) AS DOUBLE) AS weather_ingested, f._loaded_at_utc AS loaded_at FROM v_fact f JOIN v_calc k ON k.client_id = f.client_id AND k.unix_time = f.unix_time JOIN v_clean_client c ON c.client_id = f.client_id
JOIN v_clean_weather w ON w.client_id = f.client_id AND w.unix_time = f.unix_time""")
def lineage(t: Tables) -> DataFrame:
    """Fact rows joined back to calculation, client and weather sources."""
    key = ["client_id", "unix_time"]
    calc = E.clean_calculations(t).select(*key, "poa_wm2")
    weather = E.clean_weather(t).select(*key, (F.unix_micros("_ingested_at_utc") / F.lit(1000000.0)).alias("weather_ingested"))
    f = E.gold_fact(t).select(*key, "pv_power_gen_kw", D.epoch(F.col("_loaded_at_utc")).alias("loaded_at"))
    return f.join(calc, key).join(weather, key).join(E.clean_clients(t).select("client_id", F.col("name").alias("client_name")), "client_id")


@job("alerts", """SELECT (SELECT count(*) FROM v_run WHERE status LIKE 'FAILED%' AND executed_at >= TIMESTAMP '2001-07-30') AS failures_24h, (SELECT count(*) FROM (SELECT client_id FROM v_fact WHERE unix_time >= 1705363200 GROUP BY 1 HAVING count(*) < 100)) AS clients_without_coverage,
(SELECT status FROM v_run ORDER BY id DESC LIMIT 1) AS last_status, (SELECT executed_at FROM v_run ORDER BY id DESC LIMIT 1) AS last_run""")
def alerts(t: Tables, least: int = 100) -> DataFrame:
    """Alert counters in one row."""
    thin = E.gold_fact(t).where(F.col("unix_time") >= NOW_UNIX).groupBy("client_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < least)
    bad = F.col("status").like("FAILED%") & _since(1)
    one = runs(t).agg(count_if(bad).alias("failures_24h"), F.max_by(F.struct("status", "executed_at"), "id").alias("u"))
    return one.select("failures_24h", _count(thin).alias("clients_without_coverage"), F.col("u.status").alias("last_status"), F.col("u.executed_at").alias("last_run"))


_OK = "status IN ('SUCCESS','PARTIAL SUCCESS')"


@job("slo_30d", f"""SELECT count(*) AS total_runs, count(CASE WHEN {_OK} THEN 1 END) AS runs_ok, count(CASE WHEN status LIKE 'FAILED%' THEN 1 END) AS runs_failed, {h(f'100.0 * count(CASE WHEN {_OK} THEN 1 END) / count(*)')} AS availability_pct,
{h('CAST(sum(duration_seconds) AS DOUBLE) / count(*)', 1)} AS mean_duration_s, max(duration_seconds) AS max_duration_s FROM v_run WHERE executed_at >= TIMESTAMP '2001-07-01'""")
def slo_30d(t: Tables) -> DataFrame:
    ok, n = count_if(F.expr(_OK)), F.count(F.lit(1))
    return runs(t).where(_since(30)).agg(n.alias("total_runs"), ok.alias("runs_ok"), count_if(F.col("status").like("FAILED%")).alias("runs_failed"), half_up(F.lit(100.0) * ok / n).alias("availability_pct"),
                                         half_up(mean_of("duration_seconds"), 1).alias("mean_duration_s"), F.max("duration_seconds").alias("max_duration_s"))


@job("fact_freshness", f"""SELECT max(_loaded_at_utc) AS last_load_unix, {h('(1706745600 - max(_loaded_at_utc)) / 3600.0')} AS hours_since_load, CASE WHEN 1706745600 - max(_loaded_at_utc) < 7200 THEN '✅ Fresco (< 2h)' WHEN 1706745600 - max(_loaded_at_utc) < 86400 THEN '⚠️ Degradado (< 24h)'
ELSE '❌ Obsoleto (> 24h)' END AS state FROM v_fact""")
def fact_freshness(t: Tables) -> DataFrame:
    one = E.gold_fact(t).agg(D.epoch(F.max("_loaded_at_utc")).alias("last_load_unix"))
    age = F.lit(FRESH_NOW) - F.col("last_load_unix")
    return one.select("last_load_unix", half_up(age / F.lit(3600.0)).alias("hours_since_load"), _freshness(age, 7200, ("✅ Fresco (< 2h)", "⚠️ Degradado (< 24h)", "❌ Obsoleto (> 24h)")).alias("state"))


@job("weekly_slo", f"""SELECT strftime(executed_at, '%Y-W%W') AS week, count(*) AS total_runs, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS success, count(CASE WHEN status = 'PARTIAL SUCCESS' THEN 1 END) AS partial, count(CASE WHEN status LIKE 'FAILED%' THEN 1 END) AS failed,
{h(f'100.0 * count(CASE WHEN {_OK} THEN 1 END) / count(*)', 1)} AS slo_pct, {h('CAST(sum(duration_seconds) AS DOUBLE) / count(*)', 0)} AS mean_duration_s, {h('CAST(sum(rows_affected) AS DOUBLE) / count(*)', 0)} AS mean_rows FROM v_run WHERE executed_at >= TIMESTAMP '2001-06-01' GROUP BY 1""")
def weekly_slo(t: Tables) -> DataFrame:
    d, s, n = F.col("executed_at"), F.col("status"), F.count(F.lit(1))
    week = F.concat(F.date_format(d, "yyyy"), F.lit("-W"), F.lpad(D.week_monday(d).cast("string"), 2, "0"))
    return runs(t).where(_since(60)).groupBy(week.alias("week")).agg(
        n.alias("total_runs"), count_if(s == "SUCCESS").alias("success"), count_if(s == "PARTIAL SUCCESS").alias("partial"), count_if(s.like("FAILED%")).alias("failed"),
        half_up(F.lit(100.0) * count_if(F.expr(_OK)) / n, 1).alias("slo_pct"), half_up(mean_of("duration_seconds"), 0).alias("mean_duration_s"), half_up(mean_of("rows_affected"), 0).alias("mean_rows"))


@job("retention", "SELECT CAST(min(ts) AS DATE) AS oldest, CAST(max(ts) AS DATE) AS newest, count(*) AS total_rows FROM events WHERE ts >= TIMESTAMP '2024-01-11'")
def retention(t: Tables) -> DataFrame:
    """What a retention delete keeps: the last 20 days, with the new extremes."""
    from tidegrain.operators.tables import retain

    return retain(t.raw("events"), "ts", 20, "2024-01-31").agg(F.to_date(F.min("ts")).alias("oldest"), F.to_date(F.max("ts")).alias("newest"), F.count(F.lit(1)).alias("total_rows"))


@job("check_schema", """WITH r AS (SELECT event_id, event_id % 5 AS m FROM events)
SELECT event_id, v AS violation FROM r, (VALUES (1, 'E01 missing $.version'), (2, 'E02 missing $.database.password'), (3, 'T01 not an integer $.database.port'), (4, 'T02 not an integer $.retry_attempts')) x(c, v) WHERE r.m = x.c""")
def check_schema(t: Tables) -> DataFrame:
    """Violations of configuration records built from the event properties."""
    m = F.col("event_id") % 5
    rec = F.concat(F.lit('{"project_name":"p",'), F.when(m != 1, F.concat(F.lit('"version":'), F.get_json_object("props", "$.k"), F.lit(","))).otherwise(""), F.lit('"database":{"host":"h","user":"u",'),
                   F.when(m != 2, F.lit('"password":"s",')).otherwise(""), F.when(m == 3, F.lit('"port":"5432"')).otherwise(F.lit('"port":5432')), F.lit('},"retry_attempts":'),
                   F.when(m == 4, F.lit('"3"')).otherwise(F.lit("3")), F.lit("}"))
    required = [("E01", f"$.{k}") for k in ("project_name", "version", "database", "retry_attempts")] + [("E02", f"$.database.{k}") for k in ("host", "user", "password", "port")]
    return Q.check_schema(t.raw("events").select("event_id", rec.alias("record")), "record", required, ["$.database.port", "$.retry_attempts"])
