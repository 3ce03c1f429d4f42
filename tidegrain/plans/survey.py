"""Survey jobs: state production reports and review-site hypotheses, indicators and text mining."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import text as X
from tidegrain.functions.numbers import avg_if, count_if, dbl, half_up, mean, mean_of
from tidegrain.operators import joins as J
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job, view
from tidegrain.sources.tables import Tables

view("v_production", """
SELECT o_orderstatus AS commodity, year(o_orderdate) AS year, month(o_orderdate) AS period, CAST(c_nationkey AS BIGINT) AS state_id,
CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) AS value, o_orderkey AS record_id FROM orders JOIN customer ON o_custkey = c_custkey""")


def production(t: Tables, commodity: str, year: int, month: int | None = None, by_state: bool = True) -> DataFrame:
    """Production records of one commodity and year (a month of it); the date is a pushed range filter.

    Values are whole numbers; ``by_state`` adds the state of the producer.
    """
    o = t.raw("orders").where((F.col("o_orderstatus") == commodity) & D.in_year(F.col("o_orderdate"), year))
    if month:
        o = o.where(F.month("o_orderdate") == month)
    o = o.select(F.col("o_custkey").alias("c_custkey"), F.floor(F.col("o_totalprice").cast("decimal(18,2)")).cast("bigint").alias("value"), F.col("o_orderkey").alias("record_id"))
    if not by_state:
        return o
    return o.join(t.raw("customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("state_id")), "c_custkey").drop("c_custkey")


def states(t: Tables) -> DataFrame:
    return t.raw("nation").select(F.col("n_name").alias("state"), F.col("n_nationkey").cast("bigint").alias("state_id"))


@job("strip_thousands", "SELECT record_id, value FROM v_production")
def strip_thousands(t: Tables) -> DataFrame:
    """Values that arrive as ``1,234,567`` text become numbers (all six production tables share this step)."""
    raw = t.raw("orders").select(F.col("o_orderkey").alias("record_id"), F.format_number(F.floor(F.col("o_totalprice").cast("decimal(18,2)")), 0).alias("text"))
    return raw.select("record_id", X.strip_thousands(F.col("text")).alias("value"))


@job("commodity_total", """SELECT 'O' AS commodity, sum(value)::BIGINT AS total FROM v_production WHERE year = 1998 AND commodity = 'O'
UNION ALL SELECT 'F', sum(value)::BIGINT FROM v_production WHERE year = 1997 AND commodity = 'F'""")
def commodity_total(t: Tables) -> DataFrame:
    """Total of two commodities, each in its year."""
    a = production(t, "O", 1998, by_state=False).agg(F.sum("value").alias("total")).select(F.lit("O").alias("commodity"), "total")
    b = production(t, "F", 1997, by_state=False).agg(F.sum("value").alias("total")).select(F.lit("F").alias("commodity"), "total")
    return a.unionByName(b)


@job("states_over", """SELECT s.n_name AS state, sum(p.value)::BIGINT AS total_production FROM v_production p JOIN nation s ON p.state_id = s.n_nationkey
WHERE p.year = 1998 AND p.period = 4 AND p.commodity = 'O' GROUP BY s.n_name HAVING sum(p.value) > 600000""")
def states_over(t: Tables) -> DataFrame:
    """States over a production limit in a month."""
    per = production(t, "O", 1998, 4).groupBy("state_id").agg(F.sum("value").alias("total_production")).where("total_production > 600000")
    return per.join(states(t), "state_id").select("state", "total_production")


@job("commodity_mean", "SELECT CAST(sum(value) AS DOUBLE) / count(value) AS avg_value FROM v_production WHERE year = 1999 AND commodity = 'P'")
def commodity_mean(t: Tables) -> DataFrame:
    return production(t, "P", 1999, by_state=False).agg(mean_of("value").alias("avg_value"))


@job("state_code", "SELECT n_name AS state, CAST(n_nationkey AS BIGINT) AS state_id FROM nation WHERE n_name = 'NATION_12'")
def state_code(t: Tables, state: str = "NATION_12") -> DataFrame:
    return states(t).where(F.col("state") == state)


@job("states_or_zero", """SELECT s.n_name AS state, CAST(coalesce(sum(p.value), 0) AS BIGINT) AS value FROM nation s LEFT JOIN v_production p
ON s.n_nationkey = p.state_id AND p.year = 1998 AND p.period = 4 AND p.commodity = 'O' AND p.value > 400000 GROUP BY s.n_name""")
def states_or_zero(t: Tables) -> DataFrame:
    """Every state with its production or zero: the filter belongs to the joined side."""
    per = production(t, "O", 1998, 4).where("value > 400000").groupBy("state_id").agg(F.sum("value").alias("v"))
    return states(t).join(per, "state_id", "left").select("state", F.coalesce("v", F.lit(0)).cast("bigint").alias("value"))


@job("states_or_null", """SELECT s.n_name AS state, p.record_id, p.value FROM nation s LEFT JOIN v_production p ON s.n_nationkey = p.state_id AND p.year = 1998 AND p.period = 4
AND p.commodity = 'O' AND p.value > 400000""")
def states_or_null(t: Tables) -> DataFrame:
    """Every state with its records, NULL where it has none."""
    rows = production(t, "O", 1998, 4).where("value > 400000")
    return states(t).join(rows, "state_id", "left").select("state", "record_id", "value")


@job("active_elsewhere", """SELECT sum(value)::BIGINT AS total FROM v_production WHERE year = 1998 AND commodity = 'P' AND state_id IN
(SELECT DISTINCT state_id FROM v_production WHERE year = 1998 AND commodity = 'O' AND period = 4 AND value > 400000)""")
def active_elsewhere(t: Tables) -> DataFrame:
    """Production of one commodity in states active in another (semi-join)."""
    active = production(t, "O", 1998, 4).where("value > 400000").select("state_id").distinct()
    per = production(t, "P", 1998).groupBy("state_id").agg(F.sum("value").alias("v"))
    return per.join(active, "state_id", "left_semi").agg(F.sum("v").alias("total"))


@job("missing_states", """SELECT count(DISTINCT n_nationkey) AS missing_states FROM nation WHERE n_nationkey NOT IN
(SELECT state_id FROM v_production WHERE year = 1998 AND commodity = 'F' AND period = 4 AND value > 450000)""")
def missing_states(t: Tables) -> DataFrame:
    made = production(t, "F", 1998, 4).where("value > 450000").select("state_id").distinct()
    return J.not_in(states(t), "state_id", made, "state_id").agg(F.countDistinct("state_id").alias("missing_states"))


@job("mean_in_high_years", """SELECT CAST(sum(value) AS DOUBLE) / count(value) AS avg_value FROM v_production WHERE commodity = 'F' AND year IN
(SELECT year FROM v_production WHERE commodity = 'P' GROUP BY year HAVING sum(value) > (SELECT CAST(sum(value) AS DOUBLE) / count(DISTINCT year) FROM v_production WHERE commodity = 'P'))""")
def mean_in_high_years(t: Tables) -> DataFrame:
    """Mean of one commodity in the years in which another was high: one pass gives yearly sums of both."""
    o = t.raw("orders").where(F.col("o_orderstatus").isin("F", "P"))
    v = F.floor(F.col("o_totalprice").cast("decimal(18,2)")).cast("bigint")
    f, p = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"
    years = o.groupBy(F.year("o_orderdate").alias("y")).agg(F.sum(F.when(f, v)).alias("fs"), count_if(f).alias("fn"), F.sum(F.when(p, v)).alias("ps"))
    limit = years.agg(mean(F.sum("ps"), F.count("ps"))).scalar()
    return years.where(dbl("ps") > limit).agg(mean(F.sum("fs"), F.sum("fn")).alias("avg_value"))


# -- reviews ----------------------------------------------------------------------------------------

view("v_business", """
SELECT p_partkey AS business_id, p_name AS name, CAST(1 + (p_size % 9) * 0.5 AS DECIMAL(9,1)) AS stars,
CASE p_partkey % 4 WHEN 0 THEN 'u''free''' WHEN 1 THEN 'u''no''' WHEN 3 THEN 'u''paid''' END AS wifi,
CASE p_partkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END AS outdoor, coalesce(n, 0) AS review_count
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) r ON p_partkey = l_partkey""")


def reviews(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(F.col("l_partkey").alias("business_id"), F.col("l_shipdate").alias("date"))


def business(t: Tables) -> DataFrame:
    """Businesses with attributes and the number of their reviews (counted before the join)."""
    k = F.col("p_partkey")
    n = reviews(t).groupBy("business_id").agg(F.count(F.lit(1)).alias("n"))
    b = t.raw("part").select(
        k.alias("business_id"), F.col("p_name").alias("name"), (F.lit(1) + (F.col("p_size") % 9) * F.expr("0.5BD")).cast("decimal(9,1)").alias("stars"),
        F.when(k % 4 == 0, "u'free'").when(k % 4 == 1, "u'no'").when(k % 4 == 3, "u'paid'").alias("wifi"),
        F.when(k % 3 == 0, "True").when(k % 3 == 1, "False").alias("outdoor"),
    )
    return b.join(n, "business_id", "left").withColumn("review_count", F.coalesce("n", F.lit(0))).drop("n")


@job("rating_global", f"SELECT {h('CAST(sum(stars) AS DOUBLE) / count(*)')} AS mean_rating, {h('CAST(sum(review_count) AS DOUBLE) / count(*)', 0)} AS mean_reviews FROM v_business")
def rating_global(t: Tables) -> DataFrame:
    return business(t).agg(half_up(mean_of("stars")).alias("mean_rating"), half_up(mean_of("review_count"), 0).alias("mean_reviews"))


@job("rating_stability", f"""SELECT CASE WHEN review_count > 30 THEN 'Élite (>30 reseñas)' ELSE 'Estándar (<=30 reseñas)' END AS volume_segment, count(*) AS places,
{h('CAST(sum(stars) AS DOUBLE) / count(*)')} AS mean_rating, CAST(min(stars) AS DOUBLE) AS min_rating, CAST(max(stars) AS DOUBLE) AS max_rating, CAST(max(stars) - min(stars) AS DOUBLE) AS volatility
FROM v_business GROUP BY 1""")
def rating_stability(t: Tables, elite: int = 30) -> DataFrame:
    """Rating level and range by review volume."""
    seg = F.when(F.col("review_count") > elite, f"Élite (>{elite} reseñas)").otherwise(f"Estándar (<={elite} reseñas)")
    return business(t).groupBy(seg.alias("volume_segment")).agg(
        F.count(F.lit(1)).alias("places"), half_up(mean_of("stars")).alias("mean_rating"), dbl(F.min("stars")).alias("min_rating"), dbl(F.max("stars")).alias("max_rating"),
        dbl(F.max("stars") - F.min("stars")).alias("volatility"))


@job("weekday_behaviour", f"""WITH d AS (SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 'Weekend' ELSE 'Weekday (Professional)' END AS day_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS s FROM events GROUP BY 1)
SELECT day_type, n AS total_reviews, {h('CAST(s AS DOUBLE) / n')} AS average_rating, {h('n * 100.0 / (SELECT sum(n) FROM d)', 1)} AS percentage_of_total FROM d""")
def weekday_behaviour(t: Tables) -> DataFrame:
    """Weekday against weekend with the share of the real total."""
    kind = F.when(D.is_weekend(F.col("ts")), "Weekend").otherwise("Weekday (Professional)")
    d = t.raw("events").groupBy(kind.alias("day_type")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("s"))
    total = d.agg(F.sum("n")).scalar()
    return d.select("day_type", F.col("n").alias("total_reviews"), half_up(mean(F.col("s"), F.col("n"))).alias("average_rating"),
                    half_up(dbl("n") * F.lit(100.0) / total, 1).alias("percentage_of_total"))


@job("attribute_effect", f"""SELECT CASE WHEN wifi ILIKE '%free%' THEN 'Con Wi-Fi Gratis' WHEN wifi ILIKE '%no%' OR wifi IS NULL THEN 'Sin Wi-Fi / No indicado' ELSE 'Otros (Pago)' END AS connection,
count(*) AS places, {h('CAST(sum(stars) AS DOUBLE) / count(*)')} AS mean_rating, {h('CAST(sum(review_count) AS DOUBLE) / count(*)', 1)} AS mean_reviews FROM v_business GROUP BY 1""")
def attribute_effect(t: Tables) -> DataFrame:
    w = F.col("wifi")
    kind = F.when(w.ilike("%free%"), "Con Wi-Fi Gratis").when(w.ilike("%no%") | w.isNull(), "Sin Wi-Fi / No indicado").otherwise("Otros (Pago)")
    return business(t).groupBy(kind.alias("connection")).agg(F.count(F.lit(1)).alias("places"), half_up(mean_of("stars")).alias("mean_rating"),
                                                             half_up(mean_of("review_count"), 1).alias("mean_reviews"))


@job("terrace_effect", f"""SELECT CASE WHEN outdoor = 'True' THEN 'Tiene Terraza' ELSE 'Solo Interior' END AS outside, count(*) AS places, {h('CAST(sum(stars) AS DOUBLE) / count(*)')} AS mean_rating FROM v_business GROUP BY 1""")
def terrace_effect(t: Tables) -> DataFrame:
    kind = F.when(F.col("outdoor") == "True", "Tiene Terraza").otherwise("Solo Interior")
    return business(t).groupBy(kind.alias("outside")).agg(F.count(F.lit(1)).alias("places"), half_up(mean_of("stars")).alias("mean_rating"))


@job("attributes_crossed", f"""SELECT CAST(wifi ILIKE '%free%' AS BIGINT) AS wifi_free, CAST(outdoor = 'True' AS BIGINT) AS terrace, count(*) AS places, {h('CAST(sum(stars) AS DOUBLE) / count(*)')} AS mean_rating
FROM v_business WHERE wifi IS NOT NULL AND outdoor IS NOT NULL GROUP BY 1, 2""")
def attributes_crossed(t: Tables) -> DataFrame:
    """Two predicates as grouping columns."""
    b = business(t).where("wifi IS NOT NULL AND outdoor IS NOT NULL")
    return b.groupBy(F.col("wifi").ilike("%free%").cast("int").cast("bigint").alias("wifi_free"), (F.col("outdoor") == "True").cast("int").cast("bigint").alias("terrace")).agg(
        F.count(F.lit(1)).alias("places"), half_up(mean_of("stars")).alias("mean_rating"))


_WIFI = "CAST(sum(CASE WHEN wifi ILIKE '%free%' THEN stars END) AS DOUBLE) / count(CASE WHEN wifi ILIKE '%free%' THEN stars END)"


@job("review_kpis", f"""WITH m AS (SELECT {_WIFI} AS w, CAST(sum(stars) AS DOUBLE) / count(*) AS g, count(CASE WHEN dayofweek(l_shipdate) NOT IN (0, 6) THEN 1 END) AS wd, count(CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 1 END) AS we
FROM v_business b JOIN lineitem ON b.business_id = l_partkey)
SELECT {h('w')} AS rating_wifi, {h('g')} AS rating_global, {h('w - g')} AS connectivity_premium, {h('CAST(wd AS DOUBLE) / we')} AS professional_index FROM m""")
def review_kpis(t: Tables) -> DataFrame:
    """Connectivity premium and professional index, ratings weighted by reviews.

    The weights are the review counts per business, so the big review side is aggregated before the join
    and the result equals the mean over the joined rows.
    """
    weekend = D.is_weekend(F.col("date"))
    n = reviews(t).groupBy("business_id").agg(F.count(F.lit(1)).alias("n"), count_if(weekend).alias("we"))
    k = F.col("p_partkey")
    b = t.raw("part").select(k.alias("business_id"), (F.lit(1) + (F.col("p_size") % 9) * F.expr("0.5BD")).cast("decimal(9,1)").alias("stars"), (k % 4 == 0).alias("free"))
    weighted = F.col("stars") * F.col("n")
    m = n.join(b, "business_id").agg(
        mean(F.sum(F.when(F.col("free"), weighted)), F.sum(F.when(F.col("free"), F.col("n")))).alias("w"), mean(F.sum(weighted), F.sum("n")).alias("g"),
        mean(F.sum(F.col("n") - F.col("we")), F.sum("we")).alias("idx"))
    return m.select(half_up(F.col("w")).alias("rating_wifi"), half_up(F.col("g")).alias("rating_global"), half_up(F.col("w") - F.col("g")).alias("connectivity_premium"),
                    half_up(F.col("idx")).alias("professional_index"))


@job("review_kpis_unweighted", f"""SELECT {h(f'(SELECT {_WIFI} FROM v_business) - (SELECT CAST(sum(stars) AS DOUBLE) / count(*) FROM v_business)')} AS connectivity_premium,
{h('CAST(count(CASE WHEN dayofweek(l_shipdate) NOT IN (0, 6) THEN 1 END) AS DOUBLE) / count(CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 1 END)')} AS professional_index FROM lineitem""")
def review_kpis_unweighted(t: Tables) -> DataFrame:
    """The same indicators with every business counted once."""
    premium = business(t).agg(half_up(avg_if(F.col("wifi").ilike("%free%"), F.col("stars")) - mean_of("stars"))).scalar()
    we = D.is_weekend(F.col("date"))
    return reviews(t).agg(half_up(mean(count_if(~we), count_if(we))).alias("professional_index")).select(premium.alias("connectivity_premium"), "professional_index")


@job("elite_text", "SELECT d.doc_id, d.source, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 AND l.toxic = 0")
def elite_text(t: Tables) -> DataFrame:
    """Whole texts of well-rated items, for mining."""
    good = t.raw("labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return t.raw("documents").select("doc_id", "source", "text").join(good, "doc_id")


# Punctuation treated as a separator.
PUNCTUATION = ".,;:!?()\"\n\t"


def term_statistics(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Term frequency, document frequency and tf-idf over whole texts.

    Counts are reduced to (text, term) first, so a frequent term costs one row per text in the second shuffle
    and one row per task in the third.
    """
    n = texts.agg(F.count(F.lit(1))).scalar()
    words = F.filter(F.split(F.translate(F.lower(text), PUNCTUATION, " " * len(PUNCTUATION)), " "), lambda w: w != "")
    per = texts.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    stats = per.groupBy("term").agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df"))
    return stats.withColumn("tf_idf", half_up(F.col("tf") * F.ln(n / F.col("df")), 6))


TERMS = f"""WITH e AS (SELECT d.doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 AND l.toxic = 0),
w AS (SELECT doc_id, unnest(string_split(translate(lower(text), '.,;:!?()"' || chr(10) || chr(9), '           '), ' ')) AS term FROM e),
p AS (SELECT doc_id, term, count(*) AS n FROM w WHERE term <> '' GROUP BY 1, 2), s AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM p GROUP BY 1)
SELECT term, tf, df, {h('tf * ln(CAST((SELECT count(*) FROM e) AS DOUBLE) / df)', 6)} AS tf_idf FROM s"""


@job("term_table", TERMS)
def term_table(t: Tables) -> DataFrame:
    """Every term of the extract with its counts and tf-idf weight."""
    return term_statistics(elite_text(t), "doc_id", "text")


@job("top_terms", TERMS + " ORDER BY tf DESC, term LIMIT 50")
def top_terms(t: Tables, k: int = 50) -> DataFrame:
    """Report of the ``k`` most frequent terms."""
    return term_table(t).orderBy(F.col("tf").desc(), "term").limit(k)
