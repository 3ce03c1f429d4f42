"""Store jobs: sequences, baskets, division, hierarchies, RFM, series, subquery drills, market reports."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import text as X
from tidegrain.functions.numbers import count_if, dbl, half_up, mean, mean_of, sum_if
from tidegrain.operators import joins as J
from tidegrain.operators import ranking as R
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job
from tidegrain.plans.store_basics import _per_customer
from tidegrain.session import shared_dir
from tidegrain.sources.tables import Tables



def _names(t: Tables) -> DataFrame:
    return t.customers.select("customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer"), "country")


def _sold(t: Tables, lines: DataFrame) -> DataFrame:
    """Lines with their customer: one shuffle on the invoice, a hot invoice is split by the adaptive skew join."""
    return lines.join(t.invoices.select("invoice_id", "customer_id"), "invoice_id")


def _genre_spend(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """(customer, genre) spend."""
    rows = (lines or t.lines).select("invoice_id", "track_id", "line_total").join(t.tracks.select("track_id", "genre"), "track_id")
    return _sold(t, rows).groupBy("customer_id", "genre").agg(F.sum("line_total").alias("genre_spend"))


@job("running_spend", """SELECT i.customer_id, c.first_name || ' ' || c.last_name AS customer, i.invoice_id, i.invoice_date, CAST(i.total AS DOUBLE) AS total,
CAST(sum(i.total) OVER (PARTITION BY i.customer_id ORDER BY i.invoice_date, i.invoice_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_spend
FROM v_invoice i JOIN v_customer c ON i.customer_id = c.customer_id""")
def running_spend(t: Tables) -> DataFrame:
    """Running spend per customer, carried over day blocks so that a hot customer is spread."""
    run = R.running_total(
        t.invoices, ["customer_id"], F.to_date("invoice_date"), [F.col("invoice_date"), F.col("invoice_id")], "total", "running_spend"
    )
    return run.join(_names(t).select("customer_id", "customer"), "customer_id").select(
        "customer_id", "customer", "invoice_id", "invoice_date", dbl("total").alias("total"), dbl("running_spend").alias("running_spend")
    )


@job("best_artist_country", """WITH v AS (SELECT c.country, e.name AS artist, sum(l.quantity)::BIGINT AS units_sold,
rank() OVER (PARTITION BY c.country ORDER BY sum(l.quantity) DESC) AS r
FROM v_customer c JOIN v_invoice i ON i.customer_id = c.customer_id JOIN v_line l ON l.invoice_id = i.invoice_id
JOIN v_employee e ON e.employee_id = l.artist_id GROUP BY c.country, e.name) SELECT country, artist, units_sold FROM v WHERE r = 1""")
def best_artist_country(t: Tables) -> DataFrame:
    """Best-selling artist per country, ties kept."""
    per = _sold(t, t.lines.select("invoice_id", "artist_id", "quantity")).groupBy("customer_id", "artist_id").agg(F.sum("quantity").alias("quantity"))
    units = per.join(t.customers.select("customer_id", "country"), "customer_id").groupBy("country", "artist_id").agg(F.sum("quantity").alias("units_sold"))
    artists = t.employees.select(F.col("employee_id").alias("artist_id"), F.col("name").alias("artist"))
    return R.top_of_group(units, ["country"], "units_sold").join(artists, "artist_id").select("country", "artist", "units_sold").orderBy("country")


@job("slowdown", f"""WITH a AS (SELECT customer_id, invoice_id, invoice_date AS cur, lag(invoice_date) OVER w AS prev FROM v_invoice WINDOW w AS (PARTITION BY customer_id ORDER BY invoice_date, invoice_id)),
b AS (SELECT *, CAST(round(epoch(cur - prev) / 86400.0) AS BIGINT) AS d1, lag(CAST(round(epoch(cur - prev) / 86400.0) AS BIGINT)) OVER (PARTITION BY customer_id ORDER BY cur, invoice_id) AS d0 FROM a WHERE prev IS NOT NULL)
SELECT b.customer_id, c.first_name || ' ' || c.last_name AS full_name, CAST(cur AS DATE) AS current_date_of_invoice, CAST(prev AS DATE) AS previous_date_of_invoice, d1 AS days_current, d0 AS days_previous,
printf('%.2fx', {h('CAST(d1 AS DOUBLE) / d0')}) AS slowdown_factor, d1 // d0 AS whole_factor FROM b JOIN v_customer c ON b.customer_id = c.customer_id WHERE d0 > 0 AND d1 >= 2 * d0""")
def slowdown(t: Tables) -> DataFrame:
    """Purchases at least twice as late as the gap before.

    Equal dates give zero gaps, which never qualify on either side; invoices are first reduced to one row per
    customer and date, so the window group is bounded by the number of dates, not of invoices.
    """
    days = t.invoices.groupBy("customer_id", "invoice_date").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("customer_id").orderBy("invoice_date")
    steps = (
        days.withColumn("prev", F.lag("invoice_date").over(w)).withColumn("prev_n", F.lag("n").over(w))
        .withColumn("d1", half_up(D.day_gap(F.col("invoice_date"), F.col("prev")), 0).cast("bigint"))
        .withColumn("d0", F.lag("d1").over(w))
    )
    hit = steps.where("prev_n = 1 AND d0 > 0 AND d1 >= 2 * d0")
    return hit.join(_names(t), "customer_id").select(
        "customer_id", F.col("customer").alias("full_name"), F.to_date("invoice_date").alias("current_date_of_invoice"),
        F.to_date("prev").alias("previous_date_of_invoice"), F.col("d1").alias("days_current"), F.col("d0").alias("days_previous"),
        F.format_string("%.2fx", half_up(mean(F.col("d1"), F.col("d0")))).alias("slowdown_factor"), F.expr("d1 div d0").alias("whole_factor"),
    ).orderBy(F.col("whole_factor").desc())


@job("basket_pairs", """WITH d AS (SELECT DISTINCT invoice_id, track_id FROM v_line), p AS (SELECT a.track_id AS a, b.track_id AS b, count(*) AS n FROM d a JOIN d b
ON a.invoice_id = b.invoice_id AND a.track_id < b.track_id GROUP BY 1, 2 HAVING count(*) >= 2), w AS (SELECT a AS o, b AS c, n FROM p UNION ALL SELECT b, a, n FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY n DESC, c) AS rn FROM w)
SELECT r.o AS track_id, t1.name AS original_track, t1.album AS original_album, r.c AS companion_id, t2.name AS companion_track, t2.album AS companion_album, r.n AS times_together
FROM r JOIN v_track t1 ON t1.track_id = r.o JOIN v_track t2 ON t2.track_id = r.c WHERE rn = 1""")
def basket_pairs(t: Tables) -> DataFrame:
    """Best companion of every track (bought together at least twice)."""
    best = J.best_companion(t.lines, "invoice_id", "track_id")
    a = t.tracks.select(F.col("track_id").alias("origin"), F.col("name").alias("original_track"), F.col("album").alias("original_album"))
    b = t.tracks.select(F.col("track_id").alias("companion"), F.col("name").alias("companion_track"), F.col("album").alias("companion_album"))
    return best.join(a, "origin").join(b, "companion").select(
        F.col("origin").alias("track_id"), "original_track", "original_album", F.col("companion").alias("companion_id"), "companion_track",
        "companion_album", F.col("together").alias("times_together"),
    )


@job("covers_all", """SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer, c.country,
(SELECT count(DISTINCT t.media_type) FROM v_invoice i JOIN v_line l ON l.invoice_id = i.invoice_id JOIN v_track t ON t.track_id = l.track_id WHERE i.customer_id = c.customer_id) AS distinct_formats,
(SELECT CAST(sum(l.line_total) AS DOUBLE) FROM v_invoice i JOIN v_line l ON l.invoice_id = i.invoice_id WHERE i.customer_id = c.customer_id) AS total_spent
FROM v_customer c WHERE (SELECT count(DISTINCT t.media_type) FROM v_invoice i JOIN v_line l ON l.invoice_id = i.invoice_id JOIN v_track t ON t.track_id = l.track_id
WHERE i.customer_id = c.customer_id) = (SELECT count(DISTINCT media_type) FROM v_track)""")
def covers_all(t: Tables) -> DataFrame:
    """Customers who bought every format (relational division over all purchases)."""
    rows = t.lines.select("invoice_id", "track_id", "line_total").join(t.tracks.select("track_id", "media_type"), "track_id")
    pairs = _sold(t, rows).groupBy("customer_id", "media_type").agg(F.sum("line_total").alias("s"))
    all_of = J.divide(pairs, "customer_id", "media_type", t.tracks, distinct_formats=F.count("media_type"), total_spent=dbl(F.sum("s")))
    return all_of.join(_names(t), "customer_id").select(
        "customer_id", "customer", "country", "distinct_formats", "total_spent"
    ).orderBy(F.col("total_spent").desc())


@job("undecided_taste", f"""WITH g AS (SELECT i.customer_id, t.genre, sum(l.line_total) AS s FROM v_invoice i JOIN v_line l ON l.invoice_id = i.invoice_id JOIN v_track t ON t.track_id = l.track_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s DESC, genre) AS p FROM g),
d AS (SELECT customer_id, max(CASE WHEN p = 1 THEN genre END) AS g1, max(CASE WHEN p = 1 THEN s END) AS s1, max(CASE WHEN p = 2 THEN genre END) AS g2, max(CASE WHEN p = 2 THEN s END) AS s2 FROM r WHERE p IN (1, 2) GROUP BY 1)
SELECT c.first_name || ' ' || c.last_name AS customer, c.country, g1 AS favourite_genre, CAST(s1 AS DOUBLE) AS favourite_spend, g2 AS second_genre, CAST(s2 AS DOUBLE) AS second_spend,
CAST(s1 - s2 AS DOUBLE) AS difference, {h('100.0 * CAST(s1 - s2 AS DOUBLE) / CAST(s1 AS DOUBLE)')} AS difference_pct FROM d JOIN v_customer c ON c.customer_id = d.customer_id
WHERE g2 IS NOT NULL AND (s1 - s2) * 5 < s1""")
def undecided_taste(t: Tables) -> DataFrame:
    """First and second genre within 20 % of the first (a customer has one row per genre at this point)."""
    top = R.first_per_key(_genre_spend(t), ["customer_id"], [F.col("genre_spend").desc(), F.col("genre").asc()], 2, "p")
    first, second = F.col("p") == 1, F.col("p") == 2
    d = top.groupBy("customer_id").agg(
        F.max(F.when(first, F.col("genre"))).alias("g1"), F.max(F.when(first, F.col("genre_spend"))).alias("s1"),
        F.max(F.when(second, F.col("genre"))).alias("g2"), F.max(F.when(second, F.col("genre_spend"))).alias("s2"),
    )
    gap = F.col("s1") - F.col("s2")
    return d.where(F.col("g2").isNotNull() & (gap * 5 < F.col("s1"))).join(_names(t), "customer_id").select(
        "customer", "country", F.col("g1").alias("favourite_genre"), dbl("s1").alias("favourite_spend"), F.col("g2").alias("second_genre"),
        dbl("s2").alias("second_spend"), dbl(gap).alias("difference"), half_up(F.lit(100.0) * dbl(gap) / dbl("s1")).alias("difference_pct"),
    ).orderBy("difference_pct")


@job("team_sales", """WITH RECURSIVE j(manager_id, sub_id, lvl) AS (SELECT employee_id, employee_id, 0 FROM v_employee UNION ALL
SELECT j.manager_id, e.employee_id, j.lvl + 1 FROM j JOIN v_employee e ON e.reports_to = j.sub_id),
v AS (SELECT c.support_rep_id AS employee_id, sum(l.line_total) AS s FROM v_customer c JOIN v_invoice i ON i.customer_id = c.customer_id JOIN v_line l ON l.invoice_id = i.invoice_id GROUP BY 1),
r AS (SELECT j.manager_id, count(DISTINCT CASE WHEN sub_id <> manager_id THEN sub_id END) AS n, max(lvl) AS d, sum(coalesce(v.s, 0)) AS s FROM j LEFT JOIN v ON v.employee_id = j.sub_id GROUP BY 1)
SELECT e.name AS manager, r.n AS subordinates, CAST(r.d AS BIGINT) AS max_depth, CAST(r.s AS DOUBLE) AS team_sales FROM r JOIN v_employee e ON e.employee_id = r.manager_id WHERE r.n > 0""")
def team_sales(t: Tables) -> DataFrame:
    """Team size, depth and sales of every manager, rolled up the hierarchy with one row per employee."""
    per_inv = t.lines.groupBy("invoice_id").agg(F.sum("line_total").alias("s"))
    per_cust = per_inv.join(t.invoices.select("invoice_id", "customer_id"), "invoice_id").groupBy("customer_id").agg(F.sum("s").alias("s"))
    sales = per_cust.join(t.customers.select("customer_id", "support_rep_id"), "customer_id").groupBy(F.col("support_rep_id").alias("employee_id")).agg(F.sum("s").alias("s"))
    nodes = t.employees.select("employee_id", "reports_to").join(sales, "employee_id", "left").withColumn("s", F.coalesce("s", F.lit(0)))
    teams = J.roll_up(nodes, "employee_id", "reports_to", "s").select(
        F.col("node").alias("employee_id"), F.col("members").alias("subordinates"), F.col("depth").alias("max_depth"), F.col("total").alias("s"))
    return teams.where("subordinates > 0").join(t.employees, "employee_id").select(
        F.col("name").alias("manager"), "subordinates", "max_depth", dbl("s").alias("team_sales")
    ).orderBy(F.col("team_sales").desc())


@job("buying_streaks", """WITH m AS (SELECT DISTINCT customer_id, date_trunc('month', invoice_date)::DATE AS mes FROM v_invoice),
i AS (SELECT *, mes - to_months(CAST(row_number() OVER (PARTITION BY customer_id ORDER BY mes) AS INTEGER)) AS isl FROM m),
r AS (SELECT customer_id, isl, min(mes) AS a, max(mes) AS b, count(*) AS n FROM i GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, a) AS rn FROM r)
SELECT c.first_name || ' ' || c.last_name AS customer, a AS streak_start, b AS streak_end, n AS months FROM p JOIN v_customer c ON c.customer_id = p.customer_id WHERE rn = 1 AND n >= 2""")
def buying_streaks(t: Tables) -> DataFrame:
    """Longest run of consecutive buying months per customer."""
    months = t.invoices.select("customer_id", D.month_floor(F.col("invoice_date")).alias("month")).distinct()
    runs = R.longest_islands(months, ["customer_id"], "month").where("run_months >= 2")
    return runs.join(_names(t), "customer_id").select(
        "customer", F.col("run_start").alias("streak_start"), F.col("run_end").alias("streak_end"), F.col("run_months").alias("months")
    ).orderBy(F.col("months").desc(), "customer")


@job("rfm", """WITH m AS (SELECT i.customer_id, max(i.invoice_date) AS lastd, count(DISTINCT i.invoice_id) AS f, sum(l.line_total) AS s FROM v_invoice i JOIN v_line l ON l.invoice_id = i.invoice_id GROUP BY 1),
d AS (SELECT *, CAST(floor(epoch((SELECT max(invoice_date) FROM v_invoice) - lastd) / 86400.0) AS BIGINT) AS days FROM m),
q AS (SELECT *, ntile(4) OVER (ORDER BY days DESC, customer_id) AS rq, ntile(4) OVER (ORDER BY f, customer_id) AS fq, ntile(4) OVER (ORDER BY s, customer_id) AS mq FROM d)
SELECT q.customer_id, c.first_name || ' ' || c.last_name AS customer, days AS days_since, f AS frequency, CAST(s AS DOUBLE) AS total_spent, rq AS r, fq AS f, mq AS m, rq * 100 + fq * 10 + mq AS score,
CASE WHEN rq = 4 AND fq = 4 AND mq = 4 THEN 'Campeón' WHEN rq = 1 AND fq >= 3 AND mq >= 3 THEN 'En riesgo' WHEN rq = 4 AND fq <= 2 THEN 'Nuevo prometedor' ELSE 'Otro' END AS segment
FROM q JOIN v_customer c ON c.customer_id = q.customer_id""".replace("fq AS f, mq AS m", "fq AS f_tile, mq AS m_tile").replace("rq AS r,", "rq AS r_tile,"))
def rfm(t: Tables) -> DataFrame:
    """Recency, frequency, money quartiles; the totals are computed once, and a tile is told by the three cut points of its measure."""
    shared_dir(t.spark)
    per_inv = t.lines.groupBy("invoice_id").agg(F.sum("line_total").alias("s"))
    per_cust = per_inv.join(t.invoices.select("invoice_id", "customer_id", "invoice_date"), "invoice_id").groupBy("customer_id").agg(
        F.max("invoice_date").alias("last"), F.count(F.lit(1)).alias("frequency"), F.sum("s").alias("s")
    )
    newest = t.invoices.agg(F.max("invoice_date")).scalar()
    base = per_cust.withColumn("days_since", F.floor(D.day_gap(newest, F.col("last"))).cast("bigint")).drop("last").checkpoint()
    for rising, tile in ((-F.col("days_since"), "r_tile"), (F.col("frequency"), "f_tile"), (F.col("s"), "m_tile")):
        base = R.with_ntile(base, 4, [rising, F.col("customer_id")], tile)
    r, f, m = F.col("r_tile"), F.col("f_tile"), F.col("m_tile")
    segment = (
        F.when((r == 4) & (f == 4) & (m == 4), "Campeón").when((r == 1) & (f >= 3) & (m >= 3), "En riesgo")
        .when((r == 4) & (f <= 2), "Nuevo prometedor").otherwise("Otro")
    )
    return base.join(_names(t), "customer_id").select(
        "customer_id", "customer", "days_since", "frequency", dbl("s").alias("total_spent"), "r_tile", "f_tile", "m_tile",
        (r * 100 + f * 10 + m).alias("score"), segment.alias("segment"),
    )


@job("revenue_series", f"""WITH m AS (SELECT strftime(invoice_date, '%Y-%m') AS mes, sum(total) AS s FROM v_invoice GROUP BY 1),
w AS (SELECT mes, s, CAST(sum(s) OVER (ORDER BY mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (ORDER BY mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mm,
sum(s) OVER (ORDER BY mes ROWS UNBOUNDED PRECEDING) AS acc, lag(s) OVER (ORDER BY mes) AS prev FROM m)
SELECT mes AS month, CAST(s AS DOUBLE) AS revenue, {h('mm')} AS moving_mean_3m, CAST(acc AS DOUBLE) AS running_revenue,
CASE WHEN prev IS NOT NULL THEN {h('100.0 * CAST(s - prev AS DOUBLE) / CAST(prev AS DOUBLE)')} END AS change_pct,
CASE WHEN prev IS NOT NULL AND (s - prev) * 100 < -15 * prev THEN 'ALERTA' ELSE '' END AS notice FROM w""")
def revenue_series(t: Tables) -> DataFrame:
    """Monthly revenue with three-month mean, running sum, change and alert; windows see months only."""
    months = t.invoices.groupBy(D.period(F.col("invoice_date")).alias("month")).agg(F.sum("total").alias("s"))
    w = W.orderBy("month")
    last3, upto = w.rowsBetween(-2, 0), w.rowsBetween(W.unboundedPreceding, 0)
    s, prev = F.col("s"), F.col("prev")
    out = (
        months.withColumn("mm", mean(F.sum("s").over(last3), F.count("s").over(last3)))
        .withColumn("acc", F.sum("s").over(upto)).withColumn("prev", F.lag("s").over(w))
    )
    return out.select(
        "month", dbl("s").alias("revenue"), half_up(F.col("mm")).alias("moving_mean_3m"), dbl("acc").alias("running_revenue"),
        half_up(F.lit(100.0) * dbl(s - prev) / dbl(prev)).alias("change_pct"),
        F.when(prev.isNotNull() & ((s - prev) * 100 < prev * -15), "ALERTA").otherwise("").alias("notice"),
    )


@job("vip_country", """SELECT c.first_name, c.last_name, c.email, CAST(sum(i.total) AS DOUBLE) AS total_spent FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id
WHERE c.country = 'NATION_2' GROUP BY c.customer_id, c.first_name, c.last_name, c.email
HAVING CAST(sum(i.total) AS DOUBLE) > (SELECT CAST(sum(s) AS DOUBLE) / count(*) FROM (SELECT sum(total) AS s FROM v_invoice GROUP BY customer_id))""")
def vip_country(t: Tables, country: str = "NATION_2") -> DataFrame:
    """Customers of a country who spend over the mean customer total."""
    spend = _per_customer(t.invoices)
    avg_spend = spend.agg(mean_of("spent")).scalar()
    return spend.where(dbl("spent") > avg_spend).join(t.customers.where(F.col("country") == country), "customer_id").select(
        "first_name", "last_name", "email", dbl("spent").alias("total_spent")
    )


@job("tracks_of_genre", "SELECT track_id, name AS track_name, genre FROM v_track WHERE genre IN (SELECT genre FROM v_track WHERE name = 'hot gear') ORDER BY track_id LIMIT 10")
def tracks_of_genre(t: Tables) -> DataFrame:
    """First ten tracks of the genres that hold a named track (semi-join and top-k sample)."""
    return t.tracks.join(t.tracks.where("name = 'hot gear'").select("genre"), "genre", "left_semi").select(
        "track_id", F.col("name").alias("track_name"), "genre").orderBy("track_id").limit(10)


@job("market_map", """SELECT first_name, last_name, country, CASE WHEN country IN ('NATION_1','NATION_6') THEN 'North_America'
WHEN country IN ('NATION_0','NATION_5','NATION_11') THEN 'South_America' ELSE 'Rest of the World' END AS market_type FROM v_customer""")
def market_map(t: Tables) -> DataFrame:
    c = F.col("country")
    return t.customers.select("first_name", "last_name", "country", F.when(c.isin("NATION_1", "NATION_6"), "North_America")
                              .when(c.isin("NATION_0", "NATION_5", "NATION_11"), "South_America").otherwise("Rest of the World").alias("market_type"))


_AVG = "(SELECT CAST(sum(total) AS DOUBLE) / count(total) FROM v_invoice)"


@job("above_mean_invoices", f"SELECT invoice_id, customer_id, invoice_date, CAST(total AS DOUBLE) AS total FROM v_invoice WHERE CAST(total AS DOUBLE) > {_AVG}")
def above_mean_invoices(t: Tables) -> DataFrame:
    avg_total = t.invoices.agg(mean_of("total")).scalar()
    return t.invoices.where(dbl("total") > avg_total).withColumn("total", dbl("total"))


@job("vs_global_mean", f"""SELECT invoice_id, invoice_date, CAST(total AS DOUBLE) AS total, {h(_AVG)} AS average_global_total,
CASE WHEN total IS NULL THEN 'NULL' WHEN CAST(total AS DOUBLE) > {_AVG} THEN 'Above Average' WHEN CAST(total AS DOUBLE) < {_AVG} THEN 'Below Average' ELSE 'Average' END AS performance,
{h(f'CAST(total AS DOUBLE) - {_AVG}')} AS difference FROM v_invoice""")
def vs_global_mean(t: Tables) -> DataFrame:
    """Each invoice against the global mean (one scalar, used three times)."""
    avg_total = t.invoices.agg(mean_of("total")).scalar()
    x = dbl("total")
    return t.invoices.withColumn("_avg", avg_total).select(
        "invoice_id", "invoice_date", x.alias("total"), half_up(F.col("_avg")).alias("average_global_total"),
        F.when(x.isNull(), "NULL").when(x > F.col("_avg"), "Above Average").when(x < F.col("_avg"), "Below Average").otherwise("Average").alias("performance"),
        half_up(x - F.col("_avg")).alias("difference"),
    )


@job("existing_categories", "SELECT e.name FROM v_artist e WHERE EXISTS (SELECT 1 FROM v_line l WHERE l.artist_id = e.employee_id)")
def existing_categories(t: Tables) -> DataFrame:
    sold = t.lines.select(F.col("artist_id").alias("employee_id"))
    return t.artists.join(sold, "employee_id", "left_semi").select("name")


@job("empty_categories", """WITH g AS (SELECT DISTINCT genre FROM v_track), a AS (SELECT genre FROM g UNION ALL SELECT 'NEW ' || genre FROM g)
SELECT genre FROM a WHERE NOT EXISTS (SELECT 1 FROM v_track t WHERE t.genre = a.genre)""")
def empty_categories(t: Tables) -> DataFrame:
    """Genres of the catalogue plan (every genre and a new one planned beside it) without a track."""
    known = t.tracks.select("genre").distinct()
    planned = known.unionByName(known.select(F.concat(F.lit("NEW "), "genre").alias("genre")))
    return planned.join(t.tracks.select("genre"), "genre", "left_anti")


@job("most_expensive", "SELECT track_id, name, CAST(unit_price AS DOUBLE) AS unit_price FROM v_track WHERE unit_price >= (SELECT max(unit_price) FROM v_track)")
def most_expensive(t: Tables) -> DataFrame:
    """``>= ALL`` written with the maximum."""
    top = t.tracks.agg(F.max("unit_price")).scalar()
    return t.tracks.where(F.col("unit_price") >= top).select("track_id", "name", dbl("unit_price").alias("unit_price"))


@job("max_per_country", "SELECT country, invoice_id, CAST(total AS DOUBLE) AS total FROM v_inv_country x WHERE total = (SELECT max(total) FROM v_inv_country y WHERE y.country = x.country)")
def max_per_country(t: Tables) -> DataFrame:
    """Largest invoice per country, ties kept."""
    return R.top_of_group(t.invoices_by_country.select("country", "invoice_id", "total"), ["country"], "total").withColumn("total", dbl("total"))


@job("album_filters", """SELECT album AS album_title, count(track_id) AS tracks, sum(milliseconds)::BIGINT AS total_milliseconds, CAST(count(track_id) > 4 AS BIGINT) AS many_tracks,
CAST(sum(milliseconds) > 1800000 AS BIGINT) AS long_album FROM v_track GROUP BY album HAVING count(track_id) > 4 OR sum(milliseconds) > 1800000""")
def album_filters(t: Tables) -> DataFrame:
    """Albums with many tracks or a long running time."""
    g = t.tracks.groupBy(F.col("album").alias("album_title")).agg(F.count("track_id").alias("tracks"), F.sum("milliseconds").alias("total_milliseconds"))
    many, long = F.col("tracks") > 4, F.col("total_milliseconds") > 1800000
    return g.where(many | long).select("*", many.cast("bigint").alias("many_tracks"), long.cast("bigint").alias("long_album"))


@job("exceptional_invoices", """SELECT customer_id, invoice_id, CAST(total AS DOUBLE) AS total FROM v_invoice i WHERE CAST(total AS DOUBLE) > 1.9 *
(SELECT CAST(sum(total) AS DOUBLE) / count(total) FROM v_invoice x WHERE x.customer_id = i.customer_id)""")
def exceptional_invoices(t: Tables, factor: float = 1.9) -> DataFrame:
    """Invoices far above the customer's own mean."""
    rows = R.with_group_stats(t.invoices, ["customer_id"], own_mean=mean_of("total"))
    return rows.where(dbl("total") > F.lit(factor) * F.col("own_mean")).select("customer_id", "invoice_id", dbl("total").alias("total"))


@job("invoice_periods", """SELECT invoice_id, invoice_date, strftime(invoice_date, '%Y-%m') AS period, CAST(strftime(invoice_date, '%W') AS BIGINT) AS week_of_year FROM v_invoice""")
def invoice_periods(t: Tables) -> DataFrame:
    d = F.col("invoice_date")
    return t.invoices.select("invoice_id", "invoice_date", D.period(d).alias("period"), D.week_monday(d).alias("week_of_year"))


@job("vs_previous_month", f"""WITH f AS (SELECT CAST(sum(total) AS DOUBLE) / count(total) AS a FROM v_invoice WHERE invoice_date >= TIMESTAMP '1998-02-01' AND invoice_date < TIMESTAMP '1998-03-01')
SELECT invoice_id, invoice_date, CAST(total AS DOUBLE) AS total, {h('f.a')} AS february_mean FROM v_invoice, f
WHERE invoice_date >= TIMESTAMP '1998-03-01' AND invoice_date < TIMESTAMP '1998-04-01' AND CAST(total AS DOUBLE) > f.a""")
def vs_previous_month(t: Tables) -> DataFrame:
    """Invoices of a month above the mean of a fixed earlier month; both scans are range-pruned."""
    d = F.col("invoice_date")
    feb = t.invoices.where(D.between_days(d, "1998-02-01", "1998-02-28")).agg(mean_of("total")).scalar()
    return t.invoices.where(D.between_days(d, "1998-03-01", "1998-03-31")).withColumn("_a", feb).where(dbl("total") > F.col("_a")).select(
        "invoice_id", "invoice_date", dbl("total").alias("total"), half_up(F.col("_a")).alias("february_mean"))


def _month_mean_sql(keys: str) -> str:
    return f"""WITH a AS (SELECT *, CAST(sum(total) OVER (PARTITION BY {keys}) AS DOUBLE) / count(total) OVER (PARTITION BY {keys}) AS m FROM v_invoice)
SELECT invoice_id, invoice_date, CAST(total AS DOUBLE) AS total, {h('m')} AS month_mean FROM a WHERE CAST(total AS DOUBLE) > m"""


def _above_month_mean(t: Tables, keys: list[str]) -> DataFrame:
    d = F.col("invoice_date")
    rows = t.invoices.withColumn("_m", F.month(d)).withColumn("_y", F.year(d))
    rows = R.with_group_stats(rows, keys, stage=True, m=mean_of("total"))
    return rows.where(dbl("total") > F.col("m")).select("invoice_id", "invoice_date", dbl("total").alias("total"), half_up(F.col("m")).alias("month_mean"))


@job("vs_month_mean", _month_mean_sql("month(invoice_date)"))
def vs_month_mean(t: Tables) -> DataFrame:
    """Invoices above the mean of the same calendar month over all years."""
    return _above_month_mean(t, ["_m"])


@job("vs_year_month_mean", _month_mean_sql("year(invoice_date), month(invoice_date)"))
def vs_year_month_mean(t: Tables) -> DataFrame:
    """Invoices above the mean of their own month."""
    return _above_month_mean(t, ["_y", "_m"])


_YEARLY = """SELECT c.first_name, c.last_name, CAST(sum(i.total) AS DOUBLE) AS total_customer FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id
WHERE {0} GROUP BY c.customer_id, c.first_name, c.last_name HAVING sum(i.total) > 500000"""


@job("yearly_customers", _YEARLY.format("year(i.invoice_date) = 1998"))
def yearly_customers(t: Tables) -> DataFrame:
    """Customers over a limit in a year: the year is written as a range, so the scan can skip row groups."""
    spend = _per_customer(t.invoices.where(D.in_year(F.col("invoice_date"), 1998))).where("spent > 500000")
    return spend.join(t.customers, "customer_id").select("first_name", "last_name", dbl("spent").alias("total_customer"))


@job("yearly_customers_by_function", _YEARLY.format("i.invoice_date >= TIMESTAMP '1998-01-01' AND i.invoice_date < TIMESTAMP '1999-01-01'"))
def yearly_customers_by_function(t: Tables) -> DataFrame:
    """The same result with the filter on ``year()``, kept to compare the plans."""
    spend = _per_customer(t.invoices.where(F.year("invoice_date") == 1998)).where("spent > 500000")
    return spend.join(t.customers, "customer_id").select("first_name", "last_name", dbl("spent").alias("total_customer"))


@job("genre_revenue", """SELECT t.genre AS genre_name, CAST(sum(l.line_total) AS DOUBLE) AS revenue, sum(l.quantity)::BIGINT AS units_sold
FROM v_track t JOIN v_line l ON t.track_id = l.track_id GROUP BY t.genre HAVING sum(l.quantity) > 100""")
def genre_revenue(t: Tables) -> DataFrame:
    """Revenue per genre; lines are summed per track before the join."""
    per = t.lines.groupBy("track_id").agg(F.sum("line_total").alias("s"), F.sum("quantity").alias("q"))
    return per.join(t.tracks.select("track_id", "genre"), "track_id").groupBy(F.col("genre").alias("genre_name")).agg(
        dbl(F.sum("s")).alias("revenue"), F.sum("q").alias("units_sold")).where("units_sold > 100")


@job("inactive_in_year", """SELECT customer_id, first_name, email FROM v_customer WHERE customer_id NOT IN (SELECT DISTINCT customer_id FROM v_invoice WHERE year(invoice_date) = 2001)""")
def inactive_in_year(t: Tables, year: int = 2001) -> DataFrame:
    """Customers without an invoice in a year (``NOT IN`` with its NULL rules, as a shuffled anti-join)."""
    active = t.invoices.where(D.in_year(F.col("invoice_date"), year)).select("customer_id")
    return J.not_in(t.customers.select("customer_id", "first_name", "email"), "customer_id", active, "customer_id")


@job("top3_months", f"SELECT {h('CAST(sum(s) AS DOUBLE) / count(*)')} AS avg_top_3_months FROM (SELECT sum(total) AS s FROM v_invoice GROUP BY strftime(invoice_date, '%Y-%m') ORDER BY s DESC LIMIT 3)")
def top3_months(t: Tables) -> DataFrame:
    months = t.invoices.groupBy(D.period(F.col("invoice_date")).alias("p")).agg(F.sum("total").alias("s"))
    return months.orderBy(F.col("s").desc()).limit(3).agg(half_up(mean_of("s")).alias("avg_top_3_months"))


@job("retention_risk", """WITH p AS (SELECT customer_id, sum(total) AS s FROM v_invoice WHERE invoice_date >= TIMESTAMP '1995-01-01' AND invoice_date < TIMESTAMP '1997-01-01' GROUP BY 1 HAVING sum(total) > 1000000),
r AS (SELECT customer_id, sum(CASE WHEN invoice_date >= TIMESTAMP '2000-01-01' AND invoice_date < TIMESTAMP '2002-01-01' THEN total ELSE 0 END) AS s FROM v_invoice GROUP BY 1)
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, CAST(p.s AS DOUBLE) AS historic_revenue, CAST(r.s AS DOUBLE) AS recent_revenue, CAST(p.s - r.s AS DOUBLE) AS revenue_drop
FROM p JOIN v_customer c ON c.customer_id = p.customer_id LEFT JOIN r ON r.customer_id = p.customer_id""")
def retention_risk(t: Tables) -> DataFrame:
    """Past top customers against the recent period: both periods come from one pass over the invoices."""
    d, total = F.col("invoice_date"), F.col("total")
    g = t.invoices.groupBy("customer_id").agg(
        F.sum(F.when(D.between_days(d, "1995-01-01", "1996-12-31"), total)).alias("past"), sum_if(D.between_days(d, "2000-01-01", "2001-12-31"), total).alias("recent"))
    return g.where("past > 1000000").join(_names(t), "customer_id").select(
        "customer_id", F.col("customer").alias("customer_name"), dbl("past").alias("historic_revenue"), dbl("recent").alias("recent_revenue"),
        dbl(F.col("past") - F.col("recent")).alias("revenue_drop"))


def _by_country(t: Tables, *aggs, inv: DataFrame | None = None) -> DataFrame:
    """Invoices reduced per customer, then per country."""
    per = (inv or t.invoices).groupBy("customer_id").agg(*aggs)
    return per.join(t.customers.select("customer_id", "country"), "customer_id")


@job("market_status", f"""SELECT country, count(invoice_id) AS total_orders, CAST(sum(total) AS DOUBLE) AS gross_revenue, {h('CAST(sum(total) AS DOUBLE) / count(*)')} AS average_ticket,
CASE WHEN sum(total) > 150000000 THEN 'Prioritario' ELSE 'Estrategia de Crecimiento' END AS market_status FROM v_inv_country WHERE country IS NOT NULL GROUP BY country""")
def market_status(t: Tables) -> DataFrame:
    g = _by_country(t, F.count("invoice_id").alias("n"), F.sum("total").alias("s")).where("country IS NOT NULL").groupBy("country").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return g.select("country", F.col("n").alias("total_orders"), dbl("s").alias("gross_revenue"), half_up(mean(F.col("s"), F.col("n"))).alias("average_ticket"),
                    F.when(F.col("s") > 150000000, "Prioritario").otherwise("Estrategia de Crecimiento").alias("market_status"))


@job("vip_share", f"""WITH v AS (SELECT customer_id FROM v_invoice GROUP BY 1 HAVING sum(total) > 3000000)
SELECT country, CAST(sum(total) AS DOUBLE) AS country_sales, CAST(sum(CASE WHEN customer_id IN (SELECT customer_id FROM v) THEN total ELSE 0 END) AS DOUBLE) AS vip_sales,
{h('CAST(sum(CASE WHEN customer_id IN (SELECT customer_id FROM v) THEN total ELSE 0 END) AS DOUBLE) * 100.0 / CAST(sum(total) AS DOUBLE)')} AS vip_pct
FROM v_inv_country WHERE country = 'NATION_1' GROUP BY country""")
def vip_share(t: Tables, country: str = "NATION_1") -> DataFrame:
    """Share of the best customers in a country: the per-customer sums decide and are summed again, no second scan."""
    g = _by_country(t, F.sum("total").alias("s")).where(F.col("country") == country)
    vip = sum_if(F.col("s") > 3000000, F.col("s"))
    return g.groupBy("country").agg(dbl(F.sum("s")).alias("country_sales"), dbl(vip).alias("vip_sales"), half_up(dbl(vip) * F.lit(100.0) / dbl(F.sum("s"))).alias("vip_pct"))


@job("small_vs_large", """SELECT country, CAST(sum(CASE WHEN total < 250000 THEN total ELSE 0 END) AS DOUBLE) AS small_invoices, CAST(sum(CASE WHEN total >= 250000 THEN total ELSE 0 END) AS DOUBLE) AS large_invoices,
sum(CASE WHEN total >= 250000 THEN 1 ELSE 0 END)::BIGINT AS large_count FROM v_inv_country GROUP BY country""")
def small_vs_large(t: Tables) -> DataFrame:
    small, big = F.col("total") < 250000, F.col("total") >= 250000
    g = _by_country(t, sum_if(small, F.col("total")).alias("a"), sum_if(big, F.col("total")).alias("b"), count_if(big).alias("n"))
    return g.groupBy("country").agg(dbl(F.sum("a")).alias("small_invoices"), dbl(F.sum("b")).alias("large_invoices"), F.sum("n").alias("large_count"))


@job("churn", """WITH u AS (SELECT customer_id, country, max(invoice_date) AS d FROM v_inv_country GROUP BY 1, 2)
SELECT u.country, sum(CASE WHEN year(d) <= 2000 THEN 1 ELSE 0 END)::BIGINT AS dormant, sum(CASE WHEN year(d) >= 2001 THEN 1 ELSE 0 END)::BIGINT AS active,
CAST(sum(CASE WHEN year(d) >= 2001 THEN i.total ELSE 0 END) AS DOUBLE) AS active_total FROM u JOIN v_invoice i ON u.customer_id = i.customer_id GROUP BY u.country""")
def churn(t: Tables, last_year: int = 2000) -> DataFrame:
    """Dormant and active customers per country, counted once per invoice row as in the original report."""
    g = _by_country(t, F.max("invoice_date").alias("d"), F.count(F.lit(1)).alias("n"), F.sum("total").alias("s"))
    dormant, active = F.year("d") <= last_year, F.year("d") > last_year
    zero = F.lit(0).cast("bigint")
    return g.groupBy("country").agg(F.sum(F.when(dormant, F.col("n")).otherwise(zero)).alias("dormant"), F.sum(F.when(active, F.col("n")).otherwise(zero)).alias("active"),
                                    dbl(sum_if(active, F.col("s"))).alias("active_total"))


@job("length_revenue", f"""SELECT genre AS genre_name, CAST(sum(line_total) AS DOUBLE) AS total_revenue, CAST(sum(CASE WHEN milliseconds < 180000 THEN line_total ELSE 0 END) AS DOUBLE) AS short_revenue,
CAST(sum(CASE WHEN milliseconds > 300000 THEN line_total ELSE 0 END) AS DOUBLE) AS long_revenue,
{h('CAST(sum(CASE WHEN milliseconds > 300000 THEN line_total ELSE 0 END) AS DOUBLE) * 100.0 / CAST(sum(line_total) AS DOUBLE)')} AS long_ratio
FROM v_track t JOIN v_line l ON t.track_id = l.track_id GROUP BY genre HAVING sum(CASE WHEN milliseconds > 300000 THEN line_total ELSE 0 END) > 10""")
def length_revenue(t: Tables) -> DataFrame:
    """Genre revenue by track length in one pass over per-track sums."""
    per = t.lines.groupBy("track_id").agg(F.sum("line_total").alias("s"))
    ms, s = F.col("milliseconds"), F.col("s")
    long = sum_if(ms > 300000, s)
    g = per.join(t.tracks.select("track_id", "genre", "milliseconds"), "track_id").groupBy(F.col("genre").alias("genre_name")).agg(
        F.sum("s").alias("total"), sum_if(ms < 180000, s).alias("short"), long.alias("long"))
    return g.where("long > 10").select("genre_name", dbl("total").alias("total_revenue"), dbl("short").alias("short_revenue"), dbl("long").alias("long_revenue"),
                                       half_up(dbl("long") * F.lit(100.0) / dbl("total")).alias("long_ratio"))


_ALBUM = "SELECT album, sum(unit_price) AS s, count(*) AS n FROM v_track GROUP BY album"


def _dominant_sql(avg: str) -> str:
    return f"""SELECT t.track_id, t.name AS track_name, t.album AS album_title, CAST(t.unit_price AS DOUBLE) AS track_price, {avg} AS album_avg_track_price,
{h('CAST(t.unit_price AS DOUBLE) * 100.0 / CAST(a.s AS DOUBLE)')} AS dominance_index FROM v_track t JOIN ({_ALBUM}) a ON a.album = t.album
WHERE t.genre IN ('ECONOMY','PROMO') AND t.unit_price * 2 > a.s"""


def _dominant(t: Tables, avg) -> DataFrame:
    per = t.tracks.groupBy("album").agg(F.sum("unit_price").alias("s"), F.count(F.lit(1)).alias("n"))
    rows = t.tracks.where(F.col("genre").isin("ECONOMY", "PROMO")).join(per, "album").where("unit_price * 2 > s")
    return rows.select("track_id", F.col("name").alias("track_name"), F.col("album").alias("album_title"), dbl("unit_price").alias("track_price"),
                       avg(mean(F.col("s"), F.col("n"))).alias("album_avg_track_price"), half_up(dbl("unit_price") * F.lit(100.0) / dbl("s")).alias("dominance_index"))


@job("dominant_tracks", _dominant_sql(h("CAST(a.s AS DOUBLE) / a.n")))
def dominant_tracks(t: Tables) -> DataFrame:
    """Tracks worth more than half of their album."""
    return _dominant(t, half_up)


@job("dominant_tracks_raw", _dominant_sql("CAST(a.s AS DOUBLE) / a.n"))
def dominant_tracks_raw(t: Tables) -> DataFrame:
    """The subquery form of the same report, with the unrounded mean."""
    return _dominant(t, lambda c: c)


@job("courier_list", """SELECT first_name || ' ' || last_name AS customer_name, coalesce(company,'End User') AS client_type, coalesce(state,'Unknown State') AS region,
coalesce(fax, phone, 'No Phone on File') AS priority_contact, phone || ' (' || coalesce(state,'Unknown State') || ') - ' || country AS clean_address,
CASE WHEN fax IS NULL THEN 'Check Manually' ELSE 'Valid' END AS fax_status FROM v_customer""")
def courier_list(t: Tables) -> DataFrame:
    state = F.coalesce("state", F.lit("Unknown State"))
    return t.customers.select(
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"), F.coalesce("company", F.lit("End User")).alias("client_type"), state.alias("region"),
        F.coalesce("fax", "phone", F.lit("No Phone on File")).alias("priority_contact"),
        F.concat("phone", F.lit(" ("), state, F.lit(") - "), "country").alias("clean_address"),
        F.when(F.col("fax").isNull(), "Check Manually").otherwise("Valid").alias("fax_status"))


@job("marketing_list", """SELECT substr(lower(substr(c.first_name,1,1)) || lower(c.last_name),1,10) AS username, substr(c.email, instr(c.email,'@') + 1) AS domain_check,
replace(replace(t.name,'widget',''),'bolt','') AS clean_track, '****' || substr(c.email, instr(c.email,'@')) AS hidden_email, c.email AS original_email, t.name AS original_track_name
FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id JOIN v_line l ON i.invoice_id = l.invoice_id JOIN v_track t ON t.track_id = l.track_id""")
def marketing_list(t: Tables) -> DataFrame:
    """Marketing list with masked addresses, one row per line sold."""
    e = F.col("email")
    cust = t.customers.select("customer_id", X.username(F.col("first_name"), F.col("last_name")).alias("username"), X.email_domain(e).alias("domain_check"),
                              X.mask_email(e).alias("hidden_email"), e.alias("original_email"))
    tr = t.tracks.select("track_id", X.remove_words(F.col("name"), ["widget", "bolt"]).alias("clean_track"), F.col("name").alias("original_track_name"))
    rows = t.lines.select("invoice_id", "track_id").join(t.invoices.select("invoice_id", "customer_id"), "invoice_id").join(cust, "customer_id").join(tr, "track_id")
    return rows.select("username", "domain_check", "clean_track", "hidden_email", "original_email", "original_track_name")


@job("succession", """SELECT printf('%03d', e.employee_id) AS employee_id, upper(e.name) AS full_name, year(e.hire_date) AS hire_year, year(e.hire_date) + 40 AS retirement_year,
CASE WHEN 2024 - year(e.hire_date) > 20 THEN 'VETERAN' WHEN 2024 - year(e.hire_date) BETWEEN 10 AND 20 THEN 'SENIOR' ELSE 'JUNIOR' END AS seniority_status,
coalesce(e.email, m.email, 'support@example.com') AS contact_email FROM v_employee e LEFT JOIN v_employee m ON e.reports_to = m.employee_id""")
def succession(t: Tables, today: str = "2024-01-31") -> DataFrame:
    """Staff with seniority and a contact that falls back to the manager's (self-join)."""
    boss = t.employees.select(F.col("employee_id").alias("reports_to"), F.col("email").alias("boss_email"))
    y = D.year_of(F.col("hire_date"))
    return t.employees.join(boss, "reports_to", "left").select(
        F.format_string("%03d", "employee_id").alias("employee_id"), F.upper("name").alias("full_name"), y.alias("hire_year"), (y + 40).alias("retirement_year"),
        D.seniority(F.col("hire_date"), today).alias("seniority_status"), F.coalesce("email", "boss_email", F.lit("support@example.com")).alias("contact_email"))


@job("album_share", f"""SELECT track_id, t.album AS album_title, name AS track_name, CAST(unit_price AS DOUBLE) AS unit_price, CAST(s AS DOUBLE) AS total_album_value,
{h('CAST(s AS DOUBLE) / n')} AS price_avg_in_album, {h('CAST(unit_price AS DOUBLE) * 100.0 / CAST(s AS DOUBLE)')} AS pct_of_album FROM v_track t JOIN ({_ALBUM}) a ON a.album = t.album WHERE s > 2500""")
def album_share(t: Tables) -> DataFrame:
    rows = R.with_group_stats(t.tracks, ["album"], s=F.sum("unit_price"), n=F.count(F.lit(1))).where("s > 2500")
    return rows.select("track_id", F.col("album").alias("album_title"), F.col("name").alias("track_name"), dbl("unit_price").alias("unit_price"), dbl("s").alias("total_album_value"),
                       half_up(mean(F.col("s"), F.col("n"))).alias("price_avg_in_album"), half_up(dbl("unit_price") * F.lit(100.0) / dbl("s")).alias("pct_of_album"))


@job("genre_dominance", f"""WITH g AS (SELECT c.country, t.genre, sum(l.line_total) AS s FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id JOIN v_line l ON i.invoice_id = l.invoice_id
JOIN v_track t ON t.track_id = l.track_id GROUP BY 1, 2), m AS (SELECT *, CAST(sum(s) OVER (PARTITION BY country) AS DOUBLE) / count(*) OVER (PARTITION BY country) AS a FROM g)
SELECT country, genre AS genre_name, CAST(s AS DOUBLE) AS genre_sales, {h('a')} AS country_avg_genre_sales, {h('CAST(s AS DOUBLE) - a')} AS market_dominance_index FROM m WHERE {h('CAST(s AS DOUBLE) - a')} > 0""")
def genre_dominance(t: Tables) -> DataFrame:
    """Genres above the mean genre of their country."""
    g = _genre_spend(t).join(t.customers.select("customer_id", "country"), "customer_id").groupBy("country", "genre").agg(F.sum("genre_spend").alias("s"))
    rows = R.with_group_stats(R.staged(g), ["country"], stage=True, a=mean_of("s"))
    return rows.select("country", F.col("genre").alias("genre_name"), dbl("s").alias("genre_sales"), half_up(F.col("a")).alias("country_avg_genre_sales"),
                       half_up(dbl("s") - F.col("a")).alias("market_dominance_index")).where("market_dominance_index > 0")


@job("top_artists", """WITH g AS (SELECT t.genre, l.artist_id, count(t.track_id) AS n FROM (SELECT DISTINCT track_id, artist_id FROM v_line) l JOIN v_track t ON t.track_id = l.track_id GROUP BY 1, 2),
f AS (SELECT *, dense_rank() OVER (PARTITION BY genre ORDER BY n DESC) AS r, sum(n) OVER (PARTITION BY genre) AS total FROM g)
SELECT f.genre AS genre_name, e.name AS artist_name, n AS genre_artist_tracks, total::BIGINT AS genre_total_tracks, r AS ranking_dense FROM f JOIN v_employee e ON e.employee_id = f.artist_id WHERE r <= 3 AND total > 10""")
def top_artists(t: Tables) -> DataFrame:
    """Three best counts per genre, ties kept; genres with more than ten entries."""
    pairs = t.lines.select("track_id", "artist_id").distinct().join(t.tracks.select("track_id", "genre"), "track_id")
    g = pairs.groupBy("genre", "artist_id").agg(F.count(F.lit(1)).alias("n"))
    totals = g.groupBy("genre").agg(F.sum("n").alias("total")).where("total > 10")
    ranked = R.dense_top(g, ["genre"], "n", 3, "r").join(totals, "genre")
    artists = t.employees.select(F.col("employee_id").alias("artist_id"), "name")
    return ranked.join(artists, "artist_id").select(F.col("genre").alias("genre_name"), F.col("name").alias("artist_name"), F.col("n").alias("genre_artist_tracks"),
                                                   F.col("total").alias("genre_total_tracks"), F.col("r").alias("ranking_dense"))


@job("playlist_audit", f"""WITH m AS (SELECT o_orderpriority AS p, count(DISTINCT t.track_id) AS tracks, count(DISTINCT t.media_type) AS formats,
sum(CASE WHEN t.media_type ILIKE '%#1%' OR t.media_type ILIKE '%#3%' THEN 1 ELSE 0 END) AS digital, sum(CASE WHEN t.media_type ILIKE '%#2%' THEN 1 ELSE 0 END) AS protected
FROM orders JOIN v_line l ON o_orderkey = l.invoice_id JOIN v_track t ON t.track_id = l.track_id GROUP BY 1)
SELECT p AS playlist_name, tracks AS total_tracks, formats AS unique_formats, {h('CAST(digital AS DOUBLE) * 100.0 / tracks')} AS digital_percentage,
CASE WHEN formats > 25 THEN 'High Diversity' WHEN CAST(protected AS DOUBLE) * 100.0 / tracks > 50 THEN 'Legacy Format' ELSE 'Optimized' END AS data_alert FROM m""")
def playlist_audit(t: Tables) -> DataFrame:
    """Formats per playlist: entries are reduced to (playlist, track) before the catalogue is joined."""
    lists = t.raw("orders").select(F.col("o_orderkey").alias("invoice_id"), F.col("o_orderpriority").alias("p"))
    per = t.lines.select("invoice_id", "track_id").join(lists, "invoice_id").groupBy("p", "track_id").agg(F.count(F.lit(1)).alias("n"))
    fmt = per.join(t.tracks.select("track_id", "media_type"), "track_id").groupBy("p", "media_type").agg(F.count(F.lit(1)).alias("tracks"), F.sum("n").alias("n"))
    c, n = F.col("media_type"), F.col("n")
    m = fmt.groupBy("p").agg(F.sum("tracks").alias("tracks"), F.count("media_type").alias("formats"),
                             F.coalesce(F.sum(F.when(c.ilike("%#1%") | c.ilike("%#3%"), n)), F.lit(0)).alias("digital"), F.coalesce(F.sum(F.when(c.ilike("%#2%"), n)), F.lit(0)).alias("protected"))
    return m.select(F.col("p").alias("playlist_name"), F.col("tracks").alias("total_tracks"), F.col("formats").alias("unique_formats"),
                    half_up(dbl("digital") * F.lit(100.0) / F.col("tracks")).alias("digital_percentage"),
                    F.when(F.col("formats") > 25, "High Diversity").when(dbl("protected") * F.lit(100.0) / F.col("tracks") > 50, "Legacy Format").otherwise("Optimized").alias("data_alert"))


@job("sales_by_country", "SELECT country, CAST(sum(total) AS DOUBLE) AS total_sales FROM v_inv_country GROUP BY country")
def sales_by_country(t: Tables) -> DataFrame:
    """Rows of the sales-by-country report (``sources.sinks.write_report`` lays them out)."""
    return _by_country(t, F.sum("total").alias("s")).groupBy("country").agg(dbl(F.sum("s")).alias("total_sales")).orderBy(F.col("total_sales").desc())


@job("artist_top10", """SELECT e.name AS artist_name, count(l.track_id) AS total_units_sold, CAST(sum(l.line_total) AS DOUBLE) AS total_revenue, CAST(sum(l.line_total) AS DOUBLE) / count(*) AS average_price
FROM v_employee e JOIN v_line l ON e.employee_id = l.artist_id GROUP BY e.name HAVING count(l.track_id) > 10 ORDER BY sum(l.line_total) DESC, e.name LIMIT 10""")
def artist_top10(t: Tables) -> DataFrame:
    per = t.lines.groupBy(F.col("artist_id").alias("employee_id")).agg(F.count("track_id").alias("n"), F.sum("line_total").alias("s")).where("n > 10")
    return per.join(t.employees.select("employee_id", "name"), "employee_id").orderBy(F.col("s").desc(), "name").limit(10).select(
        F.col("name").alias("artist_name"), F.col("n").alias("total_units_sold"), dbl("s").alias("total_revenue"), mean(F.col("s"), F.col("n")).alias("average_price"))
