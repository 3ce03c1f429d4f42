"""Store jobs: fundamentals and advanced reports (contacts, inventory, tiers, shares, ranks, drift)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import text as X
from tidegrain.functions.numbers import dbl, half_up, mean, mean_of
from tidegrain.operators.ranking import first_per_key, keep_top_ranked, with_group_stats
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job
from tidegrain.sources.tables import Tables


@job("customers_in", "SELECT first_name, last_name, email FROM v_customer WHERE country = 'NATION_2'")
def customers_in(t: Tables, country: str = "NATION_2") -> DataFrame:
    """Contacts of one country."""
    return t.customers.where(F.col("country") == country).select("first_name", "last_name", "email")


@job("tracks_by_duration", "SELECT name, milliseconds / 60000.0 AS duration_minutes FROM v_track WHERE genre = 'PROMO'")
def tracks_by_duration(t: Tables, genre: str = "PROMO") -> DataFrame:
    """Tracks of a genre, longest first."""
    return (
        t.tracks.where(F.col("genre") == genre)
        .select("name", (F.col("milliseconds") / F.lit(60000.0)).alias("duration_minutes"))
        .orderBy(F.col("duration_minutes").desc())
    )


@job("markets", """SELECT DISTINCT n_name AS country FROM nation
WHERE n_name IN ('NATION_1','NATION_3','NATION_5','NATION_7','NATION_9') AND n_name <> 'NATION_4'""")
def markets(t: Tables) -> DataFrame:
    """Distinct markets of a list."""
    wanted = [f"NATION_{i}" for i in (1, 3, 5, 7, 9)]
    c = F.col("n_name")
    return (
        t.raw("nation").where(c.isin(wanted) & (c != "NATION_4")).select(c.alias("country")).distinct()
        .orderBy(F.col("country").desc())
    )


@job("invoices_quarter", """SELECT DISTINCT invoice_id, invoice_date, CAST(total AS DOUBLE) AS total FROM v_invoice
WHERE invoice_date >= TIMESTAMP '1998-01-01' AND invoice_date < TIMESTAMP '1998-04-01'""")
def invoices_quarter(t: Tables) -> DataFrame:
    """Invoices of a quarter; the upper bound is the whole last day."""
    inv = t.invoices.where(D.between_days(F.col("invoice_date"), "1998-01-01", "1998-03-31"))
    return inv.select("invoice_id", "invoice_date", dbl("total").alias("total")).distinct().orderBy(F.col("invoice_date").desc())


@job("unmanaged", """SELECT DISTINCT name, hire_date, nation_id FROM v_employee
WHERE reports_to IS NULL AND hire_date > DATE '1991-01-01' AND nation_id IS NOT NULL""")
def unmanaged(t: Tables) -> DataFrame:
    """Staff without a manager hired after a date."""
    e = F.col
    return (
        t.employees.where(e("reports_to").isNull() & (e("hire_date") > F.lit("1991-01-01").cast("date")) & e("nation_id").isNotNull())
        .select("name", "hire_date", "nation_id").distinct().orderBy(e("hire_date").desc())
    )


@job("name_search", """SELECT first_name, last_name, email, country FROM v_customer
WHERE last_name ILIKE '0%7%' AND email IS NOT NULL AND company IS NOT NULL""")
def name_search(t: Tables) -> DataFrame:
    """Name pattern search, ASCII case ignored."""
    c = F.col
    return (
        t.customers.where(c("last_name").ilike("0%7%") & c("email").isNotNull() & c("company").isNotNull())
        .select("first_name", "last_name", "email", "country").orderBy("country", "last_name")
    )


@job("album_artist", """SELECT DISTINCT t.album AS album_title, e.name AS artist_name
FROM (SELECT DISTINCT track_id, artist_id FROM v_line) l JOIN v_track t ON l.track_id = t.track_id
JOIN v_employee e ON l.artist_id = e.employee_id
WHERE (e.name ILIKE '%03%' OR e.name ILIKE 's%9') AND t.album IS NOT NULL""")
def album_artist(t: Tables) -> DataFrame:
    """Albums with their artists for two name patterns."""
    artist = t.employees.where(F.col("name").ilike("%03%") | F.col("name").ilike("s%9")).select(
        F.col("employee_id").alias("artist_id"), F.col("name").alias("artist_name")
    )
    pairs = t.lines.select("track_id", "artist_id").join(artist, "artist_id").distinct()
    return pairs.join(t.tracks.select("track_id", F.col("album").alias("album_title")), "track_id").select("album_title", "artist_name").distinct()


@job("invoice_customer", """SELECT i.invoice_id, i.invoice_date, CAST(i.total AS DOUBLE) AS total,
c.first_name || ' ' || c.last_name AS full_name
FROM v_invoice i JOIN v_customer c ON i.customer_id = c.customer_id WHERE c.phone IS NOT NULL AND i.total > 300000""")
def invoice_customer(t: Tables) -> DataFrame:
    """Invoices over an amount with the customer's full name."""
    names = t.customers.where("phone IS NOT NULL").select("customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"))
    return (
        t.invoices.where(F.col("total") > 300000).join(names, "customer_id")
        .select("invoice_id", "invoice_date", dbl("total").alias("total"), "full_name")
    )


@job("media_inventory", """SELECT DISTINCT t.name AS track_name, t.genre AS genre_name, t.media_type AS format_type, e.name AS artist_name
FROM v_line l JOIN v_track t ON l.track_id = t.track_id JOIN v_employee e ON l.artist_id = e.employee_id
WHERE t.media_type <> 'Brand#1' AND t.name ILIKE '%a%' AND t.genre IS NOT NULL AND t.media_type IS NOT NULL""")
def media_inventory(t: Tables) -> DataFrame:
    """Three-table inventory of names, genres and formats."""
    tr = t.tracks.where("media_type <> 'Brand#1' AND name ILIKE '%a%' AND genre IS NOT NULL").select(
        "track_id", F.col("name").alias("track_name"), F.col("genre").alias("genre_name"), F.col("media_type").alias("format_type")
    )
    ar = t.employees.select(F.col("employee_id").alias("artist_id"), F.col("name").alias("artist_name"))
    pairs = t.lines.select("track_id", "artist_id").distinct()
    return pairs.join(tr, "track_id").join(ar, "artist_id").select("track_name", "genre_name", "format_type", "artist_name").distinct()


@job("total_revenue", """SELECT CAST(sum(total) AS DOUBLE) AS total_historical_revenue FROM v_invoice
WHERE total > 0 AND invoice_date IS NOT NULL""")
def total_revenue(t: Tables) -> DataFrame:
    return t.invoices.where("total > 0 AND invoice_date IS NOT NULL").agg(dbl(F.sum("total")).alias("total_historical_revenue"))


@job("avg_by_album", """SELECT album AS album_title, CAST(sum(milliseconds) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 60000.0 AS average_duration_minutes
FROM v_track WHERE milliseconds > 10000 AND album IS NOT NULL GROUP BY album""")
def avg_by_album(t: Tables) -> DataFrame:
    """Mean track length per album in minutes."""
    return (
        t.tracks.where("milliseconds > 10000 AND album IS NOT NULL").groupBy(F.col("album").alias("album_title"))
        .agg((mean_of("milliseconds") / F.lit(60000.0)).alias("average_duration_minutes"))
        .orderBy(F.col("average_duration_minutes").desc())
    )


@job("price_range", """SELECT CAST(min(unit_price) AS DOUBLE) AS min_price, CAST(max(unit_price) AS DOUBLE) AS max_price
FROM v_track WHERE genre = 'ECONOMY' AND unit_price > 0""")
def price_range(t: Tables, genre: str = "ECONOMY") -> DataFrame:
    return t.tracks.where((F.col("genre") == genre) & (F.col("unit_price") > 0)).agg(
        dbl(F.min("unit_price")).alias("min_price"), dbl(F.max("unit_price")).alias("max_price")
    )


@job("playlist_counts", """SELECT o_orderpriority AS playlist_name, count(l_partkey) AS total_tracks
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderpriority IS NOT NULL
GROUP BY o_orderpriority HAVING count(l_partkey) > 0""")
def playlist_counts(t: Tables) -> DataFrame:
    """Entries per playlist: lines are counted per order before the join."""
    per_order = t.lines.where("track_id IS NOT NULL").groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n"))
    lists = t.raw("orders").where("o_orderpriority IS NOT NULL").select(
        F.col("o_orderkey").alias("invoice_id"), F.col("o_orderpriority").alias("playlist_name")
    )
    return (
        per_order.join(lists, "invoice_id").groupBy("playlist_name").agg(F.sum("n").alias("total_tracks"))
        .where("total_tracks > 0").orderBy(F.col("total_tracks").desc())
    )


@job("popular_genres", "SELECT genre AS genre_name, count(track_id) AS track_count FROM v_track GROUP BY genre HAVING count(track_id) > 330")
def popular_genres(t: Tables, least: int = 330) -> DataFrame:
    return (
        t.tracks.groupBy(F.col("genre").alias("genre_name")).agg(F.count("track_id").alias("track_count"))
        .where(F.col("track_count") > least).orderBy(F.col("track_count").desc())
    )


def _per_customer(inv: DataFrame) -> DataFrame:
    """Spend and orders per customer, aggregated before any join so that a hot customer costs one row per task."""
    return inv.groupBy("customer_id").agg(F.sum("total").alias("spent"), F.count("invoice_id").alias("orders"))


@job("client_location", """SELECT upper(c.first_name || ' ' || c.last_name) AS client_identity,
c.phone || ', ' || c.country AS full_location, coalesce(c.state,'N/A') AS province_status, coalesce(c.fax,'NO FAX') AS fax_status,
CAST(sum(i.total) AS DOUBLE) AS total_spent
FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id
WHERE i.invoice_date >= TIMESTAMP '1999-01-01' AND i.invoice_date < TIMESTAMP '2001-01-01'
GROUP BY c.customer_id, c.first_name, c.last_name, c.phone, c.country, c.state, c.fax HAVING sum(i.total) > 500000""")
def client_location(t: Tables) -> DataFrame:
    """High-value customers of two years with cleaned location."""
    spend = _per_customer(t.invoices.where(D.between_days(F.col("invoice_date"), "1999-01-01", "2000-12-31"))).where("spent > 500000")
    return t.customers.join(spend, "customer_id").select(
        F.upper(F.concat("first_name", F.lit(" "), "last_name")).alias("client_identity"),
        F.concat("phone", F.lit(", "), "country").alias("full_location"),
        F.coalesce("state", F.lit("N/A")).alias("province_status"),
        F.coalesce("fax", F.lit("NO FAX")).alias("fax_status"),
        dbl("spent").alias("total_spent"),
    ).orderBy(F.col("total_spent").desc())


@job("customer_tiers", """SELECT upper(c.first_name || ' ' || c.last_name) AS customer_name, c.country, coalesce(c.state,'N/A') AS state_province,
CAST(sum(i.total) AS DOUBLE) AS lifetime_value, count(i.invoice_id) AS order_count,
CASE WHEN sum(i.total) > 3000000 THEN 'Tier 1: VIP' WHEN sum(i.total) BETWEEN 2000000 AND 3000000 THEN 'Tier 2: Regular'
ELSE 'Tier 3: Occasional' END AS customer_segment
FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id
GROUP BY c.customer_id, c.first_name, c.last_name, c.country, c.state HAVING count(i.invoice_id) > 5""")
def customer_tiers(t: Tables) -> DataFrame:
    """Lifetime value tiers of customers with more than five orders."""
    s = F.col("spent")
    return t.customers.join(_per_customer(t.invoices).where("orders > 5"), "customer_id").select(
        F.upper(F.concat("first_name", F.lit(" "), "last_name")).alias("customer_name"),
        "country",
        F.coalesce("state", F.lit("N/A")).alias("state_province"),
        dbl("spent").alias("lifetime_value"),
        F.col("orders").alias("order_count"),
        F.when(s > 3000000, "Tier 1: VIP").when(s.between(2000000, 3000000), "Tier 2: Regular")
        .otherwise("Tier 3: Occasional").alias("customer_segment"),
    ).orderBy(F.col("lifetime_value").desc())


@job("market_segments", f"""SELECT upper(c.last_name || ', ' || c.first_name) AS client_profile,
CASE WHEN c.country = 'NATION_1' THEN 'Domestic' ELSE 'Foreign' END AS market_type,
CASE WHEN count(i.invoice_id) > 10 THEN 'High Activity' WHEN count(i.invoice_id) BETWEEN 5 AND 10 THEN 'Moderate Activity'
WHEN count(i.invoice_id) BETWEEN 1 AND 4 THEN 'Low Activity' ELSE 'No Activity' END AS activity_level,
CAST(coalesce(sum(i.total),0) AS DOUBLE) AS total_sales,
coalesce({h('CAST(sum(i.total) AS DOUBLE) / count(i.invoice_id)')}, 0.0) AS avg_sales
FROM v_customer c LEFT JOIN v_invoice i ON c.customer_id = i.customer_id AND i.invoice_date >= TIMESTAMP '2000-07-01'
WHERE c.email IS NOT NULL GROUP BY c.customer_id, c.first_name, c.last_name, c.country""")
def market_segments(t: Tables) -> DataFrame:
    """Activity level of every customer since a date, customers without sales included."""
    since = t.invoices.where(F.col("invoice_date") >= F.lit("2000-07-01").cast("timestamp_ntz"))
    n = F.coalesce("orders", F.lit(0))
    joined = t.customers.where("email IS NOT NULL").join(_per_customer(since), "customer_id", "left")
    return joined.select(
        F.upper(F.concat("last_name", F.lit(", "), "first_name")).alias("client_profile"),
        F.when(F.col("country") == "NATION_1", "Domestic").otherwise("Foreign").alias("market_type"),
        F.when(n > 10, "High Activity").when(n >= 5, "Moderate Activity").when(n >= 1, "Low Activity")
        .otherwise("No Activity").alias("activity_level"),
        F.coalesce(dbl("spent"), F.lit(0.0)).alias("total_sales"),
        F.coalesce(half_up(mean(F.col("spent"), F.col("orders"))), F.lit(0.0)).alias("avg_sales"),
    ).orderBy("market_type", F.col("total_sales").desc())


@job("premium_tracks", """SELECT name AS track_name, album AS album_name, CAST(unit_price AS DOUBLE) AS pricing_audit, media_type
FROM v_track WHERE CAST(unit_price AS DOUBLE) > (SELECT CAST(sum(unit_price) AS DOUBLE) / count(*) FROM v_track) AND media_type <> 'Brand#1'""")
def premium_tracks(t: Tables) -> DataFrame:
    """Tracks priced above the catalogue mean (scalar subquery)."""
    avg_price = t.tracks.agg(mean_of("unit_price")).scalar()
    return (
        t.tracks.where((dbl("unit_price") > avg_price) & (F.col("media_type") != "Brand#1"))
        .select(F.col("name").alias("track_name"), F.col("album").alias("album_name"), dbl("unit_price").alias("pricing_audit"), "media_type")
        .orderBy(F.col("pricing_audit").desc(), "track_name")
    )


@job("orphans_artist", """SELECT e.employee_id AS artist_id, coalesce(e.name,'Unknown Artist') AS artist_name FROM v_artist e
WHERE NOT EXISTS (SELECT 1 FROM v_line l WHERE l.artist_id = e.employee_id)""")
def orphans_artist(t: Tables) -> DataFrame:
    """Artists without a sale: anti-join."""
    sold = t.lines.select(F.col("artist_id").alias("employee_id"))
    return t.artists.join(sold, "employee_id", "left_anti").select(
        F.col("employee_id").alias("artist_id"), F.coalesce("name", F.lit("Unknown Artist")).alias("artist_name")
    ).orderBy("artist_name")


@job("top5_share", f"""SELECT upper(c.first_name || ' ' || c.last_name) AS full_name, c.country, CAST(sum(i.total) AS DOUBLE) AS total_spent,
{h('CAST(sum(i.total) AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM v_invoice) * 100.0')} AS percentage_total_sales
FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id WHERE i.total > 0
GROUP BY c.customer_id, c.first_name, c.last_name, c.country ORDER BY sum(i.total) DESC, c.customer_id LIMIT 5""")
def top5_share(t: Tables) -> DataFrame:
    """Five best customers with their share: top-k is taken before the names are joined."""
    grand = t.invoices.agg(dbl(F.sum("total"))).scalar()
    best = _per_customer(t.invoices.where("total > 0")).orderBy(F.col("spent").desc(), "customer_id").limit(5)
    return best.join(t.customers, "customer_id").select(
        F.upper(F.concat("first_name", F.lit(" "), "last_name")).alias("full_name"), "country",
        dbl("spent").alias("total_spent"), half_up(dbl("spent") / grand * F.lit(100.0)).alias("percentage_total_sales"),
    ).orderBy(F.col("total_spent").desc())


@job("format_consumers", """SELECT c.customer_id, upper(c.first_name || ' ' || c.last_name) AS full_name, coalesce(c.country,'Global') AS country
FROM v_customer c WHERE c.customer_id IN (SELECT i.customer_id FROM v_invoice i WHERE i.invoice_id IN (
SELECT l.invoice_id FROM v_line l WHERE l.track_id IN (SELECT t.track_id FROM v_track t WHERE t.media_type IN (
SELECT DISTINCT p_brand FROM part WHERE p_brand = 'Brand#7'))))""")
def format_consumers(t: Tables, media: str = "Brand#7") -> DataFrame:
    """Customers who bought a format: a chain of semi-joins."""
    tracks = t.tracks.where(F.col("media_type") == media)
    lines = t.lines.join(tracks, "track_id", "left_semi")
    invoices = t.invoices.join(lines, "invoice_id", "left_semi")
    return t.customers.join(invoices, "customer_id", "left_semi").select(
        "customer_id", F.upper(F.concat("first_name", F.lit(" "), "last_name")).alias("full_name"),
        F.coalesce("country", F.lit("Global")).alias("country"),
    ).orderBy("customer_id")


@job("track_order", f"""SELECT name AS track_name, album AS album_title, coalesce(composer,'Unknown Composer') AS composer, genre,
{h('milliseconds / 60000.0')} AS duration_minutes,
row_number() OVER (PARTITION BY genre, album ORDER BY milliseconds DESC, track_id) AS track_position_in_album,
CASE WHEN milliseconds / 60000.0 > 5 THEN 'Long' ELSE 'Standard' END AS length_segment
FROM v_track WHERE genre IN (SELECT genre FROM v_track GROUP BY genre HAVING count(track_id) > 320)""")
def track_order(t: Tables, least: int = 320) -> DataFrame:
    """Track positions by length inside the albums of dense genres.

    The catalogue has six genres, so the position is numbered per (genre, album), which stays a small group;
    ``track_order_genre`` numbers whole genres with a range-partitioned sort.
    """
    from pyspark.sql import Window as W

    dense = t.tracks.groupBy("genre").agg(F.count("track_id").alias("n")).where(F.col("n") > least)
    minutes = F.col("milliseconds") / F.lit(60000.0)
    w = W.partitionBy("genre", "album").orderBy(F.col("milliseconds").desc(), "track_id")
    return t.tracks.join(dense, "genre", "left_semi").select(
        F.col("name").alias("track_name"), F.col("album").alias("album_title"),
        F.coalesce("composer", F.lit("Unknown Composer")).alias("composer"), "genre",
        half_up(minutes).alias("duration_minutes"), F.row_number().over(w).cast("bigint").alias("track_position_in_album"),
        F.when(minutes > 5, "Long").otherwise("Standard").alias("length_segment"),
    )


@job("track_order_genre", f"""SELECT track_id, name AS track_name, genre, {h('milliseconds / 60000.0')} AS duration_minutes,
row_number() OVER (PARTITION BY genre ORDER BY milliseconds DESC, track_id) AS track_position_in_genre
FROM v_track WHERE genre IN (SELECT genre FROM v_track GROUP BY genre HAVING count(track_id) > 320)""")
def track_order_genre(t: Tables, least: int = 320) -> DataFrame:
    """Position inside a whole genre.

    A genre may be a third of the catalogue: rows are numbered by one range-partitioned sort on
    (genre, length) and the first number of each genre is taken off, so no task holds a genre.
    """
    from tidegrain.operators.ranking import global_row_number

    dense = t.tracks.groupBy("genre").agg(F.count("track_id").alias("n")).where(F.col("n") > least)
    rows = t.tracks.join(dense, "genre", "left_semi").select("track_id", "name", "genre", "milliseconds")
    numbered = global_row_number(rows, [F.col("genre"), F.col("milliseconds").desc(), F.col("track_id")], "no")
    return with_group_stats(numbered, ["genre"], stage=True, first=F.min("no")).select(
        "track_id", F.col("name").alias("track_name"), "genre",
        half_up(F.col("milliseconds") / F.lit(60000.0)).alias("duration_minutes"),
        (F.col("no") - F.col("first") + 1).alias("track_position_in_genre"),
    )


@job("staff_rank", """WITH p AS (SELECT c.support_rep_id AS employee_id, sum(i.total) AS s FROM v_customer c JOIN v_invoice i
ON c.customer_id = i.customer_id GROUP BY 1), r AS (SELECT *, rank() OVER (ORDER BY s DESC) AS sales_rank FROM p)
SELECT r.sales_rank, upper(e.name) AS employee_name, CAST(e.nation_id AS VARCHAR) AS region, CAST(r.s AS DOUBLE) AS total_sales,
CASE WHEN r.s > 380000000 THEN 'Elite' ELSE 'Standard' END AS performance_tier
FROM r JOIN v_employee e ON e.employee_id = r.employee_id WHERE r.sales_rank <= 3""")
def staff_rank(t: Tables, k: int = 3) -> DataFrame:
    """Best sales staff, ties kept."""
    spend = _per_customer(t.invoices).join(t.customers.select("customer_id", "support_rep_id"), "customer_id")
    sales = spend.groupBy(F.col("support_rep_id").alias("employee_id")).agg(F.sum("spent").alias("s"))
    top = keep_top_ranked(sales, "s", k, "sales_rank")
    return top.join(t.employees, "employee_id").select(
        "sales_rank", F.upper("name").alias("employee_name"), F.col("nation_id").cast("string").alias("region"),
        dbl("s").alias("total_sales"), F.when(F.col("s") > 380000000, "Elite").otherwise("Standard").alias("performance_tier"),
    ).orderBy("sales_rank")


@job("price_vs_genre", """SELECT track_id, name AS track_name, coalesce(genre,'Unknown') AS genre_name, CAST(unit_price AS DOUBLE) AS unit_price,
CAST(sum(unit_price) OVER (PARTITION BY genre) AS DOUBLE) / count(unit_price) OVER (PARTITION BY genre) AS avg_genre_price,
CAST(unit_price AS DOUBLE) - CAST(sum(unit_price) OVER (PARTITION BY genre) AS DOUBLE) / count(unit_price) OVER (PARTITION BY genre) AS price_difference
FROM v_track""")
def price_vs_genre(t: Tables) -> DataFrame:
    """Price beside the mean of its genre."""
    both = with_group_stats(t.tracks, ["genre"], stage=True, genre_mean=mean_of("unit_price"))
    return both.select(
        "track_id", F.col("name").alias("track_name"), F.coalesce("genre", F.lit("Unknown")).alias("genre_name"),
        dbl("unit_price").alias("unit_price"), F.col("genre_mean").alias("avg_genre_price"),
        (dbl("unit_price") - F.col("genre_mean")).alias("price_difference"),
    ).orderBy(F.col("price_difference").desc())


@job("invoice_drift", """WITH hst AS (SELECT c.customer_id, upper(c.first_name || ' ' || c.last_name) AS full_name, i.total,
lag(i.total, 1, 0) OVER (PARTITION BY c.customer_id ORDER BY i.invoice_date, i.invoice_id) AS prev_total,
row_number() OVER (PARTITION BY c.customer_id ORDER BY i.invoice_date DESC, i.invoice_id DESC) AS rn
FROM v_customer c JOIN v_invoice i ON c.customer_id = i.customer_id)
SELECT customer_id, full_name, CAST(total AS DOUBLE) AS last_invoice_total, CAST(prev_total AS DOUBLE) AS previous_invoice_total,
CAST(total - prev_total AS DOUBLE) AS revenue_difference FROM hst WHERE rn = 1""")
def invoice_drift(t: Tables) -> DataFrame:
    """Last invoice against the one before: only the two newest invoices per customer are shuffled."""
    two = first_per_key(t.invoices, ["customer_id"], [F.col("invoice_date").desc(), F.col("invoice_id").desc()], 2, "rn")
    pair = two.groupBy("customer_id").agg(
        F.max(F.when(F.col("rn") == 1, F.col("total"))).alias("last"),
        F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("total"))), F.lit(0).cast("decimal(18,2)")).alias("prev"),
    )
    return pair.join(t.customers, "customer_id").select(
        "customer_id", F.upper(F.concat("first_name", F.lit(" "), "last_name")).alias("full_name"),
        dbl("last").alias("last_invoice_total"), dbl("prev").alias("previous_invoice_total"),
        dbl(F.col("last") - F.col("prev")).alias("revenue_difference"),
    ).orderBy(F.col("revenue_difference").desc())


@job("sales_summary", f"""SELECT coalesce(country,'Unknown') AS country, year(invoice_date) AS sales_year,
CASE WHEN country = 'NATION_1' THEN 'Domestic' ELSE 'Foreign' END AS market_type, CAST(sum(total) AS DOUBLE) AS total_revenue,
count(invoice_id) AS order_count, {h('CAST(sum(total) AS DOUBLE) / count(*)')} AS avg_ticket
FROM v_inv_country GROUP BY country, year(invoice_date) HAVING sum(total) > 20000000""")
def sales_summary(t: Tables) -> DataFrame:
    """Sales by country and year, read through a replaceable view of its folder."""
    per = t.invoices.withColumn("sales_year", D.year_of(F.col("invoice_date"))).groupBy("customer_id", "sales_year").agg(F.sum("total").alias("s"), F.count("invoice_id").alias("n"))
    g = per.join(t.customers.select("customer_id", "country"), "customer_id").groupBy("country", "sales_year").agg(F.sum("s").alias("s"), F.sum("n").alias("order_count"))
    out = g.where("s > 20000000").select(
        F.coalesce("country", F.lit("Unknown")).alias("country"), "sales_year",
        F.when(F.col("country") == "NATION_1", "Domestic").otherwise("Foreign").alias("market_type"),
        dbl("s").alias("total_revenue"), "order_count", half_up(mean(F.col("s"), F.col("order_count"))).alias("avg_ticket"),
    )
    name = f"v_global_sales_summary_{t.tag}"
    out.createOrReplaceTempView(name)
    return t.spark.table(name).orderBy(F.col("sales_year").desc(), F.col("total_revenue").desc())


@job("artist_clean", """WITH c AS (SELECT DISTINCT employee_id AS artist_id, trim(coalesce(name,'Unknown Artist')) AS clean_name FROM v_artist e
WHERE EXISTS (SELECT 1 FROM v_line l WHERE l.artist_id = e.employee_id))
SELECT artist_id, clean_name, upper(clean_name) AS professional_format FROM c WHERE clean_name NOT ILIKE 'unknown%'""")
def artist_clean(t: Tables) -> DataFrame:
    """Artists with sales, cleaned once into a frozen table and formatted from it."""
    sold = t.lines.select(F.col("artist_id").alias("employee_id"))
    frozen = t.staged("tmp_artist_clean", lambda: (
        t.artists.join(sold, "employee_id", "left_semi")
        .select(F.col("employee_id").alias("artist_id"), F.trim(F.coalesce("name", F.lit("Unknown Artist"))).alias("clean_name"))
        .distinct()
    ))
    return frozen.where(~F.col("clean_name").ilike("unknown%")).select(
        "artist_id", "clean_name", F.upper("clean_name").alias("professional_format")
    ).orderBy("clean_name")


@job("email_domains", f"""WITH d AS (SELECT trim(first_name) || ' ' || trim(last_name) AS full_name, country, email,
lower(substr(email, instr(email,'@') + 1)) AS domain_name,
CASE WHEN email ILIKE '%@gmail.%' OR email ILIKE '%@yahoo.%' OR email ILIKE '%@hotmail.%' OR email ILIKE '%@outlook.%' THEN 'Public' ELSE 'Corporate' END AS domain_type
FROM v_customer WHERE country <> 'NATION_1'), n AS (SELECT domain_name, count(*) AS total_customers FROM d GROUP BY 1),
g AS (SELECT CAST(sum(total_customers) AS DOUBLE) / count(*) AS a FROM n)
SELECT d.*, n.total_customers, {h('n.total_customers - g.a')} AS diff FROM d JOIN n ON d.domain_name = n.domain_name CROSS JOIN g""")
def email_domains(t: Tables) -> DataFrame:
    """Customers with the size of their mail domain and its distance from the mean domain size."""
    email = F.col("email")
    data = t.customers.where("country <> 'NATION_1'").select(
        F.concat(F.trim("first_name"), F.lit(" "), F.trim("last_name")).alias("full_name"), "country", "email",
        F.lower(X.email_domain(email)).alias("domain_name"), X.domain_class(email).alias("domain_type"),
    )
    counts = data.groupBy("domain_name").agg(F.count(F.lit(1)).alias("total_customers"))
    avg_size = counts.agg(mean_of("total_customers")).scalar()
    return data.join(counts, "domain_name").withColumn("diff", half_up(F.col("total_customers") - avg_size))
