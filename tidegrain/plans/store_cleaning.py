"""Store jobs: cleaning views, deduplication, profiling, layered models, A/B groups, dimension and fact builds."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import text as X
from tidegrain.functions.numbers import count_if, dbl, half_up, mean, mean_of, null_out_of_range
from tidegrain.operators.ranking import first_per_key, with_group_stats
from tidegrain.operators.tables import with_surrogate
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job, view
from tidegrain.plans.store_basics import _per_customer
from tidegrain.sources.tables import Tables

# Countries of the named regions; every other country is the default region.
NORTH_AMERICA = ("NATION_1", "NATION_6")
LATIN_AMERICA = ("NATION_0", "NATION_5", "NATION_11")
ASIA_PACIFIC = ("NATION_2", "NATION_7")


def region_of(c: Column, latam: str, apac: str, default: str):
    """Region of a country."""
    return (
        F.when(c.isin(*NORTH_AMERICA), "North America").when(c.isin(*LATIN_AMERICA), latam)
        .when(c.isin(*ASIA_PACIFIC), apac).otherwise(default)
    )


def _region_sql(latam: str, apac: str, default: str) -> str:
    return (
        "CASE WHEN country IN ('NATION_1','NATION_6') THEN 'North America' "
        f"WHEN country IN ('NATION_0','NATION_5','NATION_11') THEN '{latam}' "
        f"WHEN country IN ('NATION_2','NATION_7') THEN '{apac}' ELSE '{default}' END"
    )


view("v_customer_doubled", """
SELECT * FROM v_customer UNION ALL SELECT customer_id + 10000000000, first_name, last_name, country, region_id, state, company,
email, phone, fax, support_rep_id FROM v_customer WHERE customer_id % 2 = 0""")
view("v_final_customer", f"""
SELECT customer_id, first_name, last_name, email, company, clean_phone, territory, country, state FROM (
SELECT *, {_region_sql('LATAM', 'APAC', 'EMEA')} AS territory, row_number() OVER (PARTITION BY email ORDER BY customer_id) AS rn FROM (
SELECT customer_id, upper(first_name) AS first_name, upper(last_name) AS last_name, lower(email) AS email,
coalesce(company,'Individual') AS company, coalesce(state,'N/A') AS state,
replace(replace(replace(replace(phone,'(',''),')',''),'-',''),' ','') AS clean_phone, country FROM v_customer_doubled)) WHERE rn = 1""")


def customers_doubled(t: Tables) -> DataFrame:
    """Customer list with every second customer entered twice under a later id and the same mail."""
    again = t.customers.where("customer_id % 2 = 0").withColumn("customer_id", F.col("customer_id") + F.lit(10000000000))
    return t.customers.unionByName(again)


def _full_name():
    return F.concat("first_name", F.lit(" "), "last_name")


@job("customers_missing_state", """SELECT count(*) AS total_customers, count(state) AS customers_with_state,
count(*) - count(state) AS missing_state_count FROM v_customer""")
def customers_missing_state(t: Tables) -> DataFrame:
    n, s = F.count(F.lit(1)), F.count("state")
    return t.customers.agg(n.alias("total_customers"), s.alias("customers_with_state"), (n - s).alias("missing_state_count"))


@job("customers_by_country", "SELECT country, count(*) AS frequency FROM v_customer GROUP BY country")
def customers_by_country(t: Tables) -> DataFrame:
    return t.customers.groupBy("country").agg(F.count(F.lit(1)).alias("frequency")).orderBy("country")


@job("customers_bad_email", """SELECT customer_id, email FROM (SELECT customer_id, CASE WHEN customer_id % 7 = 0 THEN replace(email,'@',' at ')
WHEN customer_id % 11 = 0 THEN replace(email,'.',' ') ELSE email END AS email FROM v_customer) WHERE email NOT LIKE '%@%' OR email NOT LIKE '%.%'""")
def customers_bad_email(t: Tables) -> DataFrame:
    """Malformed addresses: missing either mark is enough to be listed."""
    k, e = F.col("customer_id"), F.col("email")
    damaged = F.when(k % 7 == 0, F.replace(e, F.lit("@"), F.lit(" at "))).when(k % 11 == 0, F.replace(e, F.lit("."), F.lit(" "))).otherwise(e)
    return t.customers.select("customer_id", damaged.alias("email")).where(~e.like("%@%") | ~e.like("%.%"))


@job("customers_clean", """SELECT customer_id, first_name || ' ' || last_name AS full_name, lower(email) AS normalized_email,
coalesce(state,'Unknown') AS state_clean, country FROM v_customer""")
def customers_clean(t: Tables) -> DataFrame:
    return t.customers.select(
        "customer_id", _full_name().alias("full_name"), F.lower("email").alias("normalized_email"),
        F.coalesce("state", F.lit("Unknown")).alias("state_clean"), "country",
    )


@job("duplicate_emails", "SELECT email, count(*) AS repetitions FROM v_customer_doubled GROUP BY email HAVING count(*) > 1")
def duplicate_emails(t: Tables) -> DataFrame:
    return customers_doubled(t).groupBy("email").agg(F.count(F.lit(1)).alias("repetitions")).where("repetitions > 1")


@job("customers_unique", """SELECT customer_id, first_name, last_name, company, state, country, phone, fax, email, support_rep_id FROM (
SELECT *, row_number() OVER (PARTITION BY email ORDER BY customer_id) AS rn FROM v_customer_doubled) WHERE rn = 1""")
def customers_unique(t: Tables) -> DataFrame:
    """One row per mail, lowest id kept."""
    return first_per_key(customers_doubled(t), ["email"], [F.col("customer_id").asc()]).select(
        "customer_id", "first_name", "last_name", "company", "state", "country", "phone", "fax", "email", "support_rep_id"
    )


@job("customers_enriched", """SELECT customer_id, first_name || ' ' || last_name AS full_name,
replace(replace(replace(replace(phone,'(',''),')',''),'-',''),' ','') AS clean_phone, substr(email, instr(email,'@') + 1) AS email_domain,
upper(country) AS country_code FROM v_customer""")
def customers_enriched(t: Tables) -> DataFrame:
    return t.customers.select(
        "customer_id", _full_name().alias("full_name"), X.normalise_phone(F.col("phone")).alias("clean_phone"),
        X.email_domain(F.col("email")).alias("email_domain"), F.upper("country").alias("country_code"),
    )


@job("monthly_revenue", """SELECT year(invoice_date) AS sales_year, month(invoice_date) AS sales_month, CAST(sum(total) AS DOUBLE) AS total_revenue
FROM v_invoice GROUP BY 1, 2""")
def monthly_revenue(t: Tables) -> DataFrame:
    d = F.col("invoice_date")
    return (
        t.invoices.groupBy(D.year_of(d).alias("sales_year"), D.month_of(d).alias("sales_month"))
        .agg(dbl(F.sum("total")).alias("total_revenue")).orderBy(F.col("sales_year").desc(), F.col("sales_month").desc())
    )


@job("invoices_categorized", """SELECT invoice_id, customer_id, invoice_date, CAST(total AS DOUBLE) AS total,
CASE WHEN total < 100000 THEN 'Low Value' WHEN total BETWEEN 100000 AND 350000 THEN 'Mid Value' ELSE 'High Value' END AS sales_category,
'Q' || quarter(invoice_date) AS quarter FROM v_invoice""")
def invoices_categorized(t: Tables) -> DataFrame:
    c = F.col("total")
    return t.invoices.select(
        "invoice_id", "customer_id", "invoice_date", dbl(c).alias("total"),
        F.when(c < 100000, "Low Value").when(c.between(100000, 350000), "Mid Value").otherwise("High Value").alias("sales_category"),
        D.quarter_label(F.col("invoice_date")).alias("quarter"),
    )


@job("region_by_band", f"""SELECT world_region, sales_category, count(invoice_id) AS total_invoices, CAST(sum(total) AS DOUBLE) AS total_revenue FROM (
SELECT i.*, CASE WHEN total < 100000 THEN 'Low Value' WHEN total BETWEEN 100000 AND 350000 THEN 'Mid Value' ELSE 'High Value' END AS sales_category
FROM v_invoice i) i JOIN (SELECT customer_id, {_region_sql('Latin America', 'Asia-Pacific', 'Europe/EMEA')} AS world_region FROM v_customer) c
ON i.customer_id = c.customer_id GROUP BY 1, 2""")
def region_by_band(t: Tables) -> DataFrame:
    """Region crossed with value band; invoices are pre-aggregated per customer and band before the join."""
    c = F.col("total")
    bandname = F.when(c < 100000, "Low Value").when(c.between(100000, 350000), "Mid Value").otherwise("High Value")
    per = t.invoices.groupBy("customer_id", bandname.alias("sales_category")).agg(F.count("invoice_id").alias("n"), F.sum("total").alias("s"))
    regions = t.customers.select("customer_id", region_of(F.col("country"), "Latin America", "Asia-Pacific", "Europe/EMEA").alias("world_region"))
    return per.join(regions, "customer_id").groupBy("world_region", "sales_category").agg(
        F.sum("n").alias("total_invoices"), dbl(F.sum("s")).alias("total_revenue")
    )


def staging_customer(t: Tables) -> DataFrame:
    """First layer: casing, defaults, phone digits."""
    return customers_doubled(t).select(
        "customer_id", F.upper("first_name").alias("first_name"), F.upper("last_name").alias("last_name"), F.lower("email").alias("email"),
        F.coalesce("company", F.lit("Individual")).alias("company"), F.coalesce("state", F.lit("N/A")).alias("state"),
        X.normalise_phone(F.col("phone")).alias("clean_phone"), "country",
    )


@job("clean_pipeline", "SELECT * FROM v_final_customer")
def clean_pipeline(t: Tables) -> DataFrame:
    """Second layer: territory and one row per mail."""
    staged = staging_customer(t).withColumn("territory", region_of(F.col("country"), "LATAM", "APAC", "EMEA"))
    return first_per_key(staged, ["email"], [F.col("customer_id").asc()]).select(
        "customer_id", "first_name", "last_name", "email", "company", "clean_phone", "territory", "country", "state"
    )


@job("row_delta", """SELECT (SELECT count(*) FROM v_customer_doubled) AS total_original_rows, (SELECT count(*) FROM v_final_customer) AS total_clean_rows,
(SELECT count(*) FROM v_customer_doubled) - (SELECT count(*) FROM v_final_customer) AS removed_duplicates""")
def row_delta(t: Tables) -> DataFrame:
    """Raw against clean row counts."""
    clean = clean_pipeline(t).agg(F.count(F.lit(1))).scalar()
    return customers_doubled(t).agg(F.count(F.lit(1)).alias("total_original_rows")).select(
        "total_original_rows", clean.alias("total_clean_rows"), (F.col("total_original_rows") - clean).alias("removed_duplicates")
    )


@job("profile_report", f"""SELECT count(*) AS total_records, sum(CASE WHEN company IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS technical_fill_rate,
sum(CASE WHEN company <> 'Individual' THEN 1 ELSE 0 END)::BIGINT AS true_company_count,
{h("sum(CASE WHEN company <> 'Individual' THEN 1 ELSE 0 END)::DOUBLE * 100.0 / count(*)")} AS company_fill_rate_pct,
sum(CASE WHEN state <> 'N/A' THEN 1 ELSE 0 END)::BIGINT AS real_state_count,
{h("sum(CASE WHEN state <> 'N/A' THEN 1 ELSE 0 END)::DOUBLE * 100.0 / count(*)")} AS state_fill_rate_pct,
sum(CASE WHEN clean_phone IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS clean_phone_count,
{h("sum(CASE WHEN clean_phone IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE * 100.0 / count(*)")} AS clean_phone_fill_rate_pct FROM v_final_customer""")
def profile_report(t: Tables) -> DataFrame:
    """Fill rates, technical and real (sentinel defaults do not count as filled)."""
    n = F.count(F.lit(1))

    def pct(c):
        return half_up(dbl(c) * F.lit(100.0) / n)

    company, state, phone = count_if(F.col("company") != "Individual"), count_if(F.col("state") != "N/A"), F.count("clean_phone")
    return clean_pipeline(t).agg(
        n.alias("total_records"), F.count("company").alias("technical_fill_rate"), company.alias("true_company_count"),
        pct(company).alias("company_fill_rate_pct"), state.alias("real_state_count"), pct(state).alias("state_fill_rate_pct"),
        phone.alias("clean_phone_count"), pct(phone).alias("clean_phone_fill_rate_pct"),
    )


@job("market_share", f"""SELECT territory, count(*) AS customers_in_region,
{h('count(*)::DOUBLE * 100.0 / (SELECT count(*) FROM v_final_customer)')} AS market_share_pct FROM v_final_customer GROUP BY territory""")
def market_share(t: Tables) -> DataFrame:
    """Share of customers per territory."""
    per = clean_pipeline(t).groupBy("territory").agg(F.count(F.lit(1)).alias("customers_in_region"))
    total = per.agg(F.sum("customers_in_region")).scalar()
    return per.withColumn("market_share_pct", half_up(dbl("customers_in_region") * F.lit(100.0) / total))


def master_sales_rows(t: Tables) -> DataFrame:
    """Sales lines with customer, territory and genre (five-way star join)."""
    cust = clean_pipeline(t).select("customer_id", _full_name().alias("customer_name"), "territory", "country")
    tr = t.tracks.select("track_id", F.col("name").alias("track_name"), F.col("genre").alias("genre_name"))
    return (
        t.lines.select("invoice_id", "track_id", "line_total").join(t.invoices.select("invoice_id", "customer_id", "invoice_date"), "invoice_id")
        .join(cust, "customer_id").join(tr, "track_id")
        .select("customer_id", "customer_name", "territory", "country", "invoice_id", "invoice_date", "line_total", "track_name", "genre_name")
    )


@job("master_sales_rows", """SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.territory, c.country, i.invoice_id, i.invoice_date,
CAST(l.line_total AS DOUBLE) AS line_total, t.name AS track_name, t.genre AS genre_name
FROM v_final_customer c JOIN v_invoice i ON c.customer_id = i.customer_id JOIN v_line l ON i.invoice_id = l.invoice_id JOIN v_track t ON l.track_id = t.track_id""")
def master_rows(t: Tables) -> DataFrame:
    return master_sales_rows(t).withColumn("line_total", dbl("line_total"))


@job("master_sales", """SELECT c.territory, t.genre AS genre_name, CAST(sum(l.line_total) AS DOUBLE) AS total_revenue, count(*) AS units_sold
FROM v_final_customer c JOIN v_invoice i ON c.customer_id = i.customer_id JOIN v_line l ON i.invoice_id = l.invoice_id
JOIN v_track t ON l.track_id = t.track_id GROUP BY 1, 2""")
def master_sales(t: Tables) -> DataFrame:
    """Territory by genre; lines are reduced to (customer, genre) before the customers are joined."""
    tr = t.tracks.select("track_id", F.col("genre").alias("genre_name"))
    rows = t.lines.select("invoice_id", "track_id", "line_total").join(tr, "track_id").join(t.invoices.select("invoice_id", "customer_id"), "invoice_id")
    per_cust = rows.groupBy("customer_id", "genre_name").agg(F.sum("line_total").alias("s"), F.count(F.lit(1)).alias("n"))
    return per_cust.join(clean_pipeline(t).select("customer_id", "territory"), "customer_id").groupBy("territory", "genre_name").agg(
        dbl(F.sum("s")).alias("total_revenue"), F.sum("n").alias("units_sold")
    )


@job("performance_report", """WITH s AS (SELECT customer_id, sum(total) AS total_spent, count(invoice_id) AS transaction_count FROM v_invoice GROUP BY 1)
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.territory, CAST(s.total_spent AS DOUBLE) AS total_spent, s.transaction_count,
CASE WHEN s.total_spent > 3000000 THEN 'Top Tier (Gold)' WHEN s.total_spent BETWEEN 2000000 AND 3000000 THEN 'Mid Tier (Silver)' ELSE 'Standard' END AS customer_value_rank
FROM v_final_customer c JOIN s ON c.customer_id = s.customer_id""")
def performance_report(t: Tables) -> DataFrame:
    """Value rank from a pre-aggregated staging table (written once, reused by later reports)."""
    summary = t.staged("staging_customer_sales", lambda: _per_customer(t.invoices))
    s = F.col("spent")
    return clean_pipeline(t).join(summary, "customer_id").select(
        "customer_id", _full_name().alias("customer_name"), "territory", dbl("spent").alias("total_spent"), F.col("orders").alias("transaction_count"),
        F.when(s > 3000000, "Top Tier (Gold)").when(s.between(2000000, 3000000), "Mid Tier (Silver)").otherwise("Standard").alias("customer_value_rank"),
    )


view("v_silver_customer", """
SELECT customer_id, upper(first_name || ' ' || last_name) AS full_name, CASE WHEN company IS NULL THEN 'B2C Customer' ELSE 'B2B Customer' END AS company,
coalesce(state,'Unknown') AS state, coalesce(country,'Unknown') AS country,
coalesce(replace(replace(replace(replace(phone,'(',''),')',''),'-',''),' ',''),'Unknown') AS phone,
coalesce(fax,'Unknown') AS fax, coalesce(email,'Unknown') AS email, support_rep_id FROM v_customer""")


@job("silver_customers", "SELECT * FROM v_silver_customer")
def silver_customers(t: Tables) -> DataFrame:
    """Customer roster with B2B/B2C flag and no NULLs."""
    unknown = F.lit("Unknown")
    return t.customers.select(
        "customer_id", F.upper(_full_name()).alias("full_name"),
        F.when(F.col("company").isNull(), "B2C Customer").otherwise("B2B Customer").alias("company"),
        *[F.coalesce(c, unknown).alias(c) for c in ("state", "country")],
        F.coalesce(X.normalise_phone(F.col("phone")), unknown).alias("phone"),
        *[F.coalesce(c, unknown).alias(c) for c in ("fax", "email")], "support_rep_id",
    )


view("v_silver_track", """
SELECT track_id, coalesce(name,'Unknown Name') AS track_name, coalesce(composer,'Unknown Composer') AS composer, media_type, genre,
CASE WHEN milliseconds < 60000 OR milliseconds > 600000 THEN NULL ELSE milliseconds END AS milliseconds,
CASE WHEN milliseconds < 60000 OR milliseconds > 600000 THEN 'Corrupted' ELSE 'Standard' END AS duration_status,
bytes AS track_bytes, CAST(unit_price AS DOUBLE) AS track_price, coalesce(album,'Unknown Album') AS album_title,
CASE WHEN count(track_id) OVER (PARTITION BY album) < 2 THEN 'EP (Potential Incomplete)' ELSE 'LP' END AS album_type FROM v_track""")


@job("silver_tracks", "SELECT * FROM v_silver_track")
def silver_tracks(t: Tables, lo: int = 60000, hi: int = 600000) -> DataFrame:
    """Track audit: impossible lengths become NULL with a flag; albums with few tracks are marked."""
    ms = F.col("milliseconds")
    rows = with_group_stats(t.tracks, ["album"], album_tracks=F.count("track_id"))
    return rows.select(
        "track_id", F.coalesce("name", F.lit("Unknown Name")).alias("track_name"), F.coalesce("composer", F.lit("Unknown Composer")).alias("composer"),
        "media_type", "genre", null_out_of_range(ms, lo, hi).alias("milliseconds"),
        F.when((ms < lo) | (ms > hi), "Corrupted").otherwise("Standard").alias("duration_status"),
        F.col("bytes").alias("track_bytes"), dbl("unit_price").alias("track_price"), F.coalesce("album", F.lit("Unknown Album")).alias("album_title"),
        F.when(F.col("album_tracks") < 2, "EP (Potential Incomplete)").otherwise("LP").alias("album_type"),
    )


@job("gold_sales", """SELECT i.invoice_id, l.line_no, CAST(i.invoice_date AS DATE) AS invoice_date, c.full_name AS customer_name, c.company AS customer_segment,
c.country AS customer_country, t.track_name, t.album_title, upper(coalesce(e.name,'Unknown Artist')) AS artist_name, t.duration_status AS track_quality_flag,
l.quantity, CAST(l.line_total AS DOUBLE) AS line_revenue FROM v_invoice i JOIN v_line l ON i.invoice_id = l.invoice_id
JOIN v_silver_customer c ON i.customer_id = c.customer_id JOIN v_silver_track t ON l.track_id = t.track_id
LEFT JOIN v_employee e ON l.artist_id = e.employee_id""")
def gold_sales(t: Tables) -> DataFrame:
    """Sales master over the silver layers, one row per line."""
    cust = silver_customers(t).select("customer_id", F.col("full_name").alias("customer_name"), F.col("company").alias("customer_segment"), F.col("country").alias("customer_country"))
    tr = silver_tracks(t).select("track_id", "track_name", "album_title", F.col("duration_status").alias("track_quality_flag"))
    ar = t.employees.select(F.col("employee_id").alias("artist_id"), F.col("name").alias("artist"))
    return (
        t.lines.join(t.invoices.select("invoice_id", "customer_id", "invoice_date"), "invoice_id")
        .join(cust, "customer_id").join(tr, "track_id").join(ar, "artist_id", "left")
        .select(
            "invoice_id", "line_no", F.to_date("invoice_date").alias("invoice_date"), "customer_name", "customer_segment", "customer_country",
            "track_name", "album_title", F.upper(F.coalesce("artist", F.lit("Unknown Artist"))).alias("artist_name"), "track_quality_flag",
            "quantity", dbl("line_total").alias("line_revenue"),
        )
    )


def ab_groups(t: Tables) -> DataFrame:
    return silver_customers(t).select(
        "customer_id", "full_name", "country", "email", F.when(F.col("customer_id") % 2 == 0, "A").otherwise("B").alias("test_group")
    )


@job("ab_segments", "SELECT customer_id, full_name, country, email, CASE WHEN customer_id % 2 = 0 THEN 'A' ELSE 'B' END AS test_group FROM v_silver_customer")
def ab_segments(t: Tables) -> DataFrame:
    """Deterministic split of all customers into two groups."""
    return ab_groups(t)


@job("ab_balance", """SELECT CASE WHEN customer_id % 2 = 0 THEN 'A' ELSE 'B' END AS test_group, count(*) AS total_customers,
CAST(sum(customer_id) AS DOUBLE) / count(*) AS mean_id FROM v_silver_customer GROUP BY 1""")
def ab_balance(t: Tables) -> DataFrame:
    return ab_groups(t).groupBy("test_group").agg(F.count(F.lit(1)).alias("total_customers"), mean_of("customer_id").alias("mean_id"))


@job("ab_performance", f"""SELECT CASE WHEN c.customer_id % 2 = 0 THEN 'A' ELSE 'B' END AS test_group, count(DISTINCT c.customer_id) AS total_users,
count(i.invoice_id) AS orders, CAST(sum(i.total) AS DOUBLE) AS total_revenue,
{h('CAST(sum(i.total) AS DOUBLE) / count(DISTINCT c.customer_id)')} AS arpu
FROM v_silver_customer c LEFT JOIN v_invoice i ON c.customer_id = i.customer_id GROUP BY 1""")
def ab_performance(t: Tables) -> DataFrame:
    """Revenue per user by group, users without orders included."""
    base = ab_groups(t).select("customer_id", "test_group").join(_per_customer(t.invoices), "customer_id", "left")
    users = F.count("customer_id")
    return base.groupBy("test_group").agg(
        users.alias("total_users"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"), dbl(F.sum("spent")).alias("total_revenue"),
        half_up(mean(F.sum("spent"), users)).alias("arpu"),
    )


_TRACK_COLS = f"""upper(trim(name)) AS track_name, lower(coalesce(composer,'Unknown Artist')) AS composer_clean,
{h('milliseconds / 60000.0')} AS duration_minutes, {h('bytes / 1024.0 / 1024.0')} AS size_mb, CASE WHEN unit_price > 950.00 THEN 'Premium' ELSE 'Standard' END AS price_category"""


def _track_cols():
    return [
        F.upper(F.trim("name")).alias("track_name"), F.lower(F.coalesce("composer", F.lit("Unknown Artist"))).alias("composer_clean"),
        half_up(F.col("milliseconds") / F.lit(60000.0)).alias("duration_minutes"),
        half_up(F.col("bytes") / F.lit(1024.0) / F.lit(1024.0)).alias("size_mb"),
        F.when(F.col("unit_price") > 950, "Premium").otherwise("Standard").alias("price_category"),
    ]


@job("wrangle_tracks", f"SELECT track_id, {_TRACK_COLS} FROM v_track WHERE CAST(bytes AS DOUBLE) / 1024.0 / 1024.0 > 5")
def wrangle_tracks(t: Tables) -> DataFrame:
    """Large tracks with cleaned names."""
    return t.tracks.where(dbl("bytes") / F.lit(1024.0) / F.lit(1024.0) > 5).select("track_id", *_track_cols())


@job("dim_track", f"""SELECT t.track_id, {_TRACK_COLS}, album AS album_title, e.name AS artist_name, genre AS genre_name, CAST(unit_price AS DOUBLE) AS unit_price
FROM v_track t JOIN (SELECT track_id, min(artist_id) AS artist_id FROM v_line GROUP BY 1) a ON t.track_id = a.track_id
JOIN (SELECT employee_id, name FROM v_employee) e(employee_id, artist_name) ON a.artist_id = e.employee_id""".replace("e.name AS artist_name", "e.artist_name"))
def dim_track(t: Tables) -> DataFrame:
    """Track dimension with album, main artist and genre."""
    main = t.lines.groupBy("track_id").agg(F.min("artist_id").alias("artist_id"))
    ar = t.employees.select(F.col("employee_id").alias("artist_id"), F.col("name").alias("artist_name"))
    return t.tracks.join(main, "track_id").join(ar, "artist_id").select(
        "track_id", *_track_cols(), F.col("album").alias("album_title"), "artist_name", F.col("genre").alias("genre_name"), dbl("unit_price").alias("unit_price")
    )


_FACT = """SELECT md5(concat_ws('-', i.invoice_id::VARCHAR, l.line_no::VARCHAR, l.track_id::VARCHAR, l.artist_id::VARCHAR)) AS sales_id, i.invoice_id, l.line_no, l.track_id, i.customer_id,
l.quantity, CAST(l.line_total AS DOUBLE) AS line_total, i.invoice_date, year(i.invoice_date) AS sale_year, month(i.invoice_date) AS sale_month
FROM v_invoice i JOIN v_line l ON i.invoice_id = l.invoice_id"""


@job("fact_sales", _FACT)
def fact_sales(t: Tables) -> DataFrame:
    """Sales fact; the surrogate key is a digest of the natural key, so the load needs no global sort."""
    d = F.col("invoice_date")
    rows = t.lines.join(t.invoices.select("invoice_id", "customer_id", "invoice_date"), "invoice_id")
    return with_surrogate(rows, ["invoice_id", "line_no", "track_id", "artist_id"], "sales_id").select(
        "sales_id", "invoice_id", "line_no", "track_id", "customer_id", "quantity", dbl("line_total").alias("line_total"), "invoice_date",
        D.year_of(d).alias("sale_year"), D.month_of(d).alias("sale_month"),
    )


@job("fact_sales_totals", """SELECT 'Fact_Sales' AS table_name, count(*) AS total_rows, CAST(sum(l.line_total) AS DOUBLE) AS total_revenue
FROM v_invoice i JOIN v_line l ON i.invoice_id = l.invoice_id""")
def fact_sales_totals(t: Tables) -> DataFrame:
    """Control totals of the fact."""
    rows = t.lines.join(t.invoices.select("invoice_id"), "invoice_id")
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), dbl(F.sum("line_total")).alias("total_revenue")).select(
        F.lit("Fact_Sales").alias("table_name"), "total_rows", "total_revenue"
    )


# Rows of each table that a customer list of a given size leads to, as (fixed rows, rows per 30 customers).
EXPECTED = {"region": (5, 0), "nation": (25, 0), "customer": (0, 30), "supplier": (0, 2), "part": (0, 40), "orders": (0, 300), "lineitem": (0, 1200), "events": (0, 200)}


@job("sanity_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS current_rows, CAST({a} + c.n * {b} // 30 AS BIGINT) AS expected, CAST(count(*) - ({a} + c.n * {b} // 30) AS BIGINT) AS diff FROM {n}, (SELECT count(*) AS n FROM customer) c GROUP BY c.n"
    for n, (a, b) in EXPECTED.items()))
def sanity_counts(t: Tables, baseline: dict[str, tuple[int, int]] = EXPECTED) -> DataFrame:
    """Row counts against the baseline for the customers there are."""
    customers = t.raw("customer").agg(F.count(F.lit(1))).scalar()
    out = None
    for name, (fixed, per) in baseline.items():
        n = t.raw(name).agg(F.count(F.lit(1)).alias("current_rows")).select(
            F.lit(name).alias("table_name"), "current_rows", (F.lit(fixed) + F.floor(customers * per / 30)).cast("bigint").alias("expected"))
        n = n.withColumn("diff", F.col("current_rows") - F.col("expected"))
        out = n if out is None else out.unionByName(n)
    return out
