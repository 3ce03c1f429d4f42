"""Lab and asset jobs: market prices, markup sums, normalising loads, upserts, asset reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import text as X
from tidegrain.functions.numbers import count_if, dbl, half_even, half_up
from tidegrain.operators.joins import reconcile
from tidegrain.operators.ranking import first_per_key
from tidegrain.operators.tables import delete_in, normalise, update_first, upsert_columns
from tidegrain.plans.registry import half_even_sql as he
from tidegrain.plans.registry import half_up_sql as h
from tidegrain.plans.registry import job, view
from tidegrain.sources.readers import html_tag_values, json_tuples, xml_values
from tidegrain.sources.tables import Tables


def _comma(cents):
    return F.concat(F.floor(cents / 100).cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


@job("esios_prices", f"""SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS timestamp, {he('(event_id * 37 % 20000) / 100.0::DOUBLE + (event_id * 11 % 5000) / 100.0::DOUBLE + CASE WHEN event_id % 40 = 7 THEN 0.0::DOUBLE ELSE (event_id * 3 % 900) / 100.0::DOUBLE END', 2)} AS price_mwh,
'EUR/MWh' AS unit FROM events WHERE event_id % 50 <> 3""")
def esios_prices(t: Tables) -> DataFrame:
    """Hourly price from three decimal-comma components; a missing one counts as zero, a bad row is skipped."""
    e, ts = F.col("event_id"), F.col("ts")
    raw = t.raw("events").select(
        "event_id", F.date_format(ts, "dd/MM/yyyy").alias("Dia"), F.concat(F.date_format(ts, "HH"), F.lit("-"), F.lpad(((F.hour(ts) + 1) % 24).cast("string"), 2, "0")).alias("Hora"),
        F.when(e % 50 == 3, "n/a").otherwise(_comma(e * 37 % 20000)).alias("PCB"), _comma(e * 11 % 5000).alias("TEUPCB"), F.when(e % 40 != 7, _comma(e * 3 % 900)).alias("CCVPCB"))
    parts = [X.decimal_comma(F.coalesce(F.col(c), F.lit("0"))) for c in ("PCB", "TEUPCB", "CCVPCB")]
    total = half_even(parts[0] + parts[1] + parts[2], 2)
    return raw.select("event_id", F.date_format(D.parse_hour_range(F.col("Dia"), F.col("Hora")), "yyyy-MM-dd HH:mm:ss").alias("timestamp"), total.alias("price_mwh"), F.lit("EUR/MWh").alias("unit")).where(
        "price_mwh IS NOT NULL AND timestamp IS NOT NULL")


@job("domain_counts", """SELECT role || '.d' || CAST(conv_id % 40 AS VARCHAR) || '.org' AS org, count(*) AS count FROM conversations WHERE turn % 3 <> 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def domain_counts(t: Tables) -> DataFrame:
    """Ten most frequent sender domains of mail lines."""
    conv = F.col("conv_id").cast("string")
    line = F.when(F.col("turn") % 3 == 1, F.concat(F.lit("Subject: "), "text")).otherwise(
        F.concat(F.lit("From: u"), conv, F.lit("@"), "role", F.lit(".d"), (F.col("conv_id") % 40).cast("string"), F.lit(".org Sat Jan 5")))
    lines = t.raw("conversations").select(line.alias("value")).where(F.col("value").startswith("From: "))
    domain = F.split_part(F.split_part(F.col("value"), F.lit(" "), F.lit(2)), F.lit("@"), F.lit(2))
    return lines.groupBy(domain.alias("org")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "org").limit(10)


@job("xml_sum", "SELECT count(*) * 2 AS count, CAST(sum(p_size) + sum(p_partkey % 50) AS BIGINT) AS sum FROM part")
def xml_sum(t: Tables) -> DataFrame:
    """Count and sum of all ``count`` nodes of a column of XML documents."""
    doc = F.concat(F.lit("<info><comments><comment><name>"), "p_name", F.lit("</name><count>"), F.col("p_size").cast("string"), F.lit("</count></comment><comment><count>"),
                   (F.col("p_partkey") % 50).cast("string"), F.lit("</count></comment></comments></info>"))
    v = xml_values(t.raw("part").select(doc.alias("doc")), "doc", "//count/text()").select(F.col("value").try_cast("bigint").alias("v"))
    return v.agg(F.count("v").alias("count"), F.sum("v").alias("sum"))


@job("html_sum", "SELECT count(*) * 2 AS count, CAST(sum(page_id % 100) + sum(page_id * 7 % 50) AS BIGINT) AS sum FROM pages")
def html_sum(t: Tables) -> DataFrame:
    """Count and sum of the numbers in the ``span`` tags of pages."""
    k = F.col("page_id")
    html = F.concat("html", F.lit('<span class="comments">'), (k % 100).cast("string"), F.lit("</span><span>"), (k * 7 % 50).cast("string"), F.lit("</span>"))
    v = html_tag_values(t.raw("pages").select(html.alias("html")), "html", "span").select(F.trim("value").try_cast("bigint").alias("v"))
    return v.agg(F.count("v").alias("count"), F.sum("v").alias("sum"))


@job("json_sum", """SELECT count(*) AS count, CAST(sum(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT)) AS BIGINT) AS sum FROM events""")
def json_sum(t: Tables) -> DataFrame:
    """Count and sum of a number in JSON records."""
    v = t.raw("events").select(F.get_json_object("props", "$.k").try_cast("bigint").alias("v"))
    return v.agg(F.count("v").alias("count"), F.sum("v").alias("sum"))


# -- normalising loads ----------------------------------------------------------------------------

view("v_library", """SELECT t.track_id AS seq, t.name, 'artist ' || CAST(a.artist_id AS VARCHAR) AS artist, t.album, t.bytes // 200000 AS count, t.track_id % 101 AS rating, t.milliseconds AS length, t.genre
FROM v_track t JOIN (SELECT track_id, min(artist_id) AS artist_id FROM v_line GROUP BY 1) a ON a.track_id = t.track_id""")
view("v_lib_artist", "SELECT row_number() OVER (ORDER BY s) AS artist_id, artist AS name FROM (SELECT artist, min(seq) AS s FROM v_library GROUP BY 1)")
view("v_lib_album", "SELECT row_number() OVER (ORDER BY s) AS album_id, album AS title, a.artist_id FROM (SELECT album, min(seq) AS s, arg_min(artist, seq) AS artist FROM v_library GROUP BY 1) x JOIN v_lib_artist a ON a.name = x.artist")
view("v_lib_genre", "SELECT row_number() OVER (ORDER BY s) AS genre_id, genre AS name FROM (SELECT genre, min(seq) AS s FROM v_library GROUP BY 1)")


def library_rows(t: Tables) -> DataFrame:
    """Library rows in file order: name, artist, album, count, rating, length, genre."""
    main = t.lines.groupBy("track_id").agg(F.min("artist_id").alias("artist_id"))
    return t.tracks.join(main, "track_id").select(
        F.col("track_id").alias("seq"), "name", F.concat(F.lit("artist "), F.col("artist_id").cast("string")).alias("artist"), "album", F.expr("bytes div 200000").alias("count"),
        (F.col("track_id") % 101).alias("rating"), F.col("milliseconds").alias("length"), "genre")


def library(t: Tables) -> dict[str, DataFrame]:
    """Four tables; ids follow the first appearance, a repeated title keeps its last row."""
    rows, seq = library_rows(t), [F.col("seq")]
    artists = t.staged("library_artist", lambda: normalise(rows, "artist", "artist_id", "name", seq))
    genres = t.staged("library_genre", lambda: normalise(rows, "genre", "genre_id", "name", seq))

    def build_albums() -> DataFrame:
        ids = normalise(rows, "album", "album_id", "title", seq)
        first = rows.groupBy(F.col("album").alias("title")).agg(F.min_by("artist", "seq").alias("artist"))
        return ids.join(first, "title").join(artists.withColumnRenamed("name", "artist"), "artist").select("album_id", "title", "artist_id")

    albums = t.staged("library_album", build_albums)
    last = first_per_key(rows, ["name"], [F.col("seq").desc()])
    tracks = last.join(albums.select("album_id", F.col("title").alias("album")), "album").join(genres.withColumnRenamed("name", "genre"), "genre").select(
        F.col("name").alias("title"), "album_id", "genre_id", F.col("length").alias("len"), "rating", "count")
    return {"artist": artists, "album": albums, "genre": genres, "track": tracks}


@job("library_artists", "SELECT * FROM v_lib_artist")
def library_artists(t: Tables) -> DataFrame:
    return library(t)["artist"]


@job("library_albums", "SELECT * FROM v_lib_album")
def library_albums(t: Tables) -> DataFrame:
    return library(t)["album"]


@job("library_genres", "SELECT * FROM v_lib_genre")
def library_genres(t: Tables) -> DataFrame:
    return library(t)["genre"]


@job("track_library", """SELECT l.name AS title, a.album_id, g.genre_id, l.length AS len, l.rating, l.count FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY seq DESC) AS rn FROM v_library) l
JOIN v_lib_album a ON a.title = l.album JOIN v_lib_genre g ON g.name = l.genre WHERE rn = 1""")
def track_library(t: Tables) -> DataFrame:
    return library(t)["track"]


view("v_roster", "SELECT conv_id, turn, 'user ' || CAST(conv_id % 60 AS VARCHAR) AS name, role AS title, turn % 2 AS mrole FROM conversations")
view("v_roster_user", "SELECT row_number() OVER (ORDER BY s) AS user_id, name FROM (SELECT name, min(conv_id * 100000 + turn) AS s FROM v_roster GROUP BY 1)")
view("v_roster_course", "SELECT row_number() OVER (ORDER BY s) AS course_id, title FROM (SELECT title, min(conv_id * 100000 + turn) AS s FROM v_roster GROUP BY 1)")


@job("roster", """SELECT u.user_id, u.name, c.course_id, c.title, CAST(m.mrole AS BIGINT) AS role FROM (SELECT *, row_number() OVER (PARTITION BY name, title ORDER BY conv_id DESC, turn DESC) AS rn FROM v_roster) m
JOIN v_roster_user u ON u.name = m.name JOIN v_roster_course c ON c.title = m.title WHERE rn = 1""")
def roster(t: Tables) -> DataFrame:
    """Users, courses and memberships from ``[[name, title, role]]`` records; the last role of a membership wins."""
    doc = F.to_json(F.array(F.array(F.concat(F.lit("user "), (F.col("conv_id") % 60).cast("string")), F.col("role"), (F.col("turn") % 2).cast("string"))))
    rows = json_tuples(t.raw("conversations").select("conv_id", "turn", doc.alias("doc")), "doc", ["name", "title", "mrole"])
    order = [F.col("conv_id"), F.col("turn"), F.col("_pos")]
    users, courses = normalise(rows, "name", "user_id", "name", order), normalise(rows, "title", "course_id", "title", order)
    member = first_per_key(rows, ["name", "title"], [c.desc() for c in order])
    return member.join(users, "name").join(courses, "title").select("user_id", "name", "course_id", "title", F.col("mrole").cast("bigint").alias("role"))


@job("track_lifecycle", """SELECT track_id, name, composer, genre, album, CASE WHEN track_id = (SELECT min(track_id) FROM v_track WHERE composer IS NOT NULL AND composer NOT IN ('Brand#3','Unknown Artist') AND name = 'hot gear') THEN 1.99 ELSE CAST(unit_price AS DOUBLE) END AS unit_price
FROM v_track WHERE composer IS NOT NULL AND composer NOT IN ('Brand#3','Unknown Artist')""")
def track_lifecycle(t: Tables) -> DataFrame:
    """Denormalised tracks with a composer; two composers deleted, the first track of a name repriced."""
    rows = t.tracks.where("composer IS NOT NULL").select("track_id", "name", "composer", "genre", "album", dbl("unit_price").alias("unit_price"))
    kept = delete_in(rows, "composer", ["Brand#3", "Unknown Artist"])
    return update_first(kept, F.col("name") == "hot gear", ["track_id"], {"unit_price": F.lit(1.99)})


@job("quotes", f"""WITH tg AS (SELECT c_name AS coin_id, upper(c_mktsegment) AS symbol, c_name AS name, c_acctbal AS current_price, 'old' AS last_updated FROM customer WHERE c_custkey % 3 <> 0),
sr AS (SELECT c_name AS coin_id, upper(c_mktsegment) AS symbol, 'New ' || c_name AS name, {he('CASE WHEN c_custkey % 14 = 0 THEN 0.0::DOUBLE ELSE c_acctbal + 1.004::DOUBLE END', 2)} AS current_price, 'new' AS last_updated FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(tg.coin_id, sr.coin_id) AS coin_id, CASE WHEN tg.coin_id IS NOT NULL THEN tg.symbol ELSE sr.symbol END AS symbol, CASE WHEN tg.coin_id IS NOT NULL THEN tg.name ELSE sr.name END AS name,
CASE WHEN sr.coin_id IS NOT NULL THEN sr.current_price ELSE tg.current_price END AS current_price, CASE WHEN sr.coin_id IS NOT NULL THEN sr.last_updated ELSE tg.last_updated END AS last_updated FROM tg FULL JOIN sr ON tg.coin_id = sr.coin_id""")
def quotes(t: Tables) -> DataFrame:
    """Quotes cleaned (trim, upper, missing price zero, two decimals) and upserted: price and time change, the name stays."""
    k, c = F.col("c_custkey"), t.raw("customer")
    target = c.where(k % 3 != 0).select(F.col("c_name").alias("coin_id"), F.upper("c_mktsegment").alias("symbol"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("current_price"), F.lit("old").alias("last_updated"))
    raw = c.where(k % 2 == 0).select(
        F.concat(F.lit(" "), "c_name").alias("id"), F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("symbol"), F.concat(F.lit("New "), "c_name", F.lit(" ")).alias("name"),
        F.when(k % 14 != 0, F.col("c_acctbal") + F.lit(1.004)).cast("string").alias("current_price"), F.lit("new").alias("last_updated"))
    source = raw.select(F.trim("id").alias("coin_id"), F.upper(F.trim("symbol")).alias("symbol"), F.trim("name").alias("name"),
                        half_even(F.coalesce(F.col("current_price").try_cast("double"), F.lit(0.0)), 2).alias("current_price"), "last_updated")
    return upsert_columns(target, source, "coin_id", ["current_price", "last_updated"])


@job("sensor_table", """SELECT 'S' || CAST(user_id AS VARCHAR) AS sensor_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, value AS temperature, event_type AS status, event_id FROM events""")
def sensor_table(t: Tables) -> DataFrame:
    """Sensor readings parsed from CSV lines into a typed table."""
    from tidegrain.sources.readers import SENSOR_SCHEMA

    line = F.concat_ws(",", F.concat(F.lit("S"), F.col("user_id").cast("string")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("value").cast("string"), "event_type")
    rows = t.raw("events").select("event_id", F.from_csv(line, SENSOR_SCHEMA).alias("r"))
    return rows.select("r.*", "event_id")


# -- assets ---------------------------------------------------------------------------------------

@job("asset_audit", "SELECT s_suppkey AS asset_id, 'MODEL::' || upper(s_name) AS model, s_acctbal AS runtime_h, CASE WHEN s_acctbal > 8000 THEN 'CRITICAL' WHEN s_acctbal > 5000 THEN 'WARNING' ELSE 'active' END AS state FROM supplier".replace("upper(s_name)", "upper(replace(s_name,'#',''))"))
def asset_audit(t: Tables) -> DataFrame:
    """Status of each asset by runtime."""
    r = F.col("s_acctbal")
    return t.raw("supplier").select(F.col("s_suppkey").alias("asset_id"), F.concat(F.lit("MODEL::"), F.upper(F.trim(F.translate("s_name", X.TITLE_JUNK, "")))).alias("model"), r.alias("runtime_h"),
                                    F.when(r > 8000, "CRITICAL").when(r > 5000, "WARNING").otherwise("active").alias("state"))


@job("asset_alerts", "SELECT count(*) AS total_assets, count(CASE WHEN s_acctbal > 5000 THEN 1 END) AS alerts FROM supplier")
def asset_alerts(t: Tables) -> DataFrame:
    return asset_audit(t).agg(F.count(F.lit(1)).alias("total_assets"), count_if(F.col("state").isin("WARNING", "CRITICAL")).alias("alerts"))


_EFF, _EFF_SQL = (lambda: F.lit(0.70) + (F.col("l_linenumber") % 7) * F.lit(0.04)), "(0.70::DOUBLE + (l_linenumber % 7) * 0.04::DOUBLE)"


@job("fleet_energy", f"""SELECT l_orderkey AS fleet, l_partkey AS asset_id, l_quantity AS power_kw, l_extendedprice AS runtime_h, {_EFF_SQL} AS efficiency, {h(f'l_quantity / {_EFF_SQL} * l_extendedprice')} AS consumption_kwh,
CASE WHEN l_extendedprice > 5000 THEN 'High Usage' ELSE 'Normal' END AS status FROM lineitem""")
def fleet_energy(t: Tables) -> DataFrame:
    """Consumption and usage status per motor."""
    power, run = F.col("l_quantity"), F.col("l_extendedprice")
    return t.raw("lineitem").select(F.col("l_orderkey").alias("fleet"), F.col("l_partkey").alias("asset_id"), power.alias("power_kw"), run.alias("runtime_h"), _EFF().alias("efficiency"),
                                    half_up(power / _EFF() * run).alias("consumption_kwh"), F.when(run > 5000, "High Usage").otherwise("Normal").alias("status"))


@job("fleet_total", f"""SELECT CASE WHEN l_extendedprice > 5000 THEN 'High Usage' ELSE 'Normal' END AS status, count(*) AS motors, CAST(sum(CAST({h(f'l_quantity / {_EFF_SQL} * l_extendedprice')} AS DECIMAL(18,2))) AS DOUBLE) AS total_kwh FROM lineitem GROUP BY 1""")
def fleet_total(t: Tables) -> DataFrame:
    """Totals line of the fleet report by status."""
    return fleet_energy(t).groupBy("status").agg(F.count(F.lit(1)).alias("motors"), dbl(F.sum(F.col("consumption_kwh").cast("decimal(18,2)"))).alias("total_kwh"))


_FREQ_SQL = "(30 + l_partkey % 31)"
_VFD_SQL = f"greatest({_EFF_SQL} - (50 - {_FREQ_SQL}) / 5.0::DOUBLE * 0.005::DOUBLE, 0.70::DOUBLE)"


@job("vfd_energy", f"""SELECT l_orderkey AS fleet, l_partkey AS asset_id, {_FREQ_SQL} AS frequency_hz, {h(f'CASE WHEN l_returnflag = {chr(39)}A{chr(39)} THEN {_VFD_SQL} ELSE {_EFF_SQL} END', 3)} AS efficiency,
{h(f'l_quantity * 100.0::DOUBLE / CASE WHEN l_returnflag = {chr(39)}A{chr(39)} THEN {_VFD_SQL} ELSE {_EFF_SQL} END')} AS energy_kwh FROM lineitem""")
def vfd_energy(t: Tables, hours: float = 100.0) -> DataFrame:
    """Plain and variable-speed motors: the type column picks the formula; efficiency never under 0.70."""
    freq = F.col("l_partkey") % 31 + 30
    eff = F.when(F.col("l_returnflag") == "A", F.greatest(_EFF() - (F.lit(50) - freq) / F.lit(5.0) * F.lit(0.005), F.lit(0.70))).otherwise(_EFF())
    return t.raw("lineitem").select(F.col("l_orderkey").alias("fleet"), F.col("l_partkey").alias("asset_id"), freq.alias("frequency_hz"), half_up(eff, 3).alias("efficiency"),
                                    half_up(F.col("l_quantity") * F.lit(hours) / eff).alias("energy_kwh"))


@job("engineering_cols", f"""SELECT p_partkey AS item_id, {h('p_size / 0.7457::DOUBLE')} AS horse_power, CASE WHEN p_size / 8.0::DOUBLE > 5.0 THEN 'ALERTA: SOBREPRESIÓN DETECTADA' WHEN p_size / 8.0::DOUBLE >= 1.5 THEN 'OPERACIÓN NOMINAL (ESTABLE)' ELSE 'PELIGRO: PRESIÓN INSUFICIENTE' END AS oil_pressure,
{h("2.0::DOUBLE * (p_partkey % 90) * p_size / (CASE p_partkey % 3 WHEN 0 THEN 56 WHEN 1 THEN 35 END * 6.0::DOUBLE)")} AS voltage_drop, CASE WHEN p_partkey % 3 = 2 THEN 'ERROR: MATERIAL' WHEN {h("2.0::DOUBLE * (p_partkey % 90) * p_size / (CASE p_partkey % 3 WHEN 0 THEN 56 WHEN 1 THEN 35 END * 6.0::DOUBLE)")} > 6.9 THEN 'PELIGRO' ELSE 'OK' END AS line_status FROM part""")
def engineering_cols(t: Tables, limit: float = 6.9, section: float = 6.0) -> DataFrame:
    """Kilowatt to horse power, oil-pressure band, voltage drop by material against the limit."""
    k, size = F.col("p_partkey"), F.col("p_size")
    material = F.when(k % 3 == 0, "COBRE").when(k % 3 == 1, "ALUMINIO").otherwise("HIERRO")
    sigma = F.when(material.isin("CU", "COBRE"), F.lit(56)).when(material.isin("AL", "ALUMINIO"), F.lit(35))
    drop = half_up(F.lit(2.0) * (k % 90) * size / (sigma * F.lit(section)))
    bar = size / F.lit(8.0)
    return t.raw("part").select(
        k.alias("item_id"), half_up(size / F.lit(0.7457)).alias("horse_power"),
        F.when(bar > 5.0, "ALERTA: SOBREPRESIÓN DETECTADA").when(bar >= 1.5, "OPERACIÓN NOMINAL (ESTABLE)").otherwise("PELIGRO: PRESIÓN INSUFICIENTE").alias("oil_pressure"),
        drop.alias("voltage_drop"), F.when(sigma.isNull(), "ERROR: MATERIAL").when(drop > limit, "PELIGRO").otherwise("OK").alias("line_status"))


@job("pressure_band", """SELECT event_id, CAST(floor(value * 20) AS BIGINT) AS pressure_mbar, CASE WHEN floor(value * 20) <= 2000 THEN 'SAFE' WHEN floor(value * 20) <= 3000 THEN 'WARNING' ELSE 'CRITICAL' END AS status,
CAST(CASE WHEN floor(value * 20) <= 2000 THEN 0 WHEN floor(value * 20) <= 3000 THEN 1 ELSE 2 END AS BIGINT) AS alert_level, CAST(3000 - floor(value * 20) AS BIGINT) AS safety_margin FROM events""")
def pressure_band(t: Tables) -> DataFrame:
    """Labelled pressure readings to band, alert level and safety margin."""
    text = F.concat(F.lit("  pressure_reading: "), F.floor(F.col("value") * 20).cast("string"), F.lit(" mbar  "))
    p = F.col("pressure_mbar")
    return t.raw("events").select("event_id", X.parse_reading(text).alias("pressure_mbar")).select(
        "event_id", "pressure_mbar", F.when(p <= 2000, "SAFE").when(p <= 3000, "WARNING").otherwise("CRITICAL").alias("status"),
        F.when(p <= 2000, 0).when(p <= 3000, 1).otherwise(2).cast("bigint").alias("alert_level"), (F.lit(3000) - p).alias("safety_margin"))


@job("stock_check", """WITH a AS (SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN 'A' ELSE 'B' END AS category, CAST(p_size AS BIGINT) AS q FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey AS id, CAST(p_size + p_partkey % 3 - 1 AS BIGINT) AS q FROM part WHERE p_partkey % 5 <> 0)
SELECT coalesce(a.id, b.id) AS id, category, a.q AS system_qty, b.q AS physical_qty, b.q - a.q AS difference, CASE WHEN b.q IS NULL THEN 'MISSING' WHEN a.q IS NULL THEN 'UNREGISTERED' WHEN b.q > a.q THEN 'EXCESO' WHEN b.q < a.q THEN 'FALTA' ELSE 'OK' END AS state,
CAST(coalesce(b.q IS NULL AND category = 'A', FALSE) AS BIGINT) AS critical FROM a FULL JOIN b ON a.id = b.id""")
def stock_check(t: Tables) -> DataFrame:
    """System stock against the physical count."""
    p, k, size = t.raw("part"), F.col("p_partkey"), F.col("p_size").cast("bigint")
    system = p.where(k % 7 != 0).select(k.alias("id"), F.when(size > 40, "A").otherwise("B").alias("category"), size.alias("q"))
    physical = p.where(k % 5 != 0).select(k.alias("id"), (size + k % 3 - 1).alias("q"))
    return reconcile(system, physical, "id", "q").withColumn("critical", F.coalesce("critical", F.lit(0)).cast("bigint"))
