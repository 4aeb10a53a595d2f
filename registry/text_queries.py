"""Texts as dates and numbers, pages, links, file names and coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from halfhourly.functions import dates as D, text as X
from halfhourly.operators.coverage import link_days, manifest, matching_links, named_days
from halfhourly.operators.daybits import add_bits, day_bits, days_missing, read_bits
from halfhourly.operators.joins import missing_days
from halfhourly.operators.predicates import larger_than_bytes
from halfhourly.plans.futures import quotes_of_pages, refresh_quotes
from halfhourly.plans.weather import weather_of_pages
from halfhourly.session import staged, work_folder
from halfhourly.sources.lakes import lake_rows
from halfhourly.sources.markup import page_links, page_table_rows
from halfhourly.sources.nested import nested_table_rows
from registry import views as V
from registry.views import query

# --- dates in texts ------------------------------------------------------------

_SHAPES = {1: ("dd-MM-yyyy", "%d-%m-%Y"), 2: ("yyyy-MM-dd", "%Y-%m-%d"), 3: ("yyyyMMdd", "%Y%m%d"),
           4: ("d/M/yyyy", "%-d/%-m/%Y"), 5: ("d MMMM yyyy", "%-d %B %Y"),
           6: ("dd/MM/yyyy HH:mm", "%d/%m/%Y %H:%M")}
_SQL_TEXT = "CASE l_linenumber " + " ".join(
    f"WHEN {n} THEN strftime(l_shipdate, '{f}')" for n, (_, f) in _SHAPES.items()) + \
    " ELSE '31-02-' || year(l_shipdate) END"


@query("parse_date", f"""
SELECT l_orderkey, l_linenumber, t AS date_text, CAST(CASE
         WHEN regexp_matches(t, '^\\d{{4}}-') THEN try_strptime(t, '%Y-%m-%d')
         WHEN regexp_matches(t, '^\\d{{8}}$') THEN try_strptime(t, '%Y%m%d')
         WHEN t LIKE '% %:%' THEN try_strptime(t, '%d/%m/%Y %H:%M')
         WHEN t LIKE '%/%' THEN try_strptime(t, '%d/%m/%Y')
         WHEN t LIKE '% %' THEN try_strptime(t, '%d %B %Y')
         ELSE try_strptime(t, '%d-%m-%Y') END AS DATE) AS parsed
FROM (SELECT l_orderkey, l_linenumber, {_SQL_TEXT} AS t FROM lineitem) x""")
def _(spark, sf):
    number, ship = F.col("l_linenumber"), F.col("l_shipdate")
    text = None
    for n, (pattern, _) in _SHAPES.items():
        made = F.date_format(ship, pattern)
        text = F.when(number == n, made) if text is None else text.when(number == n, made)
    text = text.otherwise(F.concat(F.lit("31-02-"), F.year(ship).cast("string")))
    lines = V.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                                 text.alias("date_text"))
    return lines.withColumn("parsed", D.parse_date("date_text"))


@query("link_text_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS link_date FROM orders""")
def _(spark, sf):
    day = F.col("o_orderdate")
    text = F.concat(F.lit(" "), F.date_format(day, "d"), F.lit("  "),
                    F.date_format(day, "MMMM"), F.lit("   "), F.date_format(day, "yyyy"))
    return V.read(spark, sf, "orders").select("o_orderkey", D.link_text_date(text).alias("link_date"))


@query("page_name_date", """
SELECT o_orderkey, 'EODWebMarketSummary' || strftime(o_orderdate, '%y%m%d') || 'ZFT.htm' AS name,
       -- two-digit years are of this century
       CAST(strptime('20' || strftime(o_orderdate, '%y%m%d'), '%Y%m%d') AS DATE) AS quote_date
FROM orders""")
def _(spark, sf):
    names = V.read(spark, sf, "orders").select(
        "o_orderkey", D.summary_page_name(F.col("o_orderdate")).alias("name"))
    return names.withColumn("quote_date", D.summary_page_date(
        F.concat(F.lit("/pages/"), F.col("name"))))


@query("clock_text", """
SELECT event_id, strftime(ts, '%H:%M') AS local_time FROM events""")
def _(spark, sf):
    return V.read(spark, sf, "events").select(
        "event_id", D.clock_text(F.date_format("ts", "h:mm a")).alias("local_time"))


@query("file_year", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y') END
       AS file_year FROM orders""")
def _(spark, sf):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    name = (F.when(kind == 0, F.date_format(day, "yyyy"))
            .when(kind == 1, F.date_format(day, "yyyyMM"))
            .when(kind == 2, F.date_format(day, "yyyyMMdd"))
            .otherwise(F.concat(F.lit("05_"), F.date_format(day, "yyyyMMdd"))))
    return V.read(spark, sf, "orders").select("o_orderkey", D.file_year(
        F.concat(F.lit("/data/1999/offers"), name, F.lit(".csv"))).alias("file_year"))


def _price_names(spark, sf):
    """Names of day files, month files, interim files and files without a date."""
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    name = (F.when(kind == 0, F.concat(F.lit("FP_"), F.date_format(day, "yyyyMMdd"), F.lit("_F.gdx")))
            .when(kind == 1, F.concat(F.lit("FP_"), F.date_format(day, "yyyyMM"), F.lit("x_F.gdx")))
            .when(kind == 2, F.concat(F.lit("FP_"), F.date_format(day, "yyyyMMdd"), F.lit("_I.gdx")))
            .otherwise(F.lit("FP_notes.gdx")))
    return V.read(spark, sf, "orders").select(name.alias("name")).distinct()


@query("file_dates", """
SELECT DISTINCT 'FP_' || strftime(o_orderdate, '%Y%m%d') || '_F.gdx' AS name,
       CAST(o_orderdate AS DATE) AS trading_date
FROM orders WHERE o_orderkey % 4 = 0
UNION ALL
SELECT name, CAST(unnest(generate_series(m, last_day(m), INTERVAL 1 DAY)) AS DATE) FROM (
  SELECT DISTINCT 'FP_' || strftime(o_orderdate, '%Y%m') || 'x_F.gdx' AS name,
         date_trunc('month', o_orderdate) AS m
  FROM orders WHERE o_orderkey % 4 = 1) x""")
def _(spark, sf):
    return named_days(_price_names(spark, sf), "FP_", ".gdx")


# --- numbers in texts ----------------------------------------------------------

@query("clean_number", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4
         WHEN 0 THEN NULL WHEN 1 THEN -l_extendedprice ELSE l_extendedprice END AS amount
FROM lineitem""")
def _(spark, sf):
    amount, kind = F.col("l_extendedprice"), F.col("l_linenumber") % 4
    written = F.format_number(amount, 2)
    text = (F.when(kind == 0, F.lit("-")).when(kind == 1, F.concat(F.lit("-"), written))
            .otherwise(F.concat(F.lit(" "), written)))
    return V.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                                X.clean_number(text).alias("amount"))


@query("strip_unit", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS temperature,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS wind_speed FROM events""")
def _(spark, sf):
    number = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.col("value").cast("string"))

    def text(unit):
        return F.when(number == "", number).otherwise(F.concat(number, F.lit(unit)))

    return V.read(spark, sf, "events").select(
        "event_id", X.strip_unit(text("°C"), 2).alias("temperature"),
        X.strip_unit(text("km/h"), 4).alias("wind_speed"))


@query("first_word", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
       list_extract(string_split(p_name, ' '), -1) AS last_word,
       list_extract(string_split(p_type, ' '), 2) AS second_word,
       upper(p_name) AS upper_name, lower(p_type) AS lower_type,
       regexp_extract(p_brand, '\\d+') AS digits
FROM part""")
def _(spark, sf):
    return V.read(spark, sf, "part").select(
        "p_partkey", X.first_word("p_name").alias("first_word"),
        X.last_word("p_name").alias("last_word"),
        F.coalesce(X.word("p_type", 2), F.lit(None)).alias("second_word"),
        F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"),
        F.coalesce(F.get(X.digit_runs("p_brand"), F.lit(0)), F.lit("")).alias("digits"))


# --- pages and links -----------------------------------------------------------

_SQL_LINKS = r"""
WITH anchors AS (
  SELECT page_id, url, regexp_extract_all(regexp_replace(html,
           '(?is)<(?:!--.*?--|script\b.*?</script|style\b.*?</style)>', '', 'g'),
           '(?is)<a\s[^>]*>.*?</a>') AS list FROM pages),
one AS (
  SELECT page_id, url, CAST(unnest(generate_series(1, len(list))) - 1 AS INT) AS link_no,
         unnest(list) AS a FROM anchors),
links AS (
  SELECT page_id, url, link_no,
         replace(replace(replace(replace(replace(replace(regexp_replace(
           regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1),
           '^["'']|["'']$', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS href,
         replace(replace(replace(replace(replace(replace(
           regexp_replace(a, '(?s)<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS text
  FROM one)
"""


@query("pages_min_size", """
SELECT page_id, url, CAST(strlen(html) AS INT) AS n_bytes FROM pages WHERE strlen(html) > 5000""")
def _(spark, sf):
    return (V.read(spark, sf, "pages").where(larger_than_bytes("html", 5000))
            .select("page_id", "url", F.octet_length("html").alias("n_bytes")))


@query("page_links", _SQL_LINKS + """
SELECT page_id, url, link_no, href, text FROM links WHERE href <> ''""")
def _(spark, sf):
    return page_links(V.read(spark, sf, "pages"))


@query("page_links_matching", _SQL_LINKS + """
SELECT page_id, url, link_no, href, text FROM links
WHERE href <> '' AND list_extract(string_split(href, '/'), -1) LIKE '%en%'""")
def _(spark, sf):
    return matching_links(page_links(V.read(spark, sf, "pages")), "en")


@query("page_links_by_text", _SQL_LINKS + """
SELECT page_id, url, link_no, href, text FROM links WHERE href <> '' AND text LIKE '%th%'""")
def _(spark, sf):
    return matching_links(page_links(V.read(spark, sf, "pages")), "th", "text")


def _offer_links(spark, sf):
    """Links to daily offer files, several for most days, coded slashes in some."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    path = F.when(key % 2 == 0, F.lit("/data%2Foffers%2F")).otherwise(F.lit("/data/offers/"))
    href = F.concat(path, F.lit("offers"), F.date_format(day, "yyyyMMdd"),
                    F.when(key % 3 == 0, F.lit("_")).otherwise(F.lit("")), F.lit(".csv.Z"))
    return V.read(spark, sf, "orders").select(key.alias("link_no"), href.alias("href"))


_SQL_DATED = """
SELECT CAST(o_orderdate AS DATE) AS trading_date,
       max_by('/data/offers/offers' || strftime(o_orderdate, '%Y%m%d')
              || CASE WHEN o_orderkey % 3 = 0 THEN '_' ELSE '' END || '.csv.Z', o_orderkey) AS href
FROM orders GROUP BY 1"""


@query("link_dates", _SQL_DATED)
def _(spark, sf):
    return link_days(_offer_links(spark, sf), "offers", ".csv.Z")


@query("download_manifest", f"""
SELECT DISTINCT href FROM ({_SQL_DATED}) p
WHERE trading_date NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def _(spark, sf):
    held = V.read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("trading_date"))
    return manifest(link_days(_offer_links(spark, sf), "offers", ".csv.Z"), held)


@query("missing_location_days", """
WITH days AS (SELECT CAST(unnest(generate_series(MIN(date_trunc('day', ts)),
                MAX(date_trunc('day', ts)), INTERVAL 1 DAY)) AS DATE) AS trading_date FROM events),
places AS (SELECT DISTINCT 'P' || CAST(user_id AS VARCHAR) AS location FROM events)
SELECT location, trading_date FROM places, days
EXCEPT SELECT 'P' || CAST(user_id AS VARCHAR), CAST(ts AS DATE) FROM events""")
def _(spark, sf):
    events = V.read(spark, sf, "events").select(
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("location"),
        F.col("ts").cast("date").alias("trading_date"))
    first, last = events.agg(F.min("trading_date"), F.max("trading_date")).first()
    return missing_days(events, ["location"], F.lit(first), F.lit(last))


@query("missing_location_days_stored", """
WITH days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-03', DATE '2024-03-20', INTERVAL 1 DAY)) AS DATE)
                AS trading_date),
places AS (SELECT DISTINCT 'P' || CAST(user_id AS VARCHAR) AS location FROM events)
SELECT location, trading_date FROM places, days
EXCEPT SELECT 'P' || CAST(user_id AS VARCHAR), CAST(ts AS DATE) FROM events""")
def _(spark, sf):
    """As above, for a range of its own, from the bits of a stored table that two loads added to."""
    folder = work_folder(spark, "location-bits")
    events = V.read(spark, sf, "events")
    for even in (0, 1):
        rows = events.where(F.hour("ts") % 2 == even).select(
            F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("location"),
            F.col("ts").cast("date").alias("trading_date"))
        add_bits(day_bits(rows, ["location"]), folder)
    return days_missing(read_bits(spark, folder, ["location"]), ["location"], "2024-01-03", "2024-03-20")


# --- stored files and pages, one made from each given row ----------------------

def _text(*parts):
    """Texts and columns put together; a column is named in braces."""
    return F.concat(*[F.col(p[1:-1]).cast("string") if p.startswith("{") else F.lit(p)
                      for p in parts])


@query("lake_files", """
SELECT CAST(o_orderdate AS DATE) + CAST(i AS INT) AS trading_date, 'L' || o_custkey AS lake,
       CASE o_orderkey % 2 WHEN 0 THEN 'stored' ELSE 'inflow' END AS measure,
       CASE o_orderkey % 2 WHEN 0 THEN 'GWh' ELSE 'GWh/d' END AS unit,
       o_totalprice + CAST(i AS DOUBLE) AS value, 'f' || o_orderkey AS source_file
FROM orders, (VALUES (0), (1)) d(i)""")
def _(spark, sf):
    orders = V.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", (F.col("o_totalprice") + 1).alias("second"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("d0"),
        F.date_format(F.date_add("o_orderdate", 1), "d/M/yyyy").alias("d1"),
        F.when(F.col("o_orderkey") % 2 == 0, "stored").otherwise("inflow").alias("word"))
    text = _text("L", "{o_custkey}", " record\r\n2\r\n3\r\n4\r\ndate,average,2014 ", "{word}", ",\r\n",
                 "{d0}", ",0.5,", "{o_totalprice}", ",\r\n", "{d1}", ",0.5,", "{second}", ",\r\n")
    return lake_rows(orders.select(text.alias("value"), _text("f", "{o_orderkey}").alias("source_file")))


_SQL_PAGES = """
SELECT DISTINCT quote_date, product, CAST(date_trunc(part, quote_date) AS DATE) AS expiry,
       CASE product WHEN 'EA' THEN -abs(c_acctbal) ELSE abs(c_acctbal) END AS sett,
       CASE product WHEN 'EA' THEN CAST(c_custkey AS DOUBLE) END AS volume,
       CAST(c_nationkey AS DOUBLE) AS op_int
FROM (SELECT *, DATE '2010-01-01' + CAST(c_custkey % 3000 AS INT) AS quote_date FROM customer) c,
     (VALUES ('EA', 'quarter'), ('ED', 'month')) p(product, part)"""


def _summary_pages(spark, sf):
    """A daily page for each customer, with rows of two products."""
    pages = V.read(spark, sf, "customer").withColumn(
        "day", F.date_add(F.lit(dt.date(2010, 1, 1)), (F.col("c_custkey") % 3000).cast("int")))
    # a page is many times its row, so rows that one task can read are dealt out before they become pages;
    # by key, as dealing in turn makes that one task sort them first
    pages = pages.select("c_custkey", "c_nationkey", "c_acctbal", "day").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    pages = pages.select(
        "c_custkey", "c_nationkey", F.date_format("day", "yyMMdd").alias("code"),
        F.date_format("day", "MMM yyyy").alias("long"), F.date_format("day", "MMM yy").alias("short"),
        F.format_number(F.abs("c_acctbal"), 2).alias("sett"))
    line = ("<tr><td>", "{long}", "</td><td>", "{c_nationkey}", "</td><td>", "{c_custkey}",
            "</td><td>-", "{sett}", "</td></tr>")
    html = _text("<html><table><tr><td>menu</td></tr></table><table><tr><th>Expiry</th><th>Op Int</th>"
                 "<th>Volume</th><th>Sett</th></tr><tr><td>EA quarterly</td></tr>", *line, *line,
                 "<tr><td></td></tr><tr><td>ED monthly</td></tr><tr><td>", "{short}", "</td><td>",
                 "{c_nationkey}", "</td><td>-</td><td>", "{sett}", "</td></tr></table><table></table>",
                 " " * 5000, "</html>")
    # the folder keeps the pages of one day apart, the name gives the day
    name = _text("/pages/", "{c_custkey}", "/EODWebMarketSummary", "{code}", "ZFT.htm")
    return pages.select(name.alias("name"), html.alias("html"))


@query("futures_pages", _SQL_PAGES)
def _(spark, sf):
    return quotes_of_pages(_summary_pages(spark, sf))


# EA is held up to one day and ED lags behind; held quotes are told by their price
_HELD_SQL = "(product = 'EA' AND quote_date <= DATE '2014-06-30') OR (product = 'ED' AND quote_date <= DATE '2014-01-31')"


@query("futures_refresh", f"""
WITH q AS ({_SQL_PAGES}), held AS (SELECT * FROM q WHERE {_HELD_SQL}),
ends AS (SELECT p.product, coalesce(MAX(h.quote_date), MIN(p.start)) AS last_day
         FROM (VALUES ('EA', DATE '2009-07-13'), ('ED', DATE '2013-12-08')) p(product, start)
         LEFT JOIN held h ON h.product = p.product GROUP BY 1)
SELECT quote_date, product, expiry, sett + 1 AS sett, volume, op_int FROM held
UNION ALL
SELECT q.* FROM q JOIN ends ON q.product = ends.product
WHERE isodow(quote_date) <= 5 AND quote_date > last_day
  AND quote_date > CASE q.product WHEN 'ED' THEN DATE '2013-12-08' ELSE DATE '2009-07-13' END""")
def _(spark, sf):
    pages = _summary_pages(spark, sf)
    held = staged(quotes_of_pages(pages).where(_HELD_SQL).withColumn("sett", F.col("sett") + 1), "held")
    return refresh_quotes(held, pages)


_WEATHER_HEAD = "".join(f"<td>{c}</td>" for c in (
    "Local Time", "Temperature", "Dewpoint", "Humidity", "Barometer", "Visibility", "Wind Direction",
    "Wind Speed", "Gust Speed", "Precipitation", "Events", "Conditions"))


@query("weather_pages", """
SELECT 'P' || c_custkey AS location, CAST(ts AS DATE) AS trading_date,
       strftime(ts, '%H:%M') AS local_time, c_acctbal AS temperature, CAST(NULL AS DOUBLE) AS dewpoint,
       CAST(c_custkey % 100 AS DOUBLE) AS humidity, CAST(1013 AS DOUBLE) AS barometer,
       CAST(NULL AS DOUBLE) AS visibility, c_acctbal AS wind_speed, CAST(NULL AS DOUBLE) AS gust_speed,
       'NNW' AS wind_direction, '' AS precipitation, 'Rain & wind' AS events,
       c_mktsegment AS conditions
FROM (SELECT *, TIMESTAMP '2014-01-01' + to_minutes(CAST(c_custkey * 31 AS BIGINT)) AS ts
      FROM customer) c""")
def _(spark, sf):
    at = F.timestamp_add("MINUTE", (F.col("c_custkey") * 31).cast("int"),
                         F.lit(dt.date(2014, 1, 1)).cast("timestamp_ntz"))
    pages = V.read(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", (F.col("c_custkey") % 100).alias("wet"),
        at.cast("date").alias("day"), F.date_format(at, "h:mm a").alias("clock"))
    html = _text("<table><tr><td>menu</td></tr></table>" * 14 + f"<table><tr>{_WEATHER_HEAD}</tr><tr><td>",
                 "{clock}", "</td><td>", "{c_acctbal}", "°C</td><td></td><td>", "{wet}",
                 "%</td><td>1013hPa</td><td></td><td>NNW</td><td>", "{c_acctbal}",
                 "km/h</td><td>Calm</td><td></td><td>Rain &amp; wind</td><td>", "{c_mktsegment}",
                 "</td></tr></table>")
    return weather_of_pages(pages.select(_text("P", "{c_custkey}").alias("location"),
                                         F.col("day").alias("trading_date"), html.alias("html")))


_KIND = "o_orderkey % 10"


@query("nested_tables", f"""
SELECT o_orderkey AS page, 0 AS table_no, CAST(NULL AS INT) AS parent_no, n AS row_no,
       CASE n WHEN 0 THEN 'a' || o_orderkey || '|b e' ELSE 'last & end' END AS cells,
       CASE WHEN {_KIND} = 3 THEN 'table is not closed' END AS reject_reason
FROM orders, (VALUES (0), (1)) r(n) WHERE {_KIND} <> 4
UNION ALL
SELECT o_orderkey, 1, 0, n, CASE n WHEN 0 THEN 'c' || o_custkey || '|d' ELSE 'f|' END, NULL
FROM orders, (VALUES (0), (1)) r(n) WHERE {_KIND} <> 4
UNION ALL
SELECT o_orderkey, 0, NULL, NULL, NULL, 'closing tag without a table' FROM orders WHERE {_KIND} = 4""")
def _(spark, sf):
    """Pages with a table in a cell, some left open, some closed without being opened."""
    key = F.col("o_orderkey")
    inner = _text("<table><tr><td>c", "{o_custkey}", "<td>d<tr><td>f<td></table>")
    page = F.concat(_text("<html><!-- <table> --><table border=1><tr><td>a", "{o_orderkey}", "</td><td>b"), inner,
                    F.lit("e</td></tr>\n<TR><th>last &amp; <b>end</b></th></TR>"),
                    F.when(key % 10 == 3, "").otherwise("</table></html>"))
    pages = V.read(spark, sf, "orders").select(
        key.alias("page"), F.when(key % 10 == 4, "<p>x</table></p>").otherwise(page).alias("html"))
    return nested_table_rows(pages).withColumn("cells", F.array_join("cells", "|"))


@query("page_table_rows", """
SELECT o_orderkey, CAST(i AS INT) AS row_no,
       CASE i WHEN 0 THEN 'key|price' ELSE o_orderkey || '|' || o_orderpriority END AS cells
FROM orders, (VALUES (0), (1)) r(i)""")
def _(spark, sf):
    html = _text("<div><table></table><TABLE class='x'><tr><th>key</th><th>price</th></tr>\n<tr><td>",
                 "{o_orderkey}", "</td><td><b>", "{o_orderpriority}", "</b></td></tr></TABLE></div>")
    orders = V.read(spark, sf, "orders").select("o_orderkey", html.alias("html"))
    return page_table_rows(orders, 1).withColumn("cells", F.array_join("cells", "|"))
