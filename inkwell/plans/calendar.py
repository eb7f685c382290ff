"""Queries over order dates as run days and publication dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import dates
from inkwell.operators import discovery, intervals
from inkwell.session import table


def _days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run_day")).distinct()


def _said(c: str):
    """Results name days as ISO strings."""
    return F.col(c).cast("string").alias(c)


def date_window(spark, sf_dir):
    d = F.col("run_day")
    return _days(spark, sf_dir).select(_said("run_day"), dates.window_start(d).cast("string").alias("start_day"), dates.window_mode(d).alias("mode"))


def window_dates(spark, sf_dir):
    return _days(spark, sf_dir).select(_said("run_day"), F.explode(dates.window_dates(F.col("run_day"))).alias("publication_day"))


def window_range_join(spark, sf_dir):
    """Orders in each run day's window. The window's days are spelled out, so the range join is an equi-join on counts by day."""
    by_day = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").cast("string").alias("publication_day")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))
    spelled = _days(spark, sf_dir).select(_said("run_day"), F.explode(dates.window_dates(F.col("run_day"))).alias("publication_day"))
    return spelled.join(by_day, "publication_day").groupBy("run_day").agg(F.sum("n").alias("orders"), F.max("last_key").alias("last_key"))


def listing_gate(spark, sf_dir):
    """Orders as listing items of a run on 1998-06-15: kept, older or future."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 20 != 0, F.to_date("o_orderdate")).alias("hint"), F.lit("1998-06-15").cast("date").alias("day"))
    return discovery.gate_listing(o, "hint", "day").groupBy("listing_gate").agg(F.count(F.lit(1)).alias("items"))


def pagination_stop(spark, sf_dir):
    """Customers as sources, their orders as items on pages of one: reading stops after an older item or a gap."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("hint"), F.lit("1998-06-15").cast("date").alias("day"), (F.col("o_orderkey") % 7 + 1).alias("page"))
    read = discovery.pages_read(discovery.gate_listing(o, "hint", "day"), ["o_custkey"])
    return read.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("items"), F.max("page").alias("last_page"))


def available_dates(spark, sf_dir):
    from inkwell.operators import selection

    o = table(spark, sf_dir, "orders")
    published = F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate").cast("string"))
    run = F.when(F.col("o_orderkey") % 10 != 0, F.lit("1999-01-01")).otherwise("unknown")
    records = o.select("o_orderstatus", published.alias("p"), run.alias("r"), F.when(F.col("o_orderkey") % 20 == 0, "1999-02-02").alias("f"))
    return selection.available_dates(records, "o_orderstatus", selection.effective_date(F.col("p"), F.col("r"), F.col("f")))


def cron_next_fire(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", dates.next_fire(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("next_fire"))


def backoff_schedule(spark, sf_dir):
    a = F.col("attempt")
    return spark.range(1, 3).select(F.col("id").alias("attempt")).select("attempt", dates.retry_delay(a).alias("delay_seconds"))


def date_wordings(spark, sf_dir):
    """Dates of orders as pages word them, read at six in the morning of the order's day."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    now = F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + 6 * 3600 + 10 * 60 + 5)
    d = F.date_add(day, F.pmod(k, F.lit(300)).cast("int") * -1)
    nth = F.concat(F.dayofmonth(d), F.when(F.dayofmonth(d).isin(1, 21, 31), "st").when(F.dayofmonth(d).isin(2, 22), "nd").when(F.dayofmonth(d).isin(3, 23), "rd").otherwise("th"))
    said = [
        F.concat(k % 50, F.lit(" hours ago")), F.concat(F.lit("about "), k % 30 + 1, F.lit(" months ago")), F.concat(F.lit("Yesterday at "), k % 12 + 1, F.lit(":05 PM")), F.date_format(d, "EEEE"),
        F.concat(F.date_format(d, "MMM "), nth, F.date_format(d, ", yyyy")), F.date_format(d, "d MMMM"), F.concat(F.date_format(d, "yyyy/M/d"), F.lit(" 21:40 UTC")), F.concat(k % 100, F.lit(" comments")),
    ]
    wording = F.element_at(F.array(*said), (F.pmod(k, F.lit(8)) + 1).cast("int"))
    return o.select("o_orderkey", wording.alias("wording"), dates.parse_date(wording, now).alias("parsed"))


def wide_range_join(spark, sf_dir):
    """Orders in windows of 1 to 400 days, one a supplier: how many, and the first and last."""
    k = F.col("s_suppkey")
    low = F.unix_date(F.date_add(F.lit("1992-01-01").cast("date"), F.pmod(k * 611, F.lit(2500)).cast("int"))).alias("low")
    suppliers = table(spark, sf_dir, "supplier").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("times"))
    windows = suppliers.select("s_suppkey", "times", low, F.pmod(k * 37, F.lit(400)).alias("width")).withColumn("high", F.col("low") + F.col("width"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    found = intervals.fold_ranges(orders, windows, "day", "low", "high", "o_orderkey")
    return found.select("s_suppkey", (F.col("n") * F.col("times")).alias("orders"), F.col("least").alias("first"), F.col("most").alias("last"), F.col("n_distinct").alias("distinct_orders"))


QUERIES = {f.__name__: f for f in (date_window, window_dates, window_range_join, date_wordings, wide_range_join, listing_gate, pagination_stop, available_dates, cron_next_fire, backoff_schedule)}

_DAYS = "d AS (SELECT DISTINCT o_orderdate::DATE AS run_day FROM orders), w AS (SELECT run_day, run_day - CASE WHEN isodow(run_day) = 1 THEN 3 WHEN isodow(run_day) < 6 THEN 1 ELSE 0 END::INTEGER AS start_day FROM d)"

ORACLES = {
    "date_wordings": """
WITH o AS (
  SELECT o_orderkey AS k, o_orderdate::DATE AS day, o_orderdate::DATE::TIMESTAMP + INTERVAL '11 hours 40 minutes 5 seconds' AS here, o_orderdate::DATE - (o_orderkey % 300)::INT AS d FROM orders),
w AS (
  SELECT *, CASE k % 8 WHEN 0 THEN k % 50 || ' hours ago' WHEN 1 THEN 'about ' || k % 30 + 1 || ' months ago' WHEN 2 THEN 'Yesterday at ' || k % 12 + 1 || ':05 PM' WHEN 3 THEN strftime(d, '%A')
                 WHEN 4 THEN strftime(d, '%b ') || day(d) || CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(d, ', %Y')
                 WHEN 5 THEN strftime(d, '%-d %B') WHEN 6 THEN strftime(d, '%Y/%-m/%-d 21:40 UTC') ELSE k % 100 || ' comments' END AS wording,
         CASE k % 8 WHEN 0 THEN here - to_hours(k % 50) WHEN 1 THEN here - to_months((k % 30 + 1)::INT) WHEN 2 THEN (day - 1)::TIMESTAMP + to_hours((k % 12 + 1) % 12 + 12) + INTERVAL 5 MINUTE
                 WHEN 3 THEN (day - CASE WHEN (day - d) % 7 = 0 THEN 7 ELSE (day - d) % 7 END::INT)::TIMESTAMP WHEN 4 THEN d::TIMESTAMP
                 WHEN 5 THEN d::TIMESTAMP WHEN 6 THEN d::TIMESTAMP + INTERVAL '21 hours 40 minutes' + INTERVAL '5 hours 30 minutes' END AS moment
  FROM o)
SELECT k AS o_orderkey, wording, strftime(moment, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS parsed FROM w""",
    "wide_range_join": """
WITH s AS (SELECT s_suppkey, DATE '1992-01-01' + (s_suppkey * 611 % 2500)::INT AS low, (s_suppkey * 37 % 400)::INT AS width FROM supplier)
SELECT s_suppkey, count(*) AS orders, min(o_orderkey) AS first, max(o_orderkey) AS last, count(DISTINCT o_orderkey) AS distinct_orders
FROM s JOIN orders ON o_orderdate::DATE BETWEEN low AND low + width GROUP BY s_suppkey""",
    "date_window": f"WITH {_DAYS} SELECT run_day::VARCHAR AS run_day, start_day::DATE::VARCHAR AS start_day, CASE WHEN isodow(run_day) = 1 THEN 'MONDAY_WEEKEND_CATCHUP' WHEN isodow(run_day) < 6 THEN 'DAILY_WITH_LOOKBACK' ELSE 'WEEKEND_MANUAL' END AS mode FROM w",
    "window_dates": f"WITH {_DAYS} SELECT run_day::VARCHAR AS run_day, unnest(generate_series(start_day::TIMESTAMP, run_day::TIMESTAMP, INTERVAL 1 DAY))::DATE::VARCHAR AS publication_day FROM w",
    "window_range_join": f"WITH {_DAYS} SELECT run_day::VARCHAR AS run_day, count(*) AS orders, max(o_orderkey) AS last_key FROM w JOIN orders ON o_orderdate::DATE BETWEEN start_day AND run_day GROUP BY run_day",
    "listing_gate": """
WITH o AS (SELECT CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate::DATE END AS hint FROM orders)
SELECT CASE WHEN hint IS NULL OR hint BETWEEN DATE '1998-06-12' AND DATE '1998-06-15' THEN 'KEPT' WHEN hint < DATE '1998-06-12' THEN 'OLDER' ELSE 'FUTURE' END AS listing_gate,
       count(*) AS items
FROM o GROUP BY 1""",
    "pagination_stop": """
WITH o AS (SELECT o_custkey, o_orderdate::DATE < DATE '1998-06-12' AS older, o_orderkey % 7 + 1 AS page FROM orders WHERE o_orderkey % 7 + 1 <= 5),
p AS (SELECT o_custkey, page, max(older::INT) AS older, count(*) AS n FROM o GROUP BY ALL),
r AS (SELECT *, coalesce(max(older) OVER (PARTITION BY o_custkey ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0
             AND page = row_number() OVER (PARTITION BY o_custkey ORDER BY page) AS go FROM p)
SELECT o_custkey, sum(n)::BIGINT AS items, max(page) AS last_page FROM r WHERE go GROUP BY o_custkey""",
    "available_dates": """
WITH r AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate::DATE::VARCHAR WHEN o_orderkey % 10 <> 0 THEN '1999-01-01' WHEN o_orderkey % 20 = 0 THEN '1999-02-02' END AS date FROM orders)
SELECT o_orderstatus, date, count(*) AS records FROM r WHERE date IS NOT NULL GROUP BY ALL""",
    "cron_next_fire": """
SELECT event_id, (SELECT min(t) FROM (SELECT unnest(generate_series(date_trunc('hour', ts) + INTERVAL 1 HOUR, date_trunc('hour', ts) + INTERVAL 169 HOUR, INTERVAL 1 HOUR)) AS t)
                  WHERE isodow(t) < 6 AND hour(t) BETWEEN 8 AND 17) AS next_fire
FROM events""",
    "backoff_schedule": "SELECT range::BIGINT AS attempt, 1.5::DOUBLE * pow(2, range - 1) AS delay_seconds FROM range(1, 3)",
}
