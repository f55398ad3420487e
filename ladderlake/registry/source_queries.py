"""Scans and generated sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.functions.columns import load_time
from ladderlake.plans import views
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.stand_ins import table, with_ctes
from ladderlake.sinks.files import land_json, land_nanos, land_parquet
from ladderlake.sinks.workspace import fresh_path
from ladderlake.sources import scans
from ladderlake.sources.calendar import weekly_paths, weekly_windows


@register(
    "scan_configured",
    """SELECT 'MATCH_FEED' AS source, o_orderkey AS id, o_orderstatus AS what FROM orders
UNION ALL SELECT 'EVENT_FEED', event_id, event_type FROM events
UNION ALL SELECT 'LOOKUP', c_custkey, c_name || ', "' || c_mktsegment || '"' FROM customer""",
)
def scan_configured(spark, sf):
    """Three sources that only differ in their configuration: parquet, JSON lines, CSV."""
    lines, lookup = fresh_path(spark, "events"), fresh_path(spark, "lookup")
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("what"))
    land_json(events, lines)
    named = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"'))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), named.alias("what"))
    customers.write.option("header", True).option("escape", '"').csv(lookup)
    layout = "id bigint, what string"
    quoted = {"header": "true", "escape": '"'}
    configured = [
        (scans.FileSource(f"{sf}/orders.parquet", "parquet", "MATCH_FEED"), "o_orderkey", "o_orderstatus"),
        (scans.json_lines(lines, "EVENT_FEED", layout), "id", "what"),
        (scans.FileSource(lookup, "csv", "LOOKUP", schema=layout, options=quoted), "id", "what"),
    ]
    rows = [
        scans.scan(spark, src).select(
            F.lit(src.source).alias("source"), F.col(key).alias("id"), F.col(what).alias("what")
        )
        for src, key, what in configured
    ]
    return reduce(DataFrame.unionByName, rows)


@register("scan_parquet", "SELECT event_id, user_id, ts FROM events")
def scan_parquet(spark, sf):
    """A feed whose timestamps are nanosecond counts, stored and scanned back."""
    path = fresh_path(spark, "events")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    table(spark, sf, "events").withColumn("ts", nanos).write.parquet(path)
    feed = scans.FileSource(path, "parquet", "EVENT_FEED", nanos=("ts",))
    spark.conf.set(scans.NANOS_AS_LONG, "true")
    return scans.scan(spark, feed).select(
        "event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts")
    )


@register(
    "scan_parquet_nanos",
    """SELECT event_id, user_id, ts, CAST(ts AS DATE) AS file_date FROM events
WHERE CAST(ts AS DATE) IS NOT NULL""",
)
def scan_parquet_nanos(spark, sf):
    """A folder per date: those of even days hold files that count nanoseconds, as data frame
    libraries write them, those of odd days files with microseconds."""
    path = fresh_path(spark, "events_nanos")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("file_date")
    )
    even = F.dayofmonth("file_date") % 2 == 0
    land_parquet(events.where(~even), path)
    days = events.where(even).select("file_date").distinct().collect()
    for (day,) in days:  # a file for each date of the week or two that the events span
        some = events.where(F.col("file_date") == F.lit(day)).drop("file_date")
        land_nanos(some, f"{path}/file_date={day}", "ts")
    spark.conf.set(scans.NANOS_AS_LONG, "true")
    feed = scans.weekly_parquet(path, "EVENT_FEED", nanos=("ts",), mixed=True)
    found = scans.with_provenance(scans.scan(spark, feed), feed.source, dated=True, root=path)
    return found.select(
        "event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "file_date"
    )


@register(
    "scan_json_multiline",
    with_ctes(
        s.PAGE_ENTRIES.format(base=s.GROUP_BASE, more="1 AS loads"),
        "supplier_stats", "leaderboards_sr",
    ),
)
def scan_json_multiline(spark, sf):
    """Pretty-printed pages, an array of them per file."""
    path = fresh_path(spark, "pages")
    s.write_page_files(spark, sf, path)
    feed = scans.json_documents(path, s.BOARD_SOURCE, schemas.RAW_LEADERBOARD_PAGE)
    pages = scans.scan(spark, feed).withColumn("loads", F.lit(1))
    return s.page_entries(pages, "loads")


@register(
    "scan_csv_header",
    """SELECT c_name || ', ' || c_mktsegment AS Country,
 CASE WHEN c_nationkey = 7 THEN 'na' ELSE 'c' || c_custkey END AS Country_code FROM customer""",
)
def scan_csv_header(spark, sf):
    """A lookup with quoted commas and the code "na", which is text and not a missing value."""
    path = fresh_path(spark, "countries")
    table(spark, sf, "customer").select(
        F.concat_ws(", ", "c_name", "c_mktsegment").alias("Country"),
        F.when(F.col("c_nationkey") == 7, "na")
        .otherwise(F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
        .alias("Country_code"),
    ).write.option("header", True).csv(path)
    return scans.scan(spark, scans.csv_lookup(path, "LOOKUP", schemas.RAW_COUNTRIES))


@register("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_table(spark, sf):
    name = f"{s.scratch_database(spark, 'scan')}.orders"
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.saveAsTable(
        name
    )
    return scans.scan_table(spark, name)


@register(
    "scan_csv_gz",
    with_ctes(
        """SELECT player_name, rank, rating, country, win_percentage, total_matches, wins, losses,
 last_played FROM leaderboard_view""",
        *s.LEADERBOARD_VIEW,
    ),
)
def scan_csv_gz(spark, sf):
    path = fresh_path(spark, "leaderboard")
    board = views.leaderboard(s.standings(spark, sf))
    views.export(board, path, views.LEADERBOARD_ORDER, load_time())
    back = scans.scan_export(spark, path, schemas.VIEW_LEADERBOARD).drop("ldts")
    return back.withColumn("last_played", F.col("last_played").cast("timestamp_ntz"))


@register("gen_dim_date", with_ctes("SELECT * FROM days", "days"))
def gen_dim_date(spark, sf):
    return s.days(spark, sf)


def _nation_ranges(spark, sf):
    """First and last order date of each nation's customers."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy("c_nationkey")
        .agg(
            F.to_date(F.min("o_orderdate")).alias("first"),
            F.to_date(F.max("o_orderdate")).alias("last"),
        )
    )


_WINDOWS = """
 ranges AS (SELECT c_nationkey, CAST(min(o_orderdate) AS DATE) AS first,
  CAST(max(o_orderdate) AS DATE) AS last
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
 all_days AS (SELECT c_nationkey, last,
   unnest(generate_series(first, last, INTERVAL 1 DAY))::DATE AS dated FROM ranges),
 windows AS (SELECT c_nationkey, dated,
   strftime(dated, '%Y-%m-%d') || '_' || strftime(dated + 6, '%Y-%m-%d') AS query_str
  FROM all_days WHERE extract(dow FROM dated) = 0 AND dated + 6 <= last)"""


@register("gen_weekly_windows", f"WITH {_WINDOWS} SELECT c_nationkey, dated, query_str FROM windows")
def gen_weekly_windows(spark, sf):
    return weekly_windows(_nation_ranges(spark, sf), "first", "last").drop("first", "last")


@register(
    "gen_weekly_paths",
    f"""WITH {_WINDOWS} SELECT c_nationkey, strftime(dated, '%Y-%m-%d') AS file_date,
 query_str || '/stats.parquet' AS endpoint_str FROM windows""",
)
def gen_weekly_paths(spark, sf):
    windows = weekly_windows(_nation_ranges(spark, sf), "first", "last").drop("first", "last")
    return weekly_paths(windows, "stats")
