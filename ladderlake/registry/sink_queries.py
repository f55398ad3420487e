"""Sinks: each writes to scratch space of its own and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.functions.columns import load_time
from ladderlake.plans import views
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.aggregate_queries import civ_view
from ladderlake.registry.stand_ins import table, with_ctes
from ladderlake.sinks.files import land_json, land_parquet
from ladderlake.sinks.tables import upsert, write_table
from ladderlake.sinks.workspace import fresh_path
from ladderlake.sources import scans
from ladderlake.sources.scans import scan_export


@register("sink_overwrite_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_overwrite_table(spark, sf):
    """The second write replaces the rows and the schema of the first."""
    name = f"{s.scratch_database(spark, 'overwrite')}.orders"
    orders = table(spark, sf, "orders")
    write_table(orders.select("o_orderkey", "o_custkey"), name)
    write_table(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    return spark.table(name)


@register(
    "sink_partitioned",
    f"""SELECT o_orderkey, o_totalprice, {s.quarter("o_orderdate")} AS file_date FROM orders""",
)
def sink_partitioned(spark, sf):
    name = f"{s.scratch_database(spark, 'partitioned')}.orders"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", s.quarter_of("o_orderdate").alias("file_date")
    )
    write_table(orders, name, partition_by="file_date")
    return spark.table(name)


def _upsert_sides(spark, sf):
    """Held: all orders but the low-priority ones. Incoming: all finished orders, their
    price doubled and those of urgent priority moved to the next quarter."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice",
        s.quarter_of("o_orderdate").alias("file_date"),
    )
    held = orders.filter(F.col("o_orderpriority") != "5-LOW")
    later = F.add_months("file_date", 3)
    incoming = orders.filter(F.col("o_orderstatus") == "F").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") * 2,
            "file_date": F.when(F.col("o_orderpriority") == "1-URGENT", later).otherwise(
                F.col("file_date")
            ),
        }
    )
    return held.drop("o_orderstatus"), incoming.drop("o_orderstatus")


_UPSERTED = """WITH o AS (SELECT *, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q FROM orders)
SELECT o_orderkey, o_orderpriority,
 CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
 CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  THEN CAST(q + INTERVAL 3 MONTH AS DATE) ELSE q END AS file_date
FROM o WHERE o_orderstatus = 'F' OR o_orderpriority <> '5-LOW'"""


@register("sink_upsert", _UPSERTED)
def sink_upsert(spark, sf):
    """Merge into a table partitioned by quarter, with updates that change their partition."""
    name = f"{s.scratch_database(spark, 'upsert')}.orders"
    held, incoming = _upsert_sides(spark, sf)
    upsert(spark, held, name, "o_orderkey", partition_by="file_date")
    upsert(spark, incoming, name, "o_orderkey", partition_by="file_date")
    return spark.table(name)


@register("sink_upsert_whole", _UPSERTED)
def sink_upsert_whole(spark, sf):
    """The same merge into a table without partitions."""
    name = f"{s.scratch_database(spark, 'upsert_whole')}.orders"
    held, incoming = _upsert_sides(spark, sf)
    upsert(spark, held, name, "o_orderkey")
    upsert(spark, incoming, name, "o_orderkey")
    return spark.table(name)


@register(
    "sink_upsert_metrics",
    """SELECT count(*) FILTER (o_orderpriority = '5-LOW') AS inserted,
 count(*) FILTER (o_orderpriority <> '5-LOW') AS updated FROM orders WHERE o_orderstatus = 'F'""",
)
def sink_upsert_metrics(spark, sf):
    """The counts that a merge returns."""
    name = f"{s.scratch_database(spark, 'metrics')}.orders"
    held, incoming = _upsert_sides(spark, sf)
    upsert(spark, held, name, "o_orderkey", partition_by="file_date")
    done = upsert(spark, incoming, name, "o_orderkey", partition_by="file_date")
    return spark.range(1).select(
        F.lit(done.inserted).cast("bigint").alias("inserted"),
        F.lit(done.updated).cast("bigint").alias("updated"),
    )


@register("sink_csv_gz", with_ctes("SELECT * FROM civ_view", *s.CIV_VIEW))
def sink_csv_gz(spark, sf):
    path = fresh_path(spark, "civ_performance")
    views.export(civ_view(spark, sf), path, views.CIV_PERFORMANCE_ORDER, load_time())
    return scan_export(spark, path, schemas.VIEW_CIV_PERFORMANCE).drop("ldts")


@register(
    "sink_land_parquet",
    "SELECT event_id, user_id, value, CAST(ts AS DATE) AS file_date FROM events",
)
def sink_land_parquet(spark, sf):
    """Landing a date again replaces that date and leaves the others."""
    path = fresh_path(spark, "events")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("file_date")
    )
    land_parquet(events, path)
    land_parquet(events.filter(F.dayofmonth("file_date") == 3), path)
    return spark.read.parquet(path)


@register(
    "sink_land_json",
    with_ctes(
        s.PAGE_ENTRIES.format(base=s.GROUP_BASE, more=f"'{s.BOARD_SOURCE}' AS source"),
        "supplier_stats", "leaderboards_sr",
    ),
)
def sink_land_json(spark, sf):
    """What is landed is read by the scan that the bronze job uses."""
    path = fresh_path(spark, "pages")
    land_json(s.leaderboard_pages(spark, sf).select("statGroups", "leaderboardStats"), path)
    feed = scans.json_lines(path, s.BOARD_SOURCE, schemas.RAW_LEADERBOARD_PAGE)
    pages = scans.scan(spark, feed).withColumn("source", F.lit(feed.source))
    return s.page_entries(pages, "source")
