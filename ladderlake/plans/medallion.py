"""All jobs in dependency order, from raw files to exported views."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ladderlake.plans import bronze, gold, landing, silver, views
from ladderlake.quality import records
from ladderlake.sources.calendar import CALENDAR_END, CALENDAR_START
from ladderlake.sources.documents import document_pages
from ladderlake.sources.scans import (
    FileSource,
    json_lines,
    scan,
    scan_table,
    weekly_parquet,
    with_provenance,
)


@dataclass(frozen=True)
class Lake:
    """Databases of the three layers, and the folders of exported views and of landed files.

    With a `landing` folder, what arrives is validated first: the valid part lands there and
    is what the bronze layer reads, the rest goes to quarantine below it. Without one the
    sources are taken as landed already.
    """

    exports: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    landing: str | None = None

    def create(self, spark: SparkSession, location: str | None = None) -> None:
        for name in (self.bronze, self.silver, self.gold):
            at = f" LOCATION '{location}/{name}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


@dataclass(frozen=True)
class RawFiles:
    matches: FileSource
    players: FileSource
    leaderboard_pages: FileSource
    countries: FileSource


def run(
    spark: SparkSession,
    raw: RawFiles,
    lake: Lake,
    window: tuple[date | str, date | str],
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END),
    game_dates: tuple[str, str] = (silver.FIRST_GAME_DATE, silver.LAST_GAME_DATE),
) -> None:
    """Load the run window's files and carry them through to the views."""
    br, sr, gd = lake.bronze, lake.silver, lake.gold
    if lake.landing:
        raw = land(spark, raw, lake.landing, window)

    bronze.load_files(spark, raw.matches, f"{br}.matches_br", window)
    bronze.load_files(spark, raw.players, f"{br}.players_br", window)
    bronze.load_files(spark, raw.leaderboard_pages, f"{br}.leaderboard_pages_br")
    bronze.load_files(spark, raw.countries, f"{br}.country_list_br")
    bronze.load_calendar(spark, f"{br}.dim_date_br", *calendar)

    silver.load_calendar(spark, f"{br}.dim_date_br", f"{sr}.dim_date_sr")
    silver.load_matches(spark, f"{br}.matches_br", f"{sr}.matches_sr")
    silver.load_players(spark, f"{br}.players_br", f"{sr}.players_sr")
    silver.load_leaderboards(spark, f"{br}.leaderboard_pages_br", f"{sr}.leaderboards_sr")
    silver.load_statgroups(spark, f"{br}.leaderboard_pages_br", f"{sr}.statgroup_sr")
    silver.merge_matches(spark, f"{sr}.matches_sr", f"{sr}.matches_s2r", window, game_dates)
    silver.merge_players(spark, f"{sr}.players_sr", f"{sr}.players_s2r", window)
    silver.load_standings(
        spark,
        f"{sr}.leaderboards_sr",
        f"{sr}.statgroup_sr",
        f"{br}.country_list_br",
        f"{sr}.player_leaderboard_stats_s2r",
    )

    gold.merge_civs(spark, f"{sr}.players_s2r", f"{gd}.dim_civ_gd")
    gold.merge_dates(spark, f"{sr}.dim_date_sr", f"{gd}.dim_date_gd")
    gold.merge_matches(spark, f"{sr}.matches_s2r", f"{gd}.dim_match_gd", window)
    gold.merge_people(spark, f"{sr}.player_leaderboard_stats_s2r", f"{gd}.dim_player_gd")
    gold.merge_fact(
        spark,
        f"{sr}.players_s2r",
        f"{gd}.dim_civ_gd",
        f"{gd}.dim_match_gd",
        f"{gd}.dim_player_gd",
        f"{gd}.dim_date_gd",
        f"{gd}.fact_player_matches_gd",
        window,
    )
    export_views(spark, lake)


def land(
    spark: SparkSession, raw: RawFiles, folder: str, window: tuple[date | str, date | str]
) -> RawFiles:
    """Validate what arrived; returns the sources of what landed."""
    landed = {}
    for name, source, fields in (
        ("matches", raw.matches, records.MATCH_RECORD),
        ("players", raw.players, records.PLAYER_RECORD),
    ):
        arrived = with_provenance(
            scan(spark, source), source.source, dated=True, window=window, root=source.path
        )
        path = f"{folder}/{name}"
        landing.land_records(
            arrived.select(*[f.name for f in fields if f.name in arrived.columns], "file_date"),
            fields,
            path,
            f"{folder}/quarantine/{name}",
        )
        landed[name] = weekly_parquet(path, source.source)
    pages = raw.leaderboard_pages
    if pages.fmt == "documents":
        texts = document_pages(spark, pages.path, **pages.options)
    else:
        texts = spark.read.text(pages.path).withColumn("fault", F.lit(None).cast("string"))
    landing.land_documents(
        texts,
        "value",
        pages.schema,
        records.PAGE_REQUIRED,
        f"{folder}/leaderboard_pages",
        f"{folder}/quarantine/leaderboard_pages",
        delivery=str(window[1]),
        fault="fault",
    )
    return RawFiles(
        landed["matches"],
        landed["players"],
        json_lines(f"{folder}/leaderboard_pages", pages.source, pages.schema),
        raw.countries,
    )


def export_views(spark: SparkSession, lake: Lake) -> None:
    fact = scan_table(spark, f"{lake.gold}.fact_player_matches_gd")
    matches = scan_table(spark, f"{lake.gold}.dim_match_gd")
    civs = scan_table(spark, f"{lake.gold}.dim_civ_gd")
    people = scan_table(spark, f"{lake.gold}.dim_player_gd")
    for name, view, order in (
        ("civ_performance", views.civ_performance(fact, matches, civs), views.CIV_PERFORMANCE_ORDER),
        ("opponent_civ", views.opponent_civ(fact, matches, civs), views.OPPONENT_CIV_ORDER),
        ("leaderboard", views.leaderboard(people), views.LEADERBOARD_ORDER),
    ):
        views.export(view, f"{lake.exports}/vw_{name}_analysis", order)
