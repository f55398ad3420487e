"""Time the plans this library uses beside the plain ones they replace.

    python tools/measure_rewrites.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from check_queries import session  # noqa: E402
from ladderlake.functions.columns import elo_bucket, win_flag  # noqa: E402
from ladderlake.operators.filters import in_run_window  # noqa: E402
from ladderlake.plans import views  # noqa: E402
from ladderlake.quality.rules import InRange, enforce, key_gate  # noqa: E402
from ladderlake.registry import stand_ins as s  # noqa: E402
from ladderlake.sinks.files import land_parquet  # noqa: E402
from ladderlake.sinks.workspace import fresh_path, stage  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    """Better of two runs, after one that compiles."""
    action()
    spent = []
    for _ in range(2):
        start = time.perf_counter()
        action()
        spent.append(time.perf_counter() - start)
    return round(min(spent), 2)


def self_join_view(fact, matches, civs):
    """Head-to-head view as a self join of all player rows with a distinct count."""
    named = fact.join(civs.withColumnsRenamed({"civ_pk": "civ_fk", "civ_name": "civ"}), "civ_fk")
    other = named.select("match_fk", F.col("civ").alias("opponent_civ"))
    where = matches.select(
        F.col("match_pk").alias("match_fk"), "map", elo_bucket("avg_elo").alias("bucket")
    )
    return (
        named.join(other, "match_fk").filter("civ <> opponent_civ").join(where, "match_fk")
        .groupBy("civ", "opponent_civ", "map", "bucket")
        .agg(F.count_distinct("match_fk").alias("n"), F.sum(win_flag("winner")).alias("w"))
    )


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.1")
    sf = args.parse_args().sf
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")

    fact = stage(s.fact(spark, sf))[0]
    matches, civs = stage(s.match_dim(spark, sf))[0], stage(s.civ_dim(spark, sf))[0]
    print("head-to-head view     ", timed(lambda: run(views.opponent_civ(fact, matches, civs))))
    print("  as a self join      ", timed(lambda: run(self_join_view(fact, matches, civs))))

    # One match takes a hundredth of all player rows.
    one = matches.first()["match_pk"]
    hot = stage(
        fact.withColumn(
            "match_fk", F.when(F.abs(F.hash("match_fk")) % 100 == 0, one).otherwise(F.col("match_fk"))
        )
    )[0]
    print("with a hot match      ", timed(lambda: run(views.opponent_civ(hot, matches, civs))))
    print("  as a self join      ", timed(lambda: run(self_join_view(hot, matches, civs))))

    players = stage(s.unique_players(spark, sf))[0]
    gate = key_gate("id", InRange("file_date", "1990-01-01", "2010-01-01"))
    print("quality gate          ", timed(lambda: enforce(players, gate)))
    print("  an action per rule  ", timed(lambda: [enforce(players, [rule]) for rule in gate]))

    path = fresh_path(spark, "landed")
    land_parquet(players, path)
    landed = spark.read.parquet(path)
    window = in_run_window("file_date", "1999-04-01", "1999-07-01")
    by_column = F.date_add("file_date", 0).between(
        F.lit("1999-04-01").cast("date"), F.lit("1999-07-01").cast("date")
    )
    flat = stage(players)[0]
    print("run window, partitions", timed(lambda: run(landed.filter(window))))
    print("  unpartitioned       ", timed(lambda: run(flat.filter(by_column))))


if __name__ == "__main__":
    main()
