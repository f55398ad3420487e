"""Every registered query against its SQL counterpart, whole results compared."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import database as duck
from check_queries import difference, same
from conftest import SF

INVENTORY = """
scan_configured scan_parquet scan_json_multiline scan_csv_header scan_table scan_csv_gz
gen_dim_date gen_weekly_windows gen_weekly_paths
sink_overwrite_table sink_partitioned sink_upsert sink_upsert_metrics sink_csv_gz
sink_land_parquet sink_land_json
add_provenance derive_file_date conform_schema select_rename struct_expand nested_field
surrogate_key_md5 hash_key_single smart_date_key constant_columns audit_columns bucketize_elo
nanos_to_secs rename_lower display_rename drop_column
filter_run_window resolve_run_window filter_equality filter_not_null filter_is_null
filter_outside_range filter_not_equal_cols filter_multi_isin latest_rank_filter
join_star_fact join_inner_equi join_left_lookup_default join_fact_dims_view join_self_theta
join_merge_match
agg_civ_performance agg_opponent_civ agg_count_distinct agg_conditional_sum agg_ratio_guarded
rollup_civ_opponent rollup_civ_trend agg_last_updated distinct_filter_values distinct_rows
drop_duplicates_rows agg_count_all
dedup_latest_by_key sort_multi_asc sort_rank_asc
fn_string fn_date fn_date_parts fn_datetime_parse fn_math fn_conditional fn_cast fn_bool
fn_explode fn_context
dq_nulls dq_unique dq_valid_range dq_schema dq_non_empty dq_suite validate_rows
quarantine_rows validate_document recast_fields clean_float_id clean_to_string clean_to_float
flag_empty_dump
job_bronze_matches job_bronze_players job_bronze_relic job_bronze_country
job_bronze_dim_date job_silver_dim_date job_silver_leaderboards job_silver_statgroup
job_silver_matches job_silver_players job_silver2_matches job_silver2_players
job_silver2_player_leaderboard job_dim_civ job_dim_date job_dim_match job_dim_player
job_fact_player_matches view_civ_performance view_leaderboard view_opponent_civ
page_leaderboard page_civ_compare page_civ_trend
""".split()

# Further queries: other branches of the same operators.
MORE = "sink_upsert_whole validate_matches".split()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_inventory_is_complete():
    assert len(INVENTORY) == 110
    assert set(INVENTORY) <= set(entry.queries())
    assert set(INVENTORY) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", INVENTORY + MORE)
def test_query_matches_sql(spark, con, sf, key):
    df = entry.queries()[key](spark, sf)
    result = con.execute(entry.oracle_sql()[key])
    columns = {d[0]: str(d[1]).lower() for d in result.description}
    assert not difference(df.columns, df.collect(), list(columns), result.fetchall())
    assert all(same(kind, columns[name]) for name, kind in df.dtypes), (df.dtypes, columns)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
