"""Quality rules and record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.functions import cleaning
from ladderlake.plans.landing import land_documents, land_records
from ladderlake.quality import records, rules
from ladderlake.quality.rules import HasColumns, InRange, NonEmpty, NotNull, Unique, quality_report
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.stand_ins import table
from ladderlake.sinks.ledger import current_rejects
from ladderlake.sinks.workspace import fresh_path
from ladderlake.sources import scans
from ladderlake.sources.documents import document_pages

_PROFILES = """WITH profiles AS (SELECT l_orderkey, l_linenumber,
 CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS profile_id,
 CAST(l_shipdate AS DATE) AS game_date FROM lineitem)"""


def _profiles(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("profile_id"),
        F.to_date("l_shipdate").alias("game_date"),
    )


def _row(rule: str, target: str, violations: str, source: str = "profiles") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{target}' AS target, CAST({violations} AS BIGINT) AS violations, "
        f"{violations} = 0 AS passed FROM {source}"
    )


_NULLS = "count(*) FILTER (profile_id IS NULL)"
_REPEATS = "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, profile_id FROM profiles))"
_OUTSIDE = "count(*) FILTER (game_date < DATE '1996-01-01' OR game_date > DATE '2000-12-31')"


@register(
    "dq_nulls",
    f"{_PROFILES} {_row('not_null', 'profile_id', _NULLS)} UNION ALL "
    + _row("not_null", "l_orderkey", "count(*) FILTER (l_orderkey IS NULL)"),
)
def dq_nulls(spark, sf):
    return quality_report(_profiles(spark, sf), [NotNull("profile_id"), NotNull("l_orderkey")])


@register(
    "dq_unique",
    f"{_PROFILES} {_row('unique', 'l_orderkey,profile_id', f'(count(*) - {_REPEATS})')}",
)
def dq_unique(spark, sf):
    """Rows without a profile count as one value per order."""
    return quality_report(_profiles(spark, sf), [Unique(("l_orderkey", "profile_id"))])


@register("dq_valid_range", f"{_PROFILES} {_row('in_range', 'game_date', _OUTSIDE)}")
def dq_valid_range(spark, sf):
    return quality_report(
        _profiles(spark, sf), [InRange("game_date", "1996-01-01", "2000-12-31")]
    )


@register(
    "dq_schema",
    f"{_PROFILES} "
    + _row("has_columns", "l_orderkey,l_linenumber,profile_id,game_date", "count(*) * 0")
    + " UNION ALL "
    + _row("has_columns", "l_linenumber,l_orderkey,profile_id,game_date", "(count(*) * 0 + 1)"),
)
def dq_schema(spark, sf):
    """Names in the right and in the wrong order."""
    right = ("l_orderkey", "l_linenumber", "profile_id", "game_date")
    wrong = ("l_linenumber", "l_orderkey", "profile_id", "game_date")
    return quality_report(_profiles(spark, sf), [HasColumns(right), HasColumns(wrong)])


@register(
    "dq_non_empty",
    "SELECT 'non_empty' AS rule, '*' AS target, CAST(0 AS BIGINT) AS violations, "
    "count(*) > 0 AS passed FROM events",
)
def dq_non_empty(spark, sf):
    return quality_report(table(spark, sf, "events"), [NonEmpty()])


@register(
    "dq_suite",
    f"{_PROFILES} "
    + " UNION ALL ".join(
        [
            _row("not_null", "l_orderkey", "count(*) FILTER (l_orderkey IS NULL)"),
            _row("unique", "l_orderkey",
                 "(count(*) - (SELECT count(DISTINCT l_orderkey) FROM profiles))"),
            _row("not_null", "profile_id", _NULLS),
            _row("in_range", "game_date", _OUTSIDE),
            _row("non_empty", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
        ]
    ),
)
def dq_suite(spark, sf):
    gate = rules.key_gate(
        "l_orderkey", NotNull("profile_id"), InRange("game_date", "1996-01-01", "2000-12-31")
    )
    return quality_report(_profiles(spark, sf), gate)


# ---- records ---------------------------------------------------------------
def _raw_records(spark, sf):
    """Player records as text, with the faults real files have: fractions where whole
    numbers belong, words that are no outcome, missing civs, profiles as floats."""
    line = F.col("l_linenumber")
    key = F.col("l_orderkey").cast("string")
    civ = F.when(F.col("l_tax") != 0.08, F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select(
        F.concat(
            key, F.when(line == 7, ".5").when(line == 6, ".0").otherwise("")
        ).alias("game_id"),
        civ.alias("civ"),
        (F.col("l_quantity") - 25).alias("match_rating_diff"),
        F.col("l_quantity").alias("new_rating"),
        F.col("l_partkey").alias("old_rating"),
        F.when(line == 1, "NaN")
        .when(line == 2, "unknown")
        .otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")))
        .alias("profile_id"),
        F.col("l_linestatus").alias("replay_summary_raw"),
        line.alias("team"),
        F.when(line == 3, "maybe")
        .when(F.col("l_returnflag") == "R", "Yes")
        .otherwise("off")
        .alias("winner"),
        "l_orderkey",
        "l_linenumber",
    )


_JUDGED = """WITH judged AS (SELECT l_orderkey, l_linenumber,
 CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS game_id,
 CASE WHEN l_tax <> 0.08 THEN l_returnflag END AS civ,
 CAST(trunc(l_quantity) AS BIGINT) AS new_rating,
 CASE WHEN l_linenumber > 2 THEN l_suppkey END AS profile_id,
 CASE WHEN l_linenumber <> 3 THEN l_returnflag = 'R' END AS winner,
 concat_ws('; ', CASE WHEN l_tax = 0.08 THEN 'civ: missing' END,
  CASE WHEN l_linenumber = 7 THEN 'game_id: not a valid int' END,
  CASE WHEN l_linenumber <= 2 THEN 'profile_id: not a valid int' END,
  CASE WHEN l_linenumber = 3 THEN 'winner: not a valid bool' END) AS reasons
FROM lineitem)"""
# Missing numbers print differently in the two engines, so they are shown as -1.
_JUDGED_COLUMNS = """l_orderkey, l_linenumber, coalesce(game_id, -1) AS game_id, civ,
 coalesce(new_rating, -1) AS new_rating, coalesce(profile_id, -1) AS profile_id,
 CAST(winner AS VARCHAR(5)) AS winner"""


def _shown(df, *more):
    absent = {c: F.coalesce(c, F.lit(-1)) for c in ("game_id", "new_rating", "profile_id")}
    return df.withColumns({**absent, "winner": F.col("winner").cast("string")}).select(
        "l_orderkey", "l_linenumber", "game_id", "civ", "new_rating", "profile_id", "winner", *more
    )


@register(
    "validate_rows",
    f"{_JUDGED} SELECT {_JUDGED_COLUMNS} FROM judged WHERE reasons = ''",
)
def validate_rows(spark, sf):
    judged = records.judge(
        _raw_records(spark, sf), records.PLAYER_RECORD, "l_orderkey", "l_linenumber"
    )
    return _shown(records.accepted(judged))


@register(
    "quarantine_rows",
    f"{_JUDGED} SELECT {_JUDGED_COLUMNS}, reasons FROM judged WHERE reasons <> ''",
)
def quarantine_rows(spark, sf):
    judged = records.judge(
        _raw_records(spark, sf), records.PLAYER_RECORD, "l_orderkey", "l_linenumber"
    )
    rejected = records.quarantined(judged)
    return _shown(rejected, F.concat_ws("; ", "errors").alias("reasons"))


@register(
    "validate_matches",
    """SELECT o_orderkey, concat_ws('; ',
  CASE WHEN o_orderstatus = 'P' THEN 'avg_elo: not a valid float' END,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'map: missing' END,
  CASE WHEN o_custkey % 7 = 0 THEN 'raw_match_type: not a valid float' END) AS reasons,
 coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, -1) AS avg_elo,
 o_orderdate AS started_timestamp FROM orders""",
)
def validate_matches(spark, sf):
    """A match record per order, all values as text: a rating with a type suffix, a missing
    map, a match type that is a word; starts as seconds or milliseconds."""
    key = F.col("o_custkey")
    price = F.col("o_totalprice").cast("string")
    start = F.unix_timestamp("o_orderdate")
    feed = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(price, F.lit("d"))).otherwise(price).alias("avg_elo"),
        F.lit("1800000000000").alias("duration"),
        F.col("o_orderkey").cast("string").alias("game_id"),
        F.lit("fast").alias("game_speed"),
        F.col("o_orderstatus").alias("game_type"),
        F.lit("900000000000").alias("irl_duration"),
        F.lit("random_map").alias("leaderboard"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("map"),
        F.lit("no").alias("mirror"),
        F.lit("2.0").alias("num_players"),
        F.lit("100000").alias("patch"),
        F.when(key % 7 == 0, "ranked").when(key % 7 != 1, "1.5").alias("raw_match_type"),
        F.lit("true").alias("replay_enhanced"),
        F.when(key % 2 == 0, start.cast("string")).otherwise((start * 1000).cast("string")).alias("started_timestamp"),
        F.lit("dark").alias("starting_age"),
        F.lit("1e3").alias("team_0_elo"),
        F.lit(" 999.5 ").alias("team_1_elo"),
    )
    return records.judge(feed, records.MATCH_RECORD, "o_orderkey").select(
        "o_orderkey",
        F.concat_ws("; ", "errors").alias("reasons"),
        F.coalesce("avg_elo", F.lit(-1.0)).alias("avg_elo"),
        F.col("started_timestamp").cast("timestamp_ntz").alias("started_timestamp"),
    )


@register(
    "validate_document",
    """SELECT o_orderkey, concat_ws('; ',
  CASE WHEN o_orderstatus = 'P' THEN 'document: malformed or mistyped' END,
  CASE WHEN o_orderstatus = 'P' THEN 'statGroups.id: missing' END,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'statGroups.members.alias: missing' END) AS reasons,
 o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AS valid,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE -1 END AS group_id,
 o_custkey AS profile_id FROM orders""",
)
def validate_document(spark, sf):
    """A leaderboard page per order: a text where a number belongs, numbers written as text
    or with a fraction, a member without alias."""
    key = F.col("o_orderkey").cast("string")
    number = (
        F.when(F.col("o_orderstatus") == "P", '"not_an_integer"')
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit('"'), key, F.lit('"')))
        .otherwise(key)
    )
    member = F.struct(
        (F.col("o_custkey") + 0.5).alias("profile_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("alias"),
        F.lit("se").alias("country"),
    )
    other = F.struct(
        F.lit(1.0).alias("profile_id"), F.lit("ally").alias("alias"), F.lit("no").alias("country")
    )
    text = F.concat(
        F.lit('{"statGroups": [{"id": '),
        number,
        F.lit(', "name": null, "members": '),
        F.to_json(F.array(member, other)),
        F.lit('}], "leaderboardStats": [{"statgroup_id": "7", "rank": 1.0, "lastmatchdate": 5}]}'),
    )
    layout = schemas.RAW_LEADERBOARD_PAGE
    docs = records.parse_documents(
        table(spark, sf, "orders").select("o_orderkey", text.alias("body")), "body", layout
    )
    group = F.col("doc.statGroups")[0]
    return records.judge_documents(docs, layout, records.PAGE_REQUIRED).select(
        "o_orderkey",
        F.concat_ws("; ", "errors").alias("reasons"),
        (F.size("errors") == 0).alias("valid"),
        F.coalesce(group["id"].cast("bigint"), F.lit(-1)).alias("group_id"),
        group["members"][0]["profile_id"].alias("profile_id"),
    )


@register(
    "land_array_files",
    """WITH page AS (SELECT s_suppkey, s_suppkey % 7 = 0 AS bad, s_suppkey // 5 AS file, s_suppkey % 5 AS place
 FROM supplier)
SELECT s_suppkey, CASE WHEN bad THEN 'statGroups.members.alias: missing' ELSE '' END AS reasons
FROM page WHERE NOT (file % 10 = 3 AND place = 4)
UNION ALL SELECT -file, 'document: cut off' FROM page WHERE file % 10 = 3 AND place = 4""",
)
def land_array_files(spark, sf):
    """Files of five pages each, as an array. A bad page is rejected and the others of its
    file land; in every tenth file the last page is cut off."""
    key = F.col("s_suppkey")
    alias = F.when(key % 7 != 0, F.col("s_name"))
    member = F.struct(key.alias("profile_id"), alias.alias("alias"), F.lit("se").alias("country"))
    group = F.struct(key.alias("id"), F.array(member).alias("members"))
    played = F.lit(5).alias("lastmatchdate")
    stat = F.struct(key.alias("statgroup_id"), F.lit(1).alias("rank"), played)
    page = F.struct(F.array(group).alias("statGroups"), F.array(stat).alias("leaderboardStats"))
    file = F.floor(key / 5)
    raw, good, bad = (fresh_path(spark, n) for n in ("array_files", "pages", "rejects"))
    (
        table(spark, sf, "supplier")
        .groupBy(file.alias("file"))
        .agg(F.sort_array(F.collect_list(F.struct(key.alias("at"), page.alias("page")))).alias("some"))
        .select(
            F.to_json(F.col("some.page"), {"pretty": "true"}).alias("text"), "file", F.size("some").alias("n")
        )
        .select(
            F.when((F.col("file") % 10 == 3) & (F.col("n") == 5), F.expr("left(text, length(text) - 8)"))
            .otherwise(F.col("text")).alias("value"),
        )
        # Small as they are, the files are written by all tasks, a row each, into one folder.
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        .write.option("maxRecordsPerFile", 1).text(raw)
    )
    layout = schemas.RAW_LEADERBOARD_PAGE
    land_documents(
        document_pages(spark, raw), "value", layout, records.PAGE_REQUIRED, good, bad, fault="fault"
    )
    landed = scans.scan(spark, scans.json_lines(good, s.BOARD_SOURCE, layout)).select(
        F.col("statGroups")[0]["id"].cast("bigint").alias("s_suppkey"), F.lit("").alias("reasons")
    )
    # What is left of a page that was cut off still begins with the id of its group.
    found = F.regexp_extract("value", r'"id" : ([0-9]+)', 1).cast("bigint")
    reasons = F.concat_ws("; ", "errors")
    rejects = current_rejects(spark, bad, "delivery").select(
        F.when(reasons == "document: cut off", -F.floor(found / 5)).otherwise(found).alias("s_suppkey"),
        reasons.alias("reasons"),
    )
    return landed.union(rejects)


@register(
    "quarantine_corrected",
    """SELECT l_orderkey, l_linenumber, year(l_shipdate) AS file_date,
 concat_ws('; ', CASE WHEN l_tax = 0.08 THEN 'civ: missing' END,
  CASE WHEN l_linenumber = 7 THEN 'game_id: not a valid int' END) AS reasons
FROM lineitem WHERE (l_tax = 0.08 OR l_linenumber = 7) AND year(l_shipdate) NOT IN (1996, 1998)""",
)
def quarantine_corrected(spark, sf):
    """Two years are delivered again without faults: their rejects are gone, the others stay."""
    kinds = {"civ": "text", "game_id": "int", "l_orderkey": "int", "l_linenumber": "int"}
    fields = [records.Field(name, kind) for name, kind in kinds.items()]
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("file_date"),
        F.when(F.col("l_tax") != 0.08, F.col("l_returnflag")).alias("civ"),
        F.concat(
            F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") == 7, ".5").otherwise("")
        ).alias("game_id"),
    )
    good, bad = fresh_path(spark, "records"), fresh_path(spark, "rejects")
    land_records(line, fields, good, bad)
    again = line.where(F.col("file_date").isin(1996, 1998)).withColumns(
        {"civ": F.coalesce("civ", F.lit("R")), "game_id": F.col("l_orderkey").cast("string")}
    )
    land_records(again, fields, good, bad)
    return current_rejects(spark, bad, "file_date").select(
        F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"),
        F.col("file_date").cast("bigint"), F.concat_ws("; ", "errors").alias("reasons"),
    )


@register(
    "recast_fields",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def recast_fields(spark, sf):
    """Prices arrive as text and are recast; priorities cannot become numbers and stay."""
    feed = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderpriority"
    )
    casts = {"o_totalprice": "double", "o_orderpriority": "bigint", "not_there": "int"}
    return cleaning.recast(feed, casts)


@register(
    "clean_float_id",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 2 THEN l_suppkey ELSE -1 END AS from_text,
 CASE WHEN l_linenumber <> 5 THEN l_suppkey ELSE -1 END AS from_number FROM lineitem""",
)
def clean_float_id(spark, sf):
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, "NaN")
        .when(line > 2, F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")))
    )
    number = F.when(line == 5, F.lit(float("nan"))).otherwise(F.col("l_suppkey").cast("double"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(cleaning.float_id(text), F.lit(-1)).alias("from_text"),
        F.coalesce(cleaning.float_id(number), F.lit(-1)).alias("from_number"),
    )


@register(
    "clean_to_string",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS raw
FROM events""",
)
def clean_to_string(spark, sf):
    user = F.when(F.col("event_type") != "view", F.col("user_id"))
    return table(spark, sf, "events").select("event_id", cleaning.to_text(user).alias("raw"))


@register(
    "clean_to_float",
    """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'error') THEN
 CAST(user_id AS DOUBLE) + 0.5 END AS raw_match_type, event_type = 'error' AS rejected FROM events""",
)
def clean_to_float(spark, sf):
    """Missing stays missing; text that is no number is a reason to reject."""
    kind = F.col("event_type")
    raw = F.when(kind == "error", "n/a").when(
        kind != "view", F.concat(F.col("user_id").cast("string"), F.lit(".5"))
    )
    fields = (
        records.Field("event_id", "int"),
        records.Field("raw_match_type", "float", required=False, clean=cleaning.to_float),
    )
    feed = table(spark, sf, "events").select("event_id", raw.alias("raw_match_type"))
    return records.judge(feed, fields).select(
        "event_id", "raw_match_type", (F.size("errors") > 0).alias("rejected")
    )


@register(
    "flag_empty_dump",
    """SELECT d AS start_date, n AS num_matches, n + 1 AS num_players, 'm' || n AS matches_url,
 CASE WHEN n = 0 THEN 'File ' || strftime(d, '%Y-%m-%d') || ' is present but is empty!' END
  AS warning
FROM (SELECT CAST(o_orderdate AS DATE) AS d,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS INTEGER) AS n FROM orders GROUP BY 1)
WHERE month(d) <> 2""",
)
def flag_empty_dump(spark, sf):
    """A manifest per month, listing each day with its number of finished orders; those of
    February lack a url and are rejected."""
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("start_date")).agg(
        F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("num_matches")
    )
    dump = F.struct(
        "start_date",
        "num_matches",
        (F.col("num_matches") + 1).cast("string").alias("num_players"),
        F.concat(F.lit("m"), F.col("num_matches").cast("string")).alias("matches_url"),
        F.when(F.month("start_date") != 2, "p").alias("players_url"),
    )
    manifests = daily.groupBy(F.trunc("start_date", "month").alias("month")).agg(
        F.to_json(F.struct(F.collect_list(dump).alias("db_dumps"))).alias("body")
    )
    layout = schemas.RAW_MANIFEST
    judged = records.judge_documents(
        records.parse_documents(manifests, "body", layout), layout, records.MANIFEST_REQUIRED
    )
    entries = records.manifest_entries(records.accepted(judged).select("doc.*"))
    return entries.select("start_date", "num_matches", "num_players", "matches_url", "warning")
